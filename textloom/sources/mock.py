"""SRC10, SRC11: rows of a code source made from templates, for trials without a download."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A text of our own for each language, and the extension of its files.
TEMPLATES = {
    "javascript": ("function total(xs) {\n  return xs.reduce((a, x) => a + x, 0);\n}\n", "js"),
    "typescript": ("interface Item {\n  id: number;\n}\nconst first = (xs: Item[]): Item => xs[0];\n", "ts"),
    "xml": ('<?xml version="1.0"?>\n<app>\n  <name value="x"/>\n</app>\n', "xml"),
    "html": ("<!DOCTYPE html>\n<html>\n<body><p>text</p></body>\n</html>\n", "html"),
    "css": (".box { margin: 0; }\n", "css"),
    "mdx": ("# Title\n\n<Chart />\n", "mdx"),
}


def mock_rows(ids: DataFrame, languages: list[str] | None = None) -> DataFrame:
    """A row of each language for every ``id``; languages without a template have a comment as text."""
    chosen = list(TEMPLATES) if languages is None else languages
    bank = [(k, *TEMPLATES.get(k, (f"// {k}\n", k))) for k in chosen]
    kinds = F.array(*(F.struct(F.lit(k).alias("language"), F.lit(c).alias("content"), F.lit(x).alias("extension")) for k, c, x in bank))
    rows = ids.select("id").withColumn("k", F.explode(kinds))
    i = F.col("id").cast("string")
    return rows.select(
        "id", "k.language", "k.content", F.concat(F.lit("repo_"), F.floor(F.col("id") / 1000).cast("string")).alias("source_repo"), F.concat(F.lit("src/file_"), i, F.lit("."), F.col("k.extension")).alias("file_path"),
        F.length("k.content").alias("size"), F.lit("mit").alias("license"), F.sha2(F.concat(F.lit("code_"), i), 256).alias("sha256"),
    )
