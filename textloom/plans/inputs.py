"""Inputs that several queries share, each as a DataFrame and as a DuckDB common table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table

#: Own samples for the branches that no fixture row reaches.
SAMPLES = [
    (1, "function add(a, b) { return a + b; }\nconst x = add(1, 2);\nclass Box { open() { return x; } }", "javascript"),
    (2, "interface Shape { name: string; area: number }\ntype Id = string;\nconst f = (s: Shape): number => { return s.area; };", "typescript"),
    (3, "<?xml version=\"1.0\"?>\n<note id=\"7\"><to>Ann</to><body>hi</body></note>", "xml"),
    (4, "<!DOCTYPE html>\n<html lang=\"en\"><head><title>t</title></head><body class=\"a\" id=\"b\"><p>x</p></body></html>", "html"),
    (5, "body { color: red; margin: 0; }\n.box { padding: 4px; }\n/* note */\n@media print { p { color: black; } }", "css"),
    (6, "# Title\n\n**bold** and *soft* text\n\n```\ncode\n```\n<Chart kind=\"bar\" />\n## More", "mdx"),
    (7, "console.log('x');", "javascript"),
    (8, "", "unknown"),
    (9, "   ", "js"),
    (10, "if (a && b || c) {\n  for (let i = 0; i < 9; i++) {\n\twhile (true) { break; }\n  }\n} else {\n    switch (a) { case 1: break; }\n}", "ts"),
    (11, "const load = async () => {\n  try {\n    const r = await fetch('/api/items');\n    return r.json();\n  } catch (error) {\n    throw error;\n  }\n};", "javascript"),
    (12, "import react from 'react';\nfrom x import y\nlet snake_case_name = 1;\nvar camelCaseName = 2;\n}", "javascript"),
    (13, "The class of 1999 was small. It had a list, an array, and an object! Was it? Yes.", "unknown"),
    (14, "// TODO remove\nlet n = 10; // ten\n/* block\n comment */\nlet s = \"a b\"; debugger;\nalert(1)", "javascript"),
    (15, "import os\n\ndef area(w, h):\n    # of a box\n    return w * h\n", "python"),
    (16, "def broken(x:\n    return x", "python"),
    (17, "<a x=\"1\"><!-- p < q --><b><![CDATA[ 1 < 2 ]]></b></a>", "xml"),
    (18, "import React from 'react';\nexport const Button = (props) => {\n  return (<button className=\"b\" onClick={props.go}>{props.label}</button>);\n};\nexport default Button;", "javascript"),
    (19, ".card { display: flex; width: calc(100% - 4px); color: var(--ink); }\n@media (max-width: 600px) { .card { display: grid; transition: all 1s; } }\n#id { min-width: min(4px, 1em); }", "css"),
    (20, "{\"name\": \"app\", \"config\": {\"value\": 1}, \"dependencies\": {\"a\": \"1.0.0\"}, \"property\": [true, null]}", "json"),
    (21, "# Button\n\nDescription of props, with an [example](x).\n\n```js\nusage()\n```\n\n<Button />", "mdx"),
    (22, "if (a [ b ) ] { mixed } up the order of brackets", "unknown"),
    (23, "<form>\n  <input name='a'>\n  <button>Go</button>\n</form> and more words here", "html"),
]


#: Samples that parse as XML, Python and JSON, by hand; of the tables' rows none does as XML.
PARSES = {"xml": (3, 4, 17), "python": (15,), "json": (20,)}


def parses(kind: str) -> str:
    return f"(src = 's' AND id IN ({', '.join(map(str, PARSES[kind]))}))"


def quoted(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def values(rows: list[tuple], names: str) -> str:
    """A DuckDB VALUES table."""
    cell = lambda v: quoted(v) if v is None or isinstance(v, str) else str(v).lower() if isinstance(v, bool) else f"{v!r}::DOUBLE" if isinstance(v, float) else str(v)
    return f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) AS v({names}))"


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """src, id, content, language: all documents, all pages, and the samples."""
    docs = table(spark, sf_dir, "documents").select(F.lit("d").alias("src"), F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("content"), F.coalesce("lang", F.lit("unknown")).alias("language"))
    pages = table(spark, sf_dir, "pages").select(F.lit("p"), "page_id", F.coalesce("html", F.lit("")), F.lit("unknown"))
    own = spark.createDataFrame([("s", *r) for r in SAMPLES], "src string, id long, content string, language string")
    return docs.union(pages).union(own)


CONTENTS = f"""c AS (
  SELECT 'd' AS src, doc_id AS id, coalesce(text, '') AS content, coalesce(lang, 'unknown') AS language FROM documents
  UNION ALL SELECT 'p', page_id, coalesce(html, ''), 'unknown' FROM pages
  UNION ALL SELECT 's', * FROM {values(SAMPLES, "id, content, language")})"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, turn, instruction, output: each user turn with the assistant turn after it."""
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    both = turns.withColumn("next_role", F.lead("role").over(w)).withColumn("next_text", F.lead("text").over(w))
    return both.where("role = 'user' AND next_role = 'assistant'").select("conv_id", "turn", F.col("text").alias("instruction"), F.col("next_text").alias("output"))


PAIRS = """q AS (
  SELECT conv_id, turn, text AS instruction, next_text AS output FROM (
    SELECT conv_id, turn, role, coalesce(text, '') AS text, lead(role) OVER w AS next_role, lead(coalesce(text, '')) OVER w AS next_text
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND next_role = 'assistant')"""
