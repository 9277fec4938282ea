"""Exact deduplication on normalised keys: keep first, groups, keep best.

The whole normalised text is the key, so this is what a one-element set per document gives. Keys
are hashed before they are grouped, and every step is an aggregate with partial sums, so a text
that very many rows share is one row from each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPACE, strip


def aggressive_key(c: Column) -> Column:
    """PRJ5: no comments, one space, literals and identifiers by kind, lower case."""
    c = F.regexp_replace(c, r"(?m)(?d)//.*$", "")
    c = F.regexp_replace(c, r"(?s)/\*.*?\*/", "")
    c = F.regexp_replace(c, f"{SPACE}+", " ")
    c = F.regexp_replace(c, "[\"'`][^\"']*[\"'`]", '"string"')
    c = F.regexp_replace(c, r"(?<![\p{L}\p{N}_])([0-9]+|[a-zA-Z_][a-zA-Z0-9_]*)(?![\p{L}\p{N}_])", "identifier")
    return strip(F.lower(c))


def light_key(c: Column, language: Column) -> Column:
    """PRJ6: one space; for JavaScript and TypeScript then no comments (all is one line by now)."""
    c = F.regexp_replace(c, f"{SPACE}+", " ")
    bare = F.regexp_replace(F.regexp_replace(c, "//.*$", ""), r"(?s)/\*.*?\*/", "")
    low = F.lower(language)
    return strip(F.lower(F.when(low.contains("javascript") | low.contains("typescript"), bare).otherwise(c)))


def keyed(df: DataFrame, key: Column) -> DataFrame:
    return df.withColumn("key", F.sha2(key, 256))


def keep_first(df: DataFrame, id_col: str = "id") -> DataFrame:
    """DUP1, DUP2: the least id of each key, and how many rows had it. df: key and the id."""
    return df.groupBy("key").agg(F.min(id_col).alias(id_col), F.count("*").alias("copies"))


def duplicate_pairs(df: DataFrame, id_col: str = "id") -> DataFrame:
    """DUP3: every further id with its group's first one; no group is gathered in a list."""
    first = df.groupBy("key").agg(F.min(id_col).alias("rep_id"), F.count("*").alias("n")).where("n > 1")
    return df.join(first, "key").where(F.col(id_col) != F.col("rep_id")).select("rep_id", F.col(id_col).alias("dup_id"))


def keep_best(df: DataFrame, score: str, id_col: str = "id") -> DataFrame:
    """DUP4: of each key the row of the highest score, the least id where scores are equal."""
    best = F.min_by(F.struct(F.col(id_col), F.col(score)), F.struct(-F.coalesce(F.col(score), F.lit(-1e300)), F.col(id_col)))
    return df.groupBy("key").agg(best.alias("b")).select(f"b.{id_col}", f"b.{score}")
