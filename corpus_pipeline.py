"""The corpus pipeline: quality rules, line dedup, near duplicates, decontamination, packing.

Each stage is one operator of ``textloom.llm`` with its production parameters; it works on all
rows that the stage before has kept, written as Parquet and read again. All but the last return
the columns of ``documents``. What holds for odd rows (nulls, empty texts, ties, repeated rows,
empty tables) is in the operators' docstrings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import decontaminate, line_dedup, ngram_jaccard, packing, quality_rules
from textloom.llm.common import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule, or whose host is condemned, go."""
    return quality_rules.kept_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them; ``n_chars`` is counted anew."""
    others = [c for c in docs.columns if c != "text"]
    own = F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in others)).alias("own")  # no name in it clashes
    kept = line_dedup.dedup_lines(docs.select("doc_id", "text", own))
    n = F.length("text").cast("long")
    return kept.select(*((F.col("text") if c == "text" else n if c == "n_chars" else F.col("own").getField(c)).alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words, a similarity of 0.8."""
    return ngram_jaccard.without_near_duplicates(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The placement of every piece of the documents' tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", decontamination),
    ("best_fit_packing", pack),
]

#: Near duplicates need connected components, and packing needs a tokenizer: no SQL does these.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
