"""The filter funnel: language, content quality, syntax, coherence, duplicates, with counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scores as S
from ..functions.language import detect_language, passes_filter
from .dedup import aggressive_key
from .markup import parsed

#: The stages' thresholds.
QUALITY, SYNTAX, COHERENCE = 0.7, 0.8, 0.6


def stage(corrected: bool = False) -> Column:
    """The first stage that a row fails, null where it passes all; later stages are not computed.
    Columns: content, language, found, well_formed (whether it parses, needed of xml only)."""
    c, m, f = F.col("content"), F.col("language"), F.col("found")
    below = lambda x, t: F.round(x, 9) < t
    return (
        F.when(~passes_filter(c, f, corrected), "language")
        .when(below(S.content_quality(c, m, f), QUALITY), "quality")
        .when(below(S.syntax_validity(c, f, F.col("well_formed")), SYNTAX), "syntax")
        .when(below(S.coherence(c), COHERENCE), "coherence")
    )


def funnel(df: DataFrame, corrected: bool = False) -> DataFrame:
    """AGG7: one row of counters. Texts are read once; only keys' hashes are shuffled. df: content, language."""
    rows = df.select("content", "language").withColumn("found", detect_language(F.col("content"), F.col("language")))
    rows = parsed(rows).withColumn("stage", stage(corrected))
    rows = rows.select("stage", F.when(F.col("stage").isNull(), F.sha2(aggressive_key(F.col("content")), 256)).alias("key"))
    groups = rows.groupBy("stage", "key").agg(F.count("*").alias("n"))
    failed = lambda x: F.coalesce(F.sum(F.when(F.col("stage") == x, F.col("n"))), F.lit(0)).alias(f"{x}_filtered")
    total = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        *map(failed, ("language", "quality", "syntax", "coherence")),
        F.coalesce(F.sum(F.when(F.col("key").isNotNull(), F.col("n") - 1)), F.lit(0)).alias("duplicates"),
        F.count("key").alias("kept"),
    )
    return total.withColumn("efficiency", F.round(F.coalesce(F.try_divide("kept", "total"), F.lit(0.0)), 6))
