"""Near duplicates by MinHash and banding: first wins, in id order.

A text's shingles are runs of ``width`` words (a shorter text is one shingle). Of each permutation of
32-bit hashes the least is kept; ``rows`` of these make a band's key. Texts that share a key in any
band are candidates, and a candidate of a kept text with a lower id is a duplicate, as in a walk
through an index into which only kept texts are put. 16 bands of 8 find 95 % of pairs of similarity
0.8, and all but one in a hundred thousand of 0.95.

The walk is done in rounds: an undecided text that is the first undecided one of all its buckets is
kept; undecided texts in a bucket of a kept one are duplicates. Rounds are tables in the shared
folder; buckets are reduced to their least id before they meet anything, so no pairs within a
bucket are made.

Null and empty texts have no shingles; equal texts are one from the start, whatever their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bind, words
from ..session import written

BANDS, ROWS = 16, 8
#: The largest prime below 2^32; factors stay below 2^30, so products fit 64 bits.
PRIME, FACTORS = 4294967291, 1073741789


def shingles(text: Column, width: int) -> Column:
    """Distinct runs of words."""

    def runs(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(w) - width + 1), lambda i: F.array_join(F.slice(w, i, width), " "))
        short = F.when(F.size(w) == 0, F.array().cast("array<string>")).when(F.size(w) < width, F.array(F.array_join(w, " ")))
        return F.array_distinct(short.otherwise(each))

    return bind(words(F.lower(F.coalesce(text, F.lit("")))), runs)


def permuted(h: Column, k: Column) -> Column:
    """The k-th permutation of a 32-bit hash."""
    a = 1 + (k * 829348951 + 40503) % FACTORS
    return (a * h + (k * 40503 + 12345)) % PRIME


def band_keys(docs: DataFrame, id_col: str, text_col: str, width: int = 5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc, band, key of every text with words."""
    each = docs.select(F.col(id_col).alias("doc"), F.explode(shingles(F.col(text_col), width)).alias("s"))
    hashed = each.select("doc", F.conv(F.substring(F.md5("s"), 1, 8), 16, 10).cast("long").alias("h"))
    dealt = hashed.select("doc", "h", F.explode(F.sequence(F.lit(0), F.lit(bands - 1)).cast("array<long>")).alias("band"))
    least = dealt.groupBy("doc", "band").agg(*(F.min(permuted(F.col("h"), F.col("band") * rows + j)).alias(f"m{j}") for j in range(rows)))
    return least.select("doc", "band", F.md5(F.concat_ws("-", *(F.col(f"m{j}").cast("string") for j in range(rows)))).alias("key"))


def shingle_hashes(text: Column, width: int = 5) -> Column:
    """The 32-bit hashes of a text's shingles, in an array."""
    return F.transform(shingles(text, width), lambda s: F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("long"))


def probe(docs: DataFrame, id_col: str, text_col: str, width: int = 5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """JON5: of every text with words the least id in any of its buckets, its own included."""
    keys = band_keys(docs, id_col, text_col, width, bands, rows)
    first = keys.groupBy("band", "key").agg(F.min("doc").alias("first"))
    return keys.join(first, ["band", "key"]).groupBy("doc").agg(F.min("first").alias("first"))


def keep_first(docs: DataFrame, id_col: str, text_col: str, width: int = 5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """DUP1, DUP2: the ids that stay."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    exact = docs.groupBy(F.sha2(F.array_join(words(F.lower(text)), " "), 256).alias("same")).agg(F.min(id_col).alias("doc"))
    distinct = docs.join(exact.select(F.col("doc").alias(id_col)), id_col, "left_semi").select(F.col(id_col), F.col(text_col))
    keys = written(band_keys(distinct, id_col, text_col, width, bands, rows), "bands")
    kept = exact.join(keys.select("doc").distinct(), "doc", "left_anti").select("doc")  # no words: nothing to share
    live = keys
    while True:
        first = written(live.groupBy("band", "key").agg(F.min("doc").alias("first")), "firsts")
        met = live.join(first, ["band", "key"])
        now = written(met.groupBy("doc").agg(F.max((F.col("first") != F.col("doc")).cast("int")).alias("later")), "round").where("later = 0").select("doc")
        kept = kept.unionByName(now)
        taken = first.join(now, first["first"] == now["doc"]).select("band", "key", F.lit(True).alias("taken"))
        gone = live.join(taken, ["band", "key"], "left_semi").select("doc").distinct()  # kept ones and their duplicates
        live = written(live.join(gone, "doc", "left_anti"), "undecided")
        if not live.head(1):
            return kept
