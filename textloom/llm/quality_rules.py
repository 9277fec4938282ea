"""Quality rules with host verdicts, in DataFrame functions only.

Every text is measured by itself; a text that breaks a rule has ``base_failed``. Failures are
then summed by host, each host's failure rate is shrunk towards the rate of all hosts by a beta
prior fitted to the hosts themselves (method of moments), and a host is condemned only when its
posterior rate is above ``host_rate`` by ``host_sigmas`` posterior standard deviations. A text
is kept when it passes itself and its host is not condemned.

Cases: a null text counts as the empty one and fails (no words). A null host is never condemned
and takes no part in the prior. Repeated rows are rows of their own. An empty table gives an
empty result. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, quoted, whole_text, written

SPLIT = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"
SALTS = 32


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, even where ``use`` refers to it in a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeats(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more; 0 at once where all windows differ.

    Windows are compared by 64-bit hashes within a text and sorted with their places, so the
    cost is n log n in the longest text.
    """
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda s, a, b: F.get(s, a)["h"] == F.get(s, b)["h"]
        twice = lambda s: F.filter(s, lambda x, k: ((k > 0) & same(s, k - 1, k)) | ((k < F.size(s) - 1) & same(s, k + 1, k)))
        return _bind(placed, lambda s: F.size(F.array_distinct(F.flatten(F.transform(twice(s), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))))

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(
        _bind(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    )


def _words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(WS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPLIT))


def measures(text: Column) -> Column:
    """A struct of the five counts of one text."""
    words = _words(text)
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WS)) != "")
    return _bind(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            _bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeats(w).cast("long").alias("n_repeat_words"),
        ),
    )


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_words: int = 50, repeat_percent: int = 50) -> DataFrame:
    """doc_id, host, the five counts and base_failed of every row."""
    m = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), measures(whole_text(text_col)).alias("m"))
    failed = (F.col("m.n_words") < min_words) | (100 * F.col("m.n_repeat_words") > repeat_percent * F.col("m.n_words"))
    return m.select("doc_id", "host", "m.*", failed.alias("base_failed"))


def condemned_hosts(rows: DataFrame, host_rate: float = 0.5, host_sigmas: float = 2.0) -> DataFrame:
    """Hosts whose shrunken failure rate is surely above ``host_rate``, with their posteriors.

    rows: host, base_failed. The prior: mean m = all failures / all rows; strength k from the
    variance of the hosts' rates less what sampling explains, between 1 and 1000.
    """
    hosts = rows.where(F.col("host").isNotNull()).groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("f"))
    prior = hosts.agg(
        (F.sum("f") / F.sum("n")).alias("m"),
        F.coalesce(F.var_pop(F.col("f") / F.col("n")), F.lit(0.0)).alias("v"),
        F.avg(1 / F.col("n")).alias("r"),
    )
    spread = F.col("v") - F.col("m") * (1 - F.col("m")) * F.col("r")
    prior = prior.select("m", F.least(F.lit(1000.0), F.greatest(F.lit(1.0), F.when(spread > 0, F.col("m") * (1 - F.col("m")) / spread - 1).otherwise(1000.0))).alias("k"))
    a, b = F.col("f") + F.col("m") * F.col("k"), F.col("n") - F.col("f") + (1 - F.col("m")) * F.col("k")
    post = hosts.join(F.broadcast(prior)).select("host", "n", "f", (a / (a + b)).alias("rate"), F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))).alias("sd"))  # prior is one row
    return post.where(F.col("rate") - host_sigmas * F.col("sd") > host_rate)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_words: int = 50, repeat_percent: int = 50, host_rate: float = 0.5, host_sigmas: float = 2.0, broadcast_hosts: int = 100_000) -> DataFrame:
    """The counts, base_failed, host_failed and kept of every row; texts are read once."""
    rows = written(measured(docs, id_col, text_col, host_col, min_words, repeat_percent), "rules")
    bad = written(condemned_hosts(rows, host_rate, host_sigmas).select(F.col("host").alias("bad_host")), "bad-hosts")
    if bad.count() <= broadcast_hosts:
        out = rows.join(F.broadcast(bad), F.col("host") == F.col("bad_host"), "left")  # at most broadcast_hosts names
    else:  # a host of very many rows meets its verdict in SALTS tasks
        salted = bad.withColumn("bad_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
        out = rows.join(salted, (F.col("host") == F.col("bad_host")) & (own == F.col("bad_salt")), "left").drop("bad_salt")
    return out.withColumn("host_failed", F.col("bad_host").isNotNull()).withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed")).drop("bad_host")


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_words: int = 50, repeat_percent: int = 50, host_rate: float = 0.5, host_sigmas: float = 2.0, broadcast_hosts: int = 100_000) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns.

    Every row is decided by its own text and host, whatever its id; only condemned hosts are
    joined. Texts are measured once, and those that pass written beside their host; they are not
    shuffled but where more than ``broadcast_hosts`` hosts are condemned.
    """
    # the user's columns are one, so no name of theirs meets one of ours
    own = docs.select(F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("own"), *(F.col(quoted(c)).alias(n) for c, n in ((text_col, "text"), (host_col, "host"))))
    failed = _bind(_words(whole_text("text")), lambda w: (F.size(w) < min_words) | (100 * _repeats(w) > repeat_percent * F.size(w)))
    rows = written(own.select("host", failed.alias("base_failed"), F.when(~failed, F.col("own")).alias("own")), "rules")
    bad = written(condemned_hosts(rows.select("host", "base_failed"), host_rate, host_sigmas).select(F.col("host").alias("bad_host")), "bad-hosts")
    passed, same = rows.where("NOT base_failed"), F.col("host") == F.col("bad_host")
    if bad.count() <= broadcast_hosts:
        return passed.join(F.broadcast(bad), same, "left_anti").select("own.*")  # at most broadcast_hosts names
    salted = bad.withColumn("bad_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(F.to_json("own")), F.lit(SALTS)).cast("int")
    return passed.join(salted, same & (salt == F.col("bad_salt")), "left_anti").select("own.*")
