"""Quality rules with host verdicts, by DataFrame expressions only.

Each document gets counts of words, symbols, repeated lines and repeated word windows; each rule gives a failure. The
failures are summed by host, each host's rate is shrunk with a beta prior that is fitted to all hosts (by moments), and
the hosts' verdicts are joined back: a document of a bad host must also pass the stricter limits; one that is clean by
those stays, whatever its host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SPACES = "[ \\t\\n\\x0B\\f\\r]+"
#: Limits: of the base rules, and the stricter ones for documents of bad hosts.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
STRICT = {"repeat_percent": 25, "symbols_percent": 30, "dup_lines_percent": 30, "mean_chars_low": 2, "mean_chars_high": 25}
#: A host is bad if its shrunk failure rate is above this.
BAD_HOST_RATE = 0.3


def measures(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """The given rows with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words as struct ``_m``.

    Null texts have no words. Repeated rows are measured one by one. A window's identity is its 64-bit hash.
    """
    t = F.coalesce(F.col("text") if text is None else text, F.lit(""))
    words = F.filter(F.split(t, SPACES), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\f\r", "")) > 0)
    one = (
        docs.withColumn("_w", words)
        .withColumn("_l", lines)
        .withColumn("_n", F.size("_w"))
        # the hash of each window and where it starts; equal hashes stand side by side once sorted
        .withColumn(
            "_s",
            F.when(
                F.col("_n") >= 3,
                F.sort_array(F.transform(F.slice(F.col("_w"), 1, F.greatest(F.col("_n") - 2, F.lit(0))), lambda x, i: F.struct(F.xxhash64(x, F.get(F.col("_w"), i + 1), F.get(F.col("_w"), i + 2)).alias("h"), i.alias("i")))),
            ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
        )
    )
    near = lambda x, j: F.coalesce(F.get(F.col("_s"), j)["h"] == x["h"], F.lit(False))
    one = one.withColumn("_p", F.sort_array(F.transform(F.filter(F.col("_s"), lambda x, j: near(x, j - 1) | near(x, j + 1)), lambda x: x["i"])))
    covered = F.aggregate(
        F.transform(F.col("_p"), lambda p, j: F.least(F.lit(3), F.coalesce(F.get(F.col("_p"), j + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x
    )
    bare = F.translate(t, " \t\n\x0b\f\r", "")
    return one.withColumn(
        "_m",
        F.struct(
            F.col("_n").cast("long").alias("n_words"),
            F.length(bare).cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
            F.size("_l").cast("long").alias("n_lines"),
            (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
            covered.cast("long").alias("n_repeat_words"),
        ),
    ).drop("_w", "_l", "_n", "_s", "_p")


def failures(m: str = "_m") -> dict[str, Column]:
    c = lambda n: F.col(f"{m}.{n}")
    return {
        "short": c("n_words") < MIN_WORDS,
        "repeats": 100 * c("n_repeat_words") > MAX_REPEAT_PERCENT * c("n_words"),
        "strict_repeats": 100 * c("n_repeat_words") > STRICT["repeat_percent"] * c("n_words"),
        "symbols": 100 * c("n_symbols") > STRICT["symbols_percent"] * c("n_words"),
        "dup_lines": 100 * c("n_dup_lines") > STRICT["dup_lines_percent"] * c("n_lines"),
        "word_length": (c("word_chars") < STRICT["mean_chars_low"] * c("n_words")) | (c("word_chars") > STRICT["mean_chars_high"] * c("n_words")),
    }


def host_verdicts(measured: DataFrame, host: str = "_host") -> DataFrame:
    """host, n_docs, a failure count for each rule, the shrunk rate and ``bad_host``, from rows with ``_m``.

    The prior is Beta(a, b) with the mean and the spread (over hosts, weighted by documents) of the failure rates.
    Sums are combined before the shuffle, so a host with a third of all rows costs no more than another.
    """
    rules = failures()
    base = rules["short"] | rules["repeats"]
    fails = base | rules["symbols"] | rules["dup_lines"] | rules["word_length"]
    hosts = measured.groupBy(host).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(fails.cast("long")).alias("n_failed"),
        *[F.sum(c.cast("long")).alias(f"n_{k}") for k, c in rules.items()],
    )
    rate = F.col("n_failed") / F.col("n_docs")
    s = hosts.agg(
        F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"), F.sum(F.col("n_docs") * rate * rate).alias("q"), F.sum(F.lit(1.0) / F.col("n_docs")).alias("inv"), F.count(F.lit(1)).alias("hosts")
    ).first()
    a, b = beta_prior(s["n"] or 0, s["f"] or 0, s["q"] or 0.0, s["hosts"] or 0)
    shrunk = (F.col("n_failed") + F.lit(a)) / (F.col("n_docs") + F.lit(a + b))
    return hosts.withColumn("shrunk_rate", shrunk).withColumn("bad_host", F.col("shrunk_rate") > F.lit(BAD_HOST_RATE))


def beta_prior(n: int, failed: int, squares: float, hosts: int) -> tuple[float, float]:
    """Beta(a, b) by moments from the documents, the failures, sum of documents * rate^2, and the hosts.

    The spread of observed rates also holds their sampling noise; the rest is the spread between hosts. With one host
    or no such spread, the prior counts as 1,000 documents, so hosts are all but equal.
    """
    if not n:
        return 1.0, 1.0
    m = min(max(failed / n, 1e-6), 1 - 1e-6)
    spread = squares / n - m * m - m * (1 - m) * hosts / n
    weight = min(max(m * (1 - m) / spread - 1, 2.0), 1000.0) if spread > 0 and hosts > 1 else 1000.0
    return m * weight, (1 - m) * weight


def judged(measured: DataFrame, host: str = "_host") -> DataFrame:
    """The given rows with base_failed, bad_host and kept. Spark broadcasts the hosts only if they turn out small."""
    rules = failures()
    base = rules["short"] | rules["repeats"]
    strict = rules["strict_repeats"] | rules["symbols"] | rules["dup_lines"] | rules["word_length"]
    bad = host_verdicts(measured, host).where("bad_host").select(F.col(host).alias("_bad"), F.lit(True).alias("_bad_host"))
    joined = measured.join(bad, F.col(host) == F.col("_bad"), "left")
    bad_host = F.coalesce("_bad_host", F.lit(False))
    return joined.withColumn("_base_failed", base).withColumn("_kept", ~base & ~(bad_host & strict)).withColumn("_bad_host", bad_host).drop("_bad")


def quality_rules(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row for each document: its counts, ``base_failed`` and ``kept``.

    Null or empty text: no words, base_failed. Null host: a host of its own. Repeated rows: judged alike, one row each.
    Other columns are ignored, whatever their names; an empty table gives none.
    """
    hosted = F.coalesce(F.col(host).cast("string"), F.lit("")) if host in docs.columns else F.lit("")
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), hosted.alias("_host"))
    slim = common.written(measures(rows).select("doc_id", "_host", "_m"), common.shared_dir(docs.sparkSession))
    return judged(slim).select("doc_id", "_m.n_words", "_m.word_chars", "_m.n_symbols", "_m.n_dup_lines", "_m.n_repeat_words", F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"), F.col("_bad_host").alias("bad_host"))


def passing(docs: DataFrame, host: str = "source") -> DataFrame:
    """The documents that pass, with their columns as they were, whatever their names.

    Null or empty text fails; a null host is a host of its own; repeated rows pass or fail alike; an empty table gives
    none. Measures and verdicts are of slim rows; the documents themselves only meet those that fail, by id, host and
    a 64-bit hash of the text.
    """
    hosted = F.coalesce(F.col(host).cast("string"), F.lit("")) if host in docs.columns else F.lit("")
    text = F.col("text").cast("string")
    key = (F.col("doc_id").cast("string"), hosted, F.xxhash64(text))
    slim = docs.select(F.struct(*key).alias("_key"), hosted.alias("_host"), text.alias("text"))
    slim = common.written(measures(slim).select("_key", "_host", "_m"), common.shared_dir(docs.sparkSession))
    failed = judged(slim).where("not _kept").select(F.coalesce("_key.col1", F.lit("")).alias("_f1"), F.col("_key.col2").alias("_f2"), F.col("_key.col3").alias("_f3")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_d"), F.coalesce(key[0], F.lit("")).alias("_k1"), key[1].alias("_k2"), key[2].alias("_k3"))
    return rows.join(failed, (F.col("_k1") == F.col("_f1")) & (F.col("_k2") == F.col("_f2")) & (F.col("_k3") == F.col("_f3")), "left_anti").select("_d.*")
