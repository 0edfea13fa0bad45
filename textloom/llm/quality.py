"""Quality rules with host verdicts, in DataFrame functions only.

Each document is measured and tested against the rules. Failures are then counted per host, a
host's failure rate is drawn towards the rate of all hosts by a beta prior that is fitted to the
hosts themselves, and a host whose drawn rate is too high loses all its documents. A small host
is thus judged mostly by the prior, a large one by its own documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import SPACE, apart, stored, words

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

#: Base rules: fewer words than this fail, and more than this share of repeated words, in percent.
MIN_WORDS = 50
MAX_REPEATED = 50
#: Further rules, which count for the host only: shares of the words in percent.
MAX_SYMBOLS = 10
MAX_DUP_LINES = 30
#: A host is rejected when its drawn failure rate is above this.
MAX_HOST_RATE = 0.5
#: A host table of at most this many rows is sent to every task; a larger one is joined by hash.
BROADCAST_HOSTS = 100_000


@apart
def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines (all long).

    Null and empty texts count nothing. Columns of `docs` with these names are replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumns({
        "_w": words(F.col(text)),
        "_l": F.filter(F.split(body, "\n"), lambda x: F.length(F.ltrim(F.translate(x, SPACE[1:], " " * 5))) > 0),
        "word_chars": F.length(F.translate(body, SPACE, "")).cast("bigint"),
        "n_symbols": (F.length(body) - F.length(F.translate(body, "#*$%&|<>", ""))).cast("bigint"),
    })
    w = F.col("_w")
    out = out.withColumns({
        "n_words": F.size("_w").cast("bigint"),
        "n_lines": F.size("_l").cast("bigint"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint"),
        "_h": F.when(F.size("_w") >= 3, F.transform(
            F.slice(w, 1, F.greatest(F.size("_w") - 2, F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))).otherwise(F.array().cast("array<bigint>")),
    }).drop("_l")
    out = out.withColumn("_p", F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        F.sort_array(F.transform("_h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))).otherwise(
            F.array().cast("array<struct<x:bigint,i:int>>"))).drop("_w", "_h")
    p = F.col("_p")
    out = out.withColumn("_i", F.sort_array(F.transform(
        F.filter(p, lambda a, j: F.coalesce(a["x"] == F.get(p, j - 1)["x"], F.lit(False))
                 | F.coalesce(a["x"] == F.get(p, j + 1)["x"], F.lit(False))), lambda a: a["i"]))).drop("_p")
    i = F.col("_i")
    covered = F.transform(i, lambda a, j: F.least(F.lit(3), F.coalesce(F.get(i, j + 1) - a, F.lit(3))))
    out = out.withColumn("n_repeat_words", F.aggregate(covered, F.lit(0).cast("bigint"), lambda s, x: s + x)).drop("_i")
    # A filter on a measure would be pushed below all this, and each step computed in it many times over;
    # it does not pass a generator.
    out = out.withColumn("_m", F.explode(F.array(F.struct(*MEASURES)))).drop(*MEASURES)
    return out.withColumns({c: F.col(f"_m.{c}") for c in MEASURES}).drop("_m")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def rule_failed() -> Column:
    """A base rule or one of the further rules fails."""
    return (base_failed() | (100 * F.col("n_symbols") > MAX_SYMBOLS * F.col("word_chars"))
            | (100 * F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines")))


def host_verdicts(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """One row per host: host, host_docs, host_failures, host_rate, host_rejected.

    The prior is beta(a, b) with the mean and variance of the hosts' raw rates (method of
    moments); host_rate is (failures + a) / (docs + a + b). Without spread between the hosts, or
    with fewer than two, the prior weighs as much as all documents of the mean host. A null host
    is a host of its own. The table is written to the shared folder; only the prior, one row,
    passes through the driver.
    """
    counts = stored(measured(docs.select(F.col(host).alias("host"), F.col(text).alias("_text")), "_text")
                    .groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"),
                                         F.sum(rule_failed().cast("bigint")).alias("host_failures")), "hosts")
    rate = F.col("host_failures") / F.col("host_docs")
    m, v, size = counts.agg(F.avg(rate), F.var_samp(rate), F.avg("host_docs")).first()
    m, size = m or 0.0, size or 1.0
    weight = m * (1 - m) / v - 1 if v and 0 < m < 1 else size
    weight = weight if weight > 0 else size
    drawn = (F.col("host_failures") + F.lit(m * weight)) / (F.col("host_docs") + F.lit(weight))
    return counts.withColumn("host_rate", drawn).withColumn("host_rejected", F.col("host_rate") > MAX_HOST_RATE)


@apart
def judge(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """All rows of `docs` with their measures, base_failed, host_rate and kept.

    kept is false for rows that fail a base rule and for all rows of a rejected host. Rows are
    neither lost nor added: repeated ids stay apart, null texts fail (no words), and an empty
    table gives an empty result. Columns of `docs` named like a result are replaced.
    """
    verdicts = host_verdicts(docs, host, text).select(
        F.col("host").alias("_host"), F.col("host_rate").alias("_rate"), F.col("host_rejected").alias("_rejected"))
    if verdicts.count() <= BROADCAST_HOSTS:
        verdicts = F.broadcast(verdicts)
    out = measured(docs, text).withColumn("base_failed", base_failed())
    out = out.join(verdicts, F.col(host).eqNullSafe(F.col("_host")), "left")
    return out.withColumns({"host_rate": F.col("_rate"), "kept": ~F.col("base_failed") & ~F.col("_rejected")}).drop(
        "_host", "_rate", "_rejected")
