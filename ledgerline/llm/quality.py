"""Quality rules per document, and verdicts on their hosts from the rules' failures.

Per document, on the whole text (words are runs of non-white-space): number of
words, code points in words, symbols ``[#*$%&|<>]``, lines with a word that equal an earlier
line, and words that lie in an 8-word window found twice or more in the text.
A document fails the base rules with fewer than 20 words, or if more than
30 % of its words lie in repeated windows.

Host level: the source is the host. Failures are counted per host; the rates
are shrunk towards the rate of all documents with a beta prior whose strength
is fitted to the spread of the hosts' rates beyond the chance of their document counts, so a small host
is not judged by a few documents. A host whose shrunk rate is over
``HOST_LIMIT`` is rejected with all its documents. All of it is DataFrame code;
the metrics are computed once, in one pass without a shuffle, and written, and
only counts per host are shuffled.

Repeated windows are found by 64-bit hashes within one text. Defined results:
NULL or empty text has no words and fails; NULL source is a host of its own;
repeated rows count each; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import SPACES, WORD, let, settle, table

WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
HOST_LIMIT = 0.5


def repeat_words(words: Column, size: int = WINDOW) -> Column:
    """Words covered by windows of ``size`` words that occur twice or more."""

    def covered(order: Column) -> Column:
        # order: (hash, position) sorted by hash, so equal windows are neighbours
        again = F.transform(
            order,
            lambda x, j: F.when((F.get(order, j - 1)["h"] == x["h"]) | (F.get(order, j + 1)["h"] == x["h"]), x["i"]),
        )
        at = F.array_sort(F.filter(again, lambda i: i.isNotNull()))
        start = F.struct(F.lit(0).alias("n"), F.lit(-size).alias("last"))
        return F.aggregate(
            at, start, lambda a, i: F.struct((a["n"] + F.least(F.lit(size), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"]
        )

    def count(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(pairs, covered))

    def windows(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)), lambda i: F.xxhash64(F.slice(w, i, size)))
        return F.when(F.size(w) <= size, F.lit(0)).otherwise(let(hashes, count))

    return windows(words)


def dup_lines(text: Column) -> Column:
    def count(lines: Column) -> Column:
        return F.size(lines) - F.size(F.array_distinct(lines))

    return let(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), count)


def metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, source and the base metrics of every row."""
    t = F.coalesce(F.col(text), F.lit(""))
    by_words = let(
        F.regexp_extract_all(t, F.lit(WORD), F.lit(0)),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).cast("long").alias("n_repeat_words")),
    )
    return docs.select(
        "doc_id",
        "source",
        by_words.alias("w"),
        F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        dup_lines(t).cast("long").alias("n_dup_lines"),
    ).select("doc_id", "source", "w.n_words", "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words")


def prior_strength(hosts: int, n: int, failed: int, squares: float, ratios: float) -> float:
    """alpha + beta of the beta prior of the hosts' failure rates: 1 / rho - 1, rho the correlation of two documents
    of one host, from the analysis of variance between and within hosts. Infinite where the rates differ by no more
    than chance (one-document hosts show nothing else). ``squares``: sum of n * n, ``ratios``: of failed * failed / n."""
    if hosts < 2 or n <= hosts:
        return math.inf
    between = (ratios - failed * failed / n) / (hosts - 1)
    within = (failed - ratios) / (n - hosts)
    size = (n - squares / n) / (hosts - 1)
    if between <= within:
        return math.inf
    rho = (between - within) / (between + (size - 1) * within)
    return 1 / rho - 1


def host_rates(judged: DataFrame) -> DataFrame:
    """source, n, failed, and the shrunk failure rate."""
    hosts = judged.groupBy("source").agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    f, n = F.col("failed"), F.col("n")
    total = hosts.agg(
        F.count("*").alias("hosts"), F.sum(n).alias("n"), F.sum(f).alias("failed"),
        F.sum(n.cast("double") * n).alias("squares"), F.sum(f.cast("double") * f / n).alias("ratios"),
    ).first()
    if not total["n"]:
        return hosts.withColumn("rate", F.lit(None).cast("double"))
    mean, strength = total["failed"] / total["n"], prior_strength(*total)
    if math.isinf(strength):
        return hosts.withColumn("rate", F.lit(mean))
    return hosts.withColumn("rate", (f + F.lit(mean * strength)) / (n + F.lit(strength)))


def judge(docs: DataFrame, text: str = "text", host_limit: float = HOST_LIMIT) -> DataFrame:
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    judged = settle(metrics(docs, text).withColumn("base_failed", failed), "quality")
    bad = host_rates(judged).where(F.col("rate") > host_limit).select("source", F.lit(True).alias("bad_host"))
    joined = judged.alias("d").join(bad.alias("b"), F.col("d.source").eqNullSafe(F.col("b.source")), "left")
    return joined.select("d.*", (~F.col("base_failed") & F.col("bad_host").isNull()).alias("kept"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("source")


OP10_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), g AS (
  SELECT k, i, list_aggregate(w[i : i + 7], 'string_agg', chr(10)) AS g
  FROM (SELECT k, w, unnest(range(1, greatest(1, len(w) - 6))) AS i FROM d)
), twice AS (
  SELECT k, i FROM g QUALIFY count(*) OVER (PARTITION BY k, g) > 1
), cover AS (
  SELECT k, sum(least(8, i - coalesce(p, i - 8))) AS n
  FROM (SELECT k, i, lag(i) OVER (PARTITION BY k ORDER BY i) AS p FROM twice) GROUP BY k
), m AS (
  SELECT d.doc_id, d.source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
              - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN cover c USING (k)
), j AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
), x AS (
  SELECT source, CAST(CAST(base_failed AS INTEGER) AS DOUBLE) AS y,
         avg(CAST(base_failed AS INTEGER)) OVER (PARTITION BY source) AS host_mean, avg(CAST(base_failed AS INTEGER)) OVER () AS mean,
         count(*) OVER (PARTITION BY source) AS n
  FROM j
), v AS (
  SELECT any_value(mean) AS mean, count(*) AS total, sum(1.0 / n) AS hosts,
         sum((host_mean - mean) * (host_mean - mean)) AS between_squares, sum((y - host_mean) * (y - host_mean)) AS within_squares, avg(n) AS weighted
  FROM x
), u AS (
  SELECT mean, (total - weighted) / (round(hosts) - 1) AS size, between_squares / (round(hosts) - 1) AS b, within_squares / (total - round(hosts)) AS w,
         round(hosts) > 1 AND total > round(hosts) AS known
  FROM v
), p AS (
  SELECT mean, CASE WHEN known AND b > w THEN (b + (size - 1) * w) / (b - w) - 1 END AS strength FROM u
), r AS (
  SELECT source, any_value(CASE WHEN strength IS NULL THEN p.mean ELSE (n * host_mean + p.mean * strength) / (n + strength) END) AS rate
  FROM x, p GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rate <= 0.5 AS kept
FROM j JOIN r ON j.source IS NOT DISTINCT FROM r.source
"""
