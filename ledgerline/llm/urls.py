"""URL filters as a sort-merge range join.

A host is turned into a key of its labels from the last to the first, each
followed by a dot (``www.example.net`` -> ``net.example.www.``), so that a host and all its
subdomains are one interval of the sorted keys, and the rules of a host with
one path prefix are one interval of (host key, NUL, path). Intervals of
prefixes are nested or disjoint: all that contain a point are the interval
that starts last at or before the point, or intervals around that one.

``sweep`` sorts points and interval starts together by range partitioning; each
point takes the last interval start before it (within its partition by a window,
else carried in from the partitions before) with that interval's stack of
enclosing intervals, and the ones the point has left are popped. One sweep
over distinct hosts finds the active host rules, a second over distinct (host, path) pairs
their path rules, so a page, host or URL that occurs very often is swept once, and the
paths of one host spread over many ranges. All of it is DataFrame code.

Defined results: url NULL or without ``://``: host and path empty, no rule fits.
No rule fits: rule NULL, verdict ``default``. Rules with NULL or empty host or NULL
path or verdict fit nothing; repeated (host, path): ``block`` wins over ``allow``.
Rules of equal length: the one with the longer host wins. Both tables may be
empty; repeated pages are judged one by one; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import settle, small, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def host(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(h: Column) -> Column:
    return F.when(h == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(h, r"\.", -1)), "."), F.lit(".")))


def sweep(points: DataFrame, intervals: DataFrame) -> DataFrame:
    """``points``: ``key`` and other columns; ``intervals``: ``stack``, an array of structs
    with a ``key`` (the enclosing intervals from the outermost, itself last).
    Adds ``active`` to the points: the part of a stack whose keys are prefixes of the point's."""
    spark = points.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    starts = intervals.select(F.element_at("stack", -1)["key"].alias("key"), F.lit(0).alias("kind"), "stack")
    rows = points.withColumn("kind", F.lit(1)).unionByName(starts, allowMissingColumns=True)
    rows = settle(rows.repartitionByRange(parts, "key", "kind").withColumn("part", F.spark_partition_id()), "sweep")
    within = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition: a number set in the configuration
    carried = (
        rows.groupBy("part").agg(F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("stack"))
        .select("part", F.last("stack", ignorenulls=True).over(before).alias("carried"))
    )
    swept = rows.withColumn("last", F.last("stack", ignorenulls=True).over(within)).where("kind = 1")
    joined = swept.join(F.broadcast(carried), "part", "left")
    key = F.col("key")
    active = F.filter(F.coalesce("last", "carried"), lambda r: key.startswith(r["key"]))
    return joined.withColumn("active", active).drop("kind", "stack", "last", "carried", "part")


def _stacks(rules: DataFrame, by: Column, prefixes: Column) -> DataFrame:
    """Each interval with its enclosing ones. ``prefixes``: the prefixes of the key that may
    be keys of others; they are found by an equality join, never by comparing all pairs."""
    own = rules.select(F.struct(by.alias("key"), *rules.columns).alias("rule"))
    inner = own.withColumn("at", F.explode(prefixes))
    outer = own.select(F.col("rule.key").alias("at"), F.col("rule").alias("around"))
    return inner.join(outer, "at").groupBy("rule").agg(F.array_sort(F.collect_list("around")).alias("stack")).drop("rule")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``pages``: page_id, url; ``rules``: host, path, verdict. Returns page_id, host, path, rule, verdict."""
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict").where("host <> '' and path is not null and verdict is not null")
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rules = rules.withColumn("host_key", host_key(F.col("host")))
    url = F.col("url")
    parsed = pages.select("page_id", host(url).alias("host"), path(url).alias("path"))
    named = parsed.where("host <> ''")
    distinct = named.select("host", "path").distinct()

    # the labels of a host are at most 127, so a stack of hosts is short
    labels = F.split(F.expr("rule.host_key"), r"\.")
    hosts = _stacks(
        rules.select("host_key").distinct(),
        F.col("host_key"),
        F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda i: F.concat(F.array_join(F.slice(labels, 1, i), "."), F.lit("."))),
    )
    on_host = sweep(named.select("host").distinct().withColumn("key", host_key(F.col("host"))), hosts)
    ruled = settle(on_host.where(F.size("active") > 0).select("host", F.explode("active.key").alias("at")), "ruled-hosts")
    nul = F.lit("\0")
    paths = _stacks(
        rules,
        F.concat("host_key", nul, "path"),
        F.transform(
            F.sequence(F.lit(0), F.length(F.expr("rule.path"))),
            lambda i: F.concat(F.expr("rule.host_key"), nul, F.expr("rule.path").substr(F.lit(1), i)),
        ),
    )
    on_path = sweep(
        distinct.join(small(ruled, ruled.count()), "host").select("host", "path", F.concat("at", nul, "path").alias("key")),
        paths,
    )
    found = on_path.where(F.size("active") > 0).withColumn("r", F.try_element_at("active", F.lit(-1)))
    length = F.struct(F.length("r.host") + F.length("r.path"), F.length("r.host"))
    verdicts = found.groupBy("host", "path").agg(F.max_by("r", length).alias("r")).select(
        "host", "path", F.concat("r.host", "r.path").alias("rule"), F.col("r.verdict").alias("verdict")
    )
    return parsed.join(verdicts, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), spark.createDataFrame(RULES, "host string, path string, verdict string"))


OP9_SQL = r"""
WITH p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages
), rules(h, p, v) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), m AS (
  SELECT p.page_id, p.host, p.path, r.h || r.p AS rule, r.v
  FROM p LEFT JOIN rules r ON (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.p)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM m
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1
"""
