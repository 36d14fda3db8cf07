"""Mixing sources to target weights by systematic sampling.

The size of a document is its number of words. Sources in code-point order
(NULL last) get the weights 5, 2, 1, repeating, and share ``share`` times all
words; a source's target stops at ``cap`` times its own words and the excess is
shared again by weight until no target is above (water filling, in closed form
over the sources sorted by cap / weight).

Every document of a source then expects rate = target / source words copies.
Documents are ordered by (size, id, hash of the text, hash of the other columns) within their source; the
r-th document is copied once for every integer between (r - 1) * rate + u and
r * rate + u, u a fixed offset in [0, 1) drawn from the hash of the source. As
the order is by size, each run of documents of like size is sampled at the same
rate and the words taken stay close to the target.

The rank of a document in its source is a distributed prefix sum: rows are
range-partitioned by (source, order), written, counted per partition and
source, and each partition adds the counts before it; a source holding most
rows spreads over many partitions.

Defined results: NULL or empty text has size 0 and may be "copied" like any
document; a source without words has rate 0 and target 0; repeated rows are
separate documents; the table may be empty; other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import free_names, n_words, settle, small, table

WEIGHTS = (5, 2, 1)


def targets(sizes: DataFrame, share: float, cap: float, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sizes``: source, source_size (one row per source, so the unpartitioned windows
    run over as many rows as there are sources). Adds ``target``."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    i = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), i.cast("int") + 1)
    s = sizes.withColumn("w", weight).withColumn("c", F.col("source_size") * F.lit(float(cap)))
    fill = Window.orderBy(F.col("c") / F.col("w"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    s = (
        s.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("full", F.coalesce(F.sum("c").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("w").over(rest))
        # the level if this and all later sources stay below their caps
        .withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
        .withColumn("fits", F.col("level") * F.col("w") <= F.col("c"))
    )
    s = s.withColumn("level", F.min(F.when(F.col("fits"), F.struct(F.col("c") / F.col("w"), F.col("open") * -1, "level"))).over(everything)["level"])
    return s.select("source", "source_size", F.when(F.col("level").isNull(), F.col("c")).otherwise(F.least("c", F.col("level") * F.col("w"))).alias("target"))


def offset(source: Column) -> Column:
    """A fixed offset in [0, 1) for each source: 28 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(F.concat(F.lit("s:"), source), F.lit("null")).cast("binary")), 1, 7), 16, 10).cast("double") / F.lit(float(1 << 28))


def row_hash(docs: DataFrame, text: str) -> Column:
    """Hash of the columns other than doc_id and text; NULL counts as a value."""
    rest = [F.col(c) for c in docs.columns if c not in ("doc_id", text)]
    return F.xxhash64(*[x for c in rest for x in (c.isNull(), c)])


def mix(docs: DataFrame, share: float = 1.5, cap: float = 2.0, text: str = "text") -> DataFrame:
    """One row per document: doc_id, text_hash, source, size, source_size, target, copies."""
    return _mix(docs, share, cap, text).drop("row_hash")


def _mix(docs: DataFrame, share: float, cap: float, text: str) -> DataFrame:
    """``mix`` with ``row_hash``, which tells rows of one id and text apart."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col("source").alias("source"), n_words(text).alias("size"), F.xxhash64(text).alias("text_hash"), row_hash(docs, text).alias("row_hash"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id"), F.col("text_hash"), F.col("row_hash")]
    ranged = settle(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "mix")
    counts = ranged.groupBy("source", "part").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    counts = settle(counts, "mix-counts")
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("source", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    goal = targets(counts.groupBy("source").agg(F.sum("words").alias("source_size")), share, cap)
    ahead = ahead.alias("a").join(goal.alias("g"), F.col("a.source").eqNullSafe(F.col("g.source"))).select("a.source", "part", "ahead", "source_size", "target")
    within = Window.partitionBy("part", "source").orderBy("size", "doc_id", "text_hash", "row_hash")
    ranked = ranged.withColumn("r", F.row_number().over(within))
    full = ranked.alias("r").join(
        ahead.alias("a"), F.col("r.source").eqNullSafe(F.col("a.source")) & (F.col("r.part") == F.col("a.part"))
    )
    # copies by integers crossed; a rate at the cap is that integer, so it is exact for any rank
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(cap)))).otherwise(F.lit(0.0))
    rank = F.col("ahead") + F.col("r")
    u = offset(F.col("r.source"))
    copies = F.floor(rank * rate + u) - F.floor((rank - 1) * rate + u)
    copies = F.greatest(F.lit(0), F.least(copies, F.lit(int(cap))))
    return full.select("doc_id", "text_hash", "row_hash", F.col("r.source").alias("source"), "size", "source_size", "target", copies.cast("long").alias("copies"))


def emit(docs: DataFrame, share: float = 1.5, cap: float = 2.0, text: str = "text") -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken (0 to ``cap`` times)."""
    taken = _mix(docs, share, cap, text).groupBy("doc_id", "text_hash", "row_hash").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    taken = settle(taken, "taken")
    i, k, o, c, n, h, r = free_names(docs, "id", "key", "other", "copies", "nth", "hash", "rest")
    rows = docs.withColumn(h, F.xxhash64(text)).withColumn(r, row_hash(docs, text))

    def copied(part: DataFrame, of: DataFrame) -> DataFrame:
        part = part.where("copies > 0").select(F.col("doc_id").alias(i), F.col("text_hash").alias(k), F.col("row_hash").alias(o), F.col("copies").alias(c))
        part = small(part, part.count())
        same = F.col("doc_id").eqNullSafe(F.col(i)) & (F.col(h) == F.col(k)) & (F.col(r) == F.col(o))
        met = of.join(part, same).withColumn(n, F.explode(F.sequence(F.lit(1), F.col(c))))
        return met.select(*(F.col(f"`{x}`") for x in docs.columns))

    # rows equal in every column are brought together and emitted as often as all of them are taken
    return copied(taken.where("rows = 1"), rows).unionByName(copied(taken.where("rows > 1"), rows.dropDuplicates(["doc_id", h, r])))


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return m.select("doc_id", "size", F.col("source_size").cast("long"), "target", (F.col("copies") * F.col("size")).alias("taken"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size, text
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CAST([5, 2, 1][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER)] AS DOUBLE) AS w,
         source_size * 2.0::DOUBLE AS c, CAST(sum(source_size) OVER () AS BIGINT) * 1.5::DOUBLE AS total
  FROM s
), f AS (
  SELECT *, (total - coalesce(sum(c) OVER (ORDER BY c / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY c / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER (ORDER BY c / w, source NULLS LAST) AS i
  FROM w
), l AS (
  SELECT (SELECT level FROM f WHERE level * w <= c ORDER BY i LIMIT 1) AS level
), t AS (
  SELECT source, source_size, CASE WHEN l.level IS NULL THEN c ELSE least(c, l.level * w) END AS target,
         ('0x' || substr(md5(coalesce('s:' || source, 'null')), 1, 7))::BIGINT / 268435456.0::DOUBLE AS u
  FROM f, l
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.u,
         CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 2.0::DOUBLE) ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS r
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(greatest(0, least(2, floor(r * rate + u) - floor((r - 1) * rate + u))) AS BIGINT) * size AS taken
FROM r
"""
