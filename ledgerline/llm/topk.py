"""Exact top-k search by integer inner product, with distributed histogram selection.

Queries and candidates are cut into blocks and every (query block, candidate
block) cell scores all its pairs. No score is stored or shuffled: a round
histograms each query's scores over equal buckets of its current score range,
Spark sums the histograms, and the range shrinks to the bucket that holds the
k-th best value. When a range is one value wide, that value is the threshold;
a last scoring round filters by it and ties are broken by the smaller id.

A cell reports only the buckets at or above its own k-th best score (the
global k-th value cannot lie below), and of the final hits at most its own
first k in (score descending, id ascending) order, so a vector that occurs
very often costs k rows per cell and query, not one row per copy.

Defined results: vectors that are NULL, empty, or hold NULL or non-finite
components take no part, as query or candidate; a pair with different
dimensions is not scored; a query never matches the row with its own id (nor
other rows that repeat its id); fewer than k candidates give fewer rows; rows
repeating a query id are one query (the first vector in array order); an empty
table gives an empty result. Scores of 2**62 or more saturate there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import settle, table

QUERY_BLOCK = 512
CANDIDATE_BLOCK = 8192
BUCKETS = 4096
_MAX = (1 << 62) - 1


def quantise(vector: str, scale: int = 256):
    """floor(scale * x) of every component (x as double), or NULL if the vector takes no part."""
    v = F.col(vector)
    usable = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return F.when(usable, F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))))


def _matrix(blobs: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype="<i8").reshape(len(blobs), dim)


def _largest(m: np.ndarray) -> int:
    return max(int(m.max()), -int(m.min()))


def _scores(q: np.ndarray, c: np.ndarray, c_float: np.ndarray, c_top: int) -> np.ndarray:
    """Exact integer inner products: float64 while every sum stays below 2**53, 64-bit
    integers while they cannot overflow, Python integers (saturated) beyond."""
    bound = _largest(q) * c_top * q.shape[1]
    if bound < 1 << 53:
        return (q.astype(np.float64) @ c_float.T).astype(np.int64)
    if bound <= _MAX:
        return q @ c.T
    return np.clip(q.astype(object) @ c.astype(object).T, -_MAX, _MAX).astype(np.int64)


def _cells(left: pa.Table, right: pa.Table):
    """Score strips of one cell: (query rows, candidate ids, score matrix)."""
    if not left.num_rows or not right.num_rows:
        return
    lq, ld = left.column("vector").to_pylist(), left.column("dim").to_numpy()
    cv, cd, ci = right.column("vector").to_pylist(), right.column("dim").to_numpy(), right.column("id").to_numpy()
    qi = left.column("id").to_numpy()
    for dim in np.unique(ld):
        rows, cols = np.flatnonzero(ld == dim), np.flatnonzero(cd == dim)
        if not len(cols):
            continue
        c = _matrix([cv[j] for j in cols], int(dim))
        c_float, c_top = c.astype(np.float64), _largest(c)
        for at in range(0, len(rows), 64):
            part = rows[at : at + 64]
            s = _scores(_matrix([lq[i] for i in part], int(dim)), c, c_float, c_top)
            yield part, ci[cols], s, qi[part][:, None] != ci[cols][None, :]


def _histogram(k: int, buckets: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, bucket, count = [], [], []
        lo, width, span = (left.column(c).to_numpy() for c in ("lo", "width", "span"))
        above = left.column("above").to_numpy()
        qid = left.column("id").to_numpy()
        for part, _, s, other in _cells(left, right):
            for r, i in enumerate(part):
                x = s[r][other[r]]
                d = (x[x >= lo[i]] - lo[i]).view(np.uint64)  # a difference may take 64 bits
                h = np.bincount((d[d < np.uint64(span[i])] // np.uint64(width[i])).astype(np.int64), minlength=buckets)
                full = np.flatnonzero(h)[::-1]
                need = int(k - above[i])
                full = full[: int(np.searchsorted(np.cumsum(h[full]), need)) + 1]
                ids += [int(qid[i])] * len(full)
                bucket += full.tolist()
                count += h[full].tolist()
        return pa.table({"id": pa.array(ids, pa.int64()), "bucket": pa.array(bucket, pa.int32()), "n": pa.array(count, pa.int64())})

    return run


def _hits(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], []]
        lo, qid = left.column("lo").to_numpy(), left.column("id").to_numpy()
        for part, ids, s, other in _cells(left, right):
            for r, i in enumerate(part):
                at = np.flatnonzero(other[r] & (s[r] >= lo[i]))
                if len(at) > k:
                    at = at[np.lexsort((ids[at], -s[r][at]))[:k]]
                out[0] += [int(qid[i])] * len(at)
                out[1] += ids[at].tolist()
                out[2] += s[r][at].tolist()
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.int64())})

    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int, buckets: int = BUCKETS) -> DataFrame:
    """Both frames: ``id`` long, ``vector`` array<long>. Returns query_id, rank, vec_id, score."""
    spark = candidates.sparkSession
    pack = F.unhex(F.array_join(F.transform("vector", lambda x: _little_endian(x)), ""))
    shape = [F.col("id"), F.size("vector").alias("dim"), pack.alias("vector")]
    usable = F.col("id").isNotNull() & (F.size("vector") > 0)
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    q = settle(queries.where(usable).groupBy("id").agg(F.min("vector").alias("vector")).select(*shape, norm.alias("norm")), "topk-q")
    c = settle(candidates.where(usable).select(*shape, norm.alias("norm")), "topk-c")
    # |score| <= sqrt(norm of the query * largest norm): the first range of every query
    top = c.agg(F.count("*").alias("n"), F.coalesce(F.max("norm"), F.lit(0.0)).alias("norm")).first()
    n_q = q.count()
    q_blocks, c_blocks = max(1, -(-n_q // QUERY_BLOCK)), max(1, -(-top["n"] // CANDIDATE_BLOCK))
    # blocks by hash of the whole row, so that a repeated id is spread as well
    c_side = (
        c.withColumn("c_block", F.pmod(F.xxhash64("id", "vector", F.monotonically_increasing_id()), F.lit(c_blocks)).cast("int"))
        .withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    )
    q_keyed = q.withColumn("q_block", F.pmod(F.xxhash64("id"), F.lit(q_blocks)).cast("int"))
    half = F.least(F.floor(F.sqrt(F.col("norm") * F.lit(top["norm"])) * F.lit(1.0000001)) + 1, F.lit(_MAX)).cast("long")
    state = settle(
        q_keyed.select(
            "id", "dim", "vector", "q_block",
            (-half).alias("lo"),
            (F.floor(2 * half.cast("double") / buckets) + 2).cast("long").alias("width"),
            F.lit((1 << 63) - 1).alias("span"),  # the scores counted: [lo, lo + span)
            F.lit(0).cast("long").alias("above"),
            F.lit(False).alias("all"),
        ),
        "topk-state",
    )

    def cells(side: DataFrame, run, schema: str) -> DataFrame:
        spread = side.withColumn("c_block", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))))
        return spread.groupBy("q_block", "c_block").cogroup(c_side.groupBy("q_block", "c_block")).applyInArrow(run, schema)

    done = []
    while True:
        counts = cells(state, _histogram(k, buckets), "id long, bucket int, n long").groupBy("id", "bucket").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("id").orderBy(F.desc("bucket"))
        ranked = counts.withColumn("upto", F.sum("n").over(down)).join(state.select("id", "above"), "id")
        found = ranked.where(F.col("upto") + F.col("above") >= k).groupBy("id").agg(
            F.max_by(F.struct("bucket", "n", "upto"), "bucket").alias("at")
        )
        after = state.join(found, "id", "left").select(
            "id", "dim", "vector", "q_block",
            # fewer than k scores in all: everything at or above the first bound counts
            F.when(F.col("at").isNull(), F.col("lo")).otherwise(F.col("lo") + F.col("at.bucket") * F.col("width")).alias("lo"),
            F.when(F.col("at").isNull() | (F.col("width") == 1), F.lit(0)).otherwise(
                F.floor((F.col("width") - 1) / F.lit(buckets)) + 1
            ).cast("long").alias("width"),
            F.col("width").alias("span"),
            F.when(F.col("at").isNull(), F.col("above")).otherwise(F.col("above") + F.col("at.upto") - F.col("at.n")).alias("above"),
        )
        after = settle(after, "topk-state")
        done.append(after.where("width = 0"))
        state = after.where("width > 0")
        if state.isEmpty():
            break
    bounds = done[0]
    for part in done[1:]:
        bounds = bounds.unionByName(part)
    hits = cells(bounds, _hits(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    )


def _little_endian(x):
    """16 hex digits of a long, least significant byte first."""
    h = F.lpad(F.hex(x), 16, "0")
    return F.concat(*[F.substring(h, 2 * i + 1, 2) for i in reversed(range(8))])


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), quantise("embedding").alias("vector"))
    vectors = vectors.where(F.col("vector").isNotNull())
    return top_k(vectors.where(F.col("id") % 50 == 0), vectors, k=5)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s
QUALIFY rank <= 5
"""
