import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import topk

SCHEMA = "id long, vector array<long>"


def brute(queries, candidates, k):
    out = []
    for q, v in queries:
        scored = sorted((-int(np.dot(np.array(v, object), np.array(w, object))), c) for c, w in candidates if c != q and len(w) == len(v))
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, queries, candidates, k, **kw):
    got = topk.top_k(spark.createDataFrame(queries, SCHEMA), spark.createDataFrame(candidates, SCHEMA), k, **kw)
    return sorted(tuple(r) for r in got.collect())


def test_matches_brute_force_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 40)
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-20, 20, 6).tolist()) for i in range(200)]
    queries = rows[::9]
    assert run(spark, queries, rows, 5, buckets=8) == brute(queries, rows, 5)


def test_hot_vector_ties_go_to_smaller_ids(spark):
    rows = [(i, [1, 2]) for i in range(300)] + [(1000, [3, 3]), (1001, [-3, 0])]
    queries = [(0, [1, 2]), (1000, [3, 3])]
    assert run(spark, queries, rows, 3) == brute(queries, rows, 3)


def test_large_components_are_exact(spark):
    big = 1 << 27
    rows = [(1, [big, big + 1]), (2, [big, big]), (3, [big + 1, big - 1]), (4, [0, 1])]
    assert run(spark, rows, rows, 2) == brute(rows, rows, 2)


@pytest.mark.parametrize("rows", [[], [(1, [1])], [(1, [1]), (2, [1, 1])]])
def test_few_or_no_candidates(spark, rows):
    assert run(spark, rows, rows, 3) == brute(rows, rows, 3)


def test_unusable_vectors_take_no_part(spark):
    rows = [(0, [0.5, 1.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, []), (6, [1.0, -0.001]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<float>")
    q = df.select("id", topk.quantise("embedding").alias("vector"))
    assert {r["id"]: r["vector"] for r in q.collect() if r["vector"] is not None and r["id"] is not None} == {0: [128, 256], 6: [256, -1]}
    got = topk.top_k(q.where(F.col("id") == 0), q, 5).collect()
    assert [tuple(r) for r in got] == [(0, 1, 6, 128 * 256 - 256)]
