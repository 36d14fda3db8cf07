import random
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import repeats

from .helpers import brute_repeats, docs, table

COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def check(spark, rows):
    assert table(repeats.remove_repeats(docs(spark, rows)), *COLUMNS) == sorted(brute_repeats(rows), key=repr)


def noise(rng, n, letters="abcdefgh éß"):
    return "".join(rng.choice(letters) for _ in range(n))


@pytest.mark.parametrize("together", [4096, 3])  # with 3, most anchors are dealt out by share
def test_passages_copies_and_near_misses(spark, monkeypatch, together):
    monkeypatch.setattr(repeats, "TOGETHER", together)
    rng = random.Random(1)
    passages = [noise(rng, n) for n in (150, 170, 185, 199, 200, 230, 640)]
    rows = []
    for i in range(40):
        parts = [noise(rng, rng.randrange(0, 300))]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages)
            cut = rng.randrange(0, 40)
            parts += [p[cut:], noise(rng, rng.randrange(0, 120))]
        rows.append((i, "".join(parts)))
    rows += [(100 + i, rows[i][1]) for i in range(4)]
    check(spark, rows)


def test_runs_of_one_character_and_repeats_within_a_text(spark):
    rng = random.Random(2)
    p = noise(rng, 260)
    check(spark, [(1, "a" * 600), (2, "b" * 199), (3, "b" * 200), (4, "c" * 201), (5, p + "-" + p), (6, "x" + p[20:240] + "y"), (7, "ab" * 300)])


def test_nulls_repeated_rows_and_empty_table(spark):
    rng = random.Random(3)
    t, u = noise(rng, 400), noise(rng, 400)
    rows = [(1, None), (2, ""), (3, t), (3, t), (4, u), (4, u[:300] + t[:250]), (None, noise(rng, 300))]
    check(spark, rows)
    check(spark, [])


def test_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert table(repeats.op5_repeats(spark, "/root/testdata/sf0.001"), *COLUMNS) == sorted(brute_repeats(rows), key=repr)


def test_ranks_by_doubling_equal_the_strings():
    rng = random.Random(4)
    base = bytes(rng.choice(b"ab") for _ in range(300))
    contexts, runs = [], []
    for k in range(60):
        n = rng.randrange(1, 60)
        at = rng.randrange(0, 300 - 199 - n)
        own = bytearray(base[at : at + n + 199])
        if k % 3:  # some strings equal, others off by one byte near either end
            own[rng.choice([0, 24, 25, 100, 199, len(own) - 1])] ^= 1
        contexts.append(bytes(own))
        runs.append((7 * k << repeats.SHIFT) | n)
    row, start, rank, _, _ = repeats._ranks(np.array(runs), contexts)
    strings = [contexts[r][s - 7 * r :][:200] for r, s in zip(row.tolist(), start.tolist())]
    assert [len(s) for s in strings] == [200] * len(strings)
    many = Counter(strings)
    names = {}
    for s, r in zip(strings, rank.tolist()):
        assert (r == repeats.NONE) == (many[s] == 1)
        assert r == repeats.NONE or names.setdefault(s, r) == r
    assert len(set(names.values())) == len(names) > 20
    assert min(many.values()) == 1
