import os
import random

import pytest

from ledgerline.llm import jaccard
from ledgerline.llm.components import components

from .helpers import brute_components, docs, words


def edited(base, n, rng):
    w = list(base)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def run(spark, rows, size, percent):
    got = jaccard.near_duplicates(docs(spark, rows), size, percent).collect()
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80), (2, 60)])
def test_equals_all_pairs(spark, monkeypatch, size, percent):
    monkeypatch.setattr(jaccard, "RARE", 4)  # most lists are long: bundles and blocks
    monkeypatch.setattr(jaccard, "BLOCK_CLASSES", 8)
    rng = random.Random(size)
    a, b, shared = words(120, 1), words(60, 2), words(50, 3)
    texts = [edited(a, rng.randrange(0, 9), rng) for _ in range(45)] + [edited(b, rng.randrange(0, 4), rng) for _ in range(25)]
    texts += [" ".join(shared + words(rng.randrange(5, 200), 100 + i)) for i in range(30)]
    texts += [" ".join(words(n, 300 + n)) for n in range(1, 12)] * 2 + [None, "", " \n", "A b C d e", "a B c D E"]
    rng.shuffle(texts)
    rows = list(enumerate(texts, 10))
    assert run(spark, rows, size, percent) == brute_components(rows, size, percent)


def test_documents_equal_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert run(spark, rows, 4, 85) == brute_components(rows, 4, 85)


def test_null_and_repeated_ids(spark):
    t = " ".join(words(40, 9))
    got = jaccard.near_duplicates(docs(spark, [(7, t), (7, t), (None, t), (3, t.upper()), (9, "")]), 4, 85).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in got if r["doc_id"]) == [(3, 3), (7, 3), (7, 3), (9, 9)]
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None]
    assert jaccard.near_duplicates(docs(spark, []), 4, 85).collect() == []


def settled(monkeypatch):
    """(name, plan, reader) of each table that jaccard writes from now on."""
    written, settle = [], jaccard.settle

    def spy(df, name, *args, **kwargs):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        written.append((name, plan, settle(df, name, *args, **kwargs)))
        return written[-1][2]

    monkeypatch.setattr(jaccard, "settle", spy)
    return written


def near_texts(seed):
    rng = random.Random(seed)
    a, b = words(120, 1), words(60, 2)
    texts = [edited(a, rng.randrange(0, 9), rng) for _ in range(24)] + [edited(b, rng.randrange(0, 4), rng) for _ in range(12)]
    return texts + [" ".join(words(50, 200 + i)) for i in range(6)]


def test_tables_are_deleted_after_their_last_reader(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "RARE", 4)
    written, rows = settled(monkeypatch), list(enumerate(near_texts(5), 1))
    assert run(spark, rows, 4, 85) == brute_components(rows, 4, 85)
    left = {name for name, _, df in written if os.path.exists(df.settled_at.removeprefix("file:"))}
    assert {"sets", "screened", "survivors", "prefixes", "dense-links"} <= {name for name, _, _ in written}
    assert left <= {"rows", "links", "dense-links"}


def test_whole_sets_meet_only_where_ids_repeat(spark, monkeypatch):
    texts = near_texts(6)
    rows = list(enumerate(texts, 1))
    written = settled(monkeypatch)
    assert run(spark, rows, 4, 85) == brute_components(rows, 4, 85)
    assert ["first(tokens" in plan for name, plan, _ in written if name == "survivors"] == [False]
    # the same rows twice
    want = brute_components(rows, 4, 85)
    got = jaccard.near_duplicates(docs(spark, rows + rows), 4, 85).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted((i, *want[i]) for i in want for _ in (0, 1))


def test_screening_deals_tokens_with_their_row_alone(spark, monkeypatch):
    written = settled(monkeypatch)
    run(spark, list(enumerate(near_texts(7), 1)), 4, 85)
    table = next(df for name, _, df in written if name == "shared")
    assert table.columns == ["t"]


def test_keep_one_keeps_all_columns_and_apart_rows(spark):
    t, u = " ".join(words(60, 1)), " ".join(words(60, 2))
    rows = [(5, t, "en", "s"), (2, t, "en", "s"), (2, t, "en", "s"), (8, u, "de", None), (None, t), (None, t), (1, ""), (1, ""), (4, None)]
    kept = jaccard.keep_one(docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in kept.collect()) == sorted(
        [(2, t), (8, u), (-1, t), (-1, t), (1, ""), (1, ""), (4, "")]
    )


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_common_passage_makes_no_candidates(spark, monkeypatch):
    """Texts that share most of their words through one passage, but less than the linked similarity, are told apart before
    sets are dealt to pairs or blocks: these grow with the square of such a group."""
    monkeypatch.setattr(jaccard, "RARE", 4)
    rng, passage = random.Random(8), words(140, 4)
    texts = [" ".join(passage + [f"own{i}x{j}" for j in range(60)]) for i in range(30)]
    texts += [edited(words(120, 5), 2, rng) for _ in range(6)]
    rows, candidates, settle = list(enumerate(texts, 1)), [], jaccard.settle

    def spy(df, name, *args, **kwargs):
        out = settle(df, name, *args, **kwargs)
        if name == "prefixes":
            candidates.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "settle", spy)
    assert run(spark, rows, 4, 85) == brute_components(rows, 4, 85)
    assert candidates == [6]


def test_keep_one_names_the_shorter_list(spark, monkeypatch):
    """Whole rows are joined with the keys of the rows that go where these are fewer than those that stay."""
    rows = [(i, " ".join(words(30, 400 + i))) for i in range(1, 13)]
    rows += [(20, rows[0][1]), (21, rows[3][1]), (None, rows[5][1]), (22, ""), (5, rows[4][1]), (23, None)]
    joined, small = [], jaccard.small
    monkeypatch.setattr(jaccard, "links", lambda *args, f=jaccard.links: (joined.clear(), f(*args), joined.clear())[1])
    monkeypatch.setattr(jaccard, "small", lambda df, n, *args: joined.append(n) or small(df, n, *args))
    kept = jaccard.keep_one(docs(spark, rows))
    assert joined == [3, 1]  # 20, 21 and the row that 5 repeats; 5
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == sorted([*rows[:12], (0, rows[5][1]), (22, ""), (23, "")])
