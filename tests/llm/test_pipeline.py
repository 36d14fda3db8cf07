import corpus_pipeline
from pyspark.sql import functions as F

from ledgerline.llm.shared import table

from .helpers import brute_components, docs, words

SF = "/root/testdata/sf0.001"


def test_stages_keep_their_contracts(spark):
    docs = table(spark, SF, "documents")
    names = docs.columns
    seen = {"in": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        path = corpus_pipeline.settle(docs, name)
        docs = seen[name] = path
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "personal_data", "mixing", "tokenised"]
    before = [(r["doc_id"], r["text"]) for r in seen["language"].collect()]
    assert len(before) == 200  # clean documents stay
    firsts = {c for _, c in brute_components(before, 5, 80).values()}
    kept = [r["doc_id"] for r in seen["near_duplicates"].collect()]
    assert sorted(kept) == sorted(firsts)
    assert sorted(r["doc_id"] for r in seen["personal_data"].collect()) == sorted(kept)
    mixed = seen["mixing"].groupBy("doc_id").count()
    assert mixed.agg(F.max("count")).first()[0] <= 2
    assert seen["tokenised"].count() == seen["mixing"].count()


def test_stages_take_empty_and_odd_tables(spark):
    odd = docs(spark, [(1, None), (1, None), (2, ""), (None, " ".join(words(30, 1)), "en", None), (4, "the and of " * 30, "en", "s"), (4, "the and of " * 30, "en", "s")])
    for rows in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, rows, SF).count() >= 0


CLASHING = "doc_id long, text string, lang string, source string, n_chars long, __h string, __id int, id_ string, key_ string, copies int, n_pii int, ids string"


def clashing(spark):
    text = " ".join(words(60, 3))
    rows = [(i // 3, text if i < 6 else f"{text} tail{i}", "en" if i % 2 else "de", f"s{i % 3}", i, "x", i, "i", "k", 7, 8, "z") for i in range(12)]
    return spark.createDataFrame(rows, CLASHING)


def test_stages_keep_clashing_columns(spark):
    for _, stage in corpus_pipeline.STAGES[1:4]:
        rows = clashing(spark)
        out = stage(spark, rows, SF)
        assert out.columns == rows.columns or out.columns == [c for c in rows.columns if c != "n_pii"]
        assert out.count() > 0


def test_kept_row_does_not_depend_on_the_order(spark):
    from ledgerline.llm import jaccard

    text = " ".join(words(60, 4))
    rows = [(1, text, "en", "a"), (1, text, "de", "b"), (2, text, "fr", "c")]
    one = jaccard.keep_one(docs(spark, rows)).collect()
    two = jaccard.keep_one(docs(spark, rows[::-1]).repartition(2)).collect()
    assert len(one) == 1 and one == two and one[0]["doc_id"] == 1
