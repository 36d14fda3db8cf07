import re
import sys
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import langid

from .helpers import docs

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    return langid.train(rows.where(~langid.held_out()))


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = langid.op2_language(spark, SF)
    r = got.join(truth, "doc_id").where("held_out").agg(
        F.count("*").alias("n"), F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("hit"), F.min("score").alias("low"), F.max("score").alias("high")
    ).first()
    assert r["n"] > 200 and r["hit"] > 0.98 and 0 <= r["low"] and r["high"] <= 1
    assert got.count() == truth.count()


def test_labels_and_sources_are_not_inputs(spark, model):
    text = "the and that with this for are on the of"
    rows = docs(spark, [(1, text, "de", "a"), (2, text, None, None), (2, text, None, None)])
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(rows, model).collect()} == {("en", langid.predict(rows, model).first()["score"])}


def test_defined_results_and_clashing_columns(spark, model):
    rows = docs(spark, [(1, None), (2, ""), (3, "12 ### 34"), (4, "漢字"), (5, "the and " * 20000)]).withColumns(
        {"score": F.lit("x"), "lang_pred": F.lit(1), "h": F.lit(2)}
    )
    got = {r["doc_id"]: r for r in langid.predict(rows, model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and got[3]["score"] == 0.0
    assert got[4]["lang_pred"] == "de" and got[4]["score"] == pytest.approx(0.25)  # no evidence: first language
    assert got[5]["lang_pred"] == "en" and got[5]["h"] == 2
    kept = langid.accepted(docs(spark, [(1, None), (4, "漢字"), (5, "the and of that with")]), model)
    assert [r["doc_id"] for r in kept.collect()] == [5] and kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_unseen_words_fall_back_to_ngrams(spark, model):
    got = langid.predict(docs(spark, [(1, "thinghetiononly"), (2, "éeauxmenttionelle")]), model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {1: "en", 2: "fr"}


def test_numbers_are_no_letters(spark, model):
    rows = docs(spark, [(1, "² ½"), (2, "①②③ Ⅷ ٣"), (3, "½the and"), (4, "一")])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(rows, model).collect()}
    assert got[1] == got[2] == ("und", 0.0) and got[3][0] == "en" and got[4][0] != "und"


def test_words_are_the_runs_of_letters():
    numbers = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isnumeric() and not c.isdecimal() and not c.isalpha())
    slow = re.compile(rf"[^\W\d_{numbers}]+")
    text = "".join(f"a{chr(c)}İb{chr(c)}" + " " * (c % 3 == 0) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    for part in ("½the and", "Ⅷ² x²y½½z", "日本 一二 ٣٤x_y𐄇z", "", " 12 ", text):
        assert langid._words(part) == slow.findall(part.lower())


def test_words_cost_no_more_than_a_plain_expression():
    text = "the quick brown fox jumps over naïve dogs " * 20_000
    plain = re.compile(r"[^\W\d_]+")

    def seconds(find):
        took = []
        for _ in range(3):
            at = time.process_time()
            find(text.lower())
            took.append(time.process_time() - at)
        return min(took)

    # the expression with all numbers in it takes about 20 times as long
    assert seconds(langid._words) < 6 * seconds(plain.findall)


def test_nothing_to_learn(spark):
    none = docs(spark, [(1, "the and", None), (2, None, "en")])
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(none, langid.train(none)).collect()} == {("und", 0.0)}
    assert langid.predict(none.limit(0), langid.train(none.limit(0))).collect() == []


def test_sample_bound_holds(spark):
    rows = docs(spark, [(i, f"alpha{chr(97 + i % 26)}x beta", "xx") for i in range(60)] + [(99, "beta gamma beta", "yy")])
    model = langid.train(rows, docs_per_lang=5)
    assert model["langs"] == ["xx", "yy"]


def test_the_sample_is_the_first_texts_by_hash(spark, monkeypatch):
    rows = docs(spark, [(i, f"word{i % 900} text number {i % 900}", "en" if i % 10 else "de") for i in range(3000)])
    written = {}
    settle = langid.settle
    monkeypatch.setattr(langid, "settle", lambda df, name: written.setdefault(name, settle(df, name)))
    langid.train(rows, docs_per_lang=5)
    hashes = rows.select("lang", F.xxhash64("text").alias("h")).distinct().collect()
    want = {(x, h) for x in ("de", "en") for h in sorted(r["h"] for r in hashes if r["lang"] == x)[:5]}
    assert {tuple(r) for r in written["labels-chosen"].collect()} == want
