"""Language identification by word-first backoff.

Training counts words per language over a bounded sample of labelled documents
(``DOCS_PER_LANG`` documents of each language, the first in the order of a hash
of the text) and character n-grams over the words counted. The model keeps at
most ``MAX_WORDS`` words and ``MAX_GRAMS`` n-grams of each length per language, and no words of
more than 64 characters, nor words and n-grams that the sample has once,
so it has a fixed size bound and is broadcast; it does not grow with the corpus.

Prediction reads every word (run of letters, lower-cased) of the whole text. A
word the model knows is scored by its log frequency in each language. An unseen
word falls back to its character n-grams: the longest length of which the model
knows any n-gram of the word, from ``MAX_N`` down to 1, gives the mean log
frequency of the known ones; a word with none is no evidence.

The prediction has the largest sum over all words; ``score`` is the softmax
of the mean log frequency per word, at the prediction (0 to 1), so it does not
saturate with the length of a text.

Defined results: NULL text or text without a letter: ``und``, score 0. Letters
but no evidence, or an exact tie: the first language in code-point order; with
no evidence the score is 1 / number of languages. Nothing to learn from: ``und``
for every document, score 0. Repeated rows are predicted one by one; other
columns of the input are carried along untouched.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import handing_back, release, settle, small, table

DOCS_PER_LANG = 1000
MAX_WORDS = 50_000
MAX_GRAMS = 20_000
MAX_N = 5
# letters (\\p{L}) and, as Python's expressions count them to the word characters, other numbers such as ½ or Ⅷ
_LETTERS_AND_NUMBERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
_MEMO = 200_000


def _grams(word: Column, n: int) -> Column:
    """n-grams of the word between border marks."""
    w = F.concat(F.lit("^"), word, F.lit("$"))
    return F.transform(F.sequence(F.lit(1), F.length(w) - (n - 1)), lambda i: w.substr(i, F.lit(n)))


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", docs_per_lang: int = DOCS_PER_LANG) -> dict:
    """Model from the labelled rows: languages, and per word and n-gram the log
    frequencies in the order of the languages."""
    spark = labelled.sparkSession
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    hashes = settle(rows.select("lang", F.xxhash64("text").alias("h")).distinct(), "label-hashes")
    counts = hashes.groupBy("lang").agg(F.count("*").alias("n"))
    # hashes are spread evenly: twice the expected share of a language holds its first ones, and is all that meets in a task
    place = F.col("h").cast("double") / 2.0**64 + 0.5
    near = hashes.join(small(counts, counts.count()), "lang").where(place * F.col("n") <= 2 * docs_per_lang + 100)
    order = Window.partitionBy("lang").orderBy("h")
    chosen = settle(near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= docs_per_lang).select("lang", "h"), "labels-chosen")
    keys = small(chosen, chosen.count())
    sample = rows.withColumn("h", F.xxhash64("text")).join(keys, ["lang", "h"]).dropDuplicates(["lang", "h"])
    words = (
        sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("key"))
        .where(F.length("key") <= 64)
        .groupBy("lang", "key")
        .agg(F.count("*").alias("n"))
    )
    grams = None
    for n in range(1, MAX_N + 1):
        part = (
            words.where(F.length("key") >= max(1, n - 2))
            .select("lang", F.explode(_grams(F.col("key"), n)).alias("key"), "n")
            .groupBy("lang", "key")
            .agg(F.sum("n").alias("n"))
            .select("lang", F.lit(n).alias("len"), "key", "n")
        )
        grams = part if grams is None else grams.unionByName(part)
    counts = words.select("lang", F.lit(0).alias("len"), "key", "n").unionByName(grams)
    total = Window.partitionBy("lang", "len")
    ranked = counts.withColumn("total", F.sum("n").over(total)).withColumn(
        "r", F.row_number().over(total.orderBy(F.desc("n"), "key"))
    )
    kept = ranked.where((F.col("n") > 1) & (F.col("r") <= F.when(F.col("len") == 0, MAX_WORDS).otherwise(MAX_GRAMS)))
    # at most (MAX_WORDS + MAX_N * MAX_GRAMS) rows per language
    got = kept.select("lang", "len", "key", "n", "total").toPandas()
    langs = sorted(x["lang"] for x in chosen.select("lang").distinct().collect())
    at = {x: i for i, x in enumerate(langs)}
    model: dict = {"langs": langs, "tables": []}
    for n in range(MAX_N + 1):
        part = got[got["len"] == n]
        keys = {k: i for i, k in enumerate(dict.fromkeys(part["key"]))}
        totals = np.ones(len(langs))
        count = np.zeros((len(keys), len(langs)))
        col = part["lang"].map(at).to_numpy(dtype=int)
        totals[col] = part["total"].to_numpy(dtype=float)
        count[part["key"].map(keys).to_numpy(dtype=int), col] = part["n"].to_numpy(dtype=float)
        logs = np.log((count + 0.5) / (totals + 0.5 * max(1, len(keys))))
        model["tables"].append((keys, logs))
    spark_model = spark.sparkContext.broadcast(model)
    return {"langs": langs, "broadcast": spark_model}


def _words(text: str) -> list[str]:
    """The runs of letters (``str.isalpha``), lower-cased. An expression that excludes the other numbers one by one
    compares every letter with hundreds of them, so only runs that hold such a number are cut further."""
    found = _LETTERS_AND_NUMBERS.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for run in found for w in "".join(c if c.isalpha() else " " for c in run).split()]


def _backoff(word: str, tables: list, zero: np.ndarray) -> tuple[np.ndarray, int]:
    keys, logs = tables[0]
    i = keys.get(word)
    if i is not None:
        return logs[i], 1
    w = f"^{word}$"
    for n in range(min(len(tables) - 1, len(w)), 0, -1):
        keys, logs = tables[n]
        known = [j for j in map(keys.get, (w[i : i + n] for i in range(len(w) - n + 1))) if j is not None]
        if n == 1:
            known = [j for j in map(keys.get, word) if j is not None]  # border marks alone say nothing
        if known:
            return logs[known].mean(axis=0), 1
    return zero, 0


def _predictor(broadcast, text: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        model = broadcast.value
        langs, tables = model["langs"], model["tables"]
        zero = np.zeros(len(langs))
        memo: dict[str, int] = {}
        rows = np.zeros((1 << 12, len(langs) + 1))
        for batch in batches:
            pred, score = [], []
            for value in batch.column(batch.schema.get_field_index(text)):
                value = value.as_py()
                words = _words(value) if value else []
                if not words or not langs:
                    pred.append(UNKNOWN)
                    score.append(0.0)
                    continue
                for w in words:
                    if w not in memo:
                        if len(memo) >= len(rows):
                            rows = np.concatenate([rows, np.zeros_like(rows)])
                        j = memo[w] = len(memo)
                        rows[j, :-1], rows[j, -1] = _backoff(w, tables, zero)
                total = rows[np.fromiter(map(memo.__getitem__, words), dtype=np.int64, count=len(words))].sum(axis=0)
                if len(memo) > _MEMO:
                    memo = {}
                if not total[-1]:
                    pred.append(langs[0])
                    score.append(1.0 / len(langs))
                    continue
                best = int(np.argmax(total[:-1]))
                mean = total[:-1] / total[-1]
                pred.append(langs[best])
                score.append(float(1.0 / np.exp(mean - mean[best]).sum()))
            cols = [batch.column(i) for i in range(batch.num_columns)] + [pa.array(pred, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names + ["lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """All columns of ``docs`` plus lang_pred and score (columns of those names in the input are replaced)."""
    docs = docs.drop("lang_pred", "score")
    schema = T.StructType(docs.schema.fields + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(handing_back(_predictor(model["broadcast"], text)), schema)


#: A text whose words speak for no language more than this share is rejected.
MIN_SCORE = 0.4


def accepted(docs: DataFrame, model: dict, text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose text is in a language the model knows; the columns stay as they are."""
    judged = predict(docs, model, text)
    return judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select(*docs.columns)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")
