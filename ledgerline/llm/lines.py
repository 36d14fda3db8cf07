"""Line dedup: lines that many documents share stay in one of them.

A text is split at ``\\n``; a line's key is the line without the white space at its
ends and with A-Z lower-cased. Lines whose key is long enough are exploded and hashed
(two 64-bit hashes), and a key found in at least ``min_docs`` documents loses all its lines
except in the largest doc_id that has it.

1. Rows per key, counted with map-side combine: a key that a third of all documents
   hold is one row per task. Only keys of ``min_docs`` rows and more go on; a text
   gives each key once, so copies of a line inside a document cross no network.
2. The lines of these keys, with the exact number of documents (a doc_id on several
   rows is one document), give the dropped keys and the document that keeps them.
3. Dropped line positions per text; the other lines are put together again by position.

Texts are told apart by doc_id and two hashes, so rows of one doc_id and different
texts are each cleaned by themselves.

Defined results: a NULL or empty text is one empty line and is kept as it is (NULL stays NULL); rows
with NULL doc_id are together one document, smaller than any other; repeated rows are the
same document and lose the same lines; an empty table gives an empty result; other
columns of the input are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import SPACES, free_names, let, settle, small, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def _hashes(value: Column) -> list[Column]:
    return [F.xxhash64(value), F.xxhash64(F.lit(1), value)]


def _keyed(docs: DataFrame, min_chars: int) -> DataFrame:
    """id, t1, t2 (hashes of the text) and ``lines``: key hashes and position of every line that is long enough."""
    keys = F.transform(split_lines(F.col("text")), lambda line, at: F.struct(line_key(line).alias("key"), at.alias("at")))
    long = F.filter(keys, lambda x: F.length(x["key"]) >= min_chars)
    hashed = F.transform(long, lambda x: F.struct(*(h.alias(n) for h, n in zip(_hashes(x["key"]), ("h1", "h2"))), x["at"].alias("at")))
    t1, t2 = _hashes(F.col("text"))
    return docs.select(F.col("doc_id").alias("id"), t1.alias("t1"), t2.alias("t2"), hashed.alias("lines"))


def dropped_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(id, t1, t2, at array<int>): positions of the lines that go, one row per document text that loses any."""
    keyed = _keyed(docs, min_chars)
    once = F.array_distinct(F.transform("lines", lambda x: F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"))))
    rows = keyed.select("id", F.explode(once).alias("k")).groupBy("k.h1", "k.h2").agg(F.count("*").alias("rows"), F.max("id").alias("last"))
    often = settle(rows.where(F.col("rows") >= min_docs).select("h1", "h2", "last"), "line-keys")
    lines = keyed.select("id", "t1", "t2", F.explode("lines").alias("l")).select("id", "t1", "t2", "l.h1", "l.h2", "l.at")
    held = settle(lines.join(small(often, often.count()), ["h1", "h2"]), "line-places")
    shared = held.select("h1", "h2", "id").distinct().groupBy("h1", "h2").agg(F.count("*").alias("docs"))
    shared = settle(shared.where(F.col("docs") >= min_docs).select("h1", "h2"), "line-shared")
    gone = held.join(small(shared, shared.count()), ["h1", "h2"], "left_semi").where(~F.col("id").eqNullSafe(F.col("last")))
    return gone.groupBy("id", "t1", "t2").agg(F.collect_set("at").alias("at"))


def drop_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with ``text`` without the dropped lines, and with n_lines (before), n_dropped (both long;
    columns of these names are replaced)."""
    docs = docs.drop("n_lines", "n_dropped")
    gone = settle(dropped_lines(docs, min_chars, min_docs), "line-drops")
    i, t1, t2, at = free_names(docs, "id", "t1", "t2", "at")
    h1, h2 = _hashes(F.col("text"))
    places = gone.agg(F.coalesce(F.sum(F.size("at")), F.lit(0))).first()[0]
    gone = small(gone.toDF(i, t1, t2, at), places)
    rows = docs.withColumns({t1 + "x": h1, t2 + "x": h2})
    same = F.col("doc_id").eqNullSafe(F.col(i)) & (F.col(t1 + "x") == F.col(t1)) & (F.col(t2 + "x") == F.col(t2))
    lines = split_lines(F.col("text"))
    left = let(
        lines,
        lambda ls: F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col(at)), lambda k: F.get(ls, k)), "\n"
        ),
    )
    joined = rows.join(gone, same, "left")
    return joined.select(
        *(F.when(F.col(at).isNull(), F.col("text")).otherwise(left).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size(at), F.lit(0)).cast("long").alias("n_dropped"),
    )


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=20, min_docs=3)
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT doc_id, rid, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), s AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), m AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.last AS gone FROM k LEFT JOIN s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
"""
