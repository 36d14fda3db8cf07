"""Removal of repeated byte strings (the suffix-array criterion) by prefix doubling over thinned positions.

A byte is removed if it is covered by a 200-byte string that starts anywhere else
too. Prefix doubling answers that by ranks of positions: by their first 25 bytes, then by the
pairs (rank at i, rank at i + h) for h = 25, 50 and 100; a position whose rank is unique is dropped,
and ranks by 200 bytes end it. Two things keep the number of ranked positions small, without losing any repeat:

* Anchors: of the 137 64-byte strings
  that start in a 200-byte string, the leftmost of those with the smallest hash. Equal 200-byte
  strings have equal anchors at the same offset, so all starts whose anchor is unique are
  unique themselves. A run is the consecutive starts that share an anchor.
* Runs whose whole context (all their 200-byte strings) is equal are one: a run
  whose context occurs twice is repeated throughout, and for the comparison with other
  contexts one of the copies stands for all.

Only starts of runs that have the anchor but not the context in common with others are ranked.
As equal strings have equal anchors, Spark shuffles and sorts the contexts by anchor, and each task doubles over
the anchors it holds, some thousand contexts at a time: the rank pairs are sorted there, not in a shuffle a
round. Spark groups by anchor and context and joins the counts back, with partial aggregation before each shuffle
and joins that AQE can split. An anchor with
more than ``TOGETHER`` contexts, such as one at the edge of a passage that very many
documents hold, is dealt out by salt: each share settles the strings that repeat
within it, and only its other strings and one of each repeated kind go on to be
grouped by Spark across shares, by the pair of the hashes of their 100-byte halves.

Defined results: NULL text is empty (0 bytes, SHA-256 of nothing); texts below 200
bytes are kept whole; repeated rows are documents of their own (each repeats the
other); rows that share a doc_id are told apart by their texts; NULL doc_ids are
allowed; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import Hasher, blocks
from .shared import forget, settle, small, table

LENGTH = 200
GRAM = 64
FIRST = 25  # LENGTH is FIRST doubled three times
TOGETHER = 4096
NONE = -1
SHIFT = 10  # a run is packed as start << SHIFT | number of starts (at most LENGTH - GRAM + 1)
_POS = np.uint64((1 << 31) - 1)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    out, have = x, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(x) - width + 1], out[width - have :]) if have < width else out


def runs(data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(text index, start in the text, number of starts, anchor's hash, context's hash) of every run."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none
    hashes = Hasher(data)
    h = hashes.grams(gram)
    # smallest hash first, leftmost position on ties; the same bits of the hash for every block
    low = _sliding_min((h & ~_POS) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
    inside = np.zeros(len(low) + 1, dtype=np.int32)
    begin, end = off[:-1], off[1:] - length + 1
    full = end > begin
    np.add.at(inside, begin[full], 1)
    np.add.at(inside, end[full], -1)
    i = np.flatnonzero(np.cumsum(inside[:-1]))
    if not len(i):
        return none, none, none, none, none
    anchor = (low[i] & _POS).astype(np.int64)
    new = np.ones(len(i), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (i[1:] != i[:-1] + 1)
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(i)))
    start = i[at]
    context = hashes.spans(start, start + count + (length - 1))
    doc = np.searchsorted(off, start, side="right") - 1
    return doc, start - off[doc], count, h[anchor[at]].view(np.int64), context.view(np.int64)


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, h, text) -> one row per run."""
    for batch in batches:
        for first, data, off in blocks(batch.column(2)):
            doc, start, count, g, c = runs(data, off)
            rows = pa.array(doc + first)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array((start << SHIFT) | count), pa.array(g), pa.array(c)],
                names=["doc_id", "h", "run", "g", "c"],
            )


def _snippets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, h, text, [run, g, shares]) -> the contexts of the runs named."""
    for batch in batches:
        rows, out, size = [], [], 0
        for i in range(batch.num_rows):
            raw = batch.column(2)[i].as_py().encode()
            for r in batch.column(3)[i].as_py():
                start, n = r["run"] >> SHIFT, r["run"] & ((1 << SHIFT) - 1)
                rows.append((i, r["run"], r["g"], r["shares"]))
                out.append(raw[start : start + n + LENGTH - 1])
                size += len(out[-1])
            if out and (size > 4 << 20 or i == batch.num_rows - 1):
                at, run, g, shares = zip(*rows)
                at = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(run, pa.int64()), pa.array(g, pa.int64()), pa.array(shares, pa.int32()), pa.array(out, pa.binary())],
                    names=["doc_id", "h", "run", "g", "shares", "bytes"],
                )
                rows, out, size = [], [], 0


def _reranked(size: int, at: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Ranks of the positions ``at`` by their ``names``; NONE where the name is unique, and elsewhere."""
    out = np.full(size, NONE)
    _, rank, n = np.unique(names, return_inverse=True, return_counts=True)
    many = n[rank] > 1
    out[at[many]] = rank[many]
    return out


def _ranks(runs_: np.ndarray, contexts: list[bytes]):
    """Of every start in the contexts: its row, its place in the text, its rank among the strings of ``LENGTH``
    bytes at all starts (NONE: unique), and the hashes of the two halves of its string.

    Prefix doubling: positions are ranked by ``FIRST`` bytes, then by pairs (rank at i, rank at i + h) for
    h = ``FIRST``, twice that, ... A position goes once one of its ranks is unique.
    """
    count = runs_ & ((1 << SHIFT) - 1)
    size = count + LENGTH - 1
    data = np.frombuffer(b"".join(contexts), np.uint8)
    end = np.cumsum(size)
    left = np.repeat(end, size) - np.arange(len(data))  # bytes of the context from here on
    row = np.repeat(np.arange(len(runs_)), count)
    within = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    starts = (end - size)[row] + within
    hasher = Hasher(data)
    at = np.flatnonzero(left >= FIRST)
    rank, known = _reranked(len(data), at, hasher.grams(FIRST)[at]), FIRST
    while known < LENGTH:
        at = starts if 2 * known >= LENGTH else np.flatnonzero(left >= 2 * known)
        at = at[(rank[at] != NONE) & (rank[at + known] != NONE)]
        rank, known = _reranked(len(data), at, rank[at] * len(data) + rank[at + known]), 2 * known
    half = hasher.grams(LENGTH // 2)
    return row, (runs_ >> SHIFT)[row] + within, rank[starts], half[starts], half[starts + LENGTH // 2]


PAIRS = "doc_id long, h long, run long, r1 long, r2 long"


def _within_shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by anchor and share -> runs of starts whose string repeats in the share (r1 and
    r2 NULL), and of anchors with several shares the starts to compare across them."""

    def settled(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        row, start, rank, r1, r2 = _ranks(part.column(2).to_numpy(), part.column(5).to_pylist())
        # equal strings have equal anchors, so they meet here or in another share of their anchor;
        # a start differs from the other starts of its own run
        at = np.flatnonzero(rank != NONE)
        new = np.ones(len(at), dtype=bool)
        new[1:] = (row[at[1:]] != row[at[:-1]]) | (start[at[1:]] != start[at[:-1]] + 1)
        first = np.flatnonzero(new)
        length = np.diff(np.append(first, len(at)))
        yield batch_of(part, row[at[first]], (start[at[first]] << SHIFT) | length, None, None)
        # one of each string: unsettled ones, and partners for those of other shares
        one = np.concatenate([np.flatnonzero(rank == NONE), at[np.unique(rank[at], return_index=True)[1]]])
        open_ = one[part.column(4).to_numpy()[row[one]] > 1]
        if len(open_):
            yield batch_of(part, row[open_], (start[open_] << SHIFT) | 1, r1[open_].view(np.int64), r2[open_].view(np.int64))

    def batch_of(part, row, run, r1, r2) -> pa.RecordBatch:
        rows = pa.array(row)
        none = pa.nulls(len(rows), pa.int64())
        return pa.RecordBatch.from_arrays(
            [part.column(0).take(rows), part.column(1).take(rows), pa.array(run), none if r1 is None else pa.array(r1), none if r2 is None else pa.array(r2)],
            names=["doc_id", "h", "run", "r1", "r2"],
        )

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        all_ = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks().to_batches()[0]
        g, share = all_.column(3).to_numpy(), all_.column(6).to_numpy()
        # whole shares only: the last one may go on in the next batch
        borders = np.flatnonzero((g[1:] != g[:-1]) | (share[1:] != share[:-1])) + 1
        at = 0
        while len(borders) and at < borders[-1]:
            upto = int(borders[max(np.searchsorted(borders, at + TOGETHER, side="right") - 1, np.searchsorted(borders, at, side="right"))])
            yield from settled(all_.slice(at, upto - at))
            at = upto
        held = all_.slice(at)
    if held is not None and held.num_rows:
        yield from settled(held)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, runs) -> what is removed and the digest of the rest."""
    for batch in batches:
        size, removed, spans, digest = [], [], [], []
        for i in range(batch.num_rows):
            raw = (batch.column(1)[i].as_py() or "").encode()
            change = np.zeros(len(raw) + 1, dtype=np.int32)
            found = batch.column(2)[i].values.to_numpy()
            start = found >> SHIFT
            np.add.at(change, start, 1)
            np.add.at(change, start + (found & ((1 << SHIFT) - 1)) + LENGTH - 1, -1)
            gone = np.cumsum(change[:-1]) > 0
            size.append(len(raw))
            removed.append(int(gone.sum()))
            spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
            digest.append(hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, h, runs): the runs of starts of repeated strings, of each text that has any."""
    texts = _keyed(docs).where(F.octet_length("text") >= LENGTH)
    # written once: both the count of the anchors and the join read it
    every_run = settle(texts.mapInArrow(_run_rows, "doc_id long, h long, run long, g long, c long"), "every-run")
    anchors = every_run.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g")
    found = settle(every_run.join(anchors, "g"), "runs", free=True)
    forget(every_run)

    contexts = settle(
        found.groupBy("g", "c").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "h", "run")).alias("first")), "contexts"
    )
    whole = found.join(contexts.where("copies > 1").select("g", "c"), ["g", "c"], "left_semi").select("doc_id", "h", "run")
    # anchors with several contexts of which one occurs once; of each context one run
    mixed = contexts.groupBy("g").agg(F.count("*").alias("contexts"), F.min("copies").alias("least")).where("contexts > 1 and least = 1")
    named = contexts.join(mixed, "g").select(
        "first.doc_id", "first.h", F.struct("first.run", "g", F.ceil(F.col("contexts") / TOGETHER).cast("int").alias("shares")).alias("r")
    )
    named = settle(named.groupBy("doc_id", "h").agg(F.collect_list("r").alias("runs")), "named")
    same = F.col("t.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("t.h") == F.col("k.h"))
    # rows that repeat id and text hold the same runs: one of them is enough
    wanted = _matching(texts, named.select("doc_id", "h"), named.count()).dropDuplicates(["doc_id", "h"])
    with_text = wanted.alias("t").join(named.alias("k"), same).select("t.doc_id", "t.h", "t.text", "k.runs")
    contexts_of = with_text.mapInArrow(_snippets, "doc_id long, h long, run long, g long, shares int, bytes binary")
    dealt = contexts_of.withColumn("share", F.pmod(F.xxhash64("doc_id", "h", "run"), F.col("shares")).cast("int"))
    last = settle(dealt.repartition("g", "share").sortWithinPartitions("g", "share").mapInArrow(_within_shares, PAIRS), "ranked")
    few = last.where("r1 is null").select("doc_id", "h", "run")
    pairs = last.where("r1 is not null")
    again = pairs.groupBy("r1", "r2").agg(F.count("*").alias("k")).where("k > 1").select("r1", "r2")
    spread = pairs.join(again, ["r1", "r2"], "left_semi").select("doc_id", "h", "run")
    every = whole.unionByName(few).unionByName(spread)
    return every.groupBy("doc_id", "h").agg(F.collect_list("run").alias("runs"))


def _matching(texts: DataFrame, keys: DataFrame, count: int, how: str = "left_semi") -> DataFrame:
    same = F.col("t.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("t.h") == F.col("k.h"))
    return texts.alias("t").join(small(keys, count).alias("k"), same, how)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    marks = settle(repeated(docs), "marks")
    count = marks.count()
    texts, keys = _keyed(docs), marks.select("doc_id", "h")
    clean = F.coalesce("text", F.lit(""))
    untouched = _matching(texts, keys, count, "left_anti").select(
        "doc_id",
        F.octet_length(clean).cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.sha2(clean.cast("binary"), 256).alias("kept_sha256"),
    )
    same = F.col("t.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("t.h") == F.col("m.h"))
    marked = _matching(texts, keys, count).alias("t").join(marks.alias("m"), same).select("t.doc_id", "t.text", "m.runs")
    cut = marked.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return untouched.unionByName(cut)


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
