"""Digest of a file's bytes, by many tasks and for files of any size.

A file is a hash tree: leaves are SHA-256 of a zero byte and ``LEAF_BYTES`` bytes of
the file, nodes SHA-256 of a one byte and the digests of up to ``FAN`` children, in ``LEVELS``
levels above the leaves (2**50 bytes). The tree depends on the bytes alone, not on how Spark
splits the file.

The files are read as lines that keep all their bytes but the line feed. One pass
adds up the bytes of each split, whose prefix sums say where in the file the lines of a split
begin; a second one puts the lines together again and cuts them at the borders of the leaves.
Leaves that lie in one split are hashed in its task; of the others the fragments are shuffled, two
a split. A whole file never meets in one task, nor do its leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LEAF_BYTES = 1 << 20
FAN = 1024
LEVELS = 3

# Splits whose places in their files (about 150 bytes each) a broadcast may hold; beyond it the join
# shuffles the bytes, and more leaves come out in fragments.
BROADCAST_SPLITS = 500_000


def _chunks(limit: int):
    """(path, size, start, line) in file order -> (path, size, start, rel, data): the bytes of a split in pieces of
    about ``limit``, ``rel`` bytes after its first line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rel, part, held, out, ready = None, 0, [], 0, [], 0

        def flush() -> int:
            nonlocal rel, held
            data = b"\n".join(part) + b"\n"
            out.append((*key, rel, data))
            rel, held = rel + len(data), 0
            part.clear()
            return len(data)

        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for *at, line in zip(*(c.to_pylist() for c in batch.columns)):
                if at != key:
                    if part:
                        ready += flush()
                    key, rel = at, 0
                part.append(line)
                held += len(line) + 1
                if held >= limit:
                    ready += flush()
                if ready >= limit:
                    yield _batch(out, types)
                    out, ready = [], 0
        if part:
            flush()
        if out:
            yield _batch(out, types)

    return run


def _batch(rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[f"c{i}" for i in range(len(types))])


def _leaves(leaf: int):
    """(path, size, at, data) in any order -> (path, leaf, digest, at, data): the digest of every leaf that comes in a
    run, and the fragments (digest NULL) of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, size, at, held = None, 0, 0, bytearray()
        types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

        def cut(out: list, last: bool) -> None:
            nonlocal at
            while held:
                n = at // leaf
                end = min((n + 1) * leaf, size)
                if at + len(held) < end and not last:
                    return
                data = bytes(held[: end - at])
                whole = at == n * leaf and at + len(data) == end
                out.append((path, n, hashlib.sha256(b"\0" + data).hexdigest() if whole else None, at, None if whole else data))
                del held[: len(data)]
                at += len(data)

        for batch in batches:
            out: list[tuple] = []
            for path_, size_, at_, data in zip(*(c.to_pylist() for c in batch.columns)):
                if path_ != path or at_ != at + len(held):
                    cut(out, True)
                    path, size, at = path_, size_, at_
                held += data[: size_ - at_]  # a last line without a line feed got one
                cut(out, False)
            if out:
                yield _batch(out, types)
        out = []
        cut(out, True)
        if out:
            yield _batch(out, types)

    return run


def tree_digests(
    spark: SparkSession, dirs: list[str], *, leaf: int = LEAF_BYTES, fan: int = FAN, levels: int = LEVELS
) -> DataFrame:
    """(path, size, digest) of every file in ``dirs`` that has a byte.

    Files are digested as they are stored, so compressed ones, which Spark would read unpacked, are refused by name.
    A file may be larger than memory; a line of it may not.
    """
    lines = spark.read.option("lineSep", "\n").text(dirs).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("line"),
    )
    order = Window.partitionBy("path").orderBy("start")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(Window.partitionBy("path"))
    stored = (total == F.col("size")) | (total == F.col("size") + 1)
    refused = F.raise_error(F.concat("path", F.lit(" is not stored as the bytes it is read as (compressed?)"))).cast("long")
    # a row per split, so a file's window holds its size / split size rows
    splits = lines.groupBy("path", "size", "start").agg(F.sum(F.octet_length("line") + 1).alias("n"))
    splits = splits.select("path", "start", F.when(stored, before).otherwise(refused).alias("base"))
    if splits.count() <= BROADCAST_SPLITS:
        splits = F.broadcast(splits)

    chunks = lines.select("path", "size", "start", "line").mapInArrow(_chunks(leaf), "path string, size long, start long, rel long, data binary")
    placed = chunks.join(splits, ["path", "start"]).select("path", "size", (F.col("base") + F.col("rel")).alias("at"), "data")
    cut = placed.mapInArrow(_leaves(leaf), "path string, n long, digest string, at long, data binary")
    pieces = cut.groupBy("path", "n").agg(
        F.max("digest").alias("digest"), F.array_sort(F.collect_list(F.when(F.col("digest").isNull(), F.struct("at", "data")))).alias("x")
    )
    joined = F.aggregate("x", F.lit(b"\0"), lambda acc, e: F.concat(acc, e["data"]))
    nodes = pieces.select("path", "n", F.coalesce("digest", F.sha2(joined, 256)).alias("digest"))
    for _ in range(levels):
        above = nodes.groupBy("path", F.floor(F.col("n") / fan).alias("n")).agg(F.array_sort(F.collect_list(F.struct("n", "digest"))).alias("x"))
        below = F.concat(F.lit("01"), F.array_join(F.col("x.digest"), ""))
        nodes = above.select("path", "n", F.sha2(F.unhex(below), 256).alias("digest"))
    sizes = lines.select("path", "size").distinct()
    return nodes.join(sizes, "path").select("path", "size", "digest")
