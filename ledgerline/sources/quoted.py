"""Payment files whose quoted values hold line breaks, read by many tasks a file.

Spark's CSV reader either takes every line for a record (and cuts such a value in
two) or reads a file in one task. Here a file stays split into byte ranges. A line maps the
state before it (inside a quoted value or not) to the state after it; a range is
the composition of its lines, computed for both states it may start in, and the prefix
compositions over the ranges of a file say in which state each really starts. The second
read then cuts every range into records by itself. A record that runs over a
range's end comes out in fragments, which are put together by the range it began in:
two fragments a range at most, so little is shuffled.

Quotes open a value only at its start; a doubled quote inside is one quote character; what follows a
closing quote belongs to the value up to the separator, as in Spark's reader.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINE, START = "__line", "__start"

_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"(?!")[^;]*+|[^";][^;]*+|)'
#: A line that ends outside of quotes when it starts outside, and when it starts inside.
FROM_OUTSIDE = rf"{_FIELD}(?:;{_FIELD})*+"
FROM_INSIDE = rf'[^"]*+(?:""[^"]*+)*+"(?!")[^;]*+(?:;{_FIELD})*+'

#: A record longer than this is taken for a quote that is never closed.
MAX_RECORD_BYTES = 64 << 20


def read_lines(spark: SparkSession, dirs: list[str], path: str, base: str | None = None, month: T.StructField | None = None) -> DataFrame:
    """Lines of the files in ``dirs`` as they are in the bytes: ``LINE`` binary without its end,
    ``START`` (where the range begins that a line begins in), ``path``, and the month folder."""
    reader = spark.read.option("lineSep", "\n")
    fields = [T.StructField("value", T.StringType())]
    if base is not None:
        reader, fields = reader.option("basePath", base), [*fields, month]
    lines = reader.schema(T.StructType(fields)).text(dirs)
    return lines.select(
        F.col("value").cast("binary").alias(LINE),
        F.col("_metadata.file_block_start").alias(START),
        F.col("_metadata.file_path").alias(path),
        *([F.col(month.name)] if base is not None else []),
    )


def ends_inside(line) -> F.Column:
    """Whether a decoded line that starts outside of quotes ends inside of them."""
    return line.contains('"') & ~line.rlike(f"^{FROM_OUTSIDE}$")


def _bytes(pattern: str) -> re.Pattern:
    return re.compile(pattern.encode(), re.DOTALL)


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, start, line) in file order, lines with a quote only -> per range: its state at the end when it starts
    outside and when it starts inside, and whether it is ever outside when it starts inside."""
    outside, inside = _bytes(FROM_OUTSIDE), _bytes(FROM_INSIDE)
    after = lambda state, line: (inside if state else outside).fullmatch(line) is None
    key, a, b, closed = None, False, True, False
    out: list[tuple] = []
    for batch in batches:
        for path, start, line in zip(*(c.to_pylist() for c in batch.columns)):
            if (path, start) != key:
                if key is not None:
                    out.append((*key, a, b, closed))
                key, a, b, closed = (path, start), False, True, False
            line = line.removesuffix(b"\r")
            same = a == b
            a = after(a, line)
            b = a if same else after(b, line)
            closed = closed or not b
    if key is not None:
        out.append((*key, a, b, closed))
    if out:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()))],
            names=["path", "start", "a", "b", "closed"],
        )


def range_states(lines: DataFrame, path: str) -> DataFrame:
    """(path, start, inside, owner) of every byte range: whether it starts inside of quotes, and where the
    range begins that the record open at its start began in."""
    ranges = lines.select(path, START).distinct().toDF("path", "start")
    quoted = lines.where(F.col(LINE).cast("string").contains('"')).select(path, START, LINE)
    maps = quoted.mapInArrow(_states, "path string, start long, a boolean, b boolean, closed boolean")
    # a range without quotes changes nothing
    maps = ranges.join(maps, ["path", "start"], "left").select(
        "path", "start", F.coalesce("a", F.lit(False)).alias("a"), F.coalesce("b", F.lit(True)).alias("b"), F.coalesce("closed", F.lit(False)).alias("closed")
    )
    # one row a range, so a file's window holds its size / split size rows
    order = Window.partitionBy("path").orderBy("start")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flips = maps.withColumn("flips", F.sum((F.col("a") & ~F.col("b")).cast("int")).over(upto))
    fixed = F.last(F.when(F.col("a") == F.col("b"), F.struct("a", "flips")), ignorenulls=True).over(upto)
    state = flips.withColumn("fixed", fixed).withColumn(
        "after",
        F.when(F.col("fixed").isNull(), F.col("flips") % 2 == 1).otherwise(F.col("fixed.a") != ((F.col("flips") - F.col("fixed.flips")) % 2 == 1)),
    )
    state = state.withColumn("inside", F.coalesce(F.lag("after").over(order), F.lit(False)))
    opened = F.when(F.col("after") & (~F.col("inside") | F.col("closed")), F.col("start"))
    state = state.withColumn("opened", F.last(opened, ignorenulls=True).over(upto))
    return state.select("path", "start", "inside", F.lag("opened").over(order).alias("owner"))


def _records(width: int, limit: int):
    """(line, start, path[, month], inside, owner) in file order -> (record, owner, start, path[, month]);
    owner is NULL for whole records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        outside, inside = _bytes(FROM_OUTSIDE), _bytes(FROM_INSIDE)
        key, state, part, size, owner, head, tail = None, False, [], 0, None, False, ()
        out: list[tuple] = []

        def done(owner):
            nonlocal part, size
            out.append((b"\n".join(part), owner, key[0], *tail))
            part, size = [], 0

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for line, start, *rest, inside_, owner_ in zip(*columns):
                if (start, rest[0]) != key:
                    if part:
                        done(owner if head else key[0])
                    if inside_ is None:
                        raise ValueError(f"{rest[0]} was split differently between two reads; read it again")
                    key, tail, state, owner = (start, rest[0]), tuple(rest), inside_, owner_
                    head, first = inside_, start == 0
                line = line.removesuffix(b"\r")
                if b'"' in line:
                    state = (inside if state else outside).fullmatch(line) is None
                part.append(line)
                size += len(line) + 1
                if size > limit:
                    raise ValueError(f"{rest[0]} has a quote that is not closed within {limit} bytes, in the range from byte {start}")
                if state:
                    continue
                if first:  # the header
                    part, size, first = [], 0, False
                elif len(part) == 1 and not head and not line:
                    part, size = [], 0
                else:
                    done(owner if head else None)
                head = False
            if out:
                yield _batch(out, width)
                out.clear()
        if part:
            done(owner if head else key[0])
        if out:
            yield _batch(out, width)

    return run


def _batch(rows: list[tuple], width: int) -> pa.RecordBatch:
    types = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.int32()][:width]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[f"c{i}" for i in range(width)])


def read_records(lines: DataFrame, path: str, encoding: str, limit: int = MAX_RECORD_BYTES) -> DataFrame:
    """The records of ``lines`` (whole files, see ``read_lines``) as text: ``LINE``, ``path`` and the month folder.
    Header lines and empty lines are left out; a line break inside a value is ``\\n``."""
    keys = [path, *(c for c in lines.columns if c not in (LINE, START, path))]
    # one short row per byte range (a file's size / split size), and each task needs those of its ranges in
    # file order, which a shuffle would lose
    states = F.broadcast(range_states(lines, path).toDF(path, START, "__inside", "__owner"))
    marked = lines.join(states, [path, START], "left").select(LINE, START, *keys, "__inside", "__owner")
    fields = {f.name: f.dataType.simpleString() for f in lines.schema.fields}
    schema = f"{LINE} binary, __owner long, {START} long, " + ", ".join(f"`{k}` {fields[k]}" for k in keys)
    cut = marked.mapInArrow(_records(3 + len(keys), limit), schema).withColumn(LINE, F.decode(LINE, encoding))
    whole = cut.where("__owner IS NULL").select(LINE, *keys)
    pieces = cut.where("__owner IS NOT NULL").groupBy(*keys, "__owner").agg(
        F.array_sort(F.collect_list(F.struct(START, LINE))).alias("x")
    )
    return whole.unionByName(pieces.select(F.array_join(F.transform("x", lambda e: e[LINE]), "\n").alias(LINE), *keys))
