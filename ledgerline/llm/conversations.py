"""Conversation structure repair by dynamic programming over scalar big-integer weights.

The rows of a conversation, in order, are edited at least cost so that the initials of the
roles read ``(s?(ua)+)?``; among the cheapest edits the ASCII-least string of their
initials (the audit: Delete, Insert, Keep, Rerole) wins. One integer says both: its high
digits are the cost, its low digits the audit letters at fixed width, first letter
highest, with zero end padding, so the integer minimum is the answer. Working
backwards, an edit in front of a tail adds its cost and shifts the tail's letters
down by one digit.

Conversations have no bound, so a task takes ``SEGMENT`` rows at most. A segment is a
4 x 4 table (state before, state after) of such integers. All edit strings of a segment end in the
edit of its last row and hold one such edit for each row, so none is a proper prefix of
another, and a choice inside a segment never depends on what follows. Between segments
only costs and the order of the segment's strings matter: 16 small costs and ranks each,
which are chained per conversation.

1. Rows are sorted by (conversation, turn with NULL first, role, text hash) over range
   partitions, numbered and written; a hot conversation spans many partitions.
2. A row whose (role, text) its conversation had before: first number per
   (conversation, role, text hashes), with map-side combine.
3. Rows become one letter each (role initial and fault), segments strings of letters; the
   strings' tables, then the chain per conversation (1 / SEGMENT of its rows), then the
   edits per segment.
4. The edits meet the written rows by segment.

Two inserts in a row are never part of a cheapest repair (leaving both out, or deleting
the system row before them, is cheaper), so one per place is allowed.

Defined results: NULL conv_id is a conversation of its own; NULL role and NULL text are one space;
a NULL turn comes first and counts for no gap; an empty or unknown role fits nowhere (it is reroled or
deleted); repeated rows are duplicates of the first one; rows of one turn follow role and text hash; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import SPACES, has_nonspace, settle, table

SEGMENT = 256
STOPS = "[.!?]"

_D, _I, _K, _R = "DIKR"  # in ASCII order
_CODE = {c: i + 1 for i, c in enumerate("DIKR")}  # 0 is the padding
_BITS = 3
#: States: 0 nothing written, 1 after s, 2 after u, 3 after a. Role that may come next, and the state after it.
_NEXT = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}
_INITIALS = "sua-"
OK, BLANK, DUPLICATE, TRUNCATED = range(4)


def letter(initial: str, fault: int) -> str:
    return chr(65 + 4 * _INITIALS.index(initial) + fault)


def _read(symbol: str) -> tuple[str, int]:
    k = ord(symbol) - 65
    return _INITIALS[k // 4], k % 4


def _moves(initial: str, fault: int, q: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after) of every edit of a row at state q."""
    out = [(_D, 2, q)]
    if fault in (BLANK, DUPLICATE):
        return out
    extra = 5 if fault == TRUNCATED else 0
    role, after = _NEXT[q]
    if initial == role:
        out.append((_K, extra, after))
    elif initial == "s" and q == 0:
        out.append((_K, extra, 1))
    out.append((_R, 1 + extra, after))
    return out


_MOVES = {(letter(i, f), q): _moves(i, f, q) for i in _INITIALS for f in range(4) for q in range(4)}


@functools.lru_cache(maxsize=20_000)
def segment(symbols: str) -> tuple[tuple[tuple[int | None, int, str], ...], ...]:
    """[before][after] -> (cost, rank among the table's strings, edits); cost None where there is no way."""
    width = _BITS * (2 * len(symbols))  # a row's edit and at most one insert before it
    mask = (1 << width) - 1
    top = {c: code << (width - _BITS) for c, code in _CODE.items()}

    def prepend(c: str, cost: int, tail: int) -> int:
        low = tail & mask
        return tail - low + (cost << width) + top[c] + (low >> _BITS)

    ends = []
    for end in range(4):
        value: list[int | None] = [0 if q == end else None for q in range(4)]
        for symbol in reversed(symbols):
            row = []
            for q in range(4):
                ways = [prepend(c, cost, value[to]) for c, cost, to in _MOVES[symbol, q] if value[to] is not None]
                row.append(min(ways) if ways else None)
            value = []
            for q in range(4):
                inserted = row[_NEXT[q][1]]
                ways = [w for w in (row[q], None if inserted is None else prepend(_I, 5, inserted)) if w is not None]
                value.append(min(ways) if ways else None)
        ends.append(value)
    lows = sorted({v & mask for column in ends for v in column if v is not None})
    rank = {low: k for k, low in enumerate(lows)}
    out = []
    for q in range(4):
        line = []
        for p in range(4):
            v = ends[p][q]
            line.append((None, 0, "") if v is None else (v >> width, rank[v & mask], _letters(v & mask, width)))
        out.append(tuple(line))
    return tuple(out)


def _letters(low: int, width: int) -> str:
    out = []
    at = width - _BITS
    while at >= 0:
        code = (low >> at) & 7
        if not code:
            break
        out.append("DIKR"[code - 1])
        at -= _BITS
    return "".join(out)


def chain(tables: list[tuple[list[int], list[int]]]) -> tuple[int, list[tuple[int, int]], str]:
    """Cost of the best way through the segments' (costs, ranks; 16 each, -1 for no way), the states
    before and after each segment, and the letters after the last one."""
    # after the last row: nothing more, or the answer that a user turn lacks
    costs: list[int | None] = [0, None, 5, 0]
    ranks = [0, 0, 1, 0]
    choices = []
    for cost, rank in reversed(tables):
        best = []
        for q in range(4):
            ways = [
                (cost[4 * q + p] + costs[p], rank[4 * q + p], ranks[p], p)
                for p in range(4)
                if cost[4 * q + p] >= 0 and costs[p] is not None
            ]
            best.append(min(ways) if ways else None)
        order = {k: i for i, k in enumerate(sorted({b[1:3] for b in best if b}))}
        choices.append([b[3] if b else 0 for b in best])
        costs = [b[0] if b else None for b in best]
        ranks = [order[b[1:3]] if b else 0 for b in best]
    states, q = [], 0
    for choice in reversed(choices):
        states.append((q, choice[q]))
        q = choice[q]
    return costs[0], states, "I" if q == 2 else ""


def row_edits(symbols: str, before: int, edits: str) -> tuple[list[str], int]:
    """Per row, its inserts and its edit, like ``IuK``, ``D`` or ``Ra``; and the state after the last."""
    out, q, rows = [], before, iter(symbols)
    text = ""
    for c in edits:
        if c == _I:
            role, q = _NEXT[q]
            text += "I" + role
            continue
        initial, _ = _read(next(rows))
        if c == _K:
            q = 1 if initial == "s" else _NEXT[q][1]
            text += c
        elif c == _R:
            role, q = _NEXT[q]
            text += c + role
        else:
            text += c
        out.append(text)
        text = ""
    return out, q


# ---------------------------------------------------------------- Spark


def conversation_key(conv_id: Column) -> Column:
    """A string that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def damaged(rows: DataFrame) -> DataFrame:
    """conv, turn, role, text of ``rows`` (conv_id, turn, role, text) after the fixed damage of the test query."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    marked = rows.select(
        conversation_key(F.col("conv_id")).alias("conv"), F.col("turn").cast("long").alias("turn"),
        spaced("role").alias("role"), spaced("text").alias("text"), fate.alias("fate"),
    ).where("fate <> 0")
    f = F.col("fate")
    text = F.when(f == 1, F.lit("")).when(f == 2, F.regexp_replace("text", STOPS, "")).otherwise(F.col("text"))
    copies = F.explode(F.when(f == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return marked.select("conv", "turn", F.when(f == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), copies).drop("copy")


def ordered(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """``rows`` (conv, turn, role, text) with ``at``, their number in the order of the whole table, and hashes
    h1, h2 of the text. Equal rows are told apart by their place in the input, so they spread as well.
    ``partitions``: number of ranges; by default the session's, which Spark merges by measured size."""
    hashed = rows.select(
        "conv", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    ).withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text"), "place": F.monotonically_increasing_id()})
    keys = ["conv", F.col("turn").asc_nulls_first(), "role", "h1", "h2", "place"]
    dealt = hashed.repartitionByRange(*([partitions] if partitions else []), *keys).sortWithinPartitions(*keys).drop("place")
    return settle(dealt.withColumn("at", F.monotonically_increasing_id()), "turns")


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        costs, ranks, counts = [], [], []
        for symbols in batch.column("symbols").to_pylist():
            cells = [c for line in segment(symbols) for c in line]
            costs.append([-1 if c[0] is None else c[0] for c in cells])
            ranks.append([c[1] for c in cells])
            read = [_read(s) for s in symbols]
            faults = [f for _, f in read]
            pairs = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(read, read[1:]))
            counts.append([faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), pairs])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv"), batch.column("first"),
                pa.array(costs, pa.list_(pa.int64())), pa.array(ranks, pa.list_(pa.int32())),
                pa.array(counts, pa.list_(pa.int64())), pa.array([s[0] + s[-1] for s in batch.column("symbols").to_pylist()], pa.string()),
            ],
            names=["conv", "first", "costs", "ranks", "counts", "ends"],
        )


_CHAINED = "conv string, blank long, duplicate long, truncated long, illegal long, cost long, tail string, ways array<struct<first:bigint,before:int,after:int>>"


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "tail", "ways"]
    ways = pa.list_(pa.struct([("first", pa.int64()), ("before", pa.int32()), ("after", pa.int32())]))
    types = [pa.string(), *[pa.int64()] * 5, pa.string(), ways]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for conv, parts in zip(batch.column("conv").to_pylist(), batch.column("parts").to_pylist()):
            cost, states, tail = chain([(p["costs"], p["ranks"]) for p in parts])
            sums = [sum(p["counts"][k] for p in parts) for k in range(4)]
            for a, b in zip(parts, parts[1:]):
                sums[3] += _read(a["ends"][1])[0] + _read(b["ends"][0])[0] not in ("su", "ua", "au")
            way = [{"first": p["first"], "before": a, "after": b} for p, (a, b) in zip(parts, states)]
            for column, value in zip(out, [conv, *sums, cost, tail, way]):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        audit, rows = [], []
        columns = [batch.column(c).to_pylist() for c in ("symbols", "before", "after")]
        for symbols, before, after in zip(*columns):
            audit.append(segment(symbols)[before][after][2])
            rows.append(row_edits(symbols, before, audit[-1])[0])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("first"), pa.array(audit, pa.string()), pa.array(rows, pa.list_(pa.string()))],
            names=["conv", "first", "audit", "edits"],
        )


def repair(rows: DataFrame, partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(report, repaired) of ``rows`` (conv, turn, role, text; conv a string without NULL).

    report: conv, gaps, blank, duplicate, truncated, illegal, cost, audit. repaired: conv, at, nth, role, text;
    the repaired rows of a conversation ordered by (at, nth).
    """
    turns = ordered(rows, partitions)
    first = turns.groupBy("conv", "role", "h1", "h2").agg(F.min("at").alias("seen"))
    stripped = F.rtrim("text", F.lit(SPACES))
    faults = turns.select(
        "conv", "role", "h1", "h2", "at",
        F.when(~has_nonspace(F.col("text")), F.lit(BLANK)).when(~F.right(stripped, F.lit(1)).rlike(STOPS), F.lit(TRUNCATED)).otherwise(F.lit(OK)).alias("fault"),
    )
    fault = F.when((F.col("fault") != BLANK) & (F.col("at") > F.col("seen")), F.lit(DUPLICATE)).otherwise(F.col("fault"))
    initial = F.instr(F.lit("sua"), F.when(F.col("role") != "", F.left("role", F.lit(1))).otherwise(F.lit("-")))
    order = F.when(initial > 0, initial - 1).otherwise(F.lit(3))
    symbol = F.char(F.lit(65) + 4 * order + fault)
    lettered = faults.join(first, ["conv", "role", "h1", "h2"]).select("conv", "at", symbol.alias("symbol"))
    block = F.expr(f"at div {SEGMENT}")
    parts = lettered.groupBy("conv", block.alias("block")).agg(F.array_sort(F.collect_list(F.struct("at", "symbol"))).alias("x"))
    parts = settle(
        parts.select("conv", F.col("x")[0]["at"].alias("first"), "block", F.array_join(F.transform("x", lambda e: e["symbol"]), "").alias("symbols")),
        "segments",
    )
    tables = parts.select("conv", "first", "symbols").mapInArrow(
        _tables, "conv string, first long, costs array<long>, ranks array<int>, counts array<long>, ends string"
    )
    grouped = tables.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("first", "costs", "ranks", "counts", "ends"))).alias("parts"))
    chained = settle(grouped.mapInArrow(_chained, _CHAINED), "repairs")
    ways = chained.select("conv", F.explode("ways").alias("w")).select("conv", "w.first", "w.before", "w.after")
    edits = settle(
        parts.join(ways, ["conv", "first"]).select("conv", "first", "symbols", "before", "after").mapInArrow(
            _edits, "conv string, first long, audit string, edits array<string>"
        ),
        "edits",
    )
    audits = edits.groupBy("conv").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "audit"))), lambda e: e["audit"]), "").alias("audit"))
    span = turns.select("conv", "turn").distinct().groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")
    )
    report = chained.drop("ways").join(audits, "conv").join(span, "conv").select(
        "conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", F.concat("audit", "tail").alias("audit")
    )
    # rows and their edits, by segment
    plan = edits.select("conv", "first", "edits", F.expr(f"first div {SEGMENT}").alias("block"))
    met = turns.withColumn("block", block).join(plan, ["conv", "block"])
    edit = F.get("edits", (F.col("at") - F.col("first")).cast("int"))
    return report, _applied(met.select("conv", "at", "role", "text", edit.alias("edit")), chained)


def _applied(rows: DataFrame, chained: DataFrame) -> DataFrame:
    """Repaired rows of (conv, at, role, text, edit)."""
    named = lambda c: F.when(c == "u", F.lit("user")).otherwise(F.lit("assistant"))
    e = F.col("edit")
    inserted = F.when(e.startswith("I"), F.array(F.struct(named(F.substring(e, 2, 1)).alias("role"), F.lit("").alias("text"))))
    own = F.when(e.endswith("K"), F.array(F.struct("role", "text"))).when(
        e.rlike("R[ua]$"), F.array(F.struct(named(F.right(e, F.lit(1))).alias("role"), F.col("text").alias("text")))
    )
    none = F.array().cast(T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])))
    both = F.concat(F.coalesce(inserted, none), F.coalesce(own, none))
    out = rows.select("conv", "at", F.posexplode(both).alias("nth", "o")).select("conv", "at", "nth", "o.role", "o.text")
    tail = chained.where("tail <> ''").select(
        "conv", F.lit((1 << 63) - 1).alias("at"), F.lit(0).alias("nth"), F.lit("assistant").alias("role"), F.lit("").alias("text")
    )
    return out.unionByName(tail)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of ``role:text`` lines of each conversation; the rows come in order and are streamed."""
    key, digest = None, None
    schema = pa.schema([("conv", pa.string()), ("sha", pa.string())])
    for batch in batches:
        out = []
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text"))):
            if conv != key:
                if key is not None:
                    out.append((key, digest.hexdigest()))
                key, digest = conv, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], schema=schema)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], schema=schema)


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(table(spark, sf_dir, "conversations"))


def repair_report(conversations: DataFrame) -> DataFrame:
    """The query's columns for every conv_id of ``conversations``: report of the damaged rows and digest of the
    repaired ones. A digest runs over all text of its conversation, so that is streamed through one
    task; nothing is held but the hash."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    report, repaired = repair(damaged(rows))
    streams = repaired.repartition("conv").sortWithinPartitions("conv", "at", "nth").select("conv", "role", "text")
    shas = streams.mapInArrow(_digests, "conv string, sha string")
    every = rows.select("conv_id").distinct().withColumn("conv", conversation_key(F.col("conv_id")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return every.join(report, "conv", "left").join(shas, "conv", "left").select(
        "conv_id", *(zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
