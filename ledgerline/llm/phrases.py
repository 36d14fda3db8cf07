"""Phrase collocation mining by dynamic itemset counting.

The corpus is dealt into shards that are scanned in a circle, one shard a step. Phrases of
all lengths are counted side by side: words from the first step on; a longer phrase becomes
active at the step after both its subphrases (without its last and without its first word)
have been counted ``threshold`` times, and is counted from then on until it has seen every
shard once. Lengths interleave, so pairs are counted long before the words are done;
the scans end when no phrase is still in its circle. A phrase of at least ``threshold``
occurrences has subphrases of as many, so it becomes active, and its count is exact.

A step is one job over one shard. Tasks hash words and phrases of whole texts in numpy (64 bits,
seeded by language) and count them; a bitmap of fixed size per length (a few MB, whatever
the corpus) leaves out most phrases with an inactive subphrase, and a join of the
counts with the table of the phrases that reached the threshold decides exactly and gives
the step each phrase became active. Steps write their counts; the table of
reached phrases is an aggregation over the last circle of them, of the phrases that one of
its steps counted threshold / shards times (no other can have reached it). At the end the texts of the
phrases that stay are looked up in the corpus, in growing parts of it.

All results are per language. Scores are integers by decimal arithmetic of 38 digits. The best
phrases of a language are picked per salted part first, so no task sorts a language.

Defined results: NULL text has no words; NULL language is ``und``; no word or an empty table gives no
rows; repeated rows count as often as they occur; texts of any length are counted whole; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from .blocks import LOWER, Hasher, blocks, mix
from .shared import forget, release, settle, small, table

THRESHOLD = 30
LONGEST = 4
SHARDS = 3
BITMAP = 24  # bits of a hash that pick its place: 2 MB a bitmap
NARROW_ROWS = 2_000_000  # rows of two numbers that a broadcast may hold (about 50 MB); beyond it the join shuffles
ROUNDS = (0, 1, 8, 64, 512)  # parts of the corpus, in 512ths, that are searched for spellings one after the other
_FLUSH = 1 << 20
SCORE = "(CAST(2000000 AS DECIMAL(19,0)) * CAST(a AS DECIMAL(19,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"
_SALT = 32

_GAP = np.zeros(256, dtype=bool)
_GAP[list(b" \t.,;:!?\n\x0b\x0c\r")] = True
_BREAK = _GAP.copy()
_BREAK[list(b" \t")] = False
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _seed(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def _words(low: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, joined, text) of every word: ``joined[i]``: word i + 1 follows in the same piece."""
    n = len(low)
    cut = np.zeros(n + 1, dtype=bool)
    cut[off] = True
    gap = np.ones(n + 1, dtype=bool)
    gap[:n] = _GAP[low]
    before = np.ones(n + 1, dtype=bool)
    before[1:] = gap[:-1]
    start = np.flatnonzero(~gap[:n] & (before | cut)[:n])
    end = np.flatnonzero(~before[1:] & (gap[1:] | cut[1:])) + 1
    breaks = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(_BREAK[low], out=breaks[1:])
    text = np.searchsorted(off, start, side="right") - 1
    joined = (breaks[start[1:]] == breaks[end[:-1]]) & (text[1:] == text[:-1])
    return start, end, joined, text


def _hit(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = (h >> np.uint64(64 - BITMAP)).astype(np.int64)
    return (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0


def _phrases(batch: pa.RecordBatch, longest: int) -> Iterator[tuple]:
    """Per block of texts: bytes, word starts and ends, languages, language of each word, and for
    k = 1, 2, ... the phrase hashes and whether the k words are in one piece."""
    langs = [x if x is not None else "und" for x in batch.column(0).to_pylist()]
    names = sorted(set(langs))
    number = {x: i for i, x in enumerate(names)}
    codes = np.array([number[x] for x in langs], dtype=np.int64)
    seeds = np.array([_seed(x) for x in names], dtype=np.uint64)
    for first, data, off in blocks(batch.column(1)):
        low = LOWER[data]
        start, end, joined, text = _words(low, off)
        lang = codes[first + text]
        h = mix(Hasher(low).spans(start, end) + seeds[lang]) if len(start) else np.zeros(0, np.uint64)
        levels = [(h, np.ones(len(h), dtype=bool))]
        for k in range(2, longest + 1):
            h, whole = levels[-1]
            if len(h) < 2:
                break
            # the phrase's hash comes from its two subphrases
            levels.append((mix(h[:-1] * _STEP + h[1:] + np.uint64(k)), whole[:-1] & whole[1:] & joined[: len(h) - 1]))
        yield low, start, end, names, lang, levels


class _Counts:
    """Counts of one length, kept as arrays and handed out when there are many."""

    def __init__(self, k: int):
        self.k, self.parts, self.size = k, [], 0

    def add(self, h: np.ndarray, left: np.ndarray | None, right: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        self.parts.append((h, left, right))
        self.size += len(h)
        if self.size >= _FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        h = np.concatenate([p[0] for p in self.parts])
        if self.k == 1:
            u, count = np.unique(h, return_counts=True)
            sides = [pa.nulls(len(u), pa.int64())] * 2
        else:
            u, at, count = np.unique(h, return_index=True, return_counts=True)
            sides = [pa.array(np.concatenate([p[i] for p in self.parts])[at].view(np.int64)) for i in (1, 2)]
        self.parts, self.size = [], 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(u), self.k, np.int32)), pa.array(u.view(np.int64)), *sides, pa.array(count.astype(np.int64)), pa.nulls(len(u), pa.string())],
            names=["k", "h", "left", "right", "c", "lang"],
        )


COUNTS = "k int, h long, left long, right long, c long, lang string"


def _count(lengths: list[int], bitmaps):
    """Map function over (lang, text): counts of the words and phrases of ``lengths``, as far as the
    bitmaps do not rule them out; k = 0: words of each language. ``bitmaps``: broadcast {k: (reached, lately)}."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        maps = {k: tuple(np.frombuffer(b, np.uint8) for b in two) for k, two in bitmaps.value.items()}
        counts = {k: _Counts(k) for k in lengths}
        words: dict[str, int] = {}
        for batch in batches:
            for _, _, _, names, lang, levels in _phrases(batch, max(lengths)):
                for k in lengths:
                    if k > len(levels):
                        continue
                    h, whole = levels[k - 1]
                    if k == 1:
                        for name, n in zip(names, np.bincount(lang, minlength=len(names)).tolist()):
                            words[name] = words.get(name, 0) + n
                        yield from counts[1].add(h, None, None)
                        continue
                    sub = levels[k - 2][0]
                    reached, lately = (_hit(m, sub) for m in maps[k - 1])
                    at = np.flatnonzero(whole & reached[:-1] & reached[1:] & (lately[:-1] | lately[1:]))
                    yield from counts[k].add(h[at], sub[at], sub[at + 1])
        for c in counts.values():
            yield from c.flush()
        if words:
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * len(words), pa.int32()), *[pa.nulls(len(words), pa.int64())] * 3, pa.array(words.values(), pa.int64()), pa.array(words, pa.string())],
                names=["k", "h", "left", "right", "c", "lang"],
            )

    return run


def _spell(wanted, longest: int):
    """Map function over (lang, text): h, lang, phrase of the phrases whose place in the ``wanted`` bitmap of their length is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = {k: np.frombuffer(m, np.uint8) for k, m in wanted.value.items()}
        seen: set[int] = set()
        for batch in batches:
            for low, start, end, names, lang, levels in _phrases(batch, longest):
                if len(seen) > _FLUSH:
                    seen.clear()
                hs, ls, ps = [], [], []
                raw = low.tobytes()
                for k, (h, whole) in enumerate(levels, 1):
                    if k not in bitmaps:
                        continue
                    at = np.flatnonzero(whole & _hit(bitmaps[k], h))
                    u, i = np.unique(h[at], return_index=True)
                    for x, j in zip(u.tolist(), at[i].tolist()):
                        if x not in seen:
                            seen.add(x)
                            hs.append(x)
                            ls.append(names[lang[j]])
                            ps.append(b" ".join([raw[a:b] for a, b in zip(start[j : j + k].tolist(), end[j : j + k].tolist())]).decode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(hs, dtype=np.uint64).view(np.int64)), pa.array(ls, pa.string()), pa.array(ps, pa.string())],
                    names=["h", "lang", "phrase"],
                )

    return run


def _bitmaps(rows: DataFrame, lately: str) -> dict[int, tuple[bytes, bytes]]:
    """Per length k, the places of the column ``h`` of ``rows`` (k, h, reach) in bitmaps of fixed size: of all
    of them, and of those for which the condition ``lately`` holds (at most 2 ** BITMAP / 32768 rows a length come back)."""
    slot = F.shiftrightunsigned("h", 64 - BITMAP) + 1
    placed = rows.select("k", "reach", F.bitmap_bucket_number(slot).alias("b"), F.bitmap_bit_position(slot).alias("p"))
    both = [F.expr("bitmap_construct_agg(p)").alias("m"), F.expr(f"bitmap_construct_agg(p) FILTER (WHERE {lately})").alias("r")]
    size = 1 << (BITMAP - 3)
    out: dict[int, tuple[bytearray, bytearray]] = {}
    for k, bucket, *maps in placed.groupBy("k", "b").agg(*both).collect():
        for whole, part in zip(out.setdefault(k, (bytearray(size), bytearray(size))), maps):
            whole[(bucket - 1) * 4096 : bucket * 4096] = part
    return {k: tuple(map(bytes, two)) for k, two in out.items()}


def frequent(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(phrases: k, lang, phrase, f of every word and phrase of up to ``longest`` words that occurs ``threshold``
    times or more; totals: lang, n words) of ``docs`` (lang, text)."""
    spark = docs.sparkSession
    row = F.monotonically_increasing_id()
    slot = F.floor(row / shards) % ROUNDS[-1]
    corpus = settle(docs.select("lang", "text", slot.cast("int").alias("slot"), (row % shards).cast("int").alias("shard")), "shards", by="shard")
    reached, n_reached = spark.createDataFrame([], "k int, h long, reach int"), 0
    last = {0: 0}  # the last step at which a phrase of k words reached the threshold (words are active from the start)
    steps: list[DataFrame] = []
    often: list[DataFrame] = []  # phrases counted so often in one step that they may have reached the threshold in a circle
    n_often: list[int] = []
    step = 0
    while True:
        lengths = [k for k in range(1, longest + 1) if k - 1 in last and step <= last[k - 1] + shards - (k == 1)]
        if not lengths:
            break
        # a phrase both of whose subphrases reached the threshold long ago has seen every shard
        inner = reached.where(F.col("k").isin([k - 1 for k in lengths]))
        bitmaps = spark.sparkContext.broadcast(_bitmaps(inner, f"reach >= {step - shards}") if max(lengths) > 1 else {})
        rows = corpus.where(F.col("shard") == step % shards).select("lang", "text").mapInArrow(_count(lengths, bitmaps), COUNTS)
        known = small(reached.select("h", "reach"), n_reached, NARROW_ROWS)
        sides = [known.select(F.col("h").alias(s), F.col("reach").alias(f"{s}_reach")) for s in ("left", "right")]
        active = F.when(F.col("k") > 1, F.greatest("left_reach", "right_reach") + 1).otherwise(F.lit(0))
        both = F.col("left_reach").isNotNull() & F.col("right_reach").isNotNull()
        counted = (
            rows.join(sides[0], "left", "left").join(sides[1], "right", "left")
            .where((F.col("k") <= 1) | both).withColumn("active", active).where(F.col("active") + shards > step)
            .groupBy("k", "h", "lang").agg(F.sum("c").alias("c"))
        )
        steps.append(settle(counted, "counts"))
        bitmaps.destroy()
        # the last circle's counts (older ones are of phrases whose circle is over) of the phrases that one
        # of its steps counted threshold / shards times: others cannot have reached the threshold
        often.append(settle(steps[-1].where((F.col("k") > 0) & (F.col("c") * shards >= threshold)).select("h"), "often"))
        n_often.append(often[-1].count())
        at = slice(max(0, step - shards + 1), step + 1)
        circle = union(steps[at]).where("k > 0").join(small(union(often[at]), sum(n_often[at]), NARROW_ROWS), "h", "left_semi")
        new = circle.groupBy("k", "h").agg(F.sum("c").alias("c")).where(F.col("c") >= threshold).select("k", "h", F.lit(step).alias("reach"))
        before, reached = reached, settle(reached.unionByName(new).groupBy("k", "h").agg(F.min("reach").alias("reach")), "reached")
        n_reached = 0
        for k, at, n in reached.groupBy("k").agg(F.max("reach"), F.count("*")).collect():
            last[k] = at
            n_reached += n
        forget(before)
        step += 1
    every = union(steps)
    kept = every.join(small(reached.select("h"), n_reached, NARROW_ROWS), "h", "left_semi")
    sums = settle(kept.groupBy("k", "h").agg(F.sum("c").alias("f")), "frequent")
    spelled = _spelled(corpus, reached, n_reached, longest)
    spelled = sums.join(small(spelled, n_reached), "h")
    phrases = settle(spelled.select("k", "lang", "phrase", "f"), "phrases")
    totals = settle(every.where("k = 0").groupBy("lang").agg(F.sum("c").alias("n")), "totals")
    forget(corpus, reached, sums, *steps, *often)
    return phrases, totals


def union(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def _spelled(corpus: DataFrame, wanted: DataFrame, count: int, longest: int) -> DataFrame:
    """(h, lang, phrase) of the phrases ``wanted`` (k, h, reach), from growing parts of the corpus: a part is only
    searched for the phrases that the parts before do not have, so few occurrences of a phrase are written."""
    found = []
    for low, high in zip(ROUNDS, ROUNDS[1:]):
        maps = {k: two[0] for k, two in _bitmaps(wanted, "true").items()}
        if not maps:
            break
        bitmaps = corpus.sparkSession.sparkContext.broadcast(maps)
        part = corpus.where((F.col("slot") >= low) & (F.col("slot") < high)).select("lang", "text")
        rows = part.mapInArrow(_spell(bitmaps, longest), "h long, lang string, phrase string")
        rows = rows.join(small(wanted.select("h"), count, NARROW_ROWS), "h", "left_semi")
        found.append(settle(rows.groupBy("h").agg(F.min(F.struct("lang", "phrase")).alias("p")).select("h", "p.*"), "spelled"))
        bitmaps.destroy()
        wanted = settle(wanted.join(small(found[-1].select("h"), count, NARROW_ROWS), "h", "left_anti"), "unspelled")
    return union(found) if found else corpus.sparkSession.createDataFrame([], "h long, lang string, phrase string")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, shards: int = SHARDS, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` collocations of each language of ``docs`` (lang, text)."""
    phrases, totals = frequent(docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text"), threshold, longest, shards)
    count = phrases.count()
    words = F.split("phrase", " ")
    several = phrases.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), words.alias("w"))
    # every cut of a phrase, with the frequencies of its parts
    cuts = several.select("lang", "phrase", "k", "a", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    part = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    cuts = cuts.select(
        "lang", "phrase", "k", "a", "cut", part(F.lit(1), F.col("cut")).alias("head"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest")
    )
    known = phrases.select("lang", "phrase", "f")
    cuts = cuts.join(small(known.toDF("lang", "head", "l"), count), ["lang", "head"]).join(small(known.toDF("lang", "rest", "r"), count), ["lang", "rest"])
    lowest = cuts.withColumn("score", F.expr(SCORE)).groupBy("lang", "phrase", "k", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    # phrases that a longer one explains
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("k") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.col("k") - size + 1), lambda at: F.array_join(F.slice("w", at, size), " ")),
        )
    )
    longer = several.where("k > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("a").alias("in"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("in").alias("in"))
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    scored = lowest.join(longer, ["lang", "phrase"], "left").where(F.col("in").isNull() | (100 * exact("in") < 80 * exact("a")))
    scored = scored.select("lang", "phrase", "a", F.col("low.l").alias("l"), F.col("low.r").alias("r"), F.col("low.score").alias("score"))
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    salted = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(_SALT)))
    best = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


OP12_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p
  FROM documents
), s AS (
  SELECT lang, regexp_extract_all(unnest(p), '[^\x20\x09]+') AS w FROM d
), g AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM s, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)
), f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30
), n AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM s GROUP BY lang
), c AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM f WHERE k > 1
), q AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.cut, x.f AS l, y.f AS r,
         CAST((CAST(2000000 AS HUGEINT) * c.a) // (x.f + y.f) AS BIGINT) AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1 : cut], ' ')
         JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1 : c.k], ' ')
), m AS (
  SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), b AS (
  SELECT m.* FROM m WHERE NOT EXISTS (
    SELECT 1 FROM f z WHERE z.lang = m.lang AND z.k > m.k AND 100 * CAST(z.f AS HUGEINT) >= 80 * CAST(m.a AS HUGEINT)
      AND contains(' ' || z.phrase || ' ', ' ' || m.phrase || ' '))
)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n.n, score
FROM b JOIN n ON n.lang = b.lang
QUALIFY rank <= 2000
"""
