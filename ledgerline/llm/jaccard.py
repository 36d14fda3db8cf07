"""N-gram Jaccard join with token-combination prefixes.

A document's set holds the distinct hashes of its ``size``-word shingles; two
documents link when 100 * intersection >= percent * union. Documents with equal
sets are one class, so copies cost one row. All sets are ordered by hash, which
gives every set a prefix; with at most e own tokens missing from a linked set
(e = n - ceil(percent * n / 100)), a prefix of e + s tokens shares at least s of
them with the prefix of any set it links to.

1. Screening. Prefixes with s = 5 % of the set are indexed, tokens held by one
   class only are dropped, and a class with fewer than s tokens left links to
   nothing. The survivors are screened once more among themselves.
2. Whole sets of the survivors, screened once more: of the tokens of a linked set at
   least ceil(percent * n / 100) are held by another class. The classes that hold so many
   are counted again, and their tokens ordered by the number of these classes that hold
   them, so a passage that many unlike documents quote stands at the end of their sets.
3. The order by number gives shorter prefixes: of m tokens that others hold, the first
   m - ceil(percent * n / 100) + 1 have the first token that a linked pair shares. Rare
   tokens (held by at most ``RARE`` classes) of it are indexed singly. Where that first token
   is frequent, so are all shared ones: runs of two consecutive frequent tokens are indexed
   as combinations, in prefixes so long that the shared tokens of a linked pair outnumber the
   tokens that only one side has by two or more; two are neighbours on both sides then.
4. Candidates of short posting lists are pairs, filtered by size and verified on the
   sets. Combinations with long lists are not expanded: classes that share any are one
   bundle; a bundle is cut by set size, into steps of the factor 100 / percent, and by hash into blocks, and each
   pair of blocks of one step or of neighbouring ones is verified by matrix products in one task, which returns a spanning forest of
   its links, so a bundle of any size never meets in one task, and its pairs
   are never rows. Pairs of one bundle are verified there alone.

Components over the links and class membership give each document its smallest
reachable doc_id. No partner or candidate is capped.

Defined results: NULL or empty text, or text without words: empty set, linked
with nothing, its own component; a text with fewer words than ``size`` is one
shingle; repeated rows are members of one class; rows with NULL doc_id get a
NULL component and link nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .blocks import blocks, shingle_sets
from .components import components
from .mix import row_hash
from .shared import forget, free_names, handing_back, release, settle, small, table

RARE = 16
HAS_WORD = r"[^\x20\x09-\x0D]"
BLOCK_CLASSES = 512
BLOCK_TOKENS = 200_000
MAX_CELL_TASKS = 20_000
_COLUMNS = 4096


def _missing(n, percent: int):
    """Most tokens of a set of n that a linked set lacks."""
    return n - (percent * n + 99) // 100


def _signed(s: np.ndarray) -> np.ndarray:
    """In the order Spark compares them: as signed longs."""
    return np.sort(s.view(np.int64))


def _sets(size: int, percent: int, whole: bool):
    """Map function: (doc_id, h, text) -> doc_id, h, n, fp and the screening prefix or the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for first, data, off in blocks(batch.column(2)):
                ns, fps, tokens, lengths = [], [], [], []
                for s in shingle_sets(data, off, size):
                    s = _signed(s)
                    n = len(s)
                    ns.append(n)
                    fps.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if n else None)
                    kept = s if whole else s[: _missing(n, percent) + max(1, n // 20)]
                    tokens.append(kept)
                    lengths.append(len(kept))
                flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
                bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(ns)),
                        batch.column(1).slice(first, len(ns)),
                        pa.array(ns, pa.int64()),
                        pa.array(fps, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)),
                    ],
                    names=["doc_id", "h", "n", "fp", "tokens"],
                )

    return run


SET_SCHEMA = "doc_id long, h long, n long, fp binary, tokens array<long>"


def shingled(docs: DataFrame, size: int, percent: int, whole: bool) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
    return rows.mapInArrow(handing_back(_sets(size, percent, whole)), SET_SCHEMA)


def _part(df: DataFrame, own: DataFrame, rest: DataFrame, on: str | Column) -> DataFrame:
    """The rows of ``df`` that ``own`` names, where ``own`` and ``rest`` name every row: by a join with the shorter of them,
    so that wide rows stay where they are as long as one of them can be broadcast."""
    n_own, n_rest = own.count(), rest.count()
    return df.join(small(own, n_own), on, "left_semi") if n_own <= n_rest else df.join(small(rest, n_rest), on, "left_anti")


def _shared(tokens: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of t (a token) and c (how many classes hold it) for the tokens of more than one class."""
    # written, so that the shuffle of the counts is gone before the tokens are dealt out themselves
    return settle(tokens.groupBy("t").agg(F.count("*").alias("c")).where("c > 1").select(*columns), "shared", free=True)


def _screen(classes: DataFrame, heads: DataFrame, columns: list[str]) -> DataFrame:
    """``classes``: row, tokens; ``heads``: row, fp, n, rep. The ``columns`` of the classes with s tokens that another class
    holds too (s of the screening prefix); ``tokens`` are these. Tokens travel with the number of their row alone."""
    tokens = classes.select("row", F.explode("tokens").alias("t"))
    shared = _shared(tokens, "t")
    found = tokens.join(shared, "t").groupBy("row").agg(F.collect_list("t").alias("tokens"))
    enough = F.size("tokens") >= F.greatest(F.lit(1), F.floor(F.col("n") / 20))
    out = settle(found.join(heads, "row").where(enough).select(*columns), "screened", free=True)
    forget(shared)
    return out


def _block_links(percent: int):
    """Links of one pair of blocks, as the edges of a spanning forest."""

    def run(group: pa.Table) -> pa.Table:
        fps = group.column("fp").to_pylist()
        half = group.column("side").to_numpy()
        sets = group.column("tokens").combine_chunks()
        if isinstance(sets, pa.ChunkedArray):
            sets = sets.chunk(0)
        n = group.column("n").to_numpy()  # of the whole set; the tokens are those that others hold
        flat = sets.flatten().to_numpy()
        owner = np.repeat(np.arange(len(fps)), np.diff(sets.offsets.to_numpy()))
        _, token, count = np.unique(flat, return_inverse=True, return_counts=True)
        held = count[token] > 1
        owner, token = owner[held], np.unique(token[held], return_inverse=True)[1]
        overlap = np.zeros((len(fps), len(fps)), dtype=np.float32)
        order = np.argsort(token, kind="stable")
        owner, token = owner[order], token[order]
        for at in range(0, int(token[-1]) + 1 if len(token) else 0, _COLUMNS):
            a, b = np.searchsorted(token, [at, at + _COLUMNS])
            m = np.zeros((len(fps), _COLUMNS), dtype=np.float32)
            m[owner[a:b], token[a:b] - at] = 1
            overlap += m @ m.T
        inter = overlap.astype(np.int64)
        linked = 100 * inter >= percent * (n[:, None] + n[None, :] - inter)
        one = half.min() == half.max()
        linked &= np.triu(np.ones_like(linked), 1) if one else (half[:, None] < half[None, :])
        root = list(range(len(fps)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        a_out, b_out = [], []
        for x, y in zip(*(v.tolist() for v in np.nonzero(linked))):
            p, q = find(x), find(y)
            if p != q:
                root[p] = q
                a_out.append(fps[x])
                b_out.append(fps[y])
        return pa.table({"a": pa.array(a_out, pa.binary()), "b": pa.array(b_out, pa.binary())})

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    x = sets.select(F.col("fp").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("x"))
    y = sets.select(F.col("fp").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("y"))
    inter = F.size(F.array_intersect("x", "y"))
    both = pairs.join(x, "a").join(y, "b").select("a", "b", inter.alias("i"), (F.col("na") + F.col("nb")).alias("s"))
    return both.where(100 * F.col("i") >= percent * (F.col("s") - F.col("i"))).select("a", "b")


def _pairs(postings: DataFrame, key: str, percent: int) -> DataFrame:
    """All pairs of short posting lists that pass the size filter; a < b."""
    left = postings.select(key, F.col("fp").alias("a"), F.col("n").alias("na"))
    right = postings.select(key, F.col("fp").alias("b"), F.col("n").alias("nb"))
    met = left.join(right, key).where("a < b")
    return met.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b")


def links(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(membership: doc_id, h (hash of the text), n, fp of every row; links: a, b between classes). The links connect
    all classes that links connect; of a long posting list's links only a spanning forest is kept."""
    members = settle(shingled(docs, size, percent, whole=False).withColumn("row", F.monotonically_increasing_id()), "sets")
    rows = settle(members.select("doc_id", "h", "n", "fp"), "rows")
    # one row stands for its class; only the numbers of these rows are brought together, not the tokens
    usable = members.where("fp is not null and doc_id is not null")
    heads = settle(
        usable.groupBy("fp").agg(F.min(F.struct("doc_id", "row", "n")).alias("k")).select("k.row", "fp", "k.n", F.col("k.doc_id").alias("rep")), "heads"
    )
    others = settle(usable.select("row").join(heads.select("row"), "row", "left_anti"), "others")
    classes = _part(usable, heads.select("row"), others, "row").select("row", "tokens")
    # tables are deleted after their last reader: the prefixes of all rows are the largest of them
    first = _screen(classes, heads, ["row", "tokens"])
    forget(members, others)
    second = _screen(first, heads, ["fp", "n", "rep"])
    forget(first, heads)
    count = second.count()

    # whole sets of the survivors, from their texts
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wanted = small(second.select(F.col("rep").alias("doc_id")).distinct(), count)
    found = shingled(texts.join(wanted, "doc_id", "left_semi"), size, percent, whole=True)
    row = F.monotonically_increasing_id().alias("row")
    sets = settle(found.join(small(second.select("fp"), count), "fp", "left_semi").select("fp", "n", "tokens", row), "survivors", free=True)
    if sets.count() > count:  # rows that repeat both number and set: only then whole sets are brought together
        every = sets
        sets = every.groupBy("fp").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))
        sets = settle(sets.select("fp", "n", "tokens", row), "survivors", free=True)
        forget(every)
    forget(second)

    # of a linked set's tokens another class holds so many; here the tokens are counted alone, without being collected
    need = F.col("n") - _missing_sql(F.col("n"), percent)
    tokens = sets.select("row", F.explode("tokens").alias("t"))
    shared = _shared(tokens, "t")
    held = tokens.join(shared, "t").groupBy("row").agg(F.count("*").alias("m")).join(sets.select("row", "n"), "row")
    full = settle(held.where(F.col("m") >= need).select("row"), "screened", free=True)
    forget(shared)
    whole = settle(sets.join(small(full, full.count()), "row", "left_semi"), "whole", free=True)
    forget(sets, full)

    # in the order of the number of classes that hold them; the tokens that no other class holds any more go
    spread = whole.select("row", F.explode("tokens").alias("t"))
    held = _shared(spread, "t", "c")
    ordered = spread.join(held, "t").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("c", "t"))).alias("o"))
    m, k, either = F.size("o"), F.size(F.filter("o", lambda x: x["c"] <= RARE)), F.floor((100 - percent) * F.col("n") / percent)
    # neighbours among the frequent tokens; where a prefix cannot promise two, single tokens
    more = either + 2 if percent >= 75 else F.lit(1)
    length = F.least(m, m - need + more)
    indexed = settle(
        ordered.join(whole.select("row", "fp", "n"), "row").where(m >= need).select(
            "fp",
            "n",
            F.col("o.t").alias("tokens"),
            F.slice(F.col("o.t"), F.lit(1), F.least(k, m - need + 1).cast("int")).alias("rare"),
            F.slice(F.col("o.t"), k + 1, F.greatest(length - k, F.lit(0)).cast("int")).alias("frequent"),
        ),
        "prefixes",
        free=True,
    )
    forget(whole, held)
    sets = indexed.select("fp", "n", "tokens")
    f = F.col("frequent")
    couples = F.transform(F.slice(f, 2, F.greatest(F.size(f) - 1, F.lit(0))), lambda t, i: F.xxhash64(F.get(f, i), t))
    postings = indexed.where(F.size(f) > 0).select("fp", "n", F.explode(couples if percent >= 75 else f).alias("key"))
    lengths = postings.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    postings = settle(postings.join(lengths, "key"), "combinations", free=True)
    bundles = components_of_keys(postings.where(F.col("c") > RARE))
    by_token = _pairs(indexed.select("fp", "n", F.explode("rare").alias("t")), "t", percent)
    by_couple = _pairs(postings.where(F.col("c") <= RARE), "key", percent)
    pairs = by_token.unionByName(by_couple).distinct()
    if bundles is not None:
        one, other = (bundles.select(F.col("fp").alias(x), F.col("bundle").alias(f"of_{x}")) for x in "ab")
        apart = ~F.coalesce(F.col("of_a") == F.col("of_b"), F.lit(False))
        pairs = pairs.join(one, "a", "left").join(other, "b", "left").where(apart).select("a", "b")
    # one after the other, each with its shuffles gone before the next
    pairs = settle(pairs, "pairs", free=True)
    forget(postings)
    out = settle(_verified(pairs, sets, percent), "links", free=True)
    forget(pairs)

    if bundles is not None:
        # sets of linked classes differ in size by the factor 100 / percent at most, so a class meets those of its own
        # size step and of the next ones only (the step is a little wider, against rounding)
        step = F.floor(F.log("n") / (math.log(100 / percent) * 1.0001)).cast("int") if percent < 100 else F.col("n").cast("int")
        held = bundles.join(sets, "fp").withColumn("step", step)
        loads = held.groupBy("bundle", "step").agg(F.count("*").alias("classes"), F.sum("n").alias("load"))
        n_blocks = F.ceil(F.greatest(F.col("classes") / BLOCK_CLASSES, F.col("load") / BLOCK_TOKENS)).cast("int")
        # at most a few hundred steps a bundle
        order = Window.partitionBy("bundle").orderBy("step")
        near = lambda f, way: F.when(f("step").over(order) == F.col("step") + way, f("blocks").over(order)).otherwise(F.lit(0))
        loads = settle(
            loads.select("bundle", "step", n_blocks.alias("blocks")).withColumns({"above": near(F.lead, 1), "below": near(F.lag, -1)}), "blocks"
        )
        placed = held.join(loads, ["bundle", "step"]).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        mine = F.col("block")

        def cells_with(count: str, cell: Callable[[Column], list[Column]]) -> Column:
            names = ("low", "i", "high", "j", "side")
            others = F.when(F.col(count) > 0, F.sequence(F.lit(0), F.col(count) - 1)).otherwise(F.array().cast("array<int>"))
            return F.transform(others, lambda y: F.struct(*(c.cast("int").alias(x) for c, x in zip(cell(y), names))))

        here = F.col("step")
        # the cell of a block with itself has it once: `y` takes its number once
        met = F.concat(
            cells_with("blocks", lambda y: [here, F.least(mine, y), here, F.greatest(mine, y), mine]),
            cells_with("above", lambda y: [here, mine, here + 1, y, F.lit(0)]),
            cells_with("below", lambda y: [here - 1, y, here, mine, F.lit(1)]),
        )
        cells = placed.select("bundle", "fp", "n", "tokens", F.explode(met).alias("cell")).select("bundle", "cell.*", "fp", "n", "tokens")
        # cells are dealt by their number, as partitions sized by compressed bytes would put many into one task
        pairs_of = F.col("blocks").cast("long") * (F.col("blocks") + 1) / 2 + F.col("blocks").cast("long") * F.col("above")
        n_cells = int(loads.agg(F.coalesce(F.sum(pairs_of), F.lit(0))).first()[0])
        key = ["bundle", "low", "i", "high", "j"]
        dense = cells.repartition(max(1, min(n_cells, MAX_CELL_TASKS)), *key).groupBy(*key).applyInArrow(_block_links(percent), "a binary, b binary")
        out = out.unionByName(settle(dense, "dense-links", free=True))
        forget(loads)
    forget(indexed)
    return rows, out.distinct()


def _missing_sql(n, percent: int):
    return n - F.ceil(percent * n / 100).cast("long")


def components_of_keys(postings: DataFrame) -> DataFrame | None:
    """(fp, bundle): classes joined by shared keys; None without keys."""
    edges = postings.select(
        F.col("fp").alias("a"), F.unhex(F.lpad(F.hex("key"), 16, "0")).alias("b")  # 8 bytes: never equal to a 16-byte class
    )
    if edges.isEmpty():
        return None
    return components(edges).where(F.length("node") == 16).select(F.col("node").alias("fp"), F.col("component").alias("bundle"))


def _labelled(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Every row's doc_id, h, n and class label; NULL label for rows that link nothing."""
    rows, linked = links(docs, size, percent)
    groups = components(linked).withColumnRenamed("node", "fp")
    label = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "fp"))
    return rows.join(groups, "fp", "left").select("doc_id", "h", "n", label.alias("label"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``."""
    labelled = _labelled(docs, size, percent)
    smallest = labelled.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    return labelled.join(smallest, "label", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id, then text hash, then hash of the other columns.
    Rows that link nothing (no words, NULL doc_id) stay. Columns stay as they are, whatever their names."""
    labelled = settle(_labelled(docs, size, percent), "labelled")
    first = labelled.where("label is not null").groupBy("label").agg(F.min(F.struct("doc_id", "h")).alias("k")).select("k.*")
    # how many rows repeat the kept one: only those need to be brought together
    rows = labelled.where("label is not null").groupBy("doc_id", "h").agg(F.count("*").alias("k"))
    keys = first.join(rows, ["doc_id", "h"])
    single = settle(keys.where("k = 1").select("doc_id", "h"), "kept")
    many = settle(keys.where("k > 1").select("doc_id", "h"), "kept-of-many")
    rest = settle(rows.select("doc_id", "h").join(single, ["doc_id", "h"], "left_anti"), "not-kept")
    apart = F.col("doc_id").isNull() | ~F.coalesce(F.col("text").rlike(HAS_WORD), F.lit(False))
    i, k, h, r, n = free_names(docs, "id", "key", "hash", "rest", "nth")
    alone, others = docs.where(apart), docs.where(~apart).withColumn(h, F.xxhash64("text"))

    def named(part: DataFrame) -> DataFrame:
        return part.select(F.col("doc_id").alias(i), F.col("h").alias(k))

    on = (F.col("doc_id") == F.col(i)) & (F.col(h) == F.col(k))
    # single and rest name every row of the others; the texts stay where they are while one of them can be broadcast
    once = _part(others, named(single), named(rest), on)
    repeated = others.join(small(named(many), many.count()), on, "left_semi")
    # rows equal in all columns are interchangeable
    nth = F.row_number().over(Window.partitionBy("doc_id", h).orderBy(r))
    one = repeated.withColumn(r, row_hash(docs, "text")).withColumn(n, nth).where(F.col(n) == 1)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return alone.unionByName(once.select(*columns)).unionByName(one.select(*columns))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), size=4, percent=85)


OP4_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
           WHEN len(w) < 4 THEN [array_to_string(w, chr(10))]
           ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], chr(10))) END) AS g
  FROM d
), n AS (
  SELECT doc_id, CAST(len(g) AS BIGINT) AS n FROM s
), t AS MATERIALIZED (
  SELECT doc_id, md5_number(unnest(g)) AS t FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM t a JOIN t b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS MATERIALIZED (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)
), e AS MATERIALIZED (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
)
SELECT n.doc_id, n.n AS n_shingles, c.component_id
FROM n JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = n.doc_id
"""
