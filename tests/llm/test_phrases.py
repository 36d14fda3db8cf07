import random
import re
from collections import Counter

from ledgerline.llm import phrases as P

from .helpers import docs

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
LOWER = {i: i + 32 for i in range(65, 91)}


def grams(rows, longest=4):
    """Counter of (lang, words) and words per language, by brute force."""
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    return f, n


def brute(rows, threshold=30, longest=4, top=2000):
    f, n = grams(rows, longest)
    often = {g: c for g, c in f.items() if c >= threshold}
    by = {}
    for (lang, w), a in often.items():
        if len(w) < 2:
            continue
        score, cut = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        inside = any(
            z == lang and len(v) > len(w) and 100 * c >= 80 * a and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))
            for (z, v), c in often.items()
        )
        if not inside:
            by.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), " ".join(w), a, f[lang, w[:cut]], f[lang, w[cut:]], score))
    out = []
    for lang, found in by.items():
        for rank, (_, _, _, phrase, a, l, r, score) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase, a, l, r, n[lang], score))
    return sorted(out)


def run(spark, rows, shards=2, **options):
    df = docs(spark, [(i, t, lang) for i, t, lang in rows]).select("lang", "text")
    return sorted(tuple(r[c] for c in COLUMNS) for r in P.collocations(df.repartition(3), shards=shards, **options).collect())


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["of", "the", "And", "Zürich", "naïve", "x1", "sea", "salt", "in", "law"]
    fixed = ["New York City", "as well as the", "in the law", "sea salt"]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(0, 12)):
            parts.append(rng.choice(fixed) if rng.random() < 0.4 else " ".join(rng.choices(words, k=rng.randrange(1, 6))))
        out.append((i, rng.choice([" ", ". ", ",", "\n", "\t"]).join(parts), rng.choice(["en", "en", "de", None])))
    return out


def test_equals_brute_force_at_any_number_of_shards(spark):
    rows = corpus(1, 150)
    want = brute(rows, threshold=4)
    assert len(want) > 30
    for shards in (1, 3):
        assert run(spark, rows, threshold=4, shards=shards) == want


def test_counts_of_phrases_that_reach_the_threshold_late(spark):
    # the words are frequent only in the last rows, so their phrases become active in the second circle
    rows = [(i, "early bird catches the worm", "en") for i in range(3)] + [(9 + i, f"rare{i}", "en") for i in range(40)]
    rows += [(100 + i, "early bird catches the worm. bird catches", "en") for i in range(9)]
    assert run(spark, rows, threshold=10, shards=5) == brute(rows, threshold=10)


def test_overlaps_pieces_and_repeated_rows(spark):
    rows = [(1, "a a a a a a", "en")] * 8 + [(2, "a b,a b;a\nb.a\tb a  b", "en")] * 5
    assert run(spark, rows, threshold=5) == brute(rows, threshold=5)


def test_top_and_ties(spark):
    rows = [(i, " . ".join(f"p{j} q{j}" for j in range(30)), "en") for i in range(4)]
    want = brute(rows, threshold=4, top=7)
    assert len(want) == 7 and run(spark, rows, threshold=4, top=7) == want


def test_nulls_empty_long(spark):
    rows = [(1, None, None), (2, "", "en"), (3, " \t ,.", None), (None, "one two " * 40_000, None), (5, "y" * 300_000, "en")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == run(spark, [(1, None, None)], shards=1) == []


def test_clashing_columns(spark):
    df = spark.createDataFrame([("en", "to be or not", 1, "z", 2)] * 6, "lang string, text string, h int, phrase string, shard int")
    got = {r["phrase"]: r["a"] for r in P.collocations(df, threshold=5, shards=2).collect()}
    assert got == {"to be or not": 6}


def test_scores_beyond_64_bits(spark):
    a = 9_000_000_000_000_000
    df = spark.createDataFrame([(a, a, a + 1)], "a long, l long, r long")
    from pyspark.sql import functions as F

    got = df.select(F.expr(P.SCORE).alias("s")).first()["s"]
    assert got == 2000000 * a // (2 * a + 1)
