import hashlib

from ledgerline.llm import lines as L

from .helpers import docs

SPACES = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=20, min_docs=3):
    """(doc_id, n_lines, n_dropped, sha) per row of (doc_id, text)."""
    lower = str.maketrans({i: i + 32 for i in range(65, 91)})
    key = lambda s: s.strip(SPACES).translate(lower)
    split = [(i, (t or "").split("\n")) for i, t in rows]
    held = {}
    for i, ls in split:
        for line in ls:
            if len(key(line)) >= min_chars:
                held.setdefault(key(line), set()).add(i)
    rank = lambda i: (i is not None, i or 0)
    last = {k: max(v, key=rank) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for i, ls in split:
        kept = [x for x in ls if key(x) not in last or last[key(x)] == i]
        out.append((i, len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def run(df):
    from pyspark.sql import functions as F

    out = L.drop_lines(df).select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("s"))
    return sorted(map(tuple, out.collect()), key=repr)


def test_rules(spark):
    common = "All rights reserved by nobody."
    rows = [
        (1, f"one\n{common}\nend"),
        (2, f"  {common.upper()}\t\ntwo"),
        (3, f"{common}\r\n{common}\nthree\n"),
        (4, "short line\nshort line"),
        (5, "short line\n" + "é" * 20 + "\n" + "ß" * 19),
        (6, "é" * 20 + "\n" + "ß" * 19),
        (7, "É" * 20 + "\n" + "é" * 20 + "\n" + "ß" * 19),
        (8, f"{common}"),
        (9, "two of them only, not three"),
        (10, "two of them only, not three"),
    ]
    assert run(docs(spark, rows)) == brute(rows)


def test_nulls_repeats_empty_long(spark):
    a, b = "a line that everybody has had", "another line that is quite common"
    rows = [(None, a), (None, a + "\n" + b), (1, None), (2, ""), (3, a), (3, a), (4, a + "\n\n" + a), (5, "\n".join([a, b] * 4000 + ["x" * 200_000]))]
    rows += [(6, b), (7, b), (7, b + "\nrest"), (8, "\n" * 50)]
    assert run(docs(spark, rows)) == brute(rows)
    # two documents on many rows are two documents
    twice = [(1, a)] * 5 + [(2, a)] * 5
    assert run(docs(spark, twice)) == brute(twice)
    assert all(r[2] == 0 for r in brute(twice))


def test_null_stays_null_and_other_columns_stay(spark):
    a = "a line that everybody has had"
    df = spark.createDataFrame(
        [(i, a if i else None, "k", 1, i, "z") for i in range(5)], "doc_id long, text string, id string, t1 int, at int, n_dropped string"
    )
    out = L.drop_lines(df)
    assert out.columns == ["doc_id", "text", "id", "t1", "at", "n_lines", "n_dropped"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[0]["text"] is None and rows[0]["n_lines"] == 1
    assert [rows[i]["text"] for i in (1, 2, 3, 4)] == ["", "", "", a]
    assert rows[2]["id"] == "k" and rows[2]["at"] == 2


def test_empty_table(spark):
    assert L.drop_lines(docs(spark, [])).collect() == []


def test_half_of_the_rows_share_a_line(spark):
    hot = "This very line is in every second text."
    rows = [(i, f"{hot}\nown {i}" if i % 2 else f"just {i}, which is long enough") for i in range(400)]
    assert run(docs(spark, rows)) == brute(rows)
