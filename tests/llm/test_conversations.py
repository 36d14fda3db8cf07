import hashlib
import itertools
import random
import re
import zlib

from pyspark.sql import functions as F

from ledgerline.llm import conversations as C

SF = "/root/testdata/sf0.001"
ROWS = "conv_id long, turn long, role string, text string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        if not BLANK.search(text):
            out.append(C.BLANK)
        elif (role, text) in seen:
            out.append(C.DUPLICATE)
        elif BLANK.findall(text)[-1] not in ".!?":
            out.append(C.TRUNCATED)
        else:
            out.append(C.OK)
        seen.add((role, text))
    return out


def brute(rows):
    """(cost, audit, repaired) of (role, text) rows by trying every sequence of edits, two inserts a place."""
    faults = faults_of(rows)
    best = None
    inserts = ["", "u", "a", "ua", "au"]
    word = {"u": "user", "a": "assistant"}

    def go(i, cost, audit, out):
        nonlocal best
        if best and cost > best[0]:
            return
        for put in inserts:
            c, a = cost + 5 * len(put), audit + "I" * len(put)
            o = out + [(word[x], "") for x in put]
            if i == len(rows):
                if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in o)) and (best is None or (c, a) < best[:2]):
                    best = (c, a, o)
                continue
            role, text = rows[i]
            go(i + 1, c + 2, a + "D", o)
            if faults[i] in (C.OK, C.TRUNCATED):
                more = 5 * (faults[i] == C.TRUNCATED)
                go(i + 1, c + more, a + "K", o + [(role, text)])
                for x in "ua":
                    go(i + 1, c + 1 + more, a + "R", o + [(word[x], text)])

    go(0, 0, "", [])
    return best


def linear(rows):
    """The same by a table over (row, state) that keeps whole strings, for long conversations."""
    faults = faults_of(rows)
    best = {0: (0, ""), 1: None, 2: (5, "I"), 3: (0, "")}
    for (role, _), fault in reversed(list(zip(rows, faults))):
        initial = role[:1] if role[:1] in ("s", "u", "a") else "-"
        step = {}
        for q in range(4):
            ways = [(best[to][0] + c, e + best[to][1]) for e, c, to in C._moves(initial, fault, q) if best[to]]
            step[q] = min(ways) if ways else None
        best = {}
        for q in range(4):
            to = step[C._NEXT[q][1]]
            ways = [w for w in (step[q], to and (to[0] + 5, "I" + to[1])) if w]
            best[q] = min(ways) if ways else None
    return best[0]


def solved(rows, size):
    faults = faults_of(rows)
    symbols = "".join(C.letter(r[:1] if r[:1] in ("s", "u", "a") else "-", f) for (r, _), f in zip(rows, faults))
    cut = [symbols[i : i + size] for i in range(0, len(symbols), size)]
    cells = [[c for line in C.segment(s) for c in line] for s in cut]
    cost, states, tail = C.chain([([-1 if c[0] is None else c[0] for c in x], [c[1] for c in x]) for x in cells])
    return cost, "".join(C.segment(s)[a][b][2] for s, (a, b) in zip(cut, states)) + tail


def random_rows(rng, n):
    roles = ["system", "user", "assistant", "tool", " "]
    texts = ["One.", "Two!", "three", "", " \n", "Four? ", "One."]
    return [(rng.choices(roles, [2, 5, 5, 1, 1])[0], rng.choice(texts)) for _ in range(n)]


def test_small_conversations_equal_brute_force():
    rng = random.Random(5)
    for n in (0, 1, 2, 3, 4, 5):
        for _ in range(40 if n < 5 else 12):
            rows = random_rows(rng, n)
            want = brute(rows)
            assert linear(rows) == want[:2], rows
            if n:
                for size in (1, 2, 3, 256):
                    assert solved(rows, size) == want[:2], (rows, size)


def test_long_conversations_do_not_depend_on_the_segments():
    rng = random.Random(6)
    for n in (50, 700):
        rows = random_rows(rng, n)
        rows = [(r, f"{t}{k if t.strip() and k % 3 else ''}{'.' if k % 2 else ''}") for k, (r, t) in enumerate(rows)]
        want = linear(rows)
        for size in (1, 7, 64, 256):
            assert solved(rows, size) == want


def test_letters_have_zero_end_padding():
    # a shorter audit of the same cost and letters comes first
    width = C._BITS * 4
    value = lambda s: sum(C._CODE[c] << (width - C._BITS * (i + 1)) for i, c in enumerate(s))
    words = ["".join(w) for n in range(5) for w in itertools.product("DIKR", repeat=n)]
    assert sorted(words, key=value) == sorted(words)
    assert all(C._letters(value(w), width) == w for w in words)


def expected(rows):
    """The query's rows, in plain Python."""
    out = {}
    sp = lambda v: " " if v is None else str(v)
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, sp(role), sp(text)))
    for conv, turns in by.items():
        kept = []
        for turn, role, text in turns:
            fate = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
            if fate == 0:
                continue
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            role = "user" if fate == 4 else role
            kept += [(turn, role, text)] * (2 if fate == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        pairs = [(r, t) for _, r, t in kept]
        faults = faults_of(pairs)
        known = [t for t, _, _ in kept if t is not None]
        initials = [r[:1] for r, _ in pairs]
        cost, audit = linear(pairs)
        repaired, q, rest = [], 0, iter(pairs)
        for c in audit:
            role, after = C._NEXT[q]
            word = {"u": "user", "a": "assistant"}[role]
            if c == "I":
                repaired.append(f"{word}:")
                q = after
                continue
            own, text = next(rest)
            if c == "K":
                repaired.append(f"{own}:{text}")
                q = 1 if own[:1] == "s" else after
            elif c == "R":
                repaired.append(f"{word}:{text}")
                q = after
        out[conv] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *(faults.count(f) for f in (C.BLANK, C.DUPLICATE, C.TRUNCATED)),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest(),
        )
    return out


def check(spark, rows, schema=ROWS):
    df = spark.createDataFrame(rows, schema)
    got = {r["conv_id"]: tuple(r)[1:] for r in C.repair_report(df).collect()}
    want = expected([tuple(r)[:4] for r in rows])
    assert set(got) == set(want)
    for k in want:
        assert got[k] == want[k], (k, got[k], want[k])


def test_query_equals_plain_python(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = C.op11_repair(spark, SF)
    got = {r["conv_id"]: tuple(r)[1:] for r in df.collect()}
    assert got == expected(rows)


def test_nulls_repeats_and_long_conversations(spark):
    rows = [(None, None, None, None), (None, None, None, None), (None, 3, "user", "Null id.")]
    rows += [(1, None, "system", "Rules."), (1, 0, "user", None), (1, 1, None, "Text."), (1, 9, "", "Odd.")]
    rows += [(2, t, "user" if t % 2 else "assistant", f"Line {t % 7}." if t % 5 else f"cut {t}") for t in range(700)]
    rows += [(3, 0, "user", "Zürich? ")] * 300
    rows += [(4, 2, "tool", "x" * 100_000), (4, 5, "assistant", "So.")]
    check(spark, rows)


def test_empty_table_and_clashing_columns(spark):
    assert C.repair_report(spark.createDataFrame([], ROWS)).collect() == []
    rows = [(5, t, "user" if t % 2 == 0 else "assistant", f"Say {t}.", "x", 1, "y") for t in range(6)]
    check(spark, rows, ROWS + ", conv string, at int, h1 string")


def test_conversation_over_many_ranges(spark):
    rows = [("=1", t, "user" if t % 3 else "assistant", f"Turn {t}." if t % 4 else "") for t in range(900)]
    df = spark.createDataFrame(rows, "conv string, turn long, role string, text string")
    one, _ = C.repair(df, partitions=1)
    many, repaired = C.repair(df, partitions=16)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    initials = "".join(r["role"][:1] for r in repaired.orderBy("at", "nth").select(F.col("role")).collect())
    assert re.fullmatch("(s?(ua)+)?", initials)
