import hashlib
import re

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import pii

from .helpers import docs


def feistel(kind, x, y, a, b, key=pii.TEST_KEY):
    def f(i, v, m):
        return int(hashlib.sha256(f"{key}|{kind}|{i}|{m}|{v}".encode()).hexdigest()[:15], 16) % m

    for i in range(pii.ROUNDS):
        if i % 2 == 0:
            x = (x + f(i, y, a)) % a
        else:
            y = (y + f(i, x, b)) % b
    return x, y


def run(spark, texts):
    rows = docs(spark, list(enumerate(texts)))
    return [r["text"] for r in pii.pseudonymise(rows, pii.TEST_KEY).orderBy("doc_id").collect()]


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        s += v - 9 * (v > 9)
    return s % 10


def test_permutation_is_a_bijection_and_equals_python(spark):
    got = spark.range(13 * 7).select("id", pii.permute("t", F.floor(F.col("id") / 7), F.col("id") % 7, 13, 7, pii.TEST_KEY).alias("p")).collect()
    assert {(r["p"]["x"], r["p"]["y"]) for r in got} == {(i, j) for i in range(13) for j in range(7)}
    assert all((r["p"]["x"], r["p"]["y"]) == feistel("t", r["id"] // 7, r["id"] % 7, 13, 7) for r in got)


def test_kinds_keep_their_formats(spark):
    a, b = run(spark, ["ip 10.20.30.40, card 4111 1111 1111 1111; tel +1 (212) 555-0187 ssn 123-45-6789 on 2024-02-29 or 31/12/1999!", "10.20.30.40"])
    m = re.fullmatch(r"ip (\S+), card (\d{4} \d{4} \d{4} \d{4}); tel \+1 \((\d{3})\) (\d{3}-\d{4}) ssn (\d{3}-\d{2}-\d{4}) on (\d{4}-\d{2}-\d{2}) or (\d{2}/\d{2}/\d{4})!", a)
    assert m and luhn(m[2].replace(" ", "")) == 0
    assert b == m[1] and b != "10.20.30.40"  # linked across documents
    x, y = feistel("ip", 10 * 256 + 20, 30 * 256 + 40, 65536, 65536)
    assert b == f"{x // 256}.{x % 256}.{y // 256}.{y % 256}"
    assert "6789" not in a and "0187" not in a and "2024-02-29" not in a


def test_neighbours_are_told_apart(spark):
    a, b = run(spark, ["4465758382889437 4465758382889437 10.1.2.3 10.1.2.3", "x 4465 7583 8288 9437 4465 7583 8288 9437."])
    c, d, e, f = a.split(" ")
    assert c == d != "4465758382889437" and luhn(c) == 0 and e == f != "10.1.2.3"
    assert b.replace(" ", "") == f"x{c}{c}."


def test_emails_and_secrets(spark):
    a, b, c = run(spark, ["Write to Ann.B+x@Mail.example.org now", "ann.b+x@mail.example.org", 'token = "1beb58b8af68854f" password=hunter2hunter2 x'])
    assert re.fullmatch(r"Write to u[0-9a-f]{12}@d[0-9a-f]{8}\.example now", a) and b in a
    assert re.fullmatch(r'token = "[0-9a-f]{24}" password=[0-9a-f]{24} x', c) and "hunter2" not in c


def carded(body):
    return next(body + c for c in "0123456789" if luhn(body + c) == 0)


def grouped(digits, sizes, sep):
    at = [sum(sizes[:i]) for i in range(len(sizes))]
    return sep.join(digits[i : i + n] for i, n in zip(at, sizes))


@pytest.mark.parametrize("sizes", [(4, 6, 4), (4, 4, 4, 4, 1), (4, 4, 4, 4, 2), (4, 4, 4, 4, 3), (4, 6, 5), (4, 4, 4, 4)])
@pytest.mark.parametrize("sep", [" ", "-"])
def test_grouped_cards(spark, sizes, sep):
    plain = carded("3056930902590411380"[: sum(sizes) - 1])
    a, b, c = run(spark, [f"card {grouped(plain, sizes, sep)}.", plain, f"{grouped(plain, sizes, sep)}, 5 items"])
    assert plain != b and luhn(b) == 0  # linked whatever the separators
    assert a == f"card {grouped(b, sizes, sep)}." and c == f"{grouped(b, sizes, sep)}, 5 items"


@pytest.mark.parametrize("after", [
    "212-555-0187", "1 (212) 555-0187", "123-45-6789", "10.1.2.3", "12/31/1999", "12jane@example.com", "4465 7583 8288 9437", "3056 930902 5904",
])
def test_what_follows_a_card_is_not_its_tail(spark, after):
    a, b, c = run(spark, [f"4465 7583 8288 9437 {after}", "4465 7583 8288 9437", after])
    assert a == f"{b} {c}" and c != after
    # the first two groups are no card with what follows
    d, e = run(spark, [f"1234 567890 {after}", after])
    assert d == f"1234 567890 {e}"


def test_a_number_after_a_card_stays(spark):
    a, b = run(spark, ["4465 7583 8288 9437 738", "4465 7583 8288 9437"])
    assert luhn("4465758382889437738") and a == f"{b} 738" and b != "4465 7583 8288 9437"


@pytest.mark.parametrize("n", [512, 513, 800, 5000, 200_000])
def test_long_secrets_are_replaced_whole(spark, n):
    a, b = (hashlib.sha512(str(n).encode()).hexdigest() * (n // 128 + 1))[:n], "x." * (n // 2)
    got = run(spark, [f'token: "{a}", api_key={b} end'])[0]
    assert re.fullmatch(r'token: "[0-9a-f]{24}", api_key=[0-9a-f]{24} end', got)


@pytest.mark.parametrize("after", [". Then", ".", "...", ".\n", ".)", ".5", ". ", ", x", "-x", ""])
def test_emails_before_a_full_stop(spark, after):
    a, b, c = run(spark, [f"Write to jane@example.com{after}", f"(jane@mail.example.co.uk{after}", "jane@" + "a." * 40 + f"org{after}"])
    u = r"u[0-9a-f]{12}@d[0-9a-f]{8}\.example"
    assert re.fullmatch(rf"Write to {u}{re.escape(after)}", a) and re.fullmatch(rf"\({u}{re.escape(after)}", b)
    assert re.fullmatch(u + re.escape(after), c) and run(spark, ["jane@example.com"])[0] in a


@pytest.mark.parametrize("text", [
    "4111 1111 1111 1112 fails Luhn", "300.1.2.3 and 1.2.3.4.5", "000-12-3456 666-12-3456 123-00-4567", "2023-02-30 and 99/99/2020",
    "plain words, version 3.2 in 2024, 12 of 30", "a@b", "tokens and passwords", "", None,
])
def test_invalid_or_clean_text_is_left_alone(spark, text):
    assert run(spark, [text]) == [text]


def test_long_text_repeats_and_other_columns(spark):
    long = ("word " * 30000) + "8.8.8.8" + ("." * 20000) + ("7" * 20000) + ("a" * 20000) + "@x"
    rows = docs(spark, [(1, long, "en", "s"), (1, long, "en", "s"), (None, "8.8.8.8")]).withColumn("n_pii", F.lit("x"))
    got = pii.pseudonymise(rows, pii.TEST_KEY)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_pii"]
    assert [r["n_pii"] for r in got.collect()] == [1, 1, 1]
    assert pii.pseudonymise(rows.limit(0), pii.TEST_KEY).collect() == []


def test_query_leaves_no_value(spark):
    sf = "/root/testdata/sf0.01"
    found = [m for r in spark.read.parquet(f"{sf}/documents.parquet").collect() for m in re.findall(r"[\w.]+@[\w.]+|\b4\d{15}\b|\b\d+\.\d+\.\d+\.\d+\b|\(\d{3}\) 555-\d{4}", r["text"])]
    out = "\n".join(r["text"] for r in pii.op7_pii(spark, sf).collect())
    assert len(found) > 20 and not [m for m in found if m in out]


def test_nothing_of_a_planted_value_is_left(spark):
    values = ["abcdefgh!rest9", "eyJhbGciOi~abcdef", "Tr0ub4d&r3xyz", "p@ss:w=rd;12345", "Zürich-geheim-ß9", "(hunter2)hunter2"]
    forms = ["password={}", "token: {}", 'authToken = "{}"', "pwd      :   '{}'", '{{"api_key":"{}","n":1}}', "MY_SECRET_KEY={} next", "x.accessKey={}"]
    planted = [(v, f.format(v)) for v in values for f in forms]
    mails = ["jane@münchen.de", "jane@example.xn--p1ai", "o'neil@example.org", "josé.a+b@ex-bank.co.uk", "用户@例子.中国"]
    planted += [(m, f"mail {m}, please") for m in mails]
    rows = docs(spark, [(i, f"before {t} after") for i, (_, t) in enumerate(planted)])
    got = {r["doc_id"]: r for r in pii.pseudonymise(rows, "k").collect()}
    for i, (value, text) in enumerate(planted):
        out = got[i]["text"]
        parts = [p for p in __import__("re").split(r"[^\w]+", value) if len(p) > 3 and p not in ("example", "mail")]
        assert got[i]["n_pii"] >= 1 and value not in out and not any(p in out for p in parts), (text, out)
        assert out.startswith("before ") and out.endswith(" after")


def test_a_key_is_required(spark):
    import pytest

    with pytest.raises(ValueError, match="key"):
        pii.pseudonymise(docs(spark, []), "")
