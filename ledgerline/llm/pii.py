"""Personal data replaced by format-preserving Feistel pseudonyms.

Found and validated: payment card numbers (Luhn; 13 to 19 digits without separators, or
grouped by single spaces or hyphens as 4-4-4-4, 4-4-4-4 and 1 to 3, 4-6-5 or 4-6-4), US social
security numbers, North American phone numbers (any ten digits in that notation), IPv4 addresses, calendar dates
(``YYYY-MM-DD``, ``DD/MM/YYYY``, ``MM/DD/YYYY``, ``DD.MM.YYYY``), e-mail addresses, and
secrets of any length from 8 characters after a label such as ``password=`` or ``token: "``.

Each number or date is one point of a product Z_a x Z_b; an alternating Feistel
network with SHA-256 round functions under a secret key permutes that set, so
different values stay different, equal values get equal pseudonyms in every
document, and the result is a valid value of the same kind in the same
notation (a card number keeps its length, separators and a right check digit; a
date stays a real date). E-mail addresses and secrets are not numbers: they
become keyed digests of a fixed shape.

All of it is DataFrame expressions in one projection without a shuffle. Texts
without a digit or an ``@`` are passed through by a cheap test; the others are cut once
by one pattern whose quantifiers are bounded or possessive, so very long texts
take linear time. The labels of a domain are bounded, not possessive: the dot that
ends a sentence is given back.

Defined results: NULL text stays NULL, empty text empty; numbers that fail
validation stay as they are; repeated rows and values are treated alike;
other columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import free_names, let, table

TEST_KEY = "key of the test query"  # anybody who has the key can undo the numbers
ROUNDS = 10

EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-][\p{L}\p{N}.!$%'*+^_`~-]{0,63}+@(?:[\p{L}\p{N}-]{1,63}+\.){1,126}(?:(?i:xn--)[A-Za-z0-9-]{1,59}(?<!-)|\p{L}{2,24}+)"
# a label, also inside a longer name, and a value up to its closing quote or white space
SECRET = (
    r"""(?i:(?:password|passwd|pwd|token|secret(?:[_-]?key)?|api[_-]?key|access[_-]?key)["']?\s{0,40}+[=:]\s{0,40}+)"""
    r"""(?:"[^"\n]{8,300}+(?=")|'[^'\n]{8,300}+(?=')|["'][^\s"']{8,}+|[^\s"']\S{7,}+)"""
)
IP = r"(?<![0-9])(?<![0-9][.])(?:[0-9]{1,3}+\.){3}+[0-9]{1,3}+(?![0-9]|\.[0-9])"
DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9]|[./-][0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
PHONE = r"(?<![0-9+])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9]|[.-][0-9])"
# the last group of these is left to what starts there (a phone after a card is not its tail)
_FREE = f"(?![ -](?:{EMAIL}|{IP}|{DATE}|{SSN}|{PHONE}|[0-9]{{4}}(?:[ -][0-9]{{4}}){{3}}(?![0-9])|[0-9]{{4}}[ -][0-9]{{6}}[ -][0-9]{{4,5}}(?![0-9])))"
CARD = (
    r"(?<![0-9])(?:[0-9]{13,19}+|[0-9]{4}(?:[ -][0-9]{4}){3}(?:" + _FREE + r"[ -][0-9]{1,3}(?![0-9]))?"
    r"|[0-9]{4}[ -][0-9]{6}(?:[ -][0-9]{5}|" + _FREE + r"[ -][0-9]{4}))(?![0-9])"
)
KINDS = [("email", EMAIL), ("secret", SECRET), ("ip", IP), ("date", DATE), ("ssn", SSN), ("phone", PHONE), ("card", CARD)]
ANY = "|".join(p for _, p in KINDS)

_EPOCH, _CYCLE = "1800-01-01", 146_097  # days in 400 Gregorian years = 339 * 431


def _round(key: str, kind: str, i: Column, value: Column, modulus: Column) -> Column:
    text = F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), modulus.cast("string"), value.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long") % modulus


def permute(kind: str, left: Column, right: Column, a: Column | int, b: Column | int, key: str) -> Column:
    """Keyed permutation of (left, right) in Z_a x Z_b: rounds alternately add a digest of
    one half to the other. ``a`` and ``b`` are at most 10**10, so sums stay within a long."""
    a, b = (x if isinstance(x, Column) else F.lit(x).cast("long") for x in (a, b))

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        x = F.when(even, (s["x"] + _round(key, kind, i, s["y"], a)) % a).otherwise(s["x"])
        y = F.when(even, s["y"]).otherwise((s["y"] + _round(key, kind, i, s["x"], b)) % b)
        return F.struct(x.alias("x"), y.alias("y"))

    start = F.struct(left.cast("long").alias("x"), right.cast("long").alias("y"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _pad(x: Column, n: Column | int) -> Column:
    return F.lpad(x.cast("string"), n, "0")


def _refill(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced in order by ``digits``."""
    def put(s: Column, c: Column) -> Column:
        is_digit = c.between("0", "9")
        return F.struct(
            F.concat(s["out"], F.when(is_digit, F.substr(digits, s["at"], F.lit(1))).otherwise(c)).alias("out"),
            (s["at"] + is_digit.cast("int")).alias("at"),
        )

    return F.aggregate(F.split(m, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), put, lambda s: s["out"])


def luhn(digits: Column) -> Column:
    """Luhn sum of a digit string modulo 10; 0 for a valid number."""
    rev = F.split(F.reverse(digits), "")
    value = F.transform(rev, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(value, F.lit(0), lambda a, x: a + x) % 10


def _card(m: Column, key: str) -> Column:
    def new(d: Column) -> Column:
        n = F.length(d) - 1  # without the check digit
        u = F.floor(n / 2).cast("int")
        ten = lambda k: F.pow(F.lit(10.0), k).cast("long")  # noqa: E731  exact up to 10**22

        def with_check(body: Column) -> Column:
            return F.concat(body, ((10 - luhn(F.concat(body, F.lit("0")))) % 10).cast("string"))

        p = permute("card", F.substr(d, F.lit(1), u), F.substr(d, u + 1, n - u), ten(u), ten(n - u), key)
        return let(let(p, lambda s: F.concat(_pad(s["x"], u), _pad(s["y"], n - u))), with_check)

    def valid(m: Column, otherwise: Callable[[Column], Column]) -> Column:
        return let(_digits(m), lambda d: F.when(luhn(d) == 0, _refill(m, new(d))).otherwise(otherwise(m)))

    def shorter(m: Column) -> Column:
        """Four groups of four before a number that is not part of the card."""
        tail = F.substr(m, F.lit(20))
        return F.when(m.rlike("^(?:[0-9]{4}[ -]){4}"), F.concat(valid(F.left(m, F.lit(19)), lambda x: x), tail)).otherwise(m)

    return valid(m, shorter)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (m.substr(i, n).cast("int") for i, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    rank = area - 1 - (area > 666).cast("int")
    p = permute("ssn", rank * 99 + group - 1, serial - 1, 898 * 99, 9999, key)

    def text(s: Column) -> Column:
        r = F.floor(s["x"] / 99)
        return F.concat_ws("-", _pad(r + 1 + (r >= 665).cast("int"), 3), _pad(s["x"] % 99 + 1, 2), _pad(s["y"] + 1, 4))

    return F.when(valid, let(p, text)).otherwise(m)


def _phone(m: Column, key: str) -> Column:
    """The ten national digits, as area code and local number."""
    def new(d: Column) -> Column:
        last = F.right(d, F.lit(10))
        p = permute("phone", last.substr(1, 3), last.substr(4, 7), 1000, 10_000_000, key)
        national = let(p, lambda s: F.concat(_pad(s["x"], 3), _pad(s["y"], 7)))
        return _refill(m, F.concat(F.substr(d, F.lit(1), F.length(d) - 10), national))

    return let(_digits(m), new)


def _ip(m: Column, key: str) -> Column:
    def new(o: Column) -> Column:
        p = permute("ip", o[0] * 256 + o[1], o[2] * 256 + o[3], 65_536, 65_536, key)
        dotted = let(p, lambda s: F.concat_ws(".", *[x.cast("string") for x in (
            F.shiftright(s["x"], 8), s["x"] % 256, F.shiftright(s["y"], 8), s["y"] % 256)]))
        return F.when(F.array_max(o) <= 255, dotted).otherwise(m)

    return let(F.transform(F.split(m, r"\."), lambda x: x.cast("int")), new)


def _date(m: Column, key: str) -> Column:
    def shifted(day: Column, fmt: str) -> Column:
        n = F.datediff(day, F.lit(_EPOCH).cast("date"))
        base = F.floor(n / _CYCLE) * _CYCLE
        p = permute("date", F.floor((n - base) / 431), (n - base) % 431, 339, 431, key)
        return let(p, lambda s: F.date_format(F.date_add(F.lit(_EPOCH).cast("date"), (base + s["x"] * 431 + s["y"]).cast("int")), fmt))

    def by(fmt: str) -> Column:
        return let(F.try_to_date(m, fmt), lambda d: F.when(d.isNotNull(), shifted(d, fmt)))

    return F.coalesce(
        F.when(F.substr(m, F.lit(5), F.lit(1)) == "-", by("yyyy-MM-dd")),
        F.when(F.substr(m, F.lit(3), F.lit(1)) == "/", F.coalesce(by("dd/MM/yyyy"), by("MM/dd/yyyy"))),
        F.when(F.substr(m, F.lit(3), F.lit(1)) == ".", by("dd.MM.yyyy")),
        m,
    )


def _digest(key: str, kind: str, value: Column, n: int) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), value), 256), 1, n)


def pseudonym(m: Column, key: str) -> Column:
    whole = lambda p: m.rlike(f"^(?:{p})$")
    label = F.regexp_extract(m, r"""^([^=:]*[=:]\s*["']?)""", 1)
    secret = F.concat(label, _digest(key, "secret", F.substr(m, F.length(label) + 1), 24))
    email = F.concat(F.lit("u"), _digest(key, "email", F.lower(m), 12), F.lit("@"), F.lit("d"),
                     _digest(key, "domain", F.lower(F.substring_index(m, "@", -1)), 8), F.lit(".example"))
    numbers = (
        F.when(whole(IP), _ip(m, key)).when(whole(DATE), _date(m, key)).when(whole(SSN), _ssn(m, key))
        .when(whole(PHONE), _phone(m, key)).otherwise(_card(m, key))
    )
    return F.when(whole(EMAIL), email).when(whole(SECRET), secret).otherwise(numbers)


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced, and ``n_pii``, the number of replacements (an
    input column of that name is replaced). ``key``: a secret of the caller; one key keeps equal values linked."""
    if not key:
        raise ValueError("pseudonyms need a key")
    t = F.col(text)

    def replaced(found: Column) -> Column:
        new = F.transform(found, lambda m: pseudonym(m, key))
        changed = F.size(F.filter(F.arrays_zip(found.alias("a"), new.alias("b")), lambda z: z["a"] != z["b"]))
        return F.struct(new.alias("new"), changed.alias("n"))

    def joined(found: Column) -> Column:
        def glue(new: Column) -> Column:
            between = F.split(t, ANY, -1)
            tail = F.concat(new["new"], F.array(F.lit("")))
            return F.struct(F.array_join(F.zip_with(between, tail, lambda a, b: F.concat(a, b)), "").alias("text"), new["n"].alias("n"))

        return F.when(F.size(found) == 0, F.struct(t.alias("text"), F.lit(0).alias("n"))).otherwise(let(replaced(found), glue))

    maybe = t.rlike(r"[0-9@]|(?i:passw|pwd|token|secret|key)")
    done = F.when(maybe, let(F.regexp_extract_all(t, F.lit(ANY), F.lit(0)), joined)).otherwise(F.struct(t.alias("text"), F.lit(0).alias("n")))
    names = [c for c in docs.columns if c != "n_pii"]
    (made,) = free_names(docs, "pii")
    out = docs.select(*(F.col(f"`{c}`") for c in names), done.alias(made))
    return out.select(*[F.col(f"{made}.text").alias(c) if c == text else F.col(f"`{c}`") for c in names], F.col(f"{made}.n").cast("long").alias("n_pii"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), TEST_KEY)
