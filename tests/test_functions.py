from pyspark.sql import functions as F

from ledgerline.functions import (
    ano_mes_label,
    normalize_text,
    parse_brl,
    pct_change,
    period_month,
    period_year,
    region_of,
    round_half_up,
    trend_label,
)
from ledgerline.schemas import REGIONS, TREND_LABELS


def _one(spark, expr, value, typ="string"):
    df = spark.createDataFrame([(value,)], f"v {typ}")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


def test_parse_brl_cases(spark):
    assert _one(spark, parse_brl, "218,00") == 218.0
    assert _one(spark, parse_brl, "1.218,00") == 1218.0
    assert _one(spark, parse_brl, "1.234.567,89") == 1234567.89
    assert _one(spark, parse_brl, "-50,00") == -50.0
    assert _one(spark, parse_brl, "abc") is None  # no failure under ANSI
    assert _one(spark, parse_brl, None) is None


def test_round_half_up_decimal_text(spark):
    assert _one(spark, lambda c: round_half_up(c, 2), 1.005, "double") == 1.01
    assert _one(spark, lambda c: round_half_up(c, 0), 2.5, "double") == 3.0
    assert _one(spark, lambda c: round_half_up(c, 0), -2.5, "double") == -3.0
    assert _one(spark, lambda c: round_half_up(c, 4), None, "double") is None


def test_pct_change_null_rules(spark):
    df = spark.createDataFrame([(5, 2), (2, 0), (3, None)], "cur long, prev long")
    out = [r["p"] for r in df.select(pct_change("cur", "prev").alias("p")).collect()]
    assert out == [150.0, None, None]


def test_period_parts(spark):
    assert _one(spark, period_year, "202301") == 2023
    assert _one(spark, period_month, "202301") == 1
    assert _one(spark, period_month, "2023") is None
    assert _one(spark, period_year, "ab2301") is None


def test_ano_mes_label(spark):
    df = spark.createDataFrame([(2023, 1), (2024, 12)], "ano int, mes int")
    assert [r[0] for r in df.select(ano_mes_label("ano", "mes")).collect()] == ["2023-01", "2024-12"]


def test_normalize_trims_spaces_only(spark):
    assert _one(spark, normalize_text, "  sao paulo ") == "SAO PAULO"
    assert _one(spark, normalize_text, "\tx") == "\tX"  # tab survives
    assert _one(spark, normalize_text, " x") == " X"  # NBSP survives


def test_region_of_every_uf(spark):
    pairs = [(u, r) for r, ufs in REGIONS.items() for u in ufs] + [("XX", "Outros")]
    df = spark.createDataFrame(pairs, "uf string, expected string")
    bad = df.filter(region_of("uf") != F.col("expected")).count()
    assert bad == 0


def test_trend_bands(spark):
    df = spark.createDataFrame([(6.0,), (5.0,), (0.1,), (0.0,), (-1.0,), (None,)], "p double")
    got = [r[0] for r in df.select(trend_label("p")).collect()]
    t = TREND_LABELS
    assert got == [t["strong_growth"], t["growth"], t["growth"], t["stable"], t["decline"], t["no_data"]]
