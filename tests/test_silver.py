from pyspark.sql import functions as F

from ledgerline.operators import silver as S
from ledgerline.schemas import RAW_SCHEMA, SILVER_COLUMNS


def test_rename_columns(raw_fixture):
    df = S.rename_columns(raw_fixture)
    assert {"competencia", "uf", "valor_parcela_raw"} <= set(df.columns)
    assert "MES_COMPETENCIA" not in df.columns


def test_rename_only_present(spark):
    df = spark.createDataFrame([("SP", "x")], "UF string, EXTRA string")
    assert S.rename_columns(df).columns == ["uf", "EXTRA"]


def _values(df):
    return {(r["nis_favorecido"], r["codigo_municipio"], r["valor_parcela"]) for r in df.collect()}


def test_parse_valor(raw_fixture):
    df = S.parse_valor(S.rename_columns(raw_fixture))
    assert "valor_parcela_raw" not in df.columns
    got = {(r["nis_favorecido"], r["valor_parcela"]) for r in df.collect()}
    assert {("70000000001", 1089.10), ("70000000003", 0.004), ("70000000006", None), ("70000000007", float("inf"))} <= got


def test_extract_periodo(raw_fixture):
    df = S.extract_periodo(S.parse_valor(S.rename_columns(raw_fixture)))
    assert {(r["ano"], r["mes"]): r["count"] for r in df.groupBy("ano", "mes").count().collect()} == {(2021, 4): 10, (2021, 3): 1}


def test_normalize_strings(raw_fixture):
    rows = S.prepare(raw_fixture).filter("nis_favorecido = '70000000001'").collect()
    assert {(r["uf"], r["nome_municipio"], r["nome_favorecido"]) for r in rows} == {("PR", "CURITIBA", "IVO LIMA")}


def test_filter_invalid_values(raw_fixture):
    left = {r["nis_favorecido"] for r in S.filter_invalid_values(S.prepare(raw_fixture)).collect()}
    assert left == {"70000000001", "70000000002", "70000000003", None}


def test_amounts_no_column_can_hold_are_invalid(spark):
    rows = [("202104", "PR", "1", "A", "c", str(i), "N", v) for i, v in enumerate(["Infinity", "-Infinity", "NaN", "1e20", "99999999999999999999999999999", "99.999.999.999.999.991.611,39"])]
    got = S.filter_invalid_values(S.prepare(spark.createDataFrame(rows, RAW_SCHEMA))).collect()
    assert [r["nis_favorecido"] for r in got] == ["5"]


def test_filter_nulls(raw_fixture):
    df = S.filter_nulls(S.filter_invalid_values(S.prepare(raw_fixture)))
    assert df.filter(F.col("nis_favorecido").isNull()).count() == 0 and df.count() == 6


def test_dedup_keeps_highest_then_lowest_code(raw_fixture):
    assert _values(S.clean(raw_fixture)) == {
        ("70000000001", "7535", 1089.10), ("70000000002", "1361", 45.5), ("70000000003", "3105", 0.004), ("70000000003", "3105", 12.0),
    }


def test_funnel_counts(raw_fixture):
    r = S.funnel(raw_fixture).first().asDict()
    assert r == {"raw": 11, "foreign_period": 0, "invalid": 4, "nulls": 1, "duplicates": 2, "kept": 4}


def test_funnel_foreign_period(raw_fixture):
    r = S.funnel(raw_fixture, periods=[(2021, 4)]).first().asDict()
    assert r["foreign_period"] == 1 and r["kept"] == 3
    assert S.funnel(raw_fixture, periods=[(2022, 1)]).first()["foreign_period"] == 11


def test_silver_contract(raw_fixture):
    df = S.with_silver_audit(S.clean(raw_fixture))
    assert df.columns == SILVER_COLUMNS
    types = dict(df.dtypes)
    assert types["valor_parcela"] == "double" and types["ano"] == "int" and types["mes"] == "int"
    assert types["dt_ingestao"] == "timestamp"
    assert {r["_silver_version"] for r in df.collect()} == {"1.0"}


def test_adversarial_rows(spark):
    rows = [
        ("202301", "SP", "1", "A", "c", "1", "N", "1.218,00"),  # thousands separator
        ("202301", None, "1", "A", "c", "2", "N", "10,00"),  # NULL UF: invalid
        ("202301", "SP", "1", "A", "c", "3", "N", "abc"),  # malformed: invalid
        ("202301", "SP", "1", "A", "c", "4", "N", "NaN"),  # NaN: invalid
        ("2023", "SP", "1", "A", "c", "5", "N", "10,00"),  # short period: NULL month
        ("202301", " sp ", "1", "A", "c", "6", "N", "0,00"),  # zero: invalid
        ("202301", "SP", "2", "B", "c", "7", "Z", "10,00"),  # tie on value ...
        ("202301", "SP", "1", "A", "c", "7", "Y", "10,00"),  # ... lowest code wins
    ]
    df = S.clean(spark.createDataFrame(rows, RAW_SCHEMA))
    got = {r["nis_favorecido"]: r for r in df.collect()}
    assert set(got) == {"1", "7"}
    assert got["1"]["valor_parcela"] == 1218.0
    assert got["7"]["codigo_municipio"] == "1" and got["7"]["nome_favorecido"] == "Y"


def test_dedup_is_deterministic_across_partitionings(spark):
    rows = [("202301", "SP", str(i % 3), "M", "c", "42", f"N{i}", "10,00") for i in range(40)]
    base = spark.createDataFrame(rows, RAW_SCHEMA)
    picks = {
        tuple(S.clean(base.repartition(n)).first().asDict().items()) for n in (1, 3, 7)
    }
    assert len(picks) == 1


def test_dedup_plans_partial_limit_before_shuffle(raw_fixture):
    plan = S.clean(raw_fixture)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_hot_key_third_of_rows(spark):
    # one beneficiary holds a third of the rows, spread over every input partition
    hot = [("202301", "SP", str(i % 5), "M", "c", "99", f"N{i:04d}", f"{i % 700},{i % 100:02d}") for i in range(3000)]
    cold = [("202301", "RJ", "1", "M", "c", str(1000 + i), "N", "10,00") for i in range(6000)]
    df = spark.createDataFrame(hot + cold, RAW_SCHEMA).repartition(12)
    out = S.clean(df)
    assert out.count() == 6001
    r = out.filter(F.col("nis_favorecido") == "99").collect()
    assert len(r) == 1
    # the highest value, 699,99, occurs at i = 699, 1399, 2099, 2799: the lowest code among them wins
    assert r[0]["valor_parcela"] == 699.99
    assert r[0]["codigo_municipio"] == str(min(i % 5 for i in (699, 1399, 2099, 2799)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan or "WindowGroupLimit" in plan
