import hashlib
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import pipeline as P
from ledgerline.schemas import RAW_COLUMNS
from ledgerline.settings import Layout
from ledgerline.sinks.tables import existing_periods, jdbc_options, write_partitioned
from ledgerline.sources import raw_csv as R

HEADER = ";".join(RAW_COLUMNS)


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _land(root, period, lines, header=HEADER, name="part-0.csv", encoding="latin-1"):
    d = os.path.join(_local(root), f"competencia={period}")
    os.makedirs(d, exist_ok=True)
    p = os.path.join(d, name)
    with open(p, "wb") as f:
        f.write(("\n".join([header] + lines) + "\n").encode(encoding))
    return p


def test_latin1_quotes_and_extra_column(spark, tmp_lake):
    land = tmp_lake + "/landing"
    _land(
        land,
        "202301",
        [
            '202301;SP;3550308;SÃO PAULO;***.1-**;1;"JOSÉ; DA SILVA";"1.218,00";x',
            '202301;RJ;3304557;NITERÓI;***.2-**;2;"ANA ""BIA""";300,50;y',
        ],
        header=" mes_competencia ;uf;CODIGO_MUNICIPIO_SIAFI;NOME_MUNICIPIO;CPF_FAVORECIDO;NIS_FAVORECIDO;NOME_FAVORECIDO;VALOR_PARCELA;EXTRA",
    )
    df = R.read_landing(spark, land)
    assert df.columns[:8] == RAW_COLUMNS and "EXTRA" in df.columns
    rows = {r["NIS_FAVORECIDO"]: r for r in df.collect()}
    assert rows["1"]["NOME_MUNICIPIO"] == "SÃO PAULO"
    assert rows["1"]["NOME_FAVORECIDO"] == "JOSÉ; DA SILVA"
    assert rows["2"]["NOME_FAVORECIDO"] == 'ANA "BIA"'
    assert rows["2"]["NOME_MUNICIPIO"] == "NITERÓI"


def test_missing_column_is_rejected(spark, tmp_lake):
    land = tmp_lake + "/landing"
    _land(land, "202301", ["202301;SP"], header="MES_COMPETENCIA;UF")
    with pytest.raises(ValueError, match="VALOR_PARCELA"):
        R.read_landing(spark, land)


def test_missing_column_names_the_file(spark, tmp_lake):
    land = tmp_lake + "/landing"
    _land(land, "202301", ["202301;SP;1;A;c;1;N;10,00"], name="good.csv")
    _land(land, "202302", ["202302;SP;1;A;c;1;10,00"], header=HEADER.replace(";NOME_FAVORECIDO", ""), name="short.csv")
    with pytest.raises(ValueError, match="short.csv.*NOME_FAVORECIDO"):
        R.read_landing(spark, land)


def test_every_file_is_bound_by_its_own_header(spark, tmp_lake):
    land = tmp_lake + "/landing"
    _land(land, "202301", ["202301;SP;1;A;c;1;ANA;10,00"])
    _land(land, "202302", ["RJ;202302;20,00;BIA;2;d;B;2;extra"], header="UF;mes_competencia;VALOR_PARCELA;NOME_FAVORECIDO;NIS_FAVORECIDO;CPF_FAVORECIDO;NOME_MUNICIPIO;CODIGO_MUNICIPIO_SIAFI;LOTE")
    df = R.read_landing(spark, land)
    got = sorted(tuple(r[c] for c in [*RAW_COLUMNS, "LOTE"]) for r in df.collect())
    assert got == [("202301", "SP", "1", "A", "c", "1", "ANA", "10,00", None), ("202302", "RJ", "2", "B", "d", "2", "BIA", "20,00", "extra")]


def test_audit_columns_and_md5_of_bytes(spark, tmp_lake):
    land = tmp_lake + "/landing"
    p = _land(land, "202302", ["202302;SP;1;SÃO PAULO;c;1;N;10,00"], name="pagamentos jan+1.csv")
    expected = hashlib.md5(open(p, "rb").read()).hexdigest()
    for mode in ("md5", "rows", None):
        b = R.with_bronze_audit(spark, R.read_landing(spark, land), land, [(2023, 2)], file_hash=mode)
        r = b.first()
        assert (r["ano"], r["mes"]) == (2023, 2)
        assert r["_file_hash"] == expected if mode == "md5" else (r["_file_hash"] is None) == (mode is None)
        assert r["_file_name"] == "pagamentos jan+1.csv"
        assert r["_source"].endswith("/competencia=202302/pagamentos jan+1.csv")
        assert b.columns[-6:] == ["_source", "_file_name", "_ingested_at", "_file_hash", "ano", "mes"]


def test_only_requested_months_are_read(spark, tmp_lake):
    land = tmp_lake + "/landing"
    _land(land, "202301", ["202301;SP;1;A;c;1;N;10,00"])
    _land(land, "202302", ["202302;SP;1;A;c;1;N;10,00"])
    df = R.read_landing(spark, land, [(2023, 2)])
    assert [f.rsplit("/", 2)[-2] for f in df.inputFiles()] == ["competencia=202302"]
    with pytest.raises(ValueError, match="2023, 3"):
        R.read_landing(spark, land, [(2023, 2), (2023, 3)])


def _two_months(spark, lake):
    rows = [("202301", "SP", "1", "A", "c", str(i), "N", "10,00", 2023, 1) for i in range(3)]
    rows += [("202302", "SP", "1", "A", "c", str(i), "N", "10,00", 2023, 2) for i in range(4)]
    return spark.createDataFrame(rows, ",".join(f"{c} string" for c in RAW_COLUMNS) + ", ano int, mes int")


def test_overwrite_replaces_only_its_month(spark, tmp_lake):
    path = tmp_lake + "/t"
    write_partitioned(_two_months(spark, tmp_lake), path)
    one = _two_months(spark, tmp_lake).filter("mes = 1").limit(1)
    write_partitioned(one, path)
    counts = {(r["ano"], r["mes"]): r["count"] for r in spark.read.parquet(path).groupBy("ano", "mes").count().collect()}
    assert counts == {(2023, 1): 1, (2023, 2): 4}


def test_existing_periods_single_digit_months(spark, tmp_lake):
    path = tmp_lake + "/t"
    write_partitioned(_two_months(spark, tmp_lake), path)
    assert existing_periods(spark, path, [(2023, 1), (2023, 2), (2023, 3)]) == {(2023, 1), (2023, 2)}
    assert existing_periods(spark, tmp_lake + "/nothing", [(2023, 1)]) == set()


def test_bronze_idempotent_and_overwrite(spark, tmp_lake):
    lay = Layout(root=tmp_lake)
    _land(lay.landing, "202301", ["202301;SP;1;A;c;1;N;10,00", "202301;SP;1;A;c;2;N;11,00"])
    first = {tuple(r) for r in P.ingest_bronze(spark, lay, [(2023, 1)]).collect()}
    _land(lay.landing, "202301", ["202301;SP;1;A;c;3;N;12,00"])  # delivered again, with other rows
    P.ingest_bronze(spark, lay, [(2023, 1)])  # skipped: the same rows, file names and times
    assert {tuple(r) for r in spark.read.parquet(lay.bronze).collect()} == first
    P.ingest_bronze(spark, lay, [(2023, 1)], overwrite=True)
    assert [r["NIS_FAVORECIDO"] for r in spark.read.parquet(lay.bronze).collect()] == ["3"]


@pytest.mark.parametrize("n", [1, 32, 33, 80])
def test_months_without_input_keep_what_is_stored(spark, tmp_lake, n):
    """Any number of requested months, one of them no longer landed (or, for Silver, not in Bronze)."""
    import shutil

    lay = Layout(root=tmp_lake)
    asked = [(2010 + i // 12, i % 12 + 1) for i in range(n)]
    gone = asked[0]
    _land(lay.landing, "201001", ["201001;SP;1;A;c;1;N;10,00"])
    _land(lay.landing, "201002", ["201002;SP;1;A;c;1;N;10,00"])
    P.run(spark, lay, [(2010, 1), (2010, 2)])
    shutil.rmtree(_local(lay.landing) + "/competencia=201001")
    res = P.run(spark, lay, asked, overwrite=True)
    assert gone in res["layers"]["bronze"]["not_landed"]
    for path in (lay.bronze, lay.silver):
        assert {(r["ano"], r["mes"]) for r in spark.read.parquet(path).collect()} == {(2010, 1), (2010, 2)}
    shutil.rmtree(_local(lay.bronze) + "/ano=2010/mes=1")
    res = P.run(spark, lay, asked, layers=("silver", "gold"))
    assert gone in res["layers"]["silver"]["not_in_bronze"]
    assert {(r["ano"], r["mes"]) for r in spark.read.parquet(lay.silver).collect()} == {(2010, 1), (2010, 2)}
    assert spark.read.parquet(lay.gold("serie_temporal_brasil")).count() == 2


def test_missing_write_metrics_remove_nothing(spark, tmp_lake):
    from ledgerline.sinks.tables import _empty_months

    path = tmp_lake + "/t"
    write_partitioned(_two_months(spark, tmp_lake), path)
    for seen in ({}, {"months": []}, {"rows": 3, "months": []}):
        with pytest.raises(RuntimeError):
            _empty_months(spark, path, [(2023, 1), (2023, 2)], seen)
    assert spark.read.parquet(path).count() == 7


def test_stored_extra_columns_are_read(spark, tmp_lake):
    lay = Layout(root=tmp_lake)
    _land(lay.landing, "202301", ["202301;SP;1;A;c;1;N;10,00"])
    _land(lay.landing, "202302", ["202302;SP;1;A;c;2;N;10,00;x"], header=HEADER + ";LOTE")
    P.ingest_bronze(spark, lay, [(2023, 1)])
    P.ingest_bronze(spark, lay, [(2023, 2)])
    both = P.scan_periods(spark, lay.bronze, [(2023, 1), (2023, 2)])
    assert {(r["mes"], r["LOTE"]) for r in both.collect()} == {(1, None), (2, "x")}
    assert "LOTE" in P.scan_year(spark, lay.bronze, 2023).columns


def test_silver_drops_foreign_period_rows(spark, tmp_lake):
    lay = Layout(root=tmp_lake)
    _land(lay.landing, "202301", ["202301;SP;1;A;c;1;N;10,00", "202212;SP;1;A;c;2;N;11,00"])
    P.ingest_bronze(spark, lay, [(2023, 1)])
    silver, m = P.transform_silver(spark, lay, [(2023, 1)])
    assert silver.count() == 1
    assert m.raw == 2 and m.foreign_period == 1 and m.kept == 1
    assert spark.read.parquet(lay.silver).filter("ano = 2022").count() == 0


def test_jdbc_options_truncate():
    opts = jdbc_options(url="jdbc:postgresql://h/db", table="gold.t", user="u", password="p", driver="org.postgresql.Driver")
    assert opts["truncate"] == "true" and opts["dbtable"] == "gold.t"


def test_quoted_newline_in_one_task(spark, tmp_lake):
    land = tmp_lake + "/landing"
    _land(land, "202301", ['202301;SP;1;"SAO\nPAULO";c;1;N;10,00', "202301;RJ;2;RIO;c;2;N;20,00"])
    df = R.read_landing(spark, land, multi_line=True)
    rows = {r["NIS_FAVORECIDO"]: r for r in df.collect()}
    assert len(rows) == 2 and rows["1"]["NOME_MUNICIPIO"] == "SAO\nPAULO"


def test_row_fingerprint_ignores_order_and_splits(spark, tmp_lake):
    land = tmp_lake + "/landing"
    lines = [f"202301;SP;1;A;c;{i};N;{i},00" for i in range(50)]
    _land(land, "202301", lines, name="a.csv")
    _land(land, "202302", [l.replace("202301", "202302") for l in lines], name="b.csv")
    _land(land, "202303", list(reversed(lines)), name="c.csv")
    raw = R.read_landing(spark, land)
    fp = {r["_hash_path"].rsplit("/", 1)[-1]: r["_file_hash"] for r in R.row_fingerprints(raw).collect()}
    assert fp["a.csv"] == fp["c.csv"] != fp["b.csv"]
    assert fp["a.csv"].endswith(":50")
    b = R.with_bronze_audit(spark, raw.repartition(7), land, None, file_hash="rows")
    assert b.filter(F.col("_file_hash").isNull()).count() == 0


def test_read_periods_lists_only_requested_months(spark, tmp_lake):
    from ledgerline.sinks.tables import read_periods

    path = tmp_lake + "/t"
    write_partitioned(_two_months(spark, tmp_lake), path)
    df = read_periods(spark, path, [(2023, 2), (2024, 5)])
    assert df.count() == 4 and set(df.columns) >= {"ano", "mes", "UF"}
    assert all("mes=2" in f for f in df.inputFiles())
    assert read_periods(spark, path, [(2030, 1)]) is None


def test_bronze_table_follows_contract(spark, tmp_lake):
    from ledgerline.schemas import BRONZE_SCHEMA

    lay = Layout(root=tmp_lake)
    _land(lay.landing, "202301", ["202301;SP;1;A;c;1;N;10,00"])
    df = P.ingest_bronze(spark, lay, [(2023, 1)])
    assert sorted(df.columns) == sorted(f.name for f in BRONZE_SCHEMA.fields)
    types = dict(df.dtypes)
    assert all(types[f.name] == f.dataType.simpleString() for f in BRONZE_SCHEMA.fields)


def test_delta_replace_where_predicate():
    from ledgerline.sinks.tables import replace_where

    assert replace_where([(2023, 2), (2023, 1), (2023, 1)]) == "(ano = 2023 AND mes = 1) OR (ano = 2023 AND mes = 2)"
    with pytest.raises(ValueError):
        replace_where([])


def test_landed_periods_from_folder_names(spark, tmp_lake):
    land = tmp_lake + "/landing"
    _land(land, "202301", ["202301;SP;1;A;c;1;N;10,00"])
    _land(land, "199912", ["199912;SP;1;A;c;1;N;10,00"])
    assert R.landed_periods(spark, land) == [(1999, 12), (2023, 1)]
