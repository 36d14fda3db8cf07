from pyspark.sql import functions as F

from ledgerline.operators import gold as G
from ledgerline.schemas import GOLD_SCHEMAS, column_names


def _by(df, *keys):
    def key(r):
        return r[keys[0]] if len(keys) == 1 else tuple(r[k] for k in keys)

    return {key(r): r.asDict() for r in df.collect()}


def test_por_uf_mes_values(silver_fixture):
    df = G.agg_por_uf_mes(silver_fixture)
    assert df.columns == column_names(GOLD_SCHEMAS["transferencias_por_uf_mes"])
    assert sorted(tuple(r) for r in df.collect()) == [
        (2020, 12, "BA", 4, 400.3, 100.08),  # 400.30 / 4 = 100.075, half up
        (2020, 12, "SC", 1, 64.0, 64.0),
        (2021, 1, "AM", 1, 99.99, 99.99),
        (2021, 1, "BA", 1, 130.0, 130.0),
        (2021, 1, "SC", 2, 100.0, 50.0),
    ]


def test_top_municipios_ranking(silver_fixture):
    rows = sorted((r["ano"], r["ranking_nacional"], r["nome_municipio"]) for r in G.agg_top_municipios(silver_fixture).collect())
    # one beneficiary each in Ilheus and Florianopolis, and in Salvador and Manaus: the larger value first
    assert rows == [
        (2020, 1, "SALVADOR"), (2020, 2, "ILHEUS"), (2020, 3, "FLORIANOPOLIS"),
        (2021, 1, "FLORIANOPOLIS"), (2021, 2, "SALVADOR"), (2021, 3, "MANAUS"),
    ]


def test_serie_temporal(silver_fixture):
    rows = [tuple(r) for r in G.agg_serie_temporal(silver_fixture).orderBy("ano_mes").collect()]
    assert rows == [("2020-12", 5, 464.3, None), ("2021-01", 4, 329.99, -20.0)]


def test_gold_tables_share_one_preaggregate(silver_fixture):
    t = G.gold_tables(silver_fixture)
    assert set(t) == set(GOLD_SCHEMAS)
    assert all(df.count() > 0 for df in t.values())


def test_money_sum_is_exact(spark):
    rows = [(2023, 1, "SP", "1", "M", str(i), "N", 0.1) for i in range(10)]
    df = spark.createDataFrame(rows, "ano int, mes int, uf string, codigo_municipio string, nome_municipio string, nis_favorecido string, nome_favorecido string, valor_parcela double")
    r = G.agg_por_uf_mes(df).first()
    assert r["total_valor_brl"] == 1.0  # a double sum gives 0.9999999999999999
    assert r["media_valor_brl"] == 0.1


def test_fractions_of_a_cent_add_up(spark):
    rows = [(2023, 1, "SP", "1", "M", str(i), "N", 0.004) for i in range(1000)]
    rows += [(2023, 2, "SP", "1", "M", str(i), "N", 9.9e19) for i in range(50)]
    df = spark.createDataFrame(rows, "ano int, mes int, uf string, codigo_municipio string, nome_municipio string, nis_favorecido string, nome_favorecido string, valor_parcela double")
    got = {r["mes"]: (r["total_beneficios"], r["total_valor_brl"]) for r in G.agg_por_uf_mes(df).collect()}
    assert got == {1: (1000, 4.0), 2: (50, 4.95e21)}
    assert {r["mes"]: r["total_valor_brl"] for r in G.agg_por_uf_mes(G.pre_aggregate(df)).collect()} == {1: 4.0, 2: 4.95e21}


def test_typed_contract(silver_fixture):
    typed = G.typed_contract(G.agg_top_municipios(silver_fixture), "top_municipios_beneficios", with_created_at=True)
    types = dict(typed.dtypes)
    assert types["total_valor_brl"] == "decimal(18,2)" and "municipio" in types and "codigo_ibge" in types
    assert types["created_at"] == "timestamp"
    v = G.contract_violations(typed, "top_municipios_beneficios").first()
    assert (v["null_violations"], v["unique_violations"]) == (0, 0)


def test_contract_unique_ano_mes(silver_fixture):
    serie = G.typed_contract(G.agg_serie_temporal(silver_fixture), "serie_temporal_brasil")
    v = G.contract_violations(serie.unionByName(serie.limit(1)), "serie_temporal_brasil").first()
    assert (v["null_violations"], v["unique_violations"]) == (0, 1)
