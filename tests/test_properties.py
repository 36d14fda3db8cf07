"""Random raw rows: Spark Silver/Gold equal a brute-force pandas version."""

from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.operators import gold as G
from ledgerline.operators import silver as S
from ledgerline.schemas import RAW_SCHEMA, VALID_UFS

UFS = st.sampled_from(VALID_UFS[:4] + ["XX", " sp ", None])
VALUES = st.one_of(
    st.integers(min_value=-5000, max_value=500000).map(lambda c: f"{c // 100:,}".replace(",", ".") + f",{abs(c) % 100:02d}"),
    st.sampled_from(["abc", None, "0,00"]),
)
ROW = st.tuples(
    st.sampled_from(["202301", "202302", "2023", None]),
    UFS,
    st.sampled_from(["1", "2", None]),
    st.sampled_from(["a", "B ", None]),
    st.just("***"),
    st.sampled_from(["11", "22", "33", None]),
    st.sampled_from(["x", "y"]),
    VALUES,
)


def brute_silver(rows):
    out = {}
    for mc, uf, cod, mun, _cpf, nis, nome, val in rows:
        try:
            v = float(val.replace(".", "").replace(",", ".")) if val is not None else None
        except ValueError:
            v = None
        ano = int(mc[:4]) if mc and mc[:4].isdigit() else None
        mes = int(mc[4:6]) if mc and len(mc) >= 6 and mc[4:6].isdigit() else None
        u = uf.strip(" ").upper() if uf is not None else None
        m = mun.strip(" ").upper() if mun is not None else None
        n = nome.strip(" ").upper()
        if v is None or not v > 0 or u not in VALID_UFS:
            continue
        if nis is None or ano is None or mes is None:
            continue
        key = (ano, mes, nis)
        rank = (-v, cod is None, cod or "", u, m is None, m or "", n)
        if key not in out or rank < out[key][0]:
            out[key] = (rank, dict(uf=u, codigo_municipio=cod, nome_municipio=m, nis_favorecido=nis,
                                   nome_favorecido=n, valor_parcela=v, ano=ano, mes=mes))
    return [r for _, r in out.values()]


def half_up(x, n):
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-n), rounding=ROUND_HALF_UP))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=0, max_size=40))
def test_silver_and_gold_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, RAW_SCHEMA)
    silver = S.clean(df).select(
        "uf", "codigo_municipio", "nome_municipio", "nis_favorecido", "nome_favorecido", "valor_parcela", "ano", "mes"
    )
    got = sorted((tuple(sorted(r.asDict().items())) for r in silver.collect()), key=repr)
    exp_rows = brute_silver(rows)
    exp = sorted((tuple(sorted(r.items())) for r in exp_rows), key=repr)
    assert got == exp

    if not exp_rows:
        return
    pdf = pd.DataFrame(exp_rows)
    pdf["cents"] = pdf["valor_parcela"].map(lambda v: Decimal(repr(v)).quantize(Decimal("0.01")))
    g = pdf.groupby(["ano", "mes", "uf"]).agg(n=("nis_favorecido", "count"), s=("cents", "sum")).reset_index()
    exp_uf = sorted(
        ((r.ano, r.mes, r.uf, r.n, float(r.s), half_up(float(r.s) / r.n, 2)) for r in g.itertuples()), key=repr
    )
    got_uf = sorted((tuple(r) for r in G.agg_por_uf_mes(S.clean(df)).collect()), key=repr)
    assert got_uf == exp_uf
