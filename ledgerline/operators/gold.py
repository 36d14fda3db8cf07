"""Gold aggregates over Silver.

All three Gold tables are roll-ups of one pre-aggregate at the grain
``(ano, mes, uf, codigo_municipio, nome_municipio)``: Silver is scanned and
shuffled once (partial + final hash aggregation), and what survives is
bounded by months x municipalities, not by payments. The month-over-month change
runs on one row per month; municipalities, whose names are free text, are ranked by
range partitions (``ranking.numbered``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import ano_mes_label, exact_sum, pct_change, round_half_up, to_double, total_money
from ledgerline.operators.ranking import numbered
from ledgerline.schemas import GOLD_SCHEMAS, column_names

GRAIN = ["ano", "mes", "uf", "codigo_municipio", "nome_municipio"]
_N = "_n"  # count of beneficiaries (non-null NIS)
_S = "_s"  # exact sum of values, decimal(38,8)

PRE_SCHEMA = T.StructType(
    [
        T.StructField("ano", T.IntegerType()),
        T.StructField("mes", T.IntegerType()),
        T.StructField("uf", T.StringType()),
        T.StructField("codigo_municipio", T.StringType()),
        T.StructField("nome_municipio", T.StringType()),
        T.StructField(_N, T.LongType()),
        T.StructField(_S, T.DecimalType(38, 8)),
    ]
)

# Ranking order: most beneficiaries, then most value, then names (total order).
def rank_order() -> list[F.Column]:
    return [
        F.col("total_beneficios").desc(),
        F.col("total_valor_brl").desc_nulls_last(),
        F.col("uf").asc_nulls_last(),
        F.col("codigo_municipio").asc_nulls_last(),
        F.col("nome_municipio").asc_nulls_last(),
    ]


def pre_aggregate(silver: DataFrame) -> DataFrame:
    """Count and exact sum per finest Gold grain."""
    return silver.groupBy(*GRAIN).agg(
        F.count("nis_favorecido").alias(_N),
        exact_sum("valor_parcela").alias(_S),
    )


def _is_pre(df: DataFrame) -> bool:
    return _N in df.columns and _S in df.columns


def _rollup(df: DataFrame, keys: list[str]) -> DataFrame:
    """Count and exact sum at ``keys``, from Silver rows (one shuffle) or
    from the pre-aggregate (summing its partial counts and sums)."""
    if _is_pre(df):
        n, s = F.sum(_N), F.sum(_S)
    else:
        n, s = F.count("nis_favorecido"), exact_sum("valor_parcela")
    return df.groupBy(*keys).agg(
        n.cast("long").alias("total_beneficios"),
        s.cast("decimal(38,8)").alias(_S),
    )


def agg_por_uf_mes(df: DataFrame) -> DataFrame:
    """Per ``ano, mes, uf``: beneficiaries, total value, mean value (2 dp)."""
    out = _rollup(df, ["ano", "mes", "uf"]).select(
        "ano",
        "mes",
        "uf",
        "total_beneficios",
        total_money(_S).alias("total_valor_brl"),
        round_half_up(to_double(_S) / F.col("total_beneficios"), 2).alias("media_valor_brl"),
    )
    return out.select(*column_names(GOLD_SCHEMAS["transferencias_por_uf_mes"]))


def agg_top_municipios(df: DataFrame) -> DataFrame:
    """Per ``ano, nome_municipio, uf, codigo_municipio`` with national rank.

    The rank restarts per year (the Gold job always runs on one year). A year's
    municipalities are ranked by many tasks; the sorted rows are written once on the way.
    """
    agg = _rollup(df, ["ano", "nome_municipio", "uf", "codigo_municipio"]).select(
        "ano",
        "nome_municipio",
        "uf",
        "codigo_municipio",
        "total_beneficios",
        total_money(_S).alias("total_valor_brl"),
    )
    return numbered(agg, "ano", rank_order(), "ranking_nacional")


def agg_serie_temporal(df: DataFrame) -> DataFrame:
    """National monthly series with % change of beneficiaries vs. the
    previous available month (gaps are not filled)."""
    monthly = _rollup(df, ["ano", "mes"]).select(
        ano_mes_label("ano", "mes").alias("ano_mes"),
        "total_beneficios",
        total_money(_S).alias("total_valor_brl"),
    )
    # One row per month: a global ordering window is cheap here.
    w = Window.orderBy("ano_mes")
    prev = F.lag("total_beneficios", 1).over(w)
    return monthly.withColumn("variacao_pct", pct_change(F.col("total_beneficios"), prev, 4))


BUILDERS = {
    "transferencias_por_uf_mes": agg_por_uf_mes,
    "top_municipios_beneficios": agg_top_municipios,
    "serie_temporal_brasil": agg_serie_temporal,
}


def gold_tables(silver: DataFrame, names: Iterable[str] = tuple(BUILDERS)) -> dict[str, DataFrame]:
    """The Gold tables ``names`` from one pre-aggregate of ``silver``."""
    return roll_up(pre_aggregate(silver), names)


def roll_up(pre: DataFrame, names: Iterable[str] = tuple(BUILDERS)) -> dict[str, DataFrame]:
    """The Gold tables ``names`` from the pre-aggregate."""
    return {name: BUILDERS[name](pre) for name in names}


# Typed contract of the SQL copy (NUMERIC precision, published names).
TYPED_CONTRACT = {
    "transferencias_por_uf_mes": [
        ("ano", "int"),
        ("mes", "int"),
        ("uf", "string"),
        ("total_beneficios", "bigint"),
        ("total_valor_brl", "decimal(18,2)"),
        ("media_valor_brl", "decimal(12,2)"),
    ],
    "top_municipios_beneficios": [
        ("ano", "int"),
        ("nome_municipio AS municipio", "string"),
        ("uf", "string"),
        ("codigo_municipio AS codigo_ibge", "string"),
        ("total_beneficios", "bigint"),
        ("total_valor_brl", "decimal(18,2)"),
        ("ranking_nacional", "int"),
    ],
    "serie_temporal_brasil": [
        ("ano_mes", "string"),
        ("total_beneficios", "bigint"),
        ("total_valor_brl", "decimal(18,2)"),
        ("variacao_pct", "decimal(8,4)"),
    ],
}


def typed_contract(df: DataFrame, table: str, with_created_at: bool = False) -> DataFrame:
    """Project a Gold table onto the typed SQL contract (decimal amounts,
    published column names). ``try_cast`` turns an out-of-range value into
    NULL instead of failing; ``contract_violations`` reports those."""
    cols = []
    for spec, typ in TYPED_CONTRACT[table]:
        src, _, name = spec.partition(" AS ")
        name = name or src
        cols.append(F.col(src).try_cast(typ).alias(name))
    out = df.select(*cols)
    if with_created_at:
        out = out.withColumn("created_at", F.current_timestamp())
    return out


# Columns the SQL contract declares UNIQUE.
UNIQUE_KEYS = {"serie_temporal_brasil": ["ano_mes"]}


def contract_violations(typed: DataFrame, table: str) -> DataFrame:
    """One row: rows breaking NOT NULL (all but the nullable mean, change,
    code and rank columns) and duplicated UNIQUE keys (``ano_mes``)."""
    nullable = {"media_valor_brl", "variacao_pct", "codigo_ibge", "ranking_nacional"}
    required = [(spec.partition(" AS ")[2] or spec) for spec, _ in TYPED_CONTRACT[table]]
    bad = None
    for c in required:
        if c in nullable:
            continue
        cond = F.col(c).isNull()
        bad = cond if bad is None else bad | cond
    nulls = typed.agg(F.count(F.when(bad, 1)).cast("long").alias("null_violations"))
    keys = UNIQUE_KEYS.get(table)
    if not keys:
        return nulls.withColumn("unique_violations", F.lit(0).cast("long"))
    dups = (
        typed.groupBy(*keys)
        .count()
        .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("unique_violations"))
    )
    # both sides are single-row aggregates: combine them by union + fold,
    # not by a cross join
    return (
        nulls.select("null_violations", F.lit(None).cast("long").alias("unique_violations"))
        .unionByName(dups.select(F.lit(None).cast("long").alias("null_violations"), "unique_violations"))
        .agg(F.max("null_violations").alias("null_violations"), F.max("unique_violations").alias("unique_violations"))
    )
