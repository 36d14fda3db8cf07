"""Silver rules: raw strings -> typed, valid, one row per natural key.

Each rule is a pure ``DataFrame -> DataFrame`` function so it can be tested
alone; ``clean`` chains them in the required order (validity before the null
filter, dedup last). Nothing here triggers a Spark action.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import MONEY_LIMIT, normalize_text, parse_brl, period_key, period_month, period_year
from ledgerline.schemas import (
    COLUMN_MAP,
    CRITICAL_COLUMNS,
    NATURAL_KEY,
    SILVER_COLUMNS,
    SILVER_VERSION,
    VALID_UFS,
)

TEXT_COLUMNS = ["uf", "nome_municipio", "nome_favorecido"]

# Total order inside a natural key: highest value first, then every other
# kept column, so the surviving row never depends on partition order.
def dedup_order() -> list[F.Column]:
    return [
        F.col("valor_parcela").desc_nulls_last(),
        F.col("codigo_municipio").asc_nulls_last(),
        F.col("uf").asc_nulls_last(),
        F.col("nome_municipio").asc_nulls_last(),
        F.col("nome_favorecido").asc_nulls_last(),
    ]


def rename_columns(df: DataFrame) -> DataFrame:
    """Raw header names -> snake_case working names (only those present)."""
    return df.withColumnsRenamed({k: v for k, v in COLUMN_MAP.items() if k in df.columns})


def parse_valor(df: DataFrame) -> DataFrame:
    """``valor_parcela_raw`` (``'1.234,56'``) -> ``valor_parcela`` double."""
    return df.withColumn("valor_parcela", parse_brl("valor_parcela_raw")).drop("valor_parcela_raw")


def extract_periodo(df: DataFrame) -> DataFrame:
    """``competencia`` ``YYYYMM`` -> ``ano``, ``mes`` (replaces any existing ones)."""
    return df.withColumns(
        {"ano": period_year("competencia"), "mes": period_month("competencia")}
    )


def normalize_strings(df: DataFrame) -> DataFrame:
    """Upper + trim of the descriptive text columns that are present."""
    return df.withColumns({c: normalize_text(c) for c in TEXT_COLUMNS if c in df.columns})


def valid_row() -> F.Column:
    """Positive value below ``MONEY_LIMIT`` (so neither infinite nor NaN, which sorts
    above every number) and a known UF. NULLs do not pass."""
    v = F.col("valor_parcela")
    return (v > 0) & (v < F.lit(MONEY_LIMIT)) & F.col("uf").isin(VALID_UFS)


def filter_invalid_values(df: DataFrame) -> DataFrame:
    return df.filter(valid_row())


def complete_row(cols: list[str] | None = None) -> F.Column:
    cond = None
    for c in cols or CRITICAL_COLUMNS:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return cond


def filter_nulls(df: DataFrame) -> DataFrame:
    """Drop rows NULL in any critical column."""
    return df.dropna(subset=CRITICAL_COLUMNS)


def deduplicate(df: DataFrame) -> DataFrame:
    """Keep one row per ``(nis_favorecido, ano, mes)``: the highest value.

    ``row_number() == 1`` is planned as a partial ``WindowGroupLimit`` before
    the shuffle and a final one after it, so a hot key is cut to one row per
    map task before it is sent anywhere.
    """
    w = Window.partitionBy(*NATURAL_KEY).orderBy(*dedup_order())
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def in_periods(periods: list[tuple[int, int]]) -> F.Column:
    """Row period among the requested ``(year, month)`` pairs."""
    keys = sorted({y * 100 + m for y, m in periods})
    return period_key("ano", "mes").isin(keys)


def prepare(raw: DataFrame) -> DataFrame:
    """Rename, parse, derive period, normalise: the typed row before filtering."""
    return normalize_strings(extract_periodo(parse_valor(rename_columns(raw))))


def clean(raw: DataFrame) -> DataFrame:
    """All Silver rules, without audit columns."""
    return deduplicate(filter_nulls(filter_invalid_values(prepare(raw))))


def with_silver_audit(df: DataFrame, run_ts: _dt.datetime | None = None) -> DataFrame:
    """Add ``dt_ingestao`` (one run timestamp, UTC) and ``_silver_version``;
    project the Silver contract (drops ``competencia``, ``cpf_favorecido``)."""
    ts = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return df.withColumns(
        {
            "dt_ingestao": F.lit(ts.isoformat(sep=" ")).cast("timestamp"),
            "_silver_version": F.lit(SILVER_VERSION),
        }
    ).select(*SILVER_COLUMNS)


def _fate(periods: list[tuple[int, int]] | None) -> F.Column:
    """What becomes of a typed row before the dedup: foreign, invalid, null or ok."""
    foreign = ~in_periods(periods) if periods else F.lit(False)
    return (
        F.when(foreign, F.lit("foreign"))
        .when(~F.coalesce(valid_row(), F.lit(False)), F.lit("invalid"))
        .when(~complete_row(), F.lit("null"))
        .otherwise(F.lit("ok"))
    )


def fates(raw: DataFrame, periods: list[tuple[int, int]] | None = None) -> DataFrame:
    """One row: raw, foreign_period, invalid, nulls, ok.

    Every partition sends one row of counts through a shuffle, and a shuffle holds one attempt of
    each partition, so a map task that is run again replaces its counts instead of adding to them.
    """
    fate = prepare(raw).select(_fate(periods).alias("fate"))
    named = {"foreign_period": "foreign", "invalid": "invalid", "nulls": "null", "ok": "ok"}
    return fate.agg(F.count(F.lit(1)).alias("raw"), *(F.count_if(F.col("fate") == v).alias(k) for k, v in named.items()))


def funnel(raw: DataFrame, periods: list[tuple[int, int]] | None = None) -> DataFrame:
    """One row of counts: raw, foreign period, invalid, null, duplicate, kept.

    Row fates come from one scan; duplicates and kept rows from a per-key
    count (partial aggregation combines a hot key map-side, no row is
    gathered per key).
    """
    staged = prepare(raw).select(*NATURAL_KEY, _fate(periods).alias("_fate"))
    per_key = (
        staged.groupBy(*NATURAL_KEY, "_fate")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ok = F.col("_fate") == "ok"
    return per_key.agg(
        F.sum("_n").cast("long").alias("raw"),
        F.sum(F.when(F.col("_fate") == "foreign", F.col("_n")).otherwise(0)).cast("long").alias("foreign_period"),
        F.sum(F.when(F.col("_fate") == "invalid", F.col("_n")).otherwise(0)).cast("long").alias("invalid"),
        F.sum(F.when(F.col("_fate") == "null", F.col("_n")).otherwise(0)).cast("long").alias("nulls"),
        F.sum(F.when(ok, F.col("_n") - 1).otherwise(0)).cast("long").alias("duplicates"),
        F.sum(F.when(ok, 1).otherwise(0)).cast("long").alias("kept"),
    )
