"""Registered queries: one callable per operator key, over the test tables.

Every query starts from the payment rows projected from ``orders ⋈
customer ⋈ nation`` of the given scale-factor folder (whole tables), so its
work grows with the data. Write-path queries stage the rows as landing files
under the session's checkpoint folder and run the real jobs on them.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import gold as G
from ledgerline.operators import quality as Q
from ledgerline.operators import silver as S
from ledgerline.plans import pipeline as P
from ledgerline.plans import reports as RP
from ledgerline.schemas import BRONZE_SCHEMA, RAW_COLUMNS
from ledgerline.settings import Layout, work_dir
from ledgerline.sinks.tables import _fs, delete_path, read_table
from ledgerline.sources import raw_csv as R
from ledgerline.sources.feed import payments_feed

# Fixed query parameters (period filters of the scan operators).
SCAN_YEAR = 1998
SCAN_MONTH = 7
REPLACED_PERIODS = [(1996, 1), (1998, 7)]
MARK = "again "  # put before the names of rows that are delivered a second time
EVOLVED_SINCE = 1998  # year from which on the files have one more column
STREAM_FILES_PER_TRIGGER = 40  # several micro-batches over the staged files

SILVER_OUT = ["uf", "codigo_municipio", "nome_municipio", "nis_favorecido", "nome_favorecido", "valor_parcela", "ano", "mes"]

Query = Callable[[SparkSession, str], DataFrame]


def feed(spark: SparkSession, sf: str) -> DataFrame:
    return payments_feed(spark, sf)


def gold(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return G.gold_tables(S.clean(feed(spark, sf)), [table])[table]


# ---------------------------------------------------------------- staging

_LANDED: dict[tuple, str] = {}
FEED_TABLES = ["orders", "customer", "nation"]


def _state(spark: SparkSession, sf: str) -> tuple:
    """Files of the feed's tables with their sizes and times: changes when a table does."""
    out = []
    for t in FEED_TABLES:
        fs, p = _fs(spark, f"{sf}/{t}.parquet")
        for st in [*fs.listStatus(p)]:
            out.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return tuple(sorted(out))


def landed(spark: SparkSession, sf: str) -> str:
    """Landing folder holding the feed as monthly files (written once per
    session and state of the tables, then only read). Its name has a space,
    which Spark reports URL-encoded."""
    key = (spark.sparkContext.applicationId, sf, _state(spark, sf))
    if key not in _LANDED:
        path = work_dir(spark) + "/landing files"
        R.write_landing(feed(spark, sf), path)
        _LANDED[key] = path
    return _LANDED[key]


def landed_again(spark: SparkSession, sf: str) -> str:
    """A landing folder with only ``REPLACED_PERIODS``, delivered anew with marked names."""
    path = work_dir(spark) + "/landing"
    months = [str(y * 100 + m) for y, m in REPLACED_PERIODS]
    rows = feed(spark, sf).filter(F.col("MES_COMPETENCIA").isin(months))
    R.write_landing(rows.withColumn("NOME_FAVORECIDO", F.concat(F.lit(MARK), "NOME_FAVORECIDO")), path)
    return path


def odd_month() -> F.Column:
    return F.col("MES_COMPETENCIA").cast("int") % 2 == 1


def fresh_layout(spark: SparkSession, sf: str) -> Layout:
    """A new lake whose landing folder holds the staged feed."""
    return Layout(root=work_dir(spark), landing_dir=landed(spark, sf))


def all_periods(spark: SparkSession, landing: str) -> list[tuple[int, int]]:
    """Months present in the landing folder (from the folder names)."""
    return R.landed_periods(spark, landing)


# ---------------------------------------------------------------- queries


def q_silver_rename(spark, sf):
    return S.rename_columns(feed(spark, sf))


def q_silver_parse_valor(spark, sf):
    return S.parse_valor(S.rename_columns(feed(spark, sf)))


def q_silver_periodo(spark, sf):
    return S.extract_periodo(S.parse_valor(S.rename_columns(feed(spark, sf))))


def q_silver_normalize(spark, sf):
    return S.prepare(feed(spark, sf))


def q_silver_filter_invalid(spark, sf):
    return S.filter_invalid_values(S.prepare(feed(spark, sf)))


def q_silver_filter_nulls(spark, sf):
    return S.filter_nulls(S.filter_invalid_values(S.prepare(feed(spark, sf))))


def q_silver_dedup(spark, sf):
    return S.clean(feed(spark, sf))


def q_silver_full(spark, sf):
    return S.with_silver_audit(S.clean(feed(spark, sf))).drop("dt_ingestao")


def q_silver_funnel(spark, sf):
    return S.funnel(feed(spark, sf))


def q_gold_por_uf_mes(spark, sf):
    return G.agg_por_uf_mes(S.clean(feed(spark, sf)))


def q_gold_top_municipios(spark, sf):
    return G.agg_top_municipios(S.clean(feed(spark, sf)))


def q_gold_serie_temporal(spark, sf):
    return G.agg_serie_temporal(S.clean(feed(spark, sf)))


def q_gold_typed_contract(spark, sf):
    return G.typed_contract(gold(spark, sf, "top_municipios_beneficios"), "top_municipios_beneficios")


def q_gold_typed_uf_mes(spark, sf):
    return G.typed_contract(gold(spark, sf, "transferencias_por_uf_mes"), "transferencias_por_uf_mes")


def q_gold_typed_serie(spark, sf):
    return G.typed_contract(gold(spark, sf, "serie_temporal_brasil"), "serie_temporal_brasil")


def q_gold_contract_check(spark, sf):
    table = "serie_temporal_brasil"
    return G.contract_violations(G.typed_contract(gold(spark, sf, table), table), table)


def _g(name):
    def pick(spark, sf):
        return gold(spark, sf, name)

    return pick


_UF, _MUN, _SERIE = (
    _g("transferencias_por_uf_mes"),
    _g("top_municipios_beneficios"),
    _g("serie_temporal_brasil"),
)

REPORTS: dict[str, tuple[Callable, Callable]] = {
    "report_q1": (RP.report_monthly, _SERIE),
    "report_q2": (RP.report_uf_latest, _UF),
    "report_q3": (RP.report_top_municipalities, _MUN),
    "report_q4": (RP.report_regions, _UF),
    "report_q5": (RP.report_growth, _SERIE),
    "report_q6": (RP.report_ticket, _UF),
    "report_top_ufs": (RP.report_top_ufs, _UF),
    "report_growth_raw": (RP.report_growth_raw, _SERIE),
    "report_top10": (RP.report_top10, _MUN),
    "nb_top_ufs": (RP.nb_top_ufs, _UF),
    "nb_top_municipios": (RP.nb_top_municipios, _MUN),
    "nb_serie": (RP.nb_serie, _SERIE),
}


def _report(fn, table):
    def q(spark, sf):
        return fn(table(spark, sf))

    return q


def q_gold_exact_sums(spark, sf):
    """UF months over amounts with fractions of a cent, large ones, and ones that
    no amount column can hold."""
    k = F.col("o_orderkey")
    raw = payments_feed(spark, sf, with_row_id=True)
    value = (
        F.when(k % 5 == 0, F.lit("0,004"))
        .when(k % 7 == 0, F.lit("10.000.000.000,126"))
        .when(k % 11 == 0, F.lit("100.000.000.000.000.000.000,00"))
        .when(k % 13 == 0, F.lit("Infinity"))
        .otherwise(F.col("VALOR_PARCELA"))
    )
    return G.agg_por_uf_mes(S.clean(raw.withColumn("VALOR_PARCELA", value).drop("o_orderkey")))


def q_dq_report(spark, sf):
    """The payment rows are read once: counted on their way into the pre-aggregate, which
    is written, and from which the Silver count and the Gold tables follow."""
    seen = Observation(f"dq_{uuid.uuid4().hex[:12]}")
    raw = feed(spark, sf).observe(seen, F.count(F.lit(1)).alias("n"))
    path = work_dir(spark) + "/pre"
    G.pre_aggregate(S.clean(raw)).write.parquet(path)
    pre = spark.read.schema(G.PRE_SCHEMA).parquet(path)
    counts = Q.layer_counts({"bronze": None, "silver": None} | G.roll_up(pre))
    counts = counts.unionByName(pre.agg(F.sum("_n").cast("double").alias("n")).select(F.lit("silver").alias("item"), "n"))
    return Q.checks(counts.unionByName(spark.createDataFrame([("bronze", float(seen.get["n"]))], counts.schema)))


# ---------------------------------------------------------------- write path


def q_bronze_csv_roundtrip(spark, sf):
    return R.read_landing(spark, landed(spark, sf)).select(*RAW_COLUMNS)


def q_bronze_quoted_newlines(spark, sf):
    """Names of some payments hold a separator, a quote and a line break."""
    path = work_dir(spark) + "/landing"
    name = F.col("NOME_FAVORECIDO")
    broken = F.when(F.col("VALOR_PARCELA").endswith("7"), F.replace(name, F.lit("#"), F.lit(';"\n'))).otherwise(name)
    R.write_landing(feed(spark, sf).withColumn("NOME_FAVORECIDO", broken), path)
    lay = Layout(root=work_dir(spark), landing_dir=path)
    return P.ingest_bronze(spark, lay, all_periods(spark, path)).select(*RAW_COLUMNS, "ano", "mes")


def q_bronze_tree_digest(spark, sf):
    landing = landed(spark, sf)
    b = R.with_bronze_audit(spark, R.read_landing(spark, landing), landing, None, file_hash="tree")
    return b.select(*RAW_COLUMNS, "ano", "mes", F.col("_file_hash").rlike("^tree:[0-9a-f]{64}:[1-9][0-9]*$").alias("has_tree"))


def q_bronze_audit(spark, sf):
    landing = landed(spark, sf)
    raw = R.read_landing(spark, landing)
    b = R.with_bronze_audit(spark, raw, landing, None)
    name = F.col("_file_name")
    return b.select(
        *RAW_COLUMNS, "ano", "mes",
        F.col("_file_hash").startswith("rows:").alias("has_file_hash"),
        F.col("_source").contains("/landing files/").alias("has_source"),
        F.col("_source").endswith(F.concat(F.lit("/"), name)).alias("has_file_name"),
    )


def q_bronze_mixed_layouts(spark, sf):
    """Files of odd months have their columns in reverse order and one more column."""
    path = work_dir(spark) + "/landing"
    rows = feed(spark, sf)
    R.write_landing(rows.filter(~odd_month()), path)
    lot = F.concat(F.lit("lote "), "MES_COMPETENCIA").alias("LOTE")
    R.write_landing(rows.filter(odd_month()).select(lot, *reversed(RAW_COLUMNS)), path, columns=["LOTE", *reversed(RAW_COLUMNS)], mode="append")
    lay = Layout(root=work_dir(spark), landing_dir=path)
    return P.ingest_bronze(spark, lay, all_periods(spark, path)).select(*RAW_COLUMNS, "LOTE", "ano", "mes")


def q_bronze_schema_evolution(spark, sf):
    """Months stored before and after the files got another column read together."""
    path = work_dir(spark) + "/landing"
    rows = feed(spark, sf)
    later = F.col("MES_COMPETENCIA").substr(1, 4).cast("int") >= EVOLVED_SINCE
    R.write_landing(rows.filter(~later), path)
    R.write_landing(rows.filter(later).withColumn("LOTE", F.col("MES_COMPETENCIA")), path, columns=[*RAW_COLUMNS, "LOTE"], mode="append")
    lay = Layout(root=work_dir(spark), landing_dir=path)
    periods = all_periods(spark, path)
    for part in ([p for p in periods if p[0] < EVOLVED_SINCE], [p for p in periods if p[0] >= EVOLVED_SINCE]):
        if part:
            P.ingest_bronze(spark, lay, part)
    return read_table(spark, lay.bronze, schema=BRONZE_SCHEMA, extra=True).select(*RAW_COLUMNS, "LOTE", "ano", "mes")


def _bronze_all(spark, sf) -> tuple[Layout, list]:
    lay = fresh_layout(spark, sf)
    periods = all_periods(spark, lay.landing)
    P.ingest_bronze(spark, lay, periods, overwrite=True)
    return lay, periods


def q_scan_period(spark, sf):
    lay, _ = _bronze_all(spark, sf)
    return P.scan_periods(spark, lay.bronze, [(SCAN_YEAR, SCAN_MONTH)]).select(*RAW_COLUMNS, "ano", "mes")


def q_scan_year(spark, sf):
    lay, periods = _bronze_all(spark, sf)
    P.transform_silver(spark, lay, periods, overwrite=True)
    return P.scan_year(spark, lay.silver, SCAN_YEAR).select(*SILVER_OUT, "_silver_version")


FIRST_RUN = _dt.datetime(2024, 1, 1)


def _rerun(spark, sf, periods, overwrite: bool) -> DataFrame:
    """All months, then a second run from the landing that holds the marked months."""
    lay = fresh_layout(spark, sf)
    P.ingest_bronze(spark, lay, all_periods(spark, lay.landing), run_ts=FIRST_RUN)
    again = replace(lay, landing_dir=landed_again(spark, sf))
    P.ingest_bronze(spark, again, periods or all_periods(spark, lay.landing), overwrite=overwrite)
    first = F.col("_ingested_at") == F.lit(FIRST_RUN.isoformat())
    return spark.read.parquet(lay.bronze).select(*RAW_COLUMNS, "ano", "mes", first.alias("first_run"))


def q_bronze_partition_replace(spark, sf):
    """The months delivered again hold the new rows, the others the old ones."""
    return _rerun(spark, sf, REPLACED_PERIODS, overwrite=True)


def q_bronze_idempotent(spark, sf):
    """Months that exist are skipped although their files have changed."""
    return _rerun(spark, sf, REPLACED_PERIODS, overwrite=False)


def q_bronze_content_skip(spark, sf):
    """The landing has two months delivered again beside the old files of the others: those two are replaced
    without being named, the others are not written again."""
    path = work_dir(spark) + "/landing"
    rows = feed(spark, sf)
    R.write_landing(rows, path)
    lay = Layout(root=work_dir(spark), landing_dir=path)
    periods = all_periods(spark, path)
    P.ingest_bronze(spark, lay, periods, run_ts=FIRST_RUN)
    name = F.concat(F.lit(MARK), "NOME_FAVORECIDO")
    for y, m in REPLACED_PERIODS:
        delete_path(spark, f"{path}/{R.PERIOD_DIR}={y * 100 + m}")
    replaced = rows.filter(F.col("MES_COMPETENCIA").isin([str(y * 100 + m) for y, m in REPLACED_PERIODS]))
    R.write_landing(replaced.withColumn("NOME_FAVORECIDO", name), path, mode="append")
    P.ingest_bronze(spark, lay, periods, by_content=True)
    first = F.col("_ingested_at") == F.lit(FIRST_RUN.isoformat())
    return spark.read.parquet(lay.bronze).select(*RAW_COLUMNS, "ano", "mes", first.alias("first_run"))


def q_bronze_partial_landing(spark, sf):
    """All months are asked for again while only two are in the landing: the rest stay."""
    return _rerun(spark, sf, None, overwrite=True)


def q_silver_partition_replace(spark, sf):
    """Bronze has two months delivered again; Silver is told to replace the first of
    them and to add what is missing, which is nothing."""
    lay, periods = _bronze_all(spark, sf)
    P.transform_silver(spark, lay, periods, overwrite=True)
    P.ingest_bronze(spark, replace(lay, landing_dir=landed_again(spark, sf)), REPLACED_PERIODS, overwrite=True)
    P.transform_silver(spark, lay, REPLACED_PERIODS[:1], overwrite=True)
    P.transform_silver(spark, lay, periods, overwrite=False)  # all present: skipped
    return spark.read.parquet(lay.silver).select(*SILVER_OUT)


def q_gold_mixed_scopes(spark, sf):
    """Months reach Gold by a batch run, by a Silver-only run and by a streaming run."""
    from ledgerline.streaming.landing import run_available

    lay = fresh_layout(spark, sf)
    periods = all_periods(spark, lay.landing)
    P.run(spark, lay, periods[::3])
    P.run(spark, lay, periods[1::3], layers=("bronze", "silver"))
    rest = work_dir(spark) + "/landing"
    months = [str(y * 100 + m) for y, m in periods[2::3]]
    R.write_landing(feed(spark, sf).filter(F.col("MES_COMPETENCIA").isin(months)), rest)
    run_available(spark, replace(lay, landing_dir=rest), checkpoint=work_dir(spark) + "/stream")
    return spark.read.parquet(lay.gold("serie_temporal_brasil"))


def q_silver_funnel_observed(spark, sf):
    """The funnel counts that a Silver write reports, as a one-row frame."""
    lay, periods = _bronze_all(spark, sf)
    _, m = P.transform_silver(spark, lay, periods, overwrite=True)
    cols = ["raw", "foreign_period", "invalid", "nulls", "duplicates", "kept"]
    return spark.createDataFrame([tuple(int(getattr(m, c)) for c in cols)], ", ".join(f"{c} bigint" for c in cols))


def q_gold_table_roundtrip(spark, sf):
    lay, periods = _bronze_all(spark, sf)
    P.transform_silver(spark, lay, periods, overwrite=True)
    years = sorted({y for y, _ in periods})
    P.build_gold(spark, lay, years)  # the years of the periods
    return spark.read.parquet(lay.gold("top_municipios_beneficios"))


def q_pipeline_multi_month(spark, sf):
    lay = fresh_layout(spark, sf)
    periods = all_periods(spark, lay.landing)
    P.run(spark, lay, periods)
    return spark.read.parquet(lay.gold("transferencias_por_uf_mes"))


def q_streaming_incremental(spark, sf):
    """The file-driven incremental pipeline over the whole staged landing,
    in several micro-batches; returns the resulting national series."""
    from ledgerline.streaming.landing import run_available

    lay = fresh_layout(spark, sf)
    run_available(spark, lay, checkpoint=work_dir(spark) + "/stream", max_files_per_trigger=STREAM_FILES_PER_TRIGGER)
    return spark.read.parquet(lay.gold("serie_temporal_brasil"))


def q_report_sql_q4(spark, sf):
    """Region report through SQL text over the registered ``gold`` database."""
    lay, periods = _bronze_all(spark, sf)
    P.transform_silver(spark, lay, periods, overwrite=True)
    P.build_gold(spark, lay, sorted({y for y, _ in periods}))
    database = f"gold_{uuid.uuid4().hex[:8]}"
    P.register_gold(spark, lay, database)
    return spark.sql(RP.sql_text("report_q4", database))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "silver_rename": q_silver_rename,
        "silver_parse_valor": q_silver_parse_valor,
        "silver_periodo": q_silver_periodo,
        "silver_normalize": q_silver_normalize,
        "silver_filter_invalid": q_silver_filter_invalid,
        "silver_filter_nulls": q_silver_filter_nulls,
        "silver_dedup": q_silver_dedup,
        "silver_full": q_silver_full,
        "silver_funnel": q_silver_funnel,
        "gold_por_uf_mes": q_gold_por_uf_mes,
        "gold_top_municipios": q_gold_top_municipios,
        "gold_serie_temporal": q_gold_serie_temporal,
        "gold_typed_contract": q_gold_typed_contract,
        "gold_typed_uf_mes": q_gold_typed_uf_mes,
        "gold_typed_serie": q_gold_typed_serie,
        "gold_contract_check": q_gold_contract_check,
    }
    for name, (fn, table) in REPORTS.items():
        q[name] = _report(fn, table)
    q.update(
        {
            "dq_report": q_dq_report,
            "bronze_csv_roundtrip": q_bronze_csv_roundtrip,
            "bronze_quoted_newlines": q_bronze_quoted_newlines,
            "bronze_audit": q_bronze_audit,
            "bronze_tree_digest": q_bronze_tree_digest,
            "bronze_content_skip": q_bronze_content_skip,
            "bronze_mixed_layouts": q_bronze_mixed_layouts,
            "bronze_schema_evolution": q_bronze_schema_evolution,
            "bronze_partial_landing": q_bronze_partial_landing,
            "gold_exact_sums": q_gold_exact_sums,
            "gold_mixed_scopes": q_gold_mixed_scopes,
            "scan_period": q_scan_period,
            "scan_year": q_scan_year,
            "bronze_partition_replace": q_bronze_partition_replace,
            "bronze_idempotent": q_bronze_idempotent,
            "silver_partition_replace": q_silver_partition_replace,
            "silver_funnel_observed": q_silver_funnel_observed,
            "gold_table_roundtrip": q_gold_table_roundtrip,
            "pipeline_multi_month": q_pipeline_multi_month,
            "report_sql_q4": q_report_sql_q4,
            "streaming_incremental": q_streaming_incremental,
        }
    )
    return q
