"""Layer jobs: landing files -> Bronze -> Silver -> Gold, for a set of months.

One session runs any number of months in one job per layer (the months are
a predicate, not a loop of jobs), and Gold is rolled up once, over every month
Silver holds, after the months are in. Every write replaces whole months, so
re-running a month (or a retried task) never duplicates rows. A requested month
without input is reported (``not_landed``) and leaves what is stored alone.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerline.operators import gold as G
from ledgerline.operators import silver as S
from ledgerline.plans.deliveries import redelivered
from ledgerline.schemas import BRONZE_SCHEMA, GOLD_TABLES, SILVER_SCHEMA
from ledgerline.settings import Layout
from ledgerline.sinks.tables import (
    _fs,
    child_dirs,
    delete_path,
    existing_periods,
    forget_columns,
    note_columns,
    read_periods,
    stored_periods,
    write_jdbc,
    write_partitioned,
    write_table,
)
from ledgerline.sources import raw_csv as R

Period = tuple[int, int]


def _utc_now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def scan_periods(
    spark: SparkSession, path: str, periods: list[Period], fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """Layer rows of the given months, listing only their partition folders;
    an empty frame with the layer's declared schema when none of them exists.
    ``schema`` (by default the layer's) and the columns noted for the months say what is read."""
    schema = schema or (SILVER_SCHEMA if "/silver/" in path else BRONZE_SCHEMA)
    df = read_periods(spark, path, periods, fmt, schema, extra=schema is BRONZE_SCHEMA)
    return spark.createDataFrame([], schema) if df is None else df


def scan_year(spark: SparkSession, path: str, year: int, month: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Layer rows of one year, or of one month of it (only the folders of that year are listed)."""
    periods = [(year, m) for m in ([month] if month is not None else range(1, 13))]
    return scan_periods(spark, path, periods, fmt)


# ---------------------------------------------------------------- Bronze


def ingest_bronze(
    spark: SparkSession,
    layout: Layout,
    periods: list[Period],
    *,
    overwrite: bool = False,
    run_ts: _dt.datetime | None = None,
    source_label: str | None = None,
    file_hash: str | bool | None = "rows",
    multi_line: bool | None = None,
    rebalance: bool = False,
    by_content: bool = False,
) -> DataFrame:
    """Land the requested months into Bronze and return their Bronze rows.

    Months already in Bronze are skipped unless ``overwrite``. With ``by_content``
    (whatever ``overwrite`` is) they are skipped when their landed files are the
    stored ones, by name and fingerprint (``deliveries``); it needs a ``file_hash``. The others are
    read from ``layout.landing`` and written with dynamic partition overwrite.
    Months that nothing landed for keep what Bronze holds; when that is
    nothing for every requested month, it is an error.
    """
    periods = sorted(set(periods))
    done = existing_periods(spark, layout.bronze, periods, layout.fmt)
    if by_content:
        if not isinstance(file_hash, str):
            raise ValueError("by_content compares fingerprints: file_hash must name their kind")
        again = redelivered(spark, layout, sorted(done), file_hash=file_hash, multi_line=multi_line)
        todo = [p for p in periods if p not in done or p in again]
    else:
        todo = periods if overwrite else [p for p in periods if p not in done]
    todo, absent = R.split_landed(spark, layout.landing, todo)
    if not todo and not done:
        raise ValueError(f"nothing landed for {absent} under {layout.landing}")
    if todo:
        raw = R.read_landing(spark, layout.landing, todo, multi_line=multi_line)
        bronze = R.with_bronze_audit(
            spark, raw, layout.landing, todo, run_ts=run_ts or _utc_now(),
            source_label=source_label, file_hash=file_hash,
        )
        extra = [c for c in bronze.columns if c not in BRONZE_SCHEMA.names]
        noted = note_columns(spark, layout.bronze, todo, extra)
        write_partitioned(bronze, layout.bronze, fmt=layout.fmt, periods=todo, rebalance=rebalance)
        forget_columns(spark, layout.bronze, noted)
    return scan_periods(spark, layout.bronze, periods, layout.fmt, BRONZE_SCHEMA)


# ---------------------------------------------------------------- Silver


@dataclass
class SilverMetrics:
    raw: int = 0
    foreign_period: int = 0
    invalid: int = 0
    nulls: int = 0
    duplicates: int = 0
    kept: int = 0
    skipped_periods: list = field(default_factory=list)  # already in Silver
    absent_periods: list = field(default_factory=list)  # not in Bronze: Silver left alone

    def as_dict(self) -> dict:
        return dict(self.__dict__)


def silver_plan(bronze: DataFrame, periods: list[Period], run_ts: _dt.datetime | None = None) -> DataFrame:
    """Silver rows of ``bronze``.

    Rows whose own period (from ``MES_COMPETENCIA``) is not among the
    requested months are dropped (and counted, see ``funnel_counts``): under partition overwrite they
    would otherwise replace a month nobody asked to rewrite.
    """
    typed = S.prepare(bronze.drop("ano", "mes")).filter(S.in_periods(periods))
    return S.with_silver_audit(S.deduplicate(S.filter_nulls(S.filter_invalid_values(typed))), run_ts)


def funnel_counts(bronze: DataFrame, periods: list[Period], kept: int) -> SilverMetrics:
    """The funnel of a Silver write that left ``kept`` rows: one narrow scan of Bronze. Counts are
    aggregated, not accumulated, so tasks that run twice count once."""
    n = S.fates(bronze.drop("ano", "mes"), periods).first()
    return SilverMetrics(n["raw"], n["foreign_period"], n["invalid"], n["nulls"], n["ok"] - kept, kept)


def transform_silver(
    spark: SparkSession,
    layout: Layout,
    periods: list[Period],
    *,
    overwrite: bool = False,
    run_ts: _dt.datetime | None = None,
    rebalance: bool | None = None,
) -> tuple[DataFrame, SilverMetrics]:
    """Clean the requested Bronze months into Silver (one write job).

    ``rebalance`` sizes the output files by month (one more shuffle; see
    ``sinks.tables.write_partitioned``); the default does so when several
    months are written. Requested months that Bronze does not hold are
    reported and keep what Silver holds.

    Returns the Silver rows of those months and the funnel counts (``funnel_counts``).
    """
    periods = sorted(set(periods))
    skipped: list[Period] = []
    todo = periods
    if not overwrite:
        done = existing_periods(spark, layout.silver, periods, layout.fmt)
        skipped, todo = sorted(done), [p for p in periods if p not in done]
    there = existing_periods(spark, layout.bronze, todo, layout.fmt)
    absent, todo = [p for p in todo if p not in there], sorted(there)
    metrics = SilverMetrics()
    if todo:
        bronze = scan_periods(spark, layout.bronze, todo, layout.fmt, BRONZE_SCHEMA)
        silver = silver_plan(bronze, todo, run_ts or _utc_now())
        # many months: size the files by month instead of one per task and month
        several = rebalance if rebalance is not None else len(todo) > 1
        # before: a write that dies half way; after: a Gold refresh that ran meanwhile
        note_rewritten(spark, layout, todo)
        write_partitioned(silver, layout.silver, fmt=layout.fmt, periods=todo, rebalance=several)
        note_rewritten(spark, layout, todo)
        written = scan_periods(spark, layout.silver, todo, layout.fmt, SILVER_SCHEMA)
        metrics = funnel_counts(bronze, todo, written.count())
    metrics.skipped_periods, metrics.absent_periods = skipped, absent
    return scan_periods(spark, layout.silver, periods, layout.fmt, SILVER_SCHEMA), metrics


def note_rewritten(spark: SparkSession, layout: Layout, periods: list[Period]) -> None:
    """Note for the next Gold refresh that Silver rows of these months change (one folder a month)."""
    for y, m in periods:
        fs, p = _fs(spark, f"{layout.gold_notes}/{y * 100 + m}-{uuid.uuid4().hex}")
        fs.mkdirs(p)


# ---------------------------------------------------------------- Gold


def build_gold(
    spark: SparkSession,
    layout: Layout,
    year: int | list[int] | None = None,
    month: int | None = None,
    *,
    write: bool = True,
    jdbc: dict | None = None,
) -> dict[str, DataFrame]:
    """Refresh the months of ``year`` (or one month; all for None) from Silver
    and write the three Gold tables, which always cover every month of Silver.

    ``jdbc`` (``url``, ``user``, ``password``, optional ``schema`` (default
    ``gold``), ``driver``, ``best_effort``) also copies each written table, in
    the typed SQL contract, to ``<schema>.<table>`` after its table write.

    ``write=False`` returns the tables over just the months asked for and
    writes nothing.
    """
    stored = stored_periods(spark, layout.silver)
    years = None if year is None else {year} if isinstance(year, int) else set(year)
    periods = sorted(p for p in stored if (years is None or p[0] in years) and (month is None or p[1] == month))
    if not write:
        return G.gold_tables(scan_periods(spark, layout.silver, periods, layout.fmt, SILVER_SCHEMA))
    refresh_gold_pre(spark, layout, periods)
    return write_gold(spark, layout, jdbc=jdbc)


def refresh_gold_pre(spark: SparkSession, layout: Layout, periods: list[Period]) -> None:
    """Bring the month-partitioned pre-aggregate up to date with Silver.

    Rebuilds the requested months, those ``transform_silver`` noted as rewritten
    since they were last read, and any month that Silver holds and the
    pre-aggregate does not; months that are gone from Silver are emptied.
    Only those months of Silver are read; which ones is decided from folder names.
    Notes found at the start are removed once the pre-aggregate is written.
    """
    notes = child_dirs(spark, layout.gold_notes)
    noted = {(int(n[:-2]), int(n[-2:])) for n in (name.partition("-")[0] for name in notes) if n.isdigit()}
    silver, pre = stored_periods(spark, layout.silver), stored_periods(spark, layout.gold_pre)
    todo = sorted(((set(periods) | noted) & (silver | pre)) | (silver ^ pre))
    if todo:
        rows = scan_periods(spark, layout.silver, todo, layout.fmt, SILVER_SCHEMA)
        write_partitioned(G.pre_aggregate(rows), layout.gold_pre, fmt=layout.fmt, periods=todo)
    for name in notes:
        delete_path(spark, f"{layout.gold_notes}/{name}")


def write_gold(spark: SparkSession, layout: Layout, *, jdbc: dict | None = None) -> dict[str, DataFrame]:
    """Roll the pre-aggregate up into the Gold tables, over every month in it.

    The pre-aggregate is bounded by months x municipalities, so this is cheap
    however much Silver holds. Without any month the tables are written empty.
    """
    pre = scan_periods(
        spark, layout.gold_pre, sorted(stored_periods(spark, layout.gold_pre)), layout.fmt, G.PRE_SCHEMA
    )
    out = {}
    for name, df in G.roll_up(pre).items():
        write_table(df, layout.gold(name), fmt=layout.fmt)
        out[name] = spark.read.format(layout.fmt).load(layout.gold(name))
        if jdbc:
            copy_gold(out[name], name, jdbc)
    return out


def copy_gold(df: DataFrame, name: str, jdbc: dict) -> bool:
    """Copy one Gold table into a SQL database in its typed contract, which is checked first."""
    opts = dict(jdbc)
    schema = opts.pop("schema", "gold")
    typed = G.typed_contract(df, name)
    broken = G.contract_violations(typed, name).first().asDict()
    if any(broken.values()):
        raise ValueError(f"{name} breaks its SQL contract: {broken}")
    return write_jdbc(typed, table=f"{schema}.{name}", **opts)


def read_gold(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    return {t: spark.read.format(layout.fmt).load(layout.gold(t)) for t in GOLD_TABLES}


def register_gold(spark: SparkSession, layout: Layout, database: str = "gold") -> list[str]:
    """Make the Gold tables addressable as ``gold.<table>`` in SQL
    (external tables over the written files, session catalog)."""
    # The database folder lives in the lake, not in a machine-local warehouse.
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{layout.root}/catalog/{database}.db'")
    names = []
    for t in GOLD_TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{t}")
        spark.sql(
            f"CREATE TABLE {database}.{t} USING {layout.fmt} LOCATION '{layout.gold(t)}'"
        )
        names.append(f"{database}.{t}")
    return names


# ---------------------------------------------------------------- Runner


def run(
    spark: SparkSession,
    layout: Layout,
    periods: list[Period],
    layers: tuple[str, ...] = ("bronze", "silver", "gold"),
    *,
    overwrite: bool = True,
    raise_on_error: bool = True,
    file_hash: str | bool | None = "rows",
    multi_line: bool | None = None,
    source_label: str | None = None,
    rebalance: bool | None = None,
    by_content: bool = False,
    jdbc: dict | None = None,
) -> dict:
    """Run the chosen layers for a set of months.

    Gold refreshes the months (and any that Silver holds or rewrote beyond what
    Gold has seen) and covers every month of Silver afterwards, whatever mix of batch
    and streaming runs came before.

    Statuses are recorded per layer, with the requested months that had no
    input (``not_landed``, ``not_in_bronze``); the first failure stops the run,
    the result dict is completed, and then the error is raised (or returned
    when ``raise_on_error`` is False).
    """
    periods = sorted(set(periods))
    run_ts = _utc_now()
    result: dict = {"periods": periods, "layers": {}, "ok": True}
    error: Exception | None = None
    for layer in layers:
        t0 = time.time()
        try:
            if layer == "bronze":
                df = ingest_bronze(
                    spark, layout, periods, overwrite=overwrite, run_ts=run_ts, source_label=source_label,
                    file_hash=file_hash, multi_line=multi_line, rebalance=bool(rebalance), by_content=by_content,
                )
                absent = R.split_landed(spark, layout.landing, periods)[1]
                result["layers"]["bronze"] = {"rows": df.count(), "not_landed": absent, "status": "ok"}
            elif layer == "silver":
                df, m = transform_silver(
                    spark, layout, periods, overwrite=overwrite, run_ts=run_ts, rebalance=rebalance
                )
                result["layers"]["silver"] = {
                    "rows": df.count(), "funnel": m.as_dict(), "not_in_bronze": m.absent_periods, "status": "ok"
                }
            elif layer == "gold":
                refresh_gold_pre(spark, layout, periods)
                tables = {k: v.count() for k, v in write_gold(spark, layout, jdbc=jdbc).items()}
                result["layers"]["gold"] = {"tables": tables, "status": "ok"}
            else:
                raise ValueError(f"unknown layer {layer!r}")
            result["layers"][layer]["seconds"] = round(time.time() - t0, 3)
        except Exception as exc:  # record, stop, then raise
            result["layers"][layer] = {"status": "error", "error": str(exc)}
            result["ok"] = False
            error = exc
            break
    if error is not None and raise_on_error:
        raise RuntimeError(f"pipeline failed: {result}") from error
    return result
