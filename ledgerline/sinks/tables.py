"""Table writers for the layers.

Partitioned layers are written with *dynamic* partition overwrite: a run
replaces exactly the ``(ano, mes)`` partitions present in its output and
leaves every other month alone, and a retried run replaces what a failed
attempt left instead of appending twice. Gold tables are small and are
replaced whole.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION_COLUMNS = ["ano", "mes"]


def replace_where(periods: list[tuple[int, int]]) -> str:
    """Delta ``replaceWhere`` predicate covering exactly ``periods``."""
    if not periods:
        raise ValueError("delta overwrite needs the periods it replaces")
    return " OR ".join(f"(ano = {int(y)} AND mes = {int(m)})" for y, m in sorted(set(periods)))


def write_partitioned(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    mode: str = "overwrite",
    periods: list[tuple[int, int]] | None = None,
    max_records_per_file: int | None = None,
    rebalance: bool = False,
) -> None:
    """Write ``df`` partitioned by ``ano, mes``.

    ``overwrite`` replaces months (parquet: dynamic partition overwrite;
    delta: ``replaceWhere`` on ``periods``); with ``periods`` given, a
    month of them for which ``df`` has no rows is emptied as well, so the
    call means "these months now hold exactly ``df``": callers pass the months
    that had input, not the months they were asked for. ``append`` adds
    files. No repartition by default: each task writes its own slice, so a
    large month is written by many tasks in parallel, at the price of one
    file per (task, month). ``rebalance=True`` (for backfills of many
    months) adds one shuffle by month that AQE sizes: small months are
    merged, a hot month is split, and files come out near the advisory size.
    """
    track = mode == "overwrite" and fmt != "delta" and bool(periods)
    if track:
        # Months actually written, collected by the write itself (at most
        # one value per requested month).
        seen = Observation(f"months_{uuid.uuid4().hex[:12]}")
        df = df.observe(
            seen,
            F.collect_set(F.col("ano") * 100 + F.col("mes")).alias("months"),
            F.count(F.lit(1)).alias("rows"),
        )
    if rebalance:
        df = df.hint("rebalance", *PARTITION_COLUMNS)
    w = df.write.format(fmt).mode(mode).partitionBy(*PARTITION_COLUMNS)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if mode == "overwrite":
        if fmt == "delta":
            w = w.option("replaceWhere", replace_where(periods or [])).option("overwriteSchema", "false")
        else:
            w = w.option("partitionOverwriteMode", "dynamic")
    w.save(path)
    if track:
        _empty_months(df.sparkSession, path, sorted(set(periods)), seen.get)


def _empty_months(spark: SparkSession, path: str, periods: list[tuple[int, int]], seen: dict) -> None:
    """Remove the stored months of ``periods`` that the write produced no row for.

    Fails closed: without the write's own metrics nothing is removed.
    """
    if "months" not in seen or "rows" not in seen or bool(seen["months"]) != bool(seen["rows"]):
        raise RuntimeError(f"the write to {path} reported no metrics; months without rows were not removed")
    written = set(seen["months"])
    empty = [(y, m) for y, m in periods if y * 100 + m not in written]
    for d in partition_dirs(spark, path, empty).values():
        fs, p = _fs(spark, d)
        fs.delete(p, True)


def write_table(df: DataFrame, path: str, *, fmt: str = "parquet") -> None:
    """Replace an unpartitioned (Gold) table."""
    w = df.write.format(fmt).mode("overwrite")
    if fmt == "delta":
        w = w.option("overwriteSchema", "true")
    w.save(path)


COLUMNS_DIR = "_columns"  # folders YYYYMM and YYYYMM.<column>: months with noted columns, and their extra ones


def noted_columns(spark: SparkSession, path: str) -> dict[int, set[str]]:
    """Extra (text) columns by month, as noted by the writes (one listing)."""
    out: dict[int, set[str]] = {}
    for name in child_dirs(spark, f"{path.rstrip('/')}/{COLUMNS_DIR}"):
        month, _, column = name.partition(".")
        out.setdefault(int(month), set()).update([unquote(column)] if column else [])
    return out


def note_columns(spark: SparkSession, path: str, periods: list[tuple[int, int]], extra: list[str]) -> list[str]:
    """Note before a write which extra columns the months will have, so that no reader has to merge file
    footers. Returns the notes this makes stale, for ``forget_columns`` after the write: in between a month
    shows the columns of both versions."""
    root = f"{path.rstrip('/')}/{COLUMNS_DIR}"
    there = set(child_dirs(spark, root))
    months = {str(y * 100 + m) for y, m in periods}
    wanted = months | {f"{m}.{quote(c, safe='')}" for m in months for c in extra}
    for name in sorted(wanted - there):
        fs, p = _fs(spark, f"{root}/{name}")
        fs.mkdirs(p)
    return sorted(n for n in there - wanted if n.partition(".")[0] in months)


def forget_columns(spark: SparkSession, path: str, names: list[str]) -> None:
    for name in names:
        delete_path(spark, f"{path.rstrip('/')}/{COLUMNS_DIR}/{name}")


def _reader(spark: SparkSession, path: str, fmt: str, schema: T.StructType | None, extra: bool, periods: list[tuple[int, int]] | None):
    """Reader of the columns that the months of ``periods`` (all stored ones for None) have: ``schema``, and with
    ``extra`` the columns noted for them. Without a schema, or where a month has no notes, the file footers are merged."""
    reader = spark.read.format(fmt)
    if fmt not in ("parquet", "orc"):
        return reader
    if schema is not None and not extra:
        return reader.schema(schema)
    if schema is not None:
        noted = noted_columns(spark, path)
        months = {y * 100 + m for y, m in (stored_periods(spark, path) if periods is None else periods)}
        if months <= set(noted):
            more = sorted({c for m in months for c in noted[m]})
            return reader.schema(T.StructType([*schema.fields, *(T.StructField(c, T.StringType()) for c in more)]))
    return reader.option("mergeSchema", "true")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None, extra: bool = False) -> DataFrame | None:
    """The table at ``path``, or None when nothing was written there yet. ``schema``, ``extra``: see ``read_periods``."""
    try:
        return _reader(spark, path, fmt, schema, extra, None).load(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc) or "is not a Delta table" in str(exc):
            return None
        raise


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder (recursive; no error when absent)."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def child_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path`` (one listing call; empty when absent)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def stored_periods(spark: SparkSession, path: str, years: set[int] | None = None) -> set[tuple[int, int]]:
    """Months with a folder ``ano=Y/mes=M``: one listing of the table and one per year."""
    out = set()
    for year in child_dirs(spark, path):
        key, _, y = year.partition("=")
        if key != "ano" or not y.isdigit() or (years is not None and int(y) not in years):
            continue
        for month in child_dirs(spark, f"{path.rstrip('/')}/{year}"):
            key, _, m = month.partition("=")
            if key == "mes" and m.isdigit():
                out.add((int(y), int(m)))
    return out


def partition_dirs(spark: SparkSession, path: str, periods: list[tuple[int, int]]) -> dict[tuple[int, int], str]:
    """Folders ``<path>/ano=Y/mes=M`` of the requested months that exist.

    Only the folders of the requested years are listed, so the cost of a run
    does not grow with the years already stored.
    """
    found = stored_periods(spark, path, {y for y, _ in periods}) if periods else set()
    return {(y, m): f"{path.rstrip('/')}/ano={y}/mes={m}" for y, m in sorted(set(periods) & found)}


def read_periods(
    spark: SparkSession,
    path: str,
    periods: list[tuple[int, int]],
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    extra: bool = False,
) -> DataFrame | None:
    """Rows of the requested months, listing only their folders (any number of months).

    ``schema``: the layer's declared columns; ``extra``: its months may have more (noted) columns. With them no
    file footer is read to find the columns out.

    File formats read the month folders directly (``basePath`` keeps ``ano``
    and ``mes`` as columns); delta reads the table and prunes by its log.
    Returns None when none of the months exists.
    """
    keys = sorted({y * 100 + m for y, m in periods})
    cond = (F.col("ano") * 100 + F.col("mes")).isin(keys)
    if fmt == "delta":
        df = read_table(spark, path, fmt)
        return None if df is None else df.filter(cond)
    dirs = partition_dirs(spark, path, periods)
    if not dirs:
        return None
    return _reader(spark, path, fmt, schema, extra, list(dirs)).option("basePath", path).load(list(dirs.values())).filter(cond)


def existing_periods(
    spark: SparkSession, path: str, periods: list[tuple[int, int]], fmt: str = "parquet"
) -> set[tuple[int, int]]:
    """Which of ``periods`` already have rows at ``path``.

    File formats: a month exists when its folder does (Spark writes no
    folder for a month without rows, and ``write_partitioned`` removes months
    replaced by nothing): a metadata check, no job.
    Delta: a read of the months' partition columns (at most one row per
    requested month comes back).
    """
    if not periods:
        return set()
    if fmt == "delta":
        df = read_periods(spark, path, periods, fmt)
        if df is None:
            return set()
        found = df.select(*PARTITION_COLUMNS).distinct().collect()
        return {(r["ano"], r["mes"]) for r in found}
    return set(partition_dirs(spark, path, periods))


def write_jdbc(
    df: DataFrame,
    *,
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str = "org.postgresql.Driver",
    best_effort: bool = False,
    num_partitions: int = 4,
) -> bool:
    """Copy a (small) Gold table into a SQL database, replacing its rows.

    ``truncate=true`` keeps the target's DDL (types, ids, indexes) instead of
    dropping and recreating the table. Failures raise unless ``best_effort``.
    Returns True when written.
    """
    opts = jdbc_options(url=url, table=table, user=user, password=password, driver=driver)
    try:
        df.coalesce(num_partitions).write.format("jdbc").options(**opts).mode("overwrite").save()
        return True
    except Exception:
        if best_effort:
            return False
        raise


def jdbc_options(
    *, url: str, table: str, user: str | None, password: str | None, driver: str
) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "driver": driver, "truncate": "true"}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    return opts
