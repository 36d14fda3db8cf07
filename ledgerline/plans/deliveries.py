"""What a landing folder holds against what was stored from it, file by file.

Bronze rows carry the name and the fingerprint of the file they came from, so a
stored month says itself which files it was built from; no separate record can go
stale. Both sides are reduced to a row per file by aggregations that shrink the
rows before their shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.schemas import BRONZE_SCHEMA
from ledgerline.settings import Layout
from ledgerline.sinks.tables import existing_periods, read_periods
from ledgerline.sources import raw_csv as R

Period = tuple[int, int]
_FILE = ["ano", "mes", "_file_name"]


def _files(rows: DataFrame, name: str) -> DataFrame:
    """A row per file: its fingerprints (NULL for rows stored without one), as a sorted set."""
    prints = F.array_sort(F.collect_set(F.coalesce("_file_hash", F.lit(""))))
    return rows.groupBy(*_FILE).agg(prints.alias(name))


def compare_deliveries(
    spark: SparkSession, layout: Layout, periods: list[Period], *, file_hash: str = "rows", multi_line: bool | None = None
) -> DataFrame:
    """(ano, mes, _file_name, state) for every file with rows, landed or stored, of months that are both landed
    and stored: ``same``, ``changed``, ``added`` or ``removed``.

    A file stored without a fingerprint, or with one of another kind than ``file_hash``, is ``changed``. Files
    without rows (a header only) leave nothing in Bronze and are left out on both sides. Reads the landed
    files once and three columns of the stored months; writes nothing but the reader's table of file layouts.
    """
    both = sorted(existing_periods(spark, layout.bronze, R.split_landed(spark, layout.landing, periods)[0], layout.fmt))
    stored = read_periods(spark, layout.bronze, both, layout.fmt, BRONZE_SCHEMA) if both else None
    if stored is None:
        return spark.createDataFrame([], "ano int, mes int, _file_name string, state string")
    raw = R.read_landing(spark, layout.landing, both, multi_line=multi_line)
    landed = R.with_bronze_audit(spark, raw, layout.landing, both, file_hash=file_hash)
    before, now = _files(stored.select(*_FILE, "_file_hash"), "before"), _files(landed.select(*_FILE, "_file_hash"), "now")
    state = (
        F.when(F.col("before").isNull(), "added")
        .when(F.col("now").isNull(), "removed")
        .when(F.col("before") == F.col("now"), "same")
        .otherwise("changed")
    )
    return now.join(before, _FILE, "full").select(*_FILE, state.alias("state"))


def redelivered(
    spark: SparkSession, layout: Layout, periods: list[Period], *, file_hash: str = "rows", multi_line: bool | None = None
) -> set[Period]:
    """The landed and stored months of ``periods`` that have a file that was changed, added or removed. Only months
    come to the driver."""
    files = compare_deliveries(spark, layout, periods, file_hash=file_hash, multi_line=multi_line)
    return {(r["ano"], r["mes"]) for r in files.where("state <> 'same'").select("ano", "mes").distinct().collect()}
