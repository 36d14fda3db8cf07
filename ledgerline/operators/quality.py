"""Data-quality gate over the stored layers.

``dq_report`` computes the checks from the tables themselves (not from
counters passed between jobs), so it can run alone after any run. The report
is a small DataFrame ``(check, value, passed)``; ``assert_quality`` raises
listing every failed check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.schemas import GOLD_TABLES, RETENTION_THRESHOLD


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("double").alias("n")).select(F.lit(name).alias("item"), "n")


def layer_counts(frames: dict[str, DataFrame | None]) -> DataFrame:
    """``(item, n)`` for every frame that is given."""
    counts = None
    for name, df in frames.items():
        if df is not None:
            part = _count(df, name if name in ("bronze", "silver") else f"gold.{name}")
            counts = part if counts is None else counts.unionByName(part)
    return counts


def dq_report(bronze: DataFrame, silver: DataFrame, gold: dict[str, DataFrame]) -> DataFrame:
    """The checks over stored layers; a Gold table that is not there counts no rows."""
    return checks(layer_counts({"bronze": bronze, "silver": silver} | {t: gold.get(t) for t in GOLD_TABLES}))


def checks(counts: DataFrame) -> DataFrame:
    """``counts``: (item, n). Bronze has rows; Silver keeps >= 70 % of Bronze (only when
    Bronze has rows); each Gold table has rows. One row per check."""
    # Five one-row counts folded into one map row, then expanded into checks:
    # each layer is counted once.
    m = counts.agg(F.map_from_entries(F.collect_list(F.struct("item", "n"))).alias("m"))
    n = lambda item: F.coalesce(F.try_element_at("m", F.lit(item)), F.lit(0.0))
    b, s = n("bronze"), n("silver")

    def check(name, value, passed):
        return F.struct(F.lit(name).alias("check"), value.alias("value"), passed.alias("passed"))

    found = [check("bronze_rows", b, b > 0)]
    found.append(F.when(b > 0, check("silver_retention", s / b, (s / b) >= F.lit(RETENTION_THRESHOLD))))
    for t in GOLD_TABLES:
        g = n(f"gold.{t}")
        found.append(check(f"gold.{t}_rows", g, g > 0))
    present = F.filter(F.array(*found), lambda c: c.isNotNull())
    return m.select(F.inline(present))


def assert_quality(report: DataFrame) -> list[tuple[str, float, bool]]:
    """Raise ``ValueError`` naming the failed checks; return all checks.

    The report has one row per check (six at most), so collecting is bounded.
    """
    rows = [(r["check"], r["value"], bool(r["passed"])) for r in report.collect()]
    failed = [name for name, _, ok in rows if not ok]
    if failed:
        raise ValueError(f"data quality failed: {failed}")
    return rows
