"""Categorical expressions: region of a UF and trend band of a change."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.schemas import REGION_OTHER, REGIONS, TREND_LABELS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def region_of(uf: Column | str) -> Column:
    """CASE over the fixed UF lists; unknown UFs map to ``Outros``."""
    u = _col(uf)
    expr = None
    for region, ufs in REGIONS.items():
        expr = F.when(u.isin(ufs), F.lit(region)) if expr is None else expr.when(u.isin(ufs), F.lit(region))
    return expr.otherwise(F.lit(REGION_OTHER))


def trend_label(pct: Column | str) -> Column:
    """Band of a percent change: > 5, > 0, = 0, < 0, else no data."""
    p = _col(pct)
    return (
        F.when(p > 5, F.lit(TREND_LABELS["strong_growth"]))
        .when(p > 0, F.lit(TREND_LABELS["growth"]))
        .when(p == 0, F.lit(TREND_LABELS["stable"]))
        .when(p < 0, F.lit(TREND_LABELS["decline"]))
        .otherwise(F.lit(TREND_LABELS["no_data"]))
    )
