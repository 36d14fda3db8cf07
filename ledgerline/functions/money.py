"""Money arithmetic that gives the same digits on every engine and partitioning.

Brazilian amounts arrive as text with ``.`` thousands and ``,`` decimals.
Sums are exact (decimal), and every rounded output goes through a decimal
cast, so a result never depends on the order in which partial sums arrive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts are summed with 8 decimals and rounded to cents once, at the end.
MONEY_TYPE = "decimal(28,8)"
SUM_TYPE = "decimal(38,8)"
TOTAL_TYPE = "decimal(38,2)"
ROUND_TYPE = "decimal(28,8)"
# First amount that MONEY_TYPE cannot hold; Silver counts such rows as invalid.
MONEY_LIMIT = 1e20


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_brl(c: Column | str) -> Column:
    """``'1.234,56'`` -> ``1234.56``; text that is not a number gives NULL.

    One ``translate`` pass deletes the thousands dots and turns the decimal
    comma into a dot (same result as removing dots, then replacing commas;
    no regex per row). The cast is a ``try_cast`` so one malformed value
    cannot fail the job under ANSI.
    """
    return F.translate(_col(c), ",.", ".").try_cast("double")


def exact_sum(c: Column | str) -> Column:
    """Sum of an amount column as ``decimal(38,8)``: exact and order-free."""
    return F.sum(_col(c).cast(MONEY_TYPE)).cast(SUM_TYPE)


def total_money(c: Column | str) -> Column:
    """An exact sum rounded to cents, as double."""
    return F.round(_col(c), 2).cast(TOTAL_TYPE).cast("double")


def exact_total(c: Column | str) -> Column:
    """Sum of amounts that are already rounded to cents (Gold columns), as ``decimal(38,2)``."""
    return F.sum(_col(c).cast(TOTAL_TYPE)).cast(TOTAL_TYPE)


def round_half_up(c: Column | str, scale: int) -> Column:
    """Round half away from zero at ``scale`` digits, returned as double.

    The value is first fixed to 8 decimals, so doubles that differ only in the
    last bit (different summation order) round the same way.
    """
    return F.round(_col(c).cast(ROUND_TYPE), scale).cast("double")


def to_double(c: Column | str) -> Column:
    return _col(c).cast("double")


def pct_change(cur: Column | str, prev: Column | str, scale: int = 4) -> Column:
    """``(cur - prev) / prev * 100`` rounded; NULL when prev is NULL or 0."""
    c, p = _col(cur), _col(prev)
    raw = (c - p) / p * F.lit(100)
    return F.when(p.isNotNull() & (p != 0), round_half_up(raw, scale)).otherwise(
        F.lit(None).cast("double")
    )
