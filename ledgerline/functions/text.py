"""Text and period expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c: Column | str) -> Column:
    """Upper case, leading/trailing spaces removed (tabs and NBSP are kept)."""
    return F.upper(F.trim(_col(c)))


def canonical_header(name: str) -> str:
    """Header names are compared and bound after strip + upper."""
    return name.strip().upper()


def period_year(competencia: Column | str) -> Column:
    """``'YYYYMM'`` -> year (chars 1-4) as int; NULL when not numeric."""
    return F.substring(_col(competencia), 1, 4).try_cast("int")


def period_month(competencia: Column | str) -> Column:
    """``'YYYYMM'`` -> month (chars 5-6) as int; NULL when not numeric."""
    return F.substring(_col(competencia), 5, 2).try_cast("int")


def period_key(ano: Column | str, mes: Column | str) -> Column:
    """Integer period key ``ano * 100 + mes`` (e.g. 202301)."""
    return _col(ano) * 100 + _col(mes)


def ano_mes_label(ano: Column | str, mes: Column | str) -> Column:
    """``2023, 1`` -> ``'2023-01'``."""
    return F.concat_ws("-", _col(ano).cast("string"), F.lpad(_col(mes).cast("string"), 2, "0"))
