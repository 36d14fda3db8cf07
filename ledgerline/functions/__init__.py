"""Column expressions used by the operators (all built-in, JVM-side)."""

from ledgerline.functions.labels import region_of, trend_label
from ledgerline.functions.money import (
    MONEY_LIMIT,
    exact_sum,
    exact_total,
    parse_brl,
    pct_change,
    round_half_up,
    to_double,
    total_money,
)
from ledgerline.functions.text import (
    ano_mes_label,
    canonical_header,
    normalize_text,
    period_key,
    period_month,
    period_year,
)

__all__ = [
    "MONEY_LIMIT",
    "ano_mes_label",
    "canonical_header",
    "exact_sum",
    "exact_total",
    "normalize_text",
    "parse_brl",
    "pct_change",
    "period_key",
    "period_month",
    "period_year",
    "region_of",
    "round_half_up",
    "to_double",
    "total_money",
    "trend_label",
]
