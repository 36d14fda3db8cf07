"""One query per operator over the test tables, with oracle SQL where SQL expresses it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .conversations import op11_repair
from .jaccard import OP4_SQL, op4_jaccard
from .langid import op2_language
from .lines import OP13_SQL, op13_lines
from .mix import OP8_SQL, op8_mix
from .phrases import OP12_SQL, op12_phrases
from .pieces import op3_pieces
from .pii import op7_pii
from .quality import OP10_SQL, op10_quality
from .repeats import op5_repeats
from .tokens import op6_token_files
from .topk import OP1_SQL, op1_topk
from .urls import OP9_SQL, op9_url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_topk": op1_topk,
        "op2_language": op2_language,
        "op3_pieces": op3_pieces,
        "op4_jaccard": op4_jaccard,
        "op5_repeats": op5_repeats,
        "op6_token_files": op6_token_files,
        "op7_pii": op7_pii,
        "op8_mix": op8_mix,
        "op9_url_filter": op9_url_filter,
        "op10_quality": op10_quality,
        "op11_repair": op11_repair,
        "op12_phrases": op12_phrases,
        "op13_lines": op13_lines,
    }


def oracle_queries() -> dict[str, str]:
    return {
        "op1_topk": OP1_SQL,
        "op4_jaccard": OP4_SQL,
        "op8_mix": OP8_SQL,
        "op9_url_filter": OP9_SQL,
        "op10_quality": OP10_SQL,
        "op12_phrases": OP12_SQL,
        "op13_lines": OP13_SQL,
    }
