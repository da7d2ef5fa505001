from almanac.operators.aggregate import (
    as_means,
    first_seen,
    join_on_keys,
    max_by_entity,
    means,
    num_periods,
    period_totals,
    roll_up,
)
from almanac.operators.extremes import argmax_rows, argmax_rows_each, argmax_rows_window
from almanac.operators.order import with_next
from almanac.operators.rank import best_worst, rank_global
from almanac.operators.trend import deltas, trend_text, trend_totals

__all__ = [
    "argmax_rows",
    "argmax_rows_each",
    "argmax_rows_window",
    "as_means",
    "best_worst",
    "deltas",
    "first_seen",
    "join_on_keys",
    "max_by_entity",
    "means",
    "num_periods",
    "period_totals",
    "rank_global",
    "roll_up",
    "trend_text",
    "trend_totals",
    "with_next",
]
