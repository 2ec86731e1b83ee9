"""Column-expression helpers (rounding, safe ratios, exact money sums, parsing)."""

from adlens.functions.expr import (
    MONEY,
    clean_number,
    exact_mean,
    fixed,
    money_sum,
    na_to_null,
    parse_day_first,
    ratio,
    round_half_away,
    round_half_away_value,
    whole_number,
)

__all__ = [
    "MONEY", "clean_number", "exact_mean", "fixed", "money_sum",
    "na_to_null", "parse_day_first", "ratio", "round_half_away", "round_half_away_value",
    "whole_number",
]
