"""Scalar feature expressions (column in, column out; no UDFs)."""

from tablewright.functions.scalar import (
    concat_key, in_set_flag, log1p_label, expm1_label, is_nan, ratio,
    round_half_even, season, split_token, split_yyyymm, squared_error,
    threshold_flag, truncate_int, yyyymm,
)

__all__ = [
    "concat_key", "in_set_flag", "log1p_label", "expm1_label", "is_nan",
    "ratio", "round_half_even", "season", "split_token", "split_yyyymm",
    "squared_error", "threshold_flag", "truncate_int", "yyyymm",
]
