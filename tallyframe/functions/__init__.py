"""Column-expression helpers (all JVM-side, no Python UDFs)."""

from tallyframe.functions.money import (
    exact_avg,
    exact_decimal,
    exact_double,
    exact_mean,
    exact_sum,
    exact_total,
    half_up_div,
    lenient_number,
    micro_part,
    money_parts,
    part_names,
    parts_amount,
    parts_total,
    summable,
    whole_part,
)

__all__ = [
    "exact_avg",
    "exact_decimal",
    "exact_double",
    "exact_mean",
    "exact_sum",
    "exact_total",
    "half_up_div",
    "lenient_number",
    "micro_part",
    "money_parts",
    "part_names",
    "parts_amount",
    "parts_total",
    "summable",
    "whole_part",
]
