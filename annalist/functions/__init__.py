"""Column expressions shared by the operators."""

from annalist.functions.columns import (
    add_second,
    as_date,
    differs,
    has_prefix,
    let,
    moment,
    month_at,
    month_floor,
    month_index,
    month_number,
    prefix,
    rescued,
    second_at,
    second_index,
    second_number,
)

__all__ = [
    "add_second",
    "as_date",
    "differs",
    "has_prefix",
    "let",
    "moment",
    "month_at",
    "month_floor",
    "month_index",
    "month_number",
    "prefix",
    "rescued",
    "second_at",
    "second_index",
    "second_number",
]
