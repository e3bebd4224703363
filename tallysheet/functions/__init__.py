"""Column expressions shared by the operators. All are built-in functions, no UDF."""

from tallysheet.functions.columns import (
    blank_to_null,
    compose_timestamp,
    discount_number,
    discount_percent,
    discount_text,
    fitted,
    in_window,
    month_key,
    to_amount,
    to_whole,
)

__all__ = [
    "blank_to_null",
    "compose_timestamp",
    "discount_number",
    "discount_percent",
    "discount_text",
    "fitted",
    "in_window",
    "month_key",
    "to_amount",
    "to_whole",
]
