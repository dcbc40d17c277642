"""Column helpers shared by the operators."""

from snapmart.functions.columns import (
    as_double,
    boundary_diff,
    coalesce_names,
    first_order,
    is_missing,
    latest_order,
    safe_long,
    to_stamp,
    week_start,
    whole_number,
)

__all__ = [
    "as_double",
    "boundary_diff",
    "coalesce_names",
    "first_order",
    "is_missing",
    "latest_order",
    "safe_long",
    "to_stamp",
    "week_start",
    "whole_number",
]
