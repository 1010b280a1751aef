"""Column functions and name rules."""

from recordloom.functions.naming import child_table_name, report_table_name, safe_name, safe_table
from recordloom.functions.scalars import (
    attr_value,
    blank_to_null,
    bool_text,
    business_dates,
    first_known,
    first_truthy,
    is_older_than,
    join_list,
    ms_to_iso,
    ms_to_ts,
    parse_amount,
    parse_dmy,
    parse_slash_date,
    relative_window,
    report_date,
    trim_text,
    window_chunks,
)

__all__ = [
    "attr_value",
    "blank_to_null",
    "bool_text",
    "business_dates",
    "child_table_name",
    "first_known",
    "first_truthy",
    "is_older_than",
    "join_list",
    "ms_to_iso",
    "ms_to_ts",
    "parse_amount",
    "parse_dmy",
    "parse_slash_date",
    "relative_window",
    "report_date",
    "report_table_name",
    "safe_name",
    "safe_table",
    "trim_text",
    "window_chunks",
]
