"""Column expressions for vendor dates, amounts, flags and fallbacks.

Every function returns a Column built from JVM-side functions, so it stays inside
whole-stage code generation. ANSI mode is on in Spark 4, hence the ``try_`` casts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Vendor text formats and flags the results depend on.
SLASH_DATE = r"^/Date\((\d+)([+-]\d{4})?\)/"
TRUE_WORDS = ("1", "true", "yes", "on")
ENGLISH_DMY = r"^\d{2}-(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)-\d{4}$"
MONTH_NUMBERS = {
    "Jan": "01", "Feb": "02", "Mar": "03", "Apr": "04", "May": "05", "Jun": "06",
    "Jul": "07", "Aug": "08", "Sep": "09", "Oct": "10", "Nov": "11", "Dec": "12",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Empty text becomes NULL; other values stay."""
    return F.nullif(_col(c), F.lit(""))


def trim_text(c: Column | str) -> Column:
    """Outer blanks removed; what is left empty becomes NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def first_known(*cols: Column | str) -> Column:
    """First non-NULL of alternative fields."""
    return F.coalesce(*[_col(c) for c in cols])


def first_truthy(*cols: Column | str) -> Column:
    """First text that is neither NULL nor empty; falls back to the last field as it is."""
    columns = [_col(c) for c in cols]
    return F.coalesce(*[blank_to_null(c.cast("string")) for c in columns])


def parse_slash_date(c: Column | str) -> Column:
    """``/Date(ms+hhmm)/`` to ISO text in whole seconds; anything else is unchanged."""
    text = _col(c)
    millis = F.regexp_extract(text, SLASH_DATE, 1).try_cast("bigint")
    return F.when(
        text.rlike(SLASH_DATE) & millis.isNotNull(),
        F.date_format(F.timestamp_millis(millis), ISO_SECONDS),
    ).otherwise(text)


def ms_to_ts(c: Column | str) -> Column:
    """Epoch milliseconds (number or digits) to a timestamp; NULL, empty, zero and bad text to NULL."""
    millis = F.trim(_col(c).cast("string")).try_cast("bigint")
    return F.timestamp_millis(F.nullif(millis, F.lit(0).cast("bigint")))


def ms_to_iso(c: Column | str) -> Column:
    """Epoch milliseconds to ISO text with offset; the fraction is shown only where there is one."""
    ts = ms_to_ts(c)
    fraction = F.date_format(ts, "SSSSSS")
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(fraction == "000000", F.lit("")).otherwise(F.concat(F.lit("."), fraction)),
        F.lit("+00:00"),
    )


def parse_dmy(c: Column | str) -> Column:
    """``29-Nov-2025`` to ``2025-11-29``; other text is unchanged (no calendar check)."""
    text = _col(c)
    months = F.create_map(*[F.lit(x) for pair in MONTH_NUMBERS.items() for x in pair])
    iso = F.concat_ws("-", F.substring(text, 8, 4), months[F.substring(text, 4, 3)], F.substring(text, 1, 2))
    return F.when(text.rlike(ENGLISH_DMY), iso).otherwise(text)


def parse_amount(c: Column | str) -> Column:
    """``(1,234.50)`` to -1234.5: separators dropped, parentheses mean negative, bad text is NULL."""
    text = F.trim(F.regexp_replace(_col(c).cast("string"), ",", ""))
    signed = F.regexp_replace(text, r"^\((.*)\)$", "-$1")
    # a cast alone would also take type suffixes: the account code 12D is no amount
    return F.when(signed.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"), signed.try_cast("double"))


def bool_text(c: Column | str) -> Column:
    """True for the words that mean yes."""
    return F.lower(F.trim(_col(c).cast("string"))).isin(*TRUE_WORDS)


def join_list(c: Column | str, separator: str = "; ") -> Column:
    """Array of text to one text; a missing array gives the empty text."""
    return F.coalesce(F.array_join(_col(c), separator), F.lit(""))


def attr_value(attributes: Column | str, attr_id: str) -> Column:
    """Value of the first ``{Id, Value}`` entry with the given id, else the empty text."""
    hits = F.filter(_col(attributes), lambda a: a["Id"] == attr_id)
    return F.coalesce(F.get(hits, F.lit(0))["Value"], F.lit(""))


def business_dates(start: Column | str, end: Column | str) -> Column:
    """Array of ``yyyyMMdd`` for each whole day elapsed from ``start`` to ``end``, both ends included."""
    begin, finish = _col(start).cast("timestamp"), _col(end).cast("timestamp")
    whole_days = F.floor((F.unix_micros(finish) - F.unix_micros(begin)) / F.lit(86_400_000_000)).cast("int")
    offsets = F.when(whole_days >= 0, F.sequence(F.lit(0), whole_days)).otherwise(F.array().cast("array<int>"))
    return F.transform(offsets, lambda i: F.date_format(F.date_add(begin.cast("date"), i), "yyyyMMdd"))


def window_chunks(start: Column | str, end: Column | str, days: int, mode: str = "forward") -> Column:
    """Array of ``(from_date, to_date)`` windows that cover the range ``start`` to ``end``.

    ``forward``: inclusive windows of ``days`` days, the next one starts the day after.
    ``backward``: the same, walking down from ``end``.
    ``stitched``: each window starts where the last ended, so that boundaries are shared.
    """
    first, last = _col(start).cast("date"), _col(end).cast("date")
    span = F.datediff(last, first)
    if mode == "stitched":
        steps = F.greatest(F.ceil(span / F.lit(days)).cast("int") - 1, F.lit(0))
    else:
        steps = F.floor(span / F.lit(days)).cast("int")
    numbers = F.when(span >= 0, F.sequence(F.lit(0), steps)).otherwise(F.array().cast("array<int>"))

    def bounds(i: Column) -> Column:
        if mode == "backward":
            to = F.date_sub(last, i * days)
            return F.struct(
                F.greatest(first, F.date_sub(to, days - 1)).alias("from_date"), to.alias("to_date")
            )
        start_ = F.date_add(first, i * days)
        width = days if mode == "stitched" else days - 1
        return F.struct(start_.alias("from_date"), F.least(last, F.date_add(start_, width)).alias("to_date"))

    return F.transform(numbers, bounds)


def relative_window(c: Column | str, as_of: Column | str, past_days: int, future_days: int = 0) -> Column:
    """True where the date lies in ``as_of - past_days`` to ``as_of + future_days``, both included."""
    day, anchor = _col(c).cast("date"), _col(as_of).cast("date")
    return day.between(F.date_sub(anchor, past_days), F.date_add(anchor, future_days))


def is_older_than(c: Column | str, as_of: Column | str, days: int = 30) -> Column:
    """Strictly before ``as_of - days``, to the microsecond."""
    return _col(c).cast("timestamp") < _col(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))


def report_date(c: Column | str, as_of: Column | str) -> Column:
    """The report's own date, else the day of ``as_of``."""
    return F.coalesce(blank_to_null(c), F.date_format(_col(as_of).cast("timestamp"), "yyyy-MM-dd"))


def coalesce_blank(columns: list[Column]) -> Column:
    """First value that is neither NULL nor empty text, else the first non-NULL one."""
    if len(columns) == 1:
        return columns[0]
    return F.coalesce(*[blank_to_null(c) for c in columns], *columns)


def all_not_null(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])
