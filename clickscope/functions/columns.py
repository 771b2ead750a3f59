"""Scalar column functions (FN1-FN17): date helpers, number formatting, string records.

All are built-in Spark expressions, so they stay inside whole-stage codegen; none of them
runs Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Time formats of the original programs.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DATEKEY_FORMAT = "yyyyMMdd"
DATE_TIME_FORMAT = "yyyyMMddHHmm"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_time(s) -> Column:
    """FN7: 'yyyy-MM-dd HH:mm:ss' text -> timestamp; null when malformed.

    Spark's string-to-timestamp cast is a hand-written parser (several times faster than a
    pattern formatter) and, like the original lenient parser, accepts one-digit fields such
    as '2019-08-28 5:03:04'.
    """
    return _c(s).try_cast("timestamp")


def before(t1, t2) -> Column:
    """FN1: t1 strictly earlier than t2 (both time strings)."""
    return parse_time(t1) < parse_time(t2)


def after(t1, t2) -> Column:
    """FN2: t1 strictly later than t2."""
    return parse_time(t1) > parse_time(t2)


def minus(t1, t2) -> Column:
    """FN3: whole seconds between two time strings (t1 - t2)."""
    return (F.unix_seconds(parse_time(t1)) - F.unix_seconds(parse_time(t2))).cast("int")


def date_hour(t) -> Column:
    """FN4: 'yyyy-MM-dd HH:mm:ss' -> 'yyyy-MM-dd_HH' by slicing the text (keeps the hour as written)."""
    t = _c(t)
    return F.concat(F.substring_index(t, " ", 1), F.lit("_"),
                    F.substring_index(F.substring_index(t, " ", -1), ":", 1))


def today() -> Column:
    """FN5: current date as 'yyyy-MM-dd'."""
    return F.date_format(F.current_date(), DATE_FORMAT)


def yesterday() -> Column:
    return F.date_format(F.date_sub(F.current_date(), 1), DATE_FORMAT)


def format_date(ts) -> Column:
    """FN6."""
    return F.date_format(_c(ts), DATE_FORMAT)


def format_time(ts) -> Column:
    return F.date_format(_c(ts), TIME_FORMAT)


def format_date_key(ts) -> Column:
    """FN8: timestamp -> 'yyyyMMdd'."""
    return F.date_format(_c(ts), DATEKEY_FORMAT)


def parse_date_key(s) -> Column:
    return F.try_to_timestamp(_c(s), F.lit(DATEKEY_FORMAT)).cast("date")


def format_time_minute(ts) -> Column:
    """FN9: timestamp -> 'yyyyMMddHHmm'."""
    return F.date_format(_c(ts), DATE_TIME_FORMAT)


def format_double(x, scale: int = 2) -> Column:
    """FN10: HALF_UP rounding to ``scale`` decimals."""
    return F.round(_c(x), scale)


def is_empty(s) -> Column:
    """FN11: null or ''."""
    return F.coalesce(_c(s), F.lit("")) == ""


def is_not_empty(s) -> Column:
    return ~is_empty(s)


def trim_comma(s) -> Column:
    """FN12: drop one leading and one trailing comma."""
    return F.regexp_replace(_c(s), r"^,|,$", "")


def fulfill(s) -> Column:
    """FN13: two-character text stays, anything else gets a leading '0' (e.g. '5' -> '05')."""
    s = _c(s)
    return F.when(F.length(s) == 2, s).otherwise(F.concat(F.lit("0"), s))


def get_field(record, field: str, delimiter: str = "|") -> Column:
    """FN14: value of ``field`` in a 'k1=v1|k2=v2' record; null when missing or empty.

    First match wins; pieces that do not split into exactly a key and a non-empty value
    are skipped.
    """
    pieces = F.split(_c(record), re.escape(delimiter))
    kv = F.transform(pieces, lambda x: F.split(F.regexp_replace(x, "=+$", ""), "="))
    hits = F.filter(kv, lambda a: (F.size(a) == 2) & (a[0] == F.lit(field)))
    return F.get(hits, 0)[1]


def set_field(record, field: str, value, delimiter: str = "|") -> Column:
    """FN15: replace the value of ``field`` in a 'k=v|...' record (pieces keep their order)."""
    value = value if isinstance(value, Column) else F.lit(str(value))
    pieces = F.split(_c(record), re.escape(delimiter))
    repl = F.transform(pieces, lambda x: F.when(F.substring_index(x, "=", 1) == F.lit(field),
                                                F.concat(F.lit(field + "="), value)).otherwise(x))
    return F.array_join(repl, delimiter)


def concat_long_string(v1, v2, sep: str = ":") -> Column:
    """FN16 / UDF1: '<long><sep><string>'."""
    return F.concat(_c(v1).cast("string"), F.lit(sep), _c(v2))


def get_json_field(json, field: str) -> Column:
    """FN17 / UDF2: top-level field of a JSON text, as text; null when missing."""
    return F.get_json_object(_c(json), f"$.{field}")


def split_ids(s) -> Column:
    """Comma list of ids -> array<bigint>; empty or malformed items are dropped, duplicates kept."""
    items = F.transform(F.split(_c(s), ","), lambda x: x.try_cast("bigint"))
    return F.filter(items, lambda x: x.isNotNull())


def group_concat_distinct(s) -> Column:
    """AGG17 / UDAF1: sorted distinct non-null values joined by ','; null for an empty group."""
    arr = F.array_sort(F.collect_set(_c(s)))
    return F.when(F.size(arr) > 0, F.array_join(arr, ","))
