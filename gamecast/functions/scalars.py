"""Scalar functions as built-in column expressions (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_LABEL = "EEEE d MMMM yyyy"   # fixed value: long date label of a game


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_up(x) -> Column:
    """K4: round to the nearest whole number, halves up (-0.5 -> 0, 2.5 -> 3)."""
    return F.floor(_c(x) + F.lit(0.5)).cast("bigint")


def parse_ymd(text, zero_based_month: bool = False) -> Column:
    """K3/K7: "Y-M-D" -> date, NULL when malformed; month 0-11 with
    `zero_based_month` (as the web form sends it: "2013-0-24" is 24 January)."""
    parts = F.split(F.trim(_c(text)), "-")
    y = F.get(parts, 0).try_cast("int")
    m = F.get(parts, 1).try_cast("int") + F.lit(1 if zero_based_month else 0)
    d = F.get(parts, 2).try_cast("int")
    return F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd")


def date_label(d) -> Column:
    """K8: long English label, e.g. "Thursday 24 January 2013"."""
    return F.date_format(_c(d), DATE_LABEL)


def escape_name(name) -> Column:
    """K5: write every apostrophe as \\' (the request-file escape)."""
    return F.regexp_replace(_c(name), "'", "\\\\'")


def unescape_name(name) -> Column:
    """K5: read \\' back as '."""
    return F.regexp_replace(_c(name), "\\\\'", "'")


def split_roster(text) -> Column:
    """K1: comma-separated roster line -> array of unescaped names (blanks dropped)."""
    arr = F.split(F.trim(_c(text)), ",")
    return F.filter(F.transform(arr, lambda s: unescape_name(F.trim(s))), lambda s: s != "")
