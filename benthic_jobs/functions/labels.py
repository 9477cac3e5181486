"""Cleaning of labels, dates and coordinates: column in, column out. Bad input gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_label(c: Column) -> Column:
    """Lower case, ``_`` and ``-`` as spaces, single spaces, trimmed."""
    return F.trim(F.regexp_replace(F.lower(c), r"[_\-\s]+", " "))


def column_token(c: Column) -> Column:
    """A name for a column: runs of other characters become ``_``; nothing left becomes ``unknown``."""
    token = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(token, F.lit("")), F.lit("unknown"))


def number(c: Column) -> Column:
    return c.cast("string").try_cast("double")


def coverage_class(c: Column) -> Column:
    x = number(c)
    return F.when(x < 30, "low").when(x < 60, "medium").when(x >= 60, "high")


def parse_date(c: Column) -> Column:
    """Eight digits, ISO, timestamps, else day first."""
    def read(text: Column, form: str) -> Column:
        return F.try_to_timestamp(text, F.lit(form)).cast("date")

    return (
        F.when(c.rlike(r"^\d{8}$"), read(c, "yyyyMMdd"))
        .when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), read(F.substring(c, 1, 10), "yyyy-MM-dd"))
        .when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), read(c, "d/M/yyyy"))
        .when(c.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$"), read(c, "d-M-yyyy"))
    )


def survey_date(c: Column) -> Column:
    """``4-May-19`` as a date."""
    return F.try_to_timestamp(c, F.lit("d-MMM-yy")).cast("date")


def date_window(day: Column, days: int) -> tuple[Column, Column]:
    return F.date_sub(day, days), F.date_add(day, days)


def padded_period(first: Column, last: Column, days: int) -> tuple[Column, Column, Column]:
    """The period with ``days`` on both sides and its midpoint, rounded down to a day."""
    middle = F.date_add(first, F.floor(F.datediff(last, first) / 2).cast("int"))
    return F.date_sub(first, days), F.date_add(last, days), middle


def dms_to_degrees(c: Column) -> Column:
    """Degrees, minutes and seconds with any quote marks; S and W are negative."""
    form = r"(?i)^\s*(-?\d+)\D+?(\d+)\D+?(\d+(?:\.\d+)?)\D*$"
    part = [F.regexp_extract(c, form, i).try_cast("double") for i in (1, 2, 3)]
    value = F.abs(part[0]) + part[1] / 60 + part[2] / 3600
    south = F.upper(c).rlike("[SW]") | F.trim(c).startswith("-")
    return F.when(south, -value).otherwise(value)


def abundance_code(c: Column) -> Column:
    """The number that a code begins with."""
    return F.regexp_extract(c, r"^([\d.]+)", 1).try_cast("double")


def site_cluster(label: Column, prefixes: dict[str, str], members: dict[str, list[str]]) -> Column:
    """The cluster whose prefix the label has, or whose members it is one of."""
    clean, out = normalise_label(label), F.lit(None).cast("string")
    for cluster, names in reversed(members.items()):
        out = F.when(clean.isin(names), cluster).otherwise(out)
    for prefix, cluster in reversed(prefixes.items()):
        out = F.when(clean.startswith(prefix), cluster).otherwise(out)
    return out


def cloud_percent(c: Column) -> Column:
    """Missing counts as overcast; shares up to 1 become per cent."""
    x = F.coalesce(c, F.lit(100.0))
    return F.when(x <= 1, x * 100).otherwise(x)


def item_date(items: Column) -> Column:
    """The acquisition date in the first id of a JSON list."""
    first = F.get(F.from_json(items, "array<string>"), F.lit(0))
    return F.try_to_timestamp(F.regexp_extract(first, r"/(\d{8})T", 1), F.lit("yyyyMMdd")).cast("date")
