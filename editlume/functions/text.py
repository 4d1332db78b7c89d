"""Small text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit names by base.
UNITS = {1024: ("KiB", "MiB", "GiB", "TiB", "PiB", "EiB", "ZiB", "YiB"), 1000: ("KB", "MB", "GB", "TB", "PB", "EB", "ZB", "YB")}


def human_size(size: Column, base: int = 1024) -> Column:
    """A byte count in the largest unit below `base`, at least the first unit, with one decimal; NULL if negative."""
    value = size.cast("double")
    out = F.lit(None).cast("string")
    for k in range(len(UNITS[base]), 0, -1):
        scaled = value / float(base) ** k
        out = F.when(scaled < base, F.concat(F.call_function("format_number", scaled, F.lit("0.0")), F.lit(" " + UNITS[base][k - 1]))).otherwise(out)
    return F.when(value >= 0, out)


def hrefs(html: Column, pattern: str = ".*") -> Column:
    """All link targets of an HTML text that match `pattern` from their start."""
    return F.filter(F.regexp_extract_all(html, F.lit('href="([^"]*)"'), F.lit(1)), lambda h: h.rlike(f"^(?:{pattern})"))


def year_week(ts: Column) -> Column:
    """Year and week as yyyyww: weeks start on Monday, week 1 holds the year's first Monday."""
    monday = F.date_trunc("week", ts)
    return (F.year(monday) * 100 + F.floor((F.dayofyear(monday) - 1) / 7) + 1).cast("long")
