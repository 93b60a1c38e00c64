"""Calendar expressions (all built-in, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d) -> Column:
    """yyyyMMdd as an int (20240131)."""
    return F.date_format(_c(d), "yyyyMMdd").cast("int")


def year_month(d) -> Column:
    return F.date_format(_c(d), "yyyy-MM")


def month_index(d) -> Column:
    """Absolute month number ``year * 12 + month`` (differences = month offsets)."""
    d = _c(d)
    return F.year(d) * 12 + F.month(d)


def is_weekend(d) -> Column:
    return F.dayofweek(_c(d)).isin(1, 7)       # 1 = Sunday .. 7 = Saturday


def year_start(d) -> Column:
    return F.trunc(_c(d), "YEAR")


def year_end(d) -> Column:
    return F.last_day(F.add_months(F.trunc(_c(d), "YEAR"), 11))


def date_attributes(d="date") -> dict[str, Column]:
    """The calendar attributes of a date dimension, in column order."""
    d = _c(d)
    return {
        "date_key": date_key(d),
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "day": F.dayofmonth(d),
        "day_of_week": F.dayofweek(d),
        "day_name": F.date_format(d, "EEEE"),
        "day_of_year": F.dayofyear(d),
        "week_of_year": F.weekofyear(d),
        "is_weekend": is_weekend(d),
        "year_month": year_month(d),
        "quarter_name": F.concat(F.lit("Q"), F.quarter(d).cast("string")),
        "first_day_of_month": F.trunc(d, "month"),
        "last_day_of_month": F.last_day(d),
    }
