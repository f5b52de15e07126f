"""Calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_lit(value: dt.date | str | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("date")


def date_key(value: Column) -> Column:
    """``yyyymmdd`` as INT."""
    return (F.year(value) * 10000 + F.month(value) * 100 + F.day(value)).cast("int")


def key_to_date(key: Column) -> Column:
    return F.make_date(
        F.floor(key / 10000).cast("int"), (F.floor(key / 100) % 100).cast("int"), (key % 100).cast("int")
    )


def month_start(value: Column) -> Column:
    return F.trunc(value, "MM")


def day_number(value: Column) -> Column:
    """Days since 1970-01-01, for calendar RANGE windows."""
    return F.unix_date(value)


def whole_years(born: Column, at: Column) -> Column:
    """Completed years between two dates."""
    return F.floor(F.months_between(at, born) / 12).cast("int")


def calendar_columns(day: Column) -> dict[str, Column]:
    """The 14 calendar attributes of one day, ISO weeks and weekdays."""
    return {
        "date_key": date_key(day),
        "full_date": day,
        "day_of_week": (F.weekday(day) + 1).cast("smallint"),
        "day_name": F.date_format(day, "EEEE"),
        "day_of_month": F.day(day).cast("smallint"),
        "day_of_year": F.dayofyear(day).cast("smallint"),
        "week_of_year": F.weekofyear(day).cast("smallint"),
        "month_num": F.month(day).cast("smallint"),
        "month_name": F.date_format(day, "MMMM"),
        "quarter": F.quarter(day).cast("smallint"),
        "year": F.year(day).cast("smallint"),
        "is_weekend": F.weekday(day) >= 5,
        "is_holiday": F.lit(False),
        "fiscal_period": F.concat(
            F.lit("FY"), F.date_format(day, "yy"), F.lit("Q"), F.quarter(day).cast("string")
        ),
    }


def utc_instant(local: Column) -> Column:
    """A time without zone read as UTC, whatever the session's time zone is."""
    day_seconds = F.unix_date(local.cast("date")).cast("bigint") * 86_400
    seconds = day_seconds + F.hour(local) * 3600 + F.minute(local) * 60
    micros = (F.extract(F.lit("SECOND"), local) * 1_000_000).cast("bigint")
    return F.timestamp_micros(seconds * 1_000_000 + micros)


def utc_date(instant: Column) -> Column:
    """The UTC day of an instant."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86_400).cast("int"))
