"""Calendar expressions on zone-free timestamps and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# English names, Monday and January first.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTHS = [
    "January", "February", "March", "April", "May", "June", "July", "August", "September",
    "October", "November", "December",
]


def whole_days(start: Column, end: Column) -> Column:
    """Full 24-hour days between two zone-free timestamps: a 47-hour gap is 1 day."""
    return F.extract(F.lit("DAY"), end - start).cast("long")


def sunday_week(day: Column) -> Column:
    """Week of the year with weeks starting on Sunday; days before the first are week 0."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("int")


def iso_weekday(day: Column) -> Column:
    """Monday 1 .. Sunday 7."""
    return F.weekday(day) + 1


def weekday_name(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in WEEKDAYS]), iso_weekday(day))


def month_name(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in MONTHS]), F.month(day))


def month_start(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "month")


def quarter_label(ts: Column) -> Column:
    return F.concat(F.year(ts).cast("string"), F.lit("-Q"), F.quarter(ts).cast("string"))


def hour_text(ts: Column) -> Column:
    return F.lpad(F.hour(ts).cast("string"), 2, "0")


def clock_text(ts: Column) -> Column:
    return F.concat(hour_text(ts), F.lit(":"), F.lpad(F.minute(ts).cast("string"), 2, "0"))


def calendar_columns(day: Column) -> list[Column]:
    """The columns of the calendar dimension for one date column."""
    return [
        day.alias("date_key"),
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        weekday_name(day).alias("day_of_week"),
        month_name(day).alias("month_name"),
        F.dayofweek(day).alias("weekday_index"),
        sunday_week(day).alias("week_of_year"),
        F.quarter(day).alias("quarter"),
    ]
