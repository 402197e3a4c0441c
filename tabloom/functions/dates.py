"""Dates, times of day and cyclic angles as Column expressions."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date layouts a text column is probed with.
DATE_FORMATS = (
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "MM/dd/yyyy",
    "MM/dd/yyyy hh:mm:ss a",
    "MM/dd/yyyy HH:mm:ss",
)
# The layouts of the two text forms the preparation parses.
US_TIMESTAMP_FORMAT = "MM/dd/yyyy hh:mm:ss a"
CLOCK_FORMAT = "h:mm:ss a"

# Fixed value: the early-morning slot that spans more than one hour.
LONG_SLOT = "0001-0559"

MINUTES_PER_DAY = 24 * 60


def number_probe(column: Column) -> Column:
    """The value as a double, null where the text is no number."""
    return column.try_cast("double")


def timestamp_probe(column: Column, fmt: str) -> Column:
    return F.try_to_timestamp(column, F.lit(fmt))


def parse_us_timestamp(column: Column) -> Column:
    return F.try_to_timestamp(column, F.lit(US_TIMESTAMP_FORMAT))


def date_parts(column: Column) -> dict[str, Column]:
    return {
        "year": F.year(column),
        "quarter": F.quarter(column),
        "month": F.month(column),
        "day": F.dayofmonth(column),
    }


def clock_parts(column: Column) -> dict[str, Column]:
    """hour, minute and second of a ``3:05:00 PM`` text."""
    parsed = F.try_to_timestamp(column, F.lit(CLOCK_FORMAT))
    return {"hour": F.hour(parsed), "minute": F.minute(parsed), "second": F.second(parsed)}


def timestamp_from_parts(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column) -> Column:
    return F.try_make_timestamp(
        year.cast("int"), month.cast("int"), day.cast("int"),
        hour.cast("int"), minute.cast("int"), second.cast("decimal(8,6)"),
    )


def clock_label(column: Column) -> Column:
    """``hhmm`` number as ``hh:mm``; missing or malformed values become ``""``."""
    text = column.try_cast("double").try_cast("long").cast("string")
    padded = F.when(F.length(text) < 4, F.lpad(text, 4, "0")).otherwise(text)
    label = F.concat(F.substring(padded, 1, 2), F.lit(":"), F.substring(padded, 3, 20))
    return F.coalesce(label, F.lit(""))


def clock_angle(label: Column) -> Column:
    """Angle on the day circle of ``hh:mm``; ``24:00`` is midnight, others null."""
    valid = label.rlike(r"^([01][0-9]|2[0-3]):[0-5][0-9]$") | (label == "24:00")
    hour = F.substring(label, 1, 2).try_cast("int") % 24
    minute = F.substring(label, 4, 2).try_cast("int")
    return F.when(valid, F.lit(2 * pi) * (hour * 60 + minute) / F.lit(float(MINUTES_PER_DAY)))


def slot_angle(slot: Column) -> Column:
    """Angle of the middle of an hour slot ``hh00-hh59``, or of the long early slot."""
    start = F.substring(slot, 1, 2).try_cast("int") * 60 + F.substring(slot, 3, 2).try_cast("int")
    end = F.substring(slot, 6, 2).try_cast("int") * 60 + F.substring(slot, 8, 2).try_cast("int")
    hourly = slot.rlike(r"^([01][0-9]|2[0-3])00-([01][0-9]|2[0-3])59$") & (
        F.substring(slot, 1, 2) == F.substring(slot, 6, 2)
    )
    middle = (start + end) / F.lit(2.0)
    return F.when(hourly | (slot == LONG_SLOT), F.lit(2 * pi) * middle / F.lit(float(MINUTES_PER_DAY)))


def ordinal_angle(column: Column, size: int) -> Column:
    """Angle of a 1-based position on a circle of ``size`` steps, null outside it."""
    value = column.try_cast("double")
    return F.when(
        (value >= 1) & (value <= size) & (value == F.floor(value)),
        F.lit(2 * pi) * (value - 1) / F.lit(float(size)),
    )


def modulo_angle(column: Column, period: int) -> Column:
    value = column.try_cast("double")
    return F.lit(2 * pi) * F.pmod(value, F.lit(float(period))) / F.lit(float(period))
