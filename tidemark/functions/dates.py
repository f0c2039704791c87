"""Date parsing and the stamp formats used in paths and metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: text formats of the delivered files and landing paths -----------
TRENDING_DATE_PATTERN = r"^\d{2}\.\d{2}\.\d{2}$"
TRENDING_DATE_FORMAT = "yy.dd.MM"
CENTURY = "20"  # two-digit years
DAY_FORMAT = "yyyy-MM-dd"
HOUR_FORMAT = "HH"
INGESTION_ID_FORMAT = "yyyyMMdd_HHmmss"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def parse_trending_date(c: Column) -> Column:
    """'17.14.11' (year.day.month) or an ISO date; anything else gives NULL.

    The short form is rearranged into ISO and cast, which costs less than a parser for
    the pattern; text that cannot be a date does not get as far as the cast.
    """
    iso = F.concat(
        F.lit(CENTURY), F.substring(c, 1, 2), F.lit("-"), F.substring(c, 7, 2),
        F.lit("-"), F.substring(c, 4, 2),
    )
    return (
        F.when(c.rlike(TRENDING_DATE_PATTERN), iso)
        .when(c.rlike(r"^\s*[+-]?\d{4}"), c)
        .try_cast("date")
    )


def trending_stamp(c: Column) -> Column:
    return F.date_format(c, TRENDING_DATE_FORMAT)


def day_stamp(c: Column) -> Column:
    return F.date_format(c, DAY_FORMAT)


def hour_stamp(c: Column) -> Column:
    return F.date_format(c, HOUR_FORMAT)


def ingestion_id(c: Column) -> Column:
    return F.date_format(c, INGESTION_ID_FORMAT)


def iso_stamp(c: Column) -> Column:
    return F.date_format(c.cast("timestamp"), ISO_FORMAT)


def hours_before(c: Column, hours: int) -> Column:
    return c - F.make_dt_interval(hours=F.lit(hours))
