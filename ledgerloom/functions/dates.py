"""Date text, gaps and time zones."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CATALOGUE_ZONE = "US/Pacific"


def date_prefix(text: Column) -> Column:
    """The first ten characters of a timestamp text; empty becomes null."""
    return F.nullif(F.left(text, F.lit(10)), F.lit(""))


def moment_of(text: Column, wall_clock: bool = False) -> Column:
    """The moment an ISO timestamp names; with ``wall_clock`` its zone suffix is cut off."""
    if wall_clock:
        return F.try_to_timestamp(F.left(text, F.lit(19)), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    return text.try_cast("timestamp")


def duration_hours(start: Column, end: Column, wall_clock: bool = False) -> Column:
    """Hours between two ISO timestamps; ``wall_clock`` ignores that a clock changed between them."""
    seconds = F.unix_timestamp(moment_of(end, wall_clock)) - F.unix_timestamp(moment_of(start, wall_clock))
    return F.round((seconds / F.lit(3600)).cast("decimal(20,8)"), 2).cast("double")


def year_month_label(year: Column, month: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


# Labels of the days to a readmission.
def readmit_window_label(days: Column) -> Column:
    return (
        F.when(days <= 7, "0-7 days")
        .when(days <= 14, "8-14 days")
        .when(days <= 21, "15-21 days")
        .otherwise("22-30 days")
    )


def to_pacific(utc: Column) -> Column:
    return F.from_utc_timestamp(utc, CATALOGUE_ZONE)


def from_pacific(local: Column) -> Column:
    return F.to_utc_timestamp(local, CATALOGUE_ZONE)


def short_time(text: Column) -> Column:
    """``2024-01-01T08:30:00`` shown as ``2024-01-01 08:30``."""
    shown = F.replace(F.left(text, F.lit(16)), F.lit("T"), F.lit(" "))
    return F.coalesce(F.nullif(shown, F.lit("")), F.lit("Unknown Time"))
