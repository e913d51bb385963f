"""Dates from text that mixes ISO and day-first notation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Day and month may be unpadded, the time is optional.
DAY_FIRST = "d/M/yyyy[ HH:mm:ss]"

# The two notations, white space around them aside; text of any other shape (a bare number, a year, a date with a
# tail) is no date.
_ISO = r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,9})?)?\s*$"
_DAY_FIRST = r"^\s*[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}( [0-9]{2}:[0-9]{2}:[0-9]{2})?\s*$"


def as_moment(text: Column) -> Column:
    """Zone-less timestamp from ``yyyy-MM-dd[ HH:mm:ss]`` or ``d/M/yyyy[ HH:mm:ss]``, blanks around it aside.

    NULL for text of any other shape and for days that do not exist.
    """
    # The cast trims by itself; trimming any white space first would cost more than the rest.
    day_first = F.try_to_timestamp(F.btrim(text, F.lit(" \t\n\x0b\f\r")), F.lit(DAY_FIRST)).cast("timestamp_ntz")
    return F.when(text.rlike(_ISO), text.try_cast("timestamp_ntz")).when(text.rlike(_DAY_FIRST), day_first)


def as_date(text: Column) -> Column:
    """Date of the same notations."""
    return as_moment(text).cast("date")


def moment_of(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a moment: text is parsed, dates and timestamps pass unchanged."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return as_moment(F.col(name))
    return F.col(name)


def year_of(df: DataFrame, name: str) -> Column:
    """Civil year of column ``name``; NULL when the text is no date."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.year(as_date(F.col(name)))
    return F.year(name)
