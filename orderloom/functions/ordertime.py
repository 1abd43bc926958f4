"""Requested pickup time as HH:mm."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.calendar import clock_text

ASAP = "ASAP"


def requested_time(verbose: Column, created: Column) -> Column:
    """The last word of the request as a 24-hour clock time.

    A missing request and "ASAP" mean the time of creation.  A last word that is no
    12-hour time ("PM" after a blank) gives null.
    """
    last = F.element_at(F.split(F.trim(verbose), r"\s+"), -1)
    asap = verbose.isNull() | (last == ASAP)
    marked = F.upper(last)
    parsed = F.coalesce(
        F.try_to_timestamp(last, F.lit("h:mm")), F.try_to_timestamp(marked, F.lit("h:mma"))
    )
    return F.when(asap, clock_text(created)).otherwise(clock_text(parsed))


def requested_time_full(verbose: Column, created: Column) -> Column:
    """Like ``requested_time``, but also reads a blank before AM or PM."""
    glued = F.regexp_replace(F.trim(verbose), r"(?i)\s+([ap]m)$", "$1")
    return requested_time(glued, created)
