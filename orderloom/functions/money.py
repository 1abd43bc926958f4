"""Money is whole cents until the last projection, so sums are exact in any order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dollars(cents: Column | str) -> Column:
    cents = F.col(cents) if isinstance(cents, str) else cents
    return cents / F.lit(100)


def parse_cents(text: Column) -> Column:
    """JSON number text to whole cents, halves away from zero; bad text is an error."""
    cents = text.cast("double")
    return F.when(cents < 0, F.ceil(cents - 0.5)).otherwise(F.floor(cents + 0.5))


def rounded_ratio(total: Column, count: Column) -> Column:
    """``total / count`` rounded to a whole number, halves away from zero.

    Integer arithmetic only.  No rows or a zero count give null.
    """
    count = F.nullif(count, F.lit(0))
    half_up = F.floor((F.abs(total) * 2 + count) / (count * 2))
    return (F.sign(total) * half_up).cast("long")


def dollars_text(cents: Column) -> Column:
    """Shortest plain text of a dollar amount ("4", "4.5", "4.55"), for key building."""
    size = F.abs(cents)
    digits = F.concat(
        F.floor(size / 100).cast("string"),
        F.lit("."),
        F.lpad((size % 100).cast("string"), 2, "0"),
    )
    short = F.rtrim(F.rtrim(digits, F.lit("0")), F.lit("."))
    return F.concat(F.when(cents < 0, "-").otherwise(""), short)
