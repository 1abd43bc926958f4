"""Payment status texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status code texts that downstream reports match on.
STATUS_TEXT = {
    2: "Payment is successful",
    1: "Payment is successful, label not printed",
    9: "Payment is unsuccessful",
    0: "Order created but no payment made",
}
UNKNOWN_ERA = "Unknown (2019-2020)"
UNKNOWN = "Status Unknown"
UNKNOWN_ERA_CODE = 10
UNKNOWN_ERA_YEARS = (2019, 2020)


def status_description(status: Column, created: Column | None = None) -> Column:
    """Text of a status code.

    Code 10 belongs to the early years only; without ``created`` the year is ignored.
    """
    early = F.lit(True) if created is None else F.year(created).between(*UNKNOWN_ERA_YEARS)
    text = F.when((status == UNKNOWN_ERA_CODE) & early, UNKNOWN_ERA)
    for code, label in STATUS_TEXT.items():
        text = text.when(status == code, label)
    return text.otherwise(UNKNOWN)
