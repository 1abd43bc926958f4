"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text that stands for a null part of a key.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: Column) -> Column:
    """md5 of the parts joined by dashes.  Give money as
    ``money.dollars_text``: the text of a float differs between engines."""
    texts = [F.coalesce(part.cast("string"), F.lit(NULL_PART)) for part in parts]
    return F.md5(F.concat_ws("-", *texts))
