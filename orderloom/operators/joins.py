"""Joins on keys whose types are known to agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The type each key has in every table that holds it.
KEYS: dict[str, T.DataType] = {
    "order_id": T.LongType(),
    "customer_id": T.LongType(),
    "order_item_id": T.StringType(),
    "item_name": T.StringType(),
    "item": T.StringType(),
    "status": T.IntegerType(),
    "date_key": T.DateType(),
    "day": T.DateType(),
    "hour": T.IntegerType(),
}


class KeyMismatch(TypeError):
    """Two tables hold a key in types that do not meet."""


def _text(kind: T.DataType) -> str:
    return kind.simpleString()


def check_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> None:
    """Complain, before anything runs, of keys that are missing, of different types on the
    two sides or other than the contract says, and of keys that cannot be compared exactly.

    Spark would cast one side, so a text key would match a number only where it is written
    the same way, and the cast hides the key from the storage layout.
    """
    problems = []
    for key in keys:
        sides = [df.schema[key].dataType if key in df.columns else None for df in (left, right)]
        if None in sides:
            problems.append(f"{key} is missing on the {'left' if sides[0] is None else 'right'}")
            continue
        if sides[0] != sides[1]:
            problems.append(f"{key} is {_text(sides[0])} on the left, {_text(sides[1])} on the right")
        wanted = KEYS.get(key)
        for side, kind in zip(("left", "right"), sides):
            if wanted is not None and kind != wanted:
                problems.append(f"{key} is {_text(kind)} on the {side}, its contract is {_text(wanted)}")
            elif isinstance(kind, (T.DoubleType, T.FloatType)):
                problems.append(f"{key} is {_text(kind)}, which does not compare exactly")
    if problems:
        raise KeyMismatch("; ".join(dict.fromkeys(problems)))


def join_on(left: DataFrame, right: DataFrame, keys: str | Sequence[str], how: str = "inner") -> DataFrame:
    """A join on columns of the same name, refused where their types differ."""
    names = [keys] if isinstance(keys, str) else list(keys)
    check_keys(left, right, names)
    return left.join(right, names, how)
