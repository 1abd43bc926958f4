"""Item categories: the shop supplies its own menu, the first matching list wins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_CATEGORY = "Kitchen"


def by_menu(menu: Mapping[str, Sequence[str]], default: str = DEFAULT_CATEGORY):
    """A rule ``name column -> category column`` from ordered lists of item names."""

    def rule(name: Column) -> Column:
        pick = None
        for category, names in menu.items():
            hit = name.isin(list(names))
            pick = F.when(hit, category) if pick is None else pick.when(hit, category)
        return F.lit(default) if pick is None else pick.otherwise(default)

    return rule


def by_last_word(words: Mapping[str, Sequence[str]], default: str = DEFAULT_CATEGORY):
    """A rule that looks only at the last word of the item name."""
    base = by_menu(words, default)
    return lambda name: base(F.substring_index(name, " ", -1))


def first_positions(menu: DataFrame) -> DataFrame:
    """One category per name of a menu table (position, item_name, item_category).

    The lowest position of a name wins, then the first category in order.
    """
    place = F.min(F.struct("position", "item_category"))
    named = menu.where(F.col("item_name").isNotNull()).groupBy("item_name").agg(place.alias("_first"))
    return named.select("item_name", F.col("_first.item_category").alias("item_category"))


def with_menu(lines: DataFrame, menu: DataFrame, default: str = DEFAULT_CATEGORY) -> DataFrame:
    """Lines with the category of a menu table of any size, joined by item name.

    Names outside the menu get the default.  A frequent name does not need the menu to be
    small: Spark broadcasts it if it is, else splits the name's lines.
    """
    plain = lines.drop("item_category")
    joined = plain.join(first_positions(menu), "item_name", "left")
    category = F.coalesce("item_category", F.lit(default)).alias("item_category")
    return joined.select(*[category if c == "item_category" else c for c in _kept(lines)])


def _kept(lines: DataFrame) -> list[str]:
    names = list(lines.columns)
    return names if "item_category" in names else [*names, "item_category"]
