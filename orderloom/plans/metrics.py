"""Named tables, their links and the columns reports add up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.plans import cart, star

# Columns that reports sum; all other columns only group.
SUMMED = {
    "customers": ["total_orders", "avg_order_value", "visits_last_year"],
    "items": ["item_quantity", "item_price"],
    "options": ["option_price"],
    "option_counts": ["count", "avg_option_price"],
    "orders": ["total", "status", "cart_size", "cart_surcharge", "cart_total_price", "cart_gst"],
    "staged_orders": ["order_id", "customer_id", "total", "status"],
    "item_totals": [],
}


class Link(NamedTuple):
    """Rows of ``one`` select those of ``many`` with the same key; ``both`` ways if so said."""

    many: str
    one: str
    key: str
    both: bool = False


# The links of the report model.
LINKS = (
    Link("options", "orders", "order_id"),
    Link("items", "orders", "order_id"),
    Link("customers", "orders", "customer_id", both=True),
    Link("option_counts", "items", "item_name", both=True),
    Link("items", "item_totals", "item_name"),
)


def report_tables(orders: DataFrame, as_of=None) -> dict[str, DataFrame]:
    return {
        "customers": star.dim_customers(orders, as_of),
        "items": cart.item_details_v1(orders),
        "options": cart.item_options_v1(orders),
        "option_counts": star.item_options_analysis(orders),
        "orders": cart.order_details_v1(orders),
        "staged_orders": orders.select(
            "order_id",
            "customer_id",
            "ip_addr",
            "date_created",
            "date_paid",
            F.col("total_cents").alias("total"),
            "status",
        ),
        "item_totals": star.total_sales_by_item(orders),
    }


def _path(start: str, goal: str) -> list[tuple[str, str]]:
    """(key, table) steps from the summed table to the one that groups, shortest first."""
    routes: list[tuple[str, list[tuple[str, str]]]] = [(start, [])]
    seen = {start}
    while routes:
        at, steps = routes.pop(0)
        if at == goal:
            return steps
        for link in LINKS:
            for here, there in ((link.many, link.one), (link.one, link.many)):
                open_ = here == link.many or link.both
                if here == at and open_ and there not in seen:
                    seen.add(there)
                    routes.append((there, [*steps, (link.key, there)]))
    raise ValueError(f"{goal} cannot describe rows of {start}: no link leads there")


def _bridge(tables: Mapping[str, DataFrame], steps: Sequence[tuple[str, str]], columns: list[Column]) -> DataFrame:
    """Distinct (key of the first step, columns of the last table).

    Each table on the way gives only its distinct key pairs, so a value reaches a key of
    the summed table once, however many rows connect them.
    """
    key, owner = steps[-1]
    names = [f"_by{i}" for i in range(len(columns))]
    found = tables[owner].select(
        F.col(key).alias("_key"), *[c.alias(n) for c, n in zip(columns, names)]
    ).distinct()
    for (before, table), (after, _) in zip(reversed(steps[:-1]), reversed(steps[1:])):
        pairs = tables[table].select(F.col(before).alias("_near"), F.col(after).alias("_key")).distinct()
        found = pairs.join(found, "_key").select(F.col("_near").alias("_key"), *names).distinct()
    return found.where(F.col("_key").isNotNull())


def metric(
    tables: Mapping[str, DataFrame], table: str, measures: Sequence[str], by: Sequence[str]
) -> DataFrame:
    """Sums of a table's columns by columns of the same or of linked tables.

    ``by`` holds "table.column" names.  The measures are summed per own group column and
    link key first.  A row counts once for each value that reaches it through the links,
    and under null if none does; over a link between many and many, values of the other
    side are distinct per key before they meet the sums, so nothing is counted twice.
    """
    unknown = [m for m in measures if m not in SUMMED[table]]
    if unknown:
        raise ValueError(f"{table} has no summed column {', '.join(unknown)}")
    wanted: dict[str, list[tuple[str, str]]] = {}
    for i, name in enumerate(by):
        owner, column = name.split(".", 1)
        wanted.setdefault(owner, []).append((column, f"_group{i}"))
    own = wanted.pop(table, [])
    routes = {owner: _path(table, owner) for owner in wanted}
    keys = list(dict.fromkeys(steps[0][0] for steps in routes.values()))
    frame = (
        tables[table]
        .groupBy(
            *[F.col(column).alias(group) for column, group in own],
            *[F.col(key).alias(f"_link_{key}") for key in keys],
        )
        .agg(*[F.sum(m).alias(f"_sum_{m}") for m in measures])
    )
    for owner, columns in wanted.items():
        steps = routes[owner]
        side = _bridge(tables, steps, [F.col(column) for column, _ in columns])
        side = side.select(
            "_key", *[F.col(f"_by{i}").alias(group) for i, (_, group) in enumerate(columns)]
        )
        frame = frame.join(side, F.col(f"_link_{steps[0][0]}") == F.col("_key"), "left").drop("_key")
    groups = [F.col(f"_group{i}").alias(name.split(".", 1)[1]) for i, name in enumerate(by)]
    return frame.groupBy(*groups).agg(*[F.sum(f"_sum_{m}").alias(m) for m in measures])
