"""Order documents to one row per order, with the cart lines as a nested array.

An order is one row, so line identity, ranks and merged quantities are array
expressions inside that row: nothing here shuffles, and one busy customer or item
costs no more than any other.  ``order_id`` must be unique in the raw table
(``quality.unique`` checks that).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.categories import by_menu
from orderloom.functions.keys import surrogate_key
from orderloom.functions.money import dollars, dollars_text, parse_cents, rounded_ratio
from orderloom.functions.status import status_description

SCALARS = ["cart_size", "cart_surcharge", "cart_total_price", "cart_gst", "order_time", "order_time_verbose"]
DOCUMENT = (
    "cart_size string, cart_surcharge string, cart_total_price string, cart_gst string, "
    "order_time string, order_time_verbose string, cart array<string>"
)
OPTION = "name: string, value: string, price: string"
ODD_OPTION = "name string, value string, price string"
CART = f"""cart array<struct<
    name: string, price: string, quantity: string, options: array<struct<{OPTION}>>>>"""
LINE = f"name string, price string, quantity string, options array<struct<{OPTION}>>"

CategoryRule = Callable[[Column], Column]
no_menu: CategoryRule = by_menu({})


def stg_orders(raw: DataFrame) -> DataFrame:
    """Raw orders with the total in dollars and the document renamed."""
    return raw.select(
        "order_id",
        "customer_id",
        "date_created",
        "date_paid",
        dollars("total").alias("total"),
        "status",
        F.col("items").alias("items_json"),
    )


def stg_orders_v1(raw: DataFrame) -> DataFrame:
    """Older form: total stays in cents, the address hash is kept."""
    return raw.withColumnRenamed("items", "items_json").select(
        "order_id",
        "customer_id",
        "ip_addr",
        F.col("date_created").cast("timestamp_ntz").alias("date_created"),
        F.col("date_paid").cast("timestamp_ntz").alias("date_paid"),
        "total",
        "status",
        "items_json",
    )


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once per row.

    A plain expression used inside an array lambda would be evaluated again for every
    element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scalar(text: Column, value: Column, field: str) -> Column:
    """A text field of an object; null where the document holds an object or a list there.

    The parser gives the JSON text of such a value.  Only a value that looks like it is
    parsed again, as a text may also begin with a bracket.
    """
    shapes = [F.from_json(text, f"`{field}` {kind}")[field] for kind in ("struct<_:string>", "array<string>")]
    nested = shapes[0].isNotNull() | shapes[1].isNotNull()
    return F.when(value.rlike(r"^\s*[{\[]") & nested, F.lit(None)).otherwise(value)


def _whole(text: Column) -> Column:
    """A whole number, null for other text.  Text without a digit is none: it is not handed
    to the cast, which makes an exception of each."""
    return F.when(text.rlike("[0-9]"), text.try_cast("long"))


def _element(text: Column, parsed: Column) -> Column:
    # an option that is no object empties the whole list: read such lists one by one
    odd_options = F.transform(
        F.from_json(text, "options array<string>")["options"],
        lambda option: F.from_json(option, ODD_OPTION),
    )
    return F.struct(
        _scalar(text, parsed["name"], "name").alias("item_name"),
        text.alias("cart_item"),
        F.coalesce(_whole(parsed["quantity"]), F.lit(1)).alias("quantity"),
        _bind(_scalar(text, parsed["price"], "price"), parse_cents).alias("price_cents"),
        F.coalesce(parsed["options"], odd_options).alias("options"),
    )


def _elements(texts: Column, items: Column) -> Column:
    """Cart elements with their fields, in document order.

    One parse reads the fields of the whole cart.  It gives nothing when an element is
    not an object; only such carts are read element by element.
    """

    def odd(text: Column) -> Column:
        return _bind(F.from_json(text, LINE), lambda parsed: _element(text, parsed))

    regular = F.zip_with(texts, F.from_json(items, CART)["cart"], _element)
    return F.coalesce(regular, F.transform(texts, odd))


def _lines(texts: Column, items: Column, category: CategoryRule) -> Column:
    """Merged cart lines in identity order.

    Two elements are the same line when their JSON text is equal; ``item_id`` numbers the
    distinct lines by (name, text), ``item_rank`` the distinct names.
    """

    def without_repeats(elements: Column) -> Column:
        def first_of_equals(e: Column, i: Column) -> Column:
            return (i == 0) | ~e["cart_item"].eqNullSafe(F.get(elements, i - 1)["cart_item"])

        return F.filter(elements, first_of_equals)

    def number(env: Column) -> Column:
        lines, ranked, merged = env["lines"], env["ranked"], env["merged"]

        def line(e: Column, position: Column) -> Column:
            same = F.filter(texts, lambda text: text.eqNullSafe(e["cart_item"]))
            place = F.array_position(ranked, F.struct(e["item_name"].alias("n")))
            rank = F.when(ranked.isNull(), position + 1).otherwise(place.cast("int"))
            return F.struct(
                (position + 1).alias("item_id"),
                rank.alias("item_rank"),
                e["item_name"].alias("item_name"),
                _bind(e["item_name"], category).alias("item_category"),
                F.when(merged, F.size(same)).otherwise(1).alias("copies"),
                e["quantity"].alias("quantity"),
                e["price_cents"].alias("price_cents"),
                e["cart_item"].alias("cart_item"),
                e["options"].alias("options"),
            )

        return F.transform(lines, line)

    def prepare(elements: Column) -> Column:
        # equal lines are rare: only carts that have some are searched for copies
        merged = F.size(F.array_distinct(texts)) < F.size(texts)
        # where every name occurs once, the lines in order are the names in order
        repeated = F.size(F.array_distinct(elements["item_name"])) < F.size(elements)
        names = F.transform(elements, lambda e: F.struct(e["item_name"].alias("n")))
        return F.struct(
            F.when(merged, without_repeats(elements)).otherwise(elements).alias("lines"),
            F.when(repeated, F.array_distinct(names)).alias("ranked"),
            merged.alias("merged"),
        )

    ordered = F.sort_array(_elements(texts, items))
    return _bind(_bind(ordered, prepare), number)


def order_documents(raw: DataFrame, category: CategoryRule = no_menu) -> DataFrame:
    """One row per order: scalars of the document in typed form and the merged lines.

    A missing or broken document leaves ``lines`` null; such orders have no lines in any
    later table.  ``quantity`` and ``price_cents`` of a line are those of one copy.
    ``item_count`` is the number of distinct names (null without a readable cart) and
    ``line_cents`` the sum of line prices.
    """
    doc, items = F.col("doc"), F.col("items")
    parsed = raw.withColumn("doc", F.from_json("items", DOCUMENT))
    # texts in a step of their own: each is found once, and the parses that look for an odd
    # value stay behind the test that such a value is there
    found = parsed.select(
        *["order_id", "customer_id", "ip_addr", "date_created", "date_paid", "total", "status"],
        *[_scalar(items, doc[name], name).alias(f"_{name}") for name in SCALARS],
        _lines(doc["cart"], items, category).alias("lines"),
    )
    orders = found.select(
        "order_id",
        "customer_id",
        "ip_addr",
        "date_created",
        "date_paid",
        F.col("total").alias("total_cents"),
        "status",
        status_description(F.col("status"), F.col("date_created")).alias("status_description"),
        F.col("_cart_size").cast("long").alias("cart_size"),
        parse_cents(F.col("_cart_surcharge")).alias("surcharge_cents"),
        parse_cents(F.col("_cart_total_price")).alias("cart_total_cents"),
        parse_cents(F.col("_cart_gst")).alias("gst_cents"),
        F.col("_order_time").alias("order_time"),
        F.col("_order_time_verbose").alias("order_time_verbose"),
        "lines",
    )
    zero = F.lit(0).cast("long")
    return orders.withColumns(
        {
            "item_count": F.coalesce(
                F.try_element_at("lines", F.lit(-1))["item_rank"],
                F.when(F.col("lines").isNotNull(), F.lit(0)),
            ),
            "line_cents": F.coalesce(
                F.aggregate(
                    "lines",
                    zero,
                    lambda acc, e: acc + F.coalesce(e["price_cents"] * e["copies"], zero),
                ),
                zero,
            ),
        }
    )


def has_lines() -> Column:
    return F.col("item_count") > 0


def item_names() -> Column:
    """Distinct item names of an order; reads only the names."""
    return F.array_distinct(F.col("lines.item_name"))


def _slim_lines(orders: DataFrame, keep: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Orders with only the named fields in their lines."""
    lines = F.arrays_zip(*[F.col(f"lines.{field}") for field in fields])
    return orders.select(*keep, lines.alias("lines"))


def each_line(orders: DataFrame, keep: Sequence[str | Column], fields: Sequence[str]) -> DataFrame:
    """One row per merged line with only the named line fields.

    Zipping the fields one by one lets the Parquet scan skip the others, above all the
    JSON text of each line.
    """
    zipped = F.arrays_zip(*[F.col(f"lines.{field}") for field in fields])
    exploded = orders.select(*keep, F.explode(zipped).alias("_line"))
    names = [c for c in exploded.columns if c != "_line"]
    return exploded.select(*names, *[F.col("_line")[field].alias(field) for field in fields])


def order_item_id() -> Column:
    return F.concat_ws("-", F.col("order_id"), F.col("item_id"))


def cart_lines(orders: DataFrame) -> DataFrame:
    """One row per distinct cart line, quantities and prices summed over equal lines."""
    lines = each_line(
        orders,
        [
            "order_id", "customer_id", "date_created", "date_paid", "total_cents", "status",
            "status_description", "cart_size", "surcharge_cents", "cart_total_cents",
            "gst_cents", "order_time", "order_time_verbose",
        ],
        [
            "item_id", "item_rank", "item_name", "item_category", "copies", "quantity",
            "price_cents", "cart_item",
        ],
    )
    return lines.select(
        order_item_id().alias("order_item_id"),
        F.concat_ws("-", F.col("order_id"), F.col("item_rank")).alias("order_item_ranking"),
        "item_id",
        "item_rank",
        "item_category",
        "order_id",
        "customer_id",
        "date_created",
        "date_paid",
        dollars("total_cents").alias("total"),
        "status",
        "cart_size",
        dollars("surcharge_cents").alias("cart_surcharge"),
        dollars("cart_total_cents").alias("cart_total_price"),
        dollars("gst_cents").alias("cart_gst"),
        "order_time",
        "order_time_verbose",
        "item_name",
        (F.col("quantity") * F.col("copies")).alias("item_quantity"),
        dollars(F.col("price_cents") * F.col("copies")).alias("item_price"),
        "status_description",
        F.col("cart_item").alias("cart_items"),
    )


def _option_columns() -> list[Column]:
    option = F.col("option")
    return [
        option["name"].alias("option_name"),
        option["value"].alias("option_value"),
        parse_cents(F.when(~option["price"].rlike(r"^\s*[{\[]"), option["price"])).alias(
            "option_price_cents"
        ),
    ]


def option_rows(orders: DataFrame) -> DataFrame:
    """One row per option of a merged line, price in cents."""
    lines = each_line(orders, ["order_id", "date_created"], ["item_id", "item_name", "options"])
    options = lines.select(
        "order_id",
        "date_created",
        order_item_id().alias("order_item_id"),
        "item_name",
        F.explode("options").alias("option"),
    )
    return options.select(
        "order_item_id", "order_id", "item_name", *_option_columns(), "date_created"
    )


def line_options(orders: DataFrame) -> DataFrame:
    return option_rows(orders).select(
        "order_item_id",
        "order_id",
        "item_name",
        "option_name",
        "option_value",
        dollars("option_price_cents").alias("option_price"),
        "date_created",
    )


def fct_order_details(orders: DataFrame) -> DataFrame:
    """Orders that have lines, without the lines."""
    return orders.where(has_lines()).select(
        "order_id",
        "customer_id",
        "date_created",
        "date_paid",
        "order_time",
        "order_time_verbose",
        dollars("total_cents").alias("total"),
        "status",
        "cart_size",
        dollars("surcharge_cents").alias("cart_surcharge"),
        dollars("cart_total_cents").alias("cart_total_price"),
        dollars("gst_cents").alias("cart_gst"),
    )


def fct_product_sales(orders: DataFrame) -> DataFrame:
    """One row per merged line; the document holds line prices, so price is per unit."""
    lines = each_line(
        orders, ["order_id"], ["item_id", "item_name", "copies", "quantity", "price_cents"]
    )
    quantity = F.col("quantity") * F.col("copies")
    sales = F.col("price_cents") * F.col("copies")
    return lines.select(
        order_item_id().alias("order_item_id"),
        "item_name",
        "order_id",
        dollars(rounded_ratio(sales, quantity)).alias("price"),
        quantity.alias("quantity"),
        dollars(sales).alias("item_sales"),
    )


def fct_order_item_options(orders: DataFrame) -> DataFrame:
    options = option_rows(orders)
    key = surrogate_key(
        F.col("order_item_id"),
        F.col("order_id"),
        F.col("item_name"),
        F.col("option_name"),
        F.col("option_value"),
        dollars_text(F.col("option_price_cents")),
    )
    return options.select(
        key.alias("order_item_option_id"),
        "order_item_id",
        "order_id",
        "item_name",
        "option_name",
        "option_value",
        dollars("option_price_cents").alias("option_price"),
    )


def _check_semantics(price_semantics: str) -> None:
    if price_semantics not in ("line", "unit"):
        raise ValueError(f"price_semantics must be 'line' or 'unit', got {price_semantics!r}")


def _amount(e: Column, price_semantics: str) -> Column:
    cents = e["price_cents"] * e["copies"]
    return cents if price_semantics == "line" else cents * e["quantity"]


def line_sales(
    orders: DataFrame, price_semantics: str = "line", fields: Sequence[str] = ("item_name",)
) -> DataFrame:
    """Sales per merged line, money in cents: for sums, where lines need no grouping.

    ``fields`` are the line fields wanted beside quantity and money.
    """
    _check_semantics(price_semantics)
    lines = each_line(
        orders,
        ["order_id", "date_created", "customer_id"],
        [*fields, "copies", "quantity", "price_cents"],
    )
    cents = F.col("price_cents") * F.col("copies")
    return lines.select(
        "order_id",
        "date_created",
        "customer_id",
        *fields,
        (F.col("quantity") * F.col("copies")).alias("quantity_sold"),
        (cents if price_semantics == "line" else cents * F.col("quantity")).alias("sales_cents"),
    )


def product_sales(orders: DataFrame, price_semantics: str = "line") -> DataFrame:
    """Sales per order and item, money in cents.

    ``line``: the cart price is that of the whole line.  ``unit``: it is the price of one
    piece and is multiplied by the quantity.  Grouping stays inside the order row.
    """
    _check_semantics(price_semantics)
    lines = F.col("lines")
    zero = F.lit(0).cast("long")

    def sale(e: Column, quantity: Column, cents: Column) -> Column:
        return F.struct(
            e["item_name"].alias("item_name"),
            e["item_category"].alias("item_category"),
            quantity.alias("quantity_sold"),
            cents.alias("sales_cents"),
        )

    def single(e: Column) -> Column:
        cents = F.coalesce(_amount(e, price_semantics), zero)
        return sale(e, e["quantity"] * e["copies"], cents)

    def combined(rank: Column) -> Column:
        def total(same: Column, of: Callable[[Column], Column]) -> Column:
            return F.aggregate(same, zero, lambda acc, e: acc + F.coalesce(of(e), zero))

        return _bind(
            F.filter(lines, lambda e: e["item_rank"] == rank),
            lambda same: sale(
                same[0],
                total(same, lambda e: e["quantity"] * e["copies"]),
                total(same, lambda e: _amount(e, price_semantics)),
            ),
        )

    # most carts name an item once; only the others are grouped
    ranks = F.sequence(F.lit(1), F.col("item_count"))
    sales = F.when(F.col("item_count") == F.size(lines), F.transform(lines, single)).when(
        F.col("item_count") > 0, F.transform(ranks, combined)
    )
    slim = _slim_lines(
        orders.where(has_lines()),
        ["order_id", "date_created", "customer_id", "item_count"],
        ["item_name", "item_category", "item_rank", "copies", "quantity", "price_cents"],
    )
    return slim.select("order_id", "date_created", "customer_id", F.inline(sales))


# Older generation of the same tables -------------------------------------------------


def order_details_v1(orders: DataFrame) -> DataFrame:
    """Every order, also those with an empty or broken cart."""
    return orders.select(
        "order_id",
        "customer_id",
        "ip_addr",
        "date_created",
        "date_paid",
        dollars("total_cents").alias("total"),
        "status",
        "cart_size",
        dollars("surcharge_cents").alias("cart_surcharge"),
        dollars("cart_total_cents").alias("cart_total_price"),
        dollars("gst_cents").alias("cart_gst"),
    )


def _each_element(orders: DataFrame, keep: Sequence[str | Column], fields: Sequence[str]) -> DataFrame:
    """One row per cart element: equal elements stay separate rows."""
    lines = each_line(orders, keep, [*fields, "copies"])
    repeated = lines.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.drop("_copy", "copies")


def item_details_v1(orders: DataFrame) -> DataFrame:
    """One row per cart element, price as written."""
    elements = _each_element(
        orders,
        ["order_id", "order_time", "order_time_verbose"],
        ["item_name", "item_category", "item_rank", "quantity", "price_cents"],
    )
    return elements.select(
        F.concat_ws("-", F.col("order_id"), F.col("item_rank")).alias("order_item_ranking"),
        "order_id",
        "item_name",
        "item_category",
        F.col("quantity").alias("item_quantity"),
        dollars("price_cents").alias("item_price"),
        "order_time",
        "order_time_verbose",
        "item_rank",
    )


def weighted_options_v1(orders: DataFrame) -> DataFrame:
    """Options of the older join on (order, item name), one row with a weight.

    That join pairs the options of a name that occurs k times in a cart with all k lines,
    so every option counts k times per element.  ``weight`` holds that count; no pairs are
    built here.
    """
    lines = F.col("lines")

    def named(name: Column) -> Column:
        same = F.filter(lines, lambda e: e["item_name"].eqNullSafe(name))
        return F.aggregate(same, F.lit(0), lambda acc, e: acc + e["copies"])

    counted = F.transform(
        lines,
        lambda e: F.struct(
            e["item_name"].alias("item_name"),
            e["item_rank"].alias("item_rank"),
            e["options"].alias("options"),
            (e["copies"] * named(e["item_name"])).alias("weight"),
        ),
    )
    slim = _slim_lines(orders, ["order_id"], ["item_name", "item_rank", "copies", "options"])
    rows = slim.select("order_id", F.inline(counted)).where(F.col("item_name").isNotNull())
    options = rows.withColumn("option", F.explode("options"))
    return options.select(
        "order_id",
        "item_name",
        F.concat_ws("-", F.col("order_id"), F.col("item_rank")).alias("order_item_ranking"),
        *_option_columns(),
        "weight",
    )


def item_options_v1(orders: DataFrame) -> DataFrame:
    """The older option table row for row, repeats included."""
    weighted = weighted_options_v1(orders)
    return weighted.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("weight")))).select(
        "order_id",
        "item_name",
        "order_item_ranking",
        "option_name",
        "option_value",
        dollars("option_price_cents").alias("option_price"),
    )
