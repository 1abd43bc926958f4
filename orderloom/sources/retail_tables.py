"""Raw orders from a star of order, line and part tables.

The given tables hold lines as rows.  This builds the documents the shop would have
written: one JSON cart per order.  A cart is one text cell in the source model, so the
lines of one order are one row by definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.calendar import clock_text
from orderloom.functions.categories import by_last_word

# Words the part names of the given tables are made of.
ADJECTIVES = ["blue", "cold", "hot", "large", "new", "old", "red", "small"]
NOUNS = ["anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget"]
ITEM_NAMES = [f"{adjective} {noun}" for adjective in ADJECTIVES for noun in NOUNS]
CATEGORY_WORDS = {
    "Food": ["plate", "ring"],
    "Hot Drinks": ["widget", "gizmo"],
    "Cold Drinks": ["rod", "bolt"],
}
category_of = by_last_word(CATEGORY_WORDS)

YEARS_FORWARD = 24  # source orders end in 2001

# Of so many orders one each has a document that is cut off (remainder 3), none (4), and an
# object where a number should be (6).
ODD_EVERY = 500


def _cents(amount: str) -> Column:
    return F.round(F.col(amount) * 100).cast("long")


def _text(value: Column) -> Column:
    return value.cast("string")


def _cart_line() -> Column:
    """JSON text of one cart line: quantity is absent on line 7 and no number on line 6."""
    quantity = (
        F.when(F.col("number") == 7, F.lit(""))
        .when(F.col("number") == 6, F.lit(',"quantity":"x"'))
        .otherwise(F.concat(F.lit(',"quantity":"'), _text(F.col("quantity")), F.lit('"')))
    )
    return F.concat(
        F.lit('{"name":"'),
        F.col("name"),
        F.lit('","price":'),
        _text(F.col("cents")),
        quantity,
        F.lit(',"options":[{"name":"size","value":"'),
        _text(F.col("size")),
        F.lit('","price":'),
        _text(F.col("retail")),
        F.lit('},{"name":"flag","value":"'),
        F.col("flag"),
        F.lit('","price":0}]}'),
    )


def _request(key: Column) -> Column:
    """Five shapes of requested time, one of them absent."""
    clock = F.concat(_text(key % 12 + 1), F.lit(":"), F.lpad(_text(key % 60), 2, "0"))
    value = (
        F.when(key % 5 == 1, F.lit("ASAP"))
        .when(key % 5 == 2, F.concat(F.lit("Today "), clock, F.lit("PM")))
        .when(key % 5 == 3, F.concat(F.lit("Tomorrow "), clock))
        .when(key % 5 == 4, F.concat(F.lit("Today "), clock, F.lit(" PM")))
    )
    return F.coalesce(F.concat(F.lit(',"order_time_verbose":"'), value, F.lit('"')), F.lit(""))


def raw_orders(spark: SparkSession, root: str) -> DataFrame:
    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")

    parts = read("part").select(
        "p_partkey", F.col("p_name").alias("name"), F.col("p_size").alias("size"), _cents("p_retailprice").alias("retail")
    )
    lines = (
        read("lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "inner")
        .select(
            "l_orderkey",
            F.col("l_linenumber").alias("number"),
            F.col("l_quantity").cast("long").alias("quantity"),
            _cents("l_extendedprice").alias("cents"),
            F.col("l_returnflag").alias("flag"),
            "name",
            "size",
            "retail",
        )
    )
    # numbers move to their order; the text of a line, several times as long, is made there
    # a first line of every tenth order is entered twice, so equal lines occur
    twice = (F.col("l_orderkey") % 10 == 0) & (F.col("number") == 1)
    carts = (
        lines.repartition("l_orderkey")
        .select(
            "l_orderkey",
            F.explode(F.array_repeat(_cart_line(), F.when(twice, 2).otherwise(1))).alias("line"),
        )
        .groupBy("l_orderkey")
        .agg(F.array_sort(F.collect_list("line")).alias("cart"))
    )
    orders = read("orders")
    key = F.col("o_orderkey")
    odd = key % ODD_EVERY
    size = F.coalesce(F.size("cart"), F.lit(0))
    size = F.when(F.col("cart").isNull(), 0).otherwise(size)
    total = _cents("o_totalprice")
    minutes = F.make_dt_interval(mins=(420 + key * 37 % 600).cast("int"))
    created = F.col("o_orderdate") + F.make_ym_interval(F.lit(YEARS_FORWARD)) + minutes
    pending = F.col("o_orderstatus") == "P"
    status = (
        F.when(F.col("o_orderstatus") == "F", 2)
        .when(F.col("o_orderstatus") == "O", 1)
        .when(key % 3 == 0, 0)
        .when(key % 3 == 1, 9)
        .otherwise(10)
    )
    document = F.concat(
        F.lit('{"cart_size":'),
        _text(size),
        F.lit(',"cart_surcharge":'),
        _text(F.when(key % 4 == 0, F.floor(total / 100)).otherwise(F.lit(0))),
        F.lit(',"cart_total_price":'),
        F.when(odd == 6, F.concat(F.lit('{"cents":'), _text(total), F.lit("}"))).otherwise(_text(total)),
        F.lit(',"cart_gst":'),
        _text(F.floor(total / 11)),
        F.lit(',"order_time":"'),
        clock_text(created),
        F.lit('"'),
        _request(key),
        F.lit(',"cart":['),
        F.coalesce(F.array_join("cart", ","), F.lit("")),
        F.lit("]}"),
    )
    written = orders.join(carts, key == F.col("l_orderkey"), "left").select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.md5(_text(F.col("o_custkey"))).alias("ip_addr"),
        created.alias("date_created"),
        F.when(~pending, created + F.expr("INTERVAL 5 MINUTES")).alias("date_paid"),
        total.alias("total"),
        status.alias("status"),
        document.alias("items"),
    )
    # some documents are cut off, some missing; a step of its own, so the text is made once
    odd, items = F.col("order_id") % ODD_EVERY, F.col("items")
    cut = F.when(odd == 3, F.substr(items, F.lit(1), F.length(items) - 10)).when(odd != 4, items)
    return written.withColumn("items", cut)
