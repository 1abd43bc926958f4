"""Revenue, products, portfolio and business questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.functions.ordertime import requested_time, requested_time_full
from orderloom.plans import marts, products, questions, revenue, star
from orderloom.sources.retail_tables import ITEM_NAMES
from orderloom.workload.base_sql import half_up, sql
from orderloom.workload.registry import query


@query(
    "revenue_by_month",
    sql("SELECT date_trunc('month', date_paid)::DATE AS month, sum(total_cents)::BIGINT AS total, strftime(date_trunc('month', date_paid), '%y-%m') AS month_str FROM ro WHERE date_paid IS NOT NULL GROUP BY 1, 3"),
)
def _(s):
    return revenue.revenue_by_month(s.orders)


@query(
    "revenue_by_hour",
    sql("SELECT strftime(date_created, '%H') AS time, sum(total_cents)::BIGINT / 100.0 AS total FROM ro WHERE status = 2 GROUP BY 1"),
)
def _(s):
    return revenue.revenue_by_hour(s.orders)


@query(
    "revenue_by_hour_year",
    sql("SELECT CAST(year(date_created) AS INTEGER) AS year, strftime(date_created, '%H') AS time, sum(total_cents)::BIGINT / 100.0 AS total FROM ro WHERE status = 2 GROUP BY 1, 2"),
)
def _(s):
    return revenue.revenue_by_hour_year(s.orders)


@query(
    "revenue_by_hour_weekday",
    sql("SELECT strftime(date_created, '%A') AS day_of_week, strftime(date_created, '%H') AS time, sum(total_cents)::BIGINT / 100.0 AS total FROM ro WHERE status = 2 GROUP BY 1, 2"),
)
def _(s):
    return revenue.revenue_by_hour_weekday(s.orders)


_WEEKDAY = "SELECT strftime(date_paid, '%A') AS weekday, sum(total_cents)::BIGINT AS total FROM ro WHERE date_paid IS NOT NULL GROUP BY 1"


@query("revenue_by_weekday", sql(_WEEKDAY))
def _(s):
    return revenue.revenue_by_weekday(s.orders)


@query("best_weekday", sql(f"{_WEEKDAY} ORDER BY 2 DESC, 1 LIMIT 1"))
def _(s):
    return revenue.best_weekday(s.orders)


@query(
    "peak_hour",
    sql("SELECT CAST(hour(date_paid) AS INTEGER) AS hour, sum(total_cents)::BIGINT AS total FROM ro WHERE date_paid IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"),
)
def _(s):
    return revenue.peak_hour(s.orders)


@query("aov", sql("SELECT round(avg(total_cents), 6) AS avg_order_value FROM ro"))
def _(s):
    return revenue.average_order_value(s.orders)


@query(
    "revenue_per_customer",
    sql("SELECT round(avg(t), 6) AS avg_revenue_per_customer FROM (SELECT sum(total_cents)::BIGINT AS t FROM ro GROUP BY customer_id)"),
)
def _(s):
    return revenue.revenue_per_customer(s.orders)


_DAYS = "unnest(generate_series((SELECT min(date_created)::DATE FROM ro)::TIMESTAMP, (SELECT max(date_created)::DATE FROM ro)::TIMESTAMP, INTERVAL 1 DAY))::DATE"


@query(
    "daily_order_counts",
    sql(f"""SELECT d AS date_created, COALESCE(n, 0) AS order_count FROM (SELECT {_DAYS} AS d)
 LEFT JOIN (SELECT date_created::DATE AS d, count(*) AS n FROM ro GROUP BY 1) USING (d)"""),
)
def _(s):
    return revenue.daily_order_counts(s.orders)


_HOURS_DIM = "(SELECT actual_date, min(open_time) AS open_time, max(close_time) AS close_time, max(special_note) AS special_note FROM oh WHERE actual_date IS NOT NULL GROUP BY 1)"


@query(
    "daily_sales_with_hours",
    sql(f"""SELECT date_created, total_daily_sales, actual_date, open_time, close_time, special_note FROM
 (SELECT date_created::DATE AS date_created, sum(sales_cents)::BIGINT / 100.0 AS total_daily_sales FROM ps GROUP BY 1) d
 LEFT JOIN {_HOURS_DIM} h ON d.date_created = h.actual_date"""),
)
def _(s):
    return revenue.daily_sales_with_hours(s.orders, s.hours)


@query(
    "revenue_anomalies",
    sql(f"""SELECT day, revenue_cents, round(m, 3) AS mean_before, round(sd, 3) AS std_before, CASE WHEN revenue_cents < m - 2.0*sd THEN 'drop' ELSE 'spike' END AS kind FROM
 (SELECT day, revenue_cents, avg(revenue_cents) OVER w AS m, stddev_samp(revenue_cents) OVER w AS sd, count(*) OVER w AS n FROM
   (SELECT d AS day, COALESCE(c, 0)::BIGINT AS revenue_cents FROM (SELECT {_DAYS} AS d) LEFT JOIN (SELECT date_created::DATE AS d, sum(total_cents)::BIGINT AS c FROM ro GROUP BY 1) USING (d))
  WINDOW w AS (ORDER BY day ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))
 WHERE n = 28 AND (revenue_cents < m - 2.0*sd OR revenue_cents > m + 2.0*sd)"""),
    digits=3,
)
def _(s):
    return revenue.revenue_anomalies(s.orders)


@query("top_items", sql("SELECT item_name, count(*) AS sales FROM el GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"))
def _(s):
    return products.top_items(s.orders)


@query("items_per_order", sql("SELECT round(avg(cart_size), 6) AS avg_items_per_order FROM os"))
def _(s):
    return products.items_per_order(s.orders)


@query(
    "price_per_item",
    sql("SELECT round(avg(total_cents::DOUBLE / cart_size), 6) AS avg_price_per_item FROM os WHERE cart_size > 0"),
)
def _(s):
    return products.price_per_item(s.orders)


@query(
    "price_vs_count",
    sql("SELECT item_name AS item, sum(price_cents)::BIGINT AS total_price, count(*) AS count, round(sum(price_cents)::DOUBLE / count(*), 6) AS avg_price FROM el GROUP BY 1"),
)
def _(s):
    return products.price_vs_count(s.orders)


@query(
    "monthly_item_sales",
    sql("SELECT item_name, date_trunc('month', date_created)::DATE AS month_year, sum(sales_cents)::BIGINT / 100.0 AS total_sales, sum(quantity_sold)::BIGINT AS units_sold FROM ps GROUP BY 1, 2"),
)
def _(s):
    return products.monthly_item_sales(s.orders)


@query(
    "monthly_pivot",
    sql(
        "SELECT date_trunc('month', date_created)::DATE AS month_year, "
        + ", ".join(
            f"""COALESCE(sum(quantity_sold) FILTER (WHERE item_name = '{name}'), 0)::BIGINT AS "{name}\""""
            for name in ITEM_NAMES[:-3]
        )
        + """, COALESCE(sum(quantity_sold) FILTER (WHERE item_name IS NULL OR item_name NOT IN ("""
        + ", ".join(f"'{name}'" for name in ITEM_NAMES[:-3])
        + """)), 0)::BIGINT AS "other items" FROM ps GROUP BY 1"""
    ),
)
def _(s):
    return products.monthly_pivot(s.orders, ITEM_NAMES[:-3])


@query(
    "menu_categories",
    sql(
        """SELECT CASE WHEN length(item_name) % 4 = 0 THEN 'Kitchen' ELSE 'Length ' || length(item_name) END AS item_category,
 count(DISTINCT item_name) AS items, sum(quantity_sold)::BIGINT AS units FROM ps GROUP BY 1"""
    ),
)
def _(s):
    from pyspark.sql import functions as F

    from orderloom.functions.categories import with_menu

    sales = products.line_sales(s.orders, "line")
    # a menu of the names that occur, each twice, without those of some lengths
    names = sales.select("item_name").distinct().where(F.length("item_name") % 4 != 0)
    entries = [
        F.struct(F.lit(2).alias("position"), F.lit("A second entry").alias("item_category")),
        F.struct(
            F.lit(1).alias("position"),
            F.concat(F.lit("Length "), F.length("item_name").cast("string")).alias("item_category"),
        ),
    ]
    menu = names.select("item_name", F.inline(F.array(*entries)))
    return (
        with_menu(sales, menu)
        .groupBy("item_category")
        .agg(
            F.count_distinct("item_name").alias("items"), F.sum("quantity_sold").alias("units")
        )
    )


@query(
    "yearly_item_sales",
    sql("SELECT item_name, CAST(year(date_created) AS INTEGER) AS year, CAST(month(date_created) AS INTEGER) AS month, sum(sales_cents)::BIGINT / 100.0 AS total_sales FROM ps GROUP BY 1, 2, 3"),
)
def _(s):
    return products.yearly_item_sales(s.orders)


_PORTFOLIO = {
    "qs": "SELECT item_name, strftime(date_created, '%Y') || '-Q' || quarter(date_created) AS quarter, sum(sales_cents)::BIGINT AS c FROM ps GROUP BY 1, 2",
    "qm": "SELECT quarter, sum(c)::BIGINT AS mc FROM qs GROUP BY 1",
    "lq": "SELECT max(quarter) AS l, (SELECT max(quarter) FROM qm WHERE quarter < (SELECT max(quarter) FROM qm)) AS p FROM qm",
    "gr": """SELECT item_name, CASE WHEN b > 0 THEN (n - b)::DOUBLE / b ELSE 0.0 END AS growth_rate FROM
 (SELECT item_name, COALESCE(sum(c) FILTER (WHERE quarter = l), 0)::BIGINT AS n, COALESCE(sum(c) FILTER (WHERE quarter = p), 0)::BIGINT AS b FROM qs, lq GROUP BY 1)""",
    "pr": "SELECT qs.item_name, qs.quarter, c / 100.0 AS total_sales, mc / 100.0 AS market_total_sales, c::DOUBLE / mc AS share, growth_rate FROM qs JOIN qm USING (quarter) JOIN gr USING (item_name)",
    "md": "SELECT quantile_cont(share, 0.5) AS ms, quantile_cont(growth_rate, 0.5) AS mg FROM pr",
    "pm": """SELECT item_name, quarter, total_sales, market_total_sales, round(share, 6) AS relative_market_share, round(growth_rate, 6) AS growth_rate,
 CASE WHEN share >= ms AND growth_rate >= mg THEN 'Star' WHEN share < ms AND growth_rate >= mg THEN 'Question Mark'
  WHEN share >= ms THEN 'Cash Cow' ELSE 'Dog' END AS category FROM pr, md""",
}


@query("portfolio_matrix", sql("SELECT * FROM pm", **_PORTFOLIO))
def _(s):
    return products.portfolio_matrix(s.orders)


def _top(n: int, where: str = "") -> str:
    return sql(
        f"SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY quarter, category ORDER BY total_sales DESC, item_name) AS INTEGER) AS place FROM pm {where}) WHERE place <= {n}",
        **_PORTFOLIO,
    )


@query("portfolio_top_5", _top(5))
def _(s):
    return products.portfolio_top_n(products.portfolio_matrix(s.orders), 5)


_QUARTERS = ["2022-Q2", "2022-Q3", "2022-Q4", "2023-Q1", "2023-Q2", "2023-Q3", "2023-Q4", "2024-Q1"]


@query("portfolio_top_1", _top(1, f"WHERE quarter IN ({', '.join(repr(q) for q in _QUARTERS)})"))
def _(s):
    return products.portfolio_top_n(products.portfolio_matrix(s.orders), 1, _QUARTERS)


@query(
    "orders_with_dims",
    sql(f"""SELECT os.order_id, os.customer_id, os.date_created, os.status, total_cents / 100.0 AS total, total_orders, avg_order_value, p.status_description,
 date_created::DATE AS date_key, CAST(quarter(date_created) AS INTEGER) AS quarter FROM os LEFT JOIN
 (SELECT customer_id, count(*) AS total_orders, {half_up('sum(total_cents)::BIGINT', 'count(*)')} AS avg_order_value FROM os WHERE cart_size > 0 GROUP BY 1) USING (customer_id)
 LEFT JOIN (SELECT DISTINCT status, CASE status WHEN 2 THEN 'Payment is successful' WHEN 1 THEN 'Payment is successful, label not printed'
 WHEN 9 THEN 'Payment is unsuccessful' WHEN 0 THEN 'Order created but no payment made' ELSE 'Unknown (2019-2020)' END AS status_description FROM ro) p ON os.status = p.status"""),
)
def _(s):
    customers = star.dim_customers(s.orders, "2025-08-01")
    return products.orders_with_dims(s.orders, customers, star.payment_status_v1(s.orders))


@query(
    "sales_with_dims",
    sql("""SELECT order_id, customer_id, ps.item_name, item_category, date_created::DATE AS date_key, CAST(day(date_created) AS INTEGER) AS day, CAST(month(date_created) AS INTEGER) AS month,
 CAST(year(date_created) AS INTEGER) AS year, strftime(date_created, '%A') AS day_of_week, strftime(date_created, '%B') AS month_name, CAST(dayofweek(date_created) + 1 AS INTEGER) AS weekday_index,
 CAST(strftime(date_created, '%U') AS INTEGER) AS week_of_year, CAST(quarter(date_created) AS INTEGER) AS quarter, quantity_sold, sales_cents / 100.0 AS total_sales, average_price
 FROM ps JOIN (SELECT item_name, round(sum(price_cents)::DOUBLE / count(*) / 100, 6) AS average_price FROM el GROUP BY 1) USING (item_name)"""),
)
def _(s):
    return products.sales_with_dims(s.orders)


@query(
    "dropped_orders",
    sql("SELECT count(*) AS orders, count(*) FILTER (WHERE cart_size IS NULL) AS unreadable, count(*) FILTER (WHERE cart_size = 0) AS empty, count(*) FILTER (WHERE cart_size > 0) AS with_lines FROM os"),
)
def _(s):
    return products.dropped_orders(s.orders)


_CLOCK = "lpad(CAST({h} AS VARCHAR), 2, '0') || ':' || lpad(CAST(order_id % 60 AS VARCHAR), 2, '0')"
_AM = _CLOCK.format(h="(order_id % 12 + 1) % 12")
_PM = _CLOCK.format(h="(order_id % 12 + 1) % 12 + 12")


@query(
    "order_time_normalised",
    sql(f"""SELECT order_id, CASE CASE WHEN order_id % 500 IN (3, 4) THEN 0 ELSE order_id % 5 END WHEN 0 THEN order_time WHEN 1 THEN order_time WHEN 2 THEN {_PM} WHEN 3 THEN {_AM} END AS requested_time,
 CASE CASE WHEN order_id % 500 IN (3, 4) THEN 0 ELSE order_id % 5 END WHEN 0 THEN order_time WHEN 1 THEN order_time WHEN 3 THEN {_AM} ELSE {_PM} END AS requested_time_full FROM rw"""),
)
def _(s):
    verbose, created = F.col("order_time_verbose"), F.col("date_created")
    return s.orders.select(
        "order_id",
        requested_time(verbose, created).alias("requested_time"),
        requested_time_full(verbose, created).alias("requested_time_full"),
    )


@query(
    "new_item_prices",
    sql("""SELECT date_created < first_sold + INTERVAL 90 DAY AS is_new, round(sum(sales_cents)::DOUBLE / (sum(quantity_sold) * 100), 6) AS avg_unit_price, count(*) AS sales
 FROM ps JOIN (SELECT item_name, min(date_created) AS first_sold FROM ps GROUP BY 1) USING (item_name) GROUP BY 1"""),
)
def _(s):
    return questions.new_item_prices(s.orders)


@query(
    "new_customers_by_month",
    sql("SELECT date_trunc('month', f)::DATE AS month, count(*) AS new_customers FROM (SELECT min(date_created) AS f FROM ro GROUP BY customer_id) GROUP BY 1"),
)
def _(s):
    return questions.new_customers_by_month(s.orders)


@query(
    "cohort_retention",
    sql("""SELECT cohort, month_offset, customers, round(customers::DOUBLE / max(customers) FILTER (WHERE month_offset = 0) OVER (PARTITION BY cohort), 6) AS retention_rate FROM
 (SELECT cohort, CAST(date_diff('month', cohort, month) AS INTEGER) AS month_offset, count(*) AS customers FROM
  (SELECT customer_id, month, min(month) OVER (PARTITION BY customer_id) AS cohort FROM (SELECT DISTINCT customer_id, date_trunc('month', date_created)::DATE AS month FROM ro)) GROUP BY 1, 2)"""),
)
def _(s):
    return questions.cohort_retention(s.orders)


_KIND = "CASE WHEN row_number() OVER (PARTITION BY customer_id ORDER BY order_time, order_id) = 1 THEN 'new' ELSE 'returning' END"


@query(
    "time_between_orders",
    sql(f"""SELECT COALESCE(kind, 'all') AS kind, count(*) AS intervals, round(sum(interval_days)::DOUBLE / count(*), 6) AS avg_days_between
 FROM (SELECT interval_days, {_KIND} AS kind FROM gp) WHERE interval_days IS NOT NULL GROUP BY GROUPING SETS ((kind), ())"""),
)
def _(s):
    return questions.time_between_orders(marts.order_gaps(marts.paid_orders(s.orders)))


@query(
    "orders_per_customer",
    sql("SELECT round(avg(n), 6) AS avg_orders_per_customer, count(*) AS customers FROM (SELECT count(*) AS n FROM ro GROUP BY customer_id)"),
)
def _(s):
    return questions.orders_per_customer(s.orders)


@query(
    "aov_new_vs_returning",
    sql(f"SELECT kind, round(avg(order_cents) / 100, 6) AS avg_order_value, count(order_cents) AS orders FROM (SELECT order_cents, {_KIND} AS kind FROM po) GROUP BY 1"),
)
def _(s):
    return questions.aov_new_vs_returning(marts.paid_orders(s.orders))


@query(
    "revenue_per_open_hour",
    sql(f"""SELECT hour, COALESCE(sum(cents), 0)::BIGINT / 100.0 AS revenue, count(*) AS open_days, round(COALESCE(sum(cents), 0)::BIGINT / 100.0 / count(*), 6) AS revenue_per_open_hour FROM
 (SELECT day, CAST(unnest(range(a // 100, (b + 99) // 100)) AS INTEGER) AS hour FROM
   (SELECT d AS day, CASE WHEN special_note IS NOT NULL AND open_time IS NULL THEN NULL ELSE COALESCE(open_time, CASE WHEN isodow(d) <= 5 THEN 600 ELSE 700 END) END AS a,
     CASE WHEN special_note IS NOT NULL AND open_time IS NULL THEN NULL ELSE COALESCE(close_time, 1600) END AS b
    FROM (SELECT {_DAYS} AS d) LEFT JOIN {_HOURS_DIM} h ON d = h.actual_date) WHERE a IS NOT NULL)
 LEFT JOIN (SELECT date_created::DATE AS day, CAST(hour(date_created) AS INTEGER) AS hour, sum(total_cents)::BIGINT AS cents FROM ro GROUP BY 1, 2) USING (day, hour) GROUP BY 1"""),
)
def _(s):
    return questions.revenue_per_open_hour(s.orders, s.hours)


@query(
    "price_elasticity",
    sql("""SELECT item_name, round(regr_slope(ln(u), ln(c / 100.0 / u)), 6) AS elasticity, count(*) AS months FROM
 (SELECT item_name, date_trunc('month', date_created) AS m, sum(sales_cents)::BIGINT AS c, sum(quantity_sold)::BIGINT AS u FROM ps GROUP BY 1, 2) GROUP BY 1"""),
)
def _(s):
    return questions.price_elasticity(s.orders)
