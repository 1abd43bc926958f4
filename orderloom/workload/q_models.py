"""Clusters, churn models, campaigns, forecasts, checks, profiles, metrics, events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators import ordering, profile, quality, sampling
from orderloom.plans import cart, churn, forecast, marts, metrics, rfm, segmentation, star
from orderloom.scratch import stage
from orderloom.streaming import kpi
from orderloom.workload import q_star  # noqa: F401  its twins are the tables checked here
from orderloom.workload.base_sql import sql
from orderloom.workload.registry import ORACLES, query

AS_OF = "2025-08-01"


def _once(s, name, make):
    """A value several queries of one application share."""
    if not hasattr(s, name):
        setattr(s, name, make())
    return getattr(s, name)


def _scaled(s):
    base = rfm.rfm_orders(s.orders)
    return _once(
        s,
        "scaled",
        lambda: stage(segmentation.scale(segmentation.transformed(base)), "scaled"),
    )


def _clustered(s):
    return _once(
        s,
        "clustered",
        lambda: stage(segmentation.assign_clusters(_scaled(s)), "clustered"),
    )


@query("kmeans_profile")
def _(s):
    return segmentation.cluster_profile(_clustered(s))


@query("cluster_attribute_means")
def _(s):
    return segmentation.attribute_means(_clustered(s))


@query("cluster_tier_shares")
def _(s):
    tiers = rfm.rfm_quartile_score(rfm.rfm_orders(s.orders)).select("customer_id", "score")
    return rfm.shares_within(
        _clustered(s).select("customer_id", "cluster").join(tiers, "customer_id"), "cluster", "score"
    )


@query("elbow_scan")
def _(s):
    return segmentation.elbow_scan(_scaled(s))


_WINDOWS = """SELECT * FROM (VALUES ('p1', 0, 1), ('p2', 1, 2), ('p3', 2, 9), ('p4', 0, 2), ('p5', 1, 9), ('p6', 0, 3), ('p7', 4, 9), ('p8', 3, 4), ('test', 0, 9)) AS t(period, a, b)"""
FEATURES = {
    "sn": "SELECT min(date_created) AS f, max(date_created) AS l FROM ro",
    "mk": """SELECT 0 AS k, f AS t FROM sn UNION ALL SELECT 1, TIMESTAMP '2020-12-31' UNION ALL SELECT 2, TIMESTAMP '2021-12-31' UNION ALL SELECT 3, f + INTERVAL 365 DAY FROM sn
 UNION ALL SELECT 4, l - INTERVAL 365 DAY FROM sn UNION ALL SELECT 9, l FROM sn""",
    "wn": f"SELECT period, x.t AS lo, y.t AS hi FROM ({_WINDOWS}) w JOIN mk x ON w.a = x.k JOIN mk y ON w.b = y.k",
    "cf0": """SELECT period, customer_id, max(date_created) FILTER (WHERE date_created <= hi - INTERVAL 60 DAY) AS latest, count(*) FILTER (WHERE date_created <= hi - INTERVAL 60 DAY) AS frequency,
 sum(total_cents) FILTER (WHERE date_created <= hi - INTERVAL 60 DAY)::BIGINT AS monetary, count(*) FILTER (WHERE date_created >= hi - INTERVAL 60 DAY) AS seen
 FROM ro JOIN wn ON date_created BETWEEN lo AND hi GROUP BY 1, 2""",
    "cf": """SELECT period, customer_id, date_sub('day', latest, max(latest) OVER (PARTITION BY period)) AS recency, frequency, monetary, CAST(CASE WHEN seen > 0 THEN 0 ELSE 1 END AS INTEGER) AS churn
 FROM cf0 WHERE frequency > 0""",
}


def _features(s):
    return _once(s, "features", lambda: stage(churn.churn_features(s.order_heads), "churn"))


@query("churn_features", sql("SELECT * FROM cf", **FEATURES))
def _(s):
    return churn.churn_features(s.order_heads)


def _hash(key: str, seed: int = 42) -> str:
    return f"CAST('0x' || substr(md5({key} || '-{seed}'), 1, 8) AS BIGINT)"


@query(
    "churn_training_rows",
    sql(
        f"""SELECT period, customer_id, recency, frequency, monetary, churn, NOT ({_hash("period || '/' || customer_id")} % 100 < 80) AS is_validation,
 CASE WHEN churn = 1 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM cf WHERE recency < 40 AND period <> 'test'""",
        **FEATURES,
    ),
)
def _(s):
    return churn.training_rows(_features(s))


_ROC = "SELECT frequency AS sc, sum(churn)::BIGINT AS p, count(*) - sum(churn)::BIGINT AS q FROM cf WHERE period = 'test' GROUP BY 1"


@query(
    "roc_by_frequency",
    sql(
        """SELECT sc AS threshold, round(sum(q) OVER w / sum(q) OVER (), 6) AS fpr, round(sum(p) OVER w / sum(p) OVER (), 6) AS tpr FROM rc WINDOW w AS (ORDER BY sc DESC ROWS UNBOUNDED PRECEDING)""",
        **FEATURES,
        rc=_ROC,
    ),
)
def _(s):
    rows = _features(s).where("period = 'test'")
    return ordering.roc_points(rows, "frequency", "churn")


@query(
    "auc_by_recency",
    sql(
        """SELECT round(sum(p * (below + q / 2.0)) / (sum(p) * sum(q)), 6) AS roc_auc FROM (SELECT p, q, COALESCE(sum(q) OVER (ORDER BY sc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS below FROM rc)""",
        **FEATURES,
        rc=_ROC.replace("frequency AS sc", "recency AS sc"),
    ),
)
def _(s):
    return churn.roc_auc(_features(s).where("period = 'test'"), "recency")


_RULE = "SELECT churn AS a, CAST(recency > 20 AS INTEGER) AS b, count(*) AS n FROM cf GROUP BY 1, 2"


@query(
    "confusion_by_rule",
    sql("SELECT a AS actual, b AS predicted, n AS count FROM cm", **FEATURES, cm=_RULE),
)
def _(s):
    return churn.confusion(_features(s), F.col("recency") > 20)


@query(
    "report_by_rule",
    sql(
        """SELECT tp, fp, fn, tn, round((tp + tn)::DOUBLE / (tp + fp + fn + tn), 6) AS accuracy, round(tp::DOUBLE / (tp + fp), 6) AS precision, round(tp::DOUBLE / (tp + fn), 6) AS recall,
 round(2.0 * tp / (2 * tp + fp + fn), 6) AS f1 FROM (SELECT sum(n) FILTER (WHERE a = 1 AND b = 1)::BIGINT AS tp, sum(n) FILTER (WHERE a = 0 AND b = 1)::BIGINT AS fp,
  sum(n) FILTER (WHERE a = 1 AND b = 0)::BIGINT AS fn, sum(n) FILTER (WHERE a = 0 AND b = 0)::BIGINT AS tn FROM cm)""",
        **FEATURES,
        cm=_RULE,
    ),
)
def _(s):
    return churn.binary_report(churn.confusion(_features(s), F.col("recency") > 20))


def _boosted(s):
    return _once(s, "boosted", lambda: churn.fit_boosted(churn.training_rows(_features(s))))


def _value_model(s):
    return _once(
        s,
        "value_model",
        lambda: churn.fit_boosted(churn.training_rows(_features(s)), churn.VALUE_MODEL),
    )


def _scores(s):
    return churn.score(_boosted(s), churn.test_rows(_features(s)))


def _value_scores(s):
    return _once(
        s,
        "value_scores",
        lambda: stage(
            churn.score(_value_model(s), churn.test_rows(_features(s))), "scores"
        ),
    )


@query("churn_scores")
def _(s):
    return _scores(s)


@query("churn_model_report")
def _(s):
    scored = _scores(s)
    counts = churn.confusion(scored, F.col("proba") > 0.5)
    return churn.binary_report(counts).crossJoin(F.broadcast(churn.roc_auc(scored)))


@query("churn_class_report")
def _(s):
    return churn.class_report(churn.confusion(_value_scores(s), F.col("proba") >= 0.5))


@query("value_model_report")
def _(s):
    flagged = _value_scores(s).withColumn("flag", (F.col("proba") >= 0.4).cast("double"))
    report = churn.binary_report(churn.confusion(flagged, F.col("flag")))
    return report.crossJoin(F.broadcast(churn.roc_auc(flagged, "flag")))


@query("boosting_lengths")
def _(s):
    """Trees and losses of the boosted models; a single tree would show."""
    held = churn.training_rows(_features(s)).where("is_validation")
    auc = churn.boosting_length(_boosted(s), "auc", churn.AUC_MODEL, held)
    return auc.unionAll(churn.boosting_length(_value_model(s), "value", churn.VALUE_MODEL, held))


@query("churn_roc_points")
def _(s):
    return ordering.roc_points(_scores(s), "proba", "churn")


@query("churn_feature_importance")
def _(s):
    return churn.feature_importance(_boosted(s), s.spark)


def _forest(s):
    return _once(s, "forest", lambda: churn.fit_forest(churn.training_rows(_features(s))))


@query("forest_report")
def _(s):
    scored = churn.score(_forest(s), churn.test_rows(_features(s)))
    counts = churn.confusion(scored, F.col("proba") > 0.5)
    train = churn.training_rows(_features(s)).where(~F.col("is_validation"))
    fitted = churn.confusion(churn.score(_forest(s), train), F.col("proba") > 0.5)
    own = churn.binary_report(fitted).select(F.col("accuracy").alias("train_accuracy"))
    report = churn.binary_report(counts).crossJoin(F.broadcast(churn.roc_auc(scored)))
    return report.crossJoin(F.broadcast(own))


@query("forest_class_report")
def _(s):
    scored = churn.score(_forest(s), churn.test_rows(_features(s)))
    return churn.class_report(churn.confusion(scored, F.col("proba") > 0.5))


@query("churn_probability_histogram")
def _(s):
    return rfm.histogram(_value_scores(s), ["proba"], 30)


# expected losses with a rule in place of the model, so SQL can follow
@query(
    "expected_losses_by_rule",
    sql(
        """SELECT period, customer_id, recency, frequency, monetary, churn, round(proba, 3) AS proba, lt AS lifetime_days_total, total, ly AS lifetime_days_last_year, round(total * proba * 365 / ly, 3) AS expected_value_lost FROM
 (SELECT cf.*, 1.0::DOUBLE / (1 + frequency) AS proba FROM cf WHERE period = 'test' AND recency < 40)
 JOIN (SELECT customer_id, date_sub('day', min(date_created), max(date_created)) + 1 AS lt FROM ro GROUP BY 1) USING (customer_id)
 LEFT JOIN (SELECT customer_id, sum(total_cents)::BIGINT AS total, date_sub('day', min(date_created), max(date_created)) + 1 AS ly FROM ro, sn
  WHERE date_created BETWEEN l - INTERVAL 425 DAY AND l - INTERVAL 60 DAY GROUP BY 1) USING (customer_id)""",
        **FEATURES,
    ),
    digits=3,
)
def _(s):
    rule = churn.test_rows(_features(s)).withColumn("proba", 1.0 / (1 + F.col("frequency")))
    return churn.expected_losses(s.orders, rule)


def _campaign(s):
    def make():
        segments = rfm.rfm_quintile_segments(rfm.rfm_orders(s.orders))
        return stage(
            churn.campaign_list(s.orders, _value_scores(s), segments), "campaign"
        )

    return _once(s, "campaign", make)


@query("campaign_list")
def _(s):
    return _campaign(s)


@query("campaign_sample")
def _(s):
    return churn.campaign_sample(_campaign(s))


@query("campaign_kpis")
def _(s):
    return churn.campaign_kpis(s.orders, _campaign(s), churn.campaign_sample(_campaign(s)))


@query(
    "customer_sample",
    sql(
        f"""SELECT customer_id, recency, frequency, monetary FROM (SELECT rf.*, row_number() OVER (ORDER BY {_hash('CAST(customer_id AS VARCHAR)')}, customer_id) AS rn, count(*) OVER () AS n FROM rf)
 WHERE rn <= round(n * 0.3::DOUBLE)""",
        rf="SELECT customer_id, date_sub('day', max(date_created), (SELECT max(date_created) FROM ro)) AS recency, count(*) AS frequency, sum(total_cents)::BIGINT AS monetary FROM ro GROUP BY 1",
    ),
)
def _(s):
    return sampling.exact_sample(rfm.rfm_orders(s.orders), "customer_id", 0.3)


@query(
    "first_order_features",
    sql("""SELECT customer_id, total_cents / 100.0 AS first_total, COALESCE(cart_size, 0) AS first_cart_size, CAST(hour(date_created) AS INTEGER) AS first_hour, CAST(isodow(date_created) - 1 AS INTEGER) AS first_weekday,
 CAST(CASE WHEN EXISTS (SELECT 1 FROM ro r WHERE r.customer_id = f.customer_id AND r.order_id <> f.order_id AND date_sub('day', f.date_created, r.date_created) <= 60) THEN 1 ELSE 0 END AS INTEGER) AS retained FROM
 (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY date_created, order_id) AS rn FROM os) f WHERE rn = 1 AND date_sub('day', date_created, (SELECT max(date_created) FROM ro)) > 60"""),
)
def _(s):
    return forecast.first_order_features(s.orders)


_CATEGORIES = ["Hot Drinks", "Food", "Cold Drinks", "Kitchen"]


def _checked_tables(s):
    return {
        "raw_orders": s.raw,
        "cart_lines": cart.cart_lines(s.orders),
        "line_options": cart.line_options(s.orders),
        "fct_order_item_options": cart.fct_order_item_options(s.orders),
        "fct_order_details": cart.fct_order_details(s.orders),
        "fct_product_sales": cart.fct_product_sales(s.orders),
        "dim_customers": star.dim_customers(s.orders, AS_OF),
        "dim_products": star.dim_products(s.orders),
        "dim_payment_status": star.dim_payment_status(s.orders),
        "customer_churn_threshold": marts.customer_churn_threshold(s.orders),
        "dim_item_options": star.dim_item_options(s.orders),
        "item_price_history": star.item_price_history(s.orders),
        "dim_time": star.dim_time(s.orders),
    }


_KEYS = {
    "raw_orders": "order_id",
    "cart_lines": "order_item_id",
    "fct_order_item_options": "order_item_option_id",
    "fct_order_details": "order_id",
    "fct_product_sales": "order_item_id",
    "customer_churn_threshold": "customer_id",
    "dim_customers": "customer_id",
    "dim_payment_status": "status",
    "dim_products": "item_name",
    "dim_item_options": "item_option_id",
    "item_price_history": "item_price_id",
    "dim_time": "date_key",
}
_PRESENT = {
    "raw_orders": ["customer_id", "date_created"],
    "cart_lines": ["order_item_ranking"],
    "customer_churn_threshold": ["churn_threshold"],
    "dim_payment_status": ["status_description"],
    "dim_item_options": ["start_date"],
    "item_price_history": ["start_date"],
}
_PARENTS = [
    ("line_options", "order_id", "fct_order_details"),
    ("line_options", "item_name", "dim_products"),
    ("line_options", "order_item_id", "fct_product_sales"),
    ("fct_order_details", "customer_id", "dim_customers"),
    ("fct_order_details", "status", "dim_payment_status"),
    ("fct_product_sales", "item_name", "dim_products"),
    ("fct_product_sales", "order_id", "fct_order_details"),
    ("customer_churn_threshold", "customer_id", "dim_customers"),
    ("dim_item_options", "item_name", "dim_products"),
    ("item_price_history", "item_name", "dim_products"),
]


def _rules():
    rule = quality.Rule
    rules = []
    for table, key in _KEYS.items():
        rules.append(rule("unique", table, (key,)))
        rules += [rule("not_null", table, (c,)) for c in [key, *_PRESENT.get(table, [])]]
    rules += [rule("relationships", t, (c,), parent=p, parent_column=c) for t, c, p in _PARENTS]
    rules += [
        rule("accepted_values", t, ("item_category",), values=tuple(_CATEGORIES))
        for t in ("cart_lines", "dim_products")
    ]
    rules.append(rule("ends_after_start", "dim_item_options", failing="end_date < start_date"))
    return rules


def _check_sql() -> str:
    """The same checks over the twins of the checked tables."""

    def table(name: str) -> str:
        return f"({ORACLES['stg_orders_v1' if name == 'raw_orders' else name]})"

    rows: list[str] = []

    def row(check: str, name: str, column: str, body: str) -> None:
        rows.append(f"SELECT '{check}' AS \"check\", '{name}' AS \"table\", '{column}' AS \"column\", {body}")

    def unique(name: str, key: str) -> None:
        repeated = f"SELECT {key} AS k FROM {table(name)} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
        row("unique", name, key, f"count(*) AS failing_rows, CAST(min(k) AS VARCHAR) AS sample FROM ({repeated})")

    def not_null(name: str, *keys: str) -> None:
        for key in keys:
            row("not_null", name, key, f"count(*) FILTER (WHERE {key} IS NULL), NULL FROM {table(name)}")

    def related(name: str, key: str, parent: str) -> None:
        orphans = f"SELECT c.{key} AS k FROM {table(name)} c WHERE c.{key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {table(parent)} p WHERE p.{key} = c.{key})"
        row("relationships", name, key, f"count(*), CAST(min(k) AS VARCHAR) FROM ({orphans})")

    def accepted(name: str, key: str) -> None:
        wrong = f"SELECT {key} AS k FROM {table(name)} WHERE {key} NOT IN ({', '.join(repr(c) for c in _CATEGORIES)})"
        row("accepted_values", name, key, f"count(*), min(k) FROM ({wrong})")

    for name, key in _KEYS.items():
        unique(name, key)
        not_null(name, key, *_PRESENT.get(name, []))
    accepted("cart_lines", "item_category")
    accepted("dim_products", "item_category")
    for name, key, parent in _PARENTS:
        related(name, key, parent)
    row("ends_after_start", "dim_item_options", "", f"count(*), NULL FROM {table('dim_item_options')} WHERE end_date < start_date")
    return "\nUNION ALL ".join(rows)


@query("dq_report", _check_sql())
def _(s):
    return quality.run_checks(_checked_tables(s), _rules())


@query(
    "dq_on_tables",
    sql("""SELECT 'unique' AS "check", 'lineitem' AS "table", 'l_orderkey, l_linenumber' AS "column", count(*) AS failing_rows, min(k) AS sample FROM
 (SELECT l_orderkey || ', ' || l_linenumber AS k FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
 UNION ALL SELECT 'not_null', 'events', 'value', count(*) FILTER (WHERE value IS NULL), min(CAST(event_id AS VARCHAR)) FILTER (WHERE value IS NULL) FROM events
 UNION ALL SELECT 'not_null', 'events', 'user_id', count(*) FILTER (WHERE user_id IS NULL), min(CAST(event_id AS VARCHAR)) FILTER (WHERE user_id IS NULL) FROM events
 UNION ALL SELECT 'accepted_values', 'orders', 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')), min(o_orderstatus) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) FROM orders
 UNION ALL SELECT 'relationships', 'events', 'user_id', count(*), CAST(min(user_id) AS VARCHAR) FROM events WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT c_nationkey FROM customer WHERE c_nationkey IS NOT NULL)
 UNION ALL SELECT 'positive_quantity', 'lineitem', '', count(*), NULL FROM lineitem WHERE l_quantity <= 0"""),
)
def _(s):
    rule = quality.Rule
    tables = {n: s.table(n) for n in ("lineitem", "events", "orders", "customer")}
    return quality.run_checks(
        tables,
        [
            rule("unique", "lineitem", ("l_orderkey", "l_linenumber")),
            rule("not_null", "events", ("value",), key="event_id"),
            rule("not_null", "events", ("user_id",), key="event_id"),
            rule("accepted_values", "orders", ("o_orderstatus",), values=("F", "O")),
            rule("relationships", "events", ("user_id",), parent="customer", parent_column="c_nationkey"),
            rule("positive_quantity", "lineitem", failing="l_quantity <= 0"),
        ],
    )


_PROFILED = [("o_orderkey", "bigint", 1), ("o_custkey", "bigint", 1), ("o_orderstatus", "string", 0), ("o_orderpriority", "string", 0)]


@query(
    "table_profile",
    sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", '{t}' AS type, count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values,
 CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, {f'round(avg({c}), 6)' if n else 'NULL::DOUBLE'} AS mean FROM orders"""
            for c, t, n in _PROFILED
        )
    ),
)
def _(s):
    return profile.profile(s.table("orders").select(*[c for c, _, _ in _PROFILED]), exact=True)


# columns of every given table
_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount "
    "l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}


@query(
    "profile_all_tables",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls,
 count(DISTINCT {c}) AS distinct_values FROM {t}"""
        for t, columns in _COLUMNS.items()
        for c in columns.split()
    ),
)
def _(s):
    parts = []
    for name in _COLUMNS:
        found = profile.profile(s.table(name), exact=True).withColumn("table", F.lit(name))
        parts.append(found.select("table", "column", "rows", "nulls", "distinct_values"))
    return reduce(DataFrame.unionAll, parts)


@query("table_profile_estimated")
def _(s):
    return profile.profile(s.orders.drop("lines"))


@query("table_quartiles_estimated")
def _(s):
    return profile.quantiles(s.orders, ["total_cents", "cart_size", "gst_cents"])


@query(
    "top_item_names",
    sql("SELECT 'item_name' AS \"column\", item_name AS value, count(*) AS count FROM ln GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10"),
)
def _(s):
    return profile.top_values(cart.cart_lines(s.orders), "item_name")


@query(
    "metric_items_by_category_status",
    sql("SELECT item_category, status, sum(quantity)::BIGINT AS item_quantity, sum(price_cents)::BIGINT / 100.0 AS item_price FROM el JOIN os USING (order_id) GROUP BY 1, 2"),
    digits=2,
)
def _(s):
    tables = metrics.report_tables(s.orders, AS_OF)
    return metrics.metric(
        tables, "items", ["item_quantity", "item_price"], ["items.item_category", "orders.status"]
    )


_PEOPLE = "(SELECT customer_id, count(*) AS total_orders FROM os WHERE cart_size > 0 GROUP BY 1)"


@query(
    "metric_orders_by_customer_orders",
    sql(f"""SELECT total_orders, round(sum(total_cents) / 100.0, 2) AS total, sum(cart_size)::BIGINT AS cart_size FROM os
 LEFT JOIN {_PEOPLE} USING (customer_id) GROUP BY 1"""),
    digits=2,
)
def _(s):
    tables = metrics.report_tables(s.orders, AS_OF)
    return metrics.metric(tables, "orders", ["total", "cart_size"], ["customers.total_orders"])


@query(
    "metric_customers_by_status",
    sql(f"""SELECT status, sum(total_orders)::BIGINT AS total_orders FROM {_PEOPLE} c
 LEFT JOIN (SELECT DISTINCT customer_id, status FROM os) USING (customer_id) GROUP BY 1"""),
)
def _(s):
    """Many to many: a customer with orders of two statuses counts once under each."""
    tables = metrics.report_tables(s.orders, AS_OF)
    return metrics.metric(tables, "customers", ["total_orders"], ["orders.status"])


_OPTION_ROWS = f"({ORACLES['item_options_v1']})"


@query(
    "metric_options_by_status",
    f"""SELECT status, round(sum(option_price), 2) AS option_price FROM {_OPTION_ROWS} o
 JOIN (SELECT order_id, status FROM ({ORACLES["stg_orders_v1"]})) s USING (order_id) GROUP BY 1""",
    digits=2,
)
def _(s):
    tables = metrics.report_tables(s.orders, AS_OF)
    return metrics.metric(tables, "options", ["option_price"], ["orders.status"])


@query(
    "metric_option_counts_by_category",
    f"""SELECT item_category, sum(n)::BIGINT AS "count" FROM (SELECT item_name, "count" AS n FROM ({ORACLES["item_options_analysis"]})) a
 LEFT JOIN (SELECT DISTINCT item_name, item_category FROM ({sql("SELECT * FROM el")})) USING (item_name) GROUP BY 1""",
)
def _(s):
    """Many to many: option counts and items share item names."""
    tables = metrics.report_tables(s.orders, AS_OF)
    return metrics.metric(tables, "option_counts", ["count"], ["items.item_category"])


@query(
    "metric_option_counts_by_order_status",
    f"""SELECT status, sum(n)::BIGINT AS "count" FROM (SELECT item_name, "count" AS n FROM ({ORACLES["item_options_analysis"]})) a
 LEFT JOIN (SELECT DISTINCT item_name, status FROM ({sql("SELECT item_name, status FROM el JOIN os USING (order_id)")})) USING (item_name) GROUP BY 1""",
)
def _(s):
    """Two links: option counts to items by name, items to orders."""
    tables = metrics.report_tables(s.orders, AS_OF)
    return metrics.metric(tables, "option_counts", ["count"], ["orders.status"])


@query(
    "metric_items_by_total_sales",
    f"""SELECT t.item_name, sum(quantity)::BIGINT AS item_quantity FROM ({sql("SELECT item_name, quantity FROM el")}) e
 LEFT JOIN (SELECT DISTINCT item_name FROM ({ORACLES["total_sales_by_item"]})) t ON t.item_name = e.item_name GROUP BY 1""",
)
def _(s):
    tables = metrics.report_tables(s.orders, AS_OF)
    return metrics.metric(tables, "items", ["item_quantity"], ["item_totals.item_name"])


@query(
    "metric_staged_orders",
    sql("SELECT status, sum(total_cents)::BIGINT AS total FROM ro GROUP BY 1"),
)
def _(s):
    tables = metrics.report_tables(s.orders, AS_OF)
    return metrics.metric(tables, "staged_orders", ["total"], ["staged_orders.status"])


@query(
    "revenue_kpi_hourly",
    sql("SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, round(sum(value), 6) AS revenue, count(*) AS events FROM events WHERE event_type = 'purchase' GROUP BY 1, 2"),
)
def _(s):
    return kpi.revenue_kpi(s.table("events"))


@query(
    "revenue_kpi_daily",
    sql("SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY AS window_end, round(sum(value), 6) AS revenue, count(*) AS events FROM events WHERE event_type = 'purchase' GROUP BY 1, 2"),
)
def _(s):
    return kpi.revenue_kpi(s.table("events"), "1 day")


@query(
    "visit_sessions",
    sql("""SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events, round(sum(value), 6) AS value FROM
 (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM
  (SELECT *, CASE WHEN ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS n FROM events)) GROUP BY user_id, sid"""),
)
def _(s):
    return kpi.visit_sessions(s.table("events"))
