"""Retention, returns, removal scenarios, customer value and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.operators import ordering, transforms
from orderloom.plans import customers, retention, returns, rfm
from orderloom.scratch import stage
from orderloom.workload.base_sql import sql
from orderloom.workload.registry import query

Z = 1.959963984540054


def _wilson(k: str, n: str, z: float, sign: str) -> str:
    p = f"(({k})::DOUBLE / ({n}))"
    return f"(2*({n})*{p} + {z * z!r} {sign} {z!r}*sqrt(4*({n})*{p}*(1-{p}) + {z * z!r})) / (2*(({n}) + {z * z!r}))"


RET = {
    "lt": "SELECT max(order_time) AS m FROM po",
    "lab": """SELECT customer_id, order_id, order_time, next_order_time, interval_days, churn_threshold, COALESCE(interval_days < churn_threshold, false) AS rep
 FROM gp JOIN th USING (customer_id), lt WHERE order_time >= TIMESTAMP '2022-07-01'
 AND NOT (next_order_time IS NULL AND date_sub('day', order_time, m) < floor(churn_threshold))""",
    "oi": "SELECT DISTINCT customer_id, order_id, item_name AS item, rep FROM (SELECT order_id, item_name FROM pl) JOIN lab USING (order_id)",
    "ir0": "SELECT item, count(*) AS n, count(*) FILTER (WHERE rep) AS k FROM oi GROUP BY 1",
    "ir1": f"SELECT *, (k + 0.005::DOUBLE) / (n + 0.01::DOUBLE) AS p, {_wilson('k', 'n', Z, '-')} AS lo, {_wilson('k', 'n', Z, '+')} AS hi FROM ir0 WHERE k > 0",
    "irm": "SELECT quantile_cont(p, 0.5) AS md FROM ir1",
    "ir": "SELECT ir1.*, CASE WHEN lo > md THEN 'Low' WHEN hi < md THEN 'High' ELSE 'Moderate' END AS lvl FROM ir1, irm",
    "ai": "SELECT oi.* FROM oi WHERE item IN (SELECT item FROM ir WHERE lvl = 'High')",
    "im": """SELECT a.*, r.* FROM (SELECT count(*) AS affected, count(*) FILTER (WHERE NOT rep) AS unret FROM (SELECT DISTINCT customer_id, order_id, rep FROM ai)) a,
 (SELECT quantile_cont(p, 0.5) AS after, quantile_cont(p, 0.75) - quantile_cont(p, 0.25) AS iqr FROM ir WHERE lvl <> 'High') r""",
}


def ret(body: str, **extra: str) -> str:
    return sql(body, **RET, **extra)


def _labelled(s):
    """The labelled orders, staged: several registered queries start from them."""
    if not hasattr(s, "labelled"):
        s.labelled = stage(retention.order_repeat_label(s.orders), "labelled")
    return s.labelled


def _items(s):
    """Staged as well: its use of quantiles is a sort."""
    if not hasattr(s, "item_risks"):
        s.item_risks = stage(retention.item_retention(_labelled(s)), "items")
    return s.item_risks


def _impact(s):
    if not hasattr(s, "impact"):
        s.impact = stage(retention.high_risk_impact(_labelled(s), _items(s)), "impact")
    return s.impact


@query(
    "order_repeat_label",
    ret("SELECT customer_id, order_id, order_time, next_order_time, interval_days AS interval_to_next, round(churn_threshold, 6) AS churn_threshold, rep AS next_repeat_purchase FROM lab"),
)
def _(s):
    return retention.order_repeat_label(s.orders).drop("items")


@query(
    "labelled_lines",
    ret("SELECT order_id, item_id AS item_tracking_id, item_name AS item, quantity, lab.customer_id, lab.order_time, rep AS next_repeat_purchase FROM lab LEFT JOIN (SELECT order_id, item_id, item_name, quantity FROM pl) USING (order_id)"),
)
def _(s):
    return retention.labelled_lines(s.orders, _labelled(s))


_IR = "SELECT item, n AS item_order_count, k AS item_order_count_next_repeat, round(p, 6) AS retention_proba, round(lo, 6) AS ci_lower, round(hi, 6) AS ci_upper, lvl AS churn_risk_level FROM ir"


@query("item_retention_risk", ret(_IR))
def _(s):
    return _items(s)


@query(
    "item_retention_risk_keep_zero",
    sql(_IR, **{**RET, "ir1": RET["ir1"].replace(" WHERE k > 0", "")}),
)
def _(s):
    return retention.item_retention(_labelled(s), keep_zero=True)


@query("item_risk_levels", ret("SELECT lvl AS churn_risk_level, count(*) AS count FROM ir GROUP BY 1"))
def _(s):
    return rfm.value_counts(_items(s), "churn_risk_level")


@query(
    "high_risk_impact",
    ret("""SELECT affected AS affected_orders, unret AS unretained_orders, affected - unret AS repeat_before, round((affected - unret)::DOUBLE / nullif(affected, 0), 6) AS retention_before,
 round(after, 6) AS retention_after, round(iqr, 6) AS iqr FROM im"""),
)
def _(s):
    return _impact(s)


_COMPOUND = """WITH RECURSIVE {ctes}, walk AS (
 SELECT cohort, initial_orders, retention_proba, initial_orders AS live, 0::BIGINT AS step FROM start
 UNION ALL SELECT cohort, initial_orders, retention_proba, CAST(floor(live * retention_proba) AS BIGINT), step + 1 FROM walk WHERE live >= 1)
SELECT cohort, initial_orders, round(retention_proba, 6) AS retention_proba, CAST(sum(CASE WHEN step > 0 THEN live ELSE 0 END) AS BIGINT) AS total_new_repeat_purchases
FROM walk GROUP BY cohort, initial_orders, retention_proba"""


def _recursive(start: str) -> str:
    head = ret("SELECT * FROM start", start=start)
    ctes = head[len("WITH ") : head.rindex("\nSELECT")]
    return _COMPOUND.format(ctes=ctes)


@query("cohort_compounding", _recursive("SELECT item AS cohort, n AS initial_orders, p AS retention_proba FROM ir"))
def _(s):
    return retention.cohort_compounding(
        _items(s).select(
            F.col("item").alias("cohort"),
            F.col("item_order_count").alias("initial_orders"),
            "retention_proba",
        )
    )


_REMOVAL_START = """SELECT 'after' AS cohort, affected AS initial_orders, after AS retention_proba FROM im
 UNION ALL SELECT 'before', affected, (affected - unret)::DOUBLE / nullif(affected, 0) FROM im"""


@query("removal_cohorts", _recursive(_REMOVAL_START))
def _(s):
    return retention.cohort_compounding(retention.impact_cohorts(_impact(s)))


_REVENUE = """, tot AS (SELECT cohort, CAST(sum(CASE WHEN step > 0 THEN live ELSE 0 END) AS BIGINT) AS t FROM walk GROUP BY 1)
SELECT inc AS repeat_increase, round(sp, 4) AS avg_spending_per_order, ps0 AS period_sales, round(inc * sp, 4) AS extra_revenue, round(inc * sp / ps0, 4) AS revenue_increase FROM
 (SELECT (SELECT t FROM tot WHERE cohort = 'after') - (SELECT t FROM tot WHERE cohort = 'before') AS inc,
  (SELECT avg(m) / 100 FROM (SELECT avg(order_cents) AS m FROM po WHERE customer_id IN (SELECT customer_id FROM ai) GROUP BY customer_id)) AS sp,
  (SELECT sum(order_cents)::BIGINT / 100.0 FROM po WHERE order_time >= TIMESTAMP '2022-07-01') AS ps0)"""


_REMOVAL = _recursive(_REMOVAL_START)


@query("removal_revenue", _REMOVAL[: _REMOVAL.rindex("\nSELECT cohort")] + _REVENUE, digits=4)
def _(s):
    return retention.removal_revenue(s.orders, _labelled(s), _items(s), _impact(s))


_IC = {
    "ic0": "SELECT item, customer_id, count(*) AS c, count(*) FILTER (WHERE NOT rep) AS u FROM ai GROUP BY 1, 2",
    "ic": "SELECT ic0.*, min(c) OVER w AS mn, max(c) OVER w AS mx, avg(c) OVER w + stddev_samp(c) OVER w AS lim FROM ic0 WINDOW w AS (PARTITION BY item)",
}


@query(
    "high_risk_item_customers",
    ret("SELECT item, customer_id, c AS order_count, mn AS min_order_count, mx AS max_order_count, round(lim, 6) AS loyalty_threshold FROM ic", **_IC),
)
def _(s):
    return retention.item_customer_orders(_labelled(s), _items(s)).drop("_unretained")


@query(
    "loyal_customers_at_risk",
    ret("SELECT item, customer_id, c AS order_count, round(lim, 6) AS loyalty_threshold FROM ic WHERE c > lim AND u = 0", **_IC),
)
def _(s):
    return retention.loyal_customers(_labelled(s), _items(s))


@query(
    "loyalty_tradeoff",
    ret(
        """SELECT gain AS customers_retained, lost AS customers_lost, gain - lost AS net_retention_gain, total AS total_customers, round((gain - lost)::DOUBLE / total, 6) AS net_share FROM
 (SELECT CAST(COALESCE(floor((SELECT count(DISTINCT customer_id) FROM ai WHERE NOT rep) * after), 0) AS BIGINT) AS gain,
   (SELECT count(*) FROM ic WHERE c > lim AND u = 0) AS lost, (SELECT count(DISTINCT customer_id) FROM po WHERE order_time >= TIMESTAMP '2022-07-01') AS total FROM im)""",
        **_IC,
    ),
)
def _(s):
    return retention.loyalty_tradeoff(s.orders, _labelled(s), _items(s), _impact(s))


_SD = "SELECT customer_id, sum(order_cents)::BIGINT / 100.0 AS total_spending, count(*) AS order_freq, avg(order_cents) / 100 AS spending_per_order FROM po GROUP BY 1"


@query(
    "spending_drivers",
    sql(f"SELECT customer_id, total_spending, order_freq, round(spending_per_order, 6) AS spending_per_order FROM ({_SD})"),
)
def _(s):
    return customers.spending_drivers(s.orders)


def _avg_rank(column: str) -> str:
    return f"rank() OVER (ORDER BY {column}) + (count(*) OVER (PARTITION BY {column}) - 1) / 2.0"


_SP = {
    "sd": _SD,
    "rk": f"SELECT {_avg_rank('total_spending')} AS a, {_avg_rank('order_freq')} AS b, {_avg_rank('spending_per_order')} AS c FROM sd",
    "sp": """SELECT 'total_spending' AS left, 'order_freq' AS right, corr(a, b) AS rho, count(*) AS n FROM rk
 UNION ALL SELECT 'total_spending', 'spending_per_order', corr(a, c), count(*) FROM rk UNION ALL SELECT 'order_freq', 'spending_per_order', corr(b, c), count(*) FROM rk""",
}


@query(
    "spearman_matrix",
    sql(
        f"SELECT \"left\", \"right\", round(rho, 6) AS rho, n, round(rho * sqrt(n - 2) / sqrt(1 - rho*rho), 6) AS t_stat, abs(rho * sqrt(n - 2) / sqrt(1 - rho*rho)) > {Z} AS significant FROM sp",
        **{**_SP, "sp": _SP["sp"].replace("AS left", 'AS "left"').replace("AS right", 'AS "right"')},
    ),
)
def _(s):
    columns = ["total_spending", "order_freq", "spending_per_order"]
    return ordering.significance(ordering.spearman(customers.spending_drivers(s.orders), columns))


RETURNS = {
    "sr": """SELECT *, COALESCE(g > 0 AND g <= 60, false) AS returned FROM (SELECT *, date_sub('day', date_created, lead(date_created) OVER (PARTITION BY customer_id ORDER BY date_created, order_id, item_name)) AS g
 FROM ps WHERE date_created BETWEEN TIMESTAMP '2022-01-01' AND TIMESTAMP '2024-12-31')""",
    "so": """SELECT ps.*, returned FROM ps JOIN (SELECT order_id, COALESCE(g > 0 AND g <= 60, false) AS returned FROM
 (SELECT order_id, date_sub('day', date_created, lead(date_created) OVER (PARTITION BY customer_id ORDER BY date_created, order_id)) AS g
  FROM (SELECT DISTINCT order_id, customer_id, date_created FROM ps WHERE date_created BETWEEN TIMESTAMP '2022-01-01' AND TIMESTAMP '2024-12-31'))) USING (order_id)""",
    "rp0": """SELECT CASE WHEN date_created BETWEEN TIMESTAMP '2022-03-06' AND TIMESTAMP '2023-03-06' THEN '2022_2023'
 WHEN date_created BETWEEN TIMESTAMP '2023-03-07' AND TIMESTAMP '2024-03-06' THEN '2023_2024' END AS period, item_name AS item, count(*) AS n, count(*) FILTER (WHERE returned) AS k FROM sr GROUP BY 1, 2""",
    "rp1": "SELECT *, (k + 0.5::DOUBLE) / (n + 1) AS p FROM rp0 WHERE period IS NOT NULL",
    "rp2": """SELECT *, (2*n*p + 3.8415999999999997 - 1.96*sqrt(4*n*p*(1-p) + 3.8415999999999997)) / (2*(n + 3.8415999999999997)) AS lo,
 (2*n*p + 3.8415999999999997 + 1.96*sqrt(4*n*p*(1-p) + 3.8415999999999997)) / (2*(n + 3.8415999999999997)) AS hi FROM rp1""".replace("1.96*", "1.96::DOUBLE*").replace("3.8415999999999997", "3.8415999999999997::DOUBLE"),
    "rp": "SELECT rp2.*, CASE WHEN lo > md THEN 'Low' WHEN hi < md THEN 'High' ELSE 'Moderate' END AS risk FROM rp2 JOIN (SELECT period, quantile_cont(p, 0.5) AS md FROM rp2 GROUP BY 1) USING (period)",
}
_RP = "SELECT period, item, n AS total_sales, k AS return_counts, round(k::DOUBLE / n, 6) AS base_probability, round(p, 6) AS updated_probability, round(lo, 6) AS ci_lower, round(hi, 6) AS ci_upper, risk AS churn_risk FROM rp"


def _returns(s):
    return returns.item_return_probability(s.orders)


@query("item_return_probability", sql(_RP, **RETURNS))
def _(s):
    return _returns(s)


@query(
    "item_return_probability_by_order",
    sql(_RP, **{**RETURNS, "rp0": RETURNS["rp0"].replace("FROM sr", "FROM so")}),
)
def _(s):
    return returns.item_return_probability(s.orders, unit="order")


@query(
    "high_risk_return_items",
    sql("SELECT item, round(avg(p), 6) AS updated_probability, sum(n)::BIGINT AS total_sales FROM rp WHERE risk = 'High' GROUP BY 1", **{**RETURNS, "rp0": RETURNS["rp0"].replace("FROM sr", "FROM so")}),
)
def _(s):
    return returns.high_risk_summary(returns.item_return_probability(s.orders, unit="order"))


_PLAN = """SELECT period, role, item, round(lo, 6) AS ci_lower, round(p, 6) AS updated_probability FROM
 (SELECT rp.*, CASE WHEN risk = 'High' AND lo > h THEN 'replace' WHEN risk = 'Low' AND p >= l THEN 'candidate' END AS role FROM rp JOIN
  (SELECT period, quantile_cont(CASE WHEN risk = 'High' THEN lo END, 0.75) AS h, quantile_cont(CASE WHEN risk = 'Low' THEN p END, 0.75) AS l FROM rp GROUP BY 1) USING (period)) WHERE role IS NOT NULL"""


@query(
    "replacement_plan",
    sql(
        _PLAN,
        **{**RETURNS, "rp0": RETURNS["rp0"].replace("FROM sr", "FROM so")},
    ),
)
def _(s):
    return returns.replacement_plan(returns.item_return_probability(s.orders, unit="order"))


_UPLIFT = """SELECT period, revenue, round(before, 6) AS original_churn, round(after, 6) AS new_churn, round(before - after, 6) AS improvement, round(revenue * (before - after), 6) AS potential_increase,
 round((before - after) * 100, 6) AS increase_percent, round(revenue::DOUBLE / customers * (1 - after), 6) AS new_ltv_per_customer FROM
 (SELECT period, revenue, sl::DOUBLE / revenue * cl + sh::DOUBLE / revenue * cl AS after, sh::DOUBLE / revenue * ch + sl::DOUBLE / revenue * cl AS before FROM
  (SELECT period, sum(n)::BIGINT AS revenue, COALESCE(sum(n) FILTER (WHERE risk = 'High'), 0)::BIGINT AS sh, COALESCE(sum(n) FILTER (WHERE risk = 'Low'), 0)::BIGINT AS sl,
    1 - avg(p) FILTER (WHERE risk = 'High') AS ch, 1 - avg(p) FILTER (WHERE risk = 'Low') AS cl FROM rp GROUP BY 1)),
 (SELECT count(DISTINCT customer_id) AS customers FROM ps WHERE date_created BETWEEN TIMESTAMP '2022-03-06' AND TIMESTAMP '2023-03-06' OR date_created BETWEEN TIMESTAMP '2023-03-07' AND TIMESTAMP '2024-03-06')"""


@query("churn_weighted_uplift", sql(_UPLIFT, **{**RETURNS, "rp0": RETURNS["rp0"].replace("FROM sr", "FROM so")}))
def _(s):
    counted = customers.customer_ltv(s.orders).agg(
        F.count_distinct("customer_id").alias("customers")
    )
    return returns.churn_weighted_uplift(
        returns.item_return_probability(s.orders, unit="order"), counted
    )


@query(
    "high_risk_return_items_by_line",
    sql("SELECT item, round(avg(p), 6) AS updated_probability, sum(n)::BIGINT AS total_sales FROM rp WHERE risk = 'High' GROUP BY 1", **RETURNS),
)
def _(s):
    return returns.high_risk_summary(_returns(s))


@query("replacement_plan_by_line", sql(_PLAN, **RETURNS))
def _(s):
    return returns.replacement_plan(_returns(s))


@query("churn_weighted_uplift_by_line", sql(_UPLIFT, **RETURNS))
def _(s):
    counted = customers.customer_ltv(s.orders).agg(
        F.count_distinct("customer_id").alias("customers")
    )
    return returns.churn_weighted_uplift(_returns(s), counted)


_FM = "SELECT customer_id, count(*) AS f, sum(sales_cents)::BIGINT AS c FROM ps WHERE date_created BETWEEN TIMESTAMP '2022-04-06' AND TIMESTAMP '2023-03-06' GROUP BY 1"


@query("freq_money_corr", sql("SELECT round(corr(f, c / 100.0), 6) AS correlation, count(*) AS customers FROM fm", fm=_FM))
def _(s):
    return customers.freq_money_corr(s.orders)


@query(
    "top_decile_share",
    sql(
        """SELECT round(t, 6) AS threshold, count(*) FILTER (WHERE f >= t) AS top_customers, round(sum(c) FILTER (WHERE f >= t)::DOUBLE / sum(c)::DOUBLE, 6) AS share
 FROM fm, (SELECT quantile_cont(f::DOUBLE, 0.9) AS t FROM fm) GROUP BY t""",
        fm=_FM,
    ),
)
def _(s):
    return customers.top_decile_share(s.orders)


_PERIOD = """CASE WHEN date_created BETWEEN TIMESTAMP '2022-03-06' AND TIMESTAMP '2023-03-06' THEN '2022_2023' WHEN date_created BETWEEN TIMESTAMP '2023-03-07' AND TIMESTAMP '2024-03-06' THEN '2023_2024' END"""


@query(
    "top_decile_by_period",
    sql(
        """SELECT customer_id, f AS frequency, a / 100.0 AS "total_spending_2022_2023", round(a::DOUBLE / ta * 100, 6) AS "contribution_2022_2023", b / 100.0 AS "total_spending_2023_2024",
 round(b::DOUBLE / tb * 100, 6) AS "contribution_2023_2024" FROM td, (SELECT quantile_cont(f::DOUBLE, 0.9) AS t, sum(a)::BIGINT AS ta, sum(b)::BIGINT AS tb FROM td) WHERE f >= t""",
        td=f"""SELECT customer_id, count(*) AS f, COALESCE(sum(sales_cents) FILTER (WHERE period = '2022_2023'), 0)::BIGINT AS a, COALESCE(sum(sales_cents) FILTER (WHERE period = '2023_2024'), 0)::BIGINT AS b
 FROM (SELECT *, {_PERIOD} AS period FROM ps) WHERE period IS NOT NULL GROUP BY 1""",
    ),
)
def _(s):
    return customers.top_decile_by_period(s.orders)


_LTV = {
    "lv0": f"""SELECT period, customer_id, sum(sales_cents)::BIGINT / 100.0 AS spent, date_sub('day', min(date_created), max(date_created)) + 1 AS days FROM (SELECT *, {_PERIOD} AS period FROM ps) WHERE period IS NOT NULL GROUP BY 1, 2""",
    "lv": "SELECT lv0.*, e, spent / days AS daily FROM lv0 JOIN (SELECT period, avg(days) AS e FROM lv0 GROUP BY 1) USING (period)",
}


@query(
    "customer_ltv",
    sql("SELECT period, customer_id, spent AS total_spending, days AS actual_lifetime_days, e AS expected_lifetime, daily AS average_daily_spending, daily * e AS ltv FROM lv", **_LTV),
    digits=None,
)
def _(s):
    return customers.customer_ltv(s.orders)


@query("average_ltv", sql("SELECT period, round(avg(daily * e), 6) AS average_ltv, count(*) AS customers FROM lv GROUP BY 1", **_LTV))
def _(s):
    return customers.average_ltv(customers.customer_ltv(s.orders))


_RFM = "SELECT customer_id, date_sub('day', max(date_created), (SELECT max(date_created) FROM ro)) AS recency, count(*) AS frequency, sum(total_cents)::BIGINT AS monetary FROM ro GROUP BY 1"


@query("rfm_orders", sql("SELECT * FROM rf", rf=_RFM))
def _(s):
    return rfm.rfm_orders(s.orders)


@query(
    "rfm_period",
    sql(f"""SELECT period, customer_id, date_sub('day', max(date_created), CASE period WHEN '2022_2023' THEN TIMESTAMP '2023-03-07' ELSE TIMESTAMP '2024-03-07' END) AS recency, count(*) AS frequency,
 sum(sales_cents)::BIGINT / 100.0 AS monetary FROM (SELECT *, {_PERIOD} AS period FROM ps) WHERE period IS NOT NULL GROUP BY 1, 2"""),
)
def _(s):
    return rfm.rfm_period(s.orders)


def _bin(order: str) -> str:
    return f"CAST(5 - greatest(1, (4 * (row_number() OVER (ORDER BY {order}, customer_id) - 1) + (SELECT count(*) FROM rf) - 2) // ((SELECT count(*) FROM rf) - 1)) AS INTEGER)"


_QUARTILE = {
    "rf": _RFM,
    "qb": f"SELECT rf.*, {_bin('recency DESC')} AS r_score, {_bin('frequency')} AS f_score, {_bin('monetary')} AS m_score FROM rf",
    "qz": """SELECT *, r_score || '' || f_score || m_score AS rfm_segment, r_score + f_score + m_score AS rfm_score,
 CASE WHEN r_score + f_score + m_score < 5 THEN 'Platinum' WHEN r_score + f_score + m_score < 7 THEN 'Gold' WHEN r_score + f_score + m_score < 9 THEN 'Silver'
  WHEN r_score + f_score + m_score < 12 THEN 'Bronze' ELSE 'Green' END AS score FROM qb""",
}


@query("rfm_quartile_score", sql("SELECT * FROM qz", **_QUARTILE))
def _(s):
    return rfm.rfm_quartile_score(rfm.rfm_orders(s.orders))


def _five(column: str, low: bool) -> str:
    cuts = [f"(SELECT quantile_cont({column}::DOUBLE, 0.{p}) FROM rf)" for p in (2, 4, 6, 8)]
    points = [5, 4, 3, 2, 1] if low else [1, 2, 3, 4, 5]
    whens = " ".join(f"WHEN {column} <= {cut} THEN {point}" for cut, point in zip(cuts, points))
    return f"CAST(CASE {whens} ELSE {points[4]} END AS INTEGER)"


_QUINTILE = {
    "rf": _RFM,
    "q5": f"SELECT rf.*, {_five('recency', True)} AS r_score, {_five('frequency', False)} AS f_score, {_five('monetary', False)} AS m_score FROM rf",
    "qt": """SELECT *, r_score || '' || f_score || m_score AS rfm_segment, r_score + f_score + m_score AS rfm_score,
 CASE WHEN r_score <= 2 AND f_score <= 2 THEN 'Hibernating' WHEN r_score <= 2 AND f_score <= 4 THEN 'At risk' WHEN r_score <= 2 THEN 'Can''t lose them'
  WHEN r_score = 3 AND f_score <= 2 THEN 'About to sleep' WHEN r_score = 3 AND f_score = 3 THEN 'Need attention' WHEN r_score <= 4 AND f_score >= 4 THEN 'Loyal customers'
  WHEN r_score = 4 AND f_score = 1 THEN 'Promising' WHEN r_score = 5 AND f_score = 1 THEN 'New customers' WHEN f_score <= 3 THEN 'Potential loyalists' ELSE 'Champions' END AS segment,
 CASE WHEN r_score + f_score + m_score > 10 THEN 'Platinum' WHEN r_score + f_score + m_score > 9 THEN 'Gold' WHEN r_score + f_score + m_score > 7 THEN 'Silver'
  WHEN r_score + f_score + m_score > 5 THEN 'Bronze' ELSE 'Green' END AS score FROM q5""",
}


@query("rfm_quintile_segments", sql("SELECT * FROM qt", **_QUINTILE))
def _(s):
    return rfm.rfm_quintile_segments(rfm.rfm_orders(s.orders))


@query(
    "score_tier_shares",
    sql("SELECT score, count(*) AS count, round(count(*)::DOUBLE / (SELECT count(*) FROM qz) * 100, 1) AS percent FROM qz GROUP BY 1", **_QUARTILE),
)
def _(s):
    return rfm.shares(rfm.rfm_quartile_score(rfm.rfm_orders(s.orders)), "score")


@query(
    "segment_tier_shares",
    sql("SELECT segment, score, count(*) AS count, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY segment) * 100, 1) AS percent FROM qt GROUP BY 1, 2", **_QUINTILE),
)
def _(s):
    return rfm.shares_within(rfm.rfm_quintile_segments(rfm.rfm_orders(s.orders)), "segment", "score")


def _hist(column: str) -> str:
    return f"""SELECT '{column}' AS metric, CAST(bin AS INTEGER) AS bin, round(lo + bin * w, 6) AS bin_start, COALESCE(c, 0) AS count, round(COALESCE(c, 0) / (n * w), 6) AS density FROM
 (SELECT min({column})::DOUBLE AS lo, (max({column})::DOUBLE - min({column})::DOUBLE) / 20 AS w, count(*) AS n FROM rf), range(0, 20) bs(bin)
 LEFT JOIN (SELECT CAST(least(floor(({column} - lo) / w), 19) AS BIGINT) AS bin, count(*) AS c FROM rf,
  (SELECT min({column})::DOUBLE AS lo, (max({column})::DOUBLE - min({column})::DOUBLE) / 20 AS w FROM rf) GROUP BY 1) USING (bin)"""


@query("histogram_rfm", sql(" UNION ALL ".join(_hist(c) for c in rfm.METRICS), rf=_RFM))
def _(s):
    return rfm.histogram(rfm.rfm_orders(s.orders), rfm.METRICS)


def _skew(column: str) -> str:
    x = f"greatest({column}::DOUBLE, 0.000001)"
    forms = {"raw": x, "log": f"ln({x})", "sqrt": f"sqrt({x})", "cbrt": f"cbrt({x})"}
    return " UNION ALL ".join(
        f"SELECT '{column}' AS metric, '{form}' AS transform, round(skewness({value}), 6) AS skewness FROM rf"
        for form, value in forms.items()
    )


@query("skewness_report", sql(" UNION ALL ".join(_skew(c) for c in rfm.METRICS), rf=_RFM))
def _(s):
    return transforms.skewness_report(rfm.rfm_orders(s.orders), rfm.METRICS)


LAMBDAS = [round(-2 + 0.25 * i, 2) for i in range(17)]


@query(
    "boxcox_likelihood",
    sql(
        """SELECT 'monetary' AS metric, lam, round((lam - 1) * sum(ln(x)) - count(*) / 2.0 * ln(var_pop(CASE WHEN lam = 0 THEN ln(x) ELSE pow(x, lam) / lam END)), 3) AS llf
 FROM (SELECT greatest(monetary::DOUBLE / 100, 0.000001) AS x FROM rf), (SELECT unnest(["""
        + ", ".join(f"{v}::DOUBLE" for v in LAMBDAS)
        + "]) AS lam) GROUP BY lam",
        rf=_RFM,
    ),
)
def _(s):
    dollars = rfm.rfm_orders(s.orders).withColumn("monetary", F.col("monetary") / 100)
    found = transforms.boxcox_likelihood(dollars, {"monetary": LAMBDAS})
    return found.withColumn("llf", F.round("llf", 3))
