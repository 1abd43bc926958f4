"""Common table expressions the SQL twins start from.

They rebuild the same raw orders from the given tables, but stay relational: the cart
is never parsed from JSON here, so the twins check the parsing as well.
"""

from __future__ import annotations

import re

_LINE_TEXT = """'{"name":"' || p_name || '","price":' || CAST(CAST(round(l_extendedprice*100) AS BIGINT) AS VARCHAR)
 || CASE WHEN l_linenumber = 7 THEN '' WHEN l_linenumber = 6 THEN ',"quantity":"x"'
         ELSE ',"quantity":"' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '"' END
 || ',"options":[{"name":"size","value":"' || CAST(p_size AS VARCHAR) || '","price":'
 || CAST(CAST(round(p_retailprice*100) AS BIGINT) AS VARCHAR)
 || '},{"name":"flag","value":"' || l_returnflag || '","price":0}]}'"""

# documents that are cut off or missing give no scalars and no lines
_UNREADABLE = "order_id % 500 IN (3, 4)"

CTES: dict[str, str] = {
    # cart elements as written: one row per element, equal elements repeat
    "ela": f"""
SELECT l_orderkey AS order_id, p_name AS item_name,
  CASE WHEN split_part(p_name,' ',2) IN ('plate','ring') THEN 'Food'
       WHEN split_part(p_name,' ',2) IN ('widget','gizmo') THEN 'Hot Drinks'
       WHEN split_part(p_name,' ',2) IN ('rod','bolt') THEN 'Cold Drinks' ELSE 'Kitchen' END AS item_category,
  CASE WHEN l_linenumber IN (6,7) THEN 1 ELSE CAST(l_quantity AS BIGINT) END AS quantity,
  CAST(round(l_extendedprice*100) AS BIGINT) AS price_cents,
  {_LINE_TEXT} AS txt,
  CAST(p_size AS VARCHAR) AS size_value, CAST(round(p_retailprice*100) AS BIGINT) AS size_cents,
  l_returnflag AS flag_value
FROM lineitem JOIN part ON l_partkey = p_partkey
JOIN (SELECT unnest([0,1]) AS i) d ON d.i = 0 OR (l_orderkey % 10 = 0 AND l_linenumber = 1)""",
    # those that can be read
    "el": f"SELECT * FROM ela WHERE NOT ({_UNREADABLE})",
    # raw orders as written, scalars only
    "rw": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, md5(CAST(o_custkey AS VARCHAR)) AS ip_addr,
  o_orderdate + INTERVAL 24 YEAR + to_minutes(420 + (o_orderkey*37) % 600) AS date_created,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 24 YEAR + to_minutes(425 + (o_orderkey*37) % 600) END AS date_paid,
  CAST(round(o_totalprice*100) AS BIGINT) AS total_cents,
  CAST(CASE WHEN o_orderstatus='F' THEN 2 WHEN o_orderstatus='O' THEN 1 WHEN o_orderkey % 3 = 0 THEN 0
       WHEN o_orderkey % 3 = 1 THEN 9 ELSE 10 END AS INTEGER) AS status,
  CASE WHEN o_orderkey % 4 = 0 THEN CAST(round(o_totalprice*100) AS BIGINT) // 100 ELSE 0 END AS surcharge_cents,
  CAST(round(o_totalprice*100) AS BIGINT) // 11 AS gst_cents,
  strftime(o_orderdate + to_minutes(420 + (o_orderkey*37) % 600), '%H:%M') AS order_time,
  CASE o_orderkey % 5 WHEN 1 THEN 'ASAP'
    WHEN 2 THEN 'Today ' || CAST(o_orderkey % 12 + 1 AS VARCHAR) || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR),2,'0') || 'PM'
    WHEN 3 THEN 'Tomorrow ' || CAST(o_orderkey % 12 + 1 AS VARCHAR) || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR),2,'0')
    WHEN 4 THEN 'Today ' || CAST(o_orderkey % 12 + 1 AS VARCHAR) || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR),2,'0') || ' PM'
    END AS order_time_verbose
FROM orders""",
    # with the scalars of readable documents; every 500th has an object for its total
    "ro": f"""
SELECT * REPLACE (CASE WHEN {_UNREADABLE} THEN NULL ELSE surcharge_cents END AS surcharge_cents, CASE WHEN {_UNREADABLE} THEN NULL ELSE gst_cents END AS gst_cents,
  CASE WHEN {_UNREADABLE} THEN NULL ELSE order_time END AS order_time, CASE WHEN {_UNREADABLE} THEN NULL ELSE order_time_verbose END AS order_time_verbose)
FROM rw""",
    "os": f"""
SELECT ro.*, CASE WHEN status=2 THEN 'Payment is successful' WHEN status=1 THEN 'Payment is successful, label not printed'
  WHEN status=9 THEN 'Payment is unsuccessful' WHEN status=0 THEN 'Order created but no payment made'
  WHEN status=10 AND year(date_created) BETWEEN 2019 AND 2020 THEN 'Unknown (2019-2020)' ELSE 'Status Unknown' END AS status_description,
  CASE WHEN NOT ({_UNREADABLE}) THEN COALESCE(c.n, 0) END AS cart_size
FROM ro LEFT JOIN (SELECT order_id, count(*) AS n FROM el GROUP BY 1) c USING (order_id)""",
    # merged lines
    "ln": """
SELECT order_id, item_name, item_category, txt, count(*) AS copies, sum(quantity)::BIGINT AS quantity,
  sum(price_cents)::BIGINT AS price_cents, any_value(size_value) AS size_value, any_value(size_cents) AS size_cents,
  any_value(flag_value) AS flag_value,
  CAST(dense_rank() OVER (PARTITION BY order_id ORDER BY item_name, txt) AS INTEGER) AS item_id,
  CAST(dense_rank() OVER (PARTITION BY order_id ORDER BY item_name) AS INTEGER) AS item_rank
FROM el GROUP BY order_id, item_name, item_category, txt""",
    # options of merged lines
    "op": """
SELECT order_id, order_id || '-' || item_id AS order_item_id, item_name, 'size' AS option_name, size_value AS option_value, size_cents AS option_cents FROM ln
UNION ALL SELECT order_id, order_id || '-' || item_id, item_name, 'flag', flag_value, 0 FROM ln""",
    "opd": "SELECT op.*, os.date_created FROM op JOIN os USING (order_id)",
    # sales per order and item
    "ps": """
SELECT ln.order_id, any_value(os.date_created) AS date_created, any_value(os.customer_id) AS customer_id, ln.item_name,
  any_value(ln.item_category) AS item_category, sum(ln.quantity)::BIGINT AS quantity_sold, sum(ln.price_cents)::BIGINT AS sales_cents
FROM ln JOIN os USING (order_id) GROUP BY ln.order_id, ln.item_name""",
    "psu": """
SELECT el.order_id, any_value(os.date_created) AS date_created, any_value(os.customer_id) AS customer_id, el.item_name,
  any_value(el.item_category) AS item_category, sum(el.quantity)::BIGINT AS quantity_sold, sum(el.price_cents*el.quantity)::BIGINT AS sales_cents
FROM el JOIN os USING (order_id) GROUP BY el.order_id, el.item_name""",
    # paid lines and paid orders with lines
    "pl": "SELECT ln.*, os.customer_id, os.date_created AS order_time, CASE WHEN order_id % 500 <> 6 THEN os.total_cents END AS order_cents FROM ln JOIN os USING (order_id) WHERE date_paid IS NOT NULL AND status IN (1,2)",
    "po": "SELECT DISTINCT order_id, customer_id, order_time, order_cents FROM pl",
    "gp": """
SELECT *, date_sub('day', order_time, next_order_time) AS interval_days FROM (
  SELECT *, lead(order_time) OVER (PARTITION BY customer_id ORDER BY order_time, order_id) AS next_order_time FROM po)""",
    "th": """
SELECT customer_id, COALESCE(avg(interval_days) + stddev_samp(interval_days),
  (SELECT avg(interval_days) + stddev_samp(interval_days) FROM gp)) AS churn_threshold FROM gp GROUP BY customer_id""",
    "oh0": """
SELECT strftime(d, '%Y-%m-%d') AS date, CASE WHEN month(d)=1 THEN 700 END AS open_time, CASE WHEN month(d)=1 THEN 1400 END AS close_time,
  CASE WHEN month(d)=1 THEN 'Short day' ELSE 'Closed' END AS special_note
FROM (SELECT unnest(generate_series((SELECT min(date_created)::DATE FROM ro)::TIMESTAMP, (SELECT max(date_created)::DATE FROM ro)::TIMESTAMP, INTERVAL 1 DAY)) AS d)
WHERE (month(d)=12 AND day(d)=25) OR (month(d)=1 AND day(d)=26)
UNION ALL SELECT 'normal_' || n, CASE WHEN n IN ('Saturday','Sunday') THEN 700 ELSE 600 END, 1600, NULL
FROM (SELECT unnest(['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday']) AS n)""",
    "oh": """
SELECT CASE WHEN date NOT LIKE 'normal_%' THEN TRY_CAST(date AS DATE) END AS actual_date, CAST(open_time AS INTEGER) AS open_time,
  CAST(close_time AS INTEGER) AS close_time, special_note,
  CASE WHEN date LIKE 'normal_%' THEN replace(date,'normal_','') ELSE 'special' END AS day_category FROM oh0""",
}

_WORD = re.compile(r"\b([a-z][a-z0-9]*)\b")


def _needed(sql: str, extra: dict[str, str]) -> list[str]:
    known = {**CTES, **extra}
    order = list(known)
    found: set[str] = set()
    stack = [sql]
    while stack:
        for word in _WORD.findall(stack.pop()):
            if word in known and word not in found:
                found.add(word)
                stack.append(known[word])
    return [name for name in order if name in found]


def sql(body: str, **extra: str) -> str:
    """``body`` with the common table expressions it mentions in front."""
    known = {**CTES, **extra}
    parts = [f"{name} AS ({known[name]})" for name in _needed(body, extra)]
    return f"WITH {', '.join(parts)}\n{body}" if parts else body


def half_up(total: str, count: str) -> str:
    """Whole-number ratio, halves up, as dollars."""
    return f"((2*({total}) + ({count})) // (2*({count}))) / 100.0"
