"""What models feed, with a rule in place of the model, so that SQL can follow.

Clusters come from given centres, churn probabilities from the number of orders.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from orderloom.plans import churn, rfm, segmentation
from orderloom.scratch import stage
from orderloom.workload.base_sql import sql
from orderloom.workload.q_customers import _QUARTILE, _QUINTILE, _RFM
from orderloom.workload.q_models import FEATURES, _features, _hash, _once
from orderloom.workload.registry import query

# ---------------------------------------------------------------- clusters

CENTRES = ((1.0, -0.75, -0.75), (-0.5, 0.0, 0.25), (-0.5, 1.0, 0.75))
_T = {
    "recency": "cbrt(recency::DOUBLE)",
    "frequency": "ln(greatest(frequency, 1)::DOUBLE)",
    "monetary": "ln(greatest(monetary, 1)::DOUBLE)",
}


def _clustered(s):
    def make():
        base = stage(rfm.rfm_orders(s.orders), "rfm")
        forms = {
            "recency": F.cbrt(F.col("recency").cast("double")),
            "frequency": F.log(F.greatest("frequency", F.lit(1)).cast("double")),
            "monetary": F.log(F.greatest("monetary", F.lit(1)).cast("double")),
        }
        row = base.agg(
            *[F.avg(v).alias(f"_mean_{m}") for m, v in forms.items()],
            *[F.stddev_samp(v).alias(f"_std_{m}") for m, v in forms.items()],
        )
        parts = [(v - F.col(f"_mean_{m}")) / F.col(f"_std_{m}") for m, v in forms.items()]
        scaled = base.crossJoin(F.broadcast(row)).select(
            *base.columns, array_to_vector(F.array(*parts)).alias("scaled")
        )
        return stage(segmentation.nearest_centres(scaled, CENTRES), "by-centres")

    return _once(s, "by_centres", make)


def _gap(k: int) -> str:
    return "sqrt(" + " + ".join(f"(z{i} - ({c}))*(z{i} - ({c}))" for i, c in enumerate(CENTRES[k])) + ")"


CLUSTERS = {
    "rf": _RFM,
    "cst": "SELECT " + ", ".join(f"avg({v}) AS m{i}, stddev_samp({v}) AS s{i}" for i, v in enumerate(_T.values())) + " FROM rf",
    "csc": "SELECT rf.*, " + ", ".join(f"({v} - m{i}) / s{i} AS z{i}" for i, v in enumerate(_T.values())) + " FROM rf, cst",
    "csd": f"SELECT *, {_gap(0)} AS g0, {_gap(1)} AS g1, {_gap(2)} AS g2 FROM csc",
    "csl": "SELECT *, least(g0, g1, g2) AS d, CAST(CASE WHEN g0 <= g1 AND g0 <= g2 THEN 0 WHEN g1 <= g2 THEN 1 ELSE 2 END AS INTEGER) AS cluster FROM csd",
}
_MEANS = ", ".join(f"round(avg({m}), 6) AS mean_{m}" for m in rfm.METRICS)
_RELATIVE = ", ".join(f"round(avg({m}) / (SELECT avg({m}) FROM csl) - 1, 6) AS relative_{m}" for m in rfm.METRICS)


@query(
    "cluster_profile_by_centres",
    sql(f"SELECT cluster, count(*) AS count, round(count(*)::DOUBLE / (SELECT count(*) FROM csl) * 100, 1) AS percent, {_MEANS}, {_RELATIVE} FROM csl GROUP BY 1", **CLUSTERS),
)
def _(s):
    return segmentation.cluster_profile(_clustered(s))


@query(
    "cluster_attribute_means_by_centres",
    sql(" UNION ALL ".join(f"SELECT cluster, '{m}' AS attribute, round(avg(z{i}), 6) AS mean_value FROM csl GROUP BY 1" for i, m in enumerate(rfm.METRICS)), **CLUSTERS),
)
def _(s):
    return segmentation.attribute_means(_clustered(s))


@query(
    "cluster_tier_shares_by_centres",
    sql("""SELECT cluster, score, count(*) AS count, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY cluster) * 100, 1) AS percent
 FROM csl JOIN (SELECT customer_id, score FROM qz) USING (customer_id) GROUP BY 1, 2""", **{**CLUSTERS, **_QUARTILE}),
)
def _(s):
    tiers = rfm.rfm_quartile_score(rfm.rfm_orders(s.orders)).select("customer_id", "score")
    found = _clustered(s).select("customer_id", "cluster").join(tiers, "customer_id")
    return rfm.shares_within(found, "cluster", "score")


@query(
    "inertia_by_centres",
    sql("SELECT round(sum(d * d), 6) AS inertia, round(avg(d), 6) AS mean_distance FROM csl", **CLUSTERS),
)
def _(s):
    return segmentation.inertia(_clustered(s))


# ---------------------------------------------------------------- churn and campaign

RULE = {
    **FEATURES,
    "chr": "SELECT cf.*, 1.0::DOUBLE / (1 + frequency) AS proba FROM cf WHERE period = 'test' AND recency < 40",
    "cyr": "SELECT ro.* FROM ro, sn WHERE date_created BETWEEN l - INTERVAL 425 DAY AND l - INTERVAL 60 DAY",
    "cel": """SELECT chr.*, lt, total, ly, total * proba * 365 / ly AS lost FROM chr
 JOIN (SELECT customer_id, date_sub('day', min(date_created), max(date_created)) + 1 AS lt FROM ro GROUP BY 1) USING (customer_id)
 LEFT JOIN (SELECT customer_id, sum(total_cents)::BIGINT AS total, date_sub('day', min(date_created), max(date_created)) + 1 AS ly FROM cyr GROUP BY 1) USING (customer_id)""",
    **_QUINTILE,
    "cls": "SELECT cel.*, segment FROM cel LEFT JOIN (SELECT customer_id, segment FROM qt) USING (customer_id) WHERE ly > 10 AND lost > 500 / 0.3::DOUBLE",
    "csm": f"""SELECT * EXCLUDE (rn, nn) FROM (SELECT cls.*, row_number() OVER (ORDER BY {_hash('CAST(customer_id AS VARCHAR)')}, customer_id) AS rn, count(*) OVER () AS nn FROM cls) WHERE rn <= round(nn * 0.3::DOUBLE)""",
}
_LISTED = "period, customer_id, recency, frequency, monetary, churn, round(proba, 3) AS proba, lt AS lifetime_days_total, total, ly AS lifetime_days_last_year, round(lost, 3) AS expected_value_lost, segment"


def _scored(s):
    return churn.test_rows(_features(s)).withColumn("proba", 1.0 / (1 + F.col("frequency")))


def _listed(s):
    def make():
        segments = rfm.rfm_quintile_segments(rfm.rfm_orders(s.orders))
        return stage(churn.campaign_list(s.orders, _scored(s), segments), "campaign-by-rule")

    return _once(s, "campaign_by_rule", make)


@query("campaign_list_by_rule", sql(f"SELECT {_LISTED} FROM cls", **RULE), digits=3)
def _(s):
    return _listed(s)


@query("campaign_sample_by_rule", sql(f"SELECT {_LISTED} FROM csm", **RULE), digits=3)
def _(s):
    return churn.campaign_sample(_listed(s))


@query(
    "campaign_kpis_by_rule",
    sql("""SELECT round(al, 2) AS actual_lost, cc AS campaign_cost, round(vs, 2) AS value_saved, round(rs, 2) AS revenue_saved, lr AS last_year_revenue, round(vs / lr * 100, 2) AS saved_percent_of_year,
 round(rs / nullif(al, 0), 2) AS revenue_share_of_lost, round(rs / lr, 2) AS revenue_share_of_year, round(vs / nullif(al, 0), 2) AS value_share_of_lost, round(rs / nullif(cc, 0), 2) AS roi FROM
 (SELECT COALESCE(sum(lost / proba) FILTER (WHERE churn = 1), 0.0) AS al, count(*) * 500 AS cc FROM cls),
 (SELECT COALESCE(sum(lost), 0.0) AS vs, COALESCE(sum(lost / proba) FILTER (WHERE churn = 1), 0.0) AS rs FROM csm), (SELECT sum(total_cents)::BIGINT AS lr FROM cyr)""", **RULE),
    digits=2,
)
def _(s):
    return churn.campaign_kpis(s.orders, _listed(s), churn.campaign_sample(_listed(s)))


def _class(one: int) -> str:
    hit = f"a = {one} AND b = {one}"
    return f"""SELECT {one} AS class, round(tp::DOUBLE / nullif(tp + fp, 0), 6) AS precision, round(tp::DOUBLE / nullif(tp + fn, 0), 6) AS recall, round(2.0 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1, tp + fn AS support FROM
 (SELECT COALESCE(sum(n) FILTER (WHERE {hit}), 0)::BIGINT AS tp, COALESCE(sum(n) FILTER (WHERE a <> {one} AND b = {one}), 0)::BIGINT AS fp, COALESCE(sum(n) FILTER (WHERE a = {one} AND b <> {one}), 0)::BIGINT AS fn FROM crl)"""


@query(
    "class_report_by_rule",
    sql(f"{_class(1)} UNION ALL {_class(0)}", **FEATURES, crl="SELECT churn AS a, CAST(recency > 20 AS INTEGER) AS b, count(*) AS n FROM cf GROUP BY 1, 2"),
)
def _(s):
    return churn.class_report(churn.confusion(_features(s), F.col("recency") > 20))


@query(
    "probability_histogram_by_rule",
    sql("""SELECT 'proba' AS metric, CAST(bin AS INTEGER) AS bin, round(lo + bin * w, 6) AS bin_start, COALESCE(c, 0) AS count, round(COALESCE(c, 0) / (n * w), 6) AS density FROM
 (SELECT min(proba) AS lo, (max(proba) - min(proba)) / 30 AS w, count(*) AS n FROM chr), range(0, 30) bs(bin)
 LEFT JOIN (SELECT CAST(least(floor((proba - lo) / w), 29) AS BIGINT) AS bin, count(*) AS c FROM chr, (SELECT min(proba) AS lo, (max(proba) - min(proba)) / 30 AS w FROM chr) GROUP BY 1) USING (bin)""", **RULE),
)
def _(s):
    return rfm.histogram(_scored(s), ["proba"], 30)
