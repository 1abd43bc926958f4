"""Churn features, models, their measures, and the campaign list made from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.calendar import whole_days
from orderloom.operators.joins import join_on
from orderloom.operators.ordering import with_prefix
from orderloom.operators.sampling import exact_sample, in_train_part
from orderloom.scratch import stage

# Year ends that split the training windows, the days watched for churn,
# the recency up to which customers are scored, and (in _periods) the nine windows.
SPLITS = ("2020-12-31", "2021-12-31")
WATCH_DAYS = 60
MAX_RECENCY = 40
FEATURES = ["recency", "frequency", "monetary"]
POSITIVE_WEIGHT = 0.5
TASK_ROWS = 2_000_000  # rows that a task of the boosted models keeps, about 200 MB
TEST = "test"


def _periods(splits: tuple[str, str]) -> Column:
    """Eight training windows and the test window from the first and last order time."""
    first, last = F.col("_first"), F.col("_last")
    one, two = (F.lit(day).cast("timestamp_ntz") for day in splits)
    year = F.expr("INTERVAL 365 DAYS")
    windows = [
        ("p1", first, one),
        ("p2", one, two),
        ("p3", two, last),
        ("p4", first, two),
        ("p5", one, last),
        ("p6", first, first + year),
        ("p7", last - year, last),
        ("p8", first + year, last - year),
        (TEST, first, last),
    ]
    return F.array(
        *[
            F.struct(F.lit(name).alias("period"), low.alias("low"), high.alias("high"))
            for name, low, high in windows
        ]
    )


def churn_features(
    orders: DataFrame, splits: tuple[str, str] = SPLITS, days: int = WATCH_DAYS
) -> DataFrame:
    """Recency, frequency, money before the last days of each window, churn in them.

    Both ends of both parts are inclusive: an order at the boundary is in both.  Each
    order is repeated for the windows it falls in and combined per customer before the
    shuffle.
    """
    span = orders.agg(F.min("date_created").alias("_first"), F.max("date_created").alias("_last"))
    slim = orders.select("customer_id", "date_created", "total_cents")
    ts = F.col("date_created")
    inside = F.filter(
        _periods(splits), lambda p: (ts >= p["low"]) & (ts <= p["high"])
    )
    tagged = slim.crossJoin(F.broadcast(span)).select(
        "customer_id", "date_created", "total_cents", F.inline(inside)
    )
    mark = F.col("high") - F.expr(f"INTERVAL {days} DAYS")
    early, watched = ts <= mark, ts >= mark
    customers = (
        tagged.groupBy("period", "customer_id")
        .agg(
            F.max(F.when(early, ts)).alias("_latest"),
            F.count_if(early).alias("frequency"),
            F.sum(F.when(early, F.col("total_cents"))).alias("monetary"),
            F.count_if(watched).alias("_watched"),
        )
        .where("frequency > 0")
    )
    customers = stage(customers, "windows")  # read for the ends and the result
    # one row per window
    newest = customers.groupBy("period").agg(F.max("_latest").alias("_newest"))
    recency = whole_days(F.col("_latest"), F.col("_newest"))
    return customers.join(F.broadcast(newest), "period").select(
        "period",
        "customer_id",
        recency.alias("recency"),
        "frequency",
        "monetary",
        F.when(F.col("_watched") > 0, 0).otherwise(1).alias("churn"),
    )


def model_rows(features: DataFrame, max_recency: int = MAX_RECENCY) -> DataFrame:
    return features.where(F.col("recency") < max_recency)


def training_rows(features: DataFrame) -> DataFrame:
    """Training windows with a repeatable 80/20 split and class weights."""
    key = F.concat_ws("/", "period", "customer_id")
    return (
        model_rows(features)
        .where(F.col("period") != TEST)
        .withColumn("is_validation", ~in_train_part(key))
        .withColumn("weight", F.when(F.col("churn") == 1, POSITIVE_WEIGHT).otherwise(1.0))
    )


def test_rows(features: DataFrame) -> DataFrame:
    return model_rows(features).where(F.col("period") == TEST)


def _pipeline(classifier) -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=FEATURES, outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
            classifier,
        ]
    )


@dataclass(frozen=True)
class Boosting:
    """``patience``: rounds without a gain on the validation rows after which the search for
    the best length ends; None keeps all rounds."""

    rounds: int = 20
    rate: float = 0.05
    depth: int = 5
    patience: int | None = 10


AUC_MODEL = Boosting()
VALUE_MODEL = Boosting(rounds=100, rate=0.01, depth=7, patience=None)


def best_length(losses: list[float], patience: int) -> int:
    """Number of rounds with the least loss seen before ``patience`` rounds without gain."""
    best = 0
    for at, loss in enumerate(losses):
        if loss < losses[best]:
            best = at
        elif at - best >= patience:
            break
    return best + 1


def _few_tasks(rows: DataFrame) -> DataFrame:
    """The rows in a task per core, or more where a task would hold too many.

    Each round sends the sums of all bins from every task at each level of its tree, so
    what is shuffled grows with the tasks, not with the rows.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.coalesce(max(cores, -(-rows.count() // TASK_ROWS)))


def fit_boosted(rows: DataFrame, setting: Boosting = AUC_MODEL, seed: int = 42) -> PipelineModel:
    """Boosted trees on the rows that are not for validation.

    With patience, all rounds are fitted, the loss after each round is taken on the
    validation rows, and the model is fitted again with the best number of rounds.
    """
    train = _few_tasks(rows.where(~F.col("is_validation")))

    def fit(rounds: int) -> PipelineModel:
        return _pipeline(
            GBTClassifier(
                labelCol="churn",
                weightCol="weight",
                maxIter=rounds,
                stepSize=setting.rate,
                maxDepth=setting.depth,
                maxBins=64,
                seed=seed,
            )
        ).fit(train)

    model = fit(setting.rounds)
    if setting.patience is None:
        return model
    held = rows.where("is_validation")
    if held.isEmpty():
        return model
    prepared = PipelineModel(model.stages[:-1]).transform(held)
    length = best_length(model.stages[-1].evaluateEachIteration(prepared), setting.patience)
    return model if length == setting.rounds else fit(length)


def boosting_length(
    model: PipelineModel, name: str, setting: Boosting, held: DataFrame
) -> DataFrame:
    """One row: rounds asked for, trees held, and the loss on held-out rows after the first
    and after the last of them."""
    prepared = PipelineModel(model.stages[:-1]).transform(held)
    losses = [float(x) for x in model.stages[-1].evaluateEachIteration(prepared)]
    schema = "model string, rounds int, trees int, first_loss double, last_loss double"
    row = (name, setting.rounds, model.stages[-1].getNumTrees, losses[0], losses[-1])
    return held.sparkSession.createDataFrame([row], schema)


def fit_forest(rows: DataFrame, trees: int = 20, seed: int = 42) -> PipelineModel:
    return _pipeline(RandomForestClassifier(labelCol="churn", numTrees=trees, seed=seed)).fit(
        rows.where(~F.col("is_validation"))
    )


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with the churn probability; ids stay with their row."""
    scored = model.transform(rows)
    probability = vector_to_array("probability")[1]
    return scored.withColumn("proba", probability).select(*rows.columns, "proba")


def feature_importance(model: PipelineModel, spark) -> DataFrame:
    values = [float(v) for v in model.stages[-1].featureImportances.toArray()]
    schema = T.StructType(
        [T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())]
    )
    return spark.createDataFrame(list(zip(FEATURES, values)), schema)


def confusion(scored: DataFrame, predicted: Column, label: str = "churn") -> DataFrame:
    return scored.groupBy(
        F.col(label).cast("int").alias("actual"), predicted.cast("int").alias("predicted")
    ).agg(F.count("*").alias("count"))


def binary_report(counts: DataFrame) -> DataFrame:
    """One row of measures from confusion counts."""

    def cell(actual: int, predicted: int) -> Column:
        hit = (F.col("actual") == actual) & (F.col("predicted") == predicted)
        return F.coalesce(F.sum(F.when(hit, F.col("count"))), F.lit(0))

    row = counts.agg(
        cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(0, 0).alias("tn")
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    zero = F.lit(0.0)
    return row.select(
        "tp",
        "fp",
        "fn",
        "tn",
        F.coalesce(F.try_divide(tp + tn, tp + fp + fn + tn), zero).alias("accuracy"),
        F.coalesce(F.try_divide(tp, tp + fp), zero).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), zero).alias("f1"),
    )


def class_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of each class."""
    one = binary_report(counts).withColumn("class", F.lit(1))
    flipped = counts.select(
        (1 - F.col("actual")).alias("actual"), (1 - F.col("predicted")).alias("predicted"), "count"
    )
    zero = binary_report(flipped).withColumn("class", F.lit(0))
    return (
        one.unionByName(zero)
        .withColumn("support", F.col("tp") + F.col("fn"))
        .select("class", "precision", "recall", "f1", "support")
    )


def roc_auc(scored: DataFrame, value: str = "proba", label: str = "churn") -> DataFrame:
    """Chance that a churned customer scores above a kept one, ties as half."""
    by_score = scored.groupBy(value).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum(1 - F.col(label).cast("long")).alias("neg")
    )
    below = with_prefix(by_score, [value], {"neg_below": "neg"}, "auc")
    wins = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2))
    return below.agg(F.try_divide(wins, F.sum("pos") * F.sum("neg")).alias("roc_auc"))


@dataclass(frozen=True)
class Campaign:
    cost: int = 500
    success: float = 0.3
    min_days: int = 10


def _last_year(orders: DataFrame, days: int = WATCH_DAYS) -> DataFrame:
    """Orders of the year that ends before the watched days."""
    latest = orders.agg(F.max("date_created").alias("_last"))
    ts = F.col("date_created")
    low = F.col("_last") - F.expr(f"INTERVAL {365 + days} DAYS")
    high = F.col("_last") - F.expr(f"INTERVAL {days} DAYS")
    return orders.crossJoin(F.broadcast(latest)).where((ts >= low) & (ts <= high))


def expected_losses(orders: DataFrame, scored: DataFrame) -> DataFrame:
    """Scored customers with lifetimes, last year's money and the expected loss."""

    def days() -> Column:
        return whole_days(F.min("date_created"), F.max("date_created")) + 1

    total = orders.groupBy("customer_id").agg(days().alias("lifetime_days_total"))
    year = _last_year(orders).groupBy("customer_id").agg(
        F.sum("total_cents").alias("total"), days().alias("lifetime_days_last_year")
    )
    joined = join_on(
        join_on(scored, total, "customer_id", "left"), year, "customer_id", "left"
    )
    loss = F.col("total") * F.col("proba") * 365 / F.col("lifetime_days_last_year")
    return joined.withColumn("expected_value_lost", loss)


def campaign_list(
    orders: DataFrame, scored: DataFrame, segments: DataFrame, plan: Campaign = Campaign()
) -> DataFrame:
    """Customers worth a campaign: long enough with the shop, loss above its price."""
    worth = F.col("expected_value_lost") > plan.cost / plan.success
    listed = expected_losses(orders, scored).where(
        (F.col("lifetime_days_last_year") > plan.min_days) & worth
    )
    return join_on(listed, segments.select("customer_id", "segment"), "customer_id", "left")


def campaign_sample(listed: DataFrame, plan: Campaign = Campaign(), seed: int = 42) -> DataFrame:
    return exact_sample(listed, "customer_id", plan.success, seed)


def campaign_kpis(
    orders: DataFrame, listed: DataFrame, selected: DataFrame, plan: Campaign = Campaign()
) -> DataFrame:
    """One row: losses, the part won back, cost and return of the campaign."""
    churned = F.col("churn") == 1
    value = F.col("expected_value_lost") / F.col("proba")
    at_stake = listed.agg(
        F.coalesce(F.sum(F.when(churned, value)), F.lit(0.0)).alias("actual_lost"),
        (F.count("*") * plan.cost).alias("campaign_cost"),
    )
    won = selected.agg(
        F.coalesce(F.sum("expected_value_lost"), F.lit(0.0)).alias("value_saved"),
        F.coalesce(F.sum(F.when(churned, value)), F.lit(0.0)).alias("revenue_saved"),
    )
    year = _last_year(orders).agg(F.sum("total_cents").alias("last_year_revenue"))
    row = at_stake.crossJoin(F.broadcast(won)).crossJoin(F.broadcast(year))
    return row.select(
        "*",
        (F.try_divide("value_saved", "last_year_revenue") * 100).alias("saved_percent_of_year"),
        F.try_divide("revenue_saved", "actual_lost").alias("revenue_share_of_lost"),
        F.try_divide("revenue_saved", "last_year_revenue").alias("revenue_share_of_year"),
        F.try_divide("value_saved", "actual_lost").alias("value_share_of_lost"),
        F.try_divide("revenue_saved", "campaign_cost").alias("roi"),
    )
