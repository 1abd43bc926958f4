"""Customer clusters on transformed recency, frequency and money."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.transforms import best_lambdas, boxcox, positive
from orderloom.plans.rfm import METRICS
from orderloom.scratch import stage

SEED = 42


def transformed(rfm: DataFrame) -> DataFrame:
    """Cube root of recency, power transforms of frequency and money."""
    # the rounds read a written copy; the result keeps the order of its rows, as clusters start from it
    powers = best_lambdas(stage(rfm.select("frequency", "monetary"), "powers"), ["frequency", "monetary"])
    return rfm.select(
        "*",
        F.cbrt(F.col("recency").cast("double")).alias("recency_t"),
        boxcox(positive(F.col("frequency")), powers["frequency"]).alias("frequency_t"),
        boxcox(positive(F.col("monetary")), powers["monetary"]).alias("monetary_t"),
    )


def scale(features: DataFrame) -> DataFrame:
    """Add the standardised feature vector ``scaled``."""
    columns = [f"{metric}_t" for metric in METRICS]
    steps = Pipeline(
        stages=[
            VectorAssembler(inputCols=columns, outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
        ]
    )
    return steps.fit(features).transform(features).drop("raw")


def fit_clusters(scaled: DataFrame, k: int = 3, seed: int = SEED) -> PipelineModel:
    return KMeans(k=k, seed=seed, featuresCol="scaled", predictionCol="cluster").fit(scaled)


def assign_clusters(scaled: DataFrame, k: int = 3, seed: int = SEED) -> DataFrame:
    """Cluster numbers ordered by recency of the centre, so they mean the same each run."""
    model = fit_clusters(scaled, k, seed)
    centres = [list(map(float, centre)) for centre in model.clusterCenters()]
    order = sorted(range(len(centres)), key=lambda i: -centres[i][0])
    rank = F.create_map(*[F.lit(x) for i, c in enumerate(order) for x in (c, i)])
    return model.transform(scaled).withColumn("cluster", rank[F.col("cluster")])


def nearest_centres(scaled: DataFrame, centres: Sequence[Sequence[float]]) -> DataFrame:
    """Cluster numbers by given centres, ties to the first, and the ``distance``."""
    vector = vector_to_array("scaled")
    gaps = F.array(*[_distance(vector, list(map(float, c))) for c in centres])
    nearest = scaled.withColumn("_gaps", gaps).withColumn("distance", F.array_min("_gaps"))
    at = F.array_position("_gaps", F.col("distance")).cast("int") - 1
    return nearest.withColumn("cluster", at).drop("_gaps")


def inertia(clustered: DataFrame) -> DataFrame:
    """Sum of squared distances and mean distance to the nearest centre."""
    return clustered.agg(
        F.sum(F.col("distance") * F.col("distance")).alias("inertia"),
        F.avg("distance").alias("mean_distance"),
    )


def _distance(vector: Column, centre: list[float]) -> Column:
    gaps = F.zip_with(vector, F.array(*[F.lit(c) for c in centre]), lambda a, b: (a - b) * (a - b))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g))


def elbow_scan(
    scaled: DataFrame, k_max: int = 19, seed: int = SEED, parallelism: int = 6
) -> DataFrame:
    """Inertia and mean distance to the nearest centre for 1 .. k_max clusters.

    ``scaled`` should be a staged table: every k is a fit over it.  Some fits run at the
    same time, as in model selection; all distances are then one aggregation.
    """
    vector = vector_to_array("scaled")
    dims = range(len(METRICS))
    kept = scaled.select("scaled").persist()
    try:
        # one cluster is the mean of all rows; the library starts at two
        means = kept.agg(*[F.avg(vector[i]).alias(f"m{i}") for i in dims]).first()
        centres = {1: [[means[f"m{i}"] for i in dims]]}


        def fitted(k: int) -> list[list[float]]:
            model = fit_clusters(kept, k, seed)
            return [list(map(float, c)) for c in model.clusterCenters()]

        with ThreadPool(parallelism) as pool:
            sizes = range(2, k_max + 1)
            work = inheritable_thread_target(scaled.sparkSession)(fitted)
            centres.update(zip(sizes, pool.map(work, sizes)))
        nearest = {
            k: F.array_min(F.array(*[_distance(vector, c) for c in found]))
            for k, found in centres.items()
        }
        distances = kept.select(*[d.alias(f"d{k}") for k, d in nearest.items()])
        sums = distances.agg(
            *[F.sum(F.col(f"d{k}") * F.col(f"d{k}")).alias(f"i{k}") for k in nearest],
            *[F.avg(f"d{k}").alias(f"a{k}") for k in nearest],
        ).first()
    finally:
        kept.unpersist()
    rows = [(k, float(sums[f"i{k}"]), float(sums[f"a{k}"])) for k in nearest]
    schema = T.StructType(
        [
            T.StructField("k", T.IntegerType()),
            T.StructField("inertia", T.DoubleType()),
            T.StructField("mean_distance", T.DoubleType()),
        ]
    )
    return scaled.sparkSession.createDataFrame(rows, schema)


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Means, size and share of each cluster, and its means relative to all customers."""
    means = clustered.groupBy("cluster").agg(
        F.count("*").alias("count"), *[F.avg(m).alias(f"mean_{m}") for m in METRICS]
    )
    overall = clustered.agg(F.count("*").alias("_n"), *[F.avg(m).alias(f"_{m}") for m in METRICS])
    joined = means.crossJoin(F.broadcast(overall))
    return joined.select(
        "cluster",
        "count",
        F.round(F.col("count") / F.col("_n") * 100, 1).alias("percent"),
        *[F.col(f"mean_{m}") for m in METRICS],
        *[(F.col(f"mean_{m}") / F.col(f"_{m}") - 1).alias(f"relative_{m}") for m in METRICS],
    )


def attribute_means(clustered: DataFrame) -> DataFrame:
    """Mean standardised value of each attribute per cluster, in long form."""
    parts = vector_to_array("scaled")
    wide = clustered.select("customer_id", "cluster", *[parts[i].alias(m) for i, m in enumerate(METRICS)])
    long = wide.unpivot(["customer_id", "cluster"], list(METRICS), "attribute", "value")
    return long.groupBy("cluster", "attribute").agg(F.avg("value").alias("mean_value"))
