"""Two-level k-means over traffic profiles. Nothing is collected but centres and scores."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.operators import lloyd
from secflow.operators.profile import APP_FEATURES, FLOW_FEATURES, subcluster_features

# Candidate cluster counts and iterations.
CANDIDATES = (5,)
MAX_ITERATIONS = 100
SEED = 1


def assemble(features: DataFrame, names: list[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=names, outputCol=output).transform(features)


def fit(points: DataFrame, k: int, features: str = "features", iterations: int = MAX_ITERATIONS) -> KMeansModel:
    return KMeans(k=k, maxIter=iterations, seed=SEED, featuresCol=features, predictionCol="cluster").fit(points)


def first_level(features: DataFrame, candidates=CANDIDATES, iterations: int = MAX_ITERATIONS) -> DataFrame:
    """Clusters of addresses by traffic profile, with the count of the best silhouette."""
    points = lloyd.group_points(features, FLOW_FEATURES)
    width = len(FLOW_FEATURES)
    return lloyd.label(points, lloyd.best_groups(points, width, candidates, iterations), width).drop("parent")


def first_level_centres(features: DataFrame, candidates=CANDIDATES, iterations: int = MAX_ITERATIONS) -> DataFrame:
    """(parent, k, centres) that ``first_level`` assigns by; parent is 0."""
    points = lloyd.group_points(features, FLOW_FEATURES)
    return lloyd.best_groups(points, len(FLOW_FEATURES), candidates, iterations)


def second_level(
    app_flows: DataFrame, members: DataFrame, candidates=CANDIDATES, iterations: int = MAX_ITERATIONS,
) -> DataFrame:
    """Clusters by application profile inside each first-level cluster large enough for one.

    All first-level clusters are fitted in the same jobs; each is scaled, and gets its count, by itself.
    """
    points = lloyd.group_points(subcluster_features(app_flows, members), APP_FEATURES, "cluster")
    width = len(APP_FEATURES)
    return lloyd.label(points, lloyd.best_groups(points, width, candidates, iterations), width)


def second_level_centres(
    app_flows: DataFrame, members: DataFrame, candidates=CANDIDATES, iterations: int = MAX_ITERATIONS,
) -> DataFrame:
    """(parent, k, centres) that ``second_level`` assigns by."""
    points = lloyd.group_points(subcluster_features(app_flows, members), APP_FEATURES, "cluster")
    return lloyd.best_groups(points, len(APP_FEATURES), candidates, iterations)


def best_by_cost(points: DataFrame, most: int) -> tuple[int, KMeansModel]:
    """Model at the elbow of the within-cluster cost among 2..most clusters.

    Cost falls with every further cluster; the elbow is the count whose cost lies farthest below the
    straight line from one cluster to ``most``. With most = 2 that is 2.
    """
    scored = {k: fit(points, k) for k in range(2, most + 1)}
    cost = {k: model.summary.trainingCost for k, model in scored.items()}
    spread = points.select(Summarizer.metrics("variance", "count").summary(F.col("features")).alias("s")).first()["s"]
    cost[1] = float(sum(spread["variance"])) * max(spread["count"] - 1, 0)
    line = lambda k: cost[1] + (cost[most] - cost[1]) * (k - 1) / max(most - 1, 1)
    best = max(range(2, most + 1), key=lambda k: (line(k) - cost[k], -k))
    return best, scored[best]


def silhouette_table(features: DataFrame, candidates, iterations: int = MAX_ITERATIONS) -> DataFrame:
    """Silhouette and cost of every candidate count."""
    points = lloyd.group_points(features, FLOW_FEATURES)
    width = len(FLOW_FEATURES)
    state = lloyd.fit_groups(points, width, candidates, iterations)
    return lloyd.group_scores(points, state, width).select("k", "silhouette", "cost")


def point_rows(points: DataFrame, names: list[str], batch: str, time: str) -> DataFrame:
    """Stored form of clustered points: features joined by ``#``."""
    return points.select(
        F.lit(batch).alias("clno"), F.col("ip").alias("name"), F.col("cluster").cast("string").alias("center_index"),
        "distance", F.concat_ws("#", *[F.col(n).cast("string") for n in names]).alias("center_info"),
        F.lit(time).alias("cltime"), F.lit("#".join(names)).alias("demo"))


def centre_rows(
    spark, model: KMeansModel, names: list[str], batch: str, time: str, level: int,
    parent: int | None = None, parent_batch: str | None = None,
) -> DataFrame:
    """Stored form of cluster centres; level 2 names its parent cluster and batch."""
    rows = [
        (str(i), "#".join(str(float(x)) for x in c), batch, level, time, "#".join(names),
         None if parent is None else str(parent), parent_batch)
        for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(
        rows, "center_index string, center_info string, clno string, type int, cltime string, demo string,"
              " center_index_p string, clno_p string")


def centre_docs(
    state: DataFrame, names: list[str], batch: str, time: str, level: int, parent_batch: str | None = None,
) -> DataFrame:
    """Stored form of (parent, k, centres): a row per centre; only level 2 names its parent and batch."""
    rows = state.select("parent", F.posexplode("centres").alias("at", "centre"))
    parent = F.col("parent").cast("string") if level > 1 else F.lit(None).cast("string")
    return rows.select(
        F.col("at").cast("string").alias("center_index"),
        F.array_join(F.transform("centre", lambda x: x.cast("string")), "#").alias("center_info"),
        F.lit(batch).alias("clno"), F.lit(level).alias("type"), F.lit(time).alias("cltime"),
        F.lit("#".join(names)).alias("demo"), parent.alias("center_index_p"),
        F.lit(parent_batch).cast("string").alias("clno_p"))
