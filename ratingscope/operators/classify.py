"""Four critic/audience classes by standardised k-means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.pipeline import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import small_table
from ..workdir import materialized

# Clusters, seed and the rating that counts as high.
CLUSTERS = 4
SEED = 42
HIGH = 60.0

# Pieces that the points are dealt into for k-means, and points of a piece beyond these.
PIECES, PIECE_POINTS = 16, 100_000

CRITIC = "rt_tomatometer_rating"
AUDIENCE = "rt_audience_rating"


def rating_quadrant(critic: Column, audience: Column, high: float = HIGH) -> Column:
    """The class name of a pair of ratings."""
    return F.concat(
        F.when(critic >= high, "high_tomatometer_").otherwise("low_tomatometer_"),
        F.when(audience >= high, "high_audience").otherwise("low_audience"),
    )


def feature_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with mean and sample standard deviation of each column."""
    return df.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.stddev_samp(c).alias(f"std_{c}") for c in columns],
    )


def _scaled(df: DataFrame, columns: Sequence[str], mean: list[float], std: list[float]) -> DataFrame:
    # A constant column scales to zero.
    return df.withColumns(
        {f"_scaled_{i}": (F.col(c) - mean[i]) / std[i] if std[i] else F.lit(0.0)
         for i, c in enumerate(columns)}
    )


def _weighted_stats(points: DataFrame, columns: Sequence[str]) -> tuple[list[float], list[float]]:
    """Mean and sample standard deviation of the rows that the weighted points stand for.

    Deviations are summed around a first guess, the plain mean of the points, so that
    large values do not cancel. The guess is a whole number: sums over whole ratings are then
    exact, in whatever order tasks end.
    """
    guess = points.agg(*[F.avg(c).alias(c) for c in columns]).first()
    shift = {c: float(round(guess[c] or 0.0)) for c in columns}
    weight = F.col("_weight")
    sums = points.agg(
        F.sum(weight).alias("_n"),
        *[F.sum(weight * (F.col(c) - shift[c])).alias(f"_s{i}") for i, c in enumerate(columns)],
        *[F.sum(weight * (F.col(c) - shift[c]) ** 2).alias(f"_q{i}") for i, c in enumerate(columns)],
    ).first()
    n = sums["_n"] or 0.0
    mean, std = [], []
    for i, c in enumerate(columns):
        off = (sums[f"_s{i}"] or 0.0) / n if n else 0.0
        spread = (sums[f"_q{i}"] or 0.0) - n * off * off
        mean.append(shift[c] + off)
        std.append(max(spread / (n - 1), 0.0) ** 0.5 if n > 1 else 0.0)
    return mean, std


def fit_classes(
    df: DataFrame, columns: Sequence[str], k: int = CLUSTERS, seed: int = SEED, work_dir: str | None = None
) -> tuple[PipelineModel, list[float], list[float]]:
    """Fitted assembler + k-means on the standardised columns, with means and deviations.

    Equal rating pairs are folded to one weighted point first: ratings of 0 to 100
    give at most 10,201 points, whatever the number of movies. ``df`` is read once; the
    statistics and the rounds of k-means read the points, which are written.

    Spark draws the start of k-means from each partition by its number and the order of its
    rows. So the points are dealt by their hash into pieces whose number depends on the points
    alone, and sorted in each: the same table gives the same clusters, with the same numbers,
    however its rows are spread and whatever the size of the cluster.
    """
    points = df.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("_weight"))
    points = materialized(points, "rating-points", work_dir)
    mean, std = _weighted_stats(points, columns)
    assembler = VectorAssembler(
        inputCols=[f"_scaled_{i}" for i in range(len(columns))], outputCol="_features"
    )
    kmeans = KMeans(
        k=k, seed=seed, featuresCol="_features", predictionCol="cluster_id", weightCol="_weight"
    )
    pieces = max(PIECES, -(-points.count() // PIECE_POINTS))
    placed = points.repartition(pieces, *columns).sortWithinPartitions(*columns)
    model = Pipeline(stages=[assembler, kmeans]).fit(_scaled(placed, columns, mean, std))
    return model, mean, std


def cluster_table(
    spark: SparkSession, model: PipelineModel, mean: Sequence[float], std: Sequence[float], high: float = HIGH
) -> DataFrame:
    """``cluster_id, critic_center, audience_center, category``: centers in rating units, k rows."""
    kmeans: KMeansModel = model.stages[-1]
    centers = [
        (i, *[float(c[j]) * std[j] + mean[j] for j in range(2)])
        for i, c in enumerate(kmeans.clusterCenters())
    ]
    table = small_table(spark, centers, "cluster_id int, critic_center double, audience_center double")
    return table.withColumn("category", rating_quadrant(F.col("critic_center"), F.col("audience_center"), high))


def classify_with_clusters(
    df: DataFrame,
    critic: str = CRITIC,
    audience: str = AUDIENCE,
    *,
    high: float = HIGH,
    k: int = CLUSTERS,
    seed: int = SEED,
    keep_cluster: bool = False,
    work_dir: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`classify_ratings` and the :func:`cluster_table` of the same model."""
    rated = df.where(F.col(critic).isNotNull() & F.col(audience).isNotNull())
    columns = [critic, audience]
    model, mean, std = fit_classes(rated, columns, k, seed, work_dir)
    clusters = cluster_table(df.sparkSession, model, mean, std, high)
    names = clusters.select("cluster_id", "category")
    # One row per cluster, k in all.
    out = model.transform(_scaled(rated, columns, mean, std)).join(F.broadcast(names), "cluster_id")
    return out.select(*df.columns, *(["cluster_id"] if keep_cluster else []), "category"), clusters


def classify_ratings(df: DataFrame, critic: str = CRITIC, audience: str = AUDIENCE, **options) -> DataFrame:
    """Rows with both ratings, plus ``category``: the quadrant of their cluster's center.

    Several clusters may fall into one quadrant. ``keep_cluster`` adds ``cluster_id``;
    options as in :func:`classify_with_clusters`.
    """
    return classify_with_clusters(df, critic, audience, **options)[0]
