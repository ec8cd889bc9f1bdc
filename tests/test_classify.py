import random

import pytest
from pyspark.sql import functions as F

from ratingscope.operators import classify_ratings, classify_with_clusters, feature_stats, fit_classes, rating_quadrant

CENTERS = {"high_high": (90, 85), "high_low": (85, 25), "low_high": (20, 80), "low_low": (15, 20)}
NAMES = {
    "high_high": "high_tomatometer_high_audience", "high_low": "high_tomatometer_low_audience",
    "low_high": "low_tomatometer_high_audience", "low_low": "low_tomatometer_low_audience",
}


def movies(spark, n=400):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        kind = rng.choice(list(CENTERS))
        c, a = CENTERS[kind]
        rows.append((f"t{i}", kind, c + rng.randint(-9, 9), a + rng.randint(-9, 9)))
    rows += [("n1", "none", None, 50), ("n2", "none", 50, None)]
    return spark.createDataFrame(rows, "imdb_id string, kind string, rt_tomatometer_rating int, rt_audience_rating int")


@pytest.mark.parametrize(
    ("critic", "audience", "name"),
    [(60, 60, "high_high"), (60, 59.9, "high_low"), (59, 60, "low_high"), (0, 0, "low_low")],
)
def test_quadrant(spark, critic, audience, name):
    row = spark.range(1).select(rating_quadrant(F.lit(critic), F.lit(audience)).alias("q")).first()
    assert row.q == NAMES[name]


def test_four_clear_groups(spark):
    df = movies(spark)
    got = classify_ratings(df)
    assert got.columns == df.columns + ["category"]
    rows = got.collect()
    assert len(rows) == 400
    assert all(r.category == NAMES[r.kind] for r in rows)


def test_same_seed_same_result(spark):
    df = movies(spark)
    first, second = (
        sorted(map(tuple, classify_ratings(df, keep_cluster=True).collect())) for _ in range(2)
    )
    assert first == second


def test_each_row_is_at_its_nearest_center(spark):
    df = movies(spark).dropna()
    columns = ["rt_tomatometer_rating", "rt_audience_rating"]
    model, mean, std = fit_classes(df, columns)
    centers = model.stages[-1].clusterCenters()
    for r in classify_ratings(df, keep_cluster=True).collect():
        point = [(r[c] - mean[i]) / std[i] for i, c in enumerate(columns)]
        distances = [sum((p - q) ** 2 for p, q in zip(point, c)) for c in centers]
        assert distances[r.cluster_id] == pytest.approx(min(distances))


def test_folding_equal_points_keeps_the_centers(spark):
    """Centers of the weighted points are the means of the rows assigned to them."""
    df = movies(spark).dropna()
    columns = ["rt_tomatometer_rating", "rt_audience_rating"]
    model, mean, std = fit_classes(df, columns)
    centers = model.stages[-1].clusterCenters()
    means = classify_ratings(df, keep_cluster=True).groupBy("cluster_id").agg(*[F.avg(c).alias(c) for c in columns])
    for r in means.collect():
        for i, c in enumerate(columns):
            assert centers[r.cluster_id][i] * std[i] + mean[i] == pytest.approx(r[c])


def test_stats_equal_the_scaler(spark):
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    df = movies(spark).dropna()
    columns = ["rt_tomatometer_rating", "rt_audience_rating"]
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(df)
    scaler = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True).fit(vectors)
    stats = feature_stats(df, columns).first()
    assert list(scaler.mean) == pytest.approx([stats[f"mean_{c}"] for c in columns])
    assert list(scaler.std) == pytest.approx([stats[f"std_{c}"] for c in columns])


def test_a_constant_rating(spark):
    df = movies(spark).withColumn("rt_audience_rating", F.lit(70)).where("rt_tomatometer_rating is not null")
    names = {r.category for r in classify_ratings(df).collect()}
    assert names == {"high_tomatometer_high_audience", "low_tomatometer_high_audience"}


def test_clusters_name_the_rows(spark):
    df = movies(spark)
    rows, clusters = classify_with_clusters(df, keep_cluster=True)
    names = {r.cluster_id: r.category for r in clusters.collect()}
    assert len(names) == 4
    assert all(names[r.cluster_id] == r.category for r in rows.collect())


def test_statistics_from_weighted_points(spark):
    df = movies(spark).dropna()
    columns = ["rt_tomatometer_rating", "rt_audience_rating"]
    _, mean, std = fit_classes(df, columns)
    stats = feature_stats(df, columns).first()
    assert mean == pytest.approx([stats[f"mean_{c}"] for c in columns])
    assert std == pytest.approx([stats[f"std_{c}"] for c in columns])


def test_clusters_do_not_depend_on_the_partitioning(spark):
    """Overlapping groups, where another start ends in other clusters."""
    rng = random.Random(11)
    centers = [(55, 60), (62, 48), (48, 45), (66, 66), (40, 62)]
    rows = []
    for i in range(4000):
        c, a = centers[i % 5]
        rows.append((i, min(100, max(0, round(rng.gauss(c, 12)))), min(100, max(0, round(rng.gauss(a, 12))))))
    df = spark.createDataFrame(rows, "id int, rt_tomatometer_rating int, rt_audience_rating int")
    got = {}
    for n in (1, 4, 16):
        spread = df.repartition(n, F.xxhash64("id", F.lit(n)))
        got[n] = {r.id: (r.cluster_id, r.category) for r in classify_ratings(spread, keep_cluster=True).collect()}
    assert got[1] == got[4] == got[16] and len({c for c, _ in got[1].values()}) == 4
