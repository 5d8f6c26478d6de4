"""Quantiles, running totals, nearest neighbours and long gaps against brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorlab.functions import groups
from sensorlab.operators import arima, detectors, fills, isolation, knn, outliers, patterns


def frame(spark, n, seed=0, hot=0.6):
    rng = random.Random(seed)
    return spark.createDataFrame(
        [("hot" if rng.random() < hot else rng.choice("abc"), i, round(rng.gauss(10, 5), 1), rng.random()) for i in range(n)],
        "g string, id bigint, v double, w double")


@pytest.mark.parametrize("accuracy", [200_000, 400])
def test_quantiles_with_a_hot_group(spark, accuracy):
    df = frame(spark, 6000)
    probs = [0.0, 0.09, 0.5, 0.91, 0.99, 1.0]
    plain = df.toPandas()
    # The small accuracy makes the large group take the bracketed way.
    got = groups.quantiles(df, ["v", "w"], probs, ["g"], accuracy).collect()
    assert len(got) == 4 * 2 * len(probs)
    for r in got:
        assert r["value"] == pytest.approx(plain[plain.g == r["g"]][r["measure"]].quantile(r["prob"]))


@pytest.mark.parametrize("ascending", [True, False])
def test_running_totals(spark, ascending):
    df = frame(spark, 2000).groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = groups.running_totals(df, "v", {"upto": "n"}, ["g"], ascending, splits=16).toPandas()
    for _, part in got.groupby("g"):
        part = part.sort_values("v", ascending=ascending)
        assert (part["n"].cumsum() == part["upto"]).all()


def test_category_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "house string")
    got = {r["house"]: r["house_code"] for r in groups.category_codes(df, "house").collect()}
    assert got == {"a": 0, "b": 1, "c": 2, None: -1}


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_lookup_joins_by_broadcast_or_shuffle(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        small = spark.range(50).selectExpr("id % 5 AS g", "id AS v").groupBy("g").agg(F.sum("v").alias("total"))
        joined = spark.range(100).selectExpr("id % 6 AS g").join(groups.lookup(small), "g", "left")
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        got = {(r["g"], r["total"]) for r in joined.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {(g, sum(range(g, 50, 5))) for g in range(5)} | {(5, None)}
    assert "parquet" in plan and "Aggregate" not in plan


def test_constant_column(spark, series):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id int, x double")
    assert [r["x"] for r in groups.standardise(df, ["x"]).collect()] == [0.0, 0.0]
    z = outliers.z_scores(series([(0, 5.0, 5.0), (1, 5.0, 5.0)])).collect()
    assert [r["temp_z_score"] for r in z] == [0.0, 0.0]


@pytest.mark.parametrize("by", [[], ["g"]])
def test_knn_join_equals_brute_force(spark, by, monkeypatch):
    monkeypatch.setattr(knn, "REF_BLOCK", 40)
    monkeypatch.setattr(knn, "TARGET_BLOCK", 30)
    monkeypatch.setattr(knn, "PIVOTS", 5)
    rng = np.random.default_rng(5)
    points = lambda n, start: [("x" if i % 3 else "y", start + i, *map(float, np.round(rng.normal(size=3), 1))) for i in range(n)]
    targets = spark.createDataFrame(points(70, 0), "g string, t bigint, a double, b double, c double")
    refs = spark.createDataFrame(points(200, 1000), "g string, r bigint, a double, b double, c double")
    got = knn.knn_join(targets, refs, ["a", "b", "c"], 4, ["t"], "r", by=by).toPandas()
    tp, rp = targets.toPandas(), refs.toPandas()
    assert len(got) == 4 * len(tp)
    for t in tp.itertuples():
        pool = rp[rp.g == t.g] if by else rp
        d2 = np.round((pool.a - t.a) ** 2 + (pool.b - t.b) ** 2 + (pool.c - t.c) ** 2, 9)
        want = pool.assign(d2=d2).sort_values(["d2", "r"]).r.head(4).tolist()
        assert got[got.t == t.t].sort_values("nth").r.tolist() == want


def test_knn_fill_small(spark):
    rows = [(1.0, 10.0), (2.0, 11.0), (9.0, 20.0), (None, 10.4), (None, None), (3.0, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, temperature double, humidity double")
    got = {r["id"]: (r["temperature"], r["humidity"]) for r in knn.fill_knn(df, k=2).collect()}
    assert got[3][0] == pytest.approx(1.5)
    assert got[4] == pytest.approx((3.75, 12.85))
    assert got[5][1] == pytest.approx(10.5)


def test_lof_finds_the_far_point(spark):
    rng = np.random.default_rng(0)
    rows = [(str(i), *map(float, rng.normal(size=2))) for i in range(60)] + [("far", 9.0, 9.0)]
    df = spark.createDataFrame(rows, "row string, a double, b double")
    detector = detectors.LocalOutlierFactor({"n_neighbors": [5, 10], "contamination": [0.05]}).fit(df, ["a", "b"])
    scored = detector.score(df).orderBy(F.desc("score")).collect()
    assert scored[0]["row"] == "far" and scored[0]["predicted"] == 1


def test_isolation_forest_ranks_the_far_point_first(spark):
    rng = np.random.default_rng(1)
    rows = [(str(i), "g", *map(float, rng.normal(size=2))) for i in range(400)] + [("far", "g", 12.0, -12.0)]
    df = spark.createDataFrame(rows, "row string, g string, a double, b double")
    scored = isolation.isolation_scores(df, ["a", "b"], F.col("row"), ["g"], trees=30).orderBy(F.desc("score"))
    first = scored.first()
    assert first["row"] == "far" and 0.5 < first["score"] < 1
    again = isolation.isolation_scores(df.repartition(5), ["a", "b"], F.col("row"), ["g"], trees=30).orderBy(F.desc("score")).first()
    assert again["score"] == pytest.approx(first["score"])


def test_single_class_gives_no_model(spark):
    from sensorlab.operators.models import train_classifier

    assert train_classifier(spark.sql("SELECT 1.0D AS a, 0 AS label"), ["a"]) is None


def test_only_outliers_in_a_cell_fall_back(spark):
    df = spark.createDataFrame(
        [("z", 1, 1, 0, 90.0, 1, 50.0, 0), ("z", 1, 1, 1, 10.0, 0, 50.0, 0), ("z", 1, 2, 0, 20.0, 0, 50.0, 0), ("z", 2, 1, 0, 99.0, 1, 50.0, 0)],
        "zone string, period int, day int, hour int, temperature double, is_temp_outlier int, humidity double, is_humi_outlier int")
    got = {(r["period"], r["day"], r["hour"]): r["temperature"] for r in outliers.impute_outliers(df).collect()}
    assert got == {(1, 1, 0): 15.0, (1, 1, 1): 10.0, (1, 2, 0): 20.0, (2, 1, 0): 99.0}


def test_arima_follows_a_trend_and_leaves_leading_gaps(series):
    rows = [(0, None)] + [(i, 2.0 * i + 0.01 * (i % 3)) for i in range(1, 40)] + [(40, None), (41, None), (42, 90.0)]
    got = [r["temperature"] for r in arima.fill_arima(series(rows), ["temperature"]).orderBy("time").collect()]
    assert got[0] is None and got[40] == got[41] and 78 < got[40] < 84
    assert arima.forecast_next(np.array([3.0, 3.0, 3.0, 3.0, 3.0])) == 3.0


def plain_forecast(values):
    """Residuals of all pairs by their definition, from the first to the last value; the squared sum is a parabola in phi."""
    d, phi, theta = np.diff(values), np.array([-0.9, 0.0, 0.9])[:, None], arima.THETAS[None, :]

    def residuals(phi):
        e = total = np.zeros((len(phi), theta.shape[1]))
        for before, now in zip(d[:-1], d[1:]):
            e = now - phi * before - theta * e
            total = total + e * e
        return total, e

    low, middle, high = residuals(phi)[0]
    bend, slope = (low + high - 2 * middle) / 1.62, (high - low) / 1.8
    best_phi = np.clip(-slope / (2 * bend), -0.99, 0.99)[None, :]
    total, e = residuals(best_phi)
    k = int(total[0].argmin())
    return values[-1] + best_phi[0, k] * d[-1] + theta[0, k] * e[0, k]


def test_arima_rests_on_the_whole_history(series):
    rng = np.random.default_rng(3)
    noise = rng.normal(size=5200)
    d = np.zeros(5200)
    for t in range(1, 5200):
        d[t] = 0.6 * d[t - 1] + noise[t] + 0.3 * noise[t - 1]
    values, gaps = np.cumsum(d), {700, 1500, 1501, 3001, 5199}
    rows = [(i, None if i in gaps else values[i]) for i in range(5200)]
    df = series(rows)
    for options in ({}, {"block": 1500, "warm": 1500, "chunk": "1 day"}):
        got = [r["temperature"] for r in arima.fill_arima(df, ["temperature"], **options).orderBy("time").collect()]
        for gap in sorted(gaps):
            assert got[gap] == pytest.approx(plain_forecast(np.array([v for i, v in rows[:gap] if v is not None])), rel=1e-4)


def test_similar_hours_relax_the_month(spark):
    keys = "zone string, device_id bigint, house string"
    patterns_in = spark.sql("""SELECT 'z' AS zone, 1L AS device_id, 'h' AS house, date, 5 AS hour, n, CAST(date AS TIMESTAMP_NTZ) + INTERVAL 5 HOUR AS first,
      map(0, 1.0D) AS minutes, month(date) AS month FROM VALUES (DATE '2024-01-10', 4L), (DATE '2024-02-10', 4L), (DATE '2024-06-10', 30L), (DATE '2024-12-10', 30L) AS t(date, n)""")
    hours = lambda day: spark.sql(f"""SELECT 'z' AS zone, 1L AS device_id, 'h' AS house, 1L AS _gap, DATE '{day}' AS date, 5 AS hour, 1L AS n,
      TIMESTAMP_NTZ '{day} 05:00:00' AS first""")
    found = lambda day, **o: {str(r["_cfirst"])[:10] for r in patterns.similar_hours(hours(day), patterns_in, top=9, **o).collect()}
    assert found("2024-06-20") == {"2024-06-10"}
    assert found("2024-01-20") == {"2024-01-10", "2024-02-10", "2024-06-10", "2024-12-10"}
    assert found("2024-01-20", wrap=True) == {"2024-01-10", "2024-02-10", "2024-12-10"}


def test_tiered_with_long_gaps_fills_everything(series):
    rows = [(i * 60, 10 + (i % 24) * 0.5) for i in range(24 * 20) if not 24 * 8 <= i < 24 * 12]
    table = series(rows)
    from sensorlab.operators.ordered import densify

    dense = densify(table, "1 hour", sentinel=None).drop("humidity")
    assert fills.fill_tiered(dense, ["temperature"]).filter("temperature IS NULL").count() == 96
    for how in ("pattern", "seasonal"):
        out = fills.fill_tiered(dense, ["temperature"], long_gap=how)
        assert out.count() == dense.count() and out.filter("temperature IS NULL").count() == 0


def test_nearest_rows_like_all_distances():
    rng = np.random.default_rng(3)
    kinds = [rng.normal(size=(400, 9)), rng.integers(0, 3, (400, 2)).astype(float), 1e6 + rng.normal(size=(400, 3)), np.ones((400, 2)),
             np.where(rng.random((400, 3)) < 0.05, np.nan, rng.normal(size=(400, 3)))]
    for x in kinds:
        points, rows = x[:150], x[100:]
        for keep in (1, 20, len(rows)):
            d2 = np.zeros((len(points), len(rows)))
            for f in range(x.shape[1]):
                d2 += (points[:, f, None] - rows[None, :, f]) ** 2
            best = np.argsort(np.round(d2, knn.DIGITS), axis=1, kind="stable")[:, :keep]
            picks, squares = knn.nearest_rows(points, rows, keep)
            assert (picks == best).all()
            assert np.array_equal(squares, np.round(np.take_along_axis(d2, best, axis=1), knn.DIGITS), equal_nan=True)
