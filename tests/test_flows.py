"""Readers, writers, persisted models and the flows on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from sensorlab.operators import detectors, models
from sensorlab.plans import cleaning, imputation, ingest
from sensorlab.sources import readers, writers


def document(rows):
    return json.dumps({"data": [dict(zip(("time", "device_id", "house", "measures"), r)) for r in rows]})


@pytest.fixture
def feeds(tmp_path):
    groups = {}
    for zone in ("Zone 1", "Zone 2"):
        for period in (1, 2):
            for measure in ("temperature", "humidity"):
                path = tmp_path / f"{zone}_{period}_{measure}.json"
                rows = [(f"2024-01-0{period}T00:0{m}:00", "d1", "h1", 20.0 + m + period) for m in (0, 1, 3)]
                path.write_text(document(rows if measure == "temperature" else rows[:2]))
                groups.setdefault(zone, {}).setdefault(period, {})[measure] = str(path)
    return groups


def test_feed_groups_to_aligned_table(spark, feeds):
    read = readers.read_feed_groups(spark, feeds)
    assert read["temperature"].count() == 12 and read["humidity"].count() == 8
    assert {(r["zone"], r["period"]) for r in read["humidity"].select("zone", "period").distinct().collect()} == {
        ("Zone 1", "1"), ("Zone 1", "2"), ("Zone 2", "1"), ("Zone 2", "2")}
    weather = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 15 * i) AS time, DOUBLE(i) AS GHI FROM (SELECT explode(sequence(0, 96)) AS i)")
    out = ingest.ingest(read["humidity"], read["temperature"], weather)
    assert out["merged"].filter("zone = 'Zone 1'").count() == 24 * 60 + 4
    assert out["aligned"].filter("GHI IS NULL AND time < TIMESTAMP_NTZ '2024-01-02 00:00:00'").count() == 0
    assert out["gaps"].count() > 0 and out["statistics"].count() == 2
    before = {r["zone"]: r for r in out["missing_before"].collect()}
    assert before["Zone 1"]["total_rows"] == 24 * 60 + 4


def test_unreadable_time_is_null(spark):
    assert spark.createDataFrame([("nonsense",)], "t string").select(readers.parse_time("t").alias("t")).first()["t"] is None


def test_weather_time_column(spark, tmp_path):
    for name in ("TMSTAMP", "TIMESTAMP"):
        path = tmp_path / f"{name}.csv"
        path.write_text(f"{name},GHI_corr_Avg,Rain_mm_Tot\n2024-01-01 00:00:00,1.5,\n")
        row = readers.read_weather(spark, str(path)).first()
        assert (row["GHI"], row["Rain_mm_Tot"], str(row["time"])) == (1.5, None, "2024-01-01 00:00:00")


def test_csv_round_trip(spark, series, tmp_path):
    table = series([(0, 1.5, None), (1, None, 2.0)]).withColumn("device_id", F.col("device_id").cast("string"))
    writers.write_table(table, str(tmp_path / "out"))
    back = readers.read_readings(spark, str(tmp_path / "out" / "zone=Zone 1"))
    assert [(r["temperature"], r["humidity"]) for r in back.orderBy("time").collect()] == [(1.5, None), (None, 2.0)]


def test_metrics_and_clean_sink(spark, tmp_path):
    table = spark.sql("SELECT 'Zone 1' AS zone, 0 AS predicted")
    writers.write_metrics(table, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).first()["zone"] == "Zone 1"
    assert writers.write_if_clean(table, table, str(tmp_path / "clean"), format="parquet")
    dirty = table.withColumn("predicted", F.lit(1))
    assert not writers.write_if_clean(table, dirty, str(tmp_path / "dirty"))
    assert not (tmp_path / "dirty").exists()


def day_table(series):
    return series([(i * 30, None if i % 7 == 3 else 10 + (i % 48) / 4, 40 + (i % 5)) for i in range(48 * 20)])


def test_model_fill_saves_and_loads(spark, series, tmp_path):
    table = day_table(series)
    out = imputation.model_imputation(table, ["temperature"], trees=5, depth=4)
    assert out["table"].filter("temperature IS NULL").count() == 0
    assert out["metrics"].first()["r2"] > 0.5
    models.save_models(out["models"], str(tmp_path / "m"))
    again = models.fill_model(table, models.load_models(str(tmp_path / "m"), ["temperature"]))
    assert again.orderBy("time").collect() == out["table"].orderBy("time").collect()
    assert models.fill_model(table.na.fill(0.0), out["models"]).count() == table.count()


def test_choose_imputation(series):
    out = imputation.choose_imputation(day_table(series), ["mean", "linear"])
    assert out["best"] in ("mean", "linear") and out["evaluation"].count() == 4
    assert out["table"].filter("temperature IS NULL").count() == 0


def test_remove_outliers(series):
    out = cleaning.remove_outliers(day_table(series), ["temperature"], training={"trees": 2, "depth": 2})
    assert out["table"].count() == 48 * 20
    assert out["summary"].first()["rows"] == 48 * 20


def test_detectors_find_injected_anomalies(spark, series, tmp_path):
    table = day_table(series).na.fill(12.0).withColumnsRenamed({"temperature": "inside_temperature", "humidity": "inside_humidity"})
    from sensorlab.functions.draws import key_text
    from sensorlab.operators.evaluate import binary_metrics, roc_auc
    from sensorlab.session import stage

    copies = detectors.bootstrap(table)
    hit = stage(detectors.inject_anomalies(copies, ["inside_temperature", "inside_humidity"]).withColumn(
        "row", key_text(["device_id", "copy"], "time")))
    names = ["inside_temperature", "inside_humidity"]
    rate = hit.agg(F.avg("anomaly")).first()[0]
    assert 0.05 < rate < 0.15
    for i, detector in enumerate((detectors.NaiveBayes(), detectors.Reconstruction((1,)), detectors.BoostedTrees({"maxIter": [2], "maxDepth": [2]}, folds=2))):
        detector.fit(hit, names)
        detector.save(str(tmp_path / str(i)))
        scored = type(detector)().load(str(tmp_path / str(i))).score(hit).select(
            F.lit(detector.name).alias("model"), F.col("anomaly").alias("label"), "predicted", "score")
        assert roc_auc(scored).first()["auc"] > 0.7
        if detector.name != "reconstruction":
            assert binary_metrics(scored).first()["f1"] > 0.9


def test_untrained_detector_refuses(spark):
    with pytest.raises(ValueError):
        detectors.NaiveBayes().score(spark.range(1))
