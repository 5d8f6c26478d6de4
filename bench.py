"""Headline queries, timed; prints one JSON line.

The inputs are staged once as parquet (every user of ``events`` as a series of its own, so that the
table has millions of readings) and each query then runs from that table into a no-op sink.
"""

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from sensorlab import fixtures
from sensorlab.checks.registry import clean
from sensorlab.functions.missing import missing_percentages
from sensorlab.operators import align, evaluate, fills, gaps, ordered, outliers
from sensorlab.session import local_session, stage
from sensorlab.sources import writers

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
STEP = "15 minutes"


def label(table):
    # Three passes of the quantiles and labels read the features.
    featured = stage(outliers.outlier_features(table, unit="week"))
    return outliers.label_outliers(featured)


def main():
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) if CPUS.isdigit() else 8)
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    fixtures.readings(spark, SF_DIR, 10 ** 9).write.parquet(f"{folder}/readings")
    readings = spark.read.parquet(f"{folder}/readings")
    ordered.densify(readings, STEP).repartition(32, "device_id").write.parquet(f"{folder}/dense")
    dense = spark.read.parquet(f"{folder}/dense")
    holes = clean(dense)
    weather = fixtures.weather(spark, SF_DIR)
    rows = dense.count()

    queries = {
        "densify": lambda: ordered.densify(readings, STEP),
        "zone_sync": lambda: align.zone_sync(dense, on=("time",)),
        "asof_weather": lambda: align.asof_join(dense, weather, "2 hours"),
        "missing_pct": lambda: missing_percentages(dense, ["zone"]),
        "gap_summary": lambda: gaps.gap_summary(gaps.gap_intervals(dense, "1 hour")),
        "fill_locf": lambda: fills.fill_locf(holes),
        "fill_linear": lambda: fills.fill_linear(holes),
        "fill_windowed": lambda: ordered.fill_windowed(dense),
        "fill_tiered": lambda: fills.fill_tiered(holes, short="1 hour", medium="6 hours", limit=4),
        "rolling_features": lambda: ordered.rolling_features(holes),
        "outlier_labels": lambda: label(holes),
        "daily_mean": lambda: evaluate.daily_mean(holes),
        "box_stats": lambda: evaluate.box_statistics(holes.withColumn("month_year", F.date_format("time", "MMM yyyy")), by=["zone", "month_year"]),
    }
    times = {}
    for name, build in queries.items():
        start = time.time()
        build().write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    # The whole labelling run of the baseline: read, label both measures, write CSV.
    start = time.time()
    writers.write_table(label(holes), f"{folder}/labelled")
    times["label_and_write_csv"] = round(time.time() - start, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(os.path.basename(SF_DIR.rstrip("/")).replace("sf", "") or 0), "rows": rows}))
    spark.stop()


if __name__ == "__main__":
    main()
