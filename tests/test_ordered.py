"""Edge cases of the ordered operators, and their independence of the chunk length."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorlab.operators import fills, gaps, ordered

KEYS = ["zone", "device_id", "house"]


def run_of(n, first=0.0, last=None):
    return [(0, first)] + [(i, None) for i in range(1, n + 1)] + [(n + 1, first + n + 1 if last is None else last)]


@pytest.mark.parametrize("n", [15, 16, 17])
def test_linear_limit_fills_only_the_first_rows_of_a_run(series, values, n):
    got = values(fills.fill_linear(series(run_of(n)), ["temperature"], limit=15))
    by_time = [r for r in got]
    assert sum(v is None for v in by_time) == max(0, n - 15)


@pytest.mark.parametrize("n,short", [(15, True), (16, True), (17, False)])
def test_tiers_by_duration(series, n, short):
    # A run of n rows lasts n - 1 minutes; a short one is a line, a longer one the cubic.
    rows = [(-1, 5.0)] + run_of(n) + [(n + 2, -3.0)]
    out = fills.fill_tiered(series(rows), ["temperature"]).orderBy("time").collect()
    inside = [r["temperature"] for r in out[2:2 + n]]
    line = [float(i) for i in range(1, n + 1)]
    if short:
        assert inside[:15] == pytest.approx(line[:15])
        assert all(v is None for v in inside[15:])
    else:
        assert None not in inside and inside != pytest.approx(line)


def test_linear_edges(series):
    table = series([(0, None), (1, None), (2, 4.0), (3, None), (4, 8.0), (5, None)])
    forward = [r["temperature"] for r in fills.fill_linear(table, ["temperature"]).orderBy("time").collect()]
    assert forward == [None, None, 4.0, 6.0, 8.0, 8.0]
    both = [r["temperature"] for r in fills.fill_linear(table, ["temperature"], both=True).orderBy("time").collect()]
    assert both == [4.0, 4.0, 4.0, 6.0, 8.0, 8.0]


def random_series(seed, n=250, minutes=60 * 24 * 20, share=0.6):
    rng = random.Random(seed)
    times = sorted(rng.sample(range(minutes), n))
    pick = lambda: None if rng.random() < share else round(rng.uniform(0, 40), 2)
    return [(t, pick(), pick()) for t in times]


@pytest.mark.parametrize("chunk", ["6 hours", "3 days"])
@pytest.mark.parametrize("method", ["nocb", "linear", "custom"])
def test_chunk_length_does_not_matter(series, chunk, method):
    table = series(random_series(1)).unionByName(series(random_series(2), device=2))
    options = {"short": "2 hours", "medium": "1 day"} if method == "custom" else {}
    order = [*KEYS, "time"]
    got = fills.impute(table, method, chunk=chunk, **options).orderBy(*order).toPandas()
    want = fills.impute(table, method, chunk="520 weeks", **options).orderBy(*order).toPandas()
    pd.testing.assert_frame_equal(got, want)


def test_linear_and_locf_equal_pandas(series):
    rows = random_series(3)
    table = series(rows)
    plain = pd.DataFrame(rows, columns=["m", "temperature", "humidity"])
    got = fills.fill_linear(table, chunk="6 hours").orderBy("time").toPandas()
    pd.testing.assert_series_equal(got["temperature"], plain["temperature"].interpolate(), check_names=False)
    got = fills.fill_locf(table, chunk="6 hours").orderBy("time").toPandas()
    pd.testing.assert_series_equal(got["humidity"], plain["humidity"].ffill(), check_names=False)


@pytest.mark.parametrize("chunk", ["1 hour", "3 days"])
def test_rolling_equals_pandas(series, chunk):
    rows = random_series(4, share=0.3)
    plain = pd.DataFrame(rows, columns=["m", "temperature", "humidity"])["temperature"]
    got = ordered.rolling_features(series(rows), ["temperature"], chunk=chunk).orderBy("time").toPandas()
    rolling = plain.rolling(24, min_periods=1)
    pd.testing.assert_series_equal(got["temp_rolling_mean"], rolling.mean(), check_names=False)
    pd.testing.assert_series_equal(got["temp_rolling_std"], rolling.std().fillna(0), check_names=False)
    pd.testing.assert_series_equal(got["temp_diff"], plain.diff().fillna(0), check_names=False)


def test_observed_values_never_change(series):
    table = series(random_series(5))
    for method in ("mean", "median", "locf", "spline"):
        out = fills.impute(table, method).withColumnRenamed("temperature", "t2").select(*KEYS, "time", "t2")
        assert table.filter("temperature IS NOT NULL").join(out, [*KEYS, "time"]).filter("NOT (temperature <=> t2)").count() == 0


def test_densify_counts_off_grid_and_duplicates(series, values):
    table = series([(0, 1.0), (0, 2.0), (2.5, 9.0), (3, 4.0), (5, None)])
    got = ordered.densify(table).orderBy("time", "temperature").collect()
    assert [r["temperature"] for r in got] == [1.0, 2.0, -1.0, -1.0, 4.0, -1.0, -1.0]
    snapped = ordered.densify(table, snap=True)
    assert sorted(r["temperature"] for r in snapped.collect()) == [-1.0, -1.0, -1.0, 1.0, 2.0, 4.0, 9.0]


def test_densify_row_count_and_long_gap(series):
    table = series([(0, 1.0), (60 * 24 * 30, 2.0)])
    out = ordered.densify(table, chunk="1 day")
    assert out.count() == 60 * 24 * 30 + 1
    assert out.select("time").distinct().count() == 60 * 24 * 30 + 1


def test_single_row_series(series):
    table = series([(7, 3.0)])
    assert ordered.densify(table).count() == 1
    assert fills.fill_linear(table).first()["temperature"] == 3.0


def test_windowed_fill(series):
    # A valid row 61 minutes before the interval is out of reach.
    table = ordered.densify(series([(0, 10.0, 10.0), (200, 20.0, 20.0)]))
    got = {i: r["temperature"] for i, r in enumerate(ordered.fill_windowed(table).orderBy("time").collect())}
    assert got[74] == 10.0 and got[75] == -1.0
    assert got[134] == -1.0 and got[135] == 20.0
    assert got[0] == 10.0 and got[200] == 20.0


def test_windowed_fill_averages_duplicates_only_in_touched_intervals(series):
    table = series([(0, 1.0, 1.0), (0, 3.0, 1.0), (1, None, 1.0), (15, 5.0, 1.0), (15, 7.0, 1.0)])
    got = [r["temperature"] for r in ordered.fill_windowed(table, ["temperature"]).orderBy("time", "temperature").collect()]
    assert got == [2.0, 2.0, 4.0, 5.0, 7.0]


@pytest.mark.parametrize("chunk", ["1 hour"])
def test_windowed_fill_is_independent_of_chunk(series, chunk):
    table = series(random_series(6, n=3000, minutes=4000, share=0.9))
    order = ["time"]
    got = ordered.fill_windowed(table, chunk=chunk).orderBy(*order).toPandas()
    want = ordered.fill_windowed(table, chunk="520 weeks").orderBy(*order).toPandas()
    pd.testing.assert_frame_equal(got, want)


def test_upsample_first_row_off_the_minute(spark):
    weather = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ '2024-01-01 00:00:30', 1.0), (TIMESTAMP_NTZ '2024-01-01 00:02:30', 2.0) AS t(time, GHI)")
    got = [r["GHI"] for r in ordered.upsample(weather).orderBy("time").collect()]
    assert got == [None, 1.0, 1.0]


def test_gap_runs(series):
    table = series([(0, None), (1, 1.0), (2, None), (3, None), (4, 2.0), (5, None)])
    runs = gaps.gap_runs(table, ["temperature"], chunk="1 hour").orderBy("start_time").collect()
    assert [(r["rows"], r["minutes"]) for r in runs] == [(1, 0.0), (2, 1.0), (1, 0.0)]


@pytest.mark.parametrize("block", [2, 3, 1000])
def test_longest_constant_run(spark, block):
    rng = random.Random(9)
    vs = [rng.choice([1.0, 1.0, 1.0, 2.0]) for _ in range(60)]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(vs)], "k string, i bigint, v double")
    best = current = 1
    for a, b in zip(vs, vs[1:]):
        current = current + 1 if a == b else 1
        best = max(best, current)
    row = gaps.longest_constant_run(df, "v", ["k"], "i", block=block).first()
    assert (row["longest"], row["rows"]) == (best, 60)


def test_results_do_not_depend_on_shuffle_partitions(spark, series):
    table = series(random_series(8))
    first = fills.fill_tiered(table, short="1 hour").orderBy("time").collect()
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert fills.fill_tiered(table, short="1 hour").orderBy("time").collect() == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_plain_window_over_a_series_never_appears(series):
    plan = fills.fill_linear(series(random_series(1)))._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window [last(" in line and "_p" in line:
            assert "_chunk" in line


def test_long_gaps_with_repeated_times(spark, series):
    """Rows of one time keep their own fills: the numbering is the same for the tiers and the long gaps."""
    rows = [(5 * k, None if 4 <= k < 34 else 20.0 + k % 7, None if k % 9 == 0 else 50.0 - k % 5) for k in range(80)]
    rows.append((25, 3.0, 40.0))
    table = series(rows + [(30, None, 41.0)])
    out = fills.fill_tiered(table, short="10 minutes", medium="20 minutes", long_gap="seasonal")
    assert out.count() == 82 and out.filter("temperature IS NULL").count() == 0
