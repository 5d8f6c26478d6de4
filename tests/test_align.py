"""Edge cases of merging, syncing and joining."""

import pytest
from pyspark.sql import functions as F

from sensorlab.functions import missing
from sensorlab.operators import align, gaps

SCHEMA = "zone string, device_id bigint, house string, time timestamp_ntz, event_id bigint, {} double"


def at(text):
    return f"TIMESTAMP_NTZ '2024-01-01 {text}'"


def test_measure_merge_first_wins_null_kept_absent_is_sentinel(spark):
    feed = lambda name, rows: spark.sql("SELECT 'Z' AS zone, 1L AS device_id, 'H' AS house, time, id AS event_id, v AS %s FROM VALUES %s AS t(time, id, v)" % (
        name, ", ".join(f"({at(t)}, {i}, CAST({v} AS DOUBLE))" for t, i, v in rows)))
    temperature = feed("temperature", [("00:00:00", 2, "2.0"), ("00:00:00", 1, "1.0"), ("00:01:00", 3, "NULL")])
    humidity = feed("humidity", [("00:02:00", 4, "7.0"), ("00:00:00", 5, "6.0")])
    got = [(r["temperature"], r["humidity"]) for r in align.measure_merge(humidity, temperature).orderBy("time").collect()]
    assert got == [(1.0, 6.0), (None, -1.0), (-1.0, 7.0)]


@pytest.mark.parametrize("seconds,matched", [(60, True), (61, False)])
def test_asof_tolerance(spark, seconds, matched):
    left = spark.sql(f"SELECT {at('01:00:00')} + INTERVAL {seconds} SECOND AS time")
    right = spark.sql(f"SELECT {at('01:00:00')} AS time, 5.0D AS GHI")
    assert (align.asof_join(left, right).first()["GHI"] == 5.0) == matched


def test_asof_keeps_every_left_row_and_takes_the_last(spark):
    left = spark.sql(f"SELECT explode(sequence(1, 5)) AS id, {at('01:00:30')} AS time")
    right = spark.sql(f"SELECT * FROM VALUES ({at('01:00:00')}, 1.0D), ({at('01:00:30')}, 2.0D), ({at('01:00:31')}, 3.0D) AS t(time, GHI)")
    assert [r["GHI"] for r in align.asof_join(left, right).collect()] == [2.0] * 5


def test_zone_sync_cases(spark):
    rows = spark.sql(f"""SELECT zone, 1L AS device_id, 'H' AS house, time, t AS temperature, h AS humidity FROM VALUES
      ('Zone 1', {at('00:00:00')}, 1.0D, CAST(NULL AS DOUBLE)), ('Zone 2', {at('00:00:00')}, 2.0D, 5.0D),
      ('Zone 1', {at('00:01:00')}, -1.0D, -1.0D), ('Zone 2', {at('00:01:00')}, CAST(NULL AS DOUBLE), -1.0D),
      ('Zone 1', {at('00:02:00')}, CAST(NULL AS DOUBLE), 3.0D), ('Zone 3', {at('00:02:00')}, 9.0D, 9.0D) AS t(zone, time, t, h)""")
    got = {(r["zone"], r["time"].minute): (r["temperature"], r["humidity"]) for r in align.zone_sync(rows).collect()}
    assert got == {("Zone 1", 0): (1.0, 5.0), ("Zone 2", 0): (2.0, 5.0), ("Zone 1", 1): (-1.0, -1.0),
                   ("Zone 2", 1): (-1.0, -1.0), ("Zone 1", 2): (-1.0, 3.0), ("Zone 3", 2): (9.0, 9.0)}


def test_gap_intervals_are_anchored_at_the_zone(series):
    table = series([(7, -1.0, 1.0), (8, 1.0, 1.0), (22, None, None), (30, 1.0, 1.0)])
    got = [(r["time"].minute, r["gap_type"], r["completeness"]) for r in gaps.gap_intervals(table).orderBy("time").collect()]
    assert got == [(7, "temperature", "partial"), (22, "both", "partial")]


def test_validate(spark):
    df = spark.sql("SELECT 1.0D AS a, 'x' AS b, double('inf') AS c")
    assert missing.validate(df, ["a"])
    for cols in (["a", "z"], ["b"], ["c"]):
        with pytest.raises(ValueError):
            missing.validate(df, cols)


def test_require_no_nulls(spark):
    with pytest.raises(ValueError):
        missing.require_no_nulls(spark.sql("SELECT CAST(NULL AS INT) AS a"))


def test_sentinel_round_trip_all_columns(spark):
    df = spark.sql("SELECT -1.0D AS temperature, 2.0D AS humidity, -1.0D AS Tair")
    assert missing.sentinel_to_null(df).first()["Tair"] == -1.0
    assert missing.sentinel_to_null(df, all_columns=True).first()["Tair"] is None
    assert missing.null_to_sentinel(missing.sentinel_to_null(df)).first()["temperature"] == -1.0


def test_missing_percentage_of_nothing(spark):
    empty = spark.sql("SELECT 1.0D AS temperature, 1.0D AS humidity WHERE false")
    row = missing.missing_percentages(empty).first()
    assert row["total_rows"] == 0 and row["temperature_missing_percentage"] is None
