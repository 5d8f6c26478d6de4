"""Queries that pass the tables through the readers and writers."""

import re
from urllib.parse import unquote

from pyspark.sql import Window, functions as F

from sensorlab import fixtures
from sensorlab.checks.align import ASOF, _FEEDS
from sensorlab.checks.registry import K, READINGS, WEATHER, query
from sensorlab.operators import align
from sensorlab.session import scratch
from sensorlab.sources import readers, writers


def _documents(feed, measure, path):
    """One JSON document per zone, as the raw feeds are delivered."""
    row = F.struct("event_id", F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"), F.col("device_id").cast("string").alias("device_id"),
                   "house", F.col(measure).alias("measures"))
    rows = feed.groupBy("zone", F.dayofmonth("time").alias("day")).agg(F.sort_array(F.collect_list(row)).alias("data"))
    rows.repartition("zone", "day").write.partitionBy("zone", "day").json(path)


@query(f"""WITH {_FEEDS}
SELECT zone, CAST(device_id AS VARCHAR) AS device_id, house, time, CASE WHEN h1.event_id IS NULL THEN -1 ELSE humidity END AS humidity,
  CASE WHEN t1.event_id IS NULL THEN -1 ELSE temperature END AS temperature
FROM t1 FULL JOIN h1 USING ({K}, time)""")
def json_feeds(spark, d):
    folder, feeds = scratch(spark, "feeds"), {}
    for measure in ("humidity", "temperature"):
        _documents(fixtures.feed(spark, d, measure), measure, f"{folder}/{measure}")
        raw = readers.read_feed(spark, f"{folder}/{measure}", measure)
        feeds[measure] = raw.withColumn("zone", F.url_decode(F.regexp_extract("path", "zone=([^/]+)/", 1))).drop("path")
    return align.measure_merge(feeds["humidity"], feeds["temperature"])


@query(f"""WITH {_FEEDS}
SELECT zone, CAST(day(time) AS VARCHAR) AS period, CAST(device_id AS VARCHAR) AS device_id, house, time, 'humidity' AS measure, humidity AS value FROM h
UNION ALL SELECT zone, CAST(day(time) AS VARCHAR), CAST(device_id AS VARCHAR), house, time, 'temperature', temperature FROM t""")
def feed_groups(spark, d):
    """A file for each zone, day and measure."""
    folder, groups, out = scratch(spark, "groups"), {}, None
    for measure in ("humidity", "temperature"):
        _documents(fixtures.feed(spark, d, measure), measure, f"{folder}/{measure}")
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(f"{folder}/{measure}")
        for (path,) in files.select("path").collect():
            name = unquote(path)
            zone, day = re.search(r"zone=([^/]+)/day=(\d+)/", name).groups()
            groups.setdefault(unquote(zone), {}).setdefault(int(day), {})[measure] = path
    for measure, feed in readers.read_feed_groups(spark, groups).items():
        part = feed.select("zone", "period", "device_id", "house", "time", F.lit(measure).alias("measure"), F.col(measure).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


@query(f"WITH {READINGS} SELECT zone, count(*) AS \"rows\", count(*) AS in_order FROM readings GROUP BY zone")
def sorted_files(spark, d):
    """How many rows of the written files stand where the order by series and time puts them."""
    path = scratch(spark, "sorted")
    writers.write_table(fixtures.readings(spark, d), path, "parquet")
    rows = spark.read.parquet(path).select("zone", "device_id", "house", "time", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    place = F.row_number().over(Window.partitionBy("file").orderBy("zone", "device_id", "house", "time"))
    return rows.withColumn("place", place).groupBy("zone").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("at") + 1 == F.col("place")).alias("in_order"))


@query(f"WITH {WEATHER} SELECT time, GHI, Tair, RH, WS FROM weather")
def weather_source(spark, d):
    raw = fixtures.weather(spark, d).withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm:ss")).withColumnsRenamed(
        {"time": "TMSTAMP", "GHI": "GHI_corr_Avg", "Tair": "Tair_Avg", "RH": "RH_Avg", "WS": "WS_Avg"})
    path = scratch(spark, "weather")
    raw.write.option("header", True).csv(path)
    return readers.read_weather(spark, path)


@query(f"WITH {READINGS} SELECT zone, CAST(device_id AS VARCHAR) AS device_id, house, time, temperature, humidity FROM readings")
def csv_table(spark, d):
    path = scratch(spark, "readings")
    writers.write_table(fixtures.readings(spark, d), path, partition_by=())
    return readers.read_readings(spark, path).select("zone", "device_id", "house", "time", "temperature", "humidity")


@query(f"WITH {READINGS}, {WEATHER}, {ASOF} SELECT zone, count(*) AS \"rows\", count(GHI) AS with_weather FROM matched GROUP BY zone")
def parquet_table(spark, d):
    path = scratch(spark, "aligned")
    writers.write_table(align.asof_join(fixtures.readings(spark, d), fixtures.weather(spark, d), "2 hours"), path, "parquet")
    return spark.read.parquet(path).groupBy("zone").agg(F.count(F.lit(1)).alias("rows"), F.count("GHI").alias("with_weather"))


@query(f"WITH {READINGS} SELECT zone, count(*) AS total_rows FROM readings GROUP BY zone")
def metrics_json(spark, d):
    path = scratch(spark, "metrics")
    writers.write_metrics(fixtures.readings(spark, d).groupBy("zone").agg(F.count(F.lit(1)).alias("total_rows")), path)
    return spark.read.schema("zone string, total_rows bigint").json(path)


@query(f"""WITH {READINGS} SELECT 'sentinel' AS rule, count(*) FILTER (WHERE temperature = -1) = 0 AS written FROM readings
UNION ALL SELECT 'impossible', count(*) FILTER (WHERE temperature > 1000) = 0 FROM readings""")
def conditional_sink(spark, d):
    table, rows = fixtures.readings(spark, d), []
    for rule, condition in (("sentinel", F.col("temperature") == -1), ("impossible", F.col("temperature") > 1000)):
        flagged = table.withColumn("predicted", F.coalesce(condition.cast("int"), F.lit(0)))
        rows.append((rule, writers.write_if_clean(table, flagged, scratch(spark, "clean"), format="parquet")))
    return spark.createDataFrame(rows, "rule string, written boolean")
