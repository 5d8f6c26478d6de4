"""Sensor readings, feeds and weather derived from the whole ``events`` table.

Each has a Spark and a DuckDB statement that give the same rows.
"""

from pyspark.sql import DataFrame, SparkSession

_BUCKET = {
    "spark": "CAST(timestamp_seconds(unix_seconds(CAST(ts AS TIMESTAMP)) DIV {s} * {s}) AS TIMESTAMP_NTZ)",
    "duckdb": "time_bucket(INTERVAL {s} SECOND, ts)",
}


def _dialect(engine: str) -> dict:
    spark = engine == "spark"
    return {
        "quarter": _BUCKET[engine].format(s=900),
        "hour": _BUCKET[engine].format(s=3600),
        "text": "STRING" if spark else "VARCHAR",
        "div": "DIV" if spark else "//",
        "one": "-1.0D" if spark else "CAST(-1.0 AS DOUBLE)",
        "null": "CAST(NULL AS DOUBLE)",
    }


def readings_sql(engine: str, series: int = 8) -> str:
    """8 series (2 zones x 4 houses) in steps of 15 minutes; error events are the sentinel."""
    return """
SELECT concat('Zone ', CAST(device_id % 2 + 1 AS {text})) AS zone, device_id,
       concat('House ', CAST(device_id {div} 2 + 1 AS {text})) AS house, time,
  min_by(CASE WHEN event_type = 'error' THEN {one} ELSE round(value % 40, 2) END, event_id)
    FILTER (WHERE event_type IN ('click', 'view', 'error')) AS temperature,
  min_by(CASE WHEN event_type = 'error' THEN {one} ELSE round(20 + value % 60, 2) END, event_id)
    FILTER (WHERE event_type IN ('purchase', 'signup', 'error')) AS humidity
FROM (SELECT user_id % {series} AS device_id, event_type, event_id, value, {quarter} AS time FROM events) e
GROUP BY 1, 2, 3, 4""".format(series=series, **_dialect(engine))


def feed_sql(engine: str, measure: str) -> str:
    """A raw feed of one measure: several rows may share a key, error events are present nulls."""
    types = "'click', 'view', 'error'" if measure == "temperature" else "'purchase', 'signup', 'error'"
    return """
SELECT concat('Zone ', CAST(user_id % 8 % 2 + 1 AS {text})) AS zone, user_id % 8 AS device_id,
       concat('House ', CAST(user_id % 8 {div} 2 + 1 AS {text})) AS house, {quarter} AS time, event_id,
       CASE WHEN event_type = 'error' THEN {null} ELSE round(value % 60, 2) END AS {measure}
FROM events WHERE event_type IN ({types})""".format(measure=measure, types=types, **_dialect(engine))


def weather_sql(engine: str) -> str:
    """Hourly weather without a key; some hours are absent."""
    return """
SELECT time, round(value * 2, 2) AS GHI, round(value % 35, 2) AS Tair,
       round(20 + value % 70, 2) AS RH, round(value % 12, 2) AS WS
FROM (SELECT {hour} AS time, min_by(value, event_id) AS value
      FROM events WHERE event_type = 'view' GROUP BY 1) w""".format(**_dialect(engine))


def _run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.sql(sql.replace("FROM events", "FROM {events}"), events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def readings(spark: SparkSession, sf_dir: str, series: int = 8) -> DataFrame:
    return _run(spark, sf_dir, readings_sql("spark", series))


def feed(spark: SparkSession, sf_dir: str, measure: str) -> DataFrame:
    return _run(spark, sf_dir, feed_sql("spark", measure))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, weather_sql("spark"))
