"""Reading raw feeds, weather tables and processed tables."""

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorlab.functions.calendar import _col
from sensorlab.operators.align import normalise_weather
from sensorlab.schema import FEED, READINGS, TIME

TIME_FORMATS = "[yyyy-MM-dd'T'HH:mm:ss][yyyy-MM-dd HH:mm:ss]"


def parse_time(column) -> "F.Column":
    """Text to a timestamp without zone; what cannot be read becomes null."""
    return _col(column).try_cast("timestamp_ntz")


def read_feed(spark: SparkSession, paths, measure: str) -> DataFrame:
    """Raw JSON documents ``{"data": [{time, device_id, house, measures}]}`` as rows.

    ``event_id`` is the place of the row in the source: file, then position in its array.
    """
    raw = spark.read.schema(FEED).option("multiLine", True).json(paths)
    rows = raw.select(F.col("_metadata.file_path").alias("path"), F.posexplode("data").alias("pos", "r"))
    return rows.select(
        parse_time("r.time").alias(TIME), F.col("r.device_id").alias("device_id"), F.col("r.house").alias("house"),
        F.col("r.measures").alias(measure), F.struct("path", "pos").alias("event_id"), "path")


def read_feed_groups(spark: SparkSession, groups: dict) -> dict:
    """Feeds of several zones and periods, ``{zone: {period: {measure: path}}}``, one frame per measure.

    All files of a measure are one read; zone and period are looked up by the file's whole name, the longest that fits.
    """
    ending = lambda path: "/" + re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", path).removeprefix("./").lstrip("/")
    out = {}
    for measure in ("humidity", "temperature"):
        files = [(zone, period, parts[measure]) for zone, periods in groups.items() for period, parts in periods.items()]
        feed = read_feed(spark, [path for _, _, path in files], measure)
        labels = F.array(*[F.struct(
            F.lit(ending(path)).alias("path"), F.lit(zone).alias("zone"), F.lit(str(period)).alias("period"))
            for zone, period, path in sorted(files, key=lambda f: -len(ending(f[2])))])
        decoded = F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))
        match = F.filter(labels, lambda f: decoded.endswith(f["path"]))[0]
        out[measure] = feed.withColumns({"zone": match["zone"], "period": match["period"]}).drop("path")
    return out


def time_column(df: DataFrame) -> str:
    """The timestamp column of a weather table: TMSTAMP if present, else TIMESTAMP."""
    return "TMSTAMP" if "TMSTAMP" in df.columns else "TIMESTAMP"


def weather_table(df: DataFrame) -> DataFrame:
    """A delivered weather table with its time column and names normalised."""
    source = time_column(df)
    typed = df.withColumn(source, parse_time(source)).withColumnRenamed(source, TIME)
    return normalise_weather(typed)


def read_weather(spark: SparkSession, path: str, format: str = "csv") -> DataFrame:
    if format == "csv":
        header = spark.read.option("header", True).csv(path)
        numbers = [c for c in header.columns if c not in ("TMSTAMP", "TIMESTAMP")]
        return weather_table(header.withColumns({c: F.col(c).try_cast("double") for c in numbers}))
    return weather_table(spark.read.format(format).load(path))


def read_readings(spark: SparkSession, path: str, weather=()) -> DataFrame:
    """A processed CSV table; ``weather`` names further double columns. NaN text counts as null."""
    names = spark.read.option("header", True).csv(path).columns
    known = {f.name: f.dataType.simpleString() for f in READINGS}
    types = [f"`{n}` {known.get(n, 'double' if n in weather else 'string')}" for n in names]
    table = spark.read.schema(", ".join(types)).option("header", True).option("nanValue", "__none__").csv(path)
    return table


def union_by_name(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
