"""Merging feeds, zones and weather onto the same series and times."""

from pyspark.sql import DataFrame, Window, functions as F

from sensorlab.functions.calendar import floor_div, micros, span_micros
from sensorlab.functions.missing import is_missing, is_valid
from sensorlab.schema import KEYS, MEASURES, SENTINEL, TIME, WEATHER_NAMES


def measure_merge(humidity: DataFrame, temperature: DataFrame, keys=KEYS, time: str = TIME, order: str = "event_id") -> DataFrame:
    """Full outer merge of the two feeds on ``(keys, time)``.

    The first row in source order wins on a repeated key; a side without a row gives -1, a present
    null stays null. Both feeds pass one shuffle as a union, each row pre-aggregated before it.
    """
    group = [*keys, time]
    feeds = {"humidity": humidity, "temperature": temperature}
    both = None
    for measure, feed in feeds.items():
        part = feed.select(*group, F.lit(measure).alias("_measure"), F.col(order).alias("_order"), F.col(measure).alias("_value"))
        both = part if both is None else both.unionByName(part)
    firsts = [
        F.min_by(F.when(F.col("_measure") == m, F.struct("_value")), F.when(F.col("_measure") == m, F.col("_order"))).alias(m)
        for m in feeds
    ]
    merged = both.groupBy(*group).agg(*firsts)
    return merged.select(*group, *[
        F.when(F.col(m).isNull(), F.lit(SENTINEL)).otherwise(F.col(f"{m}._value")).alias(m) for m in feeds
    ])


def zone_sync(df: DataFrame, zones=("Zone 1", "Zone 2"), on=(TIME,), order=("device_id", "house"), cols=MEASURES) -> DataFrame:
    """Copy a measure between two zones at the same moment where one has it and the other lacks it.

    The first row of each zone at that moment decides and donates; all rows of the receiving zone
    at that moment are set. Measures move independently. What stays null becomes -1.
    """
    on, (a, b) = list(on), zones
    pair = df.filter(F.col("zone").isin(a, b))
    firsts = pair.groupBy(*on).agg(*[
        F.min_by(F.when(F.col("zone") == z, F.struct(*cols)), F.when(F.col("zone") == z, F.struct(*order))).alias(f"_{i}")
        for i, z in enumerate(zones)
    ])
    joined = df.join(firsts, on, "left")
    out = {}
    for c in cols:
        first_a, first_b = F.col(f"_0.{c}"), F.col(f"_1.{c}")
        shared = F.col("_0").isNotNull() & F.col("_1").isNotNull()
        out[c] = F.coalesce(
            F.when(shared & (F.col("zone") == a) & is_missing(first_a) & is_valid(first_b), first_b)
            .when(shared & (F.col("zone") == b) & is_missing(first_b) & is_valid(first_a), first_a)
            .otherwise(F.col(c)), F.lit(SENTINEL))
    return joined.withColumns(out).select(*df.columns)


def asof_join(left: DataFrame, right: DataFrame, tolerance: str = "1 minute", on: str = TIME, by=()) -> DataFrame:
    """Each left row with the last right row at or before it, no older than ``tolerance``.

    The distinct left moments are matched first, in buckets as long as the tolerance; a right row is
    copied into its own bucket and the next. The left rows then take the match by equality, so no
    bucket of left rows gathers in one task and no pairs are formed.
    """
    by, width = list(by), span_micros(tolerance)
    values = [c for c in right.columns if c not in (on, *by)]
    ts = micros(on)
    moments = left.select(*by, on).distinct().select(
        *by, ts.alias("_ts"), F.lit(1).alias("_side"), F.lit(None).cast(_struct_type(right, values)).alias("_r"))
    known = right.filter(F.col(on).isNotNull()).select(
        *by, ts.alias("_ts"), F.lit(0).alias("_side"), F.struct(ts.alias("_at"), *values).alias("_r"))
    bucket = floor_div(F.col("_ts"), width)
    rows = known.withColumn("_bucket", F.explode(F.array(bucket, bucket + 1))).unionByName(moments.withColumn("_bucket", bucket))
    order = Window.partitionBy(*by, "_bucket").orderBy("_ts", "_side", "_r").rowsBetween(Window.unboundedPreceding, 0)
    matched = (
        rows.withColumn("_m", F.last("_r", True).over(order)).filter("_side = 1")
        .withColumn("_m", F.when(F.col("_ts") - F.col("_m._at") <= width, F.col("_m")))
        .select(*by, F.timestamp_micros("_ts").cast("timestamp_ntz").alias(on), *[F.col(f"_m.{c}").alias(c) for c in values])
    )
    return left.join(matched, [*by, on], "left")


def _struct_type(right: DataFrame, values):
    fields = ", ".join(f"`{c}` {right.schema[c].dataType.simpleString()}" for c in values)
    return f"struct<_at bigint, {fields}>".replace("` ", "`: ").replace("_at bigint", "_at: bigint")


def weather_join(left: DataFrame, weather: DataFrame, on: str = TIME) -> DataFrame:
    """Left equality join with the weather table on time."""
    return left.join(weather, [on], "left")


def normalise_weather(df: DataFrame, names=WEATHER_NAMES) -> DataFrame:
    """Rename delivered weather columns to the names the operators use."""
    return df.withColumnsRenamed(names)


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """Drop those of the columns that are present."""
    return df.drop(*cols)


def feature_columns(df: DataFrame, wanted=None, exclude=()) -> list:
    """The wanted columns that exist, or all but the excluded ones."""
    present = df.columns if wanted is None else [c for c in wanted if c in df.columns]
    return [c for c in present if c not in set(exclude)]


def union_all(frames, labels=None, label: str = "label") -> DataFrame:
    """Union by name with absent columns as null, optionally labelled per input."""
    out = None
    for i, df in enumerate(frames):
        df = df if labels is None else df.withColumn(label, F.lit(labels[i]))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def distinct_union(frames, cols) -> DataFrame:
    """Distinct union of the given columns over all inputs."""
    out = None
    for df in frames:
        out = df.select(*cols) if out is None else out.union(df.select(*cols))
    return out.distinct()


def distinct_keys(humidity: DataFrame, temperature: DataFrame, keys=("device_id", "house")) -> DataFrame:
    """Key combinations that occur in either feed."""
    return distinct_union([humidity, temperature], keys)
