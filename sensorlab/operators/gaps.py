"""Where and how long data are missing."""

from pyspark.sql import DataFrame, Window, functions as F

from sensorlab.functions.calendar import floor_div, from_micros, micros, span_micros
from sensorlab.functions.groups import lookup
from sensorlab.functions.missing import is_missing
from sensorlab.operators.ordered import BLOCK, CHUNK, by_position, gap_end, gap_start, neighbours
from sensorlab.schema import KEYS, MEASURES, TIME


def gap_intervals(df: DataFrame, interval: str = "15 minutes", zone: str = "zone", time: str = TIME) -> DataFrame:
    """Intervals with missing measures, anchored at each zone's first time.

    Type (both, temperature, humidity) by which measures miss, completeness by whether all rows of
    the interval miss it; intervals without rows or without gaps are left out.
    """
    width = span_micros(interval)
    rows = df.select(zone, micros(time).alias("_ts"), *[is_missing(c).alias(f"_{c}") for c in MEASURES])
    anchors = lookup(rows.groupBy(zone).agg(F.min("_ts").alias("_anchor")))
    counts = (
        rows.join(anchors, zone)
        .groupBy(zone, (F.col("_ts") - F.pmod(F.col("_ts") - F.col("_anchor"), F.lit(width))).alias("_start"))
        .agg(F.count(F.lit(1)).alias("n"), *[F.count_if(f"_{c}").alias(f"{c[0]}_miss") for c in MEASURES])
    )
    n, t, h = F.col("n"), F.col("t_miss"), F.col("h_miss")
    cases = [
        ((t == n) & (h == n), "both", "complete"),
        (t == n, "temperature", "complete"),
        (h == n, "humidity", "complete"),
        ((t > 0) & (h > 0), "both", "partial"),
        (t > 0, "temperature", "partial"),
        (h > 0, "humidity", "partial"),
    ]
    kind = completeness = None
    for condition, k, full in cases:
        kind = F.when(condition, k) if kind is None else kind.when(condition, k)
        completeness = F.when(condition, full) if completeness is None else completeness.when(condition, full)
    start = from_micros("_start")
    return counts.filter((t > 0) | (h > 0)).select(
        zone, start.alias("time"), F.hour(start).alias("hour"), F.minute(start).alias("minute"),
        F.date_format(start, "yyyy-MM").alias("year_month"), kind.alias("gap_type"),
        completeness.alias("completeness"), F.dayofmonth(start).alias("day"))


def gap_summary(gaps: DataFrame) -> DataFrame:
    """Intervals per zone, month and gap type."""
    return gaps.groupBy("zone", "year_month", "gap_type").agg(F.count("time").alias("total_intervals"))


def gap_runs(df: DataFrame, cols=MEASURES, keys=KEYS, time: str = TIME, chunk: str = CHUNK) -> DataFrame:
    """Runs of consecutive rows missing a measure: start, end, rows, minutes from start to end."""
    near = neighbours(df.withColumns({c: F.when(~is_missing(c), F.col(c)) for c in cols}), cols, keys, time, chunk)
    runs = near.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(c).alias("measure"), gap_start(c).alias("_s"), gap_end(c).alias("_e")) for c in cols
    ]))).filter("_s IS NOT NULL")
    return runs.groupBy(*keys, "measure", "_s", "_e").agg(F.count(F.lit(1)).alias("rows")).select(
        *keys, "measure", from_micros("_s").alias("start_time"), from_micros("_e").alias("end_time"), "rows",
        ((F.col("_e") - F.col("_s")) / 60_000_000.0).alias("minutes"))


def longest_constant_run(df: DataFrame, col: str, group, position: str, digits: int = 3, block: int = BLOCK) -> DataFrame:
    """Per group the longest stretch of equal rounded values and its share of the rows.

    Positions count up without holes. Stretch starts are found inside blocks of positions; one row
    per block then links the last start of a block to the next start after it.
    """
    group = list(group)
    rows = df.select(*group, F.col(position).alias("_i"), F.round(col, digits).alias("_v"))
    same = lambda w: F.lag("_v").over(w).eqNullSafe(F.col("_v")) & F.lag("_i").over(w).isNotNull()
    marked = by_position(rows, group, "_i", 1, 0, {"_same": same}, block)
    marked = marked.withColumn("_b", floor_div(F.col("_i"), block)).withColumn("_start", F.when(~F.col("_same"), F.col("_i")))
    before = Window.partitionBy(*group, "_b").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    blocks = marked.withColumn("_inner", F.col("_start") - F.last("_start", True).over(before)).groupBy(*group, "_b").agg(
        F.min("_start").alias("_from"), F.max("_start").alias("_to"), F.max("_inner").alias("_inner"),
        F.max("_i").alias("_end"), F.count(F.lit(1)).alias("_n"))
    later = Window.partitionBy(*group).orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    end = F.max("_end").over(Window.partitionBy(*group)) + 1
    reach = F.coalesce(F.last("_from", True).over(later), end) - F.col("_to")
    return blocks.withColumn("_reach", reach).groupBy(*group).agg(
        F.greatest(F.max("_inner"), F.max("_reach")).alias("longest"), F.sum("_n").alias("rows")).withColumn(
        "share", F.col("longest") / F.col("rows"))
