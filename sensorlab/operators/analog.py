"""Filling a target period from the most similar moments of a reference period."""

from pyspark.sql import Column, DataFrame, functions as F

from sensorlab.functions.calendar import calendar_features
from sensorlab.functions.groups import attach, scale_stats
from sensorlab.functions.missing import clamp
from sensorlab.operators.align import feature_columns
from sensorlab.operators.knn import knn_join
from sensorlab.operators.ordered import CHUNK, fill_chain
from sensorlab.schema import ANALOG_WEIGHTS, KEYS, MEASURES, TIME
from sensorlab.session import stage

CLOCK = ["hour", "day_of_week", "is_weekend"]


def trend_means(df: DataFrame, before: Column, after: Column, cols=MEASURES, keys=KEYS) -> DataFrame:
    """Per series and measure the mean before and after a period, and their difference."""
    agg = []
    for c in cols:
        agg += [F.avg(F.when(before, F.col(c))).alias(f"{c}_before"), F.avg(F.when(after, F.col(c))).alias(f"{c}_after")]
    return df.groupBy(*keys).agg(*agg).withColumns({
        f"{c}_trend": F.coalesce(F.col(f"{c}_after") - F.col(f"{c}_before"), F.lit(0.0)) for c in cols})


def weighted_features(df: DataFrame, reference: Column, target: Column, features, keys=KEYS, weights=ANALOG_WEIGHTS) -> DataFrame:
    """Rows of both periods with each feature scaled by the reference period of its series and weighted."""
    rows = df.withColumn("_period", F.when(reference, "reference").when(target, "target")).filter("_period IS NOT NULL")
    stats = scale_stats(rows.filter("_period = 'reference'"), features, keys)
    scaled = attach(rows, stats, keys)
    return scaled.withColumns({
        f"_f_{f}": (F.col(f) - F.col(f"_{f}_mean")) / F.col(f"_{f}_std") * weights.get(f, 1.0) for f in features
    }).drop(*[f"_{f}_{s}" for f in features for s in ("mean", "std")])


def fill_analog(df: DataFrame, reference: Column, target: Column, before: Column, after: Column, cols=MEASURES, env=None,
                keys=KEYS, time: str = TIME, k: int = 5, chunk: str = CHUNK) -> DataFrame:
    """Missing rows of the target period from the k nearest reference rows of the same series.

    Nearness is over weighted weather and clock features; the mean is weighted by inverse distance,
    shifted along the trend between the periods before and after, and humidity is clamped to 0-100.
    Donors must hold the measure.
    """
    keys = list(keys)
    env = feature_columns(df, env if env is not None else [w for w in ANALOG_WEIGHTS if w not in CLOCK])
    features = [*env, *CLOCK]
    rows = calendar_features(df, time, only=("hour", "day_of_week", "is_weekend"))
    slices = rows.withColumn("_slice", F.when(reference, 0).when(target, 1)).filter("_slice IS NOT NULL")
    if env:
        slices = fill_chain(slices, env, [*keys, "_slice"], time, chunk, interpolate=False)
    # Read by the searches of all measures.
    ready = stage(weighted_features(slices, reference, target, features, keys))
    names = [f"_f_{f}" for f in features]
    trend = trend_means(df, before, after, cols, keys)
    out = attach(df, trend.select(*keys, *[f"{c}_trend" for c in cols]), keys)
    for c in cols:
        near = knn_join(
            # Of several targets at one time, the one with the smallest features.
            ready.filter((F.col("_slice") == 1) & F.col(c).isNull()).groupBy(*keys, time).agg(F.min(F.struct(*names)).alias("_least")).select(*keys, time, "_least.*"),
            ready.filter((F.col("_slice") == 0) & F.col(c).isNotNull()).select(*keys, F.col(time).alias("_at"), c, *names),
            names, k, [time], "_at", [c], keys)
        weight = 1 / (F.col("distance") + 1e-5)
        mean = near.groupBy(*keys, time).agg((F.sum(F.col(c) * weight) / F.sum(weight)).alias("_analog"))
        share = F.dayofmonth(time) / F.dayofmonth(F.last_day(time))
        value = F.col("_analog") + F.col(f"{c}_trend") * share
        value = clamp(value) if c == "humidity" else value
        out = out.join(mean, [*keys, time], "left").withColumn(c, F.coalesce(F.col(c), value)).drop("_analog")
    return out.select(*df.columns)
