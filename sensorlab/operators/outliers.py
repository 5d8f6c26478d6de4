"""Labelling and replacing outliers per period (month by default)."""

from pyspark.sql import DataFrame, functions as F

from sensorlab.functions.calendar import calendar_features, period, period_year
from sensorlab.functions.groups import attach, lookup, quantile_columns
from sensorlab.operators.ordered import CHUNK, rolling_features
from sensorlab.schema import KEYS, MEASURES, TIME


def flag(c: str) -> str:
    """Name of the outlier flag: the first four letters of the measure."""
    return f"is_{c[:4]}_outlier"


def outlier_features(df: DataFrame, cols=MEASURES, keys=KEYS, time: str = TIME, unit: str = "month", by=(),
                     chunk: str = CHUNK) -> DataFrame:
    """Calendar, rolling, difference and z-score features, ``period``, and flags set to 0.

    The z-score uses the mean and sample deviation over ``by`` (all rows by default); a zero
    deviation counts as one. A period of one year is another one than that of the next year.
    """
    within = period_year(time, unit) * 1000 + period(time, unit)
    out = rolling_features(df, cols, 24, keys, time, chunk, within=within).withColumn("period", period(time, unit))
    out = calendar_features(out, time, only=("month", "day", "hour", "day_of_week", "is_weekend"))
    out = z_scores(out, cols, by)
    return out.withColumns({flag(c): F.lit(0) for c in cols})


def z_scores(df: DataFrame, cols=MEASURES, by=()) -> DataFrame:
    stats = []
    for c in cols:
        deviation = F.stddev_samp(c)
        stats += [F.avg(c).alias(f"_{c}_mean"), F.when(deviation > 0, deviation).otherwise(1.0).alias(f"_{c}_std")]
    out = attach(df, df.groupBy(*by).agg(*stats), by)
    return out.withColumns({
        f"{c[:4]}_z_score": (F.col(c) - F.col(f"_{c}_mean")) / F.col(f"_{c}_std") for c in cols
    }).drop(*[f"_{c}_{s}" for c in cols for s in ("mean", "std")])


def label_percentiles(df: DataFrame, cols=MEASURES, by=("zone", "period"), low: float = 0.09, high: float = 0.91) -> DataFrame:
    """Flag values below the low or above the high percentile of their group."""
    bounds = quantile_columns(df, cols, {"low": low, "high": high}, by)
    out = attach(df, bounds, by)
    outside = {flag(c): _flag((F.col(c) < F.col(f"{c}_low")) | (F.col(c) > F.col(f"{c}_high"))) for c in cols}
    return out.withColumns(outside).drop(*[f"{c}_{s}" for c in cols for s in ("low", "high")])


def label_changes(df: DataFrame, cols=MEASURES, by=("zone", "period"), share: float = 0.99) -> DataFrame:
    """Flag rows whose change from the previous row of the period exceeds that percentile of the group.

    Uses the ``{prefix}_step`` columns of ``rolling_features``.
    """
    steps = [f"{c[:4]}_step" for c in cols]
    out = attach(df, quantile_columns(df, steps, {"most": share}, by), by)
    return out.withColumns({
        flag(c): _flag(F.col(s) > F.col(f"{s}_most")) for c, s in zip(cols, steps)
    }).drop(*[f"{s}_most" for s in steps])


def label_outliers(df: DataFrame, cols=MEASURES, by=("zone", "period")) -> DataFrame:
    """Percentile or rapid-change label, both from one pass over the quantiles."""
    steps = [f"{c[:4]}_step" for c in cols]
    bounds = quantile_columns(df, [*cols, *steps], {"low": 0.09, "high": 0.91, "most": 0.99}, by)
    used = [f"{c}_{s}" for c in cols for s in ("low", "high")] + [f"{s}_most" for s in steps]
    out = attach(df, bounds.select(*by, *used), by)
    return out.withColumns({
        flag(c): _flag((F.col(c) < F.col(f"{c}_low")) | (F.col(c) > F.col(f"{c}_high")) | (F.col(s) > F.col(f"{s}_most")))
        for c, s in zip(cols, steps)
    }).drop(*used)


def _flag(condition):
    return F.coalesce(condition.cast("int"), F.lit(0))


def union_labels(df: DataFrame, flags, out: str) -> DataFrame:
    """1 where any of the flags is set."""
    flags = list(flags)
    return df.withColumn(out, F.greatest(*flags) if len(flags) > 1 else F.col(flags[0]))


def outlier_summary(df: DataFrame, cols=MEASURES, by=("period",)) -> DataFrame:
    """Flagged rows, all rows and their ratio per group and measure."""
    by = list(by)
    long = df.select(*by, F.inline(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(flag(c)).alias("f")) for c in cols])))
    return long.groupBy(*by, "measure").agg(
        F.sum("f").alias("outliers"), F.count(F.lit(1)).alias("rows"), F.avg("f").alias("rate"))


def robust_medians(df: DataFrame, cols=MEASURES, by=("zone", "period")) -> DataFrame:
    """Per (group, day, hour) with flagged rows, for each measure: the median of the unflagged values
    there, else of those of the whole group, else of all values of the group."""
    by, cell = list(by), [*by, "day", "hour"]
    plain = df.withColumns({f"_{c}": F.when(F.col(flag(c)) == 0, F.col(c)) for c in cols})
    cells = lookup(df.filter(F.greatest(*[F.col(flag(c)) for c in cols], F.lit(0)) == 1).select(*cell).distinct())
    kept = [f"_{c}" for c in cols]
    fine = quantile_columns(plain.join(cells, cell, "left_semi"), kept, {"fine": 0.5}, cell)
    wide = quantile_columns(plain, [*kept, *cols], {"mid": 0.5}, by)
    return cells.join(lookup(fine), cell, "left").join(lookup(wide), by, "left").select(
        *cell, *[F.coalesce(f"_{c}_fine", f"_{c}_mid", f"{c}_mid").alias(f"{c}_median") for c in cols])


def impute_outliers(df: DataFrame, cols=MEASURES, by=("zone", "period")) -> DataFrame:
    """Replace flagged values by the robust median of their group."""
    medians = lookup(robust_medians(df, cols, by))
    return df.join(medians, [*by, "day", "hour"], "left").withColumns({
        c: F.when(F.col(flag(c)) == 1, F.col(f"{c}_median")).otherwise(F.col(c)) for c in cols
    }).drop(*[f"{c}_median" for c in cols])


def fence_impute(df: DataFrame, c: str = "humidity", by=("zone", "period")) -> DataFrame:
    """Replace values beyond P10/P90 -/+ 2 (P90 - P10) of the group by the median of those inside."""
    by = list(by)
    bounds = quantile_columns(df, [c], {"p10": 0.1, "p90": 0.9}, by)
    spread = 2 * (F.col(f"{c}_p90") - F.col(f"{c}_p10"))
    fenced = attach(df, bounds, by).withColumns({"_low": F.col(f"{c}_p10") - spread, "_high": F.col(f"{c}_p90") + spread})
    inside = F.col(c).between(F.col("_low"), F.col("_high"))
    middle = quantile_columns(fenced.withColumn("_in", F.when(inside, F.col(c))), ["_in"], {"mid": 0.5}, by)
    return attach(fenced, middle, by).withColumn(
        c, F.when((F.col(c) < F.col("_low")) | (F.col(c) > F.col("_high")), F.col("_in_mid")).otherwise(F.col(c))
    ).select(*df.columns)
