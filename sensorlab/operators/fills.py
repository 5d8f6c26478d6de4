"""Imputation methods over keyed series, and running several of them side by side."""

from pyspark.sql import DataFrame, functions as F

from sensorlab.functions.calendar import span_micros
from sensorlab.functions.groups import attach, quantile_columns
from sensorlab.operators import ordered
from sensorlab.operators.ordered import CHUNK, drop_neighbours, gap_end, gap_start, hermite, linear, neighbours
from sensorlab.schema import KEYS, MEASURES, TIME


def fill_mean(df: DataFrame, cols=MEASURES, by=()) -> DataFrame:
    means = df.groupBy(*by).agg(*[F.avg(c).alias(f"_{c}") for c in cols])
    return _coalesce(attach(df, means, by), cols)


def fill_median(df: DataFrame, cols=MEASURES, by=()) -> DataFrame:
    middle = quantile_columns(df, cols, {"mid": 0.5}, by)
    return _coalesce(attach(df, middle.withColumnsRenamed({f"{c}_mid": f"_{c}" for c in cols}), by), cols)


def _coalesce(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.coalesce(c, f"_{c}") for c in cols}).drop(*[f"_{c}" for c in cols])


def fill_locf(df: DataFrame, cols=MEASURES, keys=KEYS, chunk: str = CHUNK) -> DataFrame:
    return ordered.fill(df, ordered.locf, cols, keys, chunk=chunk, sides="p")


def fill_nocb(df: DataFrame, cols=MEASURES, keys=KEYS, chunk: str = CHUNK) -> DataFrame:
    return ordered.fill(df, ordered.nocb, cols, keys, chunk=chunk, sides="n")


def fill_linear(df: DataFrame, cols=MEASURES, keys=KEYS, limit: int = None, both: bool = False, axis: str = "rn",
                chunk: str = CHUNK) -> DataFrame:
    return ordered.fill(df, lambda c: linear(c, axis, limit, both), cols, keys, chunk=chunk)


def fill_spline(df: DataFrame, cols=MEASURES, keys=KEYS, chunk: str = CHUNK) -> DataFrame:
    """Cubic curve through the two valid points on each side of a gap."""
    return ordered.fill(df, hermite, cols, keys, chunk=chunk, detail=True)


def tiered(c: str, short: str = "15 minutes", medium: str = "2 days", limit: int = 15):
    """Straight line for short gaps, cubic for medium ones, by the time from first to last missing row."""
    duration = gap_end(c) - gap_start(c)
    return (
        F.when(F.col(c).isNotNull(), F.col(c))
        .when(duration <= span_micros(short), linear(c, limit=limit))
        .when(duration <= span_micros(medium), hermite(c))
    )


def fill_tiered(df: DataFrame, cols=MEASURES, keys=KEYS, time: str = TIME, short: str = "15 minutes", medium: str = "2 days",
                limit: int = 15, long_gap: str = None, env=None, chunk: str = CHUNK) -> DataFrame:
    """Fill gaps by their duration; those longer than ``medium`` stay missing by default.

    ``limit`` bounds the rows a line fills, so a run one row longer than the limit keeps its last
    row missing although its duration is short. ``long_gap`` "pattern" or "seasonal" fills the long
    gaps too, from the given data and not from the shorter gaps filled here.
    """
    near = neighbours(df, cols, keys, time, chunk)
    out = near.withColumns({c: tiered(c, short, medium, limit) for c in cols})
    if long_gap is not None:
        from sensorlab.operators import patterns

        for c in cols:
            values = patterns.long_gap_values(df, c, long_gap, medium, keys, time, env or (), chunk=chunk, order=cols)
            out = out.join(values.withColumnRenamed("value", "_long"), [*keys, "_rn"], "left").withColumn(
                c, F.coalesce(c, "_long")).drop("_long")
    return drop_neighbours(out, cols).select(*df.columns)


def fill_knn_measure(df: DataFrame, cols=MEASURES, k: int = 60, by=()) -> DataFrame:
    from sensorlab.operators import knn

    return knn.fill_knn(df, cols, k, by)


def fill_arima(df: DataFrame, cols=MEASURES, keys=KEYS) -> DataFrame:
    from sensorlab.operators import arima

    return arima.fill_arima(df, cols, keys)


METHODS = {
    "mean": fill_mean,
    "median": fill_median,
    "locf": fill_locf,
    "nocb": fill_nocb,
    "linear": fill_linear,
    "spline": fill_spline,
    "knn": fill_knn_measure,
    "arima": fill_arima,
    "custom": fill_tiered,
}


def register(name: str, method) -> None:
    """Add a method ``(df, cols, **options) -> df`` under a name."""
    METHODS[name] = method


def impute(df: DataFrame, method: str, cols=MEASURES, **options) -> DataFrame:
    if method not in METHODS:
        raise ValueError(f"{method!r} is none of {sorted(METHODS)}")
    return METHODS[method](df, cols, **options)


# Methods that are expressions over neighbours(): several of them share one pass over the series.
EXPRESSIONS = {"locf": ordered.locf, "nocb": ordered.nocb, "linear": linear, "spline": hermite, "custom": tiered}


def impute_all(df: DataFrame, methods, cols=MEASURES, options: dict = None, keys=KEYS, chunk: str = CHUNK) -> DataFrame:
    """The results of several methods, labelled in the column ``method``."""
    options, cols = options or {}, list(cols)
    shared = [m for m in methods if m in EXPRESSIONS and not options.get(m, {}).get("long_gap")]
    frames = []
    if shared:
        near = neighbours(df, cols, keys, chunk=chunk)
        kept = [c for c in df.columns if c not in cols]
        frames.append(near.select(*kept, F.inline(F.array(*[
            F.struct(F.lit(m).alias("method"), *[EXPRESSIONS[m](c, **options.get(m, {})).alias(c) for c in cols])
            for m in shared
        ]))).select(*df.columns, "method"))
    for m in methods:
        if m not in shared:
            frames.append(impute(df, m, cols, **options.get(m, {})).withColumn("method", F.lit(m)))
    out = frames[0]
    for part in frames[1:]:
        out = out.unionByName(part)
    return out
