"""ARIMA(1,1,1) fill: one fit per gap on all observed values before it."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from sensorlab.functions.calendar import floor_div
from sensorlab.operators.ordered import CHUNK, running_count
from sensorlab.schema import KEYS, MEASURES, TIME

# Candidate moving-average coefficients; for each the best autoregressive one has a closed form.
THETAS = np.arange(-99, 100) / 100
# Observed values that a task holds, and how many before them run the errors up: 0.99 ** 4096 is about 1e-18.
BLOCK, WARM = 8192, 4096


def walk(values: np.ndarray, first: int, lead: int, sums: np.ndarray = None, wanted=()) -> tuple:
    """Forecasts after the values with the ranks in ``wanted``, and the sums that fits need, over ``values``.

    ``first`` is the rank of the first value; the first ``lead`` values only run the errors up. With the
    differences d and a coefficient theta, u and w filter d and the difference before it by
    ``x - theta * last``, so that the error of any phi is ``u - phi * w`` and its squared sum needs the sums of
    u * u, u * w and w * w only. They start from ``sums``, those of all values before.
    """
    sums = np.zeros((3, len(THETAS))) if sums is None else sums.reshape(3, -1).copy()
    d, x, out, wanted = np.diff(values), np.zeros((2, len(THETAS))), {}, set(wanted)
    for j, value in enumerate(values):
        if j >= 2:
            x = d[[j - 1, j - 2], None] - THETAS * x
            if j >= lead:
                sums[:2] += x[0] * x
                sums[2] += x[1] * x[1]
        if first + j in wanted:
            out[first + j] = float(value) if first + j < 4 else _predict(value, d[j - 1], x, sums)
    return out, sums


def _predict(value: float, last: float, x: np.ndarray, sums: np.ndarray) -> float:
    uu, uw, ww = sums
    phi = np.clip(np.divide(uw, ww, out=np.zeros_like(uw), where=ww > 0), -0.99, 0.99)
    best = int(np.argmin(uu - 2 * phi * uw + phi * phi * ww))
    return float(value + phi[best] * last + THETAS[best] * (x[0, best] - phi[best] * x[1, best]))


def forecast_next(values: np.ndarray) -> float:
    """One-step forecast of ARIMA(1,1,1) fitted by conditional least squares.

    With fewer than four values, or without any change in them, the last value is returned.
    """
    return walk(np.asarray(values, float), 1, 0, wanted=[len(values)])[0].get(len(values), np.nan)


def fill_arima(df: DataFrame, cols=MEASURES, keys=KEYS, time: str = TIME, block: int = BLOCK, warm: int = WARM, chunk: str = CHUNK) -> DataFrame:
    """Fill every gap with the forecast from all observed values before it.

    All rows of a gap share their history, so a gap takes one fit. Observed rows are numbered per series and
    grouped in blocks, each with the ``warm`` values before it; the sums of earlier blocks are added up per
    series and coefficient, so a task holds ``block + warm`` values however long the series is and every fit
    still rests on the whole history. Leading gaps stay missing. Equal times are ordered by their value.
    """
    if not 2 <= warm <= block:
        raise ValueError("warm must be from 2 to block")
    keys, out, group = list(keys), df, [*keys, "_block"]
    key_fields = [df.schema[k] for k in keys]
    sums_schema = T.StructType([*key_fields, T.StructField("_block", T.LongType()), T.StructField("_sums", T.ArrayType(T.DoubleType()))])
    schema = T.StructType([*key_fields, T.StructField("_rank", T.LongType()), T.StructField("_f", T.DoubleType())])

    def ordered(seen: pd.DataFrame) -> tuple:
        seen = seen.sort_values("_rank")
        ranks = seen["_rank"].to_numpy()
        return seen["_v"].to_numpy(), int(ranks[0]), int((ranks <= seen["_block"].iloc[0] * block).sum())

    def add_up(seen: pd.DataFrame) -> pd.DataFrame:
        row = {k: [seen[k].iloc[0]] for k in group}
        return pd.DataFrame({**row, "_sums": [walk(*ordered(seen))[1].ravel()]})

    def fit(gaps: pd.DataFrame, seen: pd.DataFrame) -> pd.DataFrame:
        asked = gaps[gaps["_rank"].notna()]
        if asked.empty or seen.empty:
            return pd.DataFrame(columns=schema.names, dtype=object)
        before = gaps["_sums"].dropna()
        ranks = asked["_rank"].to_numpy().astype(np.int64)
        found = walk(*ordered(seen), None if before.empty else np.array(before.iloc[0], float), ranks)[0]
        return pd.DataFrame({**{k: asked[k].to_numpy() for k in keys}, "_rank": ranks, "_f": [found[r] for r in ranks.tolist()]})

    for c in cols:
        ranked = running_count(out, F.col(c).isNotNull(), "_rank", keys, time, chunk, [c])
        number = floor_div(F.col("_rank") - 1, block)
        late = F.col("_rank") > (number + 1) * block - warm
        observed = ranked.filter(F.col(c).isNotNull()).select(
            *keys, "_rank", F.col(c).cast("double").alias("_v"), F.explode(F.when(late, F.array(number, number + 1)).otherwise(F.array(number))).alias("_block"))
        # The block after the last one holds warm-up values only.
        sums = observed.groupBy(*group).applyInPandas(add_up, sums_schema)
        earlier = Window.partitionBy(*keys, "_i").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        before = sums.select(*group, F.posexplode("_sums").alias("_i", "_s")).withColumn("_s", F.sum("_s").over(earlier)).filter(
            "_s IS NOT NULL").groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("_i", "_s"))).alias("_sums"))
        before = before.select(*group, F.lit(None).cast("long").alias("_rank"), F.col("_sums._s").alias("_sums"))
        wanted = ranked.filter(F.col(c).isNull() & (F.col("_rank") > 0)).select(*keys, number.alias("_block"), "_rank").distinct()
        left = wanted.withColumn("_sums", F.lit(None).cast("array<double>")).unionByName(before)
        left, right = left.toDF(*left.columns), observed.toDF(*observed.columns)
        forecasts = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(fit, schema)
        out = ranked.join(forecasts, [*keys, "_rank"], "left").withColumn(c, F.coalesce(c, "_f")).select(*df.columns)
    return out
