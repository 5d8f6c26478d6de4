"""Isolation forest per group: small trees on key-drawn samples, scored in parallel."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sensorlab.functions.draws import uniform
from sensorlab.functions.groups import attach, lookup, quantile_columns, with_models
from sensorlab.session import stage


def average_path(n):
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3)
    long = 2 * (np.log(safe - 1) + 0.5772156649015329) - 2 * (safe - 1) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, long))


def grow(points: np.ndarray, rng: np.random.Generator) -> dict:
    """One tree as parallel arrays; a leaf has feature -1 and its mean path length as threshold."""
    limit = int(np.ceil(np.log2(max(len(points), 2))))
    feature, threshold, left, right = [], [], [], []

    def node(rows, depth):
        at = len(feature)
        feature.append(-1)
        threshold.append(float(depth + average_path(len(rows))))
        left.append(-1)
        right.append(-1)
        low, high = rows.min(axis=0), rows.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(usable):
            return at
        f = int(rng.choice(usable))
        cut = float(rng.uniform(low[f], high[f]))
        below = rows[:, f] < cut
        if below.all() or not below.any():
            return at
        feature[at], threshold[at] = f, cut
        left[at] = node(rows[below], depth + 1)
        right[at] = node(rows[~below], depth + 1)
        return at

    node(points, 0)
    return {"feature": feature, "threshold": threshold, "left": left, "right": right}


def anomaly_score(points: np.ndarray, trees, sample: int) -> np.ndarray:
    """2 ** (-mean path / average path): near 1 for points that isolate early."""
    total = np.zeros(len(points))
    for tree in trees:
        feature, threshold = np.asarray(tree["feature"]), np.asarray(tree["threshold"])
        left, right = np.asarray(tree["left"]), np.asarray(tree["right"])
        at = np.zeros(len(points), dtype=int)
        inner = feature[at] >= 0
        while inner.any():
            rows = np.flatnonzero(inner)
            here = at[rows]
            below = points[rows, feature[here]] < threshold[here]
            at[rows] = np.where(below, left[here], right[here])
            inner = feature[at] >= 0
        total += threshold[at]
    return 2.0 ** (-total / len(trees) / max(float(average_path(sample)), 1e-9))


def isolation_scores(df: DataFrame, features, key, by=(), trees: int = 100, sample: int = 256, seed: int = 42) -> DataFrame:
    """Adds ``score``. Nulls count as the group's median; ``key`` is a text column expression naming the row.

    Sampling is part of the method: about ``trees * sample`` rows per group are drawn by key (all of a smaller group), and
    each tree takes up to ``sample`` of them. All rows are scored.
    """
    by, features = list(by), list(features)
    middle = quantile_columns(df, features, {"mid": 0.5}, by)
    out = attach(df, middle, by).withColumn("_key", key).withColumn(
        "_x", F.array(*[F.coalesce(F.col(f).cast("double"), f"{f}_mid", F.lit(0.0)) for f in features])
    ).drop(*[f"{f}_mid" for f in features])
    out = out.withColumn("_group", F.concat_ws("|", F.lit(""), *[F.col(b).cast("string") for b in by]))

    # Draws by thresholds on the key's hash: a group's rows are counted, never ranked.
    sizes = lookup(out.groupBy("_group").agg(F.count(F.lit(1)).alias("_n")))
    most = float(trees * sample)
    pool = out.select("_group", "_key", "_x").join(sizes, "_group").filter(uniform(F.col("_key"), "pool", seed) < most / F.col("_n"))
    pool = pool.withColumn("_n", F.least("_n", F.lit(trees * sample))).withColumn("_tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    draw = F.pmod(F.xxhash64("_key", "_tree", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    pool = pool.withColumn("_u", draw).filter(F.col("_u") < 2.0 * sample / F.col("_n"))
    order = Window.partitionBy("_group", "_tree").orderBy("_u", "_key")
    pool = pool.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= sample)
    schema = ("_group string, n int, feature array<int>, threshold array<double>, left array<int>, right array<int>")

    def plant(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_u", "_key"])
        rng = np.random.default_rng([seed, int(rows["_tree"].iloc[0])])
        tree = grow(np.stack(rows["_x"].to_numpy()), rng)
        return pd.DataFrame({"_group": [rows["_group"].iloc[0]], "n": [len(rows)], **{k: [v] for k, v in tree.items()}})

    planted = stage(pool.groupBy("_group", "_tree").applyInPandas(plant, schema))
    forests = planted.groupBy("_group").agg(F.max("n").alias("n"), F.collect_list(F.struct("feature", "threshold", "left", "right")).alias("trees"))

    def score(rows: pa.Table, forest: pa.Table) -> pa.Table:
        if not forest.num_rows:
            return rows.append_column("score", pa.nulls(rows.num_rows, pa.float64()))
        points = np.stack([np.asarray(x) for x in rows.column("_x").to_pylist()])
        found = anomaly_score(points, forest.column("trees")[0].as_py(), forest.column("n")[0].as_py())
        return rows.append_column("score", pa.array(found))

    # Forests meet the rows of their group by a join, a hot group in many pieces.
    return with_models(out, forests, ["_group"], F.col("_key"), score, "score double").drop("_key", "_x", "_group")


def isolation_labels(df: DataFrame, features, key, out: str, by=(), contamination: float = 0.001, **options) -> DataFrame:
    """Flag the ``contamination`` share of rows with the highest scores in their group."""
    scored = isolation_scores(df, features, key, by, **options)
    cut = quantile_columns(scored, ["score"], {"cut": 1 - contamination}, by)
    return attach(scored, cut, by).withColumn(out, (F.col("score") > F.col("score_cut")).cast("int")).drop("score", "score_cut")
