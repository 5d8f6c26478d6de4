"""Anomaly detection: synthetic training data, feature preparation and four detectors."""

from dataclasses import replace
from itertools import product

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from sensorlab.functions.calendar import calendar_features
from sensorlab.functions.draws import key_text, normal, poisson_one, uniform
from sensorlab.functions.groups import attach, fill_mode, one_hot, quantiles, scale_stats, standardise
from sensorlab.functions.missing import require_no_nulls
from sensorlab.operators import boosting
from sensorlab.operators.boosting import Setting
from sensorlab.operators.knn import knn_join
from sensorlab.operators.ordered import CHUNK, fill, linear
from sensorlab.schema import KEYS, TIME
from sensorlab.session import stage
from sensorlab.sources import store

# Numeric columns filled and scaled before detection.
NUMERIC = ["outside_temperature", "outside_humidity", "BP", "WS", "WD_Avg", "WSgust_Max", "Rain_mm_Tot",
           "hour", "day_of_week", "month", "day"]

# The search grids.
BOOSTED_GRID = {
    "maxIter": [50, 100, 200, 300],
    "stepSize": [0.01, 0.02, 0.05],
    "maxDepth": [4, 6, 8],
    "subsamplingRate": [0.8, 0.9, 1.0],
    "featureSubsetStrategy": ["0.8", "0.9", "1.0"],
}
NEIGHBOUR_GRID = {"n_neighbors": [20, 50, 100], "contamination": [0.05, 0.1, 0.2]}
SMOOTHING_GRID = [1e-9, 1e-8, 1e-7]


# --- synthetic data ---------------------------------------------------------------------------

def bootstrap(df: DataFrame, keys=KEYS, time: str = TIME, seed: int = 42) -> DataFrame:
    """Resample with replacement: every row occurs a Poisson(1) number of times, numbered in ``copy``."""
    times = poisson_one(key_text(keys, time), "bootstrap", seed)
    return df.withColumn("_times", times).filter("_times > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times")


def sample_with_replacement(df: DataFrame, rows: int = None, seed: int = 42) -> DataFrame:
    """Plain resample to about ``rows`` rows (all by default); depends on the partitioning."""
    fraction = 1.0 if rows is None else rows / max(df.count(), 1)
    return df.sample(withReplacement=True, fraction=fraction, seed=seed)


def inject_anomalies(df: DataFrame, numeric, keys=(*KEYS, "copy"), time: str = TIME, rate: float = 0.1,
                     temperature: str = "inside_temperature", humidity: str = "inside_humidity", seed: int = 42) -> DataFrame:
    """Add noise of a tenth of its deviation to each numeric column, and label and shift a share of the rows.

    A labelled row gains 60 to 100 degrees and 0 to 10 points of humidity.
    """
    key = key_text(keys, time)
    out = attach(df, df.agg(*[F.coalesce(F.stddev_samp(c), F.lit(0.0)).alias(f"_{c}_std") for c in numeric]))
    noisy = {c: F.col(c) + normal(key, c, seed) * F.col(f"_{c}_std") * 0.1 for c in numeric}
    out = out.withColumns(noisy).withColumn("anomaly", (uniform(key, "anomaly", seed) < rate).cast("int"))
    hit = F.col("anomaly") == 1
    return out.withColumns({
        temperature: F.when(hit, F.col(temperature) + 60 + 40 * uniform(key, "hot", seed)).otherwise(F.col(temperature)),
        humidity: F.when(hit, F.col(humidity) + 10 * uniform(key, "wet", seed)).otherwise(F.col(humidity)),
    }).drop(*[f"_{c}_std" for c in numeric])


def prepare(df: DataFrame, keys=KEYS, time: str = TIME, encode=("zone", "device_id"), values: dict = None,
            scaler: DataFrame = None, numeric=NUMERIC, chunk: str = CHUNK):
    """Clock features, filled and scaled numeric columns, mode-filled text, 0/1 columns for ids.

    Returns the frame and the scaler (one row of means and deviations), to be passed in again so that
    data to be scored are scaled as the training data were. ``values`` fixes the encoded ids likewise.
    """
    out = calendar_features(df, time, only=("hour", "day_of_week", "month", "day", "is_weekend"))
    numeric = [c for c in numeric if c in out.columns]
    given = [c for c in numeric if c in df.columns]
    if given:
        out = fill(out, lambda c: F.coalesce(linear(c, both=True), F.lit(0.0)), given, keys, time, chunk)
    text = [n for n, t in out.dtypes if t == "string" and n not in ("house", "_row_text", time)]  # a row's key has no mode worth its pass
    out = fill_mode(stage(out), text)
    if "house" not in encode:
        out = out.drop("house")
    # Read by the encoding, the scaling and the null check.
    out = stage(out.withColumns({c: F.col(c).cast("double") for c in numeric}))
    for c in encode:
        out = one_hot(out, c, (values or {}).get(c))
    scaler = scale_stats(out, numeric) if scaler is None else scaler
    return require_no_nulls(standardise(out, numeric, stats=scaler)), scaler


def feature_names(df: DataFrame, exclude=(TIME, "anomaly", "copy", "row")) -> list:
    return sorted(n for n, t in df.dtypes if n not in exclude and t in ("double", "int", "bigint"))


# --- detectors --------------------------------------------------------------------------------
# Each has fit(df, features, label) and score(df) -> df with ``predicted`` (0/1) and ``score``.

class BoostedTrees:
    """Boosted trees with a cross-validated grid search on F1.

    All settings and folds grow in the same steps, and so does each setting on all rows. A smaller number of trees is a
    prefix of the longest run. The setting with the highest mean F1 over the folds is kept, the first one on ties, with
    the parameters' names in alphabetical order and the last of them running fastest.
    """

    name = "boosted_trees"

    def __init__(self, grid: dict = None, folds: int = 5, seed: int = 42):
        self.grid = grid or BOOSTED_GRID
        self.folds, self.seed, self.model = folds, seed, None

    def settings(self, features: int) -> dict:
        """The grid's combinations in order: parameters -> (settings that may be shared, number of trees)."""
        names = sorted(self.grid)
        out = {}
        for values in product(*[self.grid[n] for n in names]):
            chosen = dict(zip(names, values))
            setting = Setting(max(self.grid.get("maxIter", [100])), chosen.get("stepSize", 0.1), chosen.get("maxDepth", 5),
                              chosen.get("subsamplingRate", 1.0), float(chosen.get("featureSubsetStrategy", 1.0)))
            # Shares that draw the same number of columns draw the same columns.
            setting = replace(setting, columns=setting.drawn(features) / features)
            out[values] = chosen, setting, chosen.get("maxIter", 100)
        return out

    def fit(self, df, features, label="anomaly", row="row"):
        features = list(features)
        combinations = self.settings(len(features))
        unique = list(dict.fromkeys(setting for _, setting, _ in combinations.values()))
        runs = [replace(s, held=h) for s in unique for h in (-1, *range(self.folds))]
        key = F.col(row) if row in df.columns else F.concat_ws("|", *features)
        fold = F.pmod(F.xxhash64(key, F.lit("fold")), F.lit(self.folds))
        table = df.filter(F.col(label).isNotNull())
        edges = boosting.bin_edges(table, features)[()]
        blocks = boosting.row_blocks(table, features, [edges], label, fold, key, settings=len(runs))
        lengths = sorted({n for _, _, n in combinations.values()})
        grown = boosting.boost(blocks, [len(e) + 1 for e in edges], runs, counts_at=lengths, seed=self.seed)
        self.curve = {}
        for chosen, setting, trees in combinations.values():
            first = unique.index(setting) * (self.folds + 1)
            self.curve[tuple(sorted(chosen.items()))] = float(np.mean([_f1(grown.tallies.get((first + 1 + h, trees))) for h in range(self.folds)]))
        best = max(combinations.values(), key=lambda c: self.curve[tuple(sorted(c[0].items()))])
        self.best, setting, trees = best
        nodes = boosting.node_table([grown.trees[unique.index(setting) * (self.folds + 1)][:trees]], features, [edges])
        self.model = [tuple(r[c] for c in ("tree", "node", "feature", "threshold", "value")) for r in nodes.to_pylist()]
        return self

    def score(self, df):
        return boosting.score_forest(df, boosting.Forest(_fitted(self.model)))

    def save(self, path):
        from pyspark.sql import SparkSession

        nodes = SparkSession.getActiveSession().createDataFrame(_fitted(self.model), boosting.TREE_NODES)
        store.save(path, {"nodes": nodes}, {"best": self.best})

    def load(self, path):
        from pyspark.sql import SparkSession

        tables, info = store.load(SparkSession.getActiveSession(), path)
        self.best = info["best"]
        self.model = [tuple(r) for r in tables["nodes"].select("tree", "node", "feature", "threshold", "value").collect()]
        return self


def _f1(counts) -> float:
    """F1 of label 1 from counts of (label, predicted) = 00, 01, 10, 11; 0 where there is none."""
    if counts is None or not counts[3]:
        return 0.0
    return float(2 * counts[3] / (2 * counts[3] + counts[1] + counts[2]))


class NaiveBayes:
    """Gaussian naive Bayes; the smoothing is the one with the best training accuracy, the first on ties.

    Training is one aggregation; scoring is one column expression.
    """

    name = "naive_bayes"

    def __init__(self, grid=SMOOTHING_GRID):
        self.grid, self.model = list(grid), None

    def fit(self, df, features, label="anomaly"):
        features = list(features)
        moments = [F.count(F.lit(1)).alias("n")]
        for f in features:
            moments += [F.avg(f).alias(f"m_{f}"), F.var_pop(f).alias(f"v_{f}")]
        classes = {r["y"]: r for r in df.groupBy(F.col(label).alias("y")).agg(*moments).collect()}
        spread = df.agg(*[F.var_pop(f).alias(f) for f in features]).first()
        largest, total = max(spread[f] for f in features), sum(r["n"] for r in classes.values())
        base = {
            "features": features, "largest": float(largest),
            "classes": {int(y): {
                "prior": float(np.log(r["n"] / total)),
                "mean": [float(r[f"m_{f}"]) for f in features], "var": [float(r[f"v_{f}"]) for f in features],
            } for y, r in classes.items()},
        }
        models = [{**base, "smoothing": s} for s in self.grid]
        hits = [F.count_if((self._odds(m) > 0).cast("int") == F.col(label)).alias(f"h{i}") for i, m in enumerate(models)]
        row = df.agg(*hits).first()
        self.model = models[max(range(len(models)), key=lambda i: (row[f"h{i}"], -i))]
        return self

    @staticmethod
    def _odds(model):
        """Log-likelihood of class 1 minus that of class 0."""
        extra = model["smoothing"] * model["largest"]

        def joint(y):
            c = model["classes"].get(y)
            if c is None:
                return F.lit(float("-inf"))
            total = F.lit(c["prior"] - 0.5 * sum(np.log(2 * np.pi * (v + extra)) for v in c["var"]))
            for f, mean, var in zip(model["features"], c["mean"], c["var"]):
                total = total - F.pow(F.col(f) - F.lit(mean), 2) / F.lit(2 * (var + extra))
            return total

        return joint(1) - joint(0)

    def score(self, df):
        odds = self._odds(_fitted(self.model))
        return df.withColumns({"predicted": (odds > 0).cast("int"), "score": 1 / (1 + F.exp(-odds))})

    def save(self, path):
        from pyspark.sql import SparkSession
        import json

        SparkSession.getActiveSession().createDataFrame([(json.dumps(_fitted(self.model)),)], "model string").coalesce(
            1).write.mode("overwrite").text(path)

    def load(self, path):
        from pyspark.sql import SparkSession
        import json

        self.model = json.loads(SparkSession.getActiveSession().read.text(path).first()[0])
        self.model["classes"] = {int(k): v for k, v in self.model["classes"].items()}
        return self


class LocalOutlierFactor:
    """Local outlier factor against the training rows, as joins and aggregations over exact neighbours.

    The number of neighbours with the lowest mean factor on the training rows is kept. A row is an
    anomaly when its factor exceeds that of the training rows at the ``1 - contamination`` quantile.
    """

    name = "local_outlier_factor"

    def __init__(self, grid: dict = None):
        self.grid, self.model = grid or NEIGHBOUR_GRID, None

    def fit(self, df, features, label=None, row="row"):
        features, most = list(features), max(self.grid["n_neighbors"])
        train = stage(df.select(F.col(row).alias("_row"), *features))
        targets = train.withColumnRenamed("_row", "_target")
        near = stage(knn_join(targets, train, features, most + 1, ["_target"], "_row").filter("_row <> _target"))
        # The row itself is among its own neighbours unless others lie at distance 0.
        order = F.row_number().over(_nearest("_target", "_row"))
        near = near.withColumn("nth", order).filter(F.col("nth") <= most)
        best = None
        for k in self.grid["n_neighbors"]:
            reach, density, factor = self._train_factors(near, k)
            mean = factor.agg(F.avg("lof")).first()[0]
            if best is None or mean < best[0]:
                best = (mean, k, density, factor)
        _, k, density, factor = best
        contamination = self.grid["contamination"][0]
        cut = quantiles(factor, ["lof"], [1 - contamination]).first()["value"]
        self.model = {"features": features, "k": k, "train": train, "density": stage(density), "cut": cut,
                      "contamination": contamination, "mean": best[0]}
        return self

    @staticmethod
    def _train_factors(near, k):
        kept = near.filter(F.col("nth") <= k)
        reach = kept.groupBy("_target").agg(F.max("distance").alias("reach"))
        density = _densities(kept, reach, "_target").join(reach, "_target").withColumnRenamed("_target", "_row")
        return reach, density, _factors(kept, density, "_target")

    def score(self, df, row="row"):
        m = _fitted(self.model)
        targets = df.select(F.col(row).alias("_target"), *m["features"])
        near = stage(knn_join(targets, m["train"], m["features"], m["k"], ["_target"], "_row"))
        own = _densities(near, m["density"].select(F.col("_row").alias("_target"), "reach"), "_target")
        sums = near.join(m["density"].select("_row", "lrd"), "_row").groupBy("_target").agg(F.avg("lrd").alias("_around"))
        lof = sums.join(own, "_target").select(F.col("_target").alias(row), (F.col("_around") / F.col("lrd")).alias("score"))
        return df.join(lof, row, "left").withColumn("predicted", (F.col("score") > m["cut"]).cast("int"))

    def save(self, path):
        from pyspark.sql import SparkSession
        import json

        m = _fitted(self.model)
        m["train"].write.mode("overwrite").parquet(f"{path}/train")
        m["density"].write.mode("overwrite").parquet(f"{path}/density")
        plain = {k: m[k] for k in ("features", "k", "cut", "contamination", "mean")}
        SparkSession.getActiveSession().createDataFrame([(json.dumps(plain),)], "model string").coalesce(1).write.mode(
            "overwrite").text(f"{path}/settings")

    def load(self, path):
        from pyspark.sql import SparkSession
        import json

        spark = SparkSession.getActiveSession()
        self.model = {**json.loads(spark.read.text(f"{path}/settings").first()[0]),
                      "train": spark.read.parquet(f"{path}/train"), "density": spark.read.parquet(f"{path}/density")}
        return self


def _nearest(target, row):
    from pyspark.sql import Window

    return Window.partitionBy(target).orderBy("distance", row)


def _densities(near, reach, target):
    """Local reachability density: one over the mean of max(distance, reach of the neighbour)."""
    far = reach.select(F.col("_target").alias("_row"), F.col("reach").alias("_far"))
    return near.join(far, "_row").groupBy(target).agg(
        (1 / (F.avg(F.greatest("distance", "_far")) + 1e-10)).alias("lrd"))


def _factors(near, density, target):
    around = near.join(density.select("_row", "lrd"), "_row").groupBy(target).agg(F.avg("lrd").alias("_around"))
    own = density.select(F.col("_row").alias(target), "lrd")
    return around.join(own, target).select(target, (F.col("_around") / F.col("lrd")).alias("lof"))


class Reconstruction:
    """Error of rebuilding a row from its leading principal components.

    The number of components is the one with the smallest error on a fifth of the rows held out; the
    threshold is the 95th percentile of the training errors.
    """

    name = "reconstruction"

    def __init__(self, components=(2, 4, 6), quantile: float = 0.95):
        self.components, self.quantile, self.model = components, quantile, None

    def fit(self, df, features, label=None, row="row"):
        features = list(features)
        means = df.agg(*[F.avg(f).alias(f) for f in features]).first()
        means = [float(means[f]) for f in features]
        table = stage(df.select(
            *[F.col(f).cast("double").alias(f) for f in features],
            (uniform(F.col(row).cast("string"), "validation") < 0.2).alias("_held")))
        most = min(max(self.components), len(features))
        vectors = VectorAssembler(inputCols=features, outputCol="features").transform(table.filter("NOT _held"))
        axes = PCA(k=most, inputCol="features", outputCol="pc").fit(vectors).pc.toArray()
        tried = [k for k in self.components if k <= most] or [most]
        point = F.array(*features)
        errors = {k: table.filter("_held").agg(F.avg(_rebuild_error(axes[:, :k], means)(point))).first()[0] for k in tried}
        k = min(tried, key=lambda c: (errors[c], c))
        scored = table.select(_rebuild_error(axes[:, :k], means)(point).alias("score"))
        cut = quantiles(scored, ["score"], [self.quantile]).first()["value"]
        self.model = {"features": features, "means": means, "axes": axes[:, :k].tolist(), "cut": cut}
        return self

    def score(self, df):
        m = _fitted(self.model)
        point = F.array(*[F.col(f).cast("double") for f in m["features"]])
        return df.withColumn("score", _rebuild_error(np.array(m["axes"]), m["means"])(point)).withColumn(
            "predicted", (F.col("score") > m["cut"]).cast("int"))

    def save(self, path):
        from pyspark.sql import SparkSession
        import json

        SparkSession.getActiveSession().createDataFrame([(json.dumps(_fitted(self.model)),)], "model string").coalesce(
            1).write.mode("overwrite").text(path)

    def load(self, path):
        from pyspark.sql import SparkSession
        import json

        self.model = json.loads(SparkSession.getActiveSession().read.text(path).first()[0])
        return self


def _rebuild_error(axes: np.ndarray, means):
    @pandas_udf("double")
    def error(x: pd.Series) -> pd.Series:
        points = np.stack(x.to_numpy()) - means if len(x) else np.empty((0, len(axes)))
        return pd.Series(((points - points @ axes @ axes.T) ** 2).mean(axis=1))

    return error


def probability(scored: DataFrame, score: str = "score") -> DataFrame:
    """Scores brought to 0-1 by their range."""
    out = attach(scored, scored.agg(F.min(score).alias("_low"), F.max(score).alias("_high")))
    return out.withColumn("probability", F.try_divide(F.col(score) - F.col("_low"), F.col("_high") - F.col("_low"))).drop("_low", "_high")


def _fitted(model):
    if model is None:
        raise ValueError("call fit or load before score or save")
    return model


DETECTORS = {d.name: d for d in (BoostedTrees, NaiveBayes, LocalOutlierFactor, Reconstruction)}
