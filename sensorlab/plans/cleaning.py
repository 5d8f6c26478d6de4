"""Labelling outliers per zone, year and period, learning them, replacing them, and writing what came out."""

from pyspark.sql import DataFrame, functions as F

from sensorlab.functions.calendar import period_year
from sensorlab.functions.draws import key_text, uniform
from sensorlab.functions.groups import attach, quantile_columns
from sensorlab.operators import boosting, outliers
from sensorlab.operators.evaluate import binary_metrics
from sensorlab.operators.isolation import isolation_labels
from sensorlab.schema import KEYS, MEASURES, TIME
from sensorlab.session import stage
from sensorlab.sources import store, writers

#: What a threshold, a z-score of a period and a model belong to.
GROUPS = ("zone", "year", "period")
_GENERIC = ["day", "day_of_week", "hour", "is_weekend", "value", "rolling_mean", "rolling_std", "diff", "z_score"]


def model_inputs(c: str) -> list:
    p = c[:4]
    return ["day", "day_of_week", "hour", "is_weekend", c, f"{p}_rolling_mean", f"{p}_rolling_std", f"{p}_diff", f"{p}_z_score"]


def label(df: DataFrame, cols=MEASURES, by=GROUPS, forest: dict = None) -> DataFrame:
    """Percentile, rapid-change and isolation-forest labels, any of which flags a row."""
    out = outliers.label_outliers(df, cols, by)
    out = out if forest is None else stage(out)
    if forest is not None:
        key = key_text(KEYS, TIME)
        for c in cols:
            out = isolation_labels(out, model_inputs(c), key, "_forest", by, **forest)
            out = outliers.union_labels(out, [outliers.flag(c), "_forest"], outliers.flag(c)).drop("_forest")
    return out


def _inputs(df: DataFrame, cols, by, time: str = TIME, seed: int = 42) -> DataFrame:
    """A row for each reading and measure: inputs under common names (null: the group's median), flag, key and split."""
    names = sorted({n for c in cols for n in model_inputs(c)})
    middle = attach(df, quantile_columns(df, names, {"middle": 0.5}, by), by)
    full = lambda n: F.coalesce(F.col(n).cast("double"), F.col(f"{n}_middle"), F.lit(0.0))
    measures = F.array(*[
        F.struct(F.lit(c).alias("measure"), F.col(outliers.flag(c)).alias("flag"), *[full(n).alias(g) for g, n in zip(_GENERIC, model_inputs(c))])
        for c in cols])
    key = key_text(KEYS, time)
    return middle.select(*by, key.alias("row"), (uniform(key, "split", seed) < 0.8).alias("train"), F.inline(measures))


def learn(df: DataFrame, cols=MEASURES, by=GROUPS, time: str = TIME, seed: int = 42, trees: int = 100, rate: float = 0.1, depth: int = 5) -> dict:
    """One classifier for each group and measure, all grown in the same steps, and what they say of every row.

    Four fifths of a group's labels teach, label 1 weighted by zeros / ones. ``table`` has the predictions as flags; a
    group of one class has no model and keeps its labels, as do rows without a period. ``metrics`` are those of the rows
    held out, for each group and measure; ``models`` are the trees' nodes.
    """
    groups = [*by, "measure"]
    rows = stage(_inputs(df, cols, by, time, seed).filter(F.col("period").isNotNull() if "period" in by else F.lit(True)))
    setting = boosting.Setting(trees, rate, depth)
    models = boosting.boost_groups(rows, _GENERIC, "flag", groups, F.col("train"), F.col("row"), setting)
    said = stage(boosting.score_groups(rows, models, groups, F.col("row")).select(*groups, "row", "train", "flag", "predicted", "score"))
    held = said.filter("NOT train AND predicted IS NOT NULL").withColumnRenamed("flag", "label")
    right, rows_held = F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    metrics = binary_metrics(held, by=groups).withColumn("accuracy", right / rows_held)
    flags = said.groupBy("row").agg(*[F.max(F.when(F.col("measure") == c, F.col("predicted"))).alias(f"_{c}") for c in cols])
    table = df.withColumn("_row", key_text(KEYS, time)).join(flags.withColumnRenamed("row", "_row"), "_row", "left")
    table = table.withColumns({outliers.flag(c): F.coalesce(f"_{c}", outliers.flag(c)) for c in cols}).select(*df.columns)
    return {"table": table, "metrics": metrics, "models": models, "scored": said}


def apply_models(df: DataFrame, models: DataFrame, cols=MEASURES, by=GROUPS, time: str = TIME) -> DataFrame:
    """The flags that saved models give to a table with the features of ``outlier_features``; no model, no change."""
    rows = _inputs(df, cols, by, time)
    said = boosting.score_groups(rows, models, [*by, "measure"], F.col("row"))
    flags = said.groupBy("row").agg(*[F.max(F.when(F.col("measure") == c, F.col("predicted"))).alias(f"_{c}") for c in cols])
    table = df.withColumn("_row", key_text(KEYS, time)).join(flags.withColumnRenamed("row", "_row"), "_row", "left")
    return table.withColumns({outliers.flag(c): F.coalesce(f"_{c}", outliers.flag(c)) for c in cols}).select(*df.columns)


def features(df: DataFrame, cols=MEASURES, unit: str = "month", time: str = TIME) -> DataFrame:
    """The rows' features with ``year``; z-scores are those of a zone's year."""
    return outliers.outlier_features(df.withColumn("year", period_year(time, unit)), cols, unit=unit, by=("zone", "year"))


def remove_outliers(df: DataFrame, cols=MEASURES, unit: str = "month", forest: dict = None, training: dict = None, path: str = None) -> dict:
    """Features, labels, models and replacement, by zone, year and period.

    Returns the cleaned table, the flagged one, the summary of flags, the held-out metrics and the models. With ``path``
    the cleaned table (CSV), the metrics, the summary and the models (a new version in the store) are written below it.
    """
    # Read by the quantiles, the labels and the forests.
    featured = stage(features(df, cols, unit))
    labelled = stage(label(featured, cols, GROUPS, forest))
    learnt = learn(labelled, cols, GROUPS, **(training or {}))
    flagged = stage(learnt["table"])
    out = {"table": outliers.impute_outliers(flagged, cols, GROUPS), "flagged": flagged,
           "summary": outliers.outlier_summary(flagged, cols, GROUPS), "metrics": learnt["metrics"], "models": learnt["models"]}
    if path is not None:
        writers.write_table(out["table"], f"{path}/table")
        writers.write_metrics(out["metrics"], f"{path}/metrics")
        writers.write_metrics(out["summary"], f"{path}/summary")
        store.save(f"{path}/models", {"nodes": out["models"]}, {"unit": unit, "measures": list(cols), "groups": list(GROUPS)})
    return out
