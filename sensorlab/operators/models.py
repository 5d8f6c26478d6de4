"""Boosted-tree models: filling missing measures, and labelling outliers per period."""

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sensorlab.functions.calendar import calendar_features
from sensorlab.functions.draws import key_text, uniform
from sensorlab.functions.groups import category_codes, lookup
from sensorlab.functions.missing import sentinel_to_null
from sensorlab.operators.evaluate import regression_metrics
from sensorlab.operators.ordered import CHUNK, fill, linear
from sensorlab.schema import KEYS, MEASURES, TIME
from sensorlab.session import stage
from sensorlab.sources import store

NOT_FEATURES = ("year_month", "WSgust_Max", "WD_Std")


def in_training(keys, time: str = TIME, share: float = 0.8, seed: int = 42) -> Column:
    """A split that depends on the row's key only, not on partitioning."""
    return uniform(key_text(keys, time), "split", seed) < share


class FillModels(dict):
    """Models by measure, with the codes (key, value, code) that the text ids had when they were trained."""

    codes: DataFrame = None


def id_codes(df: DataFrame, keys=KEYS) -> DataFrame:
    """(key, value, code) of the text ids of a table with features: codes a model learnt with."""
    parts = [df.select(F.lit(k).alias("key"), F.col(k).alias("value"), F.col(f"f_{k}").alias("code")).distinct()
             for k in keys if isinstance(df.schema[k].dataType, T.StringType)]
    out = parts[0] if parts else df.sparkSession.createDataFrame([], "key string, value string, code double")
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.filter("value IS NOT NULL")


def model_features(df: DataFrame, cols=MEASURES, keys=KEYS, time: str = TIME, chunk: str = CHUNK, codes: DataFrame = None) -> DataFrame:
    """Adds the feature columns used by the models: clock, coded ids and weather without gaps.

    Feature columns are ``f_<name>``; the given columns stay as they were. Text ids get the ``codes`` of a trained model,
    -1 for ids it didn't know; without codes they are numbered from this table.
    """
    rows = sentinel_to_null(df, [c for c in cols if c in df.columns])
    out = calendar_features(rows, time, only=("hour", "day_of_week", "is_weekend", "month", "day"))
    names = ["hour", "day_of_week", "is_weekend", "month", "day"]
    weather = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))
               and f.name not in (*cols, *keys, time, *NOT_FEATURES)]
    if weather:
        filled = out.withColumns({f"_w_{w}": F.col(w) for w in weather})
        out = fill(filled, lambda c: F.coalesce(linear(c, both=True), F.lit(0.0)), [f"_w_{w}" for w in weather], keys, time, chunk)
    for k in keys:
        if isinstance(df.schema[k].dataType, T.NumericType):
            out = out.withColumn(f"f_{k}", F.col(k).cast("double"))
        elif codes is not None:
            known = lookup(codes.filter(F.col("key") == k).select(F.col("value").alias(k), F.col("code").cast("double").alias(f"f_{k}")))
            out = out.join(known, k, "left").withColumn(f"f_{k}", F.coalesce(f"f_{k}", F.lit(-1.0)))
        else:
            out = category_codes(out, k, f"f_{k}").withColumn(f"f_{k}", F.col(f"f_{k}").cast("double"))
    return out.withColumns({
        **{f"f_{n}": F.col(n).cast("double") for n in names}, **{f"f_{w}": F.col(f"_w_{w}") for w in weather},
    }).drop(*[n for n in names if n not in df.columns], *[f"_w_{w}" for w in weather])


def feature_names(df: DataFrame) -> list:
    return sorted(c for c in df.columns if c.startswith("f_"))


def train_fill_models(df: DataFrame, cols=MEASURES, keys=KEYS, time: str = TIME, trees: int = 100, depth: int = 6,
                      rate: float = 0.1, seed: int = 42, share: float = 0.8):
    """One regressor per measure on clock, weather and ids; no measure is a feature of another.

    ``df`` comes from ``model_features``. Returns ``{measure: model}`` and the held-out metrics.
    """
    names, models, scored = feature_names(df), FillModels(), None
    models.codes = stage(id_codes(df, keys))
    train = in_training(keys, time, share, seed)
    for c in cols:
        known = stage(df.filter(F.col(c).isNotNull()).select(*names, F.col(c).alias("label"), train.alias("_train")))
        steps = [
            VectorAssembler(inputCols=names, outputCol="features"),
            GBTRegressor(labelCol="label", maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed),
        ]
        models[c] = Pipeline(stages=steps).fit(known.filter("_train"))
        part = models[c].transform(known.filter("NOT _train")).select(F.lit(c).alias("measure"), "label", "prediction")
        scored = part if scored is None else scored.unionByName(part)
    return models, regression_metrics(scored, "label", "prediction", ["measure"])


def predict(df: DataFrame, models: dict) -> DataFrame:
    """Adds ``predicted_<measure>`` for every row."""
    out = df
    for c, model in models.items():
        out = model.transform(out).withColumnRenamed("prediction", f"predicted_{c}").drop("features")
    return out


def fill_model(df: DataFrame, models: dict, keys=KEYS, time: str = TIME) -> DataFrame:
    """Replace missing measures by their prediction; the rest stays as it is."""
    ready = sentinel_to_null(df, list(models))
    missing = F.lit(False)
    for c in models:
        missing = missing | F.col(c).isNull()
    if ready.filter(missing).isEmpty():
        return df
    out = predict(model_features(ready, list(models), keys, time, codes=getattr(models, "codes", None)), models)
    return out.withColumns({c: F.coalesce(c, f"predicted_{c}") for c in models}).select(*df.columns)


def feature_importance(models: dict) -> DataFrame:
    """(measure, feature, importance) rows, most important first."""
    from pyspark.sql import SparkSession

    rows = []
    for c, model in models.items():
        assembler, trees = model.stages[0], model.stages[-1]
        rows += [(c, n, float(v)) for n, v in zip(assembler.getInputCols(), trees.featureImportances.toArray())]
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "measure string, feature string, importance double").orderBy(
        "measure", F.desc("importance"), "feature")


def save_models(models: dict, path: str) -> None:
    """A new version of the models with their id codes; the codes' manifest is written last and names the models' folder."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    folder = f"models-{uuid.uuid4().hex}"
    for name, model in models.items():
        model.write().save(f"{path}/{folder}/{name}")
    codes = getattr(models, "codes", None)
    codes = spark.createDataFrame([], "key string, value string, code double") if codes is None else codes
    store.save(path, {"codes": codes}, {"folder": folder, "names": sorted(models), "coded": getattr(models, "codes", None) is not None})


def load_models(path: str, names=MEASURES) -> dict:
    """The last complete version."""
    from pyspark.sql import SparkSession

    tables, info = store.load(SparkSession.getActiveSession(), path)
    out = FillModels({name: PipelineModel.load(f"{path}/{info['folder']}/{name}") for name in names})
    out.codes = tables["codes"] if info["coded"] else None
    return out


def train_classifier(df: DataFrame, names, label: str = "label", trees: int = 100, depth: int = 5, rate: float = 0.1,
                     seed: int = 42, balanced: bool = True, **options):
    """Boosted-tree classifier; ``balanced`` weighs positives by negatives / positives. None for a single class."""
    counts = df.agg(F.sum(F.col(label)).alias("p"), F.count(F.lit(1)).alias("n")).first()
    if not counts["p"] or counts["p"] == counts["n"]:
        return None
    weight = (counts["n"] - counts["p"]) / counts["p"] if balanced else 1.0
    weighted = df.withColumn("_weight", F.when(F.col(label) == 1, float(weight)).otherwise(1.0)).withColumn(
        "_label", F.col(label).cast("double"))
    steps = [
        VectorAssembler(inputCols=list(names), outputCol="features"),
        GBTClassifier(labelCol="_label", weightCol="_weight", maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed, **options),
    ]
    return Pipeline(stages=steps).fit(weighted)


def classify(df: DataFrame, model) -> DataFrame:
    """Adds ``predicted`` (0/1) and ``score`` (probability of 1)."""
    out = model.transform(df)
    return out.withColumns({
        "predicted": F.col("prediction").cast("int"), "score": vector_to_array("probability")[1],
    }).drop("features", "rawPrediction", "probability", "prediction")
