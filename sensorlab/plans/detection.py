"""Choosing a detector on synthetic anomalies and applying it to the data."""

from pyspark.sql import DataFrame, functions as F

from sensorlab.functions.draws import key_text
from sensorlab.functions.groups import distinct_values
from sensorlab.operators import detectors
from sensorlab.operators.evaluate import binary_metrics, roc_auc
from sensorlab.operators.models import in_training
from sensorlab.schema import KEYS, TIME
from sensorlab.session import stage
from sensorlab.sources import writers


def detect_anomalies(df: DataFrame, candidates=None, rate: float = 0.1, keys=KEYS, time: str = TIME, path: str = None) -> dict:
    """Resample, inject, prepare, train every detector, keep the best by F1, score the given data.

    The given data are scaled with the scaler and encoded with the ids of the training data. With ``path`` the metrics,
    the flags and the best detector are written below it, and the given data too if no row of them is flagged.
    """
    candidates = candidates if candidates is not None else [d() for d in detectors.DETECTORS.values()]
    df = stage(df)
    numeric = [f for f, t in df.dtypes if t == "double"]
    values = {c: distinct_values(df, c) for c in ("zone", "device_id") if c in df.columns}
    copies = detectors.bootstrap(df, keys, time)
    injected = detectors.inject_anomalies(copies, numeric, [*keys, "copy"], time, rate)
    injected = injected.withColumns({"row": key_text([*keys, "copy"], time), "_train": in_training([*keys, "copy"], time)})
    injected = stage(injected)
    labels = injected.select("row", "anomaly", "_train")
    ready, scaler = detectors.prepare(injected.drop("anomaly", "_train", "copy").withColumn("_row_text", F.col("row")).drop("row"),
                                      keys, time, values=values)
    synthetic = stage(ready.withColumnRenamed("_row_text", "row").join(labels, "row"))
    features = [f for f in detectors.feature_names(synthetic) if f != "_train"]
    train, test = synthetic.filter("_train"), synthetic.filter("NOT _train")

    scored = None
    for d in candidates:
        part = d.fit(train, features, "anomaly").score(test).select(
            F.lit(d.name).alias("model"), F.col("anomaly").alias("label"), "predicted", F.col("score").cast("double").alias("score"))
        scored = part if scored is None else scored.unionByName(part)
    scored = stage(scored)
    metrics = binary_metrics(scored).join(roc_auc(scored), "model")
    order = {d.name: i for i, d in enumerate(candidates)}
    best = min(metrics.collect(), key=lambda r: (-r["f1"], order[r["model"]]))["model"]
    detector = next(d for d in candidates if d.name == best)

    main, _ = detectors.prepare(df.withColumn("_row_text", key_text(keys, time)), keys, time, values=values, scaler=scaler)
    flagged = detector.score(main.withColumnRenamed("_row_text", "row"))
    out = {"metrics": metrics, "scored": scored, "best": best, "detector": detector, "flagged": flagged, "features": features}
    if path is not None:
        writers.write_metrics(metrics, f"{path}/metrics")
        out["flagged"] = flagged = stage(flagged)
        writers.write_table(flagged.select("row", "predicted", "score"), f"{path}/flags", sort=("row",))
        detector.save(f"{path}/model")
        out["clean"] = writers.write_if_clean(df, flagged, f"{path}/anomaly_free")
    return out
