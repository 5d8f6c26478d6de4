"""Running several imputation methods, comparing them, and keeping the best."""

from pyspark.sql import DataFrame, functions as F

from sensorlab.functions.missing import missing_percentages, null_to_sentinel, sentinel_to_null
from sensorlab.operators.evaluate import best_method, evaluate_imputation
from sensorlab.operators.fills import impute_all
from sensorlab.operators.gaps import gap_intervals
from sensorlab.operators.models import fill_model, model_features, save_models, train_fill_models
from sensorlab.schema import MEASURES
from sensorlab.session import stage
from sensorlab.sources import writers


def choose_imputation(df: DataFrame, methods, cols=MEASURES, options: dict = None, interval: str = "15 minutes", path: str = None) -> dict:
    """All methods' results, their evaluation, the best method's name and table (gaps left as -1).

    With ``path`` every method's table, the evaluation, the missing shares and the gaps are written below it.
    """
    ready = sentinel_to_null(df, cols)
    filled = stage(impute_all(ready, methods, cols, options))
    evaluation = evaluate_imputation(ready, filled, cols)
    best = best_method(evaluation, list(methods)).first()["method"]
    winner = null_to_sentinel(filled.filter(F.col("method") == best).drop("method"), cols)
    out = {
        "filled": filled, "evaluation": evaluation, "best": best, "table": winner,
        "missing": missing_percentages(null_to_sentinel(filled, cols), ["method"]),
        "gaps": gap_intervals(winner, interval),
    }
    if path is not None:
        writers.write_table(null_to_sentinel(filled, cols), f"{path}/imputed", partition_by=("method", "zone"))
        for name in ("evaluation", "missing"):
            writers.write_metrics(out[name], f"{path}/{name}")
        writers.write_table(out["gaps"], f"{path}/gaps")
    return out


def model_imputation(df: DataFrame, cols=MEASURES, path: str = None, **training) -> dict:
    """Train on the known values, fill the missing ones; returns models, held-out metrics and the table.

    With ``path`` all three are written below it.
    """
    ready = stage(model_features(sentinel_to_null(df, cols), cols))
    models, metrics = train_fill_models(ready, cols, **training)
    out = {"models": models, "metrics": metrics, "table": fill_model(df, models)}
    if path is not None:
        save_models(models, f"{path}/models")
        writers.write_metrics(metrics, f"{path}/metrics")
        writers.write_table(out["table"], f"{path}/table")
    return out
