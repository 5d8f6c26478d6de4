"""Comparing imputed or cleaned data with the original, and scoring models."""

from pyspark.sql import DataFrame, functions as F

from sensorlab.functions.calendar import floor_time, from_micros, micros, span_micros
from sensorlab.functions.groups import lookup, quantile_columns, quantiles, running_totals
from sensorlab.operators.ordered import explode_steps
from sensorlab.schema import KEYS, MEASURES, TIME

DIGITS = 5


def summary_statistics(df: DataFrame, cols=MEASURES, by=()) -> DataFrame:
    """Mean, median and sample variance of the present values, one row per group and column."""
    by = list(by)
    long = df.unpivot(by, list(cols), "column", "v")
    moments = long.groupBy(*by, "column").agg(F.avg("v").alias("mean"), F.var_samp("v").alias("variance"))
    middle = quantiles(df, cols, [0.5], by).select(*by, F.col("measure").alias("column"), F.col("value").alias("median"))
    joined = moments.join(lookup(middle), [*by, "column"], "left")
    return joined.select(*by, "column", *[F.round(c, DIGITS).alias(c) for c in ("mean", "median", "variance")])


def evaluate_imputation(original: DataFrame, imputed: DataFrame, cols=MEASURES) -> DataFrame:
    """Per method and column: the statistics before and after and their absolute differences.

    ``imputed`` holds all methods, labelled in ``method``.
    """
    before = summary_statistics(original, cols)
    after = summary_statistics(imputed, cols, ["method"])
    stats = ("mean", "median", "variance")
    joined = after.withColumnsRenamed({s: f"imputed_{s}" for s in stats}).join(
        lookup(before.withColumnsRenamed({s: f"original_{s}" for s in stats})), "column")
    return joined.withColumns({
        f"{s}_diff": F.round(F.abs(F.col(f"imputed_{s}") - F.col(f"original_{s}")), DIGITS) for s in stats})


def best_method(evaluation: DataFrame, methods) -> DataFrame:
    """The method with the smallest sum of differences; the one named first on ties."""
    rank = F.array_position(F.array(*[F.lit(m) for m in methods]), F.col("method"))
    total = F.sum(sum((F.coalesce(f"{s}_diff", F.lit(0.0)) for s in ("median", "variance")), F.coalesce("mean_diff", F.lit(0.0))))
    scores = evaluation.groupBy("method").agg(F.round(total, DIGITS).alias("score"))
    return scores.orderBy("score", rank).limit(1)


def metrics_long(evaluation: DataFrame) -> DataFrame:
    """(method, column, metric, value) rows."""
    values = [c for c in evaluation.columns if c not in ("method", "column")]
    return evaluation.unpivot(["method", "column"], values, "metric", "value")


def daily_mean(df: DataFrame, cols=MEASURES, by=("zone",), time: str = TIME) -> DataFrame:
    """Mean per calendar day from each group's first to its last day; days without rows are null."""
    by, width = list(by), span_micros("1 day")
    day = floor_time(time, "1 day")
    means = df.groupBy(*by, day.alias(time)).agg(*[F.avg(c).alias(c) for c in cols])
    bounds = means.groupBy(*by).agg(F.min(micros(time)).alias("_from"), F.max(micros(time)).alias("_to"))
    spine = explode_steps(bounds, "_from", "_to", width, "_day").select(*by, from_micros("_day").alias(time))
    return spine.join(means, [*by, time], "left")


def box_statistics(df: DataFrame, cols=MEASURES, by=("label", "month_year")) -> DataFrame:
    """Quartiles, whiskers within 1.5 interquartile ranges and the rows outside, per group and column."""
    by = list(by)
    quartiles = quantile_columns(df, cols, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by)
    names = ("q1", "median", "q3")
    fences = lookup(quartiles.select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"{c}_{n}").alias(n) for n in names]) for c in cols]))))
    rows = df.unpivot(by, list(cols), "column", "v").filter("v IS NOT NULL").join(fences, [*by, "column"])
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("v").between(F.col("q1") - spread, F.col("q3") + spread)
    return rows.groupBy(*by, "column", *names).agg(
        F.min(F.when(inside, F.col("v"))).alias("low"), F.max(F.when(inside, F.col("v"))).alias("high"),
        F.count_if(~inside).alias("outside"), F.count(F.lit(1)).alias("rows"))


def distribution(df: DataFrame, cols=MEASURES, width: float = 1.0, low: float = 0.0, by=("label",)) -> DataFrame:
    """Histogram of fixed bins with density, per group and column."""
    by = list(by)
    rows = df.unpivot(by, list(cols), "column", "v").filter("v IS NOT NULL")
    bins = rows.groupBy(*by, "column", F.floor((F.col("v") - low) / width).alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    totals = lookup(bins.groupBy(*by, "column").agg(F.sum("rows").alias("_n")))
    return bins.join(totals, [*by, "column"]).select(
        *by, "column", (F.col("bin") * width + low).alias("low"), "rows", (F.col("rows") / (F.col("_n") * width)).alias("density"))


def year_overlay(df: DataFrame, month: int, reference_year: int, target_year: int, keys=KEYS, time: str = TIME) -> DataFrame:
    """Rows of one month in a reference and a target year, for the series that have both."""
    return period_overlay(df, (F.month(time) == month) & (F.year(time) == reference_year),
                          (F.month(time) == month) & (F.year(time) == target_year), keys)


def period_overlay(df: DataFrame, reference, target, keys=KEYS) -> DataFrame:
    keys = list(keys)
    labelled = df.withColumn("label", F.when(reference, "reference").when(target, "target")).filter("label IS NOT NULL")
    both = labelled.groupBy(*keys).agg(F.count_distinct("label").alias("_n")).filter("_n = 2").select(*keys)
    return labelled.join(both, keys, "left_semi")


# --- scoring ----------------------------------------------------------------------------------

def binary_metrics(df: DataFrame, label: str = "label", predicted: str = "predicted", by=("model",)) -> DataFrame:
    """Confusion counts, precision, recall and F1; a zero denominator gives 0."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    counts = df.groupBy(*by).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({
        "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn)})


def roc_curve(df: DataFrame, label: str = "label", score: str = "score", by=("model",)) -> DataFrame:
    """True and false positive rate at every distinct score, from the highest down."""
    counts, sizes = _score_counts(df, label, score, by)
    curve = running_totals(counts, score, {"_p": "pos", "_n": "neg"}, by, ascending=False)
    return curve.join(sizes, list(by)).select(
        *by, score, F.try_divide(F.col("_n").cast("double"), "_negatives").alias("fpr"),
        F.try_divide(F.col("_p").cast("double"), "_positives").alias("tpr"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", by=("model",)) -> DataFrame:
    """Area under the ROC curve; tied scores count half."""
    counts, sizes = _score_counts(df, label, score, by)
    curve = running_totals(counts, score, {"_above": "pos"}, by, ascending=False)
    area = F.sum(F.col("neg") * (F.col("_above") - F.col("pos") / 2))
    return curve.groupBy(*by).agg(area.alias("_area")).join(sizes, list(by)).select(
        *by, F.try_divide("_area", F.col("_positives") * F.col("_negatives")).alias("auc"))


def _score_counts(df, label, score, by):
    counts = df.groupBy(*by, score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    sizes = lookup(counts.groupBy(*by).agg(F.sum("pos").alias("_positives"), F.sum("neg").alias("_negatives")))
    return counts, sizes


def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted", by=()) -> DataFrame:
    """Root mean squared error and coefficient of determination."""
    squares = F.pow(F.col(actual) - F.col(predicted), 2)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.sqrt(F.avg(squares)).alias("rmse"),
        (1 - F.try_divide(F.avg(squares), F.var_pop(actual))).alias("r2"))
