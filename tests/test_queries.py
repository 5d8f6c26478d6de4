"""A selection of the registered queries against their SQL; check.py runs all of them."""

import inspect

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry_points
from check import TABLES, canonical
from sensorlab.checks import models
from sensorlab.functions.draws import key_text
from sensorlab.operators import detectors, fills, isolation, models as operator_models
from sensorlab.plans import cleaning, detection, imputation
from sensorlab.schema import MEASURES

SF = "/root/testdata/sf0.001"
NAMES = ["measure_merge", "densify", "zone_sync", "asof_weather", "gap_summary", "gap_runs", "fill_linear", "fill_windowed",
         "fill_tiered", "outlier_labels", "roc_auc", "daily_mean"]


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    df = entry_points.queries()[name](spark, SF)
    cursor = con.execute(entry_points.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(cursor.fetchall(), columns)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_neighbour_queries_take_every_reading(spark):
    queries = entry_points.queries()
    keys = {r[0] for r in models.sensor_table(spark, SF).select(key_text(models.KEYS, "time")).collect()}
    table = sorted((r["row"], *(r[c] for c in models.COLUMNS)) for r in models.sensor_rows(spark, SF).collect())
    assert [r[0] for r in table] == sorted(keys) and len(keys) > 900
    names, x = np.array([r[0] for r in table]), np.array([r[1:] for r in table])
    d2 = np.round(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2), 9)
    near = {}
    for r in queries["knn_join_rows"](spark, SF).collect():
        near.setdefault(r["row"], {})[r["nth"]] = r["distance"]
    for k, name in enumerate(names):
        assert np.allclose([near[name][i] for i in range(1, 6)], np.sqrt(np.sort(d2[k])[:5]), atol=2e-6)
    for query in ("lof_scores_rows", "lof_detector", "reconstruction_detector"):
        assert sorted(r["row"] for r in queries[query](spark, SF).select("row").collect()) == sorted(keys)


class Reached(Exception):
    """The job a query asks for; the job itself isn't run."""


def asked(monkeypatch, owner, name, spark, query):
    """The arguments, defaults included, with which a query reaches a function."""
    signature = inspect.signature(getattr(owner, name))

    def stop(*args, **options):
        bound = signature.bind(*args, **options)
        bound.apply_defaults()
        raise Reached(bound.arguments)

    with monkeypatch.context() as patch:
        for module in (models, imputation):
            patch.setattr(module, "stage", lambda df: df)
        patch.setattr(owner, name, stop)
        with pytest.raises(Reached) as found:
            entry_points.queries()[query](spark, SF)
    return found.value.args[0]


def test_queries_ask_for_the_whole_job(spark, monkeypatch):
    ask = lambda *x: asked(monkeypatch, *x[:2], spark, x[2])
    assert ask(detectors.LocalOutlierFactor, "fit", "lof_detector")["self"].grid == detectors.NEIGHBOUR_GRID
    boosted = ask(detectors.BoostedTrees, "fit", "boosted_detector")["self"]
    assert (boosted.grid, boosted.folds) == (detectors.BOOSTED_GRID, 5)
    assert ask(detection, "detect_anomalies", "detection_run")["candidates"] is None
    assert ask(isolation, "isolation_scores", "isolation_forest")["trees"] == 100
    job = ask(cleaning, "remove_outliers", "outlier_run")
    assert list(job["cols"]) == list(MEASURES) and job["forest"] == {} and job["training"] is None
    for query in ("fill_model_metrics", "model_reload", "feature_importance"):
        job = ask(operator_models, "train_fill_models", query)
        assert (list(job["cols"]), job["trees"], job["depth"]) == (list(MEASURES), 100, 6)
    job = ask(imputation, "train_fill_models", "fill_model")
    assert (list(job["cols"]), job["trees"], job["depth"]) == (list(MEASURES), 100, 6)
    assert sorted(ask(imputation, "choose_imputation", "imputation_run")["methods"]) == sorted(fills.METHODS)
