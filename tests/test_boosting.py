"""Many models at once against plain ones, one model a group, models as tables."""

import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlab.functions import groups
from sensorlab.operators import boosting, detectors, models, outliers
from sensorlab.operators.boosting import Setting
from sensorlab.plans import cleaning
from sensorlab.sources import store

FEATURES = ["a", "b", "c"]


def points(spark, n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.gauss(0, 1), rng.random() * 10, rng.choice([0.0, 1.0, None])
        y = int(a > 0.7 or (b > 8 and c == 1.0) or rng.random() < 0.05)
        rows.append((str(i), rng.choice(["x", "x", "y", None]), a, b if rng.random() > 0.05 else float("nan"), c, y))
    return spark.createDataFrame(rows, "row string, g string, a double, b double, c double, y int").repartition(3)


def prepared(df, settings):
    edges = boosting.bin_edges(df, FEATURES, bins=16)[()]
    fold = F.pmod(F.xxhash64("row", F.lit("fold")), F.lit(3))
    blocks = boosting.row_blocks(df, FEATURES, [edges], "y", fold, F.col("row"), settings=len(settings))
    return edges, blocks, [len(e) + 1 for e in edges]


def plain_trees(bins, labels, setting, widths):
    """Trees grown node by node from the rows themselves."""
    margin, out = np.zeros(len(labels), np.float32), []
    for _ in range(setting.trees):
        p = 1 / (1 + np.exp(-margin.astype(float)))
        g, h = p - labels, np.maximum(p * (1 - p), 1e-16)
        nodes, value = {}, np.zeros(len(labels), np.float32)

        def grow(rows, node, depth):
            best = (1e-6, None, None)
            score = lambda r: g[r].sum() ** 2 / (h[r].sum() + 1)  # noqa: B023, E731
            for f in range(bins.shape[1] if depth < setting.depth else 0):
                for cut in range(widths[f] - 1):
                    left, right = rows[bins[rows, f] <= cut], rows[bins[rows, f] > cut]
                    if len(left) and len(right) and min(h[left].sum(), h[right].sum()) >= 1:  # noqa: B023
                        gain = score(left) + score(right) - score(rows)
                        if gain > best[0] + 1e-12:
                            best = (gain, f, cut)
            if best[1] is None:
                value[rows] = -setting.rate * g[rows].sum() / (h[rows].sum() + 1)  # noqa: B023
                return
            nodes[node] = best[1:]  # noqa: B023
            inside = bins[rows, best[1]] <= best[2]
            grow(rows[inside], 2 * node + 1, depth + 1)
            grow(rows[~inside], 2 * node + 2, depth + 1)

        grow(np.arange(len(labels)), 0, 0)
        margin = margin + value
        out.append(nodes)
    return out, margin


def test_trees_equal_plain_ones(spark):
    df, setting = points(spark), Setting(6, 0.3, 3)
    _, blocks, widths = prepared(df, [setting])
    rows = blocks.collect()
    bins = np.concatenate([np.frombuffer(r["bins"], np.uint8).reshape(-1, 3) for r in rows])
    labels = np.concatenate([np.frombuffer(r["labels"], np.uint8) for r in rows])
    want, _ = plain_trees(bins, labels.astype(int), setting, widths)
    for sent_bytes in (0, 1 << 20):
        got = boosting.boost(blocks, widths, [setting], sent_bytes=sent_bytes).trees[0]
        assert [{int(k): (int(t.feature[k]), int(t.bin[k])) for k in np.flatnonzero(t.feature >= 0)} for t in got] == want


def test_sent_and_dealt_rows_grow_the_same_trees(spark):
    df = points(spark)
    settings = [Setting(t, r, d, s, c, h) for t, r, d, s, c in ((7, 0.3, 2, 1.0, 1.0), (12, 0.1, 4, 0.8, 0.67)) for h in (-1, 0, 2)]
    _, blocks, widths = prepared(df, settings)
    sent = boosting.boost(blocks, widths, settings, counts_at=(3, 12))
    dealt = boosting.boost(blocks, widths, settings, counts_at=(3, 12), sent_bytes=0, pending=4)
    assert [len(t) for t in sent.trees] == [7, 7, 7, 12, 12, 12]
    for a, b in zip(sent.trees, dealt.trees):
        for x, y in zip(a, b):
            assert x.feature.tolist() == y.feature.tolist() and x.bin.tolist() == y.bin.tolist() and np.allclose(x.value, y.value, atol=1e-5)
    assert {k: v.tolist() for k, v in sent.tallies.items()} == {k: v.tolist() for k, v in dealt.tallies.items()}
    assert sorted(sent.tallies) == [(1, 3), (2, 3), (4, 3), (4, 12), (5, 3), (5, 12)]


def test_grid_search_equals_a_plain_search(spark):
    df = points(spark)
    grid = {"maxIter": [2, 5], "stepSize": [0.1, 0.5], "maxDepth": [1, 3], "featureSubsetStrategy": ["0.7", "1.0"]}
    detector = detectors.BoostedTrees(grid, folds=3).fit(df, FEATURES, "y")
    edges = boosting.bin_edges(df, FEATURES)[()]
    rows = df.withColumn("fold", F.pmod(F.xxhash64("row", F.lit("fold")), F.lit(3))).toPandas()
    key, widths = F.col("row"), [len(e) + 1 for e in edges]
    curve = {}
    for strategy in grid["featureSubsetStrategy"]:
        for depth in grid["maxDepth"]:
            for trees in grid["maxIter"]:
                for rate in grid["stepSize"]:
                    f1 = []
                    for fold in range(3):
                        setting = Setting(trees, rate, depth, 1.0, int(float(strategy) * 3) / 3)
                        blocks = boosting.row_blocks(df.join(spark.createDataFrame(rows[rows.fold != fold][["row"]]), "row"), FEATURES, [edges], "y", F.lit(0), key)
                        nodes = boosting.node_table(boosting.boost(blocks, widths, [setting]).trees, FEATURES, [edges]).to_pylist()
                        forest = boosting.Forest([tuple(r[c] for c in ("tree", "node", "feature", "threshold", "value")) for r in nodes])
                        held = rows[rows.fold == fold]
                        said, y = forest.margins(held[forest.features].to_numpy(float)) > 0, held.y.to_numpy() == 1
                        f1.append(2 * (said & y).sum() / max(1, 2 * (said & y).sum() + (said ^ y).sum()))
                    curve[strategy, depth, trees, rate] = np.mean(f1)
    got = {tuple(dict(k)[n] for n in ("featureSubsetStrategy", "maxDepth", "maxIter", "stepSize")): v for k, v in detector.curve.items()}
    assert got == pytest.approx(curve)
    assert tuple(detector.best[n] for n in ("featureSubsetStrategy", "maxDepth", "maxIter", "stepSize")) == max(curve, key=curve.get)


def test_a_group_gets_the_trees_it_would_get_alone(spark):
    df = points(spark).withColumn("z", F.lit(1)).unionByName(points(spark, 40, 3).withColumns({"z": F.lit(2), "g": F.lit("one"), "y": F.lit(1)}))
    grow = lambda d: {
        (r["g"], r["z"], r["tree"], r["node"]): (r["feature"], r["threshold"], round(r["value"], 5))
        for r in boosting.boost_groups(d, FEATURES, "y", ["g", "z"], F.col("row") != "5", F.col("row"), Setting(4, 0.3, 3), wave=2).collect()}
    together = grow(df)
    assert {k[:2] for k in together} == {("x", 1), ("y", 1), (None, 1)}  # the group of one class has no model
    for g in ("x", "y", None):
        alone = grow(df.filter(F.col("g").eqNullSafe(F.lit(g))))
        assert {k: v for k, v in together.items() if k[0] == g} == alone


def test_groups_are_scored_by_a_join_in_pieces(spark, monkeypatch):
    df = points(spark)
    nodes = boosting.boost_groups(df, FEATURES, "y", ["g"], F.lit(True), F.col("row"), Setting(5, 0.3, 3)).filter("g IS NULL OR g = 'x'")
    want = {}
    for g in ("x", None):
        forest = boosting.Forest([tuple(r) for r in nodes.filter(F.col("g").eqNullSafe(F.lit(g))).select("tree", "node", "feature", "threshold", "value").collect()])
        part = df.filter(F.col("g").eqNullSafe(F.lit(g))).toPandas()
        want |= dict(zip(part["row"], 1 / (1 + np.exp(-forest.margins(part[forest.features].to_numpy(float))))))
    for size in (10, 100_000):
        monkeypatch.setattr(groups.with_models, "__defaults__", (size,))
        got = boosting.score_groups(df, nodes, ["g"], F.col("row")).collect()
        assert len(got) == 600 and {r["row"]: r["score"] for r in got if r["score"] is not None} == pytest.approx(want)
        assert all(r["score"] is None and r["predicted"] is None for r in got if r["g"] == "y")


def test_store_reads_complete_versions_only(spark, tmp_path):
    path = str(tmp_path / "models")
    store.save(path, {"nodes": spark.range(3)}, {"k": 1})
    store.save(path, {"nodes": spark.range(5)}, {"k": 2})
    spark.range(9).write.parquet(f"{path}/v9/nodes")  # a version without its line in the manifest
    tables, info = store.load(spark, path)
    assert tables["nodes"].count() == 5 and info == {"k": 2}
    first = store.versions(spark, path)[0]
    assert store.load(spark, path, first)[0]["nodes"].count() == 3
    with pytest.raises(FileNotFoundError):
        store.load(spark, path, "v9")


def test_reloaded_fill_models_keep_the_codes_of_their_ids(spark, series, tmp_path):
    rows = [(i * 30, 10.0 if h == "b" else 30.0) for h in "b" for i in range(300)]
    table = None
    for house, value in (("b", 10.0), ("d", 30.0)):
        part = series([(i * 30, value + (i % 4) / 10) for i in range(len(rows))], house=house)
        table = part if table is None else table.unionByName(part)
    fitted, _ = models.train_fill_models(models.model_features(table, ["temperature"]), ["temperature"], trees=4, depth=3)
    models.save_models(fitted, str(tmp_path / "m"))
    again = models.load_models(str(tmp_path / "m"), ["temperature"])
    # Here the house "d" comes first of its table, and "a" was never seen.
    gaps = series([(i * 30, None) for i in range(5)], house="d").unionByName(series([(i * 30, None) for i in range(5)], house="a"))
    got = models.fill_model(gaps, again).collect()
    assert all(abs(r["temperature"] - 30) < 3 for r in got if r["house"] == "d")
    assert {r["key"]: r["code"] for r in again.codes.filter("value = 'd'").collect()} == {"house": 1.0}


def test_cleaning_flow_by_zone_year_and_period(spark, series, tmp_path):
    def month(start, zone, scale):
        return series([(start + i * 60, scale * (20 + (i % 24) / 4 + (25 if i % 97 == 13 else 0)), 40 + i % 5) for i in range(24 * 12)], zone=zone)

    table = None
    for start in (0, 366 * 1440):  # January 2024 and January 2025
        for zone, scale in (("Zone 1", 1.0), ("Zone 2", 3.0)):
            part = month(start, zone, scale)
            table = part if table is None else table.unionByName(part)
    path = str(tmp_path / "out")
    out = cleaning.remove_outliers(table, ["temperature"], training={"trees": 8, "depth": 3}, path=path)
    assert out["table"].count() == 4 * 24 * 12
    metrics = out["metrics"].collect()
    assert {(r["zone"], r["year"], r["period"]) for r in metrics} == {(z, y, 1) for z in ("Zone 1", "Zone 2") for y in (2024, 2025)}
    assert all(r["accuracy"] > 0.8 and r["tp"] + r["fp"] + r["fn"] + r["tn"] > 30 for r in metrics)
    assert spark.read.json(f"{path}/metrics").count() == 4 and spark.read.option("header", True).csv(f"{path}/table").count() == 4 * 24 * 12
    # Saved models say of the same rows what the run said.
    nodes = store.load(spark, f"{path}/models")[0]["nodes"]
    featured = outliers.label_outliers(cleaning.features(table, ["temperature"]), ["temperature"], cleaning.GROUPS)
    again = cleaning.apply_models(featured, nodes, ["temperature"])
    flags = lambda d: sorted((r["zone"], r["time"], r["is_temp_outlier"]) for r in d.collect())
    assert flags(again) == flags(out["flagged"])
    hot = out["flagged"].filter("zone = 'Zone 2' AND temperature > 90").collect()
    assert hot and all(r["is_temp_outlier"] == 1 for r in hot)


def test_flows_write_their_outputs(spark, series, tmp_path):
    from sensorlab.plans import detection, imputation

    table = series([(i * 60, 10 + (i % 24) / 4, 40 + (i % 5)) for i in range(24 * 10)])
    imputation.choose_imputation(table, ["mean", "linear"], path=str(tmp_path / "i"))
    assert spark.read.option("header", True).csv(str(tmp_path / "i" / "imputed")).count() == 2 * 24 * 10
    sensors = table.withColumnsRenamed({"temperature": "inside_temperature", "humidity": "inside_humidity"})
    out = detection.detect_anomalies(sensors, [detectors.NaiveBayes()], path=str(tmp_path / "d"))
    assert spark.read.json(str(tmp_path / "d" / "metrics")).first()["model"] == "naive_bayes"
    assert (tmp_path / "d" / "anomaly_free").exists() == out["clean"]


def test_settings_that_draw_the_same_columns_are_one_run():
    combos = detectors.BoostedTrees().settings(4)
    assert len(combos) == 324 and len({s for _, s, _ in combos.values()}) == 54
    assert replace(Setting(), columns=0.5).drawn(5) == 2
