"""Queries over synthetic data, model-based operators and the end-to-end flows."""

from pyspark.sql import functions as F

from sensorlab import fixtures
from sensorlab.checks.align import holes
from sensorlab.checks.quality import cleaned, featured
from sensorlab.checks.registry import CLEAN, HOLES, K, READINGS, WEATHER, clean, linear_sql, near_sql, query, rnd, rounded
from sensorlab.functions.draws import key_text, normal, poisson_one, uniform
from sensorlab.operators import align, detectors, evaluate, fills, isolation, models, ordered
from sensorlab.plans import cleaning, detection, imputation, ingest
from sensorlab.schema import MEASURES
from sensorlab.session import scratch, stage

KEYS = ["zone", "device_id", "house"]


def sensor_table(spark, d):
    """Complete readings with outside weather, named as the detectors expect."""
    table = ordered.fill(cleaned(spark, d), lambda c: ordered.linear(c, both=True))
    weather = fixtures.weather(spark, d).select(
        "time", F.col("Tair").alias("outside_temperature"), F.col("RH").alias("outside_humidity"), "WS")
    return align.asof_join(table, weather, "2 hours").withColumnsRenamed(
        {"temperature": "inside_temperature", "humidity": "inside_humidity"})


SENSOR = f"""{CLEAN}, {WEATHER}, {near_sql('clean')},
sensor AS (SELECT zone, device_id, house, n.time, {linear_sql('temperature', both=True)} AS inside_temperature, {linear_sql('humidity', both=True)} AS inside_humidity,
 CASE WHEN n.time - w.time <= INTERVAL 2 HOUR THEN Tair END AS outside_temperature, CASE WHEN n.time - w.time <= INTERVAL 2 HOUR THEN RH END AS outside_humidity,
 CASE WHEN n.time - w.time <= INTERVAL 2 HOUR THEN WS END AS WS FROM near n ASOF LEFT JOIN weather w ON n.time >= w.time)"""
COLUMNS = ["inside_temperature", "inside_humidity", "outside_temperature", "outside_humidity", "WS"]


def _uniform(key, tag):
    return f"(CAST(('0x' || substr(md5({key} || '|{tag}|42'), 1, 12)) AS BIGINT) / 281474976710656.0)"


def _normal(key, tag):
    return f"(sqrt(-2 * ln(1 - {_uniform(key, tag + '.r')})) * cos({_uniform(key, tag + '.a')} * 6.283185307179586))"


_KEY = "zone || '|' || device_id || '|' || house || '|' || epoch_us(time)"
_COPY_KEY = "zone || '|' || device_id || '|' || house || '|' || copy || '|' || epoch_us(time)"


def _poisson(u):
    total, term, cases = 0.0, 0.36787944117144233, []
    for n in range(13):
        total += term
        cases.append(f"WHEN {u} < {total!r} THEN {n}")
        term /= n + 1
    return f"CASE {' '.join(cases)} ELSE 13 END"


_COPIES = f"copies AS (SELECT *, unnest(generate_series(1, {_poisson(_uniform(_KEY, 'bootstrap'))})) AS copy FROM sensor)"


@query(f"WITH {SENSOR}, {_COPIES} SELECT {K}, time, CAST(copy AS INTEGER) AS copy FROM copies")
def bootstrap(spark, d):
    return detectors.bootstrap(sensor_table(spark, d)).select(*KEYS, "time", "copy")


@query()
def resample(spark, d):
    return detectors.sample_with_replacement(fixtures.readings(spark, d))


def injected(spark, d):
    return detectors.inject_anomalies(detectors.bootstrap(sensor_table(spark, d)), COLUMNS)


_NOISY = f"""{_COPIES},
noisy AS (SELECT {K}, time, copy, CAST({_uniform(_COPY_KEY, 'anomaly')} < 0.1 AS INTEGER) AS anomaly,
 {', '.join(f"{c} + {_normal(_COPY_KEY, c)} * stddev_samp({c}) OVER () * 0.1 AS {c}" for c in COLUMNS)},
 {_uniform(_COPY_KEY, 'hot')} AS hot, {_uniform(_COPY_KEY, 'wet')} AS wet FROM copies)"""


@query(f"""WITH {SENSOR}, {_NOISY} SELECT {K}, time, CAST(copy AS INTEGER) AS copy, anomaly,
 {rnd('inside_temperature + anomaly * (60 + 40 * hot)')} AS inside_temperature, {rnd('inside_humidity + anomaly * 10 * wet')} AS inside_humidity,
 {', '.join(rnd(c) + ' AS ' + c for c in COLUMNS[2:])} FROM noisy""")
def inject_anomalies(spark, d):
    return rounded(injected(spark, d))


@query(f"WITH {SENSOR} SELECT {K}, time, {_uniform(_KEY, 'split')} < 0.8 AS train FROM sensor")
def train_split(spark, d):
    return sensor_table(spark, d).select(*KEYS, "time", models.in_training(KEYS).alias("train"))


def prepared(spark, d):
    return detectors.prepare(sensor_table(spark, d))[0]


_CLOCK = {"hour": "hour(time)", "day_of_week": "isodow(time) - 1", "month": "month(time)", "day": "day(time)"}
_FILLED = f"""{SENSOR.replace('near AS', 'near0 AS').replace('FROM near n', 'FROM near0 n').replace('numbered AS', 'numbered0 AS').replace('FROM numbered', 'FROM numbered0').replace('seconds AS', 'seconds0 AS').replace('FROM seconds', 'FROM seconds0')},
{near_sql('sensor', ('outside_temperature', 'outside_humidity', 'WS'))},
prep AS (SELECT zone, device_id, time, inside_temperature, inside_humidity, CAST(isodow(time) >= 6 AS INTEGER) AS is_weekend,
 {', '.join(f'coalesce({linear_sql(c, both=True)}, 0) AS {c}' for c in ('outside_temperature', 'outside_humidity', 'WS'))}, {', '.join(f'{v} AS {k}' for k, v in _CLOCK.items())} FROM near),
scaled AS (SELECT zone, device_id, time, inside_temperature, inside_humidity, is_weekend,
 {', '.join(f'({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () > 0 THEN stddev_pop({c}) OVER () ELSE 1 END AS {c}' for c in ('outside_temperature', 'outside_humidity', 'WS', *_CLOCK))} FROM prep)"""


@query(f"""WITH {_FILLED} SELECT time, {', '.join(rnd(c) + ' AS ' + c for c in (*COLUMNS, *_CLOCK))}, is_weekend,
 {', '.join(f"CAST(device_id = {i} AS INTEGER) AS device_id_{i}" for i in range(8))},
 CAST(zone = 'Zone 1' AS INTEGER) AS "zone_Zone 1", CAST(zone = 'Zone 2' AS INTEGER) AS "zone_Zone 2" FROM scaled""")
def preprocess(spark, d):
    return rounded(prepared(spark, d))


# --- detectors --------------------------------------------------------------------------------

NB = ["inside_temperature", "inside_humidity", "outside_temperature", "WS"]


def synthetic(spark, d):
    table = injected(spark, d).withColumn("row", key_text([*KEYS, "copy"], "time"))
    complete = ordered.fill(table, lambda c: F.coalesce(ordered.linear(c, both=True), F.lit(0.0)), COLUMNS, [*KEYS, "copy"])
    return complete.withColumn("train", models.in_training([*KEYS, "copy"]))


@query()
def naive_bayes(spark, d):
    table = stage(synthetic(spark, d))
    detector = detectors.NaiveBayes().fit(table.filter("train"), NB)
    return rounded(detector.score(table.filter("NOT train")).select("row", "anomaly", "predicted", "score"))


def _joint(y):
    parts = " ".join(f"- power({f} - m_{f}_{y}, 2) / (2 * (v_{f}_{y} + 1e-9 * top)) - 0.5 * ln(6.283185307179586 * (v_{f}_{y} + 1e-9 * top))" for f in NB[:2])
    return f"ln(n_{y} / (n_0 + n_1)) {parts}"


# Smaller inputs that SQL can follow end to end: the unsmoothed copies with their labels.
@query(f"""WITH {SENSOR}, {_NOISY}, shifted AS (SELECT {K}, time, copy, anomaly, inside_temperature + anomaly * (60 + 40 * hot) AS inside_temperature,
 inside_humidity + anomaly * 10 * wet AS inside_humidity FROM noisy),
stats AS (SELECT greatest(var_pop(inside_temperature), var_pop(inside_humidity)) AS top, {', '.join(
    f"count(*) FILTER (WHERE anomaly = {y}) AS n_{y}, " + ', '.join(f'avg({f}) FILTER (WHERE anomaly = {y}) AS m_{f}_{y}, var_pop({f}) FILTER (WHERE anomaly = {y}) AS v_{f}_{y}' for f in NB[:2]) for y in (0, 1))} FROM shifted)
SELECT {K}, time, CAST(copy AS INTEGER) AS copy, anomaly, CAST({_joint(1)} > {_joint(0)} AS INTEGER) AS predicted FROM shifted, stats""")
def naive_bayes_labels(spark, d):
    table = stage(injected(spark, d))
    detector = detectors.NaiveBayes(grid=[1e-9]).fit(table, NB[:2])
    return detector.score(table).select(*KEYS, "time", "copy", "anomaly", "predicted")


PROFILE = ["t", "h", "ts", "hs"]
_PROFILE = f"""WITH {HOLES}, {near_sql('holes')}, f AS (SELECT {K}, time, {linear_sql('temperature', both=True)} AS a, {linear_sql('humidity', both=True)} AS b FROM near),
p AS (SELECT zone || '|' || device_id || '|' || strftime(time, '%Y-%m-%d') AS "row", round(avg(a) + 1e-9, 3) AS t, round(avg(b) + 1e-9, 3) AS h,
 round(stddev_pop(a) + 1e-9, 3) AS ts, round(stddev_pop(b) + 1e-9, 3) AS hs FROM f GROUP BY 1)"""


def profiles(spark, d):
    """One row per series and day: mean and deviation of both measures, from all readings."""
    table = fills.fill_linear(holes(spark, d), both=True)
    key = F.concat_ws("|", "zone", F.col("device_id").cast("string"), F.date_format("time", "yyyy-MM-dd"))
    return table.groupBy(key.alias("row")).agg(
        F.round(F.avg("temperature") + 1e-9, 3).alias("t"), F.round(F.avg("humidity") + 1e-9, 3).alias("h"),
        F.round(F.stddev_pop("temperature") + 1e-9, 3).alias("ts"), F.round(F.stddev_pop("humidity") + 1e-9, 3).alias("hs"))


def sensor_rows(spark, d):
    """Every reading with its weather, without gaps, keyed by series and time."""
    table = sensor_table(spark, d).withColumn("row", key_text(KEYS, "time"))
    return ordered.fill(table, lambda c: F.coalesce(ordered.linear(c, both=True), F.lit(0.0)), COLUMNS)


_D2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in PROFILE)


@query(f"""{_PROFILE}, nn AS (SELECT a."row" AS r, b."row" AS n, sqrt(round({_D2}, 9)) AS d FROM p a JOIN p b ON a."row" <> b."row"
 QUALIFY row_number() OVER (PARTITION BY a."row" ORDER BY round({_D2}, 9), b."row") <= 10),
kd AS (SELECT r, max(d) AS k FROM nn GROUP BY r), lrd AS (SELECT nn.r, 1 / (avg(greatest(d, k)) + 1e-10) AS l FROM nn JOIN kd ON kd.r = nn.n GROUP BY nn.r)
SELECT nn.r AS "row", {rnd('avg(o.l) / min(s.l)')} AS lof FROM nn JOIN lrd o ON o.r = nn.n JOIN lrd s ON s.r = nn.r GROUP BY nn.r""")
def lof_scores(spark, d):
    return _train_lof(profiles(spark, d), PROFILE)


# The queries on profiles are small forms that SQL can follow; those on rows take every reading.
@query()
def lof_scores_rows(spark, d):
    return _train_lof(sensor_rows(spark, d), COLUMNS)


def _train_lof(table, features):
    from sensorlab.operators.knn import knn_join
    train = stage(table.select(F.col("row").alias("_row"), *features))
    near = knn_join(train.withColumnRenamed("_row", "_target"), train, features, 11, ["_target"], "_row").filter("_row <> _target")
    near = stage(near.withColumn("nth", F.row_number().over(detectors._nearest("_target", "_row"))).filter("nth <= 10"))
    factor = detectors.LocalOutlierFactor._train_factors(near, 10)[2]
    return rounded(factor.select(F.col("_target").alias("row"), "lof"))


@query(f"""{_PROFILE} SELECT a."row" AS "row", b."row" AS neighbour, {rnd(f'sqrt(round({_D2}, 9))')} AS distance,
 CAST(row_number() OVER (PARTITION BY a."row" ORDER BY round({_D2}, 9), b."row") AS INTEGER) AS nth FROM p a JOIN p b ON TRUE QUALIFY nth <= 5""")
def knn_join(spark, d):
    return _self_join(profiles(spark, d), PROFILE)


@query()
def knn_join_rows(spark, d):
    return _self_join(sensor_rows(spark, d), COLUMNS)


def _self_join(table, features):
    from sensorlab.operators import knn
    table = stage(table.select("row", *features))
    out = knn.knn_join(table, table.withColumnRenamed("row", "neighbour"), features, 5, ["row"], "neighbour")
    return rounded(out.select("row", "neighbour", "distance", "nth"))


@query()
def lof_detector(spark, d):
    table = stage(sensor_rows(spark, d))
    detector = detectors.LocalOutlierFactor().fit(table, COLUMNS)
    return rounded(detectors.probability(detector.score(table)).select("row", "score", "predicted", "probability"))


@query()
def reconstruction_detector(spark, d):
    table = stage(sensor_rows(spark, d))
    detector = detectors.Reconstruction().fit(table, COLUMNS)
    return rounded(detectors.probability(detector.score(table)).select("row", "score", "predicted", "probability"))


@query()
def boosted_detector(spark, d):
    table = stage(synthetic(spark, d))
    detector = detectors.BoostedTrees().fit(table.filter("train"), NB)
    return detector.score(table.filter("NOT train")).select("row", "anomaly", "predicted", "score")


@query()
def detection_run(spark, d):
    out = detection.detect_anomalies(sensor_table(spark, d))
    return out["flagged"].select("row", F.lit(out["best"]).alias("model"), "predicted", "score")


# --- outlier models ---------------------------------------------------------------------------

@query()
def isolation_forest(spark, d):
    table = stage(featured(spark, d))
    out = table
    for c in MEASURES:
        out = isolation.isolation_labels(out, cleaning.model_inputs(c), key_text(KEYS, "time"), f"{c}_isolated", ["zone", "period"])
    return out.select(*KEYS, "time", *[f"{c}_isolated" for c in MEASURES])


@query()
def outlier_run(spark, d):
    return cleaning.remove_outliers(cleaned(spark, d), forest={})["table"]  # with a forest of the default size


# --- model-based and per-gap fills ------------------------------------------------------------

@query()
def fill_model(spark, d):
    table = align.asof_join(fixtures.readings(spark, d), fixtures.weather(spark, d), "2 hours")
    return imputation.model_imputation(table)["table"]


def _trained(spark, d):
    table = align.asof_join(cleaned(spark, d), fixtures.weather(spark, d), "2 hours")
    return models.train_fill_models(stage(models.model_features(table)))


@query()
def fill_model_metrics(spark, d):
    return _trained(spark, d)[1]


@query()
def model_reload(spark, d):
    path = scratch(spark, "models")
    models.save_models(_trained(spark, d)[0], path)
    table = align.asof_join(cleaned(spark, d), fixtures.weather(spark, d), "2 hours")
    return models.fill_model(table, models.load_models(path))


@query()
def feature_importance(spark, d):
    return models.feature_importance(_trained(spark, d)[0])


@query()
def fill_arima(spark, d):
    return fills.impute(cleaned(spark, d), "arima")


# --- flows ------------------------------------------------------------------------------------

def ingested(spark, d):
    return ingest.ingest(
        fixtures.feed(spark, d, "humidity"), fixtures.feed(spark, d, "temperature"), fixtures.weather(spark, d),
        step="15 minutes", tolerance="15 minutes", on=("house", "time"), order=("device_id",), interval="1 hour")


_INGEST = f"""t AS ({fixtures.feed_sql('duckdb', 'temperature')}), h AS ({fixtures.feed_sql('duckdb', 'humidity')}),
t1 AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY {K}, time ORDER BY event_id) = 1),
h1 AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY {K}, time ORDER BY event_id) = 1),
m AS (SELECT {K}, time, CASE WHEN h1.event_id IS NULL THEN -1 ELSE humidity END AS humidity, CASE WHEN t1.event_id IS NULL THEN -1 ELSE temperature END AS temperature FROM t1 FULL JOIN h1 USING ({K}, time)),
g AS (SELECT {K}, unnest(generate_series(min(time), max(time), INTERVAL 15 MINUTE)) AS time FROM m GROUP BY {K}),
dense AS (SELECT {K}, time, coalesce(humidity, -1) AS humidity, coalesce(temperature, -1) AS temperature FROM g LEFT JOIN m USING ({K}, time)),
synced AS (SELECT a.zone, a.device_id, a.house, a.time, CASE WHEN a.temperature = -1 AND b.temperature <> -1 THEN b.temperature ELSE a.temperature END AS temperature,
  CASE WHEN a.humidity = -1 AND b.humidity <> -1 THEN b.humidity ELSE a.humidity END AS humidity FROM dense a LEFT JOIN dense b ON a.house = b.house AND a.time = b.time AND a.zone <> b.zone),
fine AS (SELECT s.time, GHI, Tair, RH, WS FROM (SELECT unnest(generate_series(min(time), max(time), INTERVAL 15 MINUTE)) AS time FROM weather) s ASOF LEFT JOIN weather w ON s.time >= w.time)"""


@query(f"""WITH {WEATHER}, {_INGEST} SELECT {K}, s.time, temperature, humidity, GHI, Tair, RH, WS FROM
(SELECT s.*, f.time AS ft, CASE WHEN s.time - f.time <= INTERVAL 15 MINUTE THEN GHI END AS GHI, CASE WHEN s.time - f.time <= INTERVAL 15 MINUTE THEN Tair END AS Tair,
 CASE WHEN s.time - f.time <= INTERVAL 15 MINUTE THEN RH END AS RH, CASE WHEN s.time - f.time <= INTERVAL 15 MINUTE THEN WS END AS WS FROM synced s ASOF LEFT JOIN fine f ON s.time >= f.time) s""")
def ingest_run(spark, d):
    return ingested(spark, d)["aligned"]


@query(f"""WITH {WEATHER}, {_INGEST} SELECT zone, count(*) AS total_rows, {', '.join(rnd(f"100.0 * count(*) FILTER (WHERE {c} IS NULL OR {c} = -1) / count(*)") + f' AS {c}_missing_percentage' for c in ('temperature', 'humidity'))} FROM synced GROUP BY zone""")
def missing_after_sync(spark, d):
    return rounded(ingested(spark, d)["missing_after"])


@query()
def imputation_run(spark, d):
    out = imputation.choose_imputation(fixtures.readings(spark, d), list(fills.METHODS))
    return out["table"]
