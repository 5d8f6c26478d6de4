"""Queries over the imputation, evaluation and outlier operators."""

from pyspark.sql import functions as F

from sensorlab import fixtures
from sensorlab.checks.align import M, dense, holes
from sensorlab.checks.registry import (
    CLEAN, DENSE, HOLES, K, MEASURES, READINGS, clean, hermite_sql, linear_sql, near, near_sql, query, rnd, rounded,
)
from sensorlab.functions import groups, missing
from sensorlab.operators import evaluate, fills, outliers
from sensorlab.session import stage

KEYS = ["zone", "device_id", "house"]
STATS = ("mean", "median", "variance")


def cleaned(spark, d):
    return clean(fixtures.readings(spark, d))


# --- statistical fills ------------------------------------------------------------------------

def _constant_fill(f):
    return f"""WITH {HOLES} SELECT {K}, time, {rnd(f'coalesce(temperature, (SELECT {f}(temperature) FROM holes))')} AS temperature,
  {rnd(f'coalesce(humidity, (SELECT {f}(humidity) FROM holes))')} AS humidity FROM holes"""


@query(_constant_fill("avg"))
def fill_mean(spark, d):
    return rounded(fills.impute(holes(spark, d), "mean"))


@query(_constant_fill("median"))
def fill_median(spark, d):
    return rounded(fills.impute(holes(spark, d), "median"))


@query(f"""WITH {HOLES}, m AS (SELECT {K}, median(temperature) AS t, median(humidity) AS h FROM holes GROUP BY {K})
SELECT {K}, time, {rnd('coalesce(temperature, t)')} AS temperature, {rnd('coalesce(humidity, h)')} AS humidity FROM holes JOIN m USING ({K})""")
def fill_median_by_series(spark, d):
    return rounded(fills.fill_median(holes(spark, d), by=KEYS))


def tier_sql(c, short=3600, medium=21600, limit=4):
    start = f"(CASE WHEN {c}_p IS NULL THEN series_first ELSE {c}_p.e END)"
    end = f"(CASE WHEN {c}_n IS NULL THEN series_last ELSE {c}_n.e END)"
    return f"""CASE WHEN {c} IS NOT NULL THEN {c}
  WHEN {end} - {start} <= {short} THEN CASE WHEN rn - {c}_p.rn <= {limit} THEN {linear_sql(c)} END
  WHEN {end} - {start} <= {medium} THEN {hermite_sql(c)} END"""


TIERED = f"WITH {HOLES}, {near_sql('holes')}, tiered AS (SELECT {K}, time, {tier_sql('temperature')} AS temperature, {tier_sql('humidity')} AS humidity FROM near)"


@query(f"{TIERED} SELECT {K}, time, {M} FROM tiered")
def fill_tiered(spark, d):
    return rounded(fills.impute(holes(spark, d), "custom", short="1 hour", medium="6 hours", limit=4))


# --- evaluation -------------------------------------------------------------------------------

METHODS = ["mean", "median", "locf", "nocb", "linear", "spline", "custom"]
OPTIONS = {"custom": {"short": "1 hour", "medium": "6 hours", "limit": 4}}


def _all_methods():
    each = {
        "mean": lambda c: f"coalesce({c}, avg({c}) OVER ())",
        "median": lambda c: f"coalesce({c}, median({c}) OVER ())",
        "locf": lambda c: f"coalesce({c}, {c}_p.v)",
        "nocb": lambda c: f"coalesce({c}, {c}_n.v)",
        "linear": linear_sql,
        "spline": hermite_sql,
        "custom": tier_sql,
    }
    parts = [f"SELECT '{m}' AS method, {f('temperature')} AS temperature, {f('humidity')} AS humidity FROM near" for m, f in each.items()]
    return f"WITH {HOLES}, {near_sql('holes')}, filled AS ({' UNION ALL '.join(parts)})"


def _stats(c, source, prefix):
    return f"""round(avg({c}), 5) AS {prefix}mean, round(median({c}), 5) AS {prefix}median, round(var_samp({c}), 5) AS {prefix}variance FROM {source}"""


_EVAL = f"""{_all_methods()},
o AS (SELECT 'temperature' AS "column", {_stats('temperature', 'holes', 'original_')} UNION ALL SELECT 'humidity', {_stats('humidity', 'holes', '')}),
i AS (SELECT method, 'temperature' AS "column", {_stats('temperature', 'filled', 'imputed_')} GROUP BY method
      UNION ALL SELECT method, 'humidity', {_stats('humidity', 'filled', '')} GROUP BY method),
e AS (SELECT *, {', '.join(f'round(abs(imputed_{s} - original_{s}), 5) AS {s}_diff' for s in STATS)} FROM i JOIN o USING ("column"))"""


def evaluation(spark, d):
    table = stage(holes(spark, d))
    return evaluate.evaluate_imputation(table, stage(fills.impute_all(table, METHODS, options=OPTIONS)))


@query(f"{_EVAL} SELECT * FROM e")
def imputation_evaluation(spark, d):
    return evaluation(spark, d)


@query(f"""{_EVAL} SELECT method, round(sum(mean_diff + median_diff + variance_diff), 5) AS score FROM e GROUP BY method
ORDER BY score, list_position({METHODS}, method) LIMIT 1""")
def method_choice(spark, d):
    return evaluate.best_method(evaluation(spark, d), METHODS)


@query(f"""{_EVAL} SELECT method, "column", metric, value FROM (UNPIVOT e ON {', '.join(f'{p}_{s}' for p in ('imputed', 'original') for s in STATS)},
{', '.join(f'{s}_diff' for s in STATS)} INTO NAME metric VALUE value)""")
def metrics_long(spark, d):
    return evaluate.metrics_long(evaluation(spark, d))


@query(f"""{_all_methods()} SELECT count(*) AS "rows", method,
 CAST(count(*) FILTER (WHERE temperature IS NULL) AS BIGINT) AS temperature_left,
 CAST(count(*) FILTER (WHERE humidity IS NULL) AS BIGINT) AS humidity_left FROM filled GROUP BY method""")
def method_dispatch(spark, d):
    filled = fills.impute_all(holes(spark, d), METHODS, options=OPTIONS)
    return filled.groupBy("method").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("temperature").isNull()).alias("temperature_left"),
        F.count_if(F.col("humidity").isNull()).alias("humidity_left"))


@query(f"""WITH {CLEAN}, thin AS (SELECT * REPLACE (CASE WHEN day(time) % 3 = 1 AND zone <> 'Zone 1' THEN time + INTERVAL 1 DAY ELSE time END AS time) FROM clean),
m AS (SELECT zone, time_bucket(INTERVAL 1 DAY, time) AS time, avg(temperature) AS t, avg(humidity) AS h FROM thin GROUP BY 1, 2),
spine AS (SELECT zone, unnest(generate_series(min(time), max(time), INTERVAL 1 DAY)) AS time FROM m GROUP BY zone)
SELECT zone, time, {rnd('t')} AS temperature, {rnd('h')} AS humidity FROM spine LEFT JOIN m USING (zone, time)""")
def daily_mean(spark, d):
    # Every third day outside Zone 1 is empty, as its readings count for the next one.
    later = F.when(F.expr("day(time) % 3 = 1 AND zone <> 'Zone 1'"), F.expr("time + INTERVAL 1 DAY")).otherwise(F.col("time"))
    thin = cleaned(spark, d).withColumn("time", later)
    return rounded(evaluate.daily_mean(thin))


_BEFORE_AFTER = f"""WITH {HOLES}, {near_sql('holes')}, both_ AS (
SELECT 'Before' AS label, strftime(time, '%b %Y') AS month_year, temperature, humidity FROM holes UNION ALL
SELECT 'After', strftime(time, '%b %Y'), {linear_sql('temperature')}, {linear_sql('humidity')} FROM near),
long AS (SELECT label, month_year, 'temperature' AS "column", temperature AS v FROM both_ WHERE temperature IS NOT NULL
 UNION ALL SELECT label, month_year, 'humidity', humidity FROM both_ WHERE humidity IS NOT NULL)"""


def before_after(spark, d):
    table = stage(holes(spark, d))
    after = stage(fills.fill_linear(table))
    from sensorlab.operators.align import union_all
    return union_all([table, after], ["Before", "After"]).withColumn("month_year", F.date_format("time", "MMM yyyy"))


@query(f"""{_BEFORE_AFTER}, q AS (SELECT label, month_year, "column", quantile_cont(v, 0.25) AS q1, median(v) AS median, quantile_cont(v, 0.75) AS q3 FROM long GROUP BY 1, 2, 3)
SELECT label, month_year, "column", {rnd('q1')} AS q1, {rnd('median')} AS median, {rnd('q3')} AS q3,
 {rnd('min(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS low,
 {rnd('max(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))')} AS high,
 count(*) FILTER (WHERE NOT v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outside, count(*) AS "rows"
FROM long JOIN q USING (label, month_year, "column") GROUP BY label, month_year, "column", q1, median, q3""")
def box_stats(spark, d):
    return rounded(evaluate.box_statistics(before_after(spark, d)))


@query(f"""{_BEFORE_AFTER}, b AS (SELECT label, "column", CAST(floor(v / 5) AS BIGINT) AS bin, count(*) AS n FROM long GROUP BY 1, 2, 3)
SELECT label, "column", CAST(bin * 5.0 AS DOUBLE) AS low, n AS "rows", {rnd('n / (sum(n) OVER (PARTITION BY label, "column") * 5.0)')} AS density FROM b""")
def distribution(spark, d):
    return rounded(evaluate.distribution(before_after(spark, d), width=5.0))


@query(f"""WITH {READINGS}, l AS (SELECT *, CASE WHEN day(time) <= 15 AND device_id <> 5 THEN 'reference' ELSE 'target' END AS label FROM readings)
SELECT * FROM l WHERE label IS NOT NULL AND (zone, device_id, house) IN (
  SELECT ({K}) FROM l WHERE label = 'reference' INTERSECT SELECT ({K}) FROM l WHERE label = 'target')""")
def period_overlay(spark, d):
    day = F.dayofmonth("time")
    return evaluate.period_overlay(fixtures.readings(spark, d), (day <= 15) & (F.col("device_id") != 5), (day > 15) | (F.col("device_id") == 5))


@query(f"""WITH {READINGS},
moved AS (SELECT * REPLACE (CASE WHEN day(time) <= 15 AND device_id <> 5 THEN time - INTERVAL 1 YEAR ELSE time END AS time) FROM readings),
named AS (SELECT *, CASE year(time) WHEN 2023 THEN 'reference' WHEN 2024 THEN 'target' END AS label FROM moved WHERE month(time) = 1 AND year(time) IN (2023, 2024))
SELECT * FROM named SEMI JOIN (SELECT {K} FROM named GROUP BY {K} HAVING count(DISTINCT label) = 2) USING ({K})""")
def year_overlay(spark, d):
    # The first half of the month goes to the year before; one series stays in a single year.
    moved = (F.dayofmonth("time") <= 15) & (F.col("device_id") != 5)
    readings = fixtures.readings(spark, d).withColumn("time", F.when(moved, F.col("time") - F.expr("INTERVAL 1 YEAR")).otherwise(F.col("time")))
    return evaluate.year_overlay(readings, 1, 2023, 2024)


# --- scoring: linear fill scored against the kept values; events scored by value --------------

def _scored(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet")
    return events.select(
        "event_type", F.lit("value").alias("model"), (F.col("event_id") % 7 < 3).cast("int").alias("label"),
        (F.col("value") > 40).cast("int").alias("predicted"), F.col("value").alias("score"))


_SCORED = """s AS (SELECT event_type, 'value' AS model, CAST(event_id % 7 < 3 AS INTEGER) AS label,
 CAST(value > 40 AS INTEGER) AS predicted, value AS score FROM events)"""


@query(f"""WITH {_SCORED}, c AS (SELECT event_type, count(*) FILTER (WHERE label = 1 AND predicted = 1) AS tp, count(*) FILTER (WHERE label = 0 AND predicted = 1) AS fp,
 count(*) FILTER (WHERE label = 1 AND predicted = 0) AS fn, count(*) FILTER (WHERE label = 0 AND predicted = 0) AS tn FROM s GROUP BY 1)
SELECT *, {rnd('coalesce(tp / nullif(tp + fp, 0), 0)')} AS precision, {rnd('coalesce(tp / nullif(tp + fn, 0), 0)')} AS recall,
 {rnd('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)')} AS f1 FROM c""")
def binary_metrics(spark, d):
    return rounded(evaluate.binary_metrics(_scored(spark, d), by=["event_type"]))


@query(f"""WITH {_SCORED}, g AS (SELECT event_type, score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n FROM s GROUP BY 1, 2)
SELECT event_type, score, {rnd('sum(n) OVER w / sum(n) OVER (PARTITION BY event_type)')} AS fpr, {rnd('sum(p) OVER w / sum(p) OVER (PARTITION BY event_type)')} AS tpr
FROM g WINDOW w AS (PARTITION BY event_type ORDER BY score DESC)""")
def roc_curve(spark, d):
    return rounded(evaluate.roc_curve(_scored(spark, d), by=["event_type"]))


@query(f"""WITH {_SCORED}, r AS (SELECT event_type, label, rank() OVER (PARTITION BY event_type ORDER BY score)
  + (count(*) OVER (PARTITION BY event_type, score) - 1) / 2 AS rk FROM s)
SELECT event_type, {rnd('(sum(rk) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * (count(*) - sum(label)))')} AS auc FROM r GROUP BY 1""")
def roc_auc(spark, d):
    return rounded(evaluate.roc_auc(_scored(spark, d), by=["event_type"]))


@query(f"""WITH {CLEAN}, p AS (SELECT zone, device_id, temperature AS y, lag(temperature) OVER (PARTITION BY {K} ORDER BY time) AS x FROM clean WHERE temperature IS NOT NULL)
SELECT zone, count(*) AS "rows", {rnd('sqrt(avg((y - x) ** 2))')} AS rmse, {rnd('1 - avg((y - x) ** 2) / var_pop(y)')} AS r2 FROM p WHERE x IS NOT NULL GROUP BY zone""")
def regression_metrics(spark, d):
    from sensorlab.operators import ordered
    present = cleaned(spark, d).filter("temperature IS NOT NULL")
    scored = ordered.rolling_features(present, ["temperature"], 2).withColumn("x", F.col("temperature") - F.col("temp_diff"))
    first = ordered.with_next_time(scored, chunk=ordered.CHUNK).filter("_ts <> _first")
    return rounded(evaluate.regression_metrics(first, "temperature", "x", ["zone"]))


# --- outliers ---------------------------------------------------------------------------------

def featured(spark, d):
    return outliers.outlier_features(cleaned(spark, d), unit="week")


def _rolling(c):
    p = c[:4]
    return f"""avg({c}) OVER r AS {p}_rolling_mean, coalesce(stddev_samp({c}) OVER r, 0) AS {p}_rolling_std,
 coalesce({c} - lag({c}) OVER w, 0) AS {p}_diff, abs({c} - lag({c}) OVER (PARTITION BY {K}, week(time) ORDER BY time)) AS {p}_step,
 ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS {p}_z_score"""


FEATURED = f"""{CLEAN}, featured AS (SELECT {K}, time, temperature, humidity, {_rolling('temperature')}, {_rolling('humidity')},
 CAST(week(time) AS INTEGER) AS period, CAST(month(time) AS INTEGER) AS month, CAST(day(time) AS INTEGER) AS day,
 CAST(hour(time) AS INTEGER) AS hour, CAST(isodow(time) - 1 AS INTEGER) AS day_of_week, CAST(isodow(time) >= 6 AS INTEGER) AS is_weekend
 FROM clean WINDOW w AS (PARTITION BY {K} ORDER BY time), r AS (PARTITION BY {K} ORDER BY time ROWS BETWEEN 23 PRECEDING AND CURRENT ROW))"""
_DOUBLES = [f"{p}_{s}" for p in ("temp", "humi") for s in ("rolling_mean", "rolling_std", "diff", "step", "z_score")]


@query(f"""WITH {FEATURED} SELECT {K}, time, {M}, {', '.join(rnd(c) + ' AS ' + c for c in _DOUBLES)}, period, month, day, hour, day_of_week, is_weekend,
 0 AS is_temp_outlier, 0 AS is_humi_outlier FROM featured""")
def outlier_features(spark, d):
    return rounded(featured(spark, d))


LABELLED = f"""WITH {FEATURED}, q AS (SELECT zone, period, {', '.join(
    f'quantile_cont({c}, 0.09) AS {c}_low, quantile_cont({c}, 0.91) AS {c}_high, quantile_cont({c[:4]}_step, 0.99) AS {c}_most' for c in MEASURES)}
 FROM featured GROUP BY 1, 2),
labelled AS (SELECT {K}, time, temperature, humidity, period, day, hour, {', '.join(
    f'CAST(coalesce({c} < {c}_low OR {c} > {c}_high, FALSE) AS INTEGER) AS {c[:4]}_by_share, CAST(coalesce({c[:4]}_step > {c}_most, FALSE) AS INTEGER) AS {c[:4]}_by_change' for c in MEASURES)}
 FROM featured JOIN q USING (zone, period)),
flagged AS (SELECT *, greatest(temp_by_share, temp_by_change) AS is_temp_outlier, greatest(humi_by_share, humi_by_change) AS is_humi_outlier FROM labelled)"""


@query(f"{LABELLED} SELECT {K}, time, temp_by_share AS is_temp_outlier, humi_by_share AS is_humi_outlier FROM flagged")
def outlier_percentiles(spark, d):
    out = outliers.label_percentiles(featured(spark, d))
    return out.select(*KEYS, "time", "is_temp_outlier", "is_humi_outlier")


@query(f"{LABELLED} SELECT {K}, time, temp_by_change AS is_temp_outlier, humi_by_change AS is_humi_outlier FROM flagged")
def outlier_changes(spark, d):
    out = outliers.label_changes(featured(spark, d))
    return out.select(*KEYS, "time", "is_temp_outlier", "is_humi_outlier")


def labelled(spark, d):
    return outliers.label_outliers(stage(featured(spark, d)))


@query(f"{LABELLED} SELECT {K}, time, is_temp_outlier, is_humi_outlier FROM flagged")
def outlier_labels(spark, d):
    return labelled(spark, d).select(*KEYS, "time", "is_temp_outlier", "is_humi_outlier")


@query(f"{LABELLED} SELECT {K}, time, is_temp_outlier, is_humi_outlier, greatest(is_temp_outlier, is_humi_outlier) AS is_outlier FROM flagged")
def outlier_union(spark, d):
    out = outliers.union_labels(labelled(spark, d), ["is_temp_outlier", "is_humi_outlier"], "is_outlier")
    return out.select(*KEYS, "time", "is_temp_outlier", "is_humi_outlier", "is_outlier")


@query(f"""{LABELLED}, l AS (SELECT period, 'temperature' AS measure, is_temp_outlier AS f FROM flagged UNION ALL SELECT period, 'humidity', is_humi_outlier FROM flagged)
SELECT period, measure, CAST(sum(f) AS BIGINT) AS outliers, count(*) AS "rows", {rnd('avg(f)')} AS rate FROM l GROUP BY 1, 2""")
def outlier_summary(spark, d):
    return rounded(outliers.outlier_summary(labelled(spark, d)))



def _med(c, keys, cond=""):
    return f"(SELECT zone, {keys}, median({c}) AS m FROM flagged {cond} GROUP BY zone, {keys})"


def _replaced(c):
    f = f"is_{c[:4]}_outlier"
    a = f"{c[:1]}"
    return (f"CASE WHEN {f} = 1 THEN coalesce({a}1.m, {a}2.m, {a}3.m) ELSE {c} END",
            f"""LEFT JOIN {_med(c, 'period, day, hour', f'WHERE {f} = 0')} {a}1 ON {a}1.zone = f.zone AND {a}1.period = f.period AND {a}1.day = f.day AND {a}1.hour = f.hour
 LEFT JOIN {_med(c, 'period', f'WHERE {f} = 0')} {a}2 ON {a}2.zone = f.zone AND {a}2.period = f.period
 LEFT JOIN {_med(c, 'period')} {a}3 ON {a}3.zone = f.zone AND {a}3.period = f.period""")


@query(f"""{LABELLED} SELECT f.zone, f.device_id, f.house, f.time, {rnd(_replaced('temperature')[0])} AS temperature, {rnd(_replaced('humidity')[0])} AS humidity
FROM flagged f {_replaced('temperature')[1]} {_replaced('humidity')[1]}""")
def outlier_impute(spark, d):
    return rounded(outliers.impute_outliers(stage(labelled(spark, d))).select(*KEYS, "time", "temperature", "humidity"))


@query(f"""WITH {CLEAN}, x AS (SELECT {K}, time, week(time) AS period, CASE WHEN device_id = 3 AND hour(time) = 5 THEN humidity * 9 ELSE humidity END AS humidity FROM clean),
q AS (SELECT zone, period, quantile_cont(humidity, 0.1) AS a, quantile_cont(humidity, 0.9) AS b FROM x GROUP BY 1, 2),
y AS (SELECT *, a - 2 * (b - a) AS low, b + 2 * (b - a) AS high FROM x JOIN q USING (zone, period)),
m AS (SELECT zone, period, median(humidity) AS m FROM y WHERE humidity BETWEEN low AND high GROUP BY 1, 2)
SELECT {K}, time, {rnd('CASE WHEN humidity < low OR humidity > high THEN m ELSE humidity END')} AS humidity FROM y JOIN m USING (zone, period)""")
def fence_impute(spark, d):
    spiked = cleaned(spark, d).withColumn("period", F.weekofyear("time")).withColumn(
        "humidity", F.when((F.col("device_id") == 3) & (F.hour("time") == 5), F.col("humidity") * 9).otherwise(F.col("humidity")))
    return rounded(outliers.fence_impute(spiked).select(*KEYS, "time", "humidity"))


@query(f"""WITH {CLEAN} SELECT {K}, time, {rnd('(temperature - avg(temperature) OVER ()) / stddev_samp(temperature) OVER ()')} AS temp_z_score,
 {rnd('(humidity - avg(humidity) OVER ()) / stddev_samp(humidity) OVER ()')} AS humi_z_score FROM clean""")
def z_scores(spark, d):
    return rounded(outliers.z_scores(cleaned(spark, d)).select(*KEYS, "time", "temp_z_score", "humi_z_score"))


# --- grouped helpers --------------------------------------------------------------------------

@query(f"""WITH {CLEAN} SELECT {K}, time, {rnd('(temperature - avg(temperature) OVER ()) / stddev_pop(temperature) OVER ()')} AS temperature,
 {rnd('(humidity - avg(humidity) OVER ()) / stddev_pop(humidity) OVER ()')} AS humidity FROM clean""")
def standard_scale(spark, d):
    return rounded(groups.standardise(cleaned(spark, d), ["temperature", "humidity"]))


@query(f"""WITH {READINGS}, c AS (SELECT house, dense_rank() OVER (ORDER BY house) - 1 AS code FROM (SELECT DISTINCT house FROM readings))
SELECT {K}, time, CAST(code AS INTEGER) AS house_code FROM readings LEFT JOIN c USING (house)""")
def category_codes(spark, d):
    return groups.category_codes(fixtures.readings(spark, d), "house").select(*KEYS, "time", "house_code")


@query(f"""WITH {READINGS} SELECT house, time, {', '.join(f"CAST(device_id = {i} AS INTEGER) AS device_id_{i}" for i in range(8))},
 CAST(zone = 'Zone 1' AS INTEGER) AS "zone_Zone 1", CAST(zone = 'Zone 2' AS INTEGER) AS "zone_Zone 2" FROM readings""")
def one_hot(spark, d):
    table = groups.one_hot(groups.one_hot(fixtures.readings(spark, d), "device_id"), "zone")
    return table.drop("temperature", "humidity")


_TYPED = "t AS (SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type END AS event_type FROM events)"


@query(f"""WITH {_TYPED} SELECT event_id, coalesce(event_type, (SELECT event_type FROM t WHERE event_type IS NOT NULL
 GROUP BY 1 ORDER BY count(*) DESC, event_type LIMIT 1)) AS event_type FROM t""")
def mode_fill(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet").select(
        "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("event_type"))
    return groups.fill_mode(events, ["event_type"])


@query(f"""WITH {CLEAN} SELECT zone, 'temperature' AS measure, p AS prob, count(temperature) AS n, {rnd('quantile_cont(temperature, p)')} AS value
 FROM clean, (SELECT unnest([0.0, 0.09, 0.5, 0.91, 1.0]::DOUBLE[]) AS p) GROUP BY zone, p""".replace("quantile_cont(temperature, p)",
 "CASE p WHEN 0.0 THEN min(temperature) WHEN 0.09 THEN quantile_cont(temperature, 0.09) WHEN 0.5 THEN median(temperature) WHEN 0.91 THEN quantile_cont(temperature, 0.91) ELSE max(temperature) END"))
def exact_quantiles(spark, d):
    return rounded(groups.quantiles(cleaned(spark, d), ["temperature"], [0.0, 0.09, 0.5, 0.91, 1.0], ["zone"]))


@query("SELECT count(*) AS \"rows\", count(*) FILTER (WHERE value IS NULL) AS nulls FROM events")
def no_nulls(spark, d):
    events = missing.require_no_nulls(spark.read.parquet(f"{d}/events.parquet"), ["event_id", "value"])
    return events.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("value").isNull()).alias("nulls"))
