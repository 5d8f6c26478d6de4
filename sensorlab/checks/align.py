"""Queries over the alignment, gap and ordered operators."""

from pyspark.sql import functions as F

from sensorlab import fixtures
from sensorlab.checks.registry import (
    CLEAN, DENSE, GRID, HOLES, K, MEASURES, READINGS, WEATHER, clean, hermite_sql, linear_sql, near_sql, query, rnd, rounded,
)
from sensorlab.functions import calendar, missing
from sensorlab.operators import align, fills, gaps, ordered
from sensorlab.sources import readers

STEP = "15 minutes"
readings, weather, feed = fixtures.readings, fixtures.weather, fixtures.feed


def dense(spark, d):
    return ordered.densify(readings(spark, d), STEP)


def holes(spark, d):
    return clean(dense(spark, d))


def aligned(spark, d):
    return align.asof_join(readings(spark, d), weather(spark, d), "2 hours")


M = "round(temperature + 1e-9, 6) AS temperature, round(humidity + 1e-9, 6) AS humidity"
ASOF = f"""matched AS (SELECT r.*, CASE WHEN r.time - w.time <= INTERVAL 2 HOUR THEN GHI END AS GHI,
  CASE WHEN r.time - w.time <= INTERVAL 2 HOUR THEN Tair END AS Tair, CASE WHEN r.time - w.time <= INTERVAL 2 HOUR THEN RH END AS RH,
  CASE WHEN r.time - w.time <= INTERVAL 2 HOUR THEN WS END AS WS
  FROM readings r ASOF LEFT JOIN weather w ON r.time >= w.time)"""

_FEEDS = f"""t AS ({fixtures.feed_sql('duckdb', 'temperature')}), h AS ({fixtures.feed_sql('duckdb', 'humidity')}),
t1 AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY {K}, time ORDER BY event_id) = 1),
h1 AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY {K}, time ORDER BY event_id) = 1)"""


@query(f"""WITH {_FEEDS}
SELECT {K}, time, CASE WHEN h1.event_id IS NULL THEN -1 ELSE humidity END AS humidity,
  CASE WHEN t1.event_id IS NULL THEN -1 ELSE temperature END AS temperature
FROM t1 FULL JOIN h1 USING ({K}, time)""")
def measure_merge(spark, d):
    return align.measure_merge(feed(spark, d, "humidity"), feed(spark, d, "temperature"))


@query(f"""WITH {_FEEDS} SELECT DISTINCT device_id, house FROM (SELECT device_id, house FROM t UNION ALL SELECT device_id, house FROM h)""")
def distinct_keys(spark, d):
    return align.distinct_keys(feed(spark, d, "humidity"), feed(spark, d, "temperature"))


@query(f"""WITH {_FEEDS} SELECT time FROM t UNION SELECT time FROM h""")
def distinct_times(spark, d):
    return align.distinct_union([feed(spark, d, "humidity"), feed(spark, d, "temperature")], ["time"])


@query(f"WITH {READINGS} SELECT DISTINCT {K} FROM readings")
def distinct_series(spark, d):
    return missing.distinct_series(readings(spark, d))


@query(f"WITH {DENSE} SELECT {K}, time, temperature, humidity FROM dense")
def densify(spark, d):
    return dense(spark, d)


@query(f"""WITH {READINGS}, src AS (SELECT {K}, time, temperature, humidity FROM readings),
span AS (SELECT {K}, min(time) AS lo, max(time) AS hi FROM src GROUP BY {K}),
grid AS (SELECT {K}, unnest(generate_series(lo, hi, INTERVAL 30 MINUTE)) AS time FROM span)
SELECT {K}, time, coalesce(temperature, -1) AS temperature, coalesce(humidity, -1) AS humidity FROM grid LEFT JOIN src USING ({K}, time)""")
def densify_off_grid(spark, d):
    return ordered.densify(readings(spark, d), "30 minutes")


_SYNC = f"""WITH {READINGS},
f AS (SELECT zone, house, time, first(temperature ORDER BY device_id) AS t, first(humidity ORDER BY device_id) AS h FROM readings GROUP BY 1, 2, 3)
SELECT r.zone, r.device_id, r.house, r.time,
 coalesce(CASE WHEN own.t IS NULL OR own.t = -1 THEN CASE WHEN o.t <> -1 THEN o.t ELSE r.temperature END ELSE r.temperature END, -1) AS temperature,
 coalesce(CASE WHEN own.h IS NULL OR own.h = -1 THEN CASE WHEN o.h <> -1 THEN o.h ELSE r.humidity END ELSE r.humidity END, -1) AS humidity
FROM readings r JOIN f own ON own.zone = r.zone AND own.house = r.house AND own.time = r.time
LEFT JOIN f o ON o.zone <> r.zone AND o.house = r.house AND o.time = r.time"""


@query(_SYNC)
def zone_sync(spark, d):
    return align.zone_sync(readings(spark, d), on=("house", "time"), order=("device_id",))


@query(f"""WITH {READINGS},
f AS (SELECT zone, time, first(temperature ORDER BY device_id, house) AS t, first(humidity ORDER BY device_id, house) AS h FROM readings GROUP BY 1, 2)
SELECT r.zone, r.device_id, r.house, r.time,
 coalesce(CASE WHEN own.t IS NULL OR own.t = -1 THEN CASE WHEN o.t <> -1 THEN o.t ELSE r.temperature END ELSE r.temperature END, -1) AS temperature,
 coalesce(CASE WHEN own.h IS NULL OR own.h = -1 THEN CASE WHEN o.h <> -1 THEN o.h ELSE r.humidity END ELSE r.humidity END, -1) AS humidity
FROM readings r JOIN f own ON own.zone = r.zone AND own.time = r.time
LEFT JOIN f o ON o.zone <> r.zone AND o.time = r.time""")
def zone_sync_by_time(spark, d):
    return align.zone_sync(readings(spark, d))


@query(f"WITH {READINGS}, {WEATHER}, {ASOF} SELECT * FROM matched")
def asof_weather(spark, d):
    return aligned(spark, d)


@query(f"WITH {READINGS}, {WEATHER} SELECT r.*, GHI, Tair, RH, WS FROM readings r LEFT JOIN weather w USING (time)")
def weather_join(spark, d):
    return align.weather_join(readings(spark, d), weather(spark, d))


@query(f"""WITH {WEATHER}, raw AS (SELECT time + INTERVAL 7 MINUTE AS time, GHI, Tair, RH, WS FROM weather),
spine AS (SELECT unnest(generate_series(time_bucket(INTERVAL 15 MINUTE, min(time)), max(time), INTERVAL 15 MINUTE)) AS time FROM raw)
SELECT s.time, GHI, Tair, RH, WS FROM spine s ASOF LEFT JOIN raw r ON s.time >= r.time""")
def upsample_weather(spark, d):
    shifted = weather(spark, d).withColumn("time", F.expr("time + INTERVAL 7 MINUTE"))
    return ordered.upsample(shifted, STEP)


_GAPS = f"""{DENSE}, anchor AS (SELECT zone, min(time) AS a FROM dense GROUP BY zone),
b AS (SELECT zone, a + INTERVAL 1 HOUR * CAST(floor(epoch(time - a) / 3600) AS INTEGER) AS time, count(*) AS n,
  count(*) FILTER (WHERE temperature = -1) AS t, count(*) FILTER (WHERE humidity = -1) AS h
  FROM dense JOIN anchor USING (zone) GROUP BY 1, 2),
gaps AS (SELECT zone, time, CAST(hour(time) AS INTEGER) AS hour, CAST(minute(time) AS INTEGER) AS minute,
  strftime(time, '%Y-%m') AS year_month,
  CASE WHEN t = n AND h = n THEN 'both' WHEN t = n THEN 'temperature' WHEN h = n THEN 'humidity'
       WHEN t > 0 AND h > 0 THEN 'both' WHEN t > 0 THEN 'temperature' ELSE 'humidity' END AS gap_type,
  CASE WHEN t = n OR h = n THEN 'complete' ELSE 'partial' END AS completeness, CAST(day(time) AS INTEGER) AS day
  FROM b WHERE t > 0 OR h > 0)"""


@query(f"WITH {_GAPS} SELECT * FROM gaps")
def gap_intervals(spark, d):
    return gaps.gap_intervals(dense(spark, d), "1 hour")


@query(f"WITH {_GAPS} SELECT zone, year_month, gap_type, count(*) AS total_intervals FROM gaps GROUP BY 1, 2, 3")
def gap_summary(spark, d):
    return gaps.gap_summary(gaps.gap_intervals(dense(spark, d), "1 hour"))


def _runs(c):
    return f"""SELECT {K}, '{c}' AS measure, min(time) AS start_time, max(time) AS end_time, count(*) AS "rows",
  round(epoch(max(time) - min(time)) / 60.0, 6) AS minutes FROM (
  SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY time) - row_number() OVER (PARTITION BY {K}, {c} IS NULL ORDER BY time) AS g
  FROM holes) WHERE {c} IS NULL GROUP BY {K}, g"""


@query(f"WITH {HOLES} {_runs('temperature')} UNION ALL {_runs('humidity')}")
def gap_runs(spark, d):
    return rounded(gaps.gap_runs(dense(spark, d)))


@query(f"""WITH {READINGS} SELECT zone, count(*) AS total_rows,
  {rnd("100.0 * count(*) FILTER (WHERE temperature IS NULL OR temperature = -1) / count(*)")} AS temperature_missing_percentage,
  {rnd("100.0 * count(*) FILTER (WHERE humidity IS NULL OR humidity = -1) / count(*)")} AS humidity_missing_percentage
FROM readings GROUP BY zone""")
def missing_pct(spark, d):
    return rounded(missing.missing_percentages(readings(spark, d), ["zone"]))


@query(f"""WITH {READINGS} SELECT zone, count(*) AS total_rows,
  count(*) FILTER (WHERE temperature IS NULL) AS temperature_null, count(*) FILTER (WHERE temperature = -1) AS temperature_sentinel,
  count(*) FILTER (WHERE humidity IS NULL) AS humidity_null, count(*) FILTER (WHERE humidity = -1) AS humidity_sentinel
FROM readings GROUP BY zone""")
def data_statistics(spark, d):
    return missing.data_statistics(readings(spark, d))


@query(f"""WITH {READINGS} SELECT zone, time_bucket(INTERVAL 1 DAY, time) AS bucket,
  CAST(temperature IS NULL OR temperature = -1 AS INTEGER) AS temperature_missing,
  CAST(humidity IS NULL OR humidity = -1 AS INTEGER) AS humidity_missing, count(*) AS "rows" FROM readings GROUP BY 1, 2, 3, 4""")
def missing_patterns(spark, d):
    return missing.missing_patterns(readings(spark, d), calendar.floor_time("time", "1 day"))


@query(f"""WITH {READINGS}, {WEATHER}, {ASOF}
SELECT zone, count(*) AS "rows", f AS feature, count(*) - count(v) AS nulls FROM (
  SELECT zone, unnest(['GHI', 'Tair', 'RH', 'WS', 'temperature']) AS f, unnest([GHI, Tair, RH, WS, temperature]) AS v FROM matched) GROUP BY zone, f""")
def null_audit(spark, d):
    return missing.null_audit(aligned(spark, d), ["GHI", "Tair", "RH", "WS", "temperature"], ["zone"])


@query(f"""WITH {READINGS} SELECT {K}, time, temperature, humidity, CAST(month(time) AS INTEGER) AS month, CAST(day(time) AS INTEGER) AS day,
  CAST(hour(time) AS INTEGER) AS hour, CAST(minute(time) AS INTEGER) AS minute, CAST(isodow(time) - 1 AS INTEGER) AS day_of_week,
  CAST(dayofyear(time) AS INTEGER) AS day_of_year, CAST(isodow(time) >= 6 AS INTEGER) AS is_weekend FROM readings""")
def calendar_features(spark, d):
    return calendar.calendar_features(readings(spark, d))


@query(f"""WITH {READINGS} SELECT {K}, time, temperature, humidity, strftime(time, '%Y-%m') AS year_month, monthname(time) AS month_name,
  CAST(year(time) AS INTEGER) AS year, strftime(time, '%b %Y') AS month_year FROM readings""")
def period_labels(spark, d):
    return calendar.period_labels(readings(spark, d))


@query("""SELECT event_id, CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS time FROM events""")
def parse_time(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet")
    text = events.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("text"))
    return text.select("event_id", readers.parse_time("text").alias("time"))


@query(f"WITH {CLEAN} SELECT * FROM clean")
def sentinel_to_null(spark, d):
    return missing.sentinel_to_null(readings(spark, d))


@query(f"WITH {READINGS} SELECT {K}, time, coalesce(temperature, -1) AS temperature, coalesce(humidity, -1) AS humidity FROM readings")
def null_to_sentinel(spark, d):
    return missing.null_to_sentinel(readings(spark, d))


@query(f"""WITH {WEATHER} SELECT time, GHI AS "GHI_corr_Avg", Tair AS "Tair_Avg", RH, WS FROM weather""")
def rename_weather(spark, d):
    back = {v: k for k, v in {"GHI_corr_Avg": "GHI", "Tair_Avg": "Tair"}.items()}
    raw = weather(spark, d).withColumnsRenamed({"GHI": "GHI_corr_Avg", "Tair": "Tair_Avg", "RH": "RH_Avg", "WS": "WS_Avg"})
    return align.normalise_weather(raw).withColumnsRenamed(back)


@query(f"WITH {READINGS}, {WEATHER}, {ASOF} SELECT zone, device_id, time, temperature, humidity, GHI, Tair, RH FROM matched")
def drop_columns(spark, d):
    return align.drop_columns(aligned(spark, d), ["house", "WS", "year_month", "WSgust_Max", "WD_Std"])


@query(f"WITH {READINGS}, {WEATHER}, {ASOF} SELECT zone, device_id, house, GHI, Tair, RH, WS FROM matched")
def feature_selection(spark, d):
    table = aligned(spark, d)
    return table.select(*align.feature_columns(table, exclude=("time", "temperature", "humidity")))


@query(f"""WITH {READINGS} SELECT * FROM readings WHERE temperature IS NOT NULL AND temperature <> -1
  AND humidity IS NOT NULL AND humidity <> -1""")
def valid_rows(spark, d):
    return readings(spark, d).filter(missing.is_valid("temperature") & missing.is_valid("humidity"))


@query(f"""WITH {READINGS} SELECT * FROM readings WHERE month(time) < 6 AND device_id = 3 AND house = 'House 2'
  AND time >= TIMESTAMP '2024-01-10' AND time < TIMESTAMP '2024-01-20'""")
def range_filter(spark, d):
    return readings(spark, d).filter(
        (F.month("time") < 6) & (F.col("device_id") == 3) & (F.col("house") == "House 2")
        & F.expr("time >= TIMESTAMP_NTZ '2024-01-10 00:00:00' AND time < TIMESTAMP_NTZ '2024-01-20 00:00:00'"))


@query("""SELECT event_id, round(CASE WHEN value IS NOT NULL THEN greatest(0, least(100, value - 10)) END + 1e-9, 6) AS value FROM events""")
def clamp_percent(spark, d):
    return rounded(spark.read.parquet(f"{d}/events.parquet").select("event_id", missing.clamp(F.col("value") - 10).alias("value")))


@query(f"""WITH {READINGS} SELECT 'Before' AS label, * FROM readings UNION ALL
SELECT 'After' AS label, {K}, time, coalesce(temperature, -1) AS temperature, coalesce(humidity, -1) AS humidity FROM readings""")
def union_labelled(spark, d):
    before = readings(spark, d)
    return align.union_all([before, missing.null_to_sentinel(before)], ["Before", "After"])


@query(f"""WITH {READINGS}, ok AS (SELECT count(*) FILTER (WHERE isinf(temperature) OR isinf(humidity)) AS bad FROM readings)
SELECT zone, count(*) AS "rows", (SELECT bad = 0 FROM ok) AS valid FROM readings GROUP BY zone""")
def validate_columns(spark, d):
    table = readings(spark, d)
    valid = missing.validate(table, ["temperature", "humidity"])
    return table.groupBy("zone").agg(F.count(F.lit(1)).alias("rows"), F.lit(valid).alias("valid"))


# --- ordered ----------------------------------------------------------------------------------

_NEAR = f"WITH {HOLES}, {near_sql('holes')}"


def _filled(expression):
    t, h = expression("temperature"), expression("humidity")
    return f"{_NEAR} SELECT {K}, time, {rnd(t)} AS temperature, {rnd(h)} AS humidity FROM near"


@query(_filled(lambda c: f"coalesce({c}, {c}_p.v)"))
def fill_locf(spark, d):
    return rounded(fills.impute(holes(spark, d), "locf"))


@query(_filled(lambda c: f"coalesce({c}, {c}_n.v)"))
def fill_nocb(spark, d):
    return rounded(fills.impute(holes(spark, d), "nocb"))


@query(_filled(linear_sql))
def fill_linear(spark, d):
    return rounded(ordered.fill(holes(spark, d), ordered.linear))


@query(_filled(lambda c: f"CASE WHEN {c} IS NOT NULL OR rn - {c}_p.rn <= 3 THEN {linear_sql(c)} END"))
def fill_linear_limit(spark, d):
    return rounded(ordered.fill(holes(spark, d), lambda c: ordered.linear(c, limit=3)))


@query(_filled(lambda c: linear_sql(c, both=True)))
def fill_linear_both(spark, d):
    return rounded(ordered.fill(holes(spark, d), lambda c: ordered.linear(c, both=True)))


_CLEAN_NEAR = f"WITH {CLEAN}, {near_sql('clean')}"


@query(f"{_CLEAN_NEAR} SELECT {K}, time, {rnd(linear_sql('temperature', 's'))} AS temperature, {rnd(linear_sql('humidity', 's'))} AS humidity FROM near")
def fill_time_weighted(spark, d):
    return rounded(ordered.fill(clean(readings(spark, d)), lambda c: ordered.linear(c, "ts")))


@query(_filled(hermite_sql))
def fill_spline(spark, d):
    return rounded(ordered.fill(holes(spark, d), ordered.hermite, detail=True))


def _win(c):
    return f"""last_value(CASE WHEN {c} IS NOT NULL THEN {{'s': s, 'rn': rn, 'v': {c}}} END IGNORE NULLS) OVER
  (PARTITION BY {K} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}_p0,
 first_value(CASE WHEN {c} IS NOT NULL THEN {{'s': s, 'rn': rn, 'v': {c}}} END IGNORE NULLS) OVER
  (PARTITION BY {K} ORDER BY s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS {c}_n0"""


@query(f"""WITH {HOLES}, a AS (SELECT *, CAST(epoch(time) AS BIGINT) AS s, row_number() OVER (PARTITION BY {K} ORDER BY time) AS rn FROM holes),
b AS (SELECT *, s // 900 * 900 AS i0, {_win('temperature')}, {_win('humidity')} FROM a),
c AS (SELECT *, {', '.join(f"CASE WHEN {m}_p0.s >= i0 - 3600 THEN {m}_p0 END AS {m}_p, CASE WHEN {m}_n0.s < i0 + 4500 THEN {m}_n0 END AS {m}_n" for m in MEASURES)} FROM b)
SELECT {K}, time, {', '.join(rnd(f"coalesce({linear_sql(m, both=True)}, -1)") + f" AS {m}" for m in MEASURES)} FROM c""")
def fill_windowed(spark, d):
    return rounded(ordered.fill_windowed(dense(spark, d)))


def _chain(c):
    return f"coalesce({linear_sql(c, both=True)}, 0)"


@query(f"{_CLEAN_NEAR} SELECT {K}, time, {rnd(_chain('temperature'))} AS temperature, {rnd(_chain('humidity'))} AS humidity FROM near")
def fill_chain(spark, d):
    return rounded(ordered.fill_chain(clean(readings(spark, d)), ["temperature", "humidity"]))


def _rolling(c):
    p = c[:4]
    return f"""{rnd(f'avg({c}) OVER r')} AS {p}_rolling_mean, {rnd(f'coalesce(stddev_samp({c}) OVER r, 0)')} AS {p}_rolling_std,
  {rnd(f'coalesce({c} - lag({c}) OVER w, 0)')} AS {p}_diff"""


@query(f"""WITH {CLEAN} SELECT {K}, time, {M}, {_rolling('temperature')}, {_rolling('humidity')}
FROM clean WINDOW w AS (PARTITION BY {K} ORDER BY time), r AS (PARTITION BY {K} ORDER BY time ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)""")
def rolling_features(spark, d):
    return rounded(ordered.rolling_features(clean(readings(spark, d))))


@query(f"""WITH {HOLES}, {near_sql('holes')}, f AS (SELECT *, {linear_sql('temperature', both=True)} AS t FROM near)
SELECT {K}, time, {rnd(f'avg(t) OVER (PARTITION BY {K} ORDER BY rn ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)')} AS temperature FROM f""")
def centred_mean(spark, d):
    near = ordered.neighbours(holes(spark, d), ["temperature"], detail=False).withColumn("temperature", ordered.linear("temperature", both=True))
    out = ordered.smooth(near, "temperature", ["zone", "device_id", "house"], "_rn")
    return rounded(out.select("zone", "device_id", "house", "time", "temperature"))


@query(f"""WITH {HOLES}, {near_sql('holes')}, f AS (SELECT *, round({linear_sql('temperature', both=True)}, 0) AS v FROM near),
s AS (SELECT *, CASE WHEN lag(v) OVER (PARTITION BY {K} ORDER BY rn) IS NOT DISTINCT FROM v THEN 0 ELSE 1 END AS new FROM f),
g AS (SELECT {K}, rn, sum(new) OVER (PARTITION BY {K} ORDER BY rn) AS g FROM s),
n AS (SELECT {K}, g, count(*) AS c FROM g GROUP BY {K}, g)
SELECT {K}, max(c) AS longest, CAST(sum(c) AS BIGINT) AS "rows", {rnd('max(c) / sum(c)')} AS share FROM n GROUP BY {K}""")
def constant_run(spark, d):
    near = ordered.neighbours(holes(spark, d), ["temperature"], detail=False).withColumn("temperature", ordered.linear("temperature", both=True))
    return rounded(gaps.longest_constant_run(near, "temperature", ["zone", "device_id", "house"], "_rn", digits=0, block=64))
