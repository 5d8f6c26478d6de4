"""Queries over the nearest-neighbour, analog-period and long-gap operators."""

from pyspark.sql import functions as F

from sensorlab import fixtures
from sensorlab.checks.align import M, aligned, holes
from sensorlab.checks.quality import cleaned
from sensorlab.checks.quality import tier_sql
from sensorlab.checks.registry import CLEAN, HOLES, K, READINGS, WEATHER, clean, hermite_sql, linear_sql, near_sql, query, rnd, rounded
from sensorlab.operators import align, analog, fills, ordered, patterns

KEYS = ["zone", "device_id", "house"]


# --- k nearest in the other measure -----------------------------------------------------------

def _knn(c, o):
    return f"""{c}_d AS (SELECT zone, {o} AS v, count(*) AS n, sum({c}) AS s FROM clean WHERE {c} IS NOT NULL AND {o} IS NOT NULL GROUP BY 1, 2),
{c}_x AS (SELECT DISTINCT zone, {o} AS x FROM clean WHERE {c} IS NULL AND {o} IS NOT NULL),
{c}_r AS (SELECT zone, x, round(abs(v - x), 9) AS d, sum(n) AS n, sum(s) AS s FROM {c}_x JOIN {c}_d USING (zone) GROUP BY 1, 2, 3),
{c}_u AS (SELECT *, greatest(least(n, 60 - sum(n) OVER (PARTITION BY zone, x ORDER BY d) + n), 0) AS used FROM {c}_r),
{c}_m AS (SELECT zone, x, sum(s / n * used) / sum(used) AS m FROM {c}_u WHERE used > 0 GROUP BY 1, 2)"""


@query(f"""WITH {CLEAN}, {_knn('temperature', 'humidity')}, {_knn('humidity', 'temperature')},
a AS (SELECT zone, avg(temperature) AS t, avg(humidity) AS h FROM clean GROUP BY 1)
SELECT c.zone, device_id, house, time, {rnd('coalesce(temperature, tm.m, t)')} AS temperature, {rnd('coalesce(humidity, hm.m, h)')} AS humidity
FROM clean c JOIN a USING (zone) LEFT JOIN temperature_m tm ON tm.zone = c.zone AND tm.x = c.humidity
LEFT JOIN humidity_m hm ON hm.zone = c.zone AND hm.x = c.temperature""")
def knn_fill(spark, d):
    return rounded(fills.impute(cleaned(spark, d), "knn", by=["zone"]))


# --- analog period ----------------------------------------------------------------------------

ENV = ["GHI", "Tair", "RH", "WS"]
WEIGHTS = {"GHI": 2.0, "Tair": 2.0, "RH": 1.8, "WS": 1.5, "hour": 3.0, "day_of_week": 1.5, "is_weekend": 1.0}


def _windows(f):
    return f"""coalesce({f}, last_value({f} IGNORE NULLS) OVER (PARTITION BY {K}, slice ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
 first_value({f} IGNORE NULLS) OVER (PARTITION BY {K}, slice ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS {f}"""


_DAYS = "day(time) BETWEEN {} AND {}"
_ANALOG = f"""WITH {CLEAN}, {WEATHER},
base AS (SELECT r.*, CASE WHEN r.time - w.time <= INTERVAL 2 HOUR THEN GHI END AS GHI, CASE WHEN r.time - w.time <= INTERVAL 2 HOUR THEN Tair END AS Tair,
  CASE WHEN r.time - w.time <= INTERVAL 2 HOUR THEN RH END AS RH, CASE WHEN r.time - w.time <= INTERVAL 2 HOUR THEN WS END AS WS
  FROM clean r ASOF LEFT JOIN weather w ON r.time >= w.time),
sliced AS (SELECT *, CASE WHEN day(time) <= 15 THEN 0 ELSE 1 END AS slice FROM base),
feat AS (SELECT {K}, time, temperature, humidity, slice, {', '.join(_windows(f) for f in ENV)}, hour(time) AS hour, isodow(time) - 1 AS day_of_week,
  CAST(isodow(time) >= 6 AS INTEGER) AS is_weekend FROM sliced),
stats AS (SELECT {K}, {', '.join(f'avg({f}) AS {f}_m, CASE WHEN stddev_pop({f}) > 0 THEN stddev_pop({f}) ELSE 1 END AS {f}_s' for f in WEIGHTS)} FROM feat WHERE slice = 0 GROUP BY {K}),
w AS (SELECT {K}, time, temperature, humidity, slice, {', '.join(f'({f} - {f}_m) / {f}_s * {v} AS f_{f}' for f, v in WEIGHTS.items())} FROM feat JOIN stats USING ({K})),
trend AS (SELECT {K}, {', '.join(f"coalesce(avg({c}) FILTER (WHERE {_DAYS.format(24, 30)}) - avg({c}) FILTER (WHERE {_DAYS.format(1, 7)}), 0) AS {c}_trend" for c in ('temperature', 'humidity'))} FROM clean GROUP BY {K})"""


def _near(c, extra=""):
    d2 = " + ".join(f"(t.f_{f} - r.f_{f}) * (t.f_{f} - r.f_{f})" for f in WEIGHTS)
    return f"""{c}_n AS (SELECT {', '.join('t.' + k for k in KEYS)}, t.time, r.time AS at, r.{c} AS v, round({d2}, 9) AS d2 FROM w t JOIN w r USING ({K})
  WHERE t.slice = 1 AND r.slice = 0 AND t.{c} IS NULL AND r.{c} IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {', '.join('t.' + k for k in KEYS)}, t.time ORDER BY round({d2}, 9), r.time) <= 5),
{c}_a AS (SELECT {K}, time, sum(v / (sqrt(d2) + 1e-5)) / sum(1 / (sqrt(d2) + 1e-5)) AS {c}_analog FROM {c}_n GROUP BY {K}, time)"""


def _value(c):
    v = f"{c}_analog + {c}_trend * day(time) / day(last_day(time))"
    return f"coalesce({c}, {v})" if c == "temperature" else f"coalesce({c}, CASE WHEN {c}_analog IS NOT NULL THEN greatest(0, least(100, {v})) END)"


@query(f"""{_ANALOG}, {_near('temperature')}, {_near('humidity')}
SELECT {K}, time, {rnd(_value('temperature'))} AS temperature, {rnd(_value('humidity'))} AS humidity, GHI, Tair, RH, WS
FROM base JOIN trend USING ({K}) LEFT JOIN temperature_a USING ({K}, time) LEFT JOIN humidity_a USING ({K}, time)""")
def fill_analog(spark, d):
    day = F.dayofmonth("time")
    table = align.asof_join(cleaned(spark, d), fixtures.weather(spark, d), "2 hours")
    out = analog.fill_analog(table, day <= 15, day > 15, day.between(1, 7), day.between(24, 30), env=ENV)
    return rounded(out).withColumns({c: F.col(c) for c in ENV})


@query(f"""{_ANALOG} SELECT {K}, time, slice, {', '.join(rnd('f_' + f) + ' AS f_' + f for f in WEIGHTS)} FROM w""")
def weighted_features(spark, d):
    day = F.dayofmonth("time")
    table = align.asof_join(cleaned(spark, d), fixtures.weather(spark, d), "2 hours")
    from sensorlab.functions.calendar import calendar_features
    rows = calendar_features(table, only=("hour", "day_of_week", "is_weekend")).withColumn("slice", F.when(day <= 15, 0).otherwise(1))
    rows = ordered.fill_chain(rows, ENV, [*KEYS, "slice"], interpolate=False)
    out = analog.weighted_features(rows, day <= 15, day > 15, list(WEIGHTS))
    return rounded(out.select(*KEYS, "time", "slice", *[F.col(f"_f_{f}").alias(f"f_{f}") for f in WEIGHTS]))


@query(f"""{_ANALOG} SELECT {K}, {rnd('temperature_trend')} AS temperature_trend, {rnd('humidity_trend')} AS humidity_trend FROM trend""")
def trend_means(spark, d):
    day = F.dayofmonth("time")
    out = analog.trend_means(cleaned(spark, d), day.between(1, 7), day.between(24, 30))
    return rounded(out.select(*KEYS, "temperature_trend", "humidity_trend"))


# --- long gaps --------------------------------------------------------------------------------

C = "temperature"
_LONG = f"""WITH {HOLES}, {near_sql('holes', (C,))},
lg AS (SELECT {K}, time, rn, coalesce({C}_p.rn, 0) AS gap, rn - coalesce({C}_p.rn, 0) - 1 AS i, {C}_p.v AS before_v, {C}_n.v AS after_v, {hermite_sql(C)} AS curve,
  CAST(time AS DATE) AS date, hour(time) AS hour FROM near WHERE {C} IS NULL
  AND (CASE WHEN {C}_n IS NULL THEN series_last ELSE {C}_n.e END) - (CASE WHEN {C}_p IS NULL THEN series_first ELSE {C}_p.e END) > 21600),
hour_dow AS (SELECT {K}, hour(time) AS hour, isodow(time) AS dow, avg({C}) AS m FROM holes GROUP BY ALL),
hour_only AS (SELECT {K}, hour(time) AS hour, avg({C}) AS hour_mean FROM holes GROUP BY ALL),
whole AS (SELECT {K}, avg({C}) AS overall FROM holes GROUP BY {K}),
seas AS (SELECT {K}, gap, rn, i, coalesce(m, hour_mean, overall) AS raw FROM lg LEFT JOIN (SELECT * FROM hour_dow) h USING ({K}, hour)
  LEFT JOIN hour_only USING ({K}, hour) LEFT JOIN whole USING ({K}) WHERE h.dow IS NULL OR h.dow = isodow(time)),
seasonal AS (SELECT {K}, gap, rn, avg(raw) OVER (PARTITION BY {K}, gap ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS value FROM seas)"""
_LONG = _LONG.replace("LEFT JOIN (SELECT * FROM hour_dow) h USING ({K}, hour)", "").replace(
    f"FROM lg LEFT JOIN (SELECT * FROM hour_dow) h USING ({K}, hour)",
    f"FROM (SELECT *, isodow(time) AS dow FROM lg) LEFT JOIN hour_dow USING ({K}, hour, dow)").replace(" WHERE h.dow IS NULL OR h.dow = isodow(time)", "")


@query(f"{_LONG} SELECT {K}, rn, {rnd('value')} AS value FROM seasonal")
def seasonal_values(spark, d):
    out = patterns.long_gap_values(holes(spark, d), C, "seasonal", "6 hours")
    return rounded(out.select(*KEYS, F.col("_rn").alias("rn"), "value"))


@query(f"""{_LONG} SELECT {K}, hour_dow.hour, CAST(dow - 1 AS INTEGER) AS day_of_week, {rnd('m')} AS mean, {rnd('hour_mean')} AS hour_mean, {rnd('overall')} AS overall
FROM hour_dow JOIN hour_only USING ({K}, hour) JOIN whole USING ({K}) WHERE m IS NOT NULL""".replace("hour_dow.hour,", "CAST(hour AS INTEGER) AS hour,"))
def seasonal_means(spark, d):
    return rounded(patterns.seasonal_means(holes(spark, d), C))


def _pattern(score, extra=""):
    return f"""{_LONG},
pm AS (SELECT {K}, CAST(time AS DATE) AS cdate, hour(time) AS hour, minute(time) AS minute, min_by({C}, time) AS v FROM holes WHERE {C} IS NOT NULL GROUP BY ALL),
cand AS (SELECT {K}, CAST(time AS DATE) AS cdate, hour(time) AS hour, count(*) AS cn, min(time) AS cfirst{', ' + extra if extra else ''} FROM {'filled_env' if extra else 'holes'} WHERE {C} IS NOT NULL GROUP BY {K}, 4, 5),
hours AS (SELECT {K}, gap, date, hour, count(*) AS n, min(time) AS first_t FROM lg GROUP BY ALL),
pairs AS (SELECT *, abs(floor(epoch(cfirst - first_t) / 86400)) AS days, least(1, abs(isodow(cfirst) - isodow(first_t)) / 7) AS wd
  FROM hours JOIN cand USING ({K}, hour) WHERE cn >= n / 2),
scored AS (SELECT *, round({score}, 9) AS score FROM pairs{f' LEFT JOIN ctx USING ({K}, gap)' if extra else ''}),
top3 AS (SELECT *, row_number() OVER (PARTITION BY {K}, gap, date, hour ORDER BY score, cfirst) AS nth FROM scored QUALIFY nth <= 3),
exact AS (SELECT {K}, lg.rn, sum(v / (score + 0.1)) / sum(1 / (score + 0.1)) AS v FROM lg JOIN top3 USING ({K}, gap, date, hour)
  JOIN pm USING ({K}, cdate, hour) WHERE pm.minute = minute(lg.time) GROUP BY {K}, lg.rn),
each AS (SELECT {K}, lg.rn, nth, first(v ORDER BY abs(pm.minute - minute(lg.time)), pm.minute) AS v FROM lg JOIN top3 USING ({K}, gap, date, hour)
  JOIN pm USING ({K}, cdate, hour) GROUP BY {K}, lg.rn, nth),
closest AS (SELECT {K}, rn, avg(v) AS v FROM each GROUP BY {K}, rn),
raw AS (SELECT {K}, gap, lg.rn, i, before_v, after_v, coalesce(exact.v, closest.v, hour_mean, curve) AS value FROM lg
  LEFT JOIN exact USING ({K}, rn) LEFT JOIN closest USING ({K}, rn) LEFT JOIN hour_only USING ({K}, hour)),
slope AS (SELECT *, count(*) OVER g AS n, avg(value) OVER g AS mean, (after_v - before_v) / count(*) OVER g AS k FROM raw WHERE value IS NOT NULL WINDOW g AS (PARTITION BY {K}, gap)),
based AS (SELECT *, CASE WHEN abs(k) > 0.01 THEN before_v + k * i + (value - mean) ELSE value END AS b FROM slope),
smoothed AS (SELECT *, CASE WHEN n > 5 THEN avg(b) OVER (PARTITION BY {K}, gap ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) ELSE b END AS s FROM based),
steps AS (SELECT *, CASE WHEN lag(round(s, 3)) OVER (PARTITION BY {K}, gap ORDER BY i) IS NOT DISTINCT FROM round(s, 3) THEN 0 ELSE 1 END AS new FROM smoothed),
runs AS (SELECT {K}, gap, r, count(*) AS c FROM (SELECT *, sum(new) OVER (PARTITION BY {K}, gap ORDER BY i) AS r FROM steps) GROUP BY ALL),
constant AS (SELECT {K}, gap FROM runs GROUP BY ALL HAVING max(c) > 0.5 * sum(c)),
pattern AS (SELECT {K}, gap, rn, s AS value FROM smoothed ANTI JOIN constant USING ({K}, gap) UNION ALL SELECT {K}, gap, rn, value FROM seasonal SEMI JOIN constant USING ({K}, gap))"""


@query(f"{_pattern('least(1, days / 365) + wd * 2')} SELECT {K}, rn, {rnd('value')} AS value FROM pattern")
def pattern_values(spark, d):
    out = patterns.long_gap_values(holes(spark, d), C, "pattern", "6 hours")
    return rounded(out.select(*KEYS, F.col("_rn").alias("rn"), "value"))


@query(f"""{_pattern('least(1, days / 365) + wd * 2')} SELECT {K}, gap, date, CAST(hour AS INTEGER) AS hour, CAST(nth AS INTEGER) AS nth, {rnd('score')} AS score, cfirst AS candidate FROM top3""")
def similar_hours(spark, d):
    table = holes(spark, d)
    rows = patterns.long_gap_rows(table, C, "6 hours").withColumns({"date": F.to_date("time"), "hour": F.hour("time")})
    hours = rows.groupBy(*KEYS, "_gap", "date", "hour").agg(F.count(F.lit(1)).alias("n"), F.min("time").alias("first"))
    out = patterns.similar_hours(hours, patterns.hour_patterns(table, C))
    return rounded(out.select(*KEYS, F.col("_gap").alias("gap"), "date", "hour", "nth", "score", F.col("_cfirst").alias("candidate")))


# Weather differences to the 96 valid rows on either side of the gap.
_HOLES_ENV = f"""{_LONG},
env0 AS (SELECT h.*, CASE WHEN h.time - w.time <= INTERVAL 2 HOUR THEN Tair END AS Tair, CASE WHEN h.time - w.time <= INTERVAL 2 HOUR THEN RH END AS RH
  FROM holes h ASOF LEFT JOIN weather w ON h.time >= w.time),
env1 AS (SELECT *, epoch(time) AS s, row_number() OVER (PARTITION BY {K} ORDER BY time) AS rn FROM env0),
env2 AS (SELECT *, {', '.join(f'''last_value(CASE WHEN {e} IS NOT NULL THEN {{'s': s, 'rn': rn, 'v': {e}}} END IGNORE NULLS) OVER (PARTITION BY {K} ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {e}_p,
  first_value(CASE WHEN {e} IS NOT NULL THEN {{'s': s, 'rn': rn, 'v': {e}}} END IGNORE NULLS) OVER (PARTITION BY {K} ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS {e}_n''' for e in ('Tair', 'RH'))} FROM env1),
filled_env AS (SELECT {K}, time, rn, temperature, {', '.join(f'coalesce({linear_sql(e, both=True)}, 0) AS {e}' for e in ('Tair', 'RH'))},
  sum(CAST({C} IS NOT NULL AS INTEGER)) OVER (PARTITION BY {K} ORDER BY rn) AS vr FROM env2),
starts AS (SELECT {K}, gap, min(vr) AS a FROM lg JOIN filled_env USING ({K}, rn) GROUP BY ALL),
ctx AS (SELECT {K}, gap, {', '.join(f'avg({e}) FILTER (WHERE vr <= a) AS {e}_b, avg({e}) FILTER (WHERE vr > a) AS {e}_a' for e in ('Tair', 'RH'))}
  FROM starts JOIN filled_env USING ({K}) WHERE {C} IS NOT NULL AND vr > a - 96 AND vr <= a + 96 GROUP BY ALL)"""
_ENV_SCORE = """CASE WHEN Tair_b IS NULL AND Tair_a IS NULL THEN least(1, days / 365) + wd * 2 ELSE
 (coalesce(abs(c_tair - Tair_b), 0) + coalesce(abs(c_tair - Tair_a), 0) + coalesce(abs(c_rh - RH_b), 0) + coalesce(abs(c_rh - RH_a), 0))
 / (CAST(Tair_b IS NOT NULL AS INTEGER) + CAST(Tair_a IS NOT NULL AS INTEGER) + CAST(RH_b IS NOT NULL AS INTEGER) + CAST(RH_a IS NOT NULL AS INTEGER))
 + least(1, days / 365) + wd END"""
_ENV_PATTERN = _pattern(_ENV_SCORE, "avg(Tair) AS c_tair, avg(RH) AS c_rh").replace(_LONG, _HOLES_ENV, 1).replace("WITH ", f"WITH {WEATHER}, ", 1)


def holes_weather(spark, d):
    return align.asof_join(holes(spark, d), fixtures.weather(spark, d).select("time", "Tair", "RH"), "2 hours")


@query(f"{_ENV_PATTERN} SELECT {K}, gap, {', '.join(rnd(f'{e}_{s}') + f' AS {e}_{s}' for e in ('Tair', 'RH') for s in ('b', 'a'))} FROM ctx")
def gap_context(spark, d):
    table = ordered.fill_chain(holes_weather(spark, d), ["Tair", "RH"])
    starts = patterns.long_gap_rows(table, C, "6 hours").groupBy(*KEYS, "_gap").agg(F.min("time").alias("_start"))
    out = patterns.gap_context(table, starts, C, ["Tair", "RH"], rows=96)
    return rounded(out.select(*KEYS, F.col("_gap").alias("gap"), *[
        F.col(f"_{e}_{n}").alias(f"{e}_{n[0]}") for e in ("Tair", "RH") for n in ("before", "after")]))


@query(f"{_ENV_PATTERN} SELECT {K}, rn, {rnd('value')} AS value FROM pattern")
def pattern_values_weather(spark, d):
    out = patterns.long_gap_values(holes_weather(spark, d), C, "pattern", "6 hours", env=("Tair", "RH"), context_rows=96)
    return rounded(out.select(*KEYS, F.col("_rn").alias("rn"), "value"))


@query(f"""{_pattern('least(1, days / 365) + wd * 2')}
SELECT {K}, time, {rnd(f'coalesce({tier_sql(C, 0, 21600, 0)}, pattern.value)')} AS {C} FROM near LEFT JOIN pattern USING ({K}, rn)""")
def fill_tiered_pattern(spark, d):
    table = holes(spark, d).drop("humidity")
    return rounded(fills.fill_tiered(table, [C], short="0 minutes", medium="6 hours", limit=0, long_gap="pattern"))
