"""Registry of queries and their SQL, and the pieces of SQL they share."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sensorlab import fixtures

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(sql: str = None, name: str = None):
    """Register a query function under its name, with the SQL giving the same rows."""
    def register(function):
        key = name or function.__name__
        assert key not in QUERIES, key
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function
    return register


def rounded(df: DataFrame) -> DataFrame:
    """Round doubles to 6 places; the nudge keeps exact halves on the same side in both engines."""
    return df.select(*[
        near(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema
    ])


def near(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(1e-9), 6)


def rnd(expression: str) -> str:
    return f"round(({expression}) + 1e-9, 6)"


def clean(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit(-1.0)) for c in ("temperature", "humidity")})


K = "zone, device_id, house"
READINGS = f"readings AS ({fixtures.readings_sql('duckdb')})"
WEATHER = f"weather AS ({fixtures.weather_sql('duckdb')})"
CLEAN = f"{READINGS}, clean AS (SELECT {K}, time, nullif(temperature, -1) AS temperature, nullif(humidity, -1) AS humidity FROM readings)"
GRID = f"""{READINGS},
span AS (SELECT {K}, min(time) AS lo, max(time) AS hi FROM readings GROUP BY {K}),
grid AS (SELECT {K}, unnest(generate_series(lo, hi, INTERVAL 15 MINUTE)) AS time FROM span)"""
DENSE = f"""{GRID},
dense AS (SELECT {K}, time, coalesce(temperature, -1) AS temperature, coalesce(humidity, -1) AS humidity
          FROM grid LEFT JOIN readings USING ({K}, time))"""
HOLES = f"{DENSE}, holes AS (SELECT {K}, time, nullif(temperature, -1) AS temperature, nullif(humidity, -1) AS humidity FROM dense)"
MEASURES = ("temperature", "humidity")


def near_sql(source: str, cols=MEASURES, extra: str = "") -> str:
    """Position, neighbours and gap edges of every row, over plain whole-series windows."""
    parts = []
    for c in cols:
        parts.append(f"""
  last_value(CASE WHEN {c} IS NOT NULL THEN {{'s': s, 'rn': rn, 'v': {c}, 's2': {c}_ps, 'v2': {c}_pv, 'e': after}} END IGNORE NULLS)
    OVER (PARTITION BY {K} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}_p,
  first_value(CASE WHEN {c} IS NOT NULL THEN {{'s': s, 'rn': rn, 'v': {c}, 's2': {c}_ns, 'v2': {c}_nv, 'e': before}} END IGNORE NULLS)
    OVER (PARTITION BY {K} ORDER BY s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS {c}_n""")
    second = []
    for c in cols:
        second.append(f"""
  last_value(CASE WHEN {c} IS NOT NULL THEN s END IGNORE NULLS) OVER a AS {c}_ps, last_value({c} IGNORE NULLS) OVER a AS {c}_pv,
  first_value(CASE WHEN {c} IS NOT NULL THEN s END IGNORE NULLS) OVER b AS {c}_ns, first_value({c} IGNORE NULLS) OVER b AS {c}_nv""")
    return f"""
numbered AS (SELECT *, epoch(time) AS s FROM {source}),
seconds AS (SELECT *, row_number() OVER w AS rn, lag(s) OVER w AS before, lead(s) OVER w AS after,
  min(s) OVER (PARTITION BY {K}) AS series_first, max(s) OVER (PARTITION BY {K}) AS series_last,{','.join(second)}
  FROM numbered WINDOW w AS (PARTITION BY {K} ORDER BY s),
  a AS (PARTITION BY {K} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  b AS (PARTITION BY {K} ORDER BY s ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
near AS (SELECT * EXCLUDE ({', '.join(f'{c}_{x}' for c in cols for x in ('ps', 'pv', 'ns', 'nv'))}),{','.join(parts)}
  FROM seconds)"""


def linear_sql(c: str, axis: str = "rn", both: bool = False) -> str:
    here = "rn" if axis == "rn" else "s"
    first = f"WHEN {c}_n IS NOT NULL THEN {c}_n.v" if both else ""
    return f"""CASE WHEN {c} IS NOT NULL THEN {c}
  WHEN {c}_p IS NOT NULL AND {c}_n IS NOT NULL
    THEN {c}_p.v + ({c}_n.v - {c}_p.v) * (CAST({here} - {c}_p.{axis} AS DOUBLE) / ({c}_n.{axis} - {c}_p.{axis}))
  WHEN {c}_p IS NOT NULL THEN {c}_p.v {first} END"""


def hermite_sql(c: str) -> str:
    p, n = f"{c}_p", f"{c}_n"
    h = f"CAST({n}.s - {p}.s AS DOUBLE)"
    x = f"((s - {p}.s) / {h})"
    m0 = f"(({n}.v - {p}.v2) / ({n}.s - {p}.s2) * {h})"
    m1 = f"(({n}.v2 - {p}.v) / ({n}.s2 - {p}.s) * {h})"
    return f"""CASE WHEN {c} IS NOT NULL THEN {c}
  WHEN {p}.s2 IS NOT NULL AND {n}.s2 IS NOT NULL THEN
    (2*{x}*{x}*{x} - 3*{x}*{x} + 1) * {p}.v + ({x}*{x}*{x} - 2*{x}*{x} + {x}) * {m0}
    + (3*{x}*{x} - 2*{x}*{x}*{x}) * {n}.v + ({x}*{x}*{x} - {x}*{x}) * {m1}
  ELSE {linear_sql(c, 's')} END"""
