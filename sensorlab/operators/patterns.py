"""Filling long gaps from similar hours elsewhere in the series, or from its seasonal profile."""

from pyspark.sql import DataFrame, Window, functions as F

from sensorlab.functions.calendar import floor_div, span_micros
from sensorlab.functions.groups import lookup
from sensorlab.operators.gaps import longest_constant_run
from sensorlab.operators.ordered import CHUNK, fill_chain, gap_end, gap_start, hermite, neighbours, running_count, smooth
from sensorlab.schema import KEYS, TIME
from sensorlab.session import stage

CONTEXT = 1440
MIN_ROWS = 10


def long_gap_rows(df: DataFrame, c: str, longer_than: str = "2 days", keys=KEYS, time: str = TIME, chunk: str = CHUNK, order=None) -> DataFrame:
    """Missing rows of gaps longer than ``longer_than``: gap number, index in the gap, values at its edges.

    ``_gap`` is the position of the last valid row before the gap (0 for a leading gap); ``_curve`` is
    the cubic fill used where a series offers nothing better.
    """
    near = neighbours(df, [c], keys, time, chunk, order)
    return near.filter(F.col(c).isNull() & (gap_end(c) - gap_start(c) > span_micros(longer_than))).select(
        *keys, time, "_rn", F.coalesce(f"_{c}_p.rn", F.lit(0)).alias("_gap"),
        (F.col("_rn") - F.coalesce(f"_{c}_p.rn", F.lit(0)) - 1).alias("_i"),
        F.col(f"_{c}_p.v").alias("_before"), F.col(f"_{c}_n.v").alias("_after"), hermite(c).alias("_curve"))


def seasonal_means(df: DataFrame, c: str, keys=KEYS, time: str = TIME) -> DataFrame:
    """Mean per series, hour and day of week, with the hour's mean and the series' mean beside it."""
    valid = df.filter(F.col(c).isNotNull())
    fine = valid.groupBy(*keys, F.hour(time).alias("hour"), F.weekday(time).alias("day_of_week")).agg(
        F.sum(c).alias("_s"), F.count(c).alias("_n"))
    hours = fine.groupBy(*keys, "hour").agg(F.sum("_s").alias("_hs"), F.sum("_n").alias("_hn"))
    whole = hours.groupBy(*keys).agg((F.sum("_hs") / F.sum("_hn")).alias("overall"))
    return fine.join(hours, [*keys, "hour"]).join(whole, list(keys)).select(
        *keys, "hour", "day_of_week", (F.col("_s") / F.col("_n")).alias("mean"),
        (F.col("_hs") / F.col("_hn")).alias("hour_mean"), "overall")


def seasonal_profile(rows: DataFrame, df: DataFrame, c: str, keys=KEYS, time: str = TIME) -> DataFrame:
    """For the given rows: mean of the hour and weekday, else of the hour, else of the series."""
    keys = list(keys)
    means = seasonal_means(df, c, keys, time)
    fine = lookup(means.select(*keys, "hour", "day_of_week", "mean"))
    hours = lookup(means.groupBy(*keys, "hour").agg(F.max("hour_mean").alias("hour_mean")))
    whole = lookup(means.groupBy(*keys).agg(F.max("overall").alias("overall")))
    out = rows.withColumns({"hour": F.hour(time), "day_of_week": F.weekday(time)})
    out = out.join(fine, [*keys, "hour", "day_of_week"], "left").join(hours, [*keys, "hour"], "left").join(whole, keys, "left")
    return out.withColumn("value", F.coalesce("mean", "hour_mean", "overall")).drop(
        "hour", "day_of_week", "mean", "hour_mean", "overall")


def gap_context(df: DataFrame, gaps: DataFrame, c: str, env, keys=KEYS, time: str = TIME, rows: int = CONTEXT,
                chunk: str = CHUNK) -> DataFrame:
    """Per gap the mean of each ``env`` column over the last valid rows before it and the first after.

    Valid rows are numbered in their series; a gap meets the numbered rows in blocks as long as the
    context, so it touches three blocks at most.
    """
    keys, env = list(keys), list(env)
    valid = running_count(df, F.col(c).isNotNull(), "_rank", keys, time, chunk).filter(F.col(c).isNotNull()).select(
        *keys, "_rank", F.col(time).alias("_t"), *env, floor_div(F.col("_rank"), rows).alias("_block"))
    # The rank of the valid row before the gap is the number of valid rows up to any row of the gap.
    ranked = running_count(df, F.col(c).isNotNull(), "_rank", keys, time, chunk).select(*keys, F.col(time).alias("_start"), "_rank")
    starts = gaps.join(ranked, [*keys, "_start"]).groupBy(*keys, "_gap").agg(F.min("_rank").alias("_at"))
    blocks = starts.withColumn("_block", F.explode(F.sequence(
        floor_div(F.col("_at") - rows + 1, rows), floor_div(F.col("_at") + rows, rows))))
    joined = blocks.join(valid, [*keys, "_block"])
    before = F.col("_rank").between(F.col("_at") - rows + 1, F.col("_at"))
    after = F.col("_rank").between(F.col("_at") + 1, F.col("_at") + rows)
    means = [F.avg(F.when(side, F.col(e))).alias(f"_{e}_{n}") for e in env for n, side in (("before", before), ("after", after))]
    return joined.groupBy(*keys, "_gap").agg(*means)


def hour_patterns(df: DataFrame, c: str, env=(), keys=KEYS, time: str = TIME) -> DataFrame:
    """One row per series, date and hour with valid values: rows, mean weather, value per minute."""
    minutes = df.filter(F.col(c).isNotNull()).groupBy(
        *keys, F.to_date(time).alias("date"), F.hour(time).alias("hour"), F.minute(time).alias("minute")).agg(
        F.min_by(c, time).alias("v"), F.count(F.lit(1)).alias("n"), F.min(time).alias("first"),
        *[F.sum(e).alias(f"_{e}") for e in env])
    return minutes.groupBy(*keys, "date", "hour").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.map_from_entries(F.collect_list(F.struct("minute", "v"))).alias("minutes"),
        *[(F.sum(f"_{e}") / F.sum("n")).alias(e) for e in env]).withColumn("month", F.month("date"))


def similar_hours(hours: DataFrame, patterns: DataFrame, env=(), keys=KEYS, context: DataFrame = None, top: int = 3,
                  wrap: bool = False) -> DataFrame:
    """The ``top`` most similar hours of the series for every gap hour, with their score.

    Candidates share the hour and the month; with fewer than ten rows the adjacent months are added,
    and failing that all months. The score adds the mean weather difference to the sides of the gap,
    the distance in days (a year counts 1) and in weekdays (a week counts 1; double without weather).
    """
    keys, env = list(keys), list(env)
    supply = patterns.groupBy(*keys, "hour", "month").agg(F.sum("n").alias("n")).groupBy(*keys, "hour").agg(
        F.map_from_entries(F.collect_list(F.struct("month", "n"))).alias("_supply"))
    wanted = hours.withColumn("_month", F.month("first")).join(supply, [*keys, "hour"])
    month = F.col("_month")
    if wrap:
        around = F.array(F.pmod(month - 2, 12) + 1, month, F.pmod(month, 12) + 1)
    else:
        around = F.array(F.greatest(month - 1, F.lit(1)), month, F.least(month + 1, F.lit(12)))
    around = F.array_distinct(around)

    def rows(months):
        return F.aggregate(months, F.lit(0).cast("bigint"), lambda a, m: a + F.coalesce(F.try_element_at("_supply", m), F.lit(0)))

    months = (F.when(rows(F.array(month)) >= MIN_ROWS, F.array(month))
              .when(rows(around) >= MIN_ROWS, around).otherwise(F.map_keys("_supply")))
    wanted = wanted.withColumn("month", F.explode(months)).drop("_supply", "_month")
    pairs = wanted.join(patterns.select(
        *keys, "hour", "month", F.col("n").alias("_cn"), F.col("first").alias("_cfirst"),
        *[F.col(e).alias(f"_{e}") for e in env]), [*keys, "hour", "month"])
    pairs = pairs.filter(F.col("_cn") >= F.col("n") / 2)

    days = F.abs(F.floor((F.unix_seconds(F.col("_cfirst").cast("timestamp")) - F.unix_seconds(F.col("first").cast("timestamp"))) / 86400))
    near = F.least(F.lit(1.0), days / 365)
    weekdays = F.least(F.lit(1.0), F.abs(F.weekday("_cfirst") - F.weekday("first")) / 7)
    if env and context is not None:
        pairs = pairs.join(context, [*keys, "_gap"], "left")
        sides = [F.abs(F.col(f"_{e}") - F.col(f"_{e}_{s}")) for e in env for s in ("before", "after")]
        total = sum((F.coalesce(s, F.lit(0.0)) for s in sides[1:]), F.coalesce(sides[0], F.lit(0.0)))
        known = sum((s.isNotNull().cast("int") for s in sides[1:]), sides[0].isNotNull().cast("int"))
        score = F.when(known > 0, total / known + near + weekdays).otherwise(near + weekdays * 2)
    else:
        score = near + weekdays * 2
    pairs = pairs.withColumn("score", F.round(score, 9))
    best = Window.partitionBy(*keys, "_gap", "date", "hour").orderBy("score", "_cfirst")
    chosen = pairs.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= top).select(
        *keys, "_gap", "date", "hour", "nth", "score", "_cfirst")
    # Only the chosen hours carry their minutes.
    minutes = patterns.select(*keys, "hour", F.col("first").alias("_cfirst"), "minutes")
    return chosen.join(minutes, [*keys, "hour", "_cfirst"]).select(*keys, "_gap", "date", "hour", "nth", "score", "_cfirst", "minutes")


def rebase_trend(rows: DataFrame, keys=KEYS, threshold: float = 0.01) -> DataFrame:
    """Lay the fill of a gap on the line between its edges where that line is steep enough.

    Needs ``_gap, _i, _before, _after, value``; adds ``_n``, the rows of the gap.
    """
    group = [*keys, "_gap"]
    gaps = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.avg("value").alias("_mean"))
    slope = (F.col("_after") - F.col("_before")) / F.col("_n")
    based = F.col("_before") + slope * F.col("_i") + (F.col("value") - F.col("_mean"))
    return rows.join(lookup(gaps), group).withColumn(
        "value", F.when(F.abs(slope) > threshold, based).otherwise(F.col("value"))).drop("_mean")


def long_gap_values(df: DataFrame, c: str, how: str = "pattern", longer_than: str = "2 days", keys=KEYS, time: str = TIME,
                    env=(), context_rows: int = CONTEXT, top: int = 3, wrap: bool = False, chunk: str = CHUNK, order=None) -> DataFrame:
    """Values for the rows of long gaps: ``keys, _rn, value``.

    ``order`` are the columns that order rows of one time in ``_rn``, by default the measure alone.

    "pattern" averages the most similar hours per minute, weighted by 1 / (score + 0.1), rebases them
    on the trend across the gap and smooths; a gap filled with a constant for more than half its rows
    takes its seasonal profile instead. "seasonal" uses the profile throughout.
    """
    keys, env, group = list(keys), [e for e in env if e in df.columns], [*keys, "_gap"]
    # Both are read many times below.
    rows = stage(long_gap_rows(df, c, longer_than, keys, time, chunk, order))
    seasonal = smooth(seasonal_profile(rows, df, c, keys, time).filter("value IS NOT NULL"), "value", group, "_i")
    if how == "seasonal":
        return seasonal.select(*keys, "_rn", "value")
    if how != "pattern":
        raise ValueError(f"long gaps are filled by pattern or seasonal, not {how!r}")

    source = stage(fill_chain(df, env, keys, time, chunk) if env else df)
    dated = rows.withColumns({"date": F.to_date(time), "hour": F.hour(time)})
    hours = dated.groupBy(*group, "date", "hour").agg(F.count(F.lit(1)).alias("n"), F.min(time).alias("first"))
    context = None
    if env:
        starts = rows.groupBy(*group).agg(F.min(time).alias("_start"))
        context = gap_context(source, starts, c, env, keys, time, context_rows, chunk)
    chosen = similar_hours(hours, hour_patterns(source, c, env, keys, time), env, keys, context, top, wrap)
    packed = chosen.groupBy(*group, "date", "hour").agg(
        F.collect_list(F.struct((1 / (F.col("score") + 0.1)).alias("w"), "minutes")).alias("_patterns"))
    minute = F.minute(time)
    filled = dated.join(packed, [*group, "date", "hour"], "left")
    hits = F.filter(F.transform("_patterns", lambda p: F.struct(
        p["w"].alias("w"), F.try_element_at(p["minutes"], minute).alias("v"))), lambda h: h["v"].isNotNull())
    closest = F.transform("_patterns", lambda p: F.array_min(F.transform(
        F.map_entries(p["minutes"]), lambda e: F.struct(F.abs(e["key"] - minute).alias("d"), e["key"].alias("m"), e["value"].alias("v"))))["v"])
    add = lambda array, f: F.aggregate(array, F.lit(0.0), lambda a, x: a + f(x))
    filled = filled.withColumns({"_hits": hits, "_closest": closest})
    value = (F.when(F.size("_hits") > 0, add("_hits", lambda h: h["w"] * h["v"]) / add("_hits", lambda h: h["w"]))
             .when(F.size("_closest") > 0, add("_closest", lambda v: v) / F.size("_closest")))
    hour_means = seasonal_means(df, c, keys, time).groupBy(*keys, "hour").agg(F.max("hour_mean").alias("_hour"))
    filled = filled.join(lookup(hour_means), [*keys, "hour"], "left").withColumn("value", F.coalesce(value, "_hour", "_curve"))
    filled = filled.filter("value IS NOT NULL").select(*group, "_rn", "_i", "_before", "_after", "value")

    based = rebase_trend(filled, keys)
    smoothed = smooth(based.withColumn("_smooth", F.col("value")), "_smooth", group, "_i")
    smoothed = stage(smoothed.withColumn("value", F.when(F.col("_n") > 5, F.col("_smooth")).otherwise(F.col("value"))))
    constant = lookup(longest_constant_run(smoothed, "value", group, "_i").filter("share > 0.5").select(*group))
    kept = smoothed.join(constant, group, "left_anti").select(*keys, "_rn", "value")
    return kept.unionByName(seasonal.join(constant, group, "left_semi").select(*keys, "_rn", "value"))
