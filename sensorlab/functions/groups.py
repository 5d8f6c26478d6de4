"""Grouped statistics that stay exact and balanced however large one group is."""

from pyspark.sql import DataFrame, Window, functions as F, types as T

from sensorlab.session import stage


def lookup(small: DataFrame) -> DataFrame:
    """Make a grouped table's size known to the planner.

    It is computed once, written, and read back: Catalyst broadcasts it where its bytes are below
    ``autoBroadcastJoinThreshold`` and joins by shuffle beyond, where adaptive execution splits skewed keys.
    Nothing goes through the driver.
    """
    return stage(small)


def attach(df: DataFrame, stats: DataFrame, by=()) -> DataFrame:
    """Add per-group statistics to every row; without groups the single row becomes literals."""
    by = list(by)
    if not by:
        row = stats.first()
        return df.withColumns({f.name: F.lit(row[f.name]).cast(f.dataType) for f in stats.schema})
    return df.join(lookup(stats), by, "left")


#: Buckets that a pass of the quantiles cuts an interval into.
BUCKETS = 4096


def quantiles(df: DataFrame, cols, probs, by=(), buckets: int = BUCKETS) -> DataFrame:
    """Exact quantiles with linear interpolation: one row per group, measure and probability.

    ``percentile`` would buffer a whole group in one task. Here every wanted rank has an interval that holds it, at first
    the group's whole range. A pass counts the values of each interval in ``buckets`` equal parts, with the least and the
    largest value of each, and the part that holds the rank is the next interval, until only one value is left. Whatever
    a group's size, a pass shuffles a row for each part at most, and no values are put in order. Infinite values and NaN
    (larger than all others) have a part of their own.
    """
    by = list(by)
    group = [*by, "measure"]
    long = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("v")) for c in cols
    ])).alias("m")).select(*by, "m.measure", "m.v").filter("v IS NOT NULL")

    place = lambda p: F.lit(float(p)) * (F.col("n") - 1)
    ranks = F.array(*[
        F.struct(F.lit(float(p)).alias("prob"), F.lit(side).alias("side"), way(place(p)).cast("long").alias("rank"))
        for p in dict.fromkeys(probs) for side, way in ((0, F.floor), (1, F.ceil))])
    ends = long.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    state = lookup(ends.select(*group, "n", F.lit(0).cast("long").alias("below"), "lo", "hi", F.inline(ranks)))
    lo, hi, v = F.col("lo"), F.col("hi"), F.col("v")
    odd = F.isnan(hi) | (F.abs(lo) == float("inf")) | (F.abs(hi) == float("inf"))
    share = (v / 2 - lo / 2) / (hi / 2 - lo / 2)
    part = F.when(odd, F.when(v == lo, 0).when(v == hi, buckets - 1).otherwise(1)).otherwise(
        F.least(F.floor(share * buckets), F.lit(buckets - 1))).cast("int")
    upto = F.sum("c").over(Window.partitionBy(*group, "below").orderBy("part"))
    while True:
        intervals = lookup(state.filter(lo < hi).select(*group, "below", "lo", "hi").distinct())
        if intervals.isEmpty():
            break
        counted = (
            long.join(intervals, group).filter((v >= lo) & (v <= hi)).withColumn("part", part)
            .groupBy(*group, "below", "part").agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))
            .withColumn("upto", F.col("below") + upto))
        now = F.col("rank")
        holds = (F.col("upto") - F.col("c") <= now) & (now < F.col("upto"))
        names = [*group, "n", "prob", "side", "rank"]
        found = state.filter(lo < hi).drop("lo", "hi").join(counted, [*group, "below"]).filter(holds).select(
            *names, (F.col("upto") - F.col("c")).alias("below"), F.col("least").alias("lo"), F.col("most").alias("hi"))
        state = lookup(state.filter(~(lo < hi)).select(*found.columns).unionByName(found))

    found = state.groupBy(*group, "prob", "n").agg(
        F.max(F.when(F.col("side") == 0, lo)).alias("v0"), F.max(F.when(F.col("side") == 1, lo)).alias("v1"))
    position = F.col("prob") * (F.col("n") - 1)
    step = F.when(F.col("v0") == F.col("v1"), F.lit(0.0)).otherwise((F.col("v1") - F.col("v0")) * (position - F.floor(position)))
    return found.select(*group, "prob", "n", (F.col("v0") + step).alias("value"))


def quantile_columns(df: DataFrame, cols, probs: dict, by=(), buckets: int = BUCKETS) -> DataFrame:
    """Exact quantiles as columns ``{measure}_{name}``; ``probs`` maps names to probabilities."""
    long = quantiles(df, cols, list(probs.values()), by, buckets)
    return long.groupBy(*by).agg(*[
        F.max(F.when((F.col("measure") == c) & (F.col("prob") == F.lit(float(p))), F.col("value"))).alias(f"{c}_{name}")
        for c in cols for name, p in probs.items()
    ])


def running_totals(df: DataFrame, order: str, totals: dict, by=(), ascending: bool = True, splits: int = 256) -> DataFrame:
    """Inclusive running sums over the global order of ``order`` within ``by``.

    ``totals`` maps output names to columns. Rows sharing an ``order`` value must have been added
    up before. Ranges cut at hash-drawn values keep the running window parallel; the draw only
    decides where the ranges end, never the result.
    """
    by = list(by)
    drawn = df.select(F.col(order).alias("s")).distinct().orderBy(F.xxhash64("s"), "s").limit(splits)
    cuts = sorted(r["s"] for r in drawn.collect() if r["s"] is not None)
    span = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda s: s <= F.col(order))) if cuts else F.lit(0)
    base = df.withColumn("_span", span)
    direction = (lambda c: F.col(c).asc()) if ascending else (lambda c: F.col(c).desc())
    within = Window.partitionBy(*by, "_span").orderBy(direction(order))
    across = Window.partitionBy(*by).orderBy(direction("_span")).rowsBetween(Window.unboundedPreceding, -1)
    spans = base.groupBy(*by, "_span").agg(*[F.sum(c).alias(f"_{n}") for n, c in totals.items()])
    spans = spans.select(*by, "_span", *[F.coalesce(F.sum(f"_{n}").over(across), F.lit(0)).alias(f"_{n}") for n in totals])
    local = base.withColumns({n: F.sum(c).over(within) for n, c in totals.items()})
    return local.join(spans, [*by, "_span"]).withColumns(
        {n: F.col(n) + F.col(f"_{n}") for n in totals}).drop("_span", *[f"_{n}" for n in totals])


#: Rows of a group that meet its model in one task, about.
PIECE_ROWS = 100_000


def with_models(df: DataFrame, models: DataFrame, by, key, function, added: str, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``function(rows, model)`` on Arrow tables, for every group cut into pieces of about ``piece_rows`` rows by their key.

    ``models`` has one row a group (none: an empty table); each piece gets a copy. The result is the rows with the columns
    ``added``. A null in ``by`` is a group of its own.
    """
    # Nulls meet as text; the type's own null stays in the rows.
    parts = [F.coalesce(F.concat(F.lit("="), F.col(b).cast("string")), F.lit("null")) for b in by]
    name = F.to_json(F.array(*parts)) if parts else F.lit("")
    rows, given = df.withColumn("_of", name), models.withColumn("_of", name).drop(*by)
    sizes = lookup(rows.groupBy("_of").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(piece_rows))).cast("int").alias("_pieces")))
    salted = rows.join(sizes, "_of").withColumn("_piece", F.pmod(F.xxhash64(key), F.col("_pieces")).cast("int")).drop("_pieces")
    copies = given.join(sizes, "_of").withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))).drop("_pieces")
    group = ["_of", "_piece"]
    out = T.StructType([*df.schema.fields, *T.StructType.fromDDL(added).fields])

    def run(left, right):
        return function(left.drop_columns(group), right)

    return salted.groupBy(*group).cogroup(copies.groupBy(*group)).applyInArrow(run, out)


def category_codes(df: DataFrame, col: str, code: str = None) -> DataFrame:
    """Replace a column by the position of its value among the sorted distinct values; null is -1."""
    code = code or f"{col}_code"
    values = df.select(col).filter(F.col(col).isNotNull()).distinct().withColumn("one", F.lit(1))
    codes = running_totals(values, col, {code: "one"}).select(col, (F.col(code) - 1).cast("int").alias(code))
    return df.join(codes, col, "left").withColumn(code, F.coalesce(code, F.lit(-1)))


def most_frequent(df: DataFrame, cols) -> DataFrame:
    """The mode of each column, the smallest value on ties, as one row."""
    out = None
    for c in cols:
        counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
        best = counts.orderBy(F.desc("n"), F.col(c)).limit(1).select(F.lit(c).alias("column"), F.col(c).cast("string").alias("mode"))
        out = best if out is None else out.unionByName(best)
    return out


def fill_mode(df: DataFrame, cols) -> DataFrame:
    modes = {r["column"]: r["mode"] for r in most_frequent(df, cols).collect()}
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(modes[c]).cast(df.schema[c].dataType)) for c in cols if c in modes
    })


def distinct_values(df: DataFrame, col: str) -> list:
    """The distinct values of a column that is to become one column per value."""
    return sorted(r[0] for r in df.select(col).filter(F.col(col).isNotNull()).distinct().collect())


def one_hot(df: DataFrame, col: str, values=None) -> DataFrame:
    """0/1 column per value. Without ``values`` the distinct ones are fetched, as the schema needs them."""
    values = distinct_values(df, col) if values is None else values
    flags = {f"{col}_{v}": F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0)) for v in sorted(values)}
    return df.withColumns(flags).drop(col)


def standardise(df: DataFrame, cols, by=(), stats: DataFrame = None) -> DataFrame:
    """(x - mean) / population deviation; a zero deviation counts as one."""
    stats = scale_stats(df, cols, by) if stats is None else stats
    named = attach(df, stats, by)
    return named.withColumns({
        c: (F.col(c) - F.col(f"_{c}_mean")) / F.col(f"_{c}_std") for c in cols
    }).drop(*[f"_{c}_{s}" for c in cols for s in ("mean", "std")])


def scale_stats(df: DataFrame, cols, by=()) -> DataFrame:
    agg = []
    for c in cols:
        agg.append(F.avg(c).alias(f"_{c}_mean"))
        deviation = F.stddev_pop(c)
        agg.append(F.when(deviation > 0, deviation).otherwise(1.0).alias(f"_{c}_std"))
    return df.groupBy(*by).agg(*agg)
