"""Ordered operators over keyed series, cut into time chunks.

A plain window over the series keys puts a whole series in one task. Every operator here windows
over ``(keys, chunk)`` instead, where a chunk is a fixed span of time, and carries what crosses a
chunk border through a table with one row per chunk. The answer is the same as that of the plain
window; ``CHUNK`` only sets how finely one long series is spread over the cluster.

Windows that look forward are written as backward windows over the descending order, because a
frame ending at UNBOUNDED FOLLOWING is evaluated anew for every row.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorlab.functions.calendar import floor_div, floor_time, from_micros, micros, span_micros
from sensorlab.functions.missing import is_missing, is_valid
from sensorlab.schema import KEYS, MEASURES, SENTINEL, TIME

CHUNK = "7 days"
BLOCK = 10_000


def with_chunk(df: DataFrame, time: str = TIME, chunk: str = CHUNK) -> DataFrame:
    return df.withColumn("_chunk", floor_div(micros(time), span_micros(chunk)))


def neighbours(df: DataFrame, cols=MEASURES, keys=KEYS, time: str = TIME, chunk: str = CHUNK, order=None,
               detail: bool = True, sides: str = "pn") -> DataFrame:
    """For every row its position in the series and the valid values around it, per column.

    Adds ``_rn``, ``_first`` and ``_last`` (first and last time of the series, in microseconds) and, per
    column c, ``_c_p`` (nearest valid row at or before) and ``_c_n`` (at or after): structs of
    ``ts, rn, v``, the next valid row outward ``ts2, v2`` and ``edge``, the time of the series row
    adjoining it on the side of the gap. Without ``detail`` the structs hold ``ts, rn, v`` only.
    Null is missing. ``sides`` limits the work to one side ("p" or "n").

    A first pass finds the outermost valid rows of each chunk, one row per chunk. The second pass
    windows over the chunks again with two extra rows, one at each end, that stand for everything
    before and after the chunk.
    """
    keys, cols = list(keys), list(cols)
    order = list(order or cols)
    group = [*keys, "_chunk"]
    base = with_chunk(df, time, chunk).withColumns({"_ts": micros(time), "_side": F.lit(0)})
    ends = _chunk_ends(base, cols, keys, group, order, detail)
    heads = ends.select(
        *group, F.lit(-1).alias("_side"), F.col("_prev_to").alias("_ts"), "_offset", "_first", "_last",
        *[F.col(f"_{c}_before").alias(f"_{c}_end") for c in cols])
    tails = ends.select(
        *group, F.lit(1).alias("_side"), F.col("_next_from").alias("_ts"),
        *[F.col(f"_{c}_after").alias(f"_{c}_end") for c in cols])
    rows = base.unionByName(heads, True).unionByName(tails, True)
    up = Window.partitionBy(*group).orderBy("_side", "_ts", *order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({n: F.max(n).over(up) for n in ("_offset", "_first", "_last")})
    near = _near_in_chunk(rows, cols, group, order, detail, sides).filter("_side = 0")
    return near.drop("_chunk", "_side", "_offset", *[f"_{c}_end" for c in cols])


def _near_in_chunk(rows: DataFrame, cols, group, order, detail: bool, sides: str) -> DataFrame:
    """Position and nearest valid rows within ``(keys, _chunk)``, all upward windows before all downward ones."""
    up = Window.partitionBy(*group).orderBy("_side", "_ts", *order)
    down = Window.partitionBy(*group).orderBy(F.desc("_side"), F.desc("_ts"), *[F.desc(c) for c in order])
    start = Window.unboundedPreceding
    number = F.sum(F.when(F.col("_side") == 0, 1).otherwise(0)).over(up.rowsBetween(start, 0))
    out = rows.withColumn("_rn", number + F.col("_offset"))

    def bare(c):
        own = F.when(F.col(c).isNotNull(), F.struct(F.col("_ts").alias("ts"), F.col(c).alias("v")))
        return F.coalesce(own, F.when(F.col(f"_{c}_end").isNotNull(), F.struct(f"_{c}_end.ts", f"_{c}_end.v")))

    def point(c, edge):
        more = [F.col(f"_{c}_2.ts").alias("ts2"), F.col(f"_{c}_2.v").alias("v2"), F.col(edge).alias("edge")]
        return F.coalesce(F.when(F.col(c).isNotNull(), F.struct(
            F.col("_ts").alias("ts"), F.col("_rn").alias("rn"), F.col(c).alias("v"), *(more if detail else []))), F.col(f"_{c}_end"))

    if detail:
        out = out.withColumns({"_above": F.lead("_ts").over(up), "_below": F.lag("_ts").over(up)})
    for side, order_by, edge in (("p", up, "_above"), ("n", down, "_below")):
        if side not in sides:
            continue
        if detail:
            out = out.withColumns({f"_{c}_2": F.last(bare(c), True).over(order_by.rowsBetween(start, -1)) for c in cols})
        out = out.withColumns({f"_{c}_{side}": F.last(point(c, edge), True).over(order_by.rowsBetween(start, 0)) for c in cols})
    return out.drop("_above", "_below", *[f"_{c}_2" for c in cols])


def _chunk_ends(base: DataFrame, cols, keys, group, order, detail: bool) -> DataFrame:
    """One row per chunk: rows before it, its adjoining times, and the valid rows nearest to it outside.

    Needs one sort: the outermost valid rows of a chunk are aggregates over numbered rows.
    """
    up = Window.partitionBy(*group).orderBy("_ts", *order)
    start = Window.unboundedPreceding
    rows = base.withColumn("_rn", F.row_number().over(up).cast("bigint"))
    if detail:
        rows = rows.withColumns({
            "_above": F.lead("_ts").over(up), "_below": F.lag("_ts").over(up),
            **{f"_{c}_2": F.last(F.when(F.col(c).isNotNull(), F.struct(F.col("_ts").alias("ts"), F.col(c).alias("v"))), True).over(
                up.rowsBetween(start, -1)) for c in cols},
            **{f"_{c}_k": F.count(c).over(up.rowsBetween(start, 0)) for c in cols}})
    agg = [F.count(F.lit(1)).alias("_rows"), F.min("_ts").alias("_from"), F.max("_ts").alias("_to")]
    for c in cols:
        here = [F.col("_rn").alias("rn"), F.col("_ts").alias("ts"), F.col(c).alias("v")]
        valid = F.col(c).isNotNull()
        more = [F.col(f"_{c}_2.ts").alias("ts2"), F.col(f"_{c}_2.v").alias("v2"), F.col("_above").alias("edge")] if detail else []
        agg.append(F.max(F.when(valid, F.struct(*here, *more))).alias(f"_{c}_last"))
        more = [F.col("_below").alias("edge")] if detail else []
        agg.append(F.min(F.when(valid, F.struct(*here, *more))).alias(f"_{c}_head"))
        if detail:
            agg.append(F.max(F.when(valid & (F.col(f"_{c}_k") == 2), F.struct(F.col("_ts").alias("ts"), F.col(c).alias("v")))).alias(f"_{c}_second"))
    out = rows.groupBy(*group).agg(*agg)
    up = Window.partitionBy(*keys).orderBy("_chunk")
    down = Window.partitionBy(*keys).orderBy(F.desc("_chunk"))
    series = Window.partitionBy(*keys)
    out = out.withColumns({
        "_offset": F.coalesce(F.sum("_rows").over(up.rowsBetween(start, -1)), F.lit(0)),
        "_next_from": F.lead("_from").over(up),
        "_prev_to": F.lag("_to").over(up),
        "_first": F.min("_from").over(series),
        "_last": F.max("_to").over(series),
    })
    for side, outward, edge, name in (("last", up, "_next_from", "before"), ("head", down, "_prev_to", "after")):
        strict = outward.rowsBetween(start, -1)

        def full(c):
            own, far = F.col(f"_{c}_{side}"), F.col(f"_{c}_far")
            if side == "last":
                ts2, v2 = own["ts2"] if detail else None, own["v2"] if detail else None
            else:
                ts2, v2 = F.col(f"_{c}_second.ts"), F.col(f"_{c}_second.v")
            more = [
                F.coalesce(ts2, far["ts"]).alias("ts2"),
                F.when(ts2.isNotNull(), v2).otherwise(far["v"]).alias("v2"),
                F.coalesce(own["edge"], F.col(edge)).alias("edge"),
            ] if detail else []
            return F.when(own.isNotNull(), F.struct(
                own["ts"].alias("ts"), (own["rn"] + F.col("_offset")).alias("rn"), own["v"].alias("v"), *more))

        if detail:
            out = out.withColumns({f"_{c}_far": F.last(f"_{c}_{side}", True).over(strict) for c in cols})
        out = out.withColumns({f"_{c}_{side}": full(c) for c in cols})
        out = out.withColumns({f"_{c}_{name}": F.last(f"_{c}_{side}", True).over(strict) for c in cols})
    return out


def drop_neighbours(df: DataFrame, cols=MEASURES) -> DataFrame:
    return df.drop("_rn", "_ts", "_first", "_last", *[f"_{c}_{s}" for c in cols for s in ("p", "n")])


# --- fill expressions over the columns of neighbours() -----------------------------------------

def locf(c: str) -> Column:
    return F.coalesce(F.col(c), F.col(f"_{c}_p.v"))


def nocb(c: str) -> Column:
    return F.coalesce(F.col(c), F.col(f"_{c}_n.v"))


def linear(c: str, axis: str = "rn", limit: int = None, both: bool = False) -> Column:
    """Straight line between the neighbours by row position (``rn``) or time (``ts``).

    Forward: a leading gap stays null and a trailing one takes the last value. ``both`` also fills
    the leading gap with the first value. ``limit`` fills that many rows next to a valid one.
    """
    p, n = F.col(f"_{c}_p"), F.col(f"_{c}_n")
    here = F.col("_rn") if axis == "rn" else F.col("_ts")
    line = p["v"] + (n["v"] - p["v"]) * ((here - p[axis]) / (n[axis] - p[axis]))
    value = F.when(p.isNotNull() & n.isNotNull(), line).when(p.isNotNull(), p["v"])
    if both:
        value = value.when(n.isNotNull(), n["v"])
    if limit is not None:
        near = F.coalesce(F.col("_rn") - p["rn"] <= limit, F.lit(False))
        if both:
            near = near | F.coalesce(n["rn"] - F.col("_rn") <= limit, F.lit(False))
        value = F.when(near, value)
    return F.when(F.col(c).isNotNull(), F.col(c)).otherwise(value)


def hermite(c: str) -> Column:
    """Cubic through the neighbours with tangents from the second valid point on each side.

    Falls back to the time-weighted line where a second point is absent.
    """
    p, n = F.col(f"_{c}_p"), F.col(f"_{c}_n")
    h = (n["ts"] - p["ts"]).cast("double")
    s = (F.col("_ts") - p["ts"]) / h
    m0 = (n["v"] - p["v2"]) / (n["ts"] - p["ts2"]) * h
    m1 = (n["v2"] - p["v"]) / (n["ts2"] - p["ts"]) * h
    s2, s3 = s * s, s * s * s
    curve = ((2 * s3 - 3 * s2 + 1) * p["v"] + (s3 - 2 * s2 + s) * m0
             + (3 * s2 - 2 * s3) * n["v"] + (s3 - s2) * m1)
    four = p["ts2"].isNotNull() & n["ts2"].isNotNull()
    return F.when(F.col(c).isNotNull(), F.col(c)).when(four, curve).otherwise(linear(c, "ts"))


def gap_start(c: str) -> Column:
    """First missing time (microseconds) of the gap a row lies in."""
    return F.when(F.col(c).isNull(), F.when(F.col(f"_{c}_p").isNull(), F.col("_first")).otherwise(F.col(f"_{c}_p.edge")))


def gap_end(c: str) -> Column:
    return F.when(F.col(c).isNull(), F.when(F.col(f"_{c}_n").isNull(), F.col("_last")).otherwise(F.col(f"_{c}_n.edge")))


def fill(df: DataFrame, how, cols=MEASURES, keys=KEYS, time: str = TIME, chunk: str = CHUNK, detail: bool = False,
         sides: str = "pn") -> DataFrame:
    """Replace each column by ``how(column)`` evaluated over its neighbours (``hermite`` needs ``detail``)."""
    near = neighbours(df, cols, keys, time, chunk, detail=detail, sides=sides)
    return drop_neighbours(near.withColumns({c: how(c) for c in cols}), cols).select(*df.columns)


def fill_chain(df: DataFrame, cols, keys=KEYS, time: str = TIME, chunk: str = CHUNK, interpolate: bool = True) -> DataFrame:
    """Linear (or the last value), then next value, then zero.

    A series that has any valid value is complete after the first two; one without has no mean or
    median either, so zero is what is left for it.
    """
    first = (lambda c: linear(c, both=True)) if interpolate else (lambda c: F.coalesce(locf(c), nocb(c)))
    return fill(df, lambda c: F.coalesce(first(c), F.lit(0.0)), list(cols), keys, time, chunk)


def running_count(df: DataFrame, flagged: Column, out: str, keys=KEYS, time: str = TIME, chunk: str = CHUNK, order=()) -> DataFrame:
    """Adds the number of flagged rows of the series up to and including each row."""
    keys, group = list(keys), [*keys, "_chunk"]
    base = with_chunk(df, time, chunk).withColumn("_one", flagged.cast("bigint"))
    across = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = base.groupBy(*group).agg(F.sum("_one").alias("_s")).select(
        *group, F.coalesce(F.sum("_s").over(across), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(*group).orderBy(time, *order).rowsBetween(Window.unboundedPreceding, 0)
    return base.withColumn(out, F.sum("_one").over(within)).join(chunks, group, "left").withColumn(
        out, F.col(out) + F.col("_offset")).drop("_chunk", "_one", "_offset")


# --- row-frame windows ------------------------------------------------------------------------

def with_row_halo(df: DataFrame, rows: int, keys=KEYS, time: str = TIME, chunk: str = CHUNK, order=MEASURES) -> DataFrame:
    """Add to every chunk copies of the ``rows`` rows before it, marked ``_halo = 1``.

    A window over ``(keys, _chunk)`` then sees the frame a window over the whole series would see.
    Use ``row_window`` for it and drop the copies afterwards.
    """
    keys, group = list(keys), [*keys, "_chunk"]
    base = with_chunk(df, time, chunk)
    across = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = base.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_start", F.coalesce(F.sum("_n").over(across), F.lit(0)))
    back = Window.partitionBy(*group).orderBy(F.col(time).desc(), *[F.col(c).desc() for c in order])
    tail = (
        base.withColumn("_r", F.row_number().over(back)).filter(F.col("_r") <= rows)
        .join(chunks, group).withColumn("_rn", F.col("_start") + F.col("_n") - F.col("_r") + 1)
        .drop("_chunk", "_r", "_n", "_start")
    )
    wanted = chunks.filter("_start > 0").select(
        *group, F.explode(F.sequence(F.greatest(F.col("_start") - rows + 1, F.lit(1)), F.col("_start"))).alias("_rn"))
    halo = tail.join(wanted, [*keys, "_rn"]).drop("_rn").withColumn("_halo", F.lit(1))
    return base.withColumn("_halo", F.lit(0)).unionByName(halo)


def row_window(keys=KEYS, time: str = TIME, order=MEASURES):
    return Window.partitionBy(*keys, "_chunk").orderBy(F.col(time), *[F.col(c).asc() for c in order])


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter("_halo = 0").drop("_halo", "_chunk")


def rolling_features(df: DataFrame, cols=MEASURES, rows: int = 24, keys=KEYS, time: str = TIME,
                     chunk: str = CHUNK, within: Column = None) -> DataFrame:
    """Per column: rolling mean, rolling sample deviation (null is 0), difference from the previous row.

    ``within`` names a period; ``{prefix}_step`` is then the absolute change inside the period.
    Output names start with the first four letters of the column.
    """
    haloed = with_row_halo(df, rows - 1, keys, time, chunk, cols)
    order = row_window(keys, time, cols)
    frame = order.rowsBetween(-(rows - 1), 0)
    out = haloed if within is None else haloed.withColumn("_period", within)
    columns = {}
    for c in cols:
        p = c[:4]
        columns[f"{p}_rolling_mean"] = F.avg(c).over(frame)
        columns[f"{p}_rolling_std"] = F.coalesce(F.stddev_samp(c).over(frame), F.lit(0.0))
        columns[f"{p}_diff"] = F.coalesce(F.col(c) - F.lag(c).over(order), F.lit(0.0))
        if within is not None:
            columns[f"{p}_step"] = F.when(F.lag("_period").over(order) == F.col("_period"), F.abs(F.col(c) - F.lag(c).over(order)))
    return drop_halo(out.withColumns(columns)).drop("_period")


def by_position(df: DataFrame, group, position: str, before: int, after: int, columns, block: int = BLOCK) -> DataFrame:
    """Evaluate row-frame expressions over rows numbered ``position`` within ``group``.

    ``columns`` maps names to functions of a window. Rows are cut into blocks of positions, with the
    rows of the frame copied across block borders.
    """
    group = list(group)
    pos = F.col(position)
    homes = [floor_div(pos + s, block) for s in (-after, 0, before)]
    spread = df.withColumn("_home", floor_div(pos, block)).withColumn("_block", F.explode(F.array_distinct(F.array(*homes))))
    order = Window.partitionBy(*group, "_block").orderBy(position)
    return spread.withColumns({n: f(order) for n, f in columns.items()}).filter("_home = _block").drop("_home", "_block")


def smooth(df: DataFrame, col: str, group, position: str, rows: int = 5) -> DataFrame:
    """Centred rolling mean within a group, as many rows as there are at its ends."""
    half = rows // 2
    return by_position(df, group, position, half, half, {
        col: lambda w: F.avg(col).over(w.rowsBetween(-half, half))})


# --- interval-windowed fill -------------------------------------------------------------------

def fill_windowed(df: DataFrame, cols=MEASURES, interval: str = "15 minutes", window: int = 4, keys=KEYS,
                  time: str = TIME, chunk: str = CHUNK) -> DataFrame:
    """Fill the intervals that miss a value from the valid rows ``window`` intervals around them.

    Linear by row position, flat beyond the outermost valid row; -1 where the window holds no valid
    row. In a touched interval rows sharing a time get their average.
    """
    keys, width = list(keys), span_micros(interval)
    reach, long = width * window, span_micros(chunk)
    # A whole number of intervals, so that no interval straddles two chunks.
    span = -(-max(long, 2 * (reach + width)) // width) * width
    order = [F.col("_ts"), *[F.col(c).asc() for c in cols]]
    base = df.withColumns({c: F.when(is_valid(c), F.col(c)) for c in cols}).withColumn("_ts", micros(time))
    homes = F.array(*[floor_div(F.col("_ts") + s, span) for s in (-(reach + width), 0, reach + width)])
    spread = base.withColumn("_home", floor_div(F.col("_ts"), span)).withColumn("_chunk", F.explode(F.array_distinct(homes)))
    group = [*keys, "_chunk"]
    up = Window.partitionBy(*group).orderBy(*order)
    down = Window.partitionBy(*group).orderBy(*[F.col("_ts").desc(), *[F.col(c).desc() for c in cols]])

    def point(c):
        return F.when(F.col(c).isNotNull(), F.struct(F.col("_ts").alias("ts"), F.col("_r").alias("rn"), F.col(c).alias("v")))

    near = spread.withColumn("_r", F.row_number().over(up))
    near = near.withColumns({f"_{c}_p": F.last(point(c), True).over(up.rowsBetween(Window.unboundedPreceding, 0)) for c in cols})
    near = near.withColumns({f"_{c}_n": F.last(point(c), True).over(down.rowsBetween(Window.unboundedPreceding, 0)) for c in cols})
    near = near.filter("_home = _chunk").withColumn("_slot", F.col("_ts") - F.pmod(F.col("_ts"), F.lit(width)))

    def value(c):
        low, high = F.col("_slot") - reach, F.col("_slot") + width + reach
        p = F.when(F.col(f"_{c}_p.ts") >= low, F.col(f"_{c}_p"))
        n = F.when(F.col(f"_{c}_n.ts") < high, F.col(f"_{c}_n"))
        line = p["v"] + (n["v"] - p["v"]) * ((F.col("_r") - p["rn"]) / (n["rn"] - p["rn"]))
        return F.coalesce(F.col(c), line, p["v"], n["v"])

    slot = Window.partitionBy(*group, "_slot")
    moment = Window.partitionBy(*group, "_slot", "_ts")
    near = near.withColumns({f"_{c}_v": value(c) for c in cols})
    near = near.withColumns({f"_{c}_t": F.max(F.col(c).isNull()).over(slot) for c in cols})
    near = near.withColumns({
        c: F.coalesce(F.when(F.col(f"_{c}_t"), F.avg(f"_{c}_v").over(moment)).otherwise(F.col(c)), F.lit(SENTINEL))
        for c in cols
    })
    return near.select(*df.columns)


# --- regular grids ----------------------------------------------------------------------------

def explode_steps(df: DataFrame, start: str, stop: str, step: int, out: str, block: int = 4096) -> DataFrame:
    """One row per ``start, start + step, ... <= stop`` (microseconds); no rows when stop < start.

    Long spans are exploded in two levels so that no array holds more than ``block`` entries or blocks.
    """
    count = floor_div(F.col(stop) - F.col(start), step)
    blocks = df.withColumn("_count", count).filter("_count >= 0").withColumn(
        "_b", F.explode(F.sequence(F.lit(0).cast("bigint"), floor_div(F.col("_count"), block))))
    first = F.col("_b") * block
    return blocks.withColumn("_i", F.explode(F.sequence(first, F.least(F.col("_count"), first + block - 1)))).withColumn(
        out, F.col(start) + F.col("_i") * step).drop("_count", "_b", "_i")


def with_next_time(df: DataFrame, keys=KEYS, time: str = TIME, chunk: str = CHUNK, order=()) -> DataFrame:
    """Adds ``_ts``, ``_next`` (time of the next row) and ``_first`` (first time of the series)."""
    keys, group = list(keys), [*keys, "_chunk"]
    base = with_chunk(df, time, chunk).withColumn("_ts", micros(time))
    if not keys:
        base, keys, group = base.withColumn("_all", F.lit(0)), ["_all"], ["_all", "_chunk"]
    up = Window.partitionBy(*keys).orderBy("_chunk")
    chunks = base.groupBy(*group).agg(F.min("_ts").alias("_from")).select(
        *group, F.lead("_from").over(up).alias("_ahead"), F.min("_from").over(Window.partitionBy(*keys)).alias("_first"))
    local = base.withColumn("_next", F.lead("_ts").over(Window.partitionBy(*group).orderBy("_ts", *order)))
    return local.join(chunks, group, "left").withColumn("_next", F.coalesce("_next", "_ahead")).drop("_ahead", "_chunk", "_all")


def densify(df: DataFrame, step: str = "1 minute", cols=MEASURES, keys=KEYS, time: str = TIME, chunk: str = CHUNK,
            snap: bool = False, sentinel: float = SENTINEL) -> DataFrame:
    """Every grid point from a series' first to its last reading; absent and null values become -1.

    The grid starts at the first reading of the series; readings off it are dropped, or with
    ``snap`` moved down to it. Readings sharing a time are all kept. ``sentinel=None`` leaves nulls.
    """
    keys, width = list(keys), span_micros(step)
    near = with_next_time(df, keys, time, chunk, cols)
    if snap:
        moved = from_micros(F.col("_ts") - F.pmod(F.col("_ts") - F.col("_first"), F.lit(width)))
        near = with_next_time(near.withColumn(time, moved).select(*df.columns), keys, time, chunk, cols)
    phase = F.pmod(F.col("_ts") - F.col("_first"), F.lit(width))
    ahead = F.pmod(F.col("_next") - F.col("_first"), F.lit(width))
    on = phase == 0
    near = near.withColumns({
        "_start": F.when(on, F.col("_ts")).otherwise(F.col("_ts") - phase + width),
        "_before_next": F.col("_next") - F.when(ahead == 0, F.lit(width)).otherwise(ahead),
    }).withColumn("_stop", F.greatest(F.when(on, F.col("_ts")), F.col("_before_next"))).filter("_stop IS NOT NULL")
    grid = explode_steps(near, "_start", "_stop", width, "_g")
    real = F.col("_g") == F.col("_ts")
    out = grid.withColumn(time, from_micros("_g"))
    rest = [c for c in df.columns if c not in (*keys, time)]
    out = out.withColumns({c: F.when(real, F.col(c)) for c in rest})
    if sentinel is not None:
        out = out.na.fill(sentinel, list(cols))
    return out.select(*df.columns)


def upsample(df: DataFrame, step: str = "1 minute", keys=(), time: str = TIME, chunk: str = CHUNK) -> DataFrame:
    """Finer regular grid holding the last row at or before each point.

    The grid is aligned to the clock, so a first row off it leaves the first point null.
    """
    keys, width = list(keys), span_micros(step)
    near = with_next_time(df, keys, time, chunk)
    up = F.col("_ts") + F.pmod(-F.col("_ts"), F.lit(width))
    down = F.col("_ts") - F.pmod(F.col("_ts"), F.lit(width))
    near = near.withColumns({
        "_start": up,
        "_stop": F.when(F.col("_next").isNull(), down).otherwise(
            F.col("_next") + F.pmod(-F.col("_next"), F.lit(width)) - width),
    })
    grid = explode_steps(near, "_start", "_stop", width, "_g").withColumn(time, from_micros("_g")).select(*df.columns)
    rest = [c for c in df.columns if c not in (*keys, time)]
    head = near.filter((F.col("_ts") == F.col("_first")) & (up != F.col("_ts"))).select(
        *keys, from_micros(down).alias(time)).distinct()
    return grid.unionByName(head.select(*keys, time, *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in rest]))
