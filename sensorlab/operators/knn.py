"""Nearest-neighbour searches that form no group of all pairs."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from sensorlab.functions.calendar import floor_div
from sensorlab.functions.groups import attach, lookup, running_totals

PIVOTS = 32
#: Reference rows of a pack of cells and of a block, and targets of a block, about; distances that are held at a time.
REF_BLOCK = 32768
TARGET_BLOCK = 16384
HELD = 1 << 22
DIGITS = 9


def knn_join(targets: DataFrame, refs: DataFrame, features, k: int, target_id, order: str, payload=(), by=()) -> DataFrame:
    """The ``k`` nearest reference rows of every target row, Euclidean, within ``by``. Exact.

    Reference rows are put into the cell of their nearest pivot. From the radius and size of the
    cells each target gets an upper bound on its k-th distance, and only cells that can hold a closer
    row are visited. A visited cell meets its targets in blocks of bounded size, each block keeping k
    rows per target; the blocks' rows are then merged. Equal distances (to 9 digits of the square)
    are ordered by ``order``. Returns ``by, target_id, distance, nth, order, payload``.
    """
    by, target_id, features, payload = list(by), list(target_id), list(features), list(payload)
    if not by:
        one = F.lit(1)
        return knn_join(targets.withColumn("_all", one), refs.withColumn("_all", one), features, k, target_id, order,
                        payload, ["_all"]).drop("_all")
    point = F.array(*[F.col(f).cast("double") for f in features])
    refs = refs.select(*by, order, *payload, point.alias("_x"))
    targets = targets.select(*by, *target_id, point.alias("_x"))
    # A fixed number of pivots; they steer the pruning only.
    drawn = refs.select("_x").distinct().orderBy(F.xxhash64("_x"), F.col("_x")).limit(PIVOTS).collect()
    pivots = np.array([r["_x"] for r in drawn], dtype=float).reshape(len(drawn), len(features))

    @pandas_udf("array<double>")
    def to_pivots(x: pd.Series) -> pd.Series:
        points = np.stack(x.to_numpy()) if len(x) else np.empty((0, len(features)))
        return pd.Series(list(np.sqrt(((points[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2))))

    refs = refs.withColumn("_d", to_pivots("_x")).withColumn("_near", F.array_min("_d"))
    refs = refs.withColumn("_cell", F.array_position("_d", F.col("_near")).cast("int")).drop("_d")
    cells = refs.groupBy(*by, "_cell").agg(F.count(F.lit(1)).alias("n"), F.max("_near").alias("radius"))
    upto = F.sum("n").over(Window.partitionBy(*by).orderBy("_cell"))
    cells = cells.withColumn("pack", F.floor((upto - F.col("n")) / REF_BLOCK))
    cells = cells.withColumn("parts", F.ceil(F.sum("n").over(Window.partitionBy(*by, "pack")) / REF_BLOCK))
    layout = cells.groupBy(*by).agg(F.collect_list(F.struct("_cell", "n", "radius", "pack", "parts")).alias("_cells"))
    sizes = targets.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / TARGET_BLOCK).alias("_tn"))
    layout = lookup(layout.join(sizes, by))

    found = targets.join(layout, by, "left")
    found = found.filter("_cells IS NOT NULL").withColumn("_d", to_pivots("_x"))
    reach = F.array_sort(F.transform("_cells", lambda c: F.struct(
        (F.element_at("_d", c["_cell"]) + c["radius"]).alias("u"), c["n"].alias("n"))))
    # The distance within which the nearest cells hold k rows for certain.
    bound = F.aggregate(
        reach, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(float("inf")).alias("u")),
        lambda a, c: F.when(a["n"] >= k, a).otherwise(F.struct(
            (a["n"] + c["n"]).alias("n"), F.when(a["n"] + c["n"] >= k, c["u"]).otherwise(a["u"]).alias("u"))))["u"]
    found = found.withColumn("_bound", bound * (1 + 1e-9) + 1e-9)
    visits = F.filter("_cells", lambda c: F.element_at("_d", c["_cell"]) - c["radius"] <= F.col("_bound"))
    packs = F.array_distinct(F.transform(visits, lambda c: F.struct(c["pack"].alias("pack"), c["parts"].alias("parts"))))
    found = found.select(*by, *target_id, "_x", "_tn", F.explode(packs).alias("_c"))
    left = found.select(
        *by, *target_id, "_x", F.col("_c.pack").alias("_pack"),
        F.pmod(F.xxhash64(*target_id), F.col("_tn")).alias("_t"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_c.parts") - 1)).alias("_r"))
    right = refs.join(layout.select(*by, "_tn"), by)
    right = right.join(lookup(cells.select(*by, "_cell", F.col("pack").alias("_pack"), "parts")), [*by, "_cell"])
    right = right.select(
        *by, order, *payload, "_x", "_pack",
        F.pmod(F.xxhash64(order, "_x"), F.col("parts")).alias("_r"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_tn") - 1)).alias("_t"))

    out_ref = [order, *payload]
    schema = T.StructType([*[targets.schema[c] for c in (*by, *target_id)], T.StructField("_d2", T.DoubleType()),
                           *[refs.schema[c] for c in out_ref]])

    def nearest(t: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if t.empty or r.empty:
            return pd.DataFrame(columns=schema.names, dtype=object)
        r = r.sort_values(order, kind="stable").reset_index(drop=True)
        tx, rx, keep = np.stack(t["_x"].to_numpy()), np.stack(r["_x"].to_numpy()), min(k, len(r))
        step = max(1, HELD // len(rx))
        found = [nearest_rows(tx[at:at + step], rx, keep) for at in range(0, len(tx), step)]
        rows = np.repeat(np.arange(len(tx)), keep)
        picks, squares = np.concatenate([p.ravel() for p, _ in found]), np.concatenate([d.ravel() for _, d in found])
        out = {c: t[c].to_numpy()[rows] for c in (*by, *target_id)}
        out["_d2"] = squares
        out.update({c: r[c].to_numpy()[picks] for c in out_ref})
        return pd.DataFrame(out)

    block = [*by, "_pack", "_r", "_t"]
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)
    local = left.groupBy(*block).cogroup(right.groupBy(*block)).applyInPandas(nearest, schema)
    order_by = Window.partitionBy(*by, *target_id).orderBy("_d2", order)
    return local.withColumn("nth", F.row_number().over(order_by)).filter(F.col("nth") <= k).select(
        *by, *target_id, F.sqrt("_d2").alias("distance"), "nth", *out_ref)


def nearest_rows(points: np.ndarray, rows: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each point the ``keep`` nearest rows, in order, and their squared distances to 9 digits; the first row on ties.

    Matrix products give the distances but for rounding; what may be near enough by them is measured again, feature by feature.
    """
    with np.errstate(invalid="ignore", over="ignore"):
        size = (points ** 2).sum(axis=1)[:, None] + (rows ** 2).sum(axis=1).max()
        rough = (rows ** 2).sum(axis=1) - 2 * (points @ rows.T)
        far = np.partition(rough, keep - 1, axis=1)[:, keep - 1, None]
        slack = 3 * 10.0 ** -DIGITS + 1e-14 * (points.shape[1] + 8) * size
        i, j = np.nonzero(~(rough > far + slack))  # all, where numbers are not finite
    d2 = np.zeros(len(i))
    with np.errstate(invalid="ignore", over="ignore"):
        for f in range(points.shape[1]):
            d2 += (points[i, f] - rows[j, f]) ** 2
    d2 = np.round(d2, DIGITS)
    order = np.lexsort((d2, i))
    i, j, d2 = i[order], j[order], d2[order]
    first = np.searchsorted(i, np.arange(len(points)))
    best = first[:, None] + np.arange(keep)
    return j[best], d2[best]


def fill_knn(df: DataFrame, cols=("temperature", "humidity"), k: int = 60, by=()) -> DataFrame:
    """Fill a missing measure with its mean over the k rows nearest in the other measure.

    Rows missing both take the column mean. Donors are reduced to one entry per distinct value of the
    other measure and numbered in order, so a receiver only meets the k entries on either side. The
    group of donors at the distance that completes the k counts with its mean for the rest.
    """
    by, (a, b) = list(by), list(cols)
    means = df.groupBy(*by).agg(*[F.avg(c).alias(f"_{c}_mean") for c in (a, b)])
    out = attach(df, means, by)
    for c, other in ((a, b), (b, a)):
        near = _nearest_means(df, c, other, k, by).withColumnRenamed("_x", other)
        out = out.join(lookup(near.select(*by, other, F.col("_near").alias(f"_{c}_near"))), [*by, other], "left")
    return out.withColumns({c: F.coalesce(c, f"_{c}_near", f"_{c}_mean") for c in (a, b)}).select(*df.columns)


def _nearest_means(df: DataFrame, c: str, other: str, k: int, by) -> DataFrame:
    """Per distinct value of ``other`` on rows missing ``c``: the mean of ``c`` over the k nearest donors."""
    donor, receiver = F.col(c).isNotNull(), F.col(c).isNull()
    values = df.filter(F.col(other).isNotNull()).groupBy(*by, F.col(other).alias("_x")).agg(
        F.count_if(donor).alias("_n"), F.sum(c).alias("_s"), F.max(receiver).alias("_wanted"))
    values = values.withColumn("_is", (F.col("_n") > 0).cast("bigint"))
    ranked = running_totals(values, "_x", {"_pos": "_is"}, by)
    donors = ranked.filter("_n > 0").select(
        *by, F.col("_x").alias("_v"), "_n", "_s", F.col("_pos").alias("_rank"), floor_div(F.col("_pos"), k).alias("_block"))
    first, last = F.col("_pos") - k + 1, F.col("_pos") + k
    wanted = ranked.filter("_wanted").select(
        *by, "_x", "_pos", F.explode(F.sequence(floor_div(first, k), floor_div(last, k))).alias("_block"))
    pairs = wanted.join(donors, [*by, "_block"]).filter(F.col("_rank").between(first, last))
    rings = pairs.groupBy(*by, "_x", F.round(F.abs(F.col("_v") - F.col("_x")), DIGITS).alias("_d")).agg(
        F.sum("_n").alias("_n"), F.sum("_s").alias("_s"))
    order = Window.partitionBy(*by, "_x").orderBy("_d")
    upto = F.sum("_n").over(order)
    used = F.greatest(F.least(F.col("_n"), k - F.col("_upto") + F.col("_n")), F.lit(0))
    return rings.withColumn("_upto", upto).withColumn("_used", used).filter("_used > 0").groupBy(*by, "_x").agg(
        (F.sum(F.col("_s") / F.col("_n") * F.col("_used")) / F.sum("_used")).alias("_near"))
