"""Exact top-k search by block-at-a-time pruning.

Documents are cut by ranges of their ids into blocks that hold a forward index (the vectors themselves) and each
term's largest and smallest value. The sum over a query's terms of what a block's extremes allow bounds every score in
the block. Each query visits blocks from the highest bound down and stops where the bound falls below its k-th score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sensorlab.llm.common import staged

#: Vectors of a block, blocks of a task, and queries that are sent to the tasks together.
BLOCK = 128
TASK_ROWS = 16_384
QUERY_BLOCK = 4_096

MOST = np.finfo(float).max

INDEX = pa.schema([("size", pa.int32()), ("ids", pa.binary()), ("values", pa.binary()), ("high", pa.binary()), ("low", pa.binary())])


def whole_numbers(column: pa.Array, scale: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By vector length: rows and floor(scale * x) as doubles, without vectors that are null or hold null or no number."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    components = column.values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(components))])
    with np.errstate(over="ignore", invalid="ignore"):
        # A product beyond the doubles is held at their end; its scores are at the ends of the long range either way.
        values = np.clip(np.floor(components * scale), -MOST, MOST)
    good = column.is_valid().to_numpy(zero_copy_only=False) & (bad[offsets[1:]] == bad[offsets[:-1]])
    sizes = np.diff(offsets)
    out = {}
    for size in np.unique(sizes[good]):
        rows = np.flatnonzero(good & (sizes == size))
        out[int(size)] = rows, values[offsets[rows][:, None] + np.arange(size)]
    return out


def products(queries: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: as doubles while no sum can leave their whole range, else as integers."""
    with np.errstate(over="ignore"):
        most = np.abs(queries).max(initial=0.0) * np.abs(values).max(initial=0.0) * max(queries.shape[1], 1)
    if most < 2.0**53:
        return (queries @ values.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in queries], object) @ np.array([[int(x) for x in row] for row in values], object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def build_index(vectors: DataFrame, scale: float, task_rows: int, block: int) -> DataFrame:
    """Blocks of vectors in ranges of vec_id, each with its terms' extremes."""
    rows = vectors.filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
    parts = max(1, -(-rows.count() // task_rows))

    def cut(batches):
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            for size, (rows, values) in whole_numbers(batch.column("embedding"), scale).items():
                for k in range(0, len(rows), block):
                    part = values[k : k + block]
                    yield pa.RecordBatch.from_pydict({
                        "size": [size], "ids": [ids[rows[k : k + block]].tobytes()], "values": [part.tobytes()],
                        "high": [part.max(axis=0).tobytes()], "low": [part.min(axis=0).tobytes()]}, schema=INDEX)

    ordered = rows.repartitionByRange(parts, "vec_id").sortWithinPartitions("vec_id")
    return staged(ordered.mapInArrow(cut, "size int, ids binary, values binary, high binary, low binary"), "index")


def search_blocks(query_ids: np.ndarray, queries: np.ndarray, blocks: list, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of queries, ids and scores: for each query its k best among the blocks (ids, values, high, low)."""
    n = len(queries)
    scores, ids = np.full((n, k), np.iinfo(np.int64).min), np.full((n, k), np.iinfo(np.int64).max)
    filled = np.zeros((n, k), bool)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    with np.errstate(over="ignore", invalid="ignore"):
        bounds = up @ np.array([b[2] for b in blocks]).T + down @ np.array([b[3] for b in blocks]).T
    # Sums beyond the whole range of doubles may be rounded, and where some are infinite, nothing is ruled out.
    bounds = np.where(np.isfinite(bounds), np.nextafter(bounds, np.inf), np.inf)
    order = np.argsort(-bounds, axis=1, kind="stable")
    active = np.arange(n)
    for turn in range(len(blocks)):
        visit = order[active, turn]
        # An equal bound may still bring an equal score with a smaller id.
        open_now = ~filled[active, -1] | (bounds[active, visit] >= scores[active, -1])
        active, visit = active[open_now], visit[open_now]
        if not len(active):
            break
        for b in np.unique(visit):
            rows = active[visit == b]
            block_ids, values = blocks[b][0], blocks[b][1]
            found = products(queries[rows], values)
            other = block_ids[None, :] != query_ids[rows][:, None]
            better = other & (~filled[rows, -1:] | (found >= scores[rows, -1:]))
            some = better.any(axis=1)
            rows, found, better = rows[some], found[some], better[some]
            if not len(rows):
                continue
            all_scores = np.concatenate([scores[rows], found], axis=1)
            all_ids = np.concatenate([ids[rows], np.broadcast_to(block_ids, found.shape)], axis=1)
            there = np.concatenate([filled[rows], better], axis=1)
            best = np.lexsort((all_ids, -all_scores, ~there), axis=1)[:, :k]
            scores[rows], ids[rows], filled[rows] = (np.take_along_axis(x, best, axis=1) for x in (all_scores, all_ids, there))
    row, rank = np.nonzero(filled)
    return row, ids[row, rank], scores[row, rank]


def answers(queries: dict, blocks: dict[int, list], k: int):
    for size, (numbers, ids, values) in queries.items():
        if size in blocks:
            row, found, scores = search_blocks(ids, values, blocks[size], k)
            yield pa.RecordBatch.from_pydict({"query": numbers[row], "query_id": ids[row], "vec_id": found, "score": scores})


def query_blocks(asked: DataFrame, most: int):
    """The queries as Arrow tables of up to ``most`` rows, in the order of their ids."""
    last = None
    while True:
        rest = asked if last is None else asked.filter(F.col("query") > last)
        held = rest.orderBy("query").limit(most).toArrow()
        if not held.num_rows:
            return
        yield held
        last = held.column("query")[-1].as_py()


def top_k(vectors: DataFrame, every: int, k: int = 5, scale: float = 256.0, task_rows: int = TASK_ROWS, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k best vectors; ties go to the smaller vec_id.

    Queries are the rows whose vec_id is divisible by ``every``, candidates all rows with another vec_id. Components count
    as floor(scale * x), scores are exact inner products (held at the ends of the long range). Rows without id, and null
    vectors or ones that hold null or a value that isn't finite, take no part; vectors of other lengths than the query's
    aren't its candidates; a vec_id on several rows is several candidates and queries; an empty table gives no rows;
    extra columns are left aside. Queries are sent in blocks of bounded size, each against the whole index.
    """
    spark = vectors.sparkSession
    vectors = vectors.select(F.col("vec_id").cast("long"), "embedding")
    index = build_index(vectors, scale, task_rows, block)
    asked = staged(vectors.filter(f"vec_id % {every} = 0 AND embedding IS NOT NULL").withColumn("query", F.monotonically_increasing_id()), "queries")
    tops = None
    for held in query_blocks(asked, query_block):
        sent = spark.sparkContext.broadcast({
            size: (held.column("query").to_numpy()[rows], held.column("vec_id").to_numpy()[rows], values)
            for size, (rows, values) in whole_numbers(held.column("embedding"), scale).items()})

        def search(batches, sent=sent):
            blocks: dict[int, list] = {}
            for batch in batches:
                for size, ids, *parts in zip(*[batch.column(c) for c in INDEX.names]):
                    size = size.as_py()
                    ids = np.frombuffer(ids.as_buffer(), np.int64)
                    values, high, low = (np.frombuffer(p.as_buffer(), np.float64) for p in parts)
                    blocks.setdefault(size, []).append((ids, values.reshape(len(ids), size), high, low))
                if sum(map(len, blocks.values())) * block > 4 * task_rows:
                    yield from answers(sent.value, blocks, k)
                    blocks = {}
            yield from answers(sent.value, blocks, k)

        part = index.mapInArrow(search, "query long, query_id long, vec_id long, score long")
        tops = part if tops is None else tops.union(part)
    if tops is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return tops.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
