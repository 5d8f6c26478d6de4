"""Staging, id filters and connected components that the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorlab.session import scratch

#: Bits of the id filter: 1 MB however many ids are set.
FILTER_BITS = 1 << 23


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder as Parquet and read it back, so that lost executors recompute nothing above."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_only(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id`` as a long, ``text`` (null: empty) and the named columns; other columns play no part."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *columns)


def in_batches(function: Callable[[pa.RecordBatch], Iterator[dict]], schema: pa.Schema):
    """A ``mapInArrow`` function from one that yields column dicts for a batch."""
    def run(batches):
        for batch in batches:
            for columns in function(batch):
                yield pa.RecordBatch.from_pydict(columns, schema=schema)
    return run


def filter_rows(df: DataFrame, keep: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """The rows of which ``keep`` says so, with all their columns."""
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(keep(batch), pa.bool_()))
    return df.mapInArrow(run, df.schema)


def id_filter(ids: DataFrame, column: str) -> np.ndarray:
    """A fixed 1 MB bit filter of evenly spread 64-bit ids: no id is missed, a few others may pass."""
    place = F.pmod(F.col(column), F.lit(FILTER_BITS)) + 1
    rows = (
        ids.groupBy(F.bitmap_bucket_number(place).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        .collect()
    )
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in rows:  # at most FILTER_BITS / 32768
        first = (row["bucket"] - 1) * 4096
        out[first : first + 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return out


def passes(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which 64-bit ids the filter lets through."""
    place = ids.view(np.uint64) & np.uint64(FILTER_BITS - 1)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(id, root) for every id in ``links`` (a, b): root is the smallest id reachable.

    Every round takes the smallest label around each id and then the label of that label, so that long chains
    shorten by half; each round is staged. Rows grow with the links, and sums before the shuffle keep hubs small.
    """
    both = staged(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), "links")
    labels = staged(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("root")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("near"))
        lower = labels.join(near, "id").select("id", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("id").alias("root"), F.col("root").alias("next"))
        rounds = staged(lower.join(jump, "root", "left").select("id", "was", F.least("root", F.coalesce("next", "root")).alias("root")), "labels")
        labels = rounds.select("id", "root")
        if rounds.filter("was <> root").isEmpty():
            return labels
