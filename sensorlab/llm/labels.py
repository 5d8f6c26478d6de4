"""Bounded samples of labelled texts, on which the classifiers are fitted."""

from __future__ import annotations

import pickle
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

#: Labelled rows that a classifier is fitted on, at most, and the characters that each of them teaches by. A longer text
#: teaches by FIT_PARTS windows at equal distances, from its beginning to its end; texts are scored whole.
FIT_ROWS = 6000
FIT_CHARS = 60_000
FIT_PARTS = 12


def fold(parts: int) -> Column:
    """crc32 of the id's text modulo ``parts``; -1 for a missing id, which nothing is learnt from or held out by."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts, F.lit(-1))


def windows(text: Column, most: int = FIT_CHARS, parts: int = FIT_PARTS) -> Column:
    """The text, or windows of ``most`` characters in all that lie evenly over a longer one."""
    each = most // parts
    start = lambda k: (k * (F.length(text) - each) / F.lit(parts - 1)).cast("int") + 1
    cut = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda k: text.substr(start(k), F.lit(each))), " ")
    return F.when(F.length(text) <= most, text).otherwise(cut)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int = FIT_ROWS, extra: tuple[str, ...] = ()) -> DataFrame:
    """Up to ``rows`` labelled texts that ``learn`` allows, drawn evenly by a hash of the id, in one ordered partition.

    A document that is labelled more than once counts with its highest label; null labels don't count.
    """
    marked = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("label")).filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & learn)
    drawn = marked.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long"), windows(F.coalesce("text", F.lit(""))).alias("text"), *extra)
    # The drawn rows have a bound, so they are sent to the texts.
    return texts.join(F.broadcast(drawn), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows)


def fitted(sample: DataFrame, fit: Callable[[pa.Table], object]) -> object:
    """What ``fit`` makes of the sample, in one task; only the model comes to the driver."""
    shape = to_arrow_schema(sample.schema)

    def run(batches):
        model = fit(pa.Table.from_batches(list(batches), schema=shape))
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})

    found = sample.coalesce(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else fit(shape.empty_table())
