"""Substring dedup: runs of consecutive sentences are hashed and joined over the whole corpus, and every sentence
in a run that stands elsewhere before is removed.

A run starts at every sentence and takes as many as needed for ``min_words`` words, at least ``min_sentences`` (or
one, if it has ``long_words`` alone); so equal passages give equal runs wherever they stand. The shortest run up to every
sentence is sent too, at most two rows a sentence, which covers repeated passages up to their last sentence. Each task
keeps only its own first place of a run: a later place in the same task is not the first anywhere. So a run of a third
of all documents costs one row a task.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from sensorlab.llm.common import in_batches, staged, text_only

#: A sentence ends after ., ! or ? (with closing quotes or brackets) before white space, and at a line's end.
SENTENCE = re.compile(r"[^\n]*?[.!?]+[\"')\]]*(?=\s|$)[^\S\n]*\n?|[^\n]+\n?|\n")
WORD = re.compile(r"\w+")


def sentences(text: str) -> list[str]:
    """The text cut into sentences; joined they give the text again."""
    return SENTENCE.findall(text)


def keyed(parts: list[str]) -> tuple[list[int], list[str], list[int]]:
    """The sentences that hold words: their places, words and counts.

    Words are compared without case, punctuation and white space; sentences without words join the run they stand in.
    """
    words = [WORD.findall(p.lower()) for p in parts]
    full = [i for i, w in enumerate(words) if w]
    return full, [" ".join(words[i]) for i in full], [len(words[i]) for i in full]


def shortest(counts: list[int], min_sentences: int, min_words: int, long_words: int) -> list[tuple[int, int]]:
    """(start, end) of the shortest run from each start that is long enough."""
    out, end, held = [], 0, 0
    for k in range(len(counts)):
        end, held = (end, held) if end > k else (k, 0)
        while end < len(counts) and held < long_words and (end - k < min_sentences or held < min_words):
            held += counts[end]
            end += 1
        while end - k > min_sentences and held - counts[end - 1] >= min_words or end - k > 1 and held - counts[end - 1] >= long_words:
            end -= 1  # a run that began before may have taken more than this one needs
            held -= counts[end]
        if held < long_words and (end - k < min_sentences or held < min_words):
            break
        out.append((k, end))
        held -= counts[k]
    return out


def hashed(places: list[tuple[int, int]], full: list[int], keys: list[str]) -> list[tuple[int, int, int]]:
    """(first sentence, sentences, hash) of runs given as (start, end)."""
    return [(full[k], full[end - 1] - full[k] + 1, xxhash.xxh3_64_intdigest("\n".join(keys[k:end])) - (1 << 63)) for k, end in places]


def runs(parts: list[str], min_sentences: int, min_words: int, long_words: int) -> list[tuple[int, int, int]]:
    """(first sentence, sentences, hash) of the shortest run from each start that is long enough."""
    full, keys, counts = keyed(parts)
    return hashed(shortest(counts, min_sentences, min_words, long_words), full, keys)


def runs_both_ways(parts: list[str], min_sentences: int, min_words: int, long_words: int) -> list[tuple[int, int, int]]:
    """``runs``, and the shortest run up to each end; one that is both comes once.

    Whether a run is shortest from its start or up to its end follows from its own words, so equal runs are sent
    alike wherever they stand. A repeated passage is covered whole: a sentence from which no long enough run fits into
    the passage lies in the shortest run up to the passage's end.
    """
    full, keys, counts = keyed(parts)
    n, limits = len(counts), (min_sentences, min_words, long_words)
    ahead = shortest(counts, *limits)
    back = [(n - end, n - k) for k, end in shortest(counts[::-1], *limits)]
    return hashed(list(dict.fromkeys(ahead + back)), full, keys)


#: Runs that a task remembers, and later places that it holds, before it sends them.
HELD = 500_000

PLACES = "key long, late boolean, doc long, row long, first long, size long"


def repeated_runs(rows: DataFrame, limits: tuple[int, int, int], held: int = HELD) -> DataFrame:
    """(row, first, size): places of runs that aren't the first by (doc_id, row, sentence); null ids come last.

    Places meet in partitions sorted by run, so nothing is held for a run but its last place.
    """
    shape = pa.schema([("key", pa.int64()), ("late", pa.bool_()), *[(c, pa.int64()) for c in ("doc", "row", "first", "size")]])

    def scatter(batches):
        local: dict[int, tuple[int, int, int, int]] = {}
        late: list[tuple[int, int, int, int]] = []
        for batch in batches:
            for row, doc, text in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text")):
                doc = (1 << 63) - 1 if doc is None else doc
                for first, size, key in runs_both_ways(sentences(text.as_py()), *limits):
                    here, kept = (doc, row, first, size), local.get(key)
                    if kept is not None:
                        late.append(max(here, kept))
                        here = min(here, kept)
                    local[key] = here
                if len(late) > held:
                    yield from send(np.zeros(0, np.int64), late, True)
                    late = []
            if len(local) > held:
                yield from send(np.fromiter(local, np.int64, len(local)), list(local.values()), False)
                local = {}
        yield from send(np.zeros(0, np.int64), late, True)
        yield from send(np.fromiter(local, np.int64, len(local)), list(local.values()), False)

    def send(keys, places, late):
        """Later places need no run to meet, so they are spread by their row."""
        for k in range(0, len(places), 50_000):
            part = np.array(places[k : k + 50_000], np.int64).reshape(-1, 4)
            spread = part[:, 1] * 1_000_003 + part[:, 2] if late else keys[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(spread), pa.array(np.full(len(part), late)), *[pa.array(c) for c in part.T.copy()]], schema=shape)

    def settle(batches):
        last = None
        for batch in batches:
            keys, late = batch.column("key").to_numpy(), batch.column("late").to_numpy(zero_copy_only=False)
            again = np.zeros(len(keys), bool)
            if len(keys):
                again[0] = last == keys[0]
                again[1:] = keys[1:] == keys[:-1]
                last = None if late[-1] else keys[-1]
            # Late places come after all others; the first of them may have the key of the last other one.
            again |= late
            yield batch.filter(pa.array(again)).select(["row", "first", "size"])

    sent = rows.select("row", "doc_id", "text").mapInArrow(scatter, PLACES)
    return sent.repartition("key").sortWithinPartitions("late", "key", "doc", "row", "first").mapInArrow(settle, "row long, first long, size long")


def dedup_spans(docs: DataFrame, min_sentences: int = 2, min_words: int = 25, long_words: int = 40) -> DataFrame:
    """All rows and columns of ``docs`` with the text that stays, and n_removed (sentences) and removed (the text cut out).

    A sentence goes if it lies in any long enough run of consecutive sentences that stands elsewhere before, in the order
    of doc_id, then of rows. So the first place of a passage stays whole, and a copied document loses all its runs. Null and empty texts stay as they are; repeated rows are copies; an empty table gives
    no rows; extra columns are kept, but for ones named as the added columns, ``row`` or ``cover``, which are replaced.
    """
    own = ["row", "cover", "n_removed", "removed"]
    base = docs.drop(*[c for c in docs.columns if c.lower() in own])
    kept = staged(base.withColumn("row", F.monotonically_increasing_id()), "rows")
    places = repeated_runs(text_only(kept, "row"), (min_sentences, min_words, long_words))
    cover = places.groupBy("row").agg(F.collect_set(F.struct("first", "size")).alias("cover"))
    joined, names = kept.join(cover, "row", "left"), base.columns

    def cut(batch):
        texts, counts, gone = [], [], []
        for text, cover in zip(batch.column("text").to_pylist(), batch.column("cover").to_pylist()):
            parts = sentences(text) if cover else []
            drop = np.zeros(len(parts), bool)
            for place in cover or []:
                drop[place["first"] : place["first"] + place["size"]] = True
            counts.append(int(drop.sum()))
            gone.append("".join(p for p, d in zip(parts, drop) if d))
            texts.append("".join(p for p, d in zip(parts, drop) if not d) if cover else text)
        yield {c: batch.column(c) for c in names} | {"text": texts, "n_removed": counts, "removed": gone}

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    shape = StructType([*(StructField("text", StringType()) if f.name == "text" else StructField(f.name, f.dataType) for f in base.schema),
                        StructField("n_removed", LongType()), StructField("removed", StringType())])
    return joined.mapInArrow(in_batches(cut, to_arrow_schema(shape)), shape)
