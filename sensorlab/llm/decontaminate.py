"""Benchmark decontamination: rare n-grams of test items seed candidates in training texts, and Smith-Waterman
alignment of words scores them, so that edited copies are found too.

How rare an item's n-grams are is counted over all documents. An item's seeds are those that aren't much more frequent
than its median one, at least half of them: so an item that stands in very many documents still has seeds, and what
a few edited copies kept isn't held to be common. Items are sent to the tasks in blocks
of bounded size, and each document is settled where it is read: nothing is joined or shuffled but counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sensorlab.llm.common import filter_rows, in_batches, text_only
from sensorlab.llm.words import ALNUM, LOWER, Lookup, find_words, gram_hash, grams, hash_words, slices, utf8_column

#: Items that are sent to the tasks together.
ITEM_BLOCK = 20_000
#: An n-gram so many times as frequent as its item's median one is no seed.
COMMON = 8
MATCH, MISS, GAP = 2, -1, -1
#: Cells of an alignment step that are held at once.
CELLS = 400_000


@dataclass
class Seeds:
    ids: list
    words: list[np.ndarray]
    n: int
    known: np.ndarray  # hashes of seeds, in order
    first: np.ndarray  # entries of seed k: first[k] to first[k + 1]
    item: np.ndarray
    place: np.ndarray


def item_grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the item's n-grams; a shorter item is one gram."""
    return grams(words, n) if len(words) >= n else np.array([gram_hash(words)] if len(words) else [], np.uint64)


def text_hashes(column: pa.Array):
    """Yield (first row, word hashes, words before each text) for ranges of rows."""
    data, offsets = utf8_column(column)
    for first, last in slices(offsets):
        lowered = LOWER[data[offsets[first] : offsets[last]]]
        starts, ends, before = find_words(lowered, offsets[first : last + 1] - offsets[first], ALNUM)
        yield first, hash_words(lowered, starts, ends), before


def hits(hashes: np.ndarray, before: np.ndarray, lookups: dict[int, Lookup]):
    """Places and rows (from 1) of known n-grams of each length that lie within one text."""
    for n, lookup in lookups.items():
        found = lookup(grams(hashes, n))
        place = np.flatnonzero(found)
        text = np.searchsorted(before, place, side="right") - 1
        inside = place + n <= before[text + 1]
        yield n, place[inside], found[place[inside]] - 1, text[inside]


def count_grams(docs: DataFrame, known: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """How often each known n-gram stands in all documents."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def count(batches):
        lookups = {n: Lookup(k) for n, k in sent.value.items()}
        totals = {n: np.zeros(len(k), np.int64) for n, k in sent.value.items()}
        for batch in batches:
            for _, hashes, before in text_hashes(batch.column("text")):
                for n, _, seed, _ in hits(hashes, before, lookups):
                    totals[n] += np.bincount(seed, minlength=len(totals[n]))
        for n, t in totals.items():
            some = np.flatnonzero(t)
            yield pa.RecordBatch.from_pydict({"n": pa.array(np.full(len(some), n), pa.int32()), "k": pa.array(some, pa.int64()), "c": pa.array(t[some], pa.int64())})

    out = {n: np.zeros(len(k), np.int64) for n, k in known.items()}
    for row in docs.select("text").mapInArrow(count, "n int, k long, c long").groupBy("n", "k").agg(F.sum("c").alias("c")).collect():  # one row a gram of the block
        out[row["n"]][row["k"]] = row["c"]
    return out


def choose_seeds(docs: DataFrame, items: list, n: int) -> dict[int, Seeds]:
    """Seeds of a block of items (item_id, text) by gram length."""
    _, hashes, before = zip(*text_hashes(pa.array([t or "" for _, t in items], pa.large_string()))) if items else ((), (), ())
    words = [h[b[k] : b[k + 1]] for h, b in zip(hashes, before) for k in range(len(b) - 1)]
    all_grams = [item_grams(w, n) for w in words]
    size = [min(n, len(w)) for w in words]
    known = {m: np.unique(np.concatenate([g for g, s in zip(all_grams, size) if s == m])) for m in sorted(set(size) - {0})}
    counts = count_grams(docs, known)
    out = {}
    for m, k in known.items():
        entries = []
        for item, (g, s) in enumerate(zip(all_grams, size)):
            if s == m:
                often = counts[m][np.searchsorted(k, g)]
                for place in np.flatnonzero(often <= COMMON * (np.median(often) + 1)):
                    entries.append((g[place], item, place))
        hashes_of = np.array([e[0] for e in entries], np.uint64)
        order = np.argsort(hashes_of, kind="stable")
        seeds, first = np.unique(hashes_of[order], return_index=True)
        out[m] = Seeds([i for i, _ in items], words, m, seeds, np.append(first, len(entries)),
                       np.array([entries[o][1] for o in order], np.int64), np.array([entries[o][2] for o in order], np.int64))
    return out


def align(texts: list[np.ndarray], items: list[np.ndarray]) -> np.ndarray:
    """Best local alignment score of each pair of word sequences, all pairs a row of words at a time."""
    best = np.zeros(len(texts), np.int64)
    order = sorted(range(len(texts)), key=lambda k: (len(items[k]), len(texts[k])))
    while order:
        width = max(len(texts[order[0]]), 1)
        take = [order[0]]
        for k in order[1:]:
            width = max(width, len(texts[k]))
            if width * (len(take) + 1) > CELLS:
                break
            take.append(k)
        order = order[len(take) :]
        width, height = max(len(texts[k]) for k in take), max(len(items[k]) for k in take)
        t = np.zeros((len(take), width), np.uint64)
        i = np.ones((len(take), height), np.uint64)  # differs from the padding of texts
        for row, k in enumerate(take):
            t[row, : len(texts[k])] = texts[k]
            i[row, : len(items[k])] = items[k]
        slope = np.arange(width + 1) * -GAP
        h, top = np.zeros((len(take), width + 1), np.int64), np.zeros(len(take), np.int64)
        for j in range(height):
            new = np.zeros_like(h)
            new[:, 1:] = np.maximum(np.maximum(h[:, :-1] + np.where(t == i[:, j : j + 1], MATCH, MISS), h[:, 1:] + GAP), 0)
            h = np.maximum.accumulate(new + slope, axis=1) - slope  # gaps along the text
            top = np.maximum(top, h.max(axis=1))
        best[take] = top
    return best


def leaks(batch_text: pa.Array, blocks: dict[int, Seeds], lookups: dict[int, Lookup], least: float) -> list[tuple[int, int, float, int]]:
    """(row, item number, score, first word) of every pair whose score is at least ``least``."""
    out = []
    for first, hashes, before in text_hashes(batch_text):
        candidates = []
        for n, place, seed, text in hits(hashes, before, lookups):
            s = blocks[n]
            times = s.first[seed + 1] - s.first[seed]
            entry = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(s.first[seed], times)
            item, line = s.item[entry], np.repeat(place, times) - s.place[entry]
            text = np.repeat(text, times)
            order = np.lexsort((line, item, text))
            text, item, line = text[order], item[order], line[order]
            length = np.array([len(s.words[k]) for k in range(len(s.words))])[item] if len(item) else np.zeros(0, np.int64)
            slack = length // 4 + 4
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (line[1:] - line[:-1] > slack[1:])
            begins = np.flatnonzero(new)
            ends = np.append(begins[1:], len(text)) - 1
            for a, b in zip(begins, ends):
                low = max(before[text[a]], line[a] - slack[a])
                high = min(before[text[a] + 1], line[b] + length[a] + slack[a])
                candidates.append((int(text[a]), int(item[a]), hashes[low:high], s.words[item[a]], int(low - before[text[a]])))
        scores = align([c[2] for c in candidates], [c[3] for c in candidates])
        top: dict[tuple[int, int], tuple[float, int]] = {}
        for (row, item, _, words, begin), value in zip(candidates, scores):
            part = value / (MATCH * len(words))
            if part >= least and part > top.get((row, item), (0.0, 0))[0]:
                top[row, item] = (part, begin)
        out += [(first + row, item, part, begin) for (row, item), (part, begin) in top.items()]
    return out


def item_blocks(benchmark: DataFrame):
    """Blocks of items (item_id, text), each of bounded size, in a fixed order."""
    rows, block = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).orderBy("item_id", "text").toLocalIterator(), []
    for row in rows:
        block.append((row[0], row[1]))
        if len(block) == ITEM_BLOCK:
            yield block
            block = []
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, n: int = 3, least: float = 0.5) -> DataFrame:
    """One row per document row and item it leaks: doc_id, item_id, score, near_word (the alignment starts at or after it).

    The score is the alignment's share of the score of a whole copy (a match gives 2; a change, insertion or
    deletion takes 1); pairs below ``least`` are left out. Words are lower-cased and compared without punctuation.
    Null or empty texts and items leak nothing; an item shorter than ``n`` words is looked for as one gram; the same item
    twice gives two rows; repeated documents give a row each; empty tables give no rows; extra columns are left aside.
    """
    docs, out = text_only(docs), None
    shape = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("near_word", pa.int64())])
    for block in item_blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(choose_seeds(docs, block, n))

        def match(batch, sent=sent):
            lookups = {m: Lookup(s.known) for m, s in sent.value.items()}
            found = leaks(batch.column("text"), sent.value, lookups, least)
            ids = batch.column("doc_id")
            names = next((s.ids for s in sent.value.values()), [])
            yield {"doc_id": [ids[f[0]].as_py() for f in found], "item_id": [names[f[1]] for f in found],
                   "score": [f[2] for f in found], "near_word": [f[3] for f in found]}

        part = docs.mapInArrow(in_batches(match, shape), "doc_id long, item_id long, score double, near_word long")
        out = part if out is None else out.union(part)
    return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, score double, near_word long") if out is None else out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, n: int = 3, least: float = 0.5) -> DataFrame:
    """The documents, with all their columns, that leak no item."""
    texts = text_only(docs)
    for block in item_blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(choose_seeds(texts, block, n))

        def clean(batch, sent=sent):
            lookups = {m: Lookup(s.known) for m, s in sent.value.items()}
            keep = np.ones(batch.num_rows, bool)
            keep[[f[0] for f in leaks(batch.column("text"), sent.value, lookups, least)]] = False
            return keep

        docs = filter_rows(docs, clean)
    return docs
