"""Mixture-controlled packing: documents become token ids, and deficit round-robin over their sources fills windows of
equal length to the target proportions.

Every source is a queue of tokens. A lap of LAP windows takes from each queue the whole tokens that its share of all laps
so far allows, so what a lap lacks or has too much is carried into the next ones as a deficit. Inside a lap a queue gives
every window the same number of tokens, and what is left over goes one token each to windows in turn, the next queue
going on where the last one stopped; so all windows are full and no queue is more than a token off its share of the lap. When a queue
runs dry, its share goes to the others. All this follows from running totals per source, so any token's window and place
there are known without looking at other documents, and laps and deficits carry across all partitions.

Queues with less than two tokens in a lap (a share below 1 / 65,536) go together as one queue, inside which whole
documents take turns by the same rule.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer, pre_tokenizers

from sensorlab.llm.common import staged, text_only

#: Words whose ids a Python worker remembers, from task to task.
MOST_WORDS = 600_000
SPECIAL = "<|endoftext|>"

#: Windows of a lap, and tokens that a queue of its own has in a lap at least.
LAP = 64
LEAST = 2

#: A letter or digit before punctuation other than an apostrophe always ends a token's text.
LETTER, POINT = np.zeros(256, bool), np.zeros(256, bool)
LETTER[48:58] = LETTER[65:91] = LETTER[97:123] = True
POINT[33:48] = POINT[58:65] = POINT[91:97] = POINT[123:127] = True
POINT[39] = False


class WordIds:
    """Ids of texts by parts of their white-space words whose ids don't depend on what stands around.

    Words are cut before punctuation and their A-Z lower-cased, as the tokenizer does too, so that few differ. New words
    are encoded together: those of plain letters parted by blanks, as each ends with a piece that ends a word; others
    parted by a special token; a word that may hold that token is encoded alone.
    """

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        self.cut = self.tokenizer.token_to_id(SPECIAL)
        vocabulary = self.tokenizer.get_vocab()
        self.kind = np.dtype("<u2" if len(vocabulary) <= 1 << 16 else "<u4")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for piece, k in vocabulary.items() if piece.endswith("</w>")]] = True
        self.letters = Tokenizer.from_str(definition)
        self.letters.normalizer = None
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known: dict[bytes, bytes] = {}

    def words(self, text: bytes) -> list[bytes]:
        if b"<|" in text:
            return text.split()
        raw = np.frombuffer(text, np.uint8)
        places = np.flatnonzero(LETTER[raw[:-1]] & POINT[raw[1:]]) + 1
        return np.insert(raw, places, 32).tobytes().lower().split()

    def learn(self, words: list[bytes]) -> None:
        plain, other = {}, []
        for w in words:
            s = w.decode()
            if s.isalpha() and max(s) < "\u0100":
                plain[w] = s.lower()
            else:
                other.append(w)
        self._together(list(plain), list(plain.values()), self.letters, " ")
        self._together([w for w in other if b"<|" not in w], None, self.tokenizer, SPECIAL)
        for w in other:
            if b"<|" in w:
                self.known[w] = self._ids(self.tokenizer, w.decode()).tobytes()

    def _ids(self, tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def _together(self, words: list[bytes], texts: list[str] | None, tokenizer, blank: str) -> None:
        for k in range(0, len(words), 2000):
            part = words[k : k + 2000]
            ids = self._ids(tokenizer, blank.join(texts[k : k + 2000] if texts else [w.decode() for w in part]))
            if texts:
                ends = np.flatnonzero(self.ends[ids]) + 1
                begins = np.append(0, ends[:-1])
            else:
                ends = np.append(np.flatnonzero(ids == self.cut), len(ids))
                begins = np.append(0, ends[:-1] + 1)
            if len(ends) != len(part):
                raise ValueError("the tokenizer's pieces don't part words")
            self.known.update(zip(part, (ids[a:b].tobytes() for a, b in zip(begins, ends))))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        parts, known = [self.words(t) for t in texts], self.known
        new = dict.fromkeys(w for words in parts for w in words if w not in known)
        if len(known) + len(new) > MOST_WORDS:
            known.clear()
            new = dict.fromkeys(w for words in parts for w in words)
        if new:
            self.learn(list(new))
        return [b"".join([known[w] for w in words]) for words in parts]


#: One coder for each tokenizer that a worker has met.
CODERS: dict[int, WordIds] = {}


def coder_of(definition: str) -> WordIds:
    key = hash(definition)
    if key not in CODERS:
        CODERS[key] = WordIds(definition)
    return CODERS[key]


def document_ids(docs: DataFrame, definition: str, end_id: int) -> DataFrame:
    """(row, chunk, doc_id, source, n, before, ids): the ids of each text and its end id, packed in 2 or 4 bytes each.

    ``before`` counts the tokens of the source that the same task (``chunk``) had before.
    """
    sent = docs.sparkSession.sparkContext.broadcast(definition)
    shape = pa.schema([("row", pa.int64()), ("chunk", pa.int64()), ("doc_id", pa.int64()), ("source", pa.string()), ("n", pa.int64()), ("before", pa.int64()), ("ids", pa.binary())])

    def encode(batches):
        coder, running = coder_of(sent.value), {}
        end = np.array([end_id], coder.kind).tobytes()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                ids = [x + end for x in coder.encode([t.as_buffer().to_pybytes() for t in part.column("text")])]
                sizes, before = [len(x) // coder.kind.itemsize for x in ids], []
                for source, n in zip(part.column("source").to_pylist(), sizes):
                    before.append(running.get(source, 0))
                    running[source] = before[-1] + n
                yield pa.RecordBatch.from_arrays([
                    part.column("row"), part.column("chunk"), part.column("doc_id"), part.column("source"), pa.array(sizes, pa.int64()),
                    pa.array(before, pa.int64()), pa.array(ids, pa.binary())], schema=shape)

    rows = docs.withColumn("row", F.monotonically_increasing_id()).select("row", F.shiftright("row", 33).alias("chunk"), "doc_id", "source", "text")
    return rows.mapInArrow(encode, "row long, chunk long, doc_id long, source string, n long, before long, ids binary")


def queued(rows: DataFrame) -> DataFrame:
    """The rows with ``first``: the tokens of their source that go before, over all chunks."""
    chunks = rows.groupBy("source", "chunk").agg(F.sum("n").alias("tokens"))
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    # Staged, so that its size is known and the ids aren't shuffled for it where it is small.
    chunks = staged(chunks.select(F.col("source").alias("s"), F.col("chunk").alias("c"), F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("ahead")), "ahead")
    return rows.join(chunks, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c"))).withColumn("first", F.col("before") + F.col("ahead")).drop("s", "c", "ahead", "before", "chunk")


def schedule(rows: DataFrame, window: int) -> DataFrame:
    """(row, place) of whole documents that take turns: how many tokens the stream holds before each.

    In every round a source's credit grows by its part of all tokens, and it sends documents while that is above zero; a
    document that begins after c tokens of its source goes in round floor(c / quantum), whatever the other sources do.
    """
    spark = rows.sparkSession
    rows = rows.select("row", "source", "n", F.shiftright("row", 33).alias("chunk"))
    own = Window.partitionBy("source", "chunk").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    chunks = rows.groupBy("source", "chunk").agg(F.sum("n").alias("tokens"))
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("ahead", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
    total = rows.agg(F.sum("n")).first()[0] or 0
    sources = chunks.groupBy("source").agg(F.sum("tokens").alias("of_source"))
    part = F.col("of_source") / F.lit(float(max(total, 1)))
    quantum = sources.select(F.col("source").alias("of"), (part * window).alias("quantum"))
    queued = (
        rows.withColumn("before", F.coalesce(F.sum("n").over(own), F.lit(0)))
        .join(chunks.select(F.col("source").alias("s"), F.col("chunk").alias("c"), "ahead"), F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c")))
        .join(quantum, F.col("source").eqNullSafe(F.col("of")))
        .select("row", "source", "n", F.floor((F.col("before") + F.col("ahead")) / F.col("quantum")).alias("round"))
    )
    queued = staged(queued, "rounds")
    # Blocks of rounds let the running total go in parallel; there are a few for every task of a shuffle.
    rounds = queued.agg(F.max("round")).first()[0] or 0
    each = max(1, -(-(rounds + 1) // (16 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    blocked = queued.withColumn("block", F.floor(F.col("round") / each))
    blocks = blocked.groupBy("block").agg(F.sum("n").alias("tokens"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("block").alias("b"), F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("block").orderBy("round", "source", "row").rowsBetween(Window.unboundedPreceding, -1)
    return blocked.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(blocks, F.col("block") == F.col("b")).select(
        "row", (F.col("before") + F.col("ahead")).alias("place"))


def apportion(amount: int, weights: list, caps: list[int]) -> list[int]:
    """``amount`` tokens by weight, whole, by largest remainder, with no more than each cap; weight 0 only takes what others can't."""
    out = [0] * len(caps)
    while amount > 0:
        free = [k for k, (cap, got) in enumerate(zip(caps, out)) if cap > got]
        shares = [Fraction(weights[k]) for k in free]
        if not sum(shares):
            shares = [Fraction(caps[k] - out[k]) for k in free]
        total, given = sum(shares), 0
        parts = [amount * share / total for share in shares]
        whole = [min(int(part), caps[k] - out[k]) for k, part in zip(free, parts)]
        for k, n in zip(free, whole):
            out[k] += n
            given += n
        for part, k in sorted(((int(part) - part, k) for part, k in zip(parts, free)), key=lambda x: x):
            if given < amount and out[k] < caps[k] and part:
                out[k] += 1
                given += 1
        amount -= given
    return out


class Deal:
    """Where every token of every queue goes. ``sizes`` are the queues' tokens, ``weights`` their shares.

    The deal is a list of segments: a number of equal laps (tokens follow from the weights) or one lap with given tokens.
    """

    def __init__(self, sizes: list[int], weights: list, window: int, lap: int = LAP):
        self.window, self.sizes, self.segments, self.laps, self.lines = window, list(sizes), [], {}, {}
        left, at = list(sizes), 0
        while sum(left) >= window:
            live = [w if n else 0 for w, n in zip(weights, left)]
            if not any(live):
                live = left
            unit = sum(map(Fraction, live))
            live = [w if window * lap * Fraction(w) >= LEAST * unit else 0 for w in live]
            unit = sum(map(Fraction, live))
            rates = [window * Fraction(w) / unit for w in live]  # tokens of a window
            most = min(Fraction(n) / r for n, r in zip(left, rates) if r)  # windows until a queue is dry
            laps = int(most / lap)
            before = [Fraction(0)]
            for r in rates:
                before.append(before[-1] + r * lap)
            taken = lambda laps: [int(laps * b) - int(laps * a) for a, b in zip(before, before[1:])]  # noqa: B023, E731
            while laps and any(t > n for t, n in zip(taken(laps), left)):
                laps -= 1
            if laps:
                tokens, size, length = taken(laps), lap, laps
                self._add(at, laps, lap, left, before, None)
            else:
                length, size = 1, max(1, min(int(most), lap, sum(left) // window))
                tokens = apportion(window * size, live, left)
                self._add(at, 1, size, left, None, tokens)
            left = [n - t for n, t in zip(left, tokens)]
            at += length * size
        if sum(left):
            self._add(at, 1, 1, left, None, list(left))
        self.starts = [[s[3][k] for s in self.segments] for k in range(len(sizes))]

    def _add(self, at, laps, size, left, before, tokens):
        """``before``: tokens of a lap of all queues before each, as whole numbers over one denominator."""
        if before is not None:
            below = math.lcm(*[b.denominator for b in before])
            before = [int(b * below) for b in before] + [below]
        self.segments.append((at, laps, size, [n - m for n, m in zip(self.sizes, left)], before, tokens))

    def taken(self, segment: int, queue: int, laps: int) -> int:
        """Tokens of the queue in the first laps of a segment."""
        _, _, _, _, before, tokens = self.segments[segment]
        return laps * tokens[queue] if before is None else laps * before[queue + 1] // before[-1] - laps * before[queue] // before[-1]

    def lap(self, segment: int, number: int) -> tuple[list[int], list[int]]:
        """Tokens of each queue for every window of the lap, and where their extra tokens begin (one more than queues)."""
        if (segment, number) not in self.laps:
            if len(self.laps) > 64:
                self.laps.clear()
            size = self.segments[segment][2]
            tokens = [self.taken(segment, k, number + 1) - self.taken(segment, k, number) for k in range(len(self.sizes))]
            each, extra = np.array([t // size for t in tokens], np.int64), np.array([t % size for t in tokens], np.int64)
            self.laps[segment, number] = np.concatenate([[0], np.cumsum(each)]), np.concatenate([[0], np.cumsum(extra)])
        return self.laps[segment, number]

    def pieces(self, queue: int, first: int, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Starts (within the n tokens), lengths, windows and places there of a queue's tokens from ``first`` on."""
        end = first + n
        segment = bisect_right(self.starts[queue], first) - 1
        at = first
        while at < end:
            window, laps, size, starts, _, _ = self.segments[segment]
            here = at - starts[queue]
            whole = self.taken(segment, queue, laps)
            if here >= whole:
                segment += 1
                continue
            number = min(laps - 1, here * laps // whole)
            while self.taken(segment, queue, number) > here:
                number -= 1
            while self.taken(segment, queue, number + 1) <= here:
                number += 1
            ends, inside = self.line(segment, number, queue)
            low, high = np.searchsorted(ends, (at, end), side="right") - 1
            high = min(high + (ends[min(high, size)] < end), size)
            a, b = ends[low:high].copy(), ends[low + 1 : high + 1].copy()
            a[0], b[-1] = at, min(end, b[-1])
            some = np.flatnonzero(b > a) if (b <= a).any() else slice(None)
            windows = np.arange(window + number * size + low, window + number * size + high)
            yield (a - first)[some], (b - a)[some], windows[some], (inside[low:high] + a - ends[low:high])[some]
            at = int(ends[-1])

    def line(self, segment: int, number: int, queue: int) -> tuple[np.ndarray, np.ndarray]:
        """The queue's tokens up to every window's start and the lap's end, and its places there."""
        if (segment, number, queue) not in self.lines:
            if len(self.lines) > 4096:
                self.lines.clear()
            size, starts = self.segments[segment][2:4]
            sums, extras = self.lap(segment, number)
            each, low, high = int(sums[queue + 1] - sums[queue]), int(extras[queue]), int(extras[queue + 1])
            w = np.arange(size)
            # Extra tokens lie side by side over the windows, round and round: window v has those at v, v + size, ...
            upto = lambda x: np.maximum(0, -((w - x) // size))  # noqa: E731  how many of the first x are at each window
            ends = starts[queue] + self.taken(segment, queue, number) + np.concatenate([[0], np.cumsum(each + upto(high) - upto(low))])
            self.lines[segment, number, queue] = ends.astype(np.int64), int(sums[queue]) + upto(low)
        return self.lines[segment, number, queue]


def pack(docs: DataFrame, tokenizer_file: str, window: int = 2048, end_id: int = 1, shares: dict[str, float] | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.

    ``shares`` gives sources their parts of a window; sources without one take their part of all tokens. A source of share
    0, or of less than two tokens in a lap, comes when the others are dry. Null and empty texts are the end id alone; a
    null source is a source of its own; repeated rows are packed each; texts of any length are cut freely; an empty table
    gives no rows; extra columns are left aside. Only the last window is padded.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as file:
        definition = file.read()
    wide = Tokenizer.from_str(definition).get_vocab_size() > 1 << 16
    rows = staged(document_ids(text_only(docs, F.col("source").cast("string").alias("source")), definition, end_id), "ids")
    sources = staged(rows.groupBy("source").agg(F.sum("n").alias("total")), "sources")
    total = sources.agg(F.sum("total")).first()[0] or 0
    named = F.col("source").isin(list(shares)) if shares else F.lit(False)
    large = (F.col("total") >= F.lit(-(-LEAST * total // (window * LAP)))) | F.coalesce(named, F.lit(False))
    # At most 65,536 sources are as large as that, besides those that the caller names.
    own = sources.filter(large).orderBy(F.col("source").asc_nulls_first()).collect()
    rest = total - sum(r["total"] for r in own)
    weight = lambda source, n: Fraction(n, max(total, 1)) if not shares or shares.get(source) is None else Fraction(shares[source])
    sizes, weights = [r["total"] for r in own] + [rest], [weight(r["source"], r["total"]) for r in own] + [Fraction(rest, max(total, 1))]
    sent = spark.sparkContext.broadcast(Deal(sizes, weights, window))
    queues = spark.createDataFrame([(r["source"], k) for k, r in enumerate(own)], "s string, queue int")
    of_queue = F.col("source").eqNullSafe(F.col("s"))
    placed = queued(rows).join(F.broadcast(queues), of_queue, "left").drop("s")
    if rest:
        small = rows.select("row", "source", "n").join(F.broadcast(queues), of_queue, "left_anti")
        pooled = schedule(small, window).withColumnRenamed("row", "r")
        placed = placed.join(pooled, F.col("row") == F.col("r"), "left").withColumns({
            "first": F.coalesce("place", "first"), "queue": F.coalesce("queue", F.lit(len(own)))})

    names = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    shape = pa.schema([(c, pa.binary() if c == "ids" else pa.int64()) for c in names])

    def cut(batches):
        for batch in batches:
            held, tokens = [], 0
            for row in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "n", "first", "queue")], batch.column("ids")):
                held.append(row)
                tokens += row[1]
                if tokens > 1 << 20:
                    yield laid_out(held)
                    held, tokens = [], 0
            if held:
                yield laid_out(held)

    def laid_out(rows):
        """The pieces of some documents; a document's pieces follow each other, so all ids are one buffer."""
        found = [list(sent.value.pieces(queue, first, n)) for _, n, first, queue, _ in rows]
        starts, lengths, windows, places = (np.concatenate([p[k] for pieces in found for p in pieces]).astype(np.int64) for k in range(4))
        many = [sum(len(p[0]) for p in pieces) for pieces in found]
        ids = np.concatenate([np.frombuffer(r[4].as_buffer(), "<u4" if wide else "<u2") for r in rows]).astype("<u4")
        offsets = np.concatenate([[0], np.cumsum(lengths * 4)]).astype(np.int32)
        packed = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
        docs = pa.array([r[0] for r in rows], pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), many)))
        sizes = np.repeat(np.array([r[1] for r in rows], np.int64), many)
        return pa.RecordBatch.from_arrays([docs, pa.array(starts), pa.array(lengths), packed, pa.array(sizes), pa.array(windows), pa.array(places)], schema=shape)

    placed = placed.select("doc_id", "n", "ids", "first", "queue")
    return placed.mapInArrow(cut, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
