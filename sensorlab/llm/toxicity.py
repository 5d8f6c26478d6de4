"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's vector is the sum of the vector of its hash and that of the hash of its first four bytes, so inflected forms
share what is learnt. Filters of several widths run over the whole text, each keeps its largest value, and a logistic
layer gives the score. Vectors start from how much more often the word stands in toxic texts; words seen in
too few of the labelled texts have none, so unknown words never add to a score.

Every labelled text teaches, by all its words. The counts of words are one aggregation. The texts are dealt into pieces; in
each of the epochs every piece learns on from the same net, and the net moves by the mean of what the pieces changed,
a word's vector by the mean over the pieces that changed it. Scores of the rows kept back for them set the thresholds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sensorlab.functions.groups import lookup, quantiles, running_totals
from sensorlab.llm.common import filter_rows, in_batches, staged
from sensorlab.llm.labels import fold
from sensorlab.llm.words import ALNUM, LOWER, Lookup, find_words, hash_words, slices, utf8_column

WIDTHS = (1, 2, 3)
FILTERS = 6
SIZE = 4
PAD = max(WIDTHS)
LEAST_TEXTS = 3
PREFIX = 4
#: Labelled texts of a piece, about, and words after which a task starts a new one; it bounds what a task holds.
PIECE_ROWS = 4096
PIECE_WORDS = 4 << 20
#: Words, and prefixes, that have a vector at most. Of more, those whose counts in toxic and other texts differ most have one.
VECTORS = 1 << 19
#: Changes of the net are added up as whole numbers of this part, so that their order doesn't matter.
PART = 2.0**-28


@dataclass
class Net:
    hashes: tuple[np.ndarray, np.ndarray]  # of words and of prefixes, row k + 1 of the vectors
    vectors: list[np.ndarray]  # row 0 is zero
    filters: list[np.ndarray]  # per width: (width, size, filters)
    out: np.ndarray
    bias: float
    thresholds: dict[str, float]


def text_words(column: pa.Array):
    """Yield (first row, last row, hashes of words, hashes of their prefixes, words before each text)."""
    data, offsets = utf8_column(column)
    for first, last in slices(offsets):
        at = offsets[first : last + 1] - offsets[first]
        lowered = LOWER[data[offsets[first] : offsets[last]]]
        starts, ends, before = find_words(lowered, at, ALNUM)
        prefixes = hash_words(lowered, starts, np.minimum(ends, starts + PREFIX))
        yield first, last, hash_words(lowered, starts, ends), np.where(ends - starts > PREFIX, prefixes, np.uint64(0)), before


def taught_rows(docs: DataFrame, labels: DataFrame, learn: Column) -> tuple[DataFrame, DataFrame]:
    """Every labelled text that ``learn`` allows: three quarters as (piece, label, text), staged in an order by hashes, and those
    that only set the thresholds as (lang, label, text).

    A document that is labelled more than once counts with its highest label; null labels don't count.
    """
    marked = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("label")).filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & learn)
    marked = lookup(marked.groupBy("doc_id").agg(F.max("label").alias("label")).withColumn("own", F.pmod(F.xxhash64("doc_id", F.lit("own")), F.lit(4)) != 3))
    pieces = -(-marked.filter("own").count() // PIECE_ROWS) or 1
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), lang.alias("lang"))
    place = F.xxhash64("doc_id", "text")
    own = texts.join(marked.filter("own"), "doc_id").withColumn("piece", F.pmod(place, F.lit(pieces)).cast("int"))
    dealt = own.repartitionById(pieces, F.col("piece")).sortWithinPartitions("piece", place, "doc_id", "text")
    return staged(dealt.select("piece", "label", "text"), "taught"), texts.join(marked.filter("NOT own"), "doc_id").select("lang", "label", "text")


def word_counts(own: DataFrame) -> DataFrame:
    """Per word (kind 0) and prefix (kind 1) its hash, the texts that hold it and how many of them have label 1."""
    shape = pa.schema([("kind", pa.int32()), ("hash", pa.int64()), ("texts", pa.int64()), ("ones", pa.int64())])

    def count(batch):
        labels = batch.column("label").to_numpy()
        for first, last, h, p, before in text_words(batch.column("text")):
            for kind, hashes in enumerate((h, p)):
                each = [np.unique(hashes[before[k] : before[k + 1]]) for k in range(last - first)]
                where = np.repeat(labels[first:last], [len(x) for x in each])
                known, place, texts = np.unique(np.concatenate(each), return_inverse=True, return_counts=True)
                ones = np.bincount(place, weights=where, minlength=len(known))
                yield {"kind": np.full(len(known), kind, np.int32), "hash": known.view(np.int64), "texts": texts, "ones": ones.astype(np.int64)}

    found = own.select("label", "text").mapInArrow(in_batches(count, shape), "kind int, hash long, texts long, ones long")
    return found.filter("hash <> 0").groupBy("kind", "hash").agg(F.sum("texts").alias("texts"), F.sum("ones").alias("ones")).filter(F.col("texts") >= LEAST_TEXTS)


def odds(own: DataFrame, rows: int, ones: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of words and of prefixes: the hashes that stand in enough texts, in order, and their log odds to stand in a text of label 1."""
    ratio = F.log((F.col("ones") + 0.2) / F.lit(ones + 0.4)) - F.log((F.col("texts") - F.col("ones") + 0.2) / F.lit(rows - ones + 0.4))
    # Equal evidence is told apart by the hash.
    evidence = ratio * ratio * F.col("texts") * (1 + F.pmod("hash", F.lit(1 << 20)) / F.lit(float(1 << 40)))
    counts = lookup(word_counts(own).withColumns({"ratio": ratio, "evidence": evidence}))
    out = []
    for kind in (0, 1):
        some = counts.filter(F.col("kind") == kind)
        many = some.count()
        if many > VECTORS:
            cut = quantiles(some, ["evidence"], [1 - VECTORS / many]).first()["value"]
            some = some.filter(F.col("evidence") > cut)
        found = some.select("hash", "ratio").toArrow()  # at most VECTORS rows
        hashes = found.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        out.append((hashes[order], found.column("ratio").to_numpy()[order]))
    return out


def learn(params: list[np.ndarray], speed: list[np.ndarray], found: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, order: np.ndarray, rate: float) -> None:
    """Adaptive gradient steps, one text at a time. ``params``: vectors of words and of prefixes, filters, and out with the bias."""
    vectors, filters, last = params[:2], params[2:-1], params[-1]
    out = last[:-1]
    for k in order:
        ids = [np.concatenate([r, np.zeros(PAD, r.dtype)]) for r in found[k]]
        x, n = vectors[0][ids[0]] + vectors[1][ids[1]], len(found[k][0])
        tops, places = [], []
        for f, w in zip(filters, WIDTHS):
            z = sum(x[o : n + 1 + o] @ f[o] for o in range(w))
            places.append(z.argmax(0))
            tops.append(z[places[-1], np.arange(FILTERS)])
        top = np.concatenate(tops)
        error = 1 / (1 + np.exp(-np.clip(top @ out + last[-1], -30, 30))) - labels[k]
        if abs(error) < 0.002:
            continue
        back = error * out
        grads, moved = [np.zeros_like(f) for f in filters], np.zeros_like(x)
        for i, (f, w) in enumerate(zip(filters, WIDTHS)):
            g = back[i * FILTERS : (i + 1) * FILTERS]
            for o in range(w):
                grads[i][o] = (x[places[i] + o] * g[:, None]).T
                np.add.at(moved, places[i] + o, (f[o] * g).T)
        for f, g, s in zip(filters, grads, speed[2:-1]):
            s += g * g
            f -= rate * g / np.sqrt(s)
        g = np.append(error * top + 1e-4 * out, error)
        speed[-1] += g * g
        last -= rate * g / np.sqrt(speed[-1])
        touched = np.flatnonzero(np.abs(moved).sum(1) > 0)
        for v, s, r in zip(vectors, speed, ids):
            for t in touched[r[touched] > 0]:
                s[r[t]] += moved[t] ** 2
                v[r[t]] -= rate * moved[t] / np.sqrt(s[r[t]])


def pieces(batches: Iterator[pa.RecordBatch], known: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[int, int, list, np.ndarray]]:
    """Yield (piece, part of it, rows of the vectors of every text, labels); a piece of very long texts comes in parts."""
    lookups = [Lookup(k) for k in known]
    piece, part, found, labels, words = None, 0, [], [], 0
    for batch in batches:
        of, label = batch.column("piece").to_numpy(), batch.column("label").to_numpy().astype(np.float64)
        for first, last, h, p, before in text_words(batch.column("text")):
            rows = [look(x).astype(np.int32) for look, x in zip(lookups, (h, p))]
            for k in range(last - first):
                if found and (of[first + k] != piece or words >= PIECE_WORDS):
                    yield piece, part, found, np.array(labels)
                    part, found, labels, words = part + 1 if of[first + k] == piece else 0, [], [], 0
                piece = int(of[first + k])
                found.append(tuple(r[before[k] : before[k + 1]].copy() for r in rows))
                labels.append(label[first + k])
                words += before[k + 1] - before[k]
    if found:
        yield piece, part, found, np.array(labels)


#: The net's arrays as rows of SIZE numbers: ``part`` 0 and 1 are the vectors, 2 is all others together.
_CHANGE = [*(f"v{k}" for k in range(SIZE)), *(f"s{k}" for k in range(SIZE))]


def as_rows(arrays: list[np.ndarray]) -> list[np.ndarray]:
    rest = np.concatenate([a.ravel() for a in arrays[2:]])
    return [*arrays[:2], np.append(rest, np.zeros(-len(rest) % SIZE)).reshape(-1, SIZE)]


def from_rows(rows: list[np.ndarray], like: list[np.ndarray]) -> list[np.ndarray]:
    rest, at, out = rows[2].ravel(), 0, rows[:2]
    for a in like[2:]:
        out, at = [*out, rest[at : at + a.size].reshape(a.shape)], at + a.size
    return out


def epoch(own: DataFrame, known: tuple[np.ndarray, np.ndarray], params: list[np.ndarray], speed: list[np.ndarray], rate: float, seed: tuple[int, int]):
    """The parameters and their speeds after every piece has learnt once from those given."""
    sent = own.sparkSession.sparkContext.broadcast((known, params, speed))
    shape = pa.schema([("part", pa.int32()), ("row", pa.int32()), *[(c, pa.int64()) for c in _CHANGE]])

    def run(batches):
        known, params, speed = sent.value
        before = [np.hstack(x) for x in zip(as_rows(params), as_rows(speed))]
        for piece, part, found, labels in pieces(batches, known):
            p, s = [x.copy() for x in params], [x.copy() for x in speed]
            learn(p, s, found, labels, np.random.default_rng([*seed, piece, part]).permutation(len(found)), rate)
            for kind, (old, new) in enumerate(zip(before, map(np.hstack, zip(as_rows(p), as_rows(s))))):
                rows = np.flatnonzero((old != new).any(axis=1)) if kind < 2 else np.arange(len(old))
                change = np.round((new[rows] - old[rows]) / PART).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"part": np.full(len(rows), kind, np.int32), "row": rows.astype(np.int32), **dict(zip(_CHANGE, change.T))}, schema=shape)

    changed = own.select("piece", "label", "text").mapInArrow(run, "part int, row int, " + ", ".join(f"{c} long" for c in _CHANGE))
    sums = changed.groupBy("part", "row").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in _CHANGE]).toArrow()  # as many rows as the net has
    sent.unpersist()
    after = [np.hstack(x) for x in zip(as_rows(params), as_rows(speed))]
    part, row, n = (sums.column(c).to_numpy() for c in ("part", "row", "n"))
    change = np.stack([sums.column(c).to_numpy() for c in _CHANGE], axis=1) * PART / n[:, None]
    for kind, rows in enumerate(after):
        rows[row[part == kind]] += change[part == kind]
    return from_rows([a[:, :SIZE].copy() for a in after], params), from_rows([a[:, SIZE:].copy() for a in after], speed)


def fit(own: DataFrame, kept: DataFrame = None, epochs: int = 4, rate: float = 0.05, seed: int = 1) -> Net:
    """Fit on the texts of ``own``, piece by piece; the texts of ``kept`` set the thresholds of their languages."""
    rows, ones = own.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    rng = np.random.default_rng(seed)
    known, vectors = [], []
    for hashes, ratio in odds(own, rows, ones):
        start = np.zeros((len(hashes) + 1, SIZE))
        start[1:] = rng.normal(0, 0.05, (len(hashes), SIZE))
        start[1:, 0] = ratio / 2
        known.append(hashes)
        vectors.append(start)
    filters = [rng.normal(0, 0.15, (w, SIZE, FILTERS)) for w in WIDTHS]
    for f in filters:
        f[0, 0] += 0.7
    base = np.clip(ones / rows if rows else 0.0, 0.01, 0.99)
    params = [*vectors, *filters, np.append(np.full(len(WIDTHS) * FILTERS, 0.1), float(np.log(base / (1 - base))) - 1.0)]
    speed = [np.full_like(p, 1e-2) for p in params]
    for number in range(epochs if rows else 0):
        params, speed = epoch(own, tuple(known), params, speed, rate, (seed, number))
    net = Net(tuple(known), params[:2], params[2:-1], params[-1][:-1], float(params[-1][-1]), {})
    if kept is not None:
        net.thresholds = calibrate(kept, net)
    return net


def score(net: Net, column: pa.Array, lookups=None) -> np.ndarray:
    """The score of every text of a string column."""
    lookups = lookups or [Lookup(k) for k in net.hashes]
    vectors = [v.astype(np.float32) for v in net.vectors]
    out = []
    for first, last, h, p, before in text_words(column):
        n = last - first
        x = np.zeros((len(h) + PAD * (n + 1), SIZE), np.float32)
        place = np.arange(len(h)) + PAD * np.repeat(np.arange(n), np.diff(before))
        x[place] = vectors[0][lookups[0](h)] + vectors[1][lookups[1](p)]
        begin = before[:-1] + PAD * np.arange(n)
        cuts = np.column_stack([begin, begin + np.diff(before) + 1]).ravel()
        rows = len(x) - PAD + 1
        tops = []
        for f, w in zip(net.filters, WIDTHS):
            z = sum(x[o : rows + o] @ f[o].astype(np.float32) for o in range(w))
            tops.append(np.maximum.reduceat(z, cuts, axis=0)[::2])
        logit = np.concatenate(tops, axis=1).astype(np.float64) @ net.out + net.bias
        out.append(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
    return np.concatenate(out) if out else np.zeros(0)


def calibrate(kept: DataFrame, net: Net, default: float = 0.3, least: int = 5) -> dict[str, float]:
    """Per language the threshold with the best F1 on the rows, midway between two scores; "" is for all others."""
    sent = kept.sparkSession.sparkContext.broadcast(net)
    shape = pa.schema([("lang", pa.string()), ("score", pa.float64()), ("label", pa.int32())])

    def run(batch):
        yield {"lang": batch.column("lang"), "score": score(sent.value, batch.column("text")), "label": batch.column("label")}

    scored = kept.select("lang", "label", "text").mapInArrow(in_batches(run, shape), "lang string, score double, label int")
    counts = lookup(scored.groupBy("lang", "score").agg(F.sum("label").alias("ones"), F.count(F.lit(1)).alias("rows")))
    sizes = counts.groupBy("lang").agg(F.sum("ones").alias("_ones"), F.sum("rows").alias("_rows")).filter(F.least("_ones", F.col("_rows") - F.col("_ones")) >= least)
    upto = running_totals(counts, "score", {"_hits": "ones", "_above": "rows"}, ["lang"], ascending=False).join(lookup(sizes), "lang")
    f1 = 2 * F.col("_hits") / (F.col("_above") + F.col("_ones"))
    best = lookup(upto.groupBy("lang").agg(F.max(F.struct(f1.alias("f1"), F.col("score").alias("best"))).alias("m")).select("lang", "m.best"))
    below = F.coalesce(F.max(F.when(F.col("score") < F.col("best"), F.col("score"))), F.lit(0.0))
    found = counts.join(best, "lang").groupBy("lang", "best").agg(below.alias("below")).collect()  # a row for each language
    return {"": default} | {r["lang"]: (r["best"] + r["below"]) / 2 for r in found}


def score_toxicity(docs: DataFrame, labels: DataFrame, parts: int = 4, held: int = 2, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document: doc_id, the columns in ``keep``, held_out, score, predicted (score of 0.3 or more), threshold and rejected.

    The net learns from all labelled rows whose fold isn't ``held``, and only from them. Whole texts teach and are scored.
    ``threshold`` is that of the document's language and ``rejected`` whether the score reaches it; languages with few
    labelled rows, and null ones, use 0.3. Null and empty texts get the score of a text without known words; without
    labels that is all that is known; repeated rows stay; an empty table gives no rows.
    """
    own, kept = taught_rows(docs, labels, fold(parts) != held)
    net = fit(own, kept if "lang" in docs.columns else None)
    sent = docs.sparkSession.sparkContext.broadcast(net)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    rows = docs.select(F.col("doc_id").cast("long"), *[c for c in keep if c != "doc_id"], (fold(parts) == held).alias("held_out"),
                       lang.alias("_lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

    shape = StructType([*rows.schema.fields[:-2], StructField("score", DoubleType()), StructField("predicted", IntegerType()),
                        StructField("threshold", DoubleType()), StructField("rejected", BooleanType())])

    names = rows.columns[:-2]

    def run(batch):
        found = score(sent.value, batch.column("_text")) if batch.num_rows else np.zeros(0)
        limits = sent.value.thresholds
        least = np.array([limits.get(x, limits.get("", 0.3)) for x in batch.column("_lang").to_pylist()])
        yield {c: batch.column(c) for c in names} | {
            "score": found, "predicted": (found >= 0.3).astype(np.int32), "threshold": least, "rejected": found >= least}

    return rows.mapInArrow(in_batches(run, to_arrow_schema(shape)), shape)


def drop_toxic(docs: DataFrame, labels: DataFrame, parts: int = 4, held: int = 2) -> DataFrame:
    """The documents, with all their columns, whose score doesn't reach the threshold of their language."""
    net = fit(*taught_rows(docs, labels, fold(parts) != held))
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def clean(batch):
        if not batch.num_rows:
            return np.zeros(0, bool)
        limits = sent.value.thresholds
        least = np.array([limits.get(x or "", limits.get("", 0.3)) for x in batch.column("lang").to_pylist()])
        return score(sent.value, batch.column("text")) < least

    return filter_rows(docs, clean)
