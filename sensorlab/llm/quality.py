"""Quality: a factorisation machine over hashed words, structure statistics and metadata, trained in numpy.

The score's logit is w0 + sum w_i x_i + half the sum over factors of (sum v_i x_i)^2 - sum v_i^2 x_i^2, so all
pairwise interactions cost time in proportion to the features of a text. A word's value is its part of the text's
words; structure statistics come from the whole text; metadata is the table's own length column.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sensorlab.llm.common import in_batches
from sensorlab.llm.labels import FIT_ROWS, fitted, fold, labelled_sample
from sensorlab.llm.words import LOWER, NOT_SPACE, find_words, hash_words, mix, slices, utf8_column

WORD_BITS = 16
FACTORS = 4

NOT_LINE_END = np.ones(256, bool)
NOT_LINE_END[10] = False
#: Byte classes whose part of the text is a statistic.
CLASSES = {
    "upper": (65, 91), "lower": (97, 123), "digit": (48, 58), "space": (32, 33), "beyond": (128, 256), "mark": (33, 48), "bar": (124, 125),
    "colon": (58, 65), "bracket": (91, 97), "control": (0, 32),
}
STATISTICS = [*CLASSES, "log_words", "word_bytes", "distinct_words", "log_lines", "distinct_lines", "line_words", "marks_in_words", "log_length", "no_length"]


@dataclass
class Machine:
    centre: np.ndarray
    spread: np.ndarray
    w0: float
    w: np.ndarray  # of words, then of statistics
    v: np.ndarray


def features(column: pa.Array, lengths: pa.Array):
    """Yield per text (row, buckets of words, their parts, statistics)."""
    data, offsets = utf8_column(column)
    stated = np.array([-1.0 if x is None else float(x) for x in lengths.to_pylist()])
    for first, last in slices(offsets):
        at = offsets[first : last + 1] - offsets[first]
        raw = data[offsets[first] : offsets[last]]
        size = np.maximum(np.diff(at), 1)
        parts = []
        for low, high in CLASSES.values():
            running = np.zeros(len(raw) + 1, np.int32)
            np.cumsum((raw >= low) & (raw < high), out=running[1:], dtype=np.int32)
            parts.append((running[at[1:]] - running[at[:-1]]) / size)
        lowered = LOWER[raw]
        starts, ends, before = find_words(lowered, at, NOT_SPACE)
        hashes = hash_words(lowered, starts, ends)
        bucket = (mix(hashes) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
        line_starts, line_ends, lines_before = find_words(lowered, at, NOT_LINE_END)
        lines = hash_words(lowered, line_starts, line_ends)
        ends_marked = ~((lowered[ends - 1] >= 97) & (lowered[ends - 1] < 123) | (lowered[ends - 1] >= 128)) if len(ends) else np.zeros(0, bool)
        marked = np.concatenate([[0], np.cumsum(ends_marked)])
        for k in range(last - first):
            a, b = before[k], before[k + 1]
            c, d = lines_before[k], lines_before[k + 1]
            found, counts = np.unique(bucket[a:b], return_counts=True)
            n, rows = max(b - a, 1), max(d - c, 1)
            told = stated[first + k]
            yield first + k, found, counts / n, np.array([
                *(p[k] for p in parts), np.log1p(b - a), (ends[a:b] - starts[a:b]).sum() / n, len(found) / n, np.log1p(d - c),
                len(np.unique(lines[c:d])) / rows, np.log1p(n / rows), (marked[b] - marked[a]) / n, np.log1p(max(told, 0.0)), float(told < 0)])


def fit(sample: pa.Table, epochs: int = 6, rate: float = 0.05, decay: float = 1e-5, seed: int = 1) -> Machine:
    """Fit on a sample (text, n_chars, label) by adaptive gradient steps, one text at a time."""
    labels = sample.column("label").to_numpy().astype(np.float64)
    rows = list(features(sample.column("text"), sample.column("n_chars")))
    n = 1 << WORD_BITS
    stats = np.array([r[3] for r in rows]).reshape(len(rows), len(STATISTICS))
    centre, spread = (stats.mean(0), np.maximum(stats.std(0), 1e-3)) if len(rows) else (np.zeros(len(STATISTICS)), np.ones(len(STATISTICS)))
    rng = np.random.default_rng(seed)
    base = np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99)
    m = Machine(centre, spread, float(np.log(base / (1 - base))), np.zeros(n + len(STATISTICS)), rng.normal(0, 0.01, (n + len(STATISTICS), FACTORS)))
    gw, gv, g0 = np.full(len(m.w), 1e-2), np.full(m.v.shape, 1e-2), 1e-2
    dense = n + np.arange(len(STATISTICS))
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            _, found, part, stat = rows[k]
            ids = np.concatenate([found, dense])
            x = np.concatenate([part, np.clip((stat - centre) / spread, -5, 5)])
            vx = m.v[ids] * x[:, None]
            total = vx.sum(0)
            logit = m.w0 + m.w[ids] @ x + 0.5 * (total @ total - (vx * vx).sum())
            error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[k]
            g0 += error * error
            m.w0 -= rate * error / np.sqrt(g0)
            g = error * x + decay * m.w[ids]
            gw[ids] += g * g
            m.w[ids] -= rate * g / np.sqrt(gw[ids])
            h = error * (x[:, None] * total - vx * x[:, None]) + decay * m.v[ids]
            gv[ids] += h * h
            m.v[ids] -= rate * h / np.sqrt(gv[ids])
    return m


def score(m: Machine, column: pa.Array, lengths: pa.Array) -> np.ndarray:
    n, out = 1 << WORD_BITS, np.zeros(len(column))
    for row, found, part, stat in features(column, lengths):
        s = np.clip((stat - m.centre) / m.spread, -5, 5)
        words, stats = m.v[found] * part[:, None], m.v[n:] * s[:, None]
        total = words.sum(0) + stats.sum(0)
        out[row] = m.w0 + m.w[found] @ part + m.w[n:] @ s + 0.5 * (total @ total - (words * words).sum() - (stats * stats).sum())
    return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def score_quality(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (score of 0.3 or more).

    The machine learns only from labelled rows whose fold isn't ``held``, at most ``fit_rows``; the whole text is
    scored. Null and empty texts are scored by their statistics; a missing or null n_chars is a statistic of its own;
    without labels every score is near 0.5; repeated rows stay; an empty table gives no rows; other columns play no part.
    """
    length = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    docs = docs.select("doc_id", "text", length.alias("n_chars"))
    machine = fitted(labelled_sample(docs, labels, "quality", fold(parts) != held, fit_rows, ("n_chars",)), fit)
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    shape = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batch):
        found = score(sent.value, batch.column("text"), batch.column("n_chars"))
        yield {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": found, "predicted": (found >= 0.3).astype(np.int32)}

    rows = docs.select(F.col("doc_id").cast("long"), (fold(parts) == held).alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), "n_chars")
    return rows.mapInArrow(in_batches(run, shape), "doc_id long, held_out boolean, score double, predicted int")
