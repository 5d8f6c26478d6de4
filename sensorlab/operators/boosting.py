"""Many boosted-tree classifiers at once, grown level by level from shared histograms.

A model is a pair of a group and a setting. Every row belongs to one group and takes part in all settings, so a grid
search over folds is one group with many settings, and models by zone and period are many groups with one setting. Rows
are binned once into blocks. A step is one job over all models: each task adds up the gradients of its blocks by model, node, feature and
bin, the sums meet by (model, node), and only the chosen splits come to the driver. Models don't wait for each other: a
model whose tree is done starts its next one while others still split. Fewer trees of a setting are a prefix of its
longest run, so the number of trees is read off one run.

Trees are second-order: a leaf's value is -rate * G / (H + 1), a split needs a positive gain and a hessian of 1 on both
sides. Draws of rows and columns depend on the row's key and the tree's number only.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sensorlab.functions.groups import with_models
from sensorlab.session import stage

#: Bins of a feature at most, rows of a block, finished trees that wait until they are added to the staged margins.
BINS = 64
BLOCK_ROWS = 4096
PENDING = 8
#: Binned rows that are sent to all tasks at most.
SENT_BYTES = 32 << 20
PENALTY, LEAST_HESSIAN, LEAST_GAIN = 1.0, 1.0, 1e-6

BLOCK = "n int, groups binary, labels binary, folds binary, draws binary, bins binary, margins binary, tallies binary"
_SCHEMA = pa.schema([("n", pa.int32()), *[(c, pa.binary()) for c in ("groups", "labels", "folds", "draws", "bins", "margins", "tallies")]])


@dataclass(frozen=True)
class Setting:
    """``held``: the fold that doesn't teach (-1: none); ``columns``: the share of features that each tree draws."""

    trees: int = 100
    rate: float = 0.1
    depth: int = 5
    rows: float = 1.0
    columns: float = 1.0
    held: int = -1

    def drawn(self, features: int) -> int:
        return max(1, int(self.columns * features + 1e-9))


@dataclass
class Tree:
    """Nodes as in a heap: feature (-1: leaf), bin up to which rows go left, value."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray


@dataclass
class Boosted:
    """The trees of every model (group * settings + setting), and counts of held-out rows by model and tree number."""

    trees: list[list[Tree]]
    tallies: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)


# --- binning ----------------------------------------------------------------------------------

def bin_edges(df: DataFrame, features, by=(), bins: int = BINS, accuracy: int = 10_000) -> dict[tuple, list[list[float]]]:
    """Per group and feature the values that cut it into bins; a row goes left of an edge if it isn't above it.

    Half of the edges cut the group's rows into about equal counts, half cut its range into equal widths, so that a wide
    gap between two kinds of rows has an edge inside it.
    """
    probs = [k / (bins // 2) for k in range(1, bins // 2)]
    parts = []
    for i, f in enumerate(features):
        v = F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double"))
        parts += [F.percentile_approx(v, probs, accuracy).alias(f"e{i}"), F.min(v).alias(f"a{i}"), F.max(v).alias(f"b{i}")]
    out = {}
    for row in df.groupBy(*by).agg(*parts).collect():  # a row for each group
        cuts = []
        for i in range(len(features)):
            low, high = row[f"a{i}"], row[f"b{i}"]
            even = [] if low is None else [low + (high - low) * k / (bins // 2) for k in range(1, bins // 2)]
            cuts.append(sorted(e for e in {*(row[f"e{i}"] or []), *even} if low <= e < high))
        out[tuple(row[b] for b in by)] = cuts
    return out


def row_blocks(df: DataFrame, features, edges: list[list[list[float]]], label: str, fold: Column, key: Column, group: Column = None, settings: int = 1) -> DataFrame:
    """Rows as blocks of bins, label (0/1), fold and a draw of their key; margins start at 0.

    ``edges`` are those of each group number. A missing value is in the lowest bin.
    """
    spark = df.sparkSession
    numbers = [F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)]
    rows = df.select(
        (F.lit(0) if group is None else group).cast("int").alias("group"), F.col(label).cast("int").alias("label"),
        fold.cast("int").alias("fold"), F.xxhash64(key).alias("draw"), *numbers)
    sent = spark.sparkContext.broadcast([[np.array(e) for e in cuts] for cuts in edges])
    wide = len(features)

    def pack(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(first, BLOCK_ROWS)
                n = part.num_rows
                whole = lambda c, kind: part.column(c).fill_null(0).to_numpy(zero_copy_only=False).astype(kind)
                groups, bins = whole("group", np.int32), np.empty((n, wide), np.uint8)
                values = [part.column(f"f{i}").fill_null(-np.inf).to_numpy(zero_copy_only=False) for i in range(wide)]
                for g in np.unique(groups):
                    own = np.flatnonzero(groups == g)
                    for i, (e, x) in enumerate(zip(sent.value[g], values)):
                        bins[own, i] = np.searchsorted(e, np.where(np.isnan(x[own]), -np.inf, x[own]), side="left")
                yield pa.RecordBatch.from_pydict({
                    "n": [n], "groups": [groups.tobytes()], "labels": [whole("label", np.uint8).tobytes()], "folds": [whole("fold", np.int16).tobytes()],
                    "draws": [whole("draw", np.int64).tobytes()], "bins": [bins.tobytes()],
                    "margins": [np.zeros((n, settings), np.float32).tobytes()], "tallies": [b""]}, schema=_SCHEMA)

    # As many files as there are cores at least, so that every step keeps them busy.
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return stage(rows.repartition(tasks).mapInArrow(pack, BLOCK))


# --- inside a task ----------------------------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn_rows(draws: np.ndarray, trees: np.ndarray, shares: np.ndarray, seed: int) -> np.ndarray:
    """Whether each row (first axis) takes part in the tree of that number of each model (second axis)."""
    step = (trees.astype(np.uint64) + np.uint64(seed) * np.uint64(1_000_003) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    u = _mixed(draws.view(np.uint64)[:, None] ^ _mixed(step)) >> np.uint64(11)
    return u.astype(float) * 2.0**-53 < shares


def drawn_columns(tree: int, count: int, features: int, seed: int) -> np.ndarray:
    chosen = np.zeros(features, bool)
    chosen[np.random.default_rng([seed, tree, count]).permutation(features)[:count]] = True
    return chosen


class _Block:
    def __init__(self, row: dict, features: int, settings: int):
        self.n = row["n"]
        read = lambda c, kind: np.frombuffer(row[c], kind)
        self.groups, self.labels, self.folds = read("groups", np.int32), read("labels", np.uint8), read("folds", np.int16)
        self.draws, self.bins = read("draws", np.int64), read("bins", np.uint8).reshape(self.n, features)
        self.margins = read("margins", np.float32).reshape(self.n, settings).copy()
        self.models = self.groups[:, None] * settings + np.arange(settings, dtype=np.int32)
        self.first = np.arange(self.n, dtype=np.int64)[:, None] * features
        self.flat, self.columns = self.bins.ravel(), np.ascontiguousarray(self.bins.T)
        self.alone = self.n > 0 and bool((self.groups == self.groups[0]).all())

    def walk(self, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """The node of every row in every setting's tree; trees are rows of the arrays."""
        if self.alone:
            return np.stack([self.nodes_of(feature[m], cut[m]) for m in self.models[0]], axis=1)
        nodes = feature.shape[1]
        feature, cut, base = feature.ravel(), cut.ravel(), self.models.astype(np.int64) * nodes
        at = base.copy()
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                return at - base
            right = self.flat[self.first + np.maximum(f, 0)] > cut[at]
            at = np.where(inner, base + 2 * (at - base) + 1 + right, at)

    def nodes_of(self, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """The node of every row in one tree: each inner node deals its rows to its children."""
        at, todo = np.zeros(self.n, np.int64), [(0, None)]
        while todo:
            node, rows = todo.pop()
            if feature[node] >= 0:
                bins = self.columns[feature[node]]
                right = (bins if rows is None else bins[rows]) > cut[node]
                for child, go in ((2 * node + 1, ~right), (2 * node + 2, right)):
                    todo.append((child, np.flatnonzero(go) if rows is None else rows[go]))
            elif rows is not None:
                at[rows] = node
        return at

    def add(self, trees: tuple) -> None:
        feature, cut, value = trees
        node = self.walk(feature, cut)
        self.margins += value[self.models, node]

    def add_counted(self, late: list, added: np.ndarray, ends: np.ndarray, held: np.ndarray, counts_at: tuple) -> list:
        """Adds waiting trees; after the tree numbers asked for, (number, model, 2 * label + predicted, n) of held-out rows."""
        out = []
        for k, t in enumerate(late):
            self.add(t)
            for number in counts_at:
                here = (added + k + 1 == number) & (ends >= number)
                if here.any():
                    i, j = np.nonzero(here[self.models] & (self.folds[:, None] == held))
                    kind = self.labels[i].astype(np.int64) * 2 + (self.margins[i, j] > 0)
                    model, many = np.unique(self.models[i, j].astype(np.int64) * 4 + kind, return_counts=True)
                    out.append(np.stack([np.full(len(model), number), model // 4, model % 4, many], axis=1))
        return out

    def catch_up(self, run: _Run, added: np.ndarray, counts_at: tuple) -> list:
        ends = run.lengths()
        return self.add_counted(run.waiting(added), added, ends, run.held, counts_at) if (ends > added).any() else []


def _blocks(batches, features, settings):
    for batch in batches:
        for row in batch.to_pylist():
            yield row, _Block(row, features, settings)


def _packed(trees: list[Tree | None], shared: int = 1) -> tuple:
    """Trees as three arrays, one row for each; None is a tree that adds nothing."""
    nodes = max([shared, *(len(t.feature) for t in trees if t is not None)])
    feature, cut, value = np.full((len(trees), nodes), -1, np.int16), np.zeros((len(trees), nodes), np.uint8), np.zeros((len(trees), nodes), np.float32)
    for i, t in enumerate(trees):
        if t is not None:
            m = len(t.feature)
            feature[i, :m], cut[i, :m], value[i, :m] = t.feature, t.bin, t.value
    return feature, cut, value


def best_split(sums: np.ndarray, starts: np.ndarray, columns: np.ndarray) -> tuple:
    """Gain, feature, bin, and the gradient and hessian sums of the left side, from a node's (bins of all features, 2) sums."""
    g, h = sums[: starts[1]].sum(axis=0)  # all rows are in some bin of the first feature
    best = (0.0, -1, 0, 0.0, 0.0)
    whole = g * g / (h + PENALTY)
    widths, found = np.diff(starts), {}
    for width in np.unique(widths[columns]):  # features of equal widths together
        some = np.flatnonzero(columns & (widths == width))
        left = np.cumsum(sums[starts[some][:, None] + np.arange(width - 1)], axis=1)
        if not left.size:
            continue
        gl, hl = left[..., 0], left[..., 1]
        gr, hr = g - gl, h - hl
        gain = gl * gl / (hl + PENALTY) + gr * gr / (hr + PENALTY) - whole
        gain[(hl < LEAST_HESSIAN) | (hr < LEAST_HESSIAN)] = 0.0
        for i, (f, k) in enumerate(zip(some, gain.argmax(axis=1))):
            found[int(f)] = (float(gain[i, k]), int(f), int(k), float(gl[i, k]), float(hl[i, k]))
    for f in sorted(found):
        if found[f][0] > best[0]:
            best = found[f]
    return best, float(g), float(h)


# --- the steps --------------------------------------------------------------------------------

class _Growing:
    """A model's tree at hand: split nodes, open nodes, leaves."""

    def __init__(self):
        self.feature, self.bin, self.value, self.open = {}, {}, {}, {0}

    def level(self) -> int:
        return (min(self.open) + 1).bit_length() - 1

    def split(self, node: int, setting: Setting, best: tuple, g: float, h: float) -> None:
        self.open.discard(node)
        gain, f, cut, gl, hl = best
        leaf = lambda g, h: -setting.rate * g / (h + PENALTY)
        if f < 0 or gain <= LEAST_GAIN:
            self.value[node] = leaf(g, h)
            return
        self.feature[node], self.bin[node] = f, cut
        deeper = (node + 1).bit_length() < setting.depth
        for child, cg, ch in ((2 * node + 1, gl, hl), (2 * node + 2, g - gl, h - hl)):
            if deeper and ch >= 2 * LEAST_HESSIAN:
                self.open.add(child)
            else:
                self.value[child] = leaf(cg, ch)

    def tree(self) -> Tree:
        n = 1 + max([0, *self.feature, *self.value, *self.open])
        out = Tree(np.full(n, -1, np.int16), np.zeros(n, np.uint8), np.zeros(n, np.float32))
        for k, f in self.feature.items():
            out.feature[k], out.bin[k] = f, self.bin[k]
        for k, v in self.value.items():
            out.value[k] = v
        return out


class _Run:
    """What a set of models has grown so far, and the step it asks for next."""

    def __init__(self, widths: list[int], settings: list[Setting], weights: np.ndarray, seed: int):
        self.widths, self.settings, self.weights, self.seed = widths, settings, weights, seed
        self.features, self.starts = len(widths), np.concatenate([[0], np.cumsum(widths)]).astype(np.int64)
        self.models = len(weights) * len(settings)
        self.trees: list[list[Tree]] = [[] for _ in range(self.models)]
        self.growing = {m: _Growing() for m in range(self.models) if weights[m // len(settings)] > 0 and self.of(m).trees > 0}
        self.held, self.share = np.array([s.held for s in settings]), np.array([s.rows for s in settings])

    def of(self, m: int) -> Setting:
        return self.settings[m % len(self.settings)]

    def lengths(self) -> np.ndarray:
        return np.array([len(t) for t in self.trees], np.int64)

    def waiting(self, added: np.ndarray) -> list[tuple]:
        """The trees that aren't in the margins yet, the first one of every model, the second one, and so on."""
        most = int((self.lengths() - added).max(initial=0))
        return [_packed([t[a + k] if a + k < len(t) else None for t, a in zip(self.trees, added)]) for k in range(most)]

    def step(self) -> tuple:
        """The trees at hand, the number of every open node, numbers of the trees, and (model, node) of the open nodes."""
        slots = [(m, node) for m, tree in self.growing.items() for node in sorted(tree.open)]
        partial = _packed([self.growing[m].tree() if m in self.growing else None for m in range(self.models)])
        slot_of = np.full(partial[0].shape, -1, np.int32)
        for k, (m, node) in enumerate(slots):
            slot_of[m, node] = k
        return partial, slot_of, self.lengths(), slots

    def sums(self, block: _Block, step: tuple) -> np.ndarray:
        """Gradient and hessian of a block's rows by open node and bin."""
        partial, slot_of, numbers, slots = step
        many = len(slots)
        total = np.zeros((many, self.starts[-1], 2))
        slot = slot_of[block.models, block.walk(partial[0], partial[1])]
        taking = (slot >= 0) & (block.folds[:, None] != self.held)
        if (self.share < 1).any():
            taking &= drawn_rows(block.draws, numbers[block.models], self.share, self.seed)
        row, column = np.nonzero(taking)
        slot = slot[row, column].astype(np.int64)
        p = 1 / (1 + np.exp(-block.margins[row, column].astype(float)))
        y = block.labels[row]
        w = np.where(y == 1, self.weights[block.groups[row]], 1.0)
        g, h = (p - y) * w, np.maximum(p * (1 - p), 1e-16) * w
        base = {width: slot * width for width in set(self.widths)}
        for f, (first, width) in enumerate(zip(self.starts, self.widths)):
            place = base[width] + block.columns[f][row]
            for k, v in enumerate((g, h)):
                total[:, first : first + width, k] += np.bincount(place, v, many * width).reshape(many, width)
        return total

    def best(self, m: int, number: int, sums: np.ndarray) -> tuple:
        return best_split(sums, self.starts, drawn_columns(number, self.of(m).drawn(self.features), self.features, self.seed))

    def split(self, slots: list, found: dict[int, tuple]) -> None:
        """Takes the splits of the open nodes; trees without open nodes are done. A node that no row reached is a leaf of 0."""
        for k, (m, node) in enumerate(slots):
            self.growing[m].split(node, self.of(m), *found.get(k, ((0.0, -1, 0, 0.0, 0.0), 0.0, 0.0)))
        for m in [m for m, tree in self.growing.items() if not tree.open]:
            self.trees[m].append(self.growing[m].tree())
            if len(self.trees[m]) >= self.of(m).trees:
                del self.growing[m]
            else:
                self.growing[m] = _Growing()


def boost(blocks: DataFrame, widths: list[int], settings: list[Setting], groups: int = 1, weights: np.ndarray = None, counts_at=(), seed: int = 42,
          pending: int = PENDING, sent_bytes: int = SENT_BYTES) -> Boosted:
    """Grow all models on the blocks; ``widths`` are the features' numbers of bins, ``weights`` what a label 1 weighs in each group.

    ``counts_at`` are the tree numbers after which each model's held-out rows are counted: right and wrong ones by label.
    A group weight of 0 leaves the group's models without trees. As with a join's small side, binned rows of up to
    ``sent_bytes`` are sent to tasks that each grow some models; beyond, rows stay where they are and sums travel. The
    steps, and the trees but for rounding, are the same.
    """
    weight = np.ones(groups) if weights is None else np.asarray(weights, float)
    run, counts_at = _Run(widths, settings, weight, seed), tuple(counts_at)
    rows = blocks.agg(F.sum("n")).first()[0] or 0
    if rows * (len(widths) + 16) <= sent_bytes:
        return _boost_sent(blocks, run, counts_at)
    return _boost_dealt(blocks, run, counts_at, pending)


def _boost_sent(blocks: DataFrame, run: _Run, counts_at: tuple) -> Boosted:
    """Models are dealt to the tasks, the binned rows sent whole: they were checked to be few."""
    spark, size = blocks.sparkSession, len(run.settings)
    columns = ("n", "groups", "labels", "folds", "draws", "bins")
    held = blocks.select(*columns).collect()
    whole = {c: b"".join(bytes(r[c]) for r in held) for c in columns[1:]} | {"n": sum(r["n"] for r in held)}
    sent = spark.sparkContext.broadcast((whole, run.widths, run.settings, run.weights, run.seed))
    shape = pa.schema([("model", pa.int32()), ("grown", pa.binary())])

    def grow(batches):
        whole, widths, settings, weights, seed = sent.value
        rows = {"groups": np.int32, "labels": np.uint8, "folds": np.int16, "draws": np.int64}
        rows = {c: np.frombuffer(whole[c], kind) for c, kind in rows.items()}
        bins = np.frombuffer(whole["bins"], np.uint8).reshape(-1, len(widths))
        for batch in batches:
            numbers = np.array(batch.column("model"), np.int64)
            for group in np.unique(numbers // size):
                own = np.flatnonzero(rows["groups"] == group)
                mine = numbers[numbers // size == group]
                few = [settings[m % size] for m in mine]
                some = _Run(widths, few, weights[group : group + 1], seed)
                block = _Block({"n": len(own), "groups": np.zeros(len(own), np.int32), **{c: rows[c][own] for c in ("labels", "folds", "draws")},
                                "bins": bins[own], "margins": np.zeros((len(own), len(few)), np.float32)}, len(widths), len(few))
                tallies, added = [], some.lengths()
                while some.growing:
                    step = some.step()
                    sums = some.sums(block, step)
                    some.split(step[3], {k: some.best(m, step[2][m], sums[k]) for k, (m, _) in enumerate(step[3])})
                    tallies += block.catch_up(some, added, counts_at)
                    added = some.lengths()
                for k, m in enumerate(mine):
                    counts = [(int(number), int(kind), int(n)) for t in tallies for number, model, kind, n in t if model == k]
                    yield pa.RecordBatch.from_pydict({"model": [m], "grown": [pickle.dumps((some.trees[k], counts))]}, schema=shape)

    tasks = 4 * spark.sparkContext.defaultParallelism
    models = spark.createDataFrame([(m,) for m in run.growing], "model int").repartition(max(1, min(tasks, len(run.growing))))
    out = Boosted(run.trees)
    for r in models.mapInArrow(grow, "model int, grown binary").collect():  # the trees, which the caller asked for
        out.trees[r["model"]], counts = pickle.loads(r["grown"])
        for number, kind, n in counts:
            out.tallies.setdefault((r["model"], number), np.zeros(4, np.int64))[kind] += n
    return out


_SPLIT = pa.schema([("slot", pa.int32()), ("gain", pa.float64()), ("feature", pa.int32()), ("bin", pa.int32()), *[(c, pa.float64()) for c in ("gl", "hl", "g", "h")]])
_SPLIT_DDL = "slot int, gain double, feature int, bin int, gl double, hl double, g double, h double"


def _boost_dealt(blocks: DataFrame, run: _Run, counts_at: tuple, pending: int) -> Boosted:
    """Rows stay where they are: a step is a job that adds up their gradients by open node and bin and chooses the splits."""
    spark, size = blocks.sparkSession, len(run.settings)
    added = np.zeros(run.models, np.int64)  # trees that are in the staged margins
    out = Boosted(run.trees)
    state = (run.widths, run.settings, run.weights, run.seed)
    while run.growing:
        step = run.step()
        sent = spark.sparkContext.broadcast((run.waiting(added), step, state))

        def histograms(batches):
            late, step, state = sent.value
            here, total = _Run(*state), 0.0
            for _, block in _blocks(batches, here.features, size):
                for t in late:
                    block.add(t)
                total = total + here.sums(block, step)
            if np.ndim(total):
                some = np.flatnonzero(total.any(axis=(1, 2)))
                yield pa.RecordBatch.from_pydict({"slot": pa.array(some, pa.int32()), "sums": pa.array([total[k].tobytes() for k in some], pa.binary())})

        def splits(batches):
            _, (_, _, numbers, slots), state = sent.value
            here, at, total, rows = _Run(*state), None, None, []

            def found():
                m, _ = slots[at]
                best, g, h = here.best(m, numbers[m], total)
                rows.append((at, *best, g, h))

            for batch in batches:
                for slot, sums in zip(batch.column("slot").to_pylist(), batch.column("sums")):
                    part = np.frombuffer(sums.as_buffer(), float).reshape(-1, 2)
                    if slot == at:
                        total += part
                        continue
                    if at is not None:
                        found()
                    at, total = slot, part.copy()
            if at is not None:
                found()
                yield pa.RecordBatch.from_pydict(dict(zip(_SPLIT.names, map(list, zip(*rows)))), schema=_SPLIT)

        sums = blocks.select("n", "groups", "labels", "folds", "draws", "bins", "margins").mapInArrow(histograms, "slot int, sums binary")
        chosen = sums.repartition("slot").sortWithinPartitions("slot").mapInArrow(splits, _SPLIT_DDL).collect()  # a row for each open node
        sent.unpersist()
        run.split(step[3], {r["slot"]: ((r["gain"], r["feature"], r["bin"], r["gl"], r["hl"]), r["g"], r["h"]) for r in chosen})
        if not run.growing or (run.lengths() - added).max() >= pending:
            blocks = _add_trees(blocks, run, added, counts_at)
            added = run.lengths()
            if counts_at:
                _count(out.tallies, blocks)
    return out


def _add_trees(blocks: DataFrame, run: _Run, added: np.ndarray, counts_at: tuple) -> DataFrame:
    """The blocks with the waiting trees in their margins; held-out rows are counted after the tree numbers asked for."""
    spark, size, features = blocks.sparkSession, len(run.settings), run.features
    sent = spark.sparkContext.broadcast((run.waiting(added), added, run.lengths(), run.held))

    def add(batches):
        late, added, ends, held = sent.value
        for row, block in _blocks(batches, features, size):
            tallies = block.add_counted(late, added, ends, held, counts_at)
            found = np.concatenate(tallies) if tallies else np.zeros((0, 4), np.int64)
            yield pa.RecordBatch.from_pylist([row | {"margins": block.margins.tobytes(), "tallies": found.astype(np.int64).tobytes()}], schema=_SCHEMA)

    return stage(blocks.mapInArrow(add, BLOCK))


def _count(tallies: dict, blocks: DataFrame) -> None:
    """Adds the counts that the blocks carry: by model and tree number, of (label, predicted) = 00, 01, 10, 11."""
    def read(batches):
        for batch in batches:
            for t in batch.column("tallies"):
                found = np.frombuffer(t.as_buffer(), np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_pydict({"number": found[:, 0], "model": found[:, 1], "kind": found[:, 2], "n": found[:, 3]})

    rows = blocks.select("tallies").mapInArrow(read, "number long, model long, kind long, n long").groupBy("number", "model", "kind").agg(F.sum("n").alias("n"))
    for r in rows.collect():  # four rows for each model and number
        tallies.setdefault((r["model"], r["number"]), np.zeros(4, np.int64))[r["kind"]] += r["n"]


# --- forests as tables ------------------------------------------------------------------------

TREE_NODES = "tree int, node int, feature string, threshold double, value double"
NODES = pa.schema([("model", pa.int32()), ("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.string()), ("threshold", pa.float64()), ("value", pa.float64())])


def node_table(trees: list[list[Tree]], features, edges: list) -> pa.Table:
    """Nodes of all models: inner ones send rows up to the threshold, and missing values, to node 2k + 1, others to 2k + 2.

    ``edges`` are those of each model; leaves of value 0 are left out.
    """
    parts = []
    for m, forest in enumerate(trees):
        for t, tree in enumerate(forest):
            node = np.flatnonzero((tree.feature >= 0) | (tree.value != 0))
            f = tree.feature[node]
            cuts = [edges[m][i][c] if i >= 0 else None for i, c in zip(f, tree.bin[node])]
            parts.append(pa.Table.from_pydict({
                "model": np.full(len(node), m), "tree": np.full(len(node), t), "node": node, "feature": [features[i] if i >= 0 else None for i in f],
                "threshold": pa.array(cuts, pa.float64()), "value": tree.value[node].astype(float)}, schema=NODES))
    return pa.concat_tables(parts) if parts else NODES.empty_table()


class Forest:
    """One model's trees on raw feature values, for scoring."""

    def __init__(self, rows: list[tuple]):
        """``rows``: (tree, node, feature, threshold, value)."""
        self.features = sorted({r[2] for r in rows if r[2] is not None})
        place = {f: i for i, f in enumerate(self.features)}
        trees, nodes = 1 + max([r[0] for r in rows], default=-1), 1 + max([r[1] for r in rows], default=0)
        nodes = 2 * nodes + 1
        self.feature, self.cut, self.value = np.full((trees, nodes), -1, np.int16), np.zeros((trees, nodes)), np.zeros((trees, nodes))
        for t, node, f, cut, value in rows:
            self.feature[t, node], self.cut[t, node], self.value[t, node] = (-1 if f is None else place[f]), cut or 0.0, value

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Sums of the trees' values; x has a column for each of ``features``, NaN where missing."""
        x = np.where(np.isnan(x), -np.inf, x)
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            at = np.zeros(len(x), np.int64)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                at = np.where(inner, 2 * at + 1 + (x[rows, np.maximum(f, 0)] > cut[at]), at)
            total += value[at]
        return total


def score_forest(df: DataFrame, forest: Forest) -> DataFrame:
    """Adds ``predicted`` (0/1) and ``score`` (probability of 1); the forest is sent to the tasks, its size is that of its trees."""
    sent = df.sparkSession.sparkContext.broadcast(forest)
    inputs = F.array(*[F.col(f).cast("double") for f in forest.features]) if forest.features else F.array().cast("array<double>")

    @F.pandas_udf("double")
    def probability(points: pd.Series) -> pd.Series:
        x = np.array(points.tolist(), float).reshape(len(points), len(sent.value.features))
        return pd.Series(1 / (1 + np.exp(-sent.value.margins(x))))

    return df.withColumn("score", probability(inputs)).withColumn("predicted", (F.col("score") > 0.5).cast("int"))


# --- one model for each group -----------------------------------------------------------------

#: Groups whose models are grown together: it bounds what a step sends to the tasks.
WAVE = 500


def boost_groups(df: DataFrame, features, label: str, by, train: Column, key: Column, setting: Setting = Setting(), balanced: bool = True, wave: int = WAVE) -> DataFrame:
    """The nodes (by, tree, node, feature, threshold, value) of one classifier for each group, all grown in the same steps.

    ``train`` says which rows teach. ``balanced`` weighs label 1 by the group's zeros / ones. A group of one class has no
    nodes; a null in ``by`` is a group of its own. Bins, weights and draws are the group's own, so its trees are those
    that it would get alone.
    """
    by, spark = list(by), df.sparkSession
    rows = df.withColumn("_teaches", F.coalesce(train, F.lit(False)))
    taught = rows.filter("_teaches")
    sizes = sorted(taught.groupBy(*by).agg(F.sum(F.col(label).cast("long")).alias("_ones"), F.count(F.lit(1)).alias("_n")).collect(), key=lambda r: repr(r[: len(by)]))
    both = [r for r in sizes if r["_ones"] and r["_ones"] < r["_n"]]
    kinds = T.StructType([df.schema[b] for b in by] + [T.StructField("_group", T.IntegerType())])
    out = None
    for first in range(0, len(both), wave):
        some = both[first : first + wave]
        numbers = spark.createDataFrame([(*r[: len(by)], i) for i, r in enumerate(some)], kinds)
        names = [f"_b{i}" for i in range(len(by))]
        numbered = F.broadcast(numbers.toDF(*names, "_group"))  # at most ``wave`` rows
        same = F.lit(True)
        for b, n in zip(by, names):
            same = same & F.col(b).eqNullSafe(F.col(n))
        part = rows.join(numbered, same).drop(*names)
        edges = bin_edges(part.filter("_teaches"), features, ["_group"])
        edges = [edges[(i,)] for i in range(len(some))]
        blocks = row_blocks(part.filter("_teaches"), features, edges, label, F.lit(0), key, F.col("_group"))
        widths = [1 + max(len(e[i]) for e in edges) for i in range(len(features))]
        weights = [(r["_n"] - r["_ones"]) / r["_ones"] if balanced else 1.0 for r in some]
        grown = boost(blocks, widths, [setting], len(some), weights)
        nodes = spark.createDataFrame(node_table(grown.trees, features, edges)).withColumnRenamed("model", "_group")
        found = stage(nodes.join(F.broadcast(numbers), "_group").select(*by, "tree", "node", "feature", "threshold", "value"))
        out = found if out is None else out.unionByName(found)
    if out is None:
        kinds = T.StructType([df.schema[b] for b in by])
        return spark.createDataFrame([], kinds).selectExpr("*", "0 AS tree", "0 AS node", "'' AS feature", "0.0D AS threshold", "0.0D AS value")
    return out


def score_groups(df: DataFrame, nodes: DataFrame, by, key: Column) -> DataFrame:
    """Adds ``predicted`` (0/1) and ``score``; null for rows whose group has no model. Models meet their rows by a join."""
    by = list(by)
    forests = nodes.groupBy(*by).agg(F.collect_list(F.struct("tree", "node", "feature", "threshold", "value")).alias("_forest"))

    def score(rows: pa.Table, forest: pa.Table) -> pa.Table:
        margins = None
        if forest.num_rows:
            model = Forest([tuple(n.values()) for n in forest.column("_forest")[0].as_py()])
            x = np.stack([rows.column(f).cast(pa.float64()).fill_null(np.nan).to_numpy() for f in model.features], axis=1) if model.features else np.zeros((rows.num_rows, 0))
            margins = model.margins(x)
        score = pa.nulls(rows.num_rows, pa.float64()) if margins is None else pa.array(1 / (1 + np.exp(-margins)))
        predicted = pa.nulls(rows.num_rows, pa.int32()) if margins is None else pa.array((margins > 0).astype(np.int32))
        return rows.append_column("score", score).append_column("predicted", predicted)

    return with_models(df, forests, by, key, score, "score double, predicted int")
