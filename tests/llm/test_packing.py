"""Windows meet the mix, against a plain simulation of the laps."""

import random
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest

from sensorlab.llm import packing
from sensorlab.llm.packing import Deal

FILE = public_tokenizers.path("word_bpe_49k.json")


def laid_out(sizes, weights, window, lap=packing.LAP, seed=0):
    """Tokens of each queue in each window, after checking that all places are taken once; queues are asked in parts."""
    rng, total = random.Random(seed), sum(sizes)
    deal = Deal(sizes, weights, window, lap)
    windows = -(-total // window)
    got, taken = np.zeros((windows, len(sizes)), int), np.zeros(windows * window, int)
    for k, n in enumerate(sizes):
        first = 0
        while first < n:
            many, start = min(n - first, rng.choice([1, 7, 90, 4000])), 0
            for piece in deal.pieces(k, first, many):
                for a, m, w, at in zip(*piece):
                    assert a == start and at + m <= window
                    start += m
                    got[w, k] += m
                    taken[w * window + at : w * window + at + m] += 1
            assert start == many
            first += many
    assert (taken[:total] == 1).all() and not taken[total:].any()
    return got


@pytest.mark.parametrize("seed", range(12))
def test_every_window_is_within_a_token_of_the_mix(seed):
    rng = random.Random(seed)
    sizes = [rng.randrange(200, 40_000) for _ in range(rng.choice([1, 2, 9, 20]))]
    total, window = sum(sizes), rng.choice([64, 256, 2048])
    got = laid_out(sizes, [Fraction(n, total) for n in sizes], window, seed=seed)
    target = np.array(sizes) / total * window
    # The last window holds the rest; the one before may end a queue.
    assert (np.abs(got[: total // window - 1] - target) <= 1 + 2 / packing.LAP).all()
    assert (np.abs(np.cumsum(got, axis=0)[: total // window - 1] - np.arange(1, total // window)[:, None] * target) <= packing.LAP / 2).all()


def test_shares_of_a_dry_queue_go_to_the_others():
    sizes, window = [10_000, 90_000, 3_000, 0], 100
    got = laid_out(sizes, [Fraction(1, 2), Fraction(1, 2), Fraction(0), Fraction(1, 3)], window)
    dry = 10_000 // 50
    assert (got[: dry - 2, 0] == 50).all() and (got[: dry - 2, 1] == 50).all()
    assert (got[dry + 1 : 980, 1] >= 99).all() and not got[: dry - 2, 2].any()
    assert got.sum(axis=0).tolist() == sizes


@pytest.mark.parametrize("seed", range(10))
def test_odd_queues_are_dealt_whole(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 3, 400, 9000]) for _ in range(rng.choice([1, 3, 15]))] + [1]
    weights = [Fraction(rng.choice([0, 1, 5])) + Fraction(rng.choice([0, 1]), 10 ** 9) for _ in sizes]
    assert laid_out(sizes, weights, rng.choice([16, 100]), rng.choice([1, 3, 64]), seed).sum(axis=0).tolist() == sizes


def test_apportion():
    assert packing.apportion(10, [1, 1, 1], [9, 9, 9]) == [4, 3, 3]
    assert packing.apportion(10, [1, 1, 0], [2, 3, 9]) == [2, 3, 5]
    assert packing.apportion(7, [0, 0], [3, 4]) == [3, 4]


def mixed(docs, **options):
    """By window: tokens of each source; sources are found by doc_id."""
    rows = packing.pack(docs, FILE, **options).collect()
    out = {}
    for r in rows:
        window = out.setdefault(r["sequence_id"], {})
        source = r["doc_id"] % 4
        window[source] = window.get(source, 0) + r["length"]
    return [out[k] for k in sorted(out)]


def test_documents_are_mixed_in_every_window(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["stone", "river", "under", "glass"]) for _ in range(n))
    docs = spark.createDataFrame([(i, text(rng.choice([5, 60, 900])), "abc"[i % 4] if i % 4 < 3 else None) for i in range(400)], "doc_id long, text string, source string").repartition(7)
    sizes = {}
    for r in packing.pack(docs, FILE, window=256).filter("start = 0").collect():
        sizes[r["doc_id"] % 4] = sizes.get(r["doc_id"] % 4, 0) + r["doc_tokens"]
    total = sum(sizes.values())
    windows = mixed(docs, window=256)
    assert all(sum(w.values()) == 256 for w in windows[:-1])
    for w in windows[: total // 256 - 1]:
        assert all(abs(w.get(s, 0) - 256 * sizes[s] / total) <= 1 + 2 / packing.LAP for s in sizes)
    # A share of 0 comes last; sources without a share, null among them, keep their part of all tokens.
    shared = mixed(docs, window=256, shares={"a": 0.0, "b": 0.5})
    assert not any(0 in w for w in shared[:20])
    rest = [sizes[s] / total for s in (2, 3)]
    assert all(abs(w[1] - 256 * 0.5 / (0.5 + sum(rest))) <= 1 + 2 / packing.LAP for w in shared[:20])


def test_many_small_sources_share_a_queue(spark):
    docs = spark.createDataFrame([(i, "one two three", f"s{i // 2}") for i in range(60)] + [(1000 + i, "river stone " * 3000, "large") for i in range(60)], "doc_id long, text string, source string")
    rows = packing.pack(docs, FILE, window=16).collect()
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
    assert [s * 16 + o for s, o, _ in places] == np.cumsum([0] + [n for *_, n in places])[:-1].tolist()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"]))
    assert len(by_doc) == 120 and all(sorted(p)[0][0] == 0 and sum(m for _, m, _ in p) == p[0][2] for p in by_doc.values())
