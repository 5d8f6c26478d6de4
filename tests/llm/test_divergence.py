"""The divergence audit against plain sums over all terms and pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from sensorlab.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=3, ranks=200):
    counts, docs, groups = {}, {}, set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        for w in words:
            counts[lang, source, w] = counts.get((lang, source, w), 0) + 1
        for w in set(words):
            docs[lang, w] = docs.get((lang, w), 0) + 1
    out = []
    for lang in {g[0] for g in groups}:
        sources = sorted(s for g, s in groups if g == lang)
        terms = [w for (g, w), n in docs.items() if g == lang and n >= least]
        of = lambda s, w: counts.get((lang, s, w), 0)  # noqa: B023, E731
        share = lambda n, size: 1 + 10**9 * (n + 1) // (size + len(terms))  # noqa: B023, E731
        sizes = {s: sum(of(s, w) for w in terms) for s in sources}
        total = sum(sizes.values())
        f = lambda p, q: (p - q) ** 2 // q
        for s in sources:
            pairs = [(sum(f(share(of(s, w), sizes[s]), share(of(o, w), sizes[o])) for w in terms), o) for o in sources if o != s]
            over = []
            for w in terms:
                q = share(sum(of(o, w) for o in sources), total)
                if of(s, w) and share(of(s, w), sizes[s]) > q:
                    over.append((f(share(of(s, w), sizes[s]), q), w))
            for part, found, most in (("pair", pairs, None), ("term", over, ranks)):
                order = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(order)]
    return sorted(out)


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["Éa", "éa", "ÉA", "straße", "日本", "Don", "don"]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "de", None])
        text = " ".join(words[min(len(words) - 1, int(rng.expovariate(0.08)))] + rng.choice(["", "", "1", "'", "_x"]) for _ in range(rng.randrange(0, 25)))
        rows.append((i, text, lang, rng.choice(["hot", "hot", "hot", "a", "b", "c", None])))
    rows += [(None, None, "en", "silent"), (5, "", "fr", "only"), (6, "one two", "xx", "p"), (7, "three", "xx", "q"), rows[3], rows[3]]
    return rows + [(900, "word " * 60_000, "en", "a"), (901, "1234 !? __", "yy", "z")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_sums(spark, seed, monkeypatch):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS term", "'x' AS rank", "0 AS code").repartition(5)
    if seed == 2:  # small slices, trees and steps
        monkeypatch.setattr(divergence, "WORDS", 50)
        monkeypatch.setattr(divergence, "STEP", 3)
    assert sorted(map(tuple, divergence.source_divergence(df).collect())) == plain(rows)
    assert sorted(map(tuple, divergence.source_divergence(df, term_ranks=3).collect())) == plain(rows, ranks=3)


def test_empty_table_and_no_kept_terms(spark):
    assert divergence.source_divergence(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "a b", "en", "x"), (2, "c", "en", "y"), (3, None, "en", None)]
    assert sorted(map(tuple, divergence.source_divergence(spark.createDataFrame(rows, SCHEMA)).collect())) == plain(rows)


def test_tree_equals_pairs_of_every_row():
    rng = np.random.default_rng(4)
    rows = sorted(tuple((s, int(c)) for s, c in enumerate(r) if c) for r in rng.integers(0, 3, size=(200, 6)) * (rng.random((200, 6)) < 0.5))
    rows = [r for r in rows if r]
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    items, shares = np.array([s for r in rows for s, _ in r]), np.array([100 + 37 * c + s for r in rows for s, c in r])
    bases, weights = np.array([100 + s for r in rows for s, _ in r]), rng.integers(1, 4, len(rows))
    a, b, value = divergence.summed(divergence.tree_pairs(first, items, shares, bases, weights))
    f, want = divergence.divergence, {}
    for k, r in enumerate(rows):
        for s, c in r:
            for t, d in r:
                if s != t:
                    p, q, p0, q0 = 100 + 37 * c + s, 100 + 37 * d + t, 100 + s, 100 + t
                    want[s, t] = want.get((s, t), 0) + int(weights[k]) * (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0))
    assert dict(zip(zip(a.tolist(), b.tolist()), value.tolist())) == want


def test_shares_are_exact_for_large_counts():
    for size in (1, 7, 10**9 + 7, 3 * 10**14 - 1):
        counts = [c for c in (0, 1, 5, 10**9, 10**12, 2 * 10**14) if c < size]
        assert divergence.share(np.array(counts), size).tolist() == [1 + 10**9 * (c + 1) // size for c in counts]


def test_counts_of_a_batch_meet():
    texts = pa.array(["b a a", "a", None, "A-c", "a c"])
    langs, sources = pa.array(["x", "x", "x", "y", "x"]), np.array([5, 3, 3, 5, 5])
    batches = list(divergence.counted(langs, sources, texts))
    table = pa.Table.from_batches(batches * 2).sort_by([("lang", "ascending"), ("term", "ascending")])
    got = divergence.merged(table.combine_chunks().to_batches()[0])
    sums = {(r["lang"], r["term"]): (r["docs"], np.frombuffer(r["sources"], np.int64).tolist(), np.frombuffer(r["counts"], np.int64).tolist()) for r in got.to_pylist()}
    assert sums == {("x", "a"): (6, [3, 5], [2, 6]), ("x", "b"): (2, [5], [2]), ("x", "c"): (2, [5], [2]), ("y", "a"): (2, [5], [2]), ("y", "c"): (2, [5], [2])}
