"""How far the sources of a language differ in their words, audited over all terms.

A term's row is its nonzero counts by source, in the order of the sources. Rows go into a frequent-pattern tree with
their multiplicities. If no source had any term, each pair's divergence would follow from the sources' sums alone; what
one source's counts change is added from a histogram of its counts, and what two sources' counts change together once
for each combination of a tree node and one of its ancestors, times the number of rows that pass the node. Rows are
dealt out in order, so those that share a path meet in one task; a path that two tasks share only makes two nodes.

Words are counted over the UTF-8 bytes of a batch, told apart there by 64-bit hashes, and meet as strings. The products
stay in the range of a long while a language keeps up to 10^9 terms; sums over tasks are decimals. The list of sources
(some 40 bytes for each language and source) is sent to all tasks: the result has the square of its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorlab.llm.common import staged
from sensorlab.llm.words import LOWER, find_words, hash_words, mix, slices, utf8_column

#: Documents of a language that must hold a term, and ranks that the part ``term`` reports.
LEAST_DOCS = 3
TERM_RANKS = 200

#: Words are runs of ASCII letters and of bytes of characters beyond ASCII.
LETTER = np.zeros(256, dtype=bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = LETTER[0x80:] = True

#: Words that are counted together, path items that one tree of a task holds, node-ancestor combinations looked at together.
WORDS = 1 << 20
TREE_ITEMS = 1 << 20
STEP = 1 << 20

PAIRS = pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("value", pa.int64())])
#: One row for each language and term: the hashes of its sources and its counts there, as binary longs in the order of the hashes.
COUNTS = pa.schema([("lang", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("sources", pa.binary()), ("counts", pa.binary())])
COUNTS_DDL = "lang string, term string, docs long, sources binary, counts binary"
#: An item of a path: places of bytes that sort as source and count do.
ITEM = np.dtype([("code", ">u4"), ("n", ">u8")])


def divergence(p, q):
    """floor((p - q)^2 / q) of whole numbers."""
    return (p - q) * (p - q) // q


def divergence_column(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def share(counts: np.ndarray, sizes) -> np.ndarray:
    """1 + floor(10^9 * (count + 1) / size), as 31250 times 32000 so that longs hold counts up to 10^14."""
    whole, rest = np.divmod((counts + 1) * 31250, sizes)
    return 1 + whole * 32000 + rest * 32000 // sizes


def share_column(count: str, total: str, terms: str) -> Column:
    """As ``share``, of size total + terms."""
    x, size = f"({count} + 1)", f"({total} + {terms})"
    return F.expr(f"1 + ({x} * 31250L div {size}) * 32000L + ({x} * 31250L % {size}) * 32000L div {size}")


def binaries(values: np.ndarray, lengths: np.ndarray, width: int = 8) -> pa.Array:
    """Binary values of so many items each, cut from one array."""
    offsets = np.concatenate([[0], np.cumsum(lengths * width)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def items_of(column: pa.Array, kind=np.int64) -> tuple[np.ndarray, np.ndarray]:
    """All items of a binary column one after the other, and the number of each row."""
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(column.to_pylist()), kind), lengths


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    place = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    return pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[place])])


def counted(langs: pa.Array, sources: np.ndarray, column: pa.Array) -> Iterator[pa.RecordBatch]:
    """A batch's counts by language and term."""
    data, offsets = utf8_column(column)
    data = LOWER[data]
    langs = langs.dictionary_encode()
    lang_of, names = langs.indices.to_numpy(), langs.dictionary
    known, source_of = np.unique(sources, return_inverse=True)
    held, n = [], 0

    def flush():
        hashes, starts, ends, rows = (np.concatenate(x) for x in zip(*held))
        lang = lang_of[rows]
        keys, _ = pd.factorize(hashes ^ mix(lang.astype(np.uint64) + np.uint64(1)))
        many = int(keys.max()) + 1
        first = np.empty(many, np.int64)
        first[keys[::-1]] = np.arange(len(keys))[::-1]
        docs = np.bincount(np.unique(keys * len(lang_of) + rows) // len(lang_of), minlength=many)
        pair, count = np.unique(keys * len(known) + source_of[rows], return_counts=True)
        lengths = np.bincount(pair // len(known), minlength=many)
        return pa.RecordBatch.from_arrays([
            names.take(pa.array(lang[first])), strings(data, starts[first], ends[first]), pa.array(docs.astype(np.int64)),
            binaries(known[pair % len(known)], lengths), binaries(count.astype(np.int64), lengths)], schema=COUNTS)

    for a, b in slices(offsets):
        part = data[offsets[a] : offsets[b]]
        starts, ends, before = find_words(part, offsets[a : b + 1] - offsets[a], LETTER)
        if not len(starts):
            continue
        held.append((hash_words(part, starts, ends), starts + offsets[a], ends + offsets[a], np.repeat(np.arange(a, b), np.diff(before))))
        n += len(starts)
        if n >= WORDS:
            yield flush()
            held, n = [], 0
    if held:
        yield flush()


def merged(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One row for each language and term of a batch in that order, and counts added up."""
    new = np.ones(batch.num_rows, bool)
    for name in ("lang", "term"):
        column = batch.column(name)
        differs = pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
        new[1:] = differs if name == "lang" else new[1:] | differs
    heads = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    sources, lengths = items_of(batch.column("sources"))
    counts, _ = items_of(batch.column("counts"))
    rows = np.repeat(group, lengths)
    order = np.lexsort((sources, rows))
    rows, sources, counts = rows[order], sources[order], counts[order]
    edge = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (sources[1:] != sources[:-1])]))
    sizes = np.bincount(rows[edge], minlength=len(heads))
    docs = np.add.reduceat(batch.column("docs").to_numpy(), heads)
    return pa.RecordBatch.from_arrays([
        batch.column("lang").take(pa.array(heads)), batch.column("term").take(pa.array(heads)), pa.array(docs),
        binaries(sources[edge], sizes), binaries(np.add.reduceat(counts, edge), sizes)], schema=COUNTS)


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """A row for each language and term that enough documents hold."""
    def count(batches):
        for batch in batches:
            yield from counted(batch.column("lang"), batch.column("source").to_numpy(), batch.column("text"))

    def meet(batches):
        last = None  # the group that the next batch may go on with, merged
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is not None:
                batch = pa.Table.from_batches([last, batch.cast(COUNTS)]).combine_chunks().to_batches()[0]
            batch = merged(batch)
            last = batch.slice(batch.num_rows - 1)
            done = batch.slice(0, batch.num_rows - 1)
            yield done.filter(pc.greater_equal(done.column("docs"), least))
        if last is not None:
            yield last.filter(pc.greater_equal(last.column("docs"), least))

    words = docs.select("lang", F.xxhash64("source").alias("source"), "text").mapInArrow(count, COUNTS_DDL)
    return words.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(meet, COUNTS_DDL)


class Sources:
    """Per language: the sources' hashes in order with their codes, sums and p of a count of 0; kept terms, and their sum."""

    def __init__(self, rows: list):
        self.langs = {}
        for lang in sorted({r["lang"] for r in rows}):
            own = sorted((r for r in rows if r["lang"] == lang), key=lambda r: r["key"])
            read = lambda c: np.array([r[c] for r in own], np.int64)  # noqa: B023, E731
            terms, total = own[0]["terms"], own[0]["lang_size"]
            codes, sizes = read("code"), np.zeros(max(r["code"] for r in own) + 1, np.int64)
            sizes[codes] = read("size")
            self.langs[lang] = read("key"), codes, sizes, terms, total

    def codes(self, lang: str, sources: np.ndarray) -> np.ndarray:
        keys, codes, *_ = self.langs[lang]
        return codes[np.searchsorted(keys, sources)]

    def shares(self, lang: str, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        _, _, sizes, terms, _ = self.langs[lang]
        return share(counts, sizes[codes] + terms)

    def lang_shares(self, lang: str, counts: np.ndarray) -> np.ndarray:
        *_, terms, total = self.langs[lang]
        return share(counts, total + terms)


def by_language(batches) -> Iterator[tuple[str, pa.RecordBatch]]:
    for batch in batches:
        for lang in batch.column("lang").unique().to_pylist():
            yield lang, batch.filter(pc.equal(batch.column("lang"), lang))


def tree_pairs(first: np.ndarray, items: np.ndarray, shares: np.ndarray, bases: np.ndarray, weights: np.ndarray) -> Iterator[tuple]:
    """(source, source, value) sums of the corrections of all node-ancestor combinations of one language's tree.

    Row i has ``weights[i]`` copies and the items ``first[i]`` to ``first[i + 1]``; rows are in order, so rows that share
    a path are neighbours. ``shares`` are the items' p, ``bases`` the p that their sources give to a count of 0.
    """
    sizes = np.diff(first)
    # Leading items that a row shares with the row before it.
    shared = np.zeros(len(sizes), np.int64)
    open_rows = np.arange(1, len(sizes))
    depth = 0
    while len(open_rows):
        open_rows = open_rows[(sizes[open_rows] > depth) & (sizes[open_rows - 1] > depth)]
        here, before = first[open_rows] + depth, first[open_rows - 1] + depth
        open_rows = open_rows[(items[here] == items[before]) & (shares[here] == shares[before])]
        shared[open_rows] += 1
        depth += 1
    rows = np.arange(len(sizes))
    for depth in range(1, int(sizes.max(initial=0))):
        rows = rows[sizes[rows] > depth]
        new = np.flatnonzero(shared[rows] <= depth)
        passing = np.add.reduceat(weights[rows], new)  # rows through each node of this depth
        step = max(1, STEP // depth)
        for k in range(0, len(new), step):
            start = first[rows[new[k : k + step]]]
            above = (start[:, None] + np.arange(depth)).ravel()
            below = np.repeat(start + depth, depth)
            many = np.repeat(passing[k : k + step], depth)
            for x, y in ((above, below), (below, above)):
                p, q, p0, q0 = shares[x], shares[y], bases[x], bases[y]
                value = many * (divergence(p, q) - divergence(p, q0) - divergence(p0, q) + divergence(p0, q0))
                yield items[x], items[y], value


def summed(parts: Iterator[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums by pair of sources, with room for one step and the pairs only."""
    a, b, value = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for x, y, v in parts:
        keys, place = np.unique(np.concatenate([a << 32 | b, x.astype(np.int64) << 32 | y]), return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, place, np.concatenate([value, v]))
        a, b, value = keys >> 32, keys & 0xFFFFFFFF, total
    return a, b, value


def pair_corrections(paths: DataFrame, sources, tree_items: int = TREE_ITEMS) -> DataFrame:
    """lang, a, b, value: what two sources' counts change together, from paths (lang, path, weight) in order."""
    def tree(lang: str, held: list) -> Iterator[pa.RecordBatch]:
        items = np.concatenate([i for i, _, _ in held])
        first = np.concatenate([[0], np.cumsum(np.concatenate([n for _, n, _ in held]))])
        codes, weights = items["code"].astype(np.int64), np.concatenate([w for _, _, w in held])
        known = sources.value
        shares, bases = known.shares(lang, codes, items["n"].astype(np.int64)), known.shares(lang, codes, np.zeros(len(codes), np.int64))
        a, b, value = summed(tree_pairs(first, codes, shares, bases, weights))
        yield pa.RecordBatch.from_pydict({"lang": [lang] * len(a), "a": a.astype(np.int32), "b": b.astype(np.int32), "value": value}, schema=PAIRS)

    def run(batches):
        last, held, n = None, [], 0
        for lang, part in by_language(batches):
            if held and (lang != last or n > tree_items):
                yield from tree(last, held)
                held, n = [], 0
            last = lang
            items, lengths = items_of(part.column("path"), ITEM)
            held.append((items, lengths, part.column("weight").to_numpy()))
            n += len(items)
        if held:
            yield from tree(last, held)

    return paths.mapInArrow(run, "lang string, a int, b int, value long")


def histogram(rows: DataFrame, sources) -> DataFrame:
    """lang, code, p, many: how many kept terms have each share in each source (terms that it lacks left out)."""
    def run(batches):
        for lang, part in by_language(batches):
            codes = sources.value.codes(lang, items_of(part.column("sources"))[0])
            shares = sources.value.shares(lang, codes, items_of(part.column("counts"))[0])
            order = np.lexsort((shares, codes))
            codes, shares = codes[order], shares[order]
            edge = np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (shares[1:] != shares[:-1])]))
            many = np.diff(np.concatenate([edge, [len(codes)]]))
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(edge), "code": pa.array(codes[edge], pa.int32()), "p": shares[edge], "many": many})

    return rows.mapInArrow(run, "lang string, code int, p long, many long").groupBy("lang", "code", "p").agg(F.sum("many").alias("many"))


def term_values(rows: DataFrame, sources, ranks: int) -> DataFrame:
    """lang, code, item, value of terms that a source uses more than its language; of a batch only those that may be ranked."""
    def run(batches):
        for lang, part in by_language(batches):
            keys, lengths = items_of(part.column("sources"))
            counts, _ = items_of(part.column("counts"))
            codes, row = sources.value.codes(lang, keys), np.repeat(np.arange(part.num_rows), lengths)
            p = sources.value.shares(lang, codes, counts)
            q = sources.value.lang_shares(lang, np.add.reduceat(counts, np.concatenate([[0], np.cumsum(lengths)[:-1]])))[row]
            over = np.flatnonzero(p > q)
            codes, row, value = codes[over], row[over], divergence(p[over], q[over])
            order = np.lexsort((-value, codes))
            codes, row, value = codes[order], row[order], value[order]
            starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
            group = np.repeat(np.arange(len(starts)), np.diff(np.concatenate([starts, [len(codes)]])))
            # Ties with the last place stay: the term decides among them later.
            last = np.minimum(starts + ranks - 1, np.concatenate([starts[1:], [len(codes)]]) - 1)
            may = value >= value[last][group]
            yield pa.RecordBatch.from_pydict({"lang": [lang] * int(may.sum()), "code": pa.array(codes[may], pa.int32()), "item": part.column("term").take(pa.array(row[may])), "value": value[may]})

    return rows.mapInArrow(run, "lang string, code int, item string, value long")


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, term_ranks: int = TERM_RANKS) -> DataFrame:
    """lang, source, part, item, value, rank: which other sources and which terms a source differs by most.

    Part ``pair`` ranks the other sources of the language by the divergence of the group's word shares from theirs, summed
    over all kept terms; part ``term`` ranks the kept terms that the group uses more than the language does. A kept term
    stands in ``least_docs`` rows of its language. Null texts, languages and sources count as empty strings, and rows
    without words still make a group, whose pairs are 0 where a language keeps no term. Repeated rows and rows without
    doc_id count as documents of their own; ties in value are ranked by the item's UTF-8 bytes; an empty table gives no
    rows; other columns play no part.
    """
    spark = docs.sparkSession
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    rows = staged(kept_terms(docs, least_docs), "terms")

    def sums(batches):
        for lang, part in by_language(batches):
            keys, place = np.unique(items_of(part.column("sources"))[0], return_inverse=True)
            size = np.zeros(len(keys), np.int64)
            np.add.at(size, place, items_of(part.column("counts"))[0])
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(keys), "key": keys, "size": size, "terms": [part.num_rows] + [0] * (len(keys) - 1)})

    sizes = staged(rows.mapInArrow(sums, "lang string, key long, size long, terms long").groupBy("lang", "key").agg(F.sum("size").alias("size"), F.sum("terms").alias("terms")), "sizes")
    langs = sizes.groupBy("lang").agg(F.sum("terms").alias("terms"), F.sum("size").alias("lang_size"))
    groups = docs.select("lang", "source").distinct().withColumn("key", F.xxhash64("source"))
    groups = groups.join(sizes.select("lang", "key", "size"), ["lang", "key"], "left").join(langs, "lang", "left").na.fill(0)
    # One row for each language and source: the result has the square of that.
    code = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("code")
    base = F.when(F.col("terms") > 0, share_column("0L", "size", "terms")).alias("p0")
    groups = staged(groups.select("lang", "source", "key", code, "size", "lang_size", "terms", base), "sources")
    sent = spark.sparkContext.broadcast(Sources(groups.filter("terms > 0").collect()))

    def paths(batches):
        for lang, part in by_language(batches):
            keys, lengths = items_of(part.column("sources"))
            items = np.zeros(len(keys), ITEM)
            items["code"], items["n"] = sent.value.codes(lang, keys), items_of(part.column("counts"))[0]
            items = items[np.lexsort((items["code"], np.repeat(np.arange(len(lengths)), lengths)))]
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(lengths), "path": binaries(items, lengths, ITEM.itemsize)})

    weighted = rows.mapInArrow(paths, "lang string, path binary").groupBy("lang", "path").agg(F.count("*").alias("weight"))
    ordered = weighted.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")

    wide = F.col("value").cast("decimal(38,0)").alias("value")
    left, right = groups.select("lang", F.col("code").alias("a"), F.col("p0").alias("a0"), "terms"), groups.select("lang", F.col("code").alias("b"), F.col("p0").alias("b0"))
    of_none = left.join(right, "lang").filter("a <> b").withColumn("value", F.coalesce(F.col("terms") * divergence_column("a0", "b0"), F.lit(0)))
    alone = histogram(rows, sent).join(left.select("lang", F.col("a").alias("code"), F.col("a0").alias("p0")), ["lang", "code"])
    with_other = alone.join(right, "lang").filter("code <> b")
    here, back = divergence_column("p", "b0") - divergence_column("p0", "b0"), divergence_column("b0", "p") - divergence_column("b0", "p0")
    both = with_other.select("lang", F.inline(F.array(
        F.struct(F.col("code").alias("a"), F.col("b"), (F.col("many") * here).alias("value")), F.struct(F.col("b").alias("a"), F.col("code").alias("b"), (F.col("many") * back).alias("value")))))
    parts = [p.select("lang", "a", "b", wide) for p in (of_none, both, pair_corrections(ordered, sent))]
    pairs = parts[0].union(parts[1]).union(parts[2]).groupBy("lang", "a", "b").agg(F.sum("value").cast("long").alias("value"))
    name = lambda c, title: groups.select("lang", F.col("code").alias(c), F.col("source").alias(title))
    pairs = pairs.join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"])
    over = term_values(rows, sent, term_ranks).join(name("code", "source"), ["lang", "code"])
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    out = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", place.alias("rank"))
    return out(pairs, "pair").union(out(over, "term").filter(F.col("rank") <= term_ranks))
