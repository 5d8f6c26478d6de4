"""N-gram Jaccard join by grouped prefixes.

A document's set holds its distinct word shingles. Shingles are ordered from rare to common, and a set's prefix
is so long that two sets similar enough must share a shingle of their prefixes. Sets with the same prefix and size
form one group; only groups that share a prefix shingle become pairs, a bound on their overlap filters the pairs,
and what is left is expanded to members and verified on the whole sets.

Commonness comes from counts of all shingles of all documents in a table of fixed size (4 million slots, 4 MB once
reduced to levels), so the order costs no shuffle of the shingles. A slot that holds a rare shingle beside a common
one only moves it back in the order, which never changes the result: any order of the shingles is correct.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from sensorlab.llm.common import components, id_filter, in_batches, passes, staged, text_only
from sensorlab.llm.words import LOWER, NOT_SPACE, U64, find_words, gram_hash, grams, hash_words, slices, utf8_column

SLOT_BITS = 22
BLOCKS = 64
#: Bytes of the parity signature that goes with each list entry; a set's whole signature has 4 bits a shingle.
SIGNATURE = 128
#: Rows of one list of sets that are compared in one step; longer lists are cut into pairs of such blocks.
LIST_BLOCK = 2048


def text_sets(column: pa.Array, words: int, wanted: np.ndarray | None = None):
    """Yield (row, sorted distinct shingle hashes) for every wanted text of a string column."""
    data, offsets = utf8_column(column)
    for first, last in slices(offsets):
        rows = np.arange(first, last) if wanted is None else np.flatnonzero(wanted[first:last]) + first
        if not len(rows):
            continue
        at = offsets[first : last + 1] - offsets[first]
        lowered = LOWER[data[offsets[first] : offsets[last]]]
        starts, ends, before = find_words(lowered, at, NOT_SPACE)
        hashes = hash_words(lowered, starts, ends)
        shingles = grams(hashes, words)
        for row in rows:
            a, b = before[row - first], before[row - first + 1]
            if b - a >= words:
                yield row, np.unique(shingles[a : b - words + 1])
            elif b > a:
                yield row, np.array([gram_hash(hashes[a:b])], U64)
            else:
                yield row, np.zeros(0, U64)


def slot_levels(docs: DataFrame, words: int) -> np.ndarray:
    """How common the shingles of each slot are: 0 within the noise of the table, else 1 + log2 of the count."""
    def count(batches):
        counts = np.zeros(1 << SLOT_BITS, np.uint32)
        for batch in batches:
            for _, shingles in text_sets(batch.column("text"), words):
                counts[(shingles >> U64(64 - SLOT_BITS)).astype(np.int64)] += np.uint32(1)
        planes = counts.view(np.uint8).reshape(BLOCKS, -1, 4)
        yield pa.RecordBatch.from_pydict({
            "block": pa.array(range(BLOCKS), pa.int32()),
            "counts": pa.array([zlib.compress(np.ascontiguousarray(p.T).tobytes(), 1) for p in planes], pa.binary())})

    def add(batches):
        sums = {}
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("counts")):
                counts = np.frombuffer(zlib.decompress(packed.as_buffer()), np.uint8).reshape(4, -1).T
                sums[block] = sums.get(block, 0) + np.ascontiguousarray(counts).view(np.uint32)[:, 0].astype(np.int64)
        yield pa.RecordBatch.from_pydict({
            "block": pa.array(list(sums), pa.int32()), "counts": pa.array([s.tobytes() for s in sums.values()], pa.binary())})

    schema = "block int, counts binary"
    summed = staged(docs.select("text").mapInArrow(count, schema).repartition("block").mapInArrow(add, schema), "slots")

    def total(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"total": pa.array([int(np.frombuffer(c.as_buffer(), np.int64).sum()) for c in batch.column("counts")], pa.int64())})

    mean = (summed.select("counts").mapInArrow(total, "total long").agg(F.sum("total")).first()[0] or 0) / (1 << SLOT_BITS)
    noise = mean + 6 * mean**0.5 + 4

    def level(batches):
        for batch in batches:
            for block, counts in zip(batch.column("block"), batch.column("counts")):
                counts = np.frombuffer(counts.as_buffer(), np.int64)
                levels = np.where(counts > noise, 1 + np.log2(np.maximum(counts, 1)), 0).astype(np.uint8)
                yield pa.RecordBatch.from_pydict({"block": pa.array([block.as_py()], pa.int32()), "counts": pa.array([levels.tobytes()], pa.binary())})

    out = np.zeros((BLOCKS, (1 << SLOT_BITS) // BLOCKS), np.uint8)
    for row in summed.mapInArrow(level, schema).collect():  # 64 rows of 64 KB whatever the input
        out[row["block"]] = np.frombuffer(bytes(row["counts"]), np.uint8)
    return out.ravel()


def signature(shingles: np.ndarray) -> np.ndarray:
    """Parity (packed bits) of the number of shingles in each of 4 to 8 classes a shingle, a power of two."""
    classes = max(8 * SIGNATURE, 1 << (4 * len(shingles)).bit_length())
    odd = np.bincount((shingles & U64(classes - 1)).astype(np.int64), minlength=classes) & 1
    return np.packbits(odd.astype(np.uint8))


def folded(sig: np.ndarray, size: int) -> np.ndarray:
    """The signature that fewer classes would have given."""
    return sig if len(sig) == size else np.bitwise_xor.reduce(sig.reshape(-1, size), axis=0)


def may_link(n1, n2, sig1, sig2, percent: int) -> np.ndarray:
    """Whether the sizes and the signatures (rows of 64-bit words) leave room for enough overlap."""
    total = n1 + n2
    apart = np.bitwise_count(sig1 ^ sig2).sum(axis=1).astype(np.int64)
    return (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)) & ((100 + percent) * (total - apart) >= 2 * percent * total)


def signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, SIGNATURE // 8)


SETS = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("member", pa.int64()), ("grp", pa.int64()), ("n", pa.int64()),
                  ("common", pa.float64()), ("prefix", pa.binary()), ("sig", pa.binary()), ("whole_sig", pa.binary())])


def document_sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Per document: keys of its text, its set (member) and its group, set size, commonness, prefix, signature."""
    levels = docs.sparkSession.sparkContext.broadcast(slot_levels(docs, words))

    def sets(batch):
        level_of, keys = levels.value, key_of_texts(batch.column("text"))
        out = {name: [] for name in SETS.names}
        ids, held = batch.column("doc_id"), 0
        for row, shingles in text_sets(batch.column("text"), words):
            n = len(shingles)
            keep = n + percent * n // -100 + 1 if n else 0  # n - ceil(percent * n / 100) + 1
            level = level_of[(shingles >> U64(64 - SLOT_BITS)).astype(np.int64)]
            prefix = shingles[np.argsort(level, kind="stable")[:keep]].tobytes()
            sig = signature(shingles) if n else None
            values = (ids[row].as_py(), keys[row],
                      xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63) if n else None,
                      xxhash.xxh3_64_intdigest(prefix, seed=n) - (1 << 63) if n else None,
                      n, float(level.mean()) if n else 0.0, prefix, folded(sig, SIGNATURE).tobytes() if n else None, sig.tobytes() if n else None)
            for name, value in zip(SETS.names, values):
                out[name].append(value)
            held += len(prefix) + (len(sig) if n else 0)
            if held > 4 << 20:
                yield out
                out, held = {name: [] for name in SETS.names}, 0
        yield out

    return docs.select("doc_id", "text").mapInArrow(in_batches(sets, SETS), "doc_id long, text_key long, member long, grp long, n long, common double, prefix binary, sig binary, whole_sig binary")


def key_of_texts(column: pa.Array) -> np.ndarray:
    data, offsets = utf8_column(column)
    view = memoryview(data)
    return np.array([xxhash.xxh3_64_intdigest(view[a:b]) - (1 << 63) for a, b in zip(offsets[:-1], offsets[1:])], np.int64)


def shared_shingles(sets: DataFrame, buckets: int) -> DataFrame:
    """(token, grp) for all prefix shingles that more than one group has.

    Each task sends one row per bucket with packed arrays instead of a row per shingle.
    """
    def scatter(batches):
        seen = set()
        for batch in batches:
            tokens, groups = [], []
            for grp, prefix in zip(batch.column("grp").to_pylist(), batch.column("prefix")):
                if grp is not None and grp not in seen:
                    seen.add(grp)
                    tokens.append(np.frombuffer(prefix.as_buffer(), U64))
                    groups.append(np.full(len(tokens[-1]), grp, np.int64))
            if len(seen) > 1_000_000:  # a repeated group costs rows, no more
                seen.clear()
            if not tokens:
                continue
            tokens, groups = np.concatenate(tokens), np.concatenate(groups)
            bucket = ((tokens >> U64(8)) % U64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            tokens, groups = tokens[order], groups[order]
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = np.flatnonzero(cuts[1:] > cuts[:-1])
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array(full, pa.int32()),
                "tokens": pa.array([tokens[cuts[k] : cuts[k + 1]].tobytes() for k in full], pa.binary()),
                "groups": pa.array([groups[cuts[k] : cuts[k + 1]].tobytes() for k in full], pa.binary())})

    def gather(pdf):
        tokens = np.frombuffer(b"".join(pdf["tokens"]), U64)
        groups = np.frombuffer(b"".join(pdf["groups"]), np.int64)
        order = np.lexsort((groups, tokens))
        tokens, groups = tokens[order], groups[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (groups[1:] != groups[:-1])
        tokens, groups = tokens[new], groups[new]
        same = tokens[1:] == tokens[:-1]
        shared = np.zeros(len(tokens), bool)
        shared[1:] |= same
        shared[:-1] |= same
        import pandas as pd
        return pd.DataFrame({"token": tokens[shared].view(np.int64), "grp": groups[shared]})

    sent = sets.select("grp", "prefix").mapInArrow(scatter, "bucket int, tokens binary, groups binary")
    return sent.groupBy("bucket").applyInPandas(gather, "token long, grp long")


def verified(docs: DataFrame, pairs: DataFrame, keys: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of members whose whole sets are similar enough; the sets are made again from the texts."""
    pairs = staged(pairs.distinct(), "pairs")
    needed = pairs.select(F.col("a").alias("member")).union(pairs.select("b")).distinct().join(keys, "member")
    bits = docs.sparkSession.sparkContext.broadcast(id_filter(needed, "text_key"))
    schema = pa.schema([("member", pa.int64()), ("shingles", pa.binary())])

    def fetch(batches):
        seen = set()
        for batch in batches:
            keys_here = key_of_texts(batch.column("text"))
            wanted = passes(bits.value, keys_here)
            new = np.zeros(len(wanted), bool)
            for i in np.flatnonzero(wanted):
                if keys_here[i] not in seen:
                    seen.add(keys_here[i])
                    new[i] = True
            if len(seen) > 1_000_000:
                seen.clear()
            out, held = ([], []), 0
            for _, shingles in text_sets(batch.column("text"), words, new):
                out[0].append(xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63))
                out[1].append(shingles.tobytes())
                held += shingles.nbytes
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary())], schema=schema)
                    out, held = ([], []), 0
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary())], schema=schema)

    def compare(batch):
        links = ([], [])
        for a, b, x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("x"), batch.column("y")):
            x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(y) - both):
                links[0].append(a)
                links[1].append(b)
        yield {"a": links[0], "b": links[1]}

    sets = staged(docs.select("text").mapInArrow(fetch, "member long, shingles binary")
                  .join(needed.select("member"), "member", "left_semi").dropDuplicates(["member"]), "sets")
    joined = (
        pairs.join(sets.select(F.col("member").alias("a"), F.col("shingles").alias("x")), "a")
        .join(sets.select(F.col("member").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
    )
    return staged(joined.mapInArrow(in_batches(compare, pa.schema([("a", pa.int64()), ("b", pa.int64())])), "a long, b long"), "links")


def ordered_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def star_pairs(lists: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """In every list, pairs of the most common group with each other group, expanded to members.

    In a family of edited copies the original has the most common shingles, so most of the family links to it.
    """
    groups = members.groupBy("grp").agg(F.min("member").alias("rep"), F.first("n").alias("n"), F.max("common").alias("common"))
    known = lists.join(groups, "grp")
    anchors = known.groupBy("token").agg(F.max_by(F.struct("grp", "rep", "n"), F.struct("common", "grp")).alias("top"))
    group_pairs = (
        known.join(anchors, "token").filter("grp <> top.grp")
        .filter(F.least("n", "top.n") * 100 >= F.greatest("n", "top.n") * percent)
        .select(F.col("top.rep").alias("rep"), "grp").distinct()
    )
    within = groups.select("rep", "grp")
    return ordered_pairs(group_pairs.union(within).join(members.select("grp", "member"), "grp"), "rep", "member")


def filtered(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs that sizes and whole signatures can't rule out: few but true links stay."""
    side = lambda k: members.select(F.col("member").alias(k), F.col("n").alias(f"n_{k}"), F.col("whole_sig").alias(f"sig_{k}"))
    both = pairs.distinct().join(side("a"), "a").join(side("b"), "b")

    def keep(batch):
        sizes = np.stack([batch.column(f"n_{k}").to_numpy() for k in "ab"], axis=1)
        good = np.zeros(len(sizes), bool)
        for i, pair in enumerate(zip(batch.column("sig_a"), batch.column("sig_b"))):
            x, y = (np.frombuffer(sig.as_buffer(), np.uint8) for sig in pair)
            least = min(len(x), len(y))
            x, y = (folded(sig, least).view(np.uint64)[None, :] for sig in (x, y))
            good[i] = may_link(sizes[i : i + 1, 0], sizes[i : i + 1, 1], x, y, percent)[0]
        yield {k: batch.column(k).to_numpy()[good] for k in "ab"}

    return both.mapInArrow(in_batches(keep, pa.schema([("a", pa.int64()), ("b", pa.int64())])), "a long, b long")


def remaining_pairs(lists: DataFrame, members: DataFrame, roots: DataFrame, percent: int, block: int = LIST_BLOCK) -> DataFrame:
    """All pairs of members that share a prefix shingle (or a group), may be similar, and aren't connected yet.

    Pairs are filtered before they leave the task. A list longer than ``block`` is cut into blocks and dealt out as pairs
    of blocks. Members of the root that has most of a long list need no pairs among themselves, so their
    blocks only meet those of the others: a family that is already connected costs its size times the few that aren't.
    """
    whole = lists.union(members.select(F.col("grp").alias("token"), "grp"))  # members of one group share its prefix
    rows = whole.join(members.select("grp", "member"), "grp").join(roots.withColumnRenamed("id", "member"), "member", "left")
    rows = rows.select("token", "member", F.coalesce("root", "member").alias("root"))
    # Two groups are paired by the star; a third set or a second member of a group can still be open.
    counts = rows.groupBy("token", "root").agg(F.count(F.lit(1)).alias("m"))
    open_lists = counts.groupBy("token").agg(F.sum("m").alias("m"), F.max(F.struct("m", "root")).alias("top")).filter("m >= 3 AND top.m < m")
    cut, most, others = F.col("m") > block, F.col("top.m"), F.col("m") - F.col("top.m")
    open_lists = open_lists.select(
        "token", F.col("top.root").alias("top_root"), F.when(cut, F.ceil(most / block)).otherwise(0).cast("int").alias("top_parts"),
        F.when(cut, F.ceil(others / block)).otherwise(1).cast("int").alias("parts"))
    rows = rows.join(open_lists, "token").withColumn("in_top", (F.col("root") == F.col("top_root")) & (F.col("top_parts") > 0))
    spread = F.xxhash64("member")
    rows = rows.withColumn("part", F.when(F.col("in_top"), F.pmod(spread, F.greatest("top_parts", F.lit(1)))).otherwise(
        F.col("top_parts") + F.pmod(spread, F.col("parts"))).cast("int"))
    first = F.when(F.col("in_top"), F.col("top_parts")).otherwise(0)
    rows = rows.withColumn("other", F.explode(F.sequence(first, F.col("top_parts") + F.col("parts") - 1)))
    rows = rows.select("token", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "member", "root")
    rows = rows.join(members.select("member", "n", "sig"), "member")
    dealt = rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")

    def pairs_of(part):
        """Pairs of one list or pair of blocks, in steps of one row against the rest."""
        own, n, root = (part.column(k).to_numpy() for k in ("part", "n", "root"))
        ids, sig = part.column("member").to_numpy(), signatures(part.column("sig"))
        across = part.column("i")[0].as_py() != part.column("j")[0].as_py()
        a, b = [], []
        for k in range(len(ids) - 1):
            rest = np.flatnonzero(root[k + 1 :] != root[k]) + k + 1
            if across:
                rest = rest[own[rest] != own[k]]
            if len(rest):
                rest = rest[may_link(n[rest], n[k], sig[rest], sig[k], percent)]
                a.append(np.minimum(ids[rest], ids[k]))
                b.append(np.maximum(ids[rest], ids[k]))
        return a, b

    def compare(batches):
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
            key = [table.column(k).to_numpy() for k in ("token", "i", "j")]
            new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in key], axis=0)) + 1 if len(table) else []
            cuts = [0, *new]
            yield from emit(table, cuts)
            kept = table.slice(cuts[-1])
        if kept is not None and len(kept):
            yield from emit(kept, [0, len(kept)])

    def emit(table, cuts):
        table = table.combine_chunks()
        a, b = [], []
        for first, last in zip(cuts[:-1], cuts[1:]):
            if last - first > 1:
                x, y = pairs_of(table.slice(first, last - first))
                a += x
                b += y
        if a:
            found = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
            yield pa.RecordBatch.from_pydict({"a": found[0], "b": found[1]})

    return dealt.mapInArrow(compare, "a long, b long")


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles (set size), component_id (smallest doc_id reachable by links).

    Documents link when 100 * intersection >= percent * union of their sets of ``words``-word shingles. Links inside
    a component that is already connected are not all written out; no component misses one. Null or empty texts have an empty
    set and no links; shorter texts are one shingle; repeated rows are copies and link; documents without an id
    take part and come back with a null doc_id; an empty table gives no rows; extra columns are left aside.
    Shingles and sets are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    docs = text_only(docs)
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sets = staged(document_sets(docs, words, percent), "sets")
    full = sets.filter("member IS NOT NULL")
    members = staged(full.groupBy("grp", "member").agg(F.min("text_key").alias("text_key"), F.first("n").alias("n"), F.first("common").alias("common"),
                                                       F.first("sig").alias("sig"), F.first("whole_sig").alias("whole_sig")), "members")
    lists = staged(shared_shingles(full, buckets), "lists")
    keys = members.select("member", "text_key")
    links = verified(docs, filtered(star_pairs(lists, members, percent), members, percent), keys, words, percent)
    roots = components(spark, links)
    more = verified(docs, filtered(remaining_pairs(lists, members, roots, percent), members, percent), keys, words, percent)
    if not more.isEmpty():
        roots = components(spark, links.union(more))
    # A row per set first, so that copies of one text don't meet at their root; staged sides let adaptive execution split what is left.
    own = full.groupBy("member").agg(F.min("doc_id").alias("first")).join(roots.withColumnRenamed("id", "member"), "member", "left")
    own = staged(own.select("member", "first", F.coalesce("root", "member").alias("root")), "own")
    smallest = staged(own.groupBy("root").agg(F.min("first").alias("smallest")), "smallest")
    of_set = own.join(smallest, "root").select("member", "smallest")
    return sets.select("doc_id", "n", "member").join(of_set, "member", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("smallest", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents, with all their columns, that come first (by doc_id, nulls last, then by row) in their component.

    Every document without words stays. A column named ``_row`` is replaced on the way and doesn't come back.
    """
    names = [c for c in docs.columns if c.lower() != "_row"]
    rows = staged(docs.select(names).withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = jaccard_components(rows.select(F.col("_row").alias("doc_id"), "text"), words, percent).withColumnRenamed("doc_id", "_row")
    ids = rows.select("_row", F.col("doc_id").cast("long").alias("own"))
    first = found.join(ids, "_row").groupBy("component_id").agg(F.min(F.struct(F.col("own").isNull().alias("none"), "own", "_row")).alias("first"))
    return rows.join(first.select(F.col("first._row").alias("_row")), "_row", "left_semi").select(names)
