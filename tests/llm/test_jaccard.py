import pytest

from sensorlab.llm import jaccard
from sensorlab.llm.common import components


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    smallest = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            smallest[find(i)] = min(r[0], smallest.get(find(i), r[0]))
    return sorted(((r[0], len(sets[i]), smallest.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows)), key=str)


def test_components_equal_all_pairs(corpus, docs):
    got = jaccard.jaccard_components(docs).collect()
    assert sorted(map(tuple, got), key=str) == brute(corpus)


def test_blocks_of_long_lists_find_every_pair(spark, docs):
    """A list cut into pairs of small blocks gives the pairs of the whole list."""
    rows = jaccard.staged(jaccard.document_sets(jaccard.text_only(docs), 5, 80), "sets").filter("member IS NOT NULL")
    members = rows.dropDuplicates(["grp", "member"])
    lists = jaccard.shared_shingles(rows, 8)
    none = spark.createDataFrame([], "id long, root long")
    pairs = [set(map(tuple, jaccard.remaining_pairs(lists, members, none, 80, block).distinct().collect())) for block in (2048, 7)]
    assert pairs[0] == pairs[1] and len(pairs[0]) > 20


def test_connected_families_meet_only_the_rest(spark, docs):
    """Where most of a long list has one root, its blocks still meet all the others, and no pair of one root comes out."""
    rows = jaccard.staged(jaccard.document_sets(jaccard.text_only(docs), 5, 80), "sets").filter("member IS NOT NULL")
    members = rows.dropDuplicates(["grp", "member"])
    lists = jaccard.shared_shingles(rows, 8)
    none = spark.createDataFrame([], "id long, root long")
    every = set(map(tuple, jaccard.remaining_pairs(lists, members, none, 80, 2048).distinct().collect()))
    ids = sorted(r["member"] for r in members.select("member").distinct().collect())
    root = {m: ids[0] if k % 4 else m for k, m in enumerate(ids)}
    roots = spark.createDataFrame(list(root.items()), "id long, root long")
    want = {(a, b) for a, b in every if root[a] != root[b]}
    for block in (2048, 7, 3):
        got = set(map(tuple, jaccard.remaining_pairs(lists, members, roots, 80, block).distinct().collect()))
        assert got == want and len(want) > 20


def test_one_of_each_keeps_columns_and_clean_rows(corpus, docs):
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    want = {c for i, n, c in brute(corpus) if n and c is not None}
    rows = kept.collect()
    got = [r["doc_id"] for r in rows if shingles(r["text"])]
    assert sorted(got) == sorted(want)
    assert len([r for r in rows if not shingles(r["text"])]) == len([r for r in corpus if not shingles(r[1])])


def test_empty_table(no_docs):
    assert jaccard.jaccard_components(no_docs).count() == 0


@pytest.mark.parametrize("links", [[], [(1, 2), (2, 3), (9, 8), (3, 3)], [(k, k + 1) for k in range(40)] + [(100, k) for k in range(60, 80)]])
def test_connected_components(spark, links):
    root = {}
    for a, b in links:
        root.setdefault(a, a), root.setdefault(b, b)
    for _ in links:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r[0]: r[1] for r in components(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: v for k, v in root.items() if any(k in p and p[0] != p[1] for p in links)}
