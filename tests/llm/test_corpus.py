"""Repeated spans, leaks, packing, search."""

import math
import random
import re
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from sensorlab.llm import decontaminate, packing, spans, topk
from sensorlab.llm.queries import QUERIES, packed_digest
from llm.conftest import edited, prose

PASSAGE = ("Every house by the river keeps a lamp burning through the night. It shows the way to those who walk late under trees. "
           "Nobody in the valley remembers who lit the first of these lamps. They only know that it must never go out. "
           "So each of them takes a turn, and the oil is paid by all who live there or pass.")


def test_sentences_join_to_the_text():
    rng = random.Random(4)
    for _ in range(500):
        text = "".join(rng.choice("ab .!?\n\t\"') é") for _ in range(rng.randrange(60)))
        assert "".join(spans.sentences(text)) == text


def test_runs_are_the_shortest_from_each_start():
    rng = random.Random(6)
    for _ in range(300):
        parts = ["x " * rng.randrange(0, 12) + ". " for _ in range(rng.randrange(12))]
        full = [i for i, p in enumerate(parts) if "x" in p]
        want = []
        for k in range(len(full)):
            for end in range(k + 1, len(full) + 1):
                words = sum(parts[i].count("x") for i in full[k:end])
                if words >= 14 or end - k >= 2 and words >= 9:
                    want.append((full[k], full[end - 1] - full[k] + 1))
                    break
        assert [r[:2] for r in spans.runs(parts, 2, 9, 14)] == want


def test_dedup_equals_plain_version(spark):
    rng = random.Random(7)
    sentence = lambda: prose(rng, rng.randrange(3, 14)).capitalize() + "."
    texts = [" ".join(sentence() for _ in range(6)) + ("\n" + PASSAGE + "\n" if i % 3 == 0 else " ") + sentence() for i in range(30)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, texts[0]), (101, None), (102, ""), (None, texts[1]), (103, PASSAGE + "\n" + PASSAGE), (103, "Short. Short.")]
    seen, want = set(), {}
    for i, (doc, text) in sorted(enumerate(rows), key=lambda x: (x[1][0] is None, x[1][0] or 0, x[0])):
        parts = spans.sentences(text or "")
        gone = set()
        for first, size, key in spans.runs_both_ways(parts, 2, 25, 40):
            if key in seen:
                gone |= set(range(first, first + size))
            seen.add(key)
        want.setdefault((doc, text), []).append(text if not gone else "".join(p for k, p in enumerate(parts) if k not in gone))
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, row string, cover int").coalesce(1)
    for parts in (1, 6):
        got = spans.dedup_spans(docs.repartition(parts, "doc_id", "text") if parts > 1 else docs)
        assert got.columns == ["doc_id", "text", "n_removed", "removed"]
        assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted(((d, x) for (d, _), xs in want.items() for x in xs), key=str)
    assert sum(PASSAGE in (r["text"] or "") for r in got.collect()) == 1
    assert spans.dedup_spans(docs.limit(0)).count() == 0


def every_repeated_run(rows, min_sentences, min_words, long_words):
    """Per row the text that stays, by comparing every long enough run of sentences, of any length."""
    seen, out = set(), []
    for text in rows:
        parts = spans.sentences(text)
        words = [tuple(re.findall(r"\w+", p.lower())) for p in parts]
        full, gone = [i for i, w in enumerate(words) if w], set()
        for a in range(len(full)):
            for b in range(a + 1, len(full) + 1):
                run = tuple(words[i] for i in full[a:b])
                held = sum(map(len, run))
                if held < long_words and (b - a < min_sentences or held < min_words):
                    continue
                if run in seen:
                    gone |= set(range(full[a], full[b - 1] + 1))
                seen.add(run)
        out.append("".join(p for k, p in enumerate(parts) if k not in gone))
    return out


def test_dedup_takes_repeated_passages_whole(spark):
    rng = random.Random(17)
    line = lambda n: " ".join("w%d" % rng.randrange(10 ** 9) for _ in range(n)) + "."
    texts = []
    for sizes in ((30, 12, 12), (45, 6), (12, 12, 30), (6, 45), (9, 8, 7, 6, 5), (24, 1), (12, 12)):
        passage = " ".join(map(line, sizes))
        texts += [f"{line(7)} {passage} {line(20)}", f"{line(20)} {passage} {line(3)} {line(30)}", f"{passage}\n...\n{line(9)}"]
    pool = [line(n) for n in (2, 3, 5, 8, 12, 13, 24, 26, 39, 41)]
    texts += [" ".join(rng.choice(pool) if rng.random() < 0.8 else line(rng.randrange(1, 30)) for _ in range(rng.randrange(1, 12))) for _ in range(120)]
    want = every_repeated_run(texts, 2, 25, 40)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for parts in (1, 5):
        got = spans.dedup_spans(docs.repartition(parts)).orderBy("doc_id").collect()
        assert [r["text"] for r in got] == want


def test_a_task_of_many_copies_sends_its_places_in_parts(spark):
    text = " ".join(f"w{j} x{j} y{j}." for j in range(40))
    docs = spark.createDataFrame([(i, text) for i in range(300)], "doc_id long, text string").coalesce(1)
    limits = (2, 25, 40)
    many, few = (sorted(map(tuple, spans.repeated_runs(docs.selectExpr("doc_id AS row", "doc_id", "text"), limits, held).collect())) for held in (7, 500_000))
    assert many == few and len({r[0] for r in many}) == 299 and min(r[0] for r in many) == 1


def test_op5_and_the_pipeline_take_passages_whole(spark, tmp_path):
    line = lambda k, n: " ".join(f"w{k}x{j}" for j in range(n)) + "."
    passage = f"{line(0, 30)} {line(1, 12)} {line(2, 12)}"
    rows = [(1, f"{line(3, 9)} {passage} {line(4, 20)}"), (2, f"{line(5, 9)} {passage} {line(6, 20)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for got in (QUERIES["op5_substring_dedup"](spark, str(tmp_path)), corpus_pipeline.cut_repeats(spark, docs, str(tmp_path))):
        assert [r["text"] for r in got.orderBy("doc_id").collect()] == [rows[0][1], f"{line(5, 9)} {line(6, 20)}"]


def test_alignment_equals_plain_smith_waterman():
    rng = random.Random(8)
    pairs = [([rng.randrange(5) for _ in range(rng.randrange(1, 20))], [rng.randrange(5) for _ in range(rng.randrange(1, 12))]) for _ in range(200)]
    want = []
    for t, i in pairs:
        h = np.zeros((len(i) + 1, len(t) + 1), int)
        for a in range(1, len(i) + 1):
            for b in range(1, len(t) + 1):
                h[a, b] = max(0, h[a - 1, b - 1] + (2 if i[a - 1] == t[b - 1] else -1), h[a - 1, b] - 1, h[a, b - 1] - 1)
        want.append(h.max())
    shift = np.uint64(7)  # padding is 0 and 1
    got = decontaminate.align([np.array(t, np.uint64) + shift for t, _ in pairs], [np.array(i, np.uint64) + shift for _, i in pairs])
    assert got.tolist() == want


def plain_score(text, item):
    """The best local alignment's share of the score of a whole copy."""
    h = np.zeros((len(item) + 1, len(text) + 1), int)
    for a in range(1, len(item) + 1):
        for b in range(1, len(text) + 1):
            h[a, b] = max(0, h[a - 1, b - 1] + (2 if item[a - 1] == text[b - 1] else -1), h[a - 1, b] - 1, h[a, b - 1] - 1)
    return h.max() / (2 * len(item))


def test_seeds_find_what_all_pairs_find(spark):
    rng = random.Random(19)
    word = lambda: "w%d" % min(rng.randrange(400), rng.randrange(400))
    words = lambda n: [word() for _ in range(n)]
    items = [words(rng.randrange(20, 45)) for _ in range(12)]
    for item in items[:6]:
        item[5:9] = ["which", "of", "the", "following"]  # a gram that many items share
    texts = []
    for i in range(90):
        copy = []
        share = rng.choice([0.0, 0.05, 0.15, 0.25])
        for w in rng.choice(items):
            kind = rng.random() / share if share else 9
            copy += [word()] if kind < 0.5 else [w, word()] if kind < 0.75 else [] if kind < 1 else [w]
        texts.append(words(rng.randrange(0, 60)) + (copy if i % 3 else words(30)) + words(rng.randrange(0, 40)))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    benchmark = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    want = {(i, k): plain_score(t, item) for i, t in enumerate(texts) for k, item in enumerate(items)}
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.find_leaks(docs, benchmark).collect()}
    sure = {pair for pair, score in want.items() if score >= 0.5}
    assert len(sure) > 40 and set(got) == sure
    assert all(abs(got[pair] - want[pair]) < 1e-9 for pair in got)


def test_leaks_are_found_and_clean_documents_kept(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEM_BLOCK", 7)
    rng = random.Random(9)
    items = [(k, prose(rng, 30)) for k in range(10)] + [(10, "two words"), (11, None), (12, "")]
    texts, want = [], set()
    for i in range(60):
        text = prose(rng, 80)
        if i % 4 == 0:
            item = items[i % 10]
            text += " " + (item[1] if i % 8 else edited(rng, item[1], 0.1)).upper() + ", " + prose(rng, 40)
            want.add((i, item[0]))
        texts.append((i, text, 1.0))
    texts += [(100, "Some two words here", 1.0), (101, None, 1.0), (102, "", 1.0), (None, items[3][1], 1.0), (103, prose(rng, 20_000), 1.0)]
    docs, benchmark = spark.createDataFrame(texts, "doc_id long, text string, score double"), spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, benchmark).collect()}
    assert found == want | {(100, 10), (None, 3)}
    kept = decontaminate.drop_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {t[0] for t in texts} - {d for d, _ in found}
    assert decontaminate.find_leaks(docs, benchmark.limit(0)).count() == 0 and decontaminate.find_leaks(docs.limit(0), benchmark).count() == 0
    assert decontaminate.drop_leaks(docs, benchmark.limit(0)).count() == len(texts)


def simulated(rows, window):
    """Deficit round-robin by a loop over rounds; rows are (row, source, n) in queue order."""
    total = sum(n for *_, n in rows)
    queues = {}
    for row, source, n in rows:
        queues.setdefault(source, []).append((row, n))
    quantum = {s: sum(n for _, n in q) / total * window for s, q in queues.items()}
    credit, order = dict.fromkeys(queues, 0.0), []
    while any(queues.values()):
        for s in sorted(queues, key=lambda s: (s is not None, s or "")):
            credit[s] += quantum[s]
            while queues[s] and credit[s] > 1e-9:
                row, n = queues[s].pop(0)
                credit[s] -= n
                order.append(row)
    return order


def test_schedule_is_deficit_round_robin(spark):
    rng = random.Random(10)
    rows = [(k + (k // 70 << 33), rng.choice(["a", "a", "a", "b", None]), rng.choice([1, 5, 90, 700])) for k in range(400)]
    got = packing.schedule(spark.createDataFrame(rows, "row long, source string, n long"), 256).orderBy("place").collect()
    assert [r["row"] for r in got] == simulated(rows, 256)
    size = {r[0]: r[2] for r in rows}
    assert [r["place"] for r in got] == np.cumsum([0] + [size[r["row"]] for r in got])[:-1].tolist()


def test_pieces_give_every_id_once(spark, docs, no_docs, corpus):
    file = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(file)
    ids = {}
    for doc, text, *_ in corpus:
        ids.setdefault(doc, []).append(tokenizer.encode(text or "", add_special_tokens=False).ids + [1])
    pieces = [r.asDict() for r in packed_digest(docs).collect()]
    total = sum(len(x) for xs in ids.values() for x in xs)
    assert sum(p["length"] for p in pieces) == total
    for p in pieces:
        assert any(len(x) == p["doc_tokens"] and zlib.crc32(np.array(x[p["start"] : p["start"] + p["length"]], "<u4").tobytes()) == p["ids_crc32"] for x in ids[p["doc_id"]])
    places = sorted((p["sequence_id"], p["offset"], p["length"]) for p in pieces)
    assert [s * 2048 + o for s, o, _ in places] == np.cumsum([0] + [n for *_, n in places])[:-1].tolist()
    assert max(o + n for _, o, n in places) <= 2048 and places[-1][0] == math.ceil(total / 2048) - 1
    assert packed_digest(no_docs).count() == 0


def test_word_ids_equal_the_tokenizer():
    definition = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    coder, tokenizer = packing.WordIds(definition), Tokenizer.from_str(definition)
    rng = random.Random(11)
    texts = ["a<|endoftext|>b <|startoftext|>x", "don't 12a's 'S", "ÀÉ ΣΑΣ İx ª1 a.…b '.'s It's,it'll", "", "  ", "áb. É! ﬁ Ǆ ẞ", "日本語 テスト。 привет,мир!", "a\xa0b\x1cc"]
    texts += ["".join(rng.choice("abZ é'sÉ.,#1\u0301\n<|>Σ…") for _ in range(rng.randrange(40))) for _ in range(2000)]
    for text, got in zip(texts, coder.encode([t.encode() for t in texts])):
        assert np.frombuffer(got, coder.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_top_k_equals_all_products(spark):
    rng = np.random.default_rng(12)
    vectors = rng.normal(size=(400, 6)).astype(np.float32)
    vectors[50:90] = vectors[50]
    rows = [(int(i), v.tolist()) for i, v in enumerate(vectors)]
    rows += [(400, None), (410, [1.0] * 5 + [None]), (420, [float("nan")] * 6), (430, [float("inf")] * 6), (None, [1.0] * 6), (440, [1.0, 2.0]), (450, [3.0, 4.0]), (451, []), (20, [0.5] * 6)]
    whole = [(i, tuple(math.floor(256 * np.float32(x).item()) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for i, q in whole:
        if i % 10 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole if j != i and len(v) == len(q))[:5]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(scores)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rank int, query int").repartition(4)
    got = topk.top_k(df, 10, task_rows=64, block=16, query_block=9)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk.top_k(df.limit(0), 10).count() == 0


def test_large_components_stay_exact():
    big = np.array([[2.0**40, 3.0]])
    assert topk.products(big, big).tolist() == [[2**63 - 1]]
    assert topk.products(np.array([[2.0**30, 1.0]]), np.array([[2.0**30, 1.0]])).tolist() == [[2**60 + 1]]


def test_a_large_finite_component_takes_part(spark):
    rows = [(0, [1e307, 1.0]), (1, [1e307, -1.0]), (2, [-1e307, 2.0]), (3, [0.5, 0.25]), (4, [float("inf"), 1.0]), (5, [-0.5, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df, 5).orderBy("query_id", "rank").collect()]
    top, low = 2**63 - 1, -(2**63)
    assert got == [(0, 1, 1, top), (0, 2, 3, top), (0, 3, 2, low), (0, 4, 5, low), (5, 1, 2, top), (5, 2, 3, -128 * 128 + 256 * 64), (5, 3, 0, low), (5, 4, 1, low)]
