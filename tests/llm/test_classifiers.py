import zlib

import pytest
from pyspark.sql import functions as F

from llm.conftest import WORDS
from sensorlab.llm import quality, toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def held_out(scores, labels, label):
    rows = scores.filter("held_out").join(labels.filter(f"{label} IS NOT NULL").select("doc_id", label), "doc_id").collect()
    ones, zeros = [r["score"] for r in rows if r[label]], [r["score"] for r in rows if not r[label]]
    auc = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))
    return auc, sum(r["predicted"] == r[label] for r in rows) / len(rows), rows


def test_toxicity_on_held_out_rows(tables):
    documents, labels = tables
    auc, accuracy, rows = held_out(toxicity.score_toxicity(documents, labels), labels, "toxic")
    # Some labelled texts of this table hold no word of the kind that marks the others, whatever is learnt.
    assert auc > 0.93 and accuracy > 0.95 and all(0 <= r["score"] <= 1 for r in rows)


def test_quality_on_held_out_rows(tables):
    documents, labels = tables
    auc, accuracy, rows = held_out(quality.score_quality(documents, labels), labels, "quality")
    assert auc > 0.98 and accuracy > 0.95 and all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows(spark, docs, no_docs, corpus):
    labels = spark.createDataFrame([(i, i % 2, None if i % 3 else i % 2, "x") for i in range(0, 60)] + [(3, 0, 0, "x"), (None, 1, 1, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    for run in (toxicity.score_toxicity, quality.score_quality):
        rows = run(docs, labels).collect()
        assert len(rows) == len(corpus) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in corpus)
        assert run(no_docs, labels).count() == 0
        assert run(docs, labels.limit(0)).count() == len(corpus)
    kept = toxicity.drop_toxic(docs, labels.limit(0))
    assert kept.columns == docs.columns


def test_score_reads_no_label_language_or_source(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    other = docs.withColumn("source", docs.doc_id.cast("string"))
    a, b = (sorted((str(r["doc_id"]), r["score"]) for r in toxicity.score_toxicity(d, labels).collect()) for d in (docs, other))
    assert a == b


def held_back_words(spark, rows=6600, late=400):
    """Labelled texts of which those beyond the first 6,000, by the hash of their ids, hold words and a language of their own."""
    ids = [r["doc_id"] for r in spark.range(1, 12 * rows).withColumnRenamed("id", "doc_id").filter(toxicity.fold(4) != 2)
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()]
    docs, labels = [], []
    for k, i in enumerate(ids):
        new, toxic = k >= rows - late, k % 2
        filler = f"river stone light {WORDS[k % len(WORDS)]} paper house"
        docs.append((i, f"{filler} {('zorgle' if toxic else 'placid') if new else ('vile' if toxic else 'calm')} walks", "xx" if new else "en"))
        labels.append((i, toxic))
    texts = {"zorgle": 1, "placid": 0, "vile": 1, "calm": 0}
    asked = [i for i in range(10 ** 7, 10 ** 7 + 100) if zlib.crc32(str(i).encode()) % 4 == 2][:4]
    docs += [(i, f"river stone {word} walks", "xx") for i, word in zip(asked, texts)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(zip(asked, texts.values()))


@pytest.mark.parametrize("piece", [4096, 500])
def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch, piece):
    monkeypatch.setattr(toxicity, "PIECE_ROWS", piece)
    docs, labels, asked = held_back_words(spark)
    found = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, labels).filter("held_out").collect()}
    assert {i: found[i]["predicted"] for i in asked} == asked
    assert found[min(asked)]["threshold"] != 0.3  # of a language that only those rows have
    kept = {r["doc_id"] for r in toxicity.drop_toxic(docs, labels).collect()}
    assert kept & asked.keys() == {i for i, toxic in asked.items() if not toxic}


def test_toxicity_learns_from_whole_texts(spark):
    word = lambda i: " ".join(f"w{(i * 31 + k) % 50}" for k in range(12_000))
    rows = [(i, f"{word(i)} {'zorgle' if i % 2 else 'placid'} {' '.join(['river'] * 200)} {word(i + 1)}", i % 2) for i in range(120)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(10 ** 7 + k, t) for k, t in enumerate(["river zorgle", "river placid"])], "doc_id long, text string")
    found = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, spark.createDataFrame([r[::2] for r in rows], "doc_id long, toxic int")).collect()}
    assert found[10 ** 7] > 0.5 > found[10 ** 7 + 1]


def test_vectors_of_the_words_that_tell_most(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "VECTORS", 3)
    own = spark.createDataFrame([(i % 2, f"{'zorgle' if i % 2 else 'placid'} {WORDS[i % 19]} {WORDS[i % 7]} the") for i in range(100)], "label int, text string")
    words, prefixes = toxicity.odds(own, 100, 50)
    assert len(words[0]) == 3 and len(prefixes[0]) <= 3 and sorted(abs(words[1]) > 4) == [False, True, True]
    counted = {(r["kind"], r["hash"]): (r["texts"], r["ones"]) for r in toxicity.word_counts(own.repartition(7)).collect()}
    assert max(counted.values()) == (100, 50) and sum(v == (50, 50) for v in counted.values()) == 2
