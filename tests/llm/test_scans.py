"""URL rules, license templates, token counts."""

import random
import re

import pytest
from tokenizers import Tokenizer, models

from sensorlab.llm import licenses, urls, viterbi
from sensorlab.llm.queries import URL_RULES


def plain_verdict(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(r), r.partition("/")[0].count("."), r, v) for r, v in rules for h, s, p in [r.partition("/")]
            if (host == h or host.endswith("." + h)) and path.startswith(s + p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


def test_urls_equal_plain_rules(spark):
    rng = random.Random(3)
    hosts = ["example.com", "www.example.com", "WWW.Example.com", "a.net", "net", "xcom", "com", "example.com:80", "", "b.www.example.com"]
    paths = ["", "/", "/en", "/en/", "/en/x/y", "/fr/1", "/es/", "/EN/", "//en/", "/en/" + "z" * 50_000]
    made = [rng.choice(["http", "", "ftp"]) + "://" + rng.choice(hosts) + rng.choice(paths) + rng.choice(["", "?q=/en/", "#a://b", "?"]) for _ in range(300)]
    made += [None, "", "example.com/en/", "://", "a://b://c", made[0]]
    rules = URL_RULES + [("com/en", "block"), ("example.com/en/x", "allow"), ("b.www.example.com", "block")]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(made)], "page_id long, url string, host string, rule string")
    got = {r["page_id"]: tuple(r)[1:] for r in urls.judge_urls(pages, rules).collect()}
    assert got == {i: plain_verdict(u, rules) for i, u in enumerate(made)}
    assert urls.judge_urls(pages.limit(0), rules).count() == 0


def test_many_rules_go_in_several_tries(spark, monkeypatch):
    monkeypatch.setattr(urls, "MOST_RULES", 2)
    pages = spark.createDataFrame([(1, "http://www.example.com/en/1"), (2, "http://x.example.com/en/")], "page_id long, url string")
    assert [r["verdict"] for r in urls.judge_urls(pages, URL_RULES).orderBy("page_id").collect()] == ["allow", "block"]


TEXTS = ["Released under the MIT License.", "mit MIT license license mit license", "mit-license; APACHE\nlicense", "the mitlicense", None, "", "É",
         "Licensed under the Apache License, Version 2.0.", "licensed under the apache license", "licensed under apache license",
         "This work is licensed under the GNU General Public License, version 3.", "is licensed under the gnu general public license",
         "This is free software licensed under the GNU lesser general public license", "Licensed under CC BY-NC 4.0.", "licensed under a creative commons cc by 4 0",
         "licensed under cc by 4 1", "w " * 60_000 + "general public license"]


def test_licenses(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(1, TEXTS[1], "x")], "doc_id long, text string, labels string")
    rows = licenses.scan_licenses(docs).orderBy("doc_id").collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(TEXTS) + 1
    for i, text in enumerate(TEXTS):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
        places = [(k, label) for p, label in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        r = got[i]
        starts = [k for k, _ in places]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(places), min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert {label for _, label in places} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    labels = [got[i]["labels"] for i in (0, 7, 8, 9, 10, 11, 12, 13, 14, 15)]
    assert labels == ["mit,mit-notice", "apache,apache-2-notice", "apache,apache-2-notice", "apache", "gpl,gpl-notice", "gpl", "gpl,gpl-notice",
                      "cc-notice", "cc-notice", ""]
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_automata_accept_what_the_pattern_says():
    a = licenses.Automaton("x", "a <<optional>>b <<optional>>c<</optional>><</optional>> <<var: 1-2>> d e")
    pattern = re.compile(r"a (b (c )?)?(\w+ ){1,2}d e ")
    rng = random.Random(1)
    for _ in range(3000):
        words = [rng.choice("abcdex") for _ in range(rng.randrange(1, 9))]
        assert a.accepts_from(lambda k: words[k], 0, len(words)) == bool(pattern.match(" ".join(words) + " "))
    with pytest.raises(ValueError):
        licenses.Automaton("x", "a <<optional>>b")


def test_viterbi_equals_tokenizer_on_random_vocabularies():
    rng = random.Random(2)
    for _ in range(1500):
        pieces = list({"".join(rng.choice("ab▁c") for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 9))})
        scored = [(p, float(-rng.randint(0, 4)) if rng.random() < 0.8 else -rng.random()) for p in pieces]
        tokenizer = Tokenizer(models.Unigram([("<unk>", 0.0), *scored], 0, False))
        counter = viterbi.Counter(scored)
        counter.unknown = min([0.0, *(s for _, s in scored)]) - viterbi.UNKNOWN_PENALTY  # the tokenizer's own <unk> counts
        text = "".join(rng.choice("abcd ") for _ in range(rng.randint(1, 14)))
        assert counter.count(text)[0] == len(tokenizer.encode("▁" + text.replace(" ", "▁")).ids), (scored, text)


def test_token_counts_of_documents(spark, docs, no_docs, corpus):
    import public_tokenizers

    file = public_tokenizers.path("piece_bpe_32k.model")
    tokenizer = Tokenizer(models.Unigram([("<unk>", 0.0), *viterbi.read_pieces(file)], 0, False))
    want = sorted(((r[0], len(tokenizer.encode("▁" + r[1].replace(" ", "▁")).ids) if r[1] else 0) for r in corpus), key=str)
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in viterbi.count_tokens(docs, file).collect()), key=str) == want
    assert viterbi.count_tokens(no_docs, file).count() == 0


def test_unknown_characters_count_as_their_bytes(spark):
    import public_tokenizers

    file, rng = public_tokenizers.path("piece_bpe_32k.model"), random.Random(12)
    pieces = viterbi.read_pieces(file)
    low = min(s for _, s in pieces) - 100.0  # never on a path of its own
    tokenizer = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces, *((f"<0x{b:02X}>", low) for b in range(256))], 0, True))
    # Texts of more unknown runs than one; the tokenizer's lower score for unknowns doesn't change a path.
    texts = ["漢", "漢 漢", "a\n\n\nb", "🙂🙂 you", "漢\n🙂", "\U00020000"]
    texts += ["".join(rng.choice(["the ", "of", "\n", "漢", "🙂", " ", "ꙮ", "river"]) for _ in range(rng.randrange(1, 30))) for _ in range(100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in viterbi.count_tokens(docs, file).collect()}
    assert got == {i: len(tokenizer.encode("▁" + t.replace(" ", "▁")).ids) for i, t in enumerate(texts)}
    assert got[0] == 4
