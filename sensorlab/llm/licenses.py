"""License scan: phrases, and license templates whose markup is compiled into token automata.

A template is text in which ``<<optional>> ... <</optional>>`` may be left out and ``<<var: a-b>>`` stands for any a
to b words; all other words are mandatory and must match exactly and in order, wherever the text starts. A template
becomes a list of states, each with its word edges and its free moves, and texts run through it by sets of states.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sensorlab.llm.common import in_batches, text_only
from sensorlab.llm.words import ALNUM, LOWER, U64, find_words, hash_words, mix, slices, utf8_column

#: Phrase and label.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Label and template of common notices.
TEMPLATES = {
    "mit-notice": "released under the mit license",
    "apache-2-notice": "licensed under the apache license <<optional>>version 2<<optional>>0<</optional>><</optional>>",
    "gpl-notice": "<<var: 1-6>> is <<optional>>free software<</optional>> licensed under the gnu <<optional>>lesser<</optional>> general public license "
                  "<<optional>>version <<var: 1-1>><</optional>>",
    "cc-notice": "licensed under <<optional>>a<</optional>> <<optional>>creative commons<</optional>> cc by <<optional>>nc<</optional>> <<optional>>sa<</optional>> <<var: 1-1>> 0",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software <<optional>>and associated documentation files "
                "the software<</optional>> to deal in <<var: 1-2>> <<optional>>software<</optional>> without restriction",
    "apache-2-text": "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "isc-text": "permission to use copy modify and <<optional>>or<</optional>> distribute this software for any purpose with or without fee is hereby granted",
}

ANY = None


class Automaton:
    """States 0..n; ``words[s]`` lists (word or ANY, next state), ``free[s]`` states reached without a word."""

    def __init__(self, label: str, template: str):
        self.label, self.words, self.free = label, [[]], [[]]
        opened: list[int] = []
        for token in re.findall(r"<<[^>]*>>|[^\s<>]+", template):
            if token == "<<optional>>":
                opened.append(len(self.words) - 1)
            elif token == "<</optional>>":
                self.free[opened.pop()].append(len(self.words) - 1)
            elif token.startswith("<<var:"):
                least, most = map(int, token[6:-2].split("-"))
                start = [self._word(ANY) for _ in range(most)][0] - 1
                for s in range(start + least, start + most):
                    self.free[s].append(start + most)
            else:
                self._word(token)
        if opened or not template.strip():
            raise ValueError(f"template {label!r} is empty or not closed")
        self.mandatory = [w for state in self.words for w, _ in state if w is not ANY]

    def _word(self, word) -> int:
        self.words.append([])
        self.free.append([])
        self.words[-2].append((word, len(self.words) - 1))
        return len(self.words) - 1

    def closure(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return seen

    def lead(self) -> tuple[int, int]:
        """The first state whose next word is mandatory, and the most words that stand before it."""
        s = 0
        while not any(w is not ANY for w, _ in self.words[s]) or any(self.free[s]):
            s += 1
        return s, s

    def accepts_from(self, word_at, start: int, n: int) -> bool:
        """Whether some run of words from ``start`` is accepted; ``word_at`` gives the word at a place."""
        last, states = len(self.words) - 1, self.closure({0})
        at = start
        while states:
            if last in states:
                return True
            if at >= n:
                return False
            word = word_at(at)
            states = self.closure({t for s in states for w, t in self.words[s] if w is ANY or w == word})
            at += 1
        return False


def word_hash(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    return hash_words(data, np.r_[0, ends[:-1]].astype(np.int64), ends.astype(np.int64))


def pair(h: np.ndarray, g: np.ndarray) -> np.ndarray:
    return mix(h * U64(3) + g)


RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])


def scan_licenses(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None) -> DataFrame:
    """Per document: n_words, n_base (places of phrases), first_word and last_word (their smallest and largest
    start, else null), base_labels, labels (with those of accepted templates), score.

    Words are runs of digits, letters (A-Z lower-cased) and characters beyond ASCII, over the whole text. A place
    counts once for each phrase that starts there. The score is 1 where a template is accepted, 0.5 where only a
    phrase stands, else 0. Null and empty texts have no words, empty labels and score 0; repeated rows stay; an
    empty table gives no rows; extra columns are left aside.
    """
    phrases = PHRASES if phrases is None else phrases
    automata = [Automaton(k, t) for k, t in (TEMPLATES if templates is None else templates).items()]
    base = [(p.split(), label) for p, label in phrases.items()]
    vocabulary = sorted({w for words, _ in base for w in words} | {w for a in automata for w in a.mandatory})
    hashes = word_hash(vocabulary)
    order = np.argsort(hashes)
    known = hashes[order]
    code = {vocabulary[k]: i for i, k in enumerate(order)}
    # Every automaton starts where its first two mandatory words that stand together do.
    leads = []
    for a in automata:
        for s in range(len(a.words) - 2):
            one, two = a.words[s][0][0], a.words[s + 1][0][0]
            if one is not ANY and two is not ANY and not _skippable(a, s, s + 2):
                leads.append((a, s, code[one], code[two]))
                break
        else:
            raise ValueError(f"template {a.label!r} needs two mandatory words in a row")

    def scan(batch):
        data, offsets = utf8_column(batch.column("text"))
        ids = batch.column("doc_id")
        for first, last in slices(offsets):
            at = offsets[first : last + 1] - offsets[first]
            lowered = LOWER[data[offsets[first] : offsets[last]]]
            starts, ends, before = find_words(lowered, at, ALNUM)
            h = hash_words(lowered, starts, ends)
            place = np.minimum(np.searchsorted(known, h), len(known) - 1)
            codes = np.where(known[place] == h, place, -1)
            text_of = np.searchsorted(before, np.arange(len(h)), side="right") - 1
            found = [[] for _ in range(last - first)]
            for words, label in base:
                for k in _runs(codes, text_of, [code[w] for w in words]):
                    found[text_of[k]].append((int(k - before[text_of[k]]), label))
            more = [set() for _ in range(last - first)]
            for a, s, one, two in leads:
                for k in _runs(codes, text_of, [one, two]):
                    row = text_of[k]
                    if a.label in more[row]:
                        continue
                    lo, hi = before[row], before[row + 1]
                    word_at = lambda i: vocabulary[order[codes[i]]] if codes[i] >= 0 else ""
                    if any(a.accepts_from(word_at, i, hi) for i in range(max(lo, k - s), k + 1)):
                        more[row].add(a.label)
            out = {name: [] for name in RESULT.names}
            for i in range(last - first):
                places, labels = [p for p, _ in found[i]], {label for _, label in found[i]}
                row = (ids[first + i].as_py(), int(before[i + 1] - before[i]), len(places), min(places, default=None), max(places, default=None),
                       ",".join(sorted(labels)), ",".join(sorted(labels | more[i])), 1.0 if more[i] else 0.5 if labels else 0.0)
                for name, value in zip(RESULT.names, row):
                    out[name].append(value)
            yield out

    return text_only(docs).mapInArrow(in_batches(scan, RESULT), "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                                      "base_labels string, labels string, score double")


def _skippable(a: Automaton, first: int, last: int) -> bool:
    """Whether a free move jumps over (part of) the words between two states."""
    return any(s < last and t > first for s, free in enumerate(a.free) for t in free)


def _runs(codes: np.ndarray, text_of: np.ndarray, run: list[int]) -> np.ndarray:
    """Places where the codes stand one after another within a text."""
    if len(codes) < len(run):
        return np.zeros(0, np.int64)
    n = len(codes) - len(run) + 1
    hit = np.flatnonzero(codes[:n] == run[0])
    for k, c in enumerate(run[1:], 1):
        hit = hit[codes[hit + k] == c]
    return hit[text_of[hit] == text_of[hit + len(run) - 1]]
