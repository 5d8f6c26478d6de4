"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton finds all vocabulary pieces in a text; for every place the best score of a path to it and
that path's number of pieces are kept, nothing else. Ties go as in unigram tokenizers: ends are settled from the
left, starts are tried from the left, and only a better score replaces a path. A character without a piece of its own
scores 10 below the worst piece, and neighbouring unknown characters are one piece, or one for each UTF-8 byte where the model has byte pieces.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from sensorlab.llm.common import in_batches, text_only

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Segments whose counts a task remembers.
MOST_SEGMENTS = 500_000
SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def read_pieces(model_file: str) -> list[tuple[str, float]]:
    """Pieces and scores of a model file, without control, unknown and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


def has_bytes(model_file: str) -> bool:
    """Whether the model has a piece for every byte, for characters without a piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return sum(model.is_byte(i) for i in range(model.get_piece_size())) == 256


class Counter:
    """Scores and counts of texts. Segments are settled apart where that can't change a path.

    No piece goes on past a mark that follows another character, and whole-number scores add up exactly, so a text's
    best path is the best paths of its segments in a row; with other scores or pieces the text is one segment.
    """

    def __init__(self, pieces: list[tuple[str, float]], byte_pieces: bool = False):
        self.byte_pieces = byte_pieces
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if not self.automaton.exists(piece):
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.alone = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.apart = MARK in self.alone and all(s == int(s) and MARK not in p.lstrip(MARK) for p, s in pieces)
        self.known: dict[str, tuple[int, float]] = {}

    def settle(self, segment: str) -> tuple[int, float]:
        """Pieces and score of the best path over the whole segment."""
        n = len(segment)
        score, count, open_end = [0.0] + [None] * n, [0] * (n + 1), [False] * (n + 1)
        done = 0

        def unknown(end: int) -> None:
            here = score[end - 1] + self.unknown
            if segment[end - 1] not in self.alone and (score[end] is None or here > score[end]):
                more = len(segment[end - 1].encode()) if self.byte_pieces else not open_end[end - 1]
                score[end], count[end], open_end[end] = here, count[end - 1] + more, True

        for last, (length, value) in self.automaton.iter(segment):
            end = last + 1
            while done < end - 1:  # ends before this one have seen all their pieces
                done += 1
                unknown(done)
            start = end - length
            here = score[start] + value
            if score[end] is None or here > score[end]:
                score[end], count[end], open_end[end] = here, count[start] + 1, False
        while done < n:
            done += 1
            unknown(done)
        return count[n], score[n]

    def count(self, text: str) -> tuple[int, float]:
        """Pieces and score of a text, with a mark before it and for every space; nothing for an empty text."""
        if not text:
            return 0, 0.0
        marked = MARK + text.replace(" ", MARK)
        if not self.apart:
            return self.settle(marked)
        pieces, score, known = 0, 0.0, self.known
        if len(known) > MOST_SEGMENTS:
            known.clear()
        for segment in SEGMENT.findall(marked):
            found = known.get(segment)
            if found is None:
                found = known[segment] = self.settle(segment)
            pieces += found[0]
            score += found[1]
        return pieces, score


def count_tokens(docs: DataFrame, model_file: str) -> DataFrame:
    """Per document: doc_id, n_tokens, score of the best segmentation of its whole text.

    Null and empty texts have no tokens and score 0; a text without any known character is one unknown piece for
    each run, or its bytes where the model has byte pieces; repeated rows stay; an empty table gives no rows; extra columns are left aside.
    """
    return count_with(docs, read_pieces(model_file), has_bytes(model_file))


def count_with(docs: DataFrame, pieces: list[tuple[str, float]], byte_pieces: bool = False) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(pieces)

    def count(batches):
        counter = Counter(sent.value, byte_pieces)
        shape = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("score", pa.float64())])
        for batch in batches:
            found = [counter.count(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([c for c, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())], schema=shape)

    return text_only(docs).mapInArrow(count, "doc_id long, n_tokens long, score double")
