"""Token counts under a unigram vocabulary: a Viterbi search that carries a score and a piece count, no pieces.

An Aho-Corasick automaton lists the vocabulary's matches by their end, longest first. The best way to each end is that
of the highest score; of equal ones the match that starts first wins, and a character without a piece of its own
comes last, at the lowest score less 10, and counts its UTF-8 bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
# Pieces of text a task remembers the count of.
REMEMBERED = 1 << 19


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores, without control and byte pieces, which never match text."""

    pieces: tuple[tuple[str, float], ...]
    # A space ahead of a text that isn't empty.
    dummy_prefix: bool = True

    @classmethod
    def from_sentencepiece(cls, path: str) -> "Vocabulary":
        """The normal pieces of a model file and their scores; its normalizer must be the identity with spaces escaped."""
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models that keep the text as it is, spaces escaped, are read")
        kind = pb.ModelProto.SentencePiece.Type
        if any(p.type == kind.USER_DEFINED for p in model.pieces):
            raise ValueError("models with pieces that users defined, which win over any score, are not read")
        return cls(tuple((p.piece, p.score) for p in model.pieces if p.type == kind.NORMAL), rules.add_dummy_prefix)


class Counter:
    """Counts pieces. What no piece spans is counted apart and remembered."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), float(score)))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self.prefix = SPACE if vocabulary.dummy_prefix else ""
        inner = any(SPACE in p.lstrip(SPACE) for p, _ in vocabulary.pieces)
        lines = any("\n" in p for p, _ in vocabulary.pieces if len(p) > 1)
        # Where no piece goes on past the start of a space, or over a line end, the text falls into parts.
        self.parts = None if inner else re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if lines else f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
        self.known: dict[str, int] = {}

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = self.prefix + text.replace(" ", SPACE)
        if self.parts is None:
            return self._best(text)
        total, known = 0, self.known
        for part in self.parts.findall(text):
            n = known.get(part)
            if n is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                n = known[part] = self._best(part)
            total += n
        return total

    def _best(self, text: str) -> int:
        """Ends of matches come in order, so all ways to an end are known before any match goes on from it."""
        size, unknown = len(text), self.unknown
        scores, counts = [0.0] + [None] * size, [0] * (size + 1)
        single, at = False, 1

        def close(end: int, single: bool) -> None:
            if not single:
                way = scores[end - 1] + unknown
                if scores[end] is None or way > scores[end]:
                    scores[end] = way
                    counts[end] = counts[end - 1] + len(text[end - 1].encode("utf-8", "surrogatepass"))

        for last, (length, score) in self.automaton.iter(text):
            end = last + 1
            while at < end:
                close(at, single)
                single, at = False, at + 1
            start = end - length
            way = scores[start] + score
            if scores[end] is None or way > scores[end]:
                scores[end] = way
                counts[end] = counts[start] + 1
            single = single or length == 1
        while at <= size:
            close(at, single)
            single, at = False, at + 1
        return counts[size]


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: `doc_id`, `n_tokens`. A null or empty text has none; repeated rows give a row each.

    A text of any length is counted whole, part by part; other columns are not read.
    """
    rows = docs.select(F.col(doc).alias("doc_id"), F.col(text).cast("string").alias("text"))
    # Plain values only: a broadcast object would need this module on the tasks' path.
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.pieces, vocabulary.dummy_prefix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(Vocabulary(*shared.value))
        for batch in batches:
            counts = [counter.count(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])

    return rows.mapInArrow(run, rows.select("doc_id").schema.add("n_tokens", "long"))
