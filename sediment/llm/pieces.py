"""Ids of whole texts under a SentencePiece model, and texts of ids, exactly as the library gives them.

Where no piece goes on past the start of a run of space marks, a merge never joins two marked words, so each is segmented by
itself. A task keeps a table of the distinct marked words it has met: the library segments each once, and the ids are
joined back by the places of the words in the texts. A table for the whole corpus would save few segmentations, as most
words outside of any task's table are met once or twice anywhere, but the texts would have to be shuffled to meet it.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.llm.arrays import groups, lists, offsets, ranges

SPACE = "▁"
# A task's table is begun anew beyond so many marked words, or characters in them.
TABLE_WORDS = 1 << 18
TABLE_CHARS = 1 << 23


def read_model(path: str) -> bytes:
    """A model file as bytes, the form in which it is sent to tasks."""
    with open(path, "rb") as f:
        return f.read()


def parsed(model: bytes):
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(model)
    return proto


def splits_at_marks(proto) -> bool:
    """Whether texts may be segmented word by word: merges by rank, text kept as it is but for marks, and no piece with
    a mark after another character."""
    rules, trained = proto.normalizer_spec, proto.trainer_spec
    kept = not rules.precompiled_charsmap and not rules.remove_extra_whitespaces and rules.escape_whitespaces
    by_rank = trained.model_type == type(trained).BPE and not trained.treat_whitespace_as_suffix
    return kept and by_rank and not any(SPACE in p.piece.lstrip(SPACE) for p in proto.pieces)


class Encoder:
    """Segments texts by a table of distinct marked words; under a model that does not allow it, by one of distinct texts."""

    def __init__(self, model: bytes):
        import sentencepiece

        proto = parsed(model)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.by_word = splits_at_marks(proto)
        self.prefix = SPACE if proto.normalizer_spec.add_dummy_prefix else ""
        self.words = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall
        # The library puts a mark ahead of all texts but the empty one, so a mark alone is the end of a longer text.
        self.mark = self.library.encode("a ")[len(self.library.encode("a")) :]
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.ids, self.begin, self.chars = array("i"), array("q", [0]), 0

    def _parts(self, text: str) -> list[str]:
        if not text:
            return []
        return self.words(self.prefix + text.replace(" ", SPACE)) if self.by_word else [text]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has."""
        if len(self.known) > TABLE_WORDS or self.chars > TABLE_CHARS:
            self._clear()
        parts = [self._parts(t) for t in texts]
        counts = np.array([len(p) for p in parts], np.int64)
        before = len(self.known)
        number = np.fromiter(map(self.known.__getitem__, chain.from_iterable(parts)), np.int64, int(counts.sum()))
        new = list(islice(reversed(self.known), len(self.known) - before))[::-1]
        asked = [w[len(self.prefix) :] for w in new] if self.by_word else new
        for word, ids in zip(asked, self.library.encode(asked, num_threads=1) if asked else ()):
            self.ids.extend(ids if word else self.mark)
            self.begin.append(len(self.ids))
        self.chars += sum(map(len, new))
        begin = np.frombuffer(self.begin, np.int64)
        of_word = begin[number + 1] - begin[number]
        ends = offsets(of_word)[offsets(counts)]
        return np.frombuffer(self.ids, np.int32)[ranges(begin[number], begin[number + 1])], np.diff(ends)


def piece_bytes(proto) -> list[bytes | None]:
    """What each id stands for in a text, marks as spaces; None for ids that are no text (control, unknown)."""
    kind = type(proto).SentencePiece
    out: list[bytes | None] = []
    for p in proto.pieces:
        if p.type == kind.BYTE:
            out.append(bytes([int(p.piece[3:5], 16)]))
        elif p.type in (kind.CONTROL, kind.UNKNOWN):
            out.append(None)
        else:
            out.append(p.piece.replace(SPACE, " ").encode())
    return out


class Decoder:
    """Texts of ids: bytes looked up for all ids at once. Lists with other ids, or bytes that are no text, go to the library."""

    def __init__(self, model: bytes):
        import sentencepiece

        proto = parsed(model)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        table = piece_bytes(proto)
        rules = proto.normalizer_spec
        # These models change more than the first space.
        other = rules.remove_extra_whitespaces or proto.denormalizer_spec.precompiled_charsmap
        self.plain = np.array([b is not None and not other for b in table] + [False])
        self.first = np.array([p.piece.startswith(SPACE) and rules.add_dummy_prefix for p in proto.pieces] + [False])
        self.data = np.frombuffer(b"".join(b or b"" for b in table), np.uint8)
        self.begin = offsets([len(b or b"") for b in table] + [0])
        self.size = len(table)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of runs of ids of these lengths."""
        ids = np.where((ids >= 0) & (ids < self.size), ids, self.size)
        if (ids == self.size).any():
            raise ValueError(f"ids outside of the model's {self.size} pieces")
        runs = offsets(counts)
        begin, end = self.begin[ids], self.begin[ids + 1]
        data = self.data[ranges(begin, end)].tobytes()
        cuts = offsets(end - begin)[runs].tolist()
        odd = offsets(~self.plain[ids])[runs].tolist()
        out = []
        for i, at in enumerate(runs[:-1].tolist()):
            text = None
            if odd[i] == odd[i + 1]:
                skip = int(runs[i + 1] > at and self.first[ids[at]])
                try:
                    text = data[cuts[i] + skip : cuts[i + 1]].decode()
                except UnicodeDecodeError:
                    pass
            out.append(self.library.decode(ids[at : runs[i + 1]].tolist()) if text is None else text)
        return out


def encode_texts(docs: DataFrame, model: bytes, text: str = "text", keep: Sequence[str] | None = None, decode: bool = False) -> DataFrame:
    """One row per row: `row` (the given row as a struct, whole or its columns `keep`) and `ids`, without begin and end ids; with
    `decode` also `decoded`, the text that `decode_ids` gives for them, made by the same task.

    A null text is an empty one and has no ids; equal texts have equal ids; bytes that are no UTF-8 count as U+FFFD; any other column
    may be null or have any name. A text of any length is segmented whole; no table grows with the corpus.
    """
    rows = docs.select(F.struct(*(["*"] if keep is None else keep)).alias("row"), F.make_valid_utf8(F.col(text).cast("string")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(shared.value), Decoder(shared.value) if decode else None
        for batch in batches:
            for some, texts in groups(batch):
                ids, counts = encoder.encode(texts)
                columns = [some.column("row"), lists(counts, ids, pa.int32())]
                if decoder:
                    columns.append(pa.array(decoder.decode(ids, counts), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = rows.select("row").schema.add("ids", T.ArrayType(T.IntegerType()))
    schema = schema.add("decoded", "string") if decode else schema
    names = schema.names
    return rows.mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, model: bytes, ids: str = "ids") -> DataFrame:
    """The given rows as `row`, and `text`: what the ids stand for. Null or no ids give an empty text; an id the model lacks stops the job."""
    rows = encoded.select(F.struct("*").alias("row"), F.col(ids).cast("array<int>").alias("ids"))
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            column = batch.column("ids")
            counts = np.asarray(column.value_lengths().fill_null(0), np.int64)
            texts = decoder.decode(column.flatten().to_numpy(zero_copy_only=False), counts)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    return rows.mapInArrow(run, rows.select("row").schema.add("text", "string"))
