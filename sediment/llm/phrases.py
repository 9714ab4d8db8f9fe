"""Phrase collocations: contiguous words that come together much more often than their parts would.

A phrase's fingerprint is a polynomial of its words' hashes, read off prefix sums in numpy. Blocks of text send each distinct
fingerprint with its number, packed into a row for all that begin with the same bits, so that rows are few; sums over the corpus say which can be
frequent, and a bitmap tells the next scans.
Phrases of three words and more are counted only where both shorter ones inside them may be frequent. Then each block keeps a pointer to
an occurrence of a fingerprint that may be frequent, holds all others against it word by word, and cuts the text out there; sums
by text decide. So fingerprints that collide cost some work and never change a count, and only frequent phrases are ever texts.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import md5
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sediment.llm.arrays import offsets, ranges
from sediment.operators.lookup import Sized, lookup
from sediment.staging import Staging


@dataclass(frozen=True)
class PhraseParams:
    # Words of the longest phrases.
    longest: int = 3
    # Occurrences a phrase needs.
    least: int = 10
    # A phrase goes if a longer one around it has this share of its occurrences, in percent.
    covered_percent: int = 50
    # Phrases of each language that are given.
    best: int = 2000
    # Bits of the bitmap of fingerprints that may be frequent, at least. A full one lets through more, never less.
    bitmap_log2: int = 26


UNKNOWN_LANGUAGE = "und"
# Bytes of text hashed at a time, and words a task gathers before it sends their phrases.
CHUNK = 1 << 18
BLOCK_WORDS = 1 << 20
# Entries whose texts a task gathers at a time.
ROWS = 1 << 18
# Phrases with their texts that a task gathers from its blocks before it sums them up, and sends them if half as many are left.
GATHERED = 1 << 20
# Fingerprints are dealt by so many of their first bits, those that travel with their texts by fewer, as languages and lengths are apart already.
PARTS_LOG2, TEXT_PARTS_LOG2 = 12, 8
# A bitmap of this size or more grows until it has so many bits for a fingerprint, or is the widest one.
NARROWEST_GROWN_LOG2, THIN, WIDEST_LOG2 = 20, 16, 28

_P, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xA0761D6478BD642F)
# What ends a piece, and what is between words.
PIECE_END = re.compile(b"[.,;:!?\n\x0b\x0c\r]")
_KIND = np.zeros(256, np.uint8)
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
_KIND[[ord(c) for c in " \t"]] = 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Prefixes:
    """Polynomial hashes of runs, from prefix sums: the sum over a run, brought back to its beginning by the inverse power."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)

    def hashes(self, values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        if len(values) + 1 > len(self.up):
            self._grow(2 * len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=sums[1:])
        return (sums[end] - sums[begin]) * self.down[begin]


class Block:
    """Words of many texts: a hash of each, its piece and its language, and all their bytes with a space after each word."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.data: list[bytes] = []
        self.words = self.pieces = 0
        self.code: dict[str, int] = {}
        self.known: dict[bytes, int] = defaultdict()
        self.known.default_factory = self.known.__len__

    def add(self, hasher: Prefixes, texts: list[bytes], languages: list[str], keep: bool) -> None:
        """Adds texts; their bytes are kept if phrases are to be cut out."""
        b = np.frombuffer(b"\n".join([*(t.lower() for t in texts), b""]), np.uint8)
        kind = _KIND[b]
        inner = kind == 0
        before = np.concatenate(([False], inner[:-1]))
        starts, ends = np.flatnonzero(inner & ~before), np.flatnonzero(~inner & before)
        hashes = _mix(hasher.hashes(b.astype(np.uint64) + np.uint64(1), starts, ends) + (ends - starts).astype(np.uint64))
        piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
        text = np.searchsorted(offsets([len(t) + 1 for t in texts])[1:], starts, side="right")
        codes = np.array([self.code.setdefault(x, len(self.code)) for x in languages], np.int32)
        numbers = np.zeros(0, np.int32)
        if keep:
            spaced = np.where(inner, b, 32).astype(np.uint8)[ranges(starts, ends + 1)].tobytes()
            self.data.append(spaced)
            numbers = np.fromiter(map(self.known.__getitem__, spaced.split(b" ")[:-1]), np.int32, len(starts))
        self.parts.append((hashes, piece + np.int32(self.pieces), codes[text], (ends - starts).astype(np.int32), numbers))
        self.words += len(starts)
        self.pieces += int((kind == 2).sum())

    def closed(self, hasher: Prefixes) -> "Block":
        """Joins what was added. If bytes are kept, `numbers` are equal for equal words only: they go by bytes, not by hashes."""
        columns = list(zip(*self.parts)) or [()] * 5
        kinds = (np.uint64, np.int32, np.int32, np.int32, np.int32)
        self.hashes, self.piece, self.codes, lengths, self.numbers = (np.concatenate([*c, np.zeros(0, k)]) for c, k in zip(columns, kinds))
        self.names, self.hasher = list(self.code), hasher
        # A phrase of another language has another fingerprint. Languages that collide are told apart by their codes.
        self.salts = np.array([int.from_bytes(md5(x.encode()).digest()[:8], "little") for x in self.names], np.uint64)
        self.text, self.begin = b"".join(self.data), offsets(lengths.astype(np.int64) + 1)
        self.parts, self.data, self.known = [], [], {}
        return self

    def fingerprints(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The places of all phrases of `n` words within pieces, and their fingerprints."""
        at = np.flatnonzero(self.piece[n - 1 :] == self.piece[: self.words - n + 1]) if self.words >= n else np.zeros(0, np.int64)
        return at, _mix((self.hasher.hashes(self.hashes, at, at + n) ^ self.salts[self.codes[at]]) + np.uint64(n))

    def cut(self, at: np.ndarray, n: int) -> list[str]:
        """The phrases at these places."""
        data = self.text
        return [data[i : j - 1].decode() for i, j in zip(self.begin[at].tolist(), self.begin[at + n].tolist())]


def segments(text: bytes) -> Iterator[bytes]:
    """A long text in parts of about CHUNK bytes that end where a piece does."""
    at = 0
    while len(text) - at > 2 * CHUNK:
        found = PIECE_END.search(text, at + CHUNK)
        if not found:
            break
        yield text[at : found.end()]
        at = found.end()
    yield text[at:] if at else text


def blocks(batches: Iterator[pa.RecordBatch], hasher: Prefixes, keep: bool) -> Iterator[Block]:
    """Closed blocks of about BLOCK_WORDS words."""
    block, texts, languages, size = Block(), [], [], 0
    for batch in batches:
        for text, language in zip(batch.column("text"), batch.column("lang")):
            for segment in segments(text.as_py().encode()):
                texts.append(segment)
                languages.append(language.as_py())
                size += len(segment)
                if size < CHUNK:
                    continue
                block.add(hasher, texts, languages, keep)
                texts, languages, size = [], [], 0
                if block.words >= BLOCK_WORDS:
                    yield block.closed(hasher)
                    block = Block()
    if texts:
        block.add(hasher, texts, languages, keep)
    yield block.closed(hasher)


def may_be_frequent(bitmap: np.ndarray, fingerprints: np.ndarray) -> np.ndarray:
    slot = (fingerprints >> np.uint64(64 - (8 * len(bitmap)).bit_length() + 1)).astype(np.int64)
    return (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def promising(block: Block, n: int, bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and fingerprints of the phrases of `n` words of which both shorter ones may be frequent."""
    at, found = block.fingerprints(n)
    shorter = np.zeros(block.words + 1, bool)
    places, prints = block.fingerprints(n - 1)
    shorter[places[may_be_frequent(bitmap, prints)]] = True
    both = shorter[at] & shorter[at + 1]
    return at[both], found[both]


def held(column: pa.Array, begin: int, end: int) -> bytes:
    """The bytes of neighbouring rows of a binary column, which lie side by side."""
    _, places, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(places, kind)[[column.offset + begin, column.offset + end]] if data is not None and end > begin else (0, 0)
    return data[at[0] : at[1]].to_pybytes() if at[1] > at[0] else b""


def runs(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[tuple, list[bytes]]]:
    """Keys of rows sorted by them, each with the bytes of all its rows, a value for each other column."""
    last, parts = None, []
    for batch in batches:
        others = [batch.column(c) for c in batch.schema.names if c not in key]
        at = 0
        for k, same in groupby(zip(*(batch.column(c).to_pylist() for c in key))):
            end = at + sum(1 for _ in same)
            if k != last and parts:
                yield last, [b"".join(x) for x in zip(*parts)]
                parts = []
            last = k
            parts.append([held(c, at, end) for c in others])
            at = end
    if parts:
        yield last, [b"".join(x) for x in zip(*parts)]


def binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The bytes of `values` as binaries that begin and end at these numbers of values."""
    places = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(values))])


def bounds_of(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, and where the last one ends."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))


def fingerprint_counts(rows: DataFrame, sizes: tuple[int, ...], bitmap: bytes | None, least: int) -> DataFrame:
    """`part`, `prints`, `counts`: phrases of these numbers of words, each once for a block, its number up to `least`. With a bitmap of those one
    word shorter, only promising ones. A row has all of a block that begin with the same bits, which are the part."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Prefixes(_B)
        known = None if shared.value is None else np.frombuffer(shared.value, np.uint8)
        for block in blocks(batches, hasher, False):
            found = np.concatenate([(block.fingerprints(n) if known is None else promising(block, n, known))[1] for n in sizes])
            found.sort()
            first = bounds_of(found)
            prints, n = found[first[:-1]], np.minimum(np.diff(first), least).astype(count_kind(least))
            parts = (prints >> np.uint64(64 - PARTS_LOG2)).astype(np.int32)
            bounds = bounds_of(parts)
            columns = [pa.array(parts[bounds[:-1]]), binaries(prints, bounds), binaries(n, bounds)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "prints", "counts"])

    return rows.mapInArrow(run, "part int, prints binary, counts binary")


def count_kind(least: int) -> type:
    return np.uint8 if least < 256 else np.uint32


def frequent_prints(counted: DataFrame, least: int) -> DataFrame:
    """`fp`: fingerprints that come to `least` over all blocks. A task holds one part at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (prints, counts) in runs(batches, ["part"]):
            found, n = np.frombuffer(prints, np.uint64), np.frombuffer(counts, count_kind(least))
            order = np.argsort(found)
            found = found[order]
            first = bounds_of(found)[:-1]
            often = np.add.reduceat(n[order], first, dtype=np.int64) >= least
            yield pa.RecordBatch.from_arrays([pa.array(found[first[often]].view(np.int64))], names=["fp"])

    return counted.repartition("part").sortWithinPartitions("part").mapInArrow(run, "fp long")


def distinct_phrases(block: Block, at: np.ndarray, found: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The place of an occurrence of each phrase, and its number of occurrences.

    Occurrences of a fingerprint are held against each other word by word; where two phrases share one, words decide alone.
    """
    order = np.argsort(found)
    at, found = at[order], found[order]
    same = found[1:] == found[:-1]
    told = [block.codes, *(block.numbers[k:] for k in range(size))]
    for x in told:
        there = x[at]
        if not (there[1:] == there[:-1])[same].all():
            _, first, n = np.unique(np.stack([y[at] for y in told], axis=1), axis=0, return_index=True, return_counts=True)
            return at[first], n
    first = np.flatnonzero(np.concatenate((found[:1] == found[:1], ~same)))
    return at[first], np.diff(np.append(first, len(found)))


def gathered(text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The bytes of many places in a text, one after another."""
    some = (slice(i, i + ROWS) for i in range(0, len(begin), ROWS))
    return np.concatenate([np.zeros(0, np.uint8), *(text[ranges(begin[x], end[x])] for x in some)])


class Gathered:
    """Phrases of a language and number of words, from several blocks: fingerprints, numbers, lengths and texts."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, *columns: np.ndarray) -> int:
        self.parts.append(columns)
        return len(columns[0])

    def sum(self) -> int:
        """Makes one entry of each phrase, in the order of fingerprints. Gives the number of entries."""
        prints, counts, lengths, texts = (np.concatenate(x) for x in zip(*self.parts))
        entry, n = summed_texts(prints, counts, lengths, texts)
        order = np.argsort(prints[entry])
        entry, n, places = entry[order], n[order].astype(np.uint32), offsets(lengths)
        self.parts = [(prints[entry], n, lengths[entry], gathered(texts, places[entry], places[entry + 1]))]
        return len(entry)


def phrase_counts(rows: DataFrame, longest: int, bitmaps: dict[int, bytes]) -> DataFrame:
    """`lang`, `words`, `part`, `prints`, `counts`, `lengths`, `texts`: phrases whose fingerprints may be frequent by their number of words' bitmap,
    once for some blocks, with their texts; and all words of a language under `words` 0 as a count only. A row has all of a language that some
    blocks have and whose fingerprints begin with the same bits, the part."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmaps)
    names = ["lang", "words", "part", "prints", "counts", "lengths", "texts"]

    def sent(found: dict[tuple[str, int], Gathered]) -> Iterator[pa.RecordBatch]:
        for (lang, size), phrases in found.items():
            ((prints, n, lengths, texts),) = phrases.parts
            parts = (prints >> np.uint64(64 - TEXT_PARTS_LOG2)).astype(np.int32)
            bounds = bounds_of(parts)
            m = len(bounds) - 1
            heads = [pa.array([lang] * m, pa.string()), pa.array([size] * m, pa.int32()), pa.array(parts[bounds[:-1]])]
            columns = [*(binaries(x, bounds) for x in (prints, n, lengths)), binaries(texts, offsets(lengths)[bounds])]
            yield pa.RecordBatch.from_arrays([*heads, *columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, known = Prefixes(_B), {n: np.frombuffer(x, np.uint8) for n, x in shared.value.items()}
        found, entries = defaultdict(Gathered), 0
        for block in blocks(batches, hasher, True):
            total = np.bincount(block.codes, minlength=len(block.names)).astype(np.uint32)
            none, each = pa.array([b""] * len(total), pa.binary()), binaries(total, np.arange(len(total) + 1))
            zero = pa.array([0] * len(total), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(block.names, pa.string()), zero, zero, none, each, none, none], names=names)
            text = np.frombuffer(block.text, np.uint8)
            for size in range(1, longest + 1):
                at, prints = block.fingerprints(size)
                print_at = np.zeros(block.words, np.uint64)
                print_at[at] = prints
                may = may_be_frequent(known[size], prints)
                first, n = distinct_phrases(block, at[may], prints[may], size)
                codes = block.codes[first]
                # Numbers of 16 bits are sorted by counting.
                order = np.argsort(codes.astype(np.uint16) if len(block.names) <= 1 << 16 else codes, kind="stable")
                first, n, codes = first[order], n[order].astype(np.uint32), codes[order]
                bounds = bounds_of(codes)
                for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    begin, end = block.begin[first[i:j]], block.begin[first[i:j] + size] - 1
                    of = found[block.names[codes[i]], size]
                    entries += of.add(print_at[first[i:j]], n[i:j], (end - begin).astype(np.uint32), gathered(text, begin, end))
            if entries > GATHERED:
                entries = sum(x.sum() for x in found.values())
                if 2 * entries > GATHERED:
                    yield from sent(found)
                    found, entries = defaultdict(Gathered), 0
        for x in found.values():
            x.sum()
        yield from sent(found)

    return rows.mapInArrow(run, "lang string, words int, part int, prints binary, counts binary, lengths binary, texts binary")


def summed_texts(prints: np.ndarray, counts: np.ndarray, lengths: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An entry of each text, and the sum of its counts. Entries of a fingerprint are held against each other byte by byte; where two texts share
    one, texts decide alone."""
    order = np.argsort(prints)
    begin, lengths = offsets(lengths), lengths.astype(np.int64)
    bounds = bounds_of(prints[order])
    same = np.ones(len(order), bool)
    same[bounds[:-1]] = False
    one, other = order[np.flatnonzero(same) - 1], order[same]
    alike = (lengths[one] == lengths[other]).all() and all(
        (texts[ranges(begin[x], begin[x] + lengths[x])] == texts[ranges(begin[y], begin[y] + lengths[y])]).all()
        for x, y in ((one[i : i + ROWS], other[i : i + ROWS]) for i in range(0, len(one), ROWS))
    )
    if alike:
        return order[bounds[:-1]], np.add.reduceat(counts[order], bounds[:-1], dtype=np.int64)
    whole, known = texts.tobytes(), {}
    for i, (x, length, n) in enumerate(zip(begin.tolist(), lengths.tolist(), counts.tolist())):
        entry = known.setdefault(whole[x : x + length], [i, 0])
        entry[1] += n
    return np.array([x for x, _ in known.values()], np.int64), np.array([n for _, n in known.values()], np.int64)


def frequent_texts(counted: DataFrame, least: int) -> DataFrame:
    """`lang`, `words`, `phrase`, `n` of the phrases that come to `least` over all blocks, and of the words of each language."""
    key = ["lang", "words", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (lang, words, _), (prints, counts, lengths, texts) in runs(batches, key):
            counts, lengths, text = (np.frombuffer(x, k) for x, k in ((counts, np.uint32), (lengths, np.uint32), (texts, np.uint8)))
            if words == 0:
                columns = [pa.array([""], pa.string()), pa.array([int(counts.sum(dtype=np.int64))], pa.int64())]
            else:
                entry, n = summed_texts(np.frombuffer(prints, np.uint64), counts, lengths, text)
                entry, n = entry[n >= least], n[n >= least]
                places = offsets(lengths)
                found = gathered(text, places[entry], places[entry + 1])
                columns = [binaries(found, offsets(lengths[entry])).view(pa.string()), pa.array(n, pa.int64())]
            m = len(columns[0])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * m, pa.string()), pa.array([words] * m, pa.int32()), *columns], names=["lang", "words", "phrase", "n"])

    return counted.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "lang string, words int, phrase string, n long")


def bitmap_of(prints: DataFrame, bits: int) -> bytes:
    """A bitmap of the fingerprints' top bits: 2^bits bits, or more if it would be full, up to WIDEST_LOG2."""
    bits = max(bits, min((THIN * prints.count()).bit_length(), WIDEST_LOG2)) if bits >= NARROWEST_GROWN_LOG2 else bits
    slots = prints.select(F.shiftrightunsigned("fp", 64 - bits).alias("slot"))
    words = slots.selectExpr("shiftright(slot, 6) as word", "shiftleft(1L, cast(slot & 63 as int)) as bit").groupBy("word")
    # At most 2^(bits - 6) rows.
    table = words.agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(max(1 << bits >> 6, 1), np.int64)
    out[table["word"].to_numpy()] = table["bits"].to_numpy()
    return out.tobytes()[: 1 << bits >> 3]


def frequent_phrases(docs: DataFrame, staging: Staging, lang: str = "lang", text: str = "text", params: PhraseParams = PhraseParams()) -> DataFrame:
    """`lang`, `words`, `phrase`, `n` of all phrases of up to `longest` words with at least `least` occurrences, as a written table.

    With `words` 0 and an empty phrase: the number of all words of a language. Documents are read once for the shortest phrases,
    once for each longer kind and once for the texts.
    """
    language = F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN_LANGUAGE))
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.make_valid_utf8(language).alias("lang"), F.make_valid_utf8(whole).alias("text"))

    def frequent(sizes: tuple[int, ...], bitmap: bytes | None) -> bytes:
        # Blocks have summed up already, and a fingerprint is in a block's row once at most.
        counted = fingerprint_counts(rows, sizes, bitmap, params.least)
        name = "prints_" + "_".join(map(str, sizes))
        return bitmap_of(staging.write(name, frequent_prints(counted, params.least)), params.bitmap_log2)

    short = tuple(range(1, min(params.longest, 2) + 1))
    bitmaps = dict.fromkeys(short, frequent(short, None))
    for size in range(3, params.longest + 1):
        bitmaps[size] = frequent((size,), bitmaps[size - 1])
    return staging.write("phrases", frequent_texts(phrase_counts(rows, params.longest, bitmaps), params.least))


def _slice(words: Column, first, length) -> Column:
    return F.array_join(F.slice(words, first, length), " ")


def covered(frequent: DataFrame) -> DataFrame:
    """`lang`, `inner`, `around`: phrases inside longer frequent ones, and the largest number of one of those."""
    longer = frequent.where("words > 2").select("lang", "words", "n", F.split("phrase", " ").alias("w"))
    for name, last in (("length", F.col("words") - 1), ("first", F.col("words") - F.col("length") + 1)):
        longer = longer.withColumn(name, F.explode(F.sequence(F.lit(2 if name == "length" else 1), last)))
    inner = longer.select("lang", _slice(F.col("w"), F.col("first"), F.col("length")).alias("inner"), "n")
    return inner.groupBy("lang", "inner").agg(F.max("n").alias("around"))


def scored(frequent: DataFrame) -> DataFrame:
    """`lang`, `phrase`, `a`, `l`, `r`, `score` of phrases of two words and more, at the cut that scores lowest, the earliest of equals."""
    cuts = frequent.where("words > 1").select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = cuts.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", _slice(F.col("w"), 1, F.col("k")).alias("head"), _slice(F.col("w"), F.col("k") + 1, F.size("w")).alias("tail"))
    parts = Sized.of(frequent.where("words > 0").select("lang", "phrase", "n"))
    cuts = lookup(cuts, parts, {"lang": "lang", "head": "phrase"}, {"n": "l"}, "inner", spread=["phrase"])
    cuts = lookup(cuts, parts, {"lang": "lang", "tail": "phrase"}, {"n": "r"}, "inner", spread=["phrase"])
    a, l, r = (F.col(c).cast("decimal(18,0)") for c in "alr")
    cuts = cuts.select("lang", "phrase", "a", "k", "l", "r", (a * a * F.lit(1_000_000)).alias("above"), (l * r).alias("below"))
    cut = F.struct(F.expr("above div below").alias("score"), "k", "l", "r")
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(cut).alias("cut"))
    return lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", params: PhraseParams = PhraseParams()) -> DataFrame:
    """`lang`, `rank` (from 1), `phrase`, `a`, `l`, `r`, `n`, `score`: each language's best phrases by score, then `a`, then the phrase's bytes.

    Everything is counted by language, a null one being `und`. Words are what is between spaces and tabs inside pieces, which end at
    `. , ; : ! ?` and line ends; A-Z count as a-z. Null and empty texts have no words, repeated rows count each, and without
    documents or frequent phrases there are no rows. Texts of any length are read whole. Other columns are not read.
    """
    staging = Staging(docs.sparkSession)
    frequent = frequent_phrases(docs, staging, lang, text, params)
    inner = covered(frequent).withColumnRenamed("lang", "inner_lang")
    # Both sides have a phrase once.
    left = scored(frequent).join(inner, (F.col("lang") == F.col("inner_lang")) & (F.col("phrase") == F.col("inner")), "left")
    left = left.where(F.col("around").isNull() | (100 * F.col("around") < params.covered_percent * F.col("a")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First the best of each of several parts of a language, so that none is ordered by one task alone.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    few = left.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    few = few.where(F.col("rank") <= params.best)
    best = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= params.best)
    totals = Sized.of(frequent.where("words = 0").select("lang", "n"))
    found = lookup(best, totals, {"lang": "lang"}, {"n": "n"}, "inner", spread=["phrase"])
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
