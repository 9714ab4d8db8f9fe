"""Alignment of two tokenizers' tokens of the same texts, by divide and conquer at the byte offsets where tokens of both end.

An interval of tokens is cut at a common end near its middle, found by bisecting the other tokenizer's ends, and both halves are
cut in turn; an interval without one is a group. A space between two plain characters is such a cut in any text, so a
task cuts texts there first and divides each distinct part once. Tokens of a group are linked, each with each; how many documents
hold an id pair linked is counted over the corpus.
"""

from __future__ import annotations

import json
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.llm.arrays import groups, lists, offsets, ranges
from sediment.llm.pieces import parsed, piece_bytes, read_model, splits_at_marks
from sediment.operators.lookup import Sized, lookup
from sediment.staging import Staging

# A space between characters that are surely no white space: pre-tokenizers and marked pieces begin a new token with it.
PLAIN = "!-~À-ɏ"
CUT = re.compile(f"(?<=[{PLAIN}])(?= [{PLAIN}])")
# A task's table is begun anew beyond so many parts, or characters or links in them.
TABLE_PARTS = 1 << 18
TABLE_SIZE = 1 << 24
# Groups with more links than this are linked by distinct ids and their numbers.
WIDE = 1 << 12
# Id pairs that are broadcast at most, the most frequent ones; 16 bytes each.
FREQUENT_PAIRS = 1 << 20


def leaf_groups(ends_a: np.ndarray, ends_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> np.ndarray:
    """Rows (a0, a1, b0, b1) of the groups, in order: tokens a0 up to a1 of one and b0 up to b1 of the other tokenizer.

    Ends are byte offsets, ascending over all texts; the intervals between neighbours in `cuts_a` and `cuts_b` (token numbers) are
    divided at once. Each round probes one place in every open interval: its middle, then to the right and left of it.
    """
    intervals = np.stack([cuts_a[:-1], cuts_a[1:], cuts_b[:-1], cuts_b[1:]], axis=1)
    step, leaves = np.zeros(len(intervals), np.int64), []
    while len(intervals):
        a0, a1, b0, b1 = intervals.T
        last = a1 - 2
        middle = (a0 + last) // 2
        whole = (a1 - a0 < 2) | (b1 - b0 < 2) | ((step + 1) // 2 > np.maximum(middle - a0, last - middle))
        leaves.append(intervals[whole])
        intervals, step, middle, last = intervals[~whole], step[~whole], middle[~whole], last[~whole]
        if not len(intervals):
            break
        a0, a1, b0, b1 = intervals.T
        place = middle + np.where(step % 2 == 1, (step + 1) // 2, -((step + 1) // 2))
        inside = (place >= a0) & (place <= last)
        end = ends_a[np.clip(place, a0, last)]
        other = np.searchsorted(ends_b, end)
        found = inside & (other < b1 - 1) & (ends_b[np.minimum(other, len(ends_b) - 1)] == end)
        at, to = place[found] + 1, other[found] + 1
        left = np.stack([a0[found], at, b0[found], to], axis=1)
        right = np.stack([at, a1[found], to, b1[found]], axis=1)
        intervals = np.concatenate([left, right, intervals[~found]])
        step = np.concatenate([np.zeros(2 * len(at), np.int64), step[~found] + 1])
    out = np.concatenate([*leaves, np.zeros((0, 4), np.int64)])
    return out[np.argsort(out[:, 0], kind="stable")]


def byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_level_bytes(tokenizer: bytes) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    vocabulary, letters = json.loads(tokenizer)["model"]["vocab"], byte_of_letter()
    out = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for token, i in vocabulary.items():
        if all(c in letters for c in token):
            out[i] = bytes(letters[c] for c in token)
    return out


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists one after another, and where each begins."""
    cuts = offsets(list(map(len, ids)))
    return np.fromiter(chain.from_iterable(ids), np.int64, int(cuts[-1])), cuts


class Aligner:
    """Divides texts, through a table of the distinct parts met so far."""

    def __init__(self, tokenizer: bytes, model: bytes):
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(tokenizer.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        proto = parsed(model)
        self.bytes_a, self.bytes_b = byte_level_bytes(tokenizer), [x or b"" for x in piece_bytes(proto)]
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.names = [f"{i}{after}" for i in range(max(len(self.bytes_a), len(self.bytes_b))) for after in ",|;"]
        rules = json.loads(tokenizer)
        plain = rules.get("normalizer") is None and (rules.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
        self.cut = CUT.split if plain and rules["pre_tokenizer"].get("use_regex", True) and splits_at_marks(proto) else lambda t: [t]
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.texts: list[str] = []
        # A row for each part: tokens of both, groups, links, and whether both tokenizers give its very bytes.
        self.numbers = np.zeros((0, 5), np.int64)
        self.pairs, self.times, self.begin, self.size = array("q"), array("q"), array("q", [0]), 0

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """For each text its numbers of tokens, groups and links, its groups as text, and the number of distinct id pairs; then the pairs of all and their numbers.

        A pair is one number: the first id times the size of the second vocabulary, plus the second id.
        """
        if len(self.known) > TABLE_PARTS or self.size > TABLE_SIZE:
            self._clear()
        parts = [self.cut(f" {t}") if t else [] for t in texts]
        before = len(self.known)
        number = [list(map(self.known.__getitem__, p)) for p in parts]
        new = list(islice(reversed(self.known), len(self.known) - before))[::-1]
        if new:
            self._divide(new)
        flat, runs = _flat(number)
        good = self.numbers[:, 4] > 0
        if not good[flat].all():
            number = [n if good[n].all() else [] for n in number]
            flat, runs = _flat(number)
        sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(self.numbers[flat, :4], axis=0)])[runs]
        begin = np.array(self.begin, np.int64)
        places = ranges(begin[flat], begin[flat + 1])
        of_text = np.repeat(np.repeat(np.arange(len(texts)), np.diff(runs)), begin[flat + 1] - begin[flat])
        everything = len(self.bytes_a) * len(self.bytes_b)
        key = of_text * everything + np.array(self.pairs, np.int64)[places]
        order = np.argsort(key, kind="stable")
        key, times = key[order], np.array(self.times, np.int64)[places[order]]
        first = np.flatnonzero(np.concatenate((key[:1] == key[:1], key[1:] != key[:-1])))
        times = np.add.reduceat(times, first) if len(first) else times
        key = key[first]
        per_text = np.bincount(key // everything, minlength=len(texts)) if len(key) else np.zeros(len(texts), np.int64)
        return np.diff(sums, axis=0), [";".join(map(self.texts.__getitem__, n)) for n in number], per_text, key % everything, times

    def _divide(self, new: list[str]) -> None:
        """Enters parts that are not in the table yet."""
        a = [e.ids for e in self.a.encode_batch_fast(new, add_special_tokens=False)]
        b = self.b.encode([p[1:] for p in new], num_threads=1)
        good = self._good(new, a, b)
        if not good.all():
            a, b = ([x if g else [] for x, g in zip(side, good.tolist())] for side in (a, b))
        (ids_a, cuts_a), (ids_b, cuts_b) = _flat(a), _flat(b)
        some = np.concatenate(([True], cuts_a[1:] > cuts_a[:-1]))
        leaves = leaf_groups(np.cumsum(self.sizes_a[ids_a]), np.cumsum(self.sizes_b[ids_b]), cuts_a[some], cuts_b[some])
        a0, a1, b0, b1 = leaves.T
        n_groups = np.diff(np.searchsorted(a0, cuts_a))
        links = (a1 - a0) * (b1 - b0)
        of_part = np.searchsorted(cuts_a, a0, side="right") - 1
        n_links = np.bincount(of_part, weights=links, minlength=len(new)).astype(np.int64)
        rows = np.stack([np.diff(cuts_a), np.diff(cuts_b), n_groups, n_links, good], axis=1)
        self.numbers = np.concatenate([self.numbers, rows])
        # A group's first ids, then its second ones; each with what stands behind it.
        shown = np.empty(len(ids_a) + len(ids_b), np.int64)
        place_a, place_b = np.arange(len(ids_a)) + np.repeat(b0, a1 - a0), np.arange(len(ids_b)) + np.repeat(a1, b1 - b0)
        shown[place_a], shown[place_b] = 3 * ids_a, 3 * ids_b
        shown[place_a[a1 - 1]] += 1
        shown[place_b[b1 - 1]] += 2
        names, at = list(map(self.names.__getitem__, shown.tolist())), (cuts_a + cuts_b).tolist()
        self.texts += ["".join(names[i:j])[:-1] for i, j in zip(at, at[1:])]
        self._link(ids_a, ids_b, leaves, links, of_part, len(new))
        self.size += sum(map(len, new))

    def _good(self, new: list[str], a: list[list[int]], b: list[list[int]]) -> np.ndarray:
        """Whether both tokenizers give the very bytes of each part."""
        whole, sizes = "".join(new).encode(), np.fromiter((len(p.encode()) for p in new), np.int64, len(new))
        good = np.ones(len(new), bool)
        for side, table, lengths in ((a, self.bytes_a, self.sizes_a), (b, self.bytes_b, self.sizes_b)):
            ids, cuts = _flat(side)
            same = np.diff(offsets(lengths[ids])[cuts]) == sizes
            if same.all() and b"".join(map(table.__getitem__, ids.tolist())) == whole:
                continue
            good &= [b"".join(map(table.__getitem__, x)) == p.encode() for p, x in zip(new, side)]
        return good

    def _link(self, ids_a: np.ndarray, ids_b: np.ndarray, leaves: np.ndarray, links: np.ndarray, of_part: np.ndarray, n: int) -> None:
        wide = links > WIDE
        a0, _, b0, b1 = leaves[~wide].T
        nth, other = ranges(np.zeros(len(a0), np.int64), links[~wide]), np.repeat(b1 - b0, links[~wide])
        first, second = np.repeat(a0, links[~wide]) + nth // np.maximum(other, 1), np.repeat(b0, links[~wide]) + nth % np.maximum(other, 1)
        pairs, times, part = [ids_a[first] * len(self.bytes_b) + ids_b[second]], [np.ones(len(first), np.int64)], [np.repeat(of_part[~wide], links[~wide])]
        for (i, j, k, m), p in zip(leaves[wide].tolist(), of_part[wide].tolist()):
            (x, nx), (y, ny) = np.unique(ids_a[i:j], return_counts=True), np.unique(ids_b[k:m], return_counts=True)
            pairs.append((x[:, None] * len(self.bytes_b) + y[None, :]).ravel())
            times.append((nx[:, None] * ny[None, :]).ravel())
            part.append(np.full(len(x) * len(y), p))
        pairs, times, part = (np.concatenate(x) for x in (pairs, times, part))
        order = np.argsort(part, kind="stable")
        self.pairs.frombytes(pairs[order].astype(np.int64).tobytes())
        self.times.frombytes(times[order].astype(np.int64).tobytes())
        self.begin.extend((self.begin[-1] + offsets(np.bincount(part, minlength=n))[1:]).tolist())
        self.size += len(pairs)


def align_texts(docs: DataFrame, tokenizer: bytes, model: bytes, text: str = "text") -> DataFrame:
    """One row per row: `row` (the whole given row), `n_a`, `n_b`, `n_groups`, `n_links`, `groups` (as `a1,a2|b1;a3|b2`), and `pairs`
    with `times`: the distinct linked id pairs as numbers, and how many links each has.

    `tokenizer` is a byte-level vocabulary file of the tokenizers library, given a space and the text; `model` a SentencePiece
    model that puts the space itself. A null or empty text, and one whose bytes either does not give back (such as one with U+2581, or
    bytes that are no UTF-8), has no tokens. Other columns may be null or have any name.
    """
    t = F.col(text).cast("string")
    rows = docs.select(F.struct("*").alias("row"), F.when(F.is_valid_utf8(t), t).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer, model))
    names = ["row", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        # One thread a task; Spark has the others.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        aligner = Aligner(*shared.value)
        for batch in batches:
            for some, texts in groups(batch):
                numbers, shown, per_text, pairs, times = aligner.align(texts)
                columns = [some.column("row"), *(pa.array(c) for c in numbers.T), pa.array(shown, pa.string())]
                columns += [lists(per_text, pairs, pa.int64()), lists(per_text, times, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = rows.select("row").schema
    for name in names[1:5]:
        schema = schema.add(name, "long")
    return rows.mapInArrow(run, schema.add("groups", "string").add("pairs", T.ArrayType(T.LongType())).add("times", T.ArrayType(T.LongType())))


def pair_counts(aligned: DataFrame, vocabulary_b: int, staging: Staging) -> DataFrame:
    """`pair`, `n`: documents that hold it linked, and `best`: whether no pair of its first id is held by more. A written table."""
    counted = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counted = staging.write("counted", counted.withColumn("a", F.expr(f"pair div {vocabulary_b}")))
    # At most a row for each id of the vocabulary.
    highest = Sized.of(staging.write("highest", counted.groupBy("a").agg(F.max("n").alias("highest"))))
    marked = lookup(counted, highest, {"a": "a"}, {"highest": "highest"}, "inner", spread=["pair"])
    return staging.write("pair_counts", marked.select("pair", "n", (F.col("n") == F.col("highest")).alias("best")))


def frequent_level(counts: DataFrame, most: int) -> int:
    """The lowest level (eighths of a power of two) from which on at most so many pairs lie."""
    sizes = counts.groupBy(F.floor(8 * F.log2("n")).cast("int").alias("level")).count().collect()
    total, level = 0, 1 << 20
    # 8 levels for each bit of a count: at most 512 rows.
    for r in sorted(sizes, key=lambda r: -r["level"]):
        total += r["count"]
        if total > most:
            break
        level = r["level"]
    return level


def link_sums(aligned: DataFrame, counts: DataFrame, most: int = FREQUENT_PAIRS) -> DataFrame:
    """`row_no`, `n_best` (links of pairs that are best), `count_sum` (counts of all links) of rows with links.

    Pairs most links are of, a bounded number, are sent to all tasks; links of the others, each in few documents, are shuffled.
    """
    level = F.floor(8 * F.log2("n")).cast("int") >= frequent_level(counts, most)
    # The sign says whether a pair is best.
    coded = counts.select(F.col("pair").alias("p"), F.when(F.col("best"), -F.col("n")).otherwise(F.col("n")).alias("code"), level.alias("frequent"))
    links = aligned.select("row_no", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row_no", "l.pairs", "l.times")
    met = links.join(F.broadcast(coded.where("frequent").select("p", "code")), F.col("pairs") == F.col("p"), "left").drop("p")
    rare = coded.where("not frequent").select("p", F.col("code").alias("c"))
    rest = met.where("code is null").drop("code").join(rare, F.col("pairs") == F.col("p")).select("row_no", "times", F.col("c").alias("code"))

    def summed(some: DataFrame) -> DataFrame:
        best = F.sum(F.when(F.col("code") < 0, F.col("times")).otherwise(0)).alias("n_best")
        return some.groupBy("row_no").agg(best, F.sum(F.abs("code") * F.col("times")).alias("count_sum"))

    both = summed(met.where("code is not null")).unionByName(summed(rest))
    return both.groupBy("row_no").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align_corpus(docs: DataFrame, tokenizer_path: str, model_path: str, keep: list[str], text: str = "text", most: int = FREQUENT_PAIRS) -> DataFrame:
    """One row per row: the columns `keep` in `row`, `n_a`, `n_b`, `n_groups`, `n_links`, `groups_sha256` ('' without tokens), `n_best`, `count_sum`.

    Each row is a document, repeated ones too. See `align_texts` for texts without tokens; they have zeros. Texts are read and
    tokenized once; what is shuffled are counts, and the links of rare pairs.
    """
    staging = Staging(docs.sparkSession)
    tokenizer, model = read_model(tokenizer_path), read_model(model_path)
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    found = align_texts(docs.select(F.struct(*keep).alias("kept"), F.col(text).alias("text")), tokenizer, model)
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    found = found.select(F.col("row.kept").alias("row"), *numbers, digest, "pairs", "times")
    aligned = staging.write("aligned", found.withColumn("row_no", F.monotonically_increasing_id()))
    counts = pair_counts(aligned, len(parsed(model).pieces), staging)
    sums = link_sums(aligned, counts, most)
    out = aligned.select("row_no", "row", *numbers, "groups_sha256").join(sums, "row_no", "left")
    return out.select("row", *numbers, "groups_sha256", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")))
