"""Line dedup: an exact set-similarity join of lines, after which later matches go.

Lines with the same words in the same order are one line, known by 128 bits of SHA-256 of them. A line's tokens are its distinct words, ordered by
rarity. Lines whose prefixes share a token and that pass the length, positional and bitmap filters are candidates, and
their Jaccard similarity is verified on their words. Rarity comes from a counting sketch of fixed size: the order of
tokens decides how few candidates there are, never which matches are found.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from sediment.llm.batches import small_batches
from sediment.llm.words import SPACES, lower_ascii, split_words, text_key
from sediment.operators.lookup import Sized
from sediment.staging import Staging

# Jaccard threshold as a fraction.
SIMILAR = (4, 5)
# Counters of the rarity sketch, 8 bytes each on the driver and in every task.
SKETCH_BITS = 17
# Bytes of text read at a time, and words or line keys a task remembers: the hash of each word, and which lines' tokens it has sent.
CHUNK = 1 << 17
REMEMBERED = 1 << 19

# Words this long are hashed by XXH64 with this seed, as sums of powers of longer ones can be made to collide. Of a hash so many bits are kept.
LONG, SEED = 256, 0x5ED1
TOKEN_BITS = 40

# 64-bit words of a line's parity bitmap. Tokens are dealt with all of them folded into one, and where lines have more words than WIDE, into two.
BITMAP = 4
BITS = tuple(f"p{i}" for i in range(BITMAP))
WIDE = 80

# Bands of line lengths at most. Parts in which the tokens are dealt, one after another, so that what one shuffles is gone before the next.
BANDS = 32
PARTS = 2


# Fixed odd base of the words' hashes; white space but line ends as spaces; bytes that are neither.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACES = bytes.maketrans(b"\t\x0b\x0c\r", b"    ")
_LETTER = np.ones(256, bool)
_LETTER[[10, 32]] = False


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Lines:
    """The words of many texts at once: where each begins and ends, its hash and its line."""

    def __init__(self) -> None:
        self._inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        self._grow(1 << 18)

    def _grow(self, n: int) -> None:
        self.up, self.down = _powers(_BASE, n), _powers(self._inverse, n)

    def words(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Beginnings, ends, hashes and line numbers of the words. `data` has no white space but spaces and line ends, and ends in a line end."""
        import xxhash

        b = np.frombuffer(data, np.uint8)
        if len(b) + 1 > len(self.up):
            self._grow(2 * len(b) + 1)
        letter = _LETTER[b]
        before = np.concatenate(([False], letter[:-1]))
        starts, ends = np.flatnonzero(letter & ~before), np.flatnonzero(~letter & before)
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.up[: len(b)], out=sums[1:])
        hashes = _mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))
        for i in np.flatnonzero(ends - starts >= LONG).tolist():
            hashes[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]], SEED)
        return starts, ends, hashes, np.cumsum(b == 10, dtype=np.int64)[starts]


def _chunks(column: pa.Array) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """(first row, some texts in lower case, each with a line end, with spaces for all other white space, first line of each)."""
    texts, starts, size, line, first = [], [], 0, 0, 0
    for i in range(len(column)):
        data = (column[i].as_py() or "").encode("utf-8", "surrogatepass").lower().translate(_SPACES) + b"\n"
        texts.append(data)
        starts.append(line)
        line += data.count(b"\n")
        size += len(data)
        if size >= CHUNK or i == len(column) - 1:
            yield first, b"".join(texts), np.array(starts, np.int64)
            texts, starts, size, line, first = [], [], 0, 0, i + 1


def _digests(data: bytes, starts: np.ndarray, ends: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The lines with a word, and 128 bits of SHA-256 of the words of each with a space in between."""
    first = np.flatnonzero(np.concatenate((lines[:1] == lines[:1], lines[1:] != lines[:-1])))
    last = np.append(first[1:], len(lines)) - 1
    letters = np.add.reduceat(ends - starts, first) + last - first
    out = []
    for a, b, n in zip(starts[first].tolist(), ends[last].tolist(), letters.tolist()):
        line = data[a:b] if b - a == n else b" ".join(data[a:b].split())
        out.append(sha256(line).digest()[:16])
    return lines[first], out


def sketch(texts: DataFrame, bits: int = SKETCH_BITS) -> np.ndarray:
    """Counters of the words of all texts (one column), by the top bits of their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, counts = Lines(), np.zeros(1 << bits, np.int64)
        for batch in batches:
            for _, data, _ in _chunks(batch.column(0)):
                _, _, found, _ = reader.words(data)
                counts += np.bincount((found >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())], names=["slot", "n"])

    summed = texts.mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << bits, np.int64)
    out[summed["slot"].to_numpy()] = summed["n"].to_numpy()
    return out


def levels(counters: np.ndarray) -> np.ndarray:
    """Rarity in 256 steps: eighths of powers of two."""
    return np.minimum(8 * np.log2(counters + 1.0), 255).astype(np.uint64)


def rarest_first(found: np.ndarray, where: np.ndarray, rarity: np.ndarray, bits: int) -> np.ndarray:
    """The order of tokens by line, then rarity, then hash.

    One sort of 20 bits of line, 8 of rarity and 36 of hash; where that leaves different tokens alike, or lines are
    too many, a slower sort of all bits.
    """
    rare = rarity[(found >> np.uint64(64 - bits)).astype(np.int64)]
    line = where.astype(np.uint64)
    if len(line) and line[-1] < 1 << 20 and line.max() < 1 << 20:
        key = (line << np.uint64(44)) | (rare << np.uint64(36)) | (found >> np.uint64(28))
        order = np.argsort(key)
        key, sorted_found = key[order], found[order]
        if not ((key[1:] == key[:-1]) & (sorted_found[1:] != sorted_found[:-1])).any():
            return order
    return np.lexsort((found, rare, line))


def prefix_length(n: np.ndarray, similar: tuple[int, int]) -> np.ndarray:
    """Two sets this similar share one of so many first tokens of each."""
    num, den = similar
    return n - (n * num + den - 1) // den + 1


def parity(tokens: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
    """For runs of tokens from `begin`: for each bit whether an odd number of them fall on it.

    What two runs share cancels out, so their bitmaps differ in no more bits than the runs in tokens.
    """
    slot, bit = (tokens >> np.uint64(6)) % np.uint64(BITMAP), np.uint64(1) << (tokens & np.uint64(63))
    return [np.bitwise_xor.reduceat(np.where(slot == i, bit, np.uint64(0)), begin) for i in range(BITMAP)]


def not_before(a: object, b: object) -> bool:
    """Whether id `a` is `b` or known to come after it, nulls last. Ids that Python cannot order are told to be the same only."""
    if a is None or b is None:
        return a is None
    try:
        return bool(a >= b)
    except TypeError:
        return a == b


def line_rows(rows: DataFrame, counters: np.ndarray, similar: tuple[int, int]) -> DataFrame:
    """A row for each line with a word: `doc_id`, `text_key`, `no`, `k1`, `k2` (a digest of its words), `n` tokens, and
    `prefix`, the rarest tokens in order, and BITS, a parity bitmap of all tokens. The prefix is empty if the same task has sent the line before
    with that id or an earlier one, so a line's first document always sends it."""
    bits = len(counters).bit_length() - 1
    shared = rows.sparkSession.sparkContext.broadcast(levels(counters))
    names = ["doc_id", "text_key", "no", "k1", "k2", "n", "prefix", *BITS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, seen, rarity = Lines(), {}, shared.value
        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            for first, data, starts in _chunks(batch.column("text")):
                begins, ends, found, where = reader.words(data)
                if not len(found):
                    continue
                ids, digests = _digests(data, begins, ends, where)
                keys = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                order = rarest_first(found, where, rarity, bits)
                found, where = found[order], where[order]
                new = np.concatenate(([True], (found[1:] != found[:-1]) | (where[1:] != where[:-1])))
                found, where = found[new], where[new]
                begin = np.searchsorted(where, ids)
                n = np.diff(np.append(begin, len(where)))
                keep = prefix_length(n, similar)
                if len(seen) > REMEMBERED:
                    seen.clear()
                row = np.searchsorted(starts, ids, side="right") - 1
                for i, (key, r) in enumerate(zip(digests, (row + first).tolist())):
                    if key in seen and not_before(docs[r], seen[key]):
                        keep[i] = 0
                    else:
                        seen[key] = docs[r]
                offsets = np.concatenate(([0], np.cumsum(keep)))
                at = np.repeat(begin - offsets[:-1], keep) + np.arange(offsets[-1])
                of_row = pa.array(row + first)
                tokens = (found[at] >> np.uint64(64 - TOKEN_BITS)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(of_row),
                        batch.column("text_key").take(of_row),
                        pa.array(ids - starts[row], pa.int32()),
                        pa.array(keys[:, 0]),
                        pa.array(keys[:, 1]),
                        pa.array(n, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(tokens)),
                        *(pa.array(x.view(np.int64)) for x in parity(found, begin)),
                    ],
                    names=names,
                )

    schema = rows.select("doc_id", "text_key").schema
    for name, kind in zip(names[2:], ("int", "long", "long", "int", "array<bigint>", *["long"] * BITMAP)):
        schema = schema.add(name, DataType.fromDDL(kind))
    return rows.mapInArrow(run, schema)


def fitting(df: DataFrame) -> DataFrame:
    """A written table of fixed-width columns, broadcast if its counted rows allow."""
    return F.broadcast(df) if Sized.of(df).fits() else df


def _long_enough(a: str, b: str, similar: tuple[int, int]) -> Column:
    """Length and positional filter of lines whose columns end in `a` and `b` and whose first shared token is at their `i`."""
    num, den = similar
    c = F.col
    n, m = c(f"n{a}"), c(f"n{b}")
    enough = F.least(n - c(f"i{a}"), m - c(f"i{b}")) * (num + den) >= (n + m) * num
    return (F.least(n, m) * den >= F.greatest(n, m) * num) & enough


def may_match(a: str, b: str, similar: tuple[int, int]) -> Column:
    """Length, positional and bitmap filter."""
    return _long_enough(a, b, similar) & few_apart(a, b, ("fold",), similar)


def few_apart(a: str, b: str, bits: tuple[str, ...], similar: tuple[int, int]) -> Column:
    """Whether bitmaps let two lines be similar: of both lines' tokens, so many are in one of them only."""
    return _few(sum(F.bit_count(F.col(f"{p}{a}").bitwiseXOR(F.col(f"{p}{b}"))) for p in bits), a, b, similar)


def _few(apart: Column, a: str, b: str, similar: tuple[int, int]) -> Column:
    num, den = similar
    return apart * (num + den) <= (F.col(f"n{a}") + F.col(f"n{b}")) * (den - num)


def halves_few_apart(a: str, b: str, similar: tuple[int, int]) -> Column:
    """`few_apart` by both halves of the bitmaps, each folded into a word. Nearly all long lines pass with one word, so their pairs would grow with
    the square of their number; a line of few words has no half of its own and passes."""
    short = F.least(F.col(f"n{a}"), F.col(f"n{b}")) <= WIDE
    one = F.col(f"half{a}").bitwiseXOR(F.col(f"half{b}"))
    other = F.col(f"fold{a}").bitwiseXOR(F.col(f"fold{b}")).bitwiseXOR(one)
    return short | _few(F.bit_count(one) + F.bit_count(other), a, b, similar)


def _ended(df: DataFrame, end: str) -> DataFrame:
    return df.select(*(F.col(c).alias(f"{c}{end}") for c in df.columns))


def _unordered(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Each pair of lines once."""
    return pairs.select(F.least(a, b).alias("k1_a"), F.greatest(a, b).alias("k1_b")).distinct()


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("k1_a", "k1_b")).alias("k1")).distinct()


def _likely(pairs: DataFrame, sent: DataFrame, staging: Staging, similar: tuple[int, int]) -> DataFrame:
    """The pairs that their lines' whole bitmaps let be similar: one word of them says little of long lines."""
    ends = staging.write("likely_ends", _ends(pairs))
    marks = fitting(staging.write("marks", sent.select("k1", "n", *BITS).join(fitting(ends), "k1", "left_semi").distinct()))
    for end in ("_a", "_b"):
        pairs = pairs.join(_ended(marks, end), f"k1{end}")
    return staging.write("likely", pairs.where(few_apart("_a", "_b", BITS, similar)).select("k1_a", "k1_b").distinct())


def _texts(rows: DataFrame, firsts: DataFrame, pairs: DataFrame, staging: Staging, name: str) -> DataFrame:
    """`k1`, `k2`, `at` (place) and `line` of the lines in pairs, from the documents they are first in."""
    keys = staging.write(f"{name}_ends", _ends(pairs))
    wanted = firsts.join(fitting(keys), "k1", "left_semi")
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "no").alias("at")
    listed = wanted.groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("k")).agg(F.collect_list(F.struct("no", "k1", "k2", at)).alias("lines"))
    of_doc = staging.write(f"{name}_of_doc", listed)
    sized = Sized.of(of_doc.select("d", "k", F.to_json("lines").alias("lines")))
    other = F.broadcast(of_doc) if sized.fits() else of_doc
    held = rows.join(other, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")))
    held = held.select(F.split("text", "\n", -1).alias("all"), F.explode("lines").alias("l"))
    held = held.select("l.k1", "l.k2", "l.at", F.get("all", F.col("l.no")).alias("line"))
    # Rows equal in id and text bring the same line more than once.
    return staging.write(f"{name}_held", held.dropDuplicates(["k1", "k2"]))


def _matched(pairs: DataFrame, held: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """`k1`, `k2` of the later line of each pair that is similar by its words."""
    num, den = similar
    both = pairs.join(_ended(held, "_a"), "k1_a").join(_ended(held, "_b"), "k1_b")
    late = F.col("at_a") > F.col("at_b")
    later = [F.when(late, F.col(f"{k}_a")).otherwise(F.col(f"{k}_b")).alias(k) for k in ("k1", "k2")]
    # Through arrays, so that each text is split and each set made once.
    lines = F.array(*(split_words(lower_ascii(F.col(f"line{e}")), SPACES) for e in ("_a", "_b")))
    sets = both.select(*later, F.transform(lines, F.array_distinct).alias("sets"))

    def same(s: Column) -> Column:
        x, y = F.get(s, F.lit(0)), F.get(s, F.lit(1))
        return F.size(F.array_intersect(x, y)) * (num + den) >= (F.size(x) + F.size(y)) * num

    verdict = F.get(F.transform(F.array("sets"), same), F.lit(0))
    return sets.where(verdict).select("k1", "k2").distinct()


def _tokens(sent: DataFrame, similar: tuple[int, int], *columns: str | Column) -> DataFrame:
    """A row for each token of the prefixes: `k1`, `doc_id`, `place` (line number and `n`), `i`, `key`, and `columns`.

    The key holds the token and a band of line lengths, so that lines of one token meet only those about as long. The shorter line
    of a pair has its first shared token further ahead than the prefix goes; where its partners may be in the next band, those of its tokens go there too.
    """
    num, den = similar
    c = F.col
    # Twice as long at least, so that partners are at most one band further.
    own, reach = (F.floor(F.log(max(2.0, 1.5 * den / num), n)) for n in (c("n"), F.floor(c("n") * den / num)))
    ahead = (c("n") - F.ceil(c("n") * 2 * num / (num + den)) + 1).cast("int")
    up = F.when(reach > own, F.slice("prefix", 1, ahead)).otherwise(F.array().cast("array<bigint>"))
    place = F.shiftleft(c("no").cast("long"), 32).bitwiseOR(c("n")).alias("place")
    given = ["k1", "doc_id", place, *columns]
    lines = sent.select(*given, own.alias("own"), F.size("prefix").alias("keep"), F.concat("prefix", up).alias("all"))
    named = lines.columns[: len(given)]
    rows = lines.select(*named, "own", "keep", F.posexplode("all").alias("at", "token"))
    later = (c("at") >= c("keep")).cast("int")
    key = c("token") * BANDS + c("own") + later
    # Said once here, Spark does not put it on one side of a join only.
    return rows.select(*named, (c("at") - c("keep") * later).alias("i"), key.alias("key"), later.alias("up")).where("k1 is not null and key is not null")


def _earlier_id(a: str, b: str) -> Column:
    """Whether the id ending in `b` is not after that in `a`, nulls last."""
    return F.col(f"doc_id{a}").isNull() | (F.col(f"doc_id{b}") <= F.col(f"doc_id{a}"))


def _met(tokens: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """`k1` and `k1_o` of lines that may match, the other not of a later document, `by_first`, and `wide`, whether both have more words than two words of bitmap tell apart.

    A line that may match the earliest line of a key meets only that one of the key, and `by_first` is the key; else it is null and the line meets all
    of the key. So groups of near copies make about as many pairs as they have lines.
    """
    c = F.col
    # Both sides of the join read one exchange, so each uses all columns.
    dealt = tokens.repartition("key")
    n = c("place").bitwiseAND(F.lit((1 << 32) - 1)).alias("n")
    side = ["key", "k1", "doc_id", n, "i", "up", "fold", "half"]
    first = F.min(F.struct(c("doc_id").isNull(), "doc_id", "place", "k1", "i", "up", "fold", "half")).over(Window.partitionBy("key"))
    mine = dealt.withColumn("first", first).select(*side, *(c(f"first.{x}").alias(f"{x}_h") for x in ("k1", "place", "i", "fold", "half")))
    mine = mine.withColumn("n_h", c("place_h").bitwiseAND(F.lit((1 << 32) - 1)))
    by_first = (c("k1") != c("k1_h")) & may_match("", "_h", similar) & halves_few_apart("", "_h", similar)
    mine = mine.select(*(x if isinstance(x, str) else "n" for x in side), "k1_h", by_first.alias("by_first"))
    # Two lines that both are here for longer ones meet in their own band.
    other = _long_enough("", "_o", similar) & _earlier_id("", "_o") & (c("up") + c("up_o") < 2)
    other = other & few_apart("", "_o", ("fold",), similar) & halves_few_apart("", "_o", similar)
    on = (c("key") == c("key_o")) & (c("k1") != c("k1_o")) & F.when(c("by_first"), c("k1_o") == c("k1_h")).otherwise(other)
    wide = (F.least("n", "n_o") > 2 * WIDE).alias("wide")
    found = mine.join(_ended(dealt.select(*side), "_o"), on)
    return found.select("k1", "k1_o", F.when(c("by_first"), c("key")).alias("by_first"), wide).distinct()


def matching_lines(rows: DataFrame, lines: DataFrame, firsts: DataFrame, staging: Staging, similar: tuple[int, int]) -> DataFrame:
    """`k1`, `k2` of the lines with a similar earlier one.

    Tokens are dealt once, in PARTS, and lines meet as `_met` says; a line that met the earliest of a key is compared with such lines only. If it is
    similar to none of them it is open, and is compared with the others it met, and with all not after it of the keys of which it met the earliest only.
    As only the later of two lines goes, no other line need be met. Candidates go by `k1`; where two lines share one, both are looked at.
    """
    c = F.col
    sent = lines.where(F.size("prefix") > 0)
    fold = reduce(Column.bitwiseXOR, map(c, BITS)).alias("fold")
    half = F.when(c("n") > WIDE, reduce(Column.bitwiseXOR, map(c, BITS[: BITMAP // 2]))).otherwise(0).alias("half")
    tokens = _tokens(sent, similar, fold, half)
    # Bits of the token that tell nothing of its partition.
    part = F.pmod(F.floor(c("key") / BANDS), F.lit(PARTS))
    met = reduce(DataFrame.unionByName, (staging.write(f"met_{i}", _met(tokens.where(part == i), similar)) for i in range(PARTS)))
    best = met.withColumn("any", F.max("by_first").over(Window.partitionBy("k1"))).where("by_first is not null or any is null")
    pairs = staging.write("met", best.groupBy(F.least("k1", "k1_o").alias("k1_a"), F.greatest("k1", "k1_o").alias("k1_b")).agg(F.first("wide").alias("wide")))
    likely = _likely(pairs.where("wide").drop("wide"), sent, staging, similar)
    pairs = likely.unionByName(pairs.where("not wide").drop("wide"))
    settled = staging.write("settled", _matched(pairs, _texts(rows, firsts, pairs, staging, "met"), similar))

    shared = firsts.groupBy("k1").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1").select("k1")
    done = settled.select("k1").distinct().join(shared, "k1", "left_anti")
    firsts_only = met.where("by_first is not null").select("k1", c("by_first").alias("key")).distinct()
    open_keys = staging.write("open", firsts_only.join(done, "k1", "left_anti"))
    open_lines = fitting(staging.write("open_lines", open_keys.select("k1").distinct()))
    mine = _tokens(sent.join(open_lines, "k1", "left_semi"), similar, "n", *BITS).join(fitting(open_keys), ["k1", "key"], "left_semi")
    theirs = _ended(_tokens(sent, similar, "n", *BITS).join(fitting(staging.write("open_keys", open_keys.select("key").distinct())), "key", "left_semi"), "_o")
    on = (c("key") == c("key_o")) & (c("k1") != c("k1_o")) & _earlier_id("", "_o") & (c("up") + c("up_o") < 2)
    rest = mine.join(theirs, on & _long_enough("", "_o", similar) & few_apart("", "_o", BITS, similar)).select("k1", "k1_o")
    rest = rest.unionByName(met.where("by_first is null").join(open_lines, "k1", "left_semi").select("k1", "k1_o"))
    rest = staging.write("rest", _unordered(rest, "k1", "k1_o").join(pairs, ["k1_a", "k1_b"], "left_anti"))
    more = _matched(rest, _texts(rows, firsts, rest, staging, "rest"), similar)
    return staging.write("matching", settled.unionByName(more).distinct())


def removed_lines(docs: DataFrame, staging: Staging, doc: str = "doc_id", text: str = "text", similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """`doc_id`, `text_key`, `gone` (line numbers from 0): what `dedup_lines` takes out."""
    t = F.col(text).cast("string")
    rows = docs.select(F.col(doc).alias("doc_id"), text_key(t).alias("text_key"), t.alias("text"))
    with small_batches(docs.sparkSession):
        counters = sketch(rows.select("text"))
        lines = staging.write("lines", line_rows(rows, counters, similar))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "no")
    found = lines.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies"))
    firsts = staging.write("firsts", found.select("k1", "k2", "first.doc_id", "first.text_key", "first.no", "copies"))
    bad = matching_lines(rows, lines, firsts, staging, similar)
    # Lines that are there once and match none lose nothing.
    verdicts = firsts.join(fitting(bad).withColumn("bad", F.lit(True)), ["k1", "k2"], "left").where("bad or copies > 1").drop("copies")
    verdicts = fitting(staging.write("verdicts", _ended(verdicts, "_f")))
    same = F.col("doc_id").eqNullSafe(F.col("doc_id_f")) & (F.col("text_key") == F.col("text_key_f")) & (F.col("no") == F.col("no_f"))
    copies = lines.select("doc_id", "text_key", "no", "k1", "k2").join(verdicts, (F.col("k1") == F.col("k1_f")) & (F.col("k2") == F.col("k2_f")))
    gone = copies.where(F.col("bad_f").isNotNull() | ~same)
    return staging.write("gone", gone.groupBy("doc_id", "text_key").agg(F.collect_set("no").alias("gone")))


def dedup_lines(docs: DataFrame, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """`row` (the whole given row), `text` without the lines that match an earlier one, `n_lines`, `n_removed`.

    Lines come in the order of (id, nulls last, key of the text, line number). A line is removed if an earlier line of
    the corpus has a Jaccard similarity of at least 4/5 of their words, whether or not that one stays. Lines without words stay.
    A null text stays null and an empty one empty; a document may lose all its lines and stays, with an empty text; rows
    equal in id and text count as one document, so they lose the same lines. Case of A-Z and the width of
    white space do not matter. A line of any length is one set of words; other columns may have any name. Texts are shuffled only if the removals are too many to broadcast.
    """
    staging = Staging(docs.sparkSession)
    gone = removed_lines(docs, staging, doc, text, **options).select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k"), "gone")
    sized = Sized.of(gone.select("_d", "_k", F.to_json("gone").alias("g")))
    given = docs.select(F.struct("*").alias("row"))
    t = F.col(f"row.`{text}`").cast("string")
    on = F.col(f"row.`{doc}`").eqNullSafe(F.col("_d")) & (text_key(t) == F.col("_k"))
    joined = given.join(F.broadcast(gone) if sized.fits() else gone, on, "left")
    split = joined.select("row", t.alias("text"), F.split(t, "\n", -1).alias("all"), "gone")
    stays = F.array_except(F.sequence(F.lit(0), F.size("all") - 1), F.col("gone"))
    kept = F.array_join(F.transform(stays, lambda i: F.get(F.col("all"), i)), "\n")
    return split.select(
        "row",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("all")).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
    )
