"""SimHash near-duplicates: fingerprints of word shingles, linked at a few differing bits.

Fingerprints are made from whole texts inside Arrow batches. From then on only distinct fingerprints travel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sediment.llm.batches import small_batches
from sediment.llm.components import connected_components
from sediment.llm.words import text_key
from sediment.operators.lookup import Sized, lookup
from sediment.staging import Staging

SHINGLE = 4
MAX_BITS = 4
BITS = 64
# Hashes of a text whose bits are counted at a time; bounds memory for very long texts.
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes; a text without words has 0."""
    # bytes.lower() and bytes.split() know ASCII only: A-Z, and the six white-space characters.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    join, digest = b" ".join, xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        hashes = [digest(join(words[i : i + shingle]), 42) for i in range(at, min(at + CHUNK, n))]
        octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprints(rows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """`rows` (with a `text`), the text replaced by `fp`: the 64 bits as a long."""
    rest = [c for c in rows.columns if c != "text"]
    at = rows.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(at)], dtype=np.uint64).view(np.int64)
            columns = [batch.column(i) for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(prints, pa.int64())], names=[*rest, "fp"])

    schema = rows.drop("text").schema.add("fp", "long")
    return rows.mapInArrow(run, schema)


def segments(max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """(first bit, bits) of so few segments that at `max_bits` differing bits one of them differs in one at most."""
    n = max_bits // 2 + 1
    cuts = [round(i * BITS / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _mask(first: int, bits: int) -> int:
    return ((1 << bits) - 1) << first


def _long(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >= 1 << 63 else x).cast("long")


def variants(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Each print once per segment and wildcard bit of it: `slot` names both, `rest` has the segment's other bits."""
    rows = []
    for first, bits in segments(max_bits):
        for bit in range(first, first + bits):
            kept = F.col("fp").bitwiseAND(_long(_mask(first, bits) & ~(1 << bit)))
            rows.append(F.struct(F.lit(bit).cast("byte").alias("slot"), kept.alias("rest")))
    return prints.select("*", F.explode(F.array(*rows)).alias("v")).select(*prints.columns, "v.slot", "v.rest")


def first_slot(x: Column, slot: Column, max_bits: int = MAX_BITS) -> Column:
    """Whether `slot` is the first one in which two prints with the differing bits `x` meet."""
    case = F.lit(False)
    earlier = F.lit(True)
    for first, bits in segments(max_bits):
        own = x.bitwiseAND(_long(_mask(first, bits)))
        here = slot.between(first, first + bits - 1)
        # Segments that are equal meet in every slot, of which the first counts; else only at the differing bit.
        case = F.when(here, earlier & ((own != 0) | (slot == first))).otherwise(case)
        earlier = earlier & (F.bit_count(own) > 1)
    return case


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """`a` < `b` for all pairs of distinct `fp` at `max_bits` or fewer differing bits, each pair once."""
    return _links(variants(prints.select("fp"), max_bits), max_bits)


def _links(index: DataFrame, max_bits: int) -> DataFrame:
    """The links of an index.

    Both sides of the join are one shuffle of the index. The distance and the first-meeting rule are part of the
    join's condition, so only links leave it, and nothing needs to be made distinct after it.
    """
    other = index.select(*(F.col(c).alias(f"{c}_q") for c in index.columns))
    x = F.col("fp").bitwiseXOR(F.col("fp_q"))
    near = (F.col("fp") < F.col("fp_q")) & (F.bit_count(x) <= max_bits) & first_slot(x, F.col("slot"), max_bits)
    pairs = index.join(other, (F.col("slot") == F.col("slot_q")) & (F.col("rest") == F.col("rest_q")) & near)
    return pairs.select(F.col("fp").alias("a"), F.col("fp_q").alias("b"))


def between_roots(prints: DataFrame, staging: Staging, max_bits: int = MAX_BITS) -> DataFrame:
    """`a` < `b`: all links of `fp` with different `root`. Index entries under which all have one root are left out first.

    In the others the prints of all roots but the most frequent one are joined with the whole entry, so a large component that
    a few strangers share an entry with is not compared with itself.
    """
    c = F.col
    same, own = Window.partitionBy("slot", "rest"), Window.partitionBy("slot", "rest", "root")
    index = variants(prints.select("fp", "root"), max_bits)
    mixed = index.withColumns({"low": F.min("root").over(same), "high": F.max("root").over(same)}).where("low <> high")
    mixed = staging.write("mixed", mixed.drop("low", "high"))
    most = F.max(F.struct("n", "root")).over(same)
    rows = mixed.withColumn("n", F.count(F.lit(1)).over(own)).withColumn("major", most["root"]).drop("n")
    rows = staging.write("mixed_rows", rows)
    other = rows.select(*(c(x).alias(f"{x}_q") for x in ("slot", "rest", "fp", "root")))
    x = c("fp").bitwiseXOR(c("fp_q"))
    near = (c("root") != c("root_q")) & (F.bit_count(x) <= max_bits) & first_slot(x, c("slot"), max_bits)
    # Of two prints that both are of lesser roots one order is enough.
    once = (c("root_q") == c("major")) | (c("fp") < c("fp_q"))
    pairs = rows.where("root <> major").join(other, (c("slot") == c("slot_q")) & (c("rest") == c("rest_q")) & near & once)
    return pairs.select(F.least("fp", "fp_q").alias("a"), F.greatest("fp", "fp_q").alias("b"))


def first_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """`a` < `b`: links of each `fp` to the smallest one it shares an index entry with, no more than index rows."""
    same = Window.partitionBy("slot", "rest")
    met = variants(prints.select("fp"), max_bits).withColumn("a", F.min("fp").over(same)).where("a <> fp")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("fp"))) <= max_bits
    return met.where(near).select("a", F.col("fp").alias("b")).distinct()


def linked(prints: DataFrame, staging: Staging, max_bits: int = MAX_BITS) -> DataFrame:
    """`fp`, `root` of distinct `fp`: the smallest print of the component of each.

    A large group of near copies is one component by the links to the smallest prints alone, or nearly so. All links
    are then looked for between components only, so its pairs are neither compared nor made links.
    """

    def rooted(nodes: DataFrame, edges: DataFrame, name: str) -> DataFrame:
        roots = connected_components(staging.write(f"{name}_links", edges), staging, name).withColumnRenamed("root", "top")
        found = nodes.join(roots, F.col("root") == F.col("node"), "left")
        return staging.write(f"{name}_roots", found.select("fp", F.coalesce("top", "root").alias("root")))

    own = prints.select("fp", F.col("fp").alias("root"))
    near = rooted(own, first_links(prints, max_bits), "first")
    rest = staging.write("rest_pairs", between_roots(near, staging, max_bits))
    for end in ("a", "b"):
        rest = rest.join(near.select(F.col("fp").alias(end), F.col("root").alias(f"root_{end}")), end)
    between = rest.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    return rooted(near, between, "rest")


def labelled(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per document: `doc_id`, `text_key`, `fp`, `root` (a print that names the component), `component_id`."""
    staging = Staging(docs.sparkSession)
    t = F.col(text).cast("string")
    rows = docs.select(F.col(doc).alias("doc_id"), text_key(t).alias("text_key"), t.alias("text"))
    with small_batches(docs.sparkSession):
        rows = staging.write("prints", with_fingerprints(rows, shingle))
    prints = staging.write("distinct", rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    of_print = prints.join(linked(prints, staging, max_bits), "fp")
    # Written, so that the joins with it can split a large component.
    of_print = staging.write("of_print", of_print)
    lowest = staging.write("lowest", of_print.groupBy("root").agg(F.min("low").alias("component_id")))
    labels = staging.write("labels", of_print.join(lowest, "root").select("fp", "root", "component_id"))
    # A print that a third of the rows share is split.
    found = lookup(rows, Sized.of(labels), {"fp": "fp"}, {"root": "root", "component_id": "component_id"}, "inner", spread=("doc_id", "text_key"))
    return found.select("doc_id", "text_key", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: `doc_id`, `fp` (long), `component_id`, the smallest id reachable over links.

    A null or empty text has no words and fingerprint 0, which links like any other. Rows with equal fingerprints
    are linked, repeated rows too; ids that are null are no smallest id, so a component of such rows only has a null
    `component_id`. An empty table gives no rows; other columns are not read.
    """
    return labelled(docs, doc, text, **options).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """`docs` with one row of each component: that of its smallest id (rows without an id last).

    Of rows of one id the one with the smallest key of its text stays, of rows equal in both the smallest in all columns.
    All columns stay. Texts are joined only with the marks of what goes or is repeated, and are shuffled only if
    those are too many to broadcast.
    """
    staging = Staging(docs.sparkSession)
    rows = staging.write("labelled", labelled(docs, doc, text, **options).select("doc_id", "text_key", "root"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    first = staging.write("first", rows.groupBy("root").agg(F.min(order).alias("first")))
    each = rows.groupBy("root", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    marks = each.join(first, "root").where(~order.eqNullSafe(F.col("first")) | (F.col("n") > 1))
    marks = marks.select(
        F.col("doc_id").alias("_d"), F.col("text_key").alias("_k"), order.eqNullSafe(F.col("first")).alias("_stays")
    )
    marks = staging.write("marks", marks)
    given = docs.select(F.struct("*").alias("_row"))
    d, t = F.col(f"_row.`{doc}`"), F.col(f"_row.`{text}`").cast("string")
    near = F.broadcast(marks) if Sized.of(marks).fits() else marks
    marked = given.join(near, d.eqNullSafe(F.col("_d")) & (text_key(t) == F.col("_k")), "left")
    whole = marked.where("_k is null").select("_row.*")
    repeated = marked.where("_stays").groupBy("_d", "_k").agg(F.min("_row").alias("_row")).select("_row.*")
    return whole.unionByName(repeated)
