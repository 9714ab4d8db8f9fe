"""Mixing sources to target weights by weighted fair queueing.

Every document gets a place in its source's shuffled order; the words up to and including it, divided by the source's
target, are its virtual finish time. Documents of all sources in the order of that time, cut at the budget, are the mix.
A source whose target is above its size comes again, up to three times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sediment.llm.words import SPACES, split_words
from sediment.operators.lookup import Sized, lookup
from sediment.staging import Staging

MAX_REPEATS = 3
# Documents that one task of a window orders.
BUCKET_ROWS = 4_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """`key`, `source_size`, `target` for `key`, `source`, `source_size` of all sources.

    Sources in code-point order, null last, weigh `weights` in turn and share the total. Going up by the ratio of
    cap to weight, a source is capped if its cap is below its share of what is left; the others share the rest.
    Holds one row per source in one task, no documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.array(*map(F.lit, weights))[F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))]
    cap = MAX_REPEATS * F.col("source_size")
    rows = sizes.withColumn("w", weight.cast("long")).withColumn("cap", cap)
    up = Window.orderBy((F.col("cap").cast("double") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    rows = rows.withColumns(
        {
            "left_w": F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)),
            "left_b": F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        }
    )
    capped = F.col("cap").cast("double") * F.col("left_w") < F.col("left_b").cast("double") * F.col("w")
    rows = rows.withColumn("capped", capped)
    free_w = F.sum(F.when(~F.col("capped"), F.col("w"))).over(every)
    free_b = F.sum("source_size").over(every) - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0))
    rows = rows.withColumns({"free_w": free_w, "free_b": free_b})
    share = F.col("free_b").cast("double") / F.col("free_w").cast("double") * F.col("w")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.least(share, F.col("cap").cast("double")))
    return rows.select("key", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (1, 2, 3), seed: str = "mix"
) -> DataFrame:
    """One row per document: `doc_id`, `size`, `source_size`, `target`, `taken`.

    A null or empty text has size 0 and takes nothing; a null source is a source; repeated rows are documents of
    their own; with no words at all nothing is taken. The shuffle is a digest of the id, so reruns agree;
    rows of one id follow by size. No group is ordered whole: sums per (source, digest range) give each range its start, and the
    global cut is found from sums per range of finish times, then inside the one range that holds it.
    """
    staging = Staging(docs.sparkSession)
    shuffled = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc).cast("string"), F.lit(""))))
    rows = docs.select(
        F.col(doc).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.size(split_words(F.col(text), SPACES)).cast("long").alias("size"),
        shuffled.alias("r"),
    )
    key = F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col("source")))
    # Rows alike in all that counts are one row until the end.
    alike = rows.withColumn("key", key).groupBy("key", "source", "r", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies"))
    rows = staging.write("sizes", alike)
    words = F.col("size") * F.col("copies")
    sizes = rows.groupBy("key", "source").agg(F.sum(words).alias("source_size"), F.count(F.lit(1)).alias("n"))
    sizes = staging.write("sources", sizes)
    totals = sizes.agg(F.sum("source_size").alias("b"), F.sum("n").alias("n")).first()
    budget, count = totals["b"] or 0, totals["n"] or 0
    targets = staging.write("targets", source_targets(sizes, weights))
    bits = max((count // BUCKET_ROWS).bit_length(), 1)

    bucket = F.shiftright(F.conv(F.substring("r", 1, 8), 16, 10).cast("long"), 32 - bits)
    rows = rows.withColumn("bucket", bucket)
    sums = rows.groupBy("key", "bucket").agg(F.sum(words).alias("words"))
    start = F.sum("words").over(Window.partitionBy("key").orderBy("bucket")) - F.col("words")
    starts = staging.write("starts", sums.select(F.col("key").alias("k"), F.col("bucket").alias("b"), start.alias("start")))
    inside = Window.partitionBy("key", "bucket").orderBy("r", F.col("doc_id").asc_nulls_last(), "size")
    placed = rows.withColumn("before", F.sum(words).over(inside) - words)
    same = (F.col("key") == F.col("k")) & (F.col("bucket") == F.col("b"))
    fits = Sized.of(starts).fits()
    placed = placed.join(F.broadcast(starts) if fits else starts, same)
    placed = placed.withColumn("j", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    placed = placed.select("key", "doc_id", "size", (F.col("start") + F.col("before") + F.col("j") * F.col("size")).alias("upto"))
    placed = lookup(placed, Sized.of(targets), {"key": "key"}, {"source_size": "source_size", "target": "target"}, "inner", spread=("upto",))
    placed = staging.write("placed", placed)

    times = [
        F.struct((((e * F.col("source_size") + F.col("upto")).cast("double")) / F.col("target")).alias("v"), F.col("key").alias("key"), (e * F.col("source_size") + F.col("upto")).alias("at"))
        for e in range(MAX_REPEATS)
    ]
    moving = placed.where((F.col("size") > 0) & (F.col("target") > 0)).select("size", F.explode(F.array(*times)).alias("t"))
    moving = moving.select("size", "t.*").withColumn("range", F.floor(F.col("v") * (1 << bits)))
    taken = F.lit(0)
    cut = _cut(moving, budget, staging)
    if cut is not None:
        last = F.struct(F.lit(cut["v"]).alias("v"), F.lit(cut["key"]).alias("key"), F.lit(cut["at"]).alias("at"))
        for t in times:
            taken = taken + F.when((F.col("target") > 0) & (t <= last), 1).otherwise(0)
    return placed.select("doc_id", "size", "source_size", "target", (F.col("size") * taken).cast("long").alias("taken"))


def _cut(moving: DataFrame, budget: int, staging: Staging):
    """The last row, in the order of (v, key, at), up to which the sizes stay within the budget."""
    ranges = staging.write("ranges", moving.groupBy("range").agg(F.sum("size").alias("words")))
    upto = F.sum("words").over(Window.orderBy("range"))
    over = ranges.withColumn("upto", upto).where(F.col("upto") > budget).orderBy("range").limit(1).collect()
    if over:
        hit, left = over[0]["range"], budget - (over[0]["upto"] - over[0]["words"])
        near = moving.where(F.col("range") == hit)
        near = near.withColumn("sum", F.sum("size").over(Window.orderBy("v", "key", "at"))).where(F.col("sum") <= left)
        found = near.agg(F.max(F.struct("v", "key", "at")).alias("m")).first()["m"]
        if found is not None:
            return found
        earlier = moving.where(F.col("range") < hit)
    else:
        earlier = moving
    return earlier.agg(F.max(F.struct("v", "key", "at")).alias("m")).first()["m"]
