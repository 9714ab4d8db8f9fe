"""Benchmark decontamination: word windows of test items found in documents.

Windows of benchmark items are a small distinct set, sent to every executor if its measured size allows. Documents
are scanned once; a window whose hash is in the set is compared word for word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.words import NOT_ALNUM, lower_ascii, split_words, text_key, whole
from sediment.operators.lookup import Sized
from sediment.staging import Staging

WINDOW = 10


def scan_words(text: Column) -> Column:
    return split_words(lower_ascii(whole(text)), NOT_ALNUM)


def benchmark_windows(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """`item_id` (text), `gram` (the window's words, space-joined), `len`; an item shorter than a window is one, an empty one none."""
    words = benchmark.select(F.col(item).cast("string").alias("item_id"), scan_words(F.col(text)).alias("w"))
    words = words.where(F.size("w") > 0).withColumn("len", F.least(F.size("w"), F.lit(window)))
    places = words.select("item_id", "w", "len", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1)).alias("p"))
    gram = F.array_join(F.slice("w", F.col("p"), F.col("len")), " ")
    return places.select("item_id", gram.alias("gram"), "len").distinct()


def covered(spans: Column) -> Column:
    """Words covered by (place, length) spans, each word once."""
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("hit"))

    def add(state: Column, span: Column) -> Column:
        last = span["p"] + span["len"] - 1
        fresh = F.greatest(last - F.greatest(state["upto"], span["p"] - 1), F.lit(0))
        return F.struct(F.greatest(state["upto"], last).alias("upto"), (state["hit"] + fresh).alias("hit"))

    return F.aggregate(F.array_sort(spans), zero, add, lambda s: s["hit"])


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per distinct (doc_id, text): `doc_id`, `text_key`, `copies`, `n_words`, `n_hit`, `items` (sorted as text), `spans`.

    `spans` are (first word from 1, words) of each occurrence. A null text has no words and no hits; rows equal in
    id and text are one row with `copies`; rows of one id with different texts stay apart; benchmark items without an
    id hit words but are no items; an empty benchmark or document table is fine. Other columns are not read.
    """
    staging = Staging(docs.sparkSession)
    of_items = staging.write("windows", benchmark_windows(benchmark, item, text=item_text, window=window))
    # What the words of a window hash to finds it, its words prove it.
    grams = staging.write(
        "grams", of_items.select("gram", "len").distinct().withColumn("gram_hash", F.xxhash64(F.split("gram", " ")))
    )
    lengths = sorted(r["len"] for r in grams.select("len").distinct().collect())  # at most `window` of them
    known = Sized.of(grams.select("gram", "gram_hash"))

    rows = docs.select(F.col(doc).alias("doc_id"), text_key(F.col(text)).alias("text_key"), scan_words(F.col(text)).alias("w"))
    # Place 0 stands for the document itself, so one pass also brings those without a hit.
    last = F.greatest(F.size("w") - F.lit(min(lengths, default=window)) + 1, F.lit(0))
    places = rows.select("doc_id", "text_key", "w", F.size("w").alias("n"), F.explode(F.sequence(F.lit(0), last)).alias("p"))
    if len(lengths) > 1:
        places = places.withColumn("len", F.explode(F.when(F.col("p") > 0, F.array(*map(F.lit, lengths))).otherwise(F.array(F.lit(0)))))
        places = places.where(F.col("p") + F.col("len") - 1 <= F.col("n"))
    else:
        places = places.withColumn("len", F.lit(lengths[0] if lengths else window))
    piece = F.slice("w", F.greatest("p", F.lit(1)), F.col("len"))
    if known.fits():
        hashed = places.withColumn("h", F.when(F.col("p") > 0, F.xxhash64(piece)))
        same = (F.col("h") == F.col("gram_hash")) & (F.array_join(piece, " ") == F.col("gram"))
        found = hashed.join(F.broadcast(known.df), same, "left").where((F.col("p") == 0) | F.col("gram").isNotNull())
        found = found.select("doc_id", "text_key", "n", "p", "len", "gram")
    else:
        own = places.where("p = 0").select("doc_id", "text_key", "n", "p", "len", F.lit(None).cast("string").alias("gram"))
        hashed = places.where("p > 0").withColumn("h", F.xxhash64(piece)).withColumn("g", F.array_join(piece, " "))
        hits = hashed.join(known.df, (F.col("h") == F.col("gram_hash")) & (F.col("g") == F.col("gram")))
        found = own.unionByName(hits.select("doc_id", "text_key", "n", "p", "len", "gram"))
    hit = F.col("p") > 0
    per_doc = found.groupBy("doc_id", "text_key").agg(
        F.max("n").alias("n"),
        F.count(F.when(~hit, 1)).alias("copies"),
        F.collect_set(F.when(hit, F.struct("p", "len"))).alias("spans"),
        F.collect_set("gram").alias("grams"),
    )
    per_doc = staging.write("per_doc", per_doc)
    items = (
        per_doc.where(F.size("grams") > 0)
        .select("doc_id", "text_key", F.explode("grams").alias("gram"))
        .join(of_items.where("item_id is not null").select("item_id", "gram"), "gram")
        .groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
        .withColumnRenamed("doc_id", "d")
        .withColumnRenamed("text_key", "k")
    )
    joined = per_doc.join(items, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left")
    return joined.select(
        "doc_id",
        "text_key",
        "copies",
        F.col("n").cast("long").alias("n_words"),
        covered(F.col("spans")).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        "spans",
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """`docs` without the documents that hold a benchmark window; all columns and repeated rows of the others stay."""
    found = find_hits(docs, benchmark, doc, text, **options).where("n_hit > 0")
    bad = Staging(docs.sparkSession).write("bad", found.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k")))
    given = docs.select(F.struct("*").alias("_row"))
    d, t = F.col(f"_row.`{doc}`"), F.col(f"_row.`{text}`")
    sized = Sized.of(bad)
    other = F.broadcast(bad) if sized.fits() else bad
    return given.join(other, d.eqNullSafe(F.col("_d")) & (text_key(t) == F.col("_k")), "left_anti").select("_row.*")
