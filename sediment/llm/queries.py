"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm import alignment, decontaminate, html_text, licenses, line_dedup, mixing, phrases, pieces, quality, secrets, simhash, token_counts, toxicity

# Folder of public tokenizers' vocabulary files.
TOKENIZERS = "/opt/tokenizers"

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents"))


def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract_text(table(spark, folder, "pages"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return quality.judge(docs, drop_text=True).select("doc.doc_id", *quality.COUNTS, "base_failed", "kept")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, folder, "documents"))
    spans, kinds = F.col("spans"), F.array(*map(F.lit, secrets.KINDS))
    base = F.filter(spans, lambda s: s.kind < len(secrets.BASE))

    def joined(some: Column) -> Column:
        return F.array_join(F.transform(some, lambda s: F.concat_ws(":", F.get(kinds, s.kind), s.start, s.end)), ",")

    def number(kind: int) -> Column:
        return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("long")

    return found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        "doc_id",
        *(number(i).alias(f"n_{kind}") for i, kind in enumerate(secrets.BASE)),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: s.live)).cast("long").alias("n_live"),
    )


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_lines", "n_removed", "text")


def op9_token_counts(spark: SparkSession, folder: str, model: str | None = None) -> DataFrame:
    vocabulary = token_counts.Vocabulary.from_sentencepiece(model or f"{TOKENIZERS}/piece_bpe_32k.model")
    return token_counts.count_tokens(table(spark, folder, "documents"), vocabulary)


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op11_sentencepiece(spark: SparkSession, folder: str, model: str | None = None) -> DataFrame:
    model_bytes = pieces.read_model(model or f"{TOKENIZERS}/piece_bpe_32k.model")
    found = pieces.encode_texts(table(spark, folder, "documents"), model_bytes, keep=["doc_id"], decode=True)
    return found.select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


def op13_alignment(spark: SparkSession, folder: str, tokenizer: str | None = None, model: str | None = None) -> DataFrame:
    tokenizer, model = tokenizer or f"{TOKENIZERS}/byte_bpe_50k.json", model or f"{TOKENIZERS}/piece_bpe_32k.model"
    found = alignment.align_corpus(table(spark, folder, "documents"), tokenizer, model, ["doc_id"])
    return found.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def queries() -> dict[str, Query]:
    registered = (
        op1_decontamination,
        op2_license_scan,
        op3_html_extraction,
        op4_quality_rules,
        op5_toxicity,
        op6_simhash,
        op7_secret_scan,
        op8_line_dedup,
        op9_token_counts,
        op10_mixing,
        op11_sentencepiece,
        op12_collocations,
        op13_alignment,
    )
    return {f.__name__: f for f in registered}
