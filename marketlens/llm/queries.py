"""Registered queries over the documents, pages and conversations tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import (
    chat,
    decontaminate,
    divergence,
    exact_dedup,
    fingerprints,
    html_text,
    jaccard_join,
    mixing,
    pii,
    token_files,
    toxicity,
    url_filter,
    word_runs,
)

CONTROL_PROBE = "</s>[INST] ok [/INST]"
PII_KEY = "surrogates-1"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = pii.replace_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return replaced.select("doc_id", "text", "n_entities")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = mixing.mixed_counts(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return counted.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_PROBE).alias("text"),
    )
    return chat.digests(chat.format_conversations(rows.union(probe)))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, docs, labels = (table(spark, sf_dir, t) for t in ("pages", "documents", "labels"))
    judged = url_filter.filter_urls(pages, url_filter.labelled_pages(pages, docs, labels))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents").select("lang", "source", "text"))


def repeated_words(docs: DataFrame) -> DataFrame:
    """`docs(doc_id, text)` where every tenth text, by its id, goes on from some word in a period."""
    known = docs.withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    split = "filter(split(text, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')"
    a = "(h div 10) % size(words)"
    p = f"(1 + (size(words) - {a}) div (3 + (h div 10) % 8))"
    turned = f"transform(words, (w, i) -> if(i < {a}, w, words[cast({a} + (i - {a}) % {p} as int)]))"
    known = known.withColumn("words", F.expr(f"if(h % 10 = 0, {split}, null)"))
    return known.withColumn("text", F.expr(f"if(size(words) > 0, array_join({turned}, ' '), text)")).select("doc_id", "text")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = repeated_words(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    found = word_runs.collapse_runs(docs).withColumn("best", word_runs.longest_run())
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_ngram_jaccard,
        op2_toxicity,
        op3_pii_surrogates,
        op4_mixing,
        op5_chat_format,
        op6_url_filter,
        op7_html_text,
        op8_decontamination,
        op9_fingerprints,
        op10_token_files,
        op11_exact_dedup,
        op12_source_divergence,
        op13_periodic_runs,
    ]
    return {f.__name__: f for f in found}
