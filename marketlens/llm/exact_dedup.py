"""Exact duplicates by 128-bit content hash, with bytes compared inside groups.

Only digests of the texts are grouped (16 bytes a row). Texts of rows whose digest occurs
again are read a second time and made distinct by digest and bytes, so that of a group of
copies one text per map task is moved; digests that stand for more than one text, if there
are any, are split by the text itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.sizes import small_side
from marketlens.session import stored

# the characters that do not count: 0x20 and 0x09-0x0D
BLANKS = " \t\n\x0b\x0c\r"
# groups of copies, some 100 bytes each; beyond this their join shuffles
BROADCAST_GROUPS = 100_000


def md5_128(text: Column) -> Column:
    """16 bytes that stand for a text."""
    return F.unhex(F.md5(text))


def normalised(text: Column) -> Column:
    """A text without blanks, null as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def _keyed(docs: DataFrame, id_col: str, text_col: str, digest: Callable, split: DataFrame | None) -> DataFrame:
    """`row` (all columns), id, text, norm, key, and variant: the normalised text where the
    key is one of `split`, which stand for several texts, else empty."""
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(text_col, F.lit("")).alias("text"),
        normalised(F.col(text_col)).alias("norm"),
    ).withColumn("key", digest(F.col("norm")))
    if split is None:
        return rows.withColumn("variant", F.lit(""))
    marked = rows.join(small_side(split.withColumn("several", F.lit(True)), BROADCAST_GROUPS, "split"), "key", "left")
    return marked.withColumn("variant", F.when(F.col("several"), F.col("norm")).otherwise("")).drop("several")


def _digests(docs: DataFrame, id_col: str, text_col: str, digest: Callable, split: DataFrame | None) -> DataFrame:
    """A short row per document, stored; `place` tells rows apart that are equal throughout."""
    rows = _keyed(docs, id_col, text_col, digest, split).select(
        "id", "key", "variant", F.char_length("text").cast("long").alias("chars"), F.sha2("norm", 256).alias("sha"),
        F.monotonically_increasing_id().alias("place"),
    )
    return stored(rows, "digests")


def _groups(rows: DataFrame) -> DataFrame:
    """Groups of two and more: how many, and the row that stays."""
    order = F.struct((-F.col("chars")).alias("chars"), F.isnull("id").alias("unknown"), "id", "place")
    found = rows.groupBy("key", "variant").agg(F.count(F.lit(1)).alias("size"), F.min(order).alias("best"))
    return stored(found.where("size > 1").select("key", "variant", "size", "best.id", "best.place"), "copies")


def several_texts(docs: DataFrame, copied: DataFrame, text_col: str = "text", digest: Callable = md5_128) -> DataFrame:
    """Of the keys in `copied`, those that stand for more than one normalised text."""
    texts = docs.select(normalised(F.col(text_col)).alias("norm")).withColumn("key", digest(F.col("norm")))
    texts = texts.join(small_side(copied, BROADCAST_GROUPS, "copied"), "key", "left_semi").distinct()
    return stored(texts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "several")


def _resolved(docs: DataFrame, id_col: str, text_col: str, digest: Callable) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    rows = _digests(docs, id_col, text_col, digest, None)
    groups = _groups(rows)
    split = several_texts(docs, groups.select("key"), text_col, digest)
    if not split.limit(1).count():
        return rows, groups, None
    rows = _digests(docs, id_col, text_col, digest, split)
    return rows, _groups(rows), split


def exact_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable = md5_128
) -> DataFrame:
    """Per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after every blank is deleted; null counts as empty, and
    all empty texts are equal. Of equal texts the row with most code points stays, then that
    of least id (null last); rows equal in that too keep one of them, whose `kept` is true.
    An empty table gives no rows; other columns are not used. `digest` makes the content
    hash; texts that share one by chance are told apart by their bytes.
    """
    rows, groups, _ = _resolved(docs, id_col, text_col, digest)
    best = groups.select("key", "variant", "size", F.col("id").alias("best_id"), F.col("place").alias("best_place"))
    joined = rows.join(small_side(best, BROADCAST_GROUPS, "best"), ["key", "variant"], "left")
    return joined.select(
        F.col("id").alias("doc_id"),
        F.when(F.isnull("size"), F.col("id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.isnull("size") | (F.col("place") == F.col("best_place"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable = md5_128
) -> DataFrame:
    """The rows of `docs` that stay, with all their columns and by the rules of
    `exact_classes`. Ranks are cut in every map task before the shuffle, so that a group
    sends one row a task."""
    _, _, split = _resolved(docs, id_col, text_col, digest)
    keyed = _keyed(docs, id_col, text_col, digest, split)
    best_first = [F.char_length("text").desc(), F.col("id").asc_nulls_last(), F.col("text").asc()]
    ranked = keyed.withColumn("rank", F.row_number().over(Window.partitionBy("key", "variant").orderBy(*best_first)))
    return ranked.where("rank = 1").select("row.*")
