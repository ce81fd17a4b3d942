"""Mixing sources to target weights.

Tokens are counted per source, each source's share by weight becomes a repetition rate, and
every document is taken floor(rate) times, plus once more with the fraction's probability,
drawn from a hash of a seed and the document's id. All in DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.naming import unused
from marketlens.llm.sizes import small_side

WORD = r"[^\x20\x09-\x0D]+"
MOST_REPEATS = 3
SEED = "mix-1"
# a source name, two numbers; beyond this the join shuffles
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Words of a text, 0 for a null one."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycling_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """`sources(source)` with weights 1, 2, ... `cycle`, 1, ... by code point, null last."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    return sources.withColumn("weight", ((F.row_number().over(order) - 1) % cycle + 1).cast("long"))


def targets(weighted: DataFrame, most: int = MOST_REPEATS) -> DataFrame:
    """`weighted(source, source_size, weight)` with `target`: the share of all sizes by
    weight, no more than `most` times the source's size, what is cut off reshared by weight.

    Sources cut off are those with the least size per weight, so one pass in this order
    finds the level at which the rest share. One row per source.
    """
    ratio = F.col("source_size") / F.col("weight")
    everything = Window.partitionBy()
    before = Window.orderBy(ratio, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    open_here = F.col("left") * F.col("weight") <= most * F.col("source_size") * F.col("weights")
    levels = weighted.withColumns({"left": left, "weights": weights})
    level = F.min(F.when(open_here, F.struct(ratio.alias("r"), F.col("source").isNull(), "source", (F.col("left").cast("double") / F.col("weights")).alias("level"))))
    capped = (most * F.col("source_size")).cast("double")
    return (
        levels.withColumn("level", level.over(everything)["level"])
        .withColumn("target", F.coalesce(F.least(capped, F.col("level") * F.col("weight")), capped))
        .select("source", "source_size", "weight", "target")
    )


def copies(rate: Column, document: Column, seed: str = SEED) -> Column:
    """floor(rate), plus one with the fraction's probability; the same for the same id."""
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(document.cast("string"), F.lit("")))), 1, 13), 16, 10)
    whole = F.floor(rate)
    return (whole + (draw.cast("double") / F.lit(float(2**52)) < rate - whole).cast("long")).cast("long")


def mixed_counts(docs: DataFrame, cycle: int = 3, most: int = MOST_REPEATS, seed: str = SEED) -> DataFrame:
    """`docs` with size, source_size, target (the source's) and copies.

    Null texts and texts without words have size 0; documents of a source without words are
    taken as often as the rate 0 says, never. A null source is a source. Repeated rows are
    counted each and drawn alike. Columns of these names in `docs` are replaced.
    """
    docs = docs.drop("size", "source_size", "target", "copies").withColumn("size", word_count(F.col("text")))
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    other = unused(docs, "_source")
    rates = targets(cycling_weights(sizes, cycle), most).select(F.col("source").alias(other), "source_size", "target")
    joined = docs.join(small_side(rates, BROADCAST_SOURCES, "rates"), F.col("source").eqNullSafe(F.col(other))).drop(other)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return joined.withColumn("copies", copies(rate, F.col("doc_id"), seed))


def mix(docs: DataFrame, cycle: int = 3, most: int = MOST_REPEATS, seed: str = SEED) -> DataFrame:
    """`docs` in the mixture: each row as often as it is taken. See `mixed_counts`."""
    packed = docs.select("doc_id", "text", "source", F.struct("*").alias("row"))
    counted = mixed_counts(packed, cycle, most, seed).where("copies > 0")
    return counted.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
