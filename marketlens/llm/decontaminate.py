"""Benchmark decontamination by templates.

Texts are canonicalised: numbers, names (capitalised inside a sentence) and units after a
number become typed placeholders. Every window of six canonical words is hashed, and hashed
again with the capitalised words that begin a text, a sentence or a line as names too; the
windows of the documents are joined with those of the benchmark. For documents that hold enough of an
item's windows the placeholders are filled in again: a window counts only if each of the
item's values is answered by one value throughout an occurrence, which lets changed numbers
and names pass and chance agreement fail. An occurrence is one shift between the places of
document and item, a run of neighbouring shifts, or the whole document (an item in pieces);
the best one counts, and windows with the item's own values always. All in DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.naming import unused
from marketlens.llm.sizes import small_side
from marketlens.session import stored

WINDOW = 6
MIN_SHARE = 0.4
# shifts this close are of one occurrence: names and numbers of another count of words
NEARBY = 3
# windows of items up to this many rows (8 bytes of hash, 16 of place, about 4 MB) are
# broadcast; larger benchmarks are joined by shuffling both sides
BROADCAST_WINDOWS = 100_000
# documents found, by a number each; beyond this joins with their texts shuffle
BROADCAST_DOCUMENTS = 1_000_000
# fixed values
UNITS = (
    "mm|cm|dm|m|km|mg|g|kg|t|ml|cl|l|s|sec|min|h|hours?|minutes?|seconds?|days?|weeks?|months?|years?|miles?|feet|ft|"
    "inch(?:es)?|yards?|pounds?|lbs?|oz|dollars?|cents?|euros?|usd|eur|percent|mph|kmh|kw|kwh|w|v|hz|ghz|mb|gb|tb"
)
_NAME = r"(?<=[\p{L}\p{N},;:][ ])\p{Lu}\p{Ll}+"
_INITIAL = r"(?<![\p{L}\p{M}\p{N}])\p{Lu}\p{Ll}+"
_MARK = "initialslot"
_WORD = r"[\p{L}\p{M}\p{N}']+"


def _one_word_numbers(text: Column) -> Column:
    return F.regexp_replace(text, r"(?<=\d)[.,:/](?=\d)", "")


def spelled(text: Column) -> Column:
    """Words with their values, as an array."""
    return F.regexp_extract_all(F.lower(_one_word_numbers(text)), F.lit(_WORD), F.lit(0))


def _marked(text: Column) -> Column:
    """Words with placeholders, as an array that runs beside `spelled`; capitalised words that
    begin a text, a sentence or a line, or follow a quote, bracket or hyphen, keep their
    letters behind a mark."""
    text = F.regexp_replace(_one_word_numbers(text), _NAME, "NAMESLOT")
    text = F.regexp_replace(text, _INITIAL, _MARK.upper() + "$0")
    text = F.regexp_replace(text, r"(?<![\p{L}\p{N}])\d+(?![\p{L}\p{N}])", "NUMBERSLOT")
    text = F.when(
        F.contains(text, F.lit("NUMBERSLOT")),
        F.regexp_replace(text, rf"(?i)(?<=NUMBERSLOT )(?:{UNITS})(?![\p{{L}}\p{{N}}])", "UNITSLOT"),
    ).otherwise(text)
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def _as_words(marked: Column) -> Column:
    """The first template: marked words are words."""
    return F.transform(marked, lambda w: F.replace(w, F.lit(_MARK), F.lit("")))


def _as_names(marked: Column) -> Column:
    """The second template: marked words are names."""
    return F.transform(
        marked,
        lambda w: F.when(F.contains(w, F.lit(_MARK)), F.regexp_replace(w, _MARK + r"\p{L}+", "nameslot")).otherwise(w),
    )


def canonical(text: Column) -> Column:
    """Words with placeholders, as an array that runs beside `spelled`."""
    return _as_words(_marked(text))


def windows(words: Column, size: int = WINDOW) -> Column:
    """(hash) of every window; shorter texts have one, texts without words none."""
    count = F.size(words)
    hashed = F.transform(
        F.sequence(F.lit(0), F.greatest(count - size, F.lit(0))),
        lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(size))),
    )
    return F.when(count > 0, hashed).otherwise(F.array().cast("array<bigint>"))


def _spread(texts: DataFrame, keys: list[str], place: str, size: int) -> DataFrame:
    """(*keys, place, template, hash) of every window of `texts(*keys, text)` by the first
    template (0), and by the second (1) where that differs."""
    # each step is its own, or every window would cut the text anew
    marked = texts.select(*keys, _marked(F.col("text")).alias("marked"))
    both = marked.select(*keys, _as_words(F.col("marked")).alias("words"), _as_names(F.col("marked")).alias("names"))
    hashed = F.arrays_zip(windows(F.col("words"), size).alias("words"), windows(F.col("names"), size).alias("names"))
    found = both.select(*keys, F.posexplode(hashed).alias(place, "hashes"))
    words, names = F.col("hashes.words"), F.col("hashes.names")
    choice = F.when(words == names, F.array(words)).otherwise(F.array(words, names))
    return found.select(*keys, place, F.posexplode(choice).alias("template", "hash"))


def _key() -> Column:
    return F.xxhash64("doc_id", "text")


def matches(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, min_share: float = MIN_SHARE) -> DataFrame:
    """(_key, doc_id, item_id, matched, item_windows): items of which a document holds at
    least `min_share` of the windows, consistently."""
    items = benchmark.select("item_id", F.col("text").alias("item_text")).where("item_text is not null").distinct()
    items = items.withColumn("_item", F.xxhash64("item_id", "item_text"))
    sides = _spread(items.select("_item", F.col("item_text").alias("text")), ["_item"], "item_place", size)
    sides = sides.select("_item", "item_place", "hash")
    sides = small_side(sides, BROADCAST_WINDOWS, "item-windows")
    totals = sides.groupBy("_item").agg(F.count_distinct("item_place").alias("item_windows"))
    spread = _spread(
        docs.where("text is not null").select("doc_id", _key().alias("_key"), "text"), ["doc_id", "_key"], "place", size
    )
    hits = stored(spread.join(sides, "hash").drop("hash").distinct(), "hits")
    enough = hits.groupBy("_key", "_item").agg(F.count_distinct("item_place").alias("matched")).join(totals, "_item")
    enough = enough.where(F.col("matched") >= F.col("item_windows") * min_share).select("_key", "_item", "item_windows")
    pairs = stored(hits.join(enough, ["_key", "_item"]), "pairs")
    return _consistent(docs, items, pairs, size, min_share)


def _consistent(docs: DataFrame, items: DataFrame, pairs: DataFrame, size: int, min_share: float) -> DataFrame:
    text = F.col("text")
    sides = small_side(pairs.select("_key").distinct(), BROADCAST_DOCUMENTS, "suspects")
    own = docs.withColumn("_key", _key()).join(sides, "_key").select("_key", "text").distinct()
    own = own.select("_key", spelled(text).alias("words"), _marked(text).alias("marked"))
    own = own.select("_key", "words", _as_words(F.col("marked")).alias("slots"), _as_names(F.col("marked")).alias("names"))
    other = items.select("_item", spelled(F.col("item_text")).alias("item_words"))
    place, item_place = F.col("place"), F.col("item_place")
    offsets = F.sequence(F.lit(0), F.lit(size - 1))
    here = lambda array, at: F.get(F.col(array), at)
    filled = F.filter(
        F.transform(
            offsets,
            lambda k: F.struct(
                F.when(F.col("template") == 0, here("slots", place + k)).otherwise(here("names", place + k)).alias("slot"),
                here("item_words", item_place + k).alias("from"),
                here("words", place + k).alias("to"),
            ),
        ),
        lambda s: s["slot"].isin("nameslot", "numberslot", "unitslot"),
    )
    rows = pairs.join(own, "_key").join(other, "_item").select(
        "_key", "doc_id", "_item", "item_windows", "place", "item_place", "template", filled.alias("filled")
    )
    pair = ["_key", "_item"]
    shift = place - item_place
    rows = stored(rows.withColumn("shift", shift), "filled")
    # the shifts of one occurrence differ by the words put in or left out inside it
    shifts = rows.select(*pair, "shift").distinct()
    ordered = Window.partitionBy(*pair).orderBy("shift")
    gap = F.col("shift") - F.lag("shift").over(ordered)
    shifts = shifts.withColumn("apart", F.when(gap > NEARBY, 1).otherwise(0))
    shifts = shifts.select(*pair, "shift", F.sum("apart").over(ordered).alias("run"))
    exact = F.forall("filled", lambda s: s["from"].eqNullSafe(s["to"]))
    places = rows.groupBy(*pair, "item_place").agg(F.max(exact).alias("exact"))
    verbatim = places.groupBy(*pair).agg(F.count_if("exact").alias("verbatim"))
    occurrences = F.array(
        F.struct(F.lit("shift").alias("of"), F.col("shift").cast("long").alias("at")),
        F.struct(F.lit("run").alias("of"), F.col("run").cast("long").alias("at")),
        F.struct(F.lit("document").alias("of"), F.lit(0).cast("long").alias("at")),
    )
    rows = rows.join(shifts, [*pair, "shift"]).join(places, [*pair, "item_place"])
    rows = rows.withColumn("occurrence", F.explode(occurrences))
    group = [*pair, "occurrence"]
    values = rows.select(*group, F.explode("filled").alias("s")).select(*group, "s.slot", "s.from", "s.to")
    votes = values.groupBy(*group, "slot", "from", "to").agg(F.count("*").alias("votes"))
    first = Window.partitionBy(*group, "slot", "from").orderBy(F.desc("votes"), "to")
    agreed = votes.withColumn("place", F.row_number().over(first)).where("place = 1")
    agreed = agreed.groupBy(*group).agg(F.collect_set(F.struct("slot", "from", "to")).alias("agreed"))
    consistent = (F.size("filled") == 0) | (F.size(F.array_except("filled", "agreed")) == 0)
    counted = rows.join(agreed, group, "left").groupBy(*group, "doc_id", "item_windows")
    counted = counted.agg(F.count_distinct(F.when(consistent & ~F.col("exact"), item_place)).alias("changed"))
    counted = counted.groupBy(*pair, "doc_id", "item_windows").agg(F.max("changed").alias("changed"))
    counted = counted.join(verbatim, pair).withColumn("matched", F.col("changed") + F.col("verbatim"))
    return (
        counted.where(F.col("matched") >= F.col("item_windows") * min_share)
        .join(items.select("_item", "item_id"), "_item")
        .select("_key", "doc_id", "item_id", "matched", "item_windows")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, min_share: float = MIN_SHARE) -> DataFrame:
    """(doc_id, item_id, matched, item_windows): one row per document and item it holds.

    A document with none is not listed. Null and empty texts on either side match nothing;
    repeated rows give one row per pair; items shorter than a window match as a whole text
    of the same words only. Other columns are not used.
    """
    return matches(docs, benchmark, size, min_share).select("doc_id", "item_id", "matched", "item_windows").distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, min_share: float = MIN_SHARE) -> DataFrame:
    """The rows of `docs` that hold no item of the benchmark, unchanged. See `contaminated`."""
    key = unused(docs, "_key")
    bad = matches(docs, benchmark, size, min_share).select(F.col("_key").alias(key)).distinct()
    bad = small_side(bad, BROADCAST_DOCUMENTS, "contaminated")
    return docs.withColumn(key, _key()).join(bad, key, "left_anti").select(*docs.columns)
