"""Chat formatting by a grammar that is read back.

    conversation = level turn*          level = "0" | "1"
    turn         = "<s>[INST]" role "[/INST]" text "</s>"

A role or text holds none of the control strings `<s>`, `</s>`, `[INST]` and `[/INST]`: what
stands between the marks of a turn and holds one is no content, and parses as null. Rendering
is tried as it is (level 0), parsed again and compared with the source. Where a role or text
holds a control string, the recovered turns differ; such a conversation is rendered again with
its contents escaped (level 1), which no content can upset: `&`, `<` and `[` become `&amp;`,
`&lt;` and `&lb;`. So no control string of a text ever stands in the formatted text. All in
DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"))


def escaped(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescaped(text: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def render(turns: Column, level: int) -> Column:
    """The formatted text of an array of (role, text)."""
    clean = escaped if level else (lambda c: c)
    one = F.transform(
        turns, lambda t: F.concat(F.lit(OPEN), clean(t["role"]), F.lit(MIDDLE), clean(t["text"]), F.lit(CLOSE))
    )
    return F.concat(F.lit(str(level)), F.array_join(one, ""))


def parse(formatted: Column) -> Column:
    """The turns of a formatted text, as (role, text, raw, start, length): raw is the text as
    it stands in the formatted text, from code point `start` (from 0) on.

    Deterministic: a turn ends at the first closing mark, its role at the first middle mark.
    Roles and texts that hold a control string are null.
    """
    pieces = F.split(F.substr(formatted, F.lit(2)), r"\Q" + CLOSE + r"\E", -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    coded = F.startswith(formatted, F.lit("1"))

    def turn(piece: Column) -> Column:
        at = F.locate(MIDDLE, piece)
        role = F.substr(piece, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)
        raw = F.substr(piece, at + len(MIDDLE))
        return F.struct(
            _content(role, coded).alias("role"),
            _content(raw, coded).alias("text"),
            raw.alias("raw"),
            F.length(piece).alias("size"),
            F.length(raw).alias("length"),
        )

    return F.transform(pieces, turn)


def _content(raw: Column, coded: Column) -> Column:
    stray = F.lit(False)
    for mark in CONTROLS:
        stray = stray | F.contains(raw, F.lit(mark))
    return F.when(~stray, F.when(coded, unescaped(raw)).otherwise(raw))


def loss_spans(parsed: Column, role: str = "assistant") -> Column:
    """(start, length) of every text of `role` in the formatted text, in code points."""
    step = F.aggregate(
        parsed,
        F.struct(F.lit(1).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:int>>").alias("spans")),
        lambda seen, t: F.struct(
            (seen["at"] + t["size"] + len(CLOSE)).alias("at"),
            F.when(
                t["role"] == role,
                F.concat(
                    seen["spans"],
                    F.array(F.struct((seen["at"] + t["size"] - t["length"]).alias("start"), t["length"].alias("length"))),
                ),
            )
            .otherwise(seen["spans"])
            .alias("spans"),
        ),
        lambda seen: seen["spans"],
    )
    return step


def format_conversations(rows: DataFrame) -> DataFrame:
    """Per conversation: conv_id, formatted, and parsed (what `parse` recovers from it).

    `rows(conv_id, turn, role, text)` in any order; turns are sorted by turn (null last),
    equal ones by role and text, repeated rows stay. Null roles and texts count as empty; a
    null conv_id is a conversation. Other columns are not used, an empty table gives no rows.
    A conversation that could not be recovered even when escaped would stop the job.
    """
    turn = F.struct(
        F.col("turn").isNull().alias("last"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    plain = turns.withColumn("formatted", render(F.col("turns"), 0))
    same = _recovered(F.col("formatted"), F.col("turns"))
    second = plain.withColumn("formatted", F.when(same, F.col("formatted")).otherwise(render(F.col("turns"), 1)))
    checked = F.when(
        F.startswith("formatted", F.lit("0")) | _recovered(F.col("formatted"), F.col("turns")), F.col("formatted")
    ).otherwise(F.raise_error(F.lit("a conversation is not recovered from its formatted text")).cast("string"))
    return second.select("conv_id", checked.alias("formatted")).withColumn("parsed", parse(F.col("formatted")))


def _recovered(formatted: Column, turns: Column) -> Column:
    pair = lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
    return F.transform(parse(formatted), pair).eqNullSafe(F.transform(turns, pair))


def digests(formatted: DataFrame, role: str = "assistant") -> DataFrame:
    """Per conversation what is read back from `format_conversations`: n_turns, turns_sha256,
    loss_chars, loss_sha256 (what the formatted text holds under the spans of `role`),
    formatted_chars."""
    parsed = F.col("parsed")
    listed = F.array_join(F.transform(parsed, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    under = F.transform(loss_spans(parsed, role), lambda s: F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"]))
    said = F.when(F.startswith("formatted", F.lit("1")), F.transform(under, unescaped)).otherwise(under)
    loss = F.array_join(said, "")
    return formatted.select(
        "conv_id",
        F.size(parsed).cast("long").alias("n_turns"),
        F.sha2(listed, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
