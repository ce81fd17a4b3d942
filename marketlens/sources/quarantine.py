"""Values of the source files that cannot be read as what their column declares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators import staging
from marketlens.sources.files import ARRIVAL
from marketlens.sources.sinks import replace_table


class UnreadableSource(ValueError):
    """A strict run met values that are there but cannot be read."""


def unreadable_values(source: str, raw: DataFrame) -> DataFrame:
    """A row per value of `raw` that is there and does not cast: source, key (the business
    key's first column), column_name, declared_type, value and, where the rows know their
    place, file, block and row.

    Null and empty cells are no values. Columns that are not text were read already. The rows
    are read once, whatever the number of columns.
    """
    types, kinds = staging.TYPES[source], dict(raw.dtypes)
    checks = [
        F.when(
            F.col(c).isNotNull() & (F.trim(c) != "") & F.col(c).try_cast(t).isNull(),
            F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("declared_type"), F.col(c).alias("value")),
        )
        for c, t in types.items()
        if kinds.get(c) == "string"
    ]
    place = [F.col(f"{ARRIVAL}.{p}").alias(p) for p in ("file", "block", "row")] if ARRIVAL in raw.columns else []
    key = F.col(staging.KEYS[source]).cast("string").alias("key")
    if not checks:
        nothing = F.expr("inline(cast(array() as array<struct<column_name:string,declared_type:string,value:string>>))")
        return raw.select(F.lit(source).alias("source"), key, nothing, *place)
    found = F.inline(F.array_compact(F.array(*checks)))
    return raw.select(F.lit(source).alias("source"), key, found, *place)


def stage_strictly(source: str, raw: DataFrame, path: str) -> DataFrame:
    """The staged source, if all its values can be read.

    What cannot is stored at `path`, with file and place, before anything else; if that is
    not empty, `UnreadableSource` says how much it is and where, with examples.
    """
    stored = replace_table(unreadable_values(source, raw), path)
    examples = stored.limit(3).collect()
    if examples:
        shown = ", ".join(f"{r['column_name']} {r['value']!r} of {r['key']}" for r in examples)
        raise UnreadableSource(f"{source}: {stored.count()} values cannot be read, such as {shown}; all are in {path}")
    return getattr(staging, f"stg_{source}")(raw, strict=True)
