"""Names of columns that a job adds beside its user's."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(docs: DataFrame, name: str) -> str:
    """`name`, with as many underscores behind it as make it none of the columns of `docs`."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name
