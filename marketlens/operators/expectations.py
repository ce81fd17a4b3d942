"""Declared checks over tables, each giving `(table_name, column_name, check_name, failures)`."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlens.operators.dedup import COPIES, duplicate_keys

# The declared checks of the star schema.
UNIQUE = {
    "dim_customer": "customer_key",
    "dim_product": "product_key",
    "dim_warehouse": "warehouse_key",
    "dim_date": "date_key",
    "fact_orders": "order_key",
    "fact_delivery": "order_key",
}
NOT_NULL = {
    "dim_customer": ["customer_key"],
    "dim_product": ["product_key"],
    "dim_warehouse": ["warehouse_key"],
    "dim_date": ["date_key"],
    "fact_orders": ["order_key", "customer_key", "product_key", "amount"],
    "fact_inventory": ["warehouse_key", "product_key"],
    "fact_delivery": ["order_key"],
    "fact_marketing": ["campaign_id"],
}
RELATIONSHIPS = [
    ("fact_orders", "customer_key", "dim_customer"),
    ("fact_orders", "product_key", "dim_product"),
]


def _results(one_row: DataFrame, table: str, check: str) -> DataFrame:
    """One-row counts as result rows, one per column."""
    entries = ", ".join(
        f"struct('{c}' as column_name, cast(coalesce(`{c}`, 0) as bigint) as failures)" for c in one_row.columns
    )
    return one_row.selectExpr(
        f"'{table}' as table_name", f"inline(array({entries}))", f"'{check}' as check_name"
    ).select("table_name", "column_name", "check_name", "failures")


def expect(df: DataFrame, table: str, check: str, column: str, failing: Column) -> DataFrame:
    """Counts rows for which `failing` holds."""
    return _results(df.agg(F.count_if(failing).alias(column)), table, check)


def expect_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """All columns of a table in one pass."""
    return _results(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]), table, "not_null")


def expect_unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Counts keys that occur more than once; nulls are not keys."""
    repeated = duplicate_keys(df.filter(F.col(column).isNotNull()).select(column), [column])
    return _results(repeated.agg(F.count(COPIES).alias(column)), table, "unique")


def expect_related(df: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Counts rows whose value has no row in `parent`. Values are counted first, so the
    join has one row per value, however often it occurs."""
    return _results(
        orphans(df, column, parent, parent_column).agg(F.sum(COPIES).alias(column)), table, "relationships"
    )


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values of `column` without a row in `parent`, with their number of rows."""
    values = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(COPIES))
    known = parent.select(F.col(parent_column).alias(column))
    return values.join(known, column, "left_anti")


def expect_rows(df: DataFrame, table: str) -> DataFrame:
    """Fails once when the table is empty."""
    return _results(df.agg((F.count(F.lit(1)) == 0).cast("bigint").alias("*")), table, "not_empty")


def expect_count(df: DataFrame, table: str, rows: int) -> DataFrame:
    """Fails by the number of rows that are missing or too many."""
    return _results(df.agg(F.abs(F.count(F.lit(1)) - rows).alias("*")), table, "row_count")


def expect_text(df: DataFrame, table: str, column: str) -> DataFrame:
    """Counts rows whose text is null or blank."""
    return expect(df, table, "not_blank", column, F.coalesce(F.trim(column), F.lit("")) == "")


def expect_in(df: DataFrame, table: str, column: str, allowed: Sequence[str]) -> DataFrame:
    """Counts rows whose value is outside the allowed set."""
    return expect(df, table, "accepted_values", column, ~F.col(column).isin(list(allowed)))


def expect_at_least(df: DataFrame, table: str, column: str, bound: float, strict: bool = False) -> DataFrame:
    failing = F.col(column) <= bound if strict else F.col(column) < bound
    return expect(df, table, "greater_than" if strict else "at_least", column, failing)


def expect_ordered(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Counts rows whose values are not ascending from the first column to the last."""
    pairs = [F.col(a) > F.col(b) for a, b in zip(columns, columns[1:])]
    return expect(df, table, "ordered", columns[0], reduce(Column.__or__, pairs))


def expect_present(df: DataFrame, table: str, column: str, required: Sequence[str]) -> DataFrame:
    """Counts required values that do not occur."""
    seen = df.agg(*[F.count_if(F.col(column) == v).alias(v) for v in required])
    missing = reduce(Column.__add__, [(F.col(f"`{v}`") == 0).cast("bigint") for v in required])
    return _results(seen.select(missing.alias(column)), table, "required_values")


def schema_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The declared checks of the star schema over the given tables."""
    parts = [expect_not_null(tables[t], t, cs) for t, cs in NOT_NULL.items()]
    return reduce(DataFrame.unionByName, [*_key_checks(tables), *parts])


def _key_checks(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Checks that need keys side by side: repeated ones, and ones without a parent."""
    parts = [expect_unique(tables[t], t, c) for t, c in UNIQUE.items()]
    return parts + [expect_related(tables[t], t, c, tables[p], c) for t, c, p in RELATIONSHIPS]


class Watch:
    """Checks of single rows, counted while a table is written: no scan of their own."""

    def __init__(self, table: str, columns: Sequence[str]):
        self.table, self.columns, self.seen = table, list(columns), Observation(f"checks of {table}")

    def over(self, df: DataFrame) -> DataFrame:
        """`df`, to be written once."""
        return df.observe(self.seen, F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in self.columns])

    def results(self, spark: SparkSession) -> DataFrame:
        """Result rows; waits for the table to be written."""
        counts = self.seen.get
        rows = [(self.table, c, "not_null", int(counts.get(c) or 0)) for c in self.columns]
        return spark.createDataFrame(rows, "table_name string, column_name string, check_name string, failures bigint")


def store_checked(
    tables: Mapping[str, DataFrame], store: Callable[[str, DataFrame], DataFrame]
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Stores every table and applies the declared checks of the star schema.

    `store` writes a table once and gives what a reader of it sees. Nulls are counted by
    that write; repeated and orphaned keys are then read from the key columns of what was
    stored, so a table is computed once whatever the number of its checks.
    """
    kept, parts = {}, []
    for name, df in tables.items():
        watch = Watch(name, NOT_NULL.get(name, []))
        kept[name] = store(name, watch.over(df))
        parts.append(watch.results(df.sparkSession))
    return kept, reduce(DataFrame.unionByName, [*parts, *_key_checks(kept)])
