"""Writers: full replace, append, empty tables and JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.sources.files import path_exists


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Full replace of the table at `path`; returns a reader of what was written."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def append_table(df: DataFrame, path: str) -> DataFrame:
    """Adds rows to the table at `path`, keeping the rows already there."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)


def ensure_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at `path`, created empty with `schema` when it does not exist yet."""
    if not path_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


def save_as_table(df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 200) -> None:
    """Full replace of a catalog table, bucketed when later joins use one key."""
    writer = df.write.mode("overwrite")
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)


def json_records(df: DataFrame) -> DataFrame:
    """One JSON object per row in column `record`; NaN is written as null."""
    clean = [
        F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(F.to_json(F.struct(*clean), {"ignoreNullFields": "false"}).alias("record"))
