"""File sources and sinks (CSV scan, Parquet scan, gzip Parquet sink)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables; columns are pruned and filters pushed
    into this scan by Catalyst."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """CSV with a header.  Types are inferred when no schema is given (an
    extra pass over the files); pass ``schema`` for production-size inputs."""
    reader = spark.read.option("header", str(header).lower())
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", "true").csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", "true").csv(path)
    return path


def write_parquet_gzip(df: DataFrame, path: str, mode: str = "errorifexists",
                       partition_by: list[str] | None = None) -> str:
    """Parquet with gzip compression.  ``mode`` is explicit: the default fails
    when the path exists instead of silently mixing runs."""
    writer = df.write.mode(mode).option("compression", "gzip")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_through(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write ``df`` as gzip Parquet and go on with the written table, so it is
    computed once."""
    write_parquet_gzip(df, path, mode)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
