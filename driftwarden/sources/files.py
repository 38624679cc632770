"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


def read_csv_union(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """Several CSV files with headers as one table; the schema is given, never inferred."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(list(paths))


def sql_source(spark: SparkSession, sql: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Rows of a SQL text over the catalog and the given frames."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)


def connector_source(spark: SparkSession, format: str, **options: str) -> DataFrame:
    """A warehouse or JDBC table through any data source on the class path."""
    return spark.read.format(format).options(**options).load()


def read_limited(df: DataFrame, n: int = 50_000, order: Sequence[str] = ()) -> DataFrame:
    """At most ``n`` rows; with an order the choice is repeatable."""
    return (df.orderBy(*order) if order else df).limit(n)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)
