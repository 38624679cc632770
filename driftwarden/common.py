"""Helpers used by every operator family: durable cuts, output shaping."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A folder of our own is made only in local mode and only when nothing is
    set; on a cluster a missing setting is an error, since a machine-local
    path would not survive the loss of an executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if configured:
        if not current:
            context.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the executors")
    folder = tempfile.mkdtemp(prefix="driftwarden-")
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for one written intermediate table."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back."""
    path = scratch_path(df.sparkSession, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *jobs: Callable[[], Any]) -> list:
    """Results of independent jobs that are handed to Spark at once: short stages of one fill what another leaves idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [r.result() for r in running]


def swept(spark: SparkSession) -> None:
    """Have Spark remove the shuffles that nothing refers to any more: it does so only when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto ``schema``: declared order and types, absent columns as NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def melt(df: DataFrame, ids: list[str], values: list[str], name: str = "metric", value: str = "value") -> DataFrame:
    """Wide to long; every value column is read as double so that types agree."""
    cast = df.select(*[F.col(f"`{c}`") for c in ids], *[F.col(f"`{c}`").cast("double").alias(c) for c in values])
    return cast.unpivot(ids, values, name, value)


def melt_text(df: DataFrame, ids: list[str], values: list[str], name: str = "feature", value: str = "value") -> DataFrame:
    """Wide to long with the values as strings."""
    cast = df.select(*[F.col(f"`{c}`") for c in ids], *[F.col(f"`{c}`").cast("string").alias(c) for c in values])
    return cast.unpivot(ids, values, name, value)
