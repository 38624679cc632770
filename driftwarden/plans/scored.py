"""The scored frame: training and production rows with labels, probabilities, bands."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwarden.common import written
from driftwarden.functions.scalars import argmax_label, equal_width_bands
from driftwarden.operators.columns import class_indicators, project_scored, tag_sets
from driftwarden.spec import ModelSpec

ORDERS_SPEC = ModelSpec(
    id_features=("row_id", "entity_id", "periodo"),
    cat_features=("o_orderpriority", "c_mktsegment"),
    cont_features=("o_totalprice", "c_acctbal"),
    sub_cols=("p0", "p1", "p2"),
    obs_features=("entity_id",),
    name_project="orders",
    name_subproject="status",
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def probability_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer, a class code, and integer-weight probabilities."""
    orders, customer = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    base = orders.join(customer, orders.o_custkey == customer.c_custkey)
    target = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    key, cust = F.col("o_orderkey"), F.col("o_custkey")

    def weight(code: int, a: int, b: int, modulus: int):
        return 1 + (a * key + b * cust) % modulus + F.when(F.col("target") == code, 40).otherwise(0)

    weighted = base.withColumn("target", target).withColumns(
        {"w0": weight(0, 7, 3, 97), "w1": weight(1, 11, 5, 89), "w2": weight(2, 13, 17, 83)}
    )
    total = F.col("w0") + F.col("w1") + F.col("w2")
    return weighted.select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_custkey").alias("entity_id"),
        F.trunc("o_orderdate", "MM").alias("periodo"),
        F.col("o_orderdate"),
        F.col("c_mktsegment").alias("segment"),
        F.col("o_totalprice").alias("kpi"),
        "target",
        *[(F.col(f"w{i}") / total).alias(f"p{i}") for i in range(3)],
        "o_orderpriority",
        "c_mktsegment",
        "o_totalprice",
        "c_acctbal",
    )


def scored_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with the set it belongs to, its label and its score bands."""
    rows = probability_frame(spark, sf_dir)
    training = F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")
    rows = rows.withColumn("set_analysis", F.when(training, "training").otherwise("predict")).drop("o_orderdate")
    labelled = rows.withColumn("prediction", argmax_label(ORDERS_SPEC.sub_cols))
    return equal_width_bands(labelled, ORDERS_SPEC.sub_cols)


def stored_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored frame kept as a table, as a monitoring job does before it builds several marts from it."""
    return written(scored_frame(spark, sf_dir), "scored")


def build_scored(training: DataFrame, predict: DataFrame, spec: ModelSpec) -> DataFrame:
    """Stack two frames that hold class probabilities and derive everything the marts read."""
    rows = tag_sets(training, predict).withColumn(spec.name_prediction, argmax_label(spec.sub_cols))
    banded = equal_width_bands(class_indicators(rows, spec), spec.sub_cols)
    return project_scored(banded, spec)
