"""Governance marts as parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwarden.operators.columns import STATIC_MARTS, add_lineage, standardize_mart
from driftwarden.spec import ModelSpec

# Columns of these names always have these types in a mart.
MART_TYPES = {"periodo": "date", "periodo_execution_mg": "date", "id_execution_mg": "timestamp_ntz"}


def mart_path(root: str, mart: str) -> str:
    """``mg_perf__x`` is stored as ``mg_poc_perf__x``."""
    return f"{root.rstrip('/')}/{mart.replace('mg', 'mg_poc', 1)}"


def mart_frame(
    df: DataFrame, mart: str, spec: ModelSpec, execution: str, period: str | None = None
) -> DataFrame | None:
    """``df`` as it is stored: standard names, lineage first, the rest in name order, fixed types."""
    out = add_lineage(standardize_mart(df, spec), mart, spec, execution)
    if out is None:
        return None
    lineage = [c for c in ("id_modelo", "id_execution_mg", "source") if c in out.columns]
    if mart not in STATIC_MARTS and period is not None and "periodo_execution_mg" not in out.columns:
        out = out.withColumn("periodo_execution_mg", F.lit(period))
    if "periodo_execution_mg" in out.columns:
        lineage.insert(2, "periodo_execution_mg")
    rest = sorted(c for c in out.columns if c not in lineage)
    return out.select(
        *[
            (F.col(f"`{c}`").try_cast(MART_TYPES[c]).alias(c) if c in MART_TYPES else F.col(f"`{c}`"))
            for c in [*lineage, *rest]
        ]
    )


#: Partition that holds the lines of one source, period and execution of a model.
RUN = "run_key"


def append_mart(
    df: DataFrame, mart: str, spec: ModelSpec, root: str, execution: str, period: str | None = None
) -> str | None:
    """Add to the mart; returns its path, or ``None`` when a prediction run does not write it.

    Lines of another source, period or execution stay. Those of the same are
    replaced, so a run that is repeated after a failure leaves each line once. A
    frame may bring its periods along as ``periodo_execution_mg``.
    """
    out = mart_frame(df, mart, spec, execution, period)
    if out is None:
        return None
    own = F.col("periodo_execution_mg").cast("string") if "periodo_execution_mg" in out.columns else F.lit(period)
    key = F.md5(F.concat_ws("|", F.lit(spec.source), F.coalesce(own, F.lit("-")), F.lit(execution)))
    path = mart_path(root, mart)
    writer = out.withColumn(RUN, key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("id_modelo", RUN).parquet(path)
    return path


def read_mart(spark: SparkSession, root: str, mart: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(mart_path(root, mart)).drop(RUN)
