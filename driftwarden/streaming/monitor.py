"""Monitoring of scored rows as they arrive, on the same marts as the batch job."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftwarden.common import together, written
from driftwarden.operators import value_counts as V
from driftwarden.operators.drift import drift_of
from driftwarden.plans import periods as R
from driftwarden.spec import ModelSpec

Marts = Callable[[DataFrame, ModelSpec], dict[str, DataFrame]]


def monitor_stream(
    arriving: DataFrame, reference: DataFrame, spec: ModelSpec, build: Marts, root: str, checkpoint: str
) -> StreamingQuery:
    """Build the marts of every micro-batch of scored rows against the reference rows.

    Each batch overwrites its own ``batch_id`` folder, so a batch that is run
    again after a failure leaves no duplicates. All rows that have arrived are
    processed, then the query stops.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        scored = reference.withColumn("set_analysis", F.lit("training")).unionByName(
            batch.withColumn("set_analysis", F.lit("predict"))
        )
        for name, mart in build(scored, spec).items():
            mart.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")

    return (
        arriving.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


#: Text form of the period, by which the stored sums and marts lie in folders.
PERIOD = "period_key"


def monitor_stream_periods(
    arriving: DataFrame, reference: DataFrame, spec: ModelSpec, root: str, checkpoint: str
) -> StreamingQuery:
    """Keep the performance and drift marts of every period up to date as its rows arrive.

    What is kept between micro-batches are sums, not rows: each batch writes its
    own cells, score counts and value counts below ``root/sums``, in a folder per
    period and batch. The marts of the periods it touches are then folded from
    the sums of all batches so far and replace the earlier ones, so a period
    whose rows come in several batches has the same lines as in one. A batch
    that is run again after a failure overwrites its own folders. The reference
    is summed once, at the start. Rows without a period form one of their own.
    """
    by = [spec.period]
    limits = written(R.reference_limits(reference, spec), "reference-limits")
    known = written(R.side_counts(reference, spec, V.REFERENCE, by), "reference-counts")
    names = ("cells", "scores", "counts")
    key = F.coalesce(F.col(spec.period).cast("string"), F.lit("none")).alias(PERIOD)

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = written(batch, "arrived")
        own = R.sums_of(rows, spec, by)

        def store(name: str) -> None:
            sums = getattr(own, name).select("*", key, F.lit(batch_id).alias("batch_id"))
            writer = sums.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(PERIOD, "batch_id").parquet(f"{root}/sums/{name}")

        together(spark, *[partial(store, name) for name in names])
        touched = [r[0] for r in rows.select(key).distinct().collect()]  # periods of one batch
        if not touched:
            return

        def so_far(name: str) -> DataFrame:
            schema = getattr(own, name).select("*", key, F.lit(batch_id).alias("batch_id")).schema
            stored = spark.read.schema(schema).parquet(f"{root}/sums/{name}")
            return stored.where(F.col(PERIOD).isin(touched) & (F.col("batch_id") <= batch_id)).drop(PERIOD, "batch_id")

        parts = R.Sums(*[so_far(name) for name in names])
        whole = R.added([parts], by)
        sums = R.kept(R.Sums(whole.cells, whole.scores, whole.counts.unionByName(known)))

        def replace(name: str, mart: DataFrame) -> None:
            writer = mart.select("*", key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(PERIOD).parquet(f"{root}/{name}")

        def performance() -> None:
            replace("perf__general_metrics", R.performance_lines(sums, limits, spec, by))

        def drift() -> None:
            found = drift_of(sums.counts, spec.cat_features, spec.cont_features, by)
            together(spark, partial(replace, "drift__general", found.general), partial(replace, "drift__specific", found.specific))

        together(spark, performance, drift)

    return (
        arriving.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
