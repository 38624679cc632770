"""Resource log of a training: blocks of eight lines, each ended by two tabs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Layout of a block and the fields of its dictionaries.
BLOCK_END = "\t\t"
LINES = ("periodo", "time_acum", "modulename", "levelname", "memory", "cpu_times", "load", "message")
MEMORY = ("total", "available", "percent", "used", "free")
CPU_TIMES = ("user", "nice", "system", "idle", "iowait", "irq", "softirq", "steal", "guest", "guest_nice")
LOAD = ("m_1", "0", "s_1")


def _numbers(text: Column) -> Column:
    return F.from_json(F.replace(text, F.lit("'"), F.lit('"')), "map<string,double>")


def parse_resource_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per complete block. A block cut short, as at the end of a log, is dropped."""
    blocks = spark.read.option("lineSep", BLOCK_END).text(path)
    lines = F.filter(F.transform(F.split("value", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    named = blocks.select(lines.alias("l")).where(F.size("l") >= len(LINES))
    named = named.select(*[F.col("l")[i].alias(n) for i, n in enumerate(LINES)])
    read = named.withColumns(
        {
            "memory": _numbers(F.col("memory")),
            "cpu_times": _numbers(F.col("cpu_times")),
            "load": F.from_json("load", "array<double>"),
        }
    )
    return read.select(
        F.replace("periodo", F.lit(","), F.lit(".")).try_cast("timestamp_ntz").alias("periodo"),
        F.col("time_acum").try_cast("bigint").alias("time_acum"),
        "modulename",
        "levelname",
        "message",
        *[F.col("memory")[k].alias(f"memory_usage_{k}") for k in MEMORY],
        *[F.col("cpu_times")[k].alias(f"cpu_times_percent_{k}") for k in CPU_TIMES],
        *[F.get("load", F.lit(i)).alias(f"cpu_usage_{k}") for i, k in enumerate(LOAD)],
    )


def resource_cost_mart(log: DataFrame) -> DataFrame:
    """The columns of the cost mart."""
    return log.select(
        *[f"cpu_usage_{k}" for k in LOAD],
        "memory_usage_available",
        "memory_usage_total",
        "message",
        "periodo",
        "time_acum",
    )


def resource_usage(costs: DataFrame) -> DataFrame:
    """Mean load over the three readings and mean share of free memory."""
    loads = [F.col(f"cpu_usage_{k}") for k in LOAD]
    present = F.filter(F.array(*loads), lambda x: x.isNotNull())
    mean = F.aggregate(present, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(present), F.lit(0))
    free = F.try_divide("memory_usage_available", "memory_usage_total")
    return costs.agg(F.avg(mean).alias("cpu_usage_percent"), F.avg(free).alias("ram_usage_percent"))
