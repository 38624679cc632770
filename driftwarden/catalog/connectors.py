"""Sources, sinks, run metadata, resource logs. Files are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwarden.catalog.performance import CAPTURE, CAPTURE_CTE
from driftwarden.catalog.registry import PREDICT, query, rounded
from driftwarden.common import scratch_path
from driftwarden.operators import columns as C
from driftwarden.operators import metrics as M
from driftwarden.operators.windows import keep_last
from driftwarden.plans.scored import ORDERS_SPEC as SPEC
from driftwarden.plans.scored import read, scored_frame
from driftwarden.sources import files, marts, resource_log, runs

EXECUTION = "2024-05-01 10:30:00"


@query("read_parquet", "SELECT * FROM nation")
def _read_parquet(spark, sf_dir):
    return files.read_parquet(spark, f"{sf_dir}/nation.parquet")


@query(
    "read_csv_union",
    "SELECT c_custkey, c_name, c_acctbal FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier",
)
def _csv(spark, sf_dir):
    paths = []
    for table, prefix in (("customer", "c_cust"), ("supplier", "s_supp")):
        p = prefix[:2]
        rows = read(spark, sf_dir, table).select(
            F.col(f"{prefix}key").alias("c_custkey"), F.col(f"{p}name").alias("c_name"), F.col(f"{p}acctbal").alias("c_acctbal")
        )
        paths.append(scratch_path(spark, "csv"))
        files.write_csv(rows, paths[-1])
    schema = spark.createDataFrame([], "c_custkey bigint, c_name string, c_acctbal double").schema
    return files.read_csv_union(spark, paths, schema)


@query(
    "sql_source",
    """SELECT o_orderdate AS fecha, o_orderkey AS id_lead, o_orderstatus AS resultado FROM orders
    JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND o_orderstatus = 'F'
    AND o_orderdate >= TIMESTAMP '1997-01-01' AND c_name IS NOT NULL""",
)
def _sql(spark, sf_dir):
    sql = """SELECT o_orderdate AS fecha, o_orderkey AS id_lead, o_orderstatus AS resultado FROM src_orders
    JOIN src_customer ON o_custkey = c_custkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND o_orderstatus = 'F'
    AND o_orderdate >= TIMESTAMP_NTZ '1997-01-01' AND c_name IS NOT NULL"""
    views = {"src_orders": read(spark, sf_dir, "orders"), "src_customer": read(spark, sf_dir, "customer")}
    return files.sql_source(spark, sql, views)


@query("read_limited", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5000")
def _limited(spark, sf_dir):
    return files.read_limited(read(spark, sf_dir, "orders"), 5_000, [F.desc("o_totalprice"), "o_orderkey"])


@query("write_parquet", "SELECT * FROM orders")
def _write_parquet(spark, sf_dir):
    path = scratch_path(spark, "orders")
    files.write_parquet(read(spark, sf_dir, "orders"), path, ["o_orderstatus"])
    return files.read_parquet(spark, path)


@query("write_csv", "SELECT p_partkey, p_name, p_retailprice FROM part")
def _write_csv(spark, sf_dir):
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    path = scratch_path(spark, "part")
    files.write_csv(part, path)
    return files.read_csv_union(spark, [path], part.schema)


@query(
    "append_mart",
    f"""{PREDICT}, {CAPTURE_CTE} SELECT {C.model_id(SPEC)}::BIGINT AS id_modelo, TIMESTAMP '{EXECUTION}' AS id_execution_mg,
    d.period AS periodo_execution_mg, 'training' AS source, metric, round(value, 6) AS value, type_metric, name_classes,
    percentil, cutoff, segment AS subpoblation_features
    FROM ({CAPTURE}), (SELECT unnest([DATE '2000-01-01', DATE '2000-02-01']) AS period) d""",
)
def _append(spark, sf_dir):
    mart = M.decile_capture(scored_frame(spark, sf_dir).where("set_analysis = 'predict'"), SPEC)
    root = scratch_path(spark, "marts")
    for period in ("2000-01-01", "2000-02-01"):
        marts.append_mart(mart, "mg_perf__general_metrics", SPEC, root, EXECUTION, period)
    back = marts.read_mart(spark, root, "mg_perf__general_metrics")
    return rounded(back.withColumn("id_modelo", F.col("id_modelo").cast("bigint")))


# ------------------------------------------------------------------- run metadata
# Every order is a run: its customer's nation is the project, its status the outcome.

RUN_ID = """'proj-' || CAST(c_nationkey AS VARCHAR) || '-0-' || CAST(c_nationkey % 3 AS VARCHAR) || '-' ||
  CASE o_orderpriority WHEN '1-URGENT' THEN '1' ELSE '0' END || '-' ||
  CASE o_orderstatus WHEN 'O' THEN 'training' ELSE 'prediction' END || '-' || CAST(o_orderkey AS VARCHAR)"""


def run_rows(spark, sf_dir):
    orders, customer = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    nation = F.col("c_nationkey")
    run_id = F.concat(
        F.lit("proj-"),
        nation.cast("string"),
        F.lit("-0-"),
        (nation % 3).cast("string"),
        F.lit("-"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "1").otherwise("0"),
        F.lit("-"),
        F.when(F.col("o_orderstatus") == "O", "training").otherwise("prediction"),
        F.lit("-"),
        F.col("o_orderkey").cast("string"),
    )
    return orders.join(customer, orders.o_custkey == customer.c_custkey).withColumn("run_id", run_id)


def run_json(spark, sf_dir) -> str:
    """Write one JSON document per order and return the folder."""
    rows = run_rows(spark, sf_dir)
    key = F.col("o_orderkey").cast("string")
    time = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")

    def output(kind: str, uri):
        return F.struct(F.array(F.struct(F.lit(f"system.{kind}").alias("schemaTitle"), uri.alias("uri"))).alias("artifacts"))

    outputs = F.create_map(
        F.lit("data"), output("Dataset", F.concat(F.lit("data/df_"), key)),
        F.lit("report"), output("Artifact", F.concat(F.lit("report/"), key)),
    )
    model = F.concat(F.lit("store/a/MODELS/v/table_"), F.col("c_nationkey").cast("string"))
    task = F.struct(
        outputs.alias("outputs"),
        F.struct(F.create_map(F.lit(runs.MODEL_KEY), model).alias("metadata")).alias("execution"),
    )
    bare = F.struct(
        F.create_map().cast(outputs_type()).alias("outputs"),
        F.struct(F.create_map(F.lit("note"), F.lit("none")).alias("metadata")).alias("execution"),
    )
    failed = F.col("o_orderstatus") == "P"
    documents = rows.select(
        F.col("run_id").alias("displayName"),
        F.when(failed, "PIPELINE_STATE_FAILED").otherwise(runs.SUCCEEDED).alias("state"),
        time.alias("createTime"),
        time.alias("startTime"),
        F.when(~failed, time).alias("endTime"),
        time.alias("updateTime"),
        registration(F.concat(F.lit("store/a/MODELS/v/label_"), F.col("c_nationkey").cast("string"))).alias("pipelineSpec"),
        F.struct(F.when(failed, F.array(bare)).otherwise(F.array(task, bare)).alias("taskDetails")).alias("jobDetail"),
    )
    path = scratch_path(spark, "runs")
    documents.write.json(path)
    return path


def registration(target):
    """A pipeline specification whose registering task was given ``target``."""
    value = target
    for name in ("stringValue", "constantValue", "runtimeValue", "target", "parameters", "inputs"):
        value = F.struct(value.alias(name))
    tasks = F.struct(F.create_map(F.lit(runs.REGISTER_TASK), value).alias("tasks"))
    return F.struct(F.create_map(F.lit(runs.REGISTER_STEP), F.struct(tasks.alias("dag"))).alias("components"))


def outputs_type() -> str:
    return "map<string, struct<artifacts: array<struct<schemaTitle: string, uri: string>>>>"


META = f"""WITH meta AS (SELECT {RUN_ID} AS id_pipeline, c_nationkey, o_orderkey,
  CASE o_orderstatus WHEN 'P' THEN 'PIPELINE_STATE_FAILED' ELSE 'PIPELINE_STATE_SUCCEEDED' END AS state_pipeline,
  date_trunc('second', o_orderdate) AS t, o_orderstatus <> 'P' AS fine,
  'store/a/MODELS/v/table_' || c_nationkey AS model, 'store/a/MODELS/v/label_' || c_nationkey AS label
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


@query(
    "read_run_metadata",
    f"""{META} SELECT id_pipeline, state_pipeline, label AS name_target, t AS "createTime", t AS "startTime",
    CASE WHEN fine THEN t END AS "endTime", t AS "updateTime", CASE WHEN fine THEN 2 ELSE 1 END AS n_nodes,
    CASE WHEN fine THEN 'data/df_' || o_orderkey ELSE '' END AS paths_parquets,
    CASE WHEN fine THEN 'report/' || o_orderkey ELSE '' END AS paths_artifacts,
    CASE WHEN fine THEN model ELSE '' END AS paths_models FROM meta""",
)
def _metadata(spark, sf_dir):
    out = runs.read_run_metadata(spark, run_json(spark, sf_dir))
    lists = ("paths_parquets", "paths_artifacts", "paths_models")
    return out.withColumns({c: F.array_join(c, ",") for c in lists})


def run_paths(spark, sf_dir):
    """Storage paths: some of another depth, some of no run at all."""
    last = F.when(F.col("o_orderkey") % 7 == 0, "/x/y").otherwise("/x")
    root = F.when(F.col("o_orderkey") % 5 == 0, "other").otherwise(F.col("run_id"))
    return run_rows(spark, sf_dir).select(F.concat(F.lit("b/PIPELINES/p/v/r/"), root, last).alias("path"))


PARSED = f"""SELECT {RUN_ID} AS id_pipeline, '0-' || (c_nationkey % 3) || '-' ||
  CASE o_orderpriority WHEN '1-URGENT' THEN '1' ELSE '0' END AS version, CAST(o_orderkey AS VARCHAR) AS name_pipeline,
  CASE o_orderstatus WHEN 'O' THEN 'training' ELSE 'prediction' END AS source, 'proj-' || c_nationkey AS name_subproject
  FROM orders JOIN customer ON o_custkey = c_custkey"""


@query("filter_runs", f"{PARSED} WHERE o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0")
def _filter_runs(spark, sf_dir):
    return runs.filter_runs(run_paths(spark, sf_dir))


@query(
    "run_catalog",
    f"""{META}, ids AS ({PARSED}),
    runs AS (SELECT ids.*, state_pipeline, t, fine, o_orderkey, model FROM ids JOIN meta USING (id_pipeline)
      WHERE id_pipeline NOT IN (SELECT {RUN_ID} FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice < 10000)),
    usable AS (SELECT * FROM runs WHERE version = '0-' || (CAST(split_part(name_subproject, '-', 2) AS INTEGER) % 3) || '-0' AND fine),
    trained AS (SELECT name_subproject, max(t) AS last_training FROM usable WHERE source = 'training' GROUP BY 1),
    newest AS (SELECT name_subproject, arg_max(o_orderkey, (t, id_pipeline)) AS o FROM usable GROUP BY 1)
    SELECT id_pipeline, u.name_subproject, version, name_pipeline, source, state_pipeline, t AS "createTime",
    'data/df_' || o_orderkey AS paths_parquets, model AS paths_models,
    'table_' || split_part(u.name_subproject, '-', 2) AS tables_train, last_training, 'data/df_' || o AS paths_parquets_train,
    strftime(t, '%Y-%m-%d') AS period_of_training, 'NO' AS "EXECUTE_PREVIOUSLY"
    FROM usable u LEFT JOIN trained USING (name_subproject) JOIN newest USING (name_subproject)""",
)
def _run_catalog(spark, sf_dir):
    rows = run_rows(spark, sf_dir)
    ids = runs.parse_run_ids(rows.select(F.col("run_id").alias("id_pipeline")))
    metadata = runs.read_run_metadata(spark, run_json(spark, sf_dir))
    approved = read(spark, sf_dir, "nation").select(
        F.concat(F.lit("proj-"), F.col("n_nationkey").cast("string")).alias("name_subproject"),
        F.concat(F.lit("0-"), (F.col("n_nationkey") % 3).cast("string"), F.lit("-0")).alias("version"),
    )
    executed = rows.where("o_totalprice < 10000").select(F.col("run_id").alias("id_pipeline"))
    out = runs.run_catalog(ids, metadata, approved, executed)
    lists = ("paths_parquets", "paths_models", "tables_train", "paths_parquets_train")
    keep = ["id_pipeline", "name_subproject", "version", "name_pipeline", "source", "state_pipeline", "createTime"]
    keep += ["last_training", "period_of_training", "EXECUTE_PREVIOUSLY"]
    return out.select(*keep, *[F.array_join(c, ",").alias(c) for c in lists])


# ------------------------------------------------------------------- resource log
# Every event writes one block.


def event_log(spark, sf_dir) -> str:
    value = F.col("value")

    def dictionary(fields, numbers):
        parts = [F.concat(F.lit(f"'{f}': "), n.cast("string")) for f, n in zip(fields, numbers)]
        return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))

    memory = dictionary(resource_log.MEMORY, [value + 100, value + 50, F.lit(12.5), value + 1, value + 2])
    cpu = dictionary(resource_log.CPU_TIMES, [F.col("user_id") + i for i in range(len(resource_log.CPU_TIMES))])
    load = F.concat(F.lit("["), F.concat_ws(", ", *[(value + i).cast("string") for i in (1, 5, 15)]), F.lit("]"))
    block = F.concat_ws(
        "\n",
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(",250 ")),
        F.concat(F.col("event_id").cast("string"), F.lit(" ")),
        F.lit("root "),
        F.lit("INFO "),
        F.lit(""),
        memory,
        cpu,
        load,
        F.col("event_type"),
    )
    # An event of type "error" is cut short, like the end of an interrupted log.
    whole = F.when(F.col("event_type") == "error", F.lit("2020-01-01 00:00:00,000 \n1 \nroot ")).otherwise(block)
    path = scratch_path(spark, "log")
    read(spark, sf_dir, "events").select(whole.alias("value")).write.option("lineSep", resource_log.BLOCK_END).text(path)
    return path


LOG = f"""WITH log AS (SELECT date_trunc('second', ts) + INTERVAL 250 MILLISECOND AS periodo, event_id AS time_acum,
  'root' AS modulename, 'INFO' AS levelname, event_type AS message, value + 100 AS memory_usage_total,
  value + 50 AS memory_usage_available, 12.5::DOUBLE AS memory_usage_percent, value + 1 AS memory_usage_used,
  value + 2 AS memory_usage_free, {', '.join(f'CAST(user_id + {i} AS DOUBLE) AS cpu_times_percent_{k}'
    for i, k in enumerate(resource_log.CPU_TIMES))},
  value + 1 AS cpu_usage_m_1, value + 5 AS cpu_usage_0, value + 15 AS cpu_usage_s_1 FROM events WHERE event_type <> 'error')"""


@query("parse_resource_log", f"{LOG} SELECT * FROM log")
def _log(spark, sf_dir):
    return resource_log.parse_resource_log(spark, event_log(spark, sf_dir))


@query(
    "resource_cost_mart",
    f"""{LOG} SELECT cpu_usage_m_1, cpu_usage_0, cpu_usage_s_1, memory_usage_available, memory_usage_total, message,
    periodo, time_acum FROM log""",
)
def _costs(spark, sf_dir):
    log = resource_log.parse_resource_log(spark, event_log(spark, sf_dir))
    return resource_log.resource_cost_mart(log)


@query(
    "resource_usage",
    f"""{LOG} SELECT round(avg((cpu_usage_m_1 + cpu_usage_0 + cpu_usage_s_1) / 3), 6) AS cpu_usage_percent,
    round(avg(memory_usage_available / memory_usage_total), 6) AS ram_usage_percent FROM log""",
)
def _usage(spark, sf_dir):
    log = resource_log.parse_resource_log(spark, event_log(spark, sf_dir))
    return rounded(resource_log.resource_usage(resource_log.resource_cost_mart(log)))
