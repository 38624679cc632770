"""Run metadata and run ids of a pipeline service, and the run catalogue built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwarden.operators.joins import attach_run_metadata, unexecuted_runs_anti
from driftwarden.operators.profile import latest_training
from driftwarden.operators.windows import keep_last

RUN_SCHEMA = """displayName string, state string, createTime string, startTime string, endTime string, updateTime string,
  pipelineSpec struct<components: map<string, struct<dag: struct<tasks: map<string, struct<inputs: struct<parameters: struct<
    target: struct<runtimeValue: struct<constantValue: struct<stringValue: string>>>>>>>>>>>, jobDetail struct<taskDetails: array<struct<
    outputs: map<string, struct<artifacts: array<struct<schemaTitle: string, uri: string>>>>,
    execution: struct<metadata: map<string, string>>>>>"""

# How runs and model folders are named.
SUCCEEDED = "PIPELINE_STATE_SUCCEEDED"
MODEL_KEY = "output:Output"
REGISTER_STEP, REGISTER_TASK = "comp-condition-register-outputs-1", "register-model"
MODEL_FOLDER = "MODELS"
RUN_KINDS = ("prediction-", "training-")
RUN_DEPTH = 7


def _artifact_paths(kind: str) -> Column:
    """URIs of the first artifact of every output whose type is ``system.<kind>``."""

    def first(output: Column) -> Column:
        return F.get(output["artifacts"], F.lit(0))

    def of_task(task: Column) -> Column:
        outputs = F.map_values(task["outputs"])
        wanted = F.filter(outputs, lambda o: first(o)["schemaTitle"] == f"system.{kind}")
        return F.coalesce(F.transform(wanted, lambda o: first(o)["uri"]), F.array().cast("array<string>"))

    return F.flatten(F.transform("jobDetail.taskDetails", of_task))


def read_run_metadata(spark: SparkSession, path: str) -> DataFrame:
    """One row per run: state, times, number of nodes, and the paths it produced."""
    runs = spark.read.schema(RUN_SCHEMA).json(path)
    registered = F.col("pipelineSpec.components")[REGISTER_STEP]["dag"]["tasks"][REGISTER_TASK]
    models = F.transform("jobDetail.taskDetails", lambda t: t["execution"]["metadata"][MODEL_KEY])
    return runs.select(
        F.col("displayName").alias("id_pipeline"),
        F.col("state").alias("state_pipeline"),
        registered["inputs"]["parameters"]["target"]["runtimeValue"]["constantValue"]["stringValue"].alias("name_target"),
        *[F.col(c).try_cast("timestamp_ntz").alias(c) for c in ("createTime", "startTime", "endTime", "updateTime")],
        F.size("jobDetail.taskDetails").alias("n_nodes"),
        _artifact_paths("Dataset").alias("paths_parquets"),
        _artifact_paths("Artifact").alias("paths_artifacts"),
        F.array_distinct(F.filter(models, lambda m: m.contains(MODEL_FOLDER))).alias("paths_models"),
    )


def filter_runs(paths: DataFrame, column: str = "path") -> DataFrame:
    """Run ids in storage paths, split into project, version, kind and time.

    A run id reads ``<project>-<major>-<minor>-<patch>-<kind>-<time>`` and is the
    last folder of a path of seven parts.
    """
    kinds = F.lit(False)
    for k in RUN_KINDS:
        kinds = kinds | F.col(column).contains(k)
    parts = F.split(column, "/")
    ids = paths.where(kinds & (F.size(parts) == RUN_DEPTH)).select(F.element_at(parts, -2).alias("id_pipeline"))
    return parse_run_ids(ids)


def parse_run_ids(ids: DataFrame) -> DataFrame:
    p = F.split("id_pipeline", "-")
    n = F.size(p)
    return ids.select(
        "id_pipeline",
        F.array_join(F.slice(p, n - 4, F.lit(3)), "-").alias("version"),
        F.element_at(p, -1).alias("name_pipeline"),
        F.element_at(p, -2).alias("source"),
        F.array_join(F.slice(p, F.lit(1), n - 5), "-").alias("name_subproject"),
    )


def first_nonempty(df: DataFrame, key: str, arrays: list[str], order: str) -> DataFrame:
    """Per project the first non-empty list of each column."""
    return df.groupBy(key).agg(
        *[F.min_by(F.col(a), F.when(F.size(a) > 0, F.col(order))).alias(a) for a in arrays]
    )


def run_catalog(
    ids: DataFrame, metadata: DataFrame, approved: DataFrame, executed: DataFrame | None = None
) -> DataFrame:
    """Succeeded runs of the approved version of each project, with times and paths.

    ``approved`` has ``name_subproject, version``; ``executed`` the ids already
    processed. Model paths and label tables are those of the project's first run
    that has any; the training data are those of its newest run.
    """
    runs = attach_run_metadata(ids, metadata.where(F.col("state_pipeline").isNotNull()), on="id_pipeline")
    if executed is not None:
        runs = unexecuted_runs_anti(runs, executed, "id_pipeline")
    label = F.concat("name_target", F.lit("/"), F.replace("version", F.lit("-"), F.lit(".")))
    runs = runs.withColumn("name_target", F.array_compact(F.array(label)))
    shared = first_nonempty(runs, "name_subproject", ["paths_models", "name_target"], "id_pipeline")
    runs = runs.drop("paths_models", "name_target").join(shared, "name_subproject")

    def tables(paths: str) -> Column:
        named = F.transform(paths, lambda w: F.get(F.split(w, "/"), F.lit(4)))
        return F.when(F.size(named) > 0, named)

    runs = runs.withColumn("tables_train", F.coalesce(tables("paths_models"), tables("name_target")))
    usable = runs.join(approved, ["name_subproject", "version"], "left_semi").where(F.col("state_pipeline") == SUCCEEDED)
    trained = latest_training(usable, "name_subproject", "createTime", F.col("source") == "training")
    newest = keep_last(usable, ["name_subproject"], ["createTime", "id_pipeline"]).select(
        "name_subproject", F.col("paths_parquets").alias("paths_parquets_train")
    )
    return (
        usable.join(trained.withColumnRenamed("period_of_training", "last_training"), "name_subproject", "left")
        .join(newest, "name_subproject")
        .withColumn("period_of_training", F.date_format("createTime", "yyyy-MM-dd"))
        .withColumn("EXECUTE_PREVIOUSLY", F.lit("NO"))
    )
