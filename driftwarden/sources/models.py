"""Saving and loading a model with its preprocessor and metadata."""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from driftwarden.operators.columns import model_id
from driftwarden.operators.encode import Preprocessor
from driftwarden.spec import ModelSpec


@dataclass
class SavedModel:
    model: PipelineModel
    preprocessor: Preprocessor
    spec: ModelSpec


def model_path(root: str, spec: ModelSpec) -> str:
    return f"{root.rstrip('/')}/{spec.name_project}/{spec.name_subproject}/{spec.version}/{model_id(spec)}"


def save_model(saved: SavedModel, root: str) -> str:
    """Write model, preprocessor and metadata below one folder and return it."""
    spark = SparkSession.getActiveSession()
    path = model_path(root, saved.spec)
    saved.model.write().overwrite().save(f"{path}/model")
    saved.preprocessor.write().overwrite().save(f"{path}/preprocess")
    text = json.dumps(asdict(saved.spec))
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/spec")
    return path


def load_model(spark: SparkSession, path: str) -> SavedModel:
    content = json.loads(spark.read.text(f"{path}/spec").first()["value"])
    spec = ModelSpec(**{k: tuple(v) if isinstance(v, list) else v for k, v in content.items()})
    return SavedModel(PipelineModel.load(f"{path}/model"), Preprocessor.load(f"{path}/preprocess"), spec)


def load_models(spark: SparkSession, prefix: str) -> dict[str, SavedModel]:
    """Every readable model one level below ``prefix``; damaged ones are skipped."""
    files = spark.read.text(f"{prefix.rstrip('/')}/*/spec").select(F.input_file_name().alias("f")).distinct().collect()
    found = {}
    for path in sorted({re.sub(r"/spec/[^/]*$", "", r["f"]) for r in files}):
        try:
            found[path.rsplit("/", 1)[-1]] = load_model(spark, path)
        except Exception:  # an incomplete folder must not hide the others
            continue
    return found
