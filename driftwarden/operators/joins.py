"""Equi-joins of modelling tables with outcomes, run metadata and feature tables.

No side is forced to be broadcast here: Spark compares the size of a side with
``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution splits skewed
partitions of the sort-merge joins that remain.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwarden.common import written
from driftwarden.operators.windows import keep_last


def feedback_join(data: DataFrame, outcomes: DataFrame, keys: Sequence[str], period: str = "periodo") -> DataFrame:
    """Inner join on all keys; if that matches nothing, on the first key with the outcomes' period left out.

    The join is written, so that looking whether it is empty does not run it a second time.
    """
    full = written(data.join(outcomes, list(keys)), "feedback")
    if not full.isEmpty():
        return full
    timeless = outcomes.select(*[c for c in outcomes.columns if period not in c])
    return data.join(timeless, keys[0])


def attach_run_metadata(runs: DataFrame, *tables: DataFrame, on: str = "id_pipeline") -> DataFrame:
    """Left joins of the run table with state, times and paths."""
    for t in tables:
        runs = runs.join(t, on, "left")
    return runs


def known_runs_semi(runs: DataFrame, known: DataFrame, on: str) -> DataFrame:
    return runs.join(known, on, "left_semi")


def unexecuted_runs_anti(runs: DataFrame, executed: DataFrame, on: str) -> DataFrame:
    return runs.join(executed, on, "left_anti")


def leakage_guard(
    train: DataFrame, valid: DataFrame, id_columns: Sequence[str], entity: str, order: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Last row per id combination on both sides; validation entities seen in training are dropped."""
    train, valid = (keep_last(side, id_columns, order) for side in (train, valid))
    return train, valid.join(train.select(entity).distinct(), entity, "left_anti")


def align_by_row(features: DataFrame, labels: DataFrame, row_key: str) -> DataFrame:
    """Attach labels to features by an explicit row key."""
    return features.join(labels, row_key)


def enrich_features(
    entities: DataFrame, feature_refs: Sequence[str], tables: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Add features named ``entity:feature``, with one left join per entity table.

    ``tables`` maps an entity to its feature table and that table's key; the key
    is the column of the same name in ``entities``.
    """
    wanted: dict[str, list[str]] = {}
    for ref in feature_refs:
        entity, feature = ref.split(":", 1)
        wanted.setdefault(entity, []).append(feature)
    for entity, features in wanted.items():
        table, key = tables[entity]
        chosen = table.select(key, *[F.col(f).alias(f"{entity}__{f}") for f in features if f != key])
        entities = entities.join(chosen, key, "left")
    return entities


def importance_fill(features: DataFrame, importance: DataFrame) -> DataFrame:
    """Importance of every listed feature, 0 for those the model never used."""
    return features.join(importance, "feature", "left").select(
        "feature", F.coalesce(F.col("importance"), F.lit(0.0)).alias("importance")
    )
