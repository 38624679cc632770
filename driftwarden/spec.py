"""Column roles of a modelling table and the fixed shapes of the output tables."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

METRIC_SCHEMA = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("type_metric", T.StringType()),
        T.StructField("name_classes", T.StringType()),
        T.StructField("percentil", T.StringType()),
        T.StructField("cutoff", T.DoubleType()),
        T.StructField("segment", T.StringType()),
    ]
)

FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("group_feature", T.StringType()),
        T.StructField("name_classes", T.StringType()),
        T.StructField("flg_target", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("type_metric", T.StringType()),
    ]
)


@dataclass(frozen=True)
class ModelSpec:
    """Which column plays which part for one model.

    ``sub_cols`` are the class-probability columns in class-code order: class
    code ``i`` of the target is described by ``sub_cols[i]``.
    """

    id_features: tuple[str, ...]
    cat_features: tuple[str, ...]
    cont_features: tuple[str, ...]
    name_target: str = "target"
    name_prediction: str = "prediction"
    sub_cols: tuple[str, ...] = ("p0", "p1")
    kpi_features: tuple[str, ...] = ("kpi",)
    segment: str = "segment"
    segment_values: tuple[str, ...] | None = None
    period: str = "periodo"
    obs_features: tuple[str, ...] = ()
    text_features: tuple[str, ...] = ()
    name_project: str = "project"
    name_subproject: str = "subproject"
    type_model: str = "GBT"
    version: str = "0.1.0"
    id_training: str = ""
    source: str = "training"
    parameters: dict = field(default_factory=dict, hash=False, compare=False)

    @property
    def n_classes(self) -> int:
        return len(self.sub_cols)

    @property
    def features(self) -> tuple[str, ...]:
        return self.cat_features + self.cont_features

    @property
    def kpi(self) -> str:
        return self.kpi_features[0]

    def with_(self, **changes) -> "ModelSpec":
        return replace(self, **changes)
