"""Column management, row filters and period selection."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwarden.spec import ModelSpec

# The characters that may not stay in a column name.
_FORBIDDEN = r"[#%\[\] ]"


def clean_name(name: str, hash_prefix: str | None = None) -> str:
    """Replace forbidden characters by ``_``; ``#`` by ``hash_prefix`` when one is given."""
    if hash_prefix is not None:
        name = name.replace("#", hash_prefix)
    return re.sub(_FORBIDDEN, "_", name)


def sanitize_columns(df: DataFrame, hash_prefix: str | None = None) -> DataFrame:
    return df.toDF(*[clean_name(c, hash_prefix) for c in df.columns])


def drop_duplicate_columns(df: DataFrame) -> DataFrame:
    """Keep the first of equally named columns."""
    unique = df.toDF(*[f"__{i}" for i in range(len(df.columns))])
    first: dict[str, int] = {}
    for i, c in enumerate(df.columns):
        first.setdefault(c, i)
    return unique.select(*[F.col(f"__{i}").alias(c) for c, i in first.items()])


def standardize_mart(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Give role columns their common names so that marts of all models stack.

    Class probabilities and ids become arrays, KPIs become ``kpi_1``/``kpi_2``
    as double, target and segment get their role names, scratch columns go.
    """
    # Columns that never leave a run.
    scratch = [
        "current_small_hist_0",
        "current_small_hist_1",
        "ref_small_hist_0",
        "ref_small_hist_1",
        "hpo",
        "group",
        "feature_importance",
    ]
    df = pack_columns(df, spec).drop(*scratch)
    for i, kpi in enumerate(spec.kpi_features[:2], start=1):
        if kpi in df.columns:
            df = df.withColumn(kpi, F.col(kpi).cast("double")).withColumnRenamed(kpi, f"kpi_{i}")
    return df.withColumnsRenamed({spec.name_target: "name_target", spec.segment: "subpoblation_features"})


def pack_columns(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Fold parallel columns into arrays: probabilities, ids without the period, importances."""
    groups = {
        "sub_cols": list(spec.sub_cols),
        "id_features": [c for c in spec.id_features if c != spec.period],
        "importance": [f"importance_{i}" for i in range(spec.n_classes)],
    }
    for name, members in groups.items():
        if members and all(m in df.columns for m in members):
            kind = "string" if name == "id_features" else "double"
            df = df.withColumn(name, F.array(*[F.col(m).cast(kind) for m in members])).drop(*members)
    return df


# Tables that describe a training and carry no execution columns.
STATIC_MARTS = (
    "mg_metadata_constants",
    "mg_metadata_modelo_costos",
    "mg_perf_metadata_training_validation",
    "mg_perf_metadata_hpo_trials",
    "mg_int_metadata_gain",
)
# Of these, the ones a prediction run does not write at all.
TRAINING_ONLY_MARTS = ("mg_metadata_constants", "mg_metadata_modelo_costos")


def add_lineage(df: DataFrame, mart: str, spec: ModelSpec, execution: str) -> DataFrame | None:
    """Prefix the lineage columns; ``None`` when a prediction run skips this mart."""
    if mart in TRAINING_ONLY_MARTS and spec.source == "predict":
        return None
    lineage = {"id_modelo": F.lit(model_id(spec))}
    if mart not in STATIC_MARTS:
        lineage |= {"id_execution_mg": F.lit(execution).try_cast("timestamp_ntz"), "source": F.lit(spec.source)}
    rest = [c for c in df.columns if c not in ("id_modelo", "id_execution_mg", "source")]
    return df.select(*[v.alias(k) for k, v in lineage.items()], *[F.col(f"`{c}`") for c in rest])


def model_id(spec: ModelSpec) -> str:
    """First 15 decimal digits of the md5 of the identifying parts of a training."""
    parts = (spec.name_project, spec.name_subproject, spec.type_model, spec.version, spec.id_training)
    return str(int(hashlib.md5("_".join(parts).encode("utf8")).hexdigest(), 16))[:15]


def period_split(df: DataFrame, period: str, until: Column, after: Column | None = None, since: Column | None = None):
    """Training rows up to ``until`` (from ``since``), production rows after ``after`` or ``until``."""
    value = F.col(period)
    training = value <= until if since is None else (value >= since) & (value <= until)
    return df.where(training), df.where(value > (until if after is None else after))


def latest_period(df: DataFrame, period: str) -> DataFrame:
    """Rows of the newest period: the reference set of a monitoring run."""
    return df.where(F.col(period) == df.select(F.max(period)).scalar())


def next_period_pair(df: DataFrame, period: str, start: Column, name: str = "set_data") -> DataFrame:
    """Rows of one month as ``reference`` and of the following month as ``current``."""
    value = F.col(period)
    side = F.when(value == start, "reference").when(value == F.add_months(start, 1), "current")
    return df.withColumn(name, side).where(F.col(name).isNotNull())


def read_period_batches(df: DataFrame, period: str) -> DataFrame:
    """The distinct periods in order with their sizes; the rows stay keyed by ``period``."""
    return df.groupBy(period).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(period)


def subpopulation_filter(df: DataFrame, segment: str, values: Iterable[str]) -> DataFrame:
    return df.where(F.col(segment).isin(*values))


def tag_sets(training: DataFrame, predict: DataFrame, name: str = "set_analysis") -> DataFrame:
    return training.withColumn(name, F.lit("training")).unionByName(
        predict.withColumn(name, F.lit("predict")), allowMissingColumns=True
    )


def split_to_columns(df: DataFrame, column: str, names: Sequence[str], separator: str = ",") -> DataFrame:
    parts = F.split(column, re.escape(separator))
    return df.withColumns({n: F.get(parts, F.lit(i)) for i, n in enumerate(names)})


def interaction_features(
    df: DataFrame, pairs: Sequence[tuple[str, str]], target: str | None = None, drop: Sequence[str] = ()
) -> DataFrame:
    """Products of numeric pairs as ``a_b``; text columns go, the label becomes ``target``."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != target]
    out = df.withColumns({f"{a}_{b}": F.col(a) * F.col(b) for a, b in pairs}).drop(*texts, *drop)
    return out.withColumnRenamed(target, "target") if target else out


def class_indicators(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """0/1 columns per class for the prediction and for the target."""
    return df.withColumns(
        {
            f"{c}_{i}": F.when(F.col(c) == i, 1).otherwise(0)
            for c in (spec.name_prediction, spec.name_target)
            for i in range(spec.n_classes)
        }
    )


def project_scored(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Ids, features, labels, probabilities, indicators and bands, each once."""
    wanted = [*spec.id_features, *spec.features, spec.name_target, spec.name_prediction, *spec.sub_cols]
    wanted += ["set_analysis", *spec.kpi_features, spec.segment, spec.period, *spec.text_features]
    wanted += [f"{c}_{i}" for c in (spec.name_target, spec.name_prediction) for i in range(spec.n_classes)]
    wanted += [f"{c}_cut" for c in spec.sub_cols]
    return df.select(*[c for c in dict.fromkeys(wanted) if c in df.columns])


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def infer_feature_roles(df: DataFrame, spec_ids: Sequence[str], target: str) -> dict[str, list[str]]:
    """Text columns are categorical, the rest continuous; ids and the target are neither."""
    roles: dict[str, list[str]] = {"cat": [], "cont": []}
    for f in df.schema.fields:
        if f.name not in (*spec_ids, target):
            roles["cat" if isinstance(f.dataType, T.StringType) else "cont"].append(f.name)
    return roles


def feature_roles_table(df: DataFrame, spec_ids: Sequence[str], target: str) -> DataFrame:
    """The roles with the number of rows that hold a value, one row per feature."""
    roles = infer_feature_roles(df, spec_ids, target)
    kind = {c: r for r, cs in roles.items() for c in cs}
    counted = df.agg(*[F.count(c).cast("double").alias(c) for c in kind]).unpivot([], list(kind), "column", "n_values")
    role = F.element_at(F.create_map(*[F.lit(x) for kv in kind.items() for x in kv]), F.col("column"))
    return counted.select("column", role.alias("role"), F.col("n_values").cast("bigint").alias("n_values"))


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))
