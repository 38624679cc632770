"""Scalar column functions: bands, recodes, labels, keys, safe lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def band_number(value: Column, low: Column, high: Column, k: int = 10) -> Column:
    """Right-closed equal-width bin 1..k of ``value`` in [low, high].

    A constant column has no width; its single value falls in the middle bin.
    """
    width = high - low
    position = F.ceil((value - low) / F.nullif(width, F.lit(0.0)) * F.lit(float(k)))
    inside = F.least(F.greatest(position, F.lit(1)), F.lit(k))
    return F.when(value.isNull(), None).when(width == 0, F.lit(k // 2)).otherwise(inside).cast("int")


def band_label(number: Column, k: int = 10) -> Column:
    """``P010`` … ``P100`` for ten bands."""
    return F.when(number.isNull(), None).otherwise(
        F.concat(F.lit("P"), F.lpad((number * F.lit(100 // k)).cast("string"), 3, "0"))
    )


def equal_width_bands(df: DataFrame, columns: Sequence[str], k: int = 10, suffix: str = "_cut") -> DataFrame:
    """Add a band label per column; the borders come from one pass over ``df``."""
    limits = df.agg(
        F.struct(
            *[F.min(F.col(c).cast("double")).alias(f"lo_{c}") for c in columns],
            *[F.max(F.col(c).cast("double")).alias(f"hi_{c}") for c in columns],
        ).alias("limits")
    ).scalar()
    joined = df.withColumn("__limits", limits)
    return joined.withColumns(
        {
            f"{c}{suffix}": band_label(
                band_number(F.col(c).cast("double"), F.col(f"__limits.lo_{c}"), F.col(f"__limits.hi_{c}"), k), k
            )
            for c in columns
        }
    ).drop("__limits")


def recode_values(value: Column, mapping: Mapping) -> Column:
    """Dictionary lookup; anything not listed becomes NULL."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.element_at(F.create_map(*pairs), value)


def first_token(value: Column) -> Column:
    return F.substring_index(value, " ", 1)


def argmax_label(columns: Sequence[str]) -> Column:
    """Index of the largest column; the first of equals wins."""
    scores = F.array(*[F.col(c) for c in columns])
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def month_floor(value: Column) -> Column:
    return F.trunc(value, "MM")


def to_date_string(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def monthly_key(value: Column) -> Column:
    return F.month(value)


def try_value(value: Column, data_type: str, default: Column | None = None) -> Column:
    """Cast, or the default where the value cannot be read."""
    read = value.try_cast(data_type)
    return read if default is None else F.coalesce(read, default)


def json_path(value: Column, path: str) -> Column:
    """Deep lookup in a JSON text; NULL where the path is absent."""
    return F.get_json_object(value, path)


def model_key(project: Column, subproject: Column, type_model: Column, version: Column, training: Column) -> Column:
    """md5 over the five identifying parts of a training, as hex text."""
    return F.md5(F.concat_ws("_", project, subproject, type_model, version, training))
