"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwarden.common import written

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A word is a maximal run of characters other than space, tab, newline, vertical tab, form feed and carriage return.
WORD = "[^\\x20\\x09-\\x0D]+"

__all__ = [
    "WORD",
    "columns_of",
    "components",
    "filter_bits",
    "groups_of",
    "held_out",
    "may_hold",
    "read",
    "unit_hash",
    "written",
]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def columns_of(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under the operator's own names: further columns of the table cannot clash."""
    return df.select(*[F.col(f"`{column}`").alias(name) for name, column in names.items()])


def held_out(doc_id: Column) -> Column:
    """Rows whose labels no model may learn from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def unit_hash(key: Column, seed: str) -> Column:
    """A repeatable number in [0, 1) from the first 52 bits of an md5."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(2**52))


def groups_of(batches: Iterable[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """The groups of a key-sorted stream of batches, one at a time; only the open group is held."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        k = batch[key].to_numpy()
        cuts = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            part = batch.iloc[a:b]
            if held and held[0][key].iloc[0] != part[key].iloc[0]:
                yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)
                held = []
            held.append(part)
    if held:
        yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)


#: Bits of a filter per key, and the most and least bits of one as powers of two (16 MB at most).
_BITS, _LEAST_BITS, _MOST_BITS = 256, 16, 27


def filter_bits(keys: DataFrame) -> tuple[DataFrame, int]:
    """A hash filter of the 64-bit numbers ``key``: (block, bits) in blocks of 32 768 bits, and its bits as a power of two.

    At most 4 096 blocks of 4 KB, however many keys there are: a filter that is
    too small for its keys lets more through.
    """
    n = max(1, keys.count())
    power = min(_MOST_BITS, max(_LEAST_BITS, (n * _BITS - 1).bit_length()))
    place = F.col("key").bitwiseAND(F.lit((1 << power) - 1)) + 1
    blocks = keys.groupBy(F.bitmap_bucket_number(place).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    return blocks, power


def may_hold(df: DataFrame, key: Column, keys: DataFrame, name: str) -> DataFrame:
    """``df`` with a boolean ``name``: false only where the 64-bit number ``key`` is none of ``keys`` (key).

    Wide rows stay where they lie; only those marked need a join with the keys.
    """
    blocks, power = filter_bits(keys)
    blocks = F.broadcast(written(blocks, "filter").withColumnsRenamed({"block": "__block", "bits": "__bits"}))  # 16 MB at most
    low = key.bitwiseAND(F.lit((1 << power) - 1))
    marked = df.withColumn("__low", F.coalesce(low, F.lit(0))).withColumn("__at", F.shiftright("__low", 15) + 1)
    bit = F.col("__low").bitwiseAND(F.lit((1 << 15) - 1))
    byte = F.conv(F.hex(F.substring("__bits", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    set_ = byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (bit % 8 + 1).cast("int"))) > 0
    joined = marked.join(blocks, F.col("__at") == F.col("__block"), "left")
    return joined.withColumn(name, F.coalesce(set_, F.lit(False))).drop("__low", "__at", "__block", "__bits")


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); the component is its smallest node.

    Alternating star contraction. Every round points the neighbours of a node,
    and the node itself, at the smallest of them: first the larger neighbours,
    then the smaller ones. What travels is one minimum per node, so a node with
    very many edges is one row after the partial aggregation; the join that
    brings the minimum back to the edges is dealt again by Spark where one node
    holds most of them. Each round is written to the shared folder.
    """
    now = written(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label
    )
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), label)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        now = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), label)
        # Done when every edge points at a node that points nowhere, and no node points at two.
        state = now.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if tuple(state) == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = tuple(state)
