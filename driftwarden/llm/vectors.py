"""Near-equal embeddings by sorted projection passes."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwarden.llm.common import components, groups_of, written
from driftwarden.operators.ordering import global_row_number

cloudpickle.register_pickle_by_value(sys.modules[__name__])

THRESHOLD = 0.95
#: Neighbours compared on each side, rows of a task's block, sign bits of one pass's sorting key.
WINDOW, BLOCK, BITS = 32, 2048, 63
#: Rows of one side where crowded rows are compared exactly, and rows of it taken at once.
PIECE, STRIP = 4096, 512
#: Chance aimed at that a lone pair at the threshold is found in some pass.
RECALL = 0.999
#: The same for rows in a crowd, of which the estimate from their own windows is too good by some factor.
CROWD_RECALL = 1 - 1e-6
_SEED = 11


def passes_for(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """Passes needed: a pair meets in a window when the leading log2(n / WINDOW) random signs agree."""
    agree = 1 - math.acos(threshold) / math.pi
    met = agree ** max(0.0, math.log2(max(n, 1) / WINDOW))
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - met))) if met < 1 else 1


def _packer(single: bool):
    kind = "<f4" if single else "<f8"

    @F.pandas_udf(T.BinaryType())
    def pack(vectors: pd.Series) -> pd.Series:
        """The bytes of a usable vector; NULL for one that is missing, empty, zero or not finite throughout."""
        out = []
        for v in vectors:
            x = None if v is None else np.asarray(v, dtype=np.float64)
            good = x is not None and x.ndim == 1 and len(x) and np.isfinite(x).all() and x.any()
            out.append(x.astype(kind).tobytes() if good else None)
        return pd.Series(out)

    return pack


def _unit(packed: Iterable[bytes], kind: str) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so that no square overflows."""
    x = np.stack([np.frombuffer(p, kind) for p in packed]).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _keys(kind: str, first: int, passes: int):
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def keys(packed: pd.Series) -> pd.Series:
        """One sorting key per pass: the signs of BITS random projections, the first one leading."""
        out: list = [None] * len(packed)
        sizes = packed.map(len).to_numpy()
        weights = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            x = _unit(packed.iloc[at], kind)
            found = []
            for turn in range(first, first + passes):
                planes = np.random.default_rng([_SEED, turn, x.shape[1]]).standard_normal((x.shape[1], BITS))
                found.append(((x @ planes) > 0) @ weights)
            for row, values in zip(at, np.column_stack(found), strict=True):
                out[row] = values
        return pd.Series(out)

    return keys


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row reachable from each of ``n`` rows by the pairs."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (root == before).all():
            return root


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading signs that the keys share."""
    x = a ^ b
    high = x >> 31
    return BITS - np.where(high > 0, 31 + np.frexp(high.astype(np.float64))[1], np.frexp(x.astype(np.float64))[1])


def _window_links(kind: str, threshold: float):
    def link(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Verified pairs within WINDOW places, as edges to one member of each cluster of the block.

        Rows with a depth in place of v tell how many leading signs u shares
        with the row just outside its window.
        """
        for block in groups_of(batches, "block"):
            found_a, found_b, outside = [], [], []
            node, sign = block["node"].to_numpy(), block["sign"].to_numpy(np.int64)
            same = block["turn"].to_numpy() * (1 << 20) + block["vector"].map(len).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(same)) + 1).tolist(), len(block)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                x = _unit(block["vector"].iloc[low:high], kind)
                for d in range(1, min(WINDOW, len(x) - 1) + 1):
                    at = np.flatnonzero(np.einsum("ij,ij->i", x[:-d], x[d:]) >= threshold) + low
                    found_a.append(at)
                    found_b.append(at + d)
                if high - low > WINDOW + 1:
                    depth = _shared(sign[low : high - WINDOW - 1], sign[low + WINDOW + 1 : high])
                    most = np.full(high - low, -1)
                    most[: len(depth)] = depth
                    most[WINDOW + 1 :] = np.maximum(most[WINDOW + 1 :], depth)
                    at = np.flatnonzero(most >= 0)
                    turns = block["turn"].to_numpy()[low + at]
                    outside.append(pd.DataFrame({"u": node[low + at], "turn": turns, "depth": most[at]}))
            if outside:
                yield pd.concat(outside, ignore_index=True).assign(v=None)[["u", "v", "turn", "depth"]]
            if not found_a:
                continue
            u, v = _stars(len(block), np.concatenate(found_a), np.concatenate(found_b))
            if len(u):
                edges = pd.DataFrame({"u": node[u], "v": node[v]}).drop_duplicates()
                yield edges.assign(turn=None, depth=None)

    return link


def _stars(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each of ``n`` rows that the pairs reach to the smallest row reached."""
    root = _roots(n, a, b)
    used = np.flatnonzero(root != np.arange(n))
    return used, root[used]


def _exact_links(kind: str, threshold: float):
    def link(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """All pairs of a piece, or of two pieces with one another, as edges to one member of each cluster."""
        for group in groups_of(batches, "bucket"):
            side, node = group["side"].to_numpy(), group["node"].to_numpy()
            across = bool(group["across"].iloc[0])
            sizes = group["vector"].map(len).to_numpy()
            u = v = np.zeros(0, np.int64)
            for size in np.unique(sizes):
                here = np.flatnonzero((sizes == size) & ((side == 0) | (not across)))
                there = np.flatnonzero((sizes == size) & (side == 1)) if across else here
                if not len(here) or not len(there):
                    continue
                y = _unit(group["vector"].iloc[there], kind)
                for low in range(0, len(here), STRIP):
                    strip = here[low : low + STRIP]
                    i, j = np.nonzero(_unit(group["vector"].iloc[strip], kind) @ y.T >= threshold)
                    u, v = _stars(len(group), np.concatenate([u, strip[i]]), np.concatenate([v, there[j]]))
            if len(u):
                yield pd.DataFrame({"u": node[u], "v": node[v]})

    return link


def _counted_links(kind: str, threshold: float):
    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Copies linked with each member of a component's block, or of two blocks with one another."""
        for group in groups_of(batches, "bucket"):
            side, copies = group["side"].to_numpy(), group["copies"].to_numpy(np.int64)
            sizes = group["vector"].map(len).to_numpy()
            links = np.zeros(len(group), np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                x = _unit(group["vector"].iloc[at], kind)
                near = x @ x.T >= threshold
                np.fill_diagonal(near, False)
                if group["across"].iloc[0]:
                    near &= side[at][:, None] != side[at][None, :]
                links[at] = near @ copies[at]
            yield pd.DataFrame({"node": group["node"], "links": links})[links > 0]

    return count


def _passed(rows: DataFrame, kind: str, threshold: float, first: int, passes: int) -> DataFrame:
    """(u, v, turn, depth) of the passes from ``first`` on over ``rows`` (node, vector)."""
    turns = F.posexplode(_keys(kind, first, passes)(F.col("vector"))).alias("turn", "sign")
    ordered = global_row_number(rows.select("node", "vector", turns), [F.length("vector"), "turn", "sign", "node"], "place")
    block = F.floor(F.col("place") / F.lit(BLOCK)).cast("bigint")
    ahead = F.col("place") % F.lit(BLOCK) >= F.lit(BLOCK - WINDOW - 1)
    blocks = F.when(ahead, F.array(block, block + 1)).otherwise(F.array(block))
    placed = ordered.select("node", "vector", "turn", "sign", "place", F.explode(blocks).alias("block"))
    return written(
        placed.repartition("block").sortWithinPartitions("block", "place").mapInPandas(
            _window_links(kind, threshold), "u bigint, v bigint, turn int, depth int"
        ),
        "vec-windows",
    )


def _compared(rows: DataFrame, kind: str, threshold: float) -> DataFrame:
    """(u, v) of all pairs among ``rows``, block by block."""
    pieces = max(1, math.ceil(rows.count() / PIECE))
    own = F.pmod(F.xxhash64("node"), F.lit(pieces)).cast("int")
    dealt = F.transform(
        F.sequence(F.lit(0), F.lit(pieces - 1)),
        lambda x: F.struct(
            (F.least(own, x).cast("bigint") * pieces + F.greatest(own, x)).alias("bucket"),
            (own != x).alias("across"),
            (own > x).cast("int").alias("side"),
        ),
    )
    members = rows.select("node", "vector", F.explode(dealt).alias("d")).select("node", "vector", "d.*")
    members = members.repartition("bucket").sortWithinPartitions("bucket", "node")
    return members.mapInPandas(_exact_links(kind, threshold), "u bigint, v bigint")


def _links(sets: DataFrame, kind: str, threshold: float) -> DataFrame:
    """(u, v): edges of the passes, and of the exact comparison of rows that the passes leave in a crowd.

    A partner that shares more signs with a row than the first rows outside its
    window do has met it. With ``depth`` signs shared there, a pass misses a
    partner at the threshold with 1 - agree ** (depth + 1); the product over the
    passes tells which rows are settled. A pair is settled with either end, so
    only the others go through further passes, and what these no longer halve is
    compared exactly.
    """
    agree = 1 - math.acos(threshold) / math.pi
    todo, n, first, edges = sets.select("node", "vector", F.lit(0.0).alias("missed")), sets.count(), 0, None
    while True:
        passes = passes_for(n, threshold)
        out = _passed(todo, kind, threshold, first, passes)
        first += passes
        now = out.where("v IS NOT NULL").select("u", "v")
        edges = now if edges is None else edges.unionByName(now)
        met = F.when(F.col("depth") >= BITS, 0.0).otherwise(F.pow(F.lit(agree), F.col("depth") + 1))
        missed = (
            out.where("depth IS NOT NULL")
            .groupBy(F.col("u").alias("node"), "turn")
            .agg(F.max("depth").alias("depth"))
            .groupBy("node")
            .agg(F.sum(F.log1p(-met)).alias("more"), F.count(F.lit(1)).alias("turns"))
            .where(F.col("turns") == passes)  # a pass with no row outside the window has compared all
        )
        left = written(
            todo.join(missed, "node")
            .select("node", "vector", (F.col("missed") + F.col("more")).alias("missed"))
            .where(F.col("missed") > math.log(1 - (CROWD_RECALL if first > passes else RECALL))),
            "vec-crowd",
        )
        m = left.count()
        if not m:
            return edges
        if m <= BLOCK or (first > passes and 2 * m > n):
            return edges.unionByName(_compared(left, kind, threshold))
        todo, n = left, m


def near_vectors(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per vector: its links, its component, whether it stays.

    Columns: vec_id, n_links (other vectors of cosine ``threshold`` or more),
    component_id (smallest vec_id reachable by links), kept (vec_id =
    component_id). Equal vectors stand for one. In each pass the vectors are
    ordered by the concatenated signs of random projections; every vector is
    compared, in double precision, with the WINDOW neighbours on each side, and
    the pairs that hold are united across passes. The number of passes follows
    from the number of vectors; vectors whose windows are crowded take further
    passes, and what these do not settle is compared exactly (``_links``). Each
    component is then compared exactly, block by block, which counts links that
    no window held; pairs never leave a task.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components
    link with nothing, and vectors of different length not with each other.
    Repeated rows are copies; an empty table gives no rows.
    """
    single = isinstance(table.schema[vector].dataType, T.ArrayType) and isinstance(
        table.schema[vector].dataType.elementType, T.FloatType
    )
    kind = "<f4" if single else "<f8"
    rows = table.select(F.col(f"`{key}`").alias("vec_id"), _packer(single)(F.col(f"`{vector}`")).alias("vector"))
    base = written(rows.withColumn("same", F.md5("vector")), "vec-base")
    distinct = base.where("vector IS NOT NULL").groupBy("vector").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )
    sets = written(distinct.withColumn("node", F.monotonically_increasing_id()), "vec-sets")
    linked = written(components(_links(sets, kind, threshold), "vec-components"), "vec-linked")
    sizes = linked.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    pieces = F.ceil(F.col("size") / F.lit(BLOCK // 2)).cast("int")
    own = F.pmod(F.xxhash64("node"), pieces).cast("int")
    dealt = F.transform(
        F.sequence(F.lit(0), pieces - 1),
        lambda x: F.struct(
            F.concat_ws(":", "component", F.least(own, x), F.greatest(own, x)).alias("bucket"),
            (own != x).alias("across"),
            (own > x).cast("int").alias("side"),
        ),
    )
    members = linked.join(sizes, "component").select("node", F.explode(dealt).alias("d")).select("node", "d.*")
    counted = (
        members.join(sets.select("node", "vector", "copies"), "node")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "node")
        .mapInPandas(_counted_links(kind, threshold), "node bigint, links bigint")
        .groupBy("node")
        .agg(F.sum("links").alias("links"))
    )
    least = F.min("rep").over(Window.partitionBy("component"))
    named = sets.join(linked, "node").select("node", least.alias("component_id"))
    per_set = (
        sets.select("node", F.md5("vector").alias("same"), "rep", "copies")
        .join(named, "node", "left")
        .join(counted, "node", "left")
        .select("same", "copies", F.coalesce("component_id", "rep").alias("component_id"), "links")
    )
    component = F.coalesce("component_id", "vec_id")
    links = F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))
    return base.join(per_set, "same", "left").select(
        "vec_id",
        links.cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
