"""Jaccard join of word shingles by the chosen-path method."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwarden.llm import shingles
from driftwarden.llm.common import columns_of, components, groups_of, may_hold, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

THRESHOLD = 0.8
#: Sampled tokens of a set (least shingles under so many hashes), and how often the splitting starts anew.
TOKENS, RUNS = 128, 10
#: Sets up to which a bucket is compared by brute force; splits of a larger one before it is compared in blocks.
SMALL, DEPTH = 2048, 3
#: Sketches agree in at least this share for any pair that is verified: five standard deviations below the threshold.
SKETCHED = THRESHOLD - 5 * (THRESHOLD * (1 - THRESHOLD) / TOKENS) ** 0.5
_SEEDS = np.random.default_rng(5)
_MULTIPLIERS = _SEEDS.integers(1, 1 << 32, TOKENS, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _SEEDS.integers(0, 1 << 32, TOKENS, dtype=np.uint32)
_UNDONE = np.array([pow(int(m), -1, 1 << 32) for m in _MULTIPLIERS], np.uint32)
#: A token is taken for a path with probability 1 / (threshold x tokens): one in the mean for two sets at the threshold.
_CHANCE = np.uint64(int(2**64 / (THRESHOLD * TOKENS)))


def words_of(text: str | None) -> list[str]:
    """Lower-case words between white space."""
    return (text or "").lower().split()


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles."""
    return np.unique(shingles.shingle_hashes(shingles.word_hashes(words_of(text))))


def _folded(members: np.ndarray) -> np.ndarray:
    return (members >> np.uint64(32)).astype(np.uint32) ^ members.astype(np.uint32)


def tokens_of(members: np.ndarray) -> np.ndarray:
    """The least member of a set under each of TOKENS hashes."""
    low = _folded(members)
    best = np.full(TOKENS, np.uint32(0xFFFFFFFF))
    for at in range(0, len(low), 2048):
        mixed = low[at : at + 2048, None] * _MULTIPLIERS[None, :] + _SHIFTS[None, :]
        mixed ^= mixed >> np.uint32(15)
        best = np.minimum(best, mixed.min(axis=0))
    return best


def named(members: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The members of a set that its tokens stand for, all 64 bits of them.

    Tokens are least numbers, so those of different members meet once in some
    10 million sets at a few hundred members each; members do not.
    """
    low = _folded(members)
    order = np.argsort(low, kind="stable")
    mixed = tokens ^ (tokens >> np.uint32(15)) ^ (tokens >> np.uint32(30))
    return members[order[np.searchsorted(low, (mixed - _SHIFTS) * _UNDONE, sorter=order)]]


def packed(tokens: np.ndarray) -> bytes:
    """Tokens as bytes, the lowest byte of all of them first: these TOKENS bytes are the set's sketch."""
    return tokens.view(np.uint8).reshape(TOKENS, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, TOKENS).T.copy().view(np.uint32).ravel()


def extended(path: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Children of each path: the tokens that a hash of path and token chooses. All sets choose alike."""
    named = shingles.scramble((np.arange(TOKENS, dtype=np.uint64) << np.uint64(32)) + tokens.astype(np.uint64))
    mixed = shingles.scramble(path[:, None] ^ named[None, :])
    taken = mixed < _CHANCE
    return shingles.scramble(mixed[taken] + np.uint64(1))


_ROOTS = shingles.scramble(np.arange(1, RUNS + 1, dtype=np.uint64))


_SIGNED = (
    T.StructType()
    .add("key", T.BinaryType())
    .add("n", T.IntegerType())
    .add("tokens", T.BinaryType())
    .add("paths", T.ArrayType(T.LongType()))
)


@F.pandas_udf(_SIGNED)
def _signed(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        words = words_of(text)
        if not words:
            rows.append((None, 0, None, None))
            continue
        members = np.unique(shingles.shingle_hashes(shingles.word_hashes(words)))
        tokens = tokens_of(members)
        key = hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass")).digest()
        paths = extended(_ROOTS, named(members, tokens)).view(np.int64)
        rows.append((key, len(members), packed(tokens), paths))
    return pd.DataFrame(rows, columns=["key", "n", "tokens", "paths"])


@F.pandas_udf(T.ArrayType(T.LongType()))
def _children(path: pd.Series, tokens: pd.Series) -> pd.Series:
    return pd.Series(
        [
            extended(np.array([p], np.int64).view(np.uint64), unpacked(t)).view(np.int64)
            for p, t in zip(path, tokens, strict=True)
        ]
    )


def likely_pairs(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one bucket whose sketches agree and that meet in no bucket of a smaller name.

    So a pair is taken up once, however many buckets it shares.
    """
    g = len(group)
    none = np.zeros(0, np.int64)
    if g < 2:
        return none, none
    sketch = np.stack([np.frombuffer(t, np.uint8) for t in group["sketch"]])
    least = int(np.ceil(SKETCHED * TOKENS))
    close = np.zeros((g, g), bool)
    for i in range(g - 1):
        close[i, i + 1 :] = (sketch[i + 1 :] == sketch[i]).sum(axis=1) >= least
    side = group["side"].to_numpy()
    if side.any():
        close &= side[:, None] != side[None, :]
    if not close.any():
        return none, none
    here = int(group["path"].iloc[0])
    near = np.flatnonzero(close.any(axis=0) | close.any(axis=1))
    earlier = [np.asarray(group["paths"].iloc[i]) for i in near]
    earlier = [p[p < here] for p in earlier]
    names, column = np.unique(np.concatenate(earlier), return_inverse=True)
    if len(names):
        holds = np.zeros((len(near), len(names)), np.float32)
        holds[np.repeat(np.arange(len(near)), [len(p) for p in earlier]), column] = 1
        block = close[np.ix_(near, near)] & ((holds @ holds.T) == 0)
        close[np.ix_(near, near)] = block
    a, b = np.nonzero(close)
    return a, b


def _verified(group: pd.DataFrame, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs have a Jaccard similarity of THRESHOLD or more, exactly."""
    used = np.unique(np.concatenate([a, b]))
    sets = {i: shingle_set(group["text"].iloc[i]) for i in used}
    if len(a) <= 4 * len(used) + 64:
        shared = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a, b, strict=True)])
    else:
        # Common members by a matrix product, a few thousand members at a time.
        of, values = np.repeat(np.arange(len(used)), [len(sets[i]) for i in used]), np.concatenate([sets[i] for i in used])
        _, column, count = np.unique(values, return_inverse=True, return_counts=True)
        keep = count[column] > 1
        of, column = of[keep], np.unique(column[keep], return_inverse=True)[1]
        both = np.zeros((len(used), len(used)), np.float32)
        order = np.argsort(column, kind="stable")
        of, column = of[order], column[order]
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            x, y = np.searchsorted(column, [low, low + 4096])
            held = np.zeros((len(used), 4096), np.float32)
            held[of[x:y], column[x:y] - low] = 1
            both += held @ held.T
        shared = both[np.searchsorted(used, a), np.searchsorted(used, b)]
    size = np.zeros(len(group))
    size[used] = [len(sets[i]) for i in used]
    return shared >= THRESHOLD * (size[a] + size[b] - shared) - 1e-9


def _taken_up(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Members of each bucket that have a likely pair in it."""
    for group in groups_of(batches, "bucket"):
        a, b = likely_pairs(group)
        if len(a):
            used = np.unique(np.concatenate([a, b]))
            yield group[["bucket", "path", "side", "node"]].iloc[used]


def _linked(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per bucket and member: copies of the sets it is linked with, and one member of its cluster."""
    for group in groups_of(batches, "bucket"):
        a, b = likely_pairs(group)
        if not len(a):
            continue
        good = _verified(group, a, b)
        a, b = a[good], b[good]
        if not len(a):
            continue
        copies, node = group["copies"].to_numpy(np.int64), group["node"].to_numpy(np.int64)
        links = np.zeros(len(group), np.int64)
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        root = np.arange(len(group))
        while True:
            before = root.copy()
            np.minimum.at(root, a, root[b])
            np.minimum.at(root, b, root[a])
            root = root[root]
            if (root == before).all():
                break
        used = np.flatnonzero(links)
        yield pd.DataFrame({"node": node[used], "links": links[used], "root": node[root[used]]})


def _bucketed(leaves: DataFrame, sets: DataFrame) -> DataFrame:
    """Bucket rows sorted by bucket: a bucket above SMALL becomes one bucket for every pair of its blocks."""
    blocks = F.ceil(F.col("size") / F.lit(SMALL)).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    single = F.array(F.struct(F.col("path").alias("bucket"), F.lit(0).alias("side")))
    paired = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda x: F.struct(
            F.xxhash64("path", F.least(own, x), F.greatest(own, x)).alias("bucket"),
            F.when(own > x, 1).otherwise(0).alias("side"),
        ),
    )
    dealt = leaves.select("node", "path", F.explode(F.when(blocks > 1, paired).otherwise(single)).alias("d"))
    return dealt.select("node", "path", "d.bucket", "d.side").join(sets, "node")


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket").sortWithinPartitions("bucket", "node")


def near_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its class, its links, its exact copies.

    Columns: doc_id, class_id (smallest doc_id reachable by links), n_links
    (other documents with a shingle similarity of 0.8 or more), n_copies
    (documents with the same words, itself included), kept (doc_id = class_id),
    raw (md5 of the text).

    Documents with the same words in lower case are copies and stand for one
    set. A set is split off by paths: in each of RUNS rounds it takes the
    tokens that a hash chooses, so that similar sets choose the same ones; sets
    with a path in common share a bucket, and a bucket above SMALL sets is split
    by further tokens, DEPTH times at most. What is still larger (a group of
    near copies) is compared block by block, so no task holds more than two
    blocks. Buckets carry sketches; tokens stay with the documents' own rows,
    but for sets in a bucket to be split, and texts follow only to pairs with
    agreeing sketches. These are verified on whole shingle sets, in the one bucket of least name that both share, and leave the task as counts
    and cluster edges, never as pairs. A pair at the threshold shares no path
    of one step in all rounds with probability exp(-1)^10, of three steps with
    0.63^10: the recall aimed at is 0.99 or more.

    A text without words, NULL included, links with nothing; shorter texts than
    a shingle are one shingle; repeated rows are copies; an empty table gives no
    rows.
    """
    rows = columns_of(docs, doc_id=key, text=text)
    base = written(
        rows.select("doc_id", F.md5(F.col("text").cast("binary")).alias("raw"), _signed(F.col("text")).alias("s")).select(
            "doc_id", "raw", "s.*", F.monotonically_increasing_id().alias("node")
        ),
        "near-base",
    )
    counted = base.where("key IS NOT NULL").groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct(F.col("doc_id").isNull().alias("at"), "doc_id", "raw", "node")).alias("s"),
    )
    sets = written(
        counted.select("key", F.col("s.doc_id").alias("rep"), "copies", F.struct("s.doc_id", "s.raw").alias("who"), "s.node"),
        "near-sets",
    )
    leaves = _leaves(base, sets)
    of_node = leaves.groupBy("node").agg(F.collect_set("path").alias("paths"))  # some tens of numbers
    sketches = base.select("node", F.substring("tokens", 1, TOKENS).alias("sketch"))
    sketched = written(of_node.join(sketches, "node").join(sets.select("node", "copies"), "node"), "near-sketched")
    fields = "bucket bigint, path bigint, side int, node bigint"
    active = written(_sorted(_bucketed(leaves, sketched)).mapInPandas(_taken_up, fields), "near-active")
    asked = written(active.join(sketched, "node").join(sets.select("node", "who"), "node"), "near-asked")
    # Only the texts of documents that stand for a wanted set leave the place where they lie.
    marked = may_hold(
        rows.withColumn("who", F.struct("doc_id", F.md5(F.col("text").cast("binary")).alias("raw"))),
        F.xxhash64("who.doc_id", "who.raw"),
        asked.select("who").distinct().select(F.xxhash64("who.doc_id", "who.raw").alias("key")),
        "may",
    )
    texts = marked.where("may").select("who", "text").dropDuplicates(["who"])
    found = written(
        _sorted(asked.join(texts, "who").drop("who")).mapInPandas(_linked, "node bigint, links bigint, root bigint"),
        "near-links",
    )
    joined = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    placed = sets.select("node", "rep").join(joined, "node")
    least = placed.groupBy("component").agg(F.min("rep").alias("class_id"))
    classes = placed.join(least, "component").select("node", "class_id")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    per_set = (
        sets.select("node", "key", "rep", "copies").join(classes, "node", "left").join(links, "node", "left")
    ).select("key", "copies", F.coalesce("class_id", "rep").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))
    out = base.select("doc_id", "raw", "key").join(per_set, "key", "left")
    class_id = F.coalesce("class_id", "doc_id")
    return out.select(
        "doc_id",
        class_id.alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("bigint").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("bigint").alias("n_copies"),
        F.coalesce(class_id == F.col("doc_id"), F.lit(True)).alias("kept"),
        "raw",
    )


def _leaves(base: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, path, size) of the final buckets with two sets or more."""
    first = base.select("node", "paths").join(sets.select("node"), "node", "left_semi")
    now = first.select("node", F.explode("paths").alias("path"))
    done = []
    for depth in range(DEPTH):
        now = written(now, "near-paths")
        sizes = now.groupBy("path").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        sized = written(now.join(sizes, "path").select("node", "path", "size"), "near-sized")
        if depth == DEPTH - 1:
            done.append(sized)
            break
        done.append(sized.where(F.col("size") <= SMALL))
        large = sized.where(F.col("size") > SMALL)
        if large.isEmpty():
            break
        # Only the tokens of sets in a large bucket leave the place where they lie.
        node = F.xxhash64("node")
        held = may_hold(base.select("node", "tokens"), node, large.select("node").distinct().select(node.alias("key")), "may")
        now = large.join(held.where("may").select("node", "tokens"), "node").select(
            "node", F.explode(_children(F.col("path"), F.col("tokens"))).alias("path")
        )
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def distinct_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each class, all columns as they are; texts without words all stay.

    The document with the smallest id stays; of rows that repeat it, the one
    whose columns have the least hash, so that the choice does not depend on how
    the rows lie. Documents that a filter of the copied and linked ones does not
    mark stay where they lie; the others are joined.
    """
    result = written(near_documents(docs, key, text), "near-result")
    touched = result.where("NOT kept OR n_copies > 1").select(F.xxhash64("doc_id", "raw").alias("key"))
    found = result.where("kept").groupBy(F.col("doc_id").alias("__id"), F.col("raw").alias("__raw"))
    found = found.agg(F.max(F.col("n_copies") > 1).alias("__copied"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    mine = docs.withColumn("__md5", F.md5(F.col(f"`{text}`").cast("binary")))
    marked = may_hold(mine, F.xxhash64(F.col(f"`{key}`"), "__md5"), touched, "__may")
    joined = marked.where("__may").join(
        found, F.col(f"`{key}`").eqNullSafe(F.col("__id")) & F.col("__md5").eqNullSafe(F.col("__raw"))
    )
    again = Window.partitionBy("__id", "__raw").orderBy(F.xxhash64(*columns))
    alone = joined.where(~F.col("__copied")).select(*columns)
    first = joined.where("__copied").withColumn("__n", F.row_number().over(again)).where("__n = 1").select(*columns)
    return marked.where(~F.col("__may")).select(*columns).unionByName(alone).unionByName(first)
