"""The trained text model over more tokens than a driver can hold: its vocabulary is a table, its vectors lie in tasks.

Documents are coded in blocks, each with a dictionary of its own, so that what is shuffled is a line per block and word,
not per document and word. A group of blocks is one task, and what it is sent and sends is a number per word of the group. The regression is the one of Spark ML (multinomial, scaled and centred features, penalty on the
unscaled coefficients) with the same steps: L-BFGS with a strong Wolfe line search. The driver sees only products of the
search's vectors with each other; the vectors themselves are arrays in parts of the vocabulary. Classes sum to zero in every
vector, so the last one is not kept.
"""

from __future__ import annotations

import math
import pickle
import sys
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel, TaskContext, cloudpickle
from pyspark.ml import Transformer
from pyspark.ml.feature import RegexTokenizer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftwarden.common import scratch_path, shared_folder, swept, written
from driftwarden.operators.ordering import global_row_number
from driftwarden.operators.text_features import TOKEN, runs

# Send the helper functions themselves: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Tokens of a block, words of its blocks in a group, words of all blocks and coefficients in a part of the vocabulary.
_BLOCK_TOKENS, _GROUP_WORDS, _PART_WORDS, _PART_COEFFICIENTS = 1 << 21, 1 << 21, 1 << 19, 1 << 16
# A word's number in its part is below this bit, in a key the part's number lies above it.
_PART_BIT = 40
# Fixed values of Spark's regression: steps remembered, tolerance, values compared, line search.
_MEMORY, _TOLERANCE, _VALUES, _TRIES, _ARMIJO, _CURVATURE = 10, 1e-6, 20, 10, 1e-4, 0.9
# Iterations between two cuts of the lineage.
_CUT = 5
_ROW = "__row"
_CODED = "block bigint, words array<struct<token: string, local: int, df: bigint>>, ends binary, places binary, counts binary, tags binary"
_HELD, _SENT, _DOCS = "held", "sent", "docs"


def tokenizer(text: str) -> RegexTokenizer:
    return RegexTokenizer(inputCol=text, outputCol="tokens", pattern=TOKEN, gaps=False)


# ------------------------------------------------------------------------ blocks


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a tag and tokens as blocks of rows with a dictionary, and the places and counts of every row."""
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        tags, tokens = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
        sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        piece = np.cumsum(sizes) // _BLOCK_TOKENS
        starts = np.flatnonzero(np.diff(piece, prepend=-1))
        for a, b in zip(starts, [*starts[1:], len(sizes)]):
            yield _block(block, tags[a:b], tokens[a:b], sizes[a:b])
            block += 1


def _block(block: int, tags: np.ndarray, tokens: pa.Array, sizes: np.ndarray) -> pa.RecordBatch:
    found = tokens.flatten().dictionary_encode()
    words = len(found.dictionary)
    cells = np.repeat(np.arange(len(sizes)), sizes) * words
    cells += found.indices.to_numpy(zero_copy_only=False)
    cells.sort()
    first = np.flatnonzero(np.diff(cells, prepend=-1))
    counts = np.diff(first, append=len(cells)).astype(np.int32)
    cells = cells[first]
    rows, places = (cells // max(words, 1)).astype(np.int32), (cells % max(words, 1)).astype(np.int32)
    listed = pa.StructArray.from_arrays(
        [found.dictionary.cast(pa.string()), pa.array(np.arange(words, dtype=np.int32)), pa.array(np.bincount(places, minlength=words).astype(np.int64))],
        ["token", "local", "df"],
    )
    binaries = [np.cumsum(np.bincount(rows, minlength=len(sizes))).astype(np.int64), places, counts, tags]
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.ListArray.from_arrays(np.array([0, words], np.int32), listed)]
        + [pa.array([a.tobytes()], pa.binary()) for a in binaries],
        ["block", "words", "ends", "places", "counts", "tags"],
    )


def _entries(line: dict, known: np.ndarray, weights: np.ndarray, sublinear: bool) -> dict:
    """The known words of a block: rows, codes, levels of counts with their weights, and the lengths of the rows."""
    ends, places = np.frombuffer(line["ends"], np.int64), np.frombuffer(line["places"], np.int32)
    rows = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    code = np.full(max(places.max(initial=-1), known.max(initial=-1)) + 1, -1)
    code[known] = np.arange(len(known))
    kept = code[places] >= 0
    rows, codes = rows[kept], code[places[kept]]
    levels, counts = np.unique(np.frombuffer(line["counts"], np.int32)[kept], return_inverse=True)
    damped = 1.0 + np.log(levels) if sublinear else levels.astype(float)
    raw = damped[counts] * weights[codes]
    length = np.sqrt(np.bincount(rows, raw * raw, len(ends)))
    return {
        "ends": np.cumsum(np.bincount(rows, minlength=len(ends))),
        "codes": codes.astype(np.int32),
        "counts": counts.astype(np.min_scalar_type(len(levels))),
        "levels": damped,
        "weights": weights,
        "lengths": np.where(length > 0, length, 1.0),
    }


def _rows(x: dict) -> np.ndarray:
    return np.repeat(np.arange(len(x["ends"])), np.diff(x["ends"], prepend=0))


def _times(x: dict, values: np.ndarray) -> np.ndarray:
    """Rows times ``values`` (words x columns)."""
    rows, damped, weighted = _rows(x), x["levels"][x["counts"]], values * x["weights"][:, None]
    sums = [np.bincount(rows, damped * column[x["codes"]], len(x["ends"])) for column in weighted.T]
    return np.stack(sums, axis=1) / x["lengths"][:, None]


def _transposed_times(x: dict, values: np.ndarray) -> np.ndarray:
    """Words times ``values`` (rows x columns)."""
    rows, damped, scaled = _rows(x), x["levels"][x["counts"]], values / x["lengths"][:, None]
    sums = [np.bincount(x["codes"], damped * column[rows], len(x["weights"])) for column in scaled.T]
    return np.stack(sums, axis=1) * x["weights"][:, None]


def _moments(x: dict) -> np.ndarray:
    """Per word the number, mean and squared deviations of its values, exact for a word whose values are all the same."""
    codes, words = x["codes"], len(x["weights"])
    values = x["levels"][x["counts"]] * x["weights"][codes] / x["lengths"][_rows(x)]
    first = np.zeros(words)
    first[codes[::-1]] = values[::-1]
    apart = values - first[codes]
    n = np.bincount(codes, minlength=words)
    total = np.bincount(codes, apart, words)
    return np.stack([n, first + total / n, np.maximum(np.bincount(codes, apart * apart, words) - total * total / n, 0.0)], axis=1)


def _merge(total: np.ndarray, at: np.ndarray, moments: np.ndarray) -> None:
    (count, mean, apart), (more, other, beside) = total[at].T, moments.T
    delta, both = other - mean, count + more
    total[at] = np.stack([both, mean + delta * more / both, apart + beside + delta * delta * count * more / both], axis=1)


def _add(total: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    total[at] += values


# ------------------------------------------------------------------------ parts


def _keys(parts: int, place: np.ndarray) -> np.ndarray:
    """Places in the order of the parts they lie in."""
    return (place % parts) << _PART_BIT | place // parts


def _linked(parts: int, links: pa.Table) -> pa.Table:
    """One part of the vocabulary: the positions of its words that each group holds."""
    group, place = (links.column(c).to_numpy() for c in ("group", "place"))
    cells = np.unique(group << _PART_BIT | place // parts)
    groups, starts = np.unique(cells >> _PART_BIT, return_index=True)
    positions = np.split((cells & ((1 << _PART_BIT) - 1)).astype(np.int32), starts[1:])
    held = pickle.dumps(dict(zip(groups.tolist(), positions)), 5)
    return pa.table({"part": pa.array([int(place[0]) % parts], pa.int64()), "held": pa.array([held], pa.binary())})


def _listed(parts: int, links: pa.Table) -> pa.Table:
    """The keys of the words of a group, in order."""
    held = np.unique(_keys(parts, links.column("place").to_numpy())).tobytes()
    return pa.table({"group": pa.array([links.column("group")[0].as_py()], pa.int64()), "held": pa.array([held], pa.binary())})


def _matrix(parts: int, sublinear: bool, coded: pa.Table, links: pa.Table) -> pa.Table:
    """A block over the known words, in the order of their keys."""
    line = coded.to_pylist()[0]
    keys = _keys(parts, links.column("place").to_numpy())
    order = np.argsort(keys)
    x = _entries(line, links.column("local").to_numpy()[order], links.column("weight").to_numpy()[order], sublinear)
    x |= {"block": line["block"], "keys": keys[order], "labels": np.frombuffer(line["tags"], float).astype(np.int64)}
    return pa.table({"group": pa.array([line["group"]], pa.int64()), "held": pa.array([pickle.dumps(x, 5)], pa.binary())})


def _placed(parts: int) -> Callable:
    """Blocks with the places of their words among those of the group, and where the group's words of every part begin."""

    def use(items: Iterator) -> Iterator[tuple]:
        for group, held, _, sent in _met(items):
            listed = np.frombuffer(sent[group][0][0], np.int64) if group in sent else np.zeros(0, np.int64)
            x = pickle.loads(held)
            x["at"] = np.searchsorted(listed, x.pop("keys")).astype(np.int32)
            x["cuts"] = np.searchsorted(listed, np.arange(parts + 1) << _PART_BIT)
            yield group, (_HELD, x)

    return use


def _over(use: Callable, *sides: RDD) -> RDD:
    """Partitions that lie over each other as one stream, so that only what was sent has moved; what is small comes first."""
    one = sides[0]
    for side in sides[1:]:
        one = one.union(side)
    return one.mapPartitions(use, preservesPartitioning=True)


def _sent(rdd: RDD, tasks: int) -> RDD:
    """Dealt by key. What arrives are pickled lists like those of any other RDD; said so, a union need not write them anew."""
    out = rdd.partitionBy(tasks)
    out._jrdd_deserializer = rdd.ctx.serializer
    return out


def _kept(rdd: RDD) -> RDD:
    return rdd.persist(StorageLevel.DISK_ONLY)


def _met(items: Iterator) -> Iterator[tuple]:
    """Key and held value, and all document states and what was sent by key, of a stream that ends with the held values."""
    sent, docs = defaultdict(list), {}
    for key, (kind, *value) in items:
        if kind == _SENT:
            sent[key].append(value)
        elif kind == _DOCS:
            docs[value[0]] = value[1:]
        else:
            yield key, value[0], docs, sent


def _summed(items: Iterator, of: Callable, into: Callable, columns: int) -> Iterator[tuple]:
    """To every part what ``of`` gives for the words of its blocks, put together for a group."""
    totals = {}
    for group, x, docs, _ in _met(items):
        _, total = totals.setdefault(group, (x["cuts"], np.zeros((x["cuts"][-1], columns))))
        into(total, x["at"], of(x, docs))
    for group, (cuts, total) in totals.items():
        for part in np.flatnonzero(np.diff(cuts)).tolist():
            yield part, (_SENT, group, total[cuts[part] : cuts[part + 1]])


def _received(sent: list) -> list:
    """In the order of the senders."""
    return sorted(sent, key=lambda v: v[0])


def _scaled(n: int, columns: int) -> Callable:
    """Parts with the scale and shift of their words, from the moments that the groups have sent."""

    def use(items: Iterator) -> Iterator[tuple]:
        for part, links, _, sent in _met(items):
            size = 1 + max(int(p.max()) for p in links.values())
            total = np.zeros((size, 3))
            for group, moments in _received(sent.pop(part)):
                _merge(total, links[group], moments)
            count, mean, apart = total.T
            variance = (apart + mean * mean * count * (n - count) / n) / max(n - 1, 1)
            inverse = np.divide(1.0, np.sqrt(variance), out=np.zeros(size), where=variance > 0)
            state = {"links": links, "inverse": inverse, "shift": mean * count / n * inverse, "s": [], "y": []}
            yield part, (_HELD, state | {"w": np.zeros((size, columns)), "g": None})

    return use


def _directed(coefficients: np.ndarray) -> Callable:
    """To every group its words' share in the next direction, a sum of the search's vectors."""

    def use(items: Iterator) -> Iterator[tuple]:
        for part, (_, state) in items:
            values = np.tensordot(coefficients, _basis(state), 1) * state["inverse"][:, None]
            for group, at in state["links"].items():
                yield group, (_SENT, part, values[at])

    return use


def _moved(step: float, intercept: np.ndarray) -> Callable:
    """Margins after the last step, and along the next direction."""

    def use(items: Iterator) -> Iterator[tuple]:
        shares = {}
        for group, x, docs, sent in _met(items):
            if group not in shares:
                shares[group] = np.concatenate([np.zeros((0, len(intercept))), *(v for _, v in _received(sent.pop(group, [])))])
            labels, margins, along = docs.pop(x["block"])
            yield group, (_DOCS, x["block"], labels, margins + step * along, _times(x, shares[group][x["at"]]) + intercept)

    return use


def _residuals(labels: np.ndarray, margins: np.ndarray) -> tuple[float, np.ndarray]:
    """Loss, and per row and kept class the probability less the label."""
    every = np.hstack([margins, -margins.sum(axis=1, keepdims=True)])
    every -= every.max(axis=1, keepdims=True)
    shares = np.exp(every)
    total = shares.sum(axis=1)
    row = np.arange(len(labels))
    loss = float((np.log(total) - every[row, labels]).sum())
    shares /= total[:, None]
    shares[row, labels] -= 1.0
    return loss, shares[:, :-1]


def _tried(step: float) -> Callable:
    def use(item: tuple) -> tuple:
        _, (_, block, labels, margins, along) = item
        loss, apart = _residuals(labels, margins + step * along)
        return block, loss, float((apart * along).sum() + (apart.sum(axis=1) * along.sum(axis=1)).sum()), apart.sum(axis=0)

    return use


def _gradients(step: float, columns: int) -> Callable:
    def of(x: dict, docs: dict) -> np.ndarray:
        labels, margins, along = docs.pop(x["block"])
        return _transposed_times(x, _residuals(labels, margins + step * along)[1])

    return lambda items: _summed(items, of, _add, columns)


def _updated(step: float, coefficients: np.ndarray | None, intercept: np.ndarray, n: int, penalty: float, memory: int) -> Callable:
    """Parts after a step along the direction: point, gradient and the steps remembered."""

    def use(items: Iterator) -> Iterator[tuple]:
        for part, old, _, sent in _met(items):
            total = np.zeros_like(old["w"])
            for group, values in _received(sent.pop(part)):
                total[old["links"][group]] += values
            new = dict(old)
            moved = None if coefficients is None else step * np.tensordot(coefficients, _basis(old), 1)
            if moved is not None:
                new["w"] = old["w"] + moved
            inverse = old["inverse"][:, None]
            new["g"] = inverse * total / n - old["shift"][:, None] * intercept + penalty * inverse * inverse * new["w"]
            if moved is not None:
                new["s"] = [moved, *old["s"][:memory]][:_MEMORY]
                new["y"] = [new["g"] - old["g"], *old["y"][:memory]][:_MEMORY]
            yield part, (_HELD, new)

    return use


def _basis(state: dict) -> np.ndarray:
    return np.stack([state["w"], state["g"], *state["s"], *state["y"]])


def _over_classes(vectors: np.ndarray) -> np.ndarray:
    """What the vectors are multiplied by for products over all classes, the last one being less the sum of the others."""
    return vectors + vectors.sum(axis=-1, keepdims=True)


def _products(item: tuple) -> tuple:
    """Products of the vectors of a part, the same with the penalty's weights, and the margins' shift."""
    part, (_, state) = item
    basis = _basis(state)
    flat, over = basis.reshape(len(basis), -1), _over_classes(basis).reshape(len(basis), -1).T
    curved = (basis * state["inverse"][None, :, None] ** 2).reshape(len(basis), -1)
    return part, flat @ over, curved @ over, np.tensordot(basis, state["shift"], axes=([1], [0]))


# ------------------------------------------------------------------------ search


class _SearchError(Exception):
    """No step was found; the steps remembered are dropped once."""


def _direction(products: np.ndarray, history: int) -> np.ndarray:
    """L-BFGS's direction as coefficients over point, gradient, steps and differences of gradients."""
    unit = np.eye(len(products))
    steps, changes = unit[2 : 2 + history], unit[2 + history :]
    out, scale, shares = unit[1].copy(), 1.0, []
    with np.errstate(divide="ignore", invalid="ignore"):
        if history:
            curvature = steps[0] @ products @ changes[0]
            if curvature < 0 or math.isnan(curvature):
                raise _SearchError
            scale = curvature / (changes[0] @ products @ changes[0])
        for s, y in zip(steps, changes):
            shares.append((s @ products @ out) / (s @ products @ y))
            if math.isnan(shares[-1]):
                raise _SearchError
            out = out - shares[-1] * y
        out = out * scale
        for s, y, share in list(zip(steps, changes, shares))[::-1]:
            out = out + (share - (y @ products @ out) / (s @ products @ y)) * s
    return -out


def _line_search(phi: Callable[[float], tuple[float, float]], start: tuple[float, float], t: float) -> float:
    """A step that satisfies the strong Wolfe conditions, by cubic interpolation."""
    value, slope = start
    if slope > 0:
        raise _SearchError

    def between(a: tuple, b: tuple) -> float:
        (left, fl, dl), (right, fr, dr) = sorted((a, b))
        d1 = dl + dr - 3 * (fl - fr) / (left - right)
        inside = d1 * d1 - dl * dr
        d2 = math.sqrt(inside) if inside >= 0 else math.nan
        width = right - left
        with np.errstate(divide="ignore", invalid="ignore"):
            out = float(right - width * np.float64(dr + d2 - d1) / (dr - dl + 2 * d2))
        return left + 0.1 * width if out < left + 0.1 * width else left + 0.9 * width if out > left + 0.9 * width else out

    def zoom(low: tuple, high: tuple) -> float:
        for _ in range(_TRIES):
            at = between(low, high)
            found = (at, *phi(at))
            if found[1] > value + _ARMIJO * at * slope or found[1] >= low[1]:
                high = found
                continue
            if abs(found[2]) <= _CURVATURE * abs(slope):
                return at
            if found[2] * (high[0] - low[0]) >= 0:
                high = low
            low = found
        raise _SearchError

    low = (0.0, value, slope)
    for i in range(_TRIES):
        found = (t, *phi(t))
        if not math.isfinite(found[1]):
            t /= 2.0
            continue
        if found[1] > value + _ARMIJO * t * slope or (found[1] >= low[1] and i > 0):
            return zoom(low, found)
        if abs(found[2]) <= _CURVATURE * abs(slope):
            return t
        if found[2] >= 0:
            return zoom(found, low)
        low, t = found, t * 1.5
    raise _SearchError


@dataclass
class _Fitted:
    parts: RDD
    intercepts: np.ndarray
    values: list[float]


def _minimised(spark: SparkSession, x: RDD, parts: RDD, labels: np.ndarray, max_iter: int, penalty: float) -> _Fitted:
    """The mean loss's minimum over the coefficients, by the steps of Spark's regression from the classes' shares."""
    n, columns, tasks, pieces = int(labels.sum()), len(labels) - 1, x.getNumPartitions(), parts.getNumPartitions()
    start = np.log1p(labels)
    point = (start - start.mean())[:-1]
    intercepts = [point]

    def begun(item: tuple) -> tuple:
        group, (_, held) = item
        return group, (_DOCS, held["block"], held["labels"], *(np.tile(v, (len(held["labels"]), 1)) for v in (point, 0 * point)))

    docs = _kept(x.map(begun, preservesPartitioning=True))

    def tried(step: float) -> tuple[float, float, np.ndarray]:
        found = sorted(docs.map(_tried(step)).collect(), key=lambda v: v[0])
        return tuple(sum(v[i] for v in found) / n for i in (1, 2, 3))

    def update(step: float, direction: np.ndarray | None, total: np.ndarray, memory: int, cut: bool) -> list[np.ndarray]:
        nonlocal parts
        sent = _sent(_over(_gradients(step, columns), docs, x), pieces)
        old, parts = parts, _kept(_over(_updated(step, direction, total, n, penalty, memory), sent, parts))
        if cut:
            parts.checkpoint()
        found = sorted(parts.map(_products).collect(), key=lambda v: v[0])
        old.unpersist()
        if cut:
            swept(spark)
        return [sum(v[i] for v in found) for i in (1, 2, 3)]

    value, _, total = tried(0.0)
    products, curved, shift = update(0.0, None, total, 0, False)
    intercepts = [point, total]
    step, history, iteration, values, recent, failed = 0.0, 0, 0, [value], [math.inf], False
    while True:
        over = np.array(intercepts)
        both = products + over @ _over_classes(over).T
        size = math.sqrt(both[1, 1])
        near = len(recent) >= 2 and abs(value - max(recent)) <= _TOLERANCE * abs(values[0])
        if iteration >= max_iter or near or size <= max(_TOLERANCE * abs(value), 1e-8):
            break
        try:
            direction = _direction(both, history)
            old, along = docs, direction @ over
            sent = _sent(parts.mapPartitions(_directed(direction)), tasks)
            docs = _kept(_over(_moved(step, along - direction @ shift), sent, docs, x))
            step, cut = 0.0, iteration % _CUT == _CUT - 1
            if cut:
                docs.checkpoint()
            bent, flat, still = (a @ curved @ b for a, b in ((direction, direction), (np.eye(len(both))[0], direction), (np.eye(len(both))[0],) * 2))
            seen = {}

            def phi(t: float) -> tuple[float, float]:
                loss, slope, rest = tried(t)
                seen[t] = loss + penalty * (still / 2 + t * flat + t * t * bent / 2), rest
                return seen[t][0], slope + penalty * (flat + t * bent)

            first = 1.0 if iteration else 1.0 / math.sqrt(direction @ both @ direction)
            try:
                found = _line_search(phi, (value, float(both[1] @ direction)), first)
            finally:
                old.unpersist()
            if found * size < 1e-10:
                raise _SearchError
        except _SearchError:
            if failed:
                break
            failed, history = True, 0
            keep = [0, 1]
            products, curved, shift, intercepts = products[np.ix_(keep, keep)], curved[np.ix_(keep, keep)], shift[keep], intercepts[:2]
            parts = parts.mapValues(lambda v: (_HELD, v[1] | {"s": [], "y": []}))
            continue
        step, (value, total) = found, seen[found]
        products, curved, shift = update(step, direction, total, _MEMORY, cut)
        moved, change = step * along, total - intercepts[1]
        steps, changes = intercepts[2 : 2 + history], intercepts[2 + history :]
        intercepts = [intercepts[0] + moved, total, *[moved, *steps][:_MEMORY], *[change, *changes][:_MEMORY]]
        history, iteration, failed = min(history + 1, _MEMORY), iteration + 1, False
        values.append(value)
        recent = [*recent, value][-_VALUES:]
    docs.unpersist()
    kept = intercepts[0] - shift[0]
    return _Fitted(parts, np.append(kept, -kept.sum()), values)


# ------------------------------------------------------------------------ model


def fit(df: DataFrame, text: str, label: str, n_classes: int, min_df: float, use_idf: bool, max_iter: int, c: float, sublinear: bool) -> WideText:
    """The model of ``training.train_text`` with the vocabulary and the coefficients in a table."""
    spark = df.sparkSession
    shared_folder(spark)
    tokens = tokenizer(text).transform(df).select(F.col(label).cast("double").alias("tag"), "tokens")
    if (bad := tokens.where("tag IS NULL OR isnan(tag) OR tag < 0 OR tag <> floor(tag)").count()):
        raise ValueError(f"{bad} labels of {label} are no class numbers")
    coded = written(tokens.mapInArrow(_coded, _CODED), "text-blocks")
    swept(spark)
    held = coded.select("block", (F.octet_length("ends") / 8).cast("bigint").alias("n"))
    n, blocks = held.agg(F.sum("n"), F.count("n")).first()
    words = coded.select("block", F.inline("words"))
    least = min_df if min_df >= 1 else min_df * n
    vocabulary = words.groupBy("token").agg(F.sum("df").alias("df")).where(F.col("df") >= least)
    numbered = global_row_number(vocabulary, [F.desc("df"), "token"], "place").withColumn("place", F.col("place") - 1)
    weight = F.log((n + 1.0) / (F.col("df") + 1.0)) + 1.0 if use_idf else F.lit(1.0)
    terms = numbered.select("token", "place", weight.alias("weight"))
    links = written(words.join(terms, "token").select("block", "local", "place", "weight"), "text-links")
    size, met = links.agg(F.max("place"), F.count("place")).first()
    if not met:
        raise ValueError("no token lies in enough texts")
    counts = {int(r["tag"]): r["count"] for r in tokens.groupBy("tag").count().collect()}
    labels = np.array([counts.get(k, 0) for k in range(n_classes)], float)
    if len(counts) == 1:  # nothing to learn, as in Spark's regression
        table = terms.withColumn("coefficients", F.array_repeat(F.lit(0.0), n_classes))
        intercepts = np.where(labels > 0, math.inf, 0.0)
        return _model(text, sublinear, intercepts, table, [0.0])
    columns = n_classes - 1
    pieces = max(math.ceil(met / _PART_WORDS), math.ceil((size + 1) * columns / _PART_COEFFICIENTS))
    tasks = min(blocks, max(spark.sparkContext.defaultParallelism, math.ceil(met / _GROUP_WORDS)))
    # The task that made a block and the block's number there: neighbours go to different groups.
    group = (F.shiftright("block", 32) + F.col("block").bitwiseAND((1 << 32) - 1)) % tasks
    grouped = links.withColumn("group", group)

    parts = grouped.groupBy((F.col("place") % pieces).alias("part")).applyInArrow(lambda t: _linked(pieces, t), "part bigint, held binary")
    listed = grouped.groupBy("group").applyInArrow(lambda t: _listed(pieces, t), "group bigint, held binary")
    matrix = coded.drop("words").withColumn("group", group).groupBy("block").cogroup(links.groupBy("block")).applyInArrow(
        lambda a, b: _matrix(pieces, sublinear, a, b), "group bigint, held binary"
    )
    x = _kept(_over(_placed(pieces), _dealt(listed, tasks, _SENT), _dealt(matrix, tasks, _HELD)))
    moments = _sent(x.mapPartitions(lambda items: _summed(items, lambda v, _: _moments(v), _merge, 3)), pieces)
    unpacked = _dealt(parts, pieces, _HELD).mapValues(lambda v: (_HELD, pickle.loads(v[1])))
    scaled = _kept(_over(_scaled(n, columns), moments, unpacked))
    found = _minimised(spark, x, scaled, labels, max_iter, 1.0 / (c * n))
    held = spark.createDataFrame(found.parts.map(lambda v: (v[0], _coefficients(v[1][1]))), "part bigint, held binary")
    coefficients = held.mapInArrow(lambda b: _places(pieces, b), "place bigint, coefficients array<double>")
    model = _model(text, sublinear, found.intercepts, terms.join(coefficients, "place"), found.values)
    found.parts.unpersist()
    x.unpersist()
    return model


def _dealt(lines: DataFrame, tasks: int, kind: str) -> RDD:
    return _sent(lines.rdd.map(lambda r: (r[0], (kind, bytes(r[1])))), tasks)


def _coefficients(state: dict) -> bytes:
    kept = state["w"] * state["inverse"][:, None]
    return pickle.dumps(np.hstack([kept, -kept.sum(axis=1, keepdims=True)]), 5)


def _places(parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for line in batch.to_pylist():
            values = pickle.loads(line["held"])
            ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
            lists = pa.ListArray.from_arrays(ends, values.ravel())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)) * parts + line["part"]), lists], ["place", "coefficients"])


def _scores(intercepts: np.ndarray, sublinear: bool, coded: pa.Table, known: pa.Table) -> pa.Table:
    """Margins and probabilities of the rows of a block."""
    line = coded.to_pylist()[0]
    x = _entries(line, known.column("local").to_numpy(), known.column("weight").to_numpy(), sublinear)
    values = known.column("coefficients").combine_chunks().flatten().to_numpy().reshape(-1, len(intercepts))
    margins = _times(x, values) + intercepts
    with np.errstate(invalid="ignore"):
        shares = np.exp(margins - margins.max(axis=1, keepdims=True))
    shares = np.where(np.isinf(intercepts).any(), np.isinf(margins).astype(float), shares)
    ends = np.arange(len(margins) + 1, dtype=np.int32) * len(intercepts)
    return pa.table(
        [
            pa.array(np.frombuffer(line["tags"], np.int64)),
            pa.ListArray.from_arrays(ends, margins.ravel()),
            pa.ListArray.from_arrays(ends, (shares / shares.sum(axis=1, keepdims=True)).ravel()),
        ],
        [_ROW, "rawPrediction", "probability"],
    )


class _Writer(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.terms.write.parquet(f"{path}/terms")


class _Reader(DefaultParamsReader):
    def load(self, path: str) -> WideText:
        model = super().load(path)
        model.terms = self.sparkSession.read.parquet(f"{path}/terms")
        return model


class WideText(Transformer, HasInputCol, MLReadable, MLWritable):
    """Tokens, weights and regression of a text model in one stage; ``terms`` is its table of tokens.

    Gives ``rawPrediction``, ``probability`` and ``prediction``. The weighted features stay in long form (``weights``).
    """

    sublinear = Param(Params._dummy(), "sublinear", "weights of 1 + ln(counts)", TypeConverters.toBoolean)
    intercepts = Param(Params._dummy(), "intercepts", "per class", TypeConverters.toListFloat)
    objectiveHistory = Param(Params._dummy(), "objectiveHistory", "loss per iteration", TypeConverters.toListFloat)
    terms: DataFrame

    def write(self) -> _Writer:
        return _Writer(self)

    @classmethod
    def read(cls) -> _Reader:
        return _Reader(cls)

    def _transform(self, df: DataFrame) -> DataFrame:
        swept(df.sparkSession)
        rows = written(df.withColumn(_ROW, F.monotonically_increasing_id()), "text-rows")
        tokens = tokenizer(self.getInputCol()).transform(rows.select(_ROW, self.getInputCol())).select(_ROW, "tokens")
        coded = written(tokens.mapInArrow(_coded, _CODED), "text-blocks")
        words = coded.select(F.col("block").alias("of"), F.inline("words"))
        known = words.join(self.terms, "token").select("of", "local", "weight", "coefficients")
        intercepts, sublinear = np.array(self.getOrDefault(self.intercepts)), self.getOrDefault(self.sublinear)
        scores = coded.drop("words").groupBy("block").cogroup(known.groupBy("of")).applyInArrow(
            lambda a, b: _scores(intercepts, sublinear, a, b), f"{_ROW} bigint, rawPrediction array<double>, probability array<double>"
        )
        best = F.array_position("probability", F.array_max("probability")) - 1
        vectors = {v: array_to_vector(F.col(v)) for v in ("rawPrediction", "probability")}
        return rows.join(scores.withColumn("prediction", best.cast("double")), _ROW).withColumns(vectors).select(*df.columns, *vectors, "prediction")

    def weights(self, df: DataFrame, key: str) -> DataFrame:
        """``key, token, weight`` of every row."""
        rows = written(df.select(key, self.getInputCol()).withColumn(_ROW, F.monotonically_increasing_id()), "text-rows")
        counts = tokenizer(self.getInputCol()).transform(rows).select(_ROW, key, runs(F.sort_array("tokens")))
        n = F.col("tf").cast("double")
        raw = (1.0 + F.ln(n) if self.getOrDefault(self.sublinear) else n) * F.col("weight")
        terms = counts.join(self.terms.select("token", "weight"), "token").select(_ROW, key, "token", raw.alias("raw"))
        length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(_ROW)))
        return terms.select(key, "token", (F.col("raw") / length).alias("weight"))


def _model(text: str, sublinear: bool, intercepts: np.ndarray, terms: DataFrame, values: list[float]) -> WideText:
    model = WideText()
    model._set(inputCol=text, sublinear=sublinear, intercepts=[float(v) for v in intercepts], objectiveHistory=values)
    path = scratch_path(terms.sparkSession, "text-terms")
    terms.write.parquet(path)
    model.terms = terms.sparkSession.read.parquet(path)
    return model
