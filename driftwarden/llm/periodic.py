"""Periodic runs of words: multi-scale minimizers seed long periods, direct lag scans find the short ones.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical), at least ``max(LEAST, TIMES * q)`` words long, which no
neighbouring word extends.

Periods below ``2 * FIRST`` are found by comparing the words with themselves q
places on. At scale t = FIRST, 2 FIRST, 4 FIRST, ... the periods from 2 t to 4 t
are sought. Every run of t words (a gram) has a hash, and a gram is picked when
it is the minimum of some window of t neighbouring grams. Inside a run windows
one period apart hold the same grams, so their minima are equal and one period
apart: pairs of equal picks seed the candidates. Grams with a period of t / 4 or
less, which lie in runs already found, are never picked; the others lie more
than t / 4 apart when equal, so a pick has at most 16 partners. A run is four
periods long, so three equal picks one period apart exist in it; only those are
extended, by a binary search on prefix hashes, and every run is compared word by
word in the end. Nothing is missed and nothing is reported by hash alone.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwarden.llm.common import columns_of
from driftwarden.llm.shingles import scramble

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Shortest run in words, and in periods.
LEAST, TIMES = 6, 4
#: Words of a gram at the first scale.
FIRST = 4
#: Bytes of text whose words are numbered and scanned together; a longer text is taken alone, whole.
TOGETHER = 4 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NEVER = np.uint64(2**64 - 1)

Stretches = list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def _lag(words: np.ndarray, q: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest stretches of ``least`` words or more with period ``q``."""
    if len(words) <= q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = np.zeros(len(words) - q + 2, np.int8)
    same[1:-1] = words[q:] == words[:-q]
    turns = np.flatnonzero(np.diff(same))
    starts, ends = turns[::2], turns[1::2] + q
    long = ends - starts >= least
    return starts[long], ends[long]


def _picked(h: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the minimum of a window of ``width`` hashes (a power of two)."""
    if len(h) < width:
        return np.zeros(0, np.int64)
    least, step = h, 1
    while step < width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    edge = np.zeros(width - 1, np.uint64)
    most, step = np.concatenate([edge, least, edge]), 1
    while step < width:
        most = np.maximum(most[:-step], most[step:])
        step *= 2
    return np.flatnonzero((h == most) & (h != _NEVER))


def _pairs(h: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of equal picks ``low`` to ``high`` apart that are followed by a third at that distance."""
    at = _picked(h, low // 2)
    at = at[np.argsort(h[at], kind="stable")]
    value, found, by = h[at], [], 1
    while by < len(at):
        near = (value[by:] == value[:-by]) & (at[by:] - at[:-by] < high)
        if not near.any():
            break
        first, gap = at[:-by][near], (at[by:] - at[:-by])[near]
        found.append(np.stack([first, gap], 1)[gap >= low])
        by += 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.concatenate(found)
    followed = np.isin((pairs[:, 0] + pairs[:, 1]) * high + pairs[:, 1], pairs[:, 0] * high + pairs[:, 1])
    return pairs[followed, 0], pairs[followed, 1]


class _Extender:
    """How far two places of the words agree, by prefix hashes."""

    def __init__(self, words: np.ndarray) -> None:
        self.n = len(words)
        self.power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(self.n, _BASE)]))
        values = scramble(words.astype(np.uint64) + np.uint64(1))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(values * self.power[:-1], dtype=np.uint64)])

    def _equal(self, a: np.ndarray, b: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether words a to b equal those q places on."""
        return (self.sums[b] - self.sums[a]) * self.power[q] == self.sums[b + q] - self.sums[a + q]

    def stretch(self, x: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The stretch with period q around each place x."""
        good, bad = x.copy(), np.full(len(x), -1, np.int64)  # leftwards: all words from good to x agree
        while (todo := good - bad > 1).any():
            middle = np.where(todo, (good + bad) // 2, good)
            same = self._equal(middle, x, q)
            good, bad = np.where(same, middle, good), np.where(same, bad, middle)
        start = good
        good, bad = x.copy(), self.n - q + 1
        while (todo := bad - good > 1).any():
            middle = np.where(todo, (good + bad) // 2, good)
            same = self._equal(x, middle, q)
            good, bad = np.where(same, middle, good), np.where(same, bad, middle)
        return start, good + q


def _exact(words: np.ndarray, start: int, end: int, q: int) -> bool:
    """Whether the stretch has period q and cannot be extended."""
    return (
        np.array_equal(words[start : end - q], words[start + q : end])
        and (start == 0 or words[start - 1] != words[start - 1 + q])
        and (end == len(words) or words[end] != words[end - q])
    )


def _long_periods(words: np.ndarray, extender: list[_Extender], h: np.ndarray, scale: int) -> np.ndarray:
    """(start, end, period) of all stretches of TIMES periods or more with a period from 2 to 4 scales."""
    x, q = _pairs(h, 2 * scale, 4 * scale)
    if not len(x):
        return np.zeros((0, 3), np.int64)
    if not extender:
        extender.append(_Extender(words))
    starts, ends = extender[0].stretch(x, q)
    found = np.unique(np.stack([starts, ends, q], 1)[ends - starts >= TIMES * q], axis=0)
    right = np.fromiter((_exact(words, *row) for row in found.tolist()), bool, len(found))
    scanned = []  # two different stretches with equal hashes: compare all words of that lag
    for lag in np.unique(found[~right, 2]).tolist():
        s, e = _lag(words, lag, TIMES * lag)
        scanned.append(np.stack([s, e, np.full(len(s), lag)], 1))
    return np.concatenate([found[right], *scanned])


def runs_of(words: np.ndarray, lengths: Sequence[int] | None = None) -> np.ndarray:
    """(start, end, period) of all runs of the numbered words, by start, then period.

    ``lengths`` are the lengths of the texts that follow each other in
    ``words``, in ascending order, each with a word of its own after it, so that
    no run crosses them; without it the words are one text.
    """
    if lengths is None:
        words = np.concatenate([words, [words.max(initial=0) + 1]])
        lengths = [len(words) - 1]
    lengths = np.asarray(lengths, np.int64)
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    table = np.zeros((0, 3), np.int64)
    for q in range(1, 2 * FIRST):
        s, e = _lag(words, q, TIMES * q)
        table = np.concatenate([table, np.stack([s, e, np.full(len(s), q)], 1)])
    h = scramble(words.astype(np.uint64) + np.uint64(1))
    covered, scale, offset = 1, FIRST, 0
    while len(lengths) and lengths[-1] >= TIMES * 2 * scale:
        # Texts too short for this scale lie in front.
        first = int(np.searchsorted(lengths, TIMES * 2 * scale))
        words, h, cut = words[starts[first] - offset :], h[starts[first] - offset :], starts[first]
        starts, lengths, offset = starts[first:], lengths[first:], cut
        while covered < scale:
            h = scramble(h[:-covered] * _BASE + h[covered:])
            covered *= 2
        eligible, dull = h.copy(), table[(table[:, 2] <= scale // 4) & (table[:, 1] - table[:, 0] >= scale) & (table[:, 0] >= offset)]
        if len(dull):
            edge = np.zeros(len(h) + 1, np.int64)
            np.add.at(edge, dull[:, 0] - offset, 1)
            np.add.at(edge, np.minimum(dull[:, 1] - scale + 1 - offset, len(h)), -1)
            eligible[np.cumsum(edge[:-1]) > 0] = _NEVER
        found = _long_periods(words, [], eligible, scale)
        found[:, :2] += offset
        table = np.concatenate([table, found])
        scale *= 2
    # A stretch found with a multiple of its smallest period is the same stretch.
    table = table[np.lexsort((table[:, 2], table[:, 1], table[:, 0]))]
    first = np.ones(len(table), bool)
    first[1:] = (table[1:, :2] != table[:-1, :2]).any(axis=1)
    table = table[first & (table[:, 1] - table[:, 0] >= LEAST)]
    return table[np.lexsort((table[:, 2], table[:, 0]))]


def _scan(texts: list[bytes | None]) -> tuple[list[int], list[np.ndarray], list[str]]:
    """Words, runs and collapsed text of each text, in the given order."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    split = [(t or b"").split() for t in texts]
    order = sorted(range(len(split)), key=lambda i: len(split[i]))
    parts = [np.fromiter(map(numbers.__getitem__, split[i]), np.int64, len(split[i])) for i in order]
    ends = np.arange(len(numbers), len(numbers) + len(order))
    words = np.concatenate([x for part, end in zip(parts, ends, strict=True) for x in (part, [end])])
    lengths = np.array([len(p) for p in parts], np.int64)
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    found = runs_of(words, lengths)
    cuts = np.searchsorted(found[:, 0], np.append(starts, len(words)))
    runs: list[np.ndarray] = [found[:0]] * len(texts)
    collapsed = [""] * len(texts)
    for k, i in enumerate(order):
        own = found[cuts[k] : cuts[k + 1]].copy()
        own[:, :2] -= starts[k]
        kept = split[i]
        if len(own):
            inside = np.zeros(len(kept) + 1, np.int64)
            np.add.at(inside, own[:, 0] + own[:, 2], 1)
            np.add.at(inside, own[:, 1], -1)
            kept = [w for w, drop in zip(kept, np.cumsum(inside[:-1]) > 0, strict=True) if not drop]
        runs[i], collapsed[i] = own, b" ".join(kept).decode("utf-8", "replace")
    return [len(s) for s in split], runs, collapsed


RUN = T.ArrayType(T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")]), False)
_RUN = pa.list_(pa.field("element", pa.struct([pa.field(n, pa.int64(), False) for n in ("start", "length", "period")]), False))


def _pieces(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about TOGETHER bytes."""
    first, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if total and total + n > TOGETHER:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(lengths):
        yield first, len(lengths)


def _scan_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
        for a, b in _pieces(sizes):
            n, runs, collapsed = _scan(texts.slice(a, b - a).to_pylist())
            flat = np.concatenate(runs)
            flat[:, 1] -= flat[:, 0]
            structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(_RUN.value_type))
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), structs, type=_RUN)
            columns = [batch.column("doc_id").slice(a, b - a), pa.array(n, pa.int64()), lists, pa.array(collapsed, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every run of every text: doc_id, n_words, runs (start, length, period; by start, then period), collapsed.

    ``collapsed`` is the text without the words that some run holds after its
    first period, the rest joined by single spaces. One row per given row:
    repeated rows, NULL ids and ties stay as they are, a NULL text counts as
    empty (no word, no run, empty ``collapsed``), an empty table gives an empty
    table and further columns are left out. One pass over the rows without a
    shuffle; memory follows ``TOGETHER`` or the longest single text.
    """
    narrow = columns_of(docs, doc_id=doc_id, text=text).withColumn("text", F.col("text").cast("binary"))
    schema = T.StructType(
        [
            narrow.schema["doc_id"],
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", RUN),
            T.StructField("collapsed", T.StringType()),
        ]
    )
    return narrow.mapInArrow(_scan_batches, schema)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with a repeated stretch written over the end of every tenth text (crc32 of the id ends in 0).

    With g = crc32 div 10 and n words, the words from a = g mod n on become
    copies of the p words from there, p = 1 + (n - a) div (3 + g mod 8). NULL
    ids and texts without a word stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    named = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    n: Column = F.size("words")
    placed = named.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    rest = n - F.col("a")
    placed = placed.withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    planted = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(again, F.lit(1), rest))
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Counts, longest run and hashes of what ``periodic_runs`` gives."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("s"), (-r.period).alias("q"))))
    lines = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.q")).alias("period"),
        F.expr("(1000 * best.length) div (-best.q)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
