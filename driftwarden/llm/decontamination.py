"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import heapq
import re
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwarden.llm import shingles
from driftwarden.llm.common import columns_of, filter_bits, may_hold, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Least words of a tile; share of a test item's words that tiles must cover.
TILE, COVERAGE = 4, 0.5
_WORD = re.compile(r"\w+")
_RUNS = "struct<words:int,runs:array<struct<hash:bigint,places:array<int>>>>"
_TILED = "struct<covered:int,tiles:array<struct<item_start:int,doc_start:int,words:int>>>"


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words of a text: runs of letters, digits and underscores in lower case."""
    return shingles.word_hashes(_WORD.findall((text or "").lower()))


def runs_of(words: np.ndarray, bits: np.ndarray | None = None) -> list[dict]:
    """The hash of every run of TILE words with its places; with ``bits`` only runs whose bit is set."""
    if len(words) < TILE:
        return []
    runs = shingles.shingle_hashes(words, TILE)
    where = np.arange(len(runs))
    if bits is not None:
        low = runs & np.uint64(8 * len(bits) - 1)
        where = np.flatnonzero((bits[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8)) & 1)
    if not len(where):
        return []
    order = where[np.argsort(runs[where], kind="stable")]
    hashes, first = np.unique(runs[order], return_index=True)
    return [
        {"hash": h, "places": p.astype(np.int32)}
        for h, p in zip(hashes.view(np.int64).tolist(), np.split(order, first[1:]), strict=True)
    ]


def tiling(place: np.ndarray, spot: np.ndarray, length: int, least: int = TILE) -> list[tuple[int, int, int]]:
    """Greedy tiles (start in the item, start in the text, words): the longest match that overlaps no tile, repeatedly.

    ``place`` and ``spot`` pair the starts of equal runs of ``least`` words.
    Runs on one diagonal that follow each other are one longer match; a match
    that earlier tiles cut into is put back as its free pieces.
    """
    order = np.lexsort((spot, spot - place))
    place, spot = place[order], spot[order]
    breaks = np.flatnonzero((np.diff(spot - place) != 0) | (np.diff(spot) != 1)) + 1
    starts, ends = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(spot)]])
    heap = [(-(int(b - a) + least - 1), int(place[a]), int(spot[a])) for a, b in zip(starts, ends, strict=True)]
    heapq.heapify(heap)
    item_used, doc_used = np.zeros(length, bool), set()
    tiles = []
    while heap:
        size, i, j = heapq.heappop(heap)
        size = -size
        free = [not item_used[i + k] and (j + k) not in doc_used for k in range(size)]
        if all(free):
            tiles.append((i, j, size))
            item_used[i : i + size] = True
            doc_used.update(range(j, j + size))
            continue
        k = 0
        while k < size:
            if not free[k]:
                k += 1
                continue
            end = k
            while end < size and free[end]:
                end += 1
            if end - k >= least:
                heapq.heappush(heap, (k - end, i + k, j + k))
            k = end
    return sorted(tiles)


def covering(hits: list, length: int, coverage: float) -> tuple[int, list[tuple[int, int, int]]]:
    """(words covered, tiles) of one item in one text from the places of their common runs, or nothing if too few."""
    starts = np.concatenate([np.asarray(p, np.int64) for p, _ in hits])
    reach = np.zeros(length + 1, np.int64)
    np.add.at(reach, starts, 1)
    np.add.at(reach, starts + TILE, -1)
    if int((np.cumsum(reach)[:length] > 0).sum()) < coverage * length:
        return 0, []  # no tiling can cover more than the seeds touch
    place = np.concatenate([np.repeat(np.asarray(p, np.int64), len(s)) for p, s in hits])
    spot = np.concatenate([np.tile(np.asarray(s, np.int64), len(p)) for p, s in hits])
    tiles = tiling(place, spot, length)
    return sum(t[2] for t in tiles), tiles


def _runs(bits: np.ndarray | None = None):
    @F.pandas_udf(_RUNS)
    def find(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            words = word_hashes(text)
            rows.append((len(words), runs_of(words, bits)))
        return pd.DataFrame(rows, columns=["words", "runs"])

    return find


def _tiled(coverage: float):
    @F.pandas_udf(_TILED)
    def tile(hits: pd.Series, lengths: pd.Series) -> pd.DataFrame:
        rows = []
        for pairs, length in zip(hits, lengths, strict=True):
            covered, tiles = covering(list(pairs), int(length), coverage)
            rows.append((covered, [{"item_start": a, "doc_start": b, "words": w} for a, b, w in tiles]))
        return pd.DataFrame(rows, columns=["covered", "tiles"])

    return tile


def _packed(seeds: DataFrame) -> np.ndarray:
    """The filter of the seeds' hashes as bytes: 16 MB at most."""
    blocks, power = filter_bits(seeds.select(F.col("hash").alias("key")).distinct())
    out = np.zeros(max(4096, (1 << power) // 8), np.uint8)
    for r in blocks.collect():
        out[(r["block"] - 1) * 4096 : r["block"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    coverage: float = COVERAGE,
) -> DataFrame:
    """One row per document and test item of which tiles cover at least ``coverage`` of the words.

    Columns: doc_id, item_id, item_words, covered, coverage, tiles. Words are
    runs of letters, digits and underscores in lower case. Tiles may stand in
    any order in the document, so reordered passages are found; each word of
    item and document belongs to one tile at most. NULL and empty texts, on
    either side, match nothing, like items shorter than a tile; repeated rows
    give repeated results; empty tables give no rows.

    The seeds are a table (hash of a run of words, item, places). Documents are
    scanned once, where they lie: a filter of the seeds' hashes, 16 MB at most,
    lets through the runs that an item may hold, and these are joined with the
    seeds, a run that a text or an item repeats being one row. Tiles are found
    per document and item, from no more than the common runs of the two.
    """
    rows = columns_of(docs, doc_id=key, text=text)
    items = columns_of(benchmark, item_id=item, text=item_text).where("text IS NOT NULL")
    numbered = items.select("item_id", F.monotonically_increasing_id().alias("item"), _runs()(F.col("text")).alias("r"))
    numbered = written(numbered.select("item_id", "item", F.col("r.words").alias("item_words"), "r.runs"), "benchmark-runs")
    seeds = numbered.select("item_id", "item", "item_words", F.inline("runs").alias("hash", "places"))
    held = rows.select("doc_id", F.monotonically_increasing_id().alias("row"), _runs(_packed(seeds))(F.col("text")).alias("r"))
    held = written(held.select("doc_id", "row", "r.runs").where(F.size("runs") > 0), "document-runs")
    spots = held.select("doc_id", "row", F.inline("runs").alias("hash", "spots"))
    pairs = (
        spots.join(seeds, "hash")
        .groupBy("row", "doc_id", "item", "item_id", "item_words")
        .agg(F.sum(F.size("places")).alias("starts"), F.collect_list(F.array("places", "spots")).alias("hits"))
        .where(F.col("starts") * TILE >= F.col("item_words") * F.lit(float(coverage)))
    )
    found = pairs.select("doc_id", "item_id", "item_words", _tiled(coverage)(F.col("hits"), F.col("item_words")).alias("t"))
    found = found.select("doc_id", "item_id", "item_words", "t.covered", "t.tiles")
    share = F.col("covered") / F.col("item_words")
    return found.where(F.col("covered") >= F.lit(float(coverage)) * F.col("item_words")).where("covered > 0").select(
        "doc_id", "item_id", "item_words", "covered", share.alias("coverage"), "tiles"
    )


def without_benchmark(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``docs`` without the documents that hold a test item, all columns as they are. NULL and empty texts stay.

    Texts are known by their md5. Only rows that a filter of the contaminated
    ones marks are joined with them; all others stay where they lie.
    """
    digest = F.md5(F.col(f"`{text}`").cast("binary"))
    rows = docs.select(digest.alias("digest"), F.col(f"`{text}`").alias("text"))
    hit = contaminated(rows, benchmark, "digest", "text", item, item_text).select(F.col("doc_id").alias("__digest"))
    hit = written(hit.distinct(), "contaminated")
    marked = may_hold(docs.withColumn("__md5", digest), F.xxhash64("__md5"), hit.select(F.xxhash64("__digest").alias("key")), "__may")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    clean = marked.where(~F.col("__may")).select(*columns)
    rest = marked.where("__may").join(hit, F.col("__md5") == F.col("__digest"), "left_anti").select(*columns)
    return clean.unionByName(rest)
