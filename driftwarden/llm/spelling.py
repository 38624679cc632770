"""Spelling variants: words one edit apart, found with an FM-index searched from either end.

Two words one edit apart agree on the first half of one of them or on its second
half. Each of two passes fixes one half: it is matched exactly from the delimiter
inwards, and the search is then extended across the other half with one error,
always by intervals of suffix ranks over the delimited vocabulary. The index is
kept in both directions: one pass reads the words forwards, the other backwards,
since a search that starts at a delimiter only ever grows towards one side.

Words that agree on a half agree on its outer three letters. These deal the
vocabulary out to tasks, each of which indexes its own words, so no index holds
the vocabulary. Letters shared by more than ``BLOCK`` words are cut into blocks,
and every block of queries meets every block of indexed words in a task of its
own. A pair found in the second pass counts only where the first half differs,
so each near word counts once and only counts and best forms leave a task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwarden.llm.common import columns_of, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Shortest word that is compared, in code points, and least number of occurrences.
SHORTEST, OCCURRENCES = 7, 2
#: Times a form must be more frequent than the word.
TIMES = 10
#: Code points at the outer end of a half that deal the words out; no half is shorter.
KEY = SHORTEST // 2
#: Words of one index, and words searched at a time.
BLOCK, BATCH = 40_000, 4_000
#: Letters of a word: ASCII and Latin-1.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]"

Column3 = tuple[np.ndarray, np.ndarray, np.ndarray]


def coded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words one after the other, and where each word starts (one border more than words)."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return points, np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])


class FMIndex:
    """Suffix-rank intervals over words, each closed by a delimiter.

    Symbol 0 is the delimiter. Delimiters count as smaller the earlier their
    word, so equal suffixes of different words keep the order of the words, and
    the interval of a whole word is its place in the sorted vocabulary.
    """

    def __init__(self, points: np.ndarray, borders: np.ndarray) -> None:
        lengths = np.diff(borders)
        self.alphabet = np.unique(points)
        n = len(points) + len(lengths)
        ends = np.cumsum(lengths + 1) - 1
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends] = False
        text[inside] = np.searchsorted(self.alphabet, points) + 1
        end = np.repeat(ends, lengths + 1)
        rank, count, step = text, 0, 1
        while True:
            # Ranks by the first ``step`` symbols become ranks by twice as many.
            ahead = np.arange(n) + step
            following = np.where(ahead <= end, rank[np.minimum(ahead, n - 1)] + 1, 0)
            values, rank = np.unique(rank * (n + 2) + following, return_inverse=True)
            if len(values) == count:
                break
            count, step = len(values), step * 2
        order = np.argsort(rank, kind="stable")
        self.n, self.words = n, len(lengths)
        self.before = text[order - 1]
        by_symbol = np.argsort(self.before, kind="stable")
        self.keys = self.before[by_symbol] * n + by_symbol

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """The index's symbols; a letter that no indexed word holds is one beyond the alphabet."""
        at = np.searchsorted(self.alphabet, points)
        known = at < len(self.alphabet)
        known[known] = self.alphabet[at[known]] == points[known]
        return np.where(known, at + 1, len(self.alphabet) + 1)

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the symbol followed by what the given intervals stand for."""
        shift = symbol * self.n
        return np.searchsorted(self.keys, shift + low), np.searchsorted(self.keys, shift + high)

    def children(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, symbol) of every letter that stands before some suffix of an interval."""
        size, letters = high - low, len(self.alphabet)
        small = np.flatnonzero(size <= letters)
        state = np.repeat(small, size[small])
        row = np.arange(len(state)) - np.repeat(np.cumsum(size[small]) - size[small], size[small]) + low[state]
        found = np.unique(state * (letters + 2) + self.before[row])
        large = np.flatnonzero(size > letters)
        tried = (large[:, None] * (letters + 2) + np.arange(1, letters + 1)).ravel()
        found = np.concatenate([found[found % (letters + 2) > 0], tried])
        return found // (letters + 2), found % (letters + 2)


def one_edit(index: FMIndex, points: np.ndarray, borders: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, rank of an indexed word) of all pairs one edit apart that agree on the query's last ``exact`` symbols.

    The last symbols are matched exactly from the delimiter on, then the search
    runs on through the rest with one inserted, missing or replaced symbol.
    """
    text = index.symbols(points)
    begin, at = borders[:-1], borders[1:].copy()
    query = np.arange(len(begin))
    low, high = np.zeros(len(query), np.int64), np.full(len(query), index.words)
    for step in range(int(exact.max(initial=0))):
        more = exact[query] > step
        a, b = index.extend(low[more], high[more], text[at[query[more]] - 1])
        at[query[more]] -= 1
        low[more], high[more] = a, b
        alive = high > low
        query, low, high = query[alive], low[alive], high[alive]
    place = at[query]
    found = []
    while len(query):
        state, symbol = index.children(low, high)
        a, b = index.extend(low[state], high[state], symbol)
        real = b > a
        state, symbol, a, b = state[real], symbol[real], a[real], b[real]
        left = place[state] > begin[query[state]]
        same = left & (symbol == text[place[state] - 1])
        replaced, missing = left & ~same, place > begin[query]
        found.append(
            _finish(
                index,
                text,
                begin,
                np.concatenate([query[state], query[state[replaced]], query[missing]]),
                np.concatenate([place[state], place[state[replaced]] - 1, place[missing] - 1]),
                np.concatenate([a, a[replaced], low[missing]]),
                np.concatenate([b, b[replaced], high[missing]]),
            )
        )
        query, place, low, high = query[state[same]], place[state[same]] - 1, a[same], b[same]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.unique(np.concatenate(found))  # one edit may be written in several ways
    return pairs // index.words, pairs % index.words


def _finish(
    index: FMIndex, text: np.ndarray, begin: np.ndarray, query: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray
) -> np.ndarray:
    """Match what is left of each query and the delimiter before it; gives query * words + rank."""
    done = []
    while len(query):
        left = place > begin[query]
        a, b = index.extend(low, high, np.where(left, text[place - 1], 0))
        alive = b > a
        whole = alive & ~left
        done.append(query[whole] * index.words + a[whole])
        on = alive & left
        query, place, low, high = query[on], place[on] - 1, a[on], b[on]
    return np.concatenate(done) if done else np.zeros(0, np.int64)


class _Task:
    """The indexed words of one task: given in any order, searched in blocks."""

    def __init__(self, words: list[str], n: list[int], backwards: bool) -> None:
        read = [w[::-1] for w in words] if backwards else words
        order = sorted(range(len(read)), key=read.__getitem__)
        self.backwards, self.words = backwards, [words[i] for i in order]
        self.n = np.array([n[i] for i in order], np.int64)
        self.points, self.borders = coded([read[i] for i in order])
        self.place = np.empty(len(words), np.int64)  # by code points of the word as written
        self.place[sorted(range(len(words)), key=self.words.__getitem__)] = np.arange(len(words))
        self.index = FMIndex(self.points, self.borders)

    def search(self, words: list[str]) -> tuple[np.ndarray, list[int], list[str]]:
        """Near words of each query: how many, the largest count and its smallest word."""
        points, borders = coded([w[::-1] for w in words] if self.backwards else words)
        lengths = np.diff(borders)
        half = lengths // 2
        query, near = one_edit(self.index, points, borders, half if self.backwards else lengths - half)
        if not self.backwards and len(query):
            # Pairs that agree on the first half belong to the other pass.
            fits = half[query] <= np.diff(self.borders)[near]
            other = np.ones(len(query), bool)
            other[fits] = self._differ(points, borders[query[fits]], self.borders[near[fits]], half[query[fits]])
            query, near = query[other], near[other]
        count = np.bincount(query, minlength=len(words))
        order = np.lexsort((self.place[near], -self.n[near], query))
        first = order[np.concatenate([[True], np.diff(query[order]) > 0])] if len(order) else order
        best_n, best = [0] * len(words), [""] * len(words)
        for q, w in zip(query[first].tolist(), near[first].tolist(), strict=True):
            best_n[q], best[q] = int(self.n[w]), self.words[w]
        return count, best_n, best

    def _differ(self, points: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches of the queries at a and of the indexed words at b differ."""
        out = np.zeros(len(a), bool)
        for k in range(int(length.max(initial=0))):
            on = np.flatnonzero(~out & (length > k))
            out[on] = points[a[on] + k] != self.points[b[on] + k]
        return out


def _searched(backwards: bool, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by task, indexed words first; a word may be indexed, searched or both."""
    task, words, counts, index = None, [], [], None
    asked: list[str] = []

    def answers() -> Iterator[pa.RecordBatch]:
        nonlocal index, asked
        if index is None and words:
            index = _Task(words, counts, backwards)
        for i in range(0, len(asked) if index else 0, BATCH):
            some = asked[i : i + BATCH]
            count, best_n, best = index.search(some)
            hit = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([some[k] for k in hit.tolist()], pa.string()),
                    pa.array(count[hit], pa.int64()),
                    pa.array([best_n[k] for k in hit.tolist()], pa.int64()),
                    pa.array([best[k] for k in hit.tolist()], pa.string()),
                ],
                names=["word", "n_near", "best_n", "best"],
            )
        asked = []

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("task", "word", "n", "indexed", "asked")), strict=True)
        for now, word, n, indexed, is_asked in rows:
            if now != task:
                yield from answers()
                task, words, counts, index = now, [], [], None
            if indexed:
                words.append(word)
                counts.append(n)
            if is_asked:
                asked.append(word)
            if not indexed and len(asked) >= 4 * BATCH:
                yield from answers()
    yield from answers()


def _half_pass(vocabulary: DataFrame, tasks: int, backwards: bool) -> DataFrame:
    """word, n_near, best_n, best for words with a near word that agrees on one half."""
    key = F.substring("word", 1, KEY) if backwards else F.expr(f"right(word, {KEY})")
    keyed = vocabulary.withColumn("key", key)
    sizes = keyed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    # At most one row for every BLOCK words of the vocabulary.
    large = F.broadcast(sizes.where("blocks > 1"))
    keyed = keyed.join(large, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    keyed = keyed.withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    single = keyed.where("blocks = 1").select(
        F.concat(F.lit("#"), F.pmod(F.xxhash64("key"), F.lit(tasks)).cast("string")).alias("task"),
        "word",
        "n",
        F.lit(True).alias("indexed"),
        F.lit(True).alias("asked"),
    )
    several = keyed.where("blocks > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def cell(block: str, queries: str) -> Column:
        return F.concat_ws("#", "key", block, queries).alias("task")

    indexed = several.select(cell("own", "other"), "word", "n", F.lit(True).alias("indexed"), (F.col("own") == F.col("other")).alias("asked"))
    asked = several.where("own <> other").select(cell("other", "own"), "word", "n", F.lit(False).alias("indexed"), F.lit(True).alias("asked"))
    rows = single.unionByName(indexed).unionByName(asked).repartition(tasks, "task")
    rows = rows.sortWithinPartitions("task", F.col("indexed").desc())
    return rows.mapInArrow(lambda batches: _searched(backwards, batches), "word string, n_near bigint, best_n bigint, best string")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word that has a form: forms are followed to the last by doubling.

    A form is ``TIMES`` times as frequent as its word, so chains end and are
    short; each round doubles the length followed and is written.
    """
    now = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = now.join(on, "root", "left")
        now = written(
            joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "spelling-roots",
        )
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.drop("moved")


def spelling_variants(vocabulary: DataFrame, word: str = "word", n: str = "n") -> DataFrame:
    """Near words and the form of every word: word, form, root (strings), n, n_near, form_n (longs).

    Near words differ by exactly one inserted, missing or replaced code point;
    ``n_near`` counts them. The near word of largest n (ties: smallest in code
    point order) is the ``form`` if it is ``TIMES`` times as frequent as the
    word, else NULL; ``root`` follows forms to the last and is the word itself
    without one. Repeated words add their counts up; NULL words, words of under
    ``SHORTEST`` code points and words rarer than ``OCCURRENCES`` are left out,
    a NULL count counts as nothing, further columns are left out, an empty table
    gives an empty table.
    """
    named = columns_of(vocabulary, word=word, n=n).where("word IS NOT NULL")
    words = named.groupBy("word").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"))
    words = written(words.where((F.length("word") >= SHORTEST) & (F.col("n") >= OCCURRENCES)), "spelling-words")
    tasks = words.count() // BLOCK + 1
    near = _half_pass(words, tasks, False).unionByName(_half_pass(words, tasks, True))
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    near = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    fits = -F.col("best.m") >= TIMES * F.col("n")
    found = written(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(fits, F.col("best.w")).alias("form"),
            F.when(fits, -F.col("best.m")).alias("form_n"),
        ),
        "spelling-near",
    )
    rooted = found.join(roots(found.where("form IS NOT NULL")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def planted_words(docs: DataFrame) -> DataFrame:
    """(word, n): letter runs of whole texts with only A-Z lower-cased, one letter taken out of every 31st.

    With h the crc32 of ``<doc_id>:<run>``, the run loses code point h mod its
    length when 31 divides h. A NULL id counts as empty text before the colon; a
    NULL or empty text has no runs. Runs too short to be compared are left out.
    """
    run = F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{SHORTEST},}}"), F.lit(0)))
    upper = "".join(map(chr, range(65, 91)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    runs = runs.select("id", F.translate("run", upper, upper.lower()).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    place = (h % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    words = runs.select(F.when(h % 31 == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= SHORTEST).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
