"""Language-model scores by context-tree weighting over bytes, beside a word-count base line.

Every byte is eight binary decisions. Each decision has a tree of contexts, the
``DEPTH`` bytes before it, nearest first. A node of a tree holds how often the
bit was 0 and 1 in its context; its probability of them is half the
Krichevsky-Trofimov estimate and half the product of its children's. So all
depths are mixed with weights that follow from the counts alone, and the
prediction for a bit is the mixture along its path. A text ends with a byte that
UTF-8 does not have, and starts after ``DEPTH`` of them.

Nothing is held whole in one place. Texts are dealt into blocks; a block lists
its distinct grams (``DEPTH`` context bytes and the byte they precede) with
their counts in training texts. The lists are cut into parts by the two nearest
context bytes, so that a part holds whole subtrees, and merged part by part over
groups of blocks, round by round. Above the parts lie only the nodes of depth 0
and 1, 65 280 at most. Each part then answers the lists of the blocks with the
probability of every gram, and a block scores its own texts with the answers it
got. Words are counted and answered in the
same way, known by 64-bit hashes (n different words share one with odds of n * n in 2 ** 65).
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwarden.llm.common import columns_of, written
from driftwarden.llm.shingles import joined_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of context; a gram is one byte longer and fits 48 bits.
DEPTH = 5
#: Context bytes whose nodes lie above the parts.
ABOVE = 2
#: Bytes of text per block, and per array worked on at a time.
BLOCK_BYTES, PIECE = 64 << 20, 1 << 19
#: Blocks whose lists are merged, and answered, by one task.
FAN = 256
#: Grams in one row of a list.
ROW = 1 << 20
#: Texts of every MODth id hash are held out.
MOD, LEFT = 7, 2
_END = 0xFF
#: Stands for the end of a text among the hashes of words.
END_WORD = 0


# Grams of texts ----------------------------------------------------------------------------------------------------


def lowered(text: bytes) -> bytes:
    """Only A-Z become lower case."""
    return text.lower()


@dataclass
class Piece:
    """Keys of stretches of texts (grams or words), and which text each belongs to."""

    keys: np.ndarray
    owner: np.ndarray


def pieces(texts: Iterable[tuple[int, bytes]]) -> Iterator[Piece]:
    """Grams of numbered texts, at most about PIECE bytes at a time; longer texts are cut and lose no gram."""
    lead = bytes([_END]) * DEPTH
    held: list[bytes] = []
    owner: list[int] = []
    size = 0
    for number, text in texts:
        closed = lead + text + lead[:1]
        at = DEPTH
        while at < len(closed):
            part = closed[at - DEPTH : at + PIECE - size]
            held.append(part)
            owner.append(number)
            size += len(part) - DEPTH
            at += len(part) - DEPTH
            if size >= PIECE:
                yield _piece(held, owner)
                held, owner, size = [], [], 0
    if held:
        yield _piece(held, owner)


def _piece(held: list[bytes], owner: list[int]) -> Piece:
    data = np.frombuffer(b"".join(held), np.uint8)
    lengths = np.fromiter(map(len, held), np.int64, len(held))
    own = np.ones(len(data), bool)
    starts = np.cumsum(lengths) - lengths
    for k in range(DEPTH):
        own[starts + k] = False
    at = np.flatnonzero(own)
    grams = data[at].astype(np.int64)
    for d in range(1, DEPTH + 1):  # the nearest byte is the highest
        grams |= data[at - d].astype(np.int64) << (8 * (DEPTH + 1 - d))
    return Piece(grams, np.repeat(np.asarray(owner), lengths - DEPTH))


def word_pieces(texts: Iterable[tuple[int, bytes]]) -> Iterator[Piece]:
    """Hashes of the words of numbered texts, and one END_WORD after each text."""
    held: list[bytes] = []
    owner: list[int] = []
    counts: list[int] = []
    size = 0

    def made() -> Piece:
        own = np.repeat(np.asarray(owner), counts)
        hashes = joined_hashes(b" ".join(held)).view(np.int64) if held else np.zeros(0, np.int64)
        return Piece(np.concatenate([hashes, np.full(len(owner), END_WORD)]), np.concatenate([own, np.asarray(owner)]))

    for number, text in texts:
        words = text.split()
        held += words
        owner.append(number)
        counts.append(len(words))
        size += len(text)
        if size >= PIECE:
            yield made()
            held, owner, counts, size = [], [], [], 0
    if owner:
        yield made()


def _counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order and the sum of their counts."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


class _Tally:
    """Growing sums per key; lists are merged when they have grown as long as the sums."""

    def __init__(self) -> None:
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.size += len(keys)
        if self.size > max(len(self.keys), ROW):
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray]:
        if self.waiting:
            parts = [(self.keys, self.counts), *self.waiting]
            self.keys, self.counts = _counted(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
            self.waiting, self.size = [], 0
        return self.keys, self.counts


def _packed(values: np.ndarray) -> bytes:
    """Bytes of equal weight lie together, which compresses well."""
    return values.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(kind).ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=0))


def _unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, np.int64))


def part_of(kind: int, keys: np.ndarray, parts: int) -> np.ndarray:
    """Part of each key: a gram's by its two nearest context bytes, a word's by its hash."""
    nearest = (keys >> (8 * (DEPTH + 1 - ABOVE)) if kind == GRAM else keys).astype(np.uint64)
    return ((nearest * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % parts


# Trees -------------------------------------------------------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function for x >= 1/2."""
    z = x + 7.0
    low = x.copy()
    for k in range(1, 7):
        low *= x + k
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7) + 1 / (1188 * z**9)
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - np.log(low)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


@dataclass
class Level:
    """The nodes of one depth for one bit: counts, and how much of the mixture is the node's own estimate."""

    zeros: np.ndarray
    ones: np.ndarray
    log_weighted: np.ndarray
    own: np.ndarray

    @classmethod
    def of(cls, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None) -> Level:
        """``below``: log of the product of the children's weighted probabilities; None at the deepest level."""
        kt = log_kt(zeros, ones)
        if below is None:
            return cls(zeros, ones, kt, np.ones(len(kt)))
        return cls(zeros, ones, np.logaddexp(kt, below) - np.log(2.0), 1 / (1 + np.exp(np.clip(below - kt, -700, 700))))

    def mixed(self, node: np.ndarray, bit: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Probability of each bit by its node and, for the rest of the weight, by what lies below."""
        zeros, ones, own = self.zeros[node], self.ones[node], self.own[node]
        return own * (np.where(bit, ones, zeros) + 0.5) / (zeros + ones + 1.0) + (1 - own) * below


class Subtrees:
    """All trees of one part from depth ABOVE on, from its distinct grams and their counts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray) -> None:
        self.grams = grams
        # Distinct (context, byte) pairs of each depth, and where each pair of the depth below lies among them.
        self.pairs, self.counts, self.up = {DEPTH: grams}, {DEPTH: counts}, {}
        for d in range(DEPTH - 1, ABOVE - 1, -1):
            deeper = self.pairs[d + 1]
            shorter = (deeper >> 16 << 8) | (deeper & 255)
            self.pairs[d], self.up[d] = np.unique(shorter, return_inverse=True)
            self.counts[d] = np.bincount(self.up[d], self.counts[d + 1], len(self.pairs[d])).astype(np.int64)

    def _levels(self, bit: int) -> tuple[dict[int, Level], dict[int, np.ndarray], dict[int, np.ndarray]]:
        """Levels, the node of each pair and the first pair of each node, for the ``bit``-th decision."""
        levels, node, first = {}, {}, {}
        below = None
        for d in range(DEPTH, ABOVE - 1, -1):
            name = self.pairs[d] >> (8 - bit)
            turn = np.concatenate([[True], name[1:] != name[:-1]])
            node[d], first[d] = np.cumsum(turn) - 1, np.flatnonzero(turn)
            total = np.add.reduceat(self.counts[d], first[d])
            ones = np.add.reduceat(self.counts[d] * (self.pairs[d] >> (7 - bit) & 1), first[d])
            if d < DEPTH:
                parent = node[d][self.up[d][first[d + 1]]]
                below = np.bincount(parent, levels[d + 1].log_weighted, len(first[d]))
            levels[d] = Level.of((total - ones).astype(float), ones.astype(float), below)
        return levels, node, first

    def top(self) -> np.ndarray:
        """zeros, ones and log weighted probability of the nodes at depth ABOVE, summed by parent (see ``Top``)."""
        out = np.zeros((3, 256 * 256))
        for bit in range(8 if len(self.grams) else 0):
            levels, _, first = self._levels(bit)
            at = self.pairs[ABOVE][first[ABOVE]]
            slot = (at >> 24 - 8 * (3 - ABOVE) << 8) | (1 << bit) | ((at & 255) >> (8 - bit))
            level = levels[ABOVE]
            for k, values in enumerate((level.zeros, level.ones, level.log_weighted)):
                out[k] += np.bincount(slot, values, 256 * 256)
        return out

    def log10(self, top: Top) -> np.ndarray:
        """log10 of the probability of the byte of each gram in its context."""
        out = np.zeros(len(self.grams))
        for bit in range(8 if len(self.grams) else 0):
            levels, node, _ = self._levels(bit)
            place = {DEPTH: np.arange(len(self.grams))}
            for d in range(DEPTH - 1, ABOVE - 1, -1):
                place[d] = self.up[d][place[d + 1]]
            set_bit = self.grams >> (7 - bit) & 1
            p = np.full(len(self.grams), 0.5)
            for d in range(DEPTH, ABOVE - 1, -1):
                p = levels[d].mixed(node[d][place[d]], set_bit, p)
            out += np.log10(top.mixed(self.grams, bit, set_bit, p))
        return out


class Top:
    """The nodes of depth 0 and 1: one slot per nearest byte and place in the tree of a byte's bits."""

    def __init__(self, sums: np.ndarray) -> None:
        """``sums``: zeros, ones, log weighted probability of all children of each slot."""
        self.near = Level.of(sums[0], sums[1], sums[2])
        zeros, ones, below = (x.reshape(256, 256).sum(axis=0) for x in (sums[0], sums[1], self.near.log_weighted))
        self.root = Level.of(zeros, ones, below)

    def mixed(self, grams: np.ndarray, bit: int, set_bit: np.ndarray, below: np.ndarray) -> np.ndarray:
        place = (1 << bit) | ((grams & 255) >> (8 - bit))
        near = self.near.mixed(grams >> (8 * DEPTH) << 8 | place, set_bit, below)
        return self.root.mixed(place, set_bit, near)


# Spark -------------------------------------------------------------------------------------------------------------

#: Kinds of lists: grams of bytes, words by 64-bit hash.
GRAM, WORD_KEY = 0, 1
_LISTS = "kind int, block bigint, part bigint, grp bigint, keys binary, vals binary"


def _batch(names: str, *columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=names.split())


def _list_rows(names: str, kind: int, head: list[int], keys: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of a list in pieces of ROW keys."""
    for a in range(0, len(keys), ROW):
        cut = slice(a, a + ROW)
        lists = [pa.array([_packed_keys(keys[cut])], pa.binary()), pa.array([_packed(values[cut])], pa.binary())]
        yield _batch(names, pa.array([kind], pa.int32()), *[pa.array([x], pa.int64()) for x in head], *lists)


def _block_lists(parts: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct grams and words of one block with their counts in its training texts."""
    grams, words, block = _Tally(), _Tally(), None
    for batch in _small(batches):
        block = batch.column("block")[0].as_py()
        texts = [lowered(t or b"") for t in batch.column("text").to_pylist()]
        train = np.asarray(batch.column("train").to_pylist(), bool)
        for tally, cut in ((grams, pieces), (words, word_pieces)):
            for piece in cut(enumerate(texts)):
                learnt = train[piece.owner]
                tally.add(*_counted(piece.keys[learnt]))
                if not learnt.all():
                    asked = _counted(piece.keys[~learnt])[0]
                    tally.add(asked, np.zeros(len(asked), np.int64))
    for kind, tally in ((GRAM, grams), (WORD_KEY, words)) if block is not None else ():
        keys, counts = tally.settle()
        part = part_of(kind, keys, parts)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(parts + 1))
        for p in range(parts):
            own = order[cuts[p] : cuts[p + 1]]
            yield from _list_rows("kind block part grp keys vals", kind, [block, p, block // FAN], keys[own], counts[own])


def _small(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, few at a time, so that few texts are held twice."""
    for batch in batches:
        for a in range(0, batch.num_rows, 500):
            yield batch.slice(a, 500)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    return chain.from_iterable(b.slice(i, 1).to_pylist() for b in batches for i in range(b.num_rows))


def _joined(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([k for k, _ in held]), np.concatenate([v for _, v in held])


def _merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One list per kind, part and group; rows come sorted by these."""
    now, tally = None, _Tally()
    for row in chain(_rows(batches), [None]):
        key = row and (row["kind"], row["part"], row["grp"])
        if key != now:
            if now:
                yield from _list_rows("kind part grp keys vals", now[0], list(now[1:]), *tally.settle())
            now, tally = key, _Tally()
        if row:
            tally.add(_unpacked_keys(row["keys"]), _unpacked(row["vals"], np.int64))


def _part_trees(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, Subtrees]]:
    """The subtrees of each part of rows sorted by part."""
    now, held = None, []
    for row in _rows(batches):
        if held and row["part"] != now:
            yield now, Subtrees(*_joined(held))
            held = []
        now = row["part"]
        held.append((_unpacked_keys(row["keys"]), _unpacked(row["vals"], np.int64)))
    if held:
        yield now, Subtrees(*_joined(held))


def _totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        counts = _unpacked(row["vals"], np.int64)
        yield _batch("total known", pa.array([counts.sum()]), pa.array([(counts > 0).sum()]))


def _tops(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, trees in _part_trees(batches):
        sums = trees.top()
        slot = np.flatnonzero((sums != 0).any(axis=0))
        yield _batch("slot zeros ones log_weighted", pa.array(slot), *[pa.array(sums[k][slot]) for k in range(3)])


def _answers(top: Top, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, trees in _part_trees(batches):
        yield from _list_rows("kind part keys vals", GRAM, [part], trees.grams, trees.log10(top))


def _replies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each block of a group asked for; the rows of a kind, part and group come answers first, without a block."""
    now, held, answer = None, [], None
    for row in _rows(batches):
        key = (row["kind"], row["part"], row["grp"])
        if key != now:
            now, held, answer = key, [], None
        got = _unpacked_keys(row["keys"])
        if row["block"] is None:
            held.append((got, _unpacked(row["vals"], np.int64)))  # bits of a double for grams
            continue
        if answer is None:
            answer, held = _joined(held), []
        yield from _list_rows("kind block keys vals", row["kind"], [row["block"]], got, answer[1][np.searchsorted(answer[0], got)])


class _Table:
    """Replies of one kind: a value for each key of a block."""

    def __init__(self, kind: type) -> None:
        self.kind = kind
        self.keys, self.values = np.zeros(0, np.int64), np.zeros(0, kind)
        self.new: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: bytes, values: bytes) -> None:
        self.new.append((_unpacked_keys(keys), _unpacked(values, self.kind)))

    def of(self, keys: np.ndarray) -> np.ndarray:
        if self.new:
            self.keys, self.values = _joined([(self.keys, self.values), *self.new])
            order = np.argsort(self.keys, kind="stable")
            self.keys, self.values, self.new = self.keys[order], self.values[order], []
        distinct, inverse = np.unique(keys, return_inverse=True)
        return self.values[np.searchsorted(self.keys, distinct)][inverse]


def _scored(total: int, distinct: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores of the texts of one block; the rows come replies first, then texts (kind 2)."""
    tables = {GRAM: _Table(np.float64), WORD_KEY: _Table(np.int64)}
    floor = np.log10(total + distinct + 1.0)
    for batch in _small(batches):
        is_text = np.asarray(batch.column("kind")) == 2
        for row in _rows([batch.filter(pa.array(~is_text)).select(["kind", "keys", "vals"])]):
            tables[row["kind"]].add(row["keys"], row["vals"])
        docs = batch.filter(pa.array(is_text))
        if not docs.num_rows:
            continue
        texts = [lowered(t or b"") for t in docs.column("text").to_pylist()]
        score, base, n_tokens, n_known = (np.zeros(len(texts)) for _ in range(4))
        for piece in pieces(enumerate(texts)):
            score += np.bincount(piece.owner, tables[GRAM].of(piece.keys), len(texts))
        for piece in word_pieces(enumerate(texts)):
            c = tables[WORD_KEY].of(piece.keys)
            n_tokens += np.bincount(piece.owner, minlength=len(texts))
            n_known += np.bincount(piece.owner, c > 0, len(texts))
            base += np.bincount(piece.owner, np.log10(c + 1.0) - floor, len(texts))
        yield _batch(
            "doc_id held_out n_tokens n_known base score n_bytes",
            docs.column("doc_id"),
            docs.column("held_out"),
            pa.array(n_tokens.astype(np.int64)),
            pa.array(n_known.astype(np.int64)),
            pa.array(base),
            pa.array(score),
            pa.array([len(t) for t in texts], pa.int64()),
        )


def _merge_all(lists: DataFrame, groups: int, tasks: int) -> DataFrame:
    """The lists of all blocks merged part by part, FAN groups at a time."""
    while True:
        rows = lists.repartition(tasks, "kind", "part", "grp").sortWithinPartitions("kind", "part", "grp")
        lists = written(rows.mapInArrow(_merged, "kind int, part bigint, grp bigint, keys binary, vals binary"), "context-lists")
        if groups <= 1:
            return lists
        groups = -(-groups // FAN)
        lists = lists.withColumn("grp", F.floor(F.col("grp") / FAN).cast("bigint"))


def scored_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The model's and the base line's log10 probability of every whole text.

    Learns from the texts whose crc32 of the id, as text, does not leave LEFT
    when divided by MOD, from all of them and all of each. Returns doc_id,
    held_out, n_tokens, n_known, train_tokens (longs), base_score, score
    (doubles; log10) and bits_per_byte (the model's code length, the end being
    one byte more). Only A-Z are lower-cased.

    A NULL text counts as empty: its one token is the end, and its score is that
    of ending at once. A NULL id is trained on. Repeated rows are scored and
    counted each; ties do not arise. With no training text at all every bit
    costs one bit and every token log10(1). An empty table gives an empty table;
    further columns are left out.
    """
    spark = docs.sparkSession
    narrow = columns_of(docs, doc_id=doc_id, text=text).withColumn("text", F.col("text").cast("binary"))
    left_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % MOD == LEFT, F.lit(False))
    narrow = narrow.withColumn("held_out", left_out)
    size = narrow.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    groups, parts = -(-blocks // FAN), 2 * min(blocks, 2048) + 4
    tasks = parts * groups
    # The same rows give the same block in either use: it depends on nothing but the row.
    placed = narrow.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    dealt = placed.select("block", "text", (~F.col("held_out")).alias("train")).repartitionById(blocks, F.col("block").cast("int"))
    lists = written(dealt.mapInArrow(lambda b: _block_lists(parts, b), _LISTS), "context-blocks")
    merged = _merge_all(lists.drop("block"), groups, tasks)

    grams = merged.where(F.col("kind") == GRAM).repartition(parts, "part").sortWithinPartitions("part")
    slots = grams.mapInArrow(_tops, "slot bigint, zeros double, ones double, log_weighted double")
    sums = np.zeros((3, 256 * 256))
    # At most 65 280 rows.
    for row in slots.groupBy("slot").agg(F.sum("zeros"), F.sum("ones"), F.sum("log_weighted")).collect():
        sums[:, row[0]] = row[1:]
    top = Top(sums)
    counts = merged.where(F.col("kind") == WORD_KEY).select("kind", "part", "keys", "vals")
    totals = counts.select("vals").mapInArrow(_totals, "total bigint, known bigint")
    total, distinct = totals.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()

    answers = grams.mapInArrow(lambda b: _answers(top, b), "kind int, part bigint, keys binary, vals binary").unionByName(counts)
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<bigint>"))
    answers = answers.withColumn("grp", every).withColumn("block", F.lit(None).cast("bigint"))
    both = answers.unionByName(lists.withColumn("vals", F.lit(None).cast("binary")))
    both = both.repartition(tasks, "kind", "part", "grp")
    both = both.sortWithinPartitions("kind", "part", "grp", F.col("block").asc_nulls_first())
    replies = both.mapInArrow(_replies, "kind int, block bigint, keys binary, vals binary")

    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in narrow.schema]
    texts = placed.select(F.lit(2).alias("kind"), "block", F.lit(None).cast("binary").alias("keys"), F.lit(None).cast("binary").alias("vals"), *narrow.columns)
    rows = replies.select("*", *nothing).unionByName(texts)
    rows = rows.repartitionById(blocks, F.col("block").cast("int")).sortWithinPartitions("kind")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, n_bytes bigint"
    out = rows.mapInArrow(lambda b: _scored(total, distinct, b), schema)
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
        (-F.col("score") / np.log10(2.0) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
