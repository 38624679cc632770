"""Context-tree weighting and its base line against a plain recursion over all contexts."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import documents

from driftwarden.llm import context_tree as C
from driftwarden.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def is_held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def plain_bytes(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())


class PlainTree:
    """Every node of every context as a pair of counts; probabilities by the textbook recursion."""

    def __init__(self, texts, depth):
        self.depth = depth
        self.counts = defaultdict(lambda: [0, 0])
        self.children = defaultdict(set)
        for text in texts:
            for context, prefix, bit in self.bits(text):
                for d in range(depth + 1):
                    self.counts[context[:d], prefix][bit] += 1
                    if d:
                        self.children[context[: d - 1], prefix].add(context[:d])
        self.memo = {}

    def bits(self, text):
        data = b"\xff" * self.depth + text + b"\xff"
        for i in range(self.depth, len(data)):
            context = data[i - self.depth : i][::-1]
            for j in range(8):
                yield context, (1 << j) | (data[i] >> (8 - j)), data[i] >> (7 - j) & 1

    def kt(self, node):
        a, b = self.counts.get(node, (0, 0))
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def below(self, node):
        return sum(self.weighted((child, node[1])) for child in self.children.get(node, ()))

    def weighted(self, node):
        if node not in self.memo:
            kt = self.kt(node)
            if len(node[0]) < self.depth:
                low = self.below(node)
                top = max(kt, low)
                kt = top + math.log((math.exp(kt - top) + math.exp(low - top)) / 2)
            self.memo[node] = kt
        return self.memo[node]

    def predict(self, context, prefix, bit):
        p = None
        for d in range(self.depth, -1, -1):
            node = (context[:d], prefix)
            n = self.counts.get(node, (0, 0))
            own = (n[bit] + 0.5) / (n[0] + n[1] + 1)
            if p is None:
                p = own
            else:
                share = 1 / (1 + math.exp(min(700, self.below(node) - self.kt(node))))
                p = share * own + (1 - share) * p
        return p

    def log10(self, text):
        return sum(math.log10(self.predict(*x)) for x in self.bits(text))


def plain_scores(rows, depth):
    train = [plain_bytes(t) for i, t in rows if not is_held(i)]
    tree = PlainTree(train, depth)
    split = {t: re.findall(rb"[^\x20\x09-\x0D]+", t) + [b""] for t in {plain_bytes(t) for _, t in rows}}
    counts = Counter(w for t in train for w in split[t])
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        words = split[plain_bytes(t)]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        known = sum(counts[w] > 0 for w in words)
        out.append((i, is_held(i), len(words), known, total, base, tree.log10(plain_bytes(t))))
    return out


def check(got, want):
    def key(r):
        return (r[0] is None, r[0] or 0, r[2], round(r[6], 6))

    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:7] for r in got], [r[5:7] for r in want], rtol=1e-9, atol=1e-9)


def some_texts(seed, n):
    rng = random.Random(seed)
    words = ["ab", "abra", "Cadabra", "é", "x", "1,", "the", "THE"]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(12))) for _ in range(n)]


@pytest.mark.parametrize(("block", "fan", "piece", "row"), [(64 << 20, 256, 1 << 19, 1 << 20), (150, 3, 40, 7)])
def test_scores_are_those_of_the_plain_tree(spark, monkeypatch, block, fan, piece, row):
    """Also where texts are cut into pieces, dealt into many blocks and merged over several rounds."""
    for name, value in (("BLOCK_BYTES", block), ("FAN", fan), ("PIECE", piece), ("ROW", row)):
        monkeypatch.setattr(C, name, value)
    texts = some_texts(1, 60)
    docs = documents(spark, texts)
    want = plain_scores(list(enumerate(texts)), C.DEPTH)
    check(C.scored_texts(docs).collect(), want)
    check(C.scored_texts(docs.repartition(7)).collect(), want)


def test_awkward_rows(spark, odd, empty):
    rows = odd.where("doc_id <> 3 OR doc_id IS NULL")
    check(C.scored_texts(rows).collect(), plain_scores([(r["doc_id"], r["text"]) for r in rows.collect()], C.DEPTH))
    assert C.scored_texts(odd).count() == odd.count()
    assert C.scored_texts(empty).collect() == []
    held = next(i for i in range(100) if is_held(i))
    only = spark.createDataFrame([(held, "ab c", "x")], "doc_id bigint, text string, score string")
    got = C.scored_texts(only).first()  # nothing to learn from
    assert (got["n_tokens"], got["n_known"], got["train_tokens"], got["base_score"]) == (3, 0, 0, 0.0)
    assert got["bits_per_byte"] == pytest.approx(8.0)
    by_name = spark.createDataFrame([("a", "some text"), ("b", "some text")], "doc_id string, text string")
    assert {r["doc_id"] for r in C.scored_texts(by_name).collect()} == {"a", "b"}


def test_probabilities_of_a_byte_add_up_to_one():
    texts = [plain_bytes(t) for t in some_texts(3, 20)]
    piece = C._piece([b"\xff" * C.DEPTH + t + b"\xff" for t in texts], list(range(len(texts))))
    keys, counts = C._counted(piece.keys)
    context = b"\xff\xffabr"[::-1]
    nearest_first = int.from_bytes(context, "big") << 8
    asked = nearest_first + np.arange(256)
    grams, counts = C._counted(np.concatenate([keys, asked]), np.concatenate([counts, np.zeros(256, np.int64)]))
    parts = C.part_of(C.GRAM, grams, 5)
    trees = [C.Subtrees(grams[parts == p], counts[parts == p]) for p in range(5)]
    top = C.Top(sum(t.top() for t in trees))
    p = np.concatenate([10 ** t.log10(top) for t in trees])
    order = np.argsort(np.concatenate([t.grams for t in trees]))
    assert p[order][np.searchsorted(grams, asked)].sum() == pytest.approx(1.0, abs=1e-12)


def test_log_gamma():
    x = np.concatenate([np.arange(0.5, 40, 0.5), [1e3 + 0.5, 1e6, 1e9]])
    assert np.allclose(C.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-11)


def test_query_beats_the_base_line_on_held_out_texts(spark):
    got = QUERIES["op11_context_tree"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert len(got) > 100
    assert sum(r["score"] for r in got) < 0
    bits = sum(-r["score"] for r in got) / math.log10(2) / sum(-r["score"] / math.log10(2) / r["bits_per_byte"] for r in got)
    assert bits < 2.3


def test_query_matches_the_plain_base_line(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in QUERIES["op11_context_tree"](spark, SF).collect()}
    for row in plain_scores(rows, 0):
        mine = got[row[0]]
        assert tuple(mine)[1:5] == row[1:5] and mine["base_score"] == pytest.approx(row[5], rel=1e-9)
