"""Jaccard join, vectors, mixing, sharding and the pipeline against brute force."""

import random
import sys
from pathlib import Path
from collections import Counter

import numpy as np
import pytest
from compare import connect, difference
from llm_cases import documents
from pyspark.sql import functions as F

from driftwarden.llm import mixing, near, sharding, shingles, vectors
from driftwarden.llm.common import components
from driftwarden.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def classes(n, pairs):
    root = list(range(n))
    for a, b in pairs * n if n < 3 else pairs:
        while root[a] != a:
            a = root[a]
        while root[b] != b:
            b = root[b]
        root[max(a, b)] = min(a, b)
    for i in range(n):
        while root[i] != root[root[i]]:
            root[i] = root[root[i]]
    return root


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_agrees_with_sql(spark, name):
    assert difference(spark, connect(SF), SF, QUERIES[name], ORACLE[name]) is None


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(200, 200 + i) for i in range(1, 80)]
    loose = [(rng.randrange(300, 500), rng.randrange(300, 500)) for _ in range(120)]
    pairs = chain + star + loose + [(7, 7)]
    edges = spark.createDataFrame([p[:: rng.choice([1, -1])] for p in pairs], "u long, v long")
    root = classes(500, pairs)
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: root[x] for x in linked}


# Jaccard join ------------------------------------------------------------------------------------------------------


def shingle_sets(texts):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return sets


def similar(sets, threshold):
    return [
        (i, j)
        for i, a in enumerate(sets)
        for j, b in enumerate(sets[:i])
        if a and b and len(a & b) >= threshold * len(a | b) - 1e-9
    ]


def near_texts():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    return [*texts, None, "", " ", texts[0], texts[0].upper(), texts[3]]


@pytest.mark.parametrize("small", [2048, 4])
def test_jaccard_join_finds_all_links(spark, monkeypatch, small):
    """With tiny buckets the splitting and the block-by-block comparison are at work too."""
    monkeypatch.setattr(near, "SMALL", small)
    texts = near_texts()
    pairs = similar(shingle_sets(texts), near.THRESHOLD)
    root, links = classes(len(texts), pairs), Counter(x for p in pairs for x in p)
    got = {r["doc_id"]: r for r in near.near_documents(documents(spark, texts)).collect()}
    assert {i: r["n_links"] for i, r in got.items()} == {i: links[i] for i in range(len(texts))}
    assert {i: r["class_id"] for i, r in got.items()} == dict(enumerate(root))
    kept = near.distinct_documents(documents(spark, texts))
    assert "shard" in kept.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(len(texts)) if root[i] == i]


def test_shingle_hashes_tell_words_apart(monkeypatch):
    words = ["a", "ab", "b", "a", "é", "ab", "a" * 300]
    h = shingles.word_hashes(words)
    assert len(set(h.tolist())) == 5 and h[0] == h[3] and h[1] == h[5]
    monkeypatch.setattr(shingles, "_BLOCK", 3)
    assert (shingles.word_hashes(words) == h).all()
    s = shingles.shingle_hashes(shingles.word_hashes("a b c d e a b c d e".split()))
    assert len(s) == 6 and s[0] == s[5] and len(set(s.tolist())) == 5


def test_awkward_near(spark, odd, empty):
    got = near.near_documents(odd).collect()
    assert len(got) == odd.count()
    assert sorted(r["n_links"] for r in got) == [0] * 7 + [2, 2, 2]
    assert near.near_documents(empty).collect() == [] and near.distinct_documents(empty).collect() == []
    kept = near.distinct_documents(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 2


# Vectors -----------------------------------------------------------------------------------------------------------


def test_vectors_find_all_links(spark):
    rng = np.random.default_rng(3)
    rows, n = [], 0
    for size in (1, 1, 2, 3, 40, 150):
        base = rng.standard_normal(16)
        for _ in range(size):
            rows.append((n, [float(x) for x in base + rng.standard_normal(16) * 0.12]))
            n += 1
    rows += [(n + i, [float(x) for x in rng.standard_normal(16)]) for i in range(300)]
    n = len(rows)
    rows += [(n, rows[5][1]), (n + 1, [2 * x for x in rows[5][1]])]
    ids = np.array([r[0] for r in rows])
    e = np.array([r[1] for r in rows])
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    pairs = [(int(a), int(b)) for a, b in np.argwhere(e @ e.T >= 0.95) if a < b]
    odd = [(9000, None), (9001, []), (9002, [0.0] * 16), (9003, [float("nan")] * 16), (9004, [None] * 16), (9005, [1e200] * 16)]
    frame = spark.createDataFrame([(*r, 1) for r in rows + odd], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in vectors.near_vectors(frame).collect()}
    links, root = Counter(x for p in pairs for x in p), classes(len(rows), pairs)
    assert len(got) == len(rows) + len(odd)
    assert {int(i): got[i]["n_links"] for i in ids} == {int(i): links[int(i)] for i in ids}
    assert {int(i): got[i]["component_id"] for i in ids} == {int(i): root[int(i)] for i in ids}
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i, _ in odd)
    assert vectors.near_vectors(frame.limit(0)).collect() == []


def test_vectors_find_links_in_a_dense_group(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal(64)
    base /= np.linalg.norm(base)
    dense = base + rng.standard_normal((3300, 64)) * 0.0417  # mutual cosine about 0.9 and below
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    partners = dense[:150] + rng.standard_normal((150, 64)) * 0.038
    e = np.concatenate([dense, partners, rng.standard_normal((3000, 64))])
    u = e / np.linalg.norm(e, axis=1, keepdims=True)
    assert 0.6 < np.median(u[:3300] @ u[0]) < 0.92
    pairs = [(int(a), int(b)) for a, b in np.argwhere(u @ u.T >= 0.95) if a < b]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(e)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in vectors.near_vectors(frame).collect()}
    links, root = Counter(x for p in pairs for x in p), classes(len(e), pairs)
    assert len(pairs) > 1000
    assert all(got[i]["n_links"] <= links[i] for i in range(len(e)))
    assert sum(links[i] - got[i]["n_links"] for i in range(len(e))) <= 0.001 * links.total()
    assert sum(got[i]["component_id"] != root[i] for i in range(len(e))) <= 0.001 * len(e)


def test_passes_follow_the_size():
    assert vectors.passes_for(10) == 1 < vectors.passes_for(10_000) < vectors.passes_for(10**9)


# Mixing ------------------------------------------------------------------------------------------------------------


def filled(sizes, weights, budget, most):
    """Targets by handing out the excess again and again."""
    left, target, open_ = budget * sum(sizes), [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s]
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] > most * sizes[i]]
        if not full:
            for i in open_:
                target[i] = unit * weights[i]
            break
        for i in full:
            target[i] = most * sizes[i]
            left -= target[i]
        open_ = [i for i in open_ if i not in full]
    return target


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1000, 1, 1, 5, 0], [3, 900, 20, 20, 7, 1], [5]])
def test_targets(spark, sizes):
    frame = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(sizes)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
    want = filled(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))], 1.5, 2.0)
    assert [got[f"s{i}"] for i in range(len(sizes))] == pytest.approx(want)


def test_mix_repeats_rows(spark, odd, empty):
    texts = [" ".join(["w"] * (1 + i % 7)) for i in range(600)]
    docs = documents(spark, texts, [("a", "b", None)[i % 3] for i in range(600)])
    rows = mixing.mixed(docs).collect()
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    taken = Counter(r["doc_id"] for r in out.collect())
    assert taken == Counter({r["doc_id"]: r["copies"] for r in rows if r["copies"]})
    for source in ("a", "b", None):
        own = [r for r in rows if r["source"] == source]
        assert sum(r["copies"] * r["size"] for r in own) == pytest.approx(own[0]["target"], rel=0.12)
    assert sorted(mixing.mixed(docs).collect()) == sorted(rows)
    assert mixing.mixed(odd).count() == odd.count() and mixing.mixed(empty).collect() == []
    assert mixing.mix(odd).columns == odd.columns


# Sharding ----------------------------------------------------------------------------------------------------------


def test_shards_are_even_and_keep_equal_texts(spark, odd, empty):
    rng = random.Random(1)
    texts = [f"text {rng.randrange(250)}" if i % 2 else f"own {i}" for i in range(1000)] + ["hot"] * 300
    rows = sharding.shard_documents(documents(spark, texts), 10).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert len(rows) == 1300 and set(sizes.values()) == {130}
    assert sorted((r["shard"], r["slot"]) for r in rows) == [(s, k) for s in range(10) for k in range(130)]
    spread = {}
    for r in rows:
        spread.setdefault(texts[r["doc_id"]], Counter())[r["shard"]] += 1
    groups = {t: s for t, s in spread.items() if s.total() > 1}
    assert sum(n for _, n in groups["hot"].most_common(4)) >= 0.8 * 300
    assert sum(len(s) > 1 for s in groups.values()) <= 0.1 * len(groups)
    again = sharding.shard_documents(documents(spark, texts), 10).collect()
    assert sorted((r["doc_id"], r["shard"]) for r in again) == sorted((r["doc_id"], r["shard"]) for r in rows)
    assert sharding.shard_documents(odd, 4).count() == odd.count()
    assert sharding.shard_documents(empty, 4).collect() == []


@pytest.mark.parametrize("share", [0.6, 1.5])
def test_large_groups_take_no_more_shards_than_they_need(spark, share):
    quota = 200
    size = int(share * quota)
    texts = ["hot"] * size + [f"pair {i // 2}" for i in range(300)] + [f"own {i}" for i in range(10 * quota - size - 300)]
    rows = sharding.shard_documents(documents(spark, texts), 10).collect()
    spread = Counter(r["shard"] for r in rows if texts[r["doc_id"]] == "hot")
    needed = -(-size // quota)
    assert sum(n for _, n in spread.most_common(needed)) >= 0.99 * size
    whole = Counter()
    for r in rows:
        if texts[r["doc_id"]].startswith("pair"):
            whole[texts[r["doc_id"]], r["shard"]] += 1
    assert sum(n == 2 for n in whole.values()) >= 0.95 * 150


# Pipeline ----------------------------------------------------------------------------------------------------------


def test_pipeline(spark):
    sys.path[:0] = [str(Path(__file__).parents[2])]
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    after = {"": docs}
    for name, stage in P.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF)
        assert docs.columns == before.columns, name
        after[name] = docs = spark.createDataFrame(docs.toPandas(), docs.schema)
    ids = {k: [r["doc_id"] for r in v.select("doc_id").collect()] for k, v in after.items()}
    texts = {r["doc_id"]: r["text"] for r in after["toxicity"].collect()}
    order = sorted(texts)
    pairs = similar(shingle_sets([texts[i] for i in order]), near.THRESHOLD)
    root = classes(len(order), pairs)
    assert sorted(ids["near_duplicates"]) == [order[i] for i in range(len(order)) if root[i] == i]
    assert set(ids["decontamination"]) <= set(ids["near_duplicates"])
    assert max(Counter(ids["mixing"]).values()) <= 2
    rows = P.run(spark, SF).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(ids["mixing"])


def test_buckets_carry_sketches_not_tokens(spark, monkeypatch):
    tokens = np.random.default_rng(3).integers(0, 1 << 32, near.TOKENS, dtype=np.uint32)
    data = near.packed(tokens)
    assert (near.unpacked(data) == tokens).all()
    assert data[: near.TOKENS] == tokens.tobytes()[::4]
    seen = []
    plain = near._sorted
    monkeypatch.setattr(near, "_sorted", lambda rows: seen.append(rows) or plain(rows))
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, "other words")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in near.near_documents(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
    assert len(seen) == 2 and all("tokens" not in rows.columns for rows in seen)
    assert {r["n"] for rows in seen for r in rows.select(F.length("sketch").alias("n")).collect()} == {near.TOKENS}


def test_different_members_with_one_token_share_no_path():
    """Tokens have 32 bits: over many sets they meet by chance, which must not make buckets grow faster than the input."""
    rng = np.random.default_rng(6)
    a = np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64))
    turned = rng.integers(1, 1 << 32, len(a), dtype=np.uint64)
    b = np.sort(a ^ (turned << np.uint64(32)) ^ turned)
    tokens = near.tokens_of(a)
    assert (near.tokens_of(b) == tokens).all() and not set(a.tolist()) & set(b.tolist())
    mine, others = near.named(a, tokens), near.named(b, tokens)
    assert set(mine.tolist()) <= set(a.tolist()) and set(others.tolist()) <= set(b.tolist())
    assert all(near.tokens_of(np.array([m], np.uint64))[i] == tokens[i] for i, m in enumerate(mine))
    paths = [set(near.extended(near._ROOTS, x).tolist()) for x in (mine, others)]
    assert paths[0] and paths[1] and not paths[0] & paths[1]


def test_tokens_and_shingle_sets_are_written_once(spark, monkeypatch):
    """Ids that are NULL or repeated, splits at work: what travels is sketches, and texts only to likely pairs."""
    seen, marked, plain, held = [], [], near.written, near.may_hold
    monkeypatch.setattr(near, "written", lambda df, label: seen.append((label, df.columns)) or plain(df, label))
    monkeypatch.setattr(near, "may_hold", lambda df, key, keys, name: marked.append(df.columns) or held(df, key, keys, name))
    monkeypatch.setattr(near, "SMALL", 2)
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text), (2, text + " end"), (2, text + " end"), (3, text + " last"), (4, "other words"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r["doc_id"] or 0, r["class_id"] or 0, r["n_links"], r["n_copies"]) for r in near.near_documents(docs).collect())
    assert got == [(0, 2, 3, 1), (2, 2, 3, 2), (2, 2, 3, 2), (3, 2, 3, 1), (4, 4, 0, 1), (5, 5, 0, 1)]
    assert {label for label, columns in seen if "tokens" in columns} == {"near-base"}
    assert not any("members" in columns or "text" in columns for _, columns in seen)
    assert ["node", "tokens"] in marked
