"""Spelling variants and periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents

from driftwarden.llm import periodic, spelling
from driftwarden.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# Periodic runs -----------------------------------------------------------------------------------------------------


def plain_runs(words):
    """All (start, length, period) by definition: every lag is scanned, then smaller periods are ruled out."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                stretch = words[i : j + q]
                if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                    out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def found_runs(words):
    return [(s, e - s, q) for s, e, q in periodic.runs_of(np.array(words, np.int64)).tolist()]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=120))
def test_runs_of_few_words(words):
    assert found_runs(words) == plain_runs(words)


@pytest.mark.parametrize("seed", range(60))
def test_runs_with_long_and_nested_periods(seed):
    rng = random.Random(seed)
    n, kinds = rng.randrange(300, 900), rng.choice([2, 3, 500])
    words = [rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randrange(1, 5)):
        a, p = rng.randrange(n), rng.randrange(1, n // 5)
        for i in range(a, min(n, a + rng.randrange(3 * p, 6 * p + 7))):
            words[i] = words[a + (i - a) % p]
    assert found_runs(words) == plain_runs(words)


def test_runs_where_everything_repeats():
    fibonacci, before = [0], [1]
    while len(fibonacci) < 600:
        fibonacci, before = fibonacci + before, fibonacci
    thue = [bin(i).count("1") % 2 for i in range(512)]
    for words in ([7] * 700, [1, 2] * 300, ([1] * 9 + [2]) * 40, fibonacci, thue * 5, [], [1] * 5, [1] * 6):
        assert found_runs(words) == plain_runs(words)


def test_equal_hashes_do_not_make_runs(monkeypatch):
    monkeypatch.setattr(periodic, "_BASE", np.uint64(0))  # prefix hashes that tell nothing apart
    rng = random.Random(5)
    unit = [rng.randrange(9) for _ in range(23)]
    words = [rng.randrange(9) for _ in range(40)] + unit * 5 + [3] + unit * 3
    got = found_runs(words)
    assert set(got) <= set(plain_runs(words))


def plain_digest(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    return (
        len(runs),
        *(best or (None,) * 3),
        best and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
    )


def check_digests(rows, texts):
    assert len(rows) == len(texts)
    have = Counter(tuple(r) for r in rows)
    assert have == Counter((i, *plain_digest(i, t)) for i, t in texts)


def test_digests_of_awkward_rows(spark, odd, empty):
    def run(docs):
        return periodic.run_digests(periodic.periodic_runs(periodic.with_planted_runs(docs)))

    short = odd.where("n_chars IS NULL OR n_chars < 1000 OR doc_id <> 3")
    want = [(r["doc_id"], r["text"]) for r in short.collect() if r["doc_id"] != 3]
    check_digests(run(short.where("doc_id IS NULL OR doc_id <> 3")).collect(), want)
    assert run(odd).count() == odd.count()
    assert run(empty).collect() == []
    texts = [" ".join(random.Random(i).choices("abc", k=i)) for i in range(150)]
    check_digests(run(documents(spark, texts)).collect(), list(enumerate(texts)))
    check_digests(run(documents(spark, texts).repartition(7)).collect(), list(enumerate(texts)))


def test_words_are_cut_at_ascii_space_only(spark):
    row = periodic.periodic_runs(documents(spark, ["a b a b\ta b\na b a b\x0ba b  "])).first()
    assert row["n_words"] == 7 and [tuple(r) for r in row["runs"]] == [(0, 6, 1)]
    assert row["collapsed"] == "a b  "


def test_pieces_of_a_batch_give_the_same(spark, monkeypatch):
    texts = [("x y " * i) + "end" for i in range(40)]
    whole = periodic._scan([t.encode() for t in texts])
    apart = [periodic._scan([t.encode()]) for t in texts]
    assert whole[0] == [a[0][0] for a in apart] and whole[2] == [a[2][0] for a in apart]
    assert [r.tolist() for r in whole[1]] == [a[1][0].tolist() for a in apart]


def test_run_query_matches_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    short = {i for i, t in texts.items() if len((t or "").split()) < 1500}
    got = QUERIES["op13_periodic_runs"](spark, SF).collect()
    assert len(got) == len(texts)
    assert any(r["n_runs"] for r in got)
    check_digests([r for r in got if r["doc_id"] in short], [(i, texts[i]) for i in short])


# Spelling variants -------------------------------------------------------------------------------------------------


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def plain_variants(counts):
    words = {w: n for w, n in counts.items() if w is not None and len(w) >= 7 and n >= 2}
    near = {w: [x for x in words if one_apart(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), form[w] and words[form[w]]))
    return out


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text(alphabet="abé", min_size=7, max_size=10), min_size=1, max_size=40))
def test_index_finds_every_word_one_edit_away(words):
    words = sorted(words)
    n = [2 + len(w) % 3 for w in words]
    for i, (a, b) in enumerate(zip(*(spelling._Task(words, n, back).search(words)[0].tolist() for back in (True, False)), strict=True)):
        assert a + b == sum(one_apart(words[i], x) for x in words)


def typos(seed, size):
    rng = random.Random(seed)
    counts = Counter()
    for _ in range(size):
        w = "".join(rng.choice("abcdeé") for _ in range(rng.randrange(7, 14)))
        counts[w] += rng.randrange(1, 2000)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(w))
            w = w[:at] + rng.choice(["", "x", w[at] + w[at]]) + w[at + 1 :]
            counts[w] += rng.randrange(1, 40)
    return counts


def frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n bigint")


@pytest.mark.parametrize("block", [40_000, 16])
def test_variants_are_the_plain_ones(spark, monkeypatch, block):
    """With blocks of 16 words nearly every group of letters is cut into several."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    counts = typos(4, 400)
    for i in range(60):  # one group of letters much larger than a block, at both ends
        counts["abc" + "".join(random.Random(i).choices("de", k=5)) + "abc"] += i
    got = spelling.spelling_variants(frame(spark, counts).repartition(5))
    assert {tuple(r) for r in got.collect()} == plain_variants(counts) and got.count() == len(plain_variants(counts))


def test_forms_are_followed_to_the_last(spark):
    counts = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "abcdefghijk": 20000, "zzzzzzz": 5}
    got = {r["word"]: r for r in spelling.spelling_variants(frame(spark, counts)).collect()}
    assert {r["root"] for w, r in got.items() if w[0] == "a"} == {"abcdefghijk"}
    assert got["zzzzzzz"]["root"] == "zzzzzzz" and got["zzzzzzz"]["form"] is None


def test_awkward_vocabularies(spark, odd, empty):
    rows = [(None, 9, "x"), ("", 9, "x"), ("abcdefg", 1, "x"), ("abcdefg", 1, "y"), ("abcdefh", None, "x"), ("word " * 3, 4, "x")]
    got = spelling.spelling_variants(spark.createDataFrame(rows, "word string, n bigint, form string"))
    assert sorted(tuple(r) for r in got.collect()) == [
        ("abcdefg", None, "abcdefg", 2, 0, None),
        ("word " * 3, None, "word " * 3, 4, 0, None),
    ]
    assert spelling.spelling_variants(spelling.planted_words(empty)).collect() == []
    assert spelling.spelling_variants(spelling.planted_words(odd)).count() == 0
    long = "a" * 3000
    got = spelling.spelling_variants(frame(spark, {long: 2, long + "b": 30, long[1:]: 2}))
    assert {(len(r["word"]), r["n_near"]) for r in got.collect()} == {(3000, 2), (3001, 1), (2999, 1)}


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7}


def test_planted_words(spark, odd):
    assert {tuple(r) for r in spelling.planted_words(odd).collect()} == set(plain_words((r["doc_id"], r["text"]) for r in odd.collect()).items())
    texts = ["ÀÉabcdefÿ ABCdefg abc÷×xyzuvw", "Straßenbahn_Haltestelle eins2zweidreivier"]
    got = dict(tuple(r) for r in spelling.planted_words(documents(spark, texts)).collect())
    assert got == plain_words(enumerate(texts))


def test_variant_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    counts = plain_words(rows)
    got = QUERIES["op12_spelling_variants"](spark, SF).collect()
    kept = {w: n for w, n in counts.items() if n >= 2}
    assert {(r["word"], r["n"]) for r in got} == set(kept.items())
    some = {r["word"]: r for r in random.Random(2).sample(got, min(len(got), 300))}
    for w, r in some.items():
        near = [x for x in kept if abs(len(x) - len(w)) < 2 and one_apart(w, x)]
        best = min(near, key=lambda x: (-kept[x], x), default=None)
        form = best if best is not None and kept[best] >= 10 * kept[w] else None
        assert (r["n_near"], r["form"], r["form_n"]) == (len(near), form, form and kept[form])
