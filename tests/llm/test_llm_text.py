"""Personal data, line dedup, licences, toxicity, quality and decontamination against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents
from pyspark.sql import functions as F

from driftwarden.llm import decontamination as D
from driftwarden.llm import common, licenses, lines, near, personal, quality, toxicity
from driftwarden.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# Personal data -----------------------------------------------------------------------------------------------------


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((3, *m.span()))
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a.@1 2-+(.9é5\n0%_", max_size=60))
def test_base_spans_are_the_plain_matches(text):
    assert personal.base_spans(text) == plain_spans(text)


def test_base_spans_of_long_runs():
    for text in ("1" * 50_000, "a" * 50_000, "1.2.3.4." * 5_000, "@" * 10_000, "+1 " * 5_000, "9 " * 20_000):
        if len(text) < 30_000:
            assert personal.base_spans(text) == plain_spans(text)
        else:
            personal.base_spans(text)


def test_personal_query_matches_plain_spans(spark):
    got = {r["doc_id"]: r for r in QUERIES["op1_personal_data"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        spans = plain_spans(r["text"] or "")
        joined = ",".join(f"{personal.KINDS[k]}:{a}:{b}" for k, a, b in spans)
        assert got[r["doc_id"]]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert got[r["doc_id"]]["n_card"] == sum(k == 2 for k, _, _ in spans)


def test_contexts_find_unseen_identifiers(spark):
    texts = [f"please call number: +1 555 010 {1000 + i} thanks {i}x" for i in range(20)]
    texts += ["please call number: 555-0199 thanks friend", "the part 555-0199-7 is plain", "nothing to see"]
    got = {r["doc_id"]: r for r in personal.personal_data(documents(spark, texts)).collect()}
    assert got[20]["n_learnt"] == 1 and got[20]["spans"] == "phone:20:28" and got[20]["n_phone"] == 0
    assert got[21]["spans"] == "" and got[22]["n_learnt"] == 0
    assert got[0]["n_phone"] == 1


def test_spaced_numbers_are_one_span(spark):
    texts = ["my phone is 0171 234 5678 please", "my phone is (0171) 234-5678 please", "my phone is 0171 - 2345 please"]
    texts += ["my phone is " + "9" * 70 + " please", "my phone is 12 34 56 78 90 12 34 56 78 90 please"]
    texts += [f"my phone is +49 30 1234 {1000 + i} please" for i in range(30)]
    got = {r["doc_id"]: r["spans"] for r in personal.personal_data(documents(spark, texts)).collect()}
    assert [got[i] for i in range(4)] == ["phone:12:25", "phone:13:27", "phone:12:23", "phone:12:82"]
    assert got[4] == "phone:12:14"  # too many digits for one identifier: the numbers stand alone


def candidates(text):
    return [text[a:b] for a, b in personal._candidates(text, [(a, b) for _, a, b in personal.base_spans(text)])]


def test_candidates():
    assert candidates("at 12 34 then a1 5 6, 7 (8) 9.") == ["12 34", "a1", "5 6", "7 (8) 9"]
    assert candidates("1\n2 3. 4 -5") == ["1", "2 3", "4 -5"]
    assert candidates("a@b +49 170 1234567 12") == ["a@b"]  # the base phone takes the 12 as well
    assert candidates("") == [] and candidates("@ . @") == []
    assert candidates("1 " * 30) == ["1"] * 30


def test_contexts_hold_whole_words():
    long = "x" * 100
    digest = hashlib.md5(long.encode()).hexdigest()
    text = f"to {long} 12 {long}"
    assert personal.contexts(text, 104, 106) == [f"{digest} _", f"to {digest} _", f"{digest} _ {digest}"]
    assert personal.contexts("12", 0, 2) == [] and personal.contexts("a" + " " * 61 + "12", 62, 64) == []


def plain_scores(edges):
    """Patterns and instances by the rule of ``learnt_patterns``, in dictionaries; also the rounds taken."""
    found, trusted, rounds = {}, {}, 0
    unknown = [(p, v) for p, v, k in edges if k < 0]
    while True:
        own, loose = Counter(), Counter(p for p, v in unknown if v not in found)
        for p, v, k in edges:
            if k >= 0:
                own[p, k] += 1
            elif v in found:
                own[p, found[v][0]] += found[v][1]
        total = Counter()
        for (p, _), n in own.items():
            total[p] += n
        for (p, k), n in own.items():
            trust = n / (total[p] + 0.25 * loose[p] + 2)
            if trust >= 0.8:
                trusted[p, k] = max(trust, trusted.get((p, k), 0))
        doubt = {}
        for p, v in unknown:
            for k in range(4):
                if v not in found and (p, k) in trusted:
                    doubt[v, k] = doubt.get((v, k), 1.0) * (1 - min(trusted[p, k], 0.999))
        fresh = {}
        for (v, k), d in sorted(doubt.items()):
            if 1 - d >= 0.9 and (v not in fresh or 1 - d > fresh[v][1]):
                fresh[v] = (k, 1 - d)
        if not fresh:
            return trusted, found, rounds
        rounds += 1
        found |= fresh


def test_patterns_are_scored_until_nothing_is_new(spark):
    sizes = [200, 100, 60, 40, 30, 20]
    edges = []
    for step, n in enumerate(sizes):
        for i in range(n):
            name, kind = f"v{step}-{i}", 3 if step == 0 else -1
            edges += [(f"{c}{step} _", name, kind) for c in "abc"]
            if step:
                edges += [(f"{c}{step - 1} _", name, -1) for c in "abc"]
    rng = random.Random(8)
    edges += [(f"w{rng.randrange(4)} _", f"r{i}", rng.choice([-1, -1, 0, 1])) for i in range(200)]
    edges += [("mail _", f"m{i}", 0) for i in range(30)] + [("mail _", "r-both", -1), ("a0 _", "r-both", -1)]
    edges = sorted(set(edges))
    trusted, found = personal.learnt_patterns(spark.createDataFrame(edges, "pattern string, value string, kind int"))
    want_trusted, want_found, rounds = plain_scores(edges)
    assert rounds == 5 and sum(v.startswith("v") for v in want_found) == sum(sizes[1:])
    assert {r["value"]: r["kind"] for r in found.collect()} == {v: k for v, (k, _) in want_found.items()}
    got = {(r["pattern"], r["kind"]): r["trust"] for r in trusted.collect()}
    assert got.keys() == want_trusted.keys() and all(got[k] == pytest.approx(want_trusted[k]) for k in got)


# Lines -------------------------------------------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, text, edits):
    s = list(text)
    for _ in range(edits):
        p, o = rng.randrange(len(s)), rng.random()
        if o < 0.33:
            s[p] = rng.choice("abcd")
        elif o < 0.66:
            del s[p]
        else:
            s.insert(p, rng.choice("abcd"))
    return "".join(s)


def allowed(a, b):
    """Edits that the shorter of two lines allows."""
    return max((edits for edits, least in lines.BANDS if min(len(a), len(b)) >= least), default=0)


def test_edit_join_is_complete(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcd ") for _ in range(rng.randint(22, 60))).strip() for _ in range(40)]
    pool = sorted({edited(rng, b, rng.randint(0, 4)) for b in base for _ in range(6)} | set(base))
    rows = spark.createDataFrame([(p,) for p in pool], "line string").select(
        "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2")
    )
    name = {r["h1"]: r["line"] for r in rows.collect()}
    got = [frozenset((name[r["h1"]], name[r["g1"]])) for r in lines.line_links(rows).collect()]
    want = {
        frozenset((a, b))
        for i, a in enumerate(pool)
        for b in pool[:i]
        if 0 < distance(a, b) <= allowed(a, b)
    }
    assert len(got) == len(set(got)) and set(got) == want


def test_edits_follow_the_length(spark):
    """Complete in every band and across the borders of the bands; very short lines are never linked."""
    rng = random.Random(6)
    texts = ["".join(rng.choice("abc") for _ in range(n)) for n in [*range(1, 30)] * 4]
    texts += ["m" * n for n in range(1, 30)] + ["Page 1 of 10", "Page 2 of 10", "Page 99 of 10", "Yes.", "The."]
    texts += [edited(rng, t, rng.randint(1, 3)) for t in texts if len(t) > 3]
    texts = sorted({t for t in texts if t.strip()})
    frame = spark.createDataFrame([(t,) for t in texts], "line string").select(
        "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2")
    )
    name = {r["h1"]: r["line"] for r in frame.collect()}
    got = [frozenset((name[r["h1"]], name[r["g1"]])) for r in lines.line_links(frame).collect()]
    want = {frozenset((a, b)) for i, a in enumerate(texts) for b in texts[:i] if distance(a, b) <= allowed(a, b)}
    assert len(got) == len(set(got)) and set(got) == want
    assert {len(p) for pair in want for p in pair} >= {9, 23, 24, 25}


def test_everyday_words_stay(spark):
    words = "Yes. The. Home Cat 100 101 USD EUR No one two six ten".split()
    got = lines.repeated_lines(documents(spark, ["\n".join(words)])).first()
    assert got["n_lines"] == len(words) and got["removed"] == []


def test_repeated_lines(spark):
    long = "a line that is long enough to be compared"
    texts = [f"{long}\nshort\nshort", f"{long}!\n\nshort", None, "", f"other\n{long[:-1]}"]
    docs = documents(spark, texts)
    got = {r["doc_id"]: r for r in lines.repeated_lines(docs).collect()}
    assert got[0]["removed"] == [2] and (got[0]["n_lines"], got[0]["n_exact"], got[0]["n_near"]) == (3, 1, 0)
    assert got[1]["removed"] == [0, 2] and (got[1]["n_exact"], got[1]["n_near"]) == (1, 1)
    assert got[2]["n_lines"] == got[3]["n_lines"] == 0
    assert got[4]["removed"] == [1]
    left = lines.without_repeats(docs, lines.repeated_lines(docs))
    assert left.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in left.collect()} == {0: f"{long}\nshort", 1: "", 2: None, 3: "", 4: "other"}


# Licences ----------------------------------------------------------------------------------------------------------


def test_notices_and_inheritance(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    files = [
        (0, "a/LICENSE", mit),
        (1, "a/b/x.py", "no notice here"),
        (2, "a/b/c/COPYING.txt", f"intro\n{apache}\nmore"),
        (3, "a/b/c/d/y.py", None),
        (4, "z/y.py", ""),
        (5, "a/b/own.py", f"# {apache} \ncode"),
        (6, None, mit),
        (7, "top.py", "text of the work and the software"),
    ]
    frame = spark.createDataFrame(files, "doc_id long, path string, text string")
    got = {r["doc_id"]: (r["license"], r["origin"], r["directory"]) for r in licenses.license_files(frame).collect()}
    assert got[0] == ("MIT", "own", None) and got[1] == ("MIT", "inherited", "a")
    assert got[2][:2] == ("Apache-2.0", "own") and got[3] == ("Apache-2.0", "inherited", "a/b/c")
    assert got[4] == got[7] == (None, None, None)
    assert got[5][:2] == ("Apache-2.0", "own") and got[6][:2] == ("MIT", "own")


def test_cosine_against_plain_count(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    wanted = {r["doc_id"] for r in docs if re.search(r"(Licensed under|licensed under|Released under the MIT)", r["text"])}
    found = QUERIES["op4_licenses"](spark, SF).where("origin = 'own'")
    assert {r["doc_id"] for r in found.collect()} == wanted


def test_ordinary_words_weigh_what_they_weigh_in_the_files(spark):
    mit = "Released under the MIT License."
    wrapped = "Permission is hereby granted, free of charge,\nto any person obtaining\na copy of this software"
    files = [f"Copyright 2021 Jane Doe\nrow {i}" for i in range(3000)]
    files += [f"Copyright 2021 Jane Doe {mit}", f"code\n\n{wrapped}\n\nmore", "Released under seal by zorn yelk quib wump"]
    frame = spark.createDataFrame([(i, f"d{i}/x", t) for i, t in enumerate(files)], "doc_id long, path string, text string")
    found = licenses.license_files(frame).where("origin = 'own'").collect()
    counts = Counter(w for t in files for w in set(re.findall(licenses.TOKEN, t.lower())))
    line, plain = (Counter(re.findall(licenses.TOKEN, t.lower())) for t in (files[3000], mit))
    idf = {w: np.log((len(files) + 1) / (counts[w] + 1)) + 1 for w in line}
    dot = sum(line[w] * plain[w] * idf[w] ** 2 for w in line)
    norm = np.sqrt(sum((line[w] * idf[w]) ** 2 for w in line) * sum((plain[w] * idf[w]) ** 2 for w in plain))
    assert {r["doc_id"] for r in found} == {3000, 3001}
    assert {r["doc_id"]: r["score"] for r in found}[3000] == pytest.approx(dot / norm, abs=1e-6)


# Toxicity ----------------------------------------------------------------------------------------------------------


def slow_segments(weights):
    """All maximal segments by their definition: the best one, then the same on what lies left and right of it."""
    if not any(w > 0 for w in weights):
        return []
    best = max(
        ((a, b) for a in range(len(weights)) for b in range(a + 1, len(weights) + 1)),
        key=lambda p: (sum(weights[p[0] : p[1]]), -(p[1] - p[0])),
    )
    a, b = best
    right = [(x + b, y + b, s) for x, y, s in slow_segments(weights[b:])]
    return [*slow_segments(weights[:a]), (a, b, float(sum(weights[a:b]))), *right]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([-7, -5, -3, -2, 2, 3, 4, 11]), max_size=12))
def test_maximal_segments(weights):
    got = toxicity.maximal_segments([float(w) for w in weights])
    assert sum(s for _, _, s in got) == sum(s for _, _, s in slow_segments(weights))
    assert max((s for _, _, s in got), default=0) == max((s for _, _, s in slow_segments(weights)), default=0)


def labelled(spark, column):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    query = {"toxic": "op7_toxicity", "quality": "op6_quality"}[column]
    scored = QUERIES[query](spark, "/root/testdata/sf0.1").where("held_out")
    return scored.join(labels.withColumnRenamed(column, "truth"), "doc_id").toPandas()


def area(frame):
    ranks = frame["score"].rank()
    n1 = int((frame.truth == 1).sum())
    return (ranks[frame.truth == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(frame) - n1))


def test_toxicity_on_held_out_labels(spark):
    frame = labelled(spark, "toxic")
    assert area(frame) > 0.95
    assert ((frame.predicted == 1) & (frame.truth == 0)).sum() <= 0.02 * len(frame)


def test_quality_on_held_out_labels(spark):
    frame = labelled(spark, "quality")
    assert area(frame) > 0.95 and (frame.predicted == frame.truth).mean() > 0.9


def test_held_out_labels_are_never_read(spark, odd):
    """Labels of held-out rows alone teach nothing."""
    ids = [i for i in range(400) if __import__("zlib").crc32(str(i).encode()) % 4 == 2]
    docs = spark.createDataFrame([(i, "idiot words" if i % 2 else "fine words") for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    scores = {r["score"] for r in toxicity.toxic_documents(docs, labels).collect()}
    assert len(scores) == 1


def test_discriminant_density():
    rng = np.random.default_rng(1)
    x0, x1 = rng.normal(0, 2, (500, 3)), rng.normal(1, 0.5, (500, 3))
    found = {k: (float(len(x)), x.sum(0), x.T @ x) for k, x in ((0, x0), (1, x1))}
    model = quality.discriminant(found)
    at = rng.normal(0.5, 1, (20, 3))
    own = [found[k][2] / 500 - np.outer(*[found[k][1] / 500] * 2) for k in (0, 1)]
    pooled = (own[0] + own[1]) / 2
    sides = []
    for k in (0, 1):
        cov = (1 - quality.RIDGE) * ((1 - quality.POOLED) * own[k] + quality.POOLED * pooled)
        cov += quality.RIDGE * np.diag(np.diag(pooled)) + 1e-6 * np.eye(3)
        d = at - found[k][1] / 500
        sides.append(-0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert np.allclose(model.difference(at), sides[1] - sides[0])


# Decontamination ---------------------------------------------------------------------------------------------------


def slow_tiling(item, doc, least):
    """Greedy string tiling by its definition."""
    used_i, used_j, tiles = set(), set(), []
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while (
                    i + k < len(item)
                    and j + k < len(doc)
                    and item[i + k] == doc[j + k]
                    and i + k not in used_i
                    and j + k not in used_j
                ):
                    k += 1
                if k >= least and (best is None or k > best[2]):
                    best = (i, j, k)
        if best is None:
            return sorted(tiles)
        i, j, k = best
        used_i |= set(range(i, i + k))
        used_j |= set(range(j, j + k))
        tiles.append(best)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=4, max_size=12), st.lists(st.sampled_from("abc"), min_size=4, max_size=16))
def test_tiles_cover_what_greedy_tiling_covers(item, doc):
    own, theirs = ({r["hash"]: r["places"] for r in D.runs_of(D.shingles.word_hashes(w))} for w in (item, doc))
    hits = [(places, theirs[h]) for h, places in own.items() if h in theirs]
    got = D.covering(hits, len(item), 0.0)[1] if hits else []
    want = slow_tiling(item, doc, D.TILE)
    assert sorted((k for _, _, k in got), reverse=True)[:1] == sorted((k for _, _, k in want), reverse=True)[:1]
    assert all(item[i : i + k] == doc[j : j + k] for i, j, k in got)
    assert len({i + x for i, _, k in got for x in range(k)}) == sum(k for _, _, k in got)


def test_reordered_passage_is_found(spark):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi".split()
    items = spark.createDataFrame([(7, " ".join(passage)), (8, None), (9, ""), (10, "two words")], "item_id long, text string")
    moved = passage[10:] + ["and"] + passage[:5] + ["then"] + passage[5:10]
    texts = ["Intro. " + " ".join(moved).title() + " outro", "clean words only in this text", None, "", " ".join(passage[:6])]
    docs = documents(spark, texts)
    rows = D.contaminated(docs, items).collect()
    assert [(r["doc_id"], r["item_id"], r["covered"], len(r["tiles"])) for r in rows] == [(0, 7, 16, 3)]
    left = D.without_benchmark(docs, items)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {1, 2, 3, 4}


def test_seed_join_is_the_plain_tiling(spark, monkeypatch):
    """Every document against every item, also where the filter of the seeds lets nearly every run through."""
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = {r["doc_id"]: D.word_hashes(r["text"]) for r in docs.collect()}
    want = {}
    for r in bench.collect():
        words = D.word_hashes(r["text"])
        own = {h["hash"]: h["places"] for h in D.runs_of(words)}
        for i, text in texts.items():
            hits = [(own[h["hash"]], h["places"]) for h in D.runs_of(text) if h["hash"] in own]
            covered, tiles = D.covering(hits, len(words), D.COVERAGE) if hits else (0, [])
            if covered >= D.COVERAGE * len(words) > 0:
                want[i, r["item_id"]] = (len(words), covered, tiles)

    def rows():
        found = D.contaminated(docs, bench).collect()
        return {(r["doc_id"], r["item_id"]): (r["item_words"], r["covered"], [tuple(t) for t in r["tiles"]]) for r in found}

    assert want and rows() == want
    left = {r["doc_id"] for r in D.without_benchmark(docs, bench).collect()}
    assert left == set(texts) - {i for i, _ in want}
    monkeypatch.setattr(common, "_LEAST_BITS", 15)
    monkeypatch.setattr(common, "_MOST_BITS", 15)
    assert rows() == want


def test_filter_marks_every_key(spark):
    keys = spark.range(0, 3000, 3).select(F.xxhash64("id").alias("key"))
    marked = common.may_hold(spark.range(6000), F.xxhash64("id"), keys, "may")
    got = {r["id"]: r["may"] for r in marked.collect()}
    assert len(got) == 6000 and all(got[i] for i in range(0, 3000, 3))
    assert sum(got.values()) < 2000  # few others: two thirds of the bits would be far more
    none = common.may_hold(spark.range(5).withColumn("n", F.lit(None).cast("long")), F.col("n"), keys.limit(0), "may")
    assert none.columns == ["id", "n", "may"] and not any(r["may"] for r in none.collect())


# Awkward tables ----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["personal", "lines", "licenses", "toxicity", "quality", "decontamination"])
def test_awkward_tables(spark, odd, empty, name):
    labels = spark.createDataFrame([(4, 0, 1), (6, 1, 0), (None, 1, 1)], "doc_id long, toxic int, quality int")
    bench = spark.createDataFrame([(1, None), (2, "one two three four five six")], "item_id long, text string")
    run = {
        "personal": personal.personal_data,
        "lines": lines.repeated_lines,
        "licenses": lambda d: licenses.license_files(d.withColumn("path", F.col("source"))),
        "toxicity": lambda d: toxicity.toxic_documents(d, labels),
        "quality": lambda d: quality.quality_documents(d, labels),
        "decontamination": lambda d: D.contaminated(d, bench),
    }[name]
    got = run(odd).collect()
    if name == "decontamination":
        assert sorted(r["doc_id"] for r in got) == [4, 4, 5]
    else:
        assert len(got) == odd.count()
    assert run(empty).collect() == []


# Row order ---------------------------------------------------------------------------------------------------------


def arrangements(docs):
    """The same rows dealt otherwise, sorted, joined and repartitioned by a key."""
    ids = docs.select("doc_id").distinct()
    return [docs.repartition(7), docs.orderBy("text"), docs.join(ids, "doc_id"), docs.repartition(3, "source"), docs.coalesce(1)]


def rows_of(frame):
    return sorted(map(repr, frame.collect()))


def test_lines_and_licenses_do_not_depend_on_how_rows_lie(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 300")
    files = docs.withColumn("path", F.concat_ws("/", "lang", (F.col("doc_id") % 7).cast("string"), F.col("doc_id").cast("string")))
    want, licensed = rows_of(lines.repeated_lines(docs)), rows_of(licenses.license_files(files))
    assert any("own" in r for r in licensed)
    for other in arrangements(docs):
        assert rows_of(lines.repeated_lines(other)) == want
    for other in arrangements(files):
        assert rows_of(licenses.license_files(other)) == licensed


def test_toxicity_does_not_depend_on_how_rows_lie(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    again = labels.unionByName(labels.withColumn("toxic", 1 - F.col("toxic")).where("doc_id % 50 = 0"))  # labelled both ways

    def scores(n):
        found = toxicity.toxic_documents(docs.repartition(n), again.repartition(n))
        return {r["doc_id"]: r["score"] for r in found.collect()}

    three, eleven = scores(3), scores(11)
    assert three.keys() == eleven.keys()
    assert max(abs(three[k] - eleven[k]) for k in three) < 1e-12


def test_text_ids(spark):
    passage = " ".join(f"word{i}" for i in range(40))
    docs = documents(spark, [passage, f"so {passage} end", "other words entirely", passage])
    docs = docs.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    bench = spark.createDataFrame([("item a", passage)], "item_id string, text string")
    assert {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, bench).collect()} == {(f"d{i}", "item a") for i in (0, 1, 3)}
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near.near_documents(docs).collect()}
    assert got == {"d0": ("d0", 2), "d1": ("d0", 2), "d2": ("d2", 0), "d3": ("d0", 2)}
    assert {r["doc_id"] for r in near.distinct_documents(docs).collect()} == {"d0", "d2"}
    found = {r["doc_id"]: r["n_near"] for r in lines.repeated_lines(docs).collect()}
    assert set(found) == {"d0", "d1", "d2", "d3"}
