"""Fold roles against plain Python, and ordered cuts that leave the rows where they lie."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from driftwarden.operators import folds as N
from driftwarden.operators import split as S


def plain_roles(rows, k, c_min, seed, guard):
    """rows: (id, entity, y, own, order); training negatives by hash, last row per id and side, entities on one side."""
    out = {}
    for f in range(k):
        role = {i: "validation" if r[3] == f else "training" for i, r in enumerate(rows)}
        positives = sum(role[i] == "training" and r[2] == 1 for i, r in enumerate(rows))
        hashed = sorted((hashlib.md5(f"{r[0]}|{seed}".encode()).hexdigest(), i) for i, r in enumerate(rows) if role[i] == "training" and r[2] != 1)
        for _, i in hashed[int(positives / c_min - positives) :]:
            role[i] = None
        if guard:
            for side in ("training", "validation"):
                last = {}
                for i, r in enumerate(rows):
                    if role[i] == side and (r[0] not in last or r[4] > rows[last[r[0]]][4]):
                        last[r[0]] = i
                for i, r in enumerate(rows):
                    if role[i] == side and last[r[0]] != i:
                        role[i] = None
            trains = {r[1] for i, r in enumerate(rows) if role[i] == "training"}
            for i, r in enumerate(rows):
                if role[i] == "validation" and r[1] in trains:
                    role[i] = None
        for i in role:
            out[i, f] = role[i]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_roles_of_every_fold(spark, seed):
    rng = random.Random(seed)
    ids = rng.sample(range(1000), 300)
    rows = [(i, rng.randrange(60) or None, int(rng.random() < 0.05), rng.randrange(4), n) for n, i in enumerate(ids)]
    data = [(*r, n) for n, r in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, entity int, y int, own int, at int, n int").repartition(5)
    thinned = N.undersampled(N.with_roles(df, "own", 4), ["id"], "y", 4, 0.2)
    want = plain_roles(rows, 4, 0.2, 60, False)
    assert {(r["n"], f): role for r in thinned.collect() for f, role in enumerate(r["fold_roles"])} == want
    assert any(v is None for v in want.values())
    got = N.guarded(thinned, ["id"], "entity", ["at"], 4)
    want = plain_roles(rows, 4, 0.2, 60, True)
    assert {(r["n"], f): role for r in got.collect() for f, role in enumerate(r["fold_roles"])} == want
    assert got.columns == [*df.columns, "fold_roles"]


def test_repeated_ids_keep_their_last_row_on_each_side(spark):
    rows = [(1, 10 + k, k, own) for k, own in enumerate([0, 0, 1, 1])] + [(None, 99, 0, 0), (None, 99, 1, 0)]
    df = spark.createDataFrame(rows, "id int, entity int, at int, own int")
    got = {(r["id"], r["at"]): list(r["fold_roles"]) for r in N.guarded(N.with_roles(df, "own", 2), ["id"], "entity", ["at"], 2).collect()}
    assert got[1, 1] == ["validation", "training"] and got[1, 3] == ["training", "validation"]
    assert got[1, 0] == got[1, 2] == [None, None] and got[None, 0] == [None, None] and got[None, 1] == ["validation", "training"]


def test_ordered_roles_and_empty_frames(spark):
    df = spark.range(12).withColumn("own", (F.col("id") % 4 - 1).cast("int"))
    roles = {r["own"]: list(r["fold_roles"]) for r in N.with_roles(df, "own", 3, ordered=True).collect()}
    assert roles == {-1: ["training"] * 3, 0: ["validation", "training", "training"], 1: [None, "validation", "training"], 2: [None, None, "validation"]}
    empty = N.with_roles(df.limit(0).withColumns({"y": F.lit(1), "e": F.lit(1)}), "own", 3)
    assert N.guarded(N.undersampled(empty, ["id"], "y", 3), ["id"], "e", ["id"], 3).collect() == []


# Ordered cuts ------------------------------------------------------------------------------------------------------


def keyed(spark, n=97):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, 1, 2, 3]), rng.choice("ab") if i % 9 else None, "wide" * 20) for i in range(n)]
    return spark.createDataFrame(rows, "id int, t int, c string, payload string").repartition(6)


def by_key(r):
    return (r["t"] is not None, r["t"] or 0, r["id"])


def blocks(n, k):
    return [f for f in range(k) for _ in range(n // k + (f < n % k))]


def test_cuts_are_those_of_the_sorted_rows(spark):
    df = keyed(spark)
    order = ["t", "id"]
    rows = sorted(df.collect(), key=by_key)
    assert {r["id"]: r["fold"] for r in S.kfold(df, order, 5).collect()} == dict(zip([r["id"] for r in rows], blocks(97, 5)))
    got = {r["id"]: r["fold"] for r in S.stratified_kfold(df, "c", order, 5).collect()}
    for c in (None, "a", "b"):
        own = [r["id"] for r in rows if r["c"] == c]
        assert [got[i] for i in own] == blocks(len(own), 5)
    got = {r["id"]: r["split"] for r in S.time_split(df, order, 0.3).collect()}
    assert [got[r["id"]] for r in rows] == ["train"] * int(0.7 * 97) + ["validation"] * (97 - int(0.7 * 97))
    got = {r["id"]: r["fold"] for r in S.timeseries_kfold(df, order, 4).collect()}
    assert [got[r["id"]] for r in rows] == [-1] * (97 - 4 * 19) + [f for f in range(4) for _ in range(19)]


def test_the_rows_are_not_shuffled(spark):
    df = keyed(spark)
    for out in (S.kfold(df, ["t", "id"]), S.stratified_kfold(df, "c", ["t", "id"]), S.time_split(df, ["t", "id"], 0.3), S.timeseries_kfold(df, ["t", "id"])):
        assert out.columns[:4] == df.columns and out.count() == 97
        plan = out._jdf.queryExecution().executedPlan().toString()
        above = plan[: plan.index("Scan ExistingRDD")] if "Scan ExistingRDD" in plan else plan
        assert "SortMergeJoin" not in plan
        for line in above.split("\n"):
            assert not ("Exchange" in line and "payload" in line)
    assert S.kfold(df.limit(0), ["t", "id"]).collect() == []
