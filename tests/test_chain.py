"""Chains fitted on value counts against the same steps fitted one after the other."""

import random

import pytest
from pyspark.sql import functions as F

from driftwarden.operators.chain import encode_preprocess
from driftwarden.operators.encode import fit_stages


def frame(spark, seed, n=300):
    rng = random.Random(seed)
    words = ["a", "b", "c", "d", "nan", "None", "OTROS", "rare"]
    rows = [
        (
            i,
            rng.choices([*words, None], [9, 7, 5, 3, 1, 1, 1, 0.3, 2])[0],
            rng.choice([None, "x", "y"]),
            rng.choice([None, float("nan"), rng.gauss(0, 3), rng.randrange(5)]),
            rng.gauss(5, 2) if i % 7 else None,
        )
        for i in range(n)
    ]
    return spark.createDataFrame([(i, c, d, None if x is None else float(x), y) for i, c, d, x, y in rows], "i int, c string, d string, x double, y double")


def same(got, want):
    a, b = ({r["i"]: r.asDict() for r in f.collect()} for f in (got, want))
    assert a.keys() == b.keys()
    for i, row in a.items():
        assert row.keys() == b[i].keys()
        for k, v in row.items():
            w = b[i][k]
            assert v == w or (isinstance(v, float) and (v != v and w != w or v == pytest.approx(w, rel=1e-9, abs=1e-9))), (i, k, v, w)


CATEGORICAL = [("null", "pareto", "le"), ("null", "le"), ("pareto", "le"), ("type",), ("null", "type", "le"), ("null", "pareto", "ohe"), ("null", "ohe"), ("skip",), ("null", "pareto", "type", "le")]
NUMERIC = [("skip",), ("null", "ss"), ("null", "rs"), ("null", "outlier", "ms"), ("null", "ms"), ("outlier",), ("null", "outlier", "rs"), ("null", "ss", "outlier"), ("null",)]


@pytest.mark.parametrize(("steps_cat", "steps_cont"), list(zip(CATEGORICAL, NUMERIC, strict=True)))
def test_chain_equals_its_steps(spark, steps_cat, steps_cont):
    train, other = frame(spark, 1), frame(spark, 2, 80)
    unseen = spark.createDataFrame([(1000, "new", "new", 1e6, None), (1001, "nAt", None, None, -5.0)], other.schema)
    rows = train.unionByName(other.withColumn("i", F.col("i") + 500)).unionByName(unseen)
    constants = {"num_fill_null": ("median", "mean", "most_frequent")[len(steps_cat) % 3]}
    # Two decimals make the most frequent number a matter of counting.
    train, rows = (f.withColumns({c: F.round(c, 2) for c in "xy"}) for f in (train, rows))
    if steps_cont == ("outlier",):
        train, rows = (f.withColumn("x", F.nanvl("x", F.lit(None))) for f in (train, rows))
    whole, single = (fit(train, ["c", "d"], ["x", "y"], steps_cat, steps_cont, constants) for fit in (encode_preprocess, fit_stages))
    assert whole.output_columns == single.output_columns
    same(whole.transform(rows), single.transform(rows))


def test_rows_are_read_once_and_looked_up_once_per_column(spark):
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = frame(spark, 3)
    fitted = encode_preprocess(rows.mapInPandas(passed, rows.schema), ["c", "d"], ["x", "y"], ("null", "pareto", "type", "le"), ("null", "outlier", "rs"))
    assert seen.value == rows.count()
    plan = fitted.transform(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2


def test_columns_without_values(spark):
    rows = spark.createDataFrame([(1, None, None)], "i int, c string, x double")
    for fit in (encode_preprocess, fit_stages):
        fitted = fit(rows, ["c"], ["x"], ("null", "pareto", "le"), ("null", "rs"))
        assert [tuple(r) for r in fitted.transform(rows).collect()] == [(1, 0, None)]
    with pytest.raises(ValueError, match="unknown steps"):
        encode_preprocess(rows, ["c"], ["x"], ("nul",))
