"""What the physical plans may not contain."""

import re

import pytest
from pyspark.sql import functions as F

from driftwarden.functions import text as TX
from driftwarden.operators import metrics as M
from driftwarden.operators import profile as P
from driftwarden.operators import quantiles as Q
from driftwarden.operators import split as S
from driftwarden.operators import windows as W
from driftwarden.plans.scored import ORDERS_SPEC, read, scored_frame

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_text_cleaning_stays_in_the_jvm(spark):
    df = read(spark, SF, "documents").select(TX.clean_text(F.col("text"), TX.stop_words()).alias("t"))
    assert "Python" not in plan(df) and "Exchange" not in plan(df)


def test_scan_reads_only_what_is_asked(spark):
    text = plan(M.metric_count(scored_frame(spark, SF), ["set_analysis"]))
    orders = next(s for s in re.findall(r"ReadSchema: (.*)", text) if "o_custkey" in s)
    assert "o_orderpriority" not in orders and "o_totalprice" not in orders


def test_filter_reaches_the_scan(spark):
    df = read(spark, SF, "orders").where(F.col("o_totalprice") > 1000).select("o_orderkey")
    assert "GreaterThan(o_totalprice,1000.0)" in plan(df)


def test_hash_cut_does_not_shuffle_the_rows(spark):
    """Only the bucket counts and the rows of cut buckets are exchanged."""
    text = plan(S.sample_cap(spark.range(100_000), 5000, "id"))
    assert "Python" not in text
    # What is exchanged by hash are counts per bucket, or rows of a bucket that holds a cut.
    for keys in re.findall(r"Arguments: hashpartitioning\(([^)]*)", text):
        assert "__bucket" in keys or keys.split("#")[0] in ("1", "_w0")
    assert "Exchange" in text


def test_random_split_has_no_exchange(spark):
    assert "Exchange" not in plan(S.random_split(spark.range(10), "id", 0.3))


@pytest.mark.parametrize("build", [
    lambda rows: M.metric_auc(rows, ORDERS_SPEC),
    lambda rows: M.cutoff_metrics(rows, ORDERS_SPEC, ["BUILDING"]),
    lambda rows: Q.exact_percentiles(rows.select(F.lit("x").alias("feature"), F.col("kpi").alias("value")), ["feature"], [0.5]),
    lambda rows: P.top_levels(rows.select(F.lit("x").alias("feature"), F.col("segment").alias("value"))),
])
def test_windows_are_partitioned(spark, build):
    for window in re.findall(r"\bWindow\b[^\n]*\n(?:Input[^\n]*\n)?Arguments: (.*)", plan(build(scored_frame(spark, SF)))):
        assert "], []" not in window.split("],", 1)[0]
        groups = re.findall(r"\[[^\[\]]*\]", window)
        assert len(groups) >= 2 and groups[-2] != "[]"


def test_top_rows_per_key_are_limited_before_the_shuffle(spark):
    text = plan(W.keep_last(read(spark, SF, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]))
    assert "WindowGroupLimit" in text
