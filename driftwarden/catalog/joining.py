"""Joins with outcomes, run metadata, feature tables; set operations and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwarden.catalog.registry import SCORED, melt_sql, query, rounded
from driftwarden.common import melt, union_all
from driftwarden.operators import joins as J
from driftwarden.operators import windows as W
from driftwarden.plans.scored import read, scored_frame


@query(
    "feedback_join",
    """SELECT l_orderkey AS id, CAST(date_trunc('month', o_orderdate) AS DATE) AS periodo, l_linenumber, l_quantity,
    o_orderstatus AS outcome FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _feedback(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    outcomes = orders.select(
        F.col("o_orderkey").alias("id"), F.trunc("o_orderdate", "MM").alias("periodo"), F.col("o_orderstatus").alias("outcome")
    )
    line = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), "l_linenumber", "l_quantity")
    data = line.join(outcomes.select("id", "periodo"), "id")
    return J.feedback_join(data, outcomes, ["id", "periodo"])


@query(
    "feedback_join_fallback",
    """SELECT l_orderkey AS id, DATE '1990-01-01' AS periodo, l_linenumber, o_orderstatus AS outcome
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _feedback_fallback(spark, sf_dir):
    outcomes = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.trunc("o_orderdate", "MM").alias("periodo"), F.col("o_orderstatus").alias("outcome")
    )
    never = F.lit("1990-01-01").cast("date").alias("periodo")
    data = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), never, "l_linenumber")
    return J.feedback_join(data, outcomes, ["id", "periodo"])


@query(
    "attach_run_metadata",
    """SELECT c_custkey, c_name, n_orders, last_order, last_finished FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, max(o_orderdate) AS last_order FROM orders GROUP BY 1) a
      ON c_custkey = a.o_custkey
    LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_finished FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) b
      ON c_custkey = b.o_custkey""",
)
def _attach(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    totals = orders.groupBy("c_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last_order")
    )
    finished = orders.where("o_orderstatus = 'F'").groupBy("c_custkey").agg(F.max("o_orderdate").alias("last_finished"))
    runs = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return J.attach_run_metadata(runs, totals, finished, on="c_custkey")


@query("known_runs_semi", "SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def _semi(spark, sf_dir):
    known = read(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return J.known_runs_semi(read(spark, sf_dir, "customer"), known, "c_custkey")


@query(
    "unexecuted_runs_anti",
    "SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')",
)
def _anti(spark, sf_dir):
    done = read(spark, sf_dir, "orders").where("o_orderstatus = 'P'").withColumnRenamed("o_custkey", "c_custkey")
    return J.unexecuted_runs_anti(read(spark, sf_dir, "customer"), done, "c_custkey")


@query(
    "leakage_guard",
    """WITH tagged AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS periodo, o_orderkey, o_orderdate,
      CASE WHEN o_orderdate < TIMESTAMP '1995-07-01' THEN 'train' ELSE 'validation' END AS split FROM orders),
    last AS (SELECT *, row_number() OVER (PARTITION BY split, o_custkey, periodo ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM tagged)
    SELECT split, o_custkey, periodo, o_orderkey FROM last WHERE rn = 1 AND (split = 'train' OR o_custkey NOT IN
      (SELECT o_custkey FROM tagged WHERE split = 'train'))""",
)
def _leakage(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").withColumn("periodo", F.trunc("o_orderdate", "MM"))
    border = F.lit("1995-07-01").cast("timestamp_ntz")
    early, late = orders.where(F.col("o_orderdate") < border), orders.where(F.col("o_orderdate") >= border)
    train, valid = J.leakage_guard(early, late, ["o_custkey", "periodo"], "o_custkey", ["o_orderdate", "o_orderkey"])
    columns = ["o_custkey", "periodo", "o_orderkey"]
    return train.select(F.lit("train").alias("split"), *columns).unionByName(
        valid.select(F.lit("validation").alias("split"), *columns)
    )


@query("align_by_row", f"{SCORED} SELECT row_id, o_totalprice, c_acctbal, target FROM scored")
def _align(spark, sf_dir):
    rows = scored_frame(spark, sf_dir)
    return J.align_by_row(rows.select("row_id", "o_totalprice", "c_acctbal"), rows.select("row_id", "target"), "row_id")


@query(
    "enrich_features",
    """SELECT c_custkey, o_orderkey, o_totalprice, c_nationkey, c_acctbal AS customer__c_acctbal,
    c_mktsegment AS customer__c_mktsegment, n_name AS nation__n_name
    FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def _enrich(spark, sf_dir):
    customer = read(spark, sf_dir, "customer")
    orders = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    entities = orders.join(customer.select("c_custkey", "c_nationkey"), "c_custkey")
    nation = read(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return J.enrich_features(
        entities,
        ["customer:c_acctbal", "customer:c_mktsegment", "nation:n_name"],
        {"customer": (customer, "c_custkey"), "nation": (nation, "c_nationkey")},
    )


@query(
    "importance_fill",
    """SELECT f.p_brand AS feature, coalesce(round(i.importance, 6), 0) AS importance
    FROM (SELECT DISTINCT p_brand FROM part) f LEFT JOIN (SELECT p_brand, avg(p_retailprice) AS importance FROM part
      WHERE p_brand < 'Brand#3' GROUP BY 1) i ON f.p_brand = i.p_brand""",
)
def _fill(spark, sf_dir):
    part = read(spark, sf_dir, "part").withColumnRenamed("p_brand", "feature")
    used = part.where(F.col("feature") < "Brand#3").groupBy("feature").agg(F.avg("p_retailprice").alias("importance"))
    return rounded(J.importance_fill(part.select("feature").distinct(), used))


@query(
    "union_marts",
    """SELECT o_orderstatus AS grp, count(*) AS n, CAST(NULL AS DOUBLE) AS amount FROM orders GROUP BY 1
    UNION ALL SELECT l_returnflag, NULL, round(sum(l_extendedprice), 2) FROM lineitem GROUP BY 1""",
)
def _union(spark, sf_dir):
    counts = read(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("grp")).agg(F.count(F.lit(1)).alias("n"))
    sums = read(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("grp"))
    return rounded(union_all([counts, sums.agg(F.sum("l_extendedprice").alias("amount"))]), 2)


@query("distinct_rows", "SELECT DISTINCT user_id, event_type FROM events")
def _distinct(spark, sf_dir):
    return W.distinct_rows(read(spark, sf_dir, "events"), ["user_id", "event_type"])


@query(
    "melt_metrics",
    melt_sql("lineitem", ["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice", "l_discount"]),
)
def _melt(spark, sf_dir):
    return melt(
        read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice", "l_discount"]
    )
