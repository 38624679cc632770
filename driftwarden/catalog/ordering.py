"""Windows, rankings, sorts and top-k reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwarden.catalog.profiling import IMPORTANCE_SQL, fold_importance
from driftwarden.catalog.registry import query, rounded
from driftwarden.operators import encode as N
from driftwarden.operators import windows as W
from driftwarden.operators.profile import mean_fold_importance
from driftwarden.plans.scored import read

SERIES = """WITH s AS (SELECT event_type, CAST(date_trunc('day', ts) AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL),
  p AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day) - 1 AS i,
    count(*) OVER (PARTITION BY event_type) AS total FROM s),
  q AS (SELECT *, CAST(floor(0.2::DOUBLE * total) AS BIGINT) AS k FROM p),
  w AS (SELECT a.event_type, a.day, any_value(a.n) AS n, any_value(a.k) AS k, avg(b.n) AS m, stddev_pop(b.n) AS s
    FROM q a LEFT JOIN q b ON a.event_type = b.event_type AND b.i BETWEEN a.i - a.k AND a.i + a.k - 1
    GROUP BY a.event_type, a.day)"""


@query(
    "rolling_bands",
    f"""{SERIES} SELECT event_type, day, n, round(m + 2.5::DOUBLE * s, 6) AS upper, round(m - 2.5::DOUBLE * s, 6) AS lower,
    coalesce(n > m + 2.5::DOUBLE * s OR n < m - 2.5::DOUBLE * s, false) AS anomaly FROM w""",
)
def _bands(spark, sf_dir):
    day = F.col("ts").cast("date").alias("day")
    series = read(spark, sf_dir, "events").groupBy("event_type", day).agg(F.count(F.lit(1)).alias("n"))
    return rounded(W.rolling_bands(series, ["event_type"], "day", "n"))


def share_sql(column: str, table: str) -> str:
    return f"""SELECT '{column}' AS feature, CAST({column} AS VARCHAR) AS value, n,
      sum(n) OVER (ORDER BY n DESC, CAST({column} AS VARCHAR) ROWS UNBOUNDED PRECEDING) / CAST(sum(n) OVER () AS DOUBLE) AS c
      FROM (SELECT {column}, count(*) AS n FROM {table} GROUP BY 1)"""


@query(
    "cumulative_share",
    f"""SELECT feature, value, n, round(c, 6) AS cumulative_share FROM
    ({share_sql('l_returnflag', 'lineitem')} UNION ALL {share_sql('l_partkey', 'lineitem')})""",
)
def _share(spark, sf_dir):
    counts = N.level_counts(read(spark, sf_dir, "lineitem"), ["l_returnflag", "l_partkey"])
    return rounded(N.cumulative_share(counts))


@query(
    "keep_last",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER
    (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def _last(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return W.keep_last(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "keep_first",
    """SELECT doc_id, text FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents)
    WHERE rn = 1""",
)
def _first(spark, sf_dir):
    return W.keep_first(read(spark, sf_dir, "documents").select("doc_id", "text"), ["text"], ["doc_id"])


@query("latest_n", "SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 5")
def _latest(spark, sf_dir):
    return W.latest_n(read(spark, sf_dir, "orders"), "o_orderdate", "o_orderkey")


@query(
    "latest_n_per_key",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER
    (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn <= 5""",
)
def _latest_per_key(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return W.latest_n(orders, "o_orderdate", "o_orderkey", 5, ["o_custkey"])


@query(
    "variable_rank",
    f"""{IMPORTANCE_SQL} SELECT feature, round(importance, 6) AS importance,
    CAST(dense_rank() OVER (ORDER BY importance DESC) AS INTEGER) AS rank_variable FROM importance""",
)
def _rank(spark, sf_dir):
    return rounded(W.variable_rank(mean_fold_importance(fold_importance(spark, sf_dir))))


@query("sort_by_period", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey")
def _sort(spark, sf_dir):
    return W.sort_by_period(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey")


@query(
    "top_categories",
    """SELECT p_partkey, p_brand FROM part WHERE p_brand IN
    (SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 10)""",
)
def _top(spark, sf_dir):
    return W.top_categories(read(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_brand")


@query(
    "top_categories_skewed_key",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN
    (SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(*) DESC, o_custkey LIMIT 11)""",
)
def _top_key(spark, sf_dir):
    return W.top_categories(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", 11)


@query(
    "top_segments_by_value",
    """SELECT n_name, round(sum(o_totalprice), 2) AS first_value, round(sum(c_acctbal), 2) AS second_value
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY 1 ORDER BY sum(o_totalprice) DESC, sum(c_acctbal) DESC, n_name LIMIT 12""",
)
def _top_value(spark, sf_dir):
    orders, customer, nation = (read(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    )
    return rounded(W.top_segments_by_value(joined, "n_name", F.col("o_totalprice"), F.col("c_acctbal")), 2)


@query(
    "select_features_gain",
    f"{IMPORTANCE_SQL} SELECT feature, round(importance, 6) AS importance FROM importance WHERE importance >= 1500",
)
def _gain(spark, sf_dir):
    return rounded(W.select_features(mean_fold_importance(fold_importance(spark, sf_dir)), "gain", 1500.0))


@query(
    "select_features",
    f"""{IMPORTANCE_SQL} SELECT feature, round(importance, 6) AS importance FROM importance
    ORDER BY importance.importance DESC, feature LIMIT (SELECT CAST(floor(0.4::DOUBLE * count(*)) AS BIGINT) FROM importance)""",
)
def _select(spark, sf_dir):
    return rounded(W.select_features(mean_fold_importance(fold_importance(spark, sf_dir)), "n_features", 0.4))


@query(
    "row_surrogate_id",
    "SELECT doc_id, lang, 'R_' || (row_number() OVER (ORDER BY doc_id) - 1) AS row_id FROM documents",
)
def _surrogate(spark, sf_dir):
    return W.row_surrogate_id(read(spark, sf_dir, "documents").select("doc_id", "lang"), ["doc_id"])
