"""Column management, period selection, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwarden.catalog.registry import PREDICT, SCORED, query, rounded
from driftwarden.functions import scalars as X
from driftwarden.operators import columns as C
from driftwarden.operators import metrics as M
from driftwarden.plans.scored import ORDERS_SPEC as SPEC
from driftwarden.plans.scored import read, scored_frame

EXECUTION = "2024-05-01 10:30:00"


@query(
    "sanitize_columns",
    """SELECT l_orderkey AS order_key, l_quantity AS _quantity, l_discount AS discount_pct_, l_tax AS tax__
    FROM lineitem""",
)
def _sanitize(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_tax")
    return C.sanitize_columns(line.toDF("order key", "#quantity", "discount[pct]", "tax %"))


@query("sanitize_columns_prefix", "SELECT l_orderkey AS n_order, l_quantity AS quantity_ FROM lineitem")
def _sanitize_prefix(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    return C.sanitize_columns(line.toDF("#order", "quantity%"), hash_prefix="n_")


@query(
    "drop_duplicate_columns",
    "SELECT o_orderkey, o_custkey AS custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
)
def _drop_duplicates(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"))
    customer = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return C.drop_duplicate_columns(orders.join(customer, orders.custkey == customer.custkey))


@query(
    "standardize_mart",
    f"""{SCORED} SELECT periodo, target AS name_target, prediction, set_analysis, o_orderpriority, c_mktsegment,
    o_totalprice, c_acctbal, p0_cut, p1_cut, p2_cut, kpi AS kpi_1, segment AS subpoblation_features,
    round(p0, 6) AS s0, round(p1, 6) AS s1, round(p2, 6) AS s2,
    CAST(row_id AS VARCHAR) || ',' || CAST(entity_id AS VARCHAR) AS ids FROM scored""",
)
def _standardize(spark, sf_dir):
    out = C.standardize_mart(scored_frame(spark, sf_dir), SPEC)
    arrays = {f"s{i}": F.round(F.col("sub_cols")[i], 6) for i in range(3)} | {"ids": F.array_join("id_features", ",")}
    return out.withColumns(arrays).drop("sub_cols", "id_features")


@query(
    "rename_columns",
    "SELECT o_orderkey AS id_order, o_orderstatus AS name_target, o_totalprice AS kpi_1 FROM orders",
)
def _rename(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return C.rename_columns(orders, {"o_orderkey": "id_order", "o_orderstatus": "name_target", "o_totalprice": "kpi_1"})


@query(
    "pack_columns",
    f"""{SCORED} SELECT row_id AS key, round(p0 + 10 * p1 + 100 * p2, 6) AS checksum,
    row_id || '/' || entity_id AS ids FROM scored""",
)
def _pack(spark, sf_dir):
    packed = C.pack_columns(scored_frame(spark, sf_dir).withColumn("key", F.col("row_id")), SPEC)
    p = F.col("sub_cols")
    return packed.select(
        "key",
        F.round(p[0] + 10 * p[1] + 100 * p[2], 6).alias("checksum"),
        F.array_join("id_features", "/").alias("ids"),
    )


@query(
    "add_lineage",
    f"""{PREDICT} SELECT '{C.model_id(SPEC)}' AS id_modelo, TIMESTAMP '{EXECUTION}' AS id_execution_mg, 'training' AS source,
    segment, count(*) AS n FROM pred GROUP BY segment""",
)
def _lineage(spark, sf_dir):
    rows = scored_frame(spark, sf_dir).where("set_analysis = 'predict'")
    counts = rows.groupBy("segment").agg(F.count(F.lit(1)).alias("n"))
    return C.add_lineage(counts, "mg_perf__general_metrics", SPEC, EXECUTION)


@query(
    "model_id",
    """SELECT c_custkey, md5('orders_' || c_mktsegment || '_GBT_0.1.0_' || CAST(c_custkey AS VARCHAR)) AS model_key
    FROM customer""",
)
def _model_id(spark, sf_dir):
    customer = read(spark, sf_dir, "customer")
    key = X.model_key(
        F.lit("orders"), F.col("c_mktsegment"), F.lit("GBT"), F.lit("0.1.0"), F.col("c_custkey").cast("string")
    )
    return customer.select("c_custkey", key.alias("model_key"))


MONTH = "CAST(date_trunc('month', o_orderdate) AS DATE)"


def monthly(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    return orders.select("o_orderkey", X.month_floor(F.col("o_orderdate")).alias("periodo"))


@query(
    "period_split",
    f"""WITH o AS (SELECT o_orderkey, {MONTH} AS periodo FROM orders)
    SELECT o_orderkey, periodo, CASE WHEN periodo <= DATE '1999-06-01' THEN 'training' ELSE 'production' END AS part
    FROM o WHERE periodo >= DATE '1996-01-01'""",
)
def _period_split(spark, sf_dir):
    until, since = F.lit("1999-06-01").cast("date"), F.lit("1996-01-01").cast("date")
    training, production = C.period_split(monthly(spark, sf_dir), "periodo", until, since=since)
    return training.withColumn("part", F.lit("training")).unionByName(production.withColumn("part", F.lit("production")))


@query(
    "latest_period",
    f"SELECT o_orderkey, {MONTH} AS periodo FROM orders WHERE {MONTH} = (SELECT max({MONTH}) FROM orders)",
)
def _latest_period(spark, sf_dir):
    return C.latest_period(monthly(spark, sf_dir), "periodo")


@query("month_floor", f"SELECT o_orderkey, {MONTH} AS periodo FROM orders")
def _month_floor(spark, sf_dir):
    return monthly(spark, sf_dir)


@query(
    "next_period_pair",
    f"""SELECT o_orderkey, {MONTH} AS periodo, CASE {MONTH} WHEN DATE '1998-03-01' THEN 'reference' ELSE 'current' END AS set_data
    FROM orders WHERE {MONTH} IN (DATE '1998-03-01', DATE '1998-04-01')""",
)
def _pair(spark, sf_dir):
    return C.next_period_pair(monthly(spark, sf_dir), "periodo", F.lit("1998-03-01").cast("date"))


@query("read_period_batches", f"SELECT {MONTH} AS periodo, count(*) AS n_rows FROM orders GROUP BY 1")
def _batches(spark, sf_dir):
    return C.read_period_batches(monthly(spark, sf_dir), "periodo")


@query(
    "subpopulation_filter",
    f"{PREDICT} SELECT row_id, segment FROM pred WHERE segment IN (SELECT segment FROM top3)",
)
def _subpopulation(spark, sf_dir):
    rows = scored_frame(spark, sf_dir).where("set_analysis = 'predict'")
    return C.subpopulation_filter(rows, "segment", M.segment_values(rows, SPEC)).select("row_id", "segment")


@query(
    "recode_values",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 1
    WHEN '4-NOT SPECIFIED' THEN 0 END AS level FROM orders""",
)
def _recode(spark, sf_dir):
    levels = {"1-URGENT": 2, "2-HIGH": 2, "3-MEDIUM": 1, "4-NOT SPECIFIED": 0}
    value = X.recode_values(F.col("o_orderpriority"), levels)
    return read(spark, sf_dir, "orders").select("o_orderkey", value.alias("level"))


@query("first_token", "SELECT p_partkey, split_part(p_name, ' ', 1) AS token FROM part")
def _first_token(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", X.first_token(F.col("p_name")).alias("token"))


@query(
    "split_to_columns",
    """SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS place, split_part(o_orderpriority, '-', 2) AS name
    FROM orders""",
)
def _split(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return C.split_to_columns(orders, "o_orderpriority", ["place", "name"], "-").drop("o_orderpriority")


@query(
    "interaction_features",
    """SELECT l_orderkey, l_quantity, l_discount, l_tax, l_linenumber AS target, l_quantity * l_discount AS l_quantity_l_discount,
    l_discount * l_tax AS l_discount_l_tax FROM lineitem""",
)
def _interaction(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"
    )
    return C.interaction_features(line, [("l_quantity", "l_discount"), ("l_discount", "l_tax")], "l_linenumber")


@query(
    "drop_null_rows",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority <> '3-MEDIUM'",
)
def _drop_nulls(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")).alias("o_orderpriority")
    )
    return C.drop_null_rows(orders, ["o_orderpriority"])


@query(
    "infer_feature_roles",
    """SELECT 'o_orderpriority' AS "column", 'cat' AS role, count(o_orderpriority) AS n_values FROM orders
    UNION ALL SELECT 'o_totalprice', 'cont', count(o_totalprice) FROM orders
    UNION ALL SELECT 'o_orderdate', 'cont', count(o_orderdate) FROM orders""",
)
def _roles(spark, sf_dir):
    return C.feature_roles_table(read(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey"], "o_orderstatus")


@query("to_date_string", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def _date_string(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", X.to_date_string(F.col("o_orderdate")).alias("day"))


@query("monthly_key", "SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month_key FROM orders")
def _monthly_key(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", X.monthly_key(F.col("o_orderdate")).alias("month_key"))


@query(
    "json_path",
    "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.absent.x') AS absent FROM events",
)
def _json(spark, sf_dir):
    props = F.col("props")
    return read(spark, sf_dir, "events").select(
        "event_id", X.json_path(props, "$.k").alias("k"), X.json_path(props, "$.absent.x").alias("absent")
    )


@query(
    "try_value",
    """SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), -1) AS k,
    TRY_CAST(event_type AS DOUBLE) AS unreadable FROM events""",
)
def _try(spark, sf_dir):
    k = X.try_value(X.json_path(F.col("props"), "$.k"), "int", F.lit(-1))
    unreadable = X.try_value(F.col("event_type"), "double")
    return read(spark, sf_dir, "events").select("event_id", k.alias("k"), unreadable.alias("unreadable"))
