"""Encoders and scalers fitted on earlier rows and applied to all."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwarden.catalog.registry import query, rounded
from driftwarden.operators import encode as N
from driftwarden.operators.chain import encode_preprocess
from driftwarden.plans.scored import read

# Orders with gaps as NULL and as text, and a late level that training never saw.
GAPS = """WITH o AS (SELECT o_orderkey, o_orderdate < TIMESTAMP '1999-01-01' AS early,
  CASE WHEN o_orderkey % 11 = 0 THEN 'NaN' WHEN o_orderkey % 13 = 0 THEN NULL
    WHEN o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderkey % 5 = 0 THEN 'NEW' ELSE o_orderpriority END AS priority,
  o_orderstatus, o_totalprice FROM orders)"""


def gaps(spark, sf_dir):
    early = F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    key = F.col("o_orderkey")
    priority = (
        F.when(key % 11 == 0, "NaN").when(key % 13 == 0, None).when(~early & (key % 5 == 0), "NEW")
    ).otherwise(F.col("o_orderpriority"))
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", early.alias("early"), priority.alias("priority"), "o_orderstatus", "o_totalprice"
    )


FILL = "CASE WHEN priority IS NULL OR lower(priority) IN ('nan', 'none', 'nd', 'nat') THEN 'missing_value' ELSE priority END"
FILLED = f"{GAPS}, f AS (SELECT o_orderkey, early, {FILL} AS priority, o_orderstatus, o_totalprice FROM o)"
COLUMNS = ["o_orderkey", "priority"]


def filled(spark, sf_dir):
    return N.NullCategory(["priority"]).transform(gaps(spark, sf_dir))


@query("null_category", f"{FILLED} SELECT o_orderkey, priority FROM f")
def _null(spark, sf_dir):
    return filled(spark, sf_dir).select(*COLUMNS)


@query("passthrough", "SELECT o_orderkey, o_totalprice FROM orders")
def _pass(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return N.Passthrough(["o_totalprice"]).transform(rows)


@query(
    "pareto_bucket",
    """WITH c AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1),
    s AS (SELECT p_brand, sum(n) OVER (ORDER BY n DESC, p_brand ROWS UNBOUNDED PRECEDING) / CAST(sum(n) OVER () AS DOUBLE) AS c
      FROM c)
    SELECT p_partkey, CASE WHEN s.c < 0.8 THEN part.p_brand ELSE 'OTROS' END AS p_brand FROM part JOIN s USING (p_brand)""",
)
def _pareto(spark, sf_dir):
    part = read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return N.ParetoBucket(["p_brand"], 0.8).fit(part).transform(part)


LEVELS = """, lv AS (SELECT priority, row_number() OVER (ORDER BY priority) - 1 AS code
  FROM (SELECT DISTINCT priority FROM f WHERE early)),
m AS (SELECT priority FROM f WHERE early GROUP BY 1 ORDER BY count(*) DESC, priority LIMIT 1)"""


@query(
    "label_encode",
    f"""{FILLED}{LEVELS} SELECT o_orderkey, coalesce(lv.code, (SELECT code FROM lv WHERE priority = (SELECT priority FROM m)))
    AS priority FROM f LEFT JOIN lv USING (priority)""",
)
def _label(spark, sf_dir):
    rows = filled(spark, sf_dir)
    return N.LabelEncode(["priority"]).fit(rows.where("early")).transform(rows).select(*COLUMNS)


@query(
    "label_encode_batch_mode",
    f"""{FILLED}{LEVELS}, late AS (SELECT * FROM f WHERE NOT early),
    common AS (SELECT priority FROM late GROUP BY 1 ORDER BY count(*) DESC, priority LIMIT 1)
    SELECT o_orderkey, coalesce(lv.code, (SELECT code FROM lv WHERE priority = (SELECT priority FROM common)),
      (SELECT code FROM lv WHERE priority = 'missing_value')) AS priority FROM late LEFT JOIN lv USING (priority)""",
)
def _label_batch(spark, sf_dir):
    rows = filled(spark, sf_dir)
    fitted = N.LabelEncode(["priority"], unseen="batch").fit(rows.where("early"))
    return fitted.transform(rows.where("NOT early")).select(*COLUMNS)


@query(
    "label_encode_many_levels",
    """SELECT o_orderkey, dense_rank() OVER (ORDER BY CAST(o_custkey AS VARCHAR)) - 1 AS o_custkey FROM orders""",
)
def _label_many(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"))
    return N.LabelEncode(["o_custkey"]).fit(rows).transform(rows)


@query(
    "multi_label_encode",
    f"""{GAPS}, lv AS (SELECT priority, row_number() OVER (ORDER BY priority) - 1 AS code
      FROM (SELECT DISTINCT priority FROM o WHERE early AND priority IS NOT NULL)),
    ls AS (SELECT o_orderstatus, row_number() OVER (ORDER BY o_orderstatus) - 1 AS code
      FROM (SELECT DISTINCT o_orderstatus FROM o WHERE early))
    SELECT o_orderkey, o.priority, o.o_orderstatus, CAST(lv.code AS DOUBLE) AS priority_encoded,
    CAST(ls.code AS DOUBLE) AS o_orderstatus_encoded
    FROM o LEFT JOIN lv ON o.priority = lv.priority LEFT JOIN ls ON o.o_orderstatus = ls.o_orderstatus""",
)
def _multi(spark, sf_dir):
    rows = gaps(spark, sf_dir)
    fitted = N.MultiLabelEncode(["priority", "o_orderstatus"], suffix="_encoded").fit(rows.where("early"))
    return fitted.transform(rows).select("o_orderkey", "priority", "o_orderstatus", *fitted.output_columns)


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "NaN"]


@query(
    "one_hot",
    f"""{GAPS} SELECT o_orderkey, {', '.join(
        f"CASE WHEN priority = '{p}' THEN 1 ELSE 0 END AS \"priority_ohe_{p.replace(' ', '_')}\"" for p in PRIORITIES)},
    CASE WHEN priority IS NULL THEN 1 ELSE 0 END AS priority_ohe_nan FROM o""".replace('"priority_ohe_NaN"', '"priority_ohe_NaN_"'),
)
def _one_hot(spark, sf_dir):
    # Spark and DuckDB take column names without regard to case; the text level NaN is told apart from NULL here.
    rows = gaps(spark, sf_dir).withColumn(
        "priority", F.when(F.col("priority") == "NaN", "NaN ").otherwise(F.col("priority"))
    )
    return N.OneHot(["priority"]).fit(rows.where("early")).transform(rows).drop("early", "o_orderstatus", "o_totalprice")


@query(
    "category_type",
    f"""{FILLED}{LEVELS} SELECT o_orderkey, coalesce(lv.priority, (SELECT priority FROM m)) AS priority
    FROM f LEFT JOIN lv ON f.priority = lv.priority""",
)
def _category(spark, sf_dir):
    rows = filled(spark, sf_dir)
    return N.CategoryType(["priority"]).fit(rows.where("early")).transform(rows).select(*COLUMNS)


TAXES = "WITH t AS (SELECT l_orderkey, l_linenumber, nullif(l_tax, 0) AS tax, l_quantity, l_extendedprice FROM lineitem)"


def taxes(spark, sf_dir):
    tax = F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", tax, "l_quantity", "l_extendedprice")


def imputed(name: str, strategy: str, fill: str) -> None:
    sql = f"""{TAXES} SELECT l_orderkey, l_linenumber, round(coalesce(tax, ({fill})), 6) AS tax FROM t"""

    @query(name, sql)
    def run(spark, sf_dir):
        rows = taxes(spark, sf_dir).select("l_orderkey", "l_linenumber", "tax")
        return rounded(N.Impute(["tax"], strategy).fit(rows).transform(rows))


imputed("impute", "median", "SELECT quantile_cont(tax, 0.5) FROM t")
imputed("impute_mean", "mean", "SELECT avg(tax) FROM t")
imputed(
    "impute_most_frequent",
    "most_frequent",
    "SELECT tax FROM t WHERE tax IS NOT NULL GROUP BY tax ORDER BY count(*) DESC, tax LIMIT 1",
)


def scaled(name: str, stage, expression: str) -> None:
    columns = ("l_quantity", "l_extendedprice")
    values = ", ".join(f"round({expression.format(c=c)}, 6) AS {c}" for c in columns)

    @query(name, f"SELECT l_orderkey, l_linenumber, {values} FROM lineitem")
    def run(spark, sf_dir):
        rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *columns)
        return rounded(stage(columns).fit(rows).transform(rows))


def quantile_sql(q: float) -> str:
    return f"(SELECT quantile_cont(CAST({{c}} AS DOUBLE), {q}) FROM lineitem)"


scaled("standard_scale", N.StandardScale, "({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()")
scaled("robust_scale", N.RobustScale, f"({{c}} - {quantile_sql(0.5)}) / ({quantile_sql(0.75)} - {quantile_sql(0.25)})")
scaled("minmax_scale", N.MinMaxScale, "({c} - min({c}) OVER ()) / CAST(max({c}) OVER () - min({c}) OVER () AS DOUBLE)")
IQR = f"0.4::DOUBLE * ({quantile_sql(0.75)} - {quantile_sql(0.25)})"
scaled(
    "clip_outliers",
    lambda columns: N.ClipOutliers(columns, 0.4),
    f"least(greatest(CAST({{c}} AS DOUBLE), {quantile_sql(0.25)} - {IQR}), {quantile_sql(0.75)} + {IQR})",
)


CHAIN = f"""{FILLED}, tr AS (SELECT * FROM f WHERE early),
  c AS (SELECT priority, count(*) AS n FROM tr GROUP BY 1),
  s AS (SELECT priority, sum(n) OVER (ORDER BY n DESC, priority ROWS UNBOUNDED PRECEDING) / CAST(sum(n) OVER () AS DOUBLE) AS c FROM c),
  b AS (SELECT f.*, CASE WHEN f.priority = 'missing_value' OR s.c < 0.8 THEN f.priority ELSE 'OTROS' END AS bucket
    FROM f LEFT JOIN s USING (priority)),
  lv AS (SELECT bucket, row_number() OVER (ORDER BY bucket) - 1 AS code FROM (SELECT DISTINCT bucket FROM b WHERE early))
  SELECT o_orderkey, early, o_orderstatus, lv.code AS priority,
    round((o_totalprice - (SELECT quantile_cont(o_totalprice, 0.5) FROM tr)) / ((SELECT quantile_cont(o_totalprice, 0.75) FROM tr)
      - (SELECT quantile_cont(o_totalprice, 0.25) FROM tr)), 6) AS o_totalprice
  FROM b LEFT JOIN lv USING (bucket)"""


@query("encode_preprocess", CHAIN)
def _chain(spark, sf_dir):
    rows = gaps(spark, sf_dir)
    fitted = encode_preprocess(rows.where("early"), ["priority"], ["o_totalprice"], steps_cont=("null", "rs"))
    return rounded(fitted.transform(rows))
