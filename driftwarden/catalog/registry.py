"""Registry of queries and the SQL fragments they share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def rounded(df: DataFrame, digits: int = 6, only: Sequence[str] | None = None) -> DataFrame:
    """Round the double columns: two engines add up in different orders."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) and (only is None or f.name in only)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


_WEIGHT = "1 + (CAST({a} * o_orderkey + {b} * o_custkey AS BIGINT)) % {m} + CASE WHEN target = {c} THEN 40 ELSE 0 END"


def _band(column: str) -> str:
    return (
        f"'P' || lpad(CAST(10 * CAST(least(greatest(ceil(({column} - min({column}) OVER ()) "
        f"/ (max({column}) OVER () - min({column}) OVER ()) * 10.0), 1), 10) AS INTEGER) AS VARCHAR), 3, '0')"
    )


# The scored frame as common table expressions; a query continues with ", more AS (...) SELECT ..." or SELECT.
SCORED = f"""WITH base AS (
  SELECT *, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS target
  FROM orders JOIN customer ON o_custkey = c_custkey),
weighted AS (
  SELECT *, {_WEIGHT.format(a=7, b=3, m=97, c=0)} AS w0, {_WEIGHT.format(a=11, b=5, m=89, c=1)} AS w1,
         {_WEIGHT.format(a=13, b=17, m=83, c=2)} AS w2 FROM base),
probs AS (
  SELECT o_orderkey AS row_id, o_custkey AS entity_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS periodo,
         c_mktsegment AS segment, o_totalprice AS kpi, target,
         CAST(w0 AS DOUBLE) / CAST(w0 + w1 + w2 AS DOUBLE) AS p0,
         CAST(w1 AS DOUBLE) / CAST(w0 + w1 + w2 AS DOUBLE) AS p1,
         CAST(w2 AS DOUBLE) / CAST(w0 + w1 + w2 AS DOUBLE) AS p2,
         o_orderpriority, c_mktsegment, o_totalprice, c_acctbal,
         CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'training' ELSE 'predict' END AS set_analysis
  FROM weighted),
scored AS (
  SELECT *, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS prediction,
         {_band('p0')} AS p0_cut, {_band('p1')} AS p1_cut, {_band('p2')} AS p2_cut
  FROM probs)"""

# The production rows and the three largest of their segments.
PREDICT = f"""{SCORED},
pred AS (SELECT * FROM scored WHERE set_analysis = 'predict'),
top3 AS (SELECT segment FROM pred GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 3),
labelled AS (
  SELECT 'all' AS label, pred.* FROM pred
  UNION ALL SELECT segment AS label, pred.* FROM pred WHERE segment IN (SELECT segment FROM top3))"""

# One row per labelled row and class.
PER_CLASS = f"""{PREDICT},
per_class AS (
  SELECT label, 'p0' AS name_classes, p0 AS score, CAST(target = 0 AS INTEGER) AS y,
         CAST(prediction = 0 AS INTEGER) AS said FROM labelled
  UNION ALL SELECT label, 'p1', p1, CAST(target = 1 AS INTEGER), CAST(prediction = 1 AS INTEGER) FROM labelled
  UNION ALL SELECT label, 'p2', p2, CAST(target = 2 AS INTEGER), CAST(prediction = 2 AS INTEGER) FROM labelled)"""


def melt_sql(source: str, ids: Sequence[str], values: Sequence[str], name: str = "metric") -> str:
    """Wide to long as a UNION ALL over the value columns."""
    keep = "".join(f"{i}, " for i in ids)
    return " UNION ALL ".join(
        f"SELECT {keep}'{v}' AS {name}, CAST({v} AS DOUBLE) AS value FROM {source}" for v in values
    )
