"""Samples, splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwarden.catalog.registry import query
from driftwarden.common import written
from driftwarden.operators import folds as N
from driftwarden.operators import split as S
from driftwarden.plans.scored import read

HASH = "md5(CAST({k} AS VARCHAR) || '|60')"
OH = HASH.format(k="o_orderkey")


def orders(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")


@query("sample_cap", f"SELECT o_orderkey FROM orders ORDER BY {OH}, o_orderkey LIMIT 5000")
def _cap(spark, sf_dir):
    return S.sample_cap(orders(spark, sf_dir), 5000, "o_orderkey").select("o_orderkey")


@query(
    "random_split",
    f"""SELECT o_orderkey, CASE WHEN CAST(CAST('0x' || substr({OH}, 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 < 0.33
    THEN 'validation' ELSE 'train' END AS split FROM orders""",
)
def _random(spark, sf_dir):
    return S.random_split(orders(spark, sf_dir), "o_orderkey", 0.33).select("o_orderkey", "split")


@query(
    "stratified_split",
    f"""SELECT o_orderkey, o_orderstatus, CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY {OH}, o_orderkey)
    <= floor(count(*) OVER (PARTITION BY o_orderstatus) * 0.67::DOUBLE) THEN 'train' ELSE 'validation' END AS split FROM orders""",
)
def _stratified(spark, sf_dir):
    out = S.stratified_split(orders(spark, sf_dir), "o_orderkey", "o_orderstatus", 0.33)
    return out.select("o_orderkey", "o_orderstatus", "split")


@query(
    "three_way_split",
    f"""WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {OH}, o_orderkey) AS i, count(*) OVER () AS n FROM orders)
    SELECT o_orderkey, CASE WHEN i <= floor(n * 0.6::DOUBLE) THEN 'train' WHEN i <= floor(n * 0.8::DOUBLE) THEN 'validation'
    ELSE 'test' END AS split FROM r""",
)
def _three(spark, sf_dir):
    return S.three_way_split(orders(spark, sf_dir), "o_orderkey").select("o_orderkey", "split")


@query(
    "time_split",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= floor(0.67::DOUBLE * count(*) OVER ())
    THEN 'train' ELSE 'validation' END AS split FROM orders""",
)
def _time(spark, sf_dir):
    return S.time_split(orders(spark, sf_dir), ["o_orderdate", "o_orderkey"], 0.33).select("o_orderkey", "split")


@query(
    "group_split",
    """SELECT o_orderkey, CASE WHEN month(o_orderdate) IN ((SELECT min(month(o_orderdate)) FROM orders),
    (SELECT max(month(o_orderdate)) FROM orders)) THEN 'validation' ELSE 'train' END AS split FROM orders""",
)
def _group(spark, sf_dir):
    return S.group_split(orders(spark, sf_dir), F.month("o_orderdate")).select("o_orderkey", "split")


DOC = HASH.format(k="doc_id")


@query(
    "undersample",
    f"""WITH r AS (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY {DOC}, doc_id) AS i,
      floor(count(*) OVER (PARTITION BY toxic) * 0.67::DOUBLE) AS train FROM labels),
    a AS (SELECT floor(count(*) * 0.67::DOUBLE) AS a FROM labels WHERE toxic = 1)
    SELECT doc_id, toxic, CASE WHEN i > train THEN 'validation'
      WHEN toxic = 1 OR i <= (SELECT floor(a / 0.1::DOUBLE - a) FROM a) THEN 'train' ELSE 'dropped' END AS split FROM r""",
)
def _undersample(spark, sf_dir):
    return S.undersample(read(spark, sf_dir, "labels"), "doc_id", "toxic", 0.33).select("doc_id", "toxic", "split")


@query(
    "undersample_rare",
    f"""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 29 = 0 THEN 1 ELSE 0 END AS y FROM orders),
    r AS (SELECT o_orderkey, y, row_number() OVER (PARTITION BY y ORDER BY {OH}, o_orderkey) AS i,
      floor(count(*) OVER (PARTITION BY y) * 0.67::DOUBLE) AS train FROM o),
    a AS (SELECT floor(count(*) * 0.67::DOUBLE) AS a FROM o WHERE y = 1)
    SELECT o_orderkey, y, CASE WHEN i > train THEN 'validation'
      WHEN y = 1 OR i <= (SELECT floor(a / 0.1::DOUBLE - a) FROM a) THEN 'train' ELSE 'dropped' END AS split FROM r""",
)
def _undersample_rare(spark, sf_dir):
    rows = orders(spark, sf_dir).withColumn("y", F.when(F.col("o_orderkey") % 29 == 0, 1).otherwise(0))
    return S.undersample(rows, "o_orderkey", "y", 0.33).select("o_orderkey", "y", "split")


def block_sql(i: str, n: str, k: int = 5) -> str:
    return f"""CAST(CASE WHEN {i} < ({n} % {k}) * ({n} // {k} + 1) THEN {i} // ({n} // {k} + 1)
      ELSE {n} % {k} + ({i} - ({n} % {k}) * ({n} // {k} + 1)) // ({n} // {k}) END AS INTEGER)"""


@query(
    "kfold",
    f"""WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders)
    SELECT o_orderkey, {block_sql('i', 'n', 7)} AS fold FROM r""",
)
def _kfold(spark, sf_dir):
    return S.kfold(orders(spark, sf_dir).select("o_orderkey"), ["o_orderkey"], 7)


STRATIFIED = f"""WITH r AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1
  AS i, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
  SELECT o_orderkey, o_orderstatus, {block_sql('i', 'n')} AS fold FROM r"""


@query("stratified_kfold", STRATIFIED)
def _stratified_kfold(spark, sf_dir):
    rows = orders(spark, sf_dir).select("o_orderkey", "o_orderstatus")
    return S.stratified_kfold(rows, "o_orderstatus", ["o_orderkey"])


@query(
    "timeseries_kfold",
    """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders)
    SELECT o_orderkey, CAST(CASE WHEN i < n - 5 * (n // 6) THEN -1 ELSE (i - (n - 5 * (n // 6))) // (n // 6) END AS INTEGER)
    AS fold FROM r""",
)
def _timeseries_kfold(spark, sf_dir):
    return S.timeseries_kfold(orders(spark, sf_dir), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "fold")


@query(
    "group_kfold",
    """SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY month(o_orderdate)) - 1 AS INTEGER) AS fold FROM orders""",
)
def _group_kfold(spark, sf_dir):
    return S.group_kfold(orders(spark, sf_dir), F.month("o_orderdate")).select("o_orderkey", "fold")


@query(
    "undersampled_kfold",
    f"""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 29 = 0 THEN 1 ELSE 0 END AS y FROM orders),
    r AS (SELECT o_orderkey, y, row_number() OVER (PARTITION BY y ORDER BY o_orderkey) - 1 AS i,
      count(*) OVER (PARTITION BY y) AS n FROM o),
    f AS (SELECT o_orderkey, y, {block_sql('i', 'n')} AS own FROM r),
    runs AS (SELECT f.*, CAST(g AS INTEGER) AS fold FROM f, (SELECT unnest(range(0, 5)) AS g)),
    a AS (SELECT fold, count(*) AS a FROM runs WHERE fold <> own AND y = 1 GROUP BY fold),
    t AS (SELECT o_orderkey, y, fold, row_number() OVER (PARTITION BY fold, y ORDER BY {OH}, o_orderkey) AS i
      FROM runs WHERE fold <> own)
    SELECT o_orderkey, y, fold, 'train' AS split FROM t JOIN a USING (fold) WHERE y = 1 OR i <= floor(a / 0.1::DOUBLE - a)
    UNION ALL SELECT o_orderkey, y, fold, 'validation' FROM runs WHERE fold = own""",
)
def _undersampled_kfold(spark, sf_dir):
    rows = orders(spark, sf_dir).select(
        "o_orderkey", F.when(F.col("o_orderkey") % 29 == 0, 1).otherwise(0).alias("y")
    )
    return S.undersampled_kfold(rows, "o_orderkey", "y", ["o_orderkey"])


# Undersampling and the leakage guard inside every fold; an entity's rows lie far apart, so most folds share some.
MEMBER_SQL = f"""WITH o AS (SELECT o_orderkey, o_orderkey % 4001 AS entity, CASE WHEN o_orderkey % 29 = 0 THEN 1 ELSE 0 END AS y FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY o_orderkey) - 1 AS i, count(*) OVER (PARTITION BY y) AS n FROM o),
f AS (SELECT o_orderkey, entity, y, {block_sql('i', 'n')} AS own FROM r),
runs AS (SELECT f.*, CAST(g AS INTEGER) AS fold FROM f, (SELECT unnest(range(0, 5)) AS g)),
a AS (SELECT fold, count(*) AS a FROM runs WHERE fold <> own AND y = 1 GROUP BY fold),
t AS (SELECT *, row_number() OVER (PARTITION BY fold, y ORDER BY {OH}, o_orderkey) AS place FROM runs WHERE fold <> own),
train AS (SELECT t.* FROM t JOIN a USING (fold) WHERE y = 1 OR place <= floor(a / 0.1::DOUBLE - a)),
members AS (SELECT fold, 'training' AS role, y, entity FROM train UNION ALL
  SELECT fold, 'validation', y, entity FROM runs WHERE fold = own
    AND NOT EXISTS (SELECT 1 FROM train WHERE train.fold = runs.fold AND train.entity = runs.entity))"""


@query(
    "fold_members",
    f"""{MEMBER_SQL} SELECT fold, role, y, count(*) AS n, CAST(0 AS BIGINT) AS shared_entities FROM members GROUP BY fold, role, y""",
)
def _members(spark, sf_dir):
    key = F.col("o_orderkey")
    rows = orders(spark, sf_dir).select("o_orderkey", (key % 4001).alias("entity"), F.when(key % 29 == 0, 1).otherwise(0).alias("y"))
    folded = N.with_roles(S.stratified_kfold(rows, "y", ["o_orderkey"], 5, "own"), "own", 5)
    thinned = N.undersampled(folded, ["o_orderkey"], "y", 5)
    found = written(N.members(N.guarded(thinned, ["o_orderkey"], "entity", ["o_orderkey"], 5), ["entity", "y"]), "fold-members")
    sides = found.groupBy("fold", "entity").agg(F.count_distinct("role").alias("sides"))
    shared = sides.groupBy("fold").agg(F.count_if(F.col("sides") > 1).alias("shared_entities"))
    counts = found.groupBy("fold", "role", "y").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(shared, "fold").select("fold", "role", "y", "n", "shared_entities")
