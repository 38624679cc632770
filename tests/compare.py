"""Compare registered queries with their SQL on DuckDB: rows, column types, values."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    return str(value)


def difference(spark, con, sf_dir: str, run, sql: str) -> str | None:
    """None when both sides agree, else what is different."""
    got = run(spark, sf_dir)
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    kinds = {d[0]: str(d[1]) for d in want.description}
    if sorted(names) != sorted(got.columns):
        return f"columns {sorted(got.columns)} != {sorted(names)}"
    for f in got.schema.fields:
        expected = TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
        if expected != kinds[f.name]:
            return f"type of {f.name}: {f.dataType.simpleString()} != {kinds[f.name]}"
    order = sorted(names)
    mine = Counter(tuple(plain(r[c]) for c in order) for r in got.collect())
    at = [names.index(c) for c in order]
    theirs = Counter(tuple(plain(r[i]) for i in at) for r in want.fetchall())
    if mine == theirs:
        return None
    extra, missing = list((mine - theirs).elements()), list((theirs - mine).elements())
    return (
        f"{sum(mine.values())} rows vs {sum(theirs.values())}; {len(extra)} only in Spark, {len(missing)} only in SQL"
        f"\n    {order}\n    spark {sorted(extra)[:4]}\n    sql   {sorted(missing)[:4]}"
    )


def session():
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def main() -> None:
    sys.path.insert(0, str(Path(__file__).parents[1]))
    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir = args.pop(0)
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not args or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in args)]
    spark, con = session(), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for n in names:
        start = time.time()
        try:
            if n in oracle:
                problem = difference(spark, con, sf_dir, queries[n], oracle[n])
                state = "ok" if problem is None else f"DIFF {problem}"
            else:
                state = f"rows only: {queries[n](spark, sf_dir).count()}"
        except Exception as e:  # report and go on with the next query
            state = f"ERROR {type(e).__name__}: {str(e)[:700]}"
        bad += state.startswith(("DIFF", "ERROR"))
        print(f"{n:32s} {time.time() - start:6.1f}s {state}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()
