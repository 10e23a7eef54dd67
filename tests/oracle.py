"""Compare a registered query with its SQL run by DuckDB on the same tables."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "FLOAT": "float", "SMALLINT": "smallint",
}


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("martloom-check")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", "/tmp/martloom-warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    return v


def differences(spark, con, sf_dir, build, sql) -> list[str]:
    df = build(spark, sf_dir)
    order = sorted(df.columns)
    got = Counter(tuple(_value(r[c]) for c in order) for r in df.collect())
    rel = con.sql(sql)
    types = dict(zip(rel.columns, map(str, rel.types)))
    problems = []
    if sorted(rel.columns) != order:
        return [f"columns differ: {order} / {sorted(rel.columns)}"]
    for f in df.schema.fields:
        want = SPARK_TYPES.get(types[f.name], types[f.name])
        if want != f.dataType.simpleString():
            problems.append(f"type of {f.name}: {f.dataType.simpleString()} / {types[f.name]}")
    at = [rel.columns.index(c) for c in order]
    want_rows = Counter(tuple(_value(r[i]) for i in at) for r in rel.fetchall())
    if got != want_rows:
        problems.append(f"rows {sum(got.values())} / {sum(want_rows.values())}")
        problems.append(f"only spark: {list((got - want_rows).items())[:3]}")
        problems.append(f"only sql:   {list((want_rows - got).items())[:3]}")
    elif not got:
        problems.append("no rows")
    return problems


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry

    sf = sys.argv[1]
    keys = sys.argv[2:] or list(entry.queries())
    spark, bad = session(), 0
    spark.conf.set("spark.sql.ansi.enabled", "true")
    con = duck(sf)
    for key in keys:
        began = time.time()
        try:
            sql = entry.oracle_sql().get(key)
            build = entry.queries()[key]
            if sql is None:
                found = [] if build(spark, sf).count() else ["no rows"]
            else:
                found = differences(spark, con, sf, build, sql)
        except Exception as e:  # noqa: BLE001
            found = [f"{type(e).__name__}: {str(e)[:700]}"]
        bad += bool(found)
        print("BAD " if found else "ok  ", key, f"{time.time() - began:.1f}s", *found, sep="\n   " if found else " ", flush=True)
    print("bad:", bad, "of", len(keys))
