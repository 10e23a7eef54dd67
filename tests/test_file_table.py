"""File tables: which files a change rewrites, and that the rows are those of the plain operators."""

import random
import time
from collections import Counter
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.operators import change
from martloom.operators.dedup import merge_keep_last
from martloom.sources import loads
from martloom.sources.file_table import FileTable
from martloom.sources.tables import load_many
from martloom.streaming.ingest import ingest_once
from martloom.sources.publish import VersionedTable

KV = "k int, g string, v int"


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def files(table):
    return {r["file"] for r in table.files().collect()}


@pytest.fixture
def table(spark, folder):
    """2,000 keys in 20 files; ten keys to a group."""
    out = FileTable(spark, f"{folder}/t", (("k",), ("g",)), file_rows=100)
    out.publish(spark.range(2000).select(F.col("id").cast("int").alias("k"), F.expr("concat('g', id div 10)").alias("g"), F.lit(0).alias("v")).coalesce(1))
    return out


def test_a_load_of_one_percent_rewrites_the_files_hit(spark, table):
    before, old = files(table), bag(table.read())
    assert len(before) == 20
    staging = spark.createDataFrame([(k, "x", 1) for k in range(500, 519)] + [(5000, "y", 1), (None, "z", 1)], KV)
    want = bag(change.replace_by_name(table.read(), staging, ["k"]))
    done = loads.load_keyed(table, staging, "k")
    after = files(table)
    assert done["rewritten"] == 1 and len(before - after) == 1 and len(before & after) == 19
    assert done["counts"] == {"staging_count": 21, "deleted_count": 19, "inserted_count": 21}
    assert bag(table.read()) == want != old and table.version() == 2


def test_group_replace_looks_groups_up_too(spark, table):
    before = files(table)
    staging = spark.createDataFrame([(1, "g150", 1), (None, "g151", 1), (7000, None, 1)], KV)
    base = change.delete_groups(table.read(), staging, ["g"])
    want = bag(change.replace_by_name(base, staging, ["k"]))
    done = loads.load_keyed(table, staging, ["k"], ["g"])
    assert done["rewritten"] == 2 and len(files(table) & before) == 18
    assert bag(table.read()) == want


def test_keys_inside_a_range_that_no_file_holds_pass_the_filter(spark, folder):
    """Ranges of the files overlap wholly; the Bloom filters tell them apart."""
    out = FileTable(spark, f"{folder}/t", (("k",),))
    rows = lambda r: spark.range(4000).where(f"id % 8 = {r}").select(F.col("id").cast("int").alias("k"), F.lit("g").alias("g"), F.lit(0).alias("v"))
    out.publish(rows(0).coalesce(1))
    for r in range(1, 4):
        out.commit(add=rows(r))
    hit = out.files_with(spark.createDataFrame([(k, "", 0) for k in (80, 88, 960)], KV), ["k"])
    held = {r["file"] for r in out.read().where("k IN (80, 88, 960)").select(F.regexp_extract("_metadata.file_path", "[^/]+/[^/]+$", 0).alias("file")).collect()}
    assert held <= set(hit) and len(hit) <= 2
    none = out.files_with(spark.createDataFrame([(6 + 8 * i, "", 0) for i in range(20)], KV), ["k"])
    assert len(none) <= 3


def test_random_loads_equal_the_plain_operators(spark, folder):
    r = random.Random(4)
    schema = "k string, d date, p decimal(9,2), g int, v int"
    def rows(n):
        return spark.createDataFrame(
            [(r.choice([None, "ä", "b", "zz", *(f"k{i}" for i in range(30))]), r.choice([None, date(2024, 1, r.randint(1, 20))]),
              r.choice([None, Decimal(r.randint(0, 9)) / 4]), r.choice([None, *range(12)]), r.randint(0, 99)) for _ in range(n)], schema)
    keys, groups = ["k", "d", "p"], ["g"]
    out = FileTable(spark, f"{folder}/t", (tuple(keys), tuple(groups)), file_rows=20)
    want = rows(300)
    out.publish(want)
    want = Counter(bag(want))
    for step in range(3):
        staging = rows(12)
        use = groups if step % 2 else None
        target = spark.createDataFrame([t for t, n in want.items() for _ in range(n)], schema)
        want = bag(change.load(target, staging, keys, use))
        assert loads.load_keyed(out, staging, keys, use)["success"]
        assert bag(out.read()) == want


def test_outcomes_without_a_change(spark, table):
    assert loads.load_keyed(table, spark.createDataFrame([], KV), "k")["message"] == "no rows to load"
    bad = loads.load_keyed(table, spark.createDataFrame([("x", "g", 1)], "k string, g string, v int"), "k")
    assert not bad["success"] and "k: type differs" in bad["message"] and table.version() == 1
    with pytest.raises(ValueError, match="indexes"):
        FileTable(spark, table.path, (("g",),)).read()
    with pytest.raises(ValueError, match="rows are"):
        table.commit(add=spark.range(3))


def test_of_two_writers_the_later_one_fails(spark, table):
    seen = table.snapshot()
    table.commit(add=spark.createDataFrame([(1, "a", 1)], KV))
    rows = bag(table.read())
    with pytest.raises(Exception, match="already exists"):
        table.commit(add=spark.createDataFrame([(2, "b", 2)], KV), after=seen)
    assert bag(table.read()) == rows and table.version() == 2


def test_a_reader_keeps_its_version(spark, table):
    reader = table.read()
    loads.load_keyed(table, spark.createDataFrame([(3, "new", 9)], KV), "k")
    assert reader.where("v = 9").isEmpty() and reader.count() == 2000
    assert table.read().where("v = 9").count() == 1


def test_partitions_are_replaced_and_merged_together(spark, folder):
    r = random.Random(5)
    schema = "p string, k int, s int"
    parts = ["a", "b", "c", None]
    old = spark.createDataFrame([(r.choice(parts), r.randrange(40), r.randrange(99)) for _ in range(200)], schema)
    new = spark.createDataFrame([("a", 1, 5), ("a", 1, 7), (None, 90, 1), ("new", 3, 3), (None, 2, 2)], schema)
    table = FileTable(spark, f"{folder}/t", (("p",),), file_rows=20)
    table.publish(old)
    before = files(table)
    loads.merge_in_table(table, new, ["p"], ["k"], ["s"])
    others = old.where("p IN ('b', 'c')")
    assert bag(table.read()) == bag(others) + bag(merge_keep_last(old, new, ["k"], ["s"], partition_by=["p"]))
    assert len(before & files(table)) >= 3
    loads.replace_in_table(table, new, ["p"])
    assert bag(table.read()) == bag(others) + bag(new)


def test_compaction_packs_small_files_only(spark, folder):
    table = FileTable(spark, f"{folder}/t", (("k",),))
    big = spark.range(60000).select(F.col("id").cast("int").alias("k"), F.md5(F.col("id").cast("string")).alias("g"), F.lit(0).alias("v"))
    table.publish(big.coalesce(1))
    for i in range(4):
        table.commit(add=spark.createDataFrame([(100000 + i, "s", i)], KV))
    rows, sizes = bag(table.read()), {r["file"]: r["bytes"] for r in table.files().collect()}
    small = {f for f, b in sizes.items() if b < 100_000}
    assert len(small) == 4
    target = 2 * max(sizes[f] for f in small)
    assert table.compact(100_000, target) == 6
    after = files(table)
    assert set(sizes) - small <= after and not small & after and len(after - set(sizes)) == 2
    assert bag(table.read()) == rows
    assert table.compact(100, target) is None and table.version() == 6


def test_old_versions_expire_by_age(spark, table):
    first = table.read()
    loads.load_keyed(table, spark.createDataFrame([(3, "new", 9)], KV), "k", batch=("s", 7))
    time.sleep(1.1)
    middle = datetime.now(timezone.utc)
    loads.load_keyed(table, spark.createDataFrame([(1900, "new", 9)], KV), "k")
    rows = bag(table.read())
    assert table.expire(datetime.now(timezone.utc) - timedelta(days=1)) == 0
    assert table.expire(middle) == 1  # the file that version 2 replaced
    assert bag(table.read()) == rows and table.version() == 3 and table.has_batch("s", 7)
    with pytest.raises(Exception):
        first.collect()
    assert table.log().count() == 2


def test_many_files_in_one_rewrite_equal_one_after_the_other(spark, folder):
    r = random.Random(6)
    rows = lambda n: spark.createDataFrame([(r.choice([None, *range(30)]), r.choice([None, "a", "b", "c", "d", "e"]), r.randrange(99)) for _ in range(n)], KV)
    start, paths = rows(40), []
    for i in range(4):
        rows(8).coalesce(1).write.parquet(f"{folder}/drop{i}")
        paths.append(f"{folder}/drop{i}")
    spark.createDataFrame([("x", "a", 1)], "k string, g string, v int").write.parquet(f"{folder}/bad")
    paths[2:2] = [f"{folder}/missing", f"{folder}/bad"]
    for name, groups in (("keyed", None), ("grouped", ["g"])):
        plain = VersionedTable(spark, f"{folder}/plain_{name}")
        plain.publish(start)
        want = load_many(spark, plain, paths, ["k"], groups)
        table = FileTable(spark, f"{folder}/table_{name}", (("k",), ("g",)), file_rows=10)
        table.publish(start)
        got = loads.load_many_files(table, paths, ["k"], groups)
        assert [(x["ok"], x["inserted"]) for x in got.orderBy("path").collect()] == [
            (x["ok"], x["inserted"]) for x in want.orderBy("path").collect()
        ]
        assert bag(table.read()) == bag(plain.read()) and table.version() == 2


def test_a_batch_that_runs_again_adds_nothing(spark, folder):
    table = FileTable(spark, f"{folder}/t", (("k",),))
    schema = spark.createDataFrame([], KV).schema

    def arrive(rows):
        spark.createDataFrame(rows, KV).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        return ingest_once(spark, f"{folder}/in", schema, table, ["k"], f"{folder}/cp")

    assert arrive([(1, "a", 1), (None, "n", 1)]) == 1
    assert arrive([(1, "b", 2), (None, "m", 2)]) == 2
    want = Counter([(1, "b", 2), (None, "n", 1), (None, "m", 2)])
    assert bag(table.read()) == want
    again = spark.createDataFrame([(1, "b", 2), (None, "m", 2)], KV)
    done = loads.load_keyed(table, again, ["k"], batch=(f"{folder}/cp", 1))
    assert done["message"] == "batch 1 is loaded already" and bag(table.read()) == want and table.version() == 2


def test_a_frequent_index_value_is_written_by_several_tasks(spark, folder):
    table = FileTable(spark, f"{folder}/hot", (("g",),))
    rows = spark.range(60_000).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("g"), F.lit(0).alias("v"))
    few = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.publish(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", few)
    held = table.files().collect()
    assert len(held) > 1 and max(r["rows"] for r in held) < 60_000 and sum(r["rows"] for r in held) == 60_000
    assert table.files_with(spark.createDataFrame([("x",)], "g string"), ["g"]) == sorted(r["file"] for r in held)
    assert table.files_with(spark.createDataFrame([("y",)], "g string"), ["g"]) == []
    # A filter holds the different keys of a file, not one entry a row.
    bits = spark.read.parquet(f"{table.path}/_blooms_/*")
    assert bits.agg(F.max(F.length("bits"))).first()[0] == 8
