import json
import re
import zipfile
from datetime import date
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators.refresh import full_refresh
from martloom.session import shared_dir
from martloom.sources import files, tables
from martloom.sources.publish import VersionedTable, publish_together
from martloom.sources.queries import page, run_named
from martloom.streaming.ingest import ingest_files


def test_json_shapes(spark, folder, rows):
    for name, doc in {
        "list": [{"a": 1}, {"a": 2}], "wrapped": {"errors": [], "rows": [{"a": 3}]}, "single": {"a": 4}
    }.items():
        Path(folder, f"{name}.json").write_text(json.dumps(doc, indent=1))
    assert rows(files.read_json_records(spark, f"{folder}/list.json")) == [(1,), (2,)]
    assert rows(files.read_json_records(spark, f"{folder}/single.json")) == [(4,)]
    wrapped = files.read_json_records(spark, f"{folder}/wrapped.json")
    assert rows(wrapped.select("a")) == [(3,)]


def test_json_lists_of_different_kinds(spark, folder, rows):
    docs = [{"a": [{"x": 1}], "b": [{"y": 2}]}, {"a": [], "b": [{"y": 3}]}, {"a": [], "b": [], "n": 9}]
    Path(folder, "d.json").write_text("\n".join(json.dumps(d) for d in docs))
    schema = "a array<struct<x: int>>, b array<struct<y: int>>, n int"
    got = files.read_json_records(spark, folder, schema, doc_per_line=True)
    assert rows(got.select("x", "y")) == [(1, None), (None, 3)]
    kept = files.read_json_records(spark, folder, schema, doc_per_line=True, keep_without_items=True)
    assert rows(kept.select("x", "y", "n")) == [(1, None, None), (None, 3, None), (None, None, 9)]


def test_json_lists_in_document_order(spark, folder, rows):
    """The first list by name is not the first in the document."""
    docs = [
        '{"note": "[1, 2]", "z": [{"k": 1, "v": "x"}], "a": [{"k": 9}]}', '{"z": [], "m": {"k": 8}, "a": [{"k": 2}, 7, "q"]}',
        '[{"k": 3}, {"v": "[]"}]', '{"k": 4, "z": []}', '{"a": [{"k": 5}], "z": [{"k": 9}]}', "", "{broken", "[]",
    ]
    for i, doc in enumerate(docs):
        Path(folder, f"d{i}.json").write_text(doc)
    want = [(1, "x"), (2, None), (3, None), (4, None), (5, None), (None, "[]")]
    assert rows(files.read_json_in_order(spark, folder, "k int, v string")) == want
    Path(folder, "lines").mkdir()
    Path(folder, "lines", "all.json").write_text("\n".join(docs))
    got = files.read_json_in_order(spark, f"{folder}/lines", "k int, v string", doc_per_line=True)
    assert rows(got) == want


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_json_records_cut_from_a_stream(size):
    items = [{"a": 'x"],{\\', "b": [1, {"c": "]"}]}, 5, "t,]\\\"", [], [[1], {}], {}, None, True, "é"]
    for doc in (items, [], {"a": [1, 2], "b": "[,"}, "text", 7, [[]]):
        for text in (json.dumps(doc), json.dumps(doc, indent=2, ensure_ascii=False)):
            pieces = (text[i : i + size] for i in range(0, len(text), size))
            got = [json.loads(r) for r in files.json_records(pieces)]
            assert got == (doc if isinstance(doc, list) else [doc])
    with pytest.raises(ValueError):
        list(files.json_records(iter(['[{"a": 1}, {"a"', ": 2}"])))


def test_a_zip_member_is_never_held_whole():
    """Records come while the member is still being read."""
    read = []

    def pieces():
        yield "["
        for i in range(1000):
            read.append(i)
            yield json.dumps({"i": i, "pad": "x" * 1000}) + ("," if i < 999 else "]")

    for n, record in enumerate(files.json_records(pieces())):
        assert json.loads(record)["i"] == n and len(read) <= n + 2
    assert n == 999


def test_partition_keyed_replace_leaves_other_partitions_alone(spark, folder, rows):
    schema = "k int, v string, p int"
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "n", 1), (4, "d", None)], schema)
    tables.write_partitioned(old, folder, ["p"])
    untouched = {f.name for f in Path(folder, "p=2").iterdir()}
    incoming = spark.createDataFrame([(1, "new", 1), (1, "dup", 1), (5, "e", 1), (4, "x", None)], schema)
    tables.replace_keys_in_partitions(spark, incoming, folder, ["p"], ["k"])
    assert rows(spark.read.schema(schema).parquet(folder)) == [
        (1, "dup", 1), (1, "new", 1), (2, "b", 2), (4, "x", None), (5, "e", 1), (None, "n", 1)
    ]
    assert {f.name for f in Path(folder, "p=2").iterdir()} == untouched


def test_many_touched_partitions_still_prune(spark, folder):
    schema = "k bigint, p bigint"
    tables.write_partitioned(spark.createDataFrame([(1, 5), (2, 5000), (3, None)], schema), folder, ["p"])
    incoming = spark.range(2000).select(F.col("id").alias("k"), F.col("id").alias("p"))
    covered = spark.read.schema(schema).parquet(folder).where(tables.touched_range(incoming, ["p"]))
    plan = covered._jdf.queryExecution().executedPlan().toString()
    assert "p#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert [r.k for r in covered.collect()] == [1]


def test_a_key_that_changes_partition_leaves_one_row(spark, folder, rows):
    schema = "k int, v string, p string"
    old = spark.createDataFrame([(1, "a", "x y"), (2, "b", "z"), (3, "c", "z")], schema)
    tables.write_partitioned(old, folder, ["p"])
    incoming = spark.createDataFrame([(1, "new", "z"), (3, "moved", None)], schema)
    tables.replace_keys_in_partitions(spark, incoming, folder, ["p"], ["k"])
    assert rows(spark.read.schema(schema).parquet(folder)) == [
        (1, "new", "z"), (2, "b", "z"), (3, "moved", None)
    ]


def test_csv_names_and_bad_dates(spark, folder, rows):
    Path(folder, "a.csv").write_text("Sale Date,Net (INR),a-b\n01-02-2024,5,x\nsoon,6,y\n")
    df = files.read_csv_drop(spark, folder, run_id="r1", date_columns=["sale_date"], date_format="dd-MM-yyyy")
    assert df.columns == ["sale_date", "net_inr", "a_b", "run_id"]
    assert [(str(r[0]), *r[1:]) for r in df.orderBy("net_inr").collect()] == [
        ("2024-02-01 00:00:00", 5, "x", "r1"), ("None", 6, "y", "r1")
    ]


def test_zip_files(spark, folder, rows):
    for i in range(3):
        with zipfile.ZipFile(f"{folder}/drop{i}.zip", "w") as archive:
            archive.writestr("x.json", json.dumps([{"sku": f"s{i}", "qty": i}, {"sku": "t", "extra": 1}]))
    got = files.read_zip_json(spark, folder, T.StructType.fromDDL("sku string, qty int"))
    assert rows(got) == [("s0", 0), ("s1", 1), ("s2", 2), ("t", None), ("t", None), ("t", None)]


def test_versions_switch_after_the_write(spark, folder, rows):
    table = VersionedTable(spark, f"{folder}/t")
    assert not table.exists()
    table.publish(spark.range(3))
    first, second = table.write(spark.range(9)), table.write(spark.range(5))
    assert table.read().count() == 3 and table.version() == 1
    table.switch(second)
    assert table.read().count() == 5 and table.version() == 2
    with pytest.raises(Exception, match="already exists"):
        table.switch(first)


def test_publish_together(spark, folder):
    a, b = VersionedTable(spark, f"{folder}/a"), VersionedTable(spark, f"{folder}/b")
    broken = spark.range(1).select(F.raise_error(F.lit("boom")).alias("x"))
    with pytest.raises(Exception, match="boom"):
        publish_together([(a, spark.range(2)), (b, broken)])
    assert not a.exists() and not b.exists()
    c, d = VersionedTable(spark, f"{folder}/c"), VersionedTable(spark, f"{folder}/d")
    assert publish_together([(c, spark.range(2)), (d, spark.range(3))]) == [1, 1]
    assert c.read().count() == 2 and d.read().count() == 3


def test_a_unit_that_broke_off_changes_nothing(spark, folder):
    a = VersionedTable(spark, f"{folder}/a")
    a.publish(spark.range(2))
    a.switch(a.write(spark.range(9)), f"{folder}/a/_units_/broken")
    assert a.version() == 1 and a.read().count() == 2
    assert a.publish(spark.range(4)) == 3 and a.read().count() == 4
    assert publish_together([]) == []


def test_load_outcomes(spark, folder):
    table = VersionedTable(spark, f"{folder}/t")
    table.publish(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    empty = tables.load_table(table, spark.createDataFrame([], "k int, v string"), "k")
    assert empty["success"] and table.version() == 1
    bad = tables.load_table(table, spark.createDataFrame([("x", "a")], "k string, v string"), "k")
    assert not bad["success"] and "k: type differs" in bad["message"] and table.version() == 1
    done = tables.load_table(table, spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), "k")
    assert done["counts"] == {"staging_count": 2, "deleted_count": 1, "inserted_count": 2}
    assert table.version() == 2 and table.read().count() == 3


def test_days_that_fail_are_left_out(spark, folder, rows):
    schema = "k int, v int, day date"
    table = VersionedTable(spark, f"{folder}/t")
    first, second = date(2024, 1, 1), date(2024, 1, 2)
    table.publish(spark.createDataFrame([(1, 1, first), (2, 2, second)], schema))
    drop = [(1, 10, first), (3, 30, first), (2, 20, second), (4, None, second), (5, 50, None)]
    drop, checks = spark.createDataFrame(drop, schema), {"value missing": F.col("v") > 0}
    got = tables.load_days(table, drop, F.col("day"), ["k"], checks)
    assert rows(got) == [(first, 2, True, None), (second, 2, False, "value missing"), (None, 1, False, "no day")]
    assert rows(table.read().select("k", "v")) == [(1, 10), (2, 2), (3, 30)]
    tables.load_days(table, drop.where("k = 5"), F.col("day"), ["k"], checks)
    assert table.version() == 2
    assert rows(tables.load_days(table, drop.limit(0), F.col("day"), ["k"], checks)) == []


def test_statistics_of_a_table(spark):
    spark.sql("DROP TABLE IF EXISTS martloom_stats")
    tables.insert_into(spark.range(7), "martloom_stats", "replace")
    tables.analyze(spark, "martloom_stats", ["id"])
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED martloom_stats").collect()}
    assert "7 rows" in described["Statistics"]
    spark.sql("DROP TABLE martloom_stats")


def test_partition_writes(spark, folder, rows):
    schema = "k int, v string, p string"
    tables.write_partitioned(
        spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", None)], schema), folder, ["p"]
    )
    incoming = spark.createDataFrame([(1, "new", "x"), (9, "add", "x")], schema)
    tables.merge_partitions(spark, incoming, folder, ["p"], ["k"], ["v"])
    got = spark.read.schema(schema).parquet(folder)
    assert rows(got) == [(1, "new", "x"), (2, "b", "y"), (3, "c", None), (9, "add", "x")]
    with pytest.raises(ValueError, match="unknown partition"):
        tables.write_partitioned(incoming, folder, ["nope"])


def test_insert_choices(spark):
    with pytest.raises(ValueError, match="if_exists"):
        tables.insert_into(spark.range(1), "t", "merge")


def test_full_refresh_keeps_the_table_when_empty(spark, folder, rows):
    table = VersionedTable(spark, f"{folder}/t")
    sheet = spark.createDataFrame([("1", "x"), (" ", "y")], "`Qty No` string, Note string")
    assert full_refresh(table, sheet, "r1") == {"loaded": True, "version": 1}
    assert table.read().schema.simpleString() == "struct<Qty_No:bigint,Note:string,run_id:string>"
    assert full_refresh(table, sheet.limit(0))["loaded"] is False
    changed = spark.createDataFrame([("2.5", "n")], "`Qty No` string, Added string")
    full_refresh(table, changed)
    assert rows(table.read()) == [(2, "n")]
    assert table.read().columns == ["Qty_No", "Added"]


def test_stream_remembers_loaded_files(spark, folder, rows):
    schema = T.StructType.fromDDL("k int, v string")
    table = VersionedTable(spark, f"{folder}/t")

    def drop(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        return ingest_files(spark, f"{folder}/in", schema, table, ["k"], f"{folder}/cp", files_per_batch=1)

    assert drop([(1, "a"), (2, "b")]) == 1
    assert drop([(2, "c"), (3, "d")]) == 2
    assert rows(table.read()) == [(1, "a"), (2, "c"), (3, "d")]


def test_shared_folder_comes_from_the_session():
    session = SimpleNamespace(conf={"spark.checkpoint.dir": "/shared/jobs/"})
    assert re.fullmatch("/shared/jobs/[0-9a-f]{32}", shared_dir(session))


def test_pages_and_named_queries(spark):
    with pytest.raises(ValueError, match="cannot sort"):
        page(spark.range(3), "password", ["id"])
    assert [r.id for r in page(spark.range(9), "id", ["id"], limit=2, offset=3).collect()] == [5, 4]
    with pytest.raises(ValueError, match="needs a limit"):
        page(spark.range(3), "id", ["id"], offset=1)
    with pytest.raises(KeyError):
        run_named(spark, {}, "nope")
