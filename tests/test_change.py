import pytest
from pyspark.errors import PySparkException

from martloom.operators import change
from martloom.operators.dedup import keep_last, merge_keep_last

T = "k int, a string, b int"


def frames(spark):
    target = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (2, "z", 3), (None, "n", 4)], T)
    staging = spark.createDataFrame([(2, "new", 9), (2, "dup", 8), (5, "add", 7), (None, "m", 6)], T)
    return target, staging


def test_null_keys_never_match_and_duplicates_are_kept(spark, rows):
    target, staging = frames(spark)
    got = rows(change.replace_by_name(target, staging, "k"))
    assert got == sorted(
        [(1, "x", 1), (2, "new", 9), (2, "dup", 8), (5, "add", 7), (None, "n", 4), (None, "m", 6)],
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


def test_counts_and_size_law(spark):
    target, staging = frames(spark)
    counts = change.change_counts(target, staging, "k").first()
    assert counts.asDict() == {"staging_count": 4, "deleted_count": 2, "inserted_count": 4}
    after = change.replace_by_name(target, staging, "k").count()
    assert after == target.count() - counts.deleted_count + counts.staging_count


def test_replace_is_idempotent_for_rows_with_a_key(spark, rows):
    target, staging = frames(spark)
    staging = staging.where("k is not null")
    once = change.replace_by_name(target, staging, "k")
    assert rows(change.replace_by_name(once, staging, "k")) == rows(once)


def test_by_name_rules(spark, rows):
    target, _ = frames(spark)
    staging = spark.createDataFrame([("q", 1)], "extra string, k int")
    assert (1, None, None) in rows(change.replace_by_name(target, staging, ["k"]))
    with pytest.raises(ValueError, match="share no column"):
        change.replace_by_name(target, spark.createDataFrame([(1,)], "other int"), ["k"])
    with pytest.raises(ValueError, match="not in both"):
        change.replace_by_name(target, spark.createDataFrame([("a",)], "a string"), ["k"])
    with pytest.raises(ValueError, match="number of columns"):
        change.replace_by_position(target, spark.createDataFrame([(1,)], "k int"), ["k"])


def test_positional_takes_target_names_and_types(spark, rows):
    target, _ = frames(spark)
    staging = spark.createDataFrame([("1", "p", "5")], "x string, y string, z string")
    got = change.replace_by_position(target, staging, "k")
    assert got.schema.simpleString() == "struct<k:int,a:string,b:int>"
    assert (1, "p", 5) in rows(got)


def test_composite_key_with_a_null_part(spark, rows):
    target = spark.createDataFrame([(1, None, 1), (1, "x", 2)], T)
    staging = spark.createDataFrame([(1, None, 10), (1, "x", 20)], T)
    got = rows(change.replace_by_name(target, staging, ["k", "a"]))
    assert got == [(1, "x", 20), (1, None, 1), (1, None, 10)]


def test_partial_update_keeps_other_columns(spark, rows):
    target = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (None, "n", 3)], T)
    staging = spark.createDataFrame([(1, None, 10), (3, "w", 30), (None, "m", 4)], T)
    assert rows(change.update_or_insert(target, staging, "k", ["b"])) == [
        (1, "x", 10), (2, "y", 2), (3, "w", 30), (None, "m", 4), (None, "n", 3)
    ]
    # A NULL in an updated column overwrites, as an update does.
    assert (1, None, 10) in rows(change.update_or_insert(target, staging, "k"))


def test_partial_update_rejects_repeated_staging_keys(spark):
    target, staging = frames(spark)
    with pytest.raises(PySparkException, match="staging key repeats, rows: 2"):
        change.update_or_insert(target, staging, "k").collect()


def test_slice_replace_keeps_rows_where_the_predicate_is_null(spark, rows):
    target, _ = frames(spark)
    from pyspark.sql import functions as F

    kept = change.replace_slice(target, F.col("k") >= 1, target.limit(0))
    assert rows(kept) == [(None, "n", 4)]


def test_group_delete_and_append(spark):
    target, staging = frames(spark)
    assert change.delete_groups(target, staging, ["k"]).count() == 2
    assert change.merge_on_key(target, staging).count() == 8
    with pytest.raises(ValueError, match="lacks columns"):
        change.delete_groups(target, staging, ["nope"])


def test_merge_keep_last(spark, rows):
    schema = "p string, k int, seq int, v string"
    old = spark.createDataFrame(
        [("a", 1, 9, "old"), ("a", None, 1, "old"), ("b", 1, 1, "other"), (None, 1, 1, "nopart")], schema
    )
    new = spark.createDataFrame([("a", 1, 1, "new"), ("a", 1, 2, "newer"), ("a", None, 0, "null")], schema)
    merged = merge_keep_last(old, new, ["k"], ["seq"], partition_by=["p"])
    assert rows(merged) == [("a", 1, 2, "newer"), ("a", None, 0, "null")]
    again = merge_keep_last(merged, new, ["k"], ["seq"], partition_by=["p"])
    assert rows(again) == rows(merged)
    assert rows(keep_last(old, ["k"], ["seq"]).select("k", "v")) == [(1, "old"), (None, "old")]
