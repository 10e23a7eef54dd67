from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators import inference, schema
from martloom.operators.validate import compatible, schema_findings


def kinds(spark, values, ddl="string"):
    df = spark.createDataFrame([(v,) for v in values], f"c {ddl}")
    return inference.infer_types(df).first().inferred_type


def test_value_rules(spark):
    assert kinds(spark, ["1", " 32766 ", None, ""]) == "smallint"
    assert kinds(spark, ["32767"]) == "integer"
    assert kinds(spark, ["2147483647"]) == "bigint"
    assert kinds(spark, ["1.5", "20.25"]) == "numeric(4,2)"
    assert kinds(spark, ["0.1", "999999.123456"]) == "numeric(12,6)"
    assert kinds(spark, ["0.29", "1000000.5"]) == "double precision"
    assert kinds(spark, ["abc"]) == "character varying(4)"
    assert kinds(spark, ["a"]) == "character varying(1)"
    assert kinds(spark, ["x" * 1001]) == "text"
    assert kinds(spark, ["x" * 900]) == "character varying(1000)"
    assert kinds(spark, ["", " "]) == "character varying(255)"
    assert kinds(spark, [None]) == "text"
    assert kinds(spark, ['{"a": 1}', "[1]"]) == "jsonb"
    assert kinds(spark, ['{"a": 1}', "{broken"]) == "character varying(12)"
    assert kinds(spark, [1.5, 2.0], "double") == "numeric(2,1)"
    assert kinds(spark, [5], "int") == "smallint"
    assert kinds(spark, [None], "int") == "integer"
    assert kinds(spark, [datetime(2024, 1, 1)], "timestamp_ntz") == "date"
    assert kinds(spark, [datetime(2024, 1, 1, 3)], "timestamp_ntz") == "timestamp"
    assert kinds(spark, [True], "boolean") == "boolean"


def sheet_kind(spark, values):
    return inference.sheet_types(spark.createDataFrame([(v,) for v in values], "c string"))["c"]


def test_sheet_rules(spark):
    assert sheet_kind(spark, [None, " "]) == "TEXT"
    assert sheet_kind(spark, [" TRUE", "false", ""]) == "BOOLEAN"
    assert sheet_kind(spark, ["1", "2.0", " "]) == "BIGINT"
    assert sheet_kind(spark, ["1", "2.5"]) == "DOUBLE PRECISION"
    assert sheet_kind(spark, ["2024-01-01", "2024-01-02 10:00:00"]) == "TIMESTAMP"
    assert sheet_kind(spark, ["2024-01-01", "soon"]) == "TEXT"


def test_inference_is_one_job_per_table(spark):
    df = spark.createDataFrame([("1", "x", 2.0)], "a string, b string, c double")
    plan = inference.infer_types(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_keys(spark):
    orders = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "order_id int, code int")
    assert inference.discover_keys(orders, "orders") == {"primary": ["order_id"], "composite": None}
    lines = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "order_id int, line_no int")
    assert inference.discover_keys(lines, "order_lines") == {
        "primary": None, "composite": ["order_id", "line_no"]
    }
    nulls = spark.createDataFrame([(1,), (None,)], "id int")
    assert inference.discover_keys(nulls, "t")["primary"] is None


def test_apply_schema_fills(spark, rows):
    df = spark.createDataFrame([("x", "TRUE", "2.5", 1), ("7", "no", "nan", 0)], "a string, b string, c string, d int")
    declared = {
        "a": {"type": "int", "nullable": False}, "b": {"type": "bool", "nullable": False},
        "c": {"type": "float"}, "d": {"type": "bool"},
    }
    assert rows(schema.apply_schema(df, declared)) == [(0, False, 2.5, 1), (7, False, None, 0)]


def test_transform_accepts_functions(spark, rows):
    df = spark.createDataFrame([("2.5", "ab", 3)], "a string, b string, c int")
    got = schema.transform_columns(
        df, {"a": "x", "b": "y", "zz": "q"}, {"x": "int", "y": F.upper}, {"x": 0}, {"y": F.length}
    )
    assert got.columns == ["x", "y"] and rows(got) == [(2, 2)]


def test_text_forms():
    kind = T.StructType.fromDDL("a int not null, b string")
    assert schema.schema_from_text(schema.schema_text(kind)) == kind
    ddl = schema.create_table_ddl("t", kind, "/data/t")
    assert "`a` int NOT NULL" in ddl and "USING parquet" in ddl and "LOCATION '/data/t'" in ddl


def test_findings(spark):
    table = T.StructType.fromDDL("A bigint, b string, year int not null, need int not null")
    file = T.StructType.fromDDL("a int, B double, more string")
    found = {r.column_name: (r.finding, r.fails) for r in schema_findings(spark, file, table).collect()}
    assert found == {
        "b": ("type differs", True), "year": ("missing in file", False),
        "need": ("missing in file", True), "more": ("extra in file", False),
    }
    assert len(compatible(file, table)) == 2


def test_keys_are_screened_in_one_scan(spark, monkeypatch):
    """Only what may be a key is checked exactly."""
    from martloom.operators import inference

    df = spark.range(20000).selectExpr(
        "id div 2 AS order_id", "IF(id = 7, NULL, id) AS id", "id % 2 AS line_no", "IF(id = 3, 2, id) AS item_id"
    )
    candidates = [["order_id"], ["id"], ["order_id", "line_no"], ["item_id"]]
    # One repeat among 20,000 rows is below the sketch's error: it passes here and fails exactly.
    assert inference.may_be_keys(df, candidates) == [False, False, True, True]
    assert [inference.is_key(df, c) for c in candidates] == [False, False, True, False]
    assert inference.may_be_keys(df, []) == []
    checked = []
    exact = inference.is_key
    monkeypatch.setattr(inference, "is_key", lambda d, k: checked.append(tuple(k)) or exact(d, k))
    found = inference.discover_keys(df, "order_lines")
    assert found["composite"] == ["order_id", "line_no"] and ("order_id",) not in checked and ("id",) not in checked
    empty = inference.may_be_keys(df.limit(0), [["id"]])
    assert empty == [True] and inference.is_key(df.limit(0), ["id"])
