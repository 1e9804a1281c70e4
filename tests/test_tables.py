import os

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import govern, quality
from tidewatch.plans.jobs import build_all
from tidewatch.sources import schemas, tables


def test_all_schemas_parse_and_mark_keys(spark):
    assert len(schemas.TABLE_NAMES) == 24
    for name in schemas.TABLE_NAMES:
        assert schemas.schema(name).fields
    assert schemas.required_keys("sched_preferences") == ["provider_id", "shift_type", "weekday"]
    assert schemas.schema("htm_work_orders")["wo_id"].metadata["comment"].startswith("may repeat")


def test_write_read_round_trip_with_partitions(spark, tmp_path, rows):
    df = tables.rows_to_frame(spark, [("W1", "A1", None, "PM", 1.5, 2.0, None)], schemas.schema("htm_work_orders"))
    tables.write(df, str(tmp_path / "htm_work_orders"), partition_by=["wo_type"])
    back = tables.read(spark, str(tmp_path), "htm_work_orders")
    assert rows(back, "wo_id", "wo_type", "cost") == [("W1", "PM", 1.5)]
    other = tables.TableRef(str(tmp_path), "htm", "work_orders")
    assert other.path.endswith("htm_work_orders")


def test_empty_rows_need_a_schema_only(spark):
    assert tables.rows_to_frame(spark, [], "a string, b int").count() == 0


def test_materialize_cuts_lineage(spark, tmp_path):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    back = tables.materialize(df, str(tmp_path / "m"))
    assert back.count() == 10 and "Range" not in back._jdf.queryExecution().optimizedPlan().toString()


def test_views_are_listed(spark, tmp_path):
    tables.write(tables.rows_to_frame(spark, [], schemas.schema("diversion_staff")), str(tmp_path / "diversion_staff"))
    assert tables.register_views(spark, str(tmp_path), ["diversion_staff"]) == ["diversion_staff"]
    assert spark.sql("SELECT count(*) FROM diversion_staff").first()[0] == 0


def test_conform_and_comments(spark):
    df = schemas.conform(spark.createDataFrame([("S1", "3")], "staff_id string, risk_score string"), "diversion_iris_scores")
    assert df.schema["risk_score"].dataType.simpleString() == "double" and df.first()["risk_score"] == 3.0
    noted = schemas.describe(df, {"risk_score": "0 to 100"})
    assert noted.schema["risk_score"].metadata["comment"] == "0 to 100"


def test_audit_rows_are_only_added(spark, tmp_path):
    path = str(tmp_path / "audit")
    for _ in range(2):
        tables.append_audit(spark.range(1), path)
    assert spark.read.parquet(path).count() == 2


def test_one_failed_build_does_not_stop_the_rest(spark, tmp_path, rows):
    def boom():
        raise RuntimeError("no table")

    out = build_all(spark, {"a": lambda: spark.range(3), "b": boom, "c": lambda: spark.range(0)}, str(tmp_path))
    assert rows(out) == [("a", "ok", 3, None), ("b", "failed", None, "RuntimeError: no table"), ("c", "ok", 0, None)]
    assert os.path.isdir(tmp_path / "c")


def test_quality_counts_null_as_failed(spark, rows):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "v double")
    assert rows(quality.check(df, {"positive": F.col("v") > 0})) == [("positive", 2, 3)]


def test_unresolved_keys(spark, rows):
    child = spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "k string")
    parent = spark.createDataFrame([("a",)], "k string")
    assert rows(quality.referential_gaps(child, parent, "k")) == [("z", 2)]


def test_masking_and_scope(spark, rows):
    df = spark.createDataFrame([("d1", "x", 1.0), ("d2", "y", 2.0)], "dept string, name string, v double")
    held = spark.createDataFrame([("u", "d1"), ("u", "d1"), ("w", "d2")], "user string, dept string")
    seen = govern.row_filter(df, held, ["dept"], "u")
    out = govern.mask_columns(seen, {"name": "text:withheld", "v": "null"})
    assert rows(out) == [("d1", "withheld", None)]
    with pytest.raises(ValueError):
        govern.mask_columns(df, {"name": "blur"})
