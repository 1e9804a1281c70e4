"""Published tables, incremental layers and catalog tables."""

import pytest
from pyspark.sql import functions as F

from tidewatch.sources import published
from tidewatch.sources.published import Layer, PublishedTable


def orders(spark, rows):
    return spark.createDataFrame(rows, "cust bigint, id bigint, status string, price double")


def test_a_reader_keeps_the_version_it_opened(spark, tmp_path, rows):
    table = PublishedTable(spark, str(tmp_path), "t")
    assert table.current() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    table.publish(spark.range(3), "three")
    early = table.read()
    second = table.publish(spark.range(5).select(F.col("id").cast("string"), F.lit(1.5).alias("x")))
    assert early.count() == 3 and early.columns == ["id"]
    assert rows(table.read(), "id", "x")[0] == ("0", 1.5) and second.number == 2 and second.comment == "three"
    assert table.drop_old() == 1 and table.read().count() == 5


def test_schema_changes_are_named(spark):
    before = spark.createDataFrame([], "a int, b string, c date").schema
    after = spark.createDataFrame([], "a bigint, c date, d int").schema
    assert published.schema_change(before, after) == {"added": ["d"], "dropped": ["b"], "retyped": ["a"]}


def test_a_failed_write_leaves_the_former_version(spark, tmp_path, rows):
    table = PublishedTable(spark, str(tmp_path), "t")
    table.publish(spark.range(2))
    with pytest.raises(Exception):
        table.publish(spark.range(9).select(F.raise_error(F.lit("broken")).cast("bigint").alias("id")))
    assert table.read().count() == 2 and table.current().number == 1
    with pytest.raises(ValueError, match="not published"):
        table.publish(spark.range(9), rules={"small": F.col("id") < 5}, hold_back=True)
    assert table.read().count() == 2


def test_counts_and_checks_take_one_pass(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(100).mapInArrow(run, "id bigint")
    stats = PublishedTable(spark, str(tmp_path), "t").publish(df, rules={"even": F.col("id") % 2 == 0, "null": F.lit(None).cast("boolean")}).stats
    assert stats == {"n_rows": 100, "failed": {"even": 50, "null": 100}} and seen.value == 100


def test_comments_stay(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path), "t")
    table.publish(spark.range(1).withMetadata("id", {"comment": "the key"}), "numbers")
    assert table.current().comment == "numbers" and table.read().schema["id"].metadata["comment"] == "the key"


LAYERS = [
    Layer("bronze", lambda df: df),
    Layer("silver", lambda df: df.where("status <> 'F'").withColumn("cents", (F.col("price") * 100).cast("bigint"))),
    Layer("gold", lambda df: df.groupBy("cust").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))),
]


def full(df):
    for layer in LAYERS:
        df = layer.make(df)
    return df


def test_refresh_equals_a_full_build_and_touches_few_parts(spark, tmp_path, rows):
    root = str(tmp_path)
    base = [(c if c else None, 10 * c + k, "OFP"[(c + k) % 3], float(c * k)) for c in range(60) for k in range(4)]
    gold = PublishedTable(spark, root, "gold")
    refresh = lambda data: published.refresh(spark, root, orders(spark, data), ["cust"], LAYERS, n_parts=16)
    assert len(refresh(base)) == 16 and rows(gold.read()) == rows(full(orders(spark, base)))
    folders = PublishedTable(spark, root, "bronze").current().parts
    assert refresh(list(reversed(base))) == []  # the same rows in another order
    steps = [
        base + [(7, 9001, "O", 5.0)],                                   # inserted
        [(c, i, "F" if i == 73 else s, p) for c, i, s, p in base],       # updated
        [r for r in base if r[0] != 12],                                 # an entity deleted
        base + [base[5], base[5]],                                       # repeated rows
        [],                                                              # everything deleted
        base,
    ]
    for n, data in enumerate(steps):
        touched = refresh(data)
        assert rows(gold.read()) == rows(full(orders(spark, data))), n
        if n < 4:
            assert 1 <= len(touched) <= 3
        if n == 0:
            now = PublishedTable(spark, root, "bronze").current().parts
            assert sum(now[p] != folders[p] for p in folders) == len(touched) == 1


def test_a_run_that_stopped_between_layers_is_made_good(spark, tmp_path, rows):
    root = str(tmp_path)
    base = [(c, c, "O", 1.0) for c in range(40)]
    published.refresh(spark, root, orders(spark, base), ["cust"], LAYERS, n_parts=8)
    more = base + [(3, 99, "O", 2.0)]
    published.refresh(spark, root, orders(spark, more), ["cust"], LAYERS[:1], n_parts=8)  # only bronze got done
    published.refresh(spark, root, orders(spark, more + [(4, 98, "O", 2.0)]), ["cust"], LAYERS[:1], n_parts=8)
    published.refresh(spark, root, orders(spark, more + [(4, 98, "O", 2.0)]), ["cust"], LAYERS, n_parts=8)
    gold = PublishedTable(spark, root, "gold").read()
    assert rows(gold) == rows(full(orders(spark, more + [(4, 98, "O", 2.0)])))


def test_another_schema_rewrites_all_parts(spark, tmp_path, rows):
    root = str(tmp_path)
    data = [(c, c, "O", 1.0) for c in range(40)]
    published.refresh(spark, root, orders(spark, data), ["cust"], LAYERS, n_parts=8)
    wider = orders(spark, data).withColumn("note", F.lit("x"))
    assert len(published.refresh(spark, root, wider, ["cust"], LAYERS, n_parts=8)) == 8
    assert "note" in PublishedTable(spark, root, "silver").read().columns
    assert rows(PublishedTable(spark, root, "gold").read()) == rows(full(orders(spark, data)))


def test_row_changes(spark, rows):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "z"), (4, "w"), (None, "n")], "k int, v string")
    assert rows(published.row_changes(a, b, ["k"])) == [(2, "updated"), (3, "deleted"), (4, "inserted")]


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path, rows):
    published.create_namespace(spark, "tidewatch_test", "it's a test")
    for name in ("l", "r"):
        df = spark.range(2000).select((F.col("id") % 500).alias("k"), F.col("id").alias(name)).withMetadata("k", {"comment": "join key"})
        published.save_table(df, f"tidewatch_test.{name}", f"side '{name}'", ["k"], 8, str(tmp_path / name))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("tidewatch_test.l").join(spark.table("tidewatch_test.r"), "k").groupBy("k").count()
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and j.agg(F.sum("count")).first()[0] == 8000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert published.table_comment(spark, "tidewatch_test.l") == "side 'l'"
    assert spark.sql("DESCRIBE TABLE tidewatch_test.l").where("col_name = 'k'").first()["comment"] == "join key"
    published.save_table(spark.range(3), "tidewatch_test.l", path=str(tmp_path / "l2"))  # replaced, schema and all
    assert spark.table("tidewatch_test.l").columns == ["id"] and published.table_comment(spark, "tidewatch_test.l") == ""
    assert {"l", "r"} <= {r["tableName"] for r in spark.sql("SHOW TABLES IN tidewatch_test").collect()}
