"""Counts, checks and key resolution over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewatch.operators import quality
from tidewatch.plans import chronic
from tidewatch.session import scratch_path
from tidewatch.sources import published
from tidewatch.workload.registry import query

_COUNTED = tuple(
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
)


@query(
    "table_row_counts",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in _COUNTED),
)
def _(t):
    return quality.row_counts(**{n: t.raw(n) for n in _COUNTED})


@query(
    "layered_build_status",
    "SELECT 'bronze_labs' AS job, 'ok' AS status, count(*) AS n_rows, CAST(NULL AS VARCHAR) AS error FROM lab "
    "UNION ALL SELECT 'silver_low_labs', 'ok', count(*), NULL FROM lab WHERE value < 60 "
    "UNION ALL SELECT 'gold_care_gap', 'ok', 1, NULL "
    "UNION ALL SELECT 'broken_job', 'failed', NULL, 'ValueError: unknown comparison ''!!'''",
    "lab",
)
def _(t):
    """Bronze, silver, gold as functions of one table; the fourth job fails and does not stop the rest."""
    from tidewatch.operators.temporal import persistent_breach
    from tidewatch.plans.jobs import build_all

    return build_all(
        t.spark,
        {
            "bronze_labs": lambda: t.lab,
            "silver_low_labs": lambda: t.lab.where(F.col("value") < 60),
            "gold_care_gap": lambda: chronic.care_gap_summary(t.lab, t.dx),
            "broken_job": lambda: persistent_breach(t.lab, "patient_id", "lab_date", "value", op="!!"),
        },
    )


@query(
    "distinct_coded_patients",
    "SELECT count(DISTINCT patient_id) AS n_patients, count(*) AS n_codes FROM dx WHERE icd10_code LIKE 'N18%'",
    "dx",
)
def _(t):
    per = t.dx.where(F.col("icd10_code").startswith("N18")).groupBy("patient_id").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("n_patients"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_codes"))


@query(
    "lab_quality_checks",
    "SELECT 'patient id present' AS rule, count(*) FILTER (patient_id IS NULL) AS failed, count(*) AS total FROM labs "
    "UNION ALL SELECT 'value present and positive', count(*) FILTER (value IS NULL OR value <= 0), count(*) FROM labs "
    "UNION ALL SELECT 'filtration between 5 and 120', count(*) FILTER (value IS NULL OR value < 5 OR value > 120), count(*) FROM labs "
    "UNION ALL SELECT 'test name known', count(*) FILTER (test_name NOT IN ('eGFR', 'creatinine', 'UACR')), count(*) FROM labs",
    "lab uacr crea labs",
)
def _(t):
    return chronic.lab_quality(t.labs)


@query(
    "unresolved_customers",
    "SELECT o_custkey, count(*) AS n_rows FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY 1",
)
def _(t):
    return quality.referential_gaps(t.raw("orders"), t.raw("customer"), "o_custkey", "c_custkey")


@query(
    "unresolved_labels",
    "SELECT d.doc_id, count(*) AS n_rows FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.doc_id IS NULL GROUP BY 1",
)
def _(t):
    return quality.referential_gaps(t.raw("documents").select("doc_id"), t.raw("labels"), "doc_id")


def _root(t, label):
    return scratch_path(t.spark, f"{label}-{uuid.uuid4().hex[:12]}")


@query(
    "published_with_checks",
    "SELECT count(*) AS n_rows, count(*) FILTER (o_totalprice <= 0 OR o_totalprice IS NULL) AS price_positive, "
    "count(*) FILTER (o_orderstatus NOT IN ('O', 'F', 'P') OR o_orderstatus IS NULL) AS status_known, count(DISTINCT o_custkey) AS n_customers, "
    "CAST(year(min(o_orderdate)) AS INTEGER) AS first_year FROM orders",
)
def _(t):
    """Orders published twice, the second time with another schema; counts and checks come from the write pass."""
    table = published.PublishedTable(t.spark, _root(t, "published"), "orders")
    table.publish(t.raw("orders"), "all orders")
    wider = t.raw("orders").withColumn("order_year", F.year("o_orderdate")).drop("o_comment", "o_clerk")
    rules = {"price_positive": F.col("o_totalprice") > 0, "status_known": F.col("o_orderstatus").isin("O", "F", "P")}
    stats = table.publish(wider, rules=rules).stats
    seen = [F.lit(stats["n_rows"]).cast("bigint").alias("n_rows"), *[F.lit(n).cast("bigint").alias(r) for r, n in stats["failed"].items()]]
    return table.read().agg(F.countDistinct("o_custkey").alias("n_customers"), F.min("order_year").alias("first_year")).select(*seen, "n_customers", "first_year")


def _order_layers():
    keep = ["o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice"]
    open_orders = lambda o: o.where("o_orderstatus <> 'F'").withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("bigint"))
    per_customer = lambda o: o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_open"), F.sum("cents").alias("open_cents"), F.max("o_orderdate").alias("last_open")
    )
    return [
        published.Layer("bronze_orders", lambda o: o.select(*keep)),
        published.Layer("silver_open_orders", open_orders),
        published.Layer("gold_open_by_customer", per_customer, "open orders of each customer"),
    ]


@query(
    "layers_kept_up_to_date",
    "SELECT o_custkey, count(*) AS n_open, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS open_cents, max(o_orderdate) AS last_open "
    "FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1",
)
def _(t):
    """Layers built from the orders known a year before the last one, then brought up to all orders: later orders come in,
    those that were still open then have changed their status. Equal to a full build over all orders."""
    root, orders = _root(t, "layers"), t.raw("orders")
    last = orders.agg(F.add_months(F.max("o_orderdate"), -12).alias("day")).first()["day"]
    then = orders.where(F.col("o_orderdate") < F.lit(last)).withColumn(
        "o_orderstatus", F.when(F.col("o_orderdate") >= F.date_sub(F.lit(last), 90), "O").otherwise(F.col("o_orderstatus"))
    )
    for known in (then, orders):
        published.refresh(t.spark, root, known, ["o_custkey"], _order_layers(), n_parts=16)
    return published.PublishedTable(t.spark, root, "gold_open_by_customer").read()


@query(
    "bucketed_order_lines",
    "SELECT o_orderpriority, count(*) AS n_lines, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1",
)
def _(t):
    """Two catalog tables bucketed by their join key; the join reads them without an exchange."""
    root, tag = _root(t, "catalog"), uuid.uuid4().hex[:8]
    published.create_namespace(t.spark, "tidewatch", "tables of the registered queries")
    orders, lines = f"tidewatch.orders_{tag}", f"tidewatch.lines_{tag}"
    published.save_table(t.raw("orders").select("o_orderkey", "o_orderpriority"), orders, "orders by key", ["o_orderkey"], path=f"{root}/orders")
    published.save_table(t.raw("lineitem").select("l_orderkey", "l_quantity"), lines, "order lines by order", ["l_orderkey"], path=f"{root}/lines")
    j = t.spark.table(orders).join(t.spark.table(lines), F.col("o_orderkey") == F.col("l_orderkey"))
    return j.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_quantity").cast("double")).alias("quantity"))
