"""Run a list of table builds; one failure does not stop the others."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tidewatch.sources.published import observed
from tidewatch.sources.tables import rows_to_frame, write

STATUS_SCHEMA = "job string, status string, n_rows bigint, error string"


def build_all(
    spark: SparkSession, jobs: Mapping[str, Callable[[], DataFrame]], root: str | None = None, at_once: int = 4
) -> DataFrame:
    """Build each job, written to ``<root>/<job>`` if a root is given, and report (job, status, rows, error).

    Up to ``at_once`` builds run side by side; the report keeps the order of ``jobs``. Rows are counted while they are
    written, in one scan. Only the row count and the error text of a job reach the driver.
    """

    def build(name: str, make: Callable[[], DataFrame]) -> tuple:
        try:
            watched, result = observed(make())
            if root is not None:
                write(watched, f"{root.rstrip('/')}/{name}")
            else:
                watched.write.format("noop").mode("overwrite").save()
            return name, "ok", int(result()["n_rows"]), None
        except Exception as failure:  # noqa: BLE001 - the point is to go on
            return name, "failed", None, f"{type(failure).__name__}: {failure}"

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(build), name, make) for name, make in jobs.items()]
        return rows_to_frame(spark, [w.result() for w in waiting], STATUS_SCHEMA)
