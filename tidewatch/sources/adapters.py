"""The declared source tables in the shape the packs work on: joined names, period numbers, one name for the day, a site.

Every function leaves a column alone that is there already, so a table in either shape can be given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.ranges import PeriodCalendar


def _add(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, value)


def roster(hr: DataFrame) -> DataFrame:
    """Roster with ``worker_name`` from first and last name."""
    if "worker_name" in hr.columns:
        return hr
    return hr.withColumn("worker_name", F.concat_ws(" ", "first_name", "last_name"))


def demand(metrics: DataFrame, calendar: PeriodCalendar) -> DataFrame:
    """Demand with ``seq``, the number of its pay period."""
    return metrics if "seq" in metrics.columns else metrics.withColumn("seq", calendar.number(F.col("pay_period")))


def on_sites(df: DataFrame, site: int = 0) -> DataFrame:
    """Providers, coverage or assignments with ``work_date`` and ``site`` (all of one site where the source has none)."""
    if "work_date" not in df.columns and "date" in df.columns:
        df = df.withColumnRenamed("date", "work_date")
    return _add(df, "site", F.lit(site).cast("bigint"))
