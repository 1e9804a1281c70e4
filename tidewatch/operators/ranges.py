"""Date ranges: day expansion, regular period calendars, overlaps. All narrow: no range join anywhere."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def explode_ranges(
    df: DataFrame, start: str, end: str, out: str = "day", open_end: Column | str | None = None
) -> DataFrame:
    """One row per calendar day, both ends inclusive. An open end runs to ``open_end`` (else to the start)."""
    s = F.col(start).cast("date")
    fallback = s if open_end is None else (F.col(open_end) if isinstance(open_end, str) else open_end)
    e = F.coalesce(F.col(end).cast("date"), fallback)
    valid = df.where(s.isNotNull() & (e >= s))
    return valid.withColumn(out, F.explode(F.sequence(s, e)))


@dataclass(frozen=True)
class PeriodCalendar:
    """``n`` periods of ``days`` days from ``anchor``; period numbers are arithmetic, so no lookup join."""

    anchor: str
    n: int
    days: int = 14

    @property
    def _anchor(self) -> Column:
        return F.lit(self.anchor).cast("date")

    def index(self, day: Column) -> Column:
        return F.floor(F.datediff(day, self._anchor) / F.lit(self.days)).cast("int")

    def start(self, seq: Column) -> Column:
        return F.date_add(self._anchor, (seq * F.lit(self.days)).cast("int"))

    def end(self, seq: Column) -> Column:
        return F.date_add(self._anchor, ((seq + 1) * F.lit(self.days) - 1).cast("int"))

    def label(self, seq: Column) -> Column:
        """``YYYY-PPnn``: the year the period starts in, and its number among those starting that year."""
        start = self.start(seq)
        jan1 = F.make_date(F.year(start), F.lit(1), F.lit(1))
        first = F.ceil(F.datediff(jan1, self._anchor) / F.lit(self.days)).cast("int")
        return F.concat(
            F.year(start).cast("string"), F.lit("-PP"), F.lpad((seq - first + 1).cast("string"), 2, "0")
        )

    def number(self, label: Column) -> Column:
        """The period number of a ``YYYY-PPnn`` label, the reverse of ``label``; NULL for any other text."""
        year = F.regexp_extract(label, r"^(\d{4})-PP(\d{2})$", 1)
        nth = F.regexp_extract(label, r"^(\d{4})-PP(\d{2})$", 2)
        known = year != ""
        jan1 = F.make_date(F.when(known, year).cast("int"), F.lit(1), F.lit(1))
        first = F.ceil(F.datediff(jan1, self._anchor) / F.lit(self.days)).cast("int")
        return F.when(known, first + F.when(known, nth).cast("int") - 1)

    def frame(self, spark: SparkSession) -> DataFrame:
        seq = F.col("id").cast("int")
        return spark.range(self.n).select(
            seq.alias("seq"),
            self.label(seq).alias("pay_period"),
            self.start(seq).alias("start_date"),
            self.end(seq).alias("end_date"),
        )


def period_calendar(spark: SparkSession, anchor: str, n: int, days: int = 14) -> DataFrame:
    return PeriodCalendar(anchor, n, days).frame(spark)


def overlap_join(
    events: DataFrame, calendar: PeriodCalendar, start: str, end: str, open_end: Column | str | None = None
) -> DataFrame:
    """Each event once per period it touches, with the days of overlap. A pure row expansion."""
    s = F.col(start).cast("date")
    last_day = calendar.end(F.lit(calendar.n - 1))
    fallback = last_day if open_end is None else (F.col(open_end) if isinstance(open_end, str) else open_end)
    e = F.coalesce(F.col(end).cast("date"), fallback)
    first = F.greatest(calendar.index(s), F.lit(0))
    last = F.least(calendar.index(e), F.lit(calendar.n - 1))
    spread = events.where((e >= s) & (first <= last)).withColumn("seq", F.explode(F.sequence(first, last)))
    seq = F.col("seq")
    days = F.datediff(F.least(e, calendar.end(seq)), F.greatest(s, calendar.start(seq))) + 1
    return (
        spread.withColumn("period_start", calendar.start(seq))
        .withColumn("period_end", calendar.end(seq))
        .withColumn("overlap_days", days)
    )


def drop_covered_days(
    df: DataFrame, keys: list[str], day: str, windows: DataFrame, start: str, end: str, open_end: Column | None = None
) -> DataFrame:
    """Remove (key, day) rows that fall inside a window of the same key."""
    covered = explode_ranges(windows, start, end, "_covered", open_end).select(*keys, "_covered").distinct()
    covered = covered.withColumnRenamed("_covered", day)
    return df.join(covered, [*keys, day], "left_anti")
