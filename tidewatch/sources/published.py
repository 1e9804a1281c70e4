"""Published tables: new folders first, then one small pointer file moved into place.

A version is the pointer: its schema with comments, and for each part of the table the folder that holds it. Data folders
are never changed after they are written, so a reader that has opened a version reads all of it, whatever is
published meanwhile; a writer that fails leaves the former version. The schema may change from version to version.

``refresh`` rewrites only parts (hash of the entity) whose rows differ; untouched parts keep their folders.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTER, WHOLE = "_current.json", "all"


# ---------------------------------------------------------------- files in any store that Spark knows


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _read_text(spark: SparkSession, path: str) -> str | None:
    at, fs = _hadoop(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write aside, then rename over the old file: readers see the old text or the new one."""
    aside, fs = _hadoop(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm = spark._jvm
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(aside, _hadoop(spark, path)[0], options)


# ---------------------------------------------------------------- counts and checks in the write pass


def observed(df: DataFrame, rules: Mapping[str, Column] | None = None) -> tuple[DataFrame, Callable[[], dict]]:
    """The frame with its row count and failed rules observed; call the second value after one full pass over the first.

    It gives ``{"n_rows": n, "failed": {rule: n}}``. A rule holds where its condition is true; NULL counts as failed.
    """
    names = list(rules or {})
    seen = Observation(f"pass-{uuid.uuid4().hex[:8]}")
    bad = [F.count_if(~F.coalesce(rules[n], F.lit(False))).alias(f"rule_{i}") for i, n in enumerate(names)]
    watched = df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *bad)

    def result() -> dict:
        got = seen.get
        return {"n_rows": got["n_rows"], "failed": {n: got[f"rule_{i}"] for i, n in enumerate(names)}}

    return watched, result


# ---------------------------------------------------------------- the table


@dataclass(frozen=True)
class Version:
    number: int
    schema: T.StructType
    parts: dict[str, str]
    comment: str = ""
    stats: dict = field(default_factory=dict)


class PublishedTable:
    """A table below ``<root>/<name>``. Any number of readers; one writer at a time."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.base = spark, os.path.join(root, name)

    def current(self) -> Version | None:
        text = _read_text(self.spark, os.path.join(self.base, POINTER))
        if text is None:
            return None
        held = json.loads(text)
        return Version(held["number"], T.StructType.fromJson(held["schema"]), held["parts"], held["comment"], held["stats"])

    def _point(self, version: Version) -> Version:
        _replace_text(
            self.spark,
            os.path.join(self.base, POINTER),
            json.dumps(
                {
                    "number": version.number, "schema": version.schema.jsonValue(), "parts": version.parts,
                    "comment": version.comment, "stats": version.stats,
                }
            ),
        )
        return version

    def publish(
        self, df: DataFrame, comment: str | None = None, rules: Mapping[str, Column] | None = None, hold_back: bool = False
    ) -> Version:
        """Replace the whole table; columns may come, go and change type. Rows are counted and checked while they are written.

        With ``hold_back`` a table that breaks a rule is written but not pointed at: readers keep the former version.
        """
        before = self.current()
        folder = f"data-{uuid.uuid4().hex[:12]}"
        watched, result = observed(df, rules)
        watched.write.parquet(os.path.join(self.base, folder))
        stats = result()
        if hold_back and any(stats["failed"].values()):
            raise ValueError(f"not published, rows that break a rule: {stats['failed']}")
        note = comment if comment is not None else before.comment if before else ""
        return self._point(Version(before.number + 1 if before else 1, _loose(df.schema), {WHOLE: folder}, note, stats))

    def read(self, version: Version | None = None, parts: Sequence[str] | None = None) -> DataFrame:
        """The rows of a version (the current one), or of some of its parts."""
        version = version or self.current()
        if version is None:
            raise FileNotFoundError(f"nothing is published at {self.base}")
        folders = [version.parts[p] for p in (version.parts if parts is None else parts) if p in version.parts]
        if not folders:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*[os.path.join(self.base, f) for f in folders])

    def drop_old(self) -> int:
        """Delete data that the current version does not hold; only when no reader has an older one open."""
        at, fs = _hadoop(self.spark, self.base)
        held = {f.split("/")[0] for f in (self.current() or Version(0, T.StructType(), {})).parts.values()}
        old = [s.getPath() for s in fs.listStatus(at) if s.isDirectory() and s.getPath().getName() not in held]
        for path in old:
            fs.delete(path, True)
        return len(old)

    # ------------------------------------------------------------ parts

    def replace_parts(
        self, df: DataFrame, entity: Sequence[str], touched: Sequence[str], n_parts: int, stats: dict, comment: str = "", anew: bool = False
    ) -> Version:
        """Write the touched parts of ``df`` (which holds all their rows) anew; all others stay, unless the table is made
        ``anew``. An empty part goes."""
        before = self.current()
        parts = dict(before.parts) if before and not anew else {}
        for p in touched:
            parts.pop(p, None)
        if touched:
            folder = f"data-{uuid.uuid4().hex[:12]}"
            rows = df.withColumn("_part", part_of(entity, n_parts)).where(F.col("_part").isin([int(p) for p in touched]))
            rows.hint("rebalance", "_part").write.partitionBy("_part").parquet(os.path.join(self.base, folder))
            at, fs = _hadoop(self.spark, os.path.join(self.base, folder))
            written = [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()]
            parts |= {name.removeprefix("_part="): f"{folder}/{name}" for name in written if name.startswith("_part=")}
        return self._point(Version(before.number + 1 if before else 1, _loose(df.schema), parts, comment, stats))


def _loose(schema: T.StructType) -> T.StructType:
    """Files do not promise that a column is never null; comments stay."""
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


def schema_change(before: T.StructType, after: T.StructType) -> dict[str, list[str]]:
    """Names of columns that came, went or changed type."""
    old, new = {f.name: f.dataType for f in before.fields}, {f.name: f.dataType for f in after.fields}
    return {
        "added": [n for n in new if n not in old],
        "dropped": [n for n in old if n not in new],
        "retyped": [n for n in new if n in old and new[n] != old[n]],
    }


# ---------------------------------------------------------------- incremental layers


def part_of(entity: Sequence[str], n_parts: int) -> Column:
    return F.pmod(F.xxhash64(*entity), F.lit(n_parts)).cast("int")


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(c) for c in sorted(df.columns)])


def fingerprints(df: DataFrame, entity: Sequence[str], n_parts: int) -> dict[str, list[str]]:
    """Per part: rows, sum and exclusive-or of the row hashes. At most ``n_parts`` rows come to the driver."""
    rows = df.select(part_of(entity, n_parts).alias("_part"), _row_hash(df).alias("_h"))
    per = rows.groupBy("_part").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_h").cast("decimal(38,0)")).alias("total"), F.bit_xor("_h").alias("mixed")
    )
    return {str(r["_part"]): [str(r["n"]), str(r["total"]), str(r["mixed"])] for r in per.collect()}


@dataclass(frozen=True)
class Layer:
    """A table made from the one before it, entity by entity: ``make`` must not look across entities."""

    name: str
    make: Callable[[DataFrame], DataFrame]
    comment: str = ""


def refresh(
    spark: SparkSession, root: str, source: DataFrame, entity: Sequence[str], layers: Sequence[Layer], n_parts: int = 64
) -> list[str]:
    """Bring all layers up to date with ``source``; returns the parts that were rewritten.

    The first layer is compared with the source by part; a later layer is made again from the touched parts alone and
    keeps the entity columns. Layers are published one after another, each as a whole: a run that stops in between is
    made good by the next one, since a layer records which version of the first layer it was made from.
    """
    first, *rest = layers
    table = PublishedTable(spark, root, first.name)
    made = first.make(source)
    before = table.current()
    marks = fingerprints(made, entity, n_parts)
    schema = _loose(made.schema)
    same_shape = before is not None and before.schema == schema and before.stats.get("n_parts") == n_parts
    known = before.stats["marks"] if same_shape else {}
    touched = sorted((p for p in set(marks) | set(known) if marks.get(p) != known.get(p)), key=int)
    if not same_shape and before is not None:
        touched = [str(p) for p in range(n_parts)]
    if touched or before is None:
        # Which parts each later layer still owes: they are added up until it is published.
        number = before.number + 1 if before else 1
        now = table.replace_parts(made, entity, touched, n_parts, {"marks": marks, "n_parts": n_parts, "changed_in": _log(before, touched, number)}, first.comment, not same_shape)
    else:
        now = before
    rewritten = set(touched)
    upstream = table
    for layer in rest:
        own = PublishedTable(spark, root, layer.name)
        held = own.current()
        out = layer.make(upstream.read(parts=[]))
        shape = held is not None and held.schema == _loose(out.schema) and held.stats.get("n_parts") == n_parts
        since = held.stats["base"] if shape else 0
        owed = sorted((p for p, number in now.stats["changed_in"].items() if number > since), key=int)
        if not shape:
            owed = [str(p) for p in range(n_parts)]
        if owed or held is None:
            made = layer.make(upstream.read(parts=owed))
            own.replace_parts(made, entity, owed, n_parts, {"base": now.number, "n_parts": n_parts}, layer.comment, not shape)
        rewritten |= set(owed)
        upstream = own
    return sorted(rewritten, key=int)


def _log(before: Version | None, touched: Sequence[str], number: int) -> dict[str, int]:
    """Per part, the version that last changed it."""
    return {**(before.stats.get("changed_in", {}) if before else {}), **dict.fromkeys(touched, number)}


def row_changes(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, change): rows inserted, updated or deleted. Only keys and row hashes are shuffled; a null key equals a null key."""
    side = lambda df, n: df.select(*[F.col(k).alias(f"{n}_{k}") for k in key], _row_hash(df).alias(f"{n}_h"))
    a, b = side(before, "a"), side(after, "b")
    same = F.lit(True)
    for k in key:
        same = same & F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}"))
    j = a.join(b, same, "full")
    change = F.when(F.col("a_h").isNull(), "inserted").when(F.col("b_h").isNull(), "deleted").when(F.col("a_h") != F.col("b_h"), "updated")
    return j.select(*[F.coalesce(f"b_{k}", f"a_{k}").alias(k) for k in key], change.alias("change")).where("change IS NOT NULL")


# ---------------------------------------------------------------- catalog tables


def create_namespace(spark: SparkSession, name: str, comment: str = "") -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name} COMMENT '{_quoted(comment)}'")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def save_table(
    df: DataFrame, name: str, comment: str = "", bucket_by: Sequence[str] = (), buckets: int = 16, path: str | None = None
) -> None:
    """A catalog table (``namespace.name``) with its comment and the columns' comments; bucketed and sorted by the keys that
    repeated joins use, so that those read it without an exchange. An existing table of that name is replaced, schema and all."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if bucket_by:
        # One task writes one bucket, so a bucket is one file and its order holds.
        df = df.repartition(buckets, *bucket_by)
    writer = df.write.format("parquet").mode("overwrite")
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS '{_quoted(comment)}'")


def table_comment(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Comment'").collect()
    return rows[0]["data_type"] if rows else ""
