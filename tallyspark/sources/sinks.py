"""Writers and keyed load modes."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark import schemas
from tallyspark.session import BROADCAST_ROWS, materialized


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order.

    ``min_by`` keeps one candidate per key and map task, so a hot key never
    travels to, or is sorted in, a single task.
    """
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return picked.select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def last_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the last in the given order."""
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return picked.select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def upserted(
    target: DataFrame, updates: DataFrame, key: str, order: Sequence[Column]
) -> DataFrame:
    """Target after an upsert: the last update of a key replaces the whole row."""
    latest = last_per_key(updates, [key], order).select(*target.columns)
    return target.join(latest, key, "left_anti").unionByName(latest)


def inserted(
    target: DataFrame, rows: DataFrame, key: str, order: Sequence[Column]
) -> DataFrame:
    """The rows an insert-ignore adds: first per key, keys of the target left out."""
    fresh = rows.filter(F.col(key).isNotNull()).join(target.select(key), key, "left_anti")
    return first_per_key(fresh, [key], order)


def write_table(df: DataFrame, path: str, partitions: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Replace a table at ``path``."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = (
            writer.option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.save(path)


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    write_table(df, path, fmt=fmt)


def replace_snapshot(df: DataFrame, path: str, expected: DataFrame) -> DataFrame:
    """Replace a snapshot table, then compare its row count with the fact table."""
    table = SnapshotTable(df.sparkSession, path, df.schema)
    table.replace(df)
    return count_status(table.read(), expected)


def count_status(target: DataFrame, source: DataFrame) -> DataFrame:
    """One row: both counts, their difference and PASS or REVIEW."""
    sides = source.agg(F.count(F.lit(1)).alias("s")).select("s", F.lit(0).alias("t")).unionByName(
        target.agg(F.count(F.lit(1)).alias("t")).select(F.lit(0).alias("s"), "t")
    )
    return sides.agg(F.sum("s").alias("source_count"), F.sum("t").alias("target_count")).select(
        "source_count",
        "target_count",
        (F.col("source_count") - F.col("target_count")).alias("difference"),
        F.when(F.col("source_count") == F.col("target_count"), "PASS")
        .otherwise("REVIEW")
        .alias("status"),
    )


def log_row(
    name: str, status: Column, checked: Column, failed: Column, details: str, at: Column
) -> list[Column]:
    """Columns of one audit row, for use on a one-row summary."""
    return [
        F.lit(name).alias("check_name"),
        status.alias("check_status"),
        checked.cast("long").alias("records_checked"),
        failed.cast("long").alias("records_failed"),
        at.cast("timestamp_ntz").alias("check_timestamp"),
        F.lit(details).alias("details"),
    ]


def append_log(rows: DataFrame, path: str, only_if_present: bool = False) -> bool:
    """Append audit rows; the batch job skips a log that was never created."""
    if only_if_present and not path_exists(rows.sparkSession, path):
        return False
    rows.write.mode("append").parquet(path)
    return True


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DQ_LOG_DDL).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.exists(jvm_path)


def folder_of(version: int) -> str:
    """A fresh folder name; two writers that count alike still write apart."""
    return f"{version:010d}-{uuid.uuid4().hex[:12]}"


class SnapshotTable:
    """A table that is replaced as a whole: each version is written apart, then one small pointer is added.

    Readers follow the newest pointer, so they see the old rows until all new ones are there, and a
    write that fails leaves the old version in force.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema

    def current(self) -> tuple[int, str] | None:
        """Version in force and its folder."""
        if not path_exists(self.spark, f"{self.path}/pointer"):
            return None
        newest = self.spark.read.schema("version long, folder string").parquet(f"{self.path}/pointer")
        row = newest.agg(F.max(F.struct("version", "folder")).alias("at")).first().at
        return (row.version, row.folder) if row else None

    def read(self) -> DataFrame:
        at = self.current()
        if at is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/data/{at[1]}")

    def replace(self, df: DataFrame) -> None:
        at = self.current()
        version = at[0] + 1 if at else 1
        folder = folder_of(version)
        df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).write.parquet(f"{self.path}/data/{folder}")
        pointer = self.spark.createDataFrame([(version, folder)], "version long, folder string").coalesce(1)
        pointer.write.mode("append").parquet(f"{self.path}/pointer")


@dataclass(frozen=True)
class Part:
    """What one load put into one bucket: ``kind`` is base, insert or upsert; ``low`` and ``high`` are its least and greatest key."""

    bucket: int
    version: int
    folder: str
    kind: str
    rows: int
    low: object
    high: object


class KeyedTable:
    """A Parquet table by key that merges when it is read.

    A load writes its own changed rows only, one folder for the load and in it one for each bucket of
    keys, sorted by key; then one small manifest entry makes all of it appear at once.  So a load costs
    what it brings, not what the table holds, and one that dies half-way leaves the table as it was.
    Readers take a bucket's newest compacted rows (*base*) and the loads since; rows of inserts are of new keys, so only keys
    that an upsert brought are looked for among older rows.  ``compact`` writes the live rows of grown buckets
    as new bases, a heavy bucket as several files.

    A load that must know which of its keys are there reads the key column only, of the parts
    whose least and greatest key let them hold one of its keys; rows of fresh, growing keys read nothing.

    ``loaded_at`` names a column that holds the time of the load that wrote the row.  One load at a time may write.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, ddl: str, buckets: int = 256, loaded_at: str | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.schema = T.StructType.fromDDL(ddl)
        self.buckets = buckets
        self.loaded_at = loaded_at
        kind = self.schema[key].dataType.simpleString()
        self.manifest_ddl = f"bucket int, version long, folder string, kind string, rows long, low {kind}, high {kind}"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias("_bucket")

    def parts(self) -> list[Part]:
        """The parts in force: a bucket's newest base and what came after it.

        At most one for each bucket and load since the bucket was compacted.
        """
        if not path_exists(self.spark, f"{self.path}/manifest"):
            return []
        rows = self.spark.read.schema(self.manifest_ddl).parquet(f"{self.path}/manifest")
        base = rows.filter("kind = 'base'").groupBy("bucket").agg(F.max("version").alias("since"))
        live = rows.join(base, "bucket", "left").filter("since is null or version > since or (version = since and kind = 'base')")
        names = [name for name in Part.__dataclass_fields__]
        return sorted((Part(*[r[n] for n in names]) for r in live.select(*names).collect()), key=lambda p: (p.version, p.bucket))

    def versions(self) -> dict[int, int]:
        """Bucket -> version in force."""
        return {p.bucket: p.version for p in self.parts()}

    def _rows(self, parts: Sequence[Part]) -> DataFrame:
        """Stored rows of some parts, with the ``_version`` that wrote them."""
        schema = T.StructType([*self.schema.fields, T.StructField("_version", T.LongType())])
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{p.folder}/_bucket={p.bucket}" for p in parts])

    def _live(self, parts: Sequence[Part]) -> DataFrame:
        changed = [p for p in parts if p.kind == "upsert"]
        rest = self._rows([p for p in parts if p.kind != "upsert"])
        if not changed:
            return rest
        latest = last_per_key(self._rows(changed), [self.key], [F.col("_version")])
        # An insert never brings a key that was there, so no row of the rest is newer than a changed one of its key.
        # Untouched buckets hold no changed key: they need no comparison.
        touched = {p.bucket for p in changed}
        apart = self._rows([p for p in parts if p.kind != "upsert" and p.bucket not in touched])
        mixed = self._rows([p for p in parts if p.kind != "upsert" and p.bucket in touched])
        keys = latest.select(self.key)
        keys = F.broadcast(keys) if sum(p.rows for p in changed) <= BROADCAST_ROWS else keys
        return apart.unionByName(mixed.join(keys, self.key, "left_anti").select(*rest.columns)).unionByName(latest.select(*rest.columns))

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The live rows, of all or some buckets."""
        return self._live([p for p in self.parts() if buckets is None or p.bucket in buckets]).drop("_version")

    def known(self, staged: DataFrame) -> tuple[DataFrame, int]:
        """Those keys of ``staged`` (a written table with ``_bucket``) that the table holds, and the number of stored rows looked at."""
        reach = {r["_bucket"]: r for r in _reach(staged, self.key).collect()}
        near = [p for p in self.parts() if p.bucket in reach and p.low <= reach[p.bucket]["high"] and p.high >= reach[p.bucket]["low"]]
        if not near:
            return staged.limit(0).select(self.key), 0
        low, high = min(r["low"] for r in reach.values()), max(r["high"] for r in reach.values())
        stored = self._rows(near).select(self.key).filter(F.col(self.key).between(F.lit(low), F.lit(high)))
        keys = staged.select(self.key)
        keys = F.broadcast(keys) if sum(r["rows"] for r in reach.values()) <= BROADCAST_ROWS else keys
        return stored.join(keys, self.key, "left_semi").distinct(), sum(p.rows for p in near)

    def upsert(self, updates: DataFrame, order: Sequence[Column]) -> None:
        """The last update of a key becomes its row."""
        latest = last_per_key(updates.filter(F.col(self.key).isNotNull()), [self.key], order)
        self._add(self._stamped(latest), "upsert")

    def insert_ignore(self, rows: DataFrame, order: Sequence[Column]) -> None:
        """The first row of each key that the table lacks enters."""
        first = first_per_key(rows.filter(F.col(self.key).isNotNull()), [self.key], order)
        staged = materialized(self._stamped(first).withColumn("_bucket", self.bucket()), "staged")
        known, looked_at = self.known(staged)
        fresh = staged.join(known, self.key, "left_anti") if looked_at else staged
        self._add(fresh.drop("_bucket"), "insert")

    def compact(self, grown: int = 8, file_rows: int = 5_000_000) -> list[int]:
        """Write new bases for the buckets of more than ``grown`` parts; returns these buckets."""
        by_bucket: dict[int, list[Part]] = {}
        for part in self.parts():
            by_bucket.setdefault(part.bucket, []).append(part)
        heavy = {b: parts for b, parts in by_bucket.items() if len(parts) > grown}
        if heavy:
            parts = [p for own in heavy.values() for p in own]
            self._add(self._live(parts).drop("_version"), "base", files=max(len(heavy), -(-sum(p.rows for p in parts) // file_rows)))
        return sorted(heavy)

    def _stamped(self, rows: DataFrame) -> DataFrame:
        """The table's columns in its types; those that ``rows`` lacks are NULL."""
        shaped = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        return rows.select(*[F.current_timestamp().cast("timestamp_ntz").alias(f.name) if f.name == self.loaded_at else c for f, c in zip(self.schema.fields, shaped)])

    def _add(self, rows: DataFrame, kind: str, files: int | None = None) -> None:
        version = max((p.version for p in self.parts()), default=0) + 1
        folder = folder_of(version)
        path = f"{self.path}/data/{folder}"
        kept = rows.withColumn("_bucket", self.bucket()).withColumn("_version", F.lit(version).cast("long"))
        # Loads are dealt by bucket, large ones split by Spark's rebalancing; bases by ranges of keys.
        dealt = kept.repartitionByRange(files, "_bucket", self.key) if files else kept.hint("rebalance", "_bucket")
        dealt.sortWithinPartitions("_bucket", self.key).write.partitionBy("_bucket").parquet(path)
        stored = self.spark.read.schema(f"{self.key} {self.schema[self.key].dataType.simpleString()}, _bucket int").parquet(path)
        entries = _reach(stored, self.key).select(
            F.col("_bucket").alias("bucket"), F.lit(version).alias("version"), F.lit(folder).alias("folder"), F.lit(kind).alias("kind"), "rows", "low", "high"
        )
        entries.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")


def _reach(rows: DataFrame, key: str) -> DataFrame:
    """Number of rows, least and greatest key of each ``_bucket``: a row for each bucket."""
    return rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("low"), F.max(key).alias("high"))
