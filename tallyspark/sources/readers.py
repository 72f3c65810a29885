"""Table readers: delimited files, object stores, JSON message streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark import schemas


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str = schemas.RAW, multi_line: bool = True
) -> DataFrame:
    """Delimited file with a header row; every column is text unless the schema says more.

    With ``multi_line`` a quoted value may hold line breaks, and each file is read by one
    task.  Without it files are split, which is right only where no value holds a line break.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )


def read_object(spark: SparkSession, bucket: str, key: str, scheme: str = "s3a") -> DataFrame:
    """Raw transactions from an object store bucket; the cluster supplies the filesystem."""
    return read_csv(spark, object_url(bucket, key, scheme))


def object_url(bucket: str, key: str, scheme: str = "s3a") -> str:
    root = f"{scheme}:///" if scheme == "file" else f"{scheme}://"
    return f"{root}{bucket.strip('/')}/{key.lstrip('/')}"


def read_message_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of text messages, one JSON document per line."""
    reader = spark.readStream.schema("value string")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select("value")


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str = "transactions",
    starting_offsets: str = "latest",
    max_offsets: int | None = None,
) -> DataFrame:
    """Stream of one topic with its offsets; needs the Kafka connector on the cluster."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(
        F.col("value").cast("string").alias("value"), "partition", "offset"
    )


def first_existing(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """The first candidate that is a column."""
    return next((c for c in candidates if c in columns), None)


def optional_column(df: DataFrame, candidates: Sequence[str], dtype: str = "string") -> Column:
    """The first existing candidate column, else a typed NULL."""
    name = first_existing(df.columns, candidates)
    return F.col(name).cast(dtype) if name else F.lit(None).cast(dtype)
