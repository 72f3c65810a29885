"""Transaction messages: decode, validate, insert once, keep the rejected."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyspark import schemas
from tallyspark.functions import values
from tallyspark.sources.sinks import KeyedTable

STREAM_TYPES = ("Expense", "Income")
ROW_COLUMNS = ["voucher_id", "consumer_id", "transaction_type", "amount", "transaction_date", "description"]
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def decode(messages: DataFrame) -> DataFrame:
    """Parse the JSON text of ``value``; ``bad_json`` marks what is no JSON object."""
    parsed = F.from_json(
        "value", f"{schemas.MESSAGE_DDL}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}
    )
    return (
        messages.withColumn("m", parsed)
        .withColumn("bad_json", F.col("m").isNull() | F.col("m._corrupt").isNotNull())
        .select("*", *[F.col(f"m.{c}").alias(c) for c in _fields()])
        .drop("m")
    )


def _fields() -> list[str]:
    return [part.split()[0] for part in schemas.MESSAGE_DDL.split(", ")]


def validate(decoded: DataFrame) -> DataFrame:
    """Typed columns and ``reject_reason`` (NULL for good messages), first failed test wins."""
    date = F.col("transaction_date")
    parsed = F.try_to_timestamp(date, F.lit("y-M-d")).cast("date")
    has_date = F.coalesce(date != "", F.lit(False))
    money = values.money(F.col("amount"))
    reason = (
        F.when(F.col("bad_json"), "invalid JSON")
        .when(F.col("voucher_id").isNull(), "missing voucher_id")
        .when(values.flag(~F.col("transaction_type").isin(*STREAM_TYPES), True), "invalid transaction_type")
        .when(F.col("amount").isNull(), "missing amount")
        .when(has_date & (parsed.isNull() | ~date.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$")), "invalid transaction_date")
        .when(money.isNull(), "invalid amount")
        .when(values.to_number(F.col("voucher_id"), "bigint").isNull(), "invalid voucher_id")
    )
    return decoded.withColumn("reject_reason", reason).withColumns(
        {
            "voucher_id": values.to_number(F.col("voucher_id"), "bigint"),
            "consumer_id": values.to_number(F.col("consumer_id"), "bigint"),
            "amount": money,
            "transaction_date": F.when(has_date, parsed),
        }
    )


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter("reject_reason is null").drop("reject_reason", "bad_json", "value")


def rejected(validated: DataFrame) -> DataFrame:
    """Dead letters: the message text and why it was turned away."""
    return validated.filter("reject_reason is not null").select("value", "reject_reason")


def insert_outcome(good: DataFrame, target: DataFrame, order: list[Column]) -> DataFrame:
    """Every good message with INSERTED or SKIPPED: a key the target or an earlier message has is skipped.

    A key that a third of all messages repeat is ranked by one partial
    aggregate, not by a window over the key's messages.
    """
    winner = good.groupBy("voucher_id").agg(F.min(F.struct(*order)).alias("_first"))
    known = target.select("voucher_id", F.lit(True).alias("_known"))
    return (
        good.join(winner.join(known, "voucher_id", "left"), "voucher_id")
        .withColumn(
            "outcome",
            F.when(
                F.col("_known").isNull() & (F.struct(*order) == F.col("_first")), "INSERTED"
            ).otherwise("SKIPPED"),
        )
        .drop("_first", "_known")
    )


class MessageLoader:
    """A stream of messages into the keyed table that batch and incremental loads write too.

    Repeats of a key are met twice.  Spark's keyed state holds the first message of each key
    for ``span`` of arrival time, so a repeat that comes soon costs no look at the table; the table then takes only
    keys it lacks, whoever loaded them.  ``order`` names the columns of the stream by which the first message of a key
    in a batch is known: partition and offset of a topic, or a sequence number.

    A batch that is delivered again after a failure finds its keys and adds nothing.  Arrival is the batch's own
    time, which Spark keeps with the batch, so no message is ever late for the state.  Rejected messages go to their
    own stream and folder, which Spark's file sink writes exactly once.
    """

    def __init__(self, table: KeyedTable, dead_letters: str, order: list[str], span: str = "1 hour"):
        self.table = table
        self.dead_letters = dead_letters.rstrip("/")
        if not order:
            raise ValueError("name the columns that say which message came first")
        self.order = order
        self.span = span

    def read(self) -> DataFrame:
        """The message columns of all rows of the table."""
        return self.table.read().select(*ROW_COLUMNS)

    def read_dead_letters(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("value string, reject_reason string").parquet(self.dead_letters)

    def first_messages(self, stream: DataFrame) -> DataFrame:
        """The first good message of each key that the batch touches, from Spark's state."""
        good = validate(decode(stream)).filter("reject_reason is null").withColumn("arrival", F.current_timestamp()).withWatermark("arrival", self.span)
        row = F.struct(*dict.fromkeys([*ROW_COLUMNS, *self.order]))
        first = good.groupBy(F.window("arrival", self.span), F.col("voucher_id").alias("_key")).agg(
            F.min_by(row, F.struct(*self.order)).alias("first")
        )
        return first.select("first.*")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.table.insert_ignore(batch, [F.col(c) for c in self.order])

    def start(self, stream: DataFrame, checkpoint: str, available_now: bool = False) -> "Loading":
        """Start both streams: rows into the table, rejected messages into their folder."""
        stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
        rows = self.first_messages(stream).writeStream.outputMode("update").foreachBatch(self)
        dead = rejected(validate(decode(stream))).writeStream.format("parquet").option("path", self.dead_letters)
        queries = []
        for name, writer in (("rows", rows), ("dead", dead)):
            writer = writer.option("checkpointLocation", f"{checkpoint.rstrip('/')}/{name}")
            queries.append((writer.trigger(availableNow=True) if available_now else writer).start())
        return Loading(queries)


@dataclass
class Loading:
    """The running streams of a loader."""

    queries: list[StreamingQuery]

    def awaitTermination(self) -> None:  # noqa: N802  as Spark's own
        for query in self.queries:
            query.awaitTermination()

    def stop(self) -> None:
        for query in self.queries:
            query.stop()
