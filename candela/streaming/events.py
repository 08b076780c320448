"""Notification events as Structured Streaming queries.

Wire format: ``(key string, value binary)`` where ``value`` is a compact UTF-8
JSON object of strings.  The source/sink format is an argument: ``kafka`` in
production (its connector jar must be on the classpath; it is not in this
environment), any file format for tests.  Progress is tracked by the query's
checkpoint, not by consumer-group commits.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from candela.operators.notify import addressed, decode_events, outbox, rejects
from candela.schemas import EVENT_WIRE
from candela.sources import merge


#: Columns of rejected events as ``run_outbox`` writes them.
REJECTED = "key STRING, value BINARY, rejected STRING"


def _named(topic: str | None) -> str:
    if not topic:
        raise ValueError("a Kafka source or sink needs a topic")
    return topic


def read_event_stream(
    spark: SparkSession,
    *,
    fmt: str = "kafka",
    path: str | None = None,
    topic: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Streaming wire events from the start of the topic (or files in ``path``)."""
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("subscribe", _named(topic)).option("startingOffsets", "earliest")
    else:
        reader = reader.schema(EVENT_WIRE)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    raw = reader.load(path) if path else reader.load()
    return raw.select(F.col("key").cast("string").alias("key"), F.col("value").cast("binary").alias("value"))


def write_event_stream(
    wire: DataFrame,
    checkpoint: str,
    *,
    fmt: str = "kafka",
    path: str | None = None,
    topic: str | None = None,
    options: dict[str, str] | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Start writing wire events; Kafka gets ``acks=all``."""
    writer = wire.writeStream.format(fmt).option("checkpointLocation", checkpoint)
    if fmt == "kafka":
        writer = writer.option("topic", _named(topic)).option("kafka.acks", "all")
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path) if path else writer.start()


def write_event_batch(wire: DataFrame, *, fmt: str = "kafka", path: str | None = None,
                      topic: str | None = None, options: dict[str, str] | None = None, mode: str = "append") -> None:
    """Batch form of the sink (after a table write succeeds, for example); ``mode`` is for files."""
    writer = wire.write.format(fmt)
    if fmt == "kafka":
        writer = writer.option("topic", _named(topic)).option("kafka.acks", "all")
    else:
        writer = writer.mode(mode)
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.save(path) if path else writer.save()


def outbox_stream(wire: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Stateless stream: decode maps, keep valid recipients, apply defaults; ``carry``: map entries to keep as columns."""
    return outbox(decode_events(wire)).select("to", "subject", "content", *[F.col("m")[k].alias(k) for k in carry])


def rejects_stream(wire: DataFrame) -> DataFrame:
    """The events that do not reach the outbox, as they came, with the reason."""
    return rejects(decode_events(wire)).select("key", "value", "rejected")


def batch_writer(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Writes a micro-batch to a folder of its number; a batch that is run again replaces what it wrote."""
    return lambda df, batch_id: df.write.format(fmt).mode("overwrite").save(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet") -> DataFrame:
    """The rows of all finished batches in a folder, without the batch's number (none: an empty table)."""
    done = [f"{path}/batch_id={n}" for n in merge.numbered(spark, path, "batch_id")]
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(done)


def outbox_batch(
    wire: DataFrame, batch_id: int, sink_path: str, *, sink_fmt: str = "parquet", carry: Sequence[str] = (), rejected_path: str | None = None
) -> None:
    """One batch of wire events into the outbox and the rejects: read and decoded once, both at the same offset."""
    sorted_ = addressed(decode_events(wire)).persist(StorageLevel.DISK_ONLY)
    try:
        mail = sorted_.filter(F.col("rejected").isNull())
        batch_writer(sink_path, sink_fmt)(mail.select("to", "subject", "content", *[F.col("m")[k].alias(k) for k in carry]), batch_id)
        if rejected_path:
            batch_writer(rejected_path, sink_fmt)(sorted_.filter(F.col("rejected").isNotNull()).select("key", "value", "rejected"), batch_id)
    finally:
        sorted_.unpersist()


def run_outbox(
    spark: SparkSession,
    source_path: str,
    sink_path: str,
    checkpoint: str,
    *,
    source_fmt: str = "parquet",
    sink_fmt: str = "parquet",
    carry: Sequence[str] = (),
    rejected_path: str | None = None,
) -> DataFrame:
    """Drain the event folder once (``availableNow``) into the outbox table and read it back.

    ``rejected_path``: the rejected events are written there by the same query,
    from the same read.  Both sinks have a folder for each micro-batch.
    """
    query = (
        read_event_stream(spark, fmt=source_fmt, path=source_path)
        .writeStream.foreachBatch(
            lambda wire, n: outbox_batch(wire, n, sink_path, sink_fmt=sink_fmt, carry=carry, rejected_path=rejected_path)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    schema = ", ".join(f"`{c}` STRING" for c in ("to", "subject", "content", *carry))
    return read_batches(spark, sink_path, schema, sink_fmt)
