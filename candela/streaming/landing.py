"""Landed API responses as a stream: bars into the merged table, what is rejected into a quarantine.

Every micro-batch of response files is parsed once and stored; its bars are
merged by (symbol, stamp) into the table, so a file that lands twice, late or
with bars that overlap changes nothing but the keys it holds, and only the
folders it touches are read. Rejected responses go to a folder of the batch's
number, which a replay replaces. With ``span``, the batch then goes on to the
incremental load, which starts from the state of the symbols and puts bars
that are not new aside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from candela.plans import incremental
from candela.schemas import BAR_COLS, PAYLOADS, SYMBOL_BARS
from candela.session import ensure_checkpoint_dir, stored
from candela.sources import merge, payloads
from candela.streaming.events import batch_writer, read_batches

QUARANTINE = StructType([*PAYLOADS.fields, StructField("reason", StringType())])


def land_batch(landed: DataFrame, batch_id: int, root: str, *, span: int | None = None) -> None:
    """One batch of responses ``(symbol, status, api_version, body)`` into ``root``."""
    ensure_checkpoint_dir(landed.sparkSession)
    bars, rejected = payloads.split_classified(stored(payloads.classify(landed)))
    batch_writer(f"{root}/quarantine")(rejected, batch_id)
    merge.merge(bars.select("symbol", *BAR_COLS), f"{root}/bars")
    if span:
        incremental.load_batch(bars.select("symbol", *BAR_COLS).dropDuplicates(["symbol", "tstamp"]), f"{root}/load", batch_id, span=span)


def run_landing(
    spark: SparkSession,
    source_path: str,
    root: str,
    checkpoint: str,
    *,
    source_fmt: str = "parquet",
    span: int | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Drain the folder of landed responses (``availableNow``) and return the table of bars.

    ``files_per_batch`` bounds a micro-batch.
    """
    reader = spark.readStream.schema(PAYLOADS).format(source_fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.load(source_path)
        .writeStream.foreachBatch(lambda landed, n: land_batch(landed, n, root, span=span))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not merge.exists(spark, f"{root}/bars"):
        return spark.createDataFrame([], SYMBOL_BARS)
    return merge.read_merged(spark, f"{root}/bars", SYMBOL_BARS)


def quarantined(spark: SparkSession, root: str) -> DataFrame:
    """The distinct rejected responses of all batches, with the reason."""
    return read_batches(spark, f"{root}/quarantine", QUARANTINE).distinct()
