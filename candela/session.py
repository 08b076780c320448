"""Session helpers for tests, the bench and command-line use.

Library functions never build a session; they take DataFrames.  These helpers
only set what the package relies on (UTC session time zone) and fill in
settings that are unset.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # drop reliable checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "candela", scratch: str | None = None
) -> SparkSession:
    """A local session; ``scratch`` becomes its checkpoint folder."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if scratch:
        builder = builder.config("spark.checkpoint.dir", scratch)
    builder = builder.config("spark.driver.memory", os.environ.get("CANDELA_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    There is no fallback: a folder of the driver's own machine would not be
    seen by the executors, so an unset one is an error.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(path)
    return path


_REMOVES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what runs here go when it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_REMOVES, None)
    spark.conf.set(_REMOVES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVES)
        else:
            spark.conf.set(_REMOVES, before)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: computed once, lineage cut, columns still pruned, its shuffles removed."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/candela-stored-{uuid.uuid4().hex}"
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Settings suggested for a large cluster (about 100 TB of bars, 1000
# executors).  Nothing here is applied automatically; pass them to
# spark-submit or the session builder.
CLUSTER_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # start wide, let AQE merge: ~256 MB per post-shuffle partition
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # 256 MB input splits for the Parquet scans
    "spark.sql.files.maxPartitionBytes": "256m",
    # summaries below this are broadcast by AQE at run time
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # remove checkpoint files of materialised inputs when no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}
