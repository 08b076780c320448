"""Load of many symbols batch by batch, without reading what was loaded before.

Of every symbol the state after a batch is one row: its last bar, the EMA
there, the last ``span - 1`` closes (midpoints included) and the last side of
its SMA on which the close was.  The next batch of bars starts from it: the
last bar goes before the new ones, so that a gap between them is filled; the
EMA goes on from a first value that leaves it where it was; the last closes
fill the first frames of the SMA; the last side tells a crossing.  Rows and
alerts of all batches are those of one load.

Everything a batch writes lies in folders of its number: ``rows``, ``alerts``,
``late`` (bars not after the last one that was loaded, or without a stamp) and
``state`` (of all symbols).  A batch that is run again starts from the state
before it and replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candela.operators import notify, series
from candela.plans import segments as seg
from candela.schemas import BAR_COLS, DAY_SECONDS, DEFAULT_SPAN, SYMBOL_BARS
from candela.session import ensure_checkpoint_dir, stored
from candela.sources import merge

_BAR = "STRUCT<tstamp: BIGINT, high: DOUBLE, low: DOUBLE, open: DOUBLE, close: DOUBLE, volume: BIGINT>"
STATE = f"symbol STRING, last {_BAR}, ema DOUBLE, tail ARRAY<STRUCT<tstamp: BIGINT, close: DOUBLE>>, side DOUBLE"
_EMA_IN = seg.PREFIX + "ema_in"


def state_before(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """The state that the last finished batch before this one left."""
    done = [n for n in merge.numbered(spark, f"{root}/state", "batch_id") if n < batch_id]
    if not done:
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).parquet(f"{root}/state/batch_id={done[-1]}")


def load_batch(
    bars: DataFrame,
    root: str,
    batch_id: int,
    *,
    span: int = DEFAULT_SPAN,
    max_gap: int = DAY_SECONDS,
    target_rows: int = seg.TARGET_ROWS,
) -> DataFrame:
    """Gap fill, EMA, SMA and crossings of a batch of bars; returns its rows, read back.

    ``bars``: symbol and bar columns, stamps unique per symbol.  Batches come in the order of
    their numbers.  The state is joined by symbol; a symbol of very many bars
    is cut into segments as in ``series``.
    """
    spark = bars.sparkSession
    ensure_checkpoint_dir(spark)
    state = state_before(spark, root, batch_id)
    own = bars.select("symbol", *BAR_COLS)
    last = state.select(F.col("symbol").alias("__cd_s"), F.col("last.tstamp").alias("__cd_at"))
    placed = own.join(last, F.col("symbol").eqNullSafe(F.col("__cd_s")), "left")
    is_new = F.coalesce(F.col("tstamp") > F.coalesce(F.col("__cd_at"), F.lit(-(2**63))), F.lit(False))
    marked = stored(placed.select("symbol", *BAR_COLS, is_new.alias("__cd_new")))

    def write(df: DataFrame, part: str) -> DataFrame:
        path = f"{root}/{part}/batch_id={int(batch_id)}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    write(marked.where("not __cd_new").select("symbol", *BAR_COLS), "late")
    fresh = marked.where("__cd_new").select("symbol", *BAR_COLS)
    # only symbols with new bars take part; the others keep their state
    known = state.join(fresh.select(F.col("symbol").alias("__cd_s")).distinct(), F.col("symbol").eqNullSafe(F.col("__cd_s")), "left_semi")
    before = known.select("symbol", "last.*").select("symbol", *BAR_COLS)
    filled = series.interpolate(before.unionByName(fresh), max_gap=max_gap, target_rows=target_rows)
    nothing = F.lit(None).cast("double")
    # a first value that leaves the EMA where it was
    start = known.select(F.col("symbol").alias("__cd_s"), F.col("last.tstamp").alias("__cd_at"), (F.col("ema") / (2.0 / (span + 1))).alias("__cd_v"))
    joined = filled.join(start, F.col("symbol").eqNullSafe(F.col("__cd_s")), "left")
    old = F.coalesce(F.col("tstamp") <= F.col("__cd_at"), F.lit(False))
    going = joined.select("symbol", *BAR_COLS, F.when(old, F.col("__cd_v")).otherwise(F.col("close")).alias("ema_in"), old.alias("old"))
    # the closes before the last bar, for the frames of the SMA
    tail = known.select("symbol", F.inline(F.filter("tail", lambda t: t["tstamp"] < F.col("last.tstamp")))).select(
        "symbol", "tstamp", *[nothing.alias(c) for c in ("high", "low", "open")], "close", F.lit(None).cast("long").alias("volume"),
        nothing.alias("ema_in"), F.lit(True).alias("old"),
    )
    out = series.indicators(
        going.unionByName(tail), ema_spans=[span], sma_spans=[span], ema_column="ema_in", target_rows=target_rows
    )
    done = stored(out)
    rows = write(done.where("not old").drop("old", "ema_in"), "rows")
    # the last side stands for the rows before: above or below 0 on a mean of 0
    sides = known.where("side is not null").select("symbol", F.col("last.tstamp").alias("tstamp"), F.col("side").alias("close"), F.lit(0.0).alias(f"sma_{span}d"))
    signed = rows.select("symbol", "tstamp", "close", f"sma_{span}d").unionByName(sides)
    write(notify.crossover_alerts(signed, span=span, sma=f"sma_{span}d", target_rows=target_rows), "alerts")

    def latest(column, when=None):
        return F.max_by(column, F.when(when, F.col("tstamp")) if when is not None else F.col("tstamp"))

    side = F.signum(F.col("close") - F.round(F.col(f"sma_{span}d"), 4))
    ends = rows.groupBy("symbol").agg(
        latest(F.struct(*BAR_COLS)).alias("last"), latest(F.col(f"ema_{span}d")).alias("ema"), latest(side, side != 0).alias("side")
    )
    order = Window.partitionBy("symbol").orderBy(F.desc("tstamp"))
    kept = done.withColumn("r", F.row_number().over(order)).where(F.col("r") < span)
    tails = kept.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct("tstamp", "close"))).alias("tail"))
    was = state.select(F.col("symbol").alias("__cd_s"), F.col("side").alias("__cd_side"))
    now = ends.join(tails.withColumnRenamed("symbol", "__cd_t"), F.col("symbol").eqNullSafe(F.col("__cd_t")), "left")
    now = now.join(was, F.col("symbol").eqNullSafe(F.col("__cd_s")), "left").select(
        "symbol", "last", "ema", F.coalesce("tail", F.array().cast("array<struct<tstamp:bigint,close:double>>")).alias("tail"),
        F.coalesce("side", "__cd_side").alias("side"),
    )
    rest = state.join(ends.select(F.col("symbol").alias("__cd_s")), F.col("symbol").eqNullSafe(F.col("__cd_s")), "left_anti")
    write(now.unionByName(rest), "state")
    return rows


def read_all(spark: SparkSession, root: str, part: str, span: int = DEFAULT_SPAN) -> DataFrame:
    """``rows``, ``alerts`` or ``late`` of all batches, without the batch's number."""
    bar = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SYMBOL_BARS.fields)
    schema = {
        "rows": f"{bar}, ema_{span}d DOUBLE, sma_{span}d DOUBLE",
        "alerts": f"symbol STRING, tstamp BIGINT, close DOUBLE, sma_{span}d DOUBLE, direction STRING",
        "late": bar,
    }[part]
    return spark.read.schema(schema).parquet(f"{root}/{part}").drop("batch_id")
