"""Series scans: one request, many requests, CSV bars, the symbol universe, empty bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.plans import segments as seg
from candela.schemas import BARS, SYMBOL_BARS

#: Bars of a bucket of the request join, about.
BUCKET_ROWS = 1 << 14


def symbol_range_scan(bars: DataFrame, symbol: str, period1: int, period2: int) -> DataFrame:
    """Bars of one symbol with ``period1 <= tstamp < period2``.

    Plain filters, so they reach a Parquet scan (and a ``symbol`` partition
    directory when the table is written partitioned by symbol).
    """
    return bars.filter(
        (F.col("symbol") == F.lit(symbol)) & (F.col("tstamp") >= F.lit(period1)) & (F.col("tstamp") < F.lit(period2))
    )


def request_scan(bars: DataFrame, requests: DataFrame, *, target_rows: int = BUCKET_ROWS) -> DataFrame:
    """Many requests at once: bars in ``[period1, period2)`` of each request's symbol.

    ``requests`` needs ``request_id, symbol, period1, period2``.  A series of
    more than ``target_rows`` bars is cut into equal-depth buckets (see
    ``segments``); a request goes to the buckets it reaches, and both sides
    join on (symbol, bucket).  A bar meets only the requests that reach its
    bucket, a hot or dense symbol spreads over its buckets, and a request with
    absurd bounds reaches no more buckets than its symbol has.
    """
    seg.refuse_own_names(bars)
    found = seg.cuts(bars, ["symbol"], "tstamp", halo=0, target_rows=target_rows)
    bucketed = seg.split(bars, ["symbol"], "tstamp", found=found)
    bounds = F.broadcast(found)
    key, cuts = seg.PREFIX + "k0", seg.CUTS
    req = requests.select("request_id", F.col("symbol").alias("_rs"), "period1", "period2").filter("period1 < period2")

    def reached(stamp: Column) -> Column:
        return F.coalesce(F.size(F.filter(F.col(cuts), lambda c: c <= stamp)), F.lit(0))

    buckets = F.when(F.col(cuts).isNull(), F.array(F.lit(0))).otherwise(F.sequence(reached(F.col("period1")), reached(F.col("period2") - 1)))
    spread = req.join(bounds.select(key, cuts), F.col("_rs") == F.col(key), "left").select(
        "request_id", "_rs", "period1", "period2", F.explode(buckets).alias("_b")
    )
    in_range = (F.col("tstamp") >= F.col("period1")) & (F.col("tstamp") < F.col("period2"))
    joined = bucketed.join(spread, (F.col("symbol") == F.col("_rs")) & (F.col(seg.SEG) == F.col("_b")) & in_range)
    return joined.select(*[F.col(seg.q(c)) for c in bars.columns], "request_id", "period1", "period2")


def read_bars_csv(spark: SparkSession, path: str, with_symbol: bool = False) -> DataFrame:
    """Bars CSV with a header line, typed by the fixed bars schema."""
    schema = SYMBOL_BARS if with_symbol else BARS
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_symbols_csv(spark: SparkSession, path: str) -> DataFrame:
    """Symbol list, one per line, each line but the last ending in a comma."""
    raw = spark.read.schema("symbol STRING, _extra STRING").option("header", False).csv(path)
    return raw.select(F.trim("symbol").alias("symbol")).filter(F.col("symbol") != "")


def read_symbols_json(spark: SparkSession, path: str, field: str = "symbols") -> DataFrame:
    """Symbol list from a JSON document holding ``{"symbols": [...]}``."""
    doc = spark.read.option("multiLine", True).json(path)
    return doc.select(F.explode(F.col(field)).alias("symbol"))


def empty_bars(spark: SparkSession, with_symbol: bool = True) -> DataFrame:
    """Typed empty bars frame (the source's fallback when nothing is loaded)."""
    return spark.createDataFrame([], SYMBOL_BARS if with_symbol else BARS)
