"""Bars built from the driver's tables, so every query reads real inputs.

``bars_from_orders``: one series per ``o_orderpriority``; one bar per order
date.  ``bars_from_lineitem``: one series per supplier; one bar per ship date.
Both are partial-aggregated group-bys (map-side combine), so a hot key does
not concentrate raw rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.schemas import V7_HEADER
from candela.session import stored

#: An array for the metadata of the responses made here.
VIEWS = ("day", "week", "month", "year", "all")


def epoch_seconds(col: str | Column) -> Column:
    """Epoch seconds of a TIMESTAMP_NTZ (wall clock read as UTC), independent of the session zone."""
    c = (F.col(col) if isinstance(col, str) else col).cast("timestamp_ntz")
    days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bars_from_orders(orders: DataFrame) -> DataFrame:
    return (
        orders.select(
            F.col("o_orderpriority").alias("symbol"),
            epoch_seconds("o_orderdate").alias("tstamp"),
            "o_orderkey",
            "o_totalprice",
        )
        .groupBy("symbol", "tstamp")
        .agg(
            F.max("o_totalprice").alias("high"),
            F.min("o_totalprice").alias("low"),
            F.min_by("o_totalprice", "o_orderkey").alias("open"),
            F.max_by("o_totalprice", "o_orderkey").alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
    )


def bars_from_lineitem(lineitem: DataFrame) -> DataFrame:
    # (l_orderkey, l_linenumber) is not unique, so open/close take the price
    # of the smallest/largest (orderkey, linenumber, price) triple.
    line = F.struct(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_extendedprice").alias("price"))
    return (
        lineitem.select(
            F.col("l_suppkey").cast("string").alias("symbol"),
            epoch_seconds("l_shipdate").alias("tstamp"),
            "l_extendedprice",
            line.alias("line"),
        )
        .groupBy("symbol", "tstamp")
        .agg(
            F.max("l_extendedprice").alias("high"),
            F.min("l_extendedprice").alias("low"),
            F.min("line")["price"].alias("open"),
            F.max("line")["price"].alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
    )


def orders_bars(spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None) -> DataFrame:
    """Bars of ``orders``; ``days``: of the dates from the first up to, not including, the second (a filter on the scan)."""
    orders = table(spark, sf_dir, "orders")
    if days:
        first, end = (F.lit(d).cast("timestamp_ntz") for d in days)
        orders = orders.filter((F.col("o_orderdate") >= first) & (F.col("o_orderdate") < end))
    return bars_from_orders(orders)


def uneven(bars: DataFrame) -> DataFrame:
    """Bars with prices divided by 7: rounding them to three or four places is no no-op."""
    return bars.withColumns({c: F.col(c) / 7 for c in ("high", "low", "open", "close")})


def lineitem_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_from_lineitem(table(spark, sf_dir, "lineitem"))


# DuckDB text of the same adapters, for the oracle SQL.
ORDERS_BARS_SQL = """
SELECT o_orderpriority AS symbol, CAST(epoch(o_orderdate) AS BIGINT) AS tstamp,
       max(o_totalprice) AS high, min(o_totalprice) AS low,
       arg_min(o_totalprice, o_orderkey) AS "open", arg_max(o_totalprice, o_orderkey) AS "close",
       CAST(count(*) AS BIGINT) AS volume
FROM orders GROUP BY 1, 2
"""

LINEITEM_BARS_SQL = """
SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(epoch(l_shipdate) AS BIGINT) AS tstamp,
       max(l_extendedprice) AS high, min(l_extendedprice) AS low,
       min({'o': l_orderkey, 'n': l_linenumber, 'p': l_extendedprice}).p AS "open",
       max({'o': l_orderkey, 'n': l_linenumber, 'p': l_extendedprice}).p AS "close",
       CAST(count(*) AS BIGINT) AS volume
FROM lineitem GROUP BY 1, 2
"""


def hot_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem bars plus one extra series ``HOT`` holding all of them again.

    ``HOT`` carries half of all rows (stamps made unique per supplier), the
    skew case the series operators must split.  The lineitem bars are written
    once; both halves, and every pass of the operators over them, read that
    table instead of adding up the lines again.
    """
    b = stored(lineitem_bars(spark, sf_dir))
    hot = b.select(
        F.lit("HOT").alias("symbol"),
        (F.col("tstamp") * 10000 + F.col("symbol").cast("long")).alias("tstamp"),
        "high", "low", "open", "close", "volume",
    )
    return b.unionByName(hot)


HOT_BARS_SQL = f"""
WITH b AS ({LINEITEM_BARS_SQL})
SELECT * FROM b
UNION ALL
SELECT 'HOT', tstamp * 10000 + CAST(symbol AS BIGINT), high, low, "open", "close", volume FROM b
"""


# ---------------------------------------------------------------------------
# Landed responses made from bars, to feed the parsers from real tables
# ---------------------------------------------------------------------------


def _day(tstamp):
    """Calendar day (UTC) of epoch seconds, without the session time zone."""
    return F.date_from_unix_date(F.floor(tstamp / 86400).cast("int"))


def _per_period(bars: DataFrame, period_days: int | None = None) -> DataFrame:
    """One row per (symbol, calendar year), or per (symbol, ``period_days`` window), arrays sorted by tstamp."""
    if period_days:
        period = F.floor(F.col("tstamp") / (86400 * int(period_days)))
    else:
        period = F.year(_day(F.col("tstamp")))
    row = F.struct("tstamp", "high", "low", "open", "close", "volume")
    return bars.groupBy("symbol", period.alias("year")).agg(F.array_sort(F.collect_list(row)).alias("rows"))


def v8_payloads(bars: DataFrame, api_version: str = "v8", period_days: int | None = None) -> DataFrame:
    """Bars -> JSON chart payloads, one per (symbol, year) or per ``period_days``."""
    y = _per_period(bars, period_days)
    quote = F.struct(
        F.col("rows.high").alias("high"),
        F.col("rows.low").alias("low"),
        F.col("rows.open").alias("open"),
        F.col("rows.close").alias("close"),
        F.col("rows.volume").alias("volume"),
    )
    first_ts = F.element_at("rows", 1)["tstamp"]
    last_ts = F.element_at("rows", -1)["tstamp"]
    period = F.struct(
        F.lit("UTC").alias("timezone"),
        last_ts.alias("end"),
        first_ts.alias("start"),
        F.lit(0).alias("offset"),
    )
    meta = F.struct(
        F.col("symbol").alias("symbol"),
        F.lit("USD").alias("currency"),
        first_ts.alias("firstBar"),
        F.lit(False).alias("extended"),
        F.element_at("rows", -1)["close"].alias("lastPrice"),
        F.struct(period.alias("main")).alias("session"),
        F.lit("1d").alias("spacing"),
        F.array(*[F.lit(r) for r in VIEWS]).alias("views"),
    )
    result = F.struct(
        meta.alias("meta"),
        F.col("rows.tstamp").alias("timestamp"),
        F.struct(F.array(quote).alias("quote")).alias("indicators"),
    )
    body = F.to_json(F.struct(F.struct(F.array(result).alias("result")).alias("chart")))
    return y.select(
        "symbol", F.lit(200).alias("status"), F.lit(api_version).alias("api_version"), body.alias("body")
    )


def v7_payloads(bars: DataFrame, api_version: str = "v7", period_days: int | None = None) -> DataFrame:
    """Bars -> CSV download payloads (header + one line per bar), one per (symbol, year)."""
    y = _per_period(bars, period_days)
    header = F.lit(V7_HEADER)

    def cell(c: Column) -> Column:
        # a missing value is written as null (concat_ws would drop it and shift the cells)
        return F.coalesce(c.cast("string"), F.lit("null"))

    line = F.transform(
        "rows",
        lambda r: F.concat_ws(
            ",",
            cell(_day(r["tstamp"])),
            cell(r["open"]),
            cell(r["high"]),
            cell(r["low"]),
            cell(r["close"]),
            cell(r["close"]),
            cell(r["volume"]),
        ),
    )
    body = F.concat_ws("\n", F.concat(F.array(header), line))
    return y.select(
        "symbol", F.lit(200).alias("status"), F.lit(api_version).alias("api_version"), body.alias("body")
    )
