"""Data checks on series: chronology, future stamps, completeness, value rules,
request limits, key uniqueness, missing timestamps, and conforming to the
prices table.

Checks return summary rows ``(rule, checked, violations)`` so a clean table
gives zeros rather than an empty frame; row-level helpers return the
offending rows for quarantine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candela.plans import segments as seg
from candela.schemas import INTERVAL_LIMITS, SPAN_LIMITED, SYMBOL_MAX_LEN

INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def _summary(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule: rows checked and rows where the rule's flag is true."""
    agg = df.agg(
        F.count(F.lit(1)).alias("checked"),
        *[F.sum(F.when(flag, 1).otherwise(0)).alias(name) for name, flag in rules.items()],
    )
    stack = ", ".join(f"'{name}', `{name}`" for name in rules)
    return agg.selectExpr(f"stack({len(rules)}, {stack}) AS (rule, violations)", "checked").select(
        "rule", F.col("checked").cast("long").alias("checked"), F.coalesce(F.col("violations"), F.lit(0)).cast("long").alias("violations")
    )


def chronology_flags(
    df: DataFrame, seq_col: str, ts_col: str, keys: Sequence[str] = (), target_rows: int = seg.TARGET_ROWS
) -> DataFrame:
    """Rows in ingest order ``seq_col`` (an integer) with ``out_of_order`` when ``ts`` goes back in time."""
    seg.refuse_own_names(df, ["out_of_order"])
    s = seg.split(df, keys, seq_col, target_rows=target_rows)
    w = Window.partitionBy(*[seg.q(k) for k in keys], seg.SEG).orderBy(seg.q(seq_col))
    late = F.coalesce(F.col(seg.q(ts_col)) < F.lag(seg.q(ts_col)).over(w), F.lit(False))
    return s.withColumn("out_of_order", late).filter(~F.col(seg.HALO)).select(*[F.col(seg.q(c)) for c in df.columns], "out_of_order")


def check_chronology(
    df: DataFrame, seq_col: str, ts_col: str, keys: Sequence[str] = (), target_rows: int = seg.TARGET_ROWS
) -> DataFrame:
    flags = chronology_flags(df, seq_col, ts_col, keys, target_rows)
    return _summary(flags, {"chronology": F.col("out_of_order")})


def check_future(df: DataFrame, ts_col: str, as_of: Column) -> DataFrame:
    """Timestamps later than ``as_of`` (a literal or column of the same type)."""
    return _summary(df, {"future": F.coalesce(F.col(ts_col) > as_of, F.lit(False))})


def check_bar_values(bars: DataFrame) -> DataFrame:
    """Value rules on bars: NULL prices, low > high, open/close outside [low, high], negative volume."""
    c = {k: F.col(k) for k in ("open", "high", "low", "close", "volume")}
    rules = {
        "null_price": c["open"].isNull() | c["high"].isNull() | c["low"].isNull() | c["close"].isNull(),
        "low_above_high": F.coalesce(c["low"] > c["high"], F.lit(False)),
        "open_outside_range": F.coalesce((c["open"] < c["low"]) | (c["open"] > c["high"]), F.lit(False)),
        "close_outside_range": F.coalesce((c["close"] < c["low"]) | (c["close"] > c["high"]), F.lit(False)),
        "negative_volume": F.coalesce(c["volume"] < 0, F.lit(False)),
    }
    return _summary(bars, rules)


def check_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key uniqueness: ``checked`` = distinct keys, ``violations`` = keys seen more than once."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.lit("unique_key").alias("rule"),
        F.count(F.lit(1)).cast("long").alias("checked"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, 1).otherwise(0)), F.lit(0)).cast("long").alias("violations"),
    )


def expected_stamps(
    bars: DataFrame, keys: Sequence[str] = ("symbol",), step: int = 86400, chunk: int = 4096
) -> DataFrame:
    """Every ``step`` from each series' first to last stamp.

    Generated in two levels: a few chunk rows per series (one per ``chunk``
    steps), spread over the cluster, then the stamps of each chunk.  A long
    series therefore never sits in one task.
    """
    span = bars.groupBy(*keys).agg(F.min("tstamp").alias("lo"), F.max("tstamp").alias("hi"))
    n = F.floor((F.col("hi") - F.col("lo")) / step).cast("long")
    chunks = span.select(
        *keys, "lo", n.alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor(n / chunk).cast("long"))).alias("c")
    ).repartition(*keys, "c")
    first = F.col("c") * chunk
    last = F.least(first + chunk - 1, F.col("n"))
    steps = chunks.select(*keys, "lo", F.explode(F.sequence(first, last)).alias("_i"))
    return steps.select(*keys, (F.col("lo") + F.col("_i") * step).alias("tstamp"))


def missing_stamps(
    bars: DataFrame,
    keys: Sequence[str] = ("symbol",),
    step: int = 86400,
    chunk: int = 4096,
    target_rows: int = seg.TARGET_ROWS,
) -> DataFrame:
    """Expected stamps (every ``step`` from each series' first stamp to its last)
    that are absent from the bars.

    Each missing stamp lies strictly between two consecutive actual stamps, so
    one skew-safe pass with the previous stamp (``segments.split``) plus the grid points inside each gap gives exactly the anti-join
    of the full calendar with the actual stamps, without building the
    calendar or joining.  Long gaps are generated in ``chunk``-sized pieces
    spread over the cluster.  Same result as ``expected_stamps`` left-anti
    joined with the bars.
    """
    keys = list(keys)
    s = seg.split(bars.select(*keys, "tstamp"), keys, "tstamp", target_rows=target_rows)
    w = Window.partitionBy(*keys, seg.SEG)
    # the first stamp of a series that is not cut is that of its only segment
    s = s.withColumns(
        {"_prev": F.lag("tstamp").over(w.orderBy("tstamp")), "_lo": F.coalesce(seg.FIRST, F.min("tstamp").over(w))}
    ).filter(~F.col(seg.HALO))
    st = int(step)
    prev, cur, lo = F.col("_prev"), F.col("tstamp"), F.col("_lo")
    first = prev + st - F.pmod(prev - lo, F.lit(st))            # first grid point after prev
    last = (cur - 1) - F.pmod(cur - 1 - lo, F.lit(st))           # last grid point before cur
    gaps = s.select(*keys, first.alias("_g1"), last.alias("_g2")).filter(F.col("_g2") >= F.col("_g1"))
    n = F.floor((F.col("_g2") - F.col("_g1")) / st).cast("long") + 1
    pieces = gaps.select(
        *keys, "_g1", "_g2",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / chunk).cast("long"))).alias("_c"),
    ).repartition(*keys, "_c")
    start = F.col("_g1") + F.col("_c") * (chunk * st)
    end = F.least(F.col("_g2"), start + (chunk - 1) * st)
    return pieces.select(*keys, F.explode(F.sequence(start, end, F.lit(st).cast("long"))).alias("tstamp"))


def check_completeness(bars: DataFrame, keys: Sequence[str] = ("symbol",), step: int = 86400) -> DataFrame:
    """Per series: expected stamps (every ``step`` from first to last), present
    rows, missing stamps and the coverage ratio.

    One pass: a partial aggregate by (keys, stamp mod step) -- at most ``step``
    rows per series -- then a roll-up per series.  ``missing`` counts expected
    stamps that are absent, i.e. expected minus the rows on the grid of the
    first stamp (stamps are unique per series; see ``check_keys``); it equals
    ``missing_stamps(...)`` counted per series, without building the calendar.
    """
    keys = list(keys)
    phases = bars.groupBy(*keys, F.expr(f"pmod(tstamp, {int(step)})").alias("_ph")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("tstamp").alias("_lo"), F.max("tstamp").alias("_hi")
    )
    series_lo = F.min("_lo").over(Window.partitionBy(*keys))
    phases = phases.withColumn("_lo_all", series_lo).withColumn(
        "_grid", F.col("_ph") == F.expr(f"pmod(_lo_all, {int(step)})")
    )
    per = phases.groupBy(*keys).agg(
        F.min("_lo").alias("lo"),
        F.max("_hi").alias("hi"),
        F.sum("_n").alias("present"),
        F.sum(F.when(F.col("_grid"), F.col("_n")).otherwise(0)).alias("on_grid"),
    )
    expected = (F.floor((F.col("hi") - F.col("lo")) / step) + 1).cast("long")
    return per.select(
        *keys,
        expected.alias("expected"),
        F.col("present").cast("long").alias("present"),
        (expected - F.col("on_grid")).cast("long").alias("missing"),
    ).withColumn("coverage", F.round(F.col("present") / F.col("expected"), 6))


def interval_limits(spark: SparkSession) -> DataFrame:
    """Fixed interval -> look-back limit table (12 rows)."""
    return spark.createDataFrame(
        [(k, v) for k, v in INTERVAL_LIMITS.items()], "interval STRING, max_lookback BIGINT"
    )


def validate_requests(requests: DataFrame, as_of: Column) -> DataFrame:
    """Per request ``ok`` and ``reason``.

    Reasons in order: ``period`` (a bound <= 0 or NULL), ``order`` (period1 >=
    period2), ``interval`` (not a known interval), ``lookback`` (for ``1m`` the
    span of the request is limited, for the others period1 must not be older
    than the interval allows, counted back from ``as_of``).  The limits table
    is fixed at 12 rows, so it is broadcast.
    """
    limits = F.broadcast(interval_limits(requests.sparkSession)).withColumnRenamed("interval", "_iv")
    j = requests.join(limits, requests["interval"] == limits["_iv"], "left")
    p1, p2 = F.col("period1"), F.col("period2")
    reason = (
        F.when(p1.isNull() | p2.isNull() | (p1 <= 0) | (p2 <= 0), "period")
        .when(p1 >= p2, "order")
        .when(F.col("_iv").isNull(), "interval")
        .when(F.when(F.col("_iv") == SPAN_LIMITED, p2 - p1).otherwise(as_of - p1) > F.col("max_lookback"), "lookback")
    )
    out = j.withColumn("reason", reason).drop("_iv", "max_lookback")
    return out.withColumn("ok", F.col("reason").isNull())


def conform_prices(bars: DataFrame) -> DataFrame:
    """Bars shaped as the prices table, with ``ok``/``reason`` per row.

    Rules: symbol not NULL and at most 8 characters, tstamp not NULL and within
    INT, volume within INT.  Out-of-range integers are NULL in the typed
    columns and the row is flagged rather than dropped.
    """
    ts, vol, sym = F.col("tstamp"), F.col("volume"), F.col("symbol")
    has_adj = "adj_close" in bars.columns
    reason = (
        F.when(sym.isNull(), "symbol null")
        .when(F.length(sym) > SYMBOL_MAX_LEN, "symbol too long")
        .when(ts.isNull(), "tstamp null")
        .when((ts < INT_MIN) | (ts > INT_MAX), "tstamp out of range")
        .when((vol < INT_MIN) | (vol > INT_MAX), "volume out of range")
    )
    return bars.select(
        F.when((ts >= INT_MIN) & (ts <= INT_MAX), ts.cast("int")).alias("tstamp"),
        sym.alias("symbol"),
        F.col("open").cast("double").alias("open"),
        F.col("high").cast("double").alias("high"),
        F.col("low").cast("double").alias("low"),
        F.col("close").cast("double").alias("close"),
        (F.col("adj_close") if has_adj else F.lit(None)).cast("double").alias("adj_close"),
        F.when((vol >= INT_MIN) & (vol <= INT_MAX), vol.cast("int")).alias("volume"),
        reason.alias("reason"),
    ).withColumn("ok", F.col("reason").isNull())
