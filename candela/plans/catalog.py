"""Registered queries: one Spark job per operator, each with DuckDB oracle SQL.

Every query reads the driver's tables (whole) or data Spark derives from them.
Indicator columns are rounded to 4 places in both forms so that last-bit
differences between summation orders do not show.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.functions.codec import json_bytes_to_map, map_to_json_bytes
from candela.functions.numeric import round_half_up
from candela.operators import calendar, notify, quality, series
from candela.plans import incremental, jobs
from candela.plans.adapters import (
    HOT_BARS_SQL,
    LINEITEM_BARS_SQL,
    ORDERS_BARS_SQL,
    VIEWS,
    epoch_seconds,
    hot_bars,
    lineitem_bars,
    orders_bars,
    table,
    uneven,
    v7_payloads,
    v8_payloads,
)
from candela.schemas import EVENT_WIRE, PAYLOADS
from candela.session import ensure_checkpoint_dir
from candela.sources import merge, metadata, payloads, scans, sinks
from candela.streaming import events as streams
from candela.streaming import landing

QueryFn = Callable[[SparkSession, str], DataFrame]

RANGE_SYMBOL = "3-MEDIUM"
RANGE_P1 = 820454400  # 1996-01-01
RANGE_P2 = 852076800  # 1997-01-01
RANGE_DAYS = ("1996-01-01", "1997-01-01")
FUTURE_AS_OF = "2024-01-25 00:00:00"
HOT_MAX_GAP = 86400 * 10000
REQUEST_AS_OF = 1706745600  # 2024-02-01
REQUEST_INTERVALS = ["1m", "2m", "5m", "15m", "30m", "90m", "1h", "1d", "5d", "1wk", "1mo", "3mo", "2h"]

_EMA_SQL = (
    "list_reduce(list(\"close\") OVER (PARTITION BY symbol ORDER BY tstamp "
    "ROWS BETWEEN {rows} PRECEDING AND CURRENT ROW), "
    "lambda p, c: {a} * c + (1 - {a}) * p, 0.0::DOUBLE)"
)
# Older values weigh less than 1e-34 at span 10: below the last bit of the sum.
_EMA_400 = _EMA_SQL.format(a="(2.0 / 11)", rows="400")
# Sum the frame front to back, as Spark's sliding row frame does, then divide
# by the count: same additions in the same order, so the same bits.
_SMA_FRAME = "OVER (PARTITION BY symbol ORDER BY tstamp ROWS BETWEEN {p} PRECEDING AND CURRENT ROW)"
_SMA_SQL = (
    'list_reduce(list("close") ' + _SMA_FRAME + ', lambda x, y: x + y) / count("close") ' + _SMA_FRAME
)


def _ema_sql(span: int) -> str:
    return _EMA_SQL.format(a=f"(2.0 / {span + 1})", rows="UNBOUNDED")


def _sma_sql(span: int) -> str:
    return _SMA_SQL.replace("{p}", str(span - 1))


def _r4(df: DataFrame, *cols: str) -> DataFrame:
    """Indicators to 4 places by ``floor(x*1e4 + 0.5)/1e4``.

    Spark's ``round`` goes half-up on the decimal form of a double while DuckDB
    rounds the binary value, so the two differ on exact ties (an SMA over 40
    two-decimal prices can end in 5 at the fifth place).  This form is the
    same IEEE arithmetic in both engines.
    """
    return df.withColumns({c: F.floor(F.col(c) * 10000 + 0.5) / 10000 for c in cols})


def _q4(expr: str) -> str:
    return f"floor(({expr}) * 10000 + 0.5) / 10000"


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/candela-{name}-{uuid.uuid4().hex[:12]}"


# ---------------------------------------------------------------------------
# series
# ---------------------------------------------------------------------------


def q_load_symbol(spark: SparkSession, sf: str) -> DataFrame:
    return _r4(series.load_symbol_chain(orders_bars(spark, sf)), "ema_10d", "sma_10d")


def q_load_symbol_large(spark: SparkSession, sf: str) -> DataFrame:
    return _r4(series.load_symbol_chain(lineitem_bars(spark, sf)), "ema_10d", "sma_10d")


def _filled_sql(bars_sql: str, max_gap: int = 86400) -> str:
    return f"""
WITH bars AS ({bars_sql}),
prev AS (
  SELECT *, lag(tstamp) OVER w AS p_t, lag(high) OVER w AS p_h, lag(low) OVER w AS p_l,
         lag("open") OVER w AS p_o, lag("close") OVER w AS p_c
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY tstamp)),
filled AS (
  SELECT symbol, tstamp, high, low, "open", "close", volume FROM prev
  UNION ALL
  SELECT symbol, p_t + (tstamp - p_t) // 2, (high + p_h) / 2, (low + p_l) / 2,
         ("open" + p_o) / 2, ("close" + p_c) / 2, CAST(0 AS BIGINT)
  FROM prev WHERE tstamp - p_t > {max_gap})
"""


def _chain_sql(bars_sql: str, max_gap: int = 86400, ema: str | None = None) -> str:
    return (
        _filled_sql(bars_sql, max_gap)
        + f"""
SELECT symbol, tstamp, high, low, "open", "close", volume,
       {_q4(ema or _ema_sql(10))} AS ema_10d,
       {_q4(_sma_sql(10))} AS sma_10d
FROM filled
"""
    )


def q_interpolate(spark: SparkSession, sf: str) -> DataFrame:
    return series.interpolate(orders_bars(spark, sf))


def q_gap_diff(spark: SparkSession, sf: str) -> DataFrame:
    g = series.gap_diff(orders_bars(spark, sf))
    return g.select("symbol", "tstamp", "prev_tstamp", "diff", "is_gap", "prev_close", "prev_volume")


def _q_sma(span: int) -> QueryFn:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _r4(series.sma(orders_bars(spark, sf), span=span), f"sma_{span}d")

    return run


def _q_ema(span: int) -> QueryFn:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _r4(series.ema(orders_bars(spark, sf), span=span), f"ema_{span}d")

    return run


HOT_TARGET_ROWS = 1 << 12


def q_load_symbol_hot(spark: SparkSession, sf: str) -> DataFrame:
    """The chain over a table where one series holds half of all rows.

    Segments of 2^12 rows cut the hot series into many at every scale here.
    """
    out = series.load_symbol_chain(hot_bars(spark, sf), max_gap=HOT_MAX_GAP, target_rows=HOT_TARGET_ROWS, in_steps=True)
    return _r4(out, "ema_10d", "sma_10d")


def q_indicator_set(spark: SparkSession, sf: str) -> DataFrame:
    out = series.indicators(lineitem_bars(spark, sf), ema_spans=[3, 50], sma_spans=[3, 50])
    return _r4(out, "ema_3d", "ema_50d", "sma_3d", "sma_50d")


def q_running_close(spark: SparkSession, sf: str) -> DataFrame:
    return series.running_close(orders_bars(spark, sf)).select(
        "symbol", "tstamp", "close", "n_closes", "first_close", "last_close"
    )


# ---------------------------------------------------------------------------
# scans
# ---------------------------------------------------------------------------


def q_symbol_range_scan(spark: SparkSession, sf: str) -> DataFrame:
    return scans.symbol_range_scan(orders_bars(spark, sf, RANGE_DAYS), RANGE_SYMBOL, RANGE_P1, RANGE_P2)


def _requests(bars: DataFrame) -> DataFrame:
    """One request per (symbol, year): the first half of that year."""
    year = F.year(F.date_from_unix_date(F.floor(F.col("tstamp") / 86400).cast("int")))
    ys = bars.select("symbol", year.alias("y")).distinct()
    jan = F.unix_seconds(F.make_timestamp(F.col("y"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0), F.lit("UTC")))
    jul = F.unix_seconds(F.make_timestamp(F.col("y"), F.lit(7), F.lit(1), F.lit(0), F.lit(0), F.lit(0), F.lit("UTC")))
    return ys.select(
        F.concat_ws("-", "symbol", F.col("y").cast("string")).alias("request_id"),
        "symbol",
        jan.alias("period1"),
        jul.alias("period2"),
    )


def q_request_batch_scan(spark: SparkSession, sf: str) -> DataFrame:
    bars = orders_bars(spark, sf)
    return scans.request_scan(bars, _requests(bars)).select(
        "request_id", "symbol", "tstamp", "high", "low", "open", "close", "volume"
    )


def q_request_batch_scan_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    bars = orders_bars(spark, sf)
    return scans.request_scan(bars, _requests(bars), target_rows=64).select(
        "request_id", "symbol", "tstamp", "high", "low", "open", "close", "volume"
    )


_REQUEST_SQL = f"""
WITH bars AS ({ORDERS_BARS_SQL}),
ys AS (SELECT DISTINCT symbol, year(epoch_ms(tstamp * 1000)) AS y FROM bars),
req AS (SELECT symbol || '-' || CAST(y AS VARCHAR) AS request_id, symbol,
               CAST(epoch(make_timestamp(y, 1, 1, 0, 0, 0)) AS BIGINT) AS period1,
               CAST(epoch(make_timestamp(y, 7, 1, 0, 0, 0)) AS BIGINT) AS period2 FROM ys)
SELECT r.request_id, b.symbol, b.tstamp, b.high, b.low, b."open", b."close", b.volume
FROM bars b JOIN req r ON b.symbol = r.symbol AND b.tstamp >= r.period1 AND b.tstamp < r.period2
"""


def q_date_to_epoch(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    parsed = F.to_date(day, "yyyy-MM-dd")
    return o.select(
        "o_orderkey",
        day.alias("day"),
        (F.datediff(parsed, F.lit("1970-01-01").cast("date")).cast("long") * 86400).alias("tstamp"),
        epoch_seconds("o_orderdate").alias("ts_seconds"),
    )


def q_bars_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = _scratch(spark, "bars-csv")
    orders_bars(spark, sf).write.option("header", True).csv(path)
    return scans.read_bars_csv(spark, path, with_symbol=True)


def q_symbol_universe(spark: SparkSession, sf: str) -> DataFrame:
    """Symbols of the bars written as the source's symbol list (``SYM,`` per
    line) and read back through the universe reader."""
    path = _scratch(spark, "symbols")
    syms = orders_bars(spark, sf).select("symbol").distinct()
    syms.select(F.concat("symbol", F.lit(",")).alias("line")).write.text(path)
    return scans.read_symbols_csv(spark, path)


def q_symbol_universe_json(spark: SparkSession, sf: str) -> DataFrame:
    """Symbols of the bars written as one JSON document and read back through the universe reader."""
    path = _scratch(spark, "symbols-json")
    syms = orders_bars(spark, sf).select("symbol").distinct()
    syms.agg(F.collect_set("symbol").alias("symbols")).coalesce(1).write.json(path)
    return scans.read_symbols_json(spark, path)


def q_empty_bars(spark: SparkSession, sf: str) -> DataFrame:
    """The typed empty frame, as the start of a union with the bars."""
    return scans.empty_bars(spark).unionByName(orders_bars(spark, sf))


def q_write_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Write bars partitioned by symbol, overwrite one symbol again, read back."""
    bars = orders_bars(spark, sf)
    path = _scratch(spark, "bars-parquet")
    sinks.write_partitioned(bars, path)
    sinks.write_partitioned(bars.filter(F.col("symbol") == RANGE_SYMBOL), path)
    back = sinks.read_partitioned(spark, path, schema=bars.schema)
    return back.select("symbol", "tstamp", "high", "low", "open", "close", "volume")


# ---------------------------------------------------------------------------
# payloads and metadata
# ---------------------------------------------------------------------------


def q_payload_v8(spark: SparkSession, sf: str) -> DataFrame:
    return payloads.parse_v8(v8_payloads(uneven(orders_bars(spark, sf))))


def q_payload_v7(spark: SparkSession, sf: str) -> DataFrame:
    return payloads.parse_v7(v7_payloads(uneven(orders_bars(spark, sf))))


def _mixed_payloads(bars: DataFrame) -> DataFrame:
    """v8 for three symbols (of which one says v9), v7 for all others; status 404 for 1998; broken bodies for 1993 to 1996.

    The broken ones: a v7 page of HTML, a v7 cell that is no number, a v8 error
    body, and a v8 body that breaks off.
    """
    is_v8 = F.coalesce(F.col("symbol").isin("1-URGENT", "2-HIGH", "5-LOW"), F.lit(False))
    v8 = v8_payloads(bars.filter(is_v8))
    v8 = v8.withColumn("api_version", F.when(F.col("symbol") == "5-LOW", "v9").otherwise("V8"))
    year = F.year(F.timestamp_seconds(F.get_json_object("body", "$.chart.result[0].timestamp[0]").cast("long")))
    v8 = v8.withColumn("year", year).withColumn(
        "body",
        F.when(F.col("year") == 1995, '{"chart":{"result":null,"error":{"code":"Not Found","description":"No data"}}}')
        .when(F.col("year") == 1996, F.expr("left(body, length(body) - 9)"))
        .otherwise(F.col("body")),
    )
    v7 = v7_payloads(bars.filter(~is_v8)).withColumn("year", F.split_part("body", F.lit("\n"), F.lit(2)).substr(1, 4).cast("int"))
    v7 = v7.withColumn(
        "body",
        F.when(F.col("year") == 1993, "<html><body>Bad gateway</body></html>")
        .when(F.col("year") == 1994, F.concat("body", F.lit("\n1994-12-31,1.0,2.0,abc,1.5,1.5,7")))
        .otherwise(F.col("body")),
    )
    return v8.unionByName(v7).withColumn("status", F.when(F.col("year") == 1998, 404).otherwise(200)).drop("year")


def q_payload_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    bars, _ = payloads.dispatch(_mixed_payloads(uneven(orders_bars(spark, sf))))
    return bars.select("symbol", "tstamp", "high", "low", "open", "close", "adj_close", "volume")


def q_payload_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = payloads.dispatch(_mixed_payloads(uneven(orders_bars(spark, sf))))
    return bad.groupBy("symbol", "reason").agg(F.count(F.lit(1)).alias("responses"))


def q_metadata_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return metadata.flatten_json(table(spark, sf, "events"), "props", ["event_id"])


def q_metadata_malformed(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected documents by reason, of event properties of which some are cut off, turned into arrays or missing."""
    props = F.when(F.col("event_id") % 10 == 3, F.expr("left(props, length(props) - 1)"))
    props = props.when(F.col("event_id") % 10 == 4, F.concat(F.lit("["), "props", F.lit("]"))).when(F.col("event_id") % 10 != 5, F.col("props"))
    broken = table(spark, sf, "events").select("event_id", props.alias("props"))
    return metadata.malformed_json(broken, "props", ["event_id"]).groupBy("reason").agg(F.count(F.lit(1)).alias("documents"))


def q_payload_meta_flatten(spark: SparkSession, sf: str) -> DataFrame:
    p = v8_payloads(orders_bars(spark, sf))
    meta = p.select(
        F.concat_ws("-", "symbol", F.get_json_object("body", "$.chart.result[0].timestamp[0]")).alias("payload_id"),
        F.get_json_object("body", "$.chart.result[0].meta").alias("meta"),
    )
    return metadata.flatten_json(meta, "meta", ["payload_id"])


def q_round_half_up(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        round_half_up(F.col("o_totalprice") / 7, 3).alias("p3"),
        round_half_up(F.col("o_totalprice") / 7, 4).alias("p4"),
    )


# ---------------------------------------------------------------------------
# notifications
# ---------------------------------------------------------------------------


def q_event_map_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    m = F.create_map(F.lit("event_type"), F.col("event_type"), F.lit("props"), F.col("props"))
    wire = e.select("event_id", map_to_json_bytes(m).alias("value"))
    back = wire.select("event_id", F.col("value").cast("string").alias("wire"), json_bytes_to_map("value").alias("m"))
    return back.select(
        "event_id", "wire", F.col("m")["event_type"].alias("event_type"), F.col("m")["props"].alias("props"),
        F.size("m").alias("n_keys"),
    )


def q_recipient_validation(spark: SparkSession, sf: str) -> DataFrame:
    toks = notify.address_tokens(table(spark, sf, "documents"))
    return notify.validate_recipients(toks, "email")


def _doc_events(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    found = F.regexp_extract_all(F.col("text"), F.lit(notify.AT_TOKEN), 0)
    toks = d.select("doc_id", "lang", "source", F.explode(found).alias("email"))
    subject = F.when(F.col("lang") == "en", F.concat(F.lit("doc "), F.col("doc_id").cast("string")))
    m = F.create_map(
        F.lit("to"), F.col("email"), F.lit("subject"), subject, F.lit("content"), F.col("source"),
        F.lit("doc_id"), F.col("doc_id").cast("string"),
    )
    return toks.select("doc_id", m.alias("m"))


def q_notification_outbox(spark: SparkSession, sf: str) -> DataFrame:
    return notify.outbox(_doc_events(spark, sf)).select("doc_id", "to", "subject", "content")


def q_event_stream_outbox(spark: SparkSession, sf: str) -> DataFrame:
    topic = _scratch(spark, "topic")
    notify.encode_events(_doc_events(spark, sf)).write.parquet(topic)
    out = streams.run_outbox(spark, topic, _scratch(spark, "outbox"), _scratch(spark, "outbox-ckpt"), carry=["doc_id"])
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "to", "subject", "content")


def q_event_stream_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Wire events through the streaming sink into files, read back and decoded."""
    topic, sink = _scratch(spark, "sink-topic"), _scratch(spark, "sink")
    notify.encode_events(_doc_events(spark, sf)).write.parquet(topic)
    wire = streams.read_event_stream(spark, fmt="parquet", path=topic)
    streams.write_event_stream(wire, _scratch(spark, "sink-ckpt"), fmt="parquet", path=sink, available_now=True).awaitTermination()
    back = notify.decode_events(spark.read.schema(EVENT_WIRE).parquet(sink))
    return back.select(F.col("m")["doc_id"].cast("long").alias("doc_id"), F.col("m")["to"].alias("to"), F.col("m")["content"].alias("content"))


def q_event_stream_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected events of the stream by reason; the event of every tenth document breaks off."""
    topic, bad = _scratch(spark, "rejects-topic"), _scratch(spark, "rejects")
    wire = notify.encode_events(_doc_events(spark, sf), key_col="doc_id")
    cut = F.col("value").cast("string")
    wire.withColumn(
        "value", F.when(F.col("key").cast("long") % 10 == 0, F.expr("left(cast(value as string), 9)")).otherwise(cut).cast("binary")
    ).write.parquet(topic)
    streams.run_outbox(spark, topic, _scratch(spark, "rejects-outbox"), _scratch(spark, "rejects-ckpt"), rejected_path=bad)
    return streams.read_batches(spark, bad, streams.REJECTED).groupBy("rejected").agg(F.count(F.lit(1)).alias("events"))


_OUTBOX_SQL = r"""
WITH tok AS (SELECT doc_id, lang, source, unnest(regexp_split_to_array(text, '\s+')) AS email FROM documents)
SELECT doc_id, email AS "to",
       coalesce(CASE WHEN lang = 'en' THEN 'doc ' || CAST(doc_id AS VARCHAR) END, '(no subject)') AS subject,
       coalesce(source, '(no content)') AS content
FROM tok
WHERE email LIKE '%@%' AND email IS NOT NULL AND NOT regexp_full_match(email, '[\x00-\x20]*')
  AND regexp_full_match(email, '^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$')
"""


def q_alert_crossover(spark: SparkSession, sf: str) -> DataFrame:
    return notify.crossover_alerts(orders_bars(spark, sf))


ALERT_TO = "alerts@example.com"


def q_alert_outbox(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts -> event maps -> wire bytes -> decoded -> outbox rows."""
    alerts = notify.crossover_alerts(orders_bars(spark, sf))
    wire = notify.encode_events(notify.alert_events(alerts, ALERT_TO), key_col="symbol")
    mail = notify.outbox(notify.decode_events(wire))
    return mail.select(F.col("key").alias("symbol"), "to", "subject", "content")


def q_recipient_split(spark: SparkSession, sf: str) -> DataFrame:
    valid, _ = notify.split_recipients(notify.address_tokens(table(spark, sf, "documents")))
    return valid


def q_batch_load(spark: SparkSession, sf: str) -> DataFrame:
    landed = v8_payloads(orders_bars(spark, sf))
    out = jobs.load_prices(
        landed,
        _scratch(spark, "prices"),
        quarantine_path=_scratch(spark, "quarantine"),
        events_path=_scratch(spark, "alert-events"),
        alert_to=ALERT_TO,
    )
    return _r4(out.select("symbol", "tstamp", "high", "low", "open", "close", "volume", "ema_10d", "sma_10d"),
               "ema_10d", "sma_10d")


# ---------------------------------------------------------------------------
# quality
# ---------------------------------------------------------------------------


def q_merge_batches(spark: SparkSession, sf: str) -> DataFrame:
    """A late and an overlapping batch merged by (symbol, tstamp): the newest reading of each bar stays."""
    path = _scratch(spark, "merged")
    bars = orders_bars(spark, sf).withColumn("seen", F.lit(2).cast("long"))
    third = F.pmod(F.floor(F.col("tstamp") / 86400), F.lit(3))
    first = bars.where(third != 0).withColumns({"close": F.col("close") + 1, "seen": F.lit(1).cast("long")})
    for batch in (first, bars.where(third < 2)):
        merge.merge(batch, path, version="seen")
    return merge.read_merged(spark, path, bars.schema)


#: First days of the second and third batch of the incremental load.
BATCH_STARTS = ("1994-06-01", "1997-01-01")


def q_incremental_load(spark: SparkSession, sf: str) -> DataFrame:
    """Bars loaded in three batches, each from the state that the one before left."""
    root = _scratch(spark, "incremental")
    days = ("0001-01-01", *BATCH_STARTS, "9999-12-31")
    for i, (first, end) in enumerate(zip(days, days[1:])):
        incremental.load_batch(orders_bars(spark, sf, (first, end)), root, i)
    return _r4(incremental.read_all(spark, root, "rows"), "ema_10d", "sma_10d")


def q_landing_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Responses of the orders' bars that land in files, some of them twice and some rejected, as a merged table of bars."""
    landed = v8_payloads(orders_bars(spark, sf)).withColumn("part", F.pmod(F.xxhash64("symbol"), F.lit(4)))
    again = landed.where("part < 2")
    wrong = landed.where("part = 3").withColumns({"status": F.lit(500), "body": F.lit("{}")})
    source, root = _scratch(spark, "landing"), _scratch(spark, "landed")
    for i, rows in enumerate((landed.where("part < 3"), again, wrong, landed.where("part = 3"))):
        rows.select(*PAYLOADS.fieldNames()).coalesce(1).write.parquet(f"{source}/at={i}")
    return landing.run_landing(spark, f"{source}/*", root, _scratch(spark, "landing-ckpt"))


def q_missing_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    return quality.missing_stamps(orders_bars(spark, sf))


def _order_days(spark: SparkSession, sf: str) -> DataFrame:
    """An irregular calendar: every day that has an order."""
    return table(spark, sf, "orders").select(epoch_seconds("o_orderdate").alias("tstamp"))


def q_missing_on_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.missing_on_calendar(orders_bars(spark, sf), _order_days(spark, sf))


def q_completeness_on_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.check_completeness_on(lineitem_bars(spark, sf), _order_days(spark, sf))


_ON_CALENDAR_SQL = """
WITH bars AS ({bars}),
cal AS (SELECT DISTINCT CAST(epoch(o_orderdate) AS BIGINT) // 86400 AS slot FROM orders),
have AS (SELECT DISTINCT symbol, tstamp // 86400 AS slot FROM bars),
ends AS (SELECT symbol, min(slot) AS lo, max(slot) AS hi FROM have GROUP BY symbol),
want AS (SELECT symbol, slot FROM ends JOIN cal ON slot BETWEEN lo AND hi)
"""


def q_check_chronology(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return quality.check_chronology(e, "event_id", "ts")


def q_check_future(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return quality.check_future(e, "ts", F.lit(FUTURE_AS_OF).cast("timestamp_ntz"))


def q_check_completeness(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_completeness(orders_bars(spark, sf))


def q_check_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_bar_values(lineitem_bars(spark, sf))


def _event_requests(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    ivs = F.array(*[F.lit(i) for i in REQUEST_INTERVALS])
    ts = epoch_seconds("ts")
    return e.select(
        "event_id",
        F.col("event_type").alias("symbol"),
        (ts - F.col("user_id") * 3600 * 24).alias("period1"),
        ts.alias("period2"),
        F.element_at(ivs, (F.col("event_id") % len(REQUEST_INTERVALS) + 1).cast("int")).alias("interval"),
    )


def q_check_requests(spark: SparkSession, sf: str) -> DataFrame:
    return quality.validate_requests(_event_requests(spark, sf), F.lit(REQUEST_AS_OF)).select(
        "event_id", "symbol", "period1", "period2", "interval", "ok", "reason"
    )


def q_check_keys(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_type", epoch_seconds("ts").alias("second"))
    a = quality.check_keys(e, ["event_type", "second"]).withColumn("subject", F.lit("events"))
    b = quality.check_keys(orders_bars(spark, sf), ["symbol", "tstamp"]).withColumn("subject", F.lit("bars"))
    return a.unionByName(b)


def q_conform_prices(spark: SparkSession, sf: str) -> DataFrame:
    return quality.conform_prices(orders_bars(spark, sf))


# ---------------------------------------------------------------------------
# registry
# ---------------------------------------------------------------------------


def _bars_sql_with(extra: str, bars_sql: str = ORDERS_BARS_SQL) -> str:
    return f"WITH bars AS ({bars_sql}) {extra}"


def queries() -> dict[str, QueryFn]:
    q: dict[str, QueryFn] = {
        "load_symbol": q_load_symbol,
        "load_symbol_large": q_load_symbol_large,
        "load_symbol_hot": q_load_symbol_hot,
        "interpolate_midpoint": q_interpolate,
        "gap_diff": q_gap_diff,
        "sma_3": _q_sma(3),
        "sma_10": _q_sma(10),
        "sma_50": _q_sma(50),
        "ema_1": _q_ema(1),
        "ema_3": _q_ema(3),
        "ema_10": _q_ema(10),
        "ema_50": _q_ema(50),
        "indicator_set_large": q_indicator_set,
        "running_close_list": q_running_close,
        "symbol_range_scan": q_symbol_range_scan,
        "request_batch_scan": q_request_batch_scan,
        "request_batch_scan_bucketed": q_request_batch_scan_bucketed,
        "date_to_epoch": q_date_to_epoch,
        "bars_csv": q_bars_csv,
        "symbol_universe": q_symbol_universe,
        "symbol_universe_json": q_symbol_universe_json,
        "empty_bars": q_empty_bars,
        "write_overwrite_roundtrip": q_write_overwrite,
        "payload_v8_bars": q_payload_v8,
        "payload_v7_bars": q_payload_v7,
        "payload_dispatch": q_payload_dispatch,
        "payload_quarantine": q_payload_quarantine,
        "metadata_flatten": q_metadata_flatten,
        "metadata_malformed": q_metadata_malformed,
        "payload_meta_flatten": q_payload_meta_flatten,
        "round_half_up": q_round_half_up,
        "event_map_roundtrip": q_event_map_roundtrip,
        "recipient_validation": q_recipient_validation,
        "notification_outbox": q_notification_outbox,
        "event_stream_outbox": q_event_stream_outbox,
        "event_stream_sink": q_event_stream_sink,
        "event_stream_rejects": q_event_stream_rejects,
        "alert_crossover": q_alert_crossover,
        "alert_outbox": q_alert_outbox,
        "recipient_split": q_recipient_split,
        "batch_load": q_batch_load,
        "missing_timestamps": q_missing_timestamps,
        "missing_on_calendar": q_missing_on_calendar,
        "completeness_on_calendar": q_completeness_on_calendar,
        "merge_batches": q_merge_batches,
        "incremental_load": q_incremental_load,
        "landing_stream": q_landing_stream,
        "check_chronology": q_check_chronology,
        "check_future": q_check_future,
        "check_completeness": q_check_completeness,
        "check_quality": q_check_quality,
        "check_requests": q_check_requests,
        "check_keys": q_check_keys,
        "conform_prices": q_conform_prices,
    }
    return q


def oracle_sql() -> dict[str, str]:
    bars_cols = 'symbol, tstamp, high, low, "open", "close", volume'
    s: dict[str, str] = {}
    s["load_symbol"] = _chain_sql(ORDERS_BARS_SQL)
    s["load_symbol_large"] = _chain_sql(LINEITEM_BARS_SQL)
    s["load_symbol_hot"] = _chain_sql(HOT_BARS_SQL, HOT_MAX_GAP, _EMA_400)
    s["interpolate_midpoint"] = _filled_sql(ORDERS_BARS_SQL) + "SELECT * FROM filled"
    s["gap_diff"] = _bars_sql_with(
        """
SELECT symbol, tstamp, lag(tstamp) OVER w AS prev_tstamp, tstamp - lag(tstamp) OVER w AS diff,
       coalesce(tstamp - lag(tstamp) OVER w > 86400, false) AS is_gap,
       lag("close") OVER w AS prev_close, lag(volume) OVER w AS prev_volume
FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY tstamp)"""
    )
    for span in (3, 10, 50):
        s[f"sma_{span}"] = _bars_sql_with(f"SELECT {bars_cols}, {_q4(_sma_sql(span))} AS sma_{span}d FROM bars")
    for span in (1, 3, 10, 50):
        s[f"ema_{span}"] = _bars_sql_with(f"SELECT {bars_cols}, {_q4(_ema_sql(span))} AS ema_{span}d FROM bars")
    s["indicator_set_large"] = _bars_sql_with(
        f"""SELECT {bars_cols}, {_q4(_ema_sql(3))} AS ema_3d, {_q4(_ema_sql(50))} AS ema_50d,
       {_q4(_sma_sql(3))} AS sma_3d, {_q4(_sma_sql(50))} AS sma_50d FROM bars""",
        LINEITEM_BARS_SQL,
    )
    s["running_close_list"] = _bars_sql_with(
        """
SELECT symbol, tstamp, "close",
       CAST(len(list("close") OVER w) AS BIGINT) AS n_closes,
       list("close") OVER w [1] AS first_close,
       list("close") OVER w [-1] AS last_close
FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY tstamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
    )
    s["symbol_range_scan"] = _bars_sql_with(
        f"SELECT * FROM bars WHERE symbol = '{RANGE_SYMBOL}' AND tstamp >= {RANGE_P1} AND tstamp < {RANGE_P2}"
    )
    s["request_batch_scan"] = _REQUEST_SQL
    s["request_batch_scan_bucketed"] = _REQUEST_SQL
    s["date_to_epoch"] = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
       CAST(epoch(CAST(o_orderdate AS DATE)) AS BIGINT) AS tstamp,
       CAST(floor(epoch(o_orderdate)) AS BIGINT) AS ts_seconds
FROM orders"""
    s["bars_csv"] = ORDERS_BARS_SQL
    s["symbol_universe"] = "SELECT DISTINCT o_orderpriority AS symbol FROM orders"
    s["symbol_universe_json"] = s["symbol_universe"]
    s["empty_bars"] = ORDERS_BARS_SQL
    s["write_overwrite_roundtrip"] = ORDERS_BARS_SQL
    s["payload_v8_bars"] = _bars_sql_with(
        'SELECT symbol, tstamp, round(high / 7, 3) AS high, round(low / 7, 3) AS low, round("open" / 7, 3) AS "open", '
        'round("close" / 7, 3) AS "close", volume FROM bars'
    )
    s["payload_v7_bars"] = _bars_sql_with(
        'SELECT symbol, (tstamp // 86400) * 86400 AS tstamp, round(high / 7, 4) AS high, '
        'round(low / 7, 4) AS low, round("open" / 7, 4) AS "open", round("close" / 7, 4) AS "close", '
        'round("close" / 7, 4) AS adj_close, volume FROM bars'
    )
    s["payload_dispatch"] = _bars_sql_with(
        """
, b AS (SELECT *, year(epoch_ms(tstamp * 1000)) AS y FROM bars)
SELECT symbol, tstamp, round(high / 7, 3) AS high, round(low / 7, 3) AS low, round("open" / 7, 3) AS "open",
       round("close" / 7, 3) AS "close", CAST(NULL AS DOUBLE) AS adj_close, volume
FROM b WHERE symbol IN ('1-URGENT', '2-HIGH') AND y NOT IN (1995, 1996, 1998)
UNION ALL
SELECT symbol, tstamp, round(high / 7, 4), round(low / 7, 4), round("open" / 7, 4), round("close" / 7, 4), round("close" / 7, 4), volume
FROM b WHERE (symbol IS NULL OR symbol NOT IN ('1-URGENT', '2-HIGH', '5-LOW')) AND y NOT IN (1993, 1994, 1998)"""
    )
    s["payload_quarantine"] = _bars_sql_with(
        """
SELECT symbol, CASE WHEN y = 1998 THEN 'status 404' WHEN symbol = '5-LOW' THEN 'unsupported api version'
            WHEN y = 1993 THEN 'malformed body: header' WHEN y = 1994 THEN 'malformed body: cell'
            WHEN y = 1995 THEN 'api error: Not Found: No data' ELSE 'malformed body' END AS reason,
       CAST(count(*) AS BIGINT) AS responses
FROM (SELECT DISTINCT symbol, year(epoch_ms(tstamp * 1000)) AS y FROM bars) t
WHERE y = 1998 OR symbol = '5-LOW' OR y IN (1995, 1996) AND symbol IN ('1-URGENT', '2-HIGH')
   OR y IN (1993, 1994) AND (symbol IS NULL OR symbol NOT IN ('1-URGENT', '2-HIGH'))
GROUP BY 1, 2"""
    )
    s["metadata_malformed"] = """
SELECT CASE event_id % 10 WHEN 3 THEN 'not json' WHEN 4 THEN 'not an object' ELSE 'null' END AS reason,
       CAST(count(*) AS BIGINT) AS documents
FROM events WHERE event_id % 10 IN (3, 4, 5) GROUP BY 1"""
    s["metadata_flatten"] = """
SELECT e.event_id, j.key AS path, j.atom::VARCHAR AS value,
       CASE WHEN j.type IN ('BIGINT', 'UBIGINT') THEN 'int' WHEN j.type = 'DOUBLE' THEN 'double'
            WHEN j.type = 'VARCHAR' THEN 'string' WHEN j.type = 'BOOLEAN' THEN 'boolean' END AS type
FROM events e, json_each(e.props) j
WHERE j.type IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'VARCHAR', 'BOOLEAN')"""
    ranges = ", ".join(f"('views[{i}]', '{r}', 'string')" for i, r in enumerate(VIEWS))
    s["payload_meta_flatten"] = _bars_sql_with(
        f"""
, p AS (SELECT symbol, min(tstamp) AS t0, max(tstamp) AS t1, arg_max("close", tstamp) AS last_close
        FROM bars GROUP BY symbol, year(epoch_ms(tstamp * 1000))),
leaf(path, value, type) AS (
  SELECT 'symbol', NULL, 'string' UNION ALL SELECT 'currency', 'USD', 'string'
  UNION ALL SELECT 'firstBar', NULL, 'int' UNION ALL SELECT 'extended', 'false', 'boolean'
  UNION ALL SELECT 'lastPrice', NULL, 'double'
  UNION ALL SELECT 'session.main.timezone', 'UTC', 'string'
  UNION ALL SELECT 'session.main.end', NULL, 'int'
  UNION ALL SELECT 'session.main.start', NULL, 'int'
  UNION ALL SELECT 'session.main.offset', '0', 'int'
  UNION ALL SELECT 'spacing', '1d', 'string'
  UNION ALL SELECT * FROM (VALUES {ranges}))
SELECT p.symbol || '-' || CAST(p.t0 AS VARCHAR) AS payload_id, l.path,
       CASE l.path WHEN 'symbol' THEN p.symbol WHEN 'firstBar' THEN CAST(p.t0 AS VARCHAR)
            WHEN 'lastPrice' THEN CAST(p.last_close AS VARCHAR)
            WHEN 'session.main.end' THEN CAST(p.t1 AS VARCHAR)
            WHEN 'session.main.start' THEN CAST(p.t0 AS VARCHAR)
            ELSE l.value END AS value,
       l.type
FROM p, leaf l"""
    )
    s["round_half_up"] = """
SELECT o_orderkey, round(o_totalprice / 7, 3) AS p3, round(o_totalprice / 7, 4) AS p4 FROM orders"""
    s["event_map_roundtrip"] = """
SELECT event_id, to_json(MAP {'event_type': event_type, 'props': props})::VARCHAR AS wire,
       event_type, props, CAST(2 AS INTEGER) AS n_keys
FROM events"""
    s["recipient_validation"] = r"""
WITH tok AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\s+')) AS email FROM documents),
v AS (SELECT doc_id, email,
        CASE WHEN email IS NULL THEN 'null' WHEN regexp_full_match(email, '[\x00-\x20]*') THEN 'blank'
             WHEN NOT regexp_full_match(email, '^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$') THEN 'pattern' END AS reason
      FROM tok WHERE email LIKE '%@%')
SELECT doc_id, email, reason IS NULL AS valid, reason,
       CASE WHEN reason IS NULL THEN split_part(email, '@', 1) END AS user_name,
       CASE WHEN reason IS NULL THEN substr(email, strpos(email, '@') + 1) END AS domain
FROM v"""
    s["notification_outbox"] = _OUTBOX_SQL
    s["event_stream_outbox"] = _OUTBOX_SQL
    s["event_stream_sink"] = r"""
SELECT doc_id, email AS "to", source AS content
FROM (SELECT doc_id, source, unnest(regexp_split_to_array(text, '\s+')) AS email FROM documents) t WHERE email LIKE '%@%'"""
    s["event_stream_rejects"] = r"""
WITH tok AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\s+')) AS email FROM documents)
SELECT CASE WHEN doc_id % 10 = 0 THEN 'undecodable' ELSE 'recipient pattern' END AS rejected, CAST(count(*) AS BIGINT) AS events
FROM tok WHERE email LIKE '%@%'
  AND (doc_id % 10 = 0 OR NOT regexp_full_match(email, '^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$'))
GROUP BY 1"""
    crossings = f"""
, s AS (SELECT symbol, tstamp, "close", round({_sma_sql(10)}, 4) AS sma_10d FROM bars),
g AS (SELECT *, sign("close" - sma_10d) AS sg FROM s WHERE sign("close" - sma_10d) <> 0),
h AS (SELECT *, lag(sg) OVER (PARTITION BY symbol ORDER BY tstamp) AS psg FROM g)
"""
    s["alert_crossover"] = _bars_sql_with(
        crossings
        + """SELECT symbol, tstamp, "close", sma_10d, CASE WHEN sg > psg THEN 'up' ELSE 'down' END AS direction
FROM h WHERE sg <> psg"""
    )
    s["alert_outbox"] = _bars_sql_with(
        crossings
        + f"""SELECT symbol, '{ALERT_TO}' AS "to",
       symbol || ' crossed ' || CASE WHEN sg > psg THEN 'up' ELSE 'down' END AS subject,
       'tstamp ' || CAST(tstamp AS VARCHAR) || ' close ' || CAST("close" AS VARCHAR) AS content
FROM h WHERE sg <> psg"""
    )
    s["recipient_split"] = r"""
WITH tok AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\s+')) AS email FROM documents)
SELECT doc_id, email, split_part(email, '@', 1) AS user_name, substr(email, strpos(email, '@') + 1) AS domain
FROM tok
WHERE email LIKE '%@%' AND NOT regexp_full_match(email, '[\x00-\x20]*')
  AND regexp_full_match(email, '^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$')"""
    s["batch_load"] = _chain_sql(ORDERS_BARS_SQL)
    s["missing_timestamps"] = _bars_sql_with(
        """
, span AS (SELECT symbol, min(tstamp) AS lo, max(tstamp) AS hi FROM bars GROUP BY symbol),
exp AS (SELECT symbol, unnest(generate_series(lo, hi, 86400)) AS tstamp FROM span)
SELECT symbol, tstamp FROM exp e
WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.symbol = e.symbol AND b.tstamp = e.tstamp)"""
    )
    s["missing_on_calendar"] = _ON_CALENDAR_SQL.format(bars=ORDERS_BARS_SQL) + "SELECT symbol, slot * 86400 AS tstamp FROM want ANTI JOIN have USING (symbol, slot)"
    s["completeness_on_calendar"] = _ON_CALENDAR_SQL.format(bars=LINEITEM_BARS_SQL) + """
SELECT symbol, CAST(count(*) AS BIGINT) AS expected, CAST(count(h.slot) AS BIGINT) AS present,
       CAST(count(*) - count(h.slot) AS BIGINT) AS missing, round(count(h.slot) / count(*), 6) AS coverage
FROM want LEFT JOIN have h USING (symbol, slot) GROUP BY symbol"""
    s["merge_batches"] = f"""
SELECT symbol, tstamp, high, low, "open", CASE WHEN tstamp // 86400 % 3 = 2 THEN "close" + 1 ELSE "close" END AS "close", volume,
       CAST(CASE WHEN tstamp // 86400 % 3 = 2 THEN 1 ELSE 2 END AS BIGINT) AS seen FROM ({ORDERS_BARS_SQL})"""
    s["incremental_load"] = _chain_sql(ORDERS_BARS_SQL)
    s["landing_stream"] = f"SELECT {bars_cols} FROM ({ORDERS_BARS_SQL})"
    s["check_chronology"] = """
SELECT 'chronology' AS rule, CAST(count(*) AS BIGINT) AS checked,
       CAST(coalesce(sum(CASE WHEN ts < p THEN 1 ELSE 0 END), 0) AS BIGINT) AS violations
FROM (SELECT ts, lag(ts) OVER (ORDER BY event_id) AS p FROM events) t"""
    s["check_future"] = f"""
SELECT 'future' AS rule, CAST(count(*) AS BIGINT) AS checked,
       CAST(coalesce(sum(CASE WHEN ts > TIMESTAMP '{FUTURE_AS_OF}' THEN 1 ELSE 0 END), 0) AS BIGINT) AS violations
FROM events"""
    s["check_completeness"] = _bars_sql_with(
        """
, span AS (SELECT symbol, min(tstamp) AS lo, max(tstamp) AS hi, count(*) AS present FROM bars GROUP BY symbol)
SELECT symbol, CAST((hi - lo) // 86400 + 1 AS BIGINT) AS expected, CAST(present AS BIGINT) AS present,
       CAST((hi - lo) // 86400 + 1 - present AS BIGINT) AS missing,
       round(present / ((hi - lo) // 86400 + 1), 6) AS coverage
FROM span"""
    )
    s["check_quality"] = _bars_sql_with(
        """
, r AS (SELECT
   CAST(count(*) AS BIGINT) AS checked,
   sum(CASE WHEN "open" IS NULL OR high IS NULL OR low IS NULL OR "close" IS NULL THEN 1 ELSE 0 END) AS null_price,
   sum(CASE WHEN low > high THEN 1 ELSE 0 END) AS low_above_high,
   sum(CASE WHEN "open" < low OR "open" > high THEN 1 ELSE 0 END) AS open_outside_range,
   sum(CASE WHEN "close" < low OR "close" > high THEN 1 ELSE 0 END) AS close_outside_range,
   sum(CASE WHEN volume < 0 THEN 1 ELSE 0 END) AS negative_volume
 FROM bars)
SELECT rule, checked, CAST(coalesce(v, 0) AS BIGINT) AS violations FROM r,
  (VALUES ('null_price'), ('low_above_high'), ('open_outside_range'), ('close_outside_range'), ('negative_volume')) t(rule),
  LATERAL (SELECT CASE rule WHEN 'null_price' THEN null_price WHEN 'low_above_high' THEN low_above_high
     WHEN 'open_outside_range' THEN open_outside_range WHEN 'close_outside_range' THEN close_outside_range
     ELSE negative_volume END AS v)""",
        LINEITEM_BARS_SQL,
    )
    ivs = ", ".join(f"'{i}'" for i in REQUEST_INTERVALS)
    s["check_requests"] = f"""
WITH req AS (
  SELECT event_id, event_type AS symbol, CAST(floor(epoch(ts)) AS BIGINT) - user_id * 86400 AS period1,
         CAST(floor(epoch(ts)) AS BIGINT) AS period2, [{ivs}][event_id % {len(REQUEST_INTERVALS)} + 1] AS interval
  FROM events),
lim(interval, max_lookback) AS (VALUES ('1m', 604800), ('2m', 5184000), ('5m', 5184000), ('15m', 5184000),
  ('30m', 5184000), ('90m', 5184000), ('1h', 63072000), ('1d', NULL), ('5d', NULL), ('1wk', NULL),
  ('1mo', NULL), ('3mo', NULL)),
j AS (SELECT r.*, l.interval AS known, l.max_lookback FROM req r LEFT JOIN lim l ON r.interval = l.interval),
v AS (SELECT *, CASE WHEN period1 IS NULL OR period2 IS NULL OR period1 <= 0 OR period2 <= 0 THEN 'period'
                     WHEN period1 >= period2 THEN 'order'
                     WHEN known IS NULL THEN 'interval'
                     WHEN CASE WHEN interval = '1m' THEN period2 - period1 ELSE {REQUEST_AS_OF} - period1 END > max_lookback THEN 'lookback' END AS reason
      FROM j)
SELECT event_id, symbol, period1, period2, interval, reason IS NULL AS ok, reason FROM v"""
    s["check_keys"] = _bars_sql_with(
        """
, ek AS (SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) AS s, count(*) AS n FROM events GROUP BY 1, 2),
bk AS (SELECT symbol, tstamp, count(*) AS n FROM bars GROUP BY 1, 2)
SELECT 'unique_key' AS rule, CAST(count(*) AS BIGINT) AS checked,
       CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS violations, 'events' AS subject FROM ek
UNION ALL
SELECT 'unique_key', CAST(count(*) AS BIGINT), CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT), 'bars' FROM bk"""
    )
    s["conform_prices"] = _bars_sql_with(
        """
SELECT CAST(tstamp AS INTEGER) AS tstamp, symbol, "open", high, low, "close", CAST(NULL AS DOUBLE) AS adj_close,
       CAST(volume AS INTEGER) AS volume,
       CASE WHEN symbol IS NULL THEN 'symbol null' WHEN length(symbol) > 8 THEN 'symbol too long'
            WHEN tstamp IS NULL THEN 'tstamp null' END AS reason,
       NOT (symbol IS NULL OR length(symbol) > 8 OR tstamp IS NULL) AS ok
FROM bars"""
    )
    return s
