"""Schemas and fixed values shared by the whole package."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source application's for equal results)
# ---------------------------------------------------------------------------
# Bars column order: tstamp, high, low, open, close, volume.
# One day in seconds; the gap threshold of the midpoint fill.
DAY_SECONDS = 86400
# Default indicator span, in rows.
DEFAULT_SPAN = 10
# Rounding of landed prices: 3 places for the JSON chart payload (v8),
# 4 places for the CSV download payload (v7).
V8_ROUND = 3
V7_ROUND = 4
# Recipient address pattern.
EMAIL_PATTERN = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
# Notification defaults.
DEFAULT_SUBJECT = "(no subject)"
DEFAULT_CONTENT = "(no content)"
# Interval -> longest allowed look-back in seconds (None = no known limit);
# the one interval whose limit is on the length of the request instead.
SPAN_LIMITED = "1m"
SEVEN_DAYS = 604800
SIXTY_DAYS = 5184000
INTERVAL_LIMITS = {
    "1m": SEVEN_DAYS,
    "2m": SIXTY_DAYS,
    "5m": SIXTY_DAYS,
    "15m": SIXTY_DAYS,
    "30m": SIXTY_DAYS,
    "90m": SIXTY_DAYS,
    "1h": 730 * DAY_SECONDS,
    "1d": None,
    "5d": None,
    "1wk": None,
    "1mo": None,
    "3mo": None,
}
# Prices table: symbol is VARCHAR(8).
SYMBOL_MAX_LEN = 8
# ---------------------------------------------------------------------------

PRICE_COLS = ["high", "low", "open", "close"]
BAR_COLS = ["tstamp", "high", "low", "open", "close", "volume"]

BARS = T.StructType(
    [
        T.StructField("tstamp", T.LongType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
    ]
)

SYMBOL_BARS = T.StructType([T.StructField("symbol", T.StringType())] + BARS.fields)

# v7 CSV payload: Date, Open, High, Low, Close, Adj Close, Volume (this order).
V7_CSV_DDL = (
    "Date STRING, Open DOUBLE, High DOUBLE, Low DOUBLE, Close DOUBLE, "
    "`Adj Close` DOUBLE, Volume DOUBLE, malformed STRING"
)
V7_HEADER = "Date,Open,High,Low,Close,Adj Close,Volume"

QUOTE_DDL = (
    "high ARRAY<DOUBLE>, low ARRAY<DOUBLE>, open ARRAY<DOUBLE>, "
    "close ARRAY<DOUBLE>, volume ARRAY<BIGINT>"
)

# v8 chart payload: chart.result[] -> timestamp[], indicators.quote[]; the body itself where it does not fit.
CHART_DDL = (
    "chart STRUCT<result: ARRAY<STRUCT<"
    "timestamp: ARRAY<BIGINT>, "
    f"indicators: STRUCT<quote: ARRAY<STRUCT<{QUOTE_DDL}>>>>>, "
    "error STRUCT<code: STRING, description: STRING>>, "
    "malformed STRING"
)

# Landed payload table: one API response per row.
PAYLOADS = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("api_version", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)

# Notification event on the wire.
EVENT_WIRE = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())]
)
