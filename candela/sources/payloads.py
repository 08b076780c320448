"""Landed API payloads -> typed bars.

Input is a table of responses ``(symbol, status, api_version, body)``; the
HTTP client itself is out of scope (any fetcher can land this table).  All
parsing runs on executors with ``from_json`` / ``from_csv`` / generators; no
driver-side parsing, no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.functions.numeric import round_half_up
from candela.schemas import CHART_DDL, V7_CSV_DDL, V7_HEADER, V7_ROUND, V8_ROUND

KNOWN_VERSIONS = ("v7", "v8")


def _bar(tstamp: Column, high: Column, low: Column, open_: Column, close: Column,
         adj_close: Column, volume: Column, places: int) -> Column:
    """One bar struct, prices rounded; the same type for both payload versions."""
    return F.struct(
        tstamp.cast("long").alias("tstamp"),
        round_half_up(high.cast("double"), places).alias("high"),
        round_half_up(low.cast("double"), places).alias("low"),
        round_half_up(open_.cast("double"), places).alias("open"),
        round_half_up(close.cast("double"), places).alias("close"),
        round_half_up(adj_close.cast("double"), places).alias("adj_close"),
        volume.try_cast("long").alias("volume"),
    )


def _wild(c: Column) -> Column:
    """A number that is not finite; NULL is none."""
    return c.isNotNull() & (F.isnan(c) | (F.abs(c) == float("inf")))


def v8_rows(chart: Column, places: int = V8_ROUND) -> Column:
    """Parsed chart payload -> array of bar structs.

    One row per entry of each result's ``timestamp`` array, for every quote of
    that result; a price array shorter than ``timestamp`` reads as NULL there.
    """

    def per_result(r: Column) -> Column:
        ts = r["timestamp"]
        n = F.coalesce(F.size(ts), F.lit(0))
        idx = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))

        def per_quote(q: Column) -> Column:
            return F.transform(
                idx,
                lambda i: _bar(
                    F.try_element_at(ts, i),
                    F.try_element_at(q["high"], i),
                    F.try_element_at(q["low"], i),
                    F.try_element_at(q["open"], i),
                    F.try_element_at(q["close"], i),
                    F.lit(None),
                    F.try_element_at(q["volume"], i),
                    places,
                ),
            )

        return F.flatten(F.transform(F.coalesce(r["indicators"]["quote"], F.array()), per_quote))

    return F.flatten(F.transform(F.coalesce(chart["chart"]["result"], F.array()), per_result))


def v7_lines(body: Column) -> Column:
    """CSV download payload -> array of parsed lines, without the header and blank lines.

    Cells are read with a fixed 7-column schema (``null`` cells are NULL);
    ``malformed`` holds the line where cells are missing, too many or no number.
    """
    lines = F.split(body, "\r?\n")
    data = F.filter(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(1))), lambda line: F.trim(line) != "")
    options = {"nullValue": "null", "columnNameOfCorruptRecord": "malformed"}
    return F.transform(data, lambda line: F.from_csv(line, V7_CSV_DDL, options))


def _v7_day(cell: Column) -> Column:
    return F.try_to_date(cell["Date"], "yyyy-MM-dd")


def v7_fault(body: Column, cells: Column) -> Column:
    """What is wrong with a CSV payload, or NULL."""
    prices = ("Open", "High", "Low", "Close", "Adj Close")

    def no_number(c: Column) -> Column:
        wild = _wild(c["Volume"]) | (F.abs(c["Volume"]) >= 2.0**63)
        for p in prices:
            wild = wild | _wild(c[p])
        return F.coalesce(wild, F.lit(False))

    header = F.regexp_replace(F.element_at(F.split(body, "\r?\n"), 1), "^\ufeff", "")
    return (
        F.when(body.isNull() | ~header.eqNullSafe(F.lit(V7_HEADER)), F.lit("malformed body: header"))
        .when(F.exists(cells, lambda c: c.isNull() | c["malformed"].isNotNull()), F.lit("malformed body: cell"))
        .when(F.exists(cells, no_number), F.lit("malformed body: cell"))
        .when(F.exists(cells, lambda c: _v7_day(c).isNull()), F.lit("malformed body: date"))
    )


def v7_rows(cells: Column, places: int = V7_ROUND) -> Column:
    """Parsed lines -> array of bar structs (with ``adj_close``): numbers rounded, ``Date`` (UTC) in epoch seconds."""

    def per_line(c: Column) -> Column:
        tstamp = F.unix_date(_v7_day(c)).cast("long") * 86400
        return _bar(tstamp, c["High"], c["Low"], c["Open"], c["Close"], c["Adj Close"],
                    round_half_up(c["Volume"], places), places)

    return F.transform(cells, per_line)


def v8_fault(chart: Column) -> Column:
    """What is wrong with a chart payload, or NULL.

    Every result must have its ``timestamp`` (none of them null) and at least
    one quote, no price or volume beyond the last stamp, and finite numbers
    only.  Prices that are missing at the end are NULL, as ``null`` is.
    """
    result = chart["chart"]["result"]
    quotes = lambda r: r["indicators"]["quote"]
    arrays = ("high", "low", "open", "close", "volume")

    def too_long(r: Column) -> Column:
        n = F.size(r["timestamp"])
        return F.exists(quotes(r), lambda q: F.greatest(*[F.coalesce(F.size(q[a]), F.lit(0)) for a in arrays]) > n)

    def wild(r: Column) -> Column:
        some = lambda q: F.array(*[F.coalesce(F.exists(q[a], _wild), F.lit(False)) for a in arrays[:4]])
        return F.exists(quotes(r), lambda q: F.array_contains(some(q), True))

    def lacks(r: Column) -> Column:
        no_quote = quotes(r).isNull() | (F.size(quotes(r)) <= 0) | F.exists(quotes(r), lambda q: q.isNull())
        return r.isNull() | r["timestamp"].isNull() | F.exists(r["timestamp"], lambda t: t.isNull()) | no_quote

    def any_(what) -> Column:
        return F.coalesce(F.exists(result, lambda r: F.coalesce(what(r), F.lit(False))), F.lit(False))

    error = chart["chart"]["error"]
    told = F.concat_ws(": ", F.lit("api error"), error["code"], error["description"])
    return (
        F.when(chart.isNull() | chart["malformed"].isNotNull(), F.lit("malformed body"))
        .when(error.isNotNull(), told)
        .when(result.isNull() | (F.size(result) <= 0), F.lit("malformed body: no result"))
        .when(any_(lacks), F.lit("malformed body: no timestamp or quote"))
        .when(any_(too_long), F.lit("malformed body: more prices than timestamps"))
        .when(any_(wild), F.lit("malformed body: number"))
    )


def _parsed(payloads: DataFrame) -> DataFrame:
    """Adds ``_ver``, ``_chart`` (v8) and ``_cells`` (v7); every body is parsed once, where its version says so."""
    own = payloads.withColumn("_ver", F.lower(F.col("api_version")))
    chart = F.from_json("body", CHART_DDL, {"columnNameOfCorruptRecord": "malformed"})
    return own.withColumns(
        {"_chart": F.when(F.col("_ver") == "v8", chart), "_cells": F.when(F.col("_ver") == "v7", v7_lines(F.col("body")))}
    )


def classify(payloads: DataFrame) -> DataFrame:
    """Adds ``reason`` (NULL when the response is usable) and ``_bars``.

    Reasons: ``status <code>`` (anything but 200), ``unsupported api version``
    (the parser is chosen by ``lower(api_version)``), ``malformed body`` with
    what is wrong (any cell that is no finite number or no whole number of a
    long, a date that is none, missing cells, a wrong header, a body without
    a result, or a result without its stamps or quotes), ``api error`` with the
    error a chart body tells.
    """
    ver = F.col("_ver")
    status = F.coalesce(F.col("status").cast("string"), F.lit("null"))
    reason = (
        F.when(~F.coalesce(F.col("status") == 200, F.lit(False)), F.concat(F.lit("status "), status))
        .when(~F.coalesce(ver.isin(*KNOWN_VERSIONS), F.lit(False)), F.lit("unsupported api version"))
        .when(ver == "v8", v8_fault(F.col("_chart")))
        .when(ver == "v7", v7_fault(F.col("body"), F.col("_cells")))
    )
    rows = F.when(ver == "v8", v8_rows(F.col("_chart"))).when(ver == "v7", v7_rows(F.col("_cells")))
    # a generator, so that a filter on the reason is not pushed below it and parses nothing again
    both = F.array(F.struct(reason.alias("reason"), rows.alias("_bars")))
    return _parsed(payloads).select(*payloads.columns, F.inline(both))


def split_classified(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bars, quarantine) of a classified table.

    Bars carry ``adj_close`` (NULL for v8); the quarantine keeps the response
    columns plus ``reason``.
    """
    bars = classified.filter(F.col("reason").isNull()).select("symbol", F.inline("_bars"))
    return bars, classified.filter(F.col("reason").isNotNull()).drop("_bars")


def dispatch(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Status gate and per-version parsing: returns (bars, quarantine).

    Each output reads the landed table once; to write both, store ``classify``'s
    result and use ``split_classified``.
    """
    return split_classified(classify(payloads))


def parse_v8(payloads: DataFrame) -> DataFrame:
    """Usable JSON chart payloads -> bars ``(symbol, tstamp, high, low, open, close, volume)``."""
    return dispatch(payloads.withColumn("api_version", F.lit("v8")))[0].drop("adj_close")


def parse_v7(payloads: DataFrame) -> DataFrame:
    """Usable CSV download payloads -> bars with ``adj_close``."""
    out = dispatch(payloads.withColumn("api_version", F.lit("v7")))[0]
    return out.select("symbol", "tstamp", "high", "low", "open", "close", "adj_close", "volume")
