"""Notifications: recipient validation, the outbox, and indicator alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.functions.codec import json_bytes_to_map, map_to_json_bytes
from candela.functions.text import email_domain, email_reason, email_user
from candela.operators import series
from candela.plans import segments as seg
from candela.schemas import DEFAULT_CONTENT, DEFAULT_SUBJECT, DEFAULT_SPAN


def validate_recipients(df: DataFrame, col: str = "email") -> DataFrame:
    """Adds ``valid``, ``reason`` (null/blank/pattern), ``user_name`` and ``domain``."""
    reason = email_reason(col)
    return df.select(
        "*",
        reason.isNull().alias("valid"),
        reason.alias("reason"),
        F.when(reason.isNull(), email_user(col)).alias("user_name"),
        F.when(reason.isNull(), email_domain(col)).alias("domain"),
    )


def split_recipients(df: DataFrame, col: str = "email") -> tuple[DataFrame, DataFrame]:
    """(valid rows with user_name/domain, invalid rows with reason)."""
    v = validate_recipients(df, col)
    return (
        v.filter("valid").drop("valid", "reason"),
        v.filter(~F.col("valid")).drop("valid", "user_name", "domain"),
    )


# A whitespace-separated token holding an "@": the same tokens as splitting on
# whitespace and keeping those with "@", without generating every word first.
# Starts only where a token starts and never goes back, so its time is linear.
AT_TOKEN = r"(?<!\S)[^\s@]*+@\S*"


def address_tokens(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Whitespace tokens of whole texts that contain ``@``: candidate recipients."""
    found = F.regexp_extract_all(F.col(text_col), F.lit(AT_TOKEN), 0)
    return docs.select(id_col, F.explode(found).alias("email"))


def addressed(events: DataFrame, map_col: str = "m") -> DataFrame:
    """Event maps with ``to``, ``subject``, ``content`` (defaults filled in) and ``rejected``.

    ``rejected`` is NULL for mail that can go out, ``undecodable`` where the
    event has no map, else the reason against the recipient.
    """
    m = F.col(map_col)
    mail = events.select(
        "*",
        m["to"].alias("to"),
        F.coalesce(m["subject"], F.lit(DEFAULT_SUBJECT)).alias("subject"),
        F.coalesce(m["content"], F.lit(DEFAULT_CONTENT)).alias("content"),
    )
    reason = F.concat(F.lit("recipient "), email_reason("to"))
    return mail.withColumn("rejected", F.when(m.isNull(), F.lit("undecodable")).otherwise(reason))


def outbox(events: DataFrame, map_col: str = "m") -> DataFrame:
    """Event maps -> ``(to, subject, content)`` with defaults; valid recipients only."""
    return addressed(events, map_col).filter(F.col("rejected").isNull()).drop("rejected")


def rejects(events: DataFrame, map_col: str = "m") -> DataFrame:
    """The events that ``outbox`` leaves out, with the reason in ``rejected``."""
    return addressed(events, map_col).filter(F.col("rejected").isNotNull()).drop("to", "subject", "content")


def decode_events(wire: DataFrame, value_col: str = "value") -> DataFrame:
    """Wire events (binary JSON ``value``) -> ``m map<string,string>``."""
    return wire.withColumn("m", json_bytes_to_map(value_col))


def encode_events(df: DataFrame, map_col: str = "m", key_col: str | None = None) -> DataFrame:
    """Maps -> wire rows ``(key string, value binary)``."""
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    return df.select(key.alias("key"), map_to_json_bytes(map_col).alias("value"))


def crossover_alerts(
    bars: DataFrame,
    keys: Sequence[str] = ("symbol",),
    span: int = DEFAULT_SPAN,
    places: int = 4,
    target_rows: int = seg.TARGET_ROWS,
    sma: str | None = None,
) -> DataFrame:
    """Rows where ``close`` crosses its SMA: the sign of ``close - sma`` differs from the last one that was not 0.

    Rows without a close, and rows on the SMA, are no crossing and are passed
    over; the first row of a series that has a sign (not the first row of all,
    whose SMA is its own close) only sets it.  The SMA is rounded to ``places``
    before the sign so that the result does not hinge on the last bits of a
    mean.  ``direction`` is ``up`` or ``down``.  ``sma``: a column that already
    holds the SMA.
    """
    name = f"sma_{span}d"
    s = bars if sma else series.indicators(bars, keys, sma_spans=[span], target_rows=target_rows)
    mean = F.round(F.col(seg.q(sma or name)), places)
    sign = F.signum(F.col("close") - mean)
    plain = [F.col(seg.q(k)) for k in keys]
    own = s.select(*plain, "tstamp", "close", mean.alias(name), F.when(sign != 0, sign).alias("_sign"))
    # among rows with a sign, the row before holds the last sign
    split = seg.split(own.filter(F.col("_sign").isNotNull()), keys, "tstamp", halo=1, target_rows=target_rows)
    w = Window.partitionBy(*[seg.q(k) for k in keys], seg.SEG).orderBy("tstamp")
    hit = split.withColumn("_was", F.lag("_sign").over(w)).filter(~F.col(seg.HALO) & (F.col("_sign") != F.col("_was")))
    return hit.select(*plain, "tstamp", "close", name, F.when(F.col("_sign") > 0, "up").otherwise("down").alias("direction"))


def alert_events(alerts: DataFrame, to: str, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Alerts -> notification maps addressed to ``to``."""
    subject = F.concat_ws(" ", *[F.col(k) for k in keys], F.lit("crossed"), F.col("direction"))
    content = F.concat_ws(" ", F.lit("tstamp"), F.col("tstamp").cast("string"), F.lit("close"), F.col("close").cast("string"))
    return alerts.select(
        "*", F.create_map(F.lit("to"), F.lit(to), F.lit("subject"), subject, F.lit("content"), content).alias("m")
    )
