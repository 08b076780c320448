"""End-to-end batch job: landed payloads -> indicator table -> alert events.

The source application's batch load for one symbol, as one Spark job over
many symbols: status gate and parser dispatch, gap fill, EMA, SMA, a
partitioned write, and alert events emitted only after the write succeeded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from candela.operators import notify, series
from candela.sources import payloads as pl
from candela.sources import sinks
from candela.schemas import DEFAULT_SPAN
from candela.session import ensure_checkpoint_dir
from candela.streaming.events import write_event_batch


def load_prices(
    landed: DataFrame,
    out_path: str,
    *,
    span: int = DEFAULT_SPAN,
    quarantine_path: str | None = None,
    events_path: str | None = None,
    events_format: str = "parquet",
    alert_to: str | None = None,
) -> DataFrame:
    """Run the load and return the written indicator table (read back).

    ``landed``: ``(symbol, status, api_version, body)``.  Rejected responses go
    to ``quarantine_path`` when given.  With ``alert_to`` and ``events_path``,
    close/SMA crossings become notification events after the table is written.
    Each path belongs to this load: a rerun replaces what the run before wrote.
    The responses are parsed once, into a checkpoint that both outputs read.
    """
    ensure_checkpoint_dir(landed.sparkSession)
    bars, rejected = pl.split_classified(pl.classify(landed).checkpoint(eager=True))
    if quarantine_path:
        rejected.write.mode("overwrite").parquet(quarantine_path)
    table = series.load_symbol_chain(bars.drop("adj_close"), span=span)
    sinks.write_partitioned(table, out_path)
    written = sinks.read_partitioned(landed.sparkSession, out_path, schema=table.schema)
    if alert_to and events_path:
        alerts = notify.crossover_alerts(written, span=span, sma=f"sma_{span}d")
        wire = notify.encode_events(notify.alert_events(alerts, alert_to), key_col="symbol")
        write_event_batch(wire, fmt=events_format, path=events_path, mode="overwrite")
    return written
