"""Benchmark: headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR.

Prints one JSON line: {"metric", "value" (sum of query seconds), "unit",
"queries": {name: seconds}, "sf", ...}.  Each query runs to completion through
a ``noop`` write (every row produced, nothing collected); the best of
$BENCH_REPEAT (default 3) runs counts, after one warm-up of the JVM.

``comparison`` (outside the total) times the source's EMA method, a fold over
each row's full prefix list, against the linear form, both in the gap-fill ->
EMA -> SMA chain over the same bars.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from candela.operators import notify, quality, series  # noqa: E402
from candela.plans import catalog  # noqa: E402
from candela.plans.adapters import lineitem_bars, orders_bars  # noqa: E402
from candela.session import local_session  # noqa: E402

HEADLINE = [
    "load_symbol_large",
    "load_symbol_hot",
    "indicator_set_large",
    "payload_v8_bars",
    "payload_v7_bars",
    "metadata_flatten",
    "recipient_validation",
    "check_chronology",
    "request_batch_scan",
]

UNIVERSE_SYMBOLS, UNIVERSE_BARS = 503, 6300


def universe_bars(spark):
    """Daily bars of the stated universe; every 50th day is missing."""
    rows = spark.range(UNIVERSE_SYMBOLS * UNIVERSE_BARS).select(
        F.concat(F.lit("S"), (F.col("id") % UNIVERSE_SYMBOLS).cast("string")).alias("symbol"),
        F.floor(F.col("id") / UNIVERSE_SYMBOLS).alias("day"),
    )
    price = 100 + 10 * F.sin(F.col("day") / 50) + F.pmod(F.xxhash64("symbol", "day"), F.lit(1000)) / 500
    bars = rows.filter("day % 50 != 7").select("symbol", (F.lit(915148800) + F.col("day") * 86400).alias("tstamp"), price.alias("close"))
    return bars.select(
        "symbol", "tstamp", (F.col("close") + 1).alias("high"), (F.col("close") - 1).alias("low"), F.col("close").alias("open"), "close",
        F.lit(1000).cast("long").alias("volume"),
    )


def large():
    """Series operators over the bars of all suppliers, and the chain over the stated universe."""
    return {
        "interpolate_large": lambda spark, sf: series.interpolate(lineitem_bars(spark, sf)),
        "ema_10_large": lambda spark, sf: series.ema(lineitem_bars(spark, sf)),
        "sma_10_large": lambda spark, sf: series.sma(lineitem_bars(spark, sf)),
        "gap_diff_large": lambda spark, sf: series.gap_diff(lineitem_bars(spark, sf)),
        "alert_crossover_large": lambda spark, sf: notify.crossover_alerts(lineitem_bars(spark, sf)),
        "missing_timestamps_large": lambda spark, sf: quality.missing_stamps(lineitem_bars(spark, sf)),
        "load_universe": lambda spark, sf: series.load_symbol_chain(universe_bars(spark)),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="candela-bench", scratch=tempfile.mkdtemp(prefix="candela-bench-"))
    qs = catalog.queries() | large()
    # warm-up: JVM code paths and parquet footers
    qs["load_symbol"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in [*HEADLINE, *large()]:
        best = None
        try:
            for _ in range(repeat):
                t0 = time.perf_counter()
                qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                best = dt if best is None else min(best, dt)
            times[name] = round(best, 3)
        except Exception as exc:  # noqa: BLE001 - report, keep the one JSON line
            errors[name] = str(exc).splitlines()[0][:300]
    # over each row's full prefix list, one window over the whole series)
    # against the linear form, on the same gap-filled bars.
    comparison: dict[str, float] = {}
    bars = orders_bars(spark, sf_dir)
    forms = {
        "chain_prefix_list_fold": lambda: series.sma_plain_window(
            series.ema_list_fold(series.interpolate(bars), ["symbol"], 10), ["symbol"], 10
        ),
        "chain_linear": lambda: series.load_symbol_chain(bars),
    }
    for name, build in forms.items():
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        comparison[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "comparison": comparison,
                **({"errors": errors} if errors else {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
