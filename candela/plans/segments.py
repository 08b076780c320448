"""Skew-safe windows over ordered series: equal-depth segments with an exact halo.

``Window.partitionBy(symbol).orderBy(tstamp)`` sends a whole series to one
task.  ``split`` cuts every long series into segments of about ``target_rows``
rows, and copies the ``halo`` rows just before a segment into it as context,
so a window partitioned by (keys, segment) sees what it needs and holds a
bounded number of rows whatever the distribution of keys and stamps:

* ``cuts`` first counts the rows of each series, a partial aggregate by key.
  Only series of more than ``target_rows`` rows are looked at again; where
  there is none, those scans are dropped at run time.  Their quantiles (a
  sketch, exact to ``1/ACCURACY`` of the length) cut a series of n rows into
  ``min(ceil(n / target_rows), MAX_SEGMENTS)`` segments by rank, so neither a
  stray stamp nor a burst makes a segment larger.  A segment holds at most
  ``max(target_rows, n / MAX_SEGMENTS)`` rows and a tenth more, and its halo.
* The cuts are at most ``rows / target_rows``, the ranges of stamps made of
  them at most six times as many (and halos); that bound is why both may be
  broadcast.  A row finds its segments by an equi-join on (series, bin): bins
  of equal width between the first cut and the last, a few for each cut.  No
  row carries the list of cuts, so a row costs the same however many there
  are.  Short series are one segment, by the same plan.
* A segment's halo starts at the ``halo``-th stamp before the cut: of the rows
  that the sketch says lie close before a cut, the last ``halo`` are kept,
  each task dropping all but its own last ones before the shuffle.

The rows then shuffle once, by (keys, segment).  Halo copies carry
``HALO = true``; callers drop them after their windows.  Everything is
DataFrame API: no job while a plan is built, no collect, no UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Names with this prefix are the package's own; inputs that use it are refused.
PREFIX = "__cd_"
SEG = PREFIX + "seg"
HALO = PREFIX + "halo"
FIRST = PREFIX + "first"
CUTS, STARTS = PREFIX + "cuts", PREFIX + "starts"
#: Columns of ranges of stamps, and of the bins by which rows find them.
_CUT, _START, _END, _BIN = (PREFIX + x for x in ("cut", "start", "end", "bin"))
_SCALE = _LOW, _HIGH, _WIDTH, _TOP = [PREFIX + x for x in ("low", "high", "width", "top")]

TARGET_ROWS = 1 << 20
MAX_SEGMENTS = 512
GRID = 2048
ACCURACY = 20_000
#: Bins for each cut between the first cut of a series and the last.
BINS = 4
_LOWEST = -(2**63)


def q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def refuse_own_names(df: DataFrame, more: Sequence[str] = ()) -> None:
    """Raise where a column would be overwritten by a column of the package."""
    taken = [c for c in df.columns if c.lower().startswith(PREFIX) or c.lower() in {m.lower() for m in more}]
    if taken:
        raise ValueError(f"columns with reserved names: {taken}")


def non_finite(col: str) -> tuple[Column, Column, Column]:
    """Whether a value is NaN, +inf, -inf (false where it is NULL)."""
    c = F.col(q(col)).cast("double")
    inf = float("inf")
    return tuple(F.coalesce(x, F.lit(False)) for x in (F.isnan(c) & c.isNotNull(), c == F.lit(inf), c == F.lit(-inf)))


def key_names(keys: Sequence[str]) -> list[str]:
    """Names of the keys in the tables of this module."""
    return [f"{PREFIX}k{i}" for i in range(len(keys))]


def same_keys(keys: Sequence[str]) -> Column:
    """Rows of one series: the caller's keys against those of a table of this module, nulls being equal."""
    same = F.lit(True)
    for k, name in zip(keys, key_names(keys)):
        same = same & F.col(q(k)).eqNullSafe(F.col(name))
    return same


def _scaled(found: DataFrame) -> DataFrame:
    """Adds the first and the last cut of each series, the width of its bins and the highest of them between these."""
    low, high, top = F.element_at(CUTS, 1), F.element_at(CUTS, -1), F.size(CUTS) * BINS
    width = (high.cast("double") - low.cast("double")) / top
    return found.withColumns({_LOW: low, _HIGH: high, _WIDTH: F.when(width > 0, width).otherwise(1.0), _TOP: top})


def _bin(stamp: Column) -> Column:
    """The bin of a stamp, rising with it: one below the first cut, one from the last on, equal widths between."""
    between = F.least(F.floor((stamp.cast("double") - F.col(_LOW).cast("double")) / F.col(_WIDTH)).cast("int"), F.col(_TOP))
    return F.coalesce(F.when(stamp < F.col(_LOW), F.lit(-1)).when(stamp >= F.col(_HIGH), F.col(_TOP) + 1).otherwise(between), F.lit(0))


def _binned(ranges: DataFrame) -> DataFrame:
    """Ranges ``[_START, _END)`` of stamps (no end: all from there on), one row for each bin that they reach."""
    end = F.when(F.col(_END).isNull(), F.col(_TOP) + 1).otherwise(_bin(F.col(_END)))
    first = _bin(F.col(_START))
    return ranges.withColumn(_BIN, F.explode(F.sequence(first, F.greatest(first, end)))).drop(*_SCALE)


def _in_ranges(rows: DataFrame, series: DataFrame, ranges: DataFrame, left: Sequence[Column], own: Sequence[str], stamp: Column, how: str) -> DataFrame:
    """Rows with the columns of their series and of every range that their stamp lies in: two broadcast joins, by series and by (series, bin)."""
    at_series, at_range = (other.select(*[F.col(o).alias(o + suffix) for o in own], *[c for c in other.columns if c not in own]) for other, suffix in ((series, "_"), (ranges, "__")))
    same = F.lit(True)
    for x, o in zip(left, own):
        same = same & x.eqNullSafe(F.col(o + "_"))
    out = rows.join(F.broadcast(at_series), same, how)
    here = F.col(_BIN) == F.col(PREFIX + "own_bin")
    for x, o in zip(left, own):
        here = here & x.eqNullSafe(F.col(o + "__"))
    out = out.withColumn(PREFIX + "own_bin", _bin(stamp))
    return out.join(F.broadcast(at_range), here & (stamp >= F.col(_START)) & (F.col(_END).isNull() | (stamp < F.col(_END))), how)


def cuts(df: DataFrame, keys: Sequence[str], order: str, *, halo: int, target_rows: int = TARGET_ROWS) -> DataFrame:
    """One row per series longer than ``target_rows``: ``key_names``, its cuts, the start of each later segment's halo, its first stamp."""
    own, at, n = key_names(keys), PREFIX + "at", PREFIX + "rows"
    stamps = df.select(*[F.col(q(k)).alias(o) for k, o in zip(keys, own)], F.col(q(order)).cast("long").alias(at))
    long = stamps.groupBy(*own).agg(F.count(F.lit(1)).alias(n), F.min(at).alias(FIRST)).where(F.col(n) > int(target_rows))

    def of_long(other: DataFrame) -> DataFrame:
        """The stamps of long series, with the columns of a table that has a row for each of them."""
        right = other.select(*[F.col(o).alias(f"{o}_") for o in own], *[c for c in other.columns if c not in own])
        same = F.lit(True)
        for o in own:
            same = same & F.col(o).eqNullSafe(F.col(f"{o}_"))
        return stamps.join(F.broadcast(right), same).drop(*[f"{o}_" for o in own])

    # one literal, not thousands
    grid = F.split(F.lit(",".join(str(i / GRID) for i in range(1, GRID))), ",").cast("array<double>")
    sketch = of_long(long).groupBy(*own, n, FIRST).agg(F.percentile_approx(at, grid, ACCURACY).alias("grid"))
    pieces = F.least(F.ceil(F.col(n) / int(target_rows)), F.lit(MAX_SEGMENTS))
    # the i-th of s cuts is the quantile i / s
    places = F.transform(F.sequence(F.lit(1), (pieces - 1).cast("int")), lambda i: F.element_at("grid", F.greatest(F.lit(1), F.floor(i * GRID / pieces)).cast("int")))
    cut = sketch.withColumn(CUTS, F.array_distinct(places))
    if not halo:
        return cut.select(*own, CUTS, F.col(CUTS).alias(STARTS), FIRST)
    # grid steps that hold the halo, and two more for the error of both ends
    back = F.ceil(F.lit(float(halo)) * GRID / F.col(n) + 2 * GRID / ACCURACY).cast("int") + 1

    def near(c: Column) -> Column:
        below = F.size(F.filter("grid", lambda x: x < c))
        return F.when(below - back >= 1, F.try_element_at("grid", F.greatest(below - back, F.lit(1)))).otherwise(F.lit(_LOWEST))

    stretches = cut.select(*own, FIRST, CUTS, F.transform(CUTS, near).alias("near"))
    scaled = _scaled(stretches)
    # the cuts that a row lies close before: those above it whose stretch it has reached
    each = scaled.select(*own, *_SCALE, F.explode(F.arrays_zip(F.col("near").alias(_START), F.col(CUTS).alias(_END))).alias("x"))
    ranges = _binned(each.select(*own, *_SCALE, f"x.{_START}", f"x.{_END}").where(F.col(_END).isNotNull()))
    close = _in_ranges(stamps, scaled.select(*own, *_SCALE), ranges, [F.col(o) for o in own], own, F.col(at), "inner")
    before = close.select(*own, at, F.col(_END).alias("cut"))
    last = Window.partitionBy(*own, "cut").orderBy(F.desc(at))
    kept = before.withColumn("r", F.row_number().over(last)).where(F.col("r") <= int(halo))
    start = F.when(F.count(F.lit(1)) >= int(halo), F.min(at)).otherwise(F.lit(_LOWEST))
    found = kept.groupBy(*own, "cut").agg(start.alias("start")).groupBy(*own).agg(F.map_from_entries(F.collect_list(F.struct("cut", "start"))).alias("exact"))
    right = found.select(*[F.col(o).alias(f"{o}_") for o in own], "exact")
    same = F.lit(True)
    for o in own:
        same = same & F.col(o).eqNullSafe(F.col(f"{o}_"))
    # a cut with no stamp before it has only rows without one there
    starts = F.transform(CUTS, lambda c: F.coalesce(F.try_element_at("exact", c), F.lit(_LOWEST)))
    return stretches.join(F.broadcast(right), same, "left").select(*own, CUTS, starts.alias(STARTS), FIRST)


def split(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    halo: int = 1,
    target_rows: int = TARGET_ROWS,
    found: DataFrame | None = None,
    only_cut: bool = False,
) -> DataFrame:
    """Rows with their segment ``SEG``, and halo copies in later segments.

    Adds ``SEG``, ``HALO`` and ``FIRST`` (first stamp of a series that is cut).
    ``order`` must be an integer column.  Rows without a stamp come first, in
    the first segment.  ``found``: the table of ``cuts``, where the caller has
    it already.  ``only_cut``: only the series that are cut.
    """
    refuse_own_names(df)
    if found is None:
        found = cuts(df, keys, order, halo=halo, target_rows=target_rows)
    stamp = F.coalesce(F.col(q(order)).cast("long"), F.lit(_LOWEST))

    own = key_names(keys)
    scaled = _scaled(found)
    # segment i: from its halo's start up to the next cut
    each = scaled.select(*own, CUTS, STARTS, *_SCALE, F.posexplode(F.concat(F.array(F.lit(_LOWEST)), CUTS)).alias(SEG, _CUT)).where(F.col(_CUT).isNotNull())
    start = F.when(F.col(SEG) == 0, F.lit(_LOWEST)).otherwise(F.try_element_at(STARTS, F.greatest(SEG, F.lit(1))))
    ranges = _binned(each.withColumns({_START: start, _END: F.try_element_at(CUTS, F.col(SEG) + 1)}).drop(CUTS, STARTS))
    how = "inner" if only_cut else "left"
    spread = _in_ranges(df, scaled.select(*own, FIRST, *_SCALE), ranges, [F.col(q(k)) for k in keys], own, stamp, how)
    return spread.select(
        *[F.col(q(c)) for c in df.columns], FIRST, F.coalesce(SEG, F.lit(0)).alias(SEG), F.coalesce(stamp < F.col(_CUT), F.lit(False)).alias(HALO),
    )


def ema_block(span: int) -> int:
    """Values over which the weight falls to 1e-300."""
    b = 1.0 - 2.0 / (span + 1)
    return 1 << 30 if b <= 0.0 else max(1, values(b, 300.0) - 2)


def values(b: float, decades: float) -> int:
    """Values after which a weight that falls by ``b`` each time is below ten to minus ``decades``."""
    from math import ceil, log

    return int(ceil(decades * log(10.0) / -log(b))) + 1
