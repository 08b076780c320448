"""Series operators on OHLCV bars: gap fill, SMA, EMA and their chain.

All functions are ``DataFrame -> DataFrame`` and take ``keys`` (the columns
naming one series, ``("symbol",)`` by default; ``()`` for a single series).
Rows are ordered by ``tstamp`` (epoch seconds, unique within a series).
Windows run over (keys, segment) with a halo (see ``candela.plans.segments``):
one shuffle of the rows, one plan at every size, no window over a whole long
series.  ``target_rows`` is the segment size aimed at.

An EMA needs no halo: over a segment of nn values it is the affine map
``out = b^nn * in + L``.  Of each segment of a series that is cut, one row
``(nn, L)`` is kept; composed in order they give the EMA with which every
segment begins, which is joined to its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.plans import segments as seg
from candela.plans.segments import HALO, PREFIX, SEG
from candela.schemas import BAR_COLS, DAY_SECONDS, DEFAULT_SPAN, PRICE_COLS
from candela.session import stored

_UNB = Window.unboundedPreceding
_CUR = Window.currentRow
_q = seg.q
_PREV = PREFIX + "prev_"


def _fill_nulls(df: DataFrame, fill: float | None) -> DataFrame:
    """Optional legacy behaviour: NULL prices read as ``fill`` and NULL volume as 0."""
    if fill is None:
        return df
    return df.withColumns(
        {
            **{c: F.coalesce(F.col(c), F.lit(float(fill))) for c in PRICE_COLS},
            "volume": F.coalesce(F.col("volume"), F.lit(0).cast("long")),
        }
    )


def _lagged(df: DataFrame, keys: Sequence[str], prefix: str, columns: Sequence[str] = BAR_COLS) -> DataFrame:
    """The bar columns (those in ``columns``) of the previous row of the series, NULL on its first."""
    w = Window.partitionBy(*[_q(k) for k in keys], SEG).orderBy("tstamp")
    return df.withColumns({f"{prefix}{c}": F.lag(F.col(c)).over(w) for c in BAR_COLS if c in columns})


def _expand(df: DataFrame, columns: Sequence[str], same: Sequence[str], max_gap: int) -> DataFrame:
    """Add one midpoint row before every row whose gap to its predecessor exceeds max_gap.

    Needs the previous bar columns.  Midpoint: tstamp ``prev + diff div 2``,
    prices the mean of both rows, volume 0.  Columns in ``same`` (the keys and
    the package's own) are copied from the current row onto the midpoint; other
    columns are NULL there.
    """
    diff = F.col("tstamp") - F.col(f"{_PREV}tstamp")
    types = dict(df.dtypes)
    real, mid = [], []
    # What is equal on both rows stays outside the generator, so the hash
    # partitioning on it survives (no new exchange).
    for c in columns:
        if c in same:
            continue
        real.append(F.col(_q(c)).alias(c))
        if c == "tstamp":
            m = F.col(f"{_PREV}tstamp") + F.expr(f"(tstamp - {_PREV}tstamp) div 2")
        elif c in PRICE_COLS:
            m = (F.col(c) + F.col(f"{_PREV}{c}")) / 2
        elif c == "volume":
            m = F.lit(0).cast("long")
        else:
            m = F.lit(None).cast(types[c])
        mid.append(m.alias(c))
    rows = F.when(diff > max_gap, F.array(F.struct(*mid), F.struct(*real))).otherwise(F.array(F.struct(*real)))
    return df.select(*[F.col(_q(c)) for c in same], F.inline(rows))


def interpolate(
    df: DataFrame,
    keys: Sequence[str] = ("symbol",),
    *,
    max_gap: int = DAY_SECONDS,
    null_fill: float | None = None,
    target_rows: int = seg.TARGET_ROWS,
) -> DataFrame:
    """Midpoint gap fill (one shuffle of the rows, by (keys, segment)).

    A row whose distance to the previous row of its series is strictly greater
    than ``max_gap`` gets one extra row at ``prev + diff div 2`` with averaged
    prices and volume 0.  The first row never gets one.  Keys are copied onto
    it, other columns are NULL there.
    """
    return indicators(df, keys, fill_gaps=True, max_gap=max_gap, null_fill=null_fill, target_rows=target_rows)


def gap_diff(
    df: DataFrame,
    keys: Sequence[str] = ("symbol",),
    *,
    max_gap: int = DAY_SECONDS,
    target_rows: int = seg.TARGET_ROWS,
) -> DataFrame:
    """Previous-row values, ``diff = tstamp - prev_tstamp`` and the gap flag."""
    seg.refuse_own_names(df, [*[f"prev_{c}" for c in BAR_COLS], "diff", "is_gap"])
    s = _lagged(seg.split(df, keys, "tstamp", target_rows=target_rows), keys, "prev_").filter(~F.col(HALO))
    return s.select(
        *[F.col(_q(c)) for c in df.columns],
        *[F.col(f"prev_{c}") for c in BAR_COLS],
        (F.col("tstamp") - F.col("prev_tstamp")).alias("diff"),
        F.coalesce(F.col("tstamp") - F.col("prev_tstamp") > max_gap, F.lit(False)).alias("is_gap"),
    )


#: Spans up to which a sliding frame is added up for every row.
SLIDING = 64
#: Partial sums of longer frames grow by this factor.
STEP = 8


def _smas(df: DataFrame, keys: Sequence[str], spans: Sequence[int], column: str) -> DataFrame:
    """SMA columns over the rows of each (keys, segment), ordered by tstamp; NULLs are skipped.

    A frame of more than ``SLIDING`` rows is put together from sums of 1, 8,
    64, ... consecutive rows, each made of eight of the size below it by lags:
    a row costs as many additions as the span has digits, nothing is taken
    away again, and all spans share the sums.
    """
    w = Window.partitionBy(*[_q(k) for k in keys], SEG).orderBy("tstamp")
    out = df.withColumns({f"sma_{s}d": F.avg(column).over(w.rowsBetween(-(s - 1), _CUR)) for s in spans if s <= SLIDING})
    long = [s for s in spans if s > SLIDING]
    if not long:
        return out
    name, held = PREFIX + "sum", PREFIX + "held"
    value = F.col(_q(column))
    out = out.withColumns({f"{name}1": F.coalesce(value.cast("double"), F.lit(0.0)), held: F.count(value).over(w.rowsBetween(_UNB, _CUR))})

    def before(c: str, n: int) -> Column:
        return F.coalesce(F.lag(c, n).over(w), F.lit(0)) if n else F.col(c)

    def total(parts: list[Column]) -> Column:
        sum_ = parts[0]
        for p in parts[1:]:
            sum_ = sum_ + p
        return sum_

    size = 1
    while size * STEP <= max(long):
        out = out.withColumn(f"{name}{size * STEP}", total([before(f"{name}{size}", size * i) for i in range(STEP)]))
        size *= STEP
    means = {}
    for s in long:
        parts, at, unit = [], 0, size
        while unit:
            for _ in range((s - at) // unit):
                parts.append(before(f"{name}{unit}", at))
                at += unit
            unit //= STEP
        n = F.col(held) - before(held, s)
        means[f"sma_{s}d"] = F.when(n > 0, total(parts) / n)
    return out.withColumns(means)


def _local_emas(df: DataFrame, keys: Sequence[str], spans: Sequence[int], column: str) -> DataFrame:
    """EMAs over the own rows of each (keys, segment), ordered by tstamp, as if they began there with 0.0.

    Adds ``<PREFIX>nn``, the non-null values so far, and ``<PREFIX>e{span}``.
    In blocks of B non-null values (the same blocks for all spans, small
    enough that no weight falls below 1e-300) ``L = b^j * sum(a*c_i*b^-i)`` is
    a running sum, taken relative to the block's largest value (its power of
    two) so that nothing overflows.  The blocks before enter with their
    weights: what 1, 2, 4, ... of them leave is made of two halves, until what
    is older weighs nothing in doubles.  From a value that is not finite on,
    the EMA is not finite either.
    """
    own = [_q(k) for k in keys]
    wp = Window.partitionBy(*own, SEG).orderBy("tstamp")
    running = wp.rowsBetween(_UNB, _CUR)
    nn, n, sub, j, top, bad, c, raw = (PREFIX + x for x in ("nn", "n", "sub", "j", "top", "bad", "c", "raw"))
    inf = float("inf")
    d = df.withColumn(raw, F.when(~F.col(HALO), F.col(_q(column)).cast("double")))
    nan, pos, neg = seg.non_finite(raw)
    finite = ~(nan | pos | neg)
    seen = [F.max(x).over(running) for x in (nan, pos, neg)]
    first_bad = PREFIX + "first_bad"
    d = d.withColumns(
        {
            nn: F.count(raw).over(running),
            c: F.when(finite, F.col(raw)).otherwise(F.when(F.col(raw).isNotNull(), F.lit(0.0))),
            bad: F.when(seen[0] | (seen[1] & seen[2]), F.lit(float("nan"))).when(seen[1], F.lit(inf)).when(seen[2], F.lit(-inf)),
        }
    )
    out = {}
    if 1 in spans:
        value = F.coalesce(F.last(raw, ignorenulls=True).over(running), F.lit(0.0))
        d = d.withColumns({PREFIX + "value": value, first_bad: F.min(F.when(~finite, F.col(nn))).over(running)})
        # no weight on the past, and 0 * inf is NaN: what follows a value that is not finite is NaN
        out[PREFIX + "e1"] = F.when(F.col(nn) > F.col(first_bad), F.lit(float("nan"))).otherwise(F.col(PREFIX + "value"))
    spans_b = [s for s in spans if s > 1]
    if spans_b:
        size = min(seg.ema_block(s) for s in spans_b)
        d = d.withColumn(n, F.greatest(F.col(nn) - 1, F.lit(0)))
        d = d.withColumn(sub, F.expr(f"{n} div {size}")).withColumn(j, F.expr(f"{n} % {size}"))
        ws = Window.partitionBy(*own, SEG, sub).orderBy("tstamp")
        most = F.max(F.abs(F.col(c))).over(ws.rowsBetween(_UNB, Window.unboundedFollowing))
        # a power of two, so that scaling rounds nothing
        d = d.withColumn(top, F.when(most > 0, F.pow(F.lit(2.0), F.floor(F.log2(most)))))
        scaled = F.col(c) / F.col(top)
        weight = {s: 1.0 - 2.0 / (s + 1) for s in spans_b}
        local = {}
        for s, b in weight.items():
            sum_ = F.sum(F.lit(2.0 / (s + 1)) * scaled * F.pow(F.lit(b), -F.col(j))).over(ws.rowsBetween(_UNB, _CUR))
            local[PREFIX + f"l{s}"] = F.coalesce(sum_ * F.pow(F.lit(b), F.col(j)) * F.col(top), F.lit(0.0))
        d = d.withColumns(local)
        wc = Window.partitionBy(*own, SEG).orderBy(sub)

        def at(name: str, k: int, order: str = n) -> Column:
            return F.coalesce(F.max_by(name, order).over(wc.rangeBetween(-k, -k)), F.lit(0.0))

        two = {s: at(PREFIX + f"l{s}", 1) + F.pow(F.lit(b), F.lit(float(size))) * at(PREFIX + f"l{s}", 2) for s, b in weight.items()}
        d = d.withColumns({PREFIX + f"p{s}": x for s, x in two.items()})
        # blocks that still weigh something: two of them weigh 1e-600 where the span is the least
        need = {s: min(-(-seg.values(b, 590.0) // size), 1 << 31) for s, b in weight.items()}
        done = 2
        while any(done < x for x in need.values()):
            more = {s: F.pow(F.lit(b), F.lit(float(size) * done)) for s, b in weight.items() if done < need[s]}
            d = d.withColumns({PREFIX + f"p{s}": F.col(PREFIX + f"p{s}") + w * at(PREFIX + f"p{s}", done) for s, w in more.items()})
            done *= 2
        for s, b in weight.items():
            value = F.col(PREFIX + f"l{s}") + F.pow(F.lit(b), F.col(j) + 1) * F.col(PREFIX + f"p{s}")
            out[PREFIX + f"e{s}"] = F.coalesce(F.col(bad), value)
    return d.withColumns(out)


def _carried(span: int, before: Column, values: Column, local: Column) -> Column:
    """The EMA after ``values`` non-null values whose EMA from 0.0 is ``local``, begun with ``before``."""
    b = 1.0 - 2.0 / (span + 1)
    gone = F.isnan(before) | (F.abs(before) == float("inf"))
    if span == 1:
        then = F.when(gone, F.lit(float("nan"))).otherwise(local)
    else:
        then = F.when(gone, before + F.when(F.isnan(local) | (F.abs(local) == float("inf")), local).otherwise(F.lit(0.0))).otherwise(
            local + F.pow(F.lit(b), values.cast("double")) * before
        )
    return F.when(values == 0, before).otherwise(then)


def ema_states(segments: DataFrame, keys: Sequence[str], spans: Sequence[int]) -> DataFrame:
    """Of rows with local EMAs: ``key_names``, ``SEG`` and, per span, the EMA with which that segment begins.

    One row a segment comes out of the windows, on their partitioning; a
    series has at most ``MAX_SEGMENTS`` of them.
    """
    own, nn = seg.key_names(keys), PREFIX + "nn"
    ends = segments.groupBy(*[F.col(_q(k)).alias(o) for k, o in zip(keys, own)], SEG).agg(
        F.max(nn).alias("nn"), *[F.max_by(PREFIX + f"e{s}", nn).alias(f"e{s}") for s in spans]
    )
    listed = ends.groupBy(*own).agg(F.array_sort(F.collect_list(F.struct(SEG, "nn", *[f"e{s}" for s in spans]))).alias("ends"))
    start = F.struct(*[F.lit(0.0).alias(f"e{s}") for s in spans])

    def step(e: Column, x: Column) -> Column:
        return F.struct(*[_carried(s, e[f"e{s}"], x["nn"], x[f"e{s}"]).alias(f"e{s}") for s in spans])

    entering = F.transform("ends", lambda x, i: F.struct(x[SEG].alias(SEG), F.aggregate(F.slice("ends", F.lit(1), i), start, step).alias("e")))
    one = listed.select(*own, F.explode(entering).alias("x"))
    return one.select(*own, F.col(f"x.{SEG}").alias(PREFIX + "at_seg"), *[F.col(f"x.e.e{s}").alias(PREFIX + f"in{s}") for s in spans])


def _emas(df: DataFrame, keys: Sequence[str], spans: Sequence[int], column: str, cut: DataFrame, in_steps: bool) -> DataFrame:
    """EMA columns with seed 0.0 over whole series; ``cut``: rows of the series that have several segments.

    ``ema_n = a*c_n + (1-a)*ema_{n-1}`` over non-null values; a NULL row repeats
    the previous value.  ``in_steps``: the states are written first.
    """
    states = ema_states(_local_emas(cut, keys, spans, column), keys, spans)
    states = F.broadcast(stored(states) if in_steps else states)
    joined = _local_emas(df, keys, spans, column).join(states, seg.same_keys(keys) & (F.col(SEG) == F.col(PREFIX + "at_seg")), "left")
    return joined.withColumns(
        {f"ema_{s}d": _carried(s, F.coalesce(F.col(PREFIX + f"in{s}"), F.lit(0.0)), F.col(PREFIX + "nn"), F.col(PREFIX + f"e{s}")) for s in spans}
    )


def indicators(
    df: DataFrame,
    keys: Sequence[str] = ("symbol",),
    *,
    fill_gaps: bool = False,
    ema_spans: Sequence[int] = (),
    sma_spans: Sequence[int] = (),
    column: str = "close",
    max_gap: int = DAY_SECONDS,
    null_fill: float | None = None,
    target_rows: int = seg.TARGET_ROWS,
    materialize: bool = False,
    in_steps: bool = False,
    ema_column: str | None = None,
) -> DataFrame:
    """Optional gap fill, then EMA and SMA columns, in one shuffle of the rows.

    Adds ``ema_{span}d`` (in ``ema_spans`` order) then ``sma_{span}d``.  Spans
    count rows; invented midpoint rows count too, as in the source chain.
    ``ema_column``: another column than ``column`` for the EMAs (a column that
    is no bar column is NULL on midpoint rows).

    The plan reads its input twice (keys and rows), and three times more, in
    few columns, the series that are cut: for their quantiles, the stamps
    before the cuts, and the EMA of each segment.  For an input that is itself
    an expensive computation, ``materialize=True`` writes it once as a table
    into the session's checkpoint directory (shared storage on a cluster) and
    reads that instead.  ``in_steps=True`` does so with the cuts and with the
    EMAs with which segments begin (a row for each of them): the passes that
    make these end, and their shuffles are removed, before the rows are
    shuffled, so that disk holds one shuffle at a time.
    """
    keys = tuple(keys)
    for s in [*ema_spans, *sma_spans]:
        if s < 1:
            raise ValueError(f"span must be >= 1, got {s}")
    src = _fill_nulls(df, null_fill)
    if materialize:
        src = stored(src)
    new = [f"ema_{s}d" for s in ema_spans] + [f"sma_{s}d" for s in sma_spans]
    seg.refuse_own_names(src, new)
    # a midpoint needs the row before it: one row more
    halo = max([s - 1 for s in sma_spans], default=0) + 1
    found = seg.cuts(src, keys, "tstamp", halo=halo, target_rows=target_rows)
    if in_steps:
        found = stored(found)

    def filled(rows: DataFrame, only_cut: bool) -> DataFrame:
        out = seg.split(rows, keys, "tstamp", found=found, only_cut=only_cut).drop(seg.FIRST)
        return _expand(_lagged(out, keys, _PREV, rows.columns), rows.columns, [*keys, SEG, HALO], max_gap) if fill_gaps else out

    out = filled(src, False)
    # SMA first: its window shares the sort with the EMA's running count.
    if sma_spans:
        out = _smas(out, keys, list(dict.fromkeys(sma_spans)), column)
    if ema_spans:
        of = ema_column or column
        narrow = src.select(*[F.col(_q(c)) for c in dict.fromkeys([*keys, "tstamp", of])])
        out = _emas(out, keys, list(dict.fromkeys(ema_spans)), of, filled(narrow, True), in_steps)
    return out.filter(~F.col(HALO)).select(*[F.col(_q(c)) for c in src.columns], *new)


def sma(df: DataFrame, keys: Sequence[str] = ("symbol",), span: int = DEFAULT_SPAN, **kw) -> DataFrame:
    """Mean of ``close`` over the last ``span`` rows (short frames at the start)."""
    return indicators(df, keys, sma_spans=[span], **kw)


def ema(df: DataFrame, keys: Sequence[str] = ("symbol",), span: int = DEFAULT_SPAN, **kw) -> DataFrame:
    """EMA of ``close`` with ``alpha = 2/(span+1)`` and seed 0.0."""
    return indicators(df, keys, ema_spans=[span], **kw)


def load_symbol_chain(
    df: DataFrame, keys: Sequence[str] = ("symbol",), span: int = DEFAULT_SPAN, **kw
) -> DataFrame:
    """Gap fill, then EMA(span), then SMA(span): the source's batch load chain."""
    return indicators(df, keys, fill_gaps=True, ema_spans=[span], sma_spans=[span], **kw)


def running_close(
    df: DataFrame,
    keys: Sequence[str] = ("symbol",),
    *,
    column: str = "close",
    target_rows: int = seg.TARGET_ROWS,
) -> DataFrame:
    """Summary of the running list of non-null closes: its length, first and last element.

    Each segment's own summary, rolled up over the segments before it, is
    joined to the segment's rows (one row a segment, on their partitioning).
    """
    seg.refuse_own_names(df, ["n_closes", "first_close", "last_close"])
    rows = seg.split(df, keys, "tstamp", halo=0, target_rows=target_rows).filter(~F.col(HALO))
    own = [f"{PREFIX}g{i}" for i in range(2 * len(keys))]
    for i, k in enumerate(keys):
        # null-safe and plain: the window after the join needs no new exchange
        rows = rows.withColumns({own[2 * i]: F.col(_q(k)).isNull(), own[2 * i + 1]: F.coalesce(F.col(_q(k)).cast("string"), F.lit(""))})
    order = F.when(F.col(_q(column)).isNotNull(), F.coalesce(F.col("tstamp"), F.lit(-(2**63)).cast("long")))
    nn, first, last, n0, f0, l0 = (PREFIX + x for x in ("nn", "f", "l", "n0", "f0", "l0"))
    summary = rows.groupBy(*own, SEG).agg(
        F.count(column).alias(nn), F.min_by(F.col(_q(column)), order).alias(first), F.max_by(F.col(_q(column)), order).alias(last)
    )
    before = Window.partitionBy(*own).orderBy(SEG).rowsBetween(_UNB, -1)
    rolled = summary.select(
        *own, SEG,
        F.coalesce(F.sum(nn).over(before), F.lit(0)).alias(n0),
        F.first(first, ignorenulls=True).over(before).alias(f0),
        F.last(last, ignorenulls=True).over(before).alias(l0),
    ).hint("shuffle_hash")
    w = Window.partitionBy(*own, SEG).orderBy("tstamp").rowsBetween(_UNB, _CUR)
    return rows.join(rolled, [*own, SEG]).select(
        *[F.col(_q(c)) for c in df.columns],
        (F.col(n0) + F.count(column).over(w)).alias("n_closes"),
        F.coalesce(F.col(f0), F.first(column, ignorenulls=True).over(w)).alias("first_close"),
        F.coalesce(F.last(column, ignorenulls=True).over(w), F.col(l0)).alias("last_close"),
    )


# ---------------------------------------------------------------------------
# Direct forms (per-row list fold, one window per series), for tests on small inputs only: they keep a whole
# series in one window group and build a list per row (quadratic).
# ---------------------------------------------------------------------------


def ema_list_fold(df: DataFrame, keys: Sequence[str], span: int, column: str = "close") -> DataFrame:
    a = 2.0 / (span + 1)
    w = Window.partitionBy(*keys).orderBy("tstamp").rowsBetween(_UNB, _CUR)
    lst = F.collect_list(column).over(w)
    fold = F.aggregate(lst, F.lit(0.0), lambda p, c: F.lit(a) * c + F.lit(1.0 - a) * p)
    return df.withColumn(f"ema_{span}d", fold)


def sma_plain_window(df: DataFrame, keys: Sequence[str], span: int, column: str = "close") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("tstamp").rowsBetween(-(span - 1), _CUR)
    return df.withColumn(f"sma_{span}d", F.avg(column).over(w))
