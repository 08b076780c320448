"""Series against a given calendar, as bitmaps.

A calendar is a table of stamps at any spacing: trading days without weekends
and holidays, say.  Time is counted in slots of ``unit`` seconds; a stamp
stands for its slot, and any bar in a slot fulfils it.  Of every series, and of
the calendar, one bitmap is kept for each stretch of 32,768 slots; what the
calendar has between a series' first and last slot and the series has not is
missing: word by word ``calendar & ~series``, so that only stretches are rows
and only missing slots are ever listed.

Bitmaps are grouped aggregates, combined before the shuffle, so a series on a
third of all rows, or a slot with very many bars, is a row of 4 KB a task.  The
calendar's bitmaps join on the stretch without a hint: where they are few, and
one stretch holds all series, Spark finds them small enough to broadcast; where
they are many, the stretches spread the series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.plans import segments as seg
from candela.schemas import DAY_SECONDS

#: Slots and 64-bit words of a bitmap.
SLOTS, WORDS = 32_768, 512
_P = seg.PREFIX
_STRETCH, _BITS = _P + "stretch", _P + "bits"


def _slot(stamp: str, unit: int) -> Column:
    return F.floor(F.col(seg.q(stamp)) / F.lit(int(unit))).cast("long")


def bitmaps(df: DataFrame, keys: Sequence[str], stamp: str = "tstamp", unit: int = DAY_SECONDS) -> DataFrame:
    """One row per key and stretch that has a slot: ``<PREFIX>stretch`` and its bitmap ``<PREFIX>bits``; null stamps have no slot."""
    own = df.select(*[F.col(seg.q(k)) for k in keys], _slot(stamp, unit).alias(_P + "slot")).where(F.col(_P + "slot").isNotNull())
    stretch = F.floor(F.col(_P + "slot") / SLOTS).cast("long")
    place = F.pmod(_P + "slot", F.lit(SLOTS))
    return own.groupBy(*[F.col(seg.q(k)) for k in keys], stretch.alias(_STRETCH)).agg(F.bitmap_construct_agg(place).alias(_BITS))


def _words(bits: Column) -> Column:
    """A bitmap (or NULL, an empty one) as 64-bit words."""
    word = lambda i: F.conv(F.hex(F.substring(bits, i * 8 + 1, F.lit(8))), 16, -10).cast("long")
    nothing = F.array_repeat(F.lit(0).cast("long"), WORDS)
    return F.when(bits.isNull(), nothing).otherwise(F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), word))


def _set_slots(words: Column, stretch: Column) -> Column:
    """The slots of the bits that are set: bit j of a word is in its byte 7 - j / 8, a byte's bits count from its lowest."""
    numbered = F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    base = lambda x, j: stretch * SLOTS + x["i"] * 64 + (7 - F.floor(j / 8)) * 8 + j % 8

    def of_word(x: Column) -> Column:
        held = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda j: F.getbit(x["w"], j) == 1)
        return F.transform(held, lambda j: base(x, j).cast("long"))

    return F.flatten(F.transform(F.filter(numbered, lambda x: x["w"] != 0), of_word))


def against(bars: DataFrame, calendar: DataFrame, keys: Sequence[str] = ("symbol",), *, unit: int = DAY_SECONDS, stamp: str = "tstamp") -> DataFrame:
    """Per key and stretch between its first and last slot: ``on`` (calendar slots that the series has) and ``missing`` (list of slots).

    Stretches without a calendar slot have no row.  ``calendar`` has a column
    ``stamp``; entries that repeat count once.
    """
    seg.refuse_own_names(bars, ["on", "missing"])
    own = [F.col(seg.q(k)) for k in keys]
    series = bitmaps(bars, keys, stamp, unit)
    slot = _slot(stamp, unit)
    ends = bars.where(slot.isNotNull()).groupBy(*own).agg(F.min(slot).alias(_P + "lo"), F.max(slot).alias(_P + "hi"))
    at = lambda c: F.floor(F.col(c) / SLOTS).cast("long")
    names = [F.col(seg.q(k)).alias(n) for k, n in zip(keys, seg.key_names(keys))]
    stretches = ends.select(*names, _P + "lo", _P + "hi", F.explode(F.sequence(at(_P + "lo"), at(_P + "hi"))).alias(_P + "at"))
    joined = stretches.join(series, seg.same_keys(keys) & (F.col(_P + "at") == F.col(_STRETCH)), "left")
    theirs = bitmaps(calendar, [], stamp, unit).select(F.col(_STRETCH).alias(_P + "at"), F.col(_BITS).alias(_P + "all"))
    met = joined.join(theirs, _P + "at").withColumns({_P + "want": _words(F.col(_P + "all")), _P + "have": _words(F.col(_BITS))})
    both = F.zip_with(_P + "want", _P + "have", lambda a, b: F.bit_count(a.bitwiseAND(b)))
    lacking = F.zip_with(_P + "want", _P + "have", lambda a, b: a.bitwiseAND(F.bitwise_not(b)))
    inside = F.filter(_set_slots(lacking, F.col(_P + "at")), lambda s: (s >= F.col(_P + "lo")) & (s <= F.col(_P + "hi")))
    return met.select(
        *[F.col(n).alias(k) for k, n in zip(keys, seg.key_names(keys))],
        F.aggregate(both, F.lit(0).cast("long"), lambda a, b: a + b).alias("on"), inside.alias("missing"),
    )


def missing_on_calendar(bars: DataFrame, calendar: DataFrame, keys: Sequence[str] = ("symbol",), *, unit: int = DAY_SECONDS, stamp: str = "tstamp") -> DataFrame:
    """Calendar slots between a series' first and last bar that have no bar, as the slot's first second."""
    slots = against(bars, calendar, keys, unit=unit, stamp=stamp)
    return slots.select(*[F.col(seg.q(k)) for k in keys], F.explode("missing").alias(_P + "slot")).select(
        *[F.col(seg.q(k)) for k in keys], (F.col(_P + "slot") * int(unit)).alias(stamp)
    )


def check_completeness_on(bars: DataFrame, calendar: DataFrame, keys: Sequence[str] = ("symbol",), *, unit: int = DAY_SECONDS, stamp: str = "tstamp") -> DataFrame:
    """Per series: calendar slots between its first and last bar, those with a bar, those without, and the coverage.

    A series between whose ends the calendar has no slot has no row.
    """
    slots = against(bars, calendar, keys, unit=unit, stamp=stamp)
    per = slots.groupBy(*[F.col(seg.q(k)) for k in keys]).agg(F.sum("on").alias("present"), F.sum(F.size("missing")).cast("long").alias("missing"))
    expected = F.col("present") + F.col("missing")
    return per.where(expected > 0).select(
        *[F.col(seg.q(k)) for k in keys], expected.alias("expected"), "present", "missing", F.round(F.col("present") / expected, 6).alias("coverage")
    )
