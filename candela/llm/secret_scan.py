"""Secrets: patterns for credentials, and weak parts that count only beside their complement."""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame

from candela.llm import common

#: Kinds in report order; the first three have a base pattern.
KINDS = ("assign", "access", "hex", "linked_secret", "linked_id")

ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}+")

# Weak parts. Each is no finding by itself. Values have no upper bound; none is read twice.
WEAK_ID = re.compile(
    r"(?<![A-Za-z0-9])(?:access[_-]?key(?:[_-]?id)?|client[_-]?id|user(?:name)?|login|account)[\"']?\x20?[:=]\x20?[\"']?([A-Za-z0-9._@+-]{3,}+)",
    re.IGNORECASE | re.ASCII,
)
WEAK_KEY = re.compile(
    r"(?<![A-Za-z0-9])(?:pwd|pass|auth|bearer|key|credential)[\"']?\x20?[:=\x20]\x20?[\"']?([A-Za-z0-9+/_.=-]{8,}+)",
    re.IGNORECASE | re.ASCII,
)
WEAK_RANDOM = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}+={0,2}+(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(
    r"(?<![A-Za-z0-9])(?:[a-z][a-z0-9+]{1,15}://[A-Za-z0-9._~:@%-]{3,}+|(?:host(?:name)?|endpoint|server|url)[\"']?\x20?[:=]\x20?[\"']?[A-Za-z0-9._:/-]{3,}+)",
    re.IGNORECASE | re.ASCII,
)
#: Ends a scope: parts in different paragraphs are not linked, those of one are, however long it is.
SCOPE_END = re.compile(r"\n[\x20\t\r]*\n")
BITS = 3.5


def random_looking(value: str) -> bool:
    """Letters of both cases and digits, with at least ``BITS`` bits of entropy a sign."""
    if not (re.search("[0-9]", value) and re.search("[a-z]", value) and re.search("[A-Z]", value)):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= BITS


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans of all kinds."""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


class Intervals:
    """Parts of one role, asked for the nearest within a stretch of text."""

    def __init__(self, spans: Sequence[tuple[int, int]]):
        self.starts = sorted(a for a, _ in spans)
        self.stops = sorted(b for _, b in spans)

    def within(self, low: int, high: int) -> bool:
        """Whether one reaches into the stretch: begins by its end, and does not stop before it."""
        return bisect_right(self.stops, low) < bisect_right(self.starts, high)


def linked(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Weak identifiers and secrets that have their complement in their paragraph.

    The join of the parts by scope is a search in sorted starts, so it
    costs a logarithm a candidate, also where a text holds very many parts.
    """
    starts, stops = [], []
    for _, a, b in sorted(base, key=lambda x: x[1]):
        if stops and a < stops[-1]:
            stops[-1] = max(stops[-1], b)
        else:
            starts.append(a)
            stops.append(b)

    def free(a: int, b: int) -> bool:
        i = bisect_left(starts, b)
        return i == 0 or stops[i - 1] <= a

    ids = [m.span(1) for m in WEAK_ID.finditer(text) if free(*m.span(1))]
    keys = [m.span(1) for m in WEAK_KEY.finditer(text) if free(*m.span(1))]
    known = set(keys)
    keys += [m.span() for m in WEAK_RANDOM.finditer(text) if m.span() not in known and free(*m.span()) and random_looking(m[0])]
    if not ids and not keys:
        return []
    ends = [m.start() for m in SCOPE_END.finditer(text)]
    strong_id = [(a, b) for k, a, b in base if k == "access"]
    strong_key = [(a, b) for k, a, b in base if k != "access"]
    of_id, of_key = Intervals(ids + strong_id), Intervals(keys + strong_key)
    of_end = Intervals([m.span() for m in ENDPOINT.finditer(text)])

    def near(role: Intervals, a: int, b: int) -> bool:
        i = bisect_left(ends, a)
        return role.within(ends[i - 1] if i else 0, ends[i] if i < len(ends) else len(text))

    out = [("linked_secret", a, b) for a, b in keys if near(of_id, a, b) or near(of_end, a, b)]
    return out + [("linked_id", a, b) for a, b in ids if near(of_key, a, b)]


def find(text: str) -> list[tuple[str, int, int, bool]]:
    """All spans: (kind, start, end, base), by start, then kind as listed."""
    base = base_spans(text)
    order = {k: i for i, k in enumerate(KINDS)}
    out = [(*x, True) for x in base] + [(*x, False) for x in dict.fromkeys(linked(text, base))]
    return sorted(out, key=lambda x: (x[1], order[x[0]], x[2]))


def scan(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per document: the kept columns and ``spans`` (kind, start, end, base).

    Code points, end exclusive; an empty or null text has none. One pass.
    """

    def run(cols: dict[str, list]) -> dict[str, list]:
        cols["spans"] = [[{"kind": k, "start": a, "end": b, "base": x} for k, a, b, x in find(t)] for t in cols["__text"]]
        return cols

    kind = "spans array<struct<kind:string,start:int,end:int,base:boolean>>"
    return common.map_batches(
        common.keep_and_text(docs, text, keep), run, ", ".join(x for x in (common.fields(docs, keep), kind) if x)
    )
