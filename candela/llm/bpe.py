"""Byte-level BPE as a tree reduction: leaves are encoded, neighbours joined at their boundary.

An element of the monoid is a stretch of text with its token ids. Joining two
elements re-encodes a window of text around the boundary and keeps every token
outside it. The window grows until both its ends lie at a place where the
splitting pattern must have a boundary whatever stands around it; then the
pieces outside, and so their tokens, cannot change:

* no piece holds a non-space followed by white space, so between the two there
  is always a boundary (pieces have white space only at their start, or are
  nothing else);
* the pattern never looks behind a piece, so the pieces after a boundary
  depend on the text after it alone, and those before it are decided by at
  most the next sign, a white-space sign either way.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Sequence
from functools import cache, reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm import common

#: Code points of a leaf.
LEAF = 16_384
#: First reach of a window to each side of a boundary; doubled while an end has no sure boundary.
REACH = 32
#: A place between a sign that is no white space and one that is.
SURE = re.compile(r"(?<=\S)(?=[\x20\n])")


class Vocabulary:
    """Ranks and splitting pattern of a public byte-level vocabulary."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes = {i: b for b, i in ranks.items()}
        self.lengths = np.zeros(max(self.bytes) + 1, dtype=np.int64)
        for i, b in self.bytes.items():
            self.lengths[i] = len(b)
        self.leaf = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def join(self, text: str, low: int, mid: int, high: int, left: list[int], right: list[int]) -> list[int]:
        """Ids of ``text[low:high]`` from those of its parts before and after ``mid``."""
        if low == mid or mid == high:
            return left or right
        a, b, reach = mid, mid, REACH
        while True:
            start, stop = max(low, mid - reach), min(high, mid + reach)
            if a == mid:
                sure = [m.start() for m in SURE.finditer(text, start, mid) if m.start() > low]
                a = sure[-1] if sure else low if start == low else mid
            if b == mid:
                sure_after = SURE.search(text, mid + 1, stop)
                b = sure_after.start() if sure_after else high if stop == high else mid
            if a < mid < b:
                break
            reach *= 2
        window = self.leaf(text[a:b])
        return self._head(left, len(text[a:mid].encode())) + window + self._tail(right, len(text[mid:b].encode()))

    def _head(self, ids: list[int], drop: int) -> list[int]:
        """``ids`` without those of the last ``drop`` bytes."""
        i = len(ids)
        while drop > 0:
            i -= 1
            drop -= int(self.lengths[ids[i]])
        assert drop == 0, "a window must begin at a token boundary"
        return ids[:i]

    def _tail(self, ids: list[int], drop: int) -> list[int]:
        """``ids`` without those of the first ``drop`` bytes."""
        i = 0
        while drop > 0:
            drop -= int(self.lengths[ids[i]])
            i += 1
        assert drop == 0, "a window must end at a token boundary"
        return ids[i:]

    def encode(self, text: str, low: int = 0, high: int | None = None, leaf: int = LEAF) -> list[int]:
        """Ids of ``text[low:high]``: halves are encoded, then joined."""
        high = len(text) if high is None else high
        if high - low <= leaf:
            return self.leaf(text[low:high])
        mid = (low + high) // 2
        return self.join(text, low, mid, high, self.encode(text, low, mid, leaf), self.encode(text, mid, high, leaf))

    def decode(self, ids: Sequence[int]) -> bytes:
        """Bytes of the ids: leaves are looked up, then concatenated up the tree."""
        parts = [b"".join([self.bytes[i] for i in ids[k : k + LEAF]]) for k in range(0, len(ids), LEAF)]
        while len(parts) > 1:
            parts = [reduce(bytes.__add__, parts[k : k + 2]) for k in range(0, len(parts), 2)]
        return parts[0] if parts else b""


@cache
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One per worker."""
    return Vocabulary(path, pattern)


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The kept columns and ``ids``: the token ids as little-endian unsigned 32-bit integers.

    An empty or null text has no ids (empty binary). One pass, no shuffle.
    ``path`` must be readable by every executor, as installed packages are.
    """

    def run(cols: dict[str, list]) -> dict[str, list]:
        v = vocabulary(path, pattern)
        return cols | {"ids": [np.asarray(v.encode(t), dtype="<u4").tobytes() for t in cols["__text"]]}

    schema = ", ".join(x for x in (common.fields(docs, keep), "ids binary") if x)
    return common.map_batches(common.keep_and_text(docs, text, keep), run, schema, slices="__text")


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns and ``decoded``: the bytes of the ids (null: empty).

    Read in slices of bounded size; ids that are kept are sent once.
    """
    sent = ids if ids in keep else "__ids"

    def run(cols: dict[str, list]) -> dict[str, list]:
        v = vocabulary(path, pattern)
        return cols | {"decoded": [v.decode(np.frombuffer(x or b"", dtype="<u4").tolist()) for x in cols[sent]]}

    schema = ", ".join(x for x in (common.fields(encoded, keep), "decoded binary") if x)
    given = encoded.select(*[F.col(f"`{c}`") for c in keep], *([] if sent == ids else [F.col(f"`{ids}`").alias(sent)]))
    return common.map_batches(given, run, schema, slices=sent)
