"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Test items are cut into pieces of at most ``PIECE`` words (a rest shorter than
that joins the last piece). All n-grams of a piece are its seeds, frequent
ones too: what is left of an edited copy that stands in very many texts is
frequent. One pass looks the seeds up in each text and aligns the piece with
the words around them. A text holds a copy of an item where the score of the
best local alignment reaches ``ENOUGH`` of the score of a perfect one, for any
piece. A copy without ``GRAM`` words in a row as they stand in the item, such as
one with every third or fourth word replaced, has no seed and is not found.

Two bounds keep frequent seeds cheap and lose nothing that has a seed, as a score of s needs
s / ``MATCH`` words in common: words of the piece anywhere in the text, for
all its candidates in one step, then words of it within the window.

The items go through the pass in blocks of a bounded number of words; a block
is what is broadcast. All training texts are compared with all items, whatever
the number of either.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Sequence

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candela.llm import common

GRAM = 4
PIECE = 200
ENOUGH = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
#: Expected words of a block of items; pieces are dealt to blocks by a hash.
BLOCK = 1 << 19
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = b".,;:!?'\"()[]{}#*$%&|<>-"
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    """Lower-case words without the punctuation around them; one for each word of the text."""
    return [w.strip(EDGE) for w in text.encode().lower().split()]


class Hashes(dict):
    """Word to 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def hashes(words: list[bytes], known: Hashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def grams(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of the n-gram of ``size`` words that begins at each word, from the words' hashes."""
    out = np.zeros(max(0, len(h) - size + 1), dtype=np.uint64)
    for k in range(size):
        out = (out + h[k : k + len(out)]) * MIX
        out ^= out >> np.uint64(29)
    return out


def align(piece: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman score of two word sequences (as numbers), and the stretch of ``window`` it covers."""
    n = len(window)
    steps = -GAP * np.arange(1, n + 1)
    table = np.zeros((len(piece) + 1, n + 1), dtype=np.int64)
    for i, w in enumerate(piece, 1):
        above = table[i - 1]
        best = np.maximum(np.maximum(above[:-1] + np.where(window == w, MATCH, MISMATCH), above[1:] + GAP), 0)
        # a gap of k words costs k steps: a running maximum of the values above a slope
        table[i, 1:] = np.maximum.accumulate(best + steps) - steps
    i, j = np.unravel_index(int(table.argmax()), table.shape)
    score, end = int(table[i, j]), int(j)
    while table[i, j] > 0:
        here = table[i, j]
        if here == table[i - 1, j - 1] + (MATCH if window[j - 1] == piece[i - 1] else MISMATCH):
            i, j = i - 1, j - 1
        elif here == table[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return score, int(j), end


class Block:
    """The pieces of some items: their seeds by n-gram, and their words."""

    def __init__(self, pieces: list[tuple[object, list[bytes]]]):
        known = Hashes()
        self.items = [i for i, _ in pieces]
        self.words = [w for _, w in pieces]
        h = [hashes(w, known) for w in self.words]
        # a piece of fewer words than an n-gram is one seed of its own length
        size = [min(GRAM, len(w)) for w in self.words]
        self.sizes = sorted(set(size))
        own = [grams(x, n) for x, n in zip(h, size)]
        gram = np.concatenate(own)
        order = np.argsort(gram, kind="stable")
        self.piece = np.repeat(np.arange(len(own)), [len(g) for g in own])[order]
        self.at = np.concatenate([np.arange(len(g)) for g in own])[order]
        self.distinct, first = np.unique(gram[order], return_index=True)
        self.first = np.append(first, len(gram))
        self.known, self.word = np.unique(np.concatenate(h), return_inverse=True)
        self.length = np.array([len(w) for w in self.words])
        self.begin = np.cumsum(self.length) - self.length

    def lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of known n-grams in a text, by its words' hashes, and which they are."""
        at, which = [], []
        for size in self.sizes:
            found = grams(h, size)
            i = np.minimum(np.searchsorted(self.distinct, found), len(self.distinct) - 1)
            hit = np.flatnonzero(self.distinct[i] == found)
            at.append(hit)
            which.append(i[hit])
        return np.concatenate(at), np.concatenate(which)

    def may_reach(self, pieces: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Which of the pieces have so many of their words in the text that they can reach ``ENOUGH``."""
        there = np.zeros(len(self.known), dtype=np.int64)
        some = np.unique(h)
        i = np.minimum(np.searchsorted(self.known, some), len(self.known) - 1)
        there[i[self.known[i] == some]] = 1
        n = self.length[pieces]
        edge = np.cumsum(n) - n
        every = np.repeat(self.begin[pieces] - edge, n) + np.arange(n.sum())
        return np.add.reduceat(there[self.word[every]], edge) >= ENOUGH * n

    def leaks(self, text: str, known: Hashes) -> list[dict]:
        """The items that the text holds: best piece each, with similarity and stretch in code points."""
        words = words_of(text)
        h = hashes(words, known)
        hit, which = self.lookup(h)
        if not len(hit):
            return []
        counts = self.first[which + 1] - self.first[which]
        entry = np.repeat(self.first[which], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        piece, start = self.piece[entry], np.repeat(hit, counts) - self.at[entry]
        some = np.unique(piece)
        keep = np.isin(piece, some[self.may_reach(some, h)])
        piece, start = piece[keep], start[keep]
        best: dict[int, tuple[float, int, int]] = {}
        order = np.lexsort((start, piece))
        piece, start = piece[order], start[order]
        # one window for the seeds of a piece that begin within its length
        part = start // self.length[piece]
        cuts = np.flatnonzero((piece[1:] != piece[:-1]) | (part[1:] != part[:-1])) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(piece)] if len(piece) else []):
            p = int(piece[a])
            own = self.words[p]
            # a copy that reaches it has at most as many words put in as the piece has
            low, high = max(0, int(start[a]) - len(own)), min(len(words), int(start[b - 1]) + 2 * len(own))
            near = words[low:high]
            bag = Counter(near)
            if sum(min(n, bag[w]) for w, n in Counter(own).items()) < ENOUGH * len(own):
                continue
            number: dict[bytes, int] = {}
            x, y = (np.array([number.setdefault(w, len(number)) for w in s]) for s in (own, near))
            score, i, j = align(x, y)
            found = (score / (MATCH * len(own)), low + i, low + j)
            if found[0] >= ENOUGH and found > best.get(p, (0.0, 0, 0)):
                best[p] = found
        if not best:
            return []
        place = [m.span() for m in WORD.finditer(text)]
        return best_of(
            {"item_id": self.items[p], "similarity": round(similarity, 6), "start": place[i][0], "end": place[j - 1][1]}
            for p, (similarity, i, j) in sorted(best.items())
        )


def best_of(leaks: Iterable[dict]) -> list[dict]:
    """One leak an item: that of its best piece, the first of equal ones."""
    by_item: dict[object, dict] = {}
    for x in leaks:
        old = by_item.setdefault(x["item_id"], x)
        if x["similarity"] > old["similarity"]:
            by_item[x["item_id"]] = x
    return list(by_item.values())


def pieces(benchmark: DataFrame, text: str, item_id: str) -> DataFrame:
    """Rows (item_id, words, block is derived from): the pieces of each item. Empty items have none."""

    def cut(cols: dict[str, list]) -> dict[str, list]:
        items, words, count = [], [], []
        for item, t in zip(cols["__item"], cols["__text"]):
            own = words_of(t)
            n = max(1, len(own) // PIECE)
            for k in range(n if own else 0):
                items.append(item)
                words.append(own[k * PIECE : (k + 1) * PIECE if k + 1 < n else len(own)])
                count.append(len(words[-1]))
        return {"item_id": items, "words": words, "n": count}

    given = common.keep_and_text(benchmark.withColumn("__item", F.col(f"`{item_id}`")), text, ["__item"])
    kind = benchmark.schema[item_id].dataType.simpleString()
    return common.map_batches(given, cut, f"item_id {kind}, words array<binary>, n int")


def annotate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",),
    bench_text: str = "text", item_id: str = "item_id",
) -> DataFrame:
    """The kept columns and ``leaks``, one row per document.

    ``leaks``: array of (item_id, similarity, start, end), in code points of
    the text, end exclusive, by item; empty where the document holds no item,
    as for null and empty texts. Null item ids are reported as null.
    """
    spark = docs.sparkSession
    cut = common.stored(pieces(benchmark, bench_text, item_id))
    total = cut.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // BLOCK)
    kind = benchmark.schema[item_id].dataType.simpleString()
    leak = f"array<struct<item_id:{kind},similarity:double,start:int,end:int>>"
    out = common.keep_and_text(docs, text, keep).withColumn("leaks", F.array().cast(leak))
    schema = StructType(out.schema.fields)

    for n in range(blocks):
        rows = cut.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == n).collect()
        if not rows:
            continue
        block = Block(sorted(((r["item_id"], [bytes(w) for w in r["words"]]) for r in rows), key=lambda x: (x[0] is not None, x)))
        seeds = spark.sparkContext.broadcast(block)

        def find(cols: dict[str, list], seeds=seeds) -> dict[str, list]:
            known = Hashes()
            cols["leaks"] = [best_of(old + seeds.value.leaks(t, known)) for old, t in zip(cols["leaks"], cols["__text"])]
            return cols

        out = common.map_batches(out, find, schema)
    return out.drop("__text")


def leaked(found: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per document and item of ``annotate``'s result that has any."""
    return found.select(*[F.col(f"`{c}`") for c in keep], F.explode("leaks").alias("__leak")).select(*[F.col(f"`{c}`") for c in keep], "__leak.*")
