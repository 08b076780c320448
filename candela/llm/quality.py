"""Quality rules: base counts, then the divergence of a document from its language's reference.

A document is described by two histograms, of character classes and of common
words (all other words in one bin). Each is compared with the mean histogram
of its language over the whole table by the Jensen-Shannon distance.

* Common words of a language: of at most ``WORD_BYTES`` bytes, making up at
  least ``COMMON`` of its words (each document weighs the same), so at most
  ``1 / COMMON`` words. Languages with at least ``LANGUAGE`` of all documents
  have a reference of their own, so at most ``1 / LANGUAGE``; all others,
  nulls too, are compared with the reference over all documents.
* Documents that fail the base rules are not learned from.
* Minimum lengths: below ``LEAST_WORDS`` words the histograms say too little,
  and the verdict is the base rules' alone. Above it the bounds on the
  distances fall with the root of the length, as chance divergence does.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm import common

SYMBOLS = "#*$%&|<>"
WORD_BYTES = 8
COMMON, LANGUAGE = 0.004, 0.01
LEAST_WORDS = 50
#: Bounds on the distances: a limit for long documents, and a slack over the root of the words.
CLASS_BOUND, CLASS_SLACK = 0.20, 0.6
WORD_BOUND, WORD_SLACK = 0.12, 1.95
#: Character classes by byte; a byte that continues a code point has none.
CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "beyond ASCII")
_CLASS = bytes(
    7 if 128 <= b < 192
    else 6 if b >= 192
    else 0 if 97 <= b <= 122
    else 1 if 65 <= b <= 90
    else 2 if 48 <= b <= 57
    else 3 if b in b" \t\n\x0b\x0c\r"
    else 4 if b in b".,;:!?'\"()-"
    else 5
    for b in range(256)
)
STOPS = b".,;:!?'\"()"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    k = len(number)
    if k < 2_000_000:
        window = (ids[:-2] * k + ids[1:-1]) * k + ids[2:]
    else:  # the product would not fit: number the pairs first
        _, pair = np.unique(ids[:-1] * k + ids[1:], return_inverse=True)
        window = pair[:-1] * k + ids[2:]
    _, back, count = np.unique(window, return_inverse=True, return_counts=True)
    again = count[back] > 1
    hit = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        hit[shift : shift + n] |= again
    return int(hit.sum())


def base_counts(text: str) -> tuple[list[bytes], int, int, int, int]:
    """Words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = text.encode()
    words = raw.split()  # bytes split at ASCII white space, which is that of the contract
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (
        words,
        len(text) - sum(map(text.count, common.SPACE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < 50 or 100 * n_repeat > 50 * n_words


def classes(text: str) -> np.ndarray:
    """Shares of the character classes."""
    raw = np.frombuffer(text.encode().translate(_CLASS), dtype=np.uint8)
    n = np.bincount(raw, minlength=8)[:7].astype(float)
    return n / max(1.0, n.sum())


def bare(word: bytes) -> bytes:
    return word.lower().strip(STOPS)


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence in bits."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(x > 0, x * np.log2(x / m), 0).sum() for x in (p, q)]
    return math.sqrt(max(0.0, sum(parts) / 2))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str | None, tuple[np.ndarray, dict[bytes, float]]]:
    """References of the languages; ``None``: of all documents. Bounded, see the module."""

    def count(cols: dict[str, list]) -> dict[str, list]:
        sums: dict[tuple[str | None, int, bytes], float] = {}
        for language, t in zip(cols["__lang"], cols["__text"]):
            raw = t.encode()
            words = raw.split()
            if len(words) < LEAST_WORDS or base_failed(len(words), repeated_words(words)):
                continue
            own: dict[tuple[int, bytes], float] = {(0, b""): 1.0}
            for i, x in enumerate(classes(t)):
                own[1, b"%d" % i] = float(x)
            share = 1 / len(words)
            for w in words:
                if len(w) <= WORD_BYTES and len(w := bare(w)) > 0:
                    own[2, w] = own.get((2, w), 0.0) + share
            for (part, key), v in own.items():
                at = (language, part, key)
                sums[at] = sums.get(at, 0.0) + v
        keys = list(sums)
        return {"lang": [k[0] for k in keys], "part": [k[1] for k in keys], "key": [k[2] for k in keys], "v": [sums[k] for k in keys]}

    given = docs.select(F.col(f"`{lang}`").alias("__lang"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    # Sums of doubles depend on their order; whole numbers do not.
    found = common.map_batches(given, count, "lang string, part int, key binary, v double", slices=True).select(
        "lang", "part", "key", F.round(F.col("v") * 1e9).cast("decimal(38,0)").alias("v")
    )
    sums = common.stored(found.groupBy("lang", "part", "key").agg(F.sum("v").alias("v")))
    total = sums.where("part = 0").select("lang", F.col("v").alias("n"))
    every = total.agg(F.sum("n").alias("n"))
    own = total.join(every.withColumnRenamed("n", "all_n"), F.lit(True)).where(
        F.col("lang").isNotNull() & (F.col("n") >= LANGUAGE * F.col("all_n"))
    )
    pooled = sums.groupBy("part", "key").agg(F.sum("v").alias("v")).join(every, F.lit(True))
    rows = (
        sums.join(own.select("lang", "n"), "lang")
        .select("lang", "part", "key", (F.col("v") / F.col("n")).cast("double").alias("share"))
        .unionByName(
            pooled.select(F.lit(None).cast("string").alias("lang"), "part", "key", (F.col("v") / F.col("n")).cast("double").alias("share"))
        )
        .where(f"part = 1 or part = 2 and share >= {COMMON}")
        .collect()
    )
    out: dict[str | None, tuple[np.ndarray, dict[bytes, float]]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"] or "", r["part"], r["key"])):
        shape, words = out.setdefault(r["lang"], (np.zeros(len(CLASSES)), {}))
        if r["part"] == 1:
            shape[int(r["key"])] = r["share"]
        else:
            words[bytes(r["key"])] = r["share"]
    return out


def distances(text: str, words: list[bytes], reference: tuple[np.ndarray, dict[bytes, float]]) -> tuple[float, float]:
    """Jensen-Shannon distances of the class and the common-word histograms."""
    shape, common_words = reference
    seen = dict.fromkeys(common_words, 0)
    for w in words:
        if len(w) <= WORD_BYTES and (w := bare(w)) in seen:
            seen[w] += 1
    n = len(words)
    p = np.array([*seen.values(), n - sum(seen.values())], dtype=float) / max(1, n)
    q = np.array([*common_words.values(), max(0.0, 1 - sum(common_words.values()))])
    return js_distance(classes(text), shape), js_distance(p, q)


def verdict(n_words: int, class_distance: float, word_distance: float) -> bool:
    root = math.sqrt(max(1, n_words))
    return class_distance <= CLASS_BOUND + CLASS_SLACK / root and word_distance <= WORD_BOUND + WORD_SLACK / root


def rate(docs: DataFrame, text: str = "text", lang: str = "lang", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per document: kept columns, base counts, ``class_distance``, ``word_distance``, ``base_failed``, ``kept``.

    A null text is empty and fails the base rules; its distances are null, as
    are those of every text below the least length. Two passes: references,
    then verdicts; only the bounded references go through the driver.
    """
    references = learn(docs, text, lang)
    # a kept text is passed on, not sent a second time
    held = text if text in keep else "__text"

    def run(cols: dict[str, list]) -> dict[str, list]:
        rows = []
        for language, t in zip(cols["__lang"], cols[held]):
            words, chars, symbols, dup, again = base_counts(t := t or "")
            failed = base_failed(len(words), again)
            far = (None, None)
            if len(words) >= LEAST_WORDS and references:
                far = distances(t, words, references.get(language) or references[None])
            ok = not failed and (far[0] is None or verdict(len(words), *far))
            rows.append((len(words), chars, symbols, dup, again, *far, failed, ok))
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance", "base_failed", "kept")
        return cols | dict(zip(names, map(list, zip(*rows))))

    given = docs.select(
        *[F.col(f"`{c}`") for c in keep], F.col(f"`{lang}`").alias("__lang"),
        *([] if held == text else [F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text")]),
    )
    schema = (
        common.fields(docs, keep) + ", " * bool(keep)
        + "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "class_distance double, word_distance double, base_failed boolean, kept boolean"
    )
    return common.map_batches(given, run, schema, slices=held)
