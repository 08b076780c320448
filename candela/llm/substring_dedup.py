"""Substring dedup by paragraph MinHash banding.

Paragraphs do not depend on line ends. The words of a text, in lower case
(A to Z), are cut before each pair of neighbouring words whose hash is the
least (the first of equal ones) among the ``REACH`` pairs on either side, so
two texts that share a passage cut it alike but for ``REACH`` words at its
ends, however it is wrapped or embedded. Paragraphs have more than ``REACH``
words, 21 on average: what is shorter at the ends of a text is joined to its
neighbour, and a text of at most ``REACH`` words has none. They are compared
by their five-word shingles, taken as 64-bit hashes.

1. Each paragraph gets ``HASHES`` minima of its shingles, banded so that a
   pair of the wanted similarity collides in some band with at least the
   wanted recall (``banding``). Equal paragraphs need no band.
2. Equal paragraphs become one. Distinct ones that collide are verified by the
   exact Jaccard similarity of their shingle sets.
3. Groups are connected components. A paragraph is first compared with the
   first one of each of its buckets, so a bucket of n copies costs about n
   comparisons. Buckets that then still hold several components go, in chunks
   and pairs of chunks, to tasks that compare all paragraphs of different
   components there and pass on no more links than connect them: no pairs are
   made as rows, no bucket is gathered whole, and no link is lost.
4. The first occurrence of a group, by document id, then text and place in it,
   is kept; the others are the removals.

Documents with the same id and the same text are one document. Null ids come
after all others; null texts have no paragraphs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.llm import common

#: Word pairs on either side that a cut is compared with.
REACH = 10
SHINGLE, SIMILARITY = 5, 0.8
HASHES, RECALL = 8, 0.98
#: Paragraphs of a bucket in a chunk, and columns of an incidence matrix held at once.
CHUNK, COLUMNS = 512, 8192
MIX = np.uint64(0x9E3779B97F4A7C15)


def banding(similarity: float = SIMILARITY, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows a band (the fewest chance collisions) that keep the recall at the similarity."""
    fits = [r for r in range(1, hashes + 1) if 1 - (1 - similarity**r) ** (hashes // r) >= recall]
    rows = max(fits, default=1)
    return hashes // rows, rows


BANDS, ROWS = banding()
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
FACTOR = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFT = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def mixed_runs(h: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` neighbouring hashes."""
    n = max(0, len(h) - length + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(length):
        out = (out + h[k : k + n]) * MIX
        out ^= out >> np.uint64(32)
    return out


def cuts(h: np.ndarray, reach: int) -> list[int]:
    """Where paragraphs begin, among words of these hashes, and the end of the last."""
    n = len(h)
    if n <= 2 * reach + 1:
        return [0, n]
    pairs = mixed_runs(h, 2)
    ends = np.full(reach, np.iinfo(np.uint64).max, dtype=np.uint64)
    least, size = np.concatenate([ends, pairs, ends]), 1
    while size < reach:  # minima of runs of `reach` pairs, by doubling
        step = min(size, reach - size)
        least, size = np.minimum(least[:-step], least[step:]), size + step
    m = len(pairs)
    at = np.flatnonzero((pairs < least[:m]) & (pairs <= least[reach + 1 : reach + 1 + m]))
    return [0, *at[(at > reach) & (at < n - reach)].tolist(), n]


def places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a UTF-8 text, in code points."""
    b = np.frombuffer(data, dtype=np.uint8)
    white = np.ones(len(b) + 2, dtype=bool)
    white[1:-1] = (b == 32) | ((b >= 9) & (b <= 13))
    at = np.flatnonzero(white[1:] != white[:-1])
    if not data.isascii():
        at = at - np.concatenate([[0], np.cumsum((b & 0xC0) == 0x80)])[at]
    return at[::2], at[1::2]


def cut_words(data: bytes) -> tuple[list[bytes], np.ndarray, list[int]]:
    """(words, shingles, edges) of a UTF-8 text: a paragraph has the words from one edge to the next."""
    words = data.lower().split()
    if len(words) <= REACH:
        return words, np.empty(0, dtype=np.uint64), []
    # hashing a word takes less than finding it among the many words of a corpus
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    return words, mixed_runs(h, SHINGLE), cuts(h, REACH)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Band hashes, a row for each set of shingles."""
    every = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    bands = np.zeros((len(sets), BANDS), dtype=np.uint64)
    for p in range(BANDS * ROWS):
        least = np.minimum.reduceat((every ^ SHIFT[p]) * FACTOR[p], starts)
        bands[:, p // ROWS] = (bands[:, p // ROWS] + least) * MIX
        bands[:, p // ROWS] ^= bands[:, p // ROWS] >> np.uint64(29)
    return bands


def _given(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.where(F.col(f"`{text}`").isNotNull()).select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(f"`{text}`").alias("text_key"), F.col(f"`{text}`").alias("__text")
    )


def signed_paragraphs(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Rows (doc_id, text_key, unit, start, end, n_words, key, b0 ...): all paragraphs with their band hashes."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        sets: list[np.ndarray] = []
        out: dict[str, list] = {n: [] for n in ("doc_id", "text_key", "unit", "start", "end", "n_words", "key")}
        for doc, key, t in zip(cols["doc_id"], cols["text_key"], cols["__text"]):
            data = t.encode()
            words, runs, edges = cut_words(data)
            if not edges:
                continue
            starts, ends = places(data)
            at, n = np.array(edges), len(edges) - 1
            sets += [runs[a : b - SHINGLE + 1] for a, b in pairwise(edges)]
            digests = [xxhash.xxh3_128_digest(b" ".join(words[a:b])) for a, b in pairwise(edges)]
            rows = ([doc] * n, [key] * n, range(n), starts[at[:-1]].tolist(), ends[at[1:] - 1].tolist(), np.diff(at).tolist(), digests)
            for values, v in zip(out.values(), rows):
                values += v
        bands = signatures(sets).view(np.int64) if sets else np.empty((0, BANDS), dtype=np.int64)
        return out | {f"b{i}": bands[:, i] for i in range(BANDS)}

    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, text_key long, unit int, start int, end int, n_words int, key binary, "
    return common.map_batches(_given(docs, text, doc_id), run, schema + ", ".join(f"b{i} long" for i in range(BANDS)), slices=True)


def shingle_sets(docs: DataFrame, wanted: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Rows (id, shingles): sorted distinct shingle hashes of paragraphs, read where each occurs first."""
    # One row a document that is read, with the paragraphs wanted of it: at most its own.
    units = wanted.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("unit", "id"))).alias("wanted"))
    given = _given(common.may_be_among(docs.select(f"`{doc_id}`", f"`{text}`"), doc_id, wanted, "doc_id"), text, doc_id)
    there = given.join(
        units.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "wanted"),
        F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key")),
    ).select("__text", "wanted")

    def run(cols: dict[str, list]) -> dict[str, list]:
        ids, sets = [], []
        for t, wanted in zip(cols["__text"], cols["wanted"]):
            _, runs, edges = cut_words(t.encode())
            for w in wanted:
                ids.append(w["id"])
                sets.append(np.unique(runs[edges[w["unit"]] : edges[w["unit"] + 1] - SHINGLE + 1]).tobytes())
        return {"id": ids, "shingles": sets}

    # a document that is there twice gives its paragraphs twice
    return common.map_batches(there, run, "id long, shingles binary", slices=True).dropDuplicates(["id"])


def jaccard(x: bytes, y: bytes) -> float:
    a, b = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def near_pairs(sets: list[np.ndarray]) -> np.ndarray:
    """Which pairs of shingle sets reach the wanted similarity (a square of booleans)."""
    size = np.array(list(map(len, sets)), dtype=np.int64)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1  # a shingle of one set only is in no intersection
    row = np.repeat(np.arange(len(sets)), size)
    use = count[column] > 1
    row, column = row[use], shared[column[use]]
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for low in range(0, int(column.max()) + 1 if len(column) else 0, COLUMNS):
        here = (column >= low) & (column < low + COLUMNS)
        part = np.zeros((len(sets), min(COLUMNS, int(column.max()) + 1 - low)), dtype=np.float32)
        part[row[here], column[here] - low] = 1
        both += part @ part.T  # whole numbers far below 2^24: exact
    both = both.astype(np.float64)
    return both / np.maximum(size[:, None] + size[None, :] - both, 1) >= SIMILARITY


def forest(ids: list[int], roots: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect the components among the paragraphs just as all their links do."""
    near = near_pairs(sets)
    _, label = np.unique(np.array(roots), return_inverse=True)
    edges = []
    for x in range(len(ids)):
        found = np.flatnonzero(near[x] & (label != label[x]))
        while len(found):
            y = int(found[0])
            edges.append((ids[x], ids[y]))
            label[label == label[y]] = label[x]
            found = found[label[found] != label[x]]
    return edges


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (t, k, i, j, id, root, shingles), sorted by the first four: the forest of each run of these."""

    def edges(rows: list[tuple]) -> pa.RecordBatch:
        found = forest([r[4] for r in rows], [r[5] for r in rows], [np.frombuffer(r[6], dtype=np.uint64) for r in rows])
        a, b = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(7))):
            if held and held[0][:4] != row[:4]:
                yield edges(held)
                held = []
            held.append(row)
    if held:
        yield edges(held)


def verified(pairs: DataFrame, distinct: DataFrame, docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The pairs (a, b) of at least the wanted similarity."""
    pairs = common.stored(pairs.distinct())
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = common.stored(shingle_sets(docs, distinct.join(ids, "id", "left_semi"), text, doc_id))
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
    both = both.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")

    def run(cols: dict[str, list]) -> dict[str, list]:
        near = [i for i, (x, y) in enumerate(zip(cols["x"], cols["y"])) if jaccard(x, y) >= SIMILARITY]
        return {"a": [cols["a"][i] for i in near], "b": [cols["b"][i] for i in near]}

    return common.stored(common.map_batches(both, run, "a long, b long"))


def groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per occurrence of a paragraph whose group has at least two.

    Columns: ``doc_id``, ``text_key`` (hash of the text), ``unit``
    (the paragraph's number in its text), ``start``
    and ``end`` (code points, end exclusive), ``n_words``, ``group_id`` and
    ``kept``, true for the group's first occurrence.
    """
    found = common.stored(signed_paragraphs(docs, text, doc_id))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "unit")
    bands = [f"b{i}" for i in range(BANDS)]
    once = found.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("last"), *[F.min(b).alias(b) for b in bands])
    distinct = common.stored(
        once.select(
            F.monotonically_increasing_id().alias("id"), "key", *bands, "first.doc_id", "first.text_key", "first.unit",
            (F.col("first") != F.col("last")).alias("again"),
        )
    )
    bucket = Window.partitionBy("t", "k")
    buckets = common.stored(
        distinct.select("id", F.posexplode(F.array(*bands)).alias("t", "k"))
        .select("id", "t", "k", F.count("*").over(bucket).alias("n"), F.min("id").over(bucket).alias("lead"))
        .where("n > 1")
        .drop("n")
    )
    edges = verified(buckets.where("id != lead").select(F.col("lead").alias("a"), F.col("id").alias("b")), distinct, docs, text, doc_id)
    first = common.stored(common.components(edges))
    named = buckets.select("id", "t", "k").join(first.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    ordered = bucket.orderBy("id")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    mixed = common.stored(
        named.select(
            "id", "root", "t", "k", F.count("*").over(whole).alias("n"), F.row_number().over(ordered).alias("at"),
            (F.min("root").over(whole) != F.max("root").over(whole)).alias("open"),
        ).where("open")
    )
    sets = shingle_sets(docs, distinct.join(mixed.select("id").distinct(), "id", "left_semi"), text, doc_id)
    chunk, last = F.floor((F.col("at") - 1) / CHUNK), F.floor((F.col("n") - 1) / CHUNK)
    dealt = (
        mixed.join(sets, "id")
        .withColumn("own", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .select(F.col("t").cast("long").alias("t"), "k", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "root", "shingles")
        .repartition("t", "k", "i", "j")
        .sortWithinPartitions("t", "k", "i", "j")
    )
    more = common.stored(common.map_arrow(dealt, _forests, "a long, b long"))
    linked = common.components(edges.unionByName(more))

    rooted = distinct.drop(*bands).join(linked.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    heads = (
        rooted.groupBy("root")
        .agg(F.min(place).alias("head"), F.min(F.hex("key")).alias("group_id"), F.count("*").alias("n"), F.bool_or("again").alias("again"))
        .where("n > 1 or again")
        .select("root", "head", "group_id")
    )
    of_key = common.stored(rooted.select("key", "root").join(heads, "root").select("key", "head", "group_id"))
    return found.join(of_key, "key").select(
        "doc_id", "text_key", "unit", "start", "end", "n_words", "group_id", place.eqNullSafe(F.col("head")).alias("kept")
    )


def without(text: str, spans: Sequence[tuple[int, int]]) -> str:
    """The text without these stretches (in order, apart) and the blanks after each."""
    parts, at = [], 0
    for start, end in spans:
        parts.append(text[at:start])
        while end < len(text) and text[end] in " \t":
            end += 1
        at = end
    return "".join(parts) + text[at:]


def remove(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """All documents, all columns; ``text`` without the paragraphs that are not kept (a text that loses all: empty).

    The other columns pass through unread; ``__cd_`` names are reserved.
    """
    if taken := [c for c in docs.columns if c.startswith("__cd_")]:
        raise ValueError(f"reserved column names: {taken}")
    span = F.struct("start", "end")
    gone = groups(docs, text, doc_id).where(~F.col("kept")).groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set(span)).alias("__cd_gone"))
    gone = gone.select(F.col("doc_id").alias("__cd_id"), F.col("text_key").alias("__cd_key"), "__cd_gone")
    own = docs.withColumn("__cd_own", F.xxhash64(f"`{text}`"))
    both = own.join(gone, F.col(f"`{doc_id}`").eqNullSafe(F.col("__cd_id")) & (F.col("__cd_own") == F.col("__cd_key")), "left")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([without(t, [(x["start"], x["end"]) for x in found]) for t, found in zip(texts, spans)], dtype=object)

    changed = F.when(F.col("__cd_gone").isNull(), F.col(f"`{text}`")).otherwise(cut(F.coalesce(f"`{text}`", F.lit("")), F.coalesce("__cd_gone", F.array())))
    return both.select(*[changed.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
