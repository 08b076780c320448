"""Ranked lexical search: best-first document intervals bounded by range maxima of posting lists.

The documents are read once into a forward index of the queries' terms (terms,
their counts, the document's length) and into the counts over all documents.
Tasks then take it in shards. A shard has one posting list a term, in document
order, with the impact of every posting, and over the lists a sparse table of
the place of the greatest impact in any range of 2^j postings.

For a query, an interval of the shard's documents is bounded by the sum over
its terms of the greatest impact that the term's postings have there: two table
look-ups a term. The intervals of greatest bound go first. Each is split at the
document of greatest impact of the term that adds most to the bound; that
document is scored, the parts on either side are bounded and wait in turn. An
interval whose bound is below the k-th best score is done with. A first pass
scores, in every shard, only the documents of greatest impact of each term;
their k-th best score over all shards is where the second pass starts from.

Documents of a shard that have the same terms, counts and length are searched as
one, and are ordered by their most frequent terms, so that documents of one kind
lie together; the order only changes how soon intervals are done with.

Queries come in blocks of about ``BLOCK_TERMS`` terms: that is what is collected
and sent to the tasks, each block against all rows. Null texts have no terms; a
query without terms, or without a document that holds one, has no row. Rows that
repeat are ranked each on its own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.llm import common

K = 10
#: Terms of a block of queries, about.
BLOCK_TERMS = 1 << 19
#: Postings of a shard, about.
SHARD_POSTINGS = 1 << 21
#: Intervals split at once: first, and at most.
FIRST_SPLITS, MOST_SPLITS = 8, 1024

#: Signs between terms become spaces, A-Z become a-z; bytes of other signs stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


#: Bytes of a text that are cut into terms at once.
STRETCH = 1 << 22


def count_terms(text: str) -> tuple[int, Counter[bytes]]:
    """Number of terms of a text, and how often each occurs."""
    folded = text.encode().translate(_FOLD)
    n, found, start = 0, Counter(), 0
    while start < len(folded):
        end = folded.find(b" ", start + STRETCH)
        words = folded[start : end if end >= 0 else len(folded)].split()
        n += len(words)
        found.update(words)
        start = end if end >= 0 else len(folded)
    return n, found


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Of a term's count in a document of ``n`` terms, without the term's weight."""
    if 75 * int(n.max(initial=0)) * n_docs < 1 << 63:
        m = 25 + (75 * n * n_docs) // n_terms
    else:
        m = np.array([25 + (75 * int(x) * n_docs) // n_terms for x in n], dtype=np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Shard:
    """Posting lists of some documents, with their range-maximum table."""

    def __init__(self, docs: list[tuple[int | None, int, bytes, bytes]], n_docs: int, n_terms: int, k: int):
        same: dict[tuple[int, bytes, bytes], list] = {}
        for doc_id, *vector in docs:
            same.setdefault(tuple(vector), []).append(doc_id)
        split = [(np.frombuffer(t, "<i4"), np.frombuffer(c, "<i4"), n, ids) for (n, t, c), ids in same.items()]
        split.sort(key=lambda d: d[0][np.argsort(-d[1], kind="stable")[:3]].tolist())
        # of equal documents the k first in rank are the k of smallest id
        self.ids = [sorted(ids, key=lambda i: (i is None, i or 0))[:k] for *_, ids in split]
        self.size = len(split)
        count = np.array([len(t) for t, *_ in split], dtype=np.int64)
        doc = np.repeat(np.arange(self.size), count)
        term = np.concatenate([t for t, *_ in split]).astype(np.int64)
        tf = np.concatenate([c for _, c, *_ in split]).astype(np.int64)
        length = np.repeat(np.array([n for *_, n, _ in split], dtype=np.int64), count)
        order = np.argsort(term * self.size + doc, kind="stable")
        self.term, self.doc = term[order], doc[order]
        self.keys = self.term * self.size + self.doc
        self.impact = impacts(tf, length, n_docs, n_terms)[order]
        self.listed, self.first = np.unique(self.term, return_index=True)
        self.last = np.append(self.first[1:], len(self.term))
        self.table: np.ndarray | None = None

    def build(self) -> None:
        """The sparse table: row j has, at i, the place of the greatest impact of postings i to i + 2^j."""
        p = len(self.keys)
        levels = int((self.last - self.first).max(initial=1)).bit_length()
        self.table = np.empty((levels, p), dtype=np.int32)
        self.table[0] = np.arange(p)
        for j in range(1, levels):
            half = 1 << (j - 1)
            row, was = self.table[j], self.table[j - 1]
            row[:] = was
            right = was[half:]
            better = self.impact[right] > self.impact[was[: p - half]]
            row[: p - half][better] = right[better]
        self.levels = np.zeros(int((self.last - self.first).max(initial=1)) + 1, dtype=np.int64)
        self.levels[1:] = np.floor(np.log2(np.arange(1, len(self.levels)))).astype(np.int64)

    def lists(self, query: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the query's terms that the shard has: term, weight, start and end of its list."""
        at = np.searchsorted(self.listed, query)
        here = (at < len(self.listed)) & (self.listed[np.minimum(at, len(self.listed) - 1)] == query)
        at = at[here]
        return query[here], weights[here], self.first[at], self.last[at]

    def score(self, docs: np.ndarray, term: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of documents, and for each term the place of the document in its list and whether it is there."""
        want = term[None, :] * self.size + docs[:, None]
        at = np.searchsorted(self.keys, want)
        inside = np.minimum(at, len(self.keys) - 1)
        here = self.keys[inside] == want
        return (np.where(here, self.impact[inside], 0) * w).sum(axis=1), at, here

    def bound(self, low: np.ndarray, high: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Upper bounds of intervals, given as ranges of each term's list, and the document to split each at."""
        size = high - low
        some = size > 0
        j = self.levels[np.maximum(size, 1)]
        a, b = np.where(some, low, 0), np.where(some, high - (1 << j), 0)
        left, right = self.table[j, a], self.table[j, b]
        place = np.where(self.impact[right] > self.impact[left], right, left)
        value = np.where(some, self.impact[place] * w, 0)
        top = value.argmax(axis=1)
        return value.sum(axis=1), self.doc[place[np.arange(len(place)), top]]


class Best:
    """The k best documents of a query: highest score, then smallest id, a null id last."""

    def __init__(self, k: int, least: int):
        self.k, self.least, self.rows = k, least, []

    def add(self, scores: np.ndarray, docs: np.ndarray, shard: Shard) -> None:
        for i in np.flatnonzero(scores >= self.least).tolist():
            s = int(scores[i])
            self.rows += [(-s, d is None, d or 0) for d in shard.ids[int(docs[i])]]
            if len(self.rows) >= 4 * self.k:
                self.cut()
        self.cut()

    def cut(self) -> None:
        self.rows = sorted(self.rows)[: self.k]
        if len(self.rows) == self.k:
            self.least = max(self.least, -self.rows[-1][0])


def probe(shard: Shard, query: np.ndarray, weights: np.ndarray, best: Best) -> None:
    """Scores the document of greatest impact of each of the query's terms."""
    term, w, first, last = shard.lists(query, weights)
    if len(term):
        docs = np.unique([shard.doc[a + int(shard.impact[a:b].argmax())] for a, b in zip(first.tolist(), last.tolist())])
        best.add(shard.score(docs, term, w)[0], docs, shard)


def search(shard: Shard, query: np.ndarray, weights: np.ndarray, best: Best) -> None:
    """Adds the shard's documents that are among the best of the query."""
    term, w, first, last = shard.lists(query, weights)
    if not len(term):
        return
    low, high = first[None, :], last[None, :]
    bound, at = shard.bound(low, high, w)
    splits = FIRST_SPLITS
    while len(bound):
        live = np.flatnonzero(bound >= best.least)
        if len(live) > splits:
            live = live[np.argpartition(-bound[live], splits)]
        now, later = live[:splits], live[splits:]
        if not len(now):
            break
        p, a, b = at[now], low[now], high[now]
        scores, c, here = shard.score(p, term, w)
        best.add(scores, p, shard)
        # before p, and after it
        part_low, part_high = np.concatenate([a, c + here]), np.concatenate([c, b])
        part_bound, part_at = shard.bound(part_low, part_high, w)
        keep = np.flatnonzero((part_bound >= best.least) & (part_bound > 0))
        bound, at = np.concatenate([bound[later], part_bound[keep]]), np.concatenate([at[later], part_at[keep]])
        low, high = np.concatenate([low[later], part_low[keep]]), np.concatenate([high[later], part_high[keep]])
        splits = min(2 * splits, MOST_SPLITS)


def _shards(batches: Iterator[pa.RecordBatch], n_docs: int, n_terms: int, k: int) -> Iterator[Shard]:
    docs, held = [], 0
    for batch in batches:
        for row in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            docs.append(row)
            held += len(row[2]) // 4
            if held >= SHARD_POSTINGS:
                yield Shard(docs, n_docs, n_terms, k)
                docs, held = [], 0
    if docs:
        yield Shard(docs, n_docs, n_terms, k)


def forward_index(docs: DataFrame, doc_id: str, text: str, place: dict[bytes, int]) -> DataFrame:
    """Per document with a term: its id, number of terms, and the numbers and counts of those in ``place``."""
    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in common.text_slices(batch):
                ids, n, number, count = [], [], [], []
                for i, (size, held) in zip(piece.column(0).to_pylist(), map(count_terms, piece.column(1).to_pylist())):
                    if size:
                        found = sorted((place[t], c) for t, c in held.items() if t in place)
                        ids.append(i)
                        n.append(size)
                        number.append(np.array([t for t, _ in found], dtype="<i4").tobytes())
                        count.append(np.array([c for _, c in found], dtype="<i4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(number, pa.binary()), pa.array(count, pa.binary())],
                    names=["id", "n", "terms", "counts"],
                )

    return common.map_arrow(own, run, "id long, n long, terms binary, counts binary")


def statistics(index: DataFrame, n_places: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, their terms with repeats, and the documents that hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, total = np.zeros(n_places, dtype=np.int64), 0, 0
        for batch in batches:
            n += batch.num_rows
            total += sum(batch.column(1).to_pylist())
            held = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<i4")
            df += np.bincount(held, minlength=n_places)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], some]), pa.int32()), pa.array(np.concatenate([[n, total], df[some]]), pa.int64())], names=["t", "x"])

    # as many rows as the block has terms
    rows = common.map_arrow(index, run, "t int, x long").groupBy("t").agg(F.sum("x").alias("x")).collect()
    found = {r["t"]: r["x"] for r in rows}
    return found.get(-2, 0), found.get(-1, 0), np.array([found.get(t, 0) for t in range(n_places)], dtype=np.int64)


def _block(docs: DataFrame, queries: list[tuple[int | None, str]], doc_id: str, text: str, k: int) -> DataFrame | None:
    """Ranked documents of some queries: (q, rank, doc_id, score), q a query's place in the list."""
    counted = [count_terms(t or "")[1] for _, t in queries]
    place = {t: i for i, t in enumerate(sorted(set().union(*counted)))}
    if not place:
        return None
    index = common.stored(forward_index(docs, doc_id, text, place))
    n_docs, n_terms, df = statistics(index, len(place))
    w = np.array([weight(n_docs, int(x)) for x in df], dtype=np.int64)
    made = []
    for c in counted:
        number = np.array(sorted(place[t] for t in c), dtype=np.int64)
        times = np.array([x for _, x in sorted((place[t], x) for t, x in c.items())], dtype=np.int64)
        made.append((number, w[number] * times) if len(number) else (number, times))

    def pass_over(step, least: list[int]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = [Best(k, x) for x in least]
            for shard in _shards(batches, n_docs, n_terms, k):
                if len(shard.keys):
                    if step is search:
                        shard.build()
                    for (number, weights), b in zip(made, best):
                        step(shard, number, weights, b)
            rows = [(q, None if null else d, -s) for q, b in enumerate(best) for s, null, d in b.rows]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64()))], names=["q", "doc_id", "score"])

        found = common.map_arrow(index, run, "q int, doc_id long, score long")
        order = Window.partitionBy("q").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    # the score that k documents reach for certain; one row a query comes back
    reached = [1] * len(queries)
    for r in pass_over(probe, reached).where(F.col("rank") == k).select("q", "score").collect():
        reached[r["q"]] = max(1, r["score"])
    return pass_over(search, reached)


def rank(docs: DataFrame, queries: DataFrame, *, doc_id: str = "doc_id", text: str = "text", query_id: str = "item_id", query: str = "text", k: int = K) -> DataFrame:
    """The ``k`` highest-scoring documents of every query, of those that score above 0: query_id, rank, doc_id, score.

    Equal scores are ranked by ascending document id.
    """
    spark = docs.sparkSession
    own = queries.select(F.col(f"`{query_id}`").cast("long").alias("i"), F.col(f"`{query}`").cast("string").alias("t"))
    size = own.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(size / 4 / BLOCK_TERMS))
    out = spark.createDataFrame([], f"`{query_id}` long, rank int, doc_id long, score long")
    for b in range(blocks):
        mine = own.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b) if blocks > 1 else own
        asked = [(r["i"], r["t"]) for r in mine.collect()]
        found = _block(docs, asked, doc_id, text, k)
        if found is not None:
            named = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(asked)], f"q int, `{query_id}` long")
            out = out.unionByName(found.join(F.broadcast(named), "q").select(f"`{query_id}`", "rank", "doc_id", "score"))
    return out
