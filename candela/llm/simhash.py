"""SimHash near-duplicates by covering locality-sensitive hashing.

Bit i of a fingerprint is given the vector phi(i), one of the 2^(r+1) - 1
nonzero vectors of r + 1 bits, in turn. For every nonzero v there is a mask of
the bits with an odd product phi(i) . v. Fingerprints that differ in at most r
bits: the vectors of those bits span at most r dimensions, so some v is
orthogonal to all of them, and its mask leaves all of them out. Hence every
pair within the radius agrees under at least one mask: no pair is missed.
Each mask keeps about half the bits, so other pairs seldom agree.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.llm import common

BITS = 64
#: Fingerprints of a bucket compared at once; larger buckets are dealt out as pairs of chunks.
CHUNK = 1024


def shingles(words: list[bytes], size: int) -> list[bytes]:
    """Space-joined runs of ``size`` words; of fewer words all of them, of none nothing."""
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - size]]
    return [joined[a : b - 1] for a, b in zip(starts, ends[size - 1 :])]


def fingerprint(text: str, size: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of a text, unsigned; no words: zero."""
    parts = shingles(text.encode().lower().split(), size)
    if not parts:
        return 0
    digest = xxhash.xxh64_intdigest
    count = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(parts), 1 << 16):
        block = np.fromiter((digest(x, seed) for x in parts[k : k + (1 << 16)]), dtype=">u8")
        count += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > len(parts)).tobytes(), "big")


def masks(radius: int) -> list[int]:
    """The covering masks, as signed 64-bit integers."""
    side = 1 << (radius + 1)
    out = [sum(1 << i for i in range(BITS) if ((1 + i % (side - 1)) & v).bit_count() % 2) for v in range(1, side)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def fingerprints(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), size: int = 4, seed: int = 42) -> DataFrame:
    """The kept columns and ``fingerprint`` (the 64 bits as a signed long). Null or empty text: zero."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        found = [fingerprint(t, size, seed) for t in cols["__text"]]
        cols["fingerprint"] = [x - (1 << 64) if x >> 63 else x for x in found]
        return cols

    schema = ", ".join(x for x in (common.fields(docs, keep), "fingerprint long") if x)
    return common.map_batches(common.keep_and_text(docs, text, keep), run, schema)


def spanning(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges from the first member of each component to the others, for the graph of all links among ``fps`` (unsigned)."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    fresh = np.ones(len(fps), dtype=bool)
    edges = []
    for root in range(len(fps)):
        if fresh[root]:
            fresh[root] = False
            queue = [root]
            for x in queue:
                found = np.flatnonzero(near[x] & fresh)
                fresh[found] = False
                queue.extend(found.tolist())
            edges += [(root, y) for y in queue[1:]]
    return edges


def _linked(radius: int):
    """mapInArrow function over rows (bucket, fp) sorted by bucket: edges of each bucket's spanning forest."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_bucket = np.empty((0, 4), dtype=np.int64)
        held_fp = np.empty(0, dtype=np.int64)

        def edges_of(bucket: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            cut = np.flatnonzero((bucket[1:] != bucket[:-1]).any(axis=1)) + 1
            starts, ends = np.r_[0, cut], np.r_[cut, len(fp)]
            two = starts[ends - starts == 2]
            x, y = fp[two], fp[two + 1]
            near = np.bitwise_count((x ^ y).view(np.uint64)) <= radius
            a, b = [x[near]], [y[near]]
            for s, e in zip(starts, ends):
                if e - s > 2:
                    # A chunk paired with itself comes once, so no fingerprint is there twice.
                    pairs = np.array(spanning(fp[s:e].view(np.uint64), radius), dtype=np.int64).reshape(-1, 2)
                    a.append(fp[s:e][pairs[:, 0]])
                    b.append(fp[s:e][pairs[:, 1]])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

        for batch in batches:
            bucket = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)])
            bucket = np.concatenate([held_bucket, bucket])
            fp = np.concatenate([held_fp, batch.column(4).to_numpy(zero_copy_only=False)])
            change = np.flatnonzero((bucket[1:] != bucket[:-1]).any(axis=1))
            done = int(change[-1]) + 1 if len(change) else 0  # the last bucket may go on
            held_bucket, held_fp = bucket[done:], fp[done:]
            if done:
                yield edges_of(bucket[:done], fp[:done])
        if len(held_fp):
            yield edges_of(held_bucket, held_fp)

    return link


def links(distinct: DataFrame, radius: int, fp: str = "fingerprint") -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect exactly what all links within ``radius`` connect.

    Buckets with one fingerprint go before any Python code runs. A bucket's
    fingerprints are cut into chunks and every pair of chunks is a task's work
    of its own, so that no bucket is ever gathered in one place, and only a
    spanning forest of each is passed on, never all its pairs.
    """
    found = distinct.select(F.posexplode(F.array(*[F.col(fp).bitwiseAND(F.lit(m)) for m in masks(radius)])).alias("t", "key"), fp)
    whole = Window.partitionBy("t", "key").orderBy(fp)
    full = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sized = (
        found.withColumn("n", F.count("*").over(full))
        .withColumn("at", F.row_number().over(whole))
        .where("n > 1")
        .withColumn("chunk", F.floor((F.col("at") - 1) / CHUNK))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK))))
        .select(
            F.col("t").cast("long").alias("t"), "key", F.least("chunk", "other").alias("i"),
            F.greatest("chunk", "other").alias("j"), F.col(fp).alias("fp"),
        )
    )
    dealt = sized.repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j")
    return common.map_arrow(dealt, _linked(radius), "a long, b long")


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 4, seed: int = 42, radius: int = 4,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document: ``doc_id``, the kept columns, ``fingerprint`` (signed long), ``component``, ``component_id``.

    ``component`` names the component by a fingerprint of it; ``component_id``
    is the smallest id among the documents that links reach, the document
    itself included. Equal fingerprints are linked. Documents without words
    have the fingerprint zero and are linked like any other. Null ids keep
    their row and count for no ``component_id`` (null where all are).
    """
    own = common.stored(fingerprints(docs, text, (doc_id, *keep), size, seed))
    distinct = common.stored(own.groupBy("fingerprint").agg(F.min(f"`{doc_id}`").alias("least")))
    nodes = common.components(links(distinct, radius))
    rooted = distinct.join(nodes, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("component"), "least"
    )
    low = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    names = common.stored(rooted.join(low, "component").select(F.col("fingerprint").alias("__fp"), "component", "component_id"))
    joined = own.join(names, F.col("fingerprint") == F.col("__fp"))
    return joined.select(f"`{doc_id}`", *[f"`{c}`" for c in keep], "fingerprint", "component", "component_id")


def hexadecimal(fp):
    """16 lowercase hex digits of a fingerprint column."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
