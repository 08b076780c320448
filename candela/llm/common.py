"""Shared helpers: reading tables, cutting lineage, text passes, components."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: White space of the contracts: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a folder of its own; any other
    master is refused, since its executors would not see the files.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="candela-llm-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stored(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: a lost executor repeats reads, not what came before, and
    values that a rerun could change (row ids) stay as they were written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """``mapInArrow`` with this package on the workers' search path, as where a checked-out repository is run from another folder."""
    env = df.sparkSession.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)
    return df.mapInArrow(fn, schema)


def map_batches(
    df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: StructType | str, slices: bool | str = False
) -> DataFrame:
    """Apply ``fn`` (columns in, columns out, as lists) to Arrow batches of rows.

    ``slices``: to parts of them whose column ``__text`` (or the one named) is
    of bounded size, for functions that hold much more than the text itself.
    With a name, columns that ``fn`` hands back as they came are not built anew.
    """
    sized = slices if isinstance(slices, str) else "__text"
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(kind)
        for batch in batches:
            part = None
            for part in text_slices(batch, sized) if slices else [batch]:
                if part.num_rows:
                    given = {n: part.column(n).to_pylist() for n in part.schema.names}
                    out = fn(given)
                    made = [
                        part.column(f.name).cast(f.type) if isinstance(slices, str) and out[f.name] is given.get(f.name) else pa.array(out[f.name], type=f.type)
                        for f in arrow
                    ]
                    yield pa.RecordBatch.from_arrays(made, schema=arrow)
                    del given, out, made
            # not held while the next one is read
            del batch, part

    return map_arrow(df, run, kind)


def text_slices(batch: pa.RecordBatch, text: str = "__text", chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, each of one row or of at most ``chars`` code points (bytes of a binary column)."""
    column = batch.column(batch.schema.names.index(text))
    size = (pc.binary_length if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pc.utf8_length)(column).fill_null(0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(size.tolist()):
        if i > start and total + n > chars:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def keep_and_text(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """The kept columns and the text (null: empty) under a name of its own."""
    return df.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))


#: Entries of a hashed set of document ids, at most.
HASHED = 1 << 20


def may_be_among(docs: DataFrame, doc_id: str, wanted: DataFrame, wanted_id: str) -> DataFrame:
    """The documents whose hashed id is that of a wanted one: all wanted ones, and few others while few are wanted.

    The hashed ids are broadcast; there are at most ``HASHED`` of them.
    """

    def hashed(c: str) -> Column:
        return F.pmod(F.xxhash64(F.col(f"`{c}`")), F.lit(HASHED))

    some = F.broadcast(wanted.select(hashed(wanted_id).alias("__hashed")).distinct())
    return docs.join(some, hashed(doc_id) == F.col("__hashed"), "left_semi")


def fields(df: DataFrame, keep: Sequence[str]) -> str:
    """DDL of the kept columns."""
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected ``edges``: rows (node, root), root the smallest node.

    Alternates large-star and small-star steps until nothing changes. Each
    step is one grouped minimum and one join on the node, so a node with any
    number of neighbours is combined before the shuffle and can be split by
    the adaptive skew join; each round is written to the shared folder. Nodes
    without an edge have no row. Links with a null end are ignored.
    """
    step = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct()
    )
    last = None
    while True:
        mark = step.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if mark["n"] == 0 or mark == last:
            break
        last = mark
        both = step.unionByName(step.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(low, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        step = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct())
    found = step.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
