"""The corpus pipeline: stages that each call one operator on what the stage before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every result as a table in the shared folder and reads it back for the next.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm import bpe, decontaminate, line_dedup, quality, simhash
from candela.llm.common import stored, table
from candela.llm.queries import VOCABULARY


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject."""
    return quality.rate(docs, keep=docs.columns).where("kept").select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every line but the first of each group of alike lines; ``n_chars`` follows the text."""
    found = line_dedup.remove(docs)
    return found.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of near-duplicates.

    The one with the smallest id, then by a hash of the text where an id is
    there twice; a null id comes last. Of rows that repeat one stays.
    """
    keyed = docs.withColumn("__key", F.xxhash64("text"))
    rows = stored(simhash.near_duplicates(keyed, keep=("__key",)).groupBy("component", "doc_id", "__key").agg(F.count("*").alias("n")))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__key")
    first = rows.groupBy("component").agg(F.min(order).alias("first"))
    marked = rows.join(first, "component").select(F.col("doc_id").alias("__id"), F.col("__key").alias("__own"), "n", order.eqNullSafe(F.col("first")).alias("stays"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__own"))
    single = keyed.join(marked.where("not stays or n > 1"), same, "left_anti")
    repeated = keyed.join(marked.where("stays and n > 1"), same, "left_semi").dropDuplicates(["doc_id", "__key"])
    return single.unionByName(repeated).select(*docs.columns)


def without_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    found = decontaminate.annotate(docs, table(spark, sf_dir, "benchmark"), keep=docs.columns)
    return found.where(F.size("leaks") == 0).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes each text; the text itself gives way to its ids, a digest of them and of what they decode to.

    The ids are written in between: else every task would hold two Python
    workers at once, each with the vocabulary and batches of its own.
    """
    ids = stored(bpe.encode(docs, *VOCABULARY, keep=("doc_id", "lang", "source")))
    back = bpe.decode(ids, *VOCABULARY, keep=("doc_id", "lang", "source", "ids"))
    return back.select(
        "doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", without_repeated_lines),
    ("SimHash near-dedup", without_near_duplicates),
    ("benchmark decontamination", without_benchmark_items),
    ("byte-level BPE", encode),
]

#: SQL cannot express the stages; tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
