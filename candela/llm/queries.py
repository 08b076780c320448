"""The registered queries: each applies one operator to its whole table and derives the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm import (
    bpe, decontaminate, html_extract, line_dedup, pii, pitman_yor, quality, ranked_search, secret_scan, simhash, substring_dedup, token_files,
    whitening,
)
from candela.llm.common import table

VOCABULARY = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
#: Tokenizer file of the token-id output, and the id that ends a document.
WORD_TOKENIZER, END_ID = public_tokenizers.path("word_bpe_49k.json"), 2


def _joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _base(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["base"])


def _count(kind: str) -> Column:
    """Number of base spans of a kind."""
    return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")


def _digest(found: DataFrame, counted: tuple[str, ...]) -> DataFrame:
    base = F.sha2(_joined(_base(F.col("spans"))).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *map(_count, counted), base, _joined(F.col("spans")).alias("spans"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return _digest(pii.detect(table(spark, sf_dir, "documents")), pii.KINDS[:4])


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line (or stretch of a long line) whose group has more than one occurrence, and whether it is kept."""
    return line_dedup.groups(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds, with the stretch of the text and its similarity."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.leaked(decontaminate.annotate(docs, items))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the bytes they decode to."""
    ids = bpe.encode(table(spark, sf_dir, "documents"), *VOCABULARY).select(
        "doc_id", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256")
    )
    back = bpe.decode(ids, *VOCABULARY, keep=("doc_id", "n_tokens", "ids_sha256"))
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base score and model score of every document."""
    return pitman_yor.score(table(spark, sf_dir, "documents"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    return quality.rate(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph whose group has more than one occurrence, and whether it is kept."""
    return substring_dedup.groups(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return _digest(secret_scan.scan(table(spark, sf_dir, "documents")), secret_scan.KINDS[:3])


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the leading components, whitened."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document as read back from the files they were written to."""
    files = token_files.write(table(spark, sf_dir, "documents"), WORD_TOKENIZER, end=END_ID)
    return token_files.digests(files)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest-scoring documents of every benchmark item."""
    return ranked_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: All documents that hold a term of an item are scored, then ranked.
RANKED_SEARCH_SQL = r"""
WITH folded AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, CAST(len(ws) AS BIGINT) AS n, ws FROM folded WHERE len(ws) > 0),
i AS (
  SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM benchmark),
asked AS (SELECT q, w, count(*) AS times FROM (SELECT q, unnest(ws) AS w FROM i) GROUP BY q, w),
held AS (SELECT r, w, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(ws) AS w FROM d) WHERE w IN (SELECT w FROM asked) GROUP BY r, w),
total AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
weighted AS (
  SELECT w, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight
  FROM (SELECT w, CAST(count(*) AS BIGINT) AS df FROM held GROUP BY w), total),
scored AS (
  SELECT q, r, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN held USING (w) JOIN weighted USING (w) JOIN d USING (r), total GROUP BY q, r),
ranked AS (
  SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored JOIN d USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN i USING (q) WHERE rank <= 10
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_pii, op2_line_dedup, op3_decontamination, op4_bpe, op5_lm_scores,
        op6_html, op7_quality, op8_simhash, op9_substring_dedup, op10_secrets,
        op11_whitening, op12_token_files, op13_ranked_search,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op13_ranked_search": RANKED_SEARCH_SQL}
