"""Registered queries of this package; each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyfold.llm import (
    decontaminate, language, periodic, pieces, pii, pitman_yor, quality, secrets, sharding, simhash, toxicity, warc,
    whitening,
)
from tallyfold.llm.common import table

# The public tokenizer of the box; another installation names its own file.
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.identify(table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.held_out(table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("n_near_items", "near_items", "near_items_sha256")


def op8_benchmark_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the SQL of the exact matches does not cover: items whose words stand near their places, per document."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "contaminated", "n_near_items", "near_items", "near_items_sha256")


def op9_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), TOKENIZER)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.by_checksum(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def _fold(modulus: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), _fold(4) != 2)
    return toxicity.score(docs, model).select("doc_id", (_fold(4) == 2).alias("held_out"), "score", "predicted")


def planted_words(docs: DataFrame) -> DataFrame:
    """``(doc_id, words)``: the words of each text, made periodic from a point where crc32 of the id ends in 0."""
    words = F.coalesce(F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), 0), F.array().cast("array<string>"))
    h = F.crc32(F.col("doc_id").cast("string"))
    n, g = F.size("w"), F.floor(h / 10)
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
    moved = F.transform("w", lambda x, i: F.when(i >= a, F.element_at("w", (a + F.pmod(i - a, p) + 1).cast("int"))).otherwise(x))
    return docs.select("doc_id", words.alias("w")).select(
        "doc_id", F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), moved).otherwise(F.col("w")).alias("words")
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.detect(planted_words(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scans": op1_secret_scans,
    "op2_pii": op2_pii,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_warc": op4_warc,
    "op5_sharding": op5_sharding,
    "op6_quality_rules": op6_quality_rules,
    "op7_language_id": op7_language_id,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op8_benchmark_proximity": op8_benchmark_proximity,
    "op9_sentencepiece_nbest": op9_sentencepiece_nbest,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_toxicity": op12_toxicity,
    "op13_periodic_runs": op13_periodic_runs,
}

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

SQL: dict[str, str] = {
    # Windows as texts, met by equality: the plain reading of what the index finds.
    "op8_benchmark_decontamination": f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
want AS (
  SELECT DISTINCT item, array_to_string(w[i:i + 9], ' ') AS win, least(10, len(w)) AS n
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
place AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM want) WHERE len(w) >= n)),
hit AS (SELECT r, i, p.n, item FROM place p JOIN want q ON p.win = q.win AND p.n = q.n),
covered AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hit) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN named USING (r)""",
}
