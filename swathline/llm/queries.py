"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import credentials, decontaminate, language, mixing, quality, repeats, rollup, simhash, tokenstore, toxicity
from .textkit import WORD, checkpointed


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contained(_documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "item_id", "n_shared", "n_item")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir).select("doc_id", "text"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality.verdicts(quality.ledger(_documents(spark, sf_dir).select("doc_id", "text")))
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict(_documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.digest(credentials.find(_documents(spark, sf_dir).select("doc_id", "text")))


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokenstore.encoded(_documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens by two public vocabularies.  All documents come in; those labelled low in quality go; toxic ones are counted again without their digits; the deletes are replayed."""
    docs, labels = _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    import public_tokenizers

    versions = {name: public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken")}
    counts = checkpointed(rollup.token_counts(docs, versions, redacting="[0-9]+"))
    book = rollup.Rollup(spark)
    book.commit("1-load", rollup.inserts(counts))
    low = rollup.deletes(counts.join(marks.where("quality = 0"), "doc_id", "left_semi"))
    book.commit("2-low-quality", low)
    changed = marks.where("toxic = 1 AND (quality IS NULL OR quality <> 0)").select("doc_id")
    old = counts.join(changed, "doc_id", "left_semi")
    book.commit("3-redacted", rollup.revisions(old, old.withColumn("tokens", F.col("redacted"))))
    book.commit("2-low-quality", low)
    return book.totals()


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir).select("doc_id", "source", "text")).drop("copies")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.cut(_documents(spark, sf_dir).select("doc_id", "text"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_documents(spark, sf_dir).select("doc_id", "text", "lang"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_simhash": op2_simhash,
    "op3_quality_rules": op3_quality_rules,
    "op4_toxicity": op4_toxicity,
    "op5_secret_scan": op5_secret_scan,
    "op6_token_store": op6_token_store,
    "op7_token_counts": op7_token_counts,
    "op8_mixing": op8_mixing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_language": op10_language,
}

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

NORMAL = f"regexp_extract_all(lower(coalesce(text, '')), '[^{decontaminate.NOT_WORD}]+')"

ORACLES: dict[str, str] = {
    "op1_decontamination": rf"""
WITH i AS (SELECT item_id, {NORMAL} AS w FROM benchmark), d AS (SELECT doc_id, {NORMAL} AS w FROM documents),
ig AS (SELECT DISTINCT item_id, array_to_string(w[p:p + 4], ' ') AS gram FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS p FROM i WHERE len(w) >= 5)),
dg AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM d WHERE len(w) >= 5)),
q AS (SELECT item_id, count(*) AS n_item FROM ig GROUP BY item_id),
s AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ig JOIN dg USING (gram) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_item FROM s JOIN q USING (item_id) WHERE n_shared >= 0.8 * n_item - 1e-9""",
    "op3_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
g AS (SELECT doc_id, p, array_to_string(w[p:p + 7], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM d WHERE len(w) >= 8)),
twice AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM twice, (SELECT unnest(range(0, 8)) AS k) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
worded AS (SELECT doc_id, line, count(*) AS n FROM lines WHERE regexp_matches(line, '[^ 	-
]') GROUP BY doc_id, line),
dup AS (SELECT doc_id, sum(n - 1) AS n_dup, sum(n) AS n_lines FROM worded GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id)),
f AS (SELECT *, CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT + 8 * (word_chars < 2 * n_words)::INT
  + 16 * (word_chars > 15 * n_words)::INT + 32 * (10 * n_dup_lines > 3 * n_lines)::INT AS BIGINT) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed FROM f""",
    "op9_substring_dedup": rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
g AS (SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY gram ORDER BY doc_id, p) AS k FROM g) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, p + k AS p FROM later, (SELECT unnest(range(0, 20)) AS k)),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
}
