"""Registered queries of the operators in this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import chat, fingerprints, langid, licenses, media, mixing, packing, secrets, shinglejoin, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(key: str = "doc_id") -> Column:
    """Rows that are never learned from."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    done = chat.format_chat(turns.unionByName(probe))
    back = done.withColumn("turns", chat.parse_chat(F.col("formatted"))).withColumn("loss", chat.masked_text(F.col("formatted"), F.col("loss_spans")))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_neighbours(table(spark, sf_dir, "documents"))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shinglejoin.similar_texts(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    config = langid.LangidConfig()
    texts, langs = langid.sample_labelled(docs, ~held_out(), config)
    model = langid.fit(texts, langs, config)
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    config = toxicity.ToxicityConfig()
    texts, toxic = toxicity.sample_labelled(docs, table(spark, sf_dir, "labels"), ~held_out(), config)
    scored = toxicity.score(docs, toxicity.fit(texts, toxic, config))
    spans = F.array_join(F.transform("spans", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), ",")
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted", F.size("spans").cast("long").alias("n_spans"), spans.alias("span_offsets"))


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(table(spark, sf_dir, "documents").select("doc_id", "text"), tensors=False).drop("text")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("text", "matches")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), secrets.fit())
    redacted = F.sha2(F.coalesce("redacted", F.lit("")).cast("binary"), 256).alias("redacted_sha256")
    return found.select("doc_id", "n_candidates", "n_findings", "best", "findings_sha256", redacted)


QUERIES: dict[str, Query] = {"op1_chat": op1_chat, "op2_fingerprints": op2_fingerprints, "op3_jaccard": op3_jaccard, "op4_mixing": op4_mixing, "op5_langid": op5_langid, "op6_packing": op6_packing, "op7_toxicity": op7_toxicity, "op8_media": op8_media, "op9_licenses": op9_licenses, "op10_secrets": op10_secrets}

_ESC = r"(<|\[)(\\*)(\|turn\|>|\|text\|>|\|more\|>|/s>|s>|INST\]|/INST\]|<SYS>>|</SYS>>)"

ORACLES: dict[str, str] = {
    "op1_chat": rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), seen AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM turns
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY place)) AS loss_sha256,
  CAST(sum(length(regexp_replace(text, '{_ESC}', '\1\\\2\3', 'g'))
    + CASE WHEN before = role THEN 8 ELSE length('<|turn|>') + length(role) + length('<|text|>') + length('</s>') END) AS BIGINT) AS formatted_chars
FROM seen GROUP BY conv_id
""",
    "op4_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) AS h FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)]::DOUBLE AS weight FROM sized GROUP BY source
), ranked AS (
  SELECT *, source_size * 3.0::DOUBLE AS cap, source_size * 3.0::DOUBLE / weight AS full_at, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sources
), levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER (ORDER BY full_at, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY full_at, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ranked
), targets AS (
  SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, (full_at, rank)) FROM levels WHERE level <= full_at) * weight, cap)) AS target FROM levels
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets
), steps AS (
  SELECT source, h, sum(size) AS tokens FROM sized GROUP BY source, h
), sums AS (
  SELECT *, sum(tokens) OVER (PARTITION BY source ORDER BY h) AS upto FROM steps
), picks AS (
  SELECT s.source, h, whole, source_size, target, CASE WHEN upto <= target - whole * source_size THEN 1
    WHEN upto - tokens <= target - whole * source_size AND upto - (target - whole * source_size) < (target - whole * source_size) - (upto - tokens) THEN 1 ELSE 0 END AS more
  FROM sums s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT d.doc_id, d.size, p.source_size, p.target, CAST((whole + more) * d.size AS BIGINT) AS taken
FROM sized d JOIN picks p ON d.source IS NOT DISTINCT FROM p.source AND d.h = p.h
""",
}
