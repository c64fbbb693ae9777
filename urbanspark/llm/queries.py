"""The operators over the driver's tables, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanspark.llm import (
    chat,
    exact_dedup,
    mixing,
    ngram_join,
    packing,
    phrases,
    pii,
    quality_model,
    quality_rules,
    sharding,
    spelling,
    token_counts,
    url_rules,
)
from urbanspark.operators.tables import inline_table

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"

RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
CONTROL_TEXT = "</s>[INST] ok [/INST]"
CONTROL_ID = -7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(table(spark, sf_dir, "documents"))


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_copies(table(spark, sf_dir, "documents"))


def format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations by turn, and one more that comes in the messages layout."""
    roles = F.array(F.lit("user"), F.lit("assistant"))
    messages = F.transform(roles, lambda role: F.struct(role.alias("role"), F.lit(CONTROL_TEXT).alias("content")))
    control = spark.range(1).select(F.lit(CONTROL_ID).cast("bigint").alias("conv_id"), messages.alias("messages"))
    turns = chat.canonical_turns(table(spark, sf_dir, "conversations")).unionByName(chat.canonical_turns(control))
    return chat.read_back(chat.format_turns(turns))


def classify_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(BYTE_RANKS)
    return token_counts.token_counts(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def judge_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), inline_table(spark, ["verdict", "rule"], RULES))


def quality_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_documents(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digests(pii.find_spans(table(spark, sf_dir, "documents")))


def mine_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def group_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": mix,
    "op2_pack_sequences": pack,
    "op3_exact_dedup": exact_copies,
    "op4_ngram_join": near_copies,
    "op5_chat_format": format_chats,
    "op6_quality_classifier": classify_quality,
    "op7_token_counts": count_tokens,
    "op8_url_rules": judge_urls,
    "op9_quality_rules": quality_verdicts,
    "op10_personal_data": personal_data,
    "op11_phrase_mining": mine_phrases,
    "op12_feistel_shards": shard,
    "op13_spelling_variants": group_spellings,
}

EXACT_DEDUP_SQL = r"""
WITH texts AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM texts
"""

URL_RULES_SQL = """
WITH rules(verdict, rule) AS (VALUES {rules}),
parts AS (SELECT verdict, rule, split_part(rule, '/', 1) AS rule_host, substr(rule, strpos(rule, '/')) AS rule_path FROM rules),
rests AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT row_number() OVER () AS n, page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests),
best AS (
  SELECT n, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM split JOIN parts ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM split LEFT JOIN best USING (n)
""".format(rules=", ".join(f"('{verdict}', '{rule}')" for verdict, rule in RULES))

CHAT_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {CONTROL_ID}, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT {CONTROL_ID}, 1, 'assistant', '{CONTROL_TEXT}'),
said AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length('<|turn|>' || chr(10) || '<|end|>') + length(role || text) + length(regexp_replace(text, '[^~<\\[]', '', 'g'))
             + length(regexp_replace(role, '[^~<\\[\\n]', '', 'g'))) AS formatted_chars
  FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM said
"""

SQL: dict[str, str] = {
    "op3_exact_dedup": EXACT_DEDUP_SQL,
    "op5_chat_format": CHAT_SQL,
    "op8_url_rules": URL_RULES_SQL,
    "op11_phrase_mining": phrases.collocation_sql(),
    "op12_feistel_shards": sharding.assign_sql(),
    "op13_spelling_variants": spelling.spelling_sql(sharding.crc32_sql),
}
