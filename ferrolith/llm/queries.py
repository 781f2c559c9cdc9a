"""The operators of this subpackage applied to the whole standard tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrolith.llm import bpe, chat, filter_audit, forest, jaccard, langid, mixture, negatives, packing, ppm, quality, render, token_file
from ferrolith.session import new_folder, settle
from ferrolith.sources.tables import table

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
END_ID, CAPACITY = 2, 1024


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def op1_token_file(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    token_file.write_tokens(table(spark, folder, "documents"), path, WORD_BPE, END_ID)
    return token_file.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def packed(docs: DataFrame, keep: bool = True) -> DataFrame:
    pieces = packing.token_pieces(docs, BYTE_BPE, END_ID, CAPACITY, keep=keep).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(pieces, CAPACITY).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))


def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql("SELECT -1L AS conv_id, turn, role, '" + said + "' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    rows = table(spark, folder, "conversations").unionByName(extra)
    records = rows.select("conv_id", "turn", F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"}).alias("record"))
    turns = chat.canonical_turns(records, "record", "conv_id", "turn")
    return chat.digest_conversations(settle(chat.format_turns(turns), "chat"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.quality_rules(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels"), carry_text=False)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio")


def op5_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return forest.near_vectors(table(spark, folder, "embeddings"))


def with_language(docs: DataFrame) -> DataFrame:
    return langid.identify(docs, langid.fit_profiles(docs.filter(fold("doc_id", 5) != 0)))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_language(table(spark, folder, "documents").select("doc_id", "lang", "text"))
    return rows.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op7_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, folder, "documents"))


def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    rows = bpe.encode_decode(table(spark, folder, "documents"), WORD_BPE)
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return rows.select("doc_id", "n_tokens", F.sha2(decimal, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return render.extract_text(table(spark, folder, "pages").select("page_id", "html")).select(
        "page_id", "text", F.length("text").cast("long").alias("n_chars"))


def op10_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    rows = ppm.ppm_scores(table(spark, folder, "documents"), fold("doc_id", 7) != 2)
    return rows.select("doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, folder, "embeddings"), F.col("id") % 100 == 0, label=label)


def op13_source_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.mix_copies(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {f.__name__: f for f in (
    op1_token_file, op2_best_fit_packing, op3_chat_format, op4_quality_rules, op5_embedding_near_dedup, op6_language_id,
    op7_ngram_jaccard_join, op8_bpe, op9_html_text, op10_lm_scoring,
    op11_filter_audit, op12_hard_negatives, op13_source_mixture)}

_COMPONENTS = """
reach AS (
  SELECT node, node AS other FROM nodes
  UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.other)
"""

SQL = {
    "op11_filter_audit": filter_audit.SQL,
    "op12_hard_negatives": negatives.SQL,
    "op13_source_mixture": mixture.SQL,
    "op5_embedding_near_dedup": f"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
edges AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id <> q.vec_id
  WHERE list_cosine_similarity(p.e, q.e) >= 0.98),
nodes AS (SELECT vec_id AS node FROM embeddings), {_COMPONENTS}
SELECT node AS vec_id, (SELECT count(*) FROM edges e WHERE e.a = node) AS n_links, min(other) AS component_id, min(other) = node AS kept
FROM reach GROUP BY node""",
    "op7_ngram_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
edges AS (SELECT p.doc_id AS a, q.doc_id AS b FROM items p JOIN items q ON p.x = q.x AND p.doc_id <> q.doc_id
  GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
nodes AS (SELECT doc_id AS node FROM documents), {_COMPONENTS}
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM sets
JOIN (SELECT node AS doc_id, min(other) AS component_id FROM reach GROUP BY node) USING (doc_id)""",
}
