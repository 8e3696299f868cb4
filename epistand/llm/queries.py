"""The registered queries of the training-data operators and their DuckDB SQL.

Each query applies its operator to its whole table and derives the contract's columns from the
operator's result."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epistand.llm import conversations, exact_dedup, jaccard_join, langid, lm_score, mixing, pii, sentencepiece_ffbs, spelling, token_files, toxicity, vector_join, warc
from epistand.llm.common import fold_of, table
from epistand.llm.oracle_sql import OP12, OP13
from epistand.session import ensure_checkpoint_dir


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), words=3, num=90)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    strict = lambda kind: F.size(F.filter("spans", lambda s: s["strict"] & (s["kind"] == kind))).cast("long")
    text = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    return found.select("doc_id", *[strict(k).alias(f"n_{k}") for k in pii.KINDS], "base_sha256", text.alias("spans"))


def label_domain():
    """Domain of a labelled document: toxic, low (quality 0) or good; NULL without labels."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "good")


# share of the mix's tokens by domain
MIX_TARGET = {"good": 0.90, "low": 0.07, "toxic": 0.03}


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), label_domain(), MIX_TARGET)
    return rows


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-warc-{uuid.uuid4().hex}"
    return warc.roundtrip(table(spark, sf_dir, "pages"), path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_texts(table(spark, sf_dir, "documents"), fold_of("doc_id", 10) != 0)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = fold_of("doc_id", 4) == 2
    model = langid.train(docs, usable=~held)
    return langid.identify(docs.select("doc_id", held.alias("held_out"), "text"), model).select(
        "doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"), "cross_entropy", "lang_accepted")


def op8_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.link_vectors(table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = fold_of("doc_id", 3) == 1
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), usable=~held)
    return toxicity.score_toxicity(docs.select("doc_id", held.alias("held_out"), "text"), model).select(
        "doc_id", "held_out", F.col("toxicity").alias("score"), F.col("toxic_predicted").alias("predicted"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_ffbs.encode(docs).select("doc_id", "n_pieces", "piece_ids", "lossless")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-tokens-{uuid.uuid4().hex}"
    return token_files.roundtrip(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.count_words(table(spark, sf_dir, "documents")))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_pii": op3_pii,
    "op4_mixing": op4_mixing,
    "op5_warc": op5_warc,
    "op6_lm_score": op6_lm_score,
    "op7_language_id": op7_language_id,
    "op8_vector_join": op8_vector_join,
    "op9_toxicity": op9_toxicity,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_token_files": op11_token_files,
    "op12_spelling": op12_spelling,
    "op13_conversations": op13_conversations,
}

_SHA = "sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))"

ORACLE: dict[str, str] = {
    "op1_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM (SELECT doc_id, {_SHA} AS text_sha256 FROM documents)
        WINDOW w AS (PARTITION BY text_sha256)""",
    "op5_warc": """
        WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest,
                          octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
             f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to FROM f""",
    "op12_spelling": OP12,
    "op13_conversations": OP13,
}
