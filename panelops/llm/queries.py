"""Registered queries of the training-data operators, with their SQL.

Each ``opN_`` query is thin: it reads its whole table, applies the operator
with its production parameters and derives the digest columns of its contract.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelops.llm import (
    best_fit,
    chat_repair,
    chat_trees,
    elias_fano,
    jaccard_join,
    llr_rules,
    pii_anchors,
    pivotal_mix,
    quality_fm,
    sentence_pieces,
    url_reputation,
    whitening,
    winnowing,
)
from panelops.llm.common import read
from panelops.llm.oracle import ORACLE
from panelops.session import cut_lineage

__all__ = ["ORACLE", "QUERIES"]


@functools.cache
def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


HELD_OUT = 2  # fixed value: this remainder of crc32(doc_id) mod 4 is held out
MIN_QUALITY = 0.7


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == HELD_OUT, F.lit(False))


def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    model = quality_fm.fit(docs, labels.select("doc_id", F.col("quality").alias("label")))
    return quality_fm.score_documents(docs.select("doc_id", "text", "n_chars"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= MIN_QUALITY).cast("int").alias("predicted"),
    )


def op2_elias_fano(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = elias_fano.new_path(spark, "tokens")
    elias_fano.write_token_files(
        read(spark, sf_dir, "documents"), path, tokenizer("word_bpe_49k.json")
    )
    return elias_fano.read_token_files(spark, path)


def op3_llr_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = read(spark, sf_dir, "labels").where(F.col("quality") == 1)
    return llr_rules.judge(read(spark, sf_dir, "documents"), trusted)


def op4_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # Written as files are, and read back.
    out = cut_lineage(
        chat_trees.format_conversations(chat_trees.linear_tree(turns.unionByName(added))),
        "conversations",
    )
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    read_back = out.select(
        F.col("tree").alias("conv_id"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        chat_trees.parse_turns(F.col("formatted")).alias("turns"),
        chat_trees.masked_text(F.col("formatted"), F.col("loss_spans")).alias("learned"),
    )
    return read_back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars",
    )


def op5_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
    return pii_anchors.find_spans(docs).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in pii_anchors.BASE_KINDS],
        F.sha2(pii_anchors.span_digest(spans, pii_anchors.BASE_KINDS), 256).alias("base_sha256"),
        pii_anchors.span_digest(spans, pii_anchors.KINDS).alias("spans"),
    )


def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op7_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivotal_mix.mix(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "copies",
    )


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compare_with_next(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        winnowing.to_text(F.col("fingerprint")).alias("fingerprint"),
        winnowing.to_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(read(spark, sf_dir, "documents"))


def op10_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    outcomes = url_reputation.document_outcomes(pages, read(spark, sf_dir, "labels"))
    return url_reputation.judge_urls(pages, outcomes)


def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer("piece_bpe_32k.model")
    encoded = sentence_pieces.encode(read(spark, sf_dir, "documents"), model)
    joined = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return sentence_pieces.decode(encoded, model).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    return chat_repair.repair_report(turns, chat_repair.damage(turns))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings")).withColumn(
        "deviation", F.col("deviation").cast("bigint")
    )


QUERIES = {
    "op1_quality_fm": op1_quality_fm,
    "op2_elias_fano": op2_elias_fano,
    "op3_llr_rules": op3_llr_rules,
    "op4_reply_trees": op4_reply_trees,
    "op5_pii_anchors": op5_pii_anchors,
    "op6_best_fit": op6_best_fit,
    "op7_pivotal_mix": op7_pivotal_mix,
    "op8_winnowing": op8_winnowing,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_url_reputation": op10_url_reputation,
    "op11_sentence_pieces": op11_sentence_pieces,
    "op12_chat_repair": op12_chat_repair,
    "op13_whitening": op13_whitening,
}
