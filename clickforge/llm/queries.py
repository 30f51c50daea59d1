"""Registered queries of this subpackage: each takes ``(spark, sf_dir)``, applies one operator
with its production parameters to a whole table and returns the full result."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

#: Folder of the public vocabulary files; None takes the installed ones.
VOCABULARIES: str | None = None


def vocabulary(name: str) -> str:
    if VOCABULARIES:
        return os.path.join(VOCABULARIES, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark, sf_dir):
    from clickforge.llm.simhash import simhash_components
    return simhash_components(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op2_byte_bpe(spark, sf_dir):
    from clickforge.llm.bpe import decode, encode
    ids = encode(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"))
    back = decode(ids, vocabulary("byte_bpe_multi_50k.tiktoken"))
    return back.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op3_token_files(spark, sf_dir):
    from clickforge.llm.common import new_folder
    from clickforge.llm.token_files import read_token_files, write_token_files
    folder = new_folder(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), folder, vocabulary("word_bpe_49k.json"),
                      end_id=1)
    return read_token_files(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


#: Fixed rules of the query: host and path prefix, and the verdict.
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block")]
#: Zones below which names are registered, beside the last label of a host.
URL_SUFFIXES = ["example.com", "example.net", "example.org"]


def op4_url_reputation(spark, sf_dir):
    from clickforge.llm.url_reputation import judge_urls
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1))
        .alias("bad"))
    return judge_urls(table(spark, sf_dir, "pages"), labels, URL_RULES, URL_SUFFIXES).select(
        "page_id", "host", "path", "rule", "verdict")


def op5_line_chunk_dedup(spark, sf_dir):
    from clickforge.llm.line_chunks import dedup_line_chunks
    return dedup_line_chunks(table(spark, sf_dir, "documents").select("doc_id", "text")) \
        .select("doc_id", "n_lines", "n_removed_lines", "n_removed_chunks",
                F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


def op6_quality_llr(spark, sf_dir):
    from clickforge.llm.quality import judge_quality
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")) \
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                "n_repeat_words", "base_failed", "kept", F.round("score", 9).alias("score"))


def op7_chat_snapshots(spark, sf_dir):
    from clickforge.llm.chat import render_maximal
    return render_maximal(table(spark, sf_dir, "conversations"))


def op8_multiprobe_search(spark, sf_dir):
    from clickforge.llm.ann import search
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op9_low_discrepancy_mix(spark, sf_dir):
    from clickforge.llm.mixing import mix_documents
    return mix_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op10_token_counts(spark, sf_dir):
    from clickforge.llm.token_counts import count_tokens
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")) \
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op11_structure_repair(spark, sf_dir):
    from clickforge.llm.repair import damaged, repair_conversations
    return repair_conversations(damaged(table(spark, sf_dir, "conversations")))


def op12_merkle_manifest(spark, sf_dir):
    from clickforge.llm.merkle import verified_manifest
    docs = table(spark, sf_dir, "documents")
    return verified_manifest(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)


def op13_embedding_near_dedup(spark, sf_dir):
    from clickforge.llm.multi_index import near_duplicates
    return near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93).select(
        "vec_id", "n_links", "component_id", "kept")


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_simhash_near_dedup, op2_byte_bpe, op3_token_files, op4_url_reputation,
        op5_line_chunk_dedup, op6_quality_llr, op7_chat_snapshots, op8_multiprobe_search,
        op9_low_discrepancy_mix, op10_token_counts, op11_structure_repair, op12_merkle_manifest,
        op13_embedding_near_dedup)}


def oracle_sql() -> dict[str, str]:
    from clickforge.llm import sql
    return dict(sql.ORACLES)
