"""Training-data pipeline: documents to token ids, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept; its
result is written as Parquet in the shared folder and read again as the next one's ``docs``,
so a lost executor repeats one stage's tasks at most. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickforge.llm.bpe import decode, encode
from clickforge.llm.common import saved
from clickforge.llm.line_chunks import without_repeats
from clickforge.llm.mixing import mixed_documents
from clickforge.llm.quality import keep_good
from clickforge.llm.queries import vocabulary
from clickforge.llm.simhash import drop_near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood-ratio threshold."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without chunks of lines that occur before; emptied ones go."""
    return without_repeats(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, that of the least id."""
    return drop_near_duplicates(docs, shingle=4, max_bits=4)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row: ``doc_id``, ``n_tokens``, ``ids`` (binary, little-endian unsigned
    32-bit integers), and the hashes of the ids and of the text they decode to."""
    ranks = vocabulary("byte_bpe_multi_50k.tiktoken")
    return decode(encode(docs, ranks), ranks).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("mixing", mixing), ("tokens", tokens)]

#: The hash functions and the tokenizer of the stages have no SQL; the rows are tested against
#: a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
