"""The corpus pipeline: five stages, each one operator on all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqintel.llm import exact_dedup, line_crf, mixing, packing, simhash
from seqintel.llm.common import documents, stored
from seqintel.llm.queries import TOKENIZER
from seqintel.session import configure


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls good stay; it learns from ``labels`` (held-out ids never)."""
    configure(spark)
    return line_crf.keep_good(docs, line_crf.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    configure(spark)
    return exact_dedup.drop_copies(spark, docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the document with the smallest id stays."""
    configure(spark)
    return simhash.drop_near_copies(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    configure(spark)
    return mixing.mixed(spark, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences."""
    configure(spark)
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER)).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality classifier", quality), ("exact dedup", dedup_exact), ("SimHash near-dedup", dedup_near),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: A trained classifier and a tokenizer have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows are written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(spark, docs, name.replace(" ", "-"))
    return docs
