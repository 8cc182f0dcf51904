"""From raw documents to encoded training data: five stages, each written as Parquet and read again.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns what it keeps, with the columns of
docs, but for the last, which returns the encoding. A null or empty text goes at the first stage, and so does a text
without a letter. Rows without an id are kept unless another of their near duplicates stays in their place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from folioforge.llm import bpe, language_id, mixing, secret_scan, simhash
from folioforge.llm.common import durable, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; see language_id.keep_identified()."""
    return language_id.keep_identified(docs, language_id.train(docs))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id; see simhash.keep_one()."""
    return simhash.keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets redacted; see secret_scan.redact()."""
    return secret_scan.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One epoch of nine tenths of all tokens, shared out by the target weights; see mixing.keep_mixed()."""
    return mixing.keep_mixed(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and digests of the ids and of the text decoded from them; see bpe.encode_decode()."""
    return bpe.encode_decode(docs, bpe.default_path())


STAGES = [
    ("language_id", language_stage),
    ("simhash_dedup", dedup_stage),
    ("secret_scan", secrets_stage),
    ("mixing", mixing_stage),
    ("bpe", encoding_stage),
]
#: SQL can express neither the machines, the 64-bit fingerprints, the forest nor the encoding; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between them tables are written to the checkpoint folder that all executors share.

    A stage's table is removed once the next one's is written; the last one's, which is returned, stays.
    """
    docs = table(spark, sf_dir, "documents")
    durable(spark.range(0))  # sets a checkpoint folder where none is
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4().hex}")
    files, before = folder.getFileSystem(spark._jsc.hadoopConfiguration()), None
    for k, (name, stage) in enumerate(STAGES):
        out = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{k}-{name}")
        stage(spark, docs, sf_dir).write.parquet(out.toString())
        docs = spark.read.parquet(out.toString())
        if before:
            files.delete(before, True)
        before = out
    return docs
