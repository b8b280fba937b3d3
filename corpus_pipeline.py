"""From raw documents to packed training sequences, in five stages.

1. quality: documents that the weighed quality rules reject go.
2. near_duplicates: one document of each group of near-copies stays.
3. decontamination: documents that hold a benchmark item's question and answer go.
4. secrets: spans that look like credentials are masked, and ``n_chars`` follows.
5. packing: texts become pieces of fixed-length token sequences.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from siltworks.llm import copies, decontam, packing, quality, secrets, store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality is at least one half and that pass the base rules.

    A null or empty text has no words and goes.  Repeated rows are judged
    alike; rows without an id, and columns of any name, are kept as they are.
    """
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each component of near-copies.

    Near-copies share 0.8 or more of their five-word shingles; each link is
    checked on the whole sets of shingles.  Of rows that repeat id and text one
    stays; rows that share an id alone are judged by their texts; rows without
    an id stay.  Null and blank texts are copies of each other.
    """
    return copies.one_of_each(docs, similarity=0.8, width=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks; null and empty texts stay, repeated rows are judged alike."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked; ``n_chars`` (where there is such a column) is the new length where a text has changed.

    Null and empty texts stay as they are; repeated rows stay repeated.
    """
    return secrets.redact(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their token ids and their places in sequences of at most 4096 tokens.

    A null text is empty: its piece is the end id alone.  Repeated rows, and
    rows without an id, are packed as often as they come.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secret_scans),
    ("packing", pack),
]

#: Fingerprints, BM25 bounds and tokenizers are beyond SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each writes a table in the shared folder that the next one reads.

    When a stage's table is whole, the one before it and all that the stage has
    written on its way are deleted.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, store.settled(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name)
        store.discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
