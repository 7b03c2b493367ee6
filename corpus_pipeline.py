"""From raw documents to token ids, in stages that are each written and read again.

Every stage takes all documents that the one before it kept, and its decisions take effect; all but
the last return the columns of the documents they were given. The stages' operators say what
happens to null, empty and very long texts, repeated rows and empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casebook.llm import bpe, language_spans, line_spread, order_minhash, phrase_index
from casebook.llm.library import byte_bpe_path
from casebook.workspace import write_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a letter and one language for at least half of their letters.

    The model is learned from the documents' own ``lang`` where they are not held out.
    """
    model = language_spans.fit(docs.filter(language_spans.training_rows(docs)))
    return language_spans.accepted(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove lines that stand on many sites; documents of nothing else go."""
    return line_spread.shortened(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near-duplicates."""
    return order_minhash.without_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents without a passage of a benchmark item."""
    return phrase_index.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number and checksum of token ids, and checksum of the decoded text."""
    return bpe.digests(docs, byte_bpe_path())


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", tokens),
]

#: Expectation over learned models, sketches and BPE have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
