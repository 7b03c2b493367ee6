"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casebook.llm import (
    bpe,
    conversation_trie,
    language_spans,
    line_spread,
    order_minhash,
    phrase_index,
    quality_classifier,
    quality_rules,
    spelling,
    suffix_dedup,
    token_files,
    token_rollups,
    url_filter,
)
from casebook.llm.library import byte_bpe_path, many_languages_path
from casebook.workspace import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@registered
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every document by rules that vote."""
    return quality_rules.judged(table(spark, sf_dir, "documents"))


@registered
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals after inserts, deletions of copies and a change of tokenizer."""
    vocabularies = {"byte_bpe_50k": byte_bpe_path(), "byte_bpe_multi_50k": many_languages_path()}
    rollup = token_rollups.TokenRollup(spark, new_folder(spark, "rollup"))
    return token_rollups.history(table(spark, sf_dir, "documents"), rollup, vocabularies)


@registered
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document."""
    return order_minhash.deduplicated(table(spark, sf_dir, "documents"))


@registered
def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove byte strings that the corpus has before from every document."""
    return suffix_dedup.removed(table(spark, sf_dir, "documents"))


@registered
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those not held out."""
    return language_spans.identified(table(spark, sf_dir, "documents")).drop("spans")


@registered
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove boilerplate lines from every document."""
    return line_spread.without_boilerplate(table(spark, sf_dir, "documents"))


@registered
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Find every benchmark passage in every document."""
    return phrase_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@registered
def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents' token ids to binary shards and read them back."""
    return token_files.written_and_read(spark, table(spark, sf_dir, "documents"), byte_bpe_path())


@registered
def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every page's URL."""
    return url_filter.judged(table(spark, sf_dir, "pages")).drop("score")


@registered
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document."""
    return bpe.digests(table(spark, sf_dir, "documents"), byte_bpe_path())


@registered
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group every word of the documents, some damaged on purpose, with its spelling variants."""
    words = spelling.vocabulary(table(spark, sf_dir, "documents"), spelling.thirty_first_loses_a_letter)
    return spelling.variants(words)


@registered
def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score the quality of every document, learned from the labels of those not held out."""
    return quality_classifier.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the prefix trie of the rebuilt conversations."""
    return conversation_trie.prefixes(table(spark, sf_dir, "conversations"))


ORACLES["op6_line_dedup"] = line_spread.ORACLE
ORACLES["op7_benchmark_decontamination"] = phrase_index.ORACLE
ORACLES["op9_url_filters"] = url_filter.oracle()
ORACLES["op11_spelling_variants"] = spelling.ORACLE
ORACLES["op13_conversation_trie"] = conversation_trie.ORACLE
