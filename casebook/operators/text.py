"""Text operators: words, hashed term frequencies, and TF-IDF over hashed or exact vocabularies."""

from __future__ import annotations

from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions.vectors import slots
from casebook.operators.frequency import ROWS_PER_TASK, attach_counts, hot_values
from casebook.schema import TEXT_BUCKETS
from casebook.workspace import write_table


def tokenize(df: DataFrame, column: str, output: str = "words") -> DataFrame:
    """Lower-case words split at single whitespace characters; NULL counts as empty text."""
    filled = df.withColumn(column, F.coalesce(F.col(column), F.lit("")))
    return Tokenizer(inputCol=column, outputCol=output).transform(filled)


def hashing_tf(df: DataFrame, key: str, column: str, buckets: int = TEXT_BUCKETS) -> DataFrame:
    """Term frequency per record and hash bucket, one row per bucket that holds a word."""
    hashed = HashingTF(inputCol="words", outputCol="tf", numFeatures=buckets).transform(tokenize(df, column))
    return slots(hashed, [key], "tf", "bucket", "tf")


def tfidf_hashed(df: DataFrame, key: str, column: str, buckets: int = TEXT_BUCKETS) -> DataFrame:
    """Hashed term frequency weighted by ln((m + 1) / (df + 1))."""
    tf = HashingTF(inputCol="words", outputCol="tf", numFeatures=buckets)
    hashed = tf.transform(tokenize(df.select(key, column), column))
    weighted = IDF(inputCol="tf", outputCol="tfidf").fit(hashed).transform(hashed)
    return slots(weighted, [key], "tfidf", "bucket", "tfidf")


def _each(words: str | Column) -> Column:
    """One row per word. Outer, or Catalyst would split the text again just to check that it has words."""
    return F.explode_outer(words)


def term_frequencies(df: DataFrame, key: str, column: str) -> DataFrame:
    """Count of every word per record; ``key`` names one record.

    A record's words are sorted and counted where it lies, so no words move. Only rows that share a key, or
    lack one, are counted together.
    """
    repeated = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    repeated = write_table(repeated.where("_n > 1 OR _key IS NULL").select("_key"), "repeated-keys")
    words = tokenize(df.select(key, column), column)
    together = None
    if not repeated.isEmpty():
        same = F.col(key).eqNullSafe(F.col("_key"))
        shared = words.join(repeated, same, "left_semi").select(key, _each("words").alias("term"))
        shared = shared.where("term IS NOT NULL").groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
        together = write_table(shared, "shared-terms")
        words = words.join(repeated, same, "left_anti")
    ordered = words.select(key, F.sort_array("words").alias("words"))
    # each is used twice, so Catalyst keeps the steps apart and computes it once
    starts = F.transform("words", lambda word, i: F.when((i == 0) | (F.get("words", i - 1) != word), i))
    ordered = ordered.select(key, "words", F.filter(starts, lambda start: start.isNotNull()).alias("starts"))
    runs = F.transform(
        "starts",
        lambda start, i: F.struct(
            F.get("words", start).alias("term"),
            (F.coalesce(F.get("starts", i + 1), F.size("words")) - start).cast("long").alias("tf"),
        ),
    )
    own = ordered.select(key, F.inline_outer(runs)).where("term IS NOT NULL")
    return own if together is None else own.unionByName(together)


def document_frequencies(df: DataFrame, column: str) -> DataFrame:
    """Records per word. Words repeat within a record only once, so only the vocabulary is shuffled."""
    words = tokenize(df.select(column), column)
    terms = words.select(_each(F.array_distinct("words")).alias("value")).where("value IS NOT NULL")
    return terms.groupBy("value").agg(F.count(F.lit(1)).alias("frequency"))


def tfidf_terms(df: DataFrame, key: str, column: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """TF-IDF over the exact vocabulary, one row per record and word; ``key`` names one record."""
    vocabulary = write_table(document_frequencies(df, column), "vocabulary")
    terms = term_frequencies(df, key, column)
    hot = hot_values(vocabulary, rows_per_task=rows_per_task)
    weighted = attach_counts(terms, vocabulary, "term", "df", hot=hot, spread_by=[key])
    records = df.agg(F.count(F.lit(1))).scalar()
    return weighted.withColumn("tfidf", F.col("tf") * F.log((records + 1) / (F.col("df") + 1)))
