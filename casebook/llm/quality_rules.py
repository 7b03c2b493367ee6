"""Document quality by weak supervision.

Rules look at measures of a text and vote good, bad or not at all. No labels are needed: a model of
two hidden classes, fitted by expectation-maximisation, learns how often each rule votes each way on
good and on bad documents, and gives each combination of votes a probability of being good.

Measures are taken in one pass over whole texts. The model only sees how often each combination of
votes occurs; only so many occur as rules agree in different ways, at most 3 to the power of their number.

Null and empty texts have no words: all measures are 0 and the base rule drops them. Repeated rows
are judged alike, each for itself. An empty table gives an empty result. A null key stays null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.shipping import ship
from casebook.llm.words import chunks, numbered, point_table, run_spans, to_points
from casebook.workspace import write_table

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
GOOD, NONE, BAD = 1, 0, -1
#: Least probability of being good.
KEPT = 0.5
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_symbol_words",
    "n_lines",
    "n_distinct",
    "n_letters",
    "n_capitals",
    "n_marks",
    "n_capital_words",
    "n_marked_words",
    "n_long_words",
)
#: Code points from which a word is long.
LONG_WORD = 20


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``value`` is over ``bad``, good where it is at most ``good``."""

    name: str
    value: str
    good: float
    bad: float

    def vote(self) -> Column:
        value = F.expr(self.value)
        return F.when(value > self.bad, BAD).when(value <= self.good, GOOD).otherwise(NONE).cast("int").alias(self.name)


#: The production rules. Several look at each kind of defect: the model believes rules that others
#: confirm, and a lone bad vote counts for little.
RULES = (
    Rule("symbols", "n_symbols / greatest(n_words, 1)", 0.05, 0.25),
    Rule("symbol_share", "n_symbols / greatest(word_chars, 1)", 0.01, 0.04),
    Rule("symbol_words", "n_symbol_words / greatest(n_words, 1)", 0.05, 0.2),
    Rule("repeats", "n_repeat_words / greatest(n_words, 1)", 0.25, 0.5),
    Rule("lines", "n_dup_lines / greatest(n_lines, 1)", 0.0, 0.5),
    Rule("variety", "1 - n_distinct / pow(greatest(n_words, 1), 0.8)", 0.0, 0.6),
    Rule("capitals", "n_capitals / greatest(n_letters, 1)", 0.2, 0.5),
    Rule("capital_words", "n_capital_words / greatest(n_words, 1)", 0.2, 0.5),
    Rule("marks", "n_marks / greatest(n_words, 1)", 0.3, 0.8),
    Rule("marked_words", "n_marked_words / greatest(n_words, 1)", 0.1, 0.5),
    Rule("long_words", "word_chars / greatest(n_words, 1)", 9.0, 14.0),
    Rule("long_word_share", "n_long_words / greatest(n_words, 1)", 0.1, 0.3),
)


@cache
def word_points() -> np.ndarray:
    inside = np.ones(0x110000, bool)
    inside[[ord(c) for c in BLANKS]] = False
    return inside


@cache
def kinds() -> np.ndarray:
    return point_table({2: r"\p{L}", 1: r"\p{Lu}", 3: r"[!?.,;:…]"})


def per_text(counted: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Marked code points of each text."""
    total = np.concatenate([[0], np.cumsum(counted)])
    return total[begins[1:]] - total[begins[:-1]]


def line_counts(text: str) -> tuple[int, int]:
    """Lines with a word, and those of them that are equal to an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return len(lines), len(lines) - len(set(lines))


def repeated_words(text: np.ndarray, word: np.ndarray, n_texts: int, window: int = 3) -> np.ndarray:
    """Words of each text that lie in windows found twice or more in that text."""
    if len(word) < window:
        return np.zeros(n_texts, np.int64)
    size = len(word) - window + 1
    key = word[:size].copy()
    for k in range(1, window):
        key = key * (int(word.max()) + 1) + word[k : k + size]
        key = np.unique(key, return_inverse=True)[1]
    key = key * n_texts + text[:size]
    inside = text[:size] == text[window - 1 :]
    _, where, count = np.unique(key[inside], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(inside)[count[where] > 1]
    covered = np.zeros(len(word), bool)
    for k in range(window):
        covered[starts + k] = True
    return np.bincount(text[covered], minlength=n_texts)


def measured(texts: list[str]) -> dict[str, np.ndarray]:
    """All measures of some texts."""
    points, begins = to_points(texts)
    start, end = run_spans(points, begins, word_points())
    text = np.searchsorted(begins, start, side="right") - 1
    word, _ = numbered(points, start, end)
    n = len(texts)
    kind = kinds()[points]
    symbol = np.isin(points, [ord(c) for c in SYMBOLS])
    def per_word(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[end] - total[start]

    marked = per_word(symbol) > 0
    capitals, marks = per_word(kind == 1), per_word(kind == 3)
    shouted = (capitals > 1) & (2 * capitals > end - start)
    lines = [line_counts(value) for value in texts]
    pairs = np.unique(text * (int(word.max(initial=0)) + 1) + word)
    return {
        "n_words": np.bincount(text, minlength=n),
        "word_chars": np.bincount(text, weights=end - start, minlength=n).astype(np.int64),
        "n_symbols": per_text(symbol, begins),
        "n_dup_lines": np.array([x[1] for x in lines], np.int64),
        "n_repeat_words": repeated_words(text, word, n),
        "n_symbol_words": np.bincount(text[marked], minlength=n),
        "n_lines": np.array([x[0] for x in lines], np.int64),
        "n_distinct": np.bincount(pairs // (int(word.max(initial=0)) + 1), minlength=n),
        "n_letters": per_text((kind == 1) | (kind == 2), begins),
        "n_capitals": per_text(kind == 1, begins),
        "n_marks": per_text(kind == 3, begins),
        "n_capital_words": np.bincount(text[shouted], minlength=n),
        "n_marked_words": np.bincount(text[marks > 1], minlength=n),
        "n_long_words": np.bincount(text[end - start >= LONG_WORD], minlength=n),
    }


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of every text; rows are independent."""
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [value or "" for value in batch.column(1).to_pylist()]
            for low, high in chunks(list(map(len, texts))):
                found = measured(texts[low:high])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low)]
                    + [pa.array(found[name].astype(np.int64)) for name in MEASURES],
                    names=["doc_id", *MEASURES],
                )

    columns = ", ".join(f"{name} long" for name in MEASURES)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {columns}"
    return docs.select("doc_id", "text").mapInArrow(rows, schema)


def posteriors(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Probability of good for each combination of votes (rows), seen ``counts`` times.

    Each class has its own frequencies of the three votes of each rule; a rule's accuracy is how
    often it votes good on good and bad on bad documents. Starts from combinations without a bad
    vote being good; weak prior counts keep the classes from changing places.
    """
    if not len(votes):
        return np.zeros(0)
    onehot = np.stack([votes == value for value in (GOOD, NONE, BAD)], axis=-1).astype(float)
    good = np.where((votes == BAD).any(axis=1), 0.1, 0.95)
    # 10 imagined documents of each class: good ones are called good, bad ones often bad
    prior = np.array([[8.0, 1.9, 0.1], [3.0, 2.0, 5.0]])
    for _ in range(rounds):
        chance = []
        for share, imagined in ((good, prior[0]), (1 - good, prior[1])):
            weight = share * counts
            seen = np.tensordot(weight, onehot, axes=(0, 0)) + imagined
            rates = seen / seen.sum(axis=1, keepdims=True)
            chance.append(np.log(weight.sum() + 1) + (onehot * np.log(rates)).sum(axis=(1, 2)))
        new = 1 / (1 + np.exp(np.clip(chance[1] - chance[0], -700, 700)))
        done = np.abs(new - good).max() < 1e-9
        good = new
        if done:
            break
    return good


def scored(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, measures, each rule's vote, and ``quality``, the probability of being good."""
    spark = docs.sparkSession
    names = [rule.name for rule in rules]
    votes = write_table(measures(docs), "measures").select("*", *(rule.vote() for rule in rules))
    # one row for each combination that occurs, at most 3 ** len(rules); Catalyst knows its size
    seen = votes.groupBy(*names).count().orderBy(*names).collect()
    table = np.array([[row[name] for name in names] for row in seen], int).reshape(len(seen), len(names))
    quality = posteriors(table, np.array([row["count"] for row in seen], float))
    schema = ", ".join(f"{name} int" for name in names) + ", quality double"
    fitted = spark.createDataFrame(
        [(*map(int, row), float(q)) for row, q in zip(table, quality, strict=True)], schema
    )
    return votes.join(fitted, names, "left")


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measures, the base rule's verdict and the final one for every document."""
    rows = scored(docs, rules)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    votes = reduce(lambda a, b: a + b, [F.abs(F.col(rule.name)) for rule in rules])
    return rows.select(
        "doc_id",
        *MEASURES[:5],
        failed.alias("base_failed"),
        (~failed & (F.col("quality") >= KEPT)).alias("kept"),
        "quality",
        votes.alias("n_votes"),
    )
