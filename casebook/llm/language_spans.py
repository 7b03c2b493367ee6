"""Language of every word, span and document.

Training counts, for each language, hashed letter trigrams of words (with a mark at both ends) and
letters of each script. Prediction narrows the candidates of a word to the languages that use its
script, scores it by the trigrams' log-likelihood, and labels the words of a text by a Viterbi path
that pays ``SWITCH`` for each change of language. A document's language is that of most letters;
its score is the share of those letters.

The model has a fixed size for each language: ``BUCKETS`` trigram counts and one count for each
script. Only these sums reach the driver, whatever the size of the corpus.

Null texts and texts without a letter are ``und`` with score 0 and no spans. A text in scripts that
no language was seen in gets the language with most training letters, score 0. Equal scores choose
the first language by name. Rows without key, text or language are not learned from. Without any
training row every document is ``und``. Repeated rows are learned from as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.shipping import ship
from casebook.llm.words import all_points, by_chunks, chunks, point_table, run_spans, to_points

BUCKETS = 1 << 16
#: Cost of a change of language, in units of log-likelihood.
SWITCH = 12.0
#: A language uses a script if at least this share of its letters is of that script.
USED = 0.005
SMOOTHING = 0.5
#: Languages that a model holds at most; each has BUCKETS numbers in every worker.
LANGUAGES = 200
UNKNOWN = "und"
#: Letters scored at a time; each has a number for every language.
SCORED = 1 << 16

#: Scripts by Unicode property; letters of others are counted together.
SCRIPTS = (
    "Latin",
    "Greek",
    "Cyrillic",
    "Armenian",
    "Hebrew",
    "Arabic",
    "Devanagari",
    "Bengali",
    "Tamil",
    "Telugu",
    "Thai",
    "Georgian",
    "Hangul",
    "Hiragana",
    "Katakana",
    "Han",
)
OTHER = len(SCRIPTS) + 1


@cache
def script_table() -> np.ndarray:
    """The script of every letter; 0: not a letter."""
    table = point_table({OTHER: r"\p{L}"})
    scripts = point_table({k + 1: rf"(?=\p{{L}})\p{{Script={name}}}" for k, name in enumerate(SCRIPTS)})
    return np.where(scripts > 0, scripts, table)


@cache
def lower_table() -> np.ndarray:
    table = np.arange(0x110000, dtype=np.uint32)
    points = all_points()
    for point, low in zip(map(ord, points), map(str.lower, points), strict=True):
        if len(low) == 1:
            table[point] = ord(low)
    return table


@dataclass
class Letters:
    """The words of some texts. text, script, size: of each word; start, end: its code points.

    bucket: the trigram around each letter; first: where each word begins among the letters.
    """

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    script: np.ndarray
    size: np.ndarray
    first: np.ndarray
    bucket: np.ndarray


def letters(texts: list[str]) -> tuple[Letters, np.ndarray]:
    points, begins = to_points(texts)
    scripts = script_table()[points]
    start, end = run_spans(points, begins, script_table() > 0)
    size = end - start
    first = np.cumsum(size) - size
    low = lower_table()[points[scripts > 0]].astype(np.uint64)
    left, right = np.zeros_like(low), np.zeros_like(low)
    left[1:], right[:-1] = low[:-1], low[1:]
    left[first] = 0
    right[first + size - 1] = 0
    mixed = low * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= left * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= right * np.uint64(0x165667B19E3779F9)
    mixed *= np.uint64(0xFF51AFD7ED558CCD)
    bucket = (mixed >> np.uint64(48)).astype(np.int64)
    text = np.searchsorted(begins, start, side="right") - 1
    return Letters(start, end, text, scripts[start], size, first, bucket), begins


@dataclass
class Model:
    """langs: the learned languages. score: log-likelihood of each trigram (rows) by language.

    uses: whether a language uses a script. common: the language with most letters.
    """

    langs: list[str]
    score: np.ndarray
    uses: np.ndarray
    common: int


def training_rows(docs: DataFrame) -> Column:
    """The rows that are learned from: key, text and language known, and not held out."""
    return ~held_out(docs) & F.col("lang").isNotNull() & F.col("text").isNotNull()


def held_out(docs: DataFrame) -> Column:
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(True))


def fit(docs: DataFrame) -> Model:
    """Learn from the text and language of all given rows.

    Of more than ``LANGUAGES`` labels those with the most rows are learned, of equally frequent ones the first
    by name; rows of the others are not learned from.
    """
    ship(docs.sparkSession)
    labels = docs.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES + 1).collect()
    if len(labels) > LANGUAGES:
        docs = docs.filter(F.col("lang").isin([row.lang for row in labels[:LANGUAGES]]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[str, int] = {}
        total: list[np.ndarray] = []
        for names, found in by_chunks(batches, 0, lambda rows, texts: (rows.column(1).to_pylist(), letters(texts)[0])):
            own = np.array([langs.setdefault(name, len(langs)) for name in names], np.int64)
            while len(total) < len(langs):
                total.append(np.zeros(BUCKETS + OTHER + 1, np.int64))
            lang = own[found.text]
            of_letter = np.repeat(lang, found.size)
            for k in np.unique(lang).tolist():
                total[k][:BUCKETS] += np.bincount(found.bucket[of_letter == k], minlength=BUCKETS)
                mine = lang == k
                scripts = np.bincount(found.script[mine], weights=found.size[mine], minlength=OTHER + 1)
                total[k][BUCKETS:] += scripts.astype(np.int64)
        for name, k in langs.items():
            place = np.flatnonzero(total[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(place), pa.string()), pa.array(place), pa.array(total[k][place])],
                names=["lang", "place", "n"],
            )

    counts = docs.select("text", "lang").mapInArrow(count, "lang string, place long, n long")
    # at most BUCKETS and the scripts for each language
    sums = counts.groupBy("lang", "place").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(sums["lang"].unique())
    table = np.zeros((BUCKETS + OTHER + 1, len(langs)))
    where = {name: k for k, name in enumerate(langs)}
    table[sums["place"].to_numpy(int), [where[name] for name in sums["lang"]]] = sums["n"]
    trigrams, scripts = table[:BUCKETS], table[BUCKETS:]
    seen = max(1, int((trigrams.sum(axis=1) > 0).sum()))
    score = np.log((trigrams + SMOOTHING) / (trigrams.sum(axis=0) + SMOOTHING * seen))
    uses = scripts >= USED * np.maximum(scripts.sum(axis=0), 1)
    common = int(scripts.sum(axis=0).argmax()) if langs else 0
    return Model(langs, score.astype(np.float32), uses, common)


def word_scores(model: Model, found: Letters) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood of each word by language, and whether its script is known to any language.

    Against the best candidate; languages that are no candidates get a value below all others.
    """
    if not len(found.first):
        return np.zeros((0, len(model.langs)), np.float32), np.zeros(0, bool)
    score = np.empty((len(found.first), model.score.shape[1]), np.float32)
    for low, high in chunks(found.size.tolist(), SCORED):
        begin = found.first[low]
        bucket = found.bucket[begin : found.first[high - 1] + found.size[high - 1]]
        score[low:high] = np.add.reduceat(model.score[bucket], found.first[low:high] - begin, axis=0)
    allowed = model.uses[found.script]
    known = allowed.any(axis=1)
    score = np.where(allowed, score, np.float32(-1e6))
    score -= score.max(axis=1, keepdims=True)
    score = np.maximum(score, np.float32(-1e3))
    score[~known] = 0
    return score, known


def best_path(score: np.ndarray, first: np.ndarray, count: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The label of every word on its text's best path; all texts advance together, word by word.

    first, count: the first word of each text and how many it has. A path stays if staying is as good.
    """
    label = np.zeros(len(score), np.int64)
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    active = np.searchsorted(-count, -np.arange(1, (count[0] if len(count) else 0) + 1), side="right")
    value = np.zeros((len(first), score.shape[1]))
    moved = np.zeros(score.shape, bool)
    source = np.zeros(len(score), np.int64)
    for step, k in enumerate(active.tolist()):
        word = first[:k] + step
        now = value[:k]
        origin = now.argmax(axis=1)
        jump = now[np.arange(k), origin] - switch
        move = now < jump[:, None]
        moved[word], source[word] = move, origin
        value[:k] = np.where(move, jump[:, None], now) + score[word]
    state = value.argmax(axis=1)
    for step in range(len(active) - 1, -1, -1):
        k = active[step]
        word = first[:k] + step
        label[word] = state[:k]
        state[:k] = np.where(moved[word, state[:k]], source[word], state[:k])
    return label


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))


def labelled(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray, pa.Array]:
    """Language, score and spans of each text. A span reaches from its first word to its last."""
    found, begins = letters(texts)
    n, size = len(texts), len(model.langs)
    if not size:
        return [UNKNOWN] * n, np.zeros(n), pa.array([[] for _ in texts], SPANS)
    score, known = word_scores(model, found)
    count = np.bincount(found.text, minlength=n)
    label = best_path(score, np.cumsum(count) - count, count)
    weight = np.bincount(found.text * size + label, weights=found.size * known, minlength=n * size).reshape(n, size)
    total = np.bincount(found.text, weights=found.size, minlength=n)
    best = np.where(weight.any(axis=1), weight.argmax(axis=1), model.common)
    share = weight.max(axis=1) / np.maximum(total, 1)
    langs = [model.langs[k] if n_letters else UNKNOWN for k, n_letters in zip(best, total, strict=True)]
    opens = np.ones(len(label), bool)
    opens[1:] = (label[1:] != label[:-1]) | (found.text[1:] != found.text[:-1])
    opening = np.flatnonzero(opens)
    closing = np.append(opening[1:], len(label))[: len(opening)] - 1
    text = found.text[opening]
    spans = pa.StructArray.from_arrays(
        [
            pa.array(found.start[opening] - begins[text], pa.int32()),
            pa.array(found.end[closing] - begins[text], pa.int32()),
            pa.array([model.langs[k] for k in label[opening]], pa.string()),
        ],
        fields=list(SPANS.value_type),
    )
    offsets = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
    return langs, share, pa.ListArray.from_arrays(pa.array(offsets), spans)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and spans (start and end in code points, lang) of every document."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # BUCKETS numbers for each language

    def predicted(rows: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        langs, score, spans = labelled(shared.value, texts)
        return pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(langs, pa.string()), pa.array(score), spans],
            names=["doc_id", "lang_pred", "score", "spans"],
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return by_chunks(batches, 1, predicted)

    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"
    return docs.select("doc_id", "text").mapInArrow(rows, schema)


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows, all columns kept, with a letter and a language of at least ``least`` of the letters."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def good(rows: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        langs, score, _ = labelled(shared.value, texts)
        return rows.filter(pa.array(((np.array(langs, object) != UNKNOWN) & (score >= least)).astype(bool)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return by_chunks(batches, at, good)

    return docs.mapInArrow(rows, docs.schema)


def identified(docs: DataFrame) -> DataFrame:
    """Learn from the rows not held out and predict all rows."""
    model = fit(docs.filter(training_rows(docs)))
    found = predict(docs, model)
    return found.select("doc_id", held_out(found).alias("held_out"), "lang_pred", "score", "spans")
