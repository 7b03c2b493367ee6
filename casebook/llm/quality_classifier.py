"""A quality classifier: Naive Bayes support vectors.

A text is the set of its n-grams: words, pairs of words, and triples of code points, hashed into
``BUCKETS`` buckets. Over the training rows each bucket gets the log of the ratio of its
shares in good and in bad texts. Indicators scaled by these ratios, divided by their length, are what
a linear model with hinge loss is fitted to by dual coordinate descent; its weights are drawn towards
their mean magnitude. Margins become probabilities by a logistic curve, fitted to the margins of rows
that were left out of a fit.

The model is fitted to a sample of the labelled rows: about ``ROWS`` keys, picked by a digest, so that
no text moves but theirs. Ratios are counted over all of the sample; the descent runs in one task, which
sees at most ``ENTRIES`` n-grams of it. Every document is scored.

A null or empty text has no n-grams and gets the score of the bias alone. Without training rows of
both classes every score is the share of good ones among those there are, 0.5 without any. A key that
has several labels is good if any says so. Null labels do not count. Rows without a key are held out.
Repeated rows count each. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.language_spans import held_out
from casebook.llm.quality_rules import word_points
from casebook.llm.shipping import ship
from casebook.llm.words import chunks, run_spans, span_keys, to_points
from casebook.workspace import write_table

BUCKETS = 1 << 18
#: Imagined texts of each class that have a bucket.
SMOOTHING = 1.0
#: Keys of training rows, about, and n-grams of theirs that the descent sees at most.
ROWS = 10_000
ENTRIES = 20_000_000
#: Weight of the loss, passes over the rows, share of a weight that is its own, folds of the curve.
COST = 1.0
ROUNDS = 12
OWN = 0.5
FOLDS = 3
#: Score from which a text counts as good.
GOOD = 0.3


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ values >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return values ^ values >> np.uint64(31)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Different buckets of each text, sorted, one text after another, and where each text's begin."""
    points, begins = to_points(texts)
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    start, end = run_spans(points, begins, word_points())
    found, owners = [], []
    if len(start):
        length = end - start
        first = np.cumsum(length) - length
        within = np.arange(length.sum(), dtype=np.int64) - np.repeat(first, length)
        words = mixed(span_keys(points[within + np.repeat(start, length)], within, first))
        text = np.searchsorted(begins, start, side="right") - 1
        pairs = np.flatnonzero(text[1:] == text[:-1])
        found += [words, mixed(words[pairs] * np.uint64(0x9E3779B97F4A7C15) + words[pairs + 1])]
        owners += [text, text[pairs]]
    owner = np.repeat(np.arange(len(texts)), np.diff(begins))
    triples = np.flatnonzero(owner[2:] == owner[:-2])
    wide = points.astype(np.uint64)
    found.append(mixed((wide[triples] << np.uint64(42)) + (wide[triples + 1] << np.uint64(21)) + wide[triples + 2]))
    owners.append(owner[triples])
    bucket = np.concatenate(found) & np.uint64(BUCKETS - 1)
    keys = np.unique(np.concatenate(owners).astype(np.uint64) * np.uint64(BUCKETS) + bucket).astype(np.int64)
    return keys % BUCKETS, np.searchsorted(keys // BUCKETS, np.arange(len(texts) + 1))


def gram_batches(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows from and to, their buckets and bounds, in pieces of bounded size."""
    texts = [text or "" for text in batch.column(column).to_pylist()]
    for low, high in chunks(list(map(len, texts))):
        yield low, high, *grams(texts[low:high])


@dataclass
class Model:
    """ratio: each bucket's log-count ratio; weight: what it adds to the margin; bias, and the curve's two values."""

    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, buckets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Probability of being good of each text."""
        total = np.concatenate([[0.0], np.cumsum(self.weight[buckets], dtype=float)])
        squares = np.concatenate([[0.0], np.cumsum(self.ratio[buckets].astype(float) ** 2)])
        norm = np.sqrt(squares[bounds[1:]] - squares[bounds[:-1]])
        margin = (total[bounds[1:]] - total[bounds[:-1]]) / np.where(norm > 1e-9, norm, 1.0) + self.bias
        return 1 / (1 + np.exp(np.clip(-self.slope * margin - self.shift, -700, 700)))


def labelled(docs: DataFrame, labels: DataFrame, limit: int = ROWS) -> DataFrame:
    """doc_id, text and good (0 or 1) of the rows to learn from: labelled, not held out, and picked by a digest of the key.

    Of up to ``limit`` labelled keys all are picked, else about so many: a list that every task can hold.
    """
    known = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id")
    known = known.agg(F.max((F.col("quality") > 0).cast("int")).alias("good"))
    known = write_table(known.filter(~held_out(known)), "known-labels")
    share = min(1.0, limit / max(known.count(), 1))
    picked = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1.0)
    return docs.select("doc_id", "text").join(F.broadcast(known.filter(picked)), "doc_id")


def bucket_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Texts that have each bucket, of the bad (0) and good (1) ones, and texts of each class."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            good = batch.column(1).to_numpy()
            for low, high, buckets, bounds in gram_batches(batch, 0):
                own = np.repeat(good[low:high], np.diff(bounds))
                for k in (0, 1):
                    total[k] += np.bincount(buckets[own == k], minlength=BUCKETS)
                texts += np.bincount(good[low:high], minlength=2)
        place = np.flatnonzero(total.any(axis=0))
        columns = [np.append(place, -1), *(np.append(total[k][place], texts[k]) for k in (0, 1))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "bad", "good"])

    counts = rows.select("text", "good").mapInArrow(count, "bucket long, bad long, good long")
    # at most BUCKETS rows and one
    sums = counts.groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toPandas()
    table, texts = np.zeros((2, BUCKETS)), np.zeros(2)
    for k, name in enumerate(("bad", "good")):
        inside = sums["bucket"] >= 0
        table[k][sums["bucket"][inside].to_numpy(int)] = sums[name][inside]
        texts[k] = sums[name][~inside].sum()
    return table, texts


def ratios(table: np.ndarray) -> np.ndarray:
    """Log of the ratio of each bucket's smoothed share in good and in bad texts; 0 for buckets never seen."""
    smooth = table + SMOOTHING
    share = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    return np.where(table.any(axis=0), share[1] - share[0], 0).astype(np.float32)


def descent(x: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: float = COST, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (the last is the bias) of the linear model with hinge loss, by dual coordinate descent.

    x and values: buckets and scaled indicators of each row, of length 1; y: +1 or -1. The rarer class
    weighs as much as the other.
    """
    w = np.zeros(BUCKETS + 1)
    alpha = np.zeros(len(y))
    limit = cost * np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    square = np.array([v @ v for v in values]) + 1
    order = np.random.default_rng(1)
    for _ in range(rounds):
        moved = 0.0
        for k in order.permutation(len(y)):
            gradient = y[k] * (w[x[k]] @ values[k] + w[-1]) - 1
            new = min(max(alpha[k] - gradient / square[k], 0.0), limit[k])
            step = (new - alpha[k]) * y[k]
            if step:
                w[x[k]] += step * values[k]
                w[-1] += step
                moved = max(moved, abs(step))
                alpha[k] = new
        if moved < 1e-3:
            break
    return w


def drawn(w: np.ndarray, own: float = OWN) -> np.ndarray:
    """Weights moved towards their mean magnitude, as all ratios point to the good class."""
    used = w[:-1] != 0
    if used.any():
        w = w.copy()
        w[:-1][used] = (1 - own) * np.abs(w[:-1][used]).mean() + own * w[:-1][used]
    return w


def curve(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of being good by margin, by Newton's method on smoothed targets."""
    n_good = good.sum()
    target = np.where(good > 0, (n_good + 1) / (n_good + 2), 1 / (len(good) - n_good + 2))
    slope, shift = 1.0, float(np.log((n_good + 1) / (len(good) - n_good + 1)))
    for _ in range(50):
        p = 1 / (1 + np.exp(np.clip(-slope * margin - shift, -500, 500)))
        weight = p * (1 - p) + 1e-9
        gradient = np.array([((p - target) * margin).sum(), (p - target).sum()])
        second = np.array([[(weight * margin**2).sum(), (weight * margin).sum()], [(weight * margin).sum(), weight.sum()]])
        step = np.linalg.solve(second + 1e-6 * np.eye(2), gradient)
        scale = min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        slope, shift = max(0.0, slope - scale * step[0]), shift - scale * step[1]
        if np.abs(step).max() < 1e-7:
            break
    return float(slope), float(shift)


def fitted(x: list[np.ndarray], good: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Weights by bucket with the bias last, and the curve, of some rows."""
    values = []
    for buckets in x:
        own = ratio[buckets].astype(float)
        values.append(own / max(1e-9, float(np.sqrt(own @ own))))
    y = np.where(good > 0, 1.0, -1.0)
    left_out = np.zeros(len(y))
    fold = np.arange(len(y)) % FOLDS
    for k in range(FOLDS):
        inside = np.flatnonzero(fold != k)
        w = drawn(descent([x[j] for j in inside], [values[j] for j in inside], y[inside]))
        for j in np.flatnonzero(fold == k):
            left_out[j] = w[x[j]] @ values[j] + w[-1]
    return drawn(descent(x, values, y)), *curve(left_out, good)


def fit(rows: DataFrame) -> Model:
    """Learn from doc_id, text and good (0 or 1) of training rows."""
    spark = rows.sparkSession
    ship(spark)
    rows = write_table(rows, "labelled")
    table, texts = bucket_counts(rows)
    ratio = ratios(table)
    if not texts.all():
        share = texts[1] / texts.sum() if texts.sum() else 0.5
        chance = np.clip(share, 1e-6, 1 - 1e-6)
        return Model(ratio, np.zeros(BUCKETS, np.float32), 0.0, 1.0, float(np.log(chance / (1 - chance))))
    known = spark.sparkContext.broadcast(ratio)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, buckets, bounds in gram_batches(batch, 1):
                sets = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(buckets.astype(np.int32)))
                rest = [batch.column(k).slice(low, high - low) for k in (0, 2)]
                yield pa.RecordBatch.from_arrays([*rest, sets], names=["place", "good", "buckets"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, good, entries = [], [], 0
        for batch in batches:
            if entries >= ENTRIES:
                continue
            for buckets, label in zip(batch.column(2), batch.column(1).to_pylist(), strict=True):
                own = buckets.values.to_numpy()
                entries += len(own)
                if entries >= ENTRIES:
                    break
                x.append(own)
                good.append(label)
        if not x:
            return
        weight, slope, shift = fitted(x, np.array(good), known.value)
        place = np.flatnonzero(weight)
        place = np.concatenate([place, [BUCKETS + 1, BUCKETS + 2]])
        value = np.concatenate([weight[place[:-2]], [slope, shift]])
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(value)], names=["place", "value"])

    sample = rows.select(F.xxhash64("doc_id").alias("place"), "text", "good")
    sets = write_table(sample.mapInArrow(cut, "place long, good int, buckets array<int>"), "sample")
    ordered = sets.repartition(1).sortWithinPartitions("place", "good", F.size("buckets"), F.xxhash64("buckets"))
    found = ordered.mapInArrow(learn, "place long, value double").toPandas()  # at most BUCKETS + 3 rows
    full = np.zeros(BUCKETS + 3)
    full[found["place"].to_numpy(int)] = found["value"]
    weight = (full[:BUCKETS] * ratio).astype(np.float32)
    return Model(ratio, weight, float(full[BUCKETS]), float(full[BUCKETS + 1]), float(full[BUCKETS + 2]))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score, the probability of being good, of every row."""
    spark = docs.sparkSession
    ship(spark)
    known = spark.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, buckets, bounds in gram_batches(batch, 1):
                score = known.value.scores(buckets, bounds)
                own = batch.column(0).slice(low, high - low)
                yield pa.RecordBatch.from_arrays([own, pa.array(score)], names=["doc_id", "score"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double"
    return docs.select("doc_id", "text").mapInArrow(rows, schema)


def classified(docs: DataFrame, labels: DataFrame, good: float = GOOD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, learned from labelled ones not held out."""
    found = scored(docs, fit(labelled(docs, labels)))
    predicted = (F.col("score") >= good).cast("int").alias("predicted")
    return found.select("doc_id", held_out(found).alias("held_out"), "score", predicted)
