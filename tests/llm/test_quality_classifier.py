"""The quality classifier against plain versions and held-out labels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from casebook.llm import quality_classifier as nbsvm
from casebook.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def judged(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return QUERIES["op12_quality_classifier"](spark, SF).join(labels, "doc_id").toPandas()


def test_held_out_documents_are_ranked_by_their_labels(judged):
    rows = judged[judged.held_out]
    good, bad = (rows[rows.quality == k].score.to_numpy() for k in (1, 0))
    area = (good[:, None] > bad[None, :]).mean()
    assert area > 0.98
    assert (good >= nbsvm.GOOD).mean() > 0.98 and (bad < nbsvm.GOOD).mean() > 0.7
    assert ((judged.score >= 0) & (judged.score <= 1)).all()
    assert (judged.predicted == (judged.score >= 0.3)).all()


def plain_grams(text: str) -> set:
    words = nbsvm_words(text)
    found = {("w", w) for w in words} | {("p", a, b) for a, b in zip(words, words[1:], strict=False)}
    return found | {("c", text[k : k + 3]) for k in range(len(text) - 2)}


def nbsvm_words(text: str) -> list[str]:
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text)


def test_grams_are_words_pairs_and_triples():
    texts = ["the cat the cat", "", "été 日本🙂 x", "the cat the cat", "ab"]
    buckets, bounds = nbsvm.grams(texts)
    sets = [set(buckets[a:b].tolist()) for a, b in zip(bounds, bounds[1:], strict=False)]
    for text, found in zip(texts, sets, strict=True):
        assert len(plain_grams(text)) - 1 <= len(found) <= len(plain_grams(text))
    assert sets[0] == sets[3] and not sets[1]
    alone = [set(nbsvm.grams([text])[0].tolist()) for text in texts]
    assert alone == sets


def test_ratios_equal_their_definition():
    table = np.zeros((2, nbsvm.BUCKETS))
    table[:, :3] = [[4, 0, 2], [1, 6, 2]]
    found = nbsvm.ratios(table)
    bad, good = table[0] + 1, table[1] + 1
    assert np.allclose(found[:3], np.log(good / good.sum() / (bad / bad.sum()))[:3], atol=1e-6)
    assert not found[3:].any()


def test_descent_finds_the_least_loss():
    """The duals fulfil the conditions of the optimum, and no point near it is better."""
    rng = np.random.default_rng(4)
    x, values, y = [], [], []
    for k in range(60):
        own = np.sort(rng.choice(8, 3, replace=False))
        value = rng.normal(size=3)
        value /= np.sqrt(value @ value)
        x.append(own)
        values.append(value)
        y.append(1.0 if value[0] + 0.3 * rng.normal() > 0 else -1.0)
    y = np.array(y)
    w = nbsvm.descent(x, values, y, rounds=2000)

    def loss(w):
        cost = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))
        margin = np.array([w[a] @ v + w[-1] for a, v in zip(x, values, strict=True)])
        return w @ w / 2 + (cost * np.maximum(0, 1 - y * margin)).sum()

    best = loss(w)
    for _ in range(200):
        step = np.zeros_like(w)
        step[[*range(8), -1]] = rng.normal(size=9) * 10 ** rng.uniform(-3, 0)
        assert loss(w + step) >= best - 1e-2


def test_scores_equal_the_plain_sum(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = nbsvm.fit(nbsvm.labelled(documents, labels))
    texts = [row.text or "" for row in documents.limit(20).collect()]
    found = model.scores(*nbsvm.grams(texts))
    for text, score in zip(texts, found, strict=True):
        own = nbsvm.grams([text])[0]
        length = np.sqrt((model.ratio[own].astype(float) ** 2).sum()) or 1.0
        margin = model.weight[own].astype(float).sum() / length + model.bias
        assert score == pytest.approx(1 / (1 + np.exp(-model.slope * margin - model.shift)), abs=1e-6)


def test_only_rows_not_held_out_are_learned_from(spark):
    import zlib

    docs = spark.createDataFrame([(k, f"text number {k}") for k in range(50)] + [(None, "no key")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(50)] + [(None, 1), (60, 1)], "doc_id long, quality int")
    rows = {row.doc_id: row.good for row in nbsvm.labelled(docs, labels).collect()}
    assert rows == {k: k % 2 for k in range(50) if zlib.crc32(str(k).encode()) % 5}


def test_a_sample_of_labelled_keys_is_learned_from(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    assert 700 < nbsvm.labelled(docs, labels, 1000).count() < 1300
    everything = docs.filter(~nbsvm.held_out(docs)).count()
    assert nbsvm.labelled(docs, labels, everything).count() == everything


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 0, 0), (5, 1, 0), (5, 0, 0), (7, 0, 0), (8, None, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    found = nbsvm.classified(awkward, labels)
    assert found.count() == awkward.count() and found.filter("score is null or predicted is null").isEmpty()
    assert found.filter("doc_id is null and held_out").count() == 1
    empty = [row.score for row in found.filter("doc_id in (1, 2)").collect()]
    assert len(set(empty)) == 1
    assert nbsvm.classified(nothing, labels).count() == 0
    # one class only, and no labels at all
    one = nbsvm.classified(awkward, labels.filter("quality = 1")).select("score").distinct().collect()
    assert len(one) == 1 and one[0].score > 0.9
    none = nbsvm.classified(awkward, labels.limit(0)).select("score").distinct().collect()
    assert [row.score for row in none] == pytest.approx([0.5])


def test_repeated_labels_are_one(spark):
    docs = spark.createDataFrame([(2, "a b c"), (2, "a b c"), (3, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(2, 0), (2, 1), (3, 0)], "doc_id long, quality int").withColumn("text", F.lit("x"))
    assert sorted(tuple(row) for row in nbsvm.labelled(docs, labels).select("doc_id", "good").collect()) == [(2, 1), (2, 1), (3, 0)]
