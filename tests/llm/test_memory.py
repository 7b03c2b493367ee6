"""Memory of a Python worker in the pipeline's stages."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from casebook.llm import bpe, language_spans, order_minhash
from casebook.llm.library import byte_bpe_path

MODEL = language_spans.Model(
    ["de", "en", *(f"x{k:02}" for k in range(18))],
    np.zeros((language_spans.BUCKETS, 20), np.float32),
    np.ones((language_spans.OTHER + 1, 20), bool),
    0,
)
STEPS = {
    "language ID": (lambda docs: language_spans.accepted(docs, MODEL), ["doc_id", "text"], 110),
    "near-dedup": (order_minhash.sketched, ["doc_id", "content", "text"], 52),
    "BPE": (lambda docs: bpe.encode_decode(docs, byte_bpe_path()), ["doc_id", "text"], 45),
}


@pytest.fixture(scope="module")
def texts():
    chance = random.Random(7)
    words = ["".join(chance.choices("abcdefghijklmnopqrstuvwxyzäöü", k=chance.randint(1, 9))) for _ in range(3000)]
    return [" ".join(chance.choices(words, k=500)) for _ in range(3000)]


@pytest.mark.parametrize("step", STEPS)
def test_a_worker_holds_a_part_of_its_batch(spark, texts, monkeypatch, step):
    """MB of strings and arrays at a time over two batches of 3,000 texts; what stays for all batches is made before."""
    build, columns, most = STEPS[step]
    docs = spark.createDataFrame([], "doc_id long, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, work, schema: work)
    work = build(docs)
    keys = pa.array(range(len(texts)))
    batch = pa.RecordBatch.from_arrays([pa.array(texts) if name == "text" else keys for name in columns], names=columns)
    assert sum(rows.num_rows for rows in work(iter([batch.slice(0, 100)]))) == 100
    tracemalloc.start()
    n_rows = sum(rows.num_rows for rows in work(iter([batch, batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n_rows == 2 * len(texts)
    assert peak < most * 1_000_000


def test_empty_batches_and_null_texts_are_encoded(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "ä b")], "doc_id long, text string")
    found = bpe.encode_decode(docs.repartition(5), byte_bpe_path()).orderBy("doc_id").collect()
    assert [row.decoded for row in found] == ["", "", "ä b"]
    assert bpe.encode_decode(docs.limit(0), byte_bpe_path()).count() == 0


def test_chunks_of_any_size_give_the_same_tokens(texts, monkeypatch):
    code = bpe.codec(byte_bpe_path())
    some = [*texts[:20], "", "a" * 3000, "<|endoftext|> x"]
    whole = [ids.tolist() for ids in bpe.encode_texts(some, code.encode_words, code.special)]
    monkeypatch.setattr(bpe, "ENCODED", 500)
    assert [ids.tolist() for ids in code.encode(some)] == whole
