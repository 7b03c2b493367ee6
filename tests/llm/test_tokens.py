"""Token codec, token files and token totals."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from casebook.llm import library as library_module
from casebook.llm import bpe, token_files, token_rollups, words
from casebook.llm.library import byte_bpe_path, library, many_languages_path
from casebook.llm.queries import QUERIES
from casebook.workspace import new_folder, write_table

SF = "/root/testdata/sf0.001"
ODD = [
    "", " ", "  ", "I'm we'll they've you're 's 'S  's\n's x''s don't can'tt 'l 'll 'v 'r", "<|endoftext|>",
    "a<|endoftext|> b<|endoftext|><|endoftext|>", "日本語 テスト  ½ ² Ⅷ １２", " x 　 y\t\tz \n\n a", "🙂🙂 🏳️‍🌈 é",
    "\x00\x01 \x7f\x85  z", "x" * 3000, " " * 3000 + "b", "'", "''", "'s", "a'", " '", "a ᠎a ​ b",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(byte_bpe_path())


def random_texts(n):
    chance = random.Random(5)
    letters = "ab's tlve \n\t'’ é日1½!<| "
    return ["".join(chance.choice(letters) for _ in range(chance.randint(0, 60))) for _ in range(n)]


def test_trie_walk_equals_the_library(tokenizer, rows):
    texts = ODD + random_texts(2000) + [text for _, text in rows]
    code = bpe.codec(byte_bpe_path())
    expected = [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
    found = code.encode(texts)
    assert [ids.tolist() for ids in found] == expected
    assert [code.decode(ids).decode() for ids in found] == [
        tokenizer.decode(ids, skip_special_tokens=False) for ids in expected
    ]
    assert [ids.tolist() for ids in library(byte_bpe_path()).encode(texts)] == expected


def test_walk_forgets_and_still_agrees(monkeypatch, rows):
    code = bpe.Codec(byte_bpe_path())
    expected = bpe.codec(byte_bpe_path()).encode([text for _, text in rows[:50]])
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    monkeypatch.setattr(bpe, "PAIRS", 50)
    assert [x.tolist() for x in code.encode([text for _, text in rows[:50]])] == [x.tolist() for x in expected]


def test_long_texts_are_cut_where_no_token_spans(tokenizer):
    text = "word  two\n'll" * 50 + "x" * 400 + " and more" * 100
    cut = words.pieces(text, 100)
    assert "".join(cut) == text and len(cut) > 5
    assert sum((x.ids for x in tokenizer.encode_batch(cut, add_special_tokens=False)), []) == tokenizer.encode(text).ids
    assert words.pieces("x" * 500, 100) == ["x" * 500]


def test_decoding_bytes_that_are_no_text():
    code = bpe.codec(byte_bpe_path())
    lone = next(k for k, token in code.bytes_of.items() if token == b"\xe3")
    assert code.decode(np.array([lone, lone])) == "��".encode()


def test_colliding_hashes_do_not_mix_words(monkeypatch):
    monkeypatch.setattr(words, "span_keys", lambda points, within, first: np.zeros(len(first), np.uint64))
    inside = np.ones(0x110000, bool)
    inside[32] = False
    found = words.runs(["ab cd ab", "cd ef  abc"], inside)
    assert [found.distinct[k] for k in found.word] == ["ab", "cd", "ab", "cd", "ef", "abc"]
    assert found.text.tolist() == [0, 0, 0, 1, 1, 1]


def test_query_equals_the_library(spark, tokenizer, rows):
    found = {row.doc_id: row for row in QUERIES["op10_bpe"](spark, SF).collect()}
    for key, text in rows:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        row = found[key]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_awkward_rows_are_encoded(awkward, nothing, tokenizer):
    found = bpe.encode_decode(awkward, byte_bpe_path()).collect()
    assert len(found) == awkward.count()
    by_text = {row.text for row in awkward.collect()}
    assert {row.decoded for row in found} == {text or "" for text in by_text}
    assert bpe.digests(nothing, byte_bpe_path()).count() == 0


@pytest.mark.parametrize("width", [0, 1, 5, 7, 8, 9, 15, 16, 17, 31, 32])
def test_packing_round_trip(width):
    chance = np.random.default_rng(width)
    values = chance.integers(0, 1 << width, (7, token_files.BLOCK), np.uint32) if width else np.zeros((7, 256), np.uint32)
    packed = token_files.pack(values, width)
    assert packed.shape == (7, width * 32)
    assert (token_files.unpack(packed, width) == values).all()


def test_shards_hold_outliers_and_long_documents(tmp_path):
    chance = np.random.default_rng(1)
    documents = [np.array([2], np.uint32), chance.integers(0, 50, 9000, np.uint32), chance.integers(0, 1 << 32, 700, np.uint32)]
    documents[1][[5, 300, 8999]] = 4_000_000_000
    documents += [np.full(1, 7, np.uint32)] * 5
    with pa.OSFile(str(tmp_path / "x"), "wb") as stream:
        writer = token_files.ShardWriter(stream)
        writer.add([None, 1, 2], documents[:3])
        writer.add([3, 4, 5, 6, 7], documents[3:])
        writer.close()
    reader = token_files.ShardReader(pa.OSFile(str(tmp_path / "x")))
    found = [[] for _ in documents]
    for place, ids in reader.read():
        found[place] += ids.tolist()
    assert found == [ids.tolist() for ids in documents]
    assert reader.documents["known"].tolist() == [0] + [1] * 7 and reader.documents["key"][1:].tolist() == [*range(1, 8)]
    everything = np.concatenate(documents)
    for low, high in ((0, 0), (0, 1), (255, 257), (250, 6000), (len(everything) - 3, len(everything))):
        assert (reader.between(low, high) == everything[low:high]).all()


def test_a_cut_shard_is_refused(tmp_path):
    (tmp_path / "x").write_bytes(b"PFORTOK1" + bytes(60))
    with pytest.raises(ValueError, match="cut short"):
        token_files.ShardReader(pa.OSFile(str(tmp_path / "x")))


def test_files_give_every_document_back(spark, tokenizer, rows):
    found = QUERIES["op8_token_output"](spark, SF).orderBy("doc_id").collect()
    start = 0
    for row, (key, text) in zip(found, sorted(rows), strict=True):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        assert (row.doc_id, row.start, row.n_tokens) == (key, start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_every_document_of_a_larger_table_has_the_ids_of_its_whole_text(spark, tokenizer):
    """The library is given words; the ids are those it finds in whole texts."""
    folder = "/root/testdata/sf0.1"
    found = {row.doc_id: (row.n_tokens, row.ids_crc32) for row in QUERIES["op8_token_output"](spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    for low in range(0, len(rows), 500):
        part = rows[low : low + 500]
        for row, ids in zip(part, tokenizer.encode_batch([row.text or "" for row in part], add_special_tokens=False), strict=True):
            ids = np.array([*ids.ids, 2], "<u4")
            assert found[row.doc_id] == (len(ids), zlib.crc32(ids.tobytes()))


def test_null_and_repeated_keys_fill_several_shards(spark):
    rows = [(None if k < 3000 else k, f"text {k} of many") for k in range(6000)] + [(7000, f"other {k}") for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one shard
    try:
        shards = token_files.write_shards(docs, byte_bpe_path(), 2, new_folder(spark, "tokens"))
        sizes = sorted(row.n_docs for row in shards.collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 8000 and sizes[-1] < 2000


def test_a_very_long_text_without_a_blank(tokenizer):
    text = "ab" * 400_000
    expected = tokenizer.encode(text, add_special_tokens=False).ids
    assert library(byte_bpe_path()).encode([text])[0].tolist() == expected
    assert bpe.codec(byte_bpe_path()).encode([text])[0].tolist() == expected


def test_words_met_again_are_encoded_once(tokenizer, monkeypatch):
    """Words that occur once fill the memory; they do not push out those that every batch has."""
    monkeypatch.setattr(library_module, "REMEMBERED", 60)
    code, given = library_module.Library(byte_bpe_path()), []
    plain = code.run
    monkeypatch.setattr(code, "run", lambda found: given.extend(found) or plain(found))
    for k in range(30):
        text = "these five words stay known" + "".join(f" only{'abcdefghij'[k % 10]}x{'klmnopqrst'[n]}{'uvw'[k // 10]}" for n in range(10))
        assert code.encode([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert [given.count(word) for word in ("these", " five", " words", " stay", " known")] == [1] * 5
    assert code.remembered.uses.size <= 60


def test_remembered_words_of_one_hash_are_told_apart(tokenizer, monkeypatch):
    monkeypatch.setattr(words, "span_keys", lambda points, within, first: points[first].astype(np.uint64) % np.uint64(3))
    monkeypatch.setattr(library_module, "REMEMBERED", 20)
    code = library_module.Library(byte_bpe_path())
    for k in range(8):
        texts = [f"a word and other words, {'x' * n} of them'll do été 日本 {k * n}" for n in range(1, 5)]
        expected = [found.ids for found in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [ids.tolist() for ids in code.encode(texts)] == expected


def test_awkward_rows_are_written(spark, awkward, nothing):
    found = token_files.written_and_read(spark, awkward, byte_bpe_path()).orderBy("start").collect()
    assert [row.doc_id for row in found] == [None, 1, 2, 3, 4, 5, 5, 5, 6, 7, 8, 9]
    assert [row.n_tokens for row in found][1:3] == [1, 1]
    assert all(b.start == a.start + a.n_tokens for a, b in zip(found, found[1:], strict=False))
    assert token_files.written_and_read(spark, nothing, byte_bpe_path()).count() == 0


VOCABULARIES = {"byte_bpe_50k": byte_bpe_path(), "byte_bpe_multi_50k": many_languages_path()}


def test_totals_equal_counting_what_is_left(spark, documents):
    found = QUERIES["op2_token_counts"](spark, SF).collect()
    expected: dict = {}
    seen: set = set()
    for row in documents.orderBy("doc_id").collect():
        if row.text in seen:
            continue
        seen.add(row.text)
        name = "byte_bpe_50k" if row.lang == "en" else "byte_bpe_multi_50k"
        total = expected.setdefault((row.source, row.lang, name), [0, 0])
        total[0] += 1
        total[1] += len(library(VOCABULARIES[name]).encode([row.text])[0])
    assert {(r.source, r.lang, r.tokenizer): [r.n_docs, r.n_tokens] for r in found} == expected


def changes(spark, rows):
    return spark.createDataFrame(
        rows, "kind string, order int, doc_id long, source string, lang string, tokenizer string, n_tokens long"
    )


def test_batches_are_signed_and_committed_once(spark):
    rollup = token_rollups.TokenRollup(spark, new_folder(spark, "rollup"))
    assert rollup.totals().count() == 0
    first = changes(spark, [
        ("insert", 0, 1, "s", "en", "v1", 10), ("insert", 0, 2, "s", "en", "v1", 5), ("insert", 0, 3, None, None, "v1", None),
        ("insert", 1, 2, "s", "en", "v1", 7),
    ])
    assert rollup.commit("a", first) and not rollup.commit("a", first)
    second = changes(spark, [
        ("delete", 0, 1, None, None, None, None), ("delete", 0, 99, None, None, None, None), ("revise", 0, 2, "s", "en", "v2", 6),
    ])
    assert rollup.commit("b", second) and not rollup.commit("b", second) and rollup.commit("c", second.limit(0))
    found = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}
    assert found == {("s", "en", "v2"): (1, 6), (None, None, "v1"): (1, 0)}
    assert rollup.commit("d", second)  # the same document again: minus what it counted, plus the same
    assert {r.n_tokens for r in rollup.totals().collect()} == {6, 0}


def test_an_attempt_without_commit_counts_nothing(spark):
    rollup = token_rollups.TokenRollup(spark, new_folder(spark, "rollup"))
    with pytest.raises(PySparkException, match="without doc_id"):
        rollup.commit("a", changes(spark, [("insert", 0, None, "s", "en", "v1", 1)]))
    assert rollup.totals().count() == 0
    assert rollup.commit("a", changes(spark, [("insert", 0, 1, "s", "en", "v1", 1)]))
    assert rollup.totals().first().n_tokens == 1


def test_a_mark_that_was_never_finished_does_not_count(spark, tmp_path):
    """A driver that dies while it writes the mark leaves folders, and perhaps a file that is no commit yet."""
    rollup = token_rollups.TokenRollup(spark, str(tmp_path))
    first = changes(spark, [("insert", 0, 1, "s", "en", "v1", 10)])
    for folder in ("commits/b1/_temporary/0", "commits/b1/rollup-data-x/_temporary/0/_temporary/attempt_0/"):
        (tmp_path / folder).mkdir(parents=True)
    assert rollup.totals().count() == 0
    assert rollup.commit("b1", first) and not rollup.commit("b1", first)
    assert rollup.totals().first().n_tokens == 10


def test_two_writers_of_one_batch_count_once(spark, tmp_path, monkeypatch):
    """Both pass the check before either has written its mark; the data of one of them hold, for all readers."""
    one, other = (token_rollups.TokenRollup(spark, str(tmp_path)) for _ in range(2))
    first = changes(spark, [("insert", 0, 1, "s", "en", "v1", 10), ("insert", 0, 2, "s", "en", "v1", 5)])
    seen = []
    plain = other.committed
    monkeypatch.setattr(other, "committed", lambda: plain() if seen else seen.append(one.commit("b", first)) or {})
    assert other.commit("b", first) in (True, False)
    assert seen == [True] and list(one.committed()) == ["b"]
    assert one.totals().first().n_tokens == other.totals().first().n_tokens == 15
    assert one.commit("c", changes(spark, [("delete", 0, 1, None, None, None, None)]))
    assert other.totals().first().n_tokens == 5


def test_history_moves_no_texts(spark, tmp_path):
    """Texts are read once, by the pass that counts; shuffles carry short rows."""
    docs = spark.createDataFrame([(k, "text " * k, "en", "s") for k in range(5)], "doc_id long, text string, lang string, source string")
    docs.write.parquet(str(tmp_path / "documents"))
    base = token_rollups.entered(spark.read.parquet(str(tmp_path / "documents")), VOCABULARIES)
    plan = base._jdf.queryExecution().executedPlan().toString()
    assert "text" not in base.columns and "text#" not in plan


def test_history_of_awkward_rows(spark, awkward, nothing):
    known = awkward.filter(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
    rollup = token_rollups.TokenRollup(spark, new_folder(spark, "rollup"))
    found = token_rollups.history(write_table(known, "known"), rollup, VOCABULARIES)
    assert found.agg(F.sum("n_docs")).first()[0] == known.select("text").distinct().count() - known.filter("text is null").count()
    rollup = token_rollups.TokenRollup(spark, new_folder(spark, "rollup"))
    assert token_rollups.history(nothing, rollup, VOCABULARIES).count() == 0


def test_query_counts_null_and_repeated_keys(spark, tmp_path):
    """Every row counts, copies of a text once, whatever their keys."""
    rows = [
        (None, "no key", "en", "s"), (None, "no key", "en", "s"), (None, "no key", "fr", "t"), (None, None, "en", "s"),
        (1, "first of one", "en", "s"), (1, "second of one, longer", "de", "s"), (1, "second of one, longer", "de", "s"),
        (2, "first of one", "en", "s"), (3, "alone here", None, None), (4, "", "en", "s"), (None, "sans clé", "fr", "t"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op2_token_counts"](spark, str(tmp_path)).collect()
    expected: dict = {}
    # of the texts without a key on two sites either may stay
    both = [r.n_docs for r in found if (r.source, r.lang) == ("t", "fr")] == [2]
    left = [rows[2] if both else rows[0], *rows[4:6], rows[8], rows[9], rows[10]]
    for _, text, lang, source in left:
        name = "byte_bpe_50k" if lang == "en" else "byte_bpe_multi_50k"
        total = expected.setdefault((source, lang, name), [0, 0])
        total[0] += 1
        total[1] += len(library(VOCABULARIES[name]).encode([text])[0])
    assert {(r.source, r.lang, r.tokenizer): [r.n_docs, r.n_tokens] for r in found} == expected
    assert sum(r.n_docs for r in found) == 6


def test_rows_alike_count_each_until_one_stays(spark):
    rollup = token_rollups.TokenRollup(spark, new_folder(spark, "rollup"))
    docs = spark.createDataFrame([(None, "a b", "en", "s")] * 3, "doc_id long, text string, lang string, source string")
    token_rollups.history(docs, rollup, VOCABULARIES)
    signed = sorted((r.n_docs, r.n_tokens) for r in rollup.rows("ledger").collect())
    size = len(library(byte_bpe_path()).encode(["a b"])[0])
    assert signed == [(-3, -3 * size), (1, size), (3, 3 * size)]
