"""Near-duplicates, repeated bytes, components and the pipeline."""

import itertools
import random
import tracemalloc

import brute
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from casebook.llm import components, order_minhash, suffix_dedup
from casebook.llm.library import byte_bpe_path
from casebook.llm.queries import QUERIES
from casebook.llm.words import to_points
from casebook.workspace import write_table

SF = "/root/testdata/sf0.001"


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 200), (131, 129)]
    found = components.components(spark.createDataFrame(links, "a long, b long"))
    labels = {row.id: row.label for row in found.collect()}
    assert set(labels) == {*range(41), *range(100, 130), 131}
    assert all(label == (0 if key <= 40 else 100) for key, label in labels.items())


def test_alignment_equals_the_full_table():
    chance = random.Random(7)
    for _ in range(1500):
        kinds = chance.choice([2, 5, 40, 200])
        a = [chance.randrange(kinds) for _ in range(chance.randint(1, 60))]
        b = list(a)
        for _ in range(chance.randint(0, 7)):
            place = chance.randrange(len(b) + 1)
            b[place : place + chance.randint(0, 2)] = [chance.randrange(kinds) for _ in range(chance.randint(0, 2))]
        m = brute.matched_in_order(a, b)
        true = m / (len(a) + len(b) - m)
        assert order_minhash.banded_matches(a, b, 70) == m
        assert order_minhash.similarity(a, b) == pytest.approx(true if true >= 0.8 else 0)


def test_alignment_by_lists_equals_bits(monkeypatch):
    chance = random.Random(8)
    for kinds in (1, 2, 5, 60, 400):
        b = [chance.randrange(kinds) for _ in range(400)]
        a = [x for x in b if chance.random() < 0.9]
        for band in (3, 60, 500):
            monkeypatch.setattr(order_minhash, "LONG", 1000)
            by_bits = order_minhash.banded_matches(a, b, band)
            monkeypatch.setattr(order_minhash, "LONG", 0)
            assert order_minhash.banded_matches(a, b, band) == by_bits


def test_alignment_of_very_long_texts_takes_little_memory():
    """Near copies that differ close to both ends, so that nothing equal can be cut off."""
    a = [f"w{k}" for k in range(60_000)]
    b = ["x", *a[1:-1], "y"]
    tracemalloc.start()
    found = order_minhash.similarity(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == pytest.approx(59_998 / 60_002)
    assert peak < 60_000_000


def test_sketches_depend_on_order():
    words = [f"w{k}" for k in range(200)]
    same, moved = " ".join(words), " ".join(words[100:] + words[:100])
    labels, bounds = order_minhash.shingle_labels([same, moved, same, "a b a b a b a b a b"])
    keys = [order_minhash.sketch(labels[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
    assert (keys[0] == keys[2]).all() and (keys[0] == keys[1]).sum() < order_minhash.SKETCHES / 2
    assert len(set(labels[bounds[3] : bounds[4]].tolist())) == 6  # repeated shingles are told apart


def test_long_texts_are_sketched_in_parts(monkeypatch):
    labels, _ = order_minhash.shingle_labels([" ".join(f"w{k}" for k in range(500))])
    whole = order_minhash.sketch(labels)
    monkeypatch.setattr(order_minhash, "HASHES", 1000)
    assert (order_minhash.sketch(labels) == whole).all()


def plain_sketch(labels):
    """All ranks of all sketches, sorted."""
    found = []
    for seed, odd in zip(order_minhash._SEEDS, order_minhash._ODDS, strict=True):
        chosen = np.sort(np.argsort((labels ^ seed) * odd)[: order_minhash.LENGTH])
        found.append(order_minhash.folded([np.array([seed]), *(labels[[place]] for place in chosen)])[0])
    return np.array(found).view(np.int64)


def test_sketches_of_a_chunk_equal_plain_ones(spark, monkeypatch):
    """Texts of every size, with repeats, all sketched in a number of steps that does not grow with the texts."""
    chance = random.Random(9)
    texts = [" ".join(f"w{chance.randrange(900)}" for _ in range(k % 60)) for k in range(900)]
    texts += ["a b a b a b a b a b a", "x " * 70, "é\x00 日本 🙂 a b c d", " \t", "", " ".join(f"w{k}" for k in range(3000))]
    steps = []
    plain = order_minhash.folded
    monkeypatch.setattr(order_minhash, "folded", lambda columns: steps.append(1) or plain(columns))
    docs = spark.createDataFrame([], "doc_id long, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, work, schema: work)
    keys = pa.array(range(len(texts)))
    batch = pa.RecordBatch.from_arrays([keys, keys, pa.array(texts)], names=["doc_id", "content", "text"])
    (found,) = order_minhash.sketched(docs)(iter([batch]))
    assert len(steps) < 100
    for text, n, own in zip(texts, found.column(2).to_pylist(), found.column(3).to_pylist(), strict=True):
        labels, _ = order_minhash.shingle_labels([text])
        assert n == len(labels) == len(order_minhash.shingled(text)) == len(set(labels.tolist()))
        assert own == (plain_sketch(labels).tolist() if n else [])


def test_words_have_hashes_of_their_own():
    """Over all words of the given texts, and words made of the same letters."""
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])
    words = {word for text in table.column("text").to_pylist() for word in (text or "").split()}
    words |= {"".join(letters) for letters in itertools.product("ab", repeat=12)} | {"a" * n for n in range(1, 300)}
    points, begins = to_points(list(words))
    assert len(np.unique(order_minhash.word_hashes(points, begins[:-1], begins[1:]))) == len(words) > 20_000


def classes(found):
    return {row.doc_id: row.class_id for row in found.collect()}


def test_query_equals_all_pairs(spark, rows):
    found = QUERIES["op3_minhash_near_dedup"](spark, SF)
    assert classes(found) == brute.near_classes(rows)
    assert found.filter("kept <> (doc_id = class_id)").isEmpty()


def edited(words, chance, n):
    words = list(words)
    for place in chance.sample(range(len(words)), n):
        words[place] = f"new{chance.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("base", [True, False])
def test_groups_of_near_copies_are_whole(spark, base):
    """Copies of one text that are near it but often not near each other, and a common passage."""
    chance = random.Random(11)
    words = [f"w{chance.randrange(3000)}" for _ in range(300)]
    texts = [edited(words, chance, 4) for _ in range(40)] + [" ".join(words)] * base
    passage = " ".join(f"p{k}" for k in range(30))
    texts += [passage + " " + " ".join(f"q{chance.randrange(10**6)}" for _ in range(40)) for _ in range(25)]
    rows = list(enumerate(texts))
    chance.shuffle(rows)
    found = order_minhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert classes(found) == brute.near_classes(rows)


def test_groups_are_compared_in_blocks(spark, monkeypatch):
    """Copies that no leader links, in many blocks: none of the links across blocks is lost."""
    monkeypatch.setattr(order_minhash, "BLOCK_TEXTS", 7)
    chance = random.Random(12)
    words = [f"w{chance.randrange(3000)}" for _ in range(300)]
    rows = [(k, edited(words, chance, 4)) for k in range(60)]
    rows += [(100 + k, edited(rows[k][1].split(" "), chance, 1)) for k in range(0, 60, 3)]
    found = order_minhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert classes(found) == brute.near_classes(rows)


def test_short_near_copies_are_all_found(spark):
    """Pairs of every size from 8 words on, with a word more, and two that differ at both ends."""
    rows = []
    for n in range(8, 32):
        for k in range(6):
            words = [f"n{n}k{k}w{j}" for j in range(n)]
            rows += [" ".join(words), " ".join([*words, "more"]), " ".join(["x", *words[1:-1], "y"])]
    rows += [" ".join([f"t{j}" for j in range(9)] + [f"own{k}"]) for k in range(40)]  # one template
    rows = list(enumerate(rows))
    random.Random(13).shuffle(rows)
    found = classes(order_minhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")))
    assert found == brute.near_classes(rows)
    assert found[1] == 0 and len(set(found.values())) < len(rows)


def test_many_rows_of_a_null_key(spark):
    """Rows of one null key and one text are one text, however many."""
    words = [f"w{k}" for k in range(60)]
    near = " ".join([*words[:-1], "other"])
    rows = [(None, " ".join(words))] * 5000 + [(None, near)] * 5000 + [(7, near), (9, "quite another text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found, links = order_minhash.near_classes(docs)
    assert links.count() == 1
    assert found.groupBy("class_id").count().orderBy("class_id").collect() == [(7, 10_001), (9, 1)]
    assert found.filter("kept and class_id = 7").count() == 1


def test_pairs_stay_in_proportion_to_texts(spark, monkeypatch):
    """Copies of one text with edits of their own: links and compared pairs grow with the texts."""
    compared = {}
    plain = order_minhash.linked

    def counting(pairs, texts, least):
        compared[n] = compared.get(n, 0) + pairs.count()
        return plain(pairs, texts, least)

    monkeypatch.setattr(order_minhash, "linked", counting)
    chance = random.Random(14)
    words = [f"w{chance.randrange(3000)}" for _ in range(200)]
    for n in (100, 400):
        rows = [(k, edited(words, chance, 2)) for k in range(n)]  # any two match in 0.81 of their shingles
        found, links = order_minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string"))
        assert found.select("class_id").distinct().count() == 1
        assert links.count() < 2 * n
    assert compared[400] < 6 * compared[100] and compared[400] < 8 * 400


def test_texts_that_met_are_not_looked_at_again(spark, monkeypatch):
    """Pairs that share sketches and are not alike: the one is its buckets' leader, so nothing is left to find."""
    looked = []
    plain = order_minhash.all_shingles
    monkeypatch.setattr(order_minhash, "all_shingles", lambda texts: looked.append(texts.count()) or plain(texts))
    rows = []
    for k in range(30):
        words = [f"p{k}w{j}" for j in range(100)]
        rows += [" ".join(words), " ".join([*words[:80], *(f"q{k}w{j}" for j in range(20))])]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert order_minhash.similarity(*(order_minhash.shingled(text) for text in rows[:2]), 0.6) > 0.6
    sketches = [order_minhash.sketch(order_minhash.shingle_labels([text])[0]) for text in rows[:2]]
    assert (sketches[0] == sketches[1]).any()
    assert classes(order_minhash.deduplicated(docs)) == {k: k for k in range(60)}
    assert looked == []


def test_awkward_rows_have_classes(awkward, nothing):
    found = order_minhash.deduplicated(awkward).collect()
    assert len(found) == awkward.count()
    same = [row for row in found if row.doc_id == 6]
    assert same[0].class_id == 5 and not same[0].kept
    assert all(row.class_id == row.doc_id and row.kept for row in found if row.doc_id != 6)
    kept = order_minhash.without_duplicates(awkward)
    assert kept.schema == awkward.schema and kept.count() == awkward.count() - 1
    assert order_minhash.deduplicated(nothing).count() == 0


# Repeated bytes


def random_documents(chance):
    letters = chance.choice([b"ab", b"a", b"abc \x00\xff", bytes(range(256)), b"abcdefgh "])
    base = bytes(chance.choice(letters) for _ in range(chance.choice([50, 150, 300, 700])))
    for _ in range(chance.randint(1, 6)):
        text = bytearray(base if chance.random() < 0.7 else b"")
        for _ in range(chance.randint(0, 3)):
            place = chance.randrange(len(text) + 1)
            text[place : place + chance.randint(0, 2)] = bytes(
                chance.choice(letters) for _ in range(chance.randint(0, 120))
            )
        yield bytes(text * chance.choice([1, 1, 1, 2, 3]))


def test_suffix_arrays_find_every_repeat():
    chance = random.Random(3)
    for _ in range(150):
        docs = list(random_documents(chance))
        data = np.frombuffer(b"".join(docs), np.uint8)
        begins = np.concatenate([[0], np.cumsum([len(x) for x in docs])])
        value, first, last, text = suffix_dedup.choices(data, begins)
        for k, doc in enumerate(docs):  # each window chose once
            assert (last - first + 1)[text == k].sum() == max(0, len(doc) - 99)
        _, number, times = np.unique(value, return_inverse=True, return_counts=True)
        chosen = np.flatnonzero(times[number] > 1)
        gone = [np.zeros(len(doc), bool) for doc in docs]
        if len(chosen):
            contexts = [docs[text[k]][first[k] : last[k] + 100] for k in chosen]
            own, starts, stops = suffix_dedup.spans_of(*suffix_dedup.repeats(contexts, text[chosen], first[chosen]))
            for k, start, stop in zip(chosen[own], starts, stops, strict=True):
                gone[text[k]][first[k] + start : first[k] + stop] = True
        seen: set = set()
        for doc, out in zip(docs, gone, strict=True):
            expected = np.zeros(len(doc), bool)
            for k in range(len(doc) - 99):
                if doc[k : k + 100] in seen:
                    expected[k : k + 100] = True
                seen.add(doc[k : k + 100])
            assert (expected == out).all()


def test_order_and_prefixes_of_a_block():
    chance = random.Random(4)
    contexts = [bytes(chance.choice(b"ab") for _ in range(chance.randint(100, 140))) for _ in range(20)] + [b"a" * 130] * 2
    data = np.frombuffer(b"".join(contexts), np.uint8)
    ends = np.cumsum([len(x) for x in contexts])
    context = np.repeat(np.arange(len(contexts)), [len(x) for x in contexts])
    order = suffix_dedup.sort_suffixes(data, context, np.arange(len(data)), ends)
    suffixes = [data[p : ends[c]].tobytes()[:100] for p, c in zip(order, context[order], strict=True)]
    assert sorted(order) == list(range(len(data))) and suffixes == sorted(suffixes)


def test_query_equals_a_set_of_windows(spark, rows):
    found = suffix_dedup.removed(spark.createDataFrame(rows, "doc_id long, text string"))
    expected = brute.repeated_bytes(rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect()} == expected


def test_awkward_rows_lose_what_is_repeated(spark, awkward, nothing):
    long = "repeated words " * 9 + "é"
    more = spark.createDataFrame([(20, long), (21, long), (21, long), (22, "x" + long + "z"), (23, long), (None, long)], "doc_id long, text string")
    docs = awkward.select("doc_id", "text").unionByName(more)
    found = suffix_dedup.removed(docs)
    by = {}
    for row in found.collect():
        by.setdefault(row.doc_id, []).append(row)
    assert found.count() == docs.count()
    size = len(long.encode())
    assert [r.n_removed for r in by[21]] == [size, size] and by[23][0].n_removed == size
    assert {r.n_removed for r in by[None]} == {0, size}
    whole = brute.repeated_bytes([(20, long), (22, "x" + long + "z")])
    assert [tuple(by[k][0])[1:] for k in (20, 22)] == [whole[20], whole[22]]
    assert by[1][0].n_bytes == 0 and by[9][0].n_removed == 5000  # the one before it has 300 of that letter
    assert suffix_dedup.removed(nothing).count() == 0


def test_a_hash_of_many_blocks(spark, monkeypatch):
    """A passage that all documents have behind beginnings of their own: its hashes' windows are dealt one by one."""
    monkeypatch.setattr(suffix_dedup, "BLOCK", 5_000)
    chance = random.Random(21)
    passage = "".join(chance.choice("abcdefgh ") for _ in range(260))
    tails = ["".join(chance.choice("xyz ") for _ in range(120)) for _ in range(30)]
    rows = [(k, f"{chance.randrange(10**60)} {passage}{chance.choice(tails)}{k}") for k in range(400)]
    docs = write_table(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), "passages")
    found = suffix_dedup.removed(docs)
    expected = brute.repeated_bytes(rows)
    assert {row.doc_id: (row.n_bytes, row.n_removed, row.n_spans, row.kept_sha256) for row in found.collect()} == expected
    keyed = docs.selectExpr("doc_id doc", "xxhash64(text) part", "text")
    crowded = suffix_dedup.crowded_hashes(suffix_dedup.repeated_choices(keyed))
    assert crowded.count() > 1
    assert not [table.name for table in spark.catalog.listTables() if table.name.startswith("texts_")]


def test_a_block_takes_bounded_memory():
    """A block's arrays, at the most, for each byte of its contexts; contexts that share most of their bytes."""
    chance = np.random.default_rng(22)
    base = chance.integers(97, 117, 4000, np.uint8).tobytes()
    contexts = []
    for _ in range(suffix_dedup.BLOCK // 176):
        at = int(chance.integers(0, len(base) - 176))
        contexts.append(base[at : at + 88] + chance.integers(97, 117, 88, np.uint8).tobytes())
    rank, start = np.arange(len(contexts)), np.zeros(len(contexts), np.int64)
    tracemalloc.start()
    suffix_dedup.repeats(contexts, rank, start)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150_000_000


# Pipeline


def test_pipeline_equals_brute_force(spark, documents):
    """On texts in four languages with letters, the language stage keeps all; the rest is plain Python."""
    rows = [(r.doc_id, r.source, r.text) for r in documents.orderBy("doc_id").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = brute.shortened([row[1:] for row in rows])
    left = [(row[0], text) for row, text in zip(rows, texts, strict=True) if text is not None]
    same = brute.near_classes(left)
    left = [(key, text) for key, text in left if same[key] == key]
    hits = brute.contamination(left, items)
    left = {key: text for (key, text), hit in zip(left, hits, strict=True) if not hit[1]}
    tokenizer = Tokenizer.from_file(byte_bpe_path())
    expected = {key: len(tokenizer.encode(text, add_special_tokens=False).ids) for key, text in left.items()}
    assert {row.doc_id: row.n_tokens for row in corpus_pipeline.run(spark, SF).collect()} == expected


def test_stages_keep_the_columns(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = write_table(stage(spark, docs, SF), "stage")
            assert [f.name for f in docs.schema] == awkward.columns
        assert {"doc_id", "n_tokens"} <= set(corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns)


def test_all_operators_are_registered():
    names = contract.queries()
    assert [sum(name.startswith(f"op{n}_") for name in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5
