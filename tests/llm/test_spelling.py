"""Spelling variants against brute force."""

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from casebook.llm import spelling


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def brute_variants(words: dict[str, int], ratio: int = 10) -> dict[str, tuple]:
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for word, n in words.items():
        best = min(near[word], key=lambda v: (-words[v], v), default=None)
        form[word] = best if best is not None and words[best] >= ratio * n else None

    def root(word):
        while form[word]:
            word = form[word]
        return word

    return {w: (form[w], root(w), words[w], len(near[w]), words[form[w]] if form[w] else None) for w in words}


def found_variants(rows) -> dict[str, tuple]:
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows.collect()}


@pytest.fixture(scope="module")
def crowd():
    """Words that share most of their letters, so that keys are refined down to single places."""
    rng = random.Random(5)
    words = {"ertionhe" + a + b: rng.choice([2, 3, 25, 400, 9000]) for a in "abcdefghijklm" for b in "éàüßopqrs"}
    words |= {"x" * 60 + a + "y" * 40: 2 + k for k, a in enumerate("abcdefgh")}
    words |= {"".join(rng.choice("ab") for _ in range(rng.randint(7, 9))): rng.choice([2, 30, 500]) for _ in range(300)}
    return words | {"q" * k: 10 ** (12 - k) * 2 for k in range(7, 13)}


@pytest.mark.parametrize("fan", [0, 1, spelling.FAN, 10**9])
def test_variants_equal_brute_force(spark, crowd, fan):
    """Whatever keys are refined, pairs are the same and each is found once."""
    found = found_variants(spelling.variants(spark.createDataFrame(list(crowd.items()), "word string, n long"), fan=fan))
    assert found == brute_variants(crowd)


def test_very_long_words(spark):
    """Runs of letters without an end are words; they take part in no more keys than others."""
    words = {"z" * 100_000: 2, "z" * 99_999: 90, "z" * 50_000 + "y" + "z" * 49_998: 5}
    found = found_variants(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert found == brute_variants(words)


def test_candidates_stay_in_proportion(spark):
    """A beginning that all words share makes no more candidates than the bound."""
    letters = "abcdefghijklmnopqrst"
    words = [(f"commonbeginning{a}{b}{c}", 2) for a in letters for b in letters for c in letters]
    pairs = spelling.near_pairs(spark.createDataFrame(words, "word string, n long"))
    assert pairs.count() == len(words) * 3 * (len(letters) - 1) // 2
    assert pairs.distinct().count() == pairs.count()


def test_roots_follow_forms_to_the_last(spark, crowd):
    found = found_variants(spelling.variants(spark.createDataFrame(list(crowd.items()), "word string, n long")))
    assert found["q" * 12][1] == "q" * 7 and found["q" * 12][0] == "q" * 11


def changed_words(rows) -> Counter:
    counts = Counter()
    for key, text in rows:
        for run in spelling.RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return Counter({w: n for w, n in counts.items() if len(w) >= 7 and n >= 2})


def test_vocabulary_equals_brute_force(awkward, documents, rows, nothing):
    found = spelling.vocabulary(documents, spelling.thirty_first_loses_a_letter)
    assert dict(found.collect()) == changed_words(rows)
    own = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    assert dict(spelling.vocabulary(awkward, spelling.thirty_first_loses_a_letter).collect()) == changed_words(own)
    assert spelling.variants(spelling.vocabulary(nothing)).count() == 0


def test_long_texts_are_cut_between_words(monkeypatch):
    text = "Straße ÀÉ çava " * 50 + "Z" * 200 + " ende"
    whole = spelling.run_counts(text)
    monkeypatch.setattr(spelling, "PIECE", 7)
    assert spelling.run_counts(text) == whole == Counter({"straße": 50, "ÀÉ": 50, "çava": 50, "z" * 200: 1, "ende": 1})


def test_repeated_rows_count_each(spark):
    docs = spark.createDataFrame([(1, "wording"), (1, "wording"), (None, "Wording"), (2, None), (3, "")], "doc_id long, text string")
    assert spelling.vocabulary(docs.withColumn("word", F.lit("x")).withColumn("n", F.lit(1))).collect() == [("wording", 3)]
