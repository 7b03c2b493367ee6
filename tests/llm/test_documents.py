"""Quality, language, lines, phrases and URLs."""

import brute
import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from casebook.llm import language_spans, line_spread, phrase_index, quality_rules, url_filter
from casebook.llm.queries import ORACLES, QUERIES
from casebook.workspace import write_table

SF = "/root/testdata/sf0.001"


NATIVE = ("op6_line_dedup", "op7_benchmark_decontamination", "op9_url_filters")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    result = QUERIES[name](spark, SF)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("CartesianProduct", "BroadcastNestedLoopJoin"))
    assert name not in NATIVE or not any(node in plan for node in ("Python", "InPandas", "Arrow"))
    assert compare.differences(result, ORACLES[name], compare.connect(compare.DATA / "sf0.001")) == []


# Quality


def test_measures_equal_brute_force(spark, rows, awkward):
    found = {row.doc_id: row for row in QUERIES["op1_quality_rules"](spark, SF).collect()}
    for key, text in rows:
        expected = brute.measures(text)
        row = found[key]
        assert {name: row[name] for name in expected} == expected
        failed = expected["n_words"] < 50 or 100 * expected["n_repeat_words"] > 50 * expected["n_words"]
        assert row.base_failed == failed and (row.kept == (not failed and row.quality >= 0.5))
    for row in awkward.join(quality_rules.measures(awkward), "doc_id").select("text", *brute.measures("")).collect():
        if row.text and "same" not in row.text and "other" not in row.text:
            assert {name: row[name] for name in brute.measures("")} == brute.measures(row.text)


def test_verdicts_equal_brute_force(spark):
    """Votes from the measures by plain rules, and the model fitted row by row."""
    rules = quality_rules.RULES
    rows = quality_rules.scored(spark.read.parquet(f"{SF}/documents.parquet")).collect()

    def vote(rule, row):
        names = {name: row[name] for name in quality_rules.MEASURES}
        value = eval(rule.value, {"greatest": max, "pow": pow}, names)  # the same text is SQL and Python
        return -1 if value > rule.bad else 1 if value <= rule.good else 0

    votes = [tuple(vote(rule, row) for rule in rules) for row in rows]
    assert votes == [tuple(row[rule.name] for rule in rules) for row in rows]
    expected = brute.posteriors(votes)
    assert all(abs(row.quality - expected[own]) < 1e-6 for row, own in zip(rows, votes, strict=True))
    judged = {row.doc_id: row for row in QUERIES["op1_quality_rules"](spark, SF).collect()}
    assert all(judged[row.doc_id].kept == (not judged[row.doc_id].base_failed and expected[own] >= 0.5) for row, own in zip(rows, votes, strict=True))


def test_planted_defects_are_dropped(spark):
    """All capitals, marks after every word, and very long words, among clean documents."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(800).select("doc_id", "text")
    spoilt = docs.filter("doc_id % 23 = 0 and length(text) > 600")
    parts = {
        "capitals": F.upper("text"),
        "marks": F.regexp_replace("text", r"(\S) ", "$1!!! "),
        "long words": F.regexp_replace("text", r"(\S+) (\S+) (\S+) (\S+) (\S+) ", "$1$2$3$4$5 "),
    }
    clean = quality_rules.judged(docs).filter("kept").select("doc_id")
    spoilt = write_table(spoilt.join(clean, "doc_id"), "spoilt")
    planted = docs.withColumn("kind", F.lit("given"))
    for kind, text in parts.items():
        planted = planted.union(spoilt.select((F.col("doc_id") + 10**6 * (1 + list(parts).index(kind))).alias("doc_id"), text, F.lit(kind)))
    planted = write_table(planted, "planted")
    judged = quality_rules.judged(planted).join(planted.select("doc_id", "kind"), "doc_id")
    rates = dict(judged.filter("not base_failed").groupBy("kind").agg(F.avg(F.col("kept").cast("int"))).collect())
    before = quality_rules.judged(docs).filter("not base_failed").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert rates["capitals"] <= 0.05 and rates["marks"] <= 0.05 and rates["long words"] <= 0.05
    assert rates["given"] >= before - 0.005


def test_rules_find_junk_without_labels(spark):
    folder = "/root/testdata/sf0.1"
    judged = quality_rules.judged(spark.read.parquet(f"{folder}/documents.parquet")).drop("quality")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rates = judged.filter("not base_failed").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")))
    found = dict(rates.collect())
    assert found[1] > 0.99 and found.get(0, 0) < 0.1


def test_fitting_weighs_rules_by_agreement():
    votes = np.array([[1, 1, 1], [-1, -1, 1], [1, 1, -1], [0, 0, 0]])
    good = quality_rules.posteriors(votes, np.array([900.0, 90.0, 5.0, 5.0]))
    assert good[0] > 0.9 and good[1] < 0.1 and good[2] > good[1]
    assert quality_rules.posteriors(votes[:0], np.zeros(0)).tolist() == []


def test_awkward_rows_are_judged(awkward, nothing):
    found = quality_rules.judged(awkward)
    assert found.count() == awkward.count()
    assert found.filter("not base_failed").isEmpty()  # the long one repeats itself
    assert quality_rules.judged(nothing).count() == 0


# Language


def naive_path(score, switch):
    best = [0.0] * score.shape[1]
    steps = []
    for row in score:
        top = max(range(len(best)), key=lambda k: (best[k], -k))
        come = [k if best[k] >= best[top] - switch else top for k in range(len(best))]
        best = [max(best[k], best[top] - switch) + row[k] for k in range(len(best))]
        steps.append(come)
    state = max(range(len(best)), key=lambda k: (best[k], -k))
    path = []
    for come in reversed(steps):
        path.append(state)
        state = come[state]
    return path[::-1]


def test_paths_equal_a_plain_viterbi():
    chance = np.random.default_rng(3)
    for _ in range(50):
        count = chance.integers(0, 9, 6)
        score = chance.normal(0, 4, (count.sum(), 3)).round(2).astype(np.float32)
        first = np.cumsum(count) - count
        label = language_spans.best_path(score, first, count, 2.5)
        expected = [x for a, n in zip(first, count, strict=True) for x in naive_path(score[a : a + n].astype(float), 2.5)]
        assert label.tolist() == expected


def test_held_out_documents_are_identified(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = QUERIES["op5_language_id"](spark, folder)
    assert found.count() == docs.count()
    tested = found.join(docs, "doc_id").filter("held_out and lang is not null")
    right, total = tested.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert total > 100 and right / total > 0.97


def test_query_equals_a_plain_model(spark, documents):
    rows = documents.select("doc_id", "text", "lang", language_spans.training_rows(documents).alias("learned")).collect()
    train = [(row.lang, row.text) for row in rows if row.learned]
    expected = brute.languages(train, [row.text for row in rows], language_spans.SWITCH, language_spans.SMOOTHING, language_spans.USED)
    found = {row.doc_id: row.lang_pred for row in QUERIES["op5_language_id"](spark, SF).collect()}
    same = [found[row.doc_id] == lang for row, lang in zip(rows, expected, strict=True)]
    assert sum(same) >= len(same) - 1  # rounding may decide a tie


def test_only_so_many_languages_are_learned(spark, monkeypatch):
    """Junk labels, each of a few rows, take no place of the frequent ones."""
    monkeypatch.setattr(language_spans, "LANGUAGES", 2)
    rows = [(k, "the cat and the dog", "en") for k in range(9)] + [(20 + k, "der hund und die katze", "de") for k in range(5)]
    rows += [(100 + k, "zzz qqq", f"junk{k}") for k in range(50)]
    model = language_spans.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["de", "en"]


def test_labels_are_no_inputs_of_a_prediction(spark, documents):
    model = language_spans.fit(documents.filter(language_spans.training_rows(documents)))
    plain = language_spans.predict(documents, model).drop("spans")
    other = documents.withColumns({"lang": F.lit("xx"), "source": F.lit("yy")})
    assert plain.exceptAll(language_spans.predict(other, model).drop("spans")).isEmpty()


def test_mixed_texts_are_cut_into_spans(spark):
    rows = [
        (1, "the cat and the dog are in the house with the bird " * 20, "en"),
        (2, "der hund und die katze sind nicht in dem haus mit " * 20, "de"),
        (3, "кошка и собака живут в большом доме у реки " * 20, "ru"),
    ]
    model = language_spans.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    german, russian = "die katze und der hund sind in dem haus", "собака и кошка"
    english = "the dog and the cat are in the house"
    mixed = f"{english}. {german}! {russian}? 日本"
    langs, score, spans = language_spans.labelled(model, [mixed, "12 !", "日本", "", english])
    assert langs[0] in ("de", "en") and langs[1:] == ["und", "de", "und", "en"] or langs[2] in ("de", "en", "ru")
    assert [mixed[s["start"] : s["end"]] for s in spans[0].as_py()][:2] == [english, german]
    assert [s["lang"] for s in spans[0].as_py()][:3] == ["en", "de", "ru"]
    assert 0 < score[0] < 0.6 and score[1:4].tolist() == [0, 0, 0] and score[4] == 1
    words, _ = language_spans.letters([russian])
    narrowed, known = language_spans.word_scores(model, words)
    assert known.all() and (narrowed[:, :2] == -1000).all() and (narrowed[:, 2] == 0).all()


def test_awkward_rows_get_a_language(awkward, nothing):
    found = language_spans.identified(awkward)
    by = {row.doc_id: row for row in found.collect()}
    assert found.count() == awkward.count() and by[1].lang_pred == by[2].lang_pred == by[4].lang_pred == "und"
    assert by[None].held_out and by[7].lang_pred == "en"
    model = language_spans.fit(awkward.filter(language_spans.training_rows(awkward)))
    kept = language_spans.accepted(awkward, model)
    assert kept.schema == awkward.schema and {1, 2, 3, 4}.isdisjoint(row.doc_id for row in kept.collect())
    assert language_spans.identified(nothing).count() == 0
    empty = language_spans.fit(nothing)
    assert {row.lang_pred for row in language_spans.predict(awkward, empty).collect()} == {"und"}


# Lines


@pytest.fixture(scope="module")
def lined(spark):
    """A line on 8 sites, one on 5, one on 6 (near the threshold), and a document copied to 8 sites."""
    rows = []
    for k in range(40):
        lines = [f"own line {k}", "on eight sites " if k % 8 else " on eight sites", f"another line {k}"]
        lines += ["on five sites"] * (k % 8 < 5) + ["on six sites", ""] * (k % 8 < 6) + [f"last {k}"]
        rows.append((k, "\n".join(lines), f"s{k % 8}"))
    rows += [(100 + k, "copied first\ncopied second\ncopied third", f"s{k}") for k in range(8)]
    rows += [(200, "on eight sites\n\n", "s1"), (201, None, "s1"), (202, "", None), (203, " \n", None)]
    return write_table(spark.createDataFrame(rows, "doc_id long, text string, source string"), "lined")


def test_lines_equal_brute_force(lined):
    rows = {row.doc_id: row for row in line_spread.without_boilerplate(lined).collect()}
    given = lined.orderBy("doc_id").collect()
    expected = brute.without_boilerplate([(row.source, row.text) for row in given])
    assert [rows[row.doc_id].text for row in given] == expected
    assert "five" in rows[0].text and "eight" not in rows[0].text and "six" not in rows[0].text
    assert rows[100].text == "" and rows[200].n_removed == 1 and rows[201].text is None


def test_lines_go_by_distinct_sites_alone(spark):
    """A footer of three lines, a page of one line, and a bar that one hot source repeats between the same neighbours."""
    footer = "imprint\nprivacy\nall rights reserved"
    rows = [(k, f"own {k}\nmore {k}\nstill more {k}\nyet more {k}\n{footer}", f"s{k}") for k in range(40)]
    rows += [(100 + k, "page not found", f"s{k}") for k in range(40)]
    rows += [(200 + k, f"a {k}\nhome | news\nb {k}\nc {k}", f"s{k}") for k in range(40)]
    rows += [(300 + k, "x\nhome | news\ny", "hot") for k in range(60)]
    docs = write_table(spark.createDataFrame(rows, "doc_id long, text string, source string"), "sites")
    found = {row.doc_id: row for row in line_spread.without_boilerplate(docs).collect()}
    assert [found[k].text for k in (7, 107, 207, 307)] == ["own 7\nmore 7\nstill more 7\nyet more 7", "", "a 7\nb 7\nc 7", "x\ny"]
    assert [row.text for key, row in sorted(found.items())] == brute.without_boilerplate([row[:0:-1] for row in rows])
    kept = {row.doc_id: row.text for row in line_spread.shortened(docs).collect()}
    assert not any(100 <= key < 200 for key in kept) and len(kept) == 140


def test_copies_of_documents_stay_for_near_dedup(lined):
    given = lined.orderBy("doc_id").collect()
    kept = {row.doc_id: row.text for row in line_spread.shortened(lined).collect()}
    assert [kept.get(row.doc_id) for row in given] == brute.shortened([(row.source, row.text) for row in given])
    assert kept[100].count("copied") == 3


def test_emptied_documents_go(lined):
    kept = line_spread.shortened(lined)
    assert kept.columns == lined.columns
    assert {row.doc_id for row in lined.collect()} - {row.doc_id for row in kept.collect()} == {200}


def test_sketches_away_from_thresholds_need_no_exact_count(spark):
    rows = [(k, f"shared\nown {k}", f"s{k}") for k in range(3000)]
    lines = line_spread.lines_of(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert line_spread.boilerplate(lines, sites=2990).count() == 1  # exact count decides: 3,000
    assert line_spread.boilerplate(lines, sites=3001).count() == 0
    assert line_spread.boilerplate(lines, sites=500).count() == 1


def test_awkward_rows_keep_their_lines(awkward, nothing):
    found = line_spread.without_boilerplate(awkward)
    assert found.exceptAll(found.filter("n_removed = 0")).isEmpty() and found.count() == awkward.count()
    kept = line_spread.shortened(awkward)
    assert kept.dtypes == awkward.dtypes and kept.exceptAll(awkward).isEmpty() and kept.count() == awkward.count()
    assert line_spread.without_boilerplate(nothing).count() == 0 == line_spread.shortened(nothing).count()


# Phrases

ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away home"),
    (2, "short item"),
    (2, "short item"),
    (10, "quick brown fox jumps over the lazy dog and runs"),
    (None, "nameless thing"),
    (4, None),
    (5, " ... "),
    (6, "ÉTÉ étÉ"),
]
PASSAGES = [
    (1, "We saw: THE QUICK, brown fox-jumps over the lazy dog and runs away home. the end"),
    (2, "the quick brown fox jumps over the very lazy dog and runs away"),
    (3, "a short item and a nameless thing, short item"),
    (4, None),
    (5, ""),
    (6, "ÉtÉ ÉTÉ étÉ"),
    (None, "short item"),
    (7, "brown quick"),
    (7, "short item"),
    (7, "short item"),
    (8, "quick brown fox jumps over the lazy dog and runs " * 3),
]


def test_phrases_equal_brute_force(spark):
    docs = spark.createDataFrame(PASSAGES, "doc_id long, text string").withColumns({"part": F.lit(1), "window": F.lit("x")})
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("words", F.lit(3))
    found = phrase_index.contamination(docs, items)
    expected = brute.contamination(PASSAGES, ITEMS)
    order = sorted((key or 0, *row) for (key, _), row in zip(PASSAGES, expected, strict=True))
    rows = sorted((r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in found.collect())
    assert rows == order
    assert all(row.contaminated == (row.n_hit > 0) for row in found.collect())
    clean = phrase_index.clean(docs, items)
    assert clean.columns == docs.columns
    assert sorted(row.doc_id for row in clean.collect()) == [2, 4, 5, 7]
    near = {row.doc_id: row.n_near for row in found.collect()}
    assert near[2] > 0 and near[5] == 0  # a word too many is near, not exact


def test_lookup_tables_beyond_the_bound_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(phrase_index, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(phrase_index.small, "__defaults__", (0,))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame(PASSAGES, "doc_id long, text string")
        items = spark.createDataFrame(ITEMS, "item_id long, text string")
        found = phrase_index.contamination(docs, items)
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
        hits = sorted((r.n_words, r.n_hit) for r in found.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert hits == sorted(row[:2] for row in brute.contamination(PASSAGES, ITEMS))


def test_awkward_rows_and_empty_tables_have_no_hits(spark, awkward, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert phrase_index.contamination(awkward, items).filter("contaminated").isEmpty()
    assert phrase_index.contamination(nothing, items).count() == 0
    assert phrase_index.contamination(awkward, items.limit(0)).filter("n_hit = 0").count() == awkward.count()
    assert phrase_index.clean(awkward, items.limit(0)).count() == awkward.count()


# URLs

URLS = [
    ("https://A.Example.ORG/es/x?y=/en/", "a.example.org", "/es/x", "example.org/es/", "block"),
    ("http://example.org/en/1#top", "example.org", "/en/1", "example.org/en/1", "block"),
    ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("http://x.com/fr/?a", "x.com", "/fr/", "com/fr/", "allow"),
    ("http://x.com/de/", "x.com", "/de/", "com/de/", "block"),
    ("x://com/de/", "com", "/de/", "com/de/", "block"),
    ("http://x.org", "x.org", "", None, None),
    ("http://x.org?q=/", "x.org", "", None, None),
    ("http://xcom/fr/", "xcom", "/fr/", None, None),
    ("no scheme.org/es/", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
    ("a://b://c.org/", "b:", "//c.org/", None, None),
    ("http://ÄÖ.ORG/Ä", "ÄÖ.org", "/Ä", "org/", "allow"),
]


def test_urls_are_parsed_and_ruled(spark):
    pages = spark.createDataFrame([(k, row[0]) for k, row in enumerate(URLS)], "page_id long, url string")
    pages = pages.withColumns({"text": F.lit("x"), "rule": F.lit(2), "score": F.lit("y")})
    found = url_filter.judged(pages.union(pages)).collect()
    assert len(found) == 2 * len(URLS)
    for row in found:
        _, host, path, rule, verdict = URLS[row.page_id]
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == verdict if verdict else row.verdict in ("allow", "block")
    assert url_filter.judged(pages.limit(0)).count() == 0


def test_models_tell_unruled_urls_apart(spark):
    urls = [f"http://good{k}.example.com/fr/story/{k}" for k in range(300)]
    urls += [f"http://spam{k}.example.com/de/pills/{k}" for k in range(300)]
    urls += [f"http://{word}.net/{path}/1" for word, path in (("good7", "story"), ("spam8", "pills"))]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {row.page_id: row.verdict for row in url_filter.judged(pages).collect()}
    assert (found[600], found[601]) == ("allow", "block")


def test_without_rejected_urls_all_are_allowed(spark):
    pages = spark.createDataFrame([(1, "http://a.org/"), (2, "http://b.net/")], "page_id long, url string")
    assert {row.verdict for row in url_filter.judged(pages).collect()} == {"allow"}
