"""Exact and near matches of benchmark passages, through a positional inverted index.

A window is ten consecutive words of a benchmark item (all words of a shorter one). Word counts
over the corpus come first: a window with a word that the corpus lacks cannot occur, and of the
other windows the two rarest words are looked up. The index holds the postings (word, document,
place) of those words. Each posting, less its word's offset, names a place where the window could
begin; where both lists agree, all words of the window are compared with the document's.

Texts are lower-cased in A-Z only. Null and empty texts have no words. Items without an id count
for words hit but not as items; repeated items count once. Documents with a null or repeated key
are told apart by their text. An empty table of either kind gives no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.workspace import write_table

WINDOW = 10
RAREST = 2
#: Words between the places that two postings of a near match name, at most.
SLACK = 3
#: Rows of a lookup table that may be broadcast: some 10 MB. A larger one is joined by shuffle.
BROADCAST_ROWS = 100_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    parts = F.split(F.translate(text, UPPER, LOWER), BETWEEN, -1)
    return F.array_remove(F.coalesce(parts, F.array().cast("array<string>")), "")


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table, broadcast if its counted rows are few."""
    return F.broadcast(df) if df.count() <= rows else df


def windows_of(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """window (its number), words and items (ids) of every different window."""
    found = items.select("item_id", words(F.col("text")).alias("own")).filter(F.size("own") > 0)
    places = F.sequence(F.lit(0), F.greatest(F.size("own") - size, F.lit(0)))
    found = found.select("item_id", "own", F.explode(places).alias("place"))
    found = found.select("item_id", F.slice("own", F.col("place") + 1, size).alias("words"))
    found = found.groupBy("words").agg(F.collect_set("item_id").alias("items"))
    return write_table(found.withColumn("window", F.monotonically_increasing_id()), "windows")


def anchors_of(docs: DataFrame, windows: DataFrame, rarest: int = RAREST) -> DataFrame:
    """word, window, offset and n (anchors of the window): the rarest words of windows that can occur."""
    places = windows.select("window", F.posexplode("words").alias("offset", "word"))
    terms = small(write_table(places.select("word").distinct(), "terms"))
    counts = docs.select(F.explode(words(F.col("text"))).alias("word")).join(terms, "word").groupBy("word").count()
    counts = write_table(counts, "term-counts")
    rated = places.join(counts, "word", "left")
    rank = Window.partitionBy("window").orderBy(F.col("count").asc_nulls_first(), "offset")
    rated = rated.withColumns(
        {
            "rank": F.row_number().over(rank),
            "least": F.min(F.coalesce("count", F.lit(0))).over(Window.partitionBy("window")),
            "size": F.count("*").over(Window.partitionBy("window")),
        }
    )
    chosen = rated.filter((F.col("least") > 0) & (F.col("rank") <= rarest))
    chosen = chosen.withColumn("n", F.least("size", F.lit(rarest)).cast("int"))
    return write_table(chosen.select("word", "window", "offset", "n"), "anchors")


def key_of(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("part"), "text")


def postings_of(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """The index: word, document (doc_id and part) and place of every anchor word in the corpus."""
    terms = small(write_table(anchors.select("word").distinct(), "anchor-words"))
    placed = key_of(docs).select("doc_id", "part", F.posexplode(words(F.col("text"))).alias("place", "word"))
    return write_table(placed.join(terms, "word"), "postings")


def starts_of(postings: DataFrame, anchors: DataFrame) -> DataFrame:
    """Where each anchor of a window says the window would begin."""
    return postings.join(anchors, "word").select(
        "doc_id", "part", "window", "n", "offset", (F.col("place") - F.col("offset")).alias("start")
    )


def matches_of(postings: DataFrame, anchors: DataFrame, slack: int = SLACK) -> DataFrame:
    """Windows whose lists meet in a document: doc_id, part, window, starts and near.

    starts: the places where all of the window's lists agree. near: whether two lists come within
    ``slack`` words of agreeing.
    """
    lists = starts_of(postings, anchors).groupBy("doc_id", "part", "window", "n").agg(
        F.array_sort(F.collect_set(F.struct("start", "offset"))).alias("found")
    )
    # in order of start, a place that n lists name is n entries long
    pairs = "slice(found, 1, greatest(size(found) - {0}, 0)), slice(found, 1 + {0}, greatest(size(found) - {0}, 0))"
    agreed = F.expr(
        f"zip_with({pairs.format('(n - 1)')}, (a, b) -> if(a.start = b.start and a.start >= 0, a.start, null))"
    )
    # and two neighbours of different offsets are the closest such pair
    close = F.expr(
        f"zip_with({pairs.format('1')}, (a, b) -> b.start - a.start <= {slack} and a.offset <> b.offset)"
    )
    found = lists.select(
        "doc_id",
        "part",
        "window",
        F.filter(agreed, lambda start: start.isNotNull()).alias("starts"),
        F.exists(close, lambda yes: yes).alias("near"),
    )
    return write_table(found.filter((F.size("starts") > 0) | F.col("near")), "matches")


def phrase_candidates(matches: DataFrame) -> DataFrame:
    """Places where all of a window's lists agree."""
    return matches.select("doc_id", "part", "window", F.explode("starts").alias("start"))


def near_windows(matches: DataFrame) -> DataFrame:
    """Windows that a document has, exactly or some words out of place."""
    return matches.filter("near").select("doc_id", "part", "window")


def phrases(docs: DataFrame, windows: DataFrame, candidates: DataFrame) -> DataFrame:
    """doc_id, part, start, stop and items of every occurrence, compared word by word."""
    wanted = candidates.join(windows, "window").groupBy("doc_id", "part").agg(
        F.collect_list(F.struct("start", "words", "items")).alias("asked")
    )
    wanted = wanted.select(F.col("doc_id").alias("own_id"), F.col("part").alias("own_part"), "asked")
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("part") == F.col("own_part"))
    texts = key_of(docs).distinct().join(wanted, same)
    texts = texts.select("doc_id", "part", words(F.col("text")).alias("own"), "asked")
    right = F.filter(
        "asked", lambda ask: F.slice("own", ask["start"] + 1, F.size(ask["words"])) == ask["words"]
    )
    return texts.select("doc_id", "part", F.explode(right).alias("ask")).select(
        "doc_id",
        "part",
        F.col("ask.start").alias("start"),
        (F.col("ask.start") + F.size("ask.words")).alias("stop"),
        F.col("ask.items").alias("items"),
    )


def covered(spans: Column) -> Column:
    """Places that sorted spans of start and stop cover together."""
    first = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
    return F.aggregate(
        spans,
        first,
        lambda state, span: F.struct(
            F.greatest(state["end"], span["stop"]).alias("end"),
            (state["total"] + F.greatest(F.lit(0), span["stop"] - F.greatest(state["end"], span["start"]))).alias("total"),
        ),
        lambda state: state["total"],
    )


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Words, words hit, items met and near windows of every document."""
    windows = windows_of(items)
    anchors = anchors_of(docs, windows)
    matches = matches_of(postings_of(docs, anchors), anchors)
    found = phrases(docs, windows, phrase_candidates(matches))
    hits = found.groupBy("doc_id", "part").agg(
        covered(F.array_sort(F.collect_set(F.struct("start", "stop")))).alias("n_hit"),
        F.array_sort(
            F.transform(F.array_distinct(F.flatten(F.collect_set("items"))), lambda item: item.cast("string"))
        ).alias("ids"),
    )
    near = near_windows(matches).groupBy("doc_id", "part").agg(F.count("*").alias("n_near"))
    keys = ["own_id", "own_part"]
    matched = hits.join(near.toDF("near_id", "near_part", "n_near"), F.col("doc_id").eqNullSafe(F.col("near_id")) & (F.col("part") == F.col("near_part")), "full")
    matched = matched.select(
        F.coalesce("doc_id", "near_id").alias(keys[0]),
        F.coalesce("part", "near_part").alias(keys[1]),
        "n_hit",
        "ids",
        "n_near",
    )
    matched = write_table(matched, "hits")
    counted = docs.select(
        "doc_id", F.xxhash64("text").alias("part"), F.coalesce(F.size(words(F.col("text"))), F.lit(0)).cast("long").alias("n_words")
    )
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("part") == F.col("own_part"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return counted.join(matched, same, "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns kept, in which no window of an item occurs."""
    windows = windows_of(items)
    anchors = anchors_of(docs, windows)
    found = phrases(docs, windows, phrase_candidates(matches_of(postings_of(docs, anchors), anchors)))
    found = write_table(found.select("doc_id", "part").distinct().toDF("own_id", "own_part"), "hits")
    same = docs["doc_id"].eqNullSafe(F.col("own_id")) & F.xxhash64(docs["text"]).eqNullSafe(F.col("own_part"))
    return docs.join(found, same, "left_anti")


_WORDS = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE = f"""
with items as (select item_id, {_WORDS} as w from benchmark where text is not null),
windows as (
  select item_id, list_slice(w, p + 1, p + {WINDOW}) as ws
  from (select item_id, w, unnest(range(0, greatest(len(w) - {WINDOW}, 0) + 1)) as p from items where len(w) > 0)),
docs as (select doc_id, case when text is null then [] else {_WORDS} end as w from documents),
sizes as (select distinct len(ws) as size from windows),
places as (
  select doc_id, p, size, list_slice(w, p + 1, p + size) as ws
  from (select doc_id, w, size, unnest(range(0, len(w) - size + 1)) as p from docs, sizes where len(w) >= size)),
hits as (
  select distinct doc_id, p, size, item_id from places join windows using (ws)),
placed as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) - 1 as place from docs),
counts as (select word, count(*) as n from placed group by word),
offsets as (
  select ws, unnest(ws) as word, generate_subscripts(ws, 1) - 1 as off from (select distinct ws from windows)),
rated as (
  select ws, off, o.word, coalesce(n, 0) as n, min(coalesce(n, 0)) over (partition by ws) as least,
         row_number() over (partition by ws order by coalesce(n, 0), off) as rank
  from offsets o left join counts c on o.word = c.word),
starts as (
  select doc_id, ws, off, place - off as start
  from rated r join placed p on r.word = p.word where r.least > 0 and r.rank <= 2),
near as (
  select doc_id, count(distinct ws) as n_near from (
    select a.doc_id, a.ws from starts a join starts b
    on a.doc_id = b.doc_id and a.ws = b.ws and a.off < b.off and abs(a.start - b.start) <= 3)
  group by doc_id),
spots as (select doc_id, count(distinct q) as n_hit from (select doc_id, unnest(range(p, p + size)) as q from hits) group by doc_id),
met as (
  select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, cast(item_id as varchar) as id from hits where item_id is not null) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated, coalesce(n_near, 0) as n_near
from docs d left join spots using (doc_id) left join met using (doc_id) left join near using (doc_id)
"""
