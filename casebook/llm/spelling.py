"""Spelling variants: words one edit apart, joined by asymmetric q-chunks.

Of two words the one that is not shorter is cut into two disjoint chunks, halves; the other one
contributes its positional grams, of the lengths that chunks of its own length or one more have. One
edit cannot touch both chunks, so near words share a chunk, at places that differ by one at most: the
first chunk stands where it stood, the second is moved by the difference in length. Words meet by the
hash of (length, place, chunk) and are then verified.

A chunk may be common to many words. Where a key would give more than ``FAN`` candidates for each of
its words, the argument is applied once more to what the chunk leaves open: that part is cut into two
chunks, one of which the edit leaves alone too, and the key is the old chunk with the new one. This
goes on until a key is rare enough or leaves a single place open, which few words can share. So the
candidates are at most ``FAN`` times the keys, whatever the words have in common, and none is lost.

Every pair is found once: of the keys that two near words share, the one counts whose open part holds
the first place where they differ.

Null and empty texts have no words. Repeated rows count each. A null key is written as an empty one.
An empty table gives an empty result. Very long runs of letters are words like others.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.shipping import ship
from casebook.workspace import write_table

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Code points and occurrences that a word must have.
LENGTH = 7
TIMES = 2
#: How many times as frequent as a word its form must be.
RATIO = 10
#: Candidates for each word of a key, at most; keys with more are refined.
FAN = 4
#: Different words that a worker counts before it hands them over, and code points it cuts at a time.
COUNTED = 300_000
PIECE = 1 << 20

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def lowered(text: str) -> str:
    """The text with A to Z in lower case, and nothing else changed."""
    return text.encode().translate(_LOWER).decode()


def run_counts(text: str) -> Counter[str]:
    """How often each run of letters occurs, in lower case; long texts are cut between runs."""
    text = lowered(text)
    found: Counter[str] = Counter()
    low = 0
    while low < len(text):
        high = min(low + PIECE, len(text))
        while high < len(text) and RUN.match(text, high - 1) and RUN.match(text, high):
            high = RUN.match(text, high).end()
        found.update(RUN.findall(text, low, high))
        low = high
    return found


def thirty_first_loses_a_letter(key: str, run: str) -> str:
    """The run without one code point, if 31 divides the checksum of key and run."""
    digest = zlib.crc32(f"{key}:{run}".encode())
    if digest % 31:
        return run
    place = digest % len(run)
    return run[:place] + run[place + 1 :]


def vocabulary(
    docs: DataFrame,
    change: Callable[[str, str], str] | None = None,
    length: int = LENGTH,
    times: int = TIMES,
) -> DataFrame:
    """word and n of all words of ``length`` or more that occur ``times`` or more.

    change: what becomes of a run in the document of a key, before it is counted.
    """
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def batch_of() -> pa.RecordBatch:
            words = pa.array(list(total), pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for run, n in run_counts(text or "").items():
                    word = change(key or "", run) if change else run
                    if len(word) >= length:
                        total[word] += n
                if len(total) > COUNTED:
                    yield batch_of()
                    total.clear()
        yield batch_of()

    counted = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(rows, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= times)


def fixed_hash(shift: Column) -> Column:
    """Hash of a word outside its open part; ``shift``: how much shorter it is than the chunks' word."""
    before = F.substring("word", F.lit(1), F.col("low"))
    after = F.substring("word", F.col("high") + 1 - shift, F.char_length("word"))
    return F.xxhash64("size", "low", "high", before, after)


def halves(words: DataFrame) -> DataFrame:
    """Each row twice: with its first and its second half of the open part left open."""
    middle = F.expr("(low + high) div 2").cast("int")
    parts = F.array(F.struct(F.col("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high")))
    cut = words.withColumn("part", F.explode(parts))
    return cut.select("word", "n", "size", F.col("part.low").alias("low"), F.col("part.high").alias("high"))


def keyed(words: DataFrame) -> DataFrame:
    """The rows with ``key``, by what is not open."""
    return words.withColumn("key", fixed_hash(F.col("size") - F.char_length("word")))


def near_pairs(words: DataFrame, fan: int = FAN) -> DataFrame:
    """The pairs of words exactly one edit apart, once each: long, n_long, short and n_short.

    words: word and n, each word once. Of words of equal length the smaller one is ``long``.
    """
    open_all = [F.lit(0).alias("low"), F.col("size").alias("high")]
    own = F.char_length("word")
    chunks = halves(words.select("word", "n", own.alias("size")).select("*", *open_all))
    sizes = F.explode(F.array(own, own + 1)).alias("size")
    grams = halves(words.select("word", "n", sizes).select("*", *open_all))
    found = None
    while True:
        left = write_table(keyed(chunks), "chunks")
        right = write_table(keyed(grams), "grams")
        meeting = left.select("key", (F.col("high") - F.col("low")).alias("open"), F.lit(1).alias("x"), F.lit(0).alias("y"))
        meeting = meeting.union(right.select("key", F.col("high") - F.col("low"), F.lit(0), F.lit(1)))
        meeting = meeting.groupBy("key").agg(F.sum("x").alias("x"), F.sum("y").alias("y"), F.max("open").alias("open"))
        many = (F.col("x") * F.col("y") > fan * (F.col("x") + F.col("y"))) & (F.col("open") > 1)
        crowded = write_table(meeting.filter(many).select("key"), "crowded")
        pairs = write_table(verified(left.join(crowded, "key", "left_anti"), right), "near")
        found = pairs if found is None else found.union(pairs)
        if crowded.isEmpty():
            return found
        chunks = halves(left.join(crowded, "key", "left_semi"))
        grams = halves(right.join(crowded, "key", "left_semi"))


def verified(chunks: DataFrame, grams: DataFrame) -> DataFrame:
    """The words that share a key and are one edit apart, by the key that counts."""
    x = chunks.select("key", "size", "low", "high", F.col("word").alias("long"), F.col("n").alias("n_long"))
    y = grams.select("key", F.col("size").alias("s"), F.col("low").alias("l"), F.col("high").alias("h"), F.col("word").alias("short"), F.col("n").alias("n_short"))
    same = (F.col("size") == F.col("s")) & (F.col("low") == F.col("l")) & (F.col("high") == F.col("h"))
    once = (F.char_length("short") < F.char_length("long")) | (F.col("long") < F.col("short"))
    width = F.col("high") - F.col("low")
    differ = F.substring("long", F.col("low") + 1, width) != F.substring("short", F.col("low") + 1, width)
    before = F.substring("long", F.lit(1), F.col("low")) == F.substring("short", F.lit(1), F.col("low"))
    near = F.levenshtein("long", "short", 1) == 1
    return x.join(y, "key").filter(same & once & before & differ & near).select("long", "n_long", "short", "n_short")


def variants(words: DataFrame, ratio: int = RATIO, fan: int = FAN) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word.

    form: the most frequent near word (of equally frequent ones the smallest), if it is ``ratio``
    times as frequent or more. root: where forms lead from a word in the end.
    """
    words = write_table(words.select("word", "n"), "vocabulary")
    pairs = near_pairs(words, fan)
    ends = pairs.select(F.col("long").alias("word"), F.col("short").alias("near"), F.col("n_short").alias("near_n"))
    ends = ends.union(pairs.select("short", "long", "n_long"))
    best = ends.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best")
    )
    found = words.join(best, "word", "left")
    formed = -F.col("best.rank") >= ratio * F.col("n")
    found = found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("best.near")).alias("form"),
        F.when(formed, -F.col("best.rank")).alias("form_n"),
    )
    found = write_table(found, "forms")
    roots = found.filter("form is not null").select("word", F.col("form").alias("root"))
    # counts rise by the ratio from form to form, so the longest way is known; each round doubles the steps
    steps = words.agg(F.max("n")).first()[0] or 1
    longest = int(math.log(max(steps, 1), max(ratio, 2)))
    for _ in range(max(0, longest - 1).bit_length()):
        roots = write_table(roots, "roots")
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    found = found.join(roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The checksum table has 256 entries, each made by eight steps. Words are latin letters, so their UTF-8 is
#: taken apart by hex digits; near words are found by leaving out each place in turn.
ORACLE = f"""
with bytes(v, c, k) as (select i, i::bigint, 0 from range(256) t(i)),
steps as (
  with recursive r(v, c, k) as (
    select * from bytes
    union all
    select v, case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, k + 1 from r where k < 8)
  select v, c from r where k = 8),
crc as (select list(c order by v) as entry from steps),
runs as (
  select doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) as run
  from documents),
counted as (select doc_id, run, count(*) as n from runs group by all),
digested as (
  select run, n, xor(list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint)),
    lambda a, b: xor(entry[xor(a, b) % 256 + 1], a // 256)), 4294967295) as h
  from (select *, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as h from counted), crc),
changed as (
  select case when h % 31 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2)
              else run end as word, n
  from digested),
words as (
  select word, sum(n)::bigint as n from changed where length(word) >= {LENGTH} group by word having sum(n) >= {TIMES}),
cuts as (select word, n, unnest(range(length(word))) as k from words),
shorter as (select word, n, k, substr(word, 1, k::int) || substr(word, k::int + 2) as rest from cuts),
pairs as (
  select distinct s.word as a, w.word as b from shorter s join words w on s.rest = w.word
  union
  select x.word, y.word from shorter x join shorter y on x.k = y.k and x.rest = y.rest and x.word <> y.word),
ends as (select a as word, b as near from pairs union select b, a from pairs),
best as (
  select e.word, count(*) as n_near, arg_min(e.near, (-w.n, e.near)) as near, max(w.n) as near_n
  from ends e join words w on e.near = w.word group by e.word),
formed as (
  select w.word, w.n, coalesce(b.n_near, 0) as n_near, case when b.near_n >= {RATIO} * w.n then b.near end as form,
         case when b.near_n >= {RATIO} * w.n then b.near_n end as form_n
  from words w left join best b on w.word = b.word),
ways as (
  with recursive r(word, node, d) as (
    select word, word, 0 from formed
    union all
    select r.word, f.form, d + 1 from r join formed f on r.node = f.word where f.form is not null)
  select word, arg_max(node, d) as root from r group by word)
select f.word, f.form, w.root, f.n, f.n_near, f.form_n from formed f join ways w on f.word = w.word
"""
