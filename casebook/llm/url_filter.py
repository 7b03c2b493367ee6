"""URL filtering by rules and, where no rule fits, by two character language models.

Rules name a host and the beginning of a path; a rule fits its host and all subdomains, and of the
rules that fit the longest holds. URLs that a rule allows and URLs that a rule blocks train one
model each: a Markov model whose order varies with what was seen. The probability of a character
after its last four is mixed with that after its last three, and so on down to an even chance; each
mixing weight follows from how often the context was seen and by how many characters it was
followed (Witten and Bell's smoothing). A URL's score is the mean log ratio of both models, per
character. The bin of scores from which URLs are allowed is the one that separates the labelled
URLs left out of training best.

Only sums leave the tasks: counts of five-character strings, and of scores in bins of 0.01.

A null URL or one without ``://`` has an empty host and path, and is judged by the models on the
end mark alone. Without labelled URLs of both kinds, in training and left out, all that no rule
fits is allowed. Ties between bins choose the lower, which allows more. Repeated rows are judged
alike; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.workspace import write_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORDER = 4
START, END = "\x01", "\x02"
EVEN = 1 / 256
#: Labelled URLs whose MD5 begins so, three in sixteen, calibrate instead of training.
LEFT_OUT = ("0", "1", "2")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | host.endswith("." + self.host)
        return own & path.startswith(self.path)


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, host and path of every URL."""
    url = F.col("url")
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)
    return pages.select("page_id", F.translate(raw, UPPER, LOWER).alias("host"), path.alias("path"))


def ruled(urls: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Adds the longest rule that fits and its verdict; of equally long ones the first given."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda rule: len(rule.name)):
        fits = rule.fits(F.col("host"), F.col("path"))
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return urls.withColumns({"rule": name, "ruled": verdict})


def grams(texts: DataFrame) -> DataFrame:
    """One row for each character of ``text`` and its end mark: the character after its last four."""
    padded = F.concat(F.lit(START * ORDER), "text", F.lit(END))
    places = F.explode(F.sequence(F.lit(1), F.length("text") + 1))
    return texts.withColumn("place", places).withColumn("gram", padded.substr(F.col("place"), F.lit(ORDER + 1)))


def gram_ratios(train: DataFrame, wanted: DataFrame) -> DataFrame:
    """``ratio``, the log ratio of both models, of each wanted gram.

    train: label, gram and n, its count. wanted: gram.
    """
    orders = F.explode(F.sequence(F.lit(0), F.lit(ORDER))).alias("order")
    part = F.expr(f"substring(gram, {ORDER + 1} - order, order + 1)")
    lower = train.select("label", "gram", "n", orders).select("label", "order", part.alias("part"), "n")
    counts = lower.groupBy("label", "order", "part").agg(F.sum("n").alias("n"))
    context = F.expr("substring(part, 1, order)")
    contexts = counts.groupBy("label", "order", context.alias("context")).agg(
        F.sum("n").alias("total"), F.count("*").alias("kinds")
    )
    labels = F.explode(F.array(F.lit("allow"), F.lit("block"))).alias("label")
    asked = wanted.select("gram", labels).select("gram", "label", orders)
    asked = asked.withColumn("part", part).withColumn("context", context)
    rows = asked.join(counts, ["label", "order", "part"], "left")
    # the shortest contexts, of no or one character, are few and common: a small table, which every task can hold
    contexts = write_table(contexts, "url-contexts")
    on = ["label", "order", "context"]
    few = rows.filter("order <= 1").join(contexts.filter("order <= 1"), on, "left")
    rows = few.unionByName(rows.filter("order > 1").join(contexts.filter("order > 1"), on, "left"))
    seen = {
        f"{column}_{order}": F.max(F.when(F.col("order") == order, F.col(column)))
        for order in range(ORDER + 1)
        for column in ("n", "total", "kinds")
    }
    wide = rows.groupBy("gram", "label").agg(*(value.alias(name) for name, value in seen.items()))
    chance = F.lit(EVEN)
    for order in range(ORDER + 1):
        n, total, kinds = (F.coalesce(f"{column}_{order}", F.lit(0)) for column in ("n", "total", "kinds"))
        chance = F.when(total > 0, (n + kinds * chance) / (total + kinds)).otherwise(chance)
    sign = F.when(F.col("label") == "allow", 1.0).otherwise(-1.0)
    return wide.groupBy("gram").agg(F.sum(sign * F.log(chance)).alias("ratio"))


def bins(score: Column) -> Column:
    return F.floor(F.round(score, 9) * 100)


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, the rule that fits, the verdict and the models' score."""
    urls = ruled(parsed(pages), rules).withColumn("text", F.concat("host", "path"))
    # equal texts have equal hosts and paths, so equal rules
    texts = urls.select("text", "ruled").distinct()
    texts = write_table(texts.withColumn("id", F.monotonically_increasing_id()), "urls")
    left_out = F.substring(F.md5(F.col("text").cast("binary")), 1, 1).isin(*LEFT_OUT)
    labelled = grams(texts.filter(F.col("ruled").isNotNull() & ~left_out))
    train = labelled.groupBy(F.col("ruled").alias("label"), "gram").agg(F.count("*").alias("n"))
    train = write_table(train, "url-grams")
    wanted = grams(texts).select("gram").distinct()
    ratios = write_table(gram_ratios(train, wanted), "url-ratios")
    scores = grams(texts.select("id", "text")).select("id", "gram").join(ratios, "gram").groupBy("id").agg(
        F.avg("ratio").alias("score")
    )
    scored = write_table(texts.join(scores, "id").select("text", "ruled", "score", left_out.alias("left_out")), "url-scores")
    least = threshold(scored)
    by_model = F.when(bins(F.col("score")) >= least, "allow").otherwise("block")
    return (
        urls.join(scored.select("text", "score"), "text")
        .select("page_id", "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "score")
    )


def threshold(scored: DataFrame) -> Column:
    """The lowest bin that is allowed."""
    kinds = scored.filter("not left_out").agg(F.count_distinct("ruled").alias("n")).first()["n"]
    tested = scored.filter("left_out and ruled is not null")
    # bins of 0.01 between the logarithms of the least chances: some thousand rows
    counts = tested.groupBy(bins(F.col("score")).alias("bin")).agg(
        F.count_if(F.col("ruled") == "allow").alias("good"), F.count_if(F.col("ruled") == "block").alias("bad")
    )
    rows = sorted((row["bin"], row["good"], row["bad"]) for row in counts.collect())
    good, bad = sum(row[1] for row in rows), sum(row[2] for row in rows)
    if kinds < 2 or not good or not bad:
        return F.lit(-(1 << 62))
    best, least, lost, stopped = -1, 0, 0, 0
    for place, well, ill in rows:  # allowing from this bin on
        right = (good - lost) * bad + stopped * good
        if right > best:
            best, least = right, place
        lost, stopped = lost + well, stopped + ill
    return F.lit(least)


_ORDERS = range(ORDER + 1)


def _chance(order: int) -> str:
    """The mixed probability, as SQL."""
    n, total, kinds = (f"coalesce({column}_{order}, 0)" for column in ("n", "total", "kinds"))
    below = f"p{order - 1}" if order else "p_even"
    return f"case when {total} > 0 then ({n} + {kinds} * {below}) / ({total} + {kinds}) else {below} end"


def _mixing() -> str:
    levels = f"select *, cast({EVEN!r} as double) as p_even from wide"
    for order in _ORDERS:
        levels = f"select *, {_chance(order)} as p{order} from ({levels})"
    return levels


def oracle() -> str:
    """The same judgement as DuckDB SQL."""
    longest = sorted(RULES, key=lambda rule: -len(rule.name))
    left_out = ", ".join(f"'{digit}'" for digit in LEFT_OUT)
    fits = [
        f"when (host = '{rule.host}' or ends_with(host, '.{rule.host}')) and starts_with(path, '{rule.path}') then "
        for rule in longest
    ]
    name = " ".join(f"{fit} '{rule.name}'" for fit, rule in zip(fits, longest, strict=True))
    verdict = " ".join(f"{fit} '{rule.verdict}'" for fit, rule in zip(fits, longest, strict=True))
    wide = ", ".join(
        f"max(case when a.ord = {order} then {column} end) as {column}_{order}"
        for order in _ORDERS
        for column in ("n", "total", "kinds")
    )
    return f"""
with raw as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
hosts as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as host0 from raw),
urls as (
  select page_id, translate(host0, '{UPPER}', '{LOWER}') as host,
         regexp_extract(substr(rest, length(host0) + 1), '^[^?#]*') as path from hosts),
ruled as (
  select *, case {name} end as rule, case {verdict} end as verdict0, host || path as text from urls),
texts as (select distinct text, verdict0, substr(md5(text), 1, 1) in ({left_out}) as left_out from ruled),
grams as (
  select text, verdict0, left_out,
         substr(repeat(chr(1), {ORDER}) || text || chr(2), cast(i as bigint), {ORDER + 1}) as gram
  from (select *, unnest(range(1, length(text) + 2)) as i from texts)),
train as (
  select verdict0 as label, gram, count(*) as n from grams
  where verdict0 is not null and not left_out group by all),
lower_orders as (
  select label, ord, substr(gram, {ORDER + 1} - ord, ord + 1) as part, sum(n) as n
  from train, (select cast(unnest(range(0, {ORDER + 1})) as bigint) as ord) group by all),
contexts as (
  select label, ord, substr(part, 1, ord) as context, sum(n) as total, count(*) as kinds
  from lower_orders group by all),
asked as (
  select gram, label, ord, substr(gram, {ORDER + 1} - ord, ord + 1) as part,
         substr(gram, {ORDER + 1} - ord, ord) as context
  from (select distinct gram from grams), (values ('allow'), ('block')) l(label),
       (select cast(unnest(range(0, {ORDER + 1})) as bigint) as ord)),
wide as (
  select a.gram, a.label, {wide}
  from asked a left join lower_orders o on a.label = o.label and a.ord = o.ord and a.part = o.part
  left join contexts c on a.label = c.label and a.ord = c.ord and a.context = c.context
  group by a.gram, a.label),
mixed as ({_mixing()}),
ratios as (
  select gram, sum(case when label = 'allow' then 1.0 else -1.0 end * ln(p{ORDER})) as ratio from mixed group by gram),
scores as (
  select text, verdict0, left_out, avg(ratio) as score from grams join ratios using (gram) group by all),
binned as (select *, cast(floor(round(score, 9) * 100) as bigint) as bin from scores),
counts as (
  select bin, count(*) filter (verdict0 = 'allow') as good, count(*) filter (verdict0 = 'block') as bad
  from binned where left_out and verdict0 is not null group by bin),
running as (
  select bin, good, bad, sum(good) over () as all_good, sum(bad) over () as all_bad,
         coalesce(sum(good) over (order by bin rows between unbounded preceding and 1 preceding), 0) as lost,
         coalesce(sum(bad) over (order by bin rows between unbounded preceding and 1 preceding), 0) as stopped
  from counts),
best as (
  select case when (select count(distinct verdict0) from scores where not left_out) = 2
    then (select bin from running where all_good > 0 and all_bad > 0
          order by (all_good - lost) * all_bad + stopped * all_good desc, bin limit 1) end as least)
select r.page_id, r.host, r.path, r.rule,
       coalesce(r.verdict0, case when best.least is null or b.bin >= best.least then 'allow' else 'block' end) as verdict
from ruled r join binned b using (text), best
"""
