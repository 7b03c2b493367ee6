"""ANSI SQL that computes the same result as a registered query, independently of this package."""

from __future__ import annotations

CASES = """
line as (
  select * from (
    select l_orderkey, l_partkey, l_suppkey, l_returnflag, l_shipdate,
           row_number() over (partition by l_orderkey
                              order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,
                                       l_returnflag, l_shipdate) as rn
    from lineitem)
  where rn = 1),
cases as (
  select cast(o_orderkey as varchar) as complaint_id,
         o_orderdate as date_received, l_shipdate as date_sent_to_company,
         s_name as company, p_type as product, p_brand as sub_product, p_name as issue, n_name as state,
         o_orderstatus as company_response, o_orderpriority as submitted_via,
         case when o_orderkey % 7 = 0 then null else c_mktsegment end as consumer_consent_provided,
         case when o_orderkey % 3 = 0 then 'Closed' end as company_public_response,
         case when o_orderstatus = 'F' and l_returnflag in ('R', 'A') then 'Yes' else 'No' end as consumer_disputed
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  left join line on l_orderkey = o_orderkey
  left join part on p_partkey = l_partkey
  left join supplier on s_suppkey = l_suppkey)"""

CASE_COLUMNS = [
    "complaint_id",
    "date_received",
    "date_sent_to_company",
    "company",
    "product",
    "sub_product",
    "issue",
    "state",
    "company_response",
    "submitted_via",
    "consumer_consent_provided",
    "company_public_response",
    "consumer_disputed",
]


def day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def shown(columns: list[str]) -> str:
    return ", ".join(f"{day(c)} as {c}" if c.startswith("date_") else c for c in columns)


def union_all(parts: list[str]) -> str:
    return "\n  union all ".join(parts)


def report(columns: list[str], source: str) -> str:
    rows = [
        f"select '{c}' as column_name, count(*) as total_row, count(*) - count({c}) as missing_row from {source}"
        for c in columns
    ]
    return f"""
report as (
  select column_name, total_row, missing_row, missing_row * 100.0 / total_row as missing_percentage
  from ({union_all(rows)}))"""


REPORT = report(CASE_COLUMNS, "cases")
REPORT_ROWS = """
select column_name, cast(total_row as bigint) as total_row, cast(missing_row as bigint) as missing_row,
       round(missing_percentage, 6) as missing_percentage
from report"""

ALWAYS_DROPPED = "('complaint_id'), ('sub_product'), ('complaint_what_happened')"


def profile(columns: list[str], source: str) -> str:
    rows = [
        f"""select '{c}' as column_name, count(*) as total_row,
       count(distinct {c}) + max(case when {c} is null then 1 else 0 end) as distinct_values,
       count(*) - count({c}) as missing_row from {source}"""
        for c in columns
    ]
    return f"""
select column_name, cast(total_row as bigint) as total_row, cast(distinct_values as bigint) as distinct_values,
       cast(missing_row as bigint) as missing_row, round(missing_row * 100.0 / total_row, 6) as missing_percentage
from ({union_all(rows)})"""


def contract(required: list[str]) -> str:
    rows = []
    for c in required:
        if c in CASE_COLUMNS:
            rows.append(
                f"select '{c}' as column_name, true as present, cast(count(*) - count({c}) as bigint) as missing_row,"
                f" (count(*) - count({c})) * 100.0 <= 20 * count(*) as within_threshold from cases"
            )
        else:
            rows.append(
                f"select '{c}' as column_name, false as present, cast(null as bigint) as missing_row,"
                " false as within_threshold"
            )
    return union_all(rows)


# Elapsed days, and modes of the category columns.

DAYS = """
days as materialized (
  select *, abs(epoch(date_trunc('second', date_received)) - epoch(date_trunc('second', date_sent_to_company)))
            / 86400.0 as diff_in_days
  from cases)"""

CATEGORIES = ["company_response", "consumer_consent_provided", "submitted_via"]


def value_counts(columns: list[str], source: str) -> str:
    rows = [f"select '{c}' as column_name, cast({c} as varchar) as v from {source}" for c in columns]
    return f"select column_name, v, count(*) as n from ({union_all(rows)}) group by column_name, v"


def modes(columns: list[str], source: str) -> str:
    return f"""
counted as ({value_counts(columns, source)}),
modes as (
  select column_name, v, n from (
    select *, row_number() over (partition by column_name order by n desc, v) as rn
    from counted where v is not null)
  where rn = 1)"""


def indexed(columns: list[str], source: str, key: str, fitted_on: str | None = None) -> str:
    """Tall category indices: by falling count, ties by name; NULL gets the index after the last."""
    rows = [f"select {key}, '{c}' as column_name, cast({c} as varchar) as v from {source}" for c in columns]
    return f"""
value_counts as ({value_counts(columns, fitted_on or source)}),
ranks as (
  select column_name, v, row_number() over (partition by column_name order by n desc, v) - 1 as idx
  from value_counts where v is not null),
category_sizes as (select column_name, count(*) as size from ranks group by column_name),
tall as ({union_all(rows)}),
indexed as (
  select {key}, column_name, coalesce(idx, size) as idx, size
  from tall join category_sizes using (column_name) left join ranks using (column_name, v))"""


# Words as the tokenizer splits them, and their hash buckets.

BLANKS = "[ \\t\\n\\x0B\\f\\r]"


def words(source: str, key: str, column: str) -> str:
    return f"""
texts as (select {key}, lower(coalesce({column}, '')) as t from {source}),
stripped as (select {key}, t, regexp_replace(t, '{BLANKS}+$', '') as s from texts),
words as (
  select {key}, case when s = '' and t <> '' then cast([] as varchar[])
                     else string_split_regex(s, '{BLANKS}') end as w
  from stripped)"""


def buckets(count: int = 40) -> str:
    """32-bit Murmur3 of the UTF-8 bytes of every distinct term, seed 42, as a non-negative remainder."""
    digits = "'0123456789ABCDEF'"

    def byte(at: str) -> str:
        high, low = f"substr(hx, 2 * ({at}) + 1, 1)", f"substr(hx, 2 * ({at}) + 2, 1)"
        return f"cast((instr({digits}, {high}) - 1) * 16 + instr({digits}, {low}) - 1 as ubigint)"

    def block(at: str) -> str:
        return f"{byte(at)} + 256 * {byte(at + ' + 1')} + 65536 * {byte(at + ' + 2')} + 16777216 * {byte(at + ' + 3')}"

    wide = "cast(4294967296 as ubigint)"

    def times(value: str, factor: int) -> str:
        return f"((({value}) * cast({factor} as ubigint)) % {wide})"

    def turned(value: str, left: int) -> str:
        up, down = 2**left, 2 ** (32 - left)
        return f"((({value}) * cast({up} as ubigint)) % {wide} + ({value}) // cast({down} as ubigint))"

    def shifted(value: str, right: int) -> str:
        return f"xor({value}, ({value}) // cast({2**right} as ubigint))"

    first, second = 3432918353, 461845907
    return f"""
vocabulary as (
  select term, upper(hex(encode(term))) as hx, octet_length(encode(term)) as n from (select distinct term from terms)),
blocks as (
  select term, n, [{block("4 * i")} for i in range(0, n // 4)] as ks,
         case n % 4 when 0 then cast(0 as ubigint)
                    when 1 then {byte("n - 1")}
                    when 2 then {byte("n - 2")} + 256 * {byte("n - 1")}
                    else {byte("n - 3")} + 256 * {byte("n - 2")} + 65536 * {byte("n - 1")} end as k0
  from vocabulary),
mixed1 as (select term, n, [{times("k", first)} for k in ks] as ks, {times("k0", first)} as k0 from blocks),
mixed2 as (select term, n, [{turned("k", 15)} for k in ks] as ks, {turned("k0", 15)} as k0 from mixed1),
mixed3 as (select term, n, [{times("k", second)} for k in ks] as ks, {times("k0", second)} as k0 from mixed2),
folded as (
  select term, n, k0,
         list_reduce(ks, lambda h, k: ({turned("xor(h, k)", 13)} * 5 + 3864292196) % {wide}, cast(42 as ubigint)) as h
  from mixed3),
final1 as (select term, xor(xor(h, k0), cast(n as ubigint)) as h from folded),
final2 as (select term, {shifted("h", 16)} as h from final1),
final3 as (select term, {times("h", 2246822507)} as h from final2),
final4 as (select term, {shifted("h", 13)} as h from final3),
final5 as (select term, {times("h", 3266489909)} as h from final4),
final6 as (select term, {shifted("h", 16)} as h from final5),
signed as (
  select term, cast(h as bigint) - case when h >= 2147483648 then 4294967296 else 0 end as h from final6),
buckets as materialized (select term, ((h % {count}) + {count}) % {count} as bucket from signed)"""


def hashed(source: str, key: str, column: str) -> str:
    return f"""{words(source, key, column)},
terms as (select {key}, unnest(w) as term from words),
{buckets()},
hashed as materialized (
  select {key}, bucket, cast(count(*) as bigint) as tf from terms join buckets using (term) group by {key}, bucket)"""


SHARE = "cast('0x' || substr(md5(complaint_id), 1, 8) as bigint) % 100"

# The feature vector of every case, fitted on the training split. Slots: categories, days, text.
FEATURES = f"""{CASES},
{DAYS},
training as materialized (select * from days where {SHARE} < 70),
{modes(CATEGORIES, "training")},
filled as materialized (
  select complaint_id, {SHARE} < 70 as fitted, issue,
         coalesce(diff_in_days, (select avg(diff_in_days) from training)) as im_diff_in_days,
         {", ".join(f"coalesce({c}, (select v from modes where column_name = '{c}')) as {c}" for c in CATEGORIES)}
  from days),
fitted as (select * from filled where fitted),
{indexed(CATEGORIES, "filled", "complaint_id", "fitted")},
offsets as (
  select column_name, size, sum(size) over (order by column_name) - size as first_slot from category_sizes),
width as (select sum(size) as width from category_sizes),
{hashed("filled", "complaint_id", "issue")},
text_weights as (
  select bucket, ln(((select count(*) from fitted) + 1.0) / (count(*) + 1.0)) as idf
  from hashed join fitted using (complaint_id) group by bucket),
slots as materialized (
  select complaint_id, first_slot + idx as slot, 1.0::double as value
  from indexed join offsets using (column_name) where idx < indexed.size
  union all select complaint_id, width, im_diff_in_days from filled, width
  union all select complaint_id, width + 1 + bucket,
                   tf * coalesce(idf, ln((select count(*) from fitted) + 1.0))
            from hashed left join text_weights using (bucket), width),
deviations as materialized (
  select slot, sqrt((sum(value * value) - sum(value) * sum(value) / any_value(m)) / (any_value(m) - 1)) as deviation
  from slots join fitted using (complaint_id), (select cast(count(*) as double) as m from fitted)
  group by slot)"""

MATRIX = """
matrix as (
  select consumer_disputed as label, case when company_response = 'F' then 'Yes' else 'No' end as prediction,
         count(*) as n
  from cases group by 1, 2)"""

LABEL_MATRIX = """
matrix as (select quality as label, 1 - toxic as prediction, count(*) as n from labels group by 1, 2)"""


def per_label(matrix: str = "matrix") -> str:
    return f"""
classes as (
  select label, sum(n) as support, sum(case when label = prediction then n else 0 end) as hits,
         coalesce((select sum(n) from {matrix} p where p.prediction = m.label), 0) as predicted,
         (select sum(n) from {matrix}) as total
  from {matrix} m group by label),
rates as (
  select label, support, hits / support as recall, (predicted - hits) / (total - support) as fpr,
         case when predicted = 0 then 0 else hits / predicted end as prec
  from classes),
per_label as (
  select *, case when prec + recall = 0 then 0 else 2 * prec * recall / (prec + recall) end as f from rates)"""


def weighted(matrix: str) -> str:
    means = {
        "f1": "f",
        "weightedPrecision": "prec",
        "weightedRecall": "recall",
        "weightedTruePositiveRate": "recall",
        "weightedFalsePositiveRate": "fpr",
        "weightedFMeasure": "f",
    }
    firsts = {
        "truePositiveRateByLabel": "recall",
        "falsePositiveRateByLabel": "fpr",
        "precisionByLabel": "prec",
        "recallByLabel": "recall",
        "fMeasureByLabel": "f",
    }
    rows = [
        f"select '{name}' as metric, round(sum({c} * support) / sum(support), 6) as value from per_label"
        for name, c in means.items()
    ] + [f"select '{name}' as metric, round({c}, 6) as value from first_label" for name, c in firsts.items()]
    return f"""with {matrix},
{per_label()},
first_label as (select * from per_label order by support desc, label limit 1)
{union_all(rows)}"""


def weighted_f1(prediction: str) -> str:
    return f"""
  select sum(case when hits = 0 then 0 else 2.0 * hits / (support + predicted) end * support) / sum(support)
  from (select consumer_disputed as label, count(*) as support,
               count(*) filter (consumer_disputed = {prediction}) as hits,
               (select count(*) from scored p where p.{prediction} = s.consumer_disputed) as predicted
        from scored s group by consumer_disputed)"""


RULE_SCORES = f"""
scored as (
  select consumer_disputed, case when company_response = 'F' then 'Yes' else 'No' end as candidate, 'No' as champion
  from cases),
scores as (
  select ({weighted_f1("candidate")}) as c, ({weighted_f1("champion")}) as h)"""

SIZES = "sizes as (select consumer_disputed, count(*) as class_count from cases group by consumer_disputed)"
ACCEPTED = [c for c in CASE_COLUMNS if c not in ("sub_product", "company_public_response")]
TRAINING = ["consumer_disputed", *CATEGORIES, "issue", "date_sent_to_company", "date_received"]
SCORED = [*CATEGORIES, "issue", "date_sent_to_company", "date_received"]
USER_EVENTS = "counts as (select user_id, count(*) as n from events group by user_id)"

ORACLES: dict[str, str] = {
    "read_envelope": f"with {CASES}\nselect {shown(CASE_COLUMNS)} from cases",
    "load_increment": f"with {CASES}\nselect {shown(CASE_COLUMNS)}, 'tag ' || complaint_id as tags from cases",
    "rejected_feed": f"""with {CASES},
numbered as (select complaint_id, cast(complaint_id as bigint) % 50 as n from cases)
select 'no date' as reason, 'u' || complaint_id as complaint_id, cast(1 as bigint) as row_count from numbered where n = 0
union all select 'no key', null, cast(count(*) as bigint) from numbered where n = 1 having count(*) > 0
union all select 'broken', null, cast(count(*) as bigint) from numbered where n = 2 having count(*) > 0""",
    "moved_records": f"""with {CASES}
select complaint_id, cast(1 as bigint) as copies, {day("date_received")} as date_received from cases""",
    "drifted_types": f"""with {CASES},
numbered as (select *, cast(complaint_id as bigint) % 3 as part from cases)
select case part when 0 then 'a' when 1 then 'b' else 'c' end as input, complaint_id, {day("date_received")} as date_received,
       case when part <> 0 then state end as state, issue
from numbered""",
    "drift_report": f"""with {CASES},
sizes as (
  select case cast(complaint_id as bigint) % 3 when 0 then 'a' when 1 then 'b' else 'c' end as input, count(*) as n
  from cases group by 1),
kinds(input, column_name, file_type, common_type, action, file_diverted) as (values
  ('a', 'complaint_id', 'int', 'string', 'widened', false), ('b', 'complaint_id', 'bigint', 'string', 'widened', false),
  ('c', 'complaint_id', 'string', 'string', 'kept', false), ('c', 'complaint_id', 'string', 'string', 'kept', true),
  ('a', 'date_received', 'date', 'timestamp', 'widened', false),
  ('b', 'date_received', 'timestamp', 'timestamp', 'kept', false),
  ('c', 'date_received', 'timestamp', 'timestamp', 'kept', false),
  ('c', 'date_received', 'timestamp', 'timestamp', 'kept', true),
  ('a', 'state', null, 'string', 'absent', false), ('b', 'state', 'string', 'string', 'kept', false),
  ('c', 'state', 'string', 'string', 'kept', false), ('c', 'state', 'string', 'string', 'kept', true),
  ('a', 'issue', 'string', 'string', 'kept', false), ('b', 'issue', 'string', 'string', 'kept', false),
  ('c', 'issue', 'string', 'string', 'kept', false), ('c', 'issue', 'array<string>', 'string', 'diverted', true))
select k.*, cast(n as bigint) as row_count from kinds k join sizes using (input)""",
    "overlapping_windows": f"""with {CASES},
starts as (select distinct date_trunc('week', date_received)::timestamp as s from cases),
windows as (select s, s + to_days((7 * (5 + weekofyear(s) % 5))::int) as e from starts)
select {day("s")} as window_start, {day("e")} as window_end, count(date_received) as row_count,
       cast(count(*) filter (consumer_disputed = 'Yes') as bigint) as disputed
from windows left join cases on date_received >= s and date_received < e group by s, e""",
    "open_cases": f"""with {CASES}
select c.complaint_id, {day("c.date_received")} as date_received, count(o.complaint_id) as open_cases
from cases c left join (select * from cases where cast(complaint_id as bigint) % 20 = 0) o
  on c.date_received between o.date_received and o.date_sent_to_company
  and c.date_received < o.date_sent_to_company
group by c.complaint_id, c.date_received""",
    "model_as_of": f"""with {CASES},
placed as (
  select complaint_id, date_received, cast(complaint_id as bigint) as number,
         case when cast(complaint_id as bigint) % 3 = 0 then 'ALL' else state end as region
  from cases),
models as (
  select region, date_received as accepted_at, max('models/' || complaint_id) as model
  from placed where number % 97 = 0 and number % 2 = 1 group by region, date_received)
select c.complaint_id, c.region, {day("c.date_received")} as date_received, {day("m.accepted_at")} as accepted_at, m.model
from placed c asof left join models m on c.region = m.region and c.date_received >= m.accepted_at""",
    "quality_cube": f"""with {CASES},
tall as (
  {union_all([f"select '{c}' as column_name, year(date_received)::varchar as year, company_response, ({c} is null)::int as missing from cases" for c in CASE_COLUMNS])}),
cube as (
  select column_name, year, company_response, grouping(year) as gy, grouping(company_response) as gc,
         count(*) as total_row, cast(sum(missing) as bigint) as missing_row
  from tall group by column_name, cube(year, company_response))
select column_name, year, company_response, total_row, missing_row,
       case when gy = 1 and gc = 1 then 'year,company_response' when gy = 1 then 'year'
            when gc = 1 then 'company_response' else '' end as "over",
       round(missing_row * 100.0 / total_row, 6) as missing_percentage
from cube""",
    "sketched_quantiles": f"""with {CASES},
tall as (
  select 'date_received' as column_name, epoch_us(date_received)::double as own from cases
  union all select 'date_sent_to_company', epoch_us(date_sent_to_company)::double from cases
  union all select 'price', length(issue) * 1.5::double from cases),
held as (select column_name, count(own) as n, min(own) as low, max(own) as high from tall where own is not null group by 1),
shares(share) as (values (0.0::double), (0.01::double), (0.25::double), (0.5::double), (0.75::double), (0.99::double), (1.0::double))
select column_name, n, share, case share when 0 then low when 1 then high end as exact_value, true as rank_holds
from held, shares""",
    "promotion_race": f"""with {CASES},
scored as (
  select consumer_disputed, 'No' as none, case when submitted_via like '1%' then 'Yes' else 'No' end as urgent,
         case when company_response = 'F' then 'Yes' else 'No' end as closed
  from cases),
f as (
  select ({weighted_f1("none")}) as n, ({weighted_f1("urgent")}) as u, ({weighted_f1("closed")}) as c),
won as (
  -- the closed rule is judged against none only while the urgent one waits with a verdict of its own
  select *, c - n >= 0.002 as c_won, u - n >= 0.002 as u_first from f)
select model, met, round(f1, 6) as f1, round(met_f1, 6) as met_f1, tries, accepted, champion, versions, true as served from (
  select 'none' as model, null as met, n as f1, null as met_f1, 1 as tries, true as accepted,
         case when c_won and u_first and u - c >= 0.002 then 'urgent' when c_won then 'closed' when u_first then 'urgent' else 'none' end as champion,
         1 + c_won::int + (u_first and (not c_won or u - c >= 0.002))::int as versions
  from won
  union all
  select 'closed', 'none', c, n, 1, c_won,
         case when c_won and u_first and u - c >= 0.002 then 'urgent' when c_won then 'closed' when u_first then 'urgent' else 'none' end,
         1 + c_won::int + (u_first and (not c_won or u - c >= 0.002))::int
  from won
  union all
  select 'urgent', case when c_won and u_first then 'closed' else 'none' end, u,
         case when c_won and u_first then c else n end, 1 + (c_won and u_first)::int,
         u_first and (not c_won or u - c >= 0.002),
         case when c_won and u_first and u - c >= 0.002 then 'urgent' when c_won then 'closed' when u_first then 'urgent' else 'none' end,
         1 + c_won::int + (u_first and (not c_won or u - c >= 0.002))::int
  from won)""",
    "scored_once": f"""with {CASES}
select complaint_id, cast(1 as bigint) as copies, true as same_as_batch from cases""",
    "encoded_categories": f"""with {CASES},
{indexed(["submitted_via", "consumer_consent_provided", "issue"], "cases", "complaint_id")}
select complaint_id, column_name, cast(idx as integer) as slot, 1.0::double as value from indexed where idx < indexed.size""",
    "searched_forest": f"""with {CASES},
folds as (
  select cast(('0x' || substr(md5('fold ' || complaint_id), 1, 8))::bigint % 2 as integer) as fold, count(*) as n
  from cases where {SHARE} < 70 group by 1)
select depth, fold, n as row_count, true as f1_in_range, true as best_is_chosen
from folds, (values (2), (5)) d(depth)""",
    "land_to_store": f"""with {CASES}
select complaint_id, cast(2 as bigint) as copies, {day("date_received")} as date_received, issue, consumer_disputed
from cases""",
    "incremental_slice": f"""with {CASES},
store as (
  select * from cases where date_received < timestamp '1999-01-01 00:00:00' and company_response = 'F')
select complaint_id, {day("date_received")} as date_received, company_response, submitted_via
from cases
where date_received >= (select max(date_received) from store)
  and date_received < timestamp '2000-01-01 00:00:00'
  and complaint_id not in (select complaint_id from store)""",
    "window_coverage": f"""with {CASES},
windows as (
  select make_timestamp(y, 1, 1, 0, 0, 0) as window_start,
         least(make_timestamp(y + 1, 1, 1, 0, 0, 0), timestamp '2001-08-02 00:00:00') as window_end
  from range(1995, 2002) years(y))
select {day("window_start")} as window_start, {day("window_end")} as window_end,
       cast(count(date_received) as bigint) as row_count
from windows left join cases on date_received >= window_start and date_received < window_end
group by window_start, window_end""",
    "missing_report": f"with {CASES},{REPORT}{REPORT_ROWS}",
    "high_missing_columns": f"with {CASES},{REPORT}{REPORT_ROWS} where missing_percentage > 20",
    "columns_to_drop": f"""with {CASES},{REPORT}
select column_name from report where missing_percentage > 20
union select column_name from (values {ALWAYS_DROPPED}) always(column_name)""",
    "quarantine_columns": f"""with {CASES},{REPORT},
tall as ({
        union_all(
            [
                f"select complaint_id, '{c}' as column_name, cast({c} as varchar) as value from cases"
                for c in CASE_COLUMNS
                if c != "complaint_id"
            ]
        )
    })
select complaint_id, column_name, value, 'Contains many missing values' as error_msg
from tall join report using (column_name)
where missing_percentage > 20 or column_name in (select column_name from (values {ALWAYS_DROPPED}) a(column_name))""",
    "accepted_rows": f"with {CASES}\nselect {shown(ACCEPTED)} from cases",
    "contract_report": f"with {CASES}\n{contract([*TRAINING, 'timely', 'company_public_response'])}",
    "column_profile": profile(["doc_id", "text", "lang", "source", "n_chars"], "documents"),
    "column_profile_cases": f"with {CASES}{profile(CASE_COLUMNS, 'cases')}",
    "scoring_contract": f"""with {CASES}
select 'good' as input, true as valid, '' as missing_columns, cast(count(*) as bigint) as row_count from cases
union all
select 'bad' as input, false as valid, 'issue' as missing_columns, cast(count(*) as bigint) as row_count from cases""",
    "elapsed_days": f"with {CASES},{DAYS}\nselect complaint_id, round(diff_in_days, 6) as diff_in_days from days",
    "impute_mean": f"""with {CASES},{DAYS}
select complaint_id, round(coalesce(diff_in_days, avg(diff_in_days) over ()), 6) as im_diff_in_days from days""",
    "mode_fit": f"""with {CASES},{modes(CATEGORIES, "cases")}
select column_name, v as mode_value, cast(n as bigint) as frequency from modes""",
    "impute_mode": f"""with {CASES},{modes(CATEGORIES, "cases")}
select complaint_id,
       {", ".join(f"coalesce({c}, (select v from modes where column_name = '{c}')) as im_{c}" for c in CATEGORIES)}
from cases""",
    "frequency_table": f"""
select column_name, v as value, cast(n as bigint) as frequency
from ({value_counts(["user_id", "event_type"], "events")})""",
    "frequency_encode": f"""with {USER_EVENTS}
select o_orderkey, o_custkey, cast(n as bigint) as customer_events from orders join counts on user_id = o_custkey""",
    "frequency_encode_keep": f"""with {USER_EVENTS}
select o_orderkey, o_custkey, cast(coalesce(n, 0) as bigint) as customer_events
from orders left join counts on user_id = o_custkey""",
    "frequency_encode_cases": f"""with {CASES}
select complaint_id, consumer_consent_provided, state,
       cast(count(*) over (partition by consumer_consent_provided) as bigint) as consent_count,
       cast(state_total as bigint) as state_count
from cases join (select state, count(*) as state_total from cases group by state) using (state)
where consumer_consent_provided is not null""",
    "string_index": f"""with {CASES},{indexed([*CATEGORIES, "issue"], "cases", "complaint_id")}
select complaint_id, column_name, cast(idx as bigint) as category_index from indexed""",
    "one_hot": f"""with {indexed(["o_orderstatus", "o_orderpriority"], "orders", "o_orderkey")}
select o_orderkey, column_name, cast(idx as integer) as slot, cast(1 as double) as value
from indexed where idx < size - 1""",
    "standard_scale": """
with s as (
  select stddev_samp(l_quantity) as q, stddev_samp(l_extendedprice) as p, stddev_samp(l_discount) as d from lineitem)
select l_orderkey, l_linenumber, round(l_quantity / q, 6) as scaled_l_quantity,
       round(l_extendedprice / p, 6) as scaled_l_extendedprice, round(l_discount / d, 6) as scaled_l_discount
from lineitem, s""",
    "tokenize": f"""with {words("documents", "doc_id", "text")}
select doc_id, cast(len(w) as bigint) as word_count, array_to_string(w, ' ') as words from words""",
    "tokenize_issue": f"""with {CASES},{words("cases", "complaint_id", "issue")}
select complaint_id, cast(len(w) as bigint) as word_count, array_to_string(w, ' ') as words from words""",
    "hashing_tf": f"""with {hashed("documents", "doc_id", "text")}
select doc_id, cast(bucket as integer) as bucket, tf from hashed""",
    "tfidf_hashed": f"""with {hashed("documents", "doc_id", "text")},
weights as (
  select bucket, ln(((select count(*) from documents) + 1.0) / (count(*) + 1.0)) as idf from hashed group by bucket)
select doc_id, cast(bucket as integer) as bucket, round(tf * idf, 6) as tfidf
from hashed join weights using (bucket) where tf * idf <> 0""",
    "tfidf_terms": f"""with {words("documents", "doc_id", "text")},
terms as (select doc_id, unnest(w) as term from words),
counts as (select doc_id, term, count(*) as tf from terms group by doc_id, term),
held as (select term, count(*) as df from counts group by term)
select doc_id, term, cast(tf as bigint) as tf, cast(df as bigint) as df,
       round(tf * ln(((select count(*) from documents) + 1.0) / (df + 1.0)), 6) as tfidf
from counts join held using (term)""",
    "assembled_features": f"""with {FEATURES}
select complaint_id, cast(slot as integer) as slot, round(value, 6) as value from slots where value <> 0""",
    "scaled_features": f"""with {FEATURES}
select complaint_id, cast(slot as integer) as slot, round(value / deviation, 6) as value
from slots join deviations using (slot) where value <> 0 and deviation > 0""",
    "feature_pipeline": f"""with {FEATURES}
select complaint_id, cast(count(*) as bigint) as filled_slots, round(sum(value / deviation), 4) as total
from slots join deviations using (slot) where value <> 0 and deviation > 0 group by complaint_id""",
    "train_test_split": f"""with {CASES}
select complaint_id, case when {SHARE} < 70 then 'train' else 'test' end as split from cases""",
    "class_balance": f"""with {CASES},{SIZES}
select consumer_disputed, cast(class_count as bigint) as class_count,
       round(class_count / (select count(*) from cases), 6) as share
from sizes""",
    "sampling_fractions": f"""with {CASES},{SIZES}
select consumer_disputed, cast(class_count as bigint) as class_count,
       round((select min(class_count) from sizes) / class_count, 6) as fraction
from sizes""",
    "balance_undersample": f"""with {CASES},{SIZES}
select complaint_id, consumer_disputed, company_response from (
  select *, row_number() over (partition by consumer_disputed order by md5(complaint_id), complaint_id) as rn
  from cases)
where rn <= (select min(class_count) from sizes)""",
    "balanced_shuffled": f"""with {CASES},{SIZES}
select complaint_id, consumer_disputed, company_response from (
  select *, row_number() over (partition by consumer_disputed order by md5(complaint_id), complaint_id) as rn
  from cases)
where rn <= (select min(class_count) from sizes)""",
    "train_forest": f"""with {CASES}
select case when {SHARE} < 70 then 'train' else 'test' end as split, cast(count(*) as bigint) as row_count,
       cast(count(distinct consumer_disputed) as bigint) as classes, cast(11 as bigint) as metrics, true as beats_rule
from cases group by 1""",
    "score_batch": f"with {CASES}\nselect complaint_id, {shown(SCORED)}, true as known_label from cases",
    "scored_archive": f"""with {CASES}
select case cast(complaint_id as bigint) % 4 when 0 then '2024/day' when 1 then '2025/day' else 'mixed' end as input,
       complaint_id, {shown(SCORED)}, true as known_label
from cases where cast(complaint_id as bigint) % 4 <> 3""",
    "diverted_input": f"""with {CASES}
select 'mixed' as input, complaint_id, {shown([c for c in SCORED if c != "issue"])}
from cases where cast(complaint_id as bigint) % 4 = 3""",
    "score_stream": f"""with {CASES}
select complaint_id, {shown(SCORED)}, true as same_as_batch, true as also_diverted from cases""",
    "training_run": f"""with {CASES}
select cast(run as integer) as run, true as champion_as_expected, true as verdict_follows_margin,
       true as newest_is_a_run, cast(count(*) as bigint) as accepted_rows, cast(count(*) as bigint) as scored
from cases, range(1, 3) runs(run) group by run""",
    "shuffle_rows": f"""with {CASES}
select complaint_id, consumer_disputed, md5(complaint_id) as shuffle_key from cases""",
    "label_index": f"""with {CASES},{SIZES}
select complaint_id, consumer_disputed, cast(idx as bigint) as indexed_consumer_disputed
from cases join (
  select consumer_disputed, row_number() over (order by class_count desc, consumer_disputed) - 1 as idx from sizes)
using (consumer_disputed)""",
    "confusion_matrix": f"""with {CASES},{MATRIX}
select label, prediction, cast(n as bigint) as row_count from matrix""",
    "confusion_matrix_labels": f"""with {LABEL_MATRIX}
select label, prediction, cast(n as bigint) as row_count from matrix""",
    "per_label_metrics": f"""with {CASES},{MATRIX},{per_label()}
select label, cast(support as bigint) as support, round(recall, 6) as true_positive_rate,
       round(fpr, 6) as false_positive_rate, round(prec, 6) as "precision", round(recall, 6) as recall,
       round(f, 6) as f_measure
from per_label""",
    "weighted_metrics": weighted(f"{CASES},{MATRIX}"),
    "weighted_metrics_labels": weighted(LABEL_MATRIX),
    "evaluation_report": f"""with {CASES},{RULE_SCORES},
verdict as (select c - h as change, c - h >= 0.002 as better from scores)
select 'true' as model_accepted, 0.0::double as changed_accuracy, 'models/none' as trained_model_path,
       cast(null as varchar) as best_model_path, 'true' as active,
       case when better then 'models/closed' else 'models/none' end as newest_model
from verdict
union all
select cast(better as varchar), round(cast(cast(change as float) as double), 5), 'models/closed', 'models/none',
       cast(better as varchar), case when better then 'models/closed' else 'models/none' end
from verdict""",
    "promotion_gate": f"""with {CASES},{RULE_SCORES}
select round(c, 6) as candidate_f1, round(h, 6) as champion_f1, round(c - h, 6) as changed_accuracy,
       c - h >= 0.002 as model_accepted, c - h >= 0.002 as active
from scores""",
}
