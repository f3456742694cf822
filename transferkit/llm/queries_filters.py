"""Registered queries of the native filters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from transferkit.llm.decontaminate import contamination
from transferkit.llm.mixing import mixture
from transferkit.llm.quality import STOP_WORDS, quality


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir))


_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
SQL9 = f"""
with d as (
  select doc_id, coalesce(text, '') as t,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
  from documents),
g as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as gram
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d)),
twice as (select doc_id, i from g qualify count(*) over (partition by doc_id, gram) > 1),
r as (
  select doc_id, count(distinct i + k) as n from twice, (select unnest([0, 1, 2]) as k) group by doc_id),
m as (
  select d.doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(r.n, 0)::bigint as n_repeat_words,
    len(lines)::bigint as n_lines,
    len(list_filter(w, lambda x: lower(x) in ({_STOP})))::bigint as n_stop_words
  from d left join r using (doc_id))
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words)
  and word_chars between 2.0 * n_words and 15.0 * n_words and n_symbols::double <= 0.1::double * n_words
  and n_stop_words::double >= 0.02::double * n_words and n_dup_lines <= 0.5 * n_lines as kept
from m
"""


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
SQL8 = f"""
with d as (select doc_id, {_WORDS} as w from documents),
b as (select item_id, w, least(len(w), 10) as k from (select item_id, {_WORDS} as w from benchmark) where len(w) > 0),
bw as (
  select distinct item_id, k, array_to_string(w[i:i + k - 1], ' ') as g
  from (select item_id, w, k, unnest(range(1, len(w) - k + 2)) as i from b)),
dw as (
  select doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') as g
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from d, (select distinct k from b))),
hits as (select dw.doc_id, dw.i, dw.k, bw.item_id from dw join bw using (k, g)),
covered as (
  select doc_id, count(distinct i + p) as n from
  (select doc_id, i, unnest(range(k)) as p from (select distinct doc_id, i, k from hits)) group by doc_id),
items as (
  select doc_id, count(*) as n, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, item_id::varchar as item from hits) group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(c.n, 0)::bigint as n_hit, coalesce(x.n, 0)::bigint as n_items,
  sha256(coalesce(x.ids, '')) as items_sha256, coalesce(c.n, 0) > 0 as contaminated
from d left join covered c using (doc_id) left join items x using (doc_id)
"""


def op7_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(documents(spark, sf_dir)).drop("shards")


def _md5(*parts: str) -> str:
    return f"('0x' || substr(md5({" || '|' || ".join(parts)}), 1, 15))::bigint"


SQL7 = f"""
with d as (
  select doc_id, source, coalesce(doc_id::varchar, '') as id,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size from documents),
s1 as (select source, sum(size)::bigint as source_size from d group by source),
s2 as (
  select *, row_number() over (order by source nulls last) - 1 as no, 3.0::double * source_size as cap,
    sum(source_size) over ()::bigint as total from s1),
s3 as (select *, [5.0::double, 2.0, 1.0][no % 3 + 1] as weight from s2),
s4 as (
  select *, (total - coalesce(sum(cap) over (f rows between unbounded preceding and 1 preceding), 0))
      / sum(weight) over (f rows between current row and unbounded following) as level
  from s3 window f as (order by cap / weight, no)),
s5 as (
  select *, first_value(case when cap >= weight * level then level end ignore nulls)
      over (order by cap / weight, no rows between unbounded preceding and current row) as set_level from s4),
s6 as (
  select *, case when set_level is null then cap else least(cap, weight * set_level) end as target,
    greatest(1, ceil(source_size / greatest(50000, ceil(total / 8192))))::bigint as n_blocks from s5),
s7 as (select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as passes from s6),
s as (select *, target - passes * source_size as part from s7),
r as (
  select d.*, s.* exclude (source), {_md5("'7'", "id")} % n_blocks as block, {_md5("'7'", "'doc'", "id")} as h
  from d join s on d.source is not distinct from s.source),
b1 as (select no, block, part, sum(size)::bigint as words from r group by all),
b2 as (
  select *, part - (sum(words) over (partition by no order by {_md5("'7'", "'block'", "no", "block")}, block
      rows unbounded preceding) - words) as room from b1),
x as (
  select r.*, b2.room, b2.words,
    sum(r.size) over (partition by r.no, r.block order by r.h, r.size) - r.size / 2 as upto
  from r join b2 on r.no = b2.no and r.block = b2.block)
select doc_id, size, source_size, target,
  size * (passes + case when room > 0 and (room >= words or upto <= room) then 1 else 0 end)::bigint as taken
from x
"""

QUERIES = {
    "op7_mixing_sources": op7_mixing_sources,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_quality_rules": op9_quality_rules,
}
SQL = {
    "op7_mixing_sources": SQL7,
    "op8_benchmark_decontamination": SQL8,
    "op9_quality_rules": SQL9,
}
