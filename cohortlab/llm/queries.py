"""Registered queries of the corpus operators and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlab.llm import (alignment, conversations, decontaminate, exact, lines, links, mixing, ngram_join, packing,
                           quality, secrets, suffix, surrogates)
from cohortlab.llm.common import read, ship


def op1_mix(spark, sf_dir):
    """Words each document gives to a mix of the sources, weights 5, 2, 1 in turn."""
    return mixing.mix(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


def op2_secrets(spark, sf_dir):
    """Spans of secrets in every document."""
    return secrets.scan(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op3_near_lines(spark, sf_dir):
    """Per document its lines and those dropped as near copies of another line."""
    ship(spark)
    return lines.line_report(read(spark, sf_dir, "documents"))


def op4_ngram_join(spark, sf_dir):
    """Components of documents by Jaccard of 4-word shingles."""
    ship(spark)
    return ngram_join.join_components(read(spark, sf_dir, "documents"))


def op5_quality(spark, sf_dir):
    """Quality measures and verdict of every document."""
    ship(spark)
    return quality.quality(read(spark, sf_dir, "documents"))


def op6_exact(spark, sf_dir):
    """Exact groups of documents, white space apart."""
    return exact.equal_groups(read(spark, sf_dir, "documents"))


def op7_repeats(spark, sf_dir):
    """Bytes of every document in 200-byte strings that occur again."""
    ship(spark)
    return suffix.drop_repeats(read(spark, sf_dir, "documents"))


def op8_urls(spark, sf_dir):
    """Host, path, rule and verdict of every page."""
    return links.judge_urls(read(spark, sf_dir, "pages"))


def op9_pack(spark, sf_dir):
    """Token pieces of every document, packed into sequences of 4096."""
    ship(spark)
    return packing.pack(read(spark, sf_dir, "documents"))


def op10_surrogates(spark, sf_dir):
    """Every document with its personal data replaced."""
    return surrogates.replace_entities(read(spark, sf_dir, "documents"))


def op11_align(spark, sf_dir):
    """Token groups and links of every document under two tokenizers."""
    ship(spark)
    return alignment.align_documents(read(spark, sf_dir, "documents"))


def op12_decontaminate(spark, sf_dir):
    """Benchmark words and items of every document."""
    ship(spark)
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_repair(spark, sf_dir):
    """Faults, cheapest edits and repaired text of every conversation, after a fixed damage."""
    ship(spark)
    rows = read(spark, sf_dir, "conversations")
    return conversations.digests(conversations.damage(rows), ids=rows)


QUERIES = {f.__name__: f for f in (op1_mix, op2_secrets, op3_near_lines, op4_ngram_join, op5_quality, op6_exact,
                                   op7_repeats, op8_urls, op9_pack, op10_surrogates, op11_align, op12_decontaminate,
                                   op13_repair)}


def _spans_sql(rule: secrets.Rule, order: int) -> str:
    regex = rule.simple.replace("'", "''")
    return f"""
    select doc_id, start, {order} as ord, stop, '{rule.kind}' as kind from (
      select doc_id, sized[i] as sized, list_sum(list_transform(gaps[1:i], lambda x: length(x)))
               + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0) as start,
             start + length(hits[i]) as stop
      from (select doc_id, hits, sized, gaps, unnest(range(1, len(hits) + 1)) as i from (
              select doc_id, regexp_extract_all(t, '{regex}', 0) as hits,
                     regexp_extract_all(t, '{regex}', {rule.group}) as sized,
                     string_split_regex(t, '{regex}') as gaps
              from texts where regexp_matches(t, '{regex}'))))
    where length(sized) >= {rule.least}"""


_ALL = [*secrets.BASE, *secrets.EXTRA]
WORDS_12 = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ORACLE = {
    "op12_decontaminate": f"""
with d as (select row_number() over () as rid, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), '{links.UPPER}', '{links.LOWER}'), '{WORDS_12}') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), '{links.UPPER}', '{links.LOWER}'), '{WORDS_12}') as w from benchmark),
bw as (select distinct item_id, m, array_to_string(w[i:i + m - 1], ' ') as t from (
         select item_id, w, least(len(w), 10) as m, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i from b where len(w) > 0)),
dw as (select rid, i, m, array_to_string(w[i:i + m - 1], ' ') as t from (
         select rid, w, m, unnest(range(1, len(w) - m + 2)) as i from d, (select distinct m from bw) where len(w) >= m)),
hit as (select rid, i, dw.m, item_id from dw join bw on dw.m = bw.m and dw.t = bw.t),
words as (select rid, count(distinct p) as n_hit from (select distinct rid, unnest(range(i, i + m)) as p from hit) group by rid),
items as (select rid, count(*) as n_items, string_agg(item, ',' order by item) as items
          from (select distinct rid, cast(item_id as varchar) as item from hit where item_id is not null) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (rid) left join items using (rid)""",
    "op2_secrets": f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
found as ({' union all '.join(_spans_sql(r, i) for i, r in enumerate(_ALL))}),
per as (
  select doc_id,
         count(*) filter (ord = 0) as n_assign, count(*) filter (ord = 1) as n_access,
         count(*) filter (ord = 2) as n_hex,
         string_agg(kind || ':' || cast(start as bigint) || ':' || cast(stop as bigint), ',' order by start, ord) filter (ord < 3) as base,
         string_agg(kind || ':' || cast(start as bigint) || ':' || cast(stop as bigint), ',' order by start, ord) as spans
  from found group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents d left join per using (doc_id)""",
    "op6_exact": r"""
with t as (select doc_id, length(coalesce(text, '')) as chars,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') as norm from documents),
g as (select *, first_value(doc_id) over w as keep_id, count(*) over (partition by norm) as group_size,
             row_number() over w as place
      from t window w as (partition by norm order by chars desc, doc_id asc nulls last))
select doc_id, keep_id, group_size, place = 1 as kept, sha256(norm) as text_sha256 from g""",
}
