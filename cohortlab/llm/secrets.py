"""Secret scans over a trigram inverted index (SQL functions only).

Each rule's regex gives a Boolean query of trigrams that any match must hold.
Postings of those trigrams are intersected per rule, and only the candidate
documents are matched against it; a rule that forces no trigram reads every
text.
"""

from __future__ import annotations

import itertools
import re._constants as rc
import re._parser as rp
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import join_rows, keyed

MAX_STRINGS = 64      # alternatives that the derivation keeps apart
CHUNK = 128           # matches of a text whose places are added up at a time


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` characters or more (0: the whole
    match); what group ``lead`` holds, at the match's beginning, is not part of
    the span.  No regex repeats a group or starts again within a run of
    characters that it has tried: time grows with the text, whatever it holds.
    ``plain`` says the same without possessive and atomic parts."""
    kind: str
    regex: str
    group: int = 0
    least: int = 0
    lead: int = 0
    plain: str = ""

    @property
    def simple(self) -> str:
        return self.plain or self.regex


# The base kinds in their order.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # a run of 24 or more is what [0-9a-f]+ matches when shorter matches are dropped
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
EXTRA = (
    # one class that loops without recursion, in place of repeated groups
    Rule("private_key", r"-----BEGIN (?:[A-Z ]* )?PRIVATE KEY-----"),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9_.~+/-]{16,}=*"),
    # only the first eyJ of a run can begin a match: later ones see the same dots
    Rule("jwt", r"(?<![A-Za-z0-9_-])(?>([A-Za-z0-9_-]*?)eyJ)[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]++", lead=1,
         plain=r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("git_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("url_login", r"(?<![a-z])[a-z]++://[^\x20\x09-\x0D/:@]++:[^\x20\x09-\x0D/:@]++@",
         plain=r"[a-z]+://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/:@]+@"),
)


# --- trigram queries: a set of alternatives, each a set of trigrams that must all occur.
# The empty alternative asks nothing, so a query holding it cannot prune.

ANY = frozenset([frozenset()])


def _simplify(query: frozenset) -> frozenset:
    return frozenset(a for a in query if not any(b < a for b in query))


def _all(a: frozenset, b: frozenset) -> frozenset:
    if len(a) * len(b) > MAX_STRINGS:
        return min(a, b, key=len) if ANY not in (a, b) else (a if b == ANY else b)
    return _simplify(frozenset(x | y for x, y in itertools.product(a, b)))


def _grams(strings: set[str]) -> frozenset:
    return _simplify(frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings))


def _derive(items) -> tuple[set[str] | None, frozenset]:
    """For a parsed sequence: the strings it can match (None: too many) and,
    where that is None, the trigrams any match must hold."""
    strings, query, exact = {""}, ANY, True
    for op, arg in items:
        one, inner = _node(op, arg)
        if one is not None and len(strings) * len(one) <= MAX_STRINGS:
            strings = {a + b for a in strings for b in one}
            continue
        query, exact = _all(query, _grams(strings)), False
        strings = {""}
        if one is not None:
            strings = set(one)
        else:
            query = _all(query, inner)
    if exact:
        return strings, _grams(strings)
    return None, _all(query, _grams(strings))


def _node(op, arg) -> tuple[set[str] | None, frozenset]:
    if op is rc.LITERAL:
        return {chr(arg).lower()}, ANY
    if op is rc.IN:
        if all(o is rc.LITERAL for o, _ in arg) and len(arg) <= 8:
            return {chr(c).lower() for _, c in arg}, ANY
        return None, ANY
    if op is rc.SUBPATTERN:
        return _derive(arg[3])
    if op is rc.BRANCH:
        parts = [_derive(p) for p in arg[1]]
        if all(s is not None for s, _ in parts) and sum(len(s) for s, _ in parts) <= MAX_STRINGS:
            return set().union(*[s for s, _ in parts]), ANY
        return None, _simplify(frozenset().union(*[q for _, q in parts]))
    if op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
        low, high, inner = arg
        one, query = _derive(inner)
        if (low, high) == (0, 1) and one is not None:
            return one | {""}, ANY
        if low == high == 1:
            return one, query
        return None, (query if one is None else _grams(one)) if low else ANY
    if op is rc.AT:
        return {""}, ANY
    return None, ANY


def trigram_query(regex: str) -> frozenset:
    """Alternatives (any may hold) of lower-case trigrams (all must occur) that
    every match of ``regex`` satisfies.  Contains the empty set when the regex
    forces no trigram."""
    return _derive(rp.parse(regex))[1]


def postings(docs: DataFrame, trigrams: list[str], text_col: str = "text") -> DataFrame:
    """The inverted index over the queries' trigrams: ``doc_id, k, gram`` (the
    trigram's place in ``trigrams``), one row per trigram and document."""
    low = F.lower(F.col(text_col))
    held = F.filter(F.array(*[F.struct(F.lit(i).alias("gram"), F.lit(t).alias("t")) for i, t in enumerate(trigrams)]),
                    lambda x: F.contains(F.col("low"), x["t"]))
    return (docs.select("doc_id", "k", low.alias("low"))
            .select("doc_id", "k", F.explode(held["gram"]).alias("gram")))


def candidates(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``doc_id, k, rule_<i>`` for documents that satisfy some rule's query."""
    queries = {i: trigram_query(r.simple) for i, r in enumerate(rules)}
    grams = sorted({t for q in queries.values() for alt in q for t in alt})
    place = {t: i for i, t in enumerate(grams)}
    # The intersection: each document's postings meet in bit sets, a task's part first.
    words = range(len(grams) // 62 + 1)
    sets = postings(docs, grams).groupBy("doc_id", "k").agg(*[
        F.expr(f"bit_or(if(gram div 62 = {w}, shiftleft(1L, cast(gram % 62 as int)), 0L))").alias(f"b{w}") for w in words])

    def satisfied(query) -> Column:
        out = F.lit(False)
        for alt in sorted(query, key=sorted):
            mask = [0] * len(words)
            for t in alt:
                mask[place[t] // 62] |= 1 << (place[t] % 62)
            term = F.lit(True)
            for w in words:
                if mask[w]:
                    term = term & (F.col(f"b{w}").bitwiseAND(F.lit(mask[w])) == F.lit(mask[w]))
            out = out | term
        return out

    flags = [satisfied(q).alias(f"rule_{i}") for i, q in queries.items()]
    found = sets.select("doc_id", "k", *flags)
    any_ = F.lit(False)
    for i in queries:
        any_ = any_ | F.col(f"rule_{i}")
    return found.where(any_)


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """Array of ``(start, ord, end, kind)`` in code points, end exclusive.

    The text between matches (``split``) and the matches alternate, so their
    lengths add up to the positions.
    """
    regex = F.lit(rule.regex)
    matches = F.regexp_extract_all(text, regex, F.lit(0))
    sized = F.regexp_extract_all(text, regex, F.lit(rule.group))
    gaps = F.split(text, rule.regex, -1)
    # at: end of the previous match; out: spans so far
    empty = F.expr("cast(array() as array<struct<start:bigint,ord:int,end:bigint,kind:string>>)")
    if rule.lead:
        before = F.transform(F.regexp_extract_all(text, regex, F.lit(rule.lead)), F.length)
    else:
        before = F.transform(matches, lambda m: F.lit(0))
    steps = F.arrays_zip(matches.alias("m"), sized.alias("s"), F.slice(gaps, 1, F.size(matches)).alias("g"), before.alias("b"))

    def step(state, x):
        begin = state["at"] + F.length(x["g"])
        start, end = begin + x["b"], begin + F.length(x["m"])
        span = F.struct(start.cast("long").alias("start"), F.lit(order).alias("ord"),
                        end.cast("long").alias("end"), F.lit(rule.kind).alias("kind"))
        return F.struct(end.cast("long").alias("at"),
                        F.when(F.length(x["s"]) >= rule.least, F.array_append(state["out"], span))
                        .otherwise(state["out"]).alias("out"))

    # in chunks: appending to one long list would copy it for every match
    begin = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out"))

    def placed(all_):
        chunks = F.transform(F.sequence(F.lit(0), F.size(all_) - 1, F.lit(CHUNK)), lambda i: F.slice(all_, i + 1, CHUNK))
        return F.aggregate(chunks, F.array(begin), lambda state, x: F.array_append(state, F.aggregate(
            x, F.struct(F.element_at(state, -1)["at"].alias("at"), empty.alias("out")), step)))

    done = F.transform(F.array(steps), placed)[0]             # a name for the matches, found once
    # The capture that makes the decision is worth a look only where there is a match at all.
    return F.when(F.regexp_like(text, regex), F.flatten(F.transform(done, lambda s: s["out"]))).otherwise(empty)


def scan(docs: DataFrame, base: tuple = BASE, extra: tuple = EXTRA, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_<base kind>..., base_spans, all_spans,
    base_sha256, spans``.

    Spans are written ``kind:start:end`` by start, then kind in the order of
    the rules.  Null text is empty and has none; null or repeated ids and
    repeated rows are scanned each; an empty table gives no rows.
    """
    rules = [*base, *extra]
    pruned = [i for i, r in enumerate(rules) if frozenset() not in trigram_query(r.simple)]
    rows = keyed(docs, id_col, text_col)
    if pruned:
        hits = candidates(rows, [rules[i] for i in pruned])
        hits = hits.select("doc_id", "k", *[F.col(f"rule_{j}").alias(f"_r{i}") for j, i in enumerate(pruned)])
        rows = (join_rows(rows, hits, "left")
                .select("doc_id", "text", *[F.coalesce(F.col(f"_r{i}"), F.lit(False)).alias(f"_r{i}") for i in pruned]))
    none = F.expr("cast(array() as array<struct<start:bigint,ord:int,end:bigint,kind:string>>)")
    found = rows.select("doc_id", *[
        (F.when(F.col(f"_r{i}"), spans_of(F.col("text"), r, i)).otherwise(none) if i in pruned
         else spans_of(F.col("text"), r, i)).alias(f"s{i}") for i, r in enumerate(rules)])
    n = len(base)
    found = found.select(
        "doc_id", *[F.size(f"s{i}").cast("long").alias(f"n_{r.kind}") for i, r in enumerate(base)],
        F.array_sort(F.concat(*[f"s{i}" for i in range(n)])).alias("base_spans"),
        F.array_sort(F.concat(*[f"s{i}" for i in range(len(rules))])).alias("all_spans"))

    def text(col):
        return F.array_join(F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.withColumns({"base_sha256": F.sha2(text("base_spans"), 256), "spans": text("all_spans")})
