"""Exact Jaccard self-join of shingle sets by universe partition and pigeonhole.

A set's tokens (hashed word shingles) fall into segments of the hash
universe.  Sets of a size band that link differ in at most H tokens, so

* of H + 1 + slack segments at least 1 + slack are equal, or
* of H // 2 + 1 larger segments one differs in at most a token, and then the
  segments' one-deletion neighbourhoods meet;

each band takes the allocation that costs less.  Equal values are buckets.
Of a set's segments the ``slack`` commonest are left out: the cheapest value
that two linking sets share is never among either's, as ``slack`` shared
values are dearer (ties broken by the value itself).

Buckets are then resolved by :mod:`cohortlab.llm.hubs`.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.llm import packed, rolling
from cohortlab.llm.common import part_clashes, partitions, text_of
from cohortlab.llm.hubs import link_components, link_counts
from cohortlab.plans.guards import materialize

# Of op4; callers with another contract give their own.
NUM, DEN = 85, 100            # link when DEN * intersection >= NUM * union
SHINGLE = 4                   # words
BAND = 1.35                   # sizes of a band: up to this factor
SLICE = 1 << 20               # bytes hashed at a time

MET = 200_000                 # sets that a task remembers having met

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
LOWER_BYTE = rolling.BYTE[_lower]
IS_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_weights = rolling.BYTE[:64:2] * np.uint64(0x9E3779B97F4A7C15)
_u = np.uint64


# --- sets

def word_hashes(data: np.ndarray) -> np.ndarray:
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + SLICE)
        while end < len(data) and not IS_SPACE[data[end]]:     # cut between words
            end += 1
        part = data[at:end]
        word = np.zeros(len(part) + 2, np.int8)
        word[1:-1] = ~IS_SPACE[part]
        step = np.diff(word)
        pre = rolling.prefix(part, LOWER_BYTE)
        out.append(rolling.spans(pre, np.flatnonzero(step == 1), np.flatnonzero(step == -1)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Distinct hashed shingles, ascending; fewer words than ``size`` make one, none make none."""
    words = word_hashes(np.frombuffer(text, np.uint8))
    n = len(words)
    if not n:
        return words
    if n < size:
        return rolling.mix((words * _weights[:n]).sum(keepdims=True) + np.full(1, n, np.uint64) * _weights[-1])
    total = words[:n - size + 1] * _weights[0]
    for i in range(1, size):
        total = total + words[i:n - size + 1 + i] * _weights[i]
    return np.unique(rolling.mix(total))


def set_hashes(tokens: np.ndarray) -> tuple[int, int]:
    n = _u(len(tokens))
    out = []
    for salt in (_u(0xA5A5A5A5), _u(0x5C5C5C5C)):
        out.append(rolling.mix(rolling.mix(tokens + salt).sum(keepdims=True) + n).view(np.int64)[0])
    return int(out[0]), int(out[1])


def node_of(hashes: tuple[int, int], apart: frozenset = frozenset()) -> int:
    """A set's node: half of its hash, or the other half for the few halves
    that stand for two sets."""
    return hashes[1] if hashes[0] in apart else hashes[0]


# --- allocation

@lru_cache
def bands(num: int = NUM, den: int = DEN, limit: int = 1 << 40) -> tuple[np.ndarray, np.ndarray]:
    """First and last size of each band."""
    lows, highs, lo = [], [], 1
    while lo < limit:
        hi = max(lo * den // num, int(lo * BAND))
        lows.append(lo)
        highs.append(hi)
        lo = hi + 1
    return np.array(lows), np.array(highs)


@lru_cache(maxsize=None)
def allocation(band: int, num: int = NUM, den: int = DEN) -> tuple[int, int, bool]:
    """``segments, slack, deletions`` of a band.  The cost of an allocation is
    its number of signatures and, weighed far higher, the share of sets that
    end up under a value which says nothing (a segment without tokens)."""
    hi = int(bands(num, den)[1][band])
    lo = int(bands(num, den)[0][band])
    h = hi * (den - num) // num          # most tokens a linking pair can differ in
    if h == 0:
        return 0, 0, False               # only equal sets link, and those are one node
    n = (lo + hi) / 2
    slack = 1 + (h + 1) // 6
    m = h + 1 + slack
    if h > 100:
        return m, slack, False           # long sets hardly ever leave a segment empty
    mean = m * math.exp(-n / m)
    over = 1 - sum(math.exp(-mean) * mean**i / math.factorial(i) for i in range(slack + 1))
    q = h // 2 + 1
    bare = min(1.0, q * math.exp(-n / q) * (1 + n / q)) if q > 1 else 0.0
    if n + q + 1e4 * bare < m + 1e4 * over:
        return q, 0, True
    return m, slack, False


def signatures(tokens: np.ndarray, num: int = NUM, den: int = DEN) -> list[tuple[int, np.ndarray]]:
    """``(scheme, values)``: under its own band's scheme, and under the band's
    below where a set there can be its partner."""
    lows, highs = bands(num, den)
    n = len(tokens)
    own = int(np.searchsorted(highs, n))
    out = []
    for scheme in (own, own - 1):
        if scheme < 0 or (scheme < own and n > int(highs[scheme]) * den // num):
            continue
        m, _, deletions = allocation(scheme, num, den)
        if not m:
            continue
        segment = ((tokens >> _u(40)) * _u(m)) >> _u(24)      # tokens ascend, so segments do
        edges = np.searchsorted(segment, np.arange(m + 1))
        mixed = rolling.mix(tokens + _u(0x77777777))
        total = np.concatenate(([_u(0)], np.cumsum(mixed)))
        sums = total[edges[1:]] - total[edges[:-1]]
        place = np.arange(m, dtype=np.uint64) + _u(scheme << 40)
        values = rolling.mix(sums + place * _weights[1])
        if deletions:
            s = segment.astype(np.int64)
            values = np.concatenate((values, rolling.mix(sums[s] - mixed + place[s] * _weights[1])))
        out.append((scheme, np.unique(values)))
    return out


def _sets(size: int):
    def run(batches):
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            rows = [shingles(t.as_py(), size) for t in texts]
            hashes = [set_hashes(r) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(r) for r in rows], pa.int64()), pa.array([h[0] for h in hashes], pa.int64()),
                 pa.array([h[1] for h in hashes], pa.int64()), b.column(2)], names=["doc_id", "n", "node", "check", "k"])
    return run


def _emit(parts: int, size: int, num: int, den: int, apart: frozenset):
    """Signatures dealt into ``parts`` by value, as packed arrays: a row per
    batch and part.  A set that the task has met already adds nothing."""
    def run(batches):
        met = set()
        for b in batches:
            values, nodes, schemes = [], [], []
            for t in b.column(0):
                tokens = shingles(t.as_py(), size)
                if not len(tokens):
                    continue
                node = node_of(set_hashes(tokens), apart)
                if node in met:
                    continue
                if len(met) == MET:
                    met.clear()                # it only saves work
                met.add(node)
                for scheme, v in signatures(tokens, num, den):
                    values.append(v)
                    nodes.append(np.full(len(v), node, np.int64))
                    schemes.append(np.full(len(v), scheme, np.uint8))
            if not values:
                continue
            yield packed.deal(np.concatenate(values), np.concatenate(nodes), np.concatenate(schemes), parts)
    return run


# --- the join

def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3,
                    small: int = 1000, size: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, n_equal, links``.

    Sets of ``size``-word shingles link when ``den * intersection >= num * union``.
    ``component_id`` is the smallest doc_id reachable by links (null ids do
    not count; null where the component has no other), ``n_equal`` the number
    of documents with the same set, ``links`` the number of other sets that
    link with the document's.

    A document without words links with nothing.  Null text is empty; repeated
    rows share a set and a component; an empty table gives no rows.
    """
    rows, linked, sets = _linked(docs, id_col, text_col, rounds, small, size, num, den)
    degree = link_counts(linked, sets, num, den)
    nodes = _named(rows, linked).join(degree, "node", "left")
    known = materialize(nodes.select(F.col("node").alias("_node"), "component_id", "n_equal",
                                     F.coalesce("links", F.lit(0)).cast("long").alias("links")), "ngram-nodes")
    return (rows.join(known, (F.col("node") == F.col("_node")) & (F.col("n") > 0), "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    F.coalesce("n_equal", F.lit(1)).cast("long").alias("n_equal"),
                    F.coalesce("links", F.lit(0)).cast("long").alias("links")))


def _linked(docs: DataFrame, id_col: str, text_col: str, rounds: int, small: int, size: int, num: int,
            den: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``doc_id, k, n, node`` of every row, ``node, component`` of the sets that
    share a value with another, and those sets."""
    if not 0 < size < len(_weights) or not den <= 2 * num <= 2 * den:
        raise ValueError("shingles of 1 to 31 words, and a threshold from a half to 1")
    text = F.encode(text_of(text_col), "UTF-8")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    marked = base.select("doc_id", "text", F.xxhash64("text").alias("k"))
    rows = materialize(marked.mapInArrow(_sets(size), "doc_id long, n long, node long, check long, k long"), "ngram-sets")
    rows, apart = part_clashes(rows, "ngram-sets")
    linked, sets = _links(base, rows, rounds, small, size, num, den, apart)
    return rows, linked, sets


def _named(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """``node, component_id, n_equal`` of the sets with words."""
    nodes = (rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_equal"))
             .join(linked, "node", "left").withColumn("component", F.coalesce("component", "node")))
    nodes = materialize(nodes, "ngram-placed")
    named = materialize(nodes.groupBy("component").agg(F.min("least").alias("component_id")), "ngram-named")
    return nodes.join(named, "component").select("node", "component_id", "n_equal")


def _links(base: DataFrame, rows: DataFrame, rounds: int, small: int, size: int, num: int,
           den: int, apart: frozenset) -> tuple[DataFrame, DataFrame]:
    n = partitions(base)
    dealt = base.select("text").mapInArrow(_emit(4 * n, size, num, den, apart), packed.SCHEMA)
    slack = F.element_at(F.array(*[F.lit(allocation(b, num, den)[1]) for b in range(len(bands(num, den)[0]))]), F.col("tag") + 1)
    shared = materialize(packed.shared(dealt, n).withColumn("slack", slack), "ngram-shared")
    dear = Window.partitionBy("node", "tag").orderBy(F.col("cost").desc(), F.col("bucket"))
    buckets = materialize(shared.withColumn("r", F.row_number().over(dear)).where("r > slack")
                          .select("bucket", "node"), "ngram-buckets")
    # one row of the table per set gives its tokens again
    wanted = buckets.select(F.col("node").alias("_n")).distinct()
    reps = (rows.join(wanted, F.col("node") == F.col("_n"), "left_semi")
            .groupBy("node").agg(F.min("doc_id").alias("_d")))
    sets = (reps.join(base, F.col("_d").eqNullSafe(F.col("doc_id")))
            .select("node", "text").mapInArrow(_own_arrays(size, apart), "node long, n long, body array<long>"))
    sets = materialize(sets, "ngram-tokens")
    if sets.count() > sets.select("node").distinct().count():      # repeated rows gave a set twice
        sets = materialize(sets.dropDuplicates(["node"]), "ngram-tokens")
    return link_components(buckets, sets, num, den, rounds, small), sets


def _own_arrays(size: int, apart: frozenset):
    """Tokens of the rows whose set is the node asked for (an id may stand for several texts)."""
    def run(batches):
        met = set()
        for b in batches:
            nodes, ns, rows = [], [], []
            for node, t in zip(b.column(0).to_pylist(), b.column(1)):
                tokens = shingles(t.as_py(), size)
                if node in met or node_of(set_hashes(tokens), apart) != node:
                    continue
                met.add(node)
                nodes.append(node)
                ns.append(len(tokens))
                rows.append(tokens.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(ns, pa.int64()), pa.array(rows, pa.list_(pa.int64()))],
                names=["node", "n", "body"])
    return run


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                      num: int = NUM, den: int = DEN) -> DataFrame:
    """One row of ``docs`` for each component, columns as they were: that of
    the smallest id (null last), then set, text and row by their hashes.  Rows
    without words link with nothing and all stay."""
    rows, linked, _ = _linked(docs, id_col, text_col, 3, 1000, size, num, den)
    each = rows.where("n > 0").groupBy("node", "doc_id", "k").agg(F.count("*").alias("times"))
    placed = (each.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k", "times")).alias("row"))
              .join(linked, "node", "left").withColumn("component", F.coalesce("component", "node")))
    first = materialize(placed, "ngram-placed").groupBy("component").agg(
        F.min(F.struct("row.no_id", "row.doc_id", "node", "row.k", "row.times")).alias("first"))
    keep = (first.select(F.col("first.doc_id").alias("_d"), F.col("first.k").alias("_kept"), (F.col("first.times") > 1).alias("repeated"))
            .unionByName(rows.where("n = 0").select(F.col("doc_id").alias("_d"), F.col("k").alias("_kept"), F.lit(False).alias("repeated")).distinct()))
    keep = materialize(keep, "ngram-keep")
    row = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(F.encode(text_of(text_col), "UTF-8")).alias("_k"),
                      F.struct("*").alias("row"))
    kept = row.join(keep, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_k") == F.col("_kept")))
    if keep.where("repeated").isEmpty():
        return kept.select("row.*")
    # only repeated rows are mixed again, with their texts
    kept = materialize(kept, "ngram-kept")
    one = kept.where("repeated").groupBy("_id", "_k").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return one.select("row.*").unionByName(kept.where("not repeated").select("row.*"))
