"""Repair of a conversation's structure: the cheapest edits that make its roles
alternate, found by bidirectional Dijkstra over the edit lattice.

A lattice node is (rows consumed, state of the roles emitted so far); edges
keep, rerole or delete the next row, or insert a row.  A forward search from
the start and a reverse one from the ends meet; both go on until every node of
an equal-cost path is settled, and of the paths that cross the least audit is
taken.

A conversation may hold any share of all rows, so nothing gathers one.  Rows
are reduced to a symbol and ranked over the whole table, and chunks of at most
``CHUNK`` ranks are searched by themselves, for every state they may begin and
end in.  An audit of a chunk always ends with a row's edit (insertions belong
to the row that follows), so of two equally dear ones neither begins the other
and the lesser stays the lesser whatever follows: the chunks' best edges form
a shorter lattice, searched in the same way, ``FAN`` at a time, until one
remains.  Texts are read once, by conversation and in order, and hashed as
they come.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import partitions, range_ranked
from cohortlab.plans.guards import materialize, salted_lookup_join

CHUNK = 256                   # ranks of a chunk
FAN = 8                       # chunks that are joined at a time
SPACE = r"[\x20\x09-\x0D]"
# The costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# The states of `(s?(ua)+)?` after no row, s, u and a, and where each role leads.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
DUE = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}        # the role that an inserted or reroled row gets
NAMES = {"u": "user", "a": "assistant"}
ENDS = (START, ASSISTANT)
LEGAL = {"su", "ua", "au"}


# --- the lattice

def row_edges(symbol: str) -> list[tuple[int, int, int, str]]:
    """``(state, next state, cost, audit)`` of a row; its symbol is the role's
    initial (x: another) and the fault: ``-`` none, ``!`` truncated, ``#`` to be deleted."""
    role, fault = symbol
    out = [(q, q, DELETE, "D") for q in STATES]
    if fault != "#":
        more = TRUNCATED if fault == "!" else 0
        out += [(q, NEXT[q, role], more, "K") for q in STATES if (q, role) in NEXT]
        out += [(q, NEXT[q, DUE[q]], REROLE + more, "R") for q in STATES]
    return out


INSERTIONS = [(q, NEXT[q, DUE[q]], INSERT, "I") for q in STATES]


def search(layers: list[list[tuple]], insert_at: range, start: int, ends: tuple) -> tuple[int, str] | None:
    """Least cost and, of equally dear paths, the least audit from ``start``
    before the first layer to one of ``ends`` after the last.  ``layers`` hold
    the edges from one layer to the next; rows may be inserted at the layers of
    ``insert_at``."""
    n = len(layers)
    out: dict = {}
    into: dict = {}

    def edge(a, b, cost, audit):
        out.setdefault(a, []).append((b, cost, audit))
        into.setdefault(b, []).append((a, cost, audit))

    for i, edges in enumerate(layers):
        for q, r, cost, audit in edges:
            edge((i, q), (i + 1, r), cost, audit)
    for i in insert_at:
        for q, r, cost, audit in INSERTIONS:
            edge((i, q), (i, r), cost, audit)

    first, last = (0, start), {(n, q) for q in ends}
    settled = ({}, {})                          # cost from the start, cost to an end
    heaps = ([], [])
    steps = (out, into)
    best = None

    def settle(side, node, cost):
        nonlocal best
        settled[side][node] = cost
        across = settled[1 - side]
        for near, step, _ in [*steps[side].get(node, ()), (node, 0, "")]:
            if near in across:
                both = cost + step + across[near]
                best = both if best is None else min(best, both)
            if near not in settled[side]:
                heapq.heappush(heaps[side], (cost + step, near))

    settle(0, first, 0)
    for node in last:
        settle(1, node, 0)
    # while it holds, a path as cheap as the best may have a node that neither side has settled
    while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best):
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, node = heapq.heappop(heaps[side])
        if node not in settled[side]:
            settle(side, node, cost)
    if best is None:
        return None
    ahead = _least({first}, settled[0], into, lambda audit, so_far: so_far + audit)
    behind = _least(last, settled[1], out, lambda audit, so_far: audit + so_far)
    crossings = [(a, b, audit) for a, cost in settled[0].items()
                 for b, step, audit in [*out.get(a, ()), (a, 0, "")]
                 if b in settled[1] and cost + step + settled[1][b] == best]
    return best, min(ahead(a) + audit + behind(b) for a, b, audit in crossings)


def _least(own: set, settled: dict, back: dict, join):
    """The least audit between a search's own end and a node that it settled:
    along edges that lose nothing, each node's from its neighbours' nearer the end."""
    known = dict.fromkeys(own, "")

    def of(goal):
        stack = [goal]
        while stack:
            node = stack[-1]
            if node in known:
                stack.pop()
                continue
            tight = [(near, audit) for near, step, audit in back.get(node, ())
                     if near in settled and settled[near] + step == settled[node]]
            missing = [near for near, _ in tight if near not in known]
            if missing:
                stack += missing
            else:
                known[node] = min(join(audit, known[near]) for near, audit in tight)
                stack.pop()
        return known[goal]
    return of


# --- chunks

def _illegal(roles: str) -> int:
    return sum(roles[i:i + 2] not in LEGAL for i in range(len(roles) - 1))


@lru_cache(maxsize=20_000)
def _whole(symbols: str) -> tuple[int, str]:
    rows = [row_edges(symbols[i:i + 2]) for i in range(0, len(symbols), 2)]
    return search(rows, range(len(rows) + 1), START, ENDS)


def _between(layers: list[list[tuple]], insert_at: range, starts) -> list[tuple]:
    """The best edge from each state before the layers to each after them."""
    found = [(q, r, search(layers, insert_at, q, (r,))) for q in starts for r in STATES]
    return [(q, r, *best) for q, r, best in found if best is not None]


PART = "conv string, at long, parts long, first string, last string, illegal long, edges array<struct<q:int,r:int,cost:long,audit:string>>"
_EDGE = pa.list_(pa.struct([("q", pa.int32()), ("r", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_PART = [("conv", pa.string()), ("at", pa.int64()), ("parts", pa.int64()), ("first", pa.string()), ("last", pa.string()),
         ("illegal", pa.int64()), ("edges", _EDGE)]


def _batch(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)], names=[n for n, _ in fields])


def _edges(found: list[tuple]) -> list[dict]:
    return [{"q": q, "r": r, "cost": cost, "audit": audit} for q, r, cost, audit in found]


def _first_chunks(batches):
    """A chunk's rows to its best edges; a conversation of one chunk is finished (one edge, from start to end)."""
    for b in batches:
        rows = []
        for conv, at, parts, cells in zip(*(c.to_pylist() for c in b.columns)):
            cells.sort(key=lambda c: c["rank"])
            # of equal rows all but the first are duplicates
            symbols = "".join(c["symbol"] + (c["symbol"][0] + "#") * (c["copies"] - 1) for c in cells)
            if parts == 1:
                found = [(START, ASSISTANT, *_whole(symbols))]
            else:
                layers = [row_edges(symbols[i:i + 2]) for i in range(0, len(symbols), 2)]
                found = _between(layers, range(len(layers)), [START] if at == 0 else STATES)
            rows.append((conv, at, parts, symbols[0], symbols[-2], _illegal(symbols[::2]), _edges(found)))
        yield _batch(rows, _PART)


def _join_chunks(batches):
    """The best edges over up to ``FAN`` chunks in a row; the last round closes the conversation."""
    for b in batches:
        rows = []
        for conv, at, parts, cells in zip(*(c.to_pylist() for c in b.columns)):
            cells.sort(key=lambda c: c["at"])
            layers = [[(e["q"], e["r"], e["cost"], e["audit"]) for e in c["edges"]] for c in cells]
            if parts == 1:
                n = len(layers)
                found = [(START, ASSISTANT, *search(layers, range(n, n + 1), START, ENDS))]
            else:
                found = _between(layers, range(0), [START] if at == 0 else STATES)
            illegal = sum(c["illegal"] for c in cells) + sum(x["last"] + y["first"] not in LEGAL for x, y in zip(cells, cells[1:]))
            rows.append((conv, at, parts, cells[0]["first"], cells[-1]["last"], illegal, _edges(found)))
        yield _batch(rows, _PART)


# --- conversations

def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Rows damaged by ``crc32(conv_id:turn) % 20``: 0 dropped, 1 without text,
    2 without ``.!?``, 3 repeated, 4 said by the user; columns ``conv_id, turn,
    role, text``.  Nulls in the id, role and text count as one space."""
    rows = _plain(rows, conv_col, turn_col, role_col, text_col)
    turn = F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    rows = rows.withColumn("fault", F.crc32(F.encode(F.concat("conv", F.lit(":"), turn), "UTF-8")) % 20).where("fault <> 0")
    text = (F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    times = F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))
    return (rows.select("conv", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
                        text.alias("text"), F.explode(times).alias("_"))
            .select(_id().alias("conv_id"), "turn", "role", "text"))


def _plain(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    space = F.lit(" ")
    return rows.select(F.coalesce(F.col(conv_col).cast("long").cast("string"), space).alias("conv"),
                       F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), space).alias("role"),
                       F.coalesce(F.col(text_col), space).alias("text"))


def _id() -> Column:
    return F.when(F.col("conv") != " ", F.col("conv")).cast("long")


def _digest() -> Column:
    return F.unhex(F.sha2("text", 256))


ORDER = ["conv", "turn", "role", "digest"]


def _symbols(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, digest, copies, fault, symbol`` of every different row, texts left behind."""
    bare = F.regexp_replace("text", SPACE + "+\\z", "")
    fault = (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank")
             .when(~bare.rlike(r"[.!?]\z"), "truncated").otherwise("none"))
    rows = rows.select("conv", "turn", "role", _digest().alias("digest"), fault.alias("fault"))
    rows = materialize(rows.groupBy("conv", "turn", "role", "digest", "fault").agg(F.count("*").alias("copies")), "talk-rows")
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    key = F.unhex(F.sha2(F.concat(F.encode("conv", "UTF-8"), F.unhex(F.lit("00")), F.col("digest"), F.encode("role", "UTF-8")), 256))
    rows = rows.withColumns({"said": key, "when": when})
    firsts = materialize(rows.groupBy(F.col("said").alias("_said")).agg(F.min("when").alias("earliest"), F.count("*").alias("_rows")),
                         "talk-firsts")
    rows = salted_lookup_join(rows, firsts, "said", "_said", salt_from=["turn"], count_col="_rows")
    again = ~F.col("when").eqNullSafe(F.col("earliest"))
    fault = F.when((F.col("fault") != "blank") & again, "duplicate").otherwise(F.col("fault"))
    initial = F.substring("role", 1, 1)
    mark = F.when(F.col("fault").isin("blank", "duplicate"), "#").when(F.col("fault") == "truncated", "!").otherwise("-")
    return (rows.select("conv", "turn", "role", "digest", "copies", fault.alias("fault"))
            .withColumn("symbol", F.concat(F.when(initial.isin("s", "u", "a"), initial).otherwise("x"), mark)))


def _audits(symbols: DataFrame) -> DataFrame:
    """``conv, illegal, cost, audit`` of every conversation with rows."""
    order = [F.col(c).asc_nulls_first() for c in ORDER]
    ranked = range_ranked(symbols, order, "talk-ranked").select(
        "conv", "rank", F.floor(F.col("rank") / CHUNK).alias("chunk"), "symbol", "copies")
    chunks = materialize(ranked.groupBy("conv", "chunk").agg(F.collect_list(F.struct("rank", "symbol", "copies")).alias("cells")),
                         "talk-chunks")                                          # at most CHUNK
    spans = chunks.groupBy(F.col("conv").alias("_conv")).agg(F.min("chunk").alias("low"), F.count("*").alias("parts"))
    spans = materialize(spans, "talk-spans")
    most = spans.agg(F.max("parts")).first()[0] or 1
    level = salted_lookup_join(chunks, spans, "conv", "_conv", salt_from=["chunk"], count_col="parts").select(
        "conv", (F.col("chunk") - F.col("low")).alias("at"), "parts", "cells")
    level = materialize(level.mapInArrow(_first_chunks, PART), "talk-parts")
    done = level.where("parts = 1")
    while most > 1:
        joined = (level.where("parts > 1")
                  .groupBy("conv", F.floor(F.col("at") / FAN).alias("at"), F.ceil(F.col("parts") / FAN).alias("parts"))
                  .agg(F.collect_list(F.struct("at", "first", "last", "illegal", "edges")).alias("cells")))      # at most FAN
        level = materialize(joined.mapInArrow(_join_chunks, PART), "talk-parts")
        done = done.unionByName(level.where("parts = 1"))
        most = -(-most // FAN)
    return done.select("conv", "illegal", F.col("edges")[0]["cost"].alias("cost"), F.col("edges")[0]["audit"].alias("audit"))


def reports(rows: DataFrame, ids: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
            role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation of ``rows`` (and of ``ids``, a table with
    ``conv_id``): ``conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit``.

    Rows are taken by turn (nulls first; equal turns by role and text).  A
    row's first fault counts: blank, duplicate (role and text seen earlier),
    truncated (no ``.!?`` at its end).  ``gaps``: turns missing between the
    least and the greatest; ``illegal``: neighbours whose roles do not follow
    each other; ``audit``: the cheapest edits, K(eep), R(erole), D(elete) and
    I(nsert), that give role initials ``(s?(ua)+)?``, and their ``cost``.

    Nulls in the role and text count as one space; rows without an id are one
    conversation; repeated rows are duplicates; a conversation without rows has
    zeros and an empty audit; an empty table gives no rows; other columns are
    left out.
    """
    plain = _plain(rows, conv_col, turn_col, role_col, text_col)
    return _reports(plain, ids).select(_id().alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _reports(plain: DataFrame, ids: DataFrame | None) -> DataFrame:
    symbols = materialize(_symbols(plain), "talk-symbols")

    def many(fault, copies):
        return F.coalesce(F.sum(F.when(F.col("fault") == fault, copies)), F.lit(0))

    copies, one = F.col("copies"), F.lit(1)
    counted = symbols.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).alias("gaps"), many("blank", copies).alias("blank"),
        # further copies of a row that is not blank are duplicates of the first
        (many("duplicate", copies) + many("truncated", copies - 1) + many("none", copies - 1)).alias("duplicate"),
        many("truncated", one).alias("truncated"))
    found = counted.join(_audits(symbols), "conv")
    if ids is not None:
        asked = ids.select(F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit(" ")).alias("conv")).distinct()
        found = asked.join(found, "conv", "full")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return materialize(found.select("conv", *numbers, F.coalesce("audit", F.lit("")).alias("audit")), "talk-reports")


# --- repaired rows

def _walk(batches):
    """Conversations in order: ``(conv, None)`` at the beginning of each, then
    ``(conv, (edit, turn, role, text))`` for every row of the result."""
    conv = audit = None
    at = state = 0

    def inserted():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            role, at = DUE[state], at + 1
            state = NEXT[state, role]
            yield conv, ("I", None, NAMES[role], "")

    for b in batches:
        for conv_, kind, turn, role, text, said in zip(*(c.to_pylist() for c in b.columns)):
            if kind == 0:
                if conv is not None:
                    yield from inserted()
                conv, audit, at, state = conv_, said, 0, START
                yield conv, None
                continue
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "D":
                continue
            initial = DUE[state] if edit == "R" else role[0]
            state = NEXT[state, initial]
            yield conv, (edit, turn, NAMES[initial] if edit == "R" else role, text)
    if conv is not None:
        yield from inserted()


def _in_order(plain: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order, in one partition."""
    data = plain.select("conv", F.lit(1).alias("kind"), "turn", "role", _digest().alias("digest"), "text", F.lit(None).cast("string").alias("audit"))
    none = F.lit(None).cast("string")
    head = found.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), none.alias("role"),
                        F.lit(None).cast("binary").alias("digest"), none.alias("text"), "audit")
    order = ["conv", "kind"] + [F.col(c).asc_nulls_first() for c in ORDER[1:]]
    return (head.unionByName(data).repartition(partitions(plain), "conv").sortWithinPartitions(*order)
            .select("conv", "kind", "turn", "role", "text", "audit"))


def _rows(batches):
    fields = [("conv", pa.string()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]
    held, size, place = [], 0, 0
    for conv, row in _walk(batches):
        if row is None:
            place = 0
            continue
        held.append((conv, place, *row))
        place, size = place + 1, size + len(row[3])
        if len(held) == 10_000 or size > 1 << 24:
            yield _batch(held, fields)
            held, size = [], 0
    yield _batch(held, fields)


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """The rows of the repaired conversations: ``conv_id, place`` (from 0),
    ``edit`` (K, R or I), ``turn`` (null where inserted), ``role, text``.  See
    :func:`reports` for the edits and for odd rows."""
    plain = _plain(rows, conv_col, turn_col, role_col, text_col)
    return (_in_order(plain, _reports(plain, None))
            .mapInArrow(_rows, "conv string, place long, edit string, turn long, role string, text string")
            .select(_id().alias("conv_id"), "place", "edit", "turn", "role", "text"))


def _hashes(batches):
    import hashlib
    fields = [("conv", pa.string()), ("repaired_sha256", pa.string())]
    held, at, hash_, begun = [], None, None, False
    for conv, row in _walk(batches):
        if row is None:
            if hash_ is not None:
                held.append((at, hash_.hexdigest()))
            at, hash_, begun = conv, hashlib.sha256(), False
            if len(held) >= 10_000:
                yield _batch(held, fields)
                held = []
            continue
        hash_.update(("\n" if begun else "").encode() + f"{row[2]}:{row[3]}".encode())
        begun = True
    if hash_ is not None:
        held.append((at, hash_.hexdigest()))
    yield _batch(held, fields)


def digests(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """:func:`reports` with ``repaired_sha256``, the hash of the repaired
    rows as ``role:text`` lines.  A hash takes a conversation's bytes one after
    the other, so they pass through one task, a batch at a time."""
    plain = _plain(rows, "conv_id", "turn", "role", "text")
    found = _reports(plain, ids)
    hashed = _in_order(plain, found).mapInArrow(_hashes, "conv string, repaired_sha256 string")
    return (found.join(hashed, "conv")
            .select(_id().alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
