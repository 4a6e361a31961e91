"""Repeated byte strings by a depth-limited radix sort of suffixes.

Every ``depth``-byte window is a suffix cut at the threshold.  The sort goes
from the most significant digit down and only as deep as the threshold; groups
that are still equal at the end are exactly the repeated windows, and a window
alone in its group is dropped at once.

*First digit.*  The smallest hashed ``gram`` inside the window, a choice that
depends on the window's bytes alone, so equal windows share it.  Windows in a
row choose the same place, so one record stands for all windows around it:
about 2 records per ``offsets`` bytes instead of one per byte.

*Next digits.*  The bytes around the place.  Records whose whole surroundings
agree are settled at once for all their windows.  Of the others one record per
distinct surrounding goes on: groups are cut at half their windows, and half
again, keyed by the bytes that all windows of a part share, while they are too
large for a task, and then sorted window by window inside one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.llm import rolling
from cohortlab.llm.common import partitions, text_of
from cohortlab.plans.guards import materialize

MAX_GROUP = 20_000   # records that one task sorts at a time; larger groups take another digit first
SLICE = 1 << 20      # window starts handled at a time, so long texts need no large arrays


def offsets_of(depth: int) -> int:
    """Places a gram may take in a window: a power of two, so ranges halve evenly."""
    n = 1
    while 2 * n <= 0.65 * depth:
        n *= 2
    return n


def places(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``at, gram hash, surroundings hash, inside``: the chosen places of one
    text.  The surroundings are all bytes of all windows around the place;
    ``inside`` says whether they lie within the text."""
    offsets = offsets_of(depth)
    gram = depth - offsets + 1
    out = []
    n = len(data)
    for base in range(0, max(0, n - depth + 1), SLICE):
        lo, hi = max(0, base - depth), min(n, base + SLICE + 2 * depth)
        pre = rolling.prefix(data[lo:hi])
        first, last = base - lo, min(base + SLICE, n - depth + 1) - lo      # window starts
        starts = np.arange(first, last + offsets - 1)                       # places in those windows
        grams = rolling.spans(pre, starts, starts + gram)
        at = rolling.sliding_argmin(grams, offsets) + first
        left, right = at - offsets + 1, at + depth
        inside = (left + lo >= 0) & (right + lo <= n)
        around = rolling.spans(pre, np.clip(left, 0, None), np.clip(right, None, hi - lo))
        out.append((at + lo, grams[at - first], around, inside))
    if not out:
        empty = np.zeros(0, np.int64)
        return empty, empty.astype(np.uint64), empty.astype(np.uint64), empty.astype(bool)
    at, g, f, inside = (np.concatenate(x) for x in zip(*out))
    _, once = np.unique(at, return_index=True)        # slices may choose a place twice
    return at[once], g[once], f[once], inside[once]


def _records(depth: int):
    def run(batches):
        for batch in batches:
            ids, ks, texts = (batch.column(i) for i in range(3))
            cols = [[], [], [], [], []]
            for d, k, t in zip(ids.to_pylist(), ks.to_pylist(), texts):
                data = np.frombuffer(t.as_py(), np.uint8)
                at, g, f, inside = places(data, depth)
                if not len(at):
                    continue
                # surroundings that leave the text are equal to no other text's
                own = rolling.mix(at.astype(np.uint64) * np.uint64(5) + np.uint64((k + 3 * d) & (2**64 - 1)))
                f = np.where(inside, f, own)
                for c, v in zip(cols, (np.full(len(at), d), np.full(len(at), k), at, g.view(np.int64), f.view(np.int64))):
                    c.append(v)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in cols],
                                                 names=["d", "k", "at", "key", "around"])
    return run


def _cut_out(depth: int):
    """Adds to each record the bytes of its windows, padded where they leave the text."""
    offsets = offsets_of(depth)

    def run(batches):
        for b in batches:
            rows = []
            for d, k, text, recs in zip(b["d"], b["k"], b["text"], b["recs"]):
                text = bytes(text)
                for r in recs:
                    lo, hi = r["at"] - offsets + 1, r["at"] + depth
                    body = b"\0" * max(0, -lo) + text[max(0, lo):hi]
                    rows.append((d, k, lo, r["key"], body.ljust(hi - lo, b"\0"), max(0, -lo),
                                 offsets - max(0, hi - len(text))))
            yield pd.DataFrame(rows, columns=["d", "k", "start", "key", "body", "first", "last"])
    return run


CUT = "d long, k long, start long, key long, body binary, first int, last int"


def _window_hashes(bodies: list, depth: int) -> np.ndarray:
    """Rows by windows: the hash of every ``depth`` bytes of every body (equal lengths)."""
    grid = np.frombuffer(b"".join(bodies), np.uint8).reshape(len(bodies), -1)
    p, inv = rolling.powers(grid.shape[1] + 1)
    pre = np.zeros((grid.shape[0], grid.shape[1] + 1), np.uint64)
    np.cumsum(rolling.BYTE[grid] * p[:-1], axis=1, out=pre[:, 1:])
    n = grid.shape[1] - depth + 1
    return rolling.mix((pre[:, depth:] - pre[:, :n]) * inv[:n])


def _sort_groups(depth: int):
    """Sort each group's windows; gives the runs of windows that some other
    member of the group shares.  Groups come whole and in a row."""
    def solve(part):
        hashes = _window_hashes(list(part["body"]), depth)
        key = part["key"].to_numpy(np.int64).view(np.uint64)
        first, last = part["first"].to_numpy(), part["last"].to_numpy()
        shared = np.zeros(hashes.shape, bool)
        for t in range(hashes.shape[1]):
            h = rolling.mix(hashes[:, t] + key)
            ok = np.flatnonzero((first <= t) & (t < last))
            order = ok[np.argsort(h[ok], kind="stable")]
            twin = h[order[1:]] == h[order[:-1]]
            shared[order[1:][twin], t] = True
            shared[order[:-1][twin], t] = True
        edge = np.diff(np.pad(shared.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, a = np.nonzero(edge == 1)
        _, z = np.nonzero(edge == -1)
        start = part["start"].to_numpy()[row]
        return pd.DataFrame({"d": part["d"].to_numpy()[row], "k": part["k"].to_numpy()[row],
                             "a": start + a, "z": start + z - 1 + depth})

    def run(batches):
        left = None
        for b in batches:
            if not len(b):
                continue
            b = b if left is None else pd.concat([left, b], ignore_index=True)
            last = b["key"] == b["key"].iloc[-1]
            done, left = b[~last], b[last]
            if len(done):
                yield solve(done)
        if left is not None and len(left):
            yield solve(left)
    return run


def _halve(depth: int):
    """Each record becomes two with half its windows, keyed by the bytes that
    all windows of the half share; ``around`` tells equal bodies."""
    def run(batches):
        import xxhash
        for b in batches:
            rows = []
            for d, k, start, key, body, first, last in zip(b["d"], b["k"], b["start"], b["key"], b["body"], b["first"], b["last"]):
                body = bytes(body)
                half = (len(body) - depth + 1) // 2
                for at in (0, half):
                    part = body[at:at + half - 1 + depth]
                    lo, hi = max(0, first - at), min(half, last - at)
                    if lo >= hi:
                        continue
                    core = part[half - 1:depth]
                    own = b"" if (lo, hi) == (0, half) else b"%d:%d:%d" % (d, k, start)
                    rows.append((d, k, start + at, xxhash.xxh3_64_intdigest(core, seed=(key ^ at) & (2**64 - 1)) - 2**63,
                                 part, lo, hi, xxhash.xxh3_64_intdigest(part + own) - 2**63))
            yield pd.DataFrame(rows, columns=["d", "k", "start", "key", "body", "first", "last", "around"])
    return run


def _remove():
    def run(batches):
        import hashlib
        for b in batches:
            rows = []
            for doc_id, text, runs in zip(b["doc_id"], b["text"], b["runs"]):
                text, kept, at, n, spans = bytes(text), [], 0, 0, 0
                reach = -1
                for r in sorted((max(0, r["a"]), min(len(text), r["z"])) for r in runs):
                    if r[0] > reach:
                        spans += 1
                        kept.append(text[at:r[0]])
                        at = reach = r[0]
                    if r[1] > reach:
                        n += r[1] - reach
                        at = reach = r[1]
                kept.append(text[at:])
                rows.append((doc_id, len(text), n, spans,
                             hashlib.sha256(b"".join(kept)).hexdigest(), b"".join(kept)))
            yield pd.DataFrame(rows, columns=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])
    return run


def repeated_runs(docs: DataFrame, depth: int = 200) -> DataFrame:
    """``d, k, a, z``: byte runs covered by repeated windows, by row key; runs
    may overlap.  ``docs``: ``d, k, text`` with text as bytes."""
    n = partitions(docs)
    records = docs.mapInArrow(_records(depth), "d long, k long, at long, key long, around long")
    offsets = offsets_of(depth)
    # First digit: grams that occur once are out before anything else moves.
    again = materialize(records.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "suffix-grams")
    open_ = materialize(records.join(again, "key"), "suffix-records")
    classes = open_.groupBy("key", "around").agg(F.count("*").alias("n"), F.min(F.struct("d", "k", "at")).alias("one"))
    classes = materialize(classes, "suffix-classes")
    settled = (open_.join(classes.where("n > 1").select("key", "around"), ["key", "around"])
               .select("d", "k", (F.col("at") - (offsets - 1)).alias("a"), (F.col("at") + depth).alias("z")))
    found = [settled]
    # written, so that the join below can split a key that very many records share
    several = materialize(classes.groupBy("key").count().where("count > 1").select("key"), "suffix-several")
    going = classes.join(several, "key").select("key", "one.*")
    per_text = going.groupBy("d", "k").agg(F.collect_list(F.struct("key", "at")).alias("recs"))    # at most a text's length
    level = materialize(docs.join(per_text, ["d", "k"]).select("d", "k", "text", "recs")
                        .mapInPandas(_cut_out(depth), CUT), "suffix-open")
    width = offsets
    while True:
        sizes = materialize(level.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "suffix-sizes")
        total = sizes.agg(F.sum("n").alias("n")).first()["n"] or 0
        chunk = max(min(200, MAX_GROUP), min(MAX_GROUP, total // (2 * n)))
        small = level.join(sizes.where(F.col("n") <= chunk).select("key"), "key")
        found.append(materialize(
            small.select(*level.columns).repartition(n, "key").sortWithinPartitions("key")
            .mapInPandas(_sort_groups(depth), "d long, k long, a long, z long"), "suffix-runs"))
        large = sizes.where(F.col("n") > chunk).select("key")
        if width == 1 or large.isEmpty():
            if width == 1:      # whole windows: members of a group are equal
                found.append(level.join(large, "key").where("first < last")
                             .select("d", "k", F.col("start").alias("a"), (F.col("start") + depth).alias("z")))
            break
        width //= 2
        halves = materialize(level.join(large, "key").select(*level.columns)
                             .mapInPandas(_halve(depth), CUT + ", around long"), "suffix-halves")
        classes = materialize(halves.groupBy("key", "around")
                              .agg(F.count("*").alias("n"), F.min(F.struct("d", "k", "start")).alias("one")), "suffix-classes")
        found.append(halves.join(classes.where("n > 1").select("key", "around"), ["key", "around"])
                     .select("d", "k", (F.col("start") + F.col("first")).alias("a"),
                             (F.col("start") + F.col("last") - 1 + depth).alias("z")))
        heads = classes.select("key", "around", F.col("one.d").alias("d"), F.col("one.k").alias("k"), F.col("one.start").alias("start"))
        level = halves.join(heads, ["key", "around", "d", "k", "start"]).select(*level.columns)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def drop_repeats(docs: DataFrame, depth: int = 200, id_col: str = "doc_id", text_col: str = "text",
                 with_text: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``
    (and ``kept_text`` as bytes).

    Every byte covered by a ``depth``-byte string that also starts anywhere
    else, in the same text or another, is removed; strings are judged on the
    input.  Texts are UTF-8 bytes, null is empty; repeated rows repeat each
    other's strings, so all of theirs go; null ids pass through; an empty
    table gives no rows.
    """
    text = text_of(text_col)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("d"),
                       # the null id has keys of its own
                       F.xxhash64(text, F.col(id_col).isNull()).alias("k"),
                       F.encode(text, "UTF-8").alias("text"))
    runs = materialize(
        repeated_runs(base.select("d", "k", "text"), depth)
        .groupBy("d", "k").agg(F.collect_set(F.struct("a", "z")).alias("runs")), "suffix-cuts")
    schema = "id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text binary"
    hit = (base.join(runs, ["d", "k"]).select(F.col("doc_id").cast("string").alias("doc_id"), "text", "runs").mapInPandas(_remove(), schema)
           .select(F.col("id").cast("long").alias("doc_id"), *[c.split()[0] for c in schema.split(", ")[1:]]))
    whole = base.select("doc_id", "d", "k", F.octet_length("text").cast("long").alias("n_bytes"),
                        F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
                        F.sha2("text", 256).alias("kept_sha256"), *([F.col("text").alias("kept_text")] if with_text else []))
    whole = whole.join(runs.select("d", "k"), ["d", "k"], "left_anti").drop("d", "k")
    return (hit if with_text else hit.drop("kept_text")).unionByName(whole)
