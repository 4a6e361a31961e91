"""Fuzzy line duplicates by MinHash: signatures of character shingles, banding,
exact Jaccard verification and union-find."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.llm import packed, rolling
from cohortlab.llm.common import join_rows, keyed, part_clashes, partitions
from cohortlab.llm.hubs import link_components
from cohortlab.plans.guards import materialize

NUM, DEN = 80, 100            # near: DEN * intersection >= NUM * union
SHINGLE = 5                   # characters
ROWS, BANDS = 5, 14           # a pair at 0.8 shares a band with probability 0.996
FINE_ROWS, FINE_BANDS = 10, 64        # 0.999, for the members of buckets that hold several components
# Lines of many shingles look alike by chance, and the more so the more lines
# there are.  Those that fill LONG or more of four times the bins get longer
# bands (a pair at 0.8 shares one with probability 0.998); only those below BOTH
# have the short ones too.  Sets at 0.8 of sizes that fill LONG and BOTH are rare
# beyond four standard deviations.
LONG_ROWS, LONG_BANDS = 8, 35
LONG, BOTH = 170, 205
BLOCK = 1 << 20               # characters signed at a time
CHARS = 1 << 16               # characters hashed at a time
FEW = 16                      # members of a bucket whose pairs are all compared
MET = 200_000                 # lines that a task remembers having met
_u = np.uint64
_weights = rolling.BYTE[:SHINGLE]
_EMPTY = np.iinfo(np.uint64).max


def normal(line: str) -> str:
    """Lower case, single spaces, none at the ends."""
    return " ".join(line.lower().split())


def line_hash(line: str) -> tuple[int, int]:
    import xxhash
    h = xxhash.xxh3_128_intdigest(line.encode("utf-8", "surrogatepass"))
    return (h & (2**64 - 1)) - 2**63, (h >> 64) - 2**63


def _joined(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every shingle of all lines, and each shingle's line.  A line
    shorter than a shingle is one shingle."""
    hashes, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for at, end in _cut([len(x) for x in lines]):
        h, line = _hashed(lines[at:end])
        hashes.append(h)
        owner.append(line + at)
    return np.concatenate(hashes), np.concatenate(owner)


def _hashed(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    padded = [x if len(x) >= SHINGLE else x.ljust(SHINGLE, "\0") for x in lines]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(codes) - SHINGLE + 1
    total = codes[:n] * _weights[0]
    for i in range(1, SHINGLE):
        total += codes[i:n + i] * _weights[i]
    line = np.repeat(np.arange(len(lines)), [len(x) for x in padded])
    whole = line[SHINGLE - 1:] == line[:n]            # not over a line's end
    return rolling.mix(total[whole]), line[:n][whole]


def _distinct(lines: list[str]) -> tuple[np.ndarray, int]:
    """Every different shingle of each line, sorted, the line's number in the
    upper bits of its hash; and how many bits that takes."""
    hashes, line = _joined(lines)
    bits = max(len(lines) - 1, 1).bit_length()
    keys = np.sort((line.astype(np.uint64) << _u(64 - bits)) | (hashes >> _u(bits)))
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    return keys[fresh], bits


def sizes(lines: list[str]) -> np.ndarray:
    """Number of different shingles of each line."""
    out = [np.zeros(0, np.int64)]
    for at, end in _cut([len(x) for x in lines]):
        keys, bits = _distinct(lines[at:end])
        out.append(np.bincount((keys >> _u(64 - bits)).astype(np.int64), minlength=end - at))
    return np.concatenate(out)


def overlaps(x: list[str], y: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles of each ``x``, of each ``y``, and of both."""
    out = [np.zeros((3, 0), np.int64)]
    for at, end in _cut([len(a) + len(b) for a, b in zip(x, y)]):
        n = end - at
        keys, bits = _distinct(x[at:end] + y[at:end])
        line = (keys >> _u(64 - bits)).astype(np.int64)
        size = np.bincount(line, minlength=2 * n)
        keys[line >= n] -= _u(n) << _u(64 - bits)
        keys.sort()
        same = keys[1:][keys[1:] == keys[:-1]]
        both = np.bincount((same >> _u(64 - bits)).astype(np.int64), minlength=n)
        out.append(np.array([size[:n], size[n:], both]))
    return tuple(np.concatenate(out, axis=1))


def _cut(lengths: list[int]):
    """Ranges of items with about ``CHARS`` characters together, or one item."""
    at = size = 0
    for i, n in enumerate(lengths):
        if i > at and size + n > CHARS:
            yield at, i
            at, size = i, 0
        size += n
    if at < len(lengths):
        yield at, len(lengths)


def node_of(line: str, apart: frozenset = frozenset()) -> int:
    """A line's node: half of its hash, or the other half for the few halves
    that stand for two lines."""
    lo, hi = line_hash(line)
    return hi if lo in apart else lo


def tokens(line: str) -> np.ndarray:
    return np.unique(_joined([line])[0])


def band_keys(lines: list[str], rows: int = ROWS, bands: int = BANDS) -> np.ndarray:
    """``len(lines) x bands`` keys.  One permutation: a line's shingles fall
    into ``rows * bands`` bins, each bin keeps its least hash, and an empty bin
    borrows from the first filled one of a fixed pseudo-random sequence."""
    hashes, line = _joined(lines)
    return _keys(_least(hashes, line, len(lines), rows * bands), rows, bands)


def line_keys(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all bands of the lines, and each key's line: short bands, long
    ones or both, by how many bins a line's shingles fill."""
    hashes, line = _joined(lines)
    sig = _least(hashes, line, len(lines), LONG_ROWS * LONG_BANDS)
    full = (sig != _EMPTY).sum(axis=1)
    few, many = np.flatnonzero(full < BOTH), np.flatnonzero(full >= LONG)
    width = LONG_ROWS * LONG_BANDS // (ROWS * BANDS)      # bins of the long bands in one of the short ones
    short = _keys(sig[few].reshape(len(few), ROWS * BANDS, width).min(axis=2), ROWS, BANDS)
    long = rolling.mix(_keys(sig[many], LONG_ROWS, LONG_BANDS) + _u(0x10C6))
    return (np.concatenate((short.ravel(), long.ravel())),
            np.concatenate((np.repeat(few, BANDS), np.repeat(many, LONG_BANDS))))


def _least(hashes: np.ndarray, line: np.ndarray, lines: int, bins: int) -> np.ndarray:
    """``lines x bins``: the least hash that falls into each bin."""
    sig = np.full(lines * bins, _EMPTY, np.uint64)
    bin_ = ((hashes >> _u(32)) * _u(bins) >> _u(32)).astype(np.int64)
    np.minimum.at(sig, line * bins + bin_, hashes)        # uniform within a bin
    return sig.reshape(lines, bins)


def _keys(sig: np.ndarray, rows: int, bands: int) -> np.ndarray:
    bins = rows * bands
    row, at = np.nonzero(sig == _EMPTY)
    sig = np.where(sig == _EMPTY, _EMPTY, rolling.mix(sig + _u(0x51ED)))
    filled = sig.copy()
    turn = 0
    while len(row):
        turn += 1
        look = (rolling.mix((at * 1_000_003 + turn).astype(np.uint64)) % _u(bins)).astype(np.int64)
        got = sig[row, look]
        ok = got != _EMPTY
        filled[row[ok], at[ok]] = rolling.mix(got[ok] + _u(turn))
        row, at = row[~ok], at[~ok]
    keys = np.zeros((len(sig), bands), np.uint64)
    for r in range(rows):
        keys = rolling.mix(keys * _u(31) + filled[:, r::rows])
    return rolling.mix(keys + np.arange(bands, dtype=np.uint64) * _u(0x9E3779B97F4A7C15))


def _rows():
    def run(batches):
        for b in batches:
            out = []
            for d, k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                for i, line in enumerate(text.split("\n")):
                    line = normal(line)
                    if line:
                        out.append((d, k, i, *line_hash(line)))
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                names=["doc_id", "k", "line", "node", "check"])
    return run


def _bands(parts: int, apart: frozenset):
    def run(batches):
        met = set()
        values, owners = [], []

        def send(lines, nodes):
            node = np.array(nodes, np.int64)
            for at, end in _cut([LONG_ROWS * LONG_BANDS + len(x) for x in lines]):
                keys, line = line_keys(lines[at:end])
                values.append(keys)
                owners.append(node[at:end][line])
            value, owner = np.concatenate(values), np.concatenate(owners)
            values.clear()
            owners.clear()
            return packed.deal(value, owner, np.zeros(len(owner), np.uint8), parts, short=True)

        for b in batches:
            lines, nodes, size = [], [], 0
            for text in b.column(0).to_pylist():
                for line in text.split("\n"):
                    line = normal(line)
                    node = node_of(line, apart)
                    if line and node not in met:
                        if len(met) == MET:
                            met.clear()           # it only saves work
                        met.add(node)
                        lines.append(line)
                        nodes.append(node)
                        size += len(line)
                        if size >= BLOCK:
                            yield send(lines, nodes)
                            lines, nodes, size = [], [], 0
            if lines:
                yield send(lines, nodes)
    return run


def _fine_bands(parts: int):
    def run(batches):
        for b in batches:
            nodes, lines = b.column(0).to_numpy(), b.column(1).to_pylist()
            for at, end in _cut([FINE_ROWS * FINE_BANDS + len(x) for x in lines]):
                keys = band_keys(lines[at:end], FINE_ROWS, FINE_BANDS)
                node = np.repeat(nodes[at:end], FINE_BANDS)
                yield packed.deal(keys.ravel(), node, np.zeros(len(node), np.uint8), parts, short=True)
    return run


def _texts():
    """The lines asked for: one row per wanted line of each document."""
    def run(batches):
        for b in batches:
            nodes, bodies = [], []
            for text, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                lines = text.split("\n")
                nodes += [w["node"] for w in wanted]
                bodies += [normal(lines[w["line"]]) for w in wanted]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sizes(bodies), pa.int64()), pa.array(bodies, pa.string())],
                                             names=["node", "n", "body"])
    return run


def _linked(num: int, den: int):
    """``a, b, link`` of pairs of lines, by the exact Jaccard of their shingles."""
    def run(batches):
        for b in batches:
            nx, ny, both = overlaps(b.column("x").to_pylist(), b.column("y").to_pylist())
            link = both * den >= (nx + ny - both) * num
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(link)], names=["a", "b", "link"])
    return run


def _expand(lines: Column) -> Column:
    @F.pandas_udf("array<long>")
    def sets(batch: pd.Series) -> pd.Series:
        return batch.map(lambda x: tokens(x).view(np.int64))
    return sets(lines)


def _compare(joined: DataFrame) -> DataFrame:
    return joined.select("a", "b", "x", "y").mapInArrow(_linked(NUM, DEN), "a long, b long, link boolean")


def near_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3,
               small: int = 1000) -> DataFrame:
    """One row per line with a word: ``doc_id, k, line`` (number from 0),
    ``component`` and ``kept``.

    Lines are near when the sets of their 5-character shingles (case and white
    space apart) have Jaccard 0.8 or more; of each component of near lines the
    first stays: least doc_id (nulls last), then line number.  Blank lines take
    no part.  Null text is empty; of repeated rows the first of one stays; an
    empty table gives no rows.
    """
    base = keyed(docs, id_col, text_col)
    n = partitions(docs)
    rows = materialize(base.mapInArrow(_rows(), "doc_id long, k long, line int, node long, check long"), "line-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "line", "k"))
    rows, apart = part_clashes(rows, "line-rows")
    nodes = materialize(rows.groupBy("node").agg(first.alias("first"), F.count("*").alias("copies")), "line-nodes")
    dealt = base.select("text").mapInArrow(_bands(4 * n, apart), packed.SCHEMA)
    buckets = materialize(packed.shared(dealt, n).select("bucket", "node"), "line-buckets")
    wanted = (nodes.join(buckets.select("node").distinct(), "node")
              .select("first.doc_id", "first.k", F.struct("first.line", "node").alias("w"))
              .groupBy("doc_id", "k").agg(F.collect_list("w").alias("wanted")))       # at most a text's lines
    bodies = (join_rows(base, wanted).select("text", "wanted")
              .mapInArrow(_texts(), "node long, n long, body string"))
    bodies = materialize(bodies, "line-texts")
    if bodies.count() > bodies.select("node").distinct().count():
        bodies = materialize(bodies.dropDuplicates(["node"]), "line-texts")

    def finer(members):
        return packed.shared(members.mapInArrow(_fine_bands(4 * n), packed.SCHEMA), n).select("bucket", "node")
    part = link_components(buckets, bodies, NUM, DEN, rounds, small, _expand, FEW, True, _compare, finer)
    # a line that occurs once and links with none leads itself: only the others are looked up
    several = part.groupBy("component").agg(F.count("*").alias("m")).where("m > 1").select("component")
    linked = materialize(part.join(several, "component").join(nodes, "node").select("node", "component", "first"), "line-linked")
    lead = linked.groupBy("component").agg(F.min("first").alias("lead"))
    lead = linked.join(lead, "component").select("node", "component", "lead")
    again = (nodes.where("copies > 1").join(linked.select("node"), "node", "left_anti")
             .select("node", F.col("node").alias("component"), F.col("first").alias("lead")))
    lead = materialize(lead.unionByName(again).withColumnRenamed("node", "_node"), "line-leads")
    here = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "line", "k")
    return (rows.join(lead, F.col("node") == F.col("_node"), "left")
            .select("doc_id", "k", "line", F.coalesce("component", "node").alias("component"),
                    (F.col("lead").isNull() | here.eqNullSafe(F.col("lead"))).alias("kept")))


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_lines`` (with a word), ``n_dropped``
    and ``dropped`` (their numbers, ascending)."""
    base = keyed(docs, id_col, text_col).select("doc_id", "k")
    lines = (near_lines(docs, id_col, text_col).groupBy("doc_id", "k")
             .agg(F.size(F.collect_set("line")).alias("n_lines"),          # one pass, where countDistinct takes two
                  F.array_sort(F.collect_set(F.when(~F.col("kept"), F.col("line")))).alias("dropped")))
    return (join_rows(base, lines, "left")
            .select("doc_id", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
                    F.size(F.coalesce("dropped", F.array().cast("array<int>"))).cast("long").alias("n_dropped"),
                    F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped")))


def drop_near_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the dropped lines cut from the text, other columns as they were."""
    gone = (near_lines(docs, id_col, text_col).where("not kept").groupBy("doc_id", "k")
            .agg(F.collect_set("line").alias("gone")))
    row = docs.select(*keyed_columns(id_col, text_col), F.struct("*").alias("row"))
    text = F.expr(f"array_join(filter(split(row.`{text_col}`, '\\n', -1), (x, i) -> not array_contains(gone, i)), '\\n')")
    joined = join_rows(row, gone, "left").withColumn("cut", F.when(F.col("gone").isNull(), F.col(f"row.`{text_col}`")).otherwise(text))
    return joined.select(*[F.col("cut").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def keyed_columns(id_col: str, text_col: str):
    return (F.col(id_col).cast("long").alias("doc_id"),
            F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("k"))
