"""Benchmark decontamination: word windows of the documents against a
broadcast hash set of the test items' windows, verified word by word.

The items are cut into segments of bounded length, and the segments are dealt
into blocks whose windows and bytes fit a bound that is checked before anything
is broadcast.  A usual benchmark is one block and the documents are read once,
without a shuffle; a larger one is scanned block by block, and what the blocks
hit is joined per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortlab.llm import rolling
from cohortlab.llm.common import join_rows, text_of
from cohortlab.plans.guards import materialize

WINDOW = 10                   # words
SEGMENT = 4096                # windows of an item kept together
SEGMENT_BYTES = 1 << 20       # its words end there (but for the last window's)
MAX_BYTES = 64 << 20          # of a block: its words, and 24 bytes for each window
SLICE = 1 << 20               # bytes hashed at a time
GROUP = 1 << 20               # bytes of documents handled together

_u = np.uint64
# Word bytes: digits, letters and all bytes of characters beyond ASCII.
IS_WORD = np.zeros(256, np.int8)
IS_WORD[128:] = 1
for _first, _last in ("09", "AZ", "az"):
    IS_WORD[ord(_first):ord(_last) + 1] = 1
_lower = np.arange(256)
_lower[65:91] += 32
LOWER_BYTE = rolling.BYTE[_lower]
PLACE = _u(0x9E3779B97F4A7C15)
SCATTER = _u(0xD6E8FEB86659FD93)


# --- words and windows

def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and hash of every word; A-Z count as a-z.  Bytes are
    hashed with their place in the word and added up, so a word may run over
    any number of slices."""
    got, open_ = [], None                       # open_: first byte and sum of a word that goes on
    for at in range(0, len(data), SLICE):
        part = data[at:at + SLICE]
        inside = IS_WORD[part]
        edge = np.diff(inside, prepend=np.int8(0), append=np.int8(0))
        first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        size = end - first
        start = first + at
        if open_ is not None:
            if len(first) and first[0] == 0:
                start[0] = open_[0]
            else:
                got.append((np.array([open_[0]]), np.array([at]), np.array([open_[1]], np.uint64)))
                open_ = None
        if not len(first):
            continue
        cells = np.flatnonzero(inside)
        place = (cells + at - np.repeat(start, size)).astype(np.uint64)
        value = (LOWER_BYTE[part[cells]] ^ (place * PLACE)) * SCATTER
        value ^= value >> _u(32)
        total = np.add.reduceat(value * SCATTER, np.cumsum(size) - size)
        if open_ is not None:
            total[:1] += open_[1]
            open_ = None
        end = end + at
        if end[-1] == at + len(part) and end[-1] < len(data):
            open_ = (int(start[-1]), total[-1])
            start, end, total = start[:-1], end[:-1], total[:-1]
        got.append((start, end, total))
    if not got:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    start, end, total = (np.concatenate(x) for x in zip(*got))
    return start, end, rolling.mix(total + (end - start).astype(np.uint64))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` words in a row."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = words[:n] * rolling.BYTE[0]
    for i in range(1, size):
        total = total + words[i:n + i] * rolling.BYTE[i]
    return rolling.mix(total + _u(size))


def normal_words(data: bytes) -> list[bytes]:
    start, end, _ = words_of(np.frombuffer(data, np.uint8))
    low = data.lower()                          # ASCII letters only
    return [low[a:z] for a, z in zip(start.tolist(), end.tolist())]


# --- the test items

def _segments(size: int):
    def cut(words):
        if len(words) <= size:
            yield words
            return
        at, windows = 0, len(words) - size + 1
        while at < windows:
            end, held = at, 0
            while end < windows and end - at < SEGMENT and held < SEGMENT_BYTES:
                held += len(words[end])
                end += 1
            yield words[at:end + size - 1]
            at = end

    def run(batches):
        for b in batches:
            rows = [(item, " ".join(w.decode() for w in s), max(1, len(s) - size + 1))
                    for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                    for s in cut(normal_words(text)) if s]
            cols = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64()))],
                                             names=["item", "words", "windows"])
    return run


class Windows:
    """A block's windows: hashes by length, and where each stands in which segment."""

    def __init__(self, segments: list[tuple[str | None, str]], size: int):
        self.size = size
        self.items = [item for item, _ in segments]
        self.words = [words.encode() for _, words in segments]
        found: dict[int, list] = {}
        self.starts = []                        # of each segment's words
        for i, data in enumerate(self.words):
            start, end, hashes = words_of(np.frombuffer(data, np.uint8))
            length = min(size, len(start))
            h = window_hashes(hashes, length)
            found.setdefault(length, []).append((h, np.full(len(h), i, np.int32), np.arange(len(h), dtype=np.int32)))
            self.starts.append(np.append(start, len(data) + 1).astype(np.int32))
        self.by_length = {}
        for length, parts in found.items():
            h, segment, word = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(h, kind="stable")
            bits = min(26, max(16, int(len(h)).bit_length() + 4))
            seen = np.zeros(1 << bits, bool)
            seen[h >> _u(64 - bits)] = True
            self.by_length[length] = (h[order], segment[order], word[order], _u(64 - bits), seen)

    def hits(self, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows whose hash the block has, and the range of its places."""
        h, _, _, shift, seen = self.by_length[length]
        maybe = np.flatnonzero(seen[hashes >> shift])
        low, high = (np.searchsorted(h, hashes[maybe], side=s) for s in ("left", "right"))
        real = low < high
        return maybe[real], low[real], high[real]

    def holders(self, text: bytes, length: int, low: int, high: int) -> frozenset | None:
        """Ids of the items with just this window, None where there is none."""
        _, segment, word, _, _ = self.by_length[length]
        out, met = set(), False
        for s, w in zip(segment[low:high].tolist(), word[low:high].tolist()):
            starts = self.starts[s]
            if self.words[s][starts[w]:starts[w + length] - 1] == text:
                met = True
                if self.items[s] is not None:
                    out.add(self.items[s])
        return frozenset(out) if met else None


def benchmark_blocks(bench: DataFrame, size: int = WINDOW, max_bytes: int = MAX_BYTES, item_col: str = "item_id",
                     text_col: str = "text") -> list[list[tuple]]:
    """The items' segments dealt into blocks of at most ``max_bytes``, each of
    them collected only when this has been measured."""
    rows = bench.select(F.col(item_col).cast("string").alias("item"), F.encode(text_of(text_col), "UTF-8").alias("text"))
    parts = materialize(rows.mapInArrow(_segments(size), "item string, words string, windows long").distinct(), "bench-segments")
    cost = F.octet_length("words") + 24 * F.col("windows")
    total, largest = parts.agg(F.sum(cost), F.max(cost)).first()
    if total is None:
        return []
    if largest > max_bytes:
        raise ValueError(f"a window of the benchmark takes more than {max_bytes} bytes")
    n = -(-total // max_bytes)
    while True:
        dealt = parts.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(n)))
        if dealt.groupBy("block").agg(F.sum(cost).alias("c")).agg(F.max("c")).first()[0] <= max_bytes:
            break
        n *= 2
    return [[tuple(r) for r in dealt.where(F.col("block") == i).select("item", "words").collect()] for i in range(n)]


# --- the documents

FOUND = "n_words long, n_hit long, items array<string>, runs array<struct<first:long,last:long,start:long,end:long>>"
_FOUND = [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
          ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("first", "last", "start", "end")])))]
NOTHING = (0, 0, [], [])


def find(texts: list[bytes], windows: Windows) -> list[tuple]:
    """For each text its words, those in a window of the block, the items with
    such windows and the maximal runs of those words (numbers and bytes, ends
    exclusive but for ``last``)."""
    data = b"\0".join(texts)                    # no word crosses from text to text
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    start, end, hashes = words_of(np.frombuffer(data, np.uint8))
    text_of_word = np.searchsorted(begin, start, side="right") - 1
    n_words = np.bincount(text_of_word, minlength=len(texts))
    edge = np.zeros(len(start) + 1, np.int64)
    items: dict[int, set] = {}
    low_data, known = None, {}
    for length in windows.by_length:
        at, low, high = windows.hits(window_hashes(hashes, length), length)
        inside = text_of_word[at] == text_of_word[at + length - 1] if len(at) else np.zeros(0, bool)
        for i, lo, hi in zip(at[inside].tolist(), low[inside].tolist(), high[inside].tolist()):
            low_data = low_data or data.lower()
            text = b" ".join(low_data[a:z] for a, z in zip(start[i:i + length].tolist(), end[i:i + length].tolist()))
            if text not in known:
                known[text] = windows.holders(text, length, lo, hi)
            if known[text] is None:
                continue
            edge[i] += 1
            edge[i + length] -= 1
            items.setdefault(int(text_of_word[i]), set()).update(known[text])
    hit = np.cumsum(edge[:-1]) > 0
    out = [(int(n), 0, [], []) for n in n_words]
    if not hit.any():
        return out
    # a run ends with its text, too
    step = np.diff(np.where(hit, text_of_word + 1, 0), prepend=0, append=0)
    cuts = np.flatnonzero(step)
    first_word = np.cumsum(n_words) - n_words
    for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if hit[a]:
            t = int(text_of_word[a])
            n, held, _, runs = out[t]
            runs.append({"first": a - int(first_word[t]), "last": z - 1 - int(first_word[t]),
                         "start": int(start[a] - begin[t]), "end": int(end[z - 1] - begin[t])})
            out[t] = (n, held + z - a, sorted(items.get(t, ())), runs)
    return out


def _scan(block, size: int):
    """Adds :data:`FOUND` to the columns of batches whose last column is the text (UTF-8)."""
    def run(batches):
        windows = block.value
        for b in batches:
            texts, found, at = b.column(b.num_columns - 1).to_pylist(), [], 0
            while at < len(texts):
                end, held = at, 0
                while end < len(texts) and (held < GROUP or end == at):
                    held += len(texts[end])
                    end += 1
                found += find(texts[at:end], windows)
                at = end
            cols = list(zip(*found)) if found else [[]] * len(_FOUND)
            yield pa.RecordBatch.from_arrays(list(b.columns[:-1]) + [pa.array(c, t) for c, (_, t) in zip(cols, _FOUND)],
                                             names=b.schema.names[:-1] + [n for n, _ in _FOUND])
    return run


def _merge(batches):
    """One list of items and runs from those of several blocks."""
    for b in batches:
        rows = []
        for doc_id, k, n_words, items, runs in zip(*(c.to_pylist() for c in b.columns)):
            merged = []
            for r in sorted((r for many in runs for r in many), key=lambda r: (r["first"], r["last"])):
                if merged and r["first"] <= merged[-1]["last"] + 1:
                    if r["last"] > merged[-1]["last"]:
                        merged[-1] |= {"last": r["last"], "end": r["end"]}
                else:
                    merged.append(dict(r))
            rows.append((doc_id, k, n_words, sum(r["last"] - r["first"] + 1 for r in merged),
                         sorted(set().union(*items)), merged))
        cols = list(zip(*rows)) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64()] + [t for _, t in _FOUND])],
                                         names=["doc_id", "k"] + [n for n, _ in _FOUND])


def scan(docs: DataFrame, bench: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text", max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row per document: ``doc_id, k, n_words, n_hit, items, runs``.

    Words are runs of letters, digits and characters beyond ASCII, A-Z as a-z.
    A window is ``size`` words of an item in a row; an item of fewer, but not
    none, is one window.  ``n_hit``: words in any occurrence of a window;
    ``items``: ids (as strings, sorted) of the items with such a window;
    ``runs``: maximal runs of such words, by number and by byte.

    Null texts have no words; an item without words asks nothing, one without
    an id counts in ``n_hit`` and is not listed; repeated items are one,
    repeated rows are scanned each; empty tables give no rows or no hits; other
    columns are left out.
    """
    return _scanned(docs, bench, size, id_col, text_col, item_col, item_text, max_bytes, False)


def _scanned(docs, bench, size, id_col, text_col, item_col, item_text, max_bytes, whole: bool) -> DataFrame:
    """:func:`scan`, with the rows of ``docs`` as they are in ``row`` where ``whole`` says so."""
    text = F.encode(text_of(text_col), "UTF-8").alias("text")
    key = [F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("k")]
    rows = docs.select(*key, *([F.struct("*").alias("row")] if whole else []), text)
    blocks = benchmark_blocks(bench, size, max_bytes, item_col, item_text) or [[]]

    def passed(rows, block):
        found = StructType(rows.schema.fields[:-1] + StructType.fromDDL(FOUND).fields)
        return rows.mapInArrow(_scan(docs.sparkSession.sparkContext.broadcast(Windows(block, size)), size), found)

    if len(blocks) == 1:
        return passed(rows, blocks[0])
    hits = None
    for block in blocks:
        one = materialize(passed(rows.select("doc_id", "k", "text"), block).where("n_hit > 0"), "bench-hits")
        hits = one if hits is None else hits.unionByName(one)
    merged = (hits.groupBy("doc_id", "k").agg(F.max("n_words").alias("n_words"), F.collect_list("items").alias("items"),
                                              F.collect_list("runs").alias("runs"))        # a text's own hits
              .mapInArrow(_merge, "doc_id long, k long, " + FOUND).drop("n_words"))
    return (join_rows(passed(rows, []).drop("n_hit", "items", "runs"), merged, "left")
            .withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")),
                          "items": F.coalesce("items", F.array().cast("array<string>")),
                          "runs": F.coalesce("runs", F.array().cast(FOUND.split("runs ")[1]))}))


def contamination(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """Per document ``doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated``; see :func:`scan`."""
    found = scan(docs, bench, **options)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def drop_documents(docs: DataFrame, bench: DataFrame, max_share: float = 0.0, size: int = WINDOW, id_col: str = "doc_id",
                   text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                   max_bytes: int = MAX_BYTES) -> DataFrame:
    """``docs`` without those of which more than ``max_share`` of the words lie
    in windows of the benchmark; columns as they were, whatever their names."""
    found = _scanned(docs, bench, size, id_col, text_col, item_col, item_text, max_bytes, True)
    return found.where((F.col("n_hit") == 0) | (F.col("n_hit") <= max_share * F.col("n_words"))).select("row.*")


def remove_spans(docs: DataFrame, bench: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", max_bytes: int = MAX_BYTES) -> DataFrame:
    """``docs`` with the runs of benchmark words cut from the texts (from the
    first byte of a run's first word to its last word's end); all else as it was."""
    rows = _scanned(docs, bench, size, id_col, text_col, item_col, item_text, max_bytes, True)
    data, runs = F.encode(F.col(f"row.`{text_col}`"), "UTF-8"), F.col("runs")
    # what lies between one run's end and the next one's start
    at = F.concat(F.array(F.lit(0).cast("long")), runs["end"])
    till = F.concat(runs["start"], F.array(F.octet_length(data).cast("long")))
    kept = F.transform(F.arrays_zip(at.alias("a"), till.alias("z")),
                       lambda x: F.decode(F.substring(data, (x["a"] + 1).cast("int"), (x["z"] - x["a"]).cast("int")), "UTF-8"))
    cut = F.when(F.size(runs) == 0, F.col(f"row.`{text_col}`")).otherwise(F.array_join(kept, ""))
    return rows.select(*[cut.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
