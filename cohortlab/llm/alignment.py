"""Alignment of two tokenizers' tokens over the same bytes, and how often
their tokens are linked in the corpus.

Both tokenizers give a text's bytes back, so their tokens are two rising arrays
of end offsets.  Where both arrays hold the same offset, a group of tokens
ends.  Most groups are one token of each; those stretches are skipped along
the diagonal: at the current shift between the indices, blocks of doubling
length are compared as bytes, and the first difference is found by halving.
There the two indices step apart until the ends meet again, which gives one
irregular group and the new shift.
"""

from __future__ import annotations

import gc
import json
import os
import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.plans.guards import materialize, salted_lookup_join

CACHE_WORDS = 150_000         # words in each of the two generations that a task remembers, some 400 bytes each
TEXTS = 1 << 20               # characters of texts handled together
MAX_PAIRS = 1_000_000         # id pairs whose counts are broadcast, 24 bytes each
FLUSH_PAIRS = 500_000         # pairs that a task counts before it passes them on
SHIFT = 32                    # an id pair is one long: first id << SHIFT | second id
MARK = "▁"               # how pieces spell a space
# The characters of Unicode's property White_Space.
WHITE = "\t\n\v\f\r \x85\xa0                　"
UNSAFE = [" " + c for c in WHITE + MARK] + [MARK + " "]
CUT = re.compile(rf"(?<=[^ {MARK}])(?= [^\s{MARK}])")

JOINS = re.compile(r" \S").match          # such a word may follow another in a text of a tokenizer that joins

_vocabularies: dict = {}      # per worker; as large as the two tokenizers' files


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary spells each byte with: printable
    bytes as themselves, the others as the letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE in a ``tokenizers`` file.  ``local``: cutting a text
    before a space that a visible character follows changes no token, which
    holds for the usual split (a run of white space leaves its last space to the
    word) without a normaliser or added tokens that hold a space."""

    joins = True              # one long text is faster than many words

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # the tasks of an executor already share its cores
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        letters = _byte_letters()
        added = {t["id"]: t for t in said.get("added_tokens") or []}
        n = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.bytes = []
        for i in range(n):
            token = self.tokenizer.id_to_token(i) or ""
            self.bytes.append(token.encode() if i in added else bytes(letters[c] for c in token))
        split = said.get("pre_tokenizer") or {}
        plain = all(t.get("special") and " " not in t["content"] and not t["lstrip"] and not t["rstrip"] for t in added.values())
        self.local = (said.get("normalizer") is None and plain and split.get("type") == "ByteLevel"
                      and split.get("use_regex", True) and not split.get("add_prefix_space"))

    def ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts, each of which begins with the space put before it."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """A ``sentencepiece`` model that puts the space before a text itself.
    ``local``: no piece holds a space after a visible character, so no merge
    crosses one; nothing else looks across words."""

    joins = False

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes, self.local = [], True
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes.append(bytes([int(piece[3:5], 16)]))
                continue
            self.bytes.append(piece.replace(MARK, " ").encode())
            bare = piece.strip(MARK)
            if MARK in bare or (bare and (piece.startswith(2 * MARK) or piece.endswith(MARK))):
                self.local = False
        # a text that the model would change (spaces dropped, say) is left whole
        self.local = self.local and self.model.decode(self.model.encode("a  b c")) == "a  b c"

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode([t[1:] for t in texts], num_threads=1)


class Vocabularies:
    def __init__(self, first: str, second: str):
        self.both = [ByteLevel(first) if first.endswith(".json") else Pieces(first),
                     ByteLevel(second) if second.endswith(".json") else Pieces(second)]
        self.local = all(v.local for v in self.both)
        self.sizes = [np.array([len(b) for b in v.bytes], np.int64) for v in self.both]
        self.names = []       # an id's decimals and what follows: within a group, at its end
        for v, end in zip(self.both, "|;"):
            self.names.append(np.array([[f"{i}," for i in range(len(v.bytes))],
                                        [f"{i}{end}" for i in range(len(v.bytes))]], object))


def irregular_groups(ends_a: np.ndarray, ends_b: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Groups of more than one token on a side: ``(first a, last a, first b,
    last b)``; between them the tokens are one to one.  Both arrays (int64)
    rise and end alike."""
    a, b = ends_a.tolist(), ends_b.tolist()
    raw_a, raw_b = ends_a.tobytes(), ends_b.tobytes()
    n, i, j, out = len(a), 0, 0, []
    while i < n:
        if a[i] == b[j]:
            step = 1                       # probe the diagonal: blocks of doubling length
            i, j = i + 1, j + 1
            while i < n and raw_a[8 * i:8 * (i + step)] == raw_b[8 * j:8 * (j + step)]:
                i, j, step = i + step, j + step, 2 * step
            if i >= n:
                break
            while step > 1:                # the first difference, by halving
                step //= 2
                if raw_a[8 * i:8 * (i + step)] == raw_b[8 * j:8 * (j + step)]:
                    i, j = i + step, j + step
            if i >= n:
                break
        i0, j0 = i, j
        x, y = a[i], b[j]
        while x != y:                      # apart: the shorter side steps on
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        out.append((i0, i, j0, j))
        i, j = i + 1, j + 1
    return out


def _closing(n: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """1 for the tokens that end a group: all but those inside irregular groups."""
    edge = np.zeros(n + 1, np.int8)
    edge[first] += 1                       # groups do not meet, so no index comes twice on a side
    edge[last] -= 1
    return 1 - np.cumsum(edge[:n], dtype=np.int8)


@dataclass
class Aligned:
    """``closing``: for each side, whether a token ends a group; ``names``: the
    tokens in the order of the groups as text, each with what follows it;
    ``pairs``: the id pair of every link, and ``link_ends``: where its bytes end."""
    closing: tuple[np.ndarray, np.ndarray]
    names: list[str]
    pairs: np.ndarray
    link_ends: np.ndarray


def align(ids_a: np.ndarray, ids_b: np.ndarray, of: Vocabularies) -> Aligned:
    ends_a, ends_b = np.cumsum(of.sizes[0][ids_a]), np.cumsum(of.sizes[1][ids_b])
    odd = np.array(irregular_groups(ends_a, ends_b), np.int64).reshape(-1, 4)
    close_a = _closing(len(ids_a), odd[:, 0], odd[:, 1])
    close_b = _closing(len(ids_b), odd[:, 2], odd[:, 3])
    # groups before each token, then each group's size on the other side, give every token its place
    group_a = np.cumsum(close_a, dtype=np.int64) - close_a
    group_b = np.cumsum(close_b, dtype=np.int64) - close_b
    upto_a, upto_b = np.flatnonzero(close_a) + 1, np.flatnonzero(close_b) + 1       # tokens up to a group's end
    before_b = np.concatenate(([0], upto_b))
    out = np.empty(len(ids_a) + len(ids_b), object)
    out[np.arange(len(ids_a)) + before_b[group_a]] = of.names[0][close_a, ids_a]
    out[np.arange(len(ids_b)) + upto_a[group_b]] = of.names[1][close_b, ids_b]
    # a link for every stretch between two ends next to each other
    ends = np.concatenate((ends_a, ends_b))
    order = np.argsort(ends, kind="stable")
    ends, is_a = ends[order], order < len(ids_a)
    before_a = np.cumsum(is_a) - is_a
    first = np.concatenate(([True], ends[1:] != ends[:-1]))
    at_a = before_a[first]
    at_b = (np.arange(len(ends)) - before_a)[first]
    pairs = (ids_a[at_a].astype(np.int64) << SHIFT) | ids_b[at_b].astype(np.int64)
    return Aligned((close_a, close_b), out.tolist(), pairs, ends[first])


class Parts:
    """Tokens and groups of a text's parts.  Where both tokenizers are local, a
    text is cut before its words' spaces: tokens of both end there, so groups
    do, and what a word gives is the same in every text.  Each distinct word is
    encoded and aligned once (the new words of some texts together, as one long
    array of ends); elsewhere a part is a whole text.

    A part's record: tokens of each, groups, groups as text, id pairs (bytes);
    None where a tokenizer does not give the part's bytes back."""

    def __init__(self, both: Vocabularies):
        self.of = both
        self.young: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}

    def cut(self, text: str) -> list[str]:
        """Parts of a text that begins with a space."""
        if not self.of.local:
            return [text]
        if text[-1] == " " or any(pair in text for pair in UNSAFE):
            return CUT.split(text)
        return [" " + w for w in text[1:].split(" ")]

    def texts(self, texts: list[str]) -> list[list[tuple | None]]:
        """Records of the parts of space + text, for each text."""
        parts = [self.cut(" " + t) for t in texts]
        here = set().union(*parts)
        if len(self.young) + len(here) > CACHE_WORDS:          # words in use move on, the others fade
            self.young, self.old = {}, self.young
        new = []
        for w in here.difference(self.young):
            if w in self.old:
                self.young[w] = self.old[w]
            else:
                new.append(w)
        if new:
            self._learn(new)
        return [list(map(self.young.__getitem__, p)) for p in parts]

    def _encoded(self, v, sizes: np.ndarray, words: list[str], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words' ids in a row, and where each word's begin and end."""
        if self.of.local and v.joins and all(map(JOINS, words)):
            # one after the other they are one text, cut again where they end
            ids = np.array(v.ids(["".join(words)])[0], np.uint32)
            edge = np.searchsorted(np.cumsum(sizes[ids]), ends, side="right")
        else:
            listed = v.ids(words)
            ids = np.fromiter(chain.from_iterable(listed), np.uint32)
            edge = np.cumsum(np.fromiter(map(len, listed), np.int64, len(listed)))
        return ids, np.concatenate(([0], edge))

    def _learn(self, new: list[str]) -> None:
        data = [w.encode() for w in new]
        ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))
        flat, edges = [], []
        for v, sizes in zip(self.of.both, self.of.sizes):
            ids, edge = self._encoded(v, sizes, new, ends)
            if b"".join(map(v.bytes.__getitem__, ids.tolist())) != b"".join(data):
                if len(new) > 1:
                    for w in new:              # one by one: each may be at fault
                        self._learn([w])
                else:
                    self.young[new[0]] = None
                return
            flat.append(ids)
            edges.append(edge)
        got = align(*flat, self.of)
        groups = np.diff(np.concatenate(([0], np.cumsum(got.closing[0], dtype=np.int64)))[edges[0]])
        name = (edges[0] + edges[1]).tolist()
        link = (8 * np.concatenate(([0], np.searchsorted(got.link_ends, ends, side="right")))).tolist()
        raw, names = got.pairs.tobytes(), got.names
        counts = zip(np.diff(edges[0]).tolist(), np.diff(edges[1]).tolist(), groups.tolist())
        for k, (w, (a, b, g)) in enumerate(zip(new, counts)):
            self.young[w] = (a, b, g, "".join(names[name[k]:name[k + 1]]), raw[link[k]:link[k + 1]])


ALIGNED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs array<long>, times array<int>")


def _aligned(first: str, second: str):
    import hashlib

    def of_text(records):
        n_a, n_b, groups, said, pairs = zip(*records)
        pairs = np.frombuffer(b"".join(pairs), np.int64)
        distinct, times = np.unique(pairs, return_counts=True)
        said = "".join(said)[:-1]
        return (sum(n_a), sum(n_b), sum(groups), len(pairs), hashlib.sha256(said.encode()).hexdigest(), distinct, times)

    def run(batches):
        if (first, second) not in _vocabularies:
            _vocabularies[first, second] = Vocabularies(first, second)
        of = _vocabularies[first, second]
        parts = Parts(of)
        gc.disable()                           # millions of small records, none in a circle
        for b in batches:
            texts = b.column(2).to_pylist()
            found, at = [], 0
            while at < len(texts):             # so many characters at a time, one text at least
                end, size = at, 0
                while end < len(texts) and (size < TEXTS or end == at):
                    size += len(texts[end])
                    end += 1
                full = [t for t in texts[at:end] if t]
                whole = None
                for t, records in zip(full, parts.texts(full) if full else []):
                    if None in records:        # the parts' bytes may differ and the text's not
                        whole = whole or Parts(of)
                        whole.cut = lambda text: [text]
                        records = whole.texts([t])[0]
                        whole.young.clear()
                    found.append(None if None in records else of_text(records))
                at = end
            found = iter(found)
            got = [(next(found) if t else None) or (0, 0, 0, 0, "", (), ()) for t in texts]
            cols = list(zip(*got)) if got else [[]] * 7
            types = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)] + [pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
        gc.enable()
    return run


def _count(batches):
    """Documents per pair, a task's part first."""
    def send(parts):
        pairs, counts = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])

    held, size = [], 0
    for b in batches:
        values = b.column(0).flatten().to_numpy()
        held.append(values)
        size += len(values)
        if size >= FLUSH_PAIRS:
            yield send(held)
            held, size = [], 0
    if size:
        yield send(held)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: how many rows of ``aligned`` hold an id pair linked,
    and whether that is the most of any pair with its first id."""
    counts = aligned.select("pairs").mapInArrow(_count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "align-counts")
    first = F.shiftright("pair", SHIFT).alias("first")
    most = counts.groupBy(first).agg(F.max("n").alias("most"))
    return (counts.join(most, F.shiftright("pair", SHIFT) == F.col("first"))
            .select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def _score(table):
    """Sums over a document's links; pairs that the broadcast table does not hold are passed on."""
    def run(batches):
        pairs, n, best = table.value
        for b in batches:
            row, listed, times = b.columns
            offsets = listed.offsets.to_numpy()
            value, many = listed.values.to_numpy()[offsets[0]:offsets[-1]], times.values.to_numpy()[offsets[0]:offsets[-1]]
            owner = np.repeat(np.arange(len(row)), np.diff(offsets))
            spot = np.minimum(np.searchsorted(pairs, value), max(len(pairs) - 1, 0))
            known = pairs[spot] == value if len(pairs) else np.zeros(len(value), bool)
            links = np.where(known, many, 0).astype(np.int64)
            total, top = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
            if len(pairs):
                np.add.at(total, owner, links * n[spot])
                np.add.at(top, owner, links * best[spot])
            left = np.concatenate(([0], np.cumsum(np.bincount(owner[~known], minlength=len(row))))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(top), pa.array(total), pa.ListArray.from_arrays(pa.array(left), pa.array(value[~known])),
                 pa.ListArray.from_arrays(pa.array(left), pa.array(many[~known]))],
                names=["row", "n_best", "count_sum", "pairs", "times"])
    return run


def align_documents(docs: DataFrame, first: str | None = None, second: str | None = None, id_col: str = "doc_id",
                    text_col: str = "text", max_pairs: int = MAX_PAIRS) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256``.

    ``first`` and ``second`` are files of a byte-level BPE (``.json``) or of a
    ``sentencepiece`` model, over the bytes of a space and the text.  A link is
    a token of each whose bytes overlap; a pair of ids counts in as many
    documents as hold it linked.  ``n_best``: links of pairs that are the most
    frequent of their first id (ties included); ``count_sum``: the sum of the
    pairs' counts over the links; ``groups_sha256``: hash of
    ``a1,a2|b1;a3|b2,b3``, the ids of each group.

    The frequent pairs' counts, at most ``max_pairs``, are broadcast; the others
    are joined by pair.  Null and empty texts, and texts whose tokens do not
    give the bytes back, have zeros, an empty string and count in no pair;
    null ids pass through; repeated rows count each; an empty table gives no
    rows; other columns are left out.
    """
    if first is None or second is None:
        first, second = (x or y for x, y in zip((first, second), default_tokenizers()))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    aligned = materialize(rows.mapInArrow(_aligned(first, second), ALIGNED), "align-documents")
    counts = materialize(pair_counts(aligned), "align-pairs")
    least = 0                          # pairs above it are broadcast
    while counts.where(F.col("n") > least).count() > max_pairs:
        least = max(1, 10 * least)
    table = counts.where(F.col("n") > least).toPandas().sort_values("pair")       # at most max_pairs rows
    table = docs.sparkSession.sparkContext.broadcast(tuple(table[c].to_numpy(np.int64) for c in ("pair", "n", "best")))
    scored = aligned.select("row", "pairs", "times").mapInArrow(
        _score(table), "row long, n_best long, count_sum long, pairs array<long>, times array<int>")
    if least:
        scored = materialize(scored, "align-scored")
        rare = counts.where(F.col("n") <= least).select(F.col("pair").alias("_pair"), "n", "best")
        each = scored.select("row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times"))))
        more = (salted_lookup_join(each, rare, "pair", "_pair", salt_from=["row"], count_col="n")
                .groupBy(F.col("row").alias("_row"))
                .agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("b"), F.sum(F.col("times") * F.col("n")).alias("c")))
        scored = (scored.join(more, F.col("row") == F.col("_row"), "left")
                  .select("row", (F.col("n_best") + F.coalesce("b", F.lit(0))).alias("n_best"),
                          (F.col("count_sum") + F.coalesce("c", F.lit(0))).alias("count_sum")))
    sums = scored.select(F.col("row").alias("_row"), "n_best", "count_sum")
    return (aligned.join(sums, F.col("row") == F.col("_row"))
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
