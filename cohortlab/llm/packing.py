"""Best-fit packing of tokenised documents into fixed-length sequences."""

from __future__ import annotations

import bisect
import json
import os
import struct

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import range_ranked
from cohortlab.plans.guards import materialize

CACHE_BYTES = 24 << 20           # of words and ids in each of the two generations that a task remembers
ENTRY_BYTES = 160                # that an entry takes besides its word and ids
MAX_BROADCAST_RUNS = 200_000
# How a tokenizer's file spells a run of punctuation; ASCII punctuation; letters and digits.
PUNCTUATION_RUN = r"[^\\s\\p{L}\\p{N}]+"
LETTER_RUN = r"[\\p{L}]+"
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
ALNUM = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"

LATIN_END = "\u0250"             # below it every letter is in normal form and no mark combines

_workers: dict = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Ids of texts under a tokenizer that drops white space and never joins
    over it: a text's ids are its words' ids in a row, so each distinct word
    is encoded once.

    Where the tokenizer's own file says that it lowers case, words are told
    apart in lower case; where it says that runs of punctuation stand alone,
    those at a word's end are encoded apart from the rest.  Neither changes an
    id: texts that may hold an added token are left as they are.  Where the file
    says that it only normalises and lowers, and that runs of letters stand
    alone, a word of Latin small letters is one run that both steps leave as it
    is: it goes to the tokenizer's model straight away, its bytes spelt as the
    pre-tokenizer spells them."""

    def __init__(self, path: str):
        # one thread: the tasks of an executor already share its cores
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        self.added = [t["content"].encode().lower() for t in said.get("added_tokens") or []]
        self.lowers = "Lowercase" in json.dumps(said.get("normalizer"))
        self.cuts = PUNCTUATION_RUN in json.dumps(said.get("pre_tokenizer"))
        split = said.get("pre_tokenizer") or {}
        self.direct = (self.lowers and _kinds(said["normalizer"]) <= {"Sequence", "NFC", "Replace", "Lowercase"}
                       and '"Regex": "\\\\s+"' in json.dumps(said["normalizer"])
                       and LETTER_RUN in json.dumps(split) and _kinds(split) <= {"Sequence", "Split", "ByteLevel"}
                       and '"add_prefix_space": true' not in json.dumps(split) and said["model"].get("dropout") is None)
        self.spelling = {}
        if self.direct:
            self.tokenize = self.tokenizer.model.tokenize
            spell = self.tokenizer.pre_tokenizer.pre_tokenize_str
            self.spelling = {c: spell(chr(c))[0][0] for c in range(128, ord(LATIN_END)) if chr(c).isalpha()}
        self.forget()

    def forget(self) -> None:
        """Words are remembered within a task; a reused worker holds the tokenizer alone."""
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.held = 0                # bytes of the young generation, about

    def __call__(self, text: str) -> bytes:
        data = text.encode("utf-8", "replace")
        low = data.lower()           # ASCII letters
        plain = not any(t in low for t in self.added)
        words = (low if plain and self.lowers else data).split()
        here = set(words)
        if self.held > CACHE_BYTES:      # words in use move on, the others fade
            self.young, self.old, self.held = {}, self.young, 0
        cut, whole = [], []
        new = here.difference(self.young)
        self.held += ENTRY_BYTES * len(new) + 3 * sum(map(len, new))
        for w in new:
            ids = self.old.get(w)
            if ids is not None:
                self.young[w] = ids
                continue
            body = w.rstrip(PUNCTUATION) if plain and self.cuts else w
            if len(body) < len(w) and body[-1:] in ALNUM and body:
                cut.append((w, body, w[len(body):]))
            else:
                whole.append(w)
        if cut:
            ends = {x for _, *two in cut for x in two}.difference(self.young)
            whole += ends.difference(whole)
        self._encode(whole)
        for w, body, tail in cut:
            self.young[w] = self.young[body] + self.young[tail]
        return b"".join(map(self.young.__getitem__, words))

    def _encode(self, words: list[bytes]) -> None:
        new = []
        for w in words:
            ids = self.old.get(w)
            if ids is not None:
                self.young[w] = ids
                continue
            run = self._letters(w) if self.direct else None
            if run is None:
                new.append(w)
            else:
                ids = [t.id for t in self.tokenize(run)]
                self.young[w] = struct.pack(f"<{len(ids)}I", *ids)
        if new:
            coded = self.tokenizer.encode_batch_fast([w.decode("utf-8") for w in new], add_special_tokens=False)
            for w, c in zip(new, coded):
                ids = c.ids
                self.young[w] = struct.pack(f"<{len(ids)}I", *ids)


    def _letters(self, word: bytes) -> str | None:
        """A word of Latin small letters as the model reads it, else None."""
        if word.isascii():
            return word.decode() if word.isalpha() and word.islower() else None
        text = word.decode("utf-8")
        if text.isalpha() and max(text) < LATIN_END and text == text.lower():
            return text.translate(self.spelling)
        return None


def _kinds(part: dict) -> set:
    """Names of the steps in a part of a tokenizer's file."""
    inner = part.get("normalizers") or part.get("pretokenizers") or []
    return {part.get("type")}.union(*map(_kinds, inner))


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = 4096, end_id: int = 1,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document's ids,
    cut only where a document is longer than ``capacity``.  Null text is
    empty: its one id is ``end_id``."""
    path = tokenizer or default_tokenizer()
    tail = int(end_id).to_bytes(4, "little")

    def cut(batches):
        import zlib
        if path not in _workers:
            _workers[path] = WordIds(path)
        encode = _workers[path]
        encode.forget()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = encode(text or "") + tail
                for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((doc_id, i, at // 4, len(part) // 4, zlib.crc32(part)))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})
        encode.forget()

    # ids travel as text so that nulls do not turn them into floats
    return (docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInPandas(_typed(cut), "doc_id long, piece int, start long, length long, ids_crc32 long"))


def _typed(cut):
    def run(batches):
        def read():
            for b in batches:
                b["doc_id"] = pd.array([None if x is None else int(x) for x in b["doc_id"]], dtype="Int64")
                yield b
        yield from cut(read())
    return run


def best_fit(histogram: list[tuple[int, int]], capacity: int) -> list[tuple]:
    """Rounds of best-fit over runs of equal lengths, longest first.

    Each round takes one length with all its documents and sweeps the gaps
    upwards from the successor of that length; documents claim gaps in rank
    order, claimed gaps shrink, and what is left opens sequences.  Equal
    documents and equal gaps are runs, so a round handles them at once; the
    result is that of best-fit-decreasing one by one.

    Returns rows ``(length, rank_from, count, first_sequence, width, offset)``:
    the j-th document of the run goes to sequence ``first + j % width`` at
    ``offset + (j // width) * length``.
    """
    gaps: dict[int, list] = {}       # gap -> runs (first sequence, count)
    sizes: list[int] = []            # the gaps, ascending
    runs, opened, rank = [], 0, 0

    def add(gap, first, count):
        if gap and count:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(sizes, gap)
            gaps[gap].append((first, count))

    def fill(length, n, first, width, gap):
        """n documents into `width` sequences of this gap; gives what stays over."""
        nonlocal rank
        each = gap // length
        whole = min(width, n // each)
        if whole:
            runs.append((length, rank, whole * each, first, whole, capacity - gap))
            rank += whole * each
            add(gap - each * length, first, whole)
            n -= whole * each
        if n and whole < width:      # the last one is filled in part
            runs.append((length, rank, n, first + whole, 1, capacity - gap))
            rank += n
            add(gap - n * length, first + whole, 1)
            whole, n = whole + 1, 0
        return n, whole

    for length, n in sorted(histogram, reverse=True):
        rank = 0
        while n:
            at = bisect.bisect_left(sizes, length)
            if at == len(sizes):
                break
            gap = sizes.pop(at)
            taken, left = gaps.pop(gap), []
            for first, width in taken:
                used = 0
                if n:
                    n, used = fill(length, n, first, width, gap)
                if used < width:
                    left.append((first + used, width - used))
            for first, width in left:
                add(gap, first, width)
        if n:
            each = capacity // length
            width = -(-n // each)
            fill(length, n, opened, width, capacity)
            opened += width
    return runs


def pack(docs: DataFrame, capacity: int = 4096, tokenizer: str | None = None, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` per piece.

    The pieces are range-sorted by length, which gives every piece its rank
    among its equals.  Lengths are whole numbers up to ``capacity``, so the
    table of lengths and counts has at most ``capacity`` rows whatever the
    input; the sweeps run on it, and the resulting runs are joined back to the
    pieces by length and rank.

    Null or empty text is one ``end_id``; null ids pass through; repeated rows
    are packed each; an empty table gives no rows.
    """
    # written first: the range sort reads its input twice, once for its splitters
    cut = materialize(pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pack-tokens")
    cut = range_ranked(cut,
                       [F.col("length").desc(), F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], "pack-pieces")
    found = cut.groupBy("length").agg(F.count("*").alias("n"), F.min("rank").alias("at"))
    found = [tuple(r) for r in found.select("length", "n", "at").collect()]    # at most `capacity` rows
    spark = docs.sparkSession
    starts = spark.createDataFrame([(int(x), int(at)) for x, _, at in found], "len long, at long")
    runs = best_fit([(x, n) for x, n, _ in found], capacity)
    schema = "len long, rank_from long, count long, first long, width long, base long"
    plan = spark.createDataFrame([tuple(map(int, r)) for r in runs], schema).join(F.broadcast(starts), "len")
    if len(runs) <= MAX_BROADCAST_RUNS:
        plan = F.broadcast(plan)
    j = F.col("rank") - F.col("at") - F.col("rank_from")
    return (cut.join(plan, (F.col("length") == F.col("len")) & (j >= 0) & (j < F.col("count")))
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("first") + j % F.col("width")).alias("sequence_id"),
                    (F.col("base") + F.floor(j / F.col("width")).cast("long") * F.col("length")).alias("offset")))
