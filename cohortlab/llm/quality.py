"""Quality rules: compression bands beside a few counted rules.

One pass over the text, no shuffle: each Arrow batch of texts is measured in
the task that read it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_bytes long, ratio double, chunk_share double, base_failed boolean, kept boolean")
# Characters of the symbol rule and white space.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
ASCII = bytes(range(128))
SHORT = bytes(range(0xE0))      # what no letter of three bytes and more starts with


@dataclass(frozen=True)
class Bands:
    """Limits of raw size / zstd size by UTF-8 length: the first row whose
    length bound exceeds the text's holds.  A null limit does not judge.

    From the least and the most that documents passing the base rules reach
    in each row (English, German, French and Spanish; whole texts and chunks),
    with a margin of 10 % below and 12 % above.  Letters of two bytes compress
    better, by up to 1.42 when such texts are written in Cyrillic or Greek, so
    the upper limit widens with the share of bytes above 127; the lower one
    with that of letters of three bytes and more, which are not measured.
    """
    limits: tuple = ((256, None, 1.8), (512, 1.2, 2.1), (1024, 1.25, 2.4), (2048, 1.45, 2.7), (4096, 1.65, 2.9),
                     (8192, 1.8, 3.0), (16384, 1.95, 3.1), (65536, 2.0, 3.25), (None, 2.0, 3.4))
    wider: tuple = (0.3, 0.5)       # at a share of 1: down and up
    chunk: int = 4096               # bytes; chunks are judged by the same rows
    bad_chunk_share: float = 0.15   # of the bytes in chunks outside their band, at most
    level: int = 3
    min_words: int = 50
    max_repeat_percent: int = 50
    extra: dict = field(default_factory=dict)

    def inside(self, raw: bytes, ratio: float) -> bool:
        share = len(raw.translate(None, ASCII)) / len(raw)
        long = min(1.0, 3 * len(raw.translate(None, SHORT)) / len(raw))
        for bound, low, high in self.limits:
            if bound is None or len(raw) < bound:
                return ((low is None or ratio >= low * (1 - self.wider[0] * long))
                        and (high is None or ratio <= high * (1 + self.wider[1] * share)))
        return True


def repeated_words(words: list) -> int:
    """Words that lie in a 3-word window occurring at least twice."""
    import numpy as np
    n = len(words)
    if n < 4:
        return 0
    ids: dict = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    if len(ids) == n:
        return 0
    v = len(ids)
    if v >= 2_000_000:           # three codes no longer fit 63 bits: renumber the pairs first
        _, pair = np.unique(code[:-1] * v + code[1:], return_inverse=True)
        window = pair[:-1].astype(np.int64) * v + code[2:]
    else:
        window = (code[:-2] * v + code[1:-1]) * v + code[2:]
    ordered = np.sort(window)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return 0
    hit = np.isin(window, twice)
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= hit
    return int(covered.sum())


def measure(text: str | None, bands: Bands, compressor) -> tuple:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()          # bytes split at exactly the six ASCII white-space characters
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    repeat = repeated_words(words)
    base_failed = len(words) < bands.min_words or 100 * repeat > bands.max_repeat_percent * len(words)
    ratio, share = None, 0.0
    kept = not base_failed
    if raw:
        ratio = len(raw) / len(compressor.compress(raw))
        bad = 0
        if len(raw) > bands.chunk:
            for at in range(0, len(raw), bands.chunk):
                piece = raw[at:at + bands.chunk]
                if not bands.inside(piece, len(piece) / len(compressor.compress(piece))):
                    bad += len(piece)
        share = bad / len(raw)
        kept = kept and bands.inside(raw, ratio) and share <= bands.bad_chunk_share
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeat, len(raw), ratio, share, base_failed, kept)


def judged(text: Column, bands: Bands | None = None) -> Column:
    """Struct of the measures and the verdict ``kept`` of a text column."""
    bands = bands or Bands()

    @F.pandas_udf(SCHEMA)
    def rules(texts: pd.Series) -> pd.DataFrame:
        import zstandard
        compressor = zstandard.ZstdCompressor(level=bands.level)
        rows = [measure(t, bands, compressor) for t in texts]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return rules(text)


def quality(docs: DataFrame, bands: Bands | None = None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, the base counts, ``ratio`` (raw over
    compressed bytes; null for an empty text), ``chunk_share`` (bytes in chunks
    outside their band), ``base_failed`` and ``kept``.

    Null text counts as empty and fails the base rules (no words).  Repeated
    rows are judged alike; an empty table gives no rows; other columns of
    ``docs`` play no part, nulls in ``doc_id`` pass through.
    """
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), judged(F.col(text_col), bands).alias("q"))
            .select("doc_id", "q.*"))


def keep_good(docs: DataFrame, bands: Bands | None = None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they were."""
    row = docs.select(F.struct("*").alias("row"))
    return (row.withColumn("verdict", judged(F.col(f"row.`{text_col}`"), bands)["kept"])
            .where("verdict").select("row.*"))
