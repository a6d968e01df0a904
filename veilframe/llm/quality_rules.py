"""Quality rules: compression bands.

zstandard ratios over the whole document and over fixed chunks reject repetitive
(high ratio) or incompressible (low ratio) text. Limits depend on the length,
because short text compresses worse than long text of the same kind; so has the size of
a chunk, and a text too short for the smallest chunk is one chunk itself. Each row is
judged alone inside one Arrow batch, so the operator needs no shuffle, and the
lost work of an executor is simply redone.

Defined results: a null text counts as empty; an empty text has ratio 0 and fails
the base rule; repeated rows and null ids are judged like any others; an empty
table gives an empty table; further columns pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_SEPARATORS, free_name

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean,"
    " whole_ratio double, chunks long, bad_chunks long, verdict string, kept boolean"
)

COLUMNS = [c.split()[0] for c in SCHEMA.split(",")]


@dataclass(frozen=True)
class Bands:
    """Limits of the ratio raw bytes / compressed bytes.

    whole: (bytes below which the band holds, least ratio, most ratio), in order;
    the last band has no upper length. Rounded limits, set on labelled documents
    so that good text stays inside at every length.
    """

    level: int = 3
    whole: tuple[tuple[int | None, float, float], ...] = (
        (64, 0.5, 1.2),
        (128, 0.7, 1.4),
        (256, 0.9, 1.7),
        (512, 1.1, 1.8),
        (1024, 1.2, 2.03),
        (2048, 1.3, 2.2),
        (4096, 1.4, 2.3),
        (8192, 1.5, 2.4),
        (16384, 1.5, 2.5),
        (65536, 1.5, 2.6),
        (None, 1.5, 2.8),
    )
    #: (bytes from which on a text is cut so, bytes of a chunk, least ratio, most ratio), longest first.
    chunks: tuple[tuple[int, int, float, float], ...] = (
        (4096, 4096, 1.25, 2.33),
        (1024, 1024, 1.25, 2.08),
        (256, 256, 1.0, 1.8),
    )
    bad_share: float = 0.34
    min_words: int = 10
    repeat_percent: int = 20

    @property
    def chunk_bytes(self) -> int:
        """Bytes of a chunk of a long text."""
        return self.chunks[0][1]


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows of so many words that are found twice or more, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    key, span = code[:n], len(ids)
    for k in range(1, window):
        key = key * len(ids) + code[k : k + n]
        span *= len(ids)
        if span > 2**62 // max(len(ids), 1):
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            span = n
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[back] > 1)
    if not len(starts):
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.strip(WORD_SEPARATORS)]
    return len(lines) - len(set(lines))


def measure(text: str | None, bands: Bands, compressor) -> tuple:
    """The measures of one text, in the order of SCHEMA."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    word_bytes = raw.translate(None, WORD_SEPARATORS)
    word_chars = len(text or "") - (len(raw) - len(word_bytes))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    repeats = repeated_words(words)
    failed = len(words) < bands.min_words or 100 * repeats > bands.repeat_percent * len(words)
    ratio = len(raw) / len(compressor.compress(raw)) if raw else 0.0
    least, most = next((lo, hi) for limit, lo, hi in bands.whole if limit is None or len(raw) < limit)
    chunks, low, high = [raw], least, most
    for from_bytes, step, low_of, high_of in bands.chunks:
        if len(raw) >= from_bytes:
            # Full chunks only, as a band holds for one length; the last one is aligned to the end, so that no byte is left out.
            chunks, low, high = [raw[i : i + step] for i in range(0, len(raw) - step + 1, step)], low_of, high_of
            if len(raw) % step:
                chunks.append(raw[-step:])
            break
    rates = [len(c) / len(compressor.compress(c)) if c else 0.0 for c in chunks]
    bad = sum(not low <= r <= high for r in rates)
    if failed:
        verdict = "base"
    elif ratio > most:
        verdict = "repetitive"
    elif ratio < least:
        verdict = "incompressible"
    elif bad > bands.bad_share * len(chunks):
        verdict = "chunks"
    else:
        verdict = "keep"
    return len(words), word_chars, symbols, duplicate_lines(raw), repeats, failed, ratio, len(chunks), bad, verdict, verdict == "keep"


def quality_measures(text: Column | str, bands: Bands = Bands()) -> Column:
    """A struct with the measures and the verdict of a text column."""

    @F.pandas_udf(SCHEMA)
    def judge(texts: pd.Series) -> pd.DataFrame:
        compressor = zstandard.ZstdCompressor(level=bands.level)
        rows = [measure(t, bands, compressor) for t in texts]
        return pd.DataFrame(rows, columns=COLUMNS)

    return judge(F.col(text) if isinstance(text, str) else text)


def quality_rules(docs: DataFrame, text: str = "text", bands: Bands = Bands()) -> DataFrame:
    """docs with one more struct column, `quality` (or `_quality` if that is taken)."""
    return docs.withColumn(free_name(docs, "quality"), quality_measures(text, bands))


def keep_good(docs: DataFrame, text: str = "text", bands: Bands = Bands()) -> DataFrame:
    """The rows that the rules keep, with the columns of docs."""
    name = free_name(docs, "quality")
    return quality_rules(docs, text, bands).where(F.col(f"`{name}`.kept")).drop(name)
