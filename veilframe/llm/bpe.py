"""Byte-level BPE encoding and decoding by overlapping chunks.

A text is cut into chunks that overlap. Each chunk is pre-tokenised alone, so chunks
can be handled in any order; where the boundaries of a chunk and its successor agree
inside the overlap, the two are stitched. The pre-token pattern never looks back, so
from a common boundary on both tokenisations are the same. The stitched pieces are
then merged by rank. Decoding concatenates the raw bytes of the ids.

Each row is encoded alone within Arrow batches: no shuffle, and memory is bounded by
the longest text plus a bounded cache of pieces.

Defined results: a null text is encoded as the empty text (no ids); null or empty ids
decode to no bytes; ties do not occur (ranks are unique); extra columns pass through
untouched, and a name that is taken is refused; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

CHUNK = 1 << 16
OVERLAP = 1 << 10
CACHE = 120_000
#: Rows of an output batch; bounds what a worker holds.
SLICE = 256


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _boundaries(pieces: list[str], start: int) -> np.ndarray:
    """Where pieces begin, and at last where they end."""
    return start + np.concatenate(([0], np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))))


def pretokenise(text: str, pattern, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[str]:
    """The pre-tokens of text, from overlapping chunks stitched where they agree."""
    if len(text) <= chunk + overlap:
        return pattern.findall(text)
    starts = range(0, len(text), chunk)
    cut = [pattern.findall(text, s, min(len(text), s + chunk + overlap)) for s in starts]
    done, at = [], 0  # pieces so far, and where they end
    for k, s in enumerate(starts):
        edges = _boundaries(cut[k], s)
        here = int(np.searchsorted(edges, at))
        if here >= len(edges) or edges[here] != at:
            # The boundaries did not meet inside the overlap: go on from where the text is tokenised.
            pieces = pattern.findall(text, at, min(len(text), s + chunk + overlap)) if at < s + chunk + overlap else []
            edges, here = _boundaries(pieces, at), 0
        else:
            pieces = cut[k]
        if k + 1 == len(starts):
            done += pieces[here:]
            break
        # The last pieces may reach past the chunk's end: leave what touches it.
        safe = len(pieces) - 2
        follows = set(_boundaries(cut[k + 1], starts[k + 1]).tolist())
        stop = here
        while stop < safe and not (edges[stop] >= starts[k + 1] and int(edges[stop]) in follows):
            stop += 1
        done += pieces[here:stop]
        at = int(edges[stop]) if len(edges) > stop else at
    return done


class Pieces(dict):
    """Piece -> ids, bounded: a missing piece is merged, and kept while there is room."""

    def __init__(self, merge):
        self.merge = merge

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = tuple(self.merge(piece.encode("utf-8")))
        if len(self) < CACHE:
            self[piece] = ids
        return ids


class Codec:
    """Ids of texts and bytes of ids, with a bounded cache of pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.pieces = Pieces(tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._encode_single_piece)
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token

    def encode(self, text: str | None, chunk: int = CHUNK, overlap: int = OVERLAP) -> np.ndarray:
        pieces = pretokenise(text or "", self.pattern, chunk, overlap)
        return np.fromiter(chain.from_iterable(map(self.pieces.__getitem__, pieces)), np.int32)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())) if ids is not None else b""


class BytePairs:
    """Operators for one rank file.

    path: the rank file, read on the driver (under 1 MB; broadcast once).
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self.shared = spark.sparkContext.broadcast({"ranks": load_ranks(path)})
        self.pattern = pattern

    def encode(self, df: DataFrame, text: str = "text", into: str = "ids", decoded: str | None = None, drop_text: bool = False) -> DataFrame:
        """df with a column of token ids, array<int>; with `decoded`, also the ids' raw bytes, binary."""
        shared, pattern = self.shared, self.pattern
        carried = [c for c in df.columns if not (drop_text and c == text)]
        taken = {c.lower() for c in carried}
        for name in filter(None, (into, decoded)):
            if name.lower() in taken:
                raise ValueError(f"column {name} is taken; choose another name")
        schema = df.select(*[f"`{c}`" for c in carried]).schema
        schema = StructType([*schema.fields, StructField(into, ArrayType(IntegerType())), *([StructField(decoded, BinaryType())] if decoded else [])])

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codec = _codec(shared, pattern)
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    part = batch.slice(at, SLICE)
                    rows = [codec.encode(t) for t in part.column(text).to_pylist()]
                    ends = np.cumsum([0, *map(len, rows)])
                    arrays = [part.column(c) for c in carried]
                    arrays.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rows))))
                    if decoded:
                        arrays.append(pa.array([codec.decode(r) for r in rows], pa.binary()))
                    yield pa.RecordBatch.from_arrays(arrays, [*carried, into, *([decoded] if decoded else [])])

        return df.mapInArrow(encode, schema)

    def decode(self, ids: Column | str) -> Column:
        """The raw bytes of an array<int> column, binary."""
        shared, pattern = self.shared, self.pattern

        @F.pandas_udf("binary")
        def bytes_of(rows: pd.Series) -> pd.Series:
            codec = _codec(shared, pattern)
            return pd.Series([codec.decode(r) for r in rows], dtype=object)

        return bytes_of(F.col(ids) if isinstance(ids, str) else ids)


def _codec(shared, pattern: str) -> Codec:
    """One codec for each worker process and rank table, kept on the broadcast value."""
    table = shared.value
    if table.get("codec", (None, None))[0] != pattern:
        table["codec"] = (pattern, Codec(table["ranks"], pattern))
    return table["codec"][1]
