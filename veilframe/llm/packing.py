"""Best-fit packing with variable capacities.

Documents are packed into sequences of a few permitted lengths. Items are taken in
decreasing size; each goes to the open bin that it fills best, whatever that bin's
capacity. If none has room, every permitted length that holds the item is tried against
the histogram of the sizes that are left: the bin is filled in thought with the largest
that fit, and the length whose bin, downsized to what it would hold, costs least per
token is opened. So the lengths are chosen jointly and anew as the histogram empties. At
last each bin is downsized to the shortest permitted length that holds its contents. A
group is also packed with each length alone, and the cheapest of these packings is taken,
so that the result never costs more than best fit with one capacity.

Only ids and sizes are shuffled. Items are dealt by a hash into groups of about
`group_tokens` tokens, each packed alone in bounded memory; with thousands of items a
group loses next to nothing against one global packing. Equal rows are counted first and
dealt in parts, so that copies of one row do not gather. The groups depend on the items
only, so a lost task gives the same bins again.

Sizes: words `[^\\x20\\x09-\\x0D]+` plus one end mark. A text longer than the longest
length is cut into pieces of that length, all of which are packed.

Defined results: null and empty texts hold their end mark only (size 1); null ids and
repeated rows are packed like others, each of them; ties go to the smaller id, then the earlier
piece; an empty table gives no bins. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, copies

SPACES = " \t\n\x0b\x0c\r"
BINS = "group_id long, bin_id int, capacity int, used int, n_items int, doc_ids array<long>, pieces array<int>, starts array<long>, ends array<long>"


@dataclass(frozen=True)
class Lengths:
    """Permitted lengths, ascending, and what one sequence of a length costs.

    A sequence costs its tokens, a part that grows with the square of its length
    (attention), and a fixed part.
    """

    permitted: tuple[int, ...] = (512, 1024, 2048, 4096, 8192)
    square: float = 1 / 65536
    fixed: float = 48.0

    def cost(self, length: int) -> float:
        return length + self.square * length * length + self.fixed

    def holding(self, used: int) -> int:
        """The shortest permitted length that holds so many tokens."""
        return next(c for c in self.permitted if c >= used)


def filled(room: int, counts: np.ndarray, sizes: int) -> int:
    """Tokens that a bin with so much room takes of the sizes left, largest first; sizes: bit r is set if one of size r is left."""
    start = room
    while room:
        fits = sizes & ((1 << (room + 1)) - 1)
        if not fits:
            break
        size = fits.bit_length() - 1
        take = min(int(counts[size]), room // size)
        room -= take * size
        sizes &= ~(1 << size)
    return start - room


def fill(sizes: Sequence[int], lengths: Lengths, opening: tuple[int, ...] | None = None) -> list[list[int]]:
    """Item numbers of each bin; sizes in decreasing order. opening: the lengths to choose from where one holds the item."""
    longest = lengths.permitted[-1]
    opening = lengths.permitted if opening is None else opening
    room: list[list[int]] = [[] for _ in range(longest + 1)]  # open bins by what is left in them
    open_at = 0  # bit r is set if a bin has r left
    bins: list[list[int]] = []
    counts = np.bincount(np.asarray(sizes, np.int64), minlength=longest + 1)
    present = sum(1 << int(s) for s in np.flatnonzero(counts))
    for item, size in enumerate(sizes):
        size = int(size)
        counts[size] -= 1
        if not counts[size]:
            present ^= 1 << size
        fits = open_at >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            at = room[left].pop()
            if not room[left]:
                open_at ^= 1 << left
            bins[at].append(item)
            left -= size
        else:
            can = [c for c in opening if c >= size] or [next(c for c in lengths.permitted if c >= size)]
            best = can[0]
            if len(can) > 1:
                rates = []
                for c in can:
                    used = size + filled(c - size, counts, present)
                    rates.append((lengths.cost(lengths.holding(used)) / used, c))
                best = min(rates)[1]
            at = len(bins)
            bins.append([item])
            left = best - size
        if left:
            room[left].append(at)
            open_at |= 1 << left
    return bins


def pack(sizes: Sequence[int], lengths: Lengths = Lengths()) -> list[tuple[int, list[int]]]:
    """(capacity, item numbers) of each bin; sizes in decreasing order, none over the longest length."""
    cheapest = None
    for opening in (None, *((c,) for c in lengths.permitted)):
        bins = fill(sizes, lengths, opening)
        sized = [(lengths.holding(sum(int(sizes[i]) for i in items)), items) for items in bins]
        cost = sum(lengths.cost(c) for c, _ in sized)
        if cheapest is None or cost < cheapest[0] - 1e-9:
            cheapest = (cost, sized)
    return cheapest[1]


def count_words(text: Column) -> Column:
    """Words of a text column; null has none."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(bare.isNull() | (bare == ""), F.lit(0)).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+")))


def best_fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lengths: Lengths = Lengths(), group_tokens: int = 1_000_000) -> DataFrame:
    """One row for each bin, with the ids, pieces and word ranges that it holds."""
    longest = lengths.permitted[-1]
    text = F.col(text_col).cast("string")
    scratch = Scratch(docs.sparkSession)
    sized = docs.select(F.col(id_col).cast("long").alias("id"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"), (count_words(text) + 1).cast("long").alias("size"))
    sized = scratch.write(copies(sized, 4096), "sizes")
    total = sized.agg(F.coalesce(F.sum(F.col("size") * F.col("copies")), F.lit(0))).first()[0]
    groups = max(1, -(-total // group_tokens))
    piece = F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(longest).cast("long")))
    items = sized.select("id", "crc", "size", "copies", "copy_part", piece.alias("piece", "start"))
    items = items.withColumn("end", F.least(F.col("start") + longest, "size"))
    items = items.withColumn("group_id", F.pmod(F.xxhash64("id", "crc", "piece", "copy_part"), F.lit(groups)))

    def pack_group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.loc[np.repeat(np.arange(len(rows)), rows["copies"].to_numpy())]
        size = (rows["end"] - rows["start"]).to_numpy()
        ids = rows["id"].to_numpy(dtype=object)
        number = np.array([-1 if pd.isna(i) else int(i) for i in ids], np.int64)
        order = np.lexsort((rows["piece"].to_numpy(), number, -size))
        size, starts, ends, pieces = size[order], rows["start"].to_numpy()[order], rows["end"].to_numpy()[order], rows["piece"].to_numpy()[order]
        ids = [None if pd.isna(i) else int(i) for i in ids[order]]
        out = []
        for at, (capacity, inside) in enumerate(pack(size, lengths)):
            take = lambda x: [x[i] for i in inside]  # noqa: E731, B023
            out.append((int(key[0]), at, capacity, int(size[inside].sum()), len(inside), take(ids), take(pieces.tolist()), take(starts.tolist()), take(ends.tolist())))
        return pd.DataFrame(out, columns=[c.split()[0] for c in BINS.split(", ")])

    return items.select("group_id", "id", "copies", "piece", "start", "end").groupBy("group_id").applyInPandas(pack_group, BINS)
