"""MinHash near-duplicates: one permutation, optimal densification, star-shaped candidates.

1. A document's words (A-Z lower-cased) give its set of distinct shingles, as 64-bit
   hashes. Equal sets are one class, stood for by the smallest id, so that groups of
   exact copies cost one row from here on.
2. One-permutation hashing: the leading bits of a shingle's hash choose one of `bins`
   bins and the smallest hash of each bin is kept. Empty bins borrow from the bin that
   a fixed random probe sequence meets first (optimal densification).
3. `rows` successive bins make a band; classes with an equal band share a bucket.
4. Star-shaped edges: each bucket links its members with one hub only, the member that
   shares most buckets, so candidate pairs are linear in the bucket entries.
5. Edges are confirmed on the full sets, never on the sketch, and contracted to
   components.
6. A bucket whose members are still in different components may hide a link that its hub
   did not see. All its members take part in an exact search: shingles are ordered by the
   number of these sets that hold them, rarest first, and two sets can only be similar
   enough if they share one among the first n - ceil(n * percent / 100) + 1 of either
   (prefix filter) at places that leave room for the overlap wanted (position filter).
   Both filters are bounds, not estimates, so no link is lost; what passes is confirmed
   on the full sets. Under one shingle the sets outside its largest component meet all
   others in blocks of bounded size; pairs of one component are never looked at.

Band buckets find a pair of similarity 0.8 with probability 1 - (1 - 0.8^4)^32, over
0.9999999. Buckets, hubs and edges are shuffled as numbers; texts only of classes that
share a bucket. Whatever is counted of a bucket, class or shingle is written down before
the rows meet it again, so that a hot key makes a join of two plain shuffles, which Spark
splits where it is skewed.

Defined results: null and empty texts and texts without words have an empty set, are
linked with nothing and are kept. A text with fewer words than a shingle is one shingle.
Rows with a null id take no part: component null, kept. Repeated ids are one vertex: all
sets of an id are linked, whatever their similarity, and all its rows get one component.
An empty table gives an empty table. Only the id and the text are read, so other columns
cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, WorkerScratch, lower_words_of, slices
from .components import components

U64 = np.uint64
EMPTY = U64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Sketch:
    """width: words of a shingle; percent: least similarity; bins = bands * rows, a power of two."""

    width: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4
    probes: int = 512
    block: int = 1024

    @property
    def bins(self) -> int:
        return self.bands * self.rows


class WordHashes(dict):
    """Word -> 64-bit hash, bounded."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < 400_000:
            self[word] = value
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def shingle_set(text: str | None, width: int, hashes: WordHashes | None = None) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text; without `hashes` no word is remembered."""
    words = lower_words_of(text)
    if not words:
        return np.zeros(0, U64)
    code = np.fromiter(map(xxhash.xxh3_64_intdigest if hashes is None else hashes.__getitem__, words), U64, len(words))
    width = min(width, len(code))
    n = len(code) - width + 1
    h = np.full(n, U64(width))
    for k in range(width):
        h = mix(h * U64(0x9E3779B97F4A7C15) + code[k : k + n])
    return np.unique(h)


def probe_table(bins: int, probes: int) -> np.ndarray:
    """The bins that an empty bin asks, in order: a fixed hash of (bin, attempt)."""
    at = np.arange(bins, dtype=U64)[:, None] * U64(1 << 20) + np.arange(probes, dtype=U64)[None, :]
    return (mix(at + U64(0x5DEECE66D)) % U64(bins)).astype(np.int64)


def one_permutation(shingles: np.ndarray, bins: int, probes: np.ndarray) -> np.ndarray:
    """Smallest hash of each bin, empty bins filled by optimal densification."""
    at = (shingles >> U64(64 - bins.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    out = np.full(bins, EMPTY)
    out[at[first]] = shingles[first]
    full = np.zeros(bins, bool)
    full[at[first]] = True
    empty = np.flatnonzero(~full)
    if not len(empty):
        return out
    source = np.empty(len(empty), np.int64)
    left = np.arange(len(empty))
    for a, b in ((0, 8), (8, 64), (64, probes.shape[1])):
        asked = probes[empty[left], a:b]
        hit = full[asked]
        met = hit.any(axis=1)
        source[left[met]] = asked[met, hit[met].argmax(axis=1)]
        left = left[~met]
        if not len(left):
            break
    else:
        # Hardly ever: after all probes the next full bin lends.
        there = np.flatnonzero(full)
        source[left] = there[np.searchsorted(there, empty[left]) % len(there)]
    out[empty] = out[source]
    return out


def _sketches(s: Sketch):
    """mapInArrow: rows (id, th, text) to (id, th) and the set's size n, its 128-bit id hi, lo and band keys (the band in the last bits)."""

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes = probe_table(s.bins, s.probes)
        number = np.arange(s.bands, dtype=U64)
        salt = np.arange(s.bands, dtype=U64) * U64(0xD6E8FEB86659FD93)
        for batch in slices(batches):
            n, hi, lo, bands = [], [], [], []
            for text in batch.column("text"):
                have = shingle_set(text.as_py(), s.width)
                n.append(len(have))
                digest = xxhash.xxh3_128_digest(have.tobytes())
                hi.append(int.from_bytes(digest[:8], "big", signed=True))
                lo.append(int.from_bytes(digest[8:], "big", signed=True))
                if not len(have):
                    bands.append(np.zeros(0, np.int64))
                    continue
                values = one_permutation(have, s.bins, probes).reshape(s.bands, s.rows)
                key = salt.copy()
                for k in range(s.rows):
                    key = mix(key * U64(0x9E3779B97F4A7C15) + values[:, k])
                key = key - key % U64(s.bands) + number
                bands.append(key.view(np.int64))
            columns = [batch.column("id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "th", "n", "hi", "lo", "bands"])

    return sketches


def _close(x: str, y: str, s: Sketch) -> Column:
    """Whether two set sizes allow the similarity at all."""
    return 100 * F.least(x, y) >= s.percent * F.greatest(x, y)


def _confirm(s: Sketch):
    """mapInArrow: rows (a, b, ta, tb), ordered by a, to the links (a, b) that hold on full sets."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, mine = None, None
        for batch in slices(batches):
            keep = np.zeros(batch.num_rows, bool)
            ta, tb = batch.column("ta"), batch.column("tb")
            for i, a in enumerate(batch.column("a").to_pylist()):
                if a != last:
                    last, mine = a, shingle_set(ta[i].as_py(), s.width)
                other = shingle_set(tb[i].as_py(), s.width)
                both = len(np.intersect1d(mine, other, assume_unique=True))
                keep[i] = 100 * both >= s.percent * (len(mine) + len(other) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return confirm


def _shingles(s: Sketch):
    """mapInArrow: rows (v, n, label, text) to a row (v, n, label, g) for each shingle."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            have = [shingle_set(text.as_py(), s.width).view(np.int64) for text in batch.column("text")]
            rows = batch.select(["v", "n", "label"]).take(pa.array(np.repeat(np.arange(len(have)), [len(h) for h in have])))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.concatenate(have))], names=["v", "n", "label", "g"])

    return shingles


def hidden_pairs(members: DataFrame, s: Sketch, scratch: Scratch) -> DataFrame:
    """(a, b): all pairs of different labels among members (v, n, label, text) that the bounds admit."""
    held = scratch.write_mapped(members.select("v", "n", "label", "text"), _shingles(s), "v long, n long, label long, g long", "held")
    counts = held.groupBy("g").agg(F.count("*").alias("df"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    counts = scratch.write(counts.where("df > 1").select("g", "df", (F.col("lo") < F.col("hi")).alias("mixed")), "shared-shingles")
    # Shingles of one set alone come first in every order; only their number matters.
    shared = scratch.write(held.join(counts, "g"), "shared")
    scratch.drop("held")
    alone = F.col("n") - F.count("*").over(Window.partitionBy("v"))
    at = alone + F.row_number().over(Window.partitionBy("v").orderBy("df", "g")) - 1
    prefix = F.col("n") - F.expr(f"(n * {s.percent}L + 99) div 100") + 1
    ranked = shared.withColumn("at", at).where(F.col("at") < prefix).where("mixed").select("g", "v", "n", "label", "at")
    ranked = scratch.write(ranked, "prefixes")
    scratch.drop("shared")
    # Only pairs of different components matter: the sets outside a shingle's largest component meet all sets under it,
    # in blocks, each a join key of its own with a bounded number of rows on both sides.
    parts = ranked.groupBy("g", "label").agg(F.count("*").alias("m"))
    sizes = parts.groupBy("g").agg(F.sum("m").alias("size"), F.max("m").alias("most"), F.max_by("label", "m").alias("major"), F.count("*").alias("labels"))
    sizes = sizes.where("labels > 1").select("g", "major", F.ceil((F.col("size") - F.col("most")) / s.block).cast("int").alias("few"), F.ceil(F.col("size") / s.block).cast("int").alias("all"))
    sizes = scratch.write(sizes, "prefix-sizes")
    met = scratch.write(ranked.join(sizes, "g"), "prefix-groups")
    part = lambda c: F.pmod(F.xxhash64("v"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = met.where("label <> major").select("g", "v", "label", "n", "at", "major", part("few").alias("i"), every("all").alias("j"))
    right = met.select("g", *[F.col(c).alias(f"{c}2") for c in ("v", "label", "n", "at")], every("few").alias("i"), part("all").alias("j"))
    # No more can be shared than this shingle and what either set has behind it.
    most = 1 + F.least(F.col("n") - F.col("at"), F.col("n2") - F.col("at2")) - 1
    pairs = left.join(right, ["g", "i", "j"]).where("label <> label2 and (label2 = major or v < v2)").where(_close("n", "n2", s))
    return pairs.where(100 * most >= s.percent * (F.col("n") + F.col("n2") - most)).select(F.greatest("v", "v2").alias("a"), F.least("v", "v2").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sketch: Sketch = Sketch()) -> DataFrame:
    """id, n_shingles, component_id, kept: one row for each row of docs."""
    s = sketch
    scratch = WorkerScratch(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("th", F.xxhash64("text"))
    sig = scratch.write_mapped(docs.select("id", "th", "text"), _sketches(s), "id long, th long, n long, hi long, lo long, bands array<long>", "sketches")

    # A vertex v is a set; its text is that of its first row (id, th). Written at once, so that v is fixed.
    sets = sig.where("n > 0 and id is not null").groupBy("hi", "lo").agg(F.min(F.struct("id", "th")).alias("of"), F.first("n").alias("n"))
    sets = scratch.write(sets.select(F.monotonically_increasing_id().alias("v"), "hi", "lo", "of.id", "of.th", "n"), "sets")
    bands = sig.where("n > 0 and id is not null").select("id", "th", "hi", "lo", "bands")
    entries = sets.join(bands, ["id", "th", "hi", "lo"]).dropDuplicates(["v"]).select("v", "n", F.explode("bands").alias("k"))
    entries = scratch.write(entries, "entries")
    shared = scratch.write(entries.groupBy("k").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    met = scratch.write(entries.join(shared, "k"), "met")
    scratch.drop("entries")
    degree = scratch.write(met.groupBy("v").agg(F.sum("size").alias("degree")), "degrees")
    # Most shared entries first, equals parted by a hash; one number, so that hubs are found by hash aggregation.
    priority = F.shiftleft(F.least("degree", F.lit((1 << 22) - 1)), 40) + F.xxhash64("v").bitwiseAND((1 << 40) - 1)
    live = scratch.write(met.join(degree, "v").select("k", "v", "n", priority.alias("prio")), "live")
    scratch.drop("met")
    seen = sets.join(degree.select("v"), "v", "left_semi").select("v", "id", "th")
    texts = scratch.write(docs.join(seen, ["id", "th"]).select("v", "text").dropDuplicates(["v"]), "texts")

    def confirmed(edges: DataFrame, name: str) -> DataFrame:
        left = texts.select(F.col("v").alias("a"), F.col("text").alias("ta"))
        right = texts.select(F.col("v").alias("b"), F.col("text").alias("tb"))
        rows = scratch.write(edges.select("a", "b").distinct(), f"{name}-candidates").join(right, "b").join(left, "a")
        return scratch.write_mapped(rows, _confirm(s), "a long, b long", name)

    hubs = scratch.write(live.groupBy("k").agg(F.max_by("v", "prio").alias("a"), F.max_by("n", "prio").alias("na")), "hubs")
    star = live.join(hubs, "k").where("v <> a").where(_close("n", "na", s)).select("a", F.col("v").alias("b"))
    # Sets of one id belong together.
    ids = sig.where("n > 0 and id is not null").join(sets.select("v", "hi", "lo"), ["hi", "lo"]).groupBy("id").agg(F.min("v").alias("b"), F.max("v").alias("top"))
    several = scratch.write(ids.where("b < top").select("id", "b"), "several")
    same = sig.join(several, "id").join(sets.select(F.col("v").alias("a"), "hi", "lo"), ["hi", "lo"]).where("a <> b").select("a", "b").distinct()
    links = scratch.write(confirmed(star, "star").unionByName(same), "links")
    labels = components(links, scratch, "round0")

    # What is left: buckets over several components.
    known = live.join(labels, "v", "left").select("k", "v", "n", F.coalesce("label", "v").alias("label"))
    mixed = scratch.write(known.groupBy("k").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("k"), "mixed")
    members = known.join(mixed, "k").select("v", "n", "label").distinct()
    found = confirmed(hidden_pairs(scratch.write(members, "members").join(texts, "v"), s, scratch), "late-links")
    if not found.isEmpty():
        labels = components(links.union(found), scratch, "round1")
    for name in ("live", "texts", "prefixes", "members"):
        scratch.drop(name)

    reach = scratch.write(sets.join(labels, "v", "left").select("hi", "lo", "id", F.coalesce("label", "v").alias("label")), "reach")
    least = scratch.write(reach.groupBy("label").agg(F.min("id").alias("component_id")), "least")
    label = reach.join(least, "label").select("hi", "lo", "component_id")
    own = F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")))
    return (
        sig.drop("bands", "th")
        .join(label, ["hi", "lo"], "left")
        .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col(id_col), F.lit(True)))
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sketch: Sketch = Sketch()) -> DataFrame:
    """The rows of docs that near_duplicates keeps; of repeated ids every row with a kept id stays."""
    gone = near_duplicates(docs, id_col, text_col, sketch).where(~F.col("kept")).select(F.col(id_col).alias("__gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == F.col("__gone"), "left_anti")
