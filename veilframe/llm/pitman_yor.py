"""LM scoring: a hierarchical Pitman-Yor model of words.

Each context (the word before, whatever its frequency; START) is a restaurant of a
Pitman-Yor process whose parent, shared by all, is the unigram restaurant, whose parent
is uniform over the training words and one unknown. Seating
is sampled by Gibbs in sweeps: all customers of a dish leave and are seated anew, one
after another (in steps of a fixed fraction once hundreds sit), given the parent's
current probabilities; the tables of all restaurants are the parent's customers. A
word's probability is the average of the predictive probabilities of the last sweeps.

How it is distributed:

* Words are counted over all training texts. The `resident` most frequent get a number
  and are broadcast with their exact counts (a fixed bound, about 1 MB for each sweep).
  Every other word is owned by the part of its hash, as a word and as a context.
  `resident` decides where a restaurant lives, never what it holds.
* Word pairs are counted over all training texts. A pair of resident words is dealt by
  the pair's hash, so no frequent word gathers in one task. A pair with one other word
  goes to that word's owner; a pair of two others to both owners. Parts are columns of
  numbers, sorted and compressed.
* A sweep reads the pairs that occur twice or more (a pair seen once has one table) and
  sends back sums of tables for each resident word and context, added up by blocks.
  Owners that share repeated pairs tell each other, after each sweep, the tables of the
  context and the customers and tables of the word, and so seat the pair alike.
* To score, each text sends its distinct pairs to their parts and gets back sums; of a
  pair of two other words it gets both owners' numbers. Pairs so frequent that they would
  crowd a part (over 1 in `hot` of all tokens, so fewer than `hot` pairs, all of resident
  words) are scored at once from a broadcast table.

Random numbers are hashes of the pair, the sweep and the customer, so that every task
that meets a pair seats it alike, also when it is run again.

Defined results: a null text is empty and holds the end token only. Null and repeated
ids are scored like others (a null id's remainder is that of the empty text). Without
training texts every probability is that of the one unknown word, 1. An empty table
gives an empty table. Only id and text are read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fold, lower_words_of
from .minhash import WordHashes, mix

U64 = np.uint64
END_WORD, START_WORD = b"\n", b" "  # no words can be these
ROWS = "part int, kind int, flush long, blob binary"
STATE, MESSAGE, PAIRS, SUMS = range(4)  # kinds of rows between sweeps; the block of sums is in `flush`
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


@dataclass(frozen=True)
class Settings:
    """Bounds and priors. The last `averaged` of `sweeps` samples are averaged."""

    resident: int = 65_536
    sweeps: int = 5
    averaged: int = 3
    strength: float = 5.0
    base_strength: float = 20.0
    hot: int = 8_192
    flush_tokens: int = 1_000_000
    block: int = 16_384


def pack(**arrays) -> bytes:
    """Arrays in one compressed blob; names with a leading `d_` are sorted and stored as differences."""
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps({k: np.diff(v, prepend=v.dtype.type(0)) if k.startswith("d_") else v for k, v in arrays.items()}, protocol=5))


def unpack(blob: bytes) -> dict:
    found = pickle.loads(zstandard.ZstdDecompressor().decompress(blob))  # noqa: S301  written by pack()
    return {k: np.cumsum(v, dtype=v.dtype) if k.startswith("d_") else v for k, v in found.items()}


def small(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the fewest bytes."""
    most = int(x.max(initial=0))
    return x.astype(np.uint8 if most < 256 else np.uint16 if most < 65536 else np.uint32 if most < 2**32 else np.uint64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts."""
    if not len(keys):
        return keys, counts.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def uniform(key: np.ndarray, sweep: int, step: int) -> np.ndarray:
    """In (0, 1), a hash of pair, sweep and customer."""
    salt = mix(np.array([sweep * 1_000_003 + step], U64) + U64(0x51ED270B))
    return ((mix(key ^ salt) >> U64(12)).astype(np.float64) + 0.5) * 2.0**-52


def seat(customers: np.ndarray, weight: np.ndarray, discount: float, key: np.ndarray, sweep: int) -> np.ndarray:
    """Tables of each dish, when its customers are seated anew.

    weight: (strength + discount * tables of the restaurant) * parent's probability,
    against which an occupied dish with k customers at t tables has k - discount * t.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    at = np.flatnonzero(customers > 1)
    n, w, key = customers[at], weight[at], key[at]
    t, k = tables[at].astype(np.float64), 1
    while len(at):
        step = 1 if k < 64 else k // 16
        p = w / (w + k - discount * t)
        u = uniform(key, sweep, k)
        if step == 1:
            t += u < p
        else:
            take = np.minimum(step, n - k)
            mean = take * p
            t += np.clip(np.rint(mean + np.sqrt(mean * (1 - p)) * 0.5513 * np.log(u / (1 - u))), 0, take)
        k += step
        done = n <= k
        if done.any():
            tables[at[done]] = t[done].astype(np.int64)
            left = ~done
            at, n, w, key, t = at[left], n[left], w[left], key[left], t[left]
    return tables


@dataclass
class Counts:
    """What all tasks know: exact totals, and the resident words with their counts."""

    tokens: int
    types: int
    texts: int
    words: np.ndarray  # sorted hashes
    counts: np.ndarray
    base_discount: float

    @property
    def start(self) -> int:
        return len(self.words)

    @property
    def hashes(self) -> np.ndarray:
        """Of each context with a number."""
        return np.append(self.words, U64(WordHashes()[START_WORD]))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each resident word, -1 for others."""
        return _places(self.words, hashes)

    def followed(self) -> np.ndarray:
        """Customers of each context with a number."""
        end = self.numbers(np.array([WordHashes()[END_WORD]], U64))
        own = self.counts.astype(np.float64)
        own[end[end >= 0]] = 0.0
        return np.append(own, float(self.texts))

    @property
    def floor(self) -> float:
        return 1.0 / (self.types + 1)


@dataclass
class Sweep:
    """The state after one sweep: tables of contexts, customers and tables of resident words in the parent."""

    context_tables: np.ndarray
    customers: np.ndarray
    tables: np.ndarray
    all_customers: float
    all_tables: float

    def parent(self, customers, tables, model: Counts, s: Settings):
        """The unigram restaurant's probability of words with so many customers at so many tables."""
        spare = s.base_strength + model.base_discount * self.all_tables
        return (customers - model.base_discount * tables + spare * model.floor) / (s.base_strength + self.all_customers)


def _places(of: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key stands in the sorted `of`, -1 if nowhere."""
    if not len(of):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(of, keys), len(of) - 1)
    return np.where(of[at] == keys, at, -1)


def pair_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The random key of a pair, by the hashes of both words."""
    return mix(mix(context + U64(77)) + word)


def _halves(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (key >> U64(32)).astype(np.int64), (key & U64(0xFFFFFFFF)).astype(np.int64)


def _narrow(part: np.ndarray, parts: int) -> np.ndarray:
    """Part numbers in a type that sorts fast, where they fit."""
    return part.astype(np.uint16 if parts <= 1 << 16 else np.int64)


def dealt(owner: np.ndarray, other: np.ndarray, n: np.ndarray, parts: int):
    """Distinct (owner, other) with sums of n, sorted by the owner's part, owner and other; and where each part begins."""
    by = np.lexsort((other, owner, _narrow(owner % U64(parts), parts)))
    owner, other, n = owner[by], other[by], n[by].astype(np.int64)
    if len(owner):
        at = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (other[1:] != other[:-1]))))
        owner, other, n = owner[at], other[at], np.add.reduceat(n, at)
    return owner, other, n, _cuts((owner % U64(parts)).astype(np.int64), parts)


def _texts(batches: Iterator[pa.RecordBatch], s: Settings):
    """Flushes of texts: (ids, train flags, word hashes of all tokens, tokens of each text)."""
    hashes = WordHashes()
    end = hashes[END_WORD]
    ids, train, sizes, tokens, held = [], [], [], [], 0
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            for i, t, text in zip(part.column("id").to_pylist(), part.column("train").to_pylist(), part.column("text").to_pylist(), strict=True):
                words = lower_words_of(text)
                code = np.fromiter(map(hashes.__getitem__, words), U64, len(words))
                ids.append(i)
                train.append(t)
                sizes.append(len(words) + 1)
                tokens += [code, np.array([end], U64)]
                held += len(words) + 1
                if held >= s.flush_tokens or len(ids) >= 60_000:
                    yield ids, np.array(train), np.concatenate(tokens), np.array(sizes)
                    ids, train, sizes, tokens, held = [], [], [], [], 0
    if ids:
        yield ids, np.array(train), np.concatenate(tokens), np.array(sizes)


def _batch(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    part, kind, flush, blob = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(flush, pa.int64()), pa.array(blob, pa.binary())], ["part", "kind", "flush", "blob"])


def _cuts(part: np.ndarray, parts: int) -> np.ndarray:
    """Where each part begins in sorted part numbers."""
    return np.searchsorted(part, np.arange(parts + 1))


def _count_words(parts: int, s: Settings):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, tokens, _ in _texts(batches, s):
            keys, n = summed(tokens, np.ones(len(tokens), np.int64))
            part = _narrow(keys % U64(parts), parts)
            order = np.argsort(part, kind="stable")
            cut = _cuts(part[order], parts)
            rows = [(p, 0, 0, pack(d_key=keys[order[a:b]], n=small(n[order[a:b]]))) for p, (a, b) in enumerate(zip(cut, cut[1:], strict=False)) if b > a]
            yield _batch(rows)

    return count


def _gather_words(most: int):
    """Totals of a part, and its most frequent words."""

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        found = [unpack(b) for b in rows["blob"]]
        keys, n = summed(np.concatenate([f["d_key"] for f in found]), np.concatenate([f["n"].astype(np.int64) for f in found]))
        top = np.argsort(-n, kind="stable")[:most]
        blob = pack(key=keys[top], n=n[top], total=n.sum(), types=len(n), once=int((n == 1).sum()), twice=int((n == 2).sum()))
        return pd.DataFrame({"blob": [blob]})

    return gather


def _pairs(model: Counts, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each token: the hash of the word before, its number and the token's number (-1 if not resident)."""
    number = model.numbers(tokens)
    first = np.cumsum(sizes) - sizes
    before, ctx = np.empty_like(tokens), np.empty(len(tokens), np.int64)
    before[1:], ctx[1:] = tokens[:-1], number[:-1]
    before[first], ctx[first] = WordHashes()[START_WORD], model.start
    return before, ctx, number


#: Pairs with a word that is not resident: its owner's role, and what the other one is told by.
SIDES = ("word", "context", "out", "in")


def _sides(tokens, before, ctx, number):
    """Tokens of each side as (name, places, owners, others).

    word: a word after a resident context. context: a resident word after it. out, in:
    pairs of two such words, as the context's owner and as the word's owner sees them.
    """
    one, two, both = np.flatnonzero((ctx >= 0) & (number < 0)), np.flatnonzero((ctx < 0) & (number >= 0)), np.flatnonzero((ctx < 0) & (number < 0))
    yield "word", one, tokens[one], ctx[one]
    yield "context", two, before[two], number[two]
    yield "out", both, before[both], tokens[both]
    yield "in", both, tokens[both], before[both]


def _count_pairs(shared, parts: int, s: Settings):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Counts = shared.value["model"]
        for _, _, tokens, sizes in _texts(batches, s):
            before, ctx, number = _pairs(model, tokens, sizes)
            known = (ctx >= 0) & (number >= 0)
            key, n = summed((ctx[known].astype(U64) << U64(32)) | number[known].astype(U64), np.ones(int(known.sum()), np.int64))
            part = _narrow(mix(key) % U64(parts), parts)
            order = np.argsort(part, kind="stable")
            cut = _cuts(part[order], parts)
            sides = {name: dealt(owner, other, np.ones(len(owner), np.int64), parts) for name, _, owner, other in _sides(tokens, before, ctx, number)}
            rows = []
            for p in range(parts):
                a, b = cut[p], cut[p + 1]
                arrays = {}
                for name, (owner, other, m, at) in sides.items():
                    c, d = at[p], at[p + 1]
                    arrays |= {f"d_{name}": owner[c:d], f"{name}_other": small(other[c:d]), f"{name}_n": small(m[c:d])}
                if b > a or any(len(x) for x in arrays.values()):
                    rows.append((p, 0, 0, pack(d_key=key[order[a:b]], n=small(n[order[a:b]]), **arrays)))
            yield _batch(rows)

    return count


def _sums(context: np.ndarray, words: np.ndarray, scalars: list[float], s: Settings) -> list[tuple[int, bytes]]:
    """Dense sums in blocks, for adding up by block."""
    out = [(-1, pack(x=np.array(scalars, np.float64)))]
    for base, x in ((0, context), (1 << 20, words)):
        out += [(base + i, pack(x=x[a : a + s.block])) for i, a in enumerate(range(0, len(x), s.block))]
    return out


def _add(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(unpack(b)["x"] for b in rows["blob"])
    return pd.DataFrame({"block": [int(rows["block"].iloc[0])], "blob": [pack(x=total)]})


def _collect_sums(df: DataFrame, size: int, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context sums, word sums, scalars) of all parts; their size is fixed by the resident bound."""
    got = {r["block"]: unpack(r["blob"])["x"] for r in df.select("block", "blob").groupBy("block").applyInPandas(_add, "block long, blob binary").collect()}
    if not got:
        return np.zeros(size + 1), np.zeros(size), np.zeros(8)
    join = lambda base, n: np.concatenate([got[base + i] for i in range(-(-n // s.block))]) if n else np.zeros(0)
    return join(0, size + 1), join(1 << 20, size), got[-1]


def _meet(mine: np.ndarray, theirs: np.ndarray, out: bool, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order in which two owners list their common pairs (by partner, context, word), and where each partner begins."""
    partner = (theirs % U64(parts)).astype(np.int64)
    order = np.lexsort((theirs, mine, partner) if out else (mine, theirs, partner))
    return order, _cuts(partner[order], parts)


def _messages(f: dict, part: int, parts: int) -> list[tuple[int, int, int, bytes]]:
    """What the owners of the other words of repeated pairs need of this part's words."""
    out, cut = _meet(f["d_words"][f["out_at"]], f["out_other"], True, parts)
    into, cut_in = _meet(f["d_words"][f["in_at"]], f["in_other"], False, parts)
    tables, at = f["context_tables"][f["out_at"]][out], f["in_at"][into]
    customers, seated = f["customers"][at], f["tables"][at]
    rows = []
    for q in np.flatnonzero((np.diff(cut) > 0) | (np.diff(cut_in) > 0)):
        a, b, c, d = cut[q], cut[q + 1], cut_in[q], cut_in[q + 1]
        rows.append((int(q), MESSAGE, part, pack(context=small(tables[a:b]), customers=small(customers[c:d]), tables=small(seated[c:d]))))
    return rows


def _gather_pairs(shared, parts: int, s: Settings):
    """A part's pairs: what the sweeps need of them, and their sums with one table each."""

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        model: Counts = shared.value["model"]
        found = [unpack(b) for b in rows["blob"]]
        join = lambda name: np.concatenate([f[name] for f in found])
        key, n = summed(join("d_key"), join("n").astype(np.int64))
        sides = {name: dealt(join(f"d_{name}"), join(f"{name}_other"), join(f"{name}_n"), 1)[:3] for name in SIDES}
        size = len(model.words)
        kc, kw = _halves(key)
        once, more = n == 1, n > 1
        own = np.unique(np.concatenate([sides["word"][0], sides["in"][0]]))  # each context is a training word, too
        at = {name: np.searchsorted(own, owner) for name, (owner, _, _) in sides.items()}
        tally = lambda name, weights=None: np.bincount(at[name], weights, len(own)).astype(np.int64)
        single = {name: m == 1 for name, (_, _, m) in sides.items()}
        after, follow = sides["word"][1].astype(np.int64), sides["context"][1].astype(np.int64)
        pairs = pack(
            d_key=key[more],
            n=n[more],
            single_context=small(np.bincount(kc[once], minlength=size + 1) + np.bincount(after[single["word"]], minlength=size + 1)),
            single_word=small(np.bincount(kw[once], minlength=size) + np.bincount(follow[single["context"]], minlength=size)),
        )
        customers = tally("word") + tally("in")
        state = {
            "d_words": own,
            "count": tally("word", sides["word"][2]) + tally("in", sides["in"][2]),
            "single_in": tally("word", single["word"]) + tally("in", single["in"]),
            "single_out": tally("context", single["context"]) + tally("out", single["out"]),
            "customers": customers,
            "tables": np.minimum(customers, 1),
            "context_tables": tally("context") + tally("out"),
        }
        for name, (_, other, m) in sides.items():
            state |= {f"{name}_at": at[name][m > 1], f"{name}_other": other[m > 1], f"{name}_n": m[m > 1]}
        contexts = (np.bincount(kc, minlength=size + 1) + np.bincount(after, minlength=size + 1)).astype(np.float64)
        words = (np.bincount(kw, minlength=size) + np.bincount(follow, minlength=size)).astype(np.float64)
        every = np.concatenate([n, *(sides[name][2] for name in SIDES if name != "in")])
        scalars = [float(len(every)), float((every == 1).sum()), float((every == 2).sum()), float(customers.sum()), float(len(own))]
        part = int(rows["part"].iloc[0])
        out = [(part, PAIRS, 0, pairs), (part, STATE, 0, _keep(state)), *_messages(state, part, parts)]
        out += [(part, SUMS, block, blob) for block, blob in _sums(contexts, words, scalars, s)]
        return pd.DataFrame(out, columns=["part", "kind", "flush", "blob"])

    return gather


def _keep(state: dict) -> bytes:
    """A part's own words; all but hashes are small whole numbers."""
    return pack(**{k: v if k == "d_words" else small(v) for k, v in state.items()})


def seat_pairs(kc, kw, n, model: Counts, last: Sweep, discount: float, number: int, s: Settings) -> np.ndarray:
    """Tables of pairs of resident words in one sweep."""
    weight = (s.strength + discount * last.context_tables)[kc] * last.parent(last.customers[kw], last.tables[kw], model, s)
    return seat(n.astype(np.int64), weight, discount, pair_key(model.hashes[kc], model.words[kw]), number)


def _sweep(shared, s: Settings, hot_at: float | None = None):
    """The next sweep over pairs of resident words; with hot_at, instead the pairs that frequent and their tables in each sweep."""

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        know = shared.value
        model, states, discount = know["model"], know["states"], know["discount"]
        size = len(model.words)
        for batch in batches:
            for blob in batch["blob"]:
                f = unpack(blob)
                kc, kw = _halves(f["d_key"])
                if hot_at is not None:
                    kept = f["n"] >= hot_at
                    tables = [seat_pairs(kc[kept], kw[kept], f["n"][kept], model, last, discount, number, s) for number, last in enumerate(states[:-1], 1)]
                    yield pd.DataFrame([(0, pack(key=f["d_key"][kept], n=f["n"][kept], t=np.array(tables)))], columns=["block", "blob"])
                    continue
                t = seat_pairs(kc, kw, f["n"], model, states[-1], discount, len(states), s)
                contexts = f["single_context"] + np.bincount(kc, t, size + 1)
                words = f["single_word"] + np.bincount(kw, t, size)
                yield pd.DataFrame(_sums(contexts, words, [0.0, 0.0], s), columns=["block", "blob"])

    return sweep


def _sweep_owned(shared, parts: int, s: Settings):
    """The next sweep over a part's own words, given its state and what other owners told."""

    def sweep(rows: pd.DataFrame) -> pd.DataFrame:
        know = shared.value
        model, last, discount, number = know["model"], know["states"][-1], know["discount"], len(know["states"])
        part = int(rows["part"].iloc[0])
        f = unpack(rows.loc[rows["kind"] == STATE, "blob"].iloc[0])
        told = [unpack(b) for b in rows[rows["kind"] == MESSAGE].sort_values("flush")["blob"]]
        own = f["d_words"]
        at = {name: f[f"{name}_at"].astype(np.int64) for name in SIDES}
        n = {name: f[f"{name}_n"].astype(np.int64) for name in SIDES}
        after, follow = f["word_other"].astype(np.int64), f["context_other"].astype(np.int64)
        f["out_other"], f["in_other"] = f["out_other"].astype(U64), f["in_other"].astype(U64)

        def told_of(name: str, order: np.ndarray) -> np.ndarray:
            values = np.zeros(len(order), np.int64)
            if len(order):
                values[order] = np.concatenate([m[name].astype(np.int64) for m in told])
            return values

        out, _ = _meet(own[at["out"]], f["out_other"], True, parts)
        into, _ = _meet(own[at["in"]], f["in_other"], False, parts)
        room = s.strength + discount * f["context_tables"].astype(np.float64)
        parent = last.parent(f["customers"].astype(np.int64), f["tables"].astype(np.int64), model, s)
        weight = {
            "word": (s.strength + discount * last.context_tables)[after] * parent[at["word"]],
            "context": room[at["context"]] * last.parent(last.customers[follow], last.tables[follow], model, s),
            "out": room[at["out"]] * last.parent(told_of("customers", out), told_of("tables", out), model, s),
            "in": (s.strength + discount * told_of("context", into)) * parent[at["in"]],
        }
        key = {
            "word": pair_key(model.hashes[after], own[at["word"]]),
            "context": pair_key(own[at["context"]], model.words[follow]),
            "out": pair_key(own[at["out"]], f["out_other"]),
            "in": pair_key(f["in_other"], own[at["in"]]),
        }
        t = {name: seat(n[name], weight[name], discount, key[name], number) for name in SIDES}
        tally = lambda name: np.bincount(at[name], t[name], len(own)).astype(np.int64)
        f["customers"] = f["single_in"].astype(np.int64) + tally("word") + tally("in")
        f["context_tables"] = f["single_out"].astype(np.int64) + tally("context") + tally("out")
        floor = np.full(len(own), (s.base_strength + model.base_discount * last.all_tables) * model.floor)
        f["tables"] = seat(f["customers"], floor, model.base_discount, mix(own + U64(5)), number)
        if number > s.sweeps - s.averaged:  # what scoring needs of this sample
            for name in ("customers", "tables", "context_tables"):
                f[f"past_{name}"] = np.vstack([*f.get(f"past_{name}", []), f[name]])
            for name in ("word", "context", "out"):
                f[f"past_{name}"] = np.vstack([*f.get(f"past_{name}", []), t[name]])
        rows = [(part, STATE, 0, _keep(f))]
        if number < s.sweeps:
            rows += _messages(f, part, parts)
        size = len(model.words)
        sums = _sums(np.bincount(after, t["word"], size + 1), np.bincount(follow, t["context"], size), [float(f["customers"].sum()), float(f["tables"].sum())], s)
        rows += [(part, SUMS, block, blob) for block, blob in sums]
        return pd.DataFrame(rows, columns=["part", "kind", "flush", "blob"])

    return sweep


def _ask(shared, parts: int, s: Settings):
    """Each flush of texts to the parts: its texts' distinct pairs; and what is known at once about the texts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        know = shared.value
        model: Counts = know["model"]
        hot, hot_score = know["hot"]
        log_base = np.log10(model.counts + 1.0)
        bottom = np.log10(model.tokens + model.types + 1.0)
        task = TaskContext.get().partitionId()
        for turn, (ids, train, tokens, sizes) in enumerate(_texts(batches, s)):
            flush = (task << 24) + turn
            before, ctx, number = _pairs(model, tokens, sizes)
            doc = np.repeat(np.arange(len(ids)), sizes)
            known, resident = number >= 0, (number >= 0) & (ctx >= 0)
            key = (np.where(resident, ctx, 0).astype(U64) << U64(32)) | np.where(resident, number, 0).astype(U64)
            if len(hot):
                place = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
                at_once = resident & (hot[place] == key)
            else:
                place, at_once = np.zeros(len(key), np.int64), np.zeros(len(key), bool)
            # Distinct (pair, text) of resident pairs, with counts.
            sent = np.flatnonzero(resident & ~at_once)
            sent = sent[np.lexsort((key[sent], _narrow(mix(key[sent]) % U64(parts), parts)))]  # stable: texts stay in order
            k, d = key[sent], doc[sent]
            first = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])))) if len(k) else np.zeros(0, np.int64)
            n = np.diff(np.append(first, len(k)))
            k, d = k[first], d[first]
            cut = _cuts((mix(k) % U64(parts)).astype(np.int64), parts)
            # Tokens with one word that is not resident go to its owner.
            sides, both = {}, None
            for name, at, owner, other in _sides(tokens, before, ctx, number):
                if name == "in":
                    continue
                part = _narrow(owner % U64(parts), parts)
                by = np.lexsort((other, owner, part) if name == "out" else (owner, part))
                at, owner, other = at[by], owner[by], other[by]
                if name in ("word", "context"):
                    sides[name] = owner, other, doc[at], _cuts((owner % U64(parts)).astype(np.int64), parts)
                else:
                    both = at, owner, other
            # Of two such words: distinct pairs to the contexts' owners, distinct words to theirs; texts stay here.
            at, owner, other = both
            new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (other[1:] != other[:-1]))) if len(at) else np.zeros(0, bool)
            pair = np.cumsum(new) - 1
            owner, other = owner[new], other[new]
            learnt = np.bincount(pair, train[doc[at]], len(owner)).astype(np.int64)
            cut_out = _cuts((owner % U64(parts)).astype(np.int64), parts)
            word, place_of = np.unique(other, return_inverse=True)
            by = np.lexsort((word, word % U64(parts)))
            rank = np.empty(len(by), np.int64)
            rank[by] = np.arange(len(by))
            word = word[by]
            cut_in = _cuts((word % U64(parts)).astype(np.int64), parts)
            local = pack(
                ids=[i for i in ids],
                train=train,
                tokens=sizes,
                known=np.bincount(doc[known], minlength=len(ids)),
                base=np.bincount(doc[known], log_base[number[known]], len(ids)) - bottom * sizes,
                score=np.bincount(doc[at_once], hot_score[place[at_once]] if len(hot) else None, len(ids)),
                pair_doc=doc[at].astype(np.uint16),
                pair=small(pair),
                pair_word=small(rank[place_of]),
                words=len(word),
            )
            rows = [(flush % parts, 1, flush, local)]
            for p in range(parts):
                a, b = cut[p], cut[p + 1]
                arrays = {"out_from": int(cut_out[p]), "in_from": int(cut_in[p]), "d_in": word[cut_in[p] : cut_in[p + 1]]}
                some = b > a or len(arrays["d_in"]) > 0
                for name, (one, two, texts, cuts) in sides.items():
                    e, g = cuts[p], cuts[p + 1]
                    some = some or g > e
                    arrays |= {f"d_{name}": one[e:g], f"{name}_other": small(two[e:g]), f"{name}_doc": texts[e:g].astype(np.uint16)}
                e, g = cut_out[p], cut_out[p + 1]
                arrays |= {"d_out": owner[e:g], "out_other": other[e:g], "out_n": small(learnt[e:g])}
                if some or g > e:
                    rows.append((p, 0, flush, pack(d_key=k[a:b], doc=d[a:b].astype(np.uint16), n=small(n[a:b]), train=np.packbits(train), **arrays)))
            yield _batch(rows)

    return ask


def _answer(shared, s: Settings):
    """A part: counts and seating of all its pairs, then for each flush sums by text."""

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        know = shared.value
        model, states, discount, followed = know["model"], know["states"], know["discount"], know["followed"]
        size, samples = len(model.words), range(len(states) - s.averaged, len(states))
        out = [(r.flush, 1, r.blob) for r in rows[rows["kind"] == 1].itertuples()]
        kept = [unpack(b) for b in rows.loc[rows["kind"] == 2, "blob"]]
        rows = rows[rows["kind"] == 0].sort_values("flush", kind="stable")
        if not len(rows):
            return pd.DataFrame(out, columns=["flush", "kind", "blob"])
        found = [unpack(b) for b in rows["blob"]]
        train = [np.unpackbits(f["train"]).astype(bool) for f in found]
        join = lambda name: np.concatenate([f[name] for f in found])
        learns = lambda docs: np.concatenate([t[f[docs]] for t, f in zip(train, found, strict=True)]).astype(np.int64)

        # Pairs of resident words: all sweeps told again.
        pairs, at = np.unique(join("d_key"), return_inverse=True)
        n = np.bincount(at, learns("doc") * join("n").astype(np.int64), len(pairs)).astype(np.int64)
        kc, kw = _halves(pairs)
        more, t, p = n > 1, np.minimum(n, 1), np.zeros(len(pairs))
        for number in samples:
            now = states[number]
            t[more] = seat_pairs(kc[more], kw[more], n[more], model, states[number - 1], discount, number, s)
            p += (n - discount * t + (s.strength + discount * now.context_tables[kc]) * now.parent(now.customers[kw], now.tables[kw], model, s)) / (s.strength + followed[kc])
        # Hundred-thousandths of a decade, so that sums are small whole numbers.
        score = np.rint(-1e5 * np.log10(p / s.averaged)).astype(np.int64)

        # This part's own words, in the order of their hashes; those not in any training text have only zeros.
        own = np.unique(np.concatenate([join(f"d_{name}") for name in SIDES]))
        place = _places(kept[0]["d_words"], own) if kept else np.full(len(own), -1)
        there = place >= 0

        def of_words(name: str) -> np.ndarray:
            values = np.zeros((s.averaged, len(own)), np.int64)
            if kept:
                values[:, there] = kept[0][name][..., place[there]]
            return values

        customers, tables, context_tables = of_words("past_customers"), of_words("past_tables"), of_words("past_context_tables")
        count = of_words("count")[0]

        def counted(name: str, learnt: np.ndarray):
            """Distinct pairs of one side: each row's pair, and the pairs' owner, other one, customers and tables."""
            others, other = np.unique(join(f"{name}_other"), return_inverse=True)
            ids, row = np.unique(np.searchsorted(own, join(f"d_{name}")) * max(len(others), 1) + other, return_inverse=True)
            n = np.bincount(row, learnt, len(ids)).astype(np.int64)
            seated = np.tile(np.minimum(n, 1), (s.averaged, 1))
            if (n > 1).any():  # the same pairs, in the same order, as in the sweeps
                seated[:, n > 1] = kept[0][f"past_{name}"]
            return row, ids // max(len(others), 1), others[ids % max(len(others), 1)], n, seated

        word_row, w, c, wn, wt = counted("word", learns("word_doc"))
        context_row, u, r, un, ut = counted("context", learns("context_doc"))
        c, r = c.astype(np.int64), r.astype(np.int64)
        wp, up = np.zeros(len(w)), np.zeros(len(u))
        for i, number in enumerate(samples):
            now = states[number]
            wp += (wn - discount * wt[i] + (s.strength + discount * now.context_tables[c]) * now.parent(customers[i, w], tables[i, w], model, s)) / (s.strength + followed[c])
            up += (un - discount * ut[i] + (s.strength + discount * context_tables[i, u]) * now.parent(now.customers[r], now.tables[r], model, s)) / (s.strength + count[u])
        word_score, context_score = (np.rint(-1e5 * np.log10(x / s.averaged)).astype(np.int64)[y] for x, y in ((wp, word_row), (up, context_row)))
        out_row, o, _, on, ot = counted("out", join("out_n").astype(np.int64))

        log_count = np.log10(count + 1.0)
        a = b = c = e = 0
        for flush, f in zip(rows["flush"], found, strict=True):
            a2, b2, c2, e2 = a + len(f["d_key"]), b + len(f["d_word"]), c + len(f["d_context"]), e + len(f["d_out"])
            texts = 1 + int(max(f[name].max(initial=0) for name in ("doc", "word_doc", "context_doc")))
            total = np.bincount(f["doc"], score[at[a:a2]] * f["n"].astype(np.int64), texts)
            total = total + np.bincount(f["word_doc"], word_score[b:b2], texts) + np.bincount(f["context_doc"], context_score[c:c2], texts)
            mine = w[word_row[b:b2]]
            seen = count[mine] > 0
            known = np.bincount(f["word_doc"][seen], minlength=texts)
            base = np.bincount(f["word_doc"][seen], log_count[mine][seen], texts)
            some, touched = np.flatnonzero(known), np.flatnonzero(total)
            x, y = out_row[e:e2], np.searchsorted(own, f["d_in"])
            reply = pack(
                d_doc=touched.astype(np.uint16),
                total=small(total[touched].astype(np.int64)),
                d_some=some.astype(np.uint16),
                known=small(known[some]),
                base=base[some],
                out_from=f["out_from"],
                n=small(on[x]),
                seated=small(ot[:, x]),
                context_tables=small(context_tables[:, o[x]]),
                followed=small(count[o[x]]),
                in_from=f["in_from"],
                count=small(count[y]),
                customers=small(customers[:, y]),
                tables=small(tables[:, y]),
            )
            out.append((flush, 0, reply))
            a, b, c, e = a2, b2, c2, e2
        return pd.DataFrame(out, columns=["flush", "kind", "blob"])

    return answer


def _finish(model: Counts, states: list[Sweep], discount: float, s: Settings):
    """Sums of each text; pairs of two words that are not resident are put together from both owners' replies."""

    def finish(rows: pd.DataFrame) -> pd.DataFrame:
        local = unpack(rows.loc[rows["kind"] == 1, "blob"].iloc[0])
        known, base, score = local["known"].astype(np.int64), local["base"].copy(), local["score"].copy()
        total = np.zeros(len(known), np.int64)
        size, words = len(local["pair_word"]), local["words"]
        n, followed, seated, rooms = np.zeros(size), np.zeros(size), np.zeros((s.averaged, size)), np.zeros((s.averaged, size))
        count, customers, tables = np.zeros(words), np.zeros((s.averaged, words)), np.zeros((s.averaged, words))
        # Sums of logarithms are taken in one order, whatever the order of arrival.
        for blob in sorted(rows.loc[rows["kind"] == 0, "blob"]):
            f = unpack(blob)
            total[f["d_doc"]] += f["total"].astype(np.int64)
            known[f["d_some"]] += f["known"]
            base[f["d_some"]] += f["base"]
            at = slice(f["out_from"], f["out_from"] + len(f["n"]))
            n[at], followed[at], seated[:, at], rooms[:, at] = f["n"], f["followed"], f["seated"], f["context_tables"]
            at = slice(f["in_from"], f["in_from"] + len(f["count"]))
            count[at], customers[:, at], tables[:, at] = f["count"], f["customers"], f["tables"]
        pair, doc, w = local["pair"].astype(np.int64), local["pair_doc"], local["pair_word"].astype(np.int64)
        p = np.zeros(size)
        for i, now in enumerate(states):
            p += (n - discount * seated[i] + (s.strength + discount * rooms[i]) * now.parent(customers[i, w], tables[i, w], model, s)) / (s.strength + followed)
        total += np.bincount(doc, np.rint(-1e5 * np.log10(p / s.averaged))[pair], len(known)).astype(np.int64)
        known += np.bincount(doc, (count[w] > 0)[pair], len(known)).astype(np.int64)
        base += np.bincount(doc, np.log10(count[w] + 1.0)[pair], len(known))
        return pd.DataFrame(
            {
                "doc_id": pd.array(local["ids"], dtype="Int64"),
                "held_out": ~local["train"],
                "n_tokens": local["tokens"],
                "n_known": known,
                "train_tokens": model.tokens,
                "base_score": base,
                "score": score - total / 1e5,
            }
        )

    return finish


def language_model_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row for each row of docs."""
    s, spark = settings, docs.sparkSession
    scratch = Scratch(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), (fold(id_col, 7) != 2).alias("train"))
    learn = docs.where("train")

    words = learn.mapInArrow(_count_words(parts, s), ROWS).select("part", "blob").groupBy("part")
    found = [unpack(r[0]) for r in words.applyInPandas(_gather_words(-(-2 * s.resident // parts) + 64), "blob binary").collect()]
    add = lambda name: int(sum(int(f[name]) for f in found))
    join = lambda name, kind: np.concatenate([np.zeros(0, kind), *[f[name] for f in found]])
    keys, n = join("key", U64), join("n", np.int64)
    end = U64(WordHashes()[END_WORD])
    order = np.lexsort((keys, -n, keys != end))[: s.resident]
    order = order[np.argsort(keys[order])]
    estimate = lambda once, twice: float(np.clip(once / max(once + 2 * twice, 1), 0.3, 0.95))
    texts = int(n[keys == end].sum())
    model = Counts(add("total"), add("types"), texts, keys[order], n[order], estimate(add("once"), add("twice")))

    def share(**more):
        return spark.sparkContext.broadcast({"model": model, **more})

    shared = share()
    counted = learn.mapInArrow(_count_pairs(shared, parts, s), ROWS).select("part", "blob").groupBy("part")
    owned = scratch.write(counted.applyInPandas(_gather_pairs(shared, parts, s), ROWS), "pairs")
    pairs = owned.where(F.col("kind") == PAIRS).select("blob")
    sums = lambda df: df.where(F.col("kind") == SUMS).select(F.col("flush").alias("block"), "blob")
    contexts, customers, scalars = _collect_sums(sums(owned), len(model.words), s)
    discount = estimate(scalars[1], scalars[2])
    tables = np.minimum(customers, 1)
    states = [Sweep(contexts, customers, tables, customers.sum() + scalars[3], tables.sum() + scalars[4])]
    for number in range(1, s.sweeps + 1):
        know = share(states=states, discount=discount)
        swept = owned.where(F.col("kind").isin(STATE, MESSAGE)).groupBy("part").applyInPandas(_sweep_owned(know, parts, s), ROWS)
        owned = scratch.write(swept, f"sweep{number}")
        if number > 1:
            scratch.drop(f"sweep{number - 1}")
        contexts, customers, scalars = _collect_sums(pairs.mapInPandas(_sweep(know, s), "block long, blob binary").union(sums(owned)), len(model.words), s)
        last = states[-1]
        weight = np.full(len(customers), (s.base_strength + model.base_discount * last.all_tables) * model.floor)
        tables = seat(customers.astype(np.int64), weight, model.base_discount, mix(model.words + U64(5)), number)
        states.append(Sweep(contexts, customers, tables, customers.sum() + scalars[0], tables.sum() + scalars[1]))

    followed = model.followed()
    know = share(states=states, discount=discount)
    at_least = max(2.0, model.tokens / s.hot)
    hot = [unpack(r["blob"]) for r in pairs.mapInPandas(_sweep(know, s, at_least), "block long, blob binary").collect()]
    hot = [h for h in hot if len(h["key"])]
    hot_key, hot_score = np.zeros(0, U64), np.zeros(0)
    if hot:
        hot_key, hn = np.concatenate([h["key"] for h in hot]), np.concatenate([h["n"] for h in hot])
        ht = np.concatenate([h["t"] for h in hot], axis=1)
        kc, kw = _halves(hot_key)
        p = np.zeros(len(hot_key))
        for number in range(len(states) - s.averaged, len(states)):
            now = states[number]
            parent = now.parent(now.customers[kw], now.tables[kw], model, s)
            p += (hn - discount * ht[number - 1] + (s.strength + discount * now.context_tables[kc]) * parent) / (s.strength + followed[kc])
        order = np.argsort(hot_key)
        hot_key, hot_score = hot_key[order], np.log10(p[order] / s.averaged)
    know = share(states=states, discount=discount, followed=followed, hot=(hot_key, hot_score))
    own = owned.where(F.col("kind") == STATE).select("part", F.lit(2).alias("kind"), "flush", "blob")
    asked = docs.mapInArrow(_ask(know, parts, s), ROWS).union(own)
    answered = asked.groupBy("part").applyInPandas(_answer(know, s), "flush long, kind int, blob binary")
    none = np.zeros(0)
    totals = [replace(now, context_tables=none, customers=none, tables=none) for now in states[-s.averaged :]]
    return answered.groupBy("flush").applyInPandas(_finish(replace(model, words=none, counts=none), totals, discount, s), RESULT)
