"""Approximate nearest neighbours by learned partitions.

1. The nearest neighbours of a bounded sample form a graph, which is cut into parts
   of equal size that sever few edges (balanced refinement from recursive halving).
2. A small classifier (one hidden layer, numpy) learns to give a vector the parts of
   its neighbours.
3. Every row is indexed under its most probable part. A query is routed to several
   most probable parts, as many as a held-out share of the sample needs for the wanted
   recall, and all their rows are ranked again by exact cosine in double precision.

The sample is at most about `sample` rows, chosen by a hash of the id. Parts are
searched in blocks of bounded size (rows times queries), so that one very frequent
vector only makes more blocks; each block gives its best k for a query, and these few
are merged.

Defined results: vectors that are null, zero, of another length than most, or hold null
or non-finite components take no part, nor do rows without an id. Ties go to the
smaller id. With fewer candidates than k all found are returned. Rows that share an id
are all candidates, but never of that id. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FOUND = "query_id long, vec_id long, score double"


@dataclass(frozen=True)
class Settings:
    """recall: what the number of probed parts is chosen for, on held-out sample rows."""

    sample: int = 6000
    parts: int = 16
    neighbours: int = 10
    hidden: int = 96
    epochs: int = 25
    recall: float = 0.97
    block_rows: int = 4096
    block_queries: int = 8192
    seed: int = 3


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two near their largest component: exact, and no square over- or underflows."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of each row of unit vectors."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 1024):
        s = x[a : a + 1024] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else out[a : a + 1024]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rng: np.random.Generator, sweeps: int = 12) -> np.ndarray:
    """A part for each node: sizes within 5 percent of even, few edges cut."""
    n = len(x)
    part = np.zeros(n, np.int64)

    def halve(nodes: np.ndarray, first: int, count: int) -> None:
        if count == 1:
            part[nodes] = first
            return
        # The main direction of these rows by a few power iterations.
        centred = x[nodes] - x[nodes].mean(axis=0)
        d = rng.normal(size=x.shape[1])
        for _ in range(8):
            d = centred.T @ (centred @ d)
            d /= np.linalg.norm(d) + 1e-12
        order = nodes[np.argsort(centred @ d, kind="stable")]
        left = count // 2
        cut = len(nodes) * left // count
        halve(order[:cut], first, left)
        halve(order[cut:], first + left, count - left)

    halve(np.arange(n), 0, parts)
    # Both directions of each edge.
    heads, tails = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    a, b = np.concatenate([heads, tails]), np.concatenate([tails, heads])
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    edge = np.searchsorted(a, np.arange(n + 1))
    most = int(np.ceil(1.05 * n / parts))
    size = np.bincount(part, minlength=parts)
    for _ in range(sweeps):
        moved = 0
        for v in rng.permutation(n):
            votes = np.bincount(part[b[edge[v] : edge[v + 1]]], minlength=parts)
            own = part[v]
            votes = np.where((size < most) | (np.arange(parts) == own), votes, -1)
            best = int(votes.argmax())
            if votes[best] > votes[own]:
                size[own] -= 1
                size[best] += 1
                part[v] = best
                moved += 1
        if moved < n // 200:
            break
    return part


class Router:
    """A classifier from unit vectors to part probabilities."""

    def __init__(self, dims: int, parts: int, hidden: int, rng: np.random.Generator):
        self.w1 = rng.normal(0, np.sqrt(2), (dims, hidden))
        self.b1 = np.zeros(hidden)
        self.w2 = rng.normal(0, 1 / np.sqrt(hidden), (hidden, parts))
        self.b2 = np.zeros(parts)

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.maximum(x @ self.w1 + self.b1, 0)
        z = h @ self.w2 + self.b2
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        return h, p / p.sum(axis=1, keepdims=True)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return self._forward(x)[1]

    def fit(self, x: np.ndarray, target: np.ndarray, epochs: int, rng: np.random.Generator) -> None:
        """Adam on the cross entropy to the neighbours' parts."""
        values = [self.w1, self.b1, self.w2, self.b2]
        first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for a in range(0, len(x), 256):
                rows = order[a : a + 256]
                h, p = self._forward(x[rows])
                g = (p - target[rows]) / len(rows)
                gh = (g @ self.w2.T) * (h > 0)
                grads = [x[rows].T @ gh, gh.sum(0), h.T @ g, g.sum(0)]
                step += 1
                rate = 0.01 * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for v, d, m, s in zip(values, grads, first, second, strict=True):
                    m += 0.1 * (d - m)
                    s += 0.001 * (d * d - s)
                    v -= rate * m / (np.sqrt(s) + 1e-8)


def fit_router(x: np.ndarray, settings: Settings) -> tuple[Router, int]:
    """A router and the number of parts to probe, from sample vectors."""
    s, rng = settings, np.random.default_rng(settings.seed)
    x = unit(x)
    parts = max(1, min(s.parts, len(x) // 8))
    held = max(1, len(x) // 10)
    order = rng.permutation(len(x))
    test, x = x[order[:held]], x[order[held:]] if len(x) > 1 else x
    graph = neighbour_graph(x, s.neighbours)
    part = balanced_parts(x, graph, parts, rng)
    target = np.zeros((len(x), parts))
    for k in range(graph.shape[1]):
        np.add.at(target, (np.arange(len(x)), part[graph[:, k]]), 1.0)
    target[np.arange(len(x)), part] += 1
    target /= target.sum(axis=1, keepdims=True)
    router = Router(x.shape[1], parts, s.hidden, rng)
    router.fit(x, target, s.epochs, rng)
    # Rank, among a held-out row's parts, of the part under which each true neighbour is indexed.
    home = router.probabilities(x).argmax(axis=1)
    near = np.argsort(-(test @ x.T), axis=1)[:, : min(5, len(x))]
    rank = np.argsort(np.argsort(-router.probabilities(test), axis=1), axis=1)
    needed = np.sort(np.take_along_axis(rank, home[near], axis=1).ravel())
    probes = int(needed[min(len(needed) - 1, int(np.ceil(s.recall * len(needed))) - 1)]) + 1
    return router, probes


def search_block(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best k of a block for each query: distinct ids and exact cosines, ties to the smaller id."""
    most = 1
    q, v = scaled(q), scaled(v)
    if len(np.unique(ids)) < len(ids):
        raw = np.hstack([np.ascontiguousarray(x).view(np.uint8).reshape(len(ids), -1) for x in (ids, v)])
        kept = np.sort(np.unique(raw.view(f"V{raw.shape[1]}").ravel(), return_index=True)[1])
        ids, v = ids[kept], v[kept]
        # Vectors that an id still has beside each other may score alike; so many rows hold k ids at least.
        most = int(np.unique(ids, return_counts=True)[1].max())
    qn, vn = np.sqrt(np.einsum("ij,ij->i", q, q)), np.sqrt(np.einsum("ij,ij->i", v, v))
    unit_v = v / vn[:, None]
    out_q, out_v, out_s = [], [], []
    for a in range(0, len(q), 256):
        rough = (q[a : a + 256] / qn[a : a + 256, None]) @ unit_v.T
        rough[q_ids[a : a + 256, None] == ids[None, :]] = -np.inf
        kk = min(k * most, len(ids))
        floor = np.partition(rough, len(ids) - kk, axis=1)[:, len(ids) - kk]
        # Rounding in the product never decides: all within a margin are ranked again.
        row, col = np.nonzero((rough >= floor[:, None] - 1e-9) & np.isfinite(rough))
        exact = np.einsum("ij,ij->i", q[a + row], v[col]) / (qn[a + row] * vn[col])
        order = np.lexsort((ids[col], -exact, row))
        row, col, exact = row[order], col[order], exact[order]
        again = (row[1:] == row[:-1]) & (ids[col[1:]] == ids[col[:-1]]) & (exact[1:] == exact[:-1])
        fresh = np.append(True, ~again)[: len(row)]
        row, col, exact = row[fresh], col[fresh], exact[fresh]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        top = place < k
        out_q.append(q_ids[a + row[top]])
        out_v.append(ids[col[top]])
        out_s.append(exact[top])
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v array<double>) of the rows that take part."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where("id is not null and v is not null")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return rows.where(~F.exists("v", bad) & F.exists("v", lambda x: x != 0))


def nearest(df: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for the rows that `queries` (a condition on `id`) admits."""
    s = settings
    spark = df.sparkSession
    rows = valid_vectors(df, id_col, vec_col)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not lengths:
        return empty
    dims, total = lengths[0]
    rows = rows.where(F.size("v") == dims)
    chance = F.pmod(F.xxhash64(F.lit(s.seed), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = rows.where(chance < min(1.0, s.sample / total)).limit(2 * s.sample).collect()
    picked.sort()
    if not picked:
        picked = rows.limit(1).collect()
    router, probes = fit_router(np.array([r["v"] for r in picked]), s)

    @F.pandas_udf("array<int>")
    def route(vectors: pd.Series) -> pd.Series:
        p = router.probabilities(unit(np.stack(vectors.to_numpy())))
        return pd.Series(list(np.argsort(-p, axis=1, kind="stable")[:, :probes].astype(np.int32)), dtype=object)

    routed = rows.withColumn("parts", route("v"))
    placed = routed.select("id", "v", F.col("parts")[0].alias("part"))
    asked = routed.where(queries).select("id", "v", F.explode("parts").alias("part"))
    # Blocks of bounded size; parts are few, so their counts are too.
    n_rows = {r[0]: r[1] for r in placed.groupBy("part").count().collect()}
    n_asked = {r[0]: r[1] for r in asked.groupBy("part").count().collect()}
    parts = sorted(n_rows)
    row_blocks = F.array(*[F.lit(-(-n_rows.get(p, 0) // s.block_rows)) for p in range(parts[-1] + 1)])
    asked_blocks = F.array(*[F.lit(max(1, -(-n_asked.get(p, 0) // s.block_queries))) for p in range(parts[-1] + 1)])
    asked = asked.where(F.col("part").isin(parts))
    salt = F.pmod(F.xxhash64("id"), F.lit(1 << 30)).cast("int")
    left = placed.select("id", "v", "part", (salt % row_blocks[F.col("part")]).alias("i"), F.explode(F.sequence(F.lit(0), asked_blocks[F.col("part")] - 1)).alias("j"))
    right = asked.select("id", "v", "part", F.explode(F.sequence(F.lit(0), row_blocks[F.col("part")] - 1)).alias("i"), (salt % asked_blocks[F.col("part")]).alias("j"))

    def match(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if not len(mine) or not len(theirs):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        q, v, sc = search_block(theirs["id"].to_numpy(), np.stack(theirs["v"].to_numpy()), mine["id"].to_numpy(), np.stack(mine["v"].to_numpy()), k)
        return pd.DataFrame({"query_id": q, "vec_id": v, "score": sc})

    found = left.groupBy("part", "i", "j").cogroup(right.groupBy("part", "i", "j")).applyInPandas(match, FOUND)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
