"""Language identification: a bidirectional gated recurrent network over bytes.

Trained in numpy by backpropagation through time on windows of labelled texts. The
network labels every byte position of a whole text; a document's probabilities are
the normalised sum of the positions' log probabilities, tempered so that a score is
a probability rather than a certainty.

Training reads a bounded sample: at most about `per_language` documents of each
language (a threshold on the hash of the id, from the exact count of each language,
so the sample is even over the corpus and costs no shuffle of texts) and one window
of each. Everything else, all texts, is labelled in Arrow batches with the (few kB of)
weights; rows are independent, so lost work is simply redone.

Defined results: a text that is null or has no letter is `und` with score 0; with no
labelled row at all every text is `und`; ties go to the language first in order; null
ids never train (their remainder is that of the empty text); extra columns are
untouched, because prediction is a column expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, free_name

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Settings:
    """per_language bounds the training sample; window is in bytes."""

    per_language: int = 1500
    window: int = 64
    hidden: int = 8
    steps: int = 500
    batch: int = 192
    rate: float = 0.02
    seed: int = 7
    #: Positions of running text are far from independent: so many count as one.
    temper: float = 8.0


def sigmoid(x: np.ndarray) -> np.ndarray:
    """Logistic function by tanh, in place where possible."""
    np.multiply(x, 0.5, out=x)
    np.tanh(x, out=x)
    x += 1.0
    x *= 0.5
    return x


class Direction:
    """One gated recurrent layer; the byte embedding is its input projection."""

    def __init__(self, hidden: int, rng: np.random.Generator):
        self.x = rng.normal(0, 0.3, (257, 3 * hidden)).astype(np.float32)  # row 256: padding
        self.u = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32)

    def run(self, codes: np.ndarray, keep: bool = False):
        """codes (T, N) to states (T, N, H); with keep, also what backpropagation needs."""
        steps, n = codes.shape
        hid = self.u.shape[0]
        gates, cand = np.ascontiguousarray(self.u[:, : 2 * hid]), np.ascontiguousarray(self.u[:, 2 * hid :])
        state = np.zeros((n, hid), np.float32)
        out = np.empty((steps, n, hid), np.float32)
        saved = []
        for t in range(steps):
            into = self.x[codes[t]]
            zr = sigmoid(into[:, : 2 * hid] + state @ gates)
            z, r = zr[:, :hid], zr[:, hid:]
            c = np.tanh(into[:, 2 * hid :] + (r * state) @ cand)
            new = state + z * (c - state)
            if keep:
                saved.append((state, z, r, c))
            state = new
            out[t] = state
        return (out, saved) if keep else out

    def back(self, codes: np.ndarray, saved, grad_out: np.ndarray):
        """Gradients of x and u from those of the states."""
        hid = self.u.shape[0]
        gx, gu = np.zeros_like(self.x), np.zeros_like(self.u)
        gates, cand = self.u[:, : 2 * hid], self.u[:, 2 * hid :]
        flow = np.zeros_like(grad_out[0])
        for t in range(len(saved) - 1, -1, -1):
            state, z, r, c = saved[t]
            g = grad_out[t] + flow
            gc = g * z * (1 - c * c)
            gz = g * (c - state) * z * (1 - z)
            grs = gc @ cand.T
            gr = grs * state * r * (1 - r)
            gzr = np.concatenate([gz, gr], axis=1)
            flow = g * (1 - z) + grs * r + gzr @ gates.T
            gu[:, : 2 * hid] += state.T @ gzr
            gu[:, 2 * hid :] += (r * state).T @ gc
            np.add.at(gx, codes[t], np.concatenate([gzr, gc], axis=1))
        return gx, gu


class Network:
    """Forward and backward layers and one softmax over languages for each position."""

    def __init__(self, languages: list[str], settings: Settings):
        rng = np.random.default_rng(settings.seed)
        self.languages, self.settings = languages, settings
        self.forth, self.back = Direction(settings.hidden, rng), Direction(settings.hidden, rng)
        self.w = rng.normal(0, 0.3, (2 * settings.hidden, len(languages))).astype(np.float32)
        self.b = np.zeros(len(languages), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.forth.x, self.forth.u, self.back.x, self.back.u, self.w, self.b]

    def gradients(self, codes: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over positions that are no padding, and its gradients."""
        real = (codes < 256).astype(np.float32)
        hf, sf = self.forth.run(codes, True)
        hb, sb = self.back.run(codes[::-1], True)
        h = np.concatenate([hf, hb[::-1]], axis=2)
        logits = h @ self.w + self.b
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=2, keepdims=True)
        at = (slice(None), np.arange(codes.shape[1]), target)
        total = max(real.sum(), 1.0)
        loss = -(np.log(p[at] + 1e-9) * real).sum() / total
        g = p
        g[at] -= 1
        g *= (real / total)[:, :, None]
        flat = g.reshape(-1, g.shape[2])
        gw, gb = h.reshape(-1, h.shape[2]).T @ flat, flat.sum(axis=0)
        gh = g @ self.w.T
        hid = self.settings.hidden
        gxf, guf = self.forth.back(codes, sf, gh[:, :, :hid])
        gxb, gub = self.back.back(codes[::-1], sb, gh[::-1, :, hid:])
        return float(loss), [gxf, guf, gxb, gub, gw, gb]

    def fit(self, windows: list[bytes], labels: np.ndarray) -> float:
        """Adam over random batches, languages in equal parts; the last mean loss."""
        s, rng = self.settings, np.random.default_rng(self.settings.seed + 1)
        codes = encode_windows(windows, s.window)
        by = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        by = [x for x in by if len(x)]
        first = [np.zeros_like(p) for p in self.parameters()]
        second = [np.zeros_like(p) for p in self.parameters()]
        loss = 0.0
        for step in range(1, s.steps + 1):
            pick = np.concatenate([rng.choice(x, max(1, s.batch // len(by))) for x in by])
            batch = codes[:, pick]
            if step % 2:  # short texts too
                batch = batch[: rng.integers(8, s.window + 1)]
            loss, grads = self.gradients(batch, labels[pick])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            rate = s.rate * min(1.0, 2 * (1 - (step - 1) / s.steps)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for p, g, m, v in zip(self.parameters(), grads, first, second, strict=True):
                g *= min(1.0, 1.0 / (norm + 1e-9))
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
        return loss

    def label_positions(self, codes: np.ndarray) -> np.ndarray:
        """(T, N) codes to log probabilities (T, N, L) for each position."""
        hf, hb = self.forth.run(codes), self.back.run(codes[::-1])[::-1]
        hid = self.settings.hidden
        logits = hf.reshape(-1, hid) @ self.w[:hid]
        logits += np.ascontiguousarray(hb).reshape(-1, hid) @ self.w[hid:]
        logits += self.b
        logits -= logits.max(axis=1, keepdims=True)
        logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
        return logits.reshape(*codes.shape, -1)

    def pool(self, raws: list[bytes], block: int = 4096) -> np.ndarray:
        """Probabilities (documents, L): every byte of every text is labelled, in windows."""
        t = self.settings.window
        sizes = np.fromiter(map(len, raws), np.int64, len(raws))
        counts = -(-sizes // t)
        owner = np.repeat(np.arange(len(raws)), counts)
        total = np.zeros((len(raws), len(self.languages)), np.float64)
        padded = b"".join(r.ljust(int(c) * t, b"\0") for r, c in zip(raws, counts, strict=True))
        codes = np.frombuffer(padded, np.uint8).reshape(-1, t)
        last = np.cumsum(counts) - 1  # the window of each text that may have padding
        used = np.full(len(owner), t, np.int64)
        has = counts > 0
        used[last[has]] = sizes[has] - (counts[has] - 1) * t
        for i in range(0, len(owner), block):
            part = codes[i : i + block].T.astype(np.int16)
            real = np.arange(t)[:, None] < used[None, i : i + block]
            part[~real] = 256
            logp = self.label_positions(part)
            logp *= real[:, :, None]
            np.add.at(total, owner[i : i + block], logp.sum(axis=0, dtype=np.float64))
        total /= np.maximum(sizes, 1)[:, None]
        total *= np.minimum(np.maximum(sizes / self.settings.temper, 1.0), 40.0)[:, None]
        total -= total.max(axis=1, keepdims=True)
        p = np.exp(total)
        return p / p.sum(axis=1, keepdims=True)


def encode_windows(windows: list[bytes], t: int) -> np.ndarray:
    """(t, N) codes; 256 is padding."""
    codes = np.full((t, len(windows)), 256, np.int16)
    for k, w in enumerate(windows):
        w = w[:t]
        codes[: len(w), k] = np.frombuffer(w, np.uint8)
    return codes


def train(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", settings: Settings = Settings(), learn: Column | None = None) -> Network | None:
    """A network from the rows of docs with a language that `learn` admits (default: all)."""
    s = settings
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    known = known.where(learn) if learn is not None else known
    counts = {r[0]: r[1] for r in known.groupBy(F.col(lang).cast("string")).count().collect()}
    if not counts:
        return None
    # Evenly spread by the hash of the id, so many of each language; the window starts at a hashed place.
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, s.per_language / n))])
    chance = F.pmod(F.xxhash64(F.lit(s.seed), F.col(id_col)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    size = F.length(F.col(text))
    start = F.pmod(F.xxhash64(F.lit(s.seed + 1), F.col(id_col)), F.greatest(size - s.window, F.lit(1))) + 1
    sample = known.where(chance < share[F.col(lang).cast("string")]).select(F.col(lang).cast("string"), F.substring(F.col(text), start, F.lit(s.window)), F.col(id_col))
    rows = sorted(((r[2], r[0], r[1]) for r in sample.limit(2 * s.per_language * len(counts)).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    rows = [r for r in rows if LETTER.search(r[2])]
    languages = sorted({r[1] for r in rows})
    if not languages:
        return None
    net = Network(languages, s)
    where = {k: i for i, k in enumerate(languages)}
    net.fit([r[2].encode("utf-8") for r in rows], np.array([where[r[1]] for r in rows]))
    return net


def predict(net: Network | None, text: Column | str) -> Column:
    """struct(lang_pred, score) of a text column."""
    text = F.col(text) if isinstance(text, str) else text
    if net is None:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))

    @F.pandas_udf("lang_pred string, score double")
    def label(texts: pd.Series) -> pd.DataFrame:
        names, scores = [], []
        raws: list[bytes] = []
        texts = texts.tolist()

        def flush() -> None:
            if raws:
                p = net.pool(raws)
                best = p.argmax(axis=1)
                names.extend(net.languages[k] for k in best)
                scores.extend(p[np.arange(len(best)), best].tolist())
                raws.clear()

        held = 0
        for text in texts:
            fit_for = text is not None and LETTER.search(text) is not None
            raws.append(text.encode("utf-8", "surrogatepass") if fit_for else b"")
            held += len(raws[-1])
            if held > 4_000_000:
                flush()
                held = 0
        flush()
        out = pd.DataFrame({"lang_pred": names, "score": scores})
        none = np.array([t is None or LETTER.search(t) is None for t in texts], bool)
        out.loc[none, "lang_pred"] = UNKNOWN
        out.loc[none, "score"] = 0.0
        return out

    return label(text)


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", settings: Settings = Settings()) -> DataFrame:
    """id, held_out, lang_pred, score; rows with crc32(id) mod 5 = 0 are held out of training."""
    net = train(docs, text, lang, id_col, settings, fold(id_col, 5) != 0)
    return docs.select(F.col(id_col), (fold(id_col, 5) == 0).alias("held_out"), predict(net, text).alias("p")).select(id_col, "held_out", "p.*")


def keep_known(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", least: float = 0.5, settings: Settings = Settings()) -> DataFrame:
    """The rows of docs whose language is known with a score of `least` or more, with the columns of docs."""
    net = train(docs, text, lang, id_col, settings, fold(id_col, 5) != 0)
    name = free_name(docs, "language")
    labelled = docs.withColumn(name, predict(net, text))
    return labelled.where((F.col(f"`{name}`.lang_pred") != UNKNOWN) & (F.col(f"`{name}`.score") >= least)).drop(name)
