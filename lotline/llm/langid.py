"""Operator 9: language identification by a bidirectional gated recurrent network over bytes.

The network reads a text's bytes across words and lines and labels every position with language
probabilities; a document's probabilities are their mean over all its positions. State is carried over
the whole text in both directions, window by window, as many texts side by side as a batch holds. Where
fewer than WIDE texts go on, their windows are read all at once instead: each begins with a guess, its
neighbour then shows the true state, and windows that began with another are read again, until each
began with the state its neighbour ended with: the same as one pass in order. Where that takes more than
ROUNDS times the windows, as with a network that forgets nothing, the rest is read in order. Of the first
direction only what its states add to the labels is kept, up to a bound; the second direction's
states are judged with it as they are read. Only of longer batches are windows read once more.

Gates are piecewise linear and candidate states x / (1 + |x|), which numpy works out quickly. Training
is backpropagation through time in numpy on the driver, over a bounded sample of labelled text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.llm.common import below, by_text, held_out, table

HIDDEN = 8
BODY, WIDE, ROUNDS = 240, 64, 8
#: States that differ by no more than this count as equal.
TOLERANCE = 1e-5
#: A symbol that UTF-8 never has: it leaves the state as it is.
PAD = 255
#: Bounds of the training sample: documents, and pieces of PIECE bytes out of their whole texts.
SAMPLE_DOCS, SAMPLE_PIECES, PIECE = 4_000, 10_000, 64
#: Windows run side by side, and characters read together, in a task.
SIDE, BATCH_CHARS = 1024, 2_000_000
#: Numbers, one per position and label, kept of the first direction (4 bytes each); of batches with more, windows are read once more.
KEPT = 16 << 20
LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"


@dataclass
class BiGRU:
    """w: input weights per direction and byte (2, 3H, 256); u: recurrent (2, 3H, H); v, c: output layer (labels, 2H)."""

    labels: list[str]
    w: np.ndarray
    u: np.ndarray
    v: np.ndarray
    c: np.ndarray

    @classmethod
    def fresh(cls, labels: list[str], hidden: int, seed: int) -> BiGRU:
        rng = np.random.default_rng(seed)
        make = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        net = cls(labels, make(0.5, 2, 3 * hidden, 256), make(hidden**-0.5, 2, 3 * hidden, hidden), make(0.3, len(labels), 2 * hidden), np.zeros((len(labels), 1), np.float32))
        net.rest()
        return net

    def rest(self) -> None:
        """Padding closes the update gate: the state stays."""
        size = self.u.shape[2]
        self.w[:, :, PAD] = 0
        self.w[:, :size, PAD] = 1e6

    def run(self, x: np.ndarray, d: int, keep: list | None = None, h: np.ndarray | None = None) -> np.ndarray:
        """States (T, H, B) of one direction over bytes x (T, B), in reading order of that direction, begun with h (H, B) or at rest."""
        steps, n = x.shape
        size = self.u.shape[2]
        w, u = self.w[d].copy(), self.u[d].copy()
        for into in (w, u):
            into[: 2 * size] *= 0.25  # gates are 0.5 + a / 4, cut at 0 and 1
        w[: 2 * size] += 0.5
        h = np.zeros((size, n), w.dtype) if h is None else h
        out = np.empty((steps, size, n), w.dtype)
        a, g, one = np.empty((3 * size, n), w.dtype), np.empty((3 * size, n), w.dtype), np.empty((size, n), w.dtype)
        for t in range(steps):
            np.take(w, x[t], axis=1, out=a, mode="clip")
            np.matmul(u, h, out=g)
            zr, m, new = a[: 2 * size], a[2 * size :], out[t]
            zr += g[: 2 * size]
            np.maximum(zr, 0, out=zr)
            np.minimum(zr, 1, out=zr)
            np.multiply(zr[size:], g[2 * size :], out=one)
            m += one
            np.abs(m, out=one)
            one += 1
            m /= one
            if keep is not None:
                keep.append((h, zr[:size].copy(), zr[size:].copy(), m.copy(), g[2 * size :].copy()))
            np.subtract(h, m, out=new)
            new *= zr[:size]
            new += m
            h = new
        return out

    def states(self, x: np.ndarray, keep: tuple[list, list]) -> np.ndarray:
        """(T, 2H, B) for the positions of x, both directions begun at rest."""
        return np.concatenate((self.run(x, 0, keep[0]), self.run(x[::-1], 1, keep[1])[::-1]), axis=1)

    def share(self, states: np.ndarray, d: int) -> np.ndarray:
        """(T, labels, B): what the states (T, H, B) of one direction add to the labels' logits."""
        size = self.u.shape[2]
        a = np.matmul(self.v[:, d * size : (d + 1) * size], states)
        return a if d else np.add(a, self.c, out=a)

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Loss and gradients for pieces x (T, B) of language y, by backpropagation through time."""
        kept: tuple[list, list] = ([], [])
        s = self.states(x, kept)
        a = np.matmul(self.v, s) + self.c
        e = np.exp(a - a.max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        real = x != PAD
        scale = (real * (weight / (np.maximum(real.sum(axis=0), 1) * len(y)))).astype(self.w.dtype)
        pick = p[:, y, np.arange(len(y))]
        loss = float(-(np.log(pick + 1e-9) * scale).sum())
        da = p.copy()
        da[:, y, np.arange(len(y))] -= 1
        da *= scale[:, None, :]
        size = self.u.shape[2]
        ds = np.matmul(self.v.T, da)
        gw, gu = np.zeros_like(self.w), np.zeros_like(self.u)
        for d in (0, 1):
            xs, dh_out = (x, ds[:, :size]) if d == 0 else (x[::-1], ds[::-1, size:])
            dh = np.zeros_like(dh_out[0])
            into = np.empty((len(xs), 3 * size, len(y)), self.w.dtype)
            for t in range(len(xs) - 1, -1, -1):
                h, z, r, m, g = kept[d][t]
                dh = dh + dh_out[t]
                dm = dh * (1 - z) * (1 - np.abs(m)) ** 2
                dz = dh * (h - m) * (0.25 * ((z > 0) & (z < 1)))
                dr = dm * g * (0.25 * ((r > 0) & (r < 1)))
                into[t] = np.concatenate((dz, dr, dm))
                back = np.concatenate((dz, dr, dm * r))
                gu[d] += back @ h.T
                dh = dh * z + self.u[d].T @ back
            flat = into.transpose(1, 0, 2).reshape(3 * size, -1)
            for k in range(3 * size):
                gw[d, k] = np.bincount(xs.ravel(), flat[k], 256)
        return loss, [gw, gu, np.einsum("tlb,thb->lh", da, s), da.sum(axis=(0, 2))[:, None]]


def train(pieces: list[bytes], langs: list[str], hidden: int = HIDDEN, epochs: int = 5, batch: int = 64, rate: float = 0.02, seed: int = 7) -> BiGRU:
    """Adam over batches of pieces, short ones padded; languages weigh alike."""
    labels = sorted(set(langs))
    rng = np.random.default_rng(seed)
    y = np.array([labels.index(x) for x in langs])
    width = max(1, max((len(p) for p in pieces), default=1))
    x = np.frombuffer(b"".join(p.ljust(width, bytes([PAD])) for p in pieces), np.uint8).reshape(len(pieces), width).T.astype(np.intp)
    weight = (1 / np.maximum(np.bincount(y, minlength=len(labels)) / len(y) * len(labels), 0.02))[y]
    net = BiGRU.fresh(labels, hidden, seed)
    params = [net.w, net.u, net.v, net.c]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step, steps = 0, epochs * -(-len(y) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            b = order[at : at + batch]
            _, grads = net.gradients(x[:, b], y[b], weight[b])
            step += 1
            lr = rate * (1 - step / (steps + 1)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for p, g, m, q in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                q += 0.001 * (g * g - q)
                p -= (lr * m / (np.sqrt(q) + 1e-8)).astype(np.float32)
            net.rest()
    return net


def readable(texts: list[str | None]) -> list[bool]:
    """Whether a text has a letter, per text; null has none."""
    return [t is not None and LETTER.search(t) is not None for t in texts]


class Windows:
    """The windows of several texts, one after another, and the states they begin with: begin (2, windows, H)."""

    def __init__(self, net: BiGRU, raws: list[bytes]):
        self.net = net
        sizes = np.array([len(r) for r in raws], np.int64)
        count = -(-sizes // BODY)
        self.data = np.frombuffer(b"".join([r.ljust(c * BODY, bytes([PAD])) for r, c in zip(raws, count.tolist())]), np.uint8).reshape(-1, BODY)
        self.doc = np.repeat(np.arange(len(raws)), count)
        nth = np.arange(len(self.doc)) - np.repeat(np.cumsum(count) - count, count)
        #: How many windows of its text a direction reads before this one.
        self.rank = (nth, count[self.doc] - 1 - nth)
        self.left = np.minimum(sizes[self.doc] - nth * BODY, BODY)
        self.begin, self.end = np.zeros((2, 2, len(self.doc), net.u.shape[2]), net.u.dtype)
        #: Shares (BODY, labels, windows) of the first direction, windows in its order of reading, and the windows' sums by the second.
        shape = (BODY, len(net.labels), len(self.doc))
        self.kept = np.empty(shape, net.u.dtype) if np.prod(shape) <= KEPT else None
        self.slot = np.argsort(np.argsort(nth, kind="stable"))
        self.judged = np.zeros((2, len(self.doc)), bool)
        self.sums = np.zeros((len(self.doc), len(net.labels)))

    def bytes_of(self, windows: np.ndarray, d: int = 0) -> np.ndarray:
        x = self.data[windows].T.astype(np.intp)
        return x[::-1] if d else x

    def read(self, d: int, windows: np.ndarray, judge: bool = True) -> None:
        """The states that windows end with in direction d; unless they begin with a guess, their states go into the labels."""
        for at in range(0, len(windows), SIDE):
            own = windows[at : at + SIDE]
            states = self.net.run(self.bytes_of(own, d), d, h=self.begin[d, own].T)
            self.end[d, own] = states[-1].T
            if not judge or self.kept is None:
                continue
            self.judged[d, own] = True
            slot = self.slot[own]
            if d:
                self.judge(own, self.kept.take(slot, axis=2), states)
            elif (np.diff(slot) == 1).all():
                self.kept[:, :, slot[0] : slot[-1] + 1] = self.net.share(states, d)
            else:
                self.kept[:, :, slot] = self.net.share(states, d)

    def judge(self, own: np.ndarray, share: np.ndarray, states: np.ndarray) -> None:
        """The sums of windows' label probabilities, from the first direction's share and the second's states, in its order of reading."""
        share += self.net.share(states, 1)[::-1]
        share -= share.max(axis=1, keepdims=True)
        np.exp(share, out=share)
        share *= ((np.arange(BODY)[:, None] < self.left[own]) / share.sum(axis=1))[:, None].astype(share.dtype)
        self.sums[own] = share.sum(axis=0, dtype=np.float64).T

    def in_order(self, d: int, windows: np.ndarray) -> None:
        """Read whole texts or their rests in order, side by side; windows in order of rank."""
        rank = self.rank[d][windows]
        for own in np.split(windows, np.flatnonzero(np.diff(rank)) + 1):
            if len(own) and self.rank[d][own[0]]:
                self.begin[d, own] = self.end[d, own + (1 if d else -1)]
            self.read(d, own)

    def at_once(self, d: int, windows: np.ndarray) -> None:
        """Read rests of texts all at once, and again where a window began with another state than its neighbour ended with."""
        inner = windows[self.rank[d][windows] > 0]
        before = inner + (1 if d else -1)
        self.begin[d, inner] = self.end[d, before]
        todo, left = windows, ROUNDS * len(windows)
        while left > 0:
            self.read(d, todo, judge=todo is not windows)
            left -= len(todo)
            off = np.abs(self.end[d, before] - self.begin[d, inner]).max(axis=1, initial=0) > TOLERANCE
            self.begin[d, inner[off]] = self.end[d, before[off]]
            todo = inner[off]
            if not len(todo):
                return
        self.in_order(d, windows[np.isin(self.doc[windows], self.doc[todo])])

    def settle(self) -> None:
        """Find the states that all windows begin with, in both directions."""
        for d in (0, 1):
            rank = self.rank[d]
            order = np.argsort(rank, kind="stable")
            wide = int((np.bincount(rank, minlength=1) >= WIDE).sum())
            cut = int(np.searchsorted(rank[order], wide))
            self.in_order(d, order[:cut])
            if cut < len(order):
                self.at_once(d, order[cut:])
            if self.kept is not None:
                self.read(d, order[~self.judged[d, order]])

    def reread(self) -> None:
        """Judge all windows by another reading, once they have settled."""
        for at in range(0, len(self.doc), SIDE):
            own = np.arange(at, min(at + SIDE, len(self.doc)))
            first, second = (self.net.run(self.bytes_of(own, d), d, h=self.begin[d, own].T) for d in (0, 1))
            self.judge(own, self.net.share(first, 0), second)


def pooled(net: BiGRU, raws: list[bytes]) -> np.ndarray:
    """(texts, labels): the sums of the position probabilities of each text, state carried over all of it."""
    windows = Windows(net, raws)
    windows.settle()
    if windows.kept is None:
        windows.reread()
    total = np.zeros((len(raws), len(net.labels)))
    np.add.at(total, windows.doc, windows.sums)
    return total


def predict(net: BiGRU | None, texts: list[str | None]) -> list:
    """lang_pred, score, readable of texts."""
    known = readable(texts)
    if net is None:
        return [pa.array([UNKNOWN] * len(texts), pa.string()), np.zeros(len(texts)), known]
    total = pooled(net, [(t or "").encode("utf-8", "replace") for t in texts])
    size, best = total.sum(axis=1), total.argmax(axis=1)
    score = np.where(known, np.clip(total[np.arange(len(texts)), best] / np.maximum(size, 1e-9), 0, 1), 0.0)
    return [pa.array([net.labels[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()), score, known]


def training_rows(docs: DataFrame) -> list:
    """Pieces of whole texts with their language: a bounded sample, by hashes, of the rows that may be learnt from.

    Hash filters let about as many documents and pieces through as the bounds, whatever the corpus
    holds, so that no partition sends the driver more than its share.
    """
    own = docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    some = own.where(below(own.count(), SAMPLE_DOCS, "doc_id", "text")).where(F.col("text").rlike("\\p{L}"))
    some = some.select("lang", F.xxhash64("doc_id", "text").alias("h"), F.encode("text", "UTF-8").alias("raw"))
    pieces = F.ceil(F.octet_length("raw") / PIECE).cast("int")
    total = some.agg(F.sum(pieces)).first()[0] or 0
    cut = some.select("lang", "h", "raw", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("at")).where(below(total, SAMPLE_PIECES, "h", "at"))
    piece = F.substr("raw", F.col("at") * PIECE + 1, F.lit(PIECE))
    return cut.select(piece.alias("piece"), "lang", F.xxhash64("h", "at").alias("order")).orderBy("order", "piece", "lang").limit(SAMPLE_PIECES).collect()


def identify(docs: DataFrame, net: BiGRU | None, carry: tuple[str, ...] = ()) -> DataFrame:
    """The language of every whole text.

    docs: doc_id, text; of other columns, those named in `carry` are kept. Returns doc_id, lang_pred,
    score (mean probability of that language over all positions), readable (the text has a letter).
    Null text or text without a letter: 'und', score 0, not readable. Without a network (nothing to
    learn from) everything is 'und' with score 0, but readable as ever. Repeated rows give repeated
    rows, an empty table an empty result.
    """
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[c for c in carry if c != "text"])
    return by_text(kept, "lang_pred string, score double, readable boolean", lambda: lambda texts: predict(net, texts), BATCH_CHARS, "text" in carry)


def fit(docs: DataFrame, **options) -> BiGRU | None:
    """Train on the bounded sample; None if no row may be learnt from."""
    rows = training_rows(docs)
    return train([bytes(r["piece"]) for r in rows], [r["lang"] for r in rows], **options) if rows else None


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = identify(docs, fit(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
