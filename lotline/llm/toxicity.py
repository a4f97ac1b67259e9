"""Operator 4: toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features are rates within one text: densities of two lexicons (a short fixed list, and words and
word stems that mark toxic texts among the learning rows), their nearness to second-person words, capitals,
punctuation, and words that turn into lexicon words once look-alike characters are read as letters.
Trees are grown on histograms in numpy on the driver, over a bounded sample of labelled rows; a
quarter of that sample is kept from the trees and fits the monotone map from margin to probability.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.llm.common import U, below, by_text, forget, held_out, staged, table, word_bounds, word_hashes

#: Bound of the training sample (rows), and of the learnt lexicon (words and stems).
SAMPLE_ROWS, LEXICON_WORDS = 20_000, 600
#: Lengths in characters of the word stems that the learnt lexicon holds besides whole words.
STEMS = (3, 4, 5, 6, 7)
THRESHOLD = 0.3
#: Characters scored together in a task.
BATCH_CHARS = 500_000
NEAR = 6
INSULTS = "idiot idiots stupid moron morons dumb clown pathetic loser losers trash garbage worthless disgusting ugly hate kill scum fool fools jerk shut crap damn hell bastard bitch shit fuck fucking ass asshole liar creep freak imbecile dumm idiota estupido connard salope imbécile dummkopf arschloch".split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi vous votre ton ta usted ustedes tú ti su".split()
#: Characters read as the letter they look like.
LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}
NAMES = ["fixed_rate", "fixed_any", "learnt_rate", "learnt_weight", "learnt_most", "learnt_distinct", "person_rate", "near_rate", "near_any", "caps_rate", "caps_words", "punct_rate", "exclaim_rate", "question_rate", "repeat_punct", "symbol_rate", "digit_rate", "mixed_rate", "hidden_rate", "hidden_any", "log_words", "word_length"]


def hashes_of(words: list[str]) -> np.ndarray:
    if not words:
        return np.zeros(0, U)
    raws = [w.encode() for w in words]
    raw = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raws]) - 1
    return word_hashes(raw, ends - np.array([len(r) for r in raws]), ends)


def letters_table(lookalike: bool) -> np.ndarray:
    """Bytes to lower-case letters, everything else to a space; look-alikes to their letters if asked."""
    t = np.full(256, 32, np.uint8)
    for a, b in ((65, 91), (97, 123)):
        t[a:b] = np.arange(97, 123, dtype=np.uint8)
    t[128:] = np.arange(128, 256, dtype=np.uint8)
    t[ord("'")] = ord("'")
    for a, b in LOOKALIKE.items() if lookalike else ():
        t[ord(a)] = ord(b)
    return t


PLAIN, READ_AS = letters_table(False), letters_table(True)


def within(raw: np.ndarray, s: np.ndarray, e: np.ndarray, what: np.ndarray) -> np.ndarray:
    """How many bytes of each span are of the kind that `what` flags."""
    total = np.concatenate(([0], np.cumsum(what)))
    return total[e] - total[s]


def lowered(text: str, raw: bytes) -> bytes:
    """The text in lower case as bytes; as it is in the rare case that its length in bytes would change."""
    low = text.lower().encode("utf-8", "replace")
    return low if len(low) == len(raw) else raw


def ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


@dataclass
class Features:
    """Turns texts into rows of NAMES; words and weights are the learnt lexicon."""

    words: list[str] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def __post_init__(self) -> None:
        """words: whole words, and stems with a closing '*'."""
        self.fixed, self.person = np.sort(hashes_of(INSULTS)), np.sort(hashes_of(SECOND_PERSON))
        groups: dict[int, list[tuple[str, float]]] = {}
        for w, v in zip(self.words, self.weights):
            stem = w.removesuffix("*")
            groups.setdefault(len(stem.encode()) if w != stem else 0, []).append((stem, v))
        self.groups = {}
        for size, entries in groups.items():
            h = hashes_of([w for w, _ in entries])
            order = np.argsort(h)
            self.groups[size] = h[order], np.array([v for _, v in entries])[order]

    def lexicon(self, raw: np.ndarray) -> tuple[np.ndarray, ...]:
        """Word starts, hashes, whether in the fixed list, greatest learnt weight of the word or one of its stems."""
        s, e = word_bounds(raw)
        h = word_hashes(raw, s, e)
        value = np.zeros(len(h))
        for size, (keys, weights) in self.groups.items():
            fit = np.flatnonzero(e - s >= size)
            own = word_hashes(raw, s[fit], s[fit] + size) if size else h
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            value[fit] = np.maximum(value[fit], np.where(keys[at] == own, weights[at], 0.0))
        return s, h, np.isin(h, self.fixed), value

    def rows(self, texts: list[str | None]) -> np.ndarray:
        raws = [(t or "").encode("utf-8", "replace") for t in texts]
        raw = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
        base = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raws])))
        n_docs, n_bytes = len(raws), np.maximum(np.diff(base) - 1, 0)
        low = np.frombuffer(b"\n".join([lowered(t or "", r) for t, r in zip(texts, raws)]) + b"\n", np.uint8)
        s, h, fixed, value = self.lexicon(PLAIN[low])
        doc = np.searchsorted(base, s, "right") - 1
        per = lambda flags: np.bincount(doc, flags, n_docs)
        person = np.isin(h, self.person)
        hit = fixed | (value > 0)
        place = np.flatnonzero(person)
        near = np.zeros(len(h), bool)
        hits = np.flatnonzero(hit)
        if len(place) and len(hits):
            at = np.searchsorted(place, hits)
            for side in (np.maximum(at - 1, 0), np.minimum(at, len(place) - 1)):
                near[hits] |= (np.abs(place[side] - hits) <= NEAR) & (doc[place[side]] == doc[hits])
        words = per(None)
        most = np.zeros(n_docs)
        np.maximum.at(most, doc, value)
        pairs = np.unique(np.stack((doc[hit], h[hit].view(np.int64)), axis=1), axis=0) if hit.any() else np.zeros((0, 2), np.int64)
        # Tokens between blanks: capitals, mixed characters, and words that show when look-alikes are read as letters.
        ts, te = word_bounds(raw)
        tdoc = np.searchsorted(base, ts, "right") - 1
        upper, lower = (raw >= 65) & (raw <= 90), (raw >= 97) & (raw <= 122)
        digit, high = (raw >= 48) & (raw <= 57), raw >= 128
        mark = ~(upper | lower | digit | high) & (raw > 32)
        letters = within(raw, ts, te, upper | lower | high)
        odd = within(raw, ts, np.maximum(te - 1, ts), digit | (mark & (raw != 45) & (raw != 39)))
        mixed = (letters > 0) & (odd > 0)
        read = np.where(self._spread(len(raw), ts[mixed], te[mixed]), READ_AS[low], np.uint8(32))
        rs, _, rfixed, rvalue = self.lexicon(read)
        rdoc = np.searchsorted(base, rs, "right") - 1
        hidden = np.bincount(rdoc, rfixed | (rvalue > 0), n_docs)
        tokens = np.bincount(tdoc, minlength=n_docs)
        caps = within(raw, ts, te, upper)
        bytes_of = lambda what: within(raw, base[:-1], base[1:] - 1, what)
        again = mark & np.concatenate(([False], raw[1:] == raw[:-1]))
        learnt = value > 0
        columns = [
            ratio(per(fixed), words), per(fixed) > 0, ratio(per(learnt), words), ratio(per(value), words), most, ratio(np.bincount(pairs[:, 0], minlength=n_docs), np.sqrt(words)),
            ratio(per(person), words), ratio(per(near), words), per(near) > 0,
            ratio(bytes_of(upper), bytes_of(upper | lower | high)), ratio(np.bincount(tdoc, (caps > 1) & (caps == letters), n_docs), tokens),
            ratio(bytes_of(mark), n_bytes), ratio(bytes_of(raw == 33), n_bytes), ratio(bytes_of(raw == 63), n_bytes), ratio(bytes_of(again), n_bytes),
            ratio(bytes_of(np.isin(raw, np.frombuffer(b"#$%&*@^~|", np.uint8))), n_bytes), ratio(bytes_of(digit), n_bytes),
            ratio(np.bincount(tdoc, mixed, n_docs), tokens), ratio(hidden, tokens), hidden > 0,
            np.log1p(tokens), ratio(n_bytes, tokens),
        ]
        return np.stack([np.asarray(c, float) for c in columns], axis=1)

    @staticmethod
    def _spread(n: int, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Flags of the bytes inside the given spans."""
        edges = np.zeros(n + 1, np.int64)
        edges[s] += 1
        edges[e] -= 1
        return np.cumsum(edges[:n]) > 0


@dataclass
class BoostedTrees:
    """Complete trees of one depth: per tree and inner node a feature and a cut, per leaf a value."""

    start: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        for f, c, v in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            out += v[node - (len(v) - 1)]
        return out


def grow(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 3, rate: float = 0.1, bins: int = 48, ridge: float = 1.0) -> BoostedTrees:
    """Newton boosting of the logistic loss over quantile bins."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(x.shape[1])]
    code = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(mean / (1 - mean)))
    margin = np.full(len(y), start)
    features, cuts, leaves = [], [], []
    inner = 2**depth - 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        f, c, code_cut = np.zeros(inner, np.int64), np.full(inner, np.inf), np.full(inner, bins)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-6)
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                key = (node - first) * bins + code[:, j]
                gs = np.bincount(key, g, width * bins).reshape(width, bins).cumsum(1)
                hs = np.bincount(key, h, width * bins).reshape(width, bins).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt**2 / (ht + ridge)
                gain = np.where((hs > 1) & (ht - hs > 1), gain, 0)[:, : len(e)]
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                for k in np.flatnonzero(top > best):
                    best[k], f[first + k], c[first + k], code_cut[first + k] = top[k], j, e[at[k]], at[k]
            node = 2 * node + 1 + (code[np.arange(len(y)), f[node]] > code_cut[node])
        node -= inner
        v = -rate * np.bincount(node, g, inner + 1) / (np.bincount(node, h, inner + 1) + ridge)
        margin += v[node]
        features.append(f)
        cuts.append(c)
        leaves.append(v)
    return BoostedTrees(start, np.array(features), np.array(cuts), np.array(leaves))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the monotone least-squares fit, by pooling adjacent violators."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for a, b in zip(x[order].tolist(), y[order].tolist()):
        blocks.append([b, 1, a, a])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            total, n, _, hi = blocks.pop()
            blocks[-1] = [blocks[-1][0] + total, blocks[-1][1] + n, blocks[-1][2], hi]
    # Each block is flat between its ends; one row's worth of the overall mean keeps it off 0 and 1.
    mean = float(y.mean())
    knots = [(z, (t + mean) / (n + 1)) for t, n, lo, hi in blocks for z in ((lo,) if lo == hi else (lo, hi))]
    return np.array([k[0] for k in knots]), np.maximum.accumulate(np.array([k[1] for k in knots]))


@dataclass
class ToxicityModel:
    features: Features
    trees: BoostedTrees
    knots: np.ndarray
    values: np.ndarray

    def score(self, texts: list[str | None]) -> np.ndarray:
        return np.clip(np.interp(self.trees.margin(self.features.rows(texts)), self.knots, self.values), 0, 1)


def learning_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, toxic of the rows that may be learnt from: about SAMPLE_ROWS at most, by hashes of id and text.

    First ids are bounded, then their rows: an id may stand in any number of rows, of which equal ones are
    learnt from once. Hash filters let about as many through as the bound, whatever one id or partition holds.
    """
    marks = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    ids = marks.where(below(marks.count(), SAMPLE_ROWS, "doc_id")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    own = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    different = own.select("doc_id", F.xxhash64("text").alias("h")).distinct().count()
    return own.where(below(different, SAMPLE_ROWS, "doc_id", "text")).dropDuplicates(["doc_id", "text"])


def learnt_lexicon(rows: DataFrame) -> tuple[list[str], list[float]]:
    """Words, and stems marked by '*', that stand clearly more often in toxic learning texts, with their log odds."""
    words = F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), "[^\\p{L}']+"))
    stems = [F.array_distinct(F.transform(_longer(words, n), _stem(n))) for n in STEMS]
    seen = rows.where("pmod(xxhash64(doc_id), 4) <> 0").select("toxic", F.explode(F.concat(words, *stems)).alias("word"))
    counts = seen.where("word <> ''").groupBy("word").agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("n")).first()
    bad, n = total["bad"] or 0, total["n"] or 0
    odds = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("n") - F.col("bad") + 0.5) / (n - bad + 1.0))
    good = counts.where(F.col("bad") >= max(5, bad // 100)).withColumn("odds", odds).where("odds > 2.5").orderBy(F.desc(F.col("odds") * F.log("bad")), "word").limit(LEXICON_WORDS).collect()
    return [r["word"] for r in good], [r["odds"] for r in good]


def _longer(words, n: int):
    return F.filter(words, lambda w: F.length(w) > n)


def _stem(n: int):
    return lambda w: F.concat(F.left(w, F.lit(n)), F.lit("*"))


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel | None:
    """Learn from the bounded sample; None unless it has both labels.

    A quarter of the sample fits the calibration. Where that quarter or the rest has one label only
    (very small samples), trees and calibration both use all of it.
    """
    rows = staged(learning_rows(docs, labels), "sample")
    features = Features(*learnt_lexicon(rows))

    def start():
        return lambda texts: [pa.array(features.rows(texts).tolist(), pa.list_(pa.float64()))]

    seen = by_text(rows.select(F.xxhash64("doc_id").alias("doc_id"), "toxic", "text"), "x array<double>", start, BATCH_CHARS)
    got = seen.orderBy("doc_id", "x").limit(SAMPLE_ROWS).toPandas()
    forget(rows)
    if got["toxic"].nunique() < 2:
        return None
    x, y, part = np.stack(got["x"].to_numpy()), got["toxic"].to_numpy(float), got["doc_id"].to_numpy() % 4 == 0
    if len(set(y[part])) < 2 or len(set(y[~part])) < 2:
        part[:] = False
    trees = grow(x[~part], y[~part])
    own = part if part.any() else ~part
    return ToxicityModel(features, trees, *isotonic(trees.margin(x[own]), y[own]))


def toxicity(docs: DataFrame, model: ToxicityModel | None, threshold: float = THRESHOLD, carry: tuple[str, ...] = ()) -> DataFrame:
    """Score every whole text for toxicity.

    docs: doc_id, text; of other columns, those named in `carry` are kept. Returns doc_id, score
    (0 to 1), predicted (1 if score >= threshold). Null and empty texts are scored as texts without
    words. Without a model (no rows to learn from) every score is 0. Repeated rows give repeated
    rows, an empty table an empty result.
    """

    def start():
        def work(texts: list[str | None]) -> list:
            score = model.score(texts) if model else np.zeros(len(texts))
            return [score, (score >= threshold).astype(np.int32)]

        return work

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[c for c in carry if c != "text"])
    return by_text(kept, "score double, predicted int", start, BATCH_CHARS, "text" in carry)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
