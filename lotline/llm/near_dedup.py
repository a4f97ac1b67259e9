"""Operator 7: near-duplicate classes by DartMinHash signatures and banded joining.

A text is the weighted set of its five-word shingles. Darts are thrown, by hashes, at the plane of
(weight, rank) of every element, each as far above the one before as a Poisson process says; a document
owns the darts below its elements' weights. Each dart belongs to one coordinate, and a coordinate's
value is the owned dart of least rank. Two documents agree in a coordinate with the probability of
their weighted Jaccard similarity.

Documents with equal shingle sets are one vertex from the start. Vertices that share a band are
candidates; each bucket is linked through a pivot, candidates are verified exactly, and only buckets
that still hold several components are looked at again, so that a large group of copies costs one
comparison per member. What is left is settled exactly: small buckets pair by pair, large ones by
chunks of which every two meet in one bounded group. No link between components is left untested.
Tables that nothing reads any more are removed from the shared folder as the work goes on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotline.llm.common import U, forget, gram_hashes, mix, staged, table, word_bounds, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
#: A pair of similarity 0.8 shares no band with probability (1 - 0.8**5)**32 = 3e-6.
BANDS, ROWS = 32, 5
#: Looks at buckets of several components through one more pivot each, before the exact rest.
PIVOT_ROUNDS = 1
#: Buckets up to this size are settled pair by pair; larger ones chunk by chunk (members, shingles in a chunk).
SMALL, CHUNK, CHUNK_WEIGHT = 32, 256, 200_000
MASK = (1 << 64) - 1
#: Area of a strip of darts: a text with few shingles has several strips of each, thrown side by side.
AREA = 8
C1, C2, C3 = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)


class Sets(NamedTuple):
    """Weighted shingle sets of several texts, one after another: hashes in order, weights, and where each text's begin."""

    keys: np.ndarray
    weights: np.ndarray
    at: np.ndarray

    def some(self, keep: np.ndarray) -> Sets:
        """The sets of the texts that `keep` flags."""
        size = np.diff(self.at)
        use = np.repeat(keep, size)
        return Sets(self.keys[use], self.weights[use], np.concatenate(([0], np.cumsum(size[keep]))))

    def each(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(self.keys[a:b], self.weights[a:b]) for a, b in zip(self.at.tolist(), self.at[1:].tolist())]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of per-element values over each set, modulo 2**64; empty sets give 0."""
        total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
        return total[self.at[1:]] - total[self.at[:-1]]


def shingles(texts: list[str], size: int, counted: bool) -> Sets:
    """Shingles of lower-cased words with their counts (or 1); texts of fewer words are one shingle."""
    raws = [t.lower().encode("utf-8", "replace") for t in texts]
    raw = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
    base = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raws])))
    s, e = word_bounds(raw)
    h = word_hashes(raw, s, e)
    first = np.searchsorted(s, base)  # first word of each text
    n = np.diff(first)
    grams = gram_hashes(h, size)
    many = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    at = np.concatenate(([0], np.cumsum(many)))
    keys = np.empty(at[-1], U)
    for d, (a, k, to) in enumerate(zip(first.tolist(), n.tolist(), at.tolist())):
        if k >= size:
            keys[to : to + k - size + 1] = np.sort(grams[a : a + k - size + 1])
        elif k:
            keys[to] = gram_hashes(h[a : a + k], k)[0]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    new[at[:-1][many > 0]] = True
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(keys))) if counted else np.ones(len(start), np.int64)
    return Sets(keys[start], count.astype(np.int64), np.searchsorted(start, at))


def after(rank: np.ndarray, name: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Ranks of the darts `name` in strips of these widths, if `rank` are those of the darts before them."""
    return rank - np.log(((name >> U(24)).view(np.int64) + 1) * 2.0**-40) / width


def strips(sets: Sets, doc: np.ndarray, since: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, ...]:
    """Strips that begin from the document's `since` to below its `reach`: name and rank of the first dart, document, end, width, share owned.

    The plane is cut into bands of weight and, in each, strips of area AREA. A strip's darts come out of
    its hash: of a name the high 40 bits give the distance to the dart before, the low 24 the coordinate.
    """
    out: list[tuple[np.ndarray, ...]] = []
    band, low, width = 0, 0, 1
    rows = np.arange(len(doc))
    while len(rows):
        begun = np.ceil(since * (width / AREA)).astype(np.int64)
        many = (np.ceil(reach * (width / AREA)).astype(np.int64) - begun)[doc[rows]]
        begun = begun[doc[rows]]
        first, more = np.flatnonzero(many > 0), np.flatnonzero(many > 1)
        again = many[more] - 1
        row = np.concatenate((rows[first], np.repeat(rows[more], again)))
        nth = np.concatenate((begun[first], np.arange(again.sum()) - np.repeat(np.cumsum(again) - again - begun[more] - 1, again)))
        name = mix(sets.keys[row] + nth.astype(U) * C2 + U(band * int(C1) & MASK))
        wide, start = np.full(len(row), float(width)), nth * (AREA / width)
        out.append((name, after(start, name, wide), doc[row], start + AREA / width, wide, (sets.weights[row] - low) / width))
        band, low, width = band + 1, low + width, low + width
        rows = rows[sets.weights[rows] > low]
    return tuple(np.concatenate(x) for x in zip(*out))


def signatures(sets: Sets, k: int) -> np.ndarray:
    """(texts, k) names of the least darts. Every set must have an element."""
    count = len(sets.at) - 1
    doc = np.repeat(np.arange(count), np.diff(sets.at))
    step = k / sets.sums(sets.weights)
    since, reach = np.zeros(count), (math.log(k) + 2) * step
    out, least = np.zeros(count * k, U), np.full(count * k, np.inf)
    todo = np.ones(count, bool)
    thrown = strips(sets, doc, since, reach)
    while True:
        name, rank, own, end, width, share = thrown
        limit, cut = np.minimum(reach[own], end), bool((share < 1).any())
        at = np.flatnonzero(rank < limit)
        while len(at):
            n, r = name[at], rank[at]
            slot = own[at] * k + ((n & U(0xFFFFFF)) * U(k) >> U(24)).view(np.int64)
            use = r < least[slot]
            if cut:  # some elements reach into a band, but not through it
                use &= (mix(n + C2) >> U(11)).view(np.int64) * 2.0**-53 < share[at]
            use = np.flatnonzero(use)
            s, low = slot[use], r[use]
            np.minimum.at(least, s, low)
            best = low == least[s]
            out[s[best]] = n[use[best]]
            name[at] = n = mix(n + C3)
            rank[at] = r = after(r, n, width[at])
            at = at[r < limit[at]]
        todo = ~np.isfinite(least).reshape(count, k).all(axis=1)
        if not todo.any():
            return out.reshape(count, k)
        # Some coordinate has no dart yet: look at higher ranks, from the darts that wait there.
        since, reach = reach, reach + 2 * step
        wait = todo[own] & (rank < end)
        part = sets.some(todo)
        new = strips(part, doc[todo[doc]], since, reach)
        thrown = tuple(np.concatenate((x[wait], y)) for x, y in zip(thrown, new))


def text_batches(pdf: pd.DataFrame, chars: int = 400_000, rows: int = 64) -> Iterator[pd.DataFrame]:
    group = np.maximum(pdf["text"].str.len().cumsum() // chars, np.arange(len(pdf)) // rows)
    for _, part in pdf.groupby(group):
        yield part


def sign(docs: DataFrame, counted: bool, bands: int, rows: int, shingle: int) -> DataFrame:
    """doc_id, id_a, id_b (name of the shingle set), total weight, bands; documents without words are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in text_batches(pdf):
                sets = shingles(part["text"].tolist(), shingle, counted)
                some = np.diff(sets.at) > 0
                if not some.any():
                    continue
                sets = sets.some(some)
                sig = signatures(sets, bands * rows).reshape(-1, bands, rows)
                name = np.zeros(sig.shape[:2], U)
                for i in range(rows):
                    name = mix(name * C1 + sig[:, :, i])
                name = mix(name + np.arange(bands, dtype=U)[None, :] * C2).view(np.int64)
                w = sets.weights.astype(U)
                ids = [sets.sums(mix(sets.keys * c + w + d)).view(np.int64) for c, d in ((C1, U(0)), (C2, C3))]
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy()[some], "id_a": ids[0], "id_b": ids[1], "total": sets.sums(sets.weights), "bands": list(name)})

    kept = docs.where("text is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return kept.mapInPandas(run, "doc_id long, id_a long, id_b long, total long, bands array<long>")


def packed_sets(docs: DataFrame, counted: bool, shingle: int) -> DataFrame:
    """rep, keys, weights of the texts, as bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in text_batches(pdf):
                sets = shingles(part["text"].tolist(), shingle, counted).each()
                yield pd.DataFrame({"rep": part["rep"].to_numpy(), "keys": [k.tobytes() for k, _ in sets], "weights": [w.astype("<u4").tobytes() for _, w in sets]})

    return docs.mapInPandas(run, "rep long, keys binary, weights binary")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """a, b of the pairs whose weighted Jaccard similarity reaches the threshold, worked out exactly."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ok = []
            for ka, wa, kb, wb in zip(pdf["ka"], pdf["wa"], pdf["kb"], pdf["wb"]):
                ka, kb, wa, wb = np.frombuffer(ka, U), np.frombuffer(kb, U), np.frombuffer(wa, "<u4"), np.frombuffer(wb, "<u4")
                at = np.minimum(np.searchsorted(kb, ka), len(kb) - 1)
                both = int(np.minimum(wa, wb[at])[kb[at] == ka].sum())
                ok.append(both >= threshold * (int(wa.sum()) + int(wb.sum()) - both))
            yield pdf.loc[ok, ["a", "b"]]

    one = sets.select(F.col("rep").alias("a"), F.col("keys").alias("ka"), F.col("weights").alias("wa"))
    two = sets.select(F.col("rep").alias("b"), F.col("keys").alias("kb"), F.col("weights").alias("wb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ka", "wa", "kb", "wb").mapInPandas(run, "a long, b long")


def components(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """rep, label: the least vertex of each vertex's component. Labels spread along edges and then skip ahead."""
    both = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    now = both.select(F.col("a").alias("rep")).distinct().withColumn("label", F.col("rep"))
    used = [both]
    if labels is not None:
        old = labels.select(F.col("rep").alias("a"), F.col("label").alias("b")).where("a <> b")
        both = staged(both.unionByName(old).unionByName(old.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
        used.append(both)
        now = labels.unionByName(now.join(labels, "rep", "left_anti"))
    now = staged(now, "labels")
    while True:
        least = both.join(now, both["b"] == now["rep"]).groupBy("a").agg(F.min("label").alias("least"))
        step = now.join(least, now["rep"] == least["a"], "left").select("rep", F.least("label", F.coalesce("least", "label")).alias("label"), F.col("label").alias("old"))
        step = staged(step, "step")
        ahead = step.select(F.col("rep").alias("label"), F.col("label").alias("next"))
        jumped = staged(step.join(ahead, "label", "left").select("rep", F.coalesce("next", "label").alias("label"), "old"), "labels")
        forget(now, step)
        now = jumped.select("rep", "label")
        if jumped.where("label <> old").isEmpty():
            forget(*used)
            return now


def shared_bands(vertices: DataFrame) -> DataFrame:
    """key, rep, total, pivot: bands that vertices of two documents or more share, and the least document of each."""
    own = Window.partitionBy("key")
    known = vertices.select(F.explode("bands").alias("key"), "rep", "total").withColumns({"pivot": F.min("rep").over(own), "last": F.max("rep").over(own)})
    return known.where("pivot < last").drop("last").distinct()


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """key, rep, total, label, n, weight: members of the buckets that hold two components or more; n and weight of their bucket."""
    known = members.select("key", "rep", "total").join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    mixed = known.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n"), F.sum("total").alias("weight")).where("lo <> hi")
    return known.join(mixed.select("key", "n", "weight"), "key")


def links_of(part: pd.DataFrame, threshold: float) -> list[tuple[int, int]]:
    """Links between the components of a few hundred sets: enough of them to join what similar pairs join."""
    reps, label = part["rep"].tolist(), part["label"].tolist()
    keys = [np.frombuffer(k, U) for k in part["keys"]]
    weights = [np.frombuffer(w, "<u4") for w in part["weights"]]
    doc = np.repeat(np.arange(len(reps)), [len(k) for k in keys])
    _, token, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    weight = np.concatenate(weights)
    both = np.zeros((len(reps), len(reps)))
    below = 0
    for level in np.unique(weight).tolist():  # shared weight, one step between the weights that occur at a time
        use = (weight >= level) & (count[token] > 1)
        step, below = level - below, level
        _, column = np.unique(token[use], return_inverse=True)
        own = doc[use]
        for at in range(0, int(column.max(initial=-1)) + 1, 4096):
            here = (column >= at) & (column < at + 4096)
            has = np.zeros((len(reps), 4096), np.float32)
            has[own[here], column[here] - at] = 1
            both += step * (has @ has.T)
    total = np.array([int(w.sum()) for w in weights], float)
    similar = both >= threshold * (total[:, None] + total[None, :] - both)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(similar, 1)))):
        a, b = find(label[i]), find(label[j])
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((reps[i], reps[j]))
    return out


def chunk_pairs(rows: DataFrame) -> DataFrame:
    """key, rep, label, i, j: members of large buckets, copied to every pair of chunks in which two components can meet.

    A bucket's largest component is cut into chunks of its own, which never meet each other; the rest meet
    them and themselves. So a component of very many copies and a few strangers cost what the copies cost.
    """
    sizes = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("m"), F.sum("total").alias("w"))
    top = sizes.groupBy("key").agg(F.max(F.struct("m", "w", "label")).alias("top"))
    cut = lambda n, w: F.greatest(F.ceil(n / CHUNK), F.ceil(w / CHUNK_WEIGHT)).cast("int")
    own = rows.join(top, "key").withColumns({"largest": F.col("label") == F.col("top.label"), "many": cut(F.col("top.m"), F.col("top.w")), "rest": cut(F.col("n") - F.col("top.m"), F.col("weight") - F.col("top.w"))})
    place = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    own = own.withColumn("own", F.when(F.col("largest"), place(F.col("many"))).otherwise(F.col("many") + place(F.col("rest"))))
    others = F.explode(F.sequence(F.when(F.col("largest"), F.col("many")).otherwise(0), F.col("many") + F.col("rest") - 1))
    return own.select("key", "rep", "label", "own", others.alias("other")).select("key", "rep", "label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def linked_in_chunks(rows: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """a, b: links between components inside large buckets, found in groups of bounded size."""

    def run(key, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(links_of(part, threshold), columns=["a", "b"], dtype="int64")

    return chunk_pairs(rows).join(sets, "rep").groupBy("key", "i", "j").applyInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, counted: bool = True, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, class_id: the least doc_id of the document's near-duplicate class.

    docs: doc_id, text; other columns are ignored. Classes are the connected components of pairs whose
    shingle counts have a weighted Jaccard similarity (counted=False: whose shingle sets have a Jaccard
    similarity) of at least `threshold`. Texts of fewer words than a shingle are one shingle; null, empty
    and wordless texts are classes of their own. Rows with one doc_id are one document with several
    texts: each text is compared, and what is like any of them joins the document's class. A null doc_id
    gets a null class. Repeated rows give repeated rows; empty in, empty out.
    """
    classes = class_table(docs, threshold, counted, bands, rows, shingle)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    return own.join(classes, "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def class_table(docs: DataFrame, threshold: float = THRESHOLD, counted: bool = True, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, class_id as in near_duplicates, once for every doc_id that has a text with words."""
    signed = staged(sign(docs, counted, bands, rows, shingle), "signatures")
    name = ["id_a", "id_b", "total"]
    vertices = staged(signed.groupBy(*name).agg(F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands")), "vertices")
    # A vertex is named by its least document; a document of several texts ties its vertices together.
    several = signed.groupBy("doc_id").agg(F.min(F.struct(*name)).alias("lo"), F.max(F.struct(*name)).alias("hi")).where("lo <> hi").select("doc_id")
    tied = signed.join(several, "doc_id").select("doc_id", *name).distinct().join(vertices.select(*name, "rep"), name)
    tied = staged(tied.join(tied.groupBy("doc_id").agg(F.min("rep").alias("b")), "doc_id").select(F.col("rep").alias("a"), "b").where("a <> b").distinct(), "tied")
    members = staged(shared_bands(vertices), "members")
    ids = members.select("rep").distinct()
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("rep"), "text").join(ids, "rep", "left_semi").groupBy("rep", F.xxhash64("text")).agg(F.min("text").alias("text"))
    sets = staged(packed_sets(texts.select("rep", "text"), counted, shingle), "sets")

    def close(pairs: DataFrame) -> DataFrame:
        """Pairs whose weights allow the threshold."""
        return pairs.where(F.least("ta", "tb") >= F.lit(threshold) * F.greatest("ta", "tb")).select("a", "b")

    pivots = members.select(F.col("rep").alias("b"), F.col("total").alias("tb")).distinct()
    first = members.where("rep <> pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b"), F.col("total").alias("ta")).distinct().join(pivots, "b")
    tested = staged(ordered(close(first)), "pairs")
    labels = components(verified(tested, sets, threshold).unionByName(tied))
    for turn in range(PIVOT_ROUNDS):
        rows = open_members(members, labels)
        pivot = rows.groupBy("key").agg(F.max_by(F.struct(F.col("rep").alias("b"), F.col("total").alias("tb"), F.col("label").alias("lb")), F.xxhash64("rep", F.lit(turn))).alias("p")).select("key", "p.*")
        pairs = rows.select("key", F.col("rep").alias("a"), F.col("total").alias("ta"), F.col("label").alias("la")).join(pivot, "key").where("la <> lb")
        fresh = staged(ordered(close(pairs)).join(tested, ["a", "b"], "left_anti"), "pairs")
        before, labels = labels, components(verified(fresh, sets, threshold), labels)
        old, tested = tested, staged(tested.unionByName(fresh), "tested")
        forget(before, fresh, old)
    rows = staged(open_members(members, labels), "open")
    small = rows.where(F.col("n") <= SMALL)
    left, right = (small.select("key", F.col("rep").alias(x), F.col("total").alias(f"t{x}"), F.col("label").alias(f"l{x}")) for x in "ab")
    fresh = staged(ordered(close(left.join(right, "key").where("la <> lb and a > b"))).join(tested, ["a", "b"], "left_anti"), "pairs")
    before, labels = labels, components(verified(fresh, sets, threshold).unionByName(linked_in_chunks(rows.where(F.col("n") > SMALL), sets, threshold)), labels)
    reps = vertices.select(*name, "rep").join(labels, "rep", "left").select(*name, F.coalesce("label", "rep").alias("label"))
    classes = staged(signed.select("doc_id", *name).distinct().join(reps, name).groupBy("doc_id").agg(F.min("label").alias("class_id")), "classes")
    forget(before, fresh, rows, tested, members, sets, tied, signed, vertices, labels)
    return classes


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents
), g as (
  select doc_id, unnest(case when len(ws) >= 5 then list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as s from w
), c as (
  select doc_id, s, count(*) as n from g group by all
), t as (
  select doc_id, sum(n) as total from c group by all
), p as (
  select a.doc_id as x, b.doc_id as y, sum(least(a.n, b.n)) as shared from c a join c b on a.s = b.s and a.doc_id < b.doc_id group by all
), e as (
  select x, y from p join t a on a.doc_id = x join t b on b.doc_id = y where shared >= cast(0.8 as double) * (a.total + b.total - shared)
), l as (
  select x, y from e union all select y, x from e
), r as (
  select doc_id, doc_id as label from documents union select l.y, r.label from r join l on l.x = r.doc_id
)
select doc_id, min(label) as class_id from r group by doc_id
"""
