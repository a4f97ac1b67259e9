"""Shared-window search over a whole corpus, without sending every window over the network.

Documents are dealt into small blocks by a hash of doc_id and text. Each window of L units (words or bytes)
has an anchor: the least hash among its m-unit grams. Equal windows have equal anchors, so:

1. every block sends its distinct anchors, packed by hash range ("bucket"), each with how many
   segments it stands in;
2. each bucket finds anchors that occur twice or more anywhere, and answers the blocks;
3. blocks cut out the runs of windows with such an anchor ("segments"), each distinct segment
   once, and send them to the anchor's shard;
4. a shard settles the segments exactly (suffix automaton or suffix array) and answers the blocks;
5. blocks turn the answers into spans of their documents.

A hot passage sends one row per block of text, not per document, in every step; its shard and bucket
still hold as many rows as there are blocks with it. An anchor that stands in very many different segments
(a license line, say) is marked by its bucket; its windows travel one by one, dealt by the hash of
the whole window, so that one frequent gram does not fill one shard.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.llm.common import U, gram_hashes, mix, sliding_min, word_bounds, word_hashes

BLOCK_BYTES = 1 << 20
BUCKET_BYTES = 32 << 20
SHARD_BYTES = 2 << 20
#: Bytes of text that one task takes at most, about.
TASK_BYTES = 64 << 20
#: An anchor with more different segments than this, over all blocks, is split up by window.
DIVERSE = 20_000
LOW = U(0xFFFF)
#: Windows hashed together: their arrays fit a cache, and the places of their grams fit LOW.
CHUNK = 1 << 15
#: Stands for a null doc_id, so that pandas never holds ids as floats, which would round them.
NO_ID = np.iinfo(np.int64).max
PLACES = np.arange(CHUNK + (1 << 12), dtype=U)


class Runs(NamedTuple):
    """Per run: anchor (48 bits), first window, end of windows, document."""

    anchor: np.ndarray
    at: np.ndarray
    to: np.ndarray
    doc: np.ndarray


class Block:
    """The documents of one block, in order of doc_id, as one array of units."""

    def __init__(self, pdf: pd.DataFrame, words: bool, length: int, gram: int):
        by = ["doc_id"] if pdf["doc_id"].is_unique else ["doc_id", "text"]
        pdf = pdf.assign(text=pdf["text"].fillna("")).sort_values(by, kind="stable")
        self.pdf, self.words, self.length, self.gram = pdf, words, length, gram
        self.ids = pdf["doc_id"].to_numpy(np.int64)
        self.own_ids = pd.arrays.IntegerArray(self.ids, pdf["no_id"].to_numpy(bool))  # null where the document has none
        self.raws = [t.encode("utf-8", "surrogatepass") for t in pdf["text"]]
        sizes = np.fromiter((len(r) + 1 for r in self.raws), np.int64, len(self.raws))
        self.base = np.concatenate(([0], np.cumsum(sizes)))  # a separator byte follows each text
        self.data = b"\n".join(self.raws) + b"\n"
        self.raw = np.frombuffer(self.data, np.uint8)
        if words:
            self.starts, self.ends = word_bounds(self.raw)
            self.first = np.searchsorted(self.starts, self.base)  # first unit of each document
            self.last = self.first[1:]
        else:
            self.first = self.base
            self.last = self.base[1:] - 1  # the separator belongs to no window
        self.n_units = self.last - self.first[:-1]

    def lows(self) -> np.ndarray:
        """The least key of each window: 48 bits of a gram's hash, then its place in the chunk of windows."""
        wide = self.length - self.gram + 1
        units = word_hashes(self.raw, self.starts, self.ends) if self.words else self.raw
        n = len(units) - self.length + 1
        out = np.empty(max(n, 0), U)
        for c in range(0, n, CHUNK):
            m = min(CHUNK, n - c)
            part = units[c : c + m + self.length - 1]
            g = gram_hashes(part if self.words else part.astype(U), self.gram)
            g &= ~LOW
            g |= PLACES[: len(g)]
            out[c : c + m] = sliding_min(g, wide)
        return out

    def runs(self) -> Runs:
        """The runs of windows of one document and chunk that share their least key; no two windows of a run are equal."""
        low = self.lows()
        n = len(low)
        begin, end = self.first[:-1], np.minimum(self.last - self.length + 1, n)
        real = end > begin
        begin, end = begin[real], end[real]
        cut = np.zeros(n + 1, bool)
        cut[1:n] = low[1:] != low[:-1]
        cut[::CHUNK] = True
        cut[begin] = cut[end] = True
        at = np.flatnonzero(cut)
        to = np.append(at[1:], n)
        doc = np.searchsorted(begin, at, "right") - 1
        keep = (doc >= 0) & (at < end[np.maximum(doc, 0)]) if len(begin) else np.zeros(len(at), bool)
        at, to, doc = at[keep], to[keep], np.flatnonzero(real)[doc[keep]]
        return Runs(low[at] >> U(16), at, to, doc)

    def content(self, at: int, to: int) -> bytes:
        """Units of windows at..to-1, words joined by one space."""
        stop = to - 1 + self.length
        if not self.words:
            return self.data[at:stop]
        return b" ".join(self.data[self.starts[at] : self.ends[stop - 1]].split())  # splits at the same bytes as word_bounds


def packed(hashes: np.ndarray) -> bytes:
    return hashes.astype("<u8").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u8").astype(U)


def sizes(docs: DataFrame) -> dict[str, int]:
    """How many blocks, buckets, shards and partitions; all grow with the bytes of text."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return {"blocks": max(1, math.ceil(total / BLOCK_BYTES)), "buckets": max(1, math.ceil(total / BUCKET_BYTES)), "shards": max(1, math.ceil(total / SHARD_BYTES)), "parts": math.ceil(total / TASK_BYTES)}


def dealt(df: DataFrame, key: str, parts: int) -> DataFrame:
    """df by key over `parts` partitions where the session would use fewer, so that no task outgrows its memory."""
    return df.repartition(parts, key) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def in_blocks(docs: DataFrame, blocks: int, carry: tuple[str, ...]) -> DataFrame:
    extra = [F.col(c).cast("string").alias(f"carry_{i}") for i, c in enumerate(carry)]
    own = F.col("doc_id").cast("long")
    return docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"), F.coalesce(own, F.lit(NO_ID)).alias("doc_id"), own.isNull().alias("no_id"), "text", *extra)


def settle(
    docs: DataFrame,
    words: bool,
    length: int,
    gram: int,
    solve: Callable[[list[bytes], np.ndarray, np.ndarray], list[bytes | None]],
    apply: Callable[[Block | None, Iterator[tuple[int, bytes]]], pd.DataFrame],
    schema: str,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Run the five steps.

    solve(contents, counts, least): for the distinct segments of a shard, with how often each occurs
    and the least doc_id it occurs in, the answer for each segment (None: nothing to say).
    apply(block, answers): the rows of a block; answers yields (first window, answer) of each place of
    an answered segment. Columns named in carry reach apply as strings, carry_0 on.
    """
    n = sizes(docs)
    blocked = in_blocks(docs, n["blocks"], carry)
    keyed = dealt(blocked, "block", n["parts"]).groupBy("block")

    def anchors(key, pdf: pd.DataFrame) -> pd.DataFrame:
        block = Block(pdf, words, length, gram)
        h, at, to, _ = block.runs()
        uniq, count = np.unique(h, return_counts=True)
        for k in np.flatnonzero(count > 16):
            count[k] = max(2, len({block.content(at[r], to[r]) for r in np.flatnonzero(h == uniq[k])}))
        bucket = mix(uniq.copy()) % U(n["buckets"])
        value = (uniq << U(8)) | np.minimum(count, 255).astype(U)
        by = np.argsort(bucket, kind="stable")
        bucket, value = bucket[by], value[by]
        start = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.zeros(0, int)
        return pd.DataFrame({"bucket": bucket[start].astype(np.int64), "block": np.int32(key[0]), "hashes": [packed(x) for x in np.split(value, start[1:])] if len(start) else []})

    def shared(key, pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [unpacked(x) for x in pdf["hashes"]]
        every = np.sort(np.concatenate(parts))
        h = every >> U(8)
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        count = np.add.reduceat((every & U(255)).astype(np.int64), first)
        hot = h[first][count > 1]
        mark = (count[count > 1] > DIVERSE).astype(U)
        out = []
        for part in parts:
            p = part >> U(8)
            at = np.minimum(np.searchsorted(hot, p), max(len(hot) - 1, 0))
            ok = (hot[at] == p) if len(hot) else np.zeros(len(p), bool)
            out.append(packed((p[ok] << U(1)) | mark[at[ok]]))
        pdf = pdf.assign(hashes=out)
        return pdf.loc[[len(x) > 0 for x in out], ["block", "hashes"]]

    def segments(key, pdf: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        cols = ["shard", "block", "seg", "places", "least"]
        if not len(pdf) or not len(answer):
            return pd.DataFrame({c: [] for c in cols})
        block = Block(pdf, words, length, gram)
        h, at, to, doc = block.runs()
        known = np.sort(np.concatenate([unpacked(x) for x in answer["hashes"]]))
        where = np.minimum(np.searchsorted(known >> U(1), h), len(known) - 1)
        hit = known[where] >> U(1) == h
        alone = hit & ((known[where] & U(1)) > 0)
        seen: dict[bytes, tuple[int, list[int], int]] = {}
        for r in np.flatnonzero(hit).tolist():
            for a, b in ((x, x + 1) for x in range(at[r], to[r])) if alone[r] else ((at[r], to[r]),):
                c = block.content(a, b)
                row = seen.get(c)
                if row is None:  # documents come in order of doc_id: the first is the least
                    seen[c] = ((hash_bytes(c) if alone[r] else int(h[r])) % n["shards"], [int(a)], int(block.ids[doc[r]]))
                else:
                    row[1].append(int(a))
        return pd.DataFrame([(s, key[0], c, np.array(p, "<i4").tobytes(), x) for c, (s, p, x) in seen.items()], columns=cols)

    def shards(key, pdf: pd.DataFrame) -> pd.DataFrame:
        codes, segs = pd.factorize(pdf["seg"])
        counts = np.bincount(codes, pdf["places"].str.len() // 4, len(segs)).astype(np.int64)
        least = np.full(len(segs), np.iinfo(np.int64).max)
        np.minimum.at(least, codes, pdf["least"].to_numpy(np.int64))
        answers = solve(list(segs), counts, least)
        said = [answers[c] for c in codes]
        ok = np.fromiter((x is not None for x in said), bool, len(said))
        return pd.DataFrame({"block": pdf["block"][ok], "places": pdf["places"][ok], "answer": [x for x in said if x is not None]})

    def spans(key, pdf: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return apply(None, iter(()))
        found = ((a, x) for p, x in zip(answer["places"], answer["answer"]) for a in np.frombuffer(p, "<i4").tolist())
        return apply(Block(pdf, words, length, gram), found)

    anchor_rows = keyed.applyInPandas(anchors, "bucket long, block int, hashes binary")
    shared_rows = dealt(anchor_rows, "bucket", n["parts"]).groupBy("bucket").applyInPandas(shared, "block int, hashes binary")
    seg_rows = keyed.cogroup(dealt(shared_rows, "block", n["parts"]).groupBy("block")).applyInPandas(segments, "shard long, block int, seg binary, places binary, least long")
    answer_rows = dealt(seg_rows, "shard", n["parts"]).groupBy("shard").applyInPandas(shards, "block int, places binary, answer binary")
    return keyed.cogroup(dealt(answer_rows, "block", n["parts"]).groupBy("block")).applyInPandas(spans, schema)


def hash_bytes(data: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(data)
