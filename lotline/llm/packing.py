"""Operator 10: conflict-constrained best-fit packing of documents into training sequences.

Documents are dealt by a hash of doc_id into blocks of bounded size, and each block is packed by
itself, largest piece first. Open bins stand in order of residual space; each carries a bitmap of the
duplicate clusters it holds and bitmaps of the sources it holds once, twice, and so on up to the
limit. The search begins at the tightest bin with room and goes on to the next larger residual until
a bin without a conflict is found; if there is none, a new bin is opened. No document is dropped:
texts longer than a bin are cut into full bins and a rest.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.llm.common import staged, table
from lotline.llm.near_dedup import class_table

CAPACITY = 2048
PER_SOURCE = 4
BLOCK_ROWS = 20_000
#: Equal rows are dealt into blocks this many at a time.
EQUAL_ROWS = 64
#: Texts are taken about this many bytes at a time to count their words.
STEP = 1 << 17
SCHEMA = "doc_id string, piece int, start long, length long, bin_id string, bin_offset long"


class Bins:
    """Open bins in order of (residual, number), with their conflict bitmaps."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.open: list[tuple[int, int]] = []
        self.used: list[int] = []
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and offset for a piece; source and cluster are single bits, 0 for none."""
        at = bisect_left(self.open, (size, -1))
        for i in range(at, len(self.open)):
            b = self.open[i][1]
            if not self.clusters[b] & cluster and not self.sources[b][-1] & source:
                del self.open[i]
                break
        else:
            b = len(self.used)
            self.used.append(0)
            self.clusters.append(0)
            self.sources.append([0] * self.per_source)
        offset = self.used[b]
        self.used[b] += size
        self.clusters[b] |= cluster
        for n, plane in enumerate(self.sources[b]):
            if not plane & source:
                self.sources[b][n] |= source  # the n-th document of this source
                break
        if self.used[b] < self.capacity:
            insort(self.open, (self.capacity - self.used[b], b))
        return b, offset


def pack(rows: pd.DataFrame, capacity: int, per_source: int) -> list[tuple]:
    """(row, piece, start, length, bin, offset) of one block, in order of placing."""
    bins = Bins(capacity, per_source)
    source = dict.fromkeys(rows["source"].dropna())
    source = {s: 1 << i for i, s in enumerate(source)}
    twice = rows["cluster"][rows["cluster"].duplicated(keep=False)].dropna().unique()
    cluster = {c: 1 << i for i, c in enumerate(twice)}  # clusters of one document cannot conflict
    pieces = []
    for r, (size, s, c) in enumerate(zip(rows["size"].tolist(), rows["source"], rows["cluster"])):
        for p, start in enumerate(range(0, max(size, 1), capacity)):
            pieces.append((min(capacity, size - start), r, p, start, source.get(s, 0), cluster.get(c, 0)))
    pieces.sort(key=lambda x: (-x[0], x[1], x[2]))
    return [(r, p, start, size, *bins.place(size, s, c)) for size, r, p, start, s, c in pieces]


def best_fit_pack(docs: DataFrame, size: Column, cluster: Column, capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> DataFrame:
    """Pack documents into bins of `capacity` units.

    docs: doc_id, source, and what `size` (units of a document) and `cluster` (its duplicate class)
    read; other columns are ignored. Returns one row per piece: doc_id, piece (from 0), start and
    length in units, bin_id, bin_offset. No bin holds two documents of one cluster, nor more than
    per_source pieces of one source. A null source or cluster never conflicts. Null or negative sizes
    count as 0; empty documents get a piece of length 0. Ids travel as text, so that a null id rounds no
    other. Repeated rows are packed as often as they occur. A document larger than a bin has pieces of `capacity` units and a rest. Empty in, empty out.
    """
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)).alias("size"), F.col("source").cast("string").alias("source"), cluster.cast("string").alias("cluster"))
    blocks = max(1, -(-docs.count() // BLOCK_ROWS))
    # Equal rows are counted and dealt in numbered parts: a row's block follows from the rows alone, so a task that
    # runs again deals alike, and no id fills a block by itself.
    rows = rows.groupBy("doc_id", "size", "source", "cluster").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / EQUAL_ROWS))))
    rows = rows.withColumn("copies", F.least(F.lit(EQUAL_ROWS).cast("long"), F.col("copies") - F.col("part") * EQUAL_ROWS))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "size", "source", "cluster", "part"), F.lit(blocks)).cast("int"))

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "size", "source", "cluster", "part"], kind="stable")
        pdf = pdf.loc[pdf.index.repeat(pdf["copies"])].reset_index(drop=True)
        got = pack(pdf, capacity, per_source)
        r = np.array([g[0] for g in got], np.int64)
        return pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy()[r], "piece": [g[1] for g in got], "start": [g[2] for g in got], "length": [g[3] for g in got], "bin_id": [f"{key[0]}-{g[4]}" for g in got], "bin_offset": [g[5] for g in got]})

    packed = rows.groupBy("block").applyInPandas(run, SCHEMA)
    return packed.withColumn("doc_id", F.col("doc_id").cast("long"))


def word_counts(texts: pa.Array) -> np.ndarray:
    """Number of words of each text, counted in its bytes; null has none."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, ends, data = texts.buffers()
    raw, out = np.frombuffer(data or b"", np.uint8), np.zeros(len(texts), np.int64)
    if not len(texts):
        return out
    at = np.frombuffer(ends, kind)[texts.offset : texts.offset + len(texts) + 1]
    first = np.flatnonzero(np.diff((at[:-1] - at[0]) // STEP, prepend=-1)).tolist()
    for i, to in zip(first, [*first[1:], len(texts)]):
        own, here = raw[at[i] : at[to]], at[i : to + 1] - at[i]
        word = (own != 32) & ((own - np.uint8(9)) > 4)  # below 9 wraps round to above 4
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        start = here[:-1][here[:-1] < here[1:]]
        begins[start] = word[start]
        here = here.tolist()
        out[i:to] = [np.count_nonzero(begins[a:b]) for a, b in zip(here, here[1:])]
    return out


def with_words(docs: DataFrame) -> DataFrame:
    """docs with the number of words of `text` as `size` in place of the text."""
    rest = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(word_counts(batch.column("text")))], [*rest, "size"])

    return docs.select(*rest, "text").mapInArrow(run, docs.select(*rest).schema.add("size", "long"))


def with_clusters(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, cluster of every row: documents of one near-duplicate class have one cluster.

    docs: doc_id, text, source. The size is the number of words. A document is a doc_id with a text, so null
    doc_ids and different texts under one doc_id are classed like any other. Equal texts have one cluster also
    where they have no words; a null text has none. Repeated rows give repeated rows.
    """
    rows = docs.select("doc_id", "source", "text", F.xxhash64("doc_id", "text").alias("key"))
    classes = class_table(rows.select(F.col("key").alias("doc_id"), "text")).withColumnRenamed("doc_id", "key")
    rows = with_words(rows.withColumns({"no_text": F.col("text").isNull(), "equal": F.xxhash64("text")}))
    cluster = F.when(~F.col("no_text"), F.when(F.col("size") == 0, F.col("equal")).otherwise(F.col("class_id")))
    return rows.join(classes, "key", "left").select("doc_id", "source", "size", cluster.alias("cluster"))


def pack_apart(docs: DataFrame) -> DataFrame:
    """Documents packed by their number of words; no two near copies (five words, 0.8) share a bin."""
    return best_fit_pack(staged(with_clusters(docs), "clusters"), F.col("size"), F.col("cluster"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_apart(table(spark, sf_dir, "documents"))
