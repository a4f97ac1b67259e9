"""Operator 2: exact top-k inner products by a three-phase uniform threshold.

A vector is cut into slices of components; each slice is one list of partial scores. Phase 1 gathers
each list's best k entries per query and resolves those few exactly: their k-th best total is a safe
cutoff. Phase 2 sends the cutoff out with the queries; a list returns every entry of at least its
even share, cutoff / slices. A vector below its share in every list has a total below the cutoff, so
these entries suffice. Phase 3 resolves what is not yet known of their totals and ranks them.

Partial scores are block products in numpy. Packed blocks of candidates are dealt into groups of
bounded size and travel once; the packed blocks of queries, the smaller side, are copied to every
group. No key holds all candidates or all queries, and Spark broadcasts a side only while it is small.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotline.llm.common import staged, table

SLICES = 2
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 4096
#: Blocks of candidates in a group; with few blocks each is a group of its own.
GROUP_BLOCKS = 16
#: Sum of a vector's squared integer components from which it takes no part.
MOST = 2.0**62
#: A vector is known by its id and a hash of its components, as ids may repeat with other components.
QUERY, CANDIDATE = ["query_id", "query_tag"], ["vec_id", "vec_tag"]


def clean(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """id, tag (a hash of v), v (array of long): floor(scale * component); rows that may not take part are left out.

    Beside nulls and non-finite components these are vectors whose squares sum to MOST or more: below it no
    product of two vectors, nor of their slices, can leave a long.
    """
    finite = F.col(vec_col).isNotNull() & F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    floors = F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale).try_cast("long"))
    square = F.aggregate(vec_col, F.lit(0.0), lambda s, x: s + F.pow(F.abs(x.cast("double") * scale) + 1.0, F.lit(2.0)))
    good = F.coalesce(finite, F.lit(False)) & F.col(id_col).isNotNull()
    fits = F.when(good, square) < MOST
    return vectors.where(F.coalesce(fits, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), floors.alias("v")).distinct().select("id", F.xxhash64("v").alias("tag"), "v")


def nearest_copies(rows: DataFrame, k: int) -> DataFrame:
    """Of equal vectors only the k + 1 smallest ids can be among any query's k best."""
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("n") <= k + 1).drop("n")


def matrix(column: pd.Series, width: int) -> np.ndarray:
    """Rows of equal length; missing last components are 0."""
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products; in floating point where no sum can leave its exact range."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return (a.astype(float) @ b.T.astype(float)).astype(np.int64) if most < 2.0**52 else a @ b.T


def resolve(pairs: DataFrame, queries: DataFrame, rows: DataFrame) -> DataFrame:
    """Exact totals of pairs of a query and a candidate. Candidates come first: their vectors travel by their own key."""
    total = F.aggregate(F.zip_with("q", "v", lambda x, y: F.coalesce(x * y, F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda s, x: s + x)
    named = lambda df, keys, v: df.select(F.col("id").alias(keys[0]), F.col("tag").alias(keys[1]), F.col("v").alias(v))
    joined = pairs.join(named(rows, CANDIDATE, "v"), CANDIDATE).join(named(queries, QUERY, "q"), QUERY)
    return joined.select(*QUERY, *CANDIDATE, total.alias("score"))


def ranked(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy(*QUERY).orderBy(F.desc("score"), *CANDIDATE)
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256, slices: int = SLICES) -> DataFrame:
    """Each query's k best candidates by integer inner product, ties to the smaller id.

    vectors, queries: id_col, vec_col (other columns are ignored). Returns query_id, rank (from 1),
    vec_id, score. Rows with a null id or vector, or a null or non-finite component, take no part, nor do
    vectors so long that a score might not fit a long (squares of floor(scale * x) summing to 2**62: components
    of about eight million, where scale is 256). All other finite components are exact.
    Rows equal in id and components count once. An id with several vectors is several candidates, which
    can all be among the best, and as a query it is asked once per vector, so its ranks repeat. Rows with
    the query's own id are never its candidates. Missing last components count as 0. With fewer than k
    candidates all are returned; empty in, empty out.
    """
    rows = staged(nearest_copies(clean(vectors, id_col, vec_col, scale), k), "candidates")
    asked = staged(clean(queries, id_col, vec_col, scale), "queries")
    width = max(x.agg(F.max(F.size("v"))).first()[0] or 1 for x in (rows, asked))
    width = -(-width // slices) * slices
    step = width // slices
    blocks = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    packs = max(1, math.ceil(rows.count() / CANDIDATE_BLOCK))
    groups = max(1, math.ceil(packs / GROUP_BLOCKS), min(packs, rows.sparkSession.sparkContext.defaultParallelism * 2))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), CANDIDATE_BLOCK):
                part = pdf.iloc[at : at + CANDIDATE_BLOCK]
                m = matrix(part["v"], width)
                ids, tags = (part[c].to_numpy(np.int64).tobytes() for c in ("id", "tag"))
                yield pd.DataFrame({"slice": range(slices), "ids": ids, "tags": tags, "m": [np.ascontiguousarray(m[:, s * step : (s + 1) * step]).tobytes() for s in range(slices)]})

    packed = rows.mapInPandas(pack, "slice int, ids binary, tags binary, m binary")
    candidates = packed.withColumn("part", F.pmod(F.xxhash64("ids", "tags"), F.lit(groups)).cast("int"))

    def pack_queries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for qs in pdf["qs"]:
                ids, tags, cut = (np.array([q[c] for q in qs], np.int64).tobytes() for c in ("id", "tag", "cutoff"))
                yield pd.DataFrame({"q_ids": [ids], "q_tags": [tags], "cut": [cut], "q": [matrix(pd.Series([x["v"] for x in qs]), width).tobytes()]})

    def packed_queries(cutoffs: DataFrame | None) -> DataFrame:
        own = asked.withColumn("cutoff", F.lit(None).cast("long")) if cutoffs is None else asked.join(cutoffs, (F.col("id") == F.col("query_id")) & (F.col("tag") == F.col("query_tag")), "left")
        sides = F.struct("id", "tag", "v", F.coalesce("cutoff", F.lit(-(1 << 62))).alias("cutoff"))
        blocked = own.groupBy(F.pmod(F.xxhash64("id", "tag"), F.lit(blocks)).alias("block")).agg(F.sort_array(F.collect_list(sides)).alias("qs"))
        binary = blocked.select("qs").mapInPandas(pack_queries, "q_ids binary, q_tags binary, cut binary, q binary")
        return binary.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def meet(cutoffs: DataFrame | None, local_best: int | None) -> DataFrame:
        """Entries of every list: its best per block of candidates, or all of at least their share."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for s, ids, tags, m, q_ids, q_tags, cut, q in zip(*(pdf[c] for c in ("slice", "ids", "tags", "m", "q_ids", "q_tags", "cut", "q"))):
                    ids, tags, own, own_tags, cut = (np.frombuffer(x, np.int64) for x in (ids, tags, q_ids, q_tags, cut))
                    q = np.frombuffer(q, np.int64).reshape(len(own), width)[:, s * step : (s + 1) * step]
                    part = product(q, np.frombuffer(m, np.int64).reshape(len(ids), step))
                    other = own[:, None] != ids[None, :]
                    if local_best:
                        # Own rows rank last: with one more entry than asked for each, none of the best is missed.
                        n = min(local_best + 1, len(ids))
                        c = np.argpartition(-np.where(other, part, np.iinfo(np.int64).min // 2), n - 1, axis=1)[:, :n]
                        r = np.repeat(np.arange(len(own)), n)
                        c = c.ravel()
                        keep = other[r, c]
                        r, c = r[keep], c[keep]
                    else:
                        r, c = np.nonzero(other & (part >= -(-cut[:, None] // slices)))
                    yield pd.DataFrame({"query_id": own[r], "query_tag": own_tags[r], "vec_id": ids[c], "vec_tag": tags[c], "slice": np.int32(s), "part": part[r, c]})

        met = candidates.join(packed_queries(cutoffs), "part").select("slice", "ids", "tags", "m", "q_ids", "q_tags", "cut", "q")
        return met.mapInPandas(run, "query_id long, query_tag long, vec_id long, vec_tag long, slice int, part long")

    pair = [*QUERY, *CANDIDATE]
    best = Window.partitionBy(*QUERY, "slice").orderBy(F.desc("part"), *CANDIDATE)
    lists = meet(None, k).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k)
    known = ranked(resolve(lists.select(*pair).distinct(), asked, rows), k)
    cutoffs = staged(known.groupBy(*QUERY).agg(F.min("score").alias("cutoff"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k).drop("n"), "cutoffs")
    entries = meet(cutoffs, None).groupBy(*pair).agg(F.sum("part").alias("score"), F.count(F.lit(1)).alias("seen"))
    entries = staged(entries, "entries")
    whole = entries.where(F.col("seen") == slices).select(*pair, "score")
    rest = resolve(entries.where(F.col("seen") < slices).select(*pair), asked, rows)
    return ranked(whole.unionByName(rest), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return exact_topk(vectors, vectors.where("vec_id % 50 = 0"))


OP2_SQL = """
with v as (
  select distinct vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and list_sum(list_transform(embedding, lambda x: power(abs(256 * cast(x as double)) + 1, 2))) < power(2.0, 62)
), s as (
  select q.vec_id as query_id, q.v as q, c.vec_id as vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0
), r as (
  select *, row_number() over (partition by query_id, q order by score desc, vec_id) as rank from s
)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5
"""
