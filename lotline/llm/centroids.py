"""Operator 12: centroid clustering with a vantage-point tree over the centroids.

Each round the driver builds a vantage-point tree over the k centroids and sends it out with the tasks;
k and the number of components bound its size, whatever the number of vectors. A vector searches the tree
best first: of the subtrees it has met it opens the one with the smallest lower bound, until that bound
exceeds the best distance found. Bounds come from the triangle inequality in floating point, widened by
more than their rounding error, and a subtree whose bound equals the best distance is opened, so neither a
nearest centroid nor a tie is cut off. Distances that decide are whole numbers.

A batch searches as one: every vector keeps its own bounds and its own next subtree, and those at the
same subtree are measured together.

Tasks send one partial sum per centroid and component, in limbs of 40 bits, so that sums are exact for any
finite components; new centroids are their floor quotients.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.llm.common import staged, table

CLUSTERS, ROUNDS, SEED, SCALE, WIDTH = 16, 3, 1, 64, 64
#: Centroids in a leaf of the tree, and vectors searched together.
LEAF, BATCH_ROWS = 2, 4096
#: Components below this in size are computed in 64 bits: 2**6 squared differences of 2**27 stay below 2**63.
SMALL = 1 << 26
#: Sums travel as limbs of this many bits; the last one holds the sign. Components are below 2**134.
BITS, LIMBS = 40, 5
#: What floating point may lose of a distance or a bound, as a share of the largest term.
SLACK = 1e-12


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles, exact: 64-bit integers if all are small, else Python integers."""
    y = np.floor(x * float(scale))  # scale is a power of two, so the product is exact
    if not y.size or np.abs(y).max() < SMALL:
        return y.astype(np.int64)
    return np.array([int(v) for v in y.ravel()], object).reshape(y.shape)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of a from the vector b, as whole numbers."""
    d = a - b
    return (d * d).sum(axis=1)


@dataclass
class Node:
    """A subtree: its vantage point (a centroid's number), the range of distances from the parent's vantage point, children or leaf members."""

    vantage: int
    low: float
    high: float
    children: tuple[int, ...] = ()
    members: tuple[int, ...] = ()


class VantageTree:
    """Vantage-point tree over whole-number centroids; node 0 is the root."""

    def __init__(self, centroids: list[list[int]]) -> None:
        big = max((abs(v) for c in centroids for v in c), default=0) >= SMALL
        self.centroids = np.array(centroids, object if big else np.int64).reshape(len(centroids), -1)
        self.nodes: list[Node] = []
        if len(centroids):
            self.build(list(range(len(centroids))), 0.0, np.inf)

    def build(self, own: list[int], low: float, high: float) -> int:
        """The vantage point is the least centroid number; the others are halved at the median of their distances from it."""
        at = len(self.nodes)
        self.nodes.append(Node(own[0], low, high))
        if len(own) <= LEAF + 1:
            self.nodes[at].members = tuple(own[1:])
            return at
        away = np.sqrt(squared(self.centroids[own[1:]], self.centroids[own[0]]).astype(float))
        order = np.argsort(away, kind="stable")
        halves = order[: len(order) // 2], order[len(order) // 2 :]
        self.nodes[at].children = tuple(self.build(sorted(own[1 + i] for i in half), float(away[half].min()), float(away[half].max())) for half in halves)
        return at

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(nearest centroid, ties to the smaller number; squared distance; distances measured) of whole-number vectors."""
        n = len(vectors)
        exact = object if object in (vectors.dtype, self.centroids.dtype) else np.int64
        best, centroid = np.zeros(n, exact), np.full(n, -1)
        bound = np.full((n, len(self.nodes)), np.inf)
        bound[:, 0] = 0.0
        radius = np.full(n, np.inf)
        rows, measured = np.arange(n), 0

        def measure(own: np.ndarray, c: int) -> np.ndarray:
            nonlocal measured
            measured += len(own)
            d = squared(vectors[own], self.centroids[c])
            better = (centroid[own] < 0) | (d < best[own]) | ((d == best[own]) & (c < centroid[own]))
            best[own[better]], centroid[own[better]] = d[better], c
            root = np.sqrt(d.astype(float))
            radius[own] = np.minimum(radius[own], root * (1 + SLACK))
            return root

        while len(rows):
            node = bound[rows].argmin(axis=1)
            open_ = bound[rows, node] <= radius[rows]  # a bound equal to the radius may hide a tie
            open_ &= np.isfinite(bound[rows, node])
            rows, node = rows[open_], node[open_]
            for k in np.unique(node):
                own, it = rows[node == k], self.nodes[k]
                bound[own, k] = np.inf
                away = measure(own, it.vantage)
                for c in it.members:
                    measure(own, c)
                for child in it.children:
                    low, high = self.nodes[child].low, self.nodes[child].high
                    lost = SLACK * (away + high)
                    bound[own, child] = np.maximum(np.maximum(low - away, away - high) - lost, 0.0)
        return centroid, best, measured


def whole(batch: pa.RecordBatch, width: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their vectors): exactly `width` components, none null or non-finite."""
    column = batch.column(1)
    size = np.diff(column.offsets.to_numpy())
    good = (size == width) & column.is_valid().to_numpy(zero_copy_only=False)
    flat = column.values.cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False)  # nulls become NaN
    cells = column.offsets.to_numpy()[:-1][good][:, None] + np.arange(width)
    x = values[cells]
    fine = np.isfinite(x).all(axis=1)
    return np.flatnonzero(good)[fine], integers(x[fine], scale)


def pieces(batches: Iterator[pa.RecordBatch], width: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            part = batch.slice(at, BATCH_ROWS)
            yield part, *whole(part, width, scale)


def sums(vectors: DataFrame, tree: VantageTree, width: int, scale: int) -> dict[int, tuple[int, list[int]]]:
    """Per centroid the number of vectors nearest to it and their component sums."""
    k = len(tree.centroids)
    limbs = [f"s{i}" for i in range(LIMBS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, width), object), np.zeros(k, np.int64)
        for _, _, v in pieces(batches, width, scale):
            c = tree.nearest(v)[0]
            n += np.bincount(c, minlength=k)
            for i in np.unique(c):
                total[i] += v[c == i].sum(axis=0).astype(object)
        flat, mask = total.ravel(), (1 << BITS) - 1
        parts = [pa.array([(int(t) >> (BITS * i)) & mask if i < LIMBS - 1 else int(t) >> (BITS * i) for t in flat], pa.int64()) for i in range(LIMBS)]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(k, dtype=np.int32), width)), pa.array(np.tile(np.arange(width, dtype=np.int32), k)), pa.array(np.repeat(n, width)), *parts], ["cluster", "component", "n", *limbs])

    partial = vectors.mapInArrow(run, "cluster int, component int, n long, " + ", ".join(f"{s} long" for s in limbs))
    total = partial.groupBy("cluster", "component").agg(F.sum("n").alias("n"), *[F.sum(F.col(s).cast("decimal(38,0)")).alias(s) for s in limbs])
    out: dict[int, tuple[int, list[int]]] = {}
    for r in total.orderBy("cluster", "component").collect():  # k times width rows
        if r.n:
            out.setdefault(r.cluster, (r.n, []))[1].append(sum(int(r[s]) << (BITS * i) for i, s in enumerate(limbs)))
    return out


def starts(vectors: DataFrame, id_col: str, k: int, seed: int, width: int, scale: int) -> list[list[int]]:
    """The k vectors that take part with the smallest sha256 of seed:id, in that order.

    Rows of one id are ordered by their components. A null id is never a start.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows, v in pieces(batches, width, scale):
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), pa.array([[float(x) for x in r] for r in v.tolist()], pa.list_(pa.float64()))], ["id", "v"])

    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    narrow = vectors.where(F.col(id_col).isNotNull()).mapInArrow(run, f"id {vectors.schema[id_col].dataType.simpleString()}, v array<double>")  # floors of doubles are doubles
    first = narrow.withColumn("key", key).orderBy("key", "v").limit(k).collect()
    return [[int(x) for x in r.v] for r in first]


def fitting(total: int | None) -> int | None:
    """A number that a long can hold, else null."""
    return total if total is not None and total < 1 << 63 else None


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, width: int = WIDTH, scale: int = SCALE) -> tuple[DataFrame, list[list[int]]]:
    """(id_col, cluster, distance of every vector that takes part; final centroids).

    A vector takes part if it has exactly `width` components, none null or non-finite; components become
    floor(scale * x), where scale is a power of two. Repeated rows and ids count as often as they stand; a
    null id takes part but is never a start. With fewer than k vectors there are as many centroids; without
    any, no rows. distance is the squared distance, null where it needs more than 64 bits (components above
    about 2**28); the choice of the centroid is exact at any size. Other columns are ignored.
    """
    if scale & (scale - 1):
        raise ValueError("scale must be a power of two")
    vectors = vectors.select(id_col, vec_col)
    centroids = starts(vectors, id_col, k, seed, width, scale)
    if not centroids:
        return vectors.sparkSession.createDataFrame([], f"{id_col} long, cluster int, distance long"), []
    for _ in range(rounds):
        for c, (n, total) in sums(vectors, VantageTree(centroids), width, scale).items():
            centroids[c] = [t // n for t in total]
    tree = VantageTree(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows, v in pieces(batches, width, scale):
            c, d, _ = tree.nearest(v)
            own = pa.array([x if x < 1 << 63 else None for x in d.tolist()], pa.int64()) if d.dtype == object else pa.array(d)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), pa.array(c.astype(np.int32)), own], [id_col, "cluster", "distance"])

    return vectors.mapInArrow(assign, f"{id_col} {vectors.schema[id_col].dataType.simpleString()}, cluster int, distance long"), centroids


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inertias that need more than 64 bits, or of which a distance does, are null."""
    vectors = table(spark, sf_dir, "embeddings")
    assigned, centroids = cluster(vectors)
    assigned = staged(assigned, "assigned")
    total = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)")))
    per = {r.cluster: r.total for r in assigned.groupBy("cluster").agg(total.alias("total")).collect()}  # at most k rows
    inertia = None if None in per.values() else sum(int(t) for t in per.values())
    facts = [(c, fitting(None if t is None else int(t)), fitting(inertia), ",".join(map(str, centroids[c]))) for c, t in per.items()]
    known = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, components string")
    known = known.withColumn("centroid_sha256", F.sha2("components", 256)).drop("components")
    return assigned.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def centroids_sql() -> str:
    """The query in SQL: every vector against every centroid, round by round."""
    out = [f"""
with v as materialized (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as hugeint)) as v from embeddings
  where embedding is not null and len(embedding) = {WIDTH} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), c0 as materialized (
  select row_number() over (order by key, v) - 1 as c, v from (select sha256('{SEED}:' || cast(vec_id as varchar)) as key, v from v where vec_id is not null order by key, v limit {CLUSTERS})
)"""]  # fmt: skip
    near = """
, a{i} as materialized (
  select row, vec_id, arg_min(c, d * 1000 + c) as c, min(d) as d from (
    select row, vec_id, c, list_sum(list_transform(list_zip(v.v, k.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as d from v, c{i} k) group by row, vec_id
)"""
    for i in range(ROUNDS):
        out.append(near.format(i=i))
        out.append(f"""
, n{i} as materialized (
  select c, list(cast(s // n as hugeint) - cast(s % n < 0 as hugeint) order by i) as v
  from (select c, i, sum(x) as s, cast(count(*) as hugeint) as n from (select c, unnest(v) as x, generate_subscripts(v, 1) as i from v join a{i} using (row)) group by c, i) group by c
), c{i + 1} as materialized (select k.c, coalesce(n.v, k.v) as v from c{i} k left join n{i} n using (c))""")
    out.append(near.format(i=ROUNDS))
    out.append(f"""
select a.vec_id, cast(a.c as integer) as cluster, cast(a.d as bigint) as distance, cast(sum(a.d) over (partition by a.c) as bigint) as cluster_inertia,
  cast(sum(a.d) over () as bigint) as inertia, sha256(array_to_string(list_transform(k.v, lambda x: cast(x as varchar)), ',')) as centroid_sha256
from a{ROUNDS} a join c{ROUNDS} k on a.c = k.c
""")
    return "".join(out)


OP12_SQL = centroids_sql()
