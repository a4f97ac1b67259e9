"""What the operators of this subpackage share: table reading, shared-folder staging, text hashing."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U = np.uint64
#: An odd multiplier, its inverse modulo 2**64, and the multipliers of the 64-bit finaliser below.
MUL = 0x9E3779B97F4A7C15
INV = pow(MUL, -1, 1 << 64)
MIX1, MIX2 = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Where none is named, local sessions get a temporary one; a cluster must name it."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="lotline-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the shared folder and read it back: what follows survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/lotline-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Remove staged tables from the shared folder that nothing reads any more."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        for file in df.inputFiles()[:1]:
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(conf).delete(folder.getParent(), True)


def by_text(docs: DataFrame, fields: str, start: Callable[[], Callable[[list[str | None]], list]], chars: int, keep_text: bool = False) -> DataFrame:
    """docs with new columns worked out from the texts of a batch.

    fields: the new columns, as in a schema string. start() is called once per task and returns the
    function from texts to one list or array per new column. Batches are cut at about `chars`
    characters. All other columns pass through Arrow as they are, so nulls never change a type.
    """
    rest = [c for c in docs.columns if keep_text or c != "text"]
    schema = docs.select(rest).schema
    new = docs.sparkSession.createDataFrame([], fields).schema
    names = [*rest, *new.fieldNames()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy()) // chars
            cuts = np.flatnonzero(np.diff(size, prepend=-1)).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(size)]):
                part = batch.slice(a, b - a)
                made = [x if isinstance(x, pa.Array) else pa.array(x) for x in work(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in rest], *made], names)

    return docs.mapInArrow(run, type(schema)([*schema.fields, *new.fields]))


def below(n: int, bound: int, *columns: str) -> Column:
    """A filter by hash that lets about 1.2 * bound of n rows through; all of them if n is small."""
    share = min(1.0, 1.2 * bound / max(n, 1))
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) < int(share * (1 << 40))


def held_out(doc_id):
    """crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def is_held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, in place: high and low bits of the input reach every output bit."""
    h ^= h >> U(32)
    h *= U(MIX1)
    h ^= h >> U(29)
    h *= U(MIX2)
    h ^= h >> U(32)
    return h


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 16), base, dtype=U)
        out[0] = 1
        have = np.multiply.accumulate(out)
        if n <= 1 << 22:
            _POWERS[base] = have
    return have[:n]


def gram_hashes(units: np.ndarray, m: int) -> np.ndarray:
    """Hash of each run of m consecutive units (already hashed to 64 bits)."""
    n = len(units) - m + 1
    if n <= 0:
        return np.zeros(0, U)
    sums = np.zeros(len(units) + 1, U)
    np.cumsum(units * powers(MUL, len(units)), out=sums[1:])
    out = sums[m:] - sums[:-m]
    out *= powers(INV, n)
    return mix(out)


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than 0x20 and 0x09-0x0D (safe in UTF-8)."""
    word = np.zeros(len(raw) + 2, bool)
    word[1:-1] = (raw != 32) & ((raw - np.uint8(9)) > 4)  # below 9 wraps round to above 4
    edge = np.flatnonzero(word[1:] != word[:-1])
    return edge[::2], edge[1::2]


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    """A 64-bit hash of each word; the bytes are taken about `step` at a time to bound memory."""
    out = np.empty(len(starts), U)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + step, "right")))
        s, e = starts[at:to] - base, ends[at:to] - base
        n = int(e[-1])
        sums = np.zeros(n + 1, U)
        np.cumsum((raw[base : base + n].astype(U) + U(1)) * powers(MUL, n), out=sums[1:])
        out[at:to] = mix((sums[e] - sums[s]) * powers(INV, n + 1)[s] + (e - s).astype(U))
        at = to
    return out


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of w values, in log2(w) passes."""
    have = 1
    while have * 2 <= w:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (w - have)], x[w - have :]) if have < w else x
