"""Operator 3: homomorphic multiset fingerprints of documents, in Spark SQL functions only.

A text is the multiset of its paragraphs, long ones cut at sentence ends. Each piece is hashed to a
wide vector, and a fingerprint is the sum of the pieces' vectors, so it does not depend on their
order, and pieces can be added or taken away without reading the rest:

* EQUAL lanes, sums of 32-bit hashes modulo 2**32, settle equality;
* SIGN lanes, sums of +1 or -1 modulo 2**32 (more pieces than that fit no text), make the cosine of two fingerprints an unbiased
  estimate of the share of pieces that the texts have in common.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotline.llm.common import table

EQUAL, SIGN = 16, 128
#: To find each document's neighbour, ids are dealt into ranges of about RANGE_IDS, at most SIDE * SIDE of them.
RANGE_IDS, SIDE = 20_000, 64
#: Stands for a null doc_id.
NO_ID = -(1 << 63)


def let(value: Column, body) -> Column:
    """body(value) with value worked out once, however often and in whatever loop body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def pieces(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\n\r]+|(?<=[.!?])\s+"), lambda p: p != "")


def lanes(parts: Column) -> Column:
    """struct(n, equal: array<long>, sign: array<int>) of an array of pieces."""
    zero = F.lit(0).cast("long")

    def equal(ps: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(EQUAL - 1)), lambda j: F.aggregate(ps, zero, lambda s, p: s + F.xxhash64(p, j).bitwiseAND(0xFFFFFFFF)).bitwiseAND(0xFFFFFFFF))

    def signs(ps: Column, seed: int) -> Column:
        """64 sums of the bits of one hash, a set bit as +1 and others as -1."""
        bits = lambda hs: F.transform(F.sequence(F.lit(0), F.lit(63)), lambda j: F.aggregate(hs, zero, lambda s, h: s + F.call_function("shiftright", h, j).bitwiseAND(1)))
        return let(F.transform(ps, lambda p: F.xxhash64(F.lit(seed), p)), bits)

    def vector(ps: Column) -> Column:
        ones = F.concat(*[signs(ps, seed) for seed in range(SIGN // 64)])
        return F.struct(F.size(ps).cast("long").alias("n"), equal(ps).alias("equal"), F.transform(ones, lambda x: wrap(x * 2 - F.size(ps))).alias("sign"))

    return let(parts, vector)


def wrap(x: Column) -> Column:
    """A sum modulo 2**32, as a signed integer."""
    return ((x + (1 << 31)).bitwiseAND(0xFFFFFFFF) - (1 << 31)).cast("int")


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint of the union of two multisets of pieces; with sign=-1, of a without the pieces of b."""
    return F.struct(
        (a["n"] + sign * b["n"]).alias("n"),
        F.zip_with(a["equal"], b["equal"], lambda x, y: (x + sign * y).bitwiseAND(0xFFFFFFFF)).alias("equal"),
        F.zip_with(a["sign"], b["sign"], lambda x, y: wrap(x.cast("long") + sign * y.cast("long"))).alias("sign"),
    )


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: 1 for equal fingerprints, else the cosine of the sign lanes, negative estimates being 0."""
    dot = lambda x, y: F.aggregate(F.zip_with(x["sign"], y["sign"], lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    size = F.sqrt(dot(a, a) * dot(b, b))
    return F.when((a["equal"] == b["equal"]) & (a["n"] == b["n"]), 1.0).when(size > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot(a, b) / size))).otherwise(0.0)


def as_text(f: Column) -> Column:
    """Lower-case hex: number of pieces, equal lanes, sign lanes."""
    digits = lambda xs, n: F.array_join(F.transform(xs, lambda x: F.lpad(F.lower(F.hex(x)), n, "0")), "")
    return F.concat(F.lpad(F.lower(F.hex(f["n"])), 8, "0"), digits(f["equal"], 8), digits(F.transform(f["sign"], lambda x: x.cast("long").bitwiseAND(0xFFFFFFFF)), 8))


def fingerprints(docs: DataFrame, text: str = "text", out: str = "f") -> DataFrame:
    """docs with a fingerprint column. Null text counts as empty; nothing else is read or changed."""
    return docs.withColumn(out, lanes(pieces(F.col(text))))


def place(key: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts are below the key: the cuts are looked up in two steps, SIDE to a group."""
    many = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    if len(cuts) <= SIDE:
        return F.size(F.filter(many(cuts), lambda c: c < key)) if cuts else F.lit(0)
    groups = [cuts[i : i + SIDE] for i in range(0, len(cuts), SIDE)]
    before = F.size(F.filter(many([g[-1] for g in groups]), lambda c: c < key))
    own = F.coalesce(F.get(F.array(*map(many, groups)), before), F.array().cast("array<bigint>"))
    return F.least(before * SIDE + F.size(F.filter(own, lambda c: c < key)), F.lit(len(cuts)))


def neighbours(docs: DataFrame) -> DataFrame:
    """target, half, next, next_half: each distinct id with each number of characters to take, the next id in
    descending order (after the last: the first), and the smallest such number among the next id's rows.

    docs: key, half. Ids are dealt into ranges cut at quantiles; a range's smallest id goes on to the greatest
    id of the range below. Only ids and numbers travel.
    """
    ids = docs.select("key", "half").distinct()
    count = ids.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    n = int(min(SIDE * SIDE, max(1, count // RANGE_IDS)))
    cuts = sorted(set(ids.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 10_000)).first()[0] or [])) if n > 1 and count else []
    ids = ids.withColumn("bucket", place(F.col("key"), cuts))
    lows = ids.groupBy("key", "bucket").agg(F.min("half").alias("low"))
    row = F.struct("key", "low")
    tops = {r["bucket"]: r["top"] for r in lows.groupBy("bucket").agg(F.max(row).alias("top")).collect()}  # one row a range
    order = sorted(tops)
    below = {b: tops[a] for a, b in zip([order[-1], *order], order)} if order else {}
    entry = lambda t: F.struct(F.lit(t["key"]).cast("long").alias("key"), F.lit(t["low"]).cast("long").alias("low"))
    first = F.element_at(F.create_map(*[x for b, t in below.items() for x in (F.lit(b), entry(t))]), F.col("bucket")) if below else F.lit(None).cast("struct<key:bigint,low:bigint>")
    after = lows.select(F.col("key").alias("target"), F.coalesce(F.lag(row).over(Window.partitionBy("bucket").orderBy("key")), first).alias("after"))
    return ids.select(F.col("key").alias("target"), "half").join(after, "target").select("target", "half", F.col("after.key").alias("next"), F.col("after.low").alias("next_half"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited text.

    docs: doc_id, text; other columns are ignored. The edited text has its last floor(n_chars / 2)
    code points replaced by the first as many of the next document's, in descending doc_id. Returns
    doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next. Null text
    counts as empty, a null doc_id as the smallest. Rows of one doc_id share their next document; of
    several rows with the next id, those with the smallest floor(n_chars / 2) come first, and of these the
    least text is taken. A single document is its own next one.
    """
    text = F.coalesce("text", F.lit(""))
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), F.floor(F.length(text) / 2).alias("half"), text.alias("text"))
    order = neighbours(base)
    # Each fingerprint is worked out once, before the texts are dealt by id and half; both joins read that one
    # exchange. An id that very many rows share, a null one too, is split by its lengths, and each row meets one partner.
    base = fingerprints(base)
    # Keyed by the next document: its text is cut to what the edit takes before it travels, once, to its target.
    sent = order.withColumnRenamed("half", "take").join(base, (F.col("key") == F.col("next")) & (F.col("half") == F.col("next_half")))
    sent = sent.select("target", "take", F.expr("substring(text, 1, cast(take as int))").alias("piece"), F.col("f").alias("next_f")).repartition("target", "take")
    sent = sent.groupBy("target", "take").agg(F.min(F.struct("piece", "next_f")).alias("s"))
    n = F.length("text")
    joined = base.join(sent, (F.col("key") == F.col("target")) & (F.col("half") == F.col("take")))
    edited = F.concat(F.expr("substring(text, 1, cast(length(text) - half as int))"), F.col("s.piece"))
    own_id = F.when(F.col("key") != NO_ID, F.col("key"))
    out = joined.select(own_id.alias("doc_id"), n.cast("long").alias("n_chars"), edited.alias("edited"), "f", F.col("s.next_f").alias("next_f"))
    out = fingerprints(out, "edited", "edited_f")
    return out.select("doc_id", "n_chars", "edited", as_text(F.col("f")).alias("fingerprint"), as_text(F.col("edited_f")).alias("edited_fingerprint"), likeness(F.col("f"), F.col("edited_f")).alias("near_edited"), likeness(F.col("f"), F.col("next_f")).alias("near_next"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprint_edits(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")
