"""Prefix and as-of joins on skewed keys: results against brute force, and no more pairs than the keys allow."""

import datetime

from pyspark.sql import functions as F

from lotline.operators import joins as J
from lotline.operators import ordered as O


def test_prefix_join_edges(spark):
    left = spark.createDataFrame([(1, "12 Oak Street"), (2, "12 Oak"), (3, "12"), (4, "Rose"), (5, ""), (6, None), (7, "R"), (8, "12 oak street, miami")], "l long, p string")
    right = spark.createDataFrame([(1, "12 Oak Street, Miami"), (2, "12 Oakley Road"), (3, "121 Oak Street"), (4, "rosewood 3"), (5, None), (6, ""), (7, "R"), (8, "12 OAK")], "r long, t string")
    got = {(x.l, x.r) for x in J.prefix_join(left, right, "p", "t").select("l", "r").collect()}
    rows = [(a.l, a.p, b.r, b.t) for a in left.collect() for b in right.collect()]
    assert got == {(i, j) for i, p, j, t in rows if p and t is not None and t.lower().startswith(p.lower())}


def keys_met(spark, n):
    """How many pairs meet on the join keys when one house number stands in half of all rows."""
    k = F.col("id")
    streets = spark.range(n).select((F.concat(F.when(k % 2 == 0, "12").otherwise(k.cast("string")), F.lit(" s"), k.cast("string"), F.lit(" Street"))).alias("p"))
    texts = streets.select(F.concat("p", F.lit(", Miami")).alias("t"))
    out = J.prefix_join(streets, texts, "p", "t")
    assert out.count() == n
    return streets.groupBy(J.leading_words(F.lower("p"), 2)).count().agg(F.sum(F.col("count") * F.col("count"))).first()[0]


def test_prefix_join_grows_with_its_rows(spark):
    assert keys_met(spark, 400) == 400 and keys_met(spark, 4_000) == 4_000


def test_asof_edges(spark):
    day = lambda d: datetime.date(2020, 1, d) if d else None
    left = spark.createDataFrame([(1, "a", day(5)), (2, "a", day(6)), (3, "b", day(9)), (4, None, day(9)), (5, "a", None), (6, "a", day(5))], "id long, k string, at date")
    right = spark.createDataFrame([(1, "a", day(5), 10), (2, "a", day(4), 20), (3, "a", day(4), 30), (4, "b", None, 40), (5, None, day(1), 50), (6, "b", day(9), 60)], "rid long, k string, t date, v int")
    got = {r.id: r.v for r in J.asof_prev(left, right, ["k"], ["id"], "at", "t", "rid", ["v"]).collect()}
    assert got == {1: 30, 6: 30, 2: 10}  # strictly before, ties to the greater id
    old = spark.createDataFrame([(1, "a", datetime.date(2000, 1, 1), 1)], "rid long, k string, t date, v int")
    assert J.asof_prev(left, old, ["k"], ["id"], "at", "t", "rid", ["v"], 120).count() == 0
    plan = J.asof_prev(left, right, ["k"], ["id"], "at", "t", "rid", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_window_dedupe_streams_a_hot_key(spark):
    rows = spark.range(5_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(0).alias("k"), F.timestamp_seconds(F.col("id") * 600).alias("at"))
    got = sorted((r.k, r["at"]) for r in O.dedupe_window(rows, ["k"], "at", 24).collect())
    want, last = [], {}
    for r in sorted(rows.collect(), key=lambda r: (r.k, r["at"])):
        if r.k not in last or (r["at"] - last[r.k]).total_seconds() >= 24 * 3600:
            last[r.k] = r["at"]
            want.append((r.k, r["at"]))
    assert got == sorted(want)
