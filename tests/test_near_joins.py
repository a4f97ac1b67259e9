"""Interval joins, totals over later events and nearest values: equal to all pairs, without making them."""

import random

from pyspark.sql import functions as F

from lotline.operators import joins as J
from lotline.plans import spans as Sp


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_spans(rnd, n, name):
    out = []
    for i in range(n):
        start = rnd.randrange(-200, 400)
        size = rnd.choice([0, 0, 1, 2, 3, 7, 8, 9, 64, 65, 300, -2])
        out.append((rnd.choice(["p", "q", None]), i, start if rnd.random() > 0.05 else None, start + size if rnd.random() > 0.05 else None, f"{name}{i}"))
    return out


def test_overlaps_equal_all_pairs(spark):
    rnd = random.Random(6)
    a, b = random_spans(rnd, 150, "a"), random_spans(rnd, 150, "b")
    got = J.overlap_join(spark.createDataFrame(a, "k string, i int, s long, e long, x string"), spark.createDataFrame(b, "k string, j int, s2 long, e2 long, x string"), ["k"], ("s", "e"), ("s2", "e2"))
    assert got.columns == ["k", "i", "s", "e", "x", "j", "s2", "e2", "x"]
    whole = lambda r: None not in r[:4]
    want = [(*x, *y[1:]) for x in a for y in b if whole(x) and whole(y) and x[0] == y[0] and x[2] < y[3] and y[2] < x[3]]
    assert rows(got) == sorted(want, key=repr) and len(want) > 400
    assert J.overlap_join(got.select("k", "i", "s", "e").limit(0), got.select("k", "j", "s2", "e2"), ["k"], ("s", "e"), ("s2", "e2")).count() == 0


def test_overlaps_of_one_long_document(spark):
    """100,000 spans on both sides under one key; all pairs would be ten thousand million."""
    a = spark.range(100_000).select(F.lit(1).alias("doc"), (F.col("id") * 10).alias("s"), (F.col("id") * 10 + 12).alias("e"))
    b = spark.range(100_000).select(F.lit(1).alias("doc"), (F.col("id") * 10 + 5).alias("s2"), (F.col("id") * 10 + 8).alias("e2"))
    assert J.overlap_join(a, b, ["doc"], ("s", "e"), ("s2", "e2")).count() == 100_000


def test_totals_after_equal_all_pairs(spark):
    rnd = random.Random(7)
    left = [(i, rnd.choice(["p", "q", None]), rnd.choice([None, *range(12)])) for i in range(120)]
    right = [(rnd.choice(["p", "q", None]), rnd.choice([None, *range(12)]), rnd.choice([None, 1, 5])) for _ in range(120)]
    got = J.totals_after(spark.createDataFrame(left, "id int, k string, t int"), spark.createDataFrame(right, "k string, u int, v long"), ["k"], ["id"], "t", "u", {"total": F.col("v"), "n": F.col("v").isNotNull().cast("long")})
    want = []
    for i, k, t in left:
        later = [v for k2, u, v in right if k is not None and k == k2 and None not in (t, u) and u > t]
        if later:
            known = [v for v in later if v is not None]
            want.append((i, sum(known) if known else None, len(known)))
    assert rows(got) == sorted(want, key=repr) and len(want) > 50
    n = 10_000  # on one key: all pairs would be a hundred million
    many = spark.range(n).select(F.lit("p").alias("k"), "id", F.col("id").alias("t"))
    out = J.totals_after(many, many.select("k", F.col("t").alias("u")), ["k"], ["id"], "t", "u", {"n": F.lit(1)})
    assert out.count() == n - 1 and out.agg(F.sum("n")).first()[0] == n * (n - 1) // 2


def box_rows(rnd, n):
    out = []
    for i in range(n):
        x, y = rnd.choice([rnd.random() * 900, rnd.randrange(0, 900, 30)]), rnd.choice([rnd.random() * 300, rnd.randrange(0, 300, 10)])
        out.append((1, rnd.choice([1, 2]), i, f"w{i}", float(x) if rnd.random() > 0.02 else None, float(y), float(x) + rnd.randrange(5, 80), float(y) + rnd.randrange(1, 12)))
    return out


def test_nearest_values_equal_all_pairs(spark):
    rnd = random.Random(8)
    data = box_rows(rnd, 400)
    spans = spark.createDataFrame(data, "doc_id int, page int, span int, text string, x0 double, y0 double, x1 double, y1 double")
    labels = spans.where("span % 5 = 0")
    want = []
    for _, page, l, _, lx0, ly0, lx1, ly1 in data:
        best = None
        for _, p, s, text, x0, y0, _, _ in data:
            if p != page or s == l or None in (lx0, x0):
                continue
            d = None
            if abs(y0 - ly0) <= 3 and x0 >= lx1:
                d = x0 - lx1
            elif 0 <= y0 - ly1 <= 25 and abs(x0 - lx0) <= 60:
                d = y0 - ly1 + 5
            if d is not None and (best is None or (d, s) < best[:2]):
                best = (d, s, text)
        if best and l % 5 == 0:
            want.append((1, page, l, best[1], best[2], best[0]))
    assert rows(Sp.label_value_pairs(labels, spans)) == sorted(want, key=repr) and len(want) > 60
    assert Sp.label_value_pairs(labels.limit(0), spans).count() == 0


def test_cells_hold_few_pairs(spark):
    """A page of 200 rows and 200 columns: a label meets what stands near it, not the page."""
    spans = spark.range(40_000).select(F.lit(1).alias("doc_id"), F.lit(1).alias("page"), F.col("id").alias("span"), F.lit("w").alias("text"), (F.col("id") % 200 * 50).alias("x0"), F.floor(F.col("id") / 200).alias("row"))
    spans = spans.select("doc_id", "page", "span", "text", "x0", (F.col("row") * 20).alias("y0"), (F.col("x0") + 40).alias("x1"), (F.col("row") * 20 + 10).alias("y1"))
    labels = spans.select("doc_id", "page", *[F.col(c).alias(f"l_{c}") for c in ("span", "x0", "y0", "x1", "y1")])
    met = Sp.near_in_cells(labels, spans, (F.col("l_x1"), F.col("l_x1") + Sp.RING), (F.col("l_y0") - Sp.ROW, F.col("l_y0") + Sp.ROW), Sp.RING, 4 * Sp.ROW).count()
    assert met < 8 * 40_000
    assert Sp.label_value_pairs(spans, spans).count() == 40_000 - 1  # all but the last have a neighbour
