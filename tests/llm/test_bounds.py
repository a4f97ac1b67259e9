"""Bounds that hold for any input: huge components in exact search, ids that stand in very many rows."""

import math

from pyspark.sql import functions as F

from lotline.llm import near_dedup, toxicity
from lotline.llm.common import is_held_out
from lotline.llm.topk import MOST, exact_topk


def test_topk_of_huge_components(spark):
    rows = [(i, [float(i), 1e6 * (-1) ** i, 0.5]) for i in range(30)]
    rows += [(100, [3e38, 1.0, 1.0]), (101, [1e9, 0.0, 0.0]), (102, [-8e6, 0.0, 0.0]), (103, [8e6, 0.0, 0.0]), (104, [9e6, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    own = {i: [math.floor(256 * x) for x in v] for i, v in rows if sum((abs(256 * x) + 1) ** 2 for x in v) < MOST}
    assert set(own) == {*range(30), 102, 103}
    want = set()
    for q in own:
        if q % 10 == 0 or q > 100:
            score = sorted((-sum(a * b for a, b in zip(own[q], own[c])), c) for c in own if c != q)[:5]
            want |= {(q, n + 1, c, -s) for n, (s, c) in enumerate(score)}
    got = exact_topk(df, df.where("vec_id % 10 = 0 or vec_id > 100"))
    assert {tuple(r) for r in got.collect()} == want


def test_sample_is_bounded_whatever_one_id_holds(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 60)
    free = [i for i in range(200) if not is_held_out(i)][:4]
    rows = [(i, f"you are a {'fool' if i == free[0] else 'friend'} number {k}") for i in free for k in range(300)] + [(free[1], "one text many times")] * 2000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 0, int(i == free[0])) for i in free], "doc_id long, quality int, toxic int")
    kept = toxicity.learning_rows(docs, labels)
    assert 20 <= kept.count() <= 100 and kept.distinct().count() == kept.count()
    model = toxicity.fit(docs, labels)
    assert model is not None and model.score(["you are a fool number 7"])[0] > model.score(["you are a friend number 7"])[0]


def test_a_large_component_meets_strangers_only(spark, monkeypatch):
    """Members of one bucket: a component of 2,000, one of 30 and single strangers; every pair across components meets, few copies travel."""
    monkeypatch.setattr(near_dedup, "CHUNK", 50)
    members = [(1, r, 10, 5 if r < 2000 else 7 if r < 2030 else r) for r in range(2040)]
    rows = spark.createDataFrame(members, "key long, rep long, total long, label long").withColumns({"n": F.lit(len(members)), "weight": F.lit(10 * len(members))})
    met = near_dedup.chunk_pairs(rows).collect()
    assert len(met) < 3 * len(members)
    groups = {}
    for m in met:
        groups.setdefault((m.i, m.j), []).append(m)
    assert max(len(g) for g in groups.values()) < 200
    pairs = {(a.rep, b.rep) for g in groups.values() for a in g if a.rep >= 2000 for b in g if a.label != b.label}
    assert len(pairs) == 40 * 2040 - 30 * 30 - 10
