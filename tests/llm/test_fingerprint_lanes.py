"""Op 3's likeness lanes on texts of very many equal pieces, against brute force, and its plan."""

import re
from collections import Counter

from lotline.llm import fingerprint as FP


def test_many_equal_pieces_stay_alike(spark):
    docs = spark.createDataFrame([(2, "ab.\n" * 40_000), (1, "cd.\n" * 40_000), (3, "ab.\n" * 65_536)], "doc_id long, text string")
    by = {r.doc_id: r for r in FP.fingerprint_edits(docs).select("doc_id", "near_edited", "near_next", "fingerprint").collect()}
    assert 0.55 < by[2].near_edited < 0.9 and by[2].near_next < 0.5  # half the lines of doc 1
    assert by[3].near_next > 0.999  # doc 2 repeats the same line
    assert len(by[1].fingerprint) == 8 + 8 * FP.EQUAL + 8 * FP.SIGN


def cosine(a, b):
    """Cosine of two texts' counts of pieces, which the sign lanes estimate."""
    a, b = (Counter(p for p in re.split(r"[\n\r]+|(?<=[.!?])\s+", t or "") if p) for t in (a, b))
    size = (sum(x * x for x in a.values()) * sum(x * x for x in b.values())) ** 0.5
    return 1.0 if a == b else sum(n * b[p] for p, n in a.items()) / size if size else 0.0


def test_likeness_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = {r.doc_id: r for r in FP.fingerprint_edits(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    order = sorted(texts, reverse=True)
    off = []
    for i, after in zip(order, order[1:] + order[:1]):
        for got, want in ((rows[i].near_edited, cosine(texts[i], rows[i].edited)), (rows[i].near_next, cosine(texts[i], texts[after]))):
            off.append(abs(got - want))
            assert want < 1 or got == 1.0
    assert max(off) < 0.4 and sum(off) / len(off) < 0.08  # 128 lanes: a standard error of 0.09


def test_plan_has_no_python(spark):
    plan = FP.op3_fingerprints(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_places_among_many_cuts(spark, monkeypatch):
    monkeypatch.setattr(FP, "SIDE", 4)
    cuts = [3, 5, 8, 13, 21, 34, 55, 89, 144, 233]
    keys = [(k,) for k in (-9, 3, 4, 13, 14, 89, 90, 233, 234, 10**15)]
    from pyspark.sql import functions as F

    for r in spark.createDataFrame(keys, "key long").select("key", FP.place(F.col("key"), cuts).alias("at")).collect():
        assert r["at"] == sum(c < r.key for c in cuts)
