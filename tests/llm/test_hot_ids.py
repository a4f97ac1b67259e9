"""Ids that very many rows share: op3 pairs each row with one partner, op10 deals them alike in every run; op3's plain columns against SQL."""

import hashlib

import duckdb
from pyspark.sql import functions as F

from lotline.llm import fingerprint as FP
from lotline.llm import packing

SF = "/root/testdata/sf0.001"

PLAIN_SQL = f"""
with d as (select doc_id, coalesce(text, '') as t, row_number() over (order by doc_id desc) as n from '{SF}/documents.parquet'),
     e as (select d.doc_id, d.t, length(d.t) // 2 as half, x.t as after from d join d x on x.n = d.n % (select max(n) from d) + 1)
select doc_id, length(t) as n_chars, sha256(left(t, length(t) - half) || left(after, half)) as edited_sha256 from e order by doc_id"""


def test_plain_columns_equal_sql(spark):
    got = FP.op3_fingerprints(spark, SF).orderBy("doc_id").select("doc_id", "n_chars", "edited_sha256").collect()
    assert [tuple(r) for r in got] == duckdb.sql(PLAIN_SQL).fetchall()


def edited(rows):
    """What each row's text becomes, by a plain walk over distinct ids."""
    ids = sorted({i for i, _ in rows}, key=lambda i: (i is not None, i or 0), reverse=True)
    first = {i: min((len(t or "") // 2, t or "") for j, t in rows if j == i)[1] for i in ids}
    after = dict(zip(ids, [*ids[1:], ids[0]]))
    out = []
    for i, t in rows:
        t = t or ""
        out.append((i, t[: len(t) - len(t) // 2] + first[after[i]][: len(t) // 2]))
    return sorted(out, key=repr)


def test_rows_without_id_and_of_one_id_meet_one_partner(spark):
    rows = [(None, "n" * k + "x.") for k in range(300)] + [(7, "é" * k + "y.") for k in range(200)] + [(i, f"text {i}. end") for i in (3, 5, 9)] + [(None, None), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = FP.fingerprint_edits(docs)
    assert sorted(((r.doc_id, r.edited) for r in out.collect()), key=repr) == edited(rows)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line and "half" in line]
    assert len(joins) == 2 and all(line.count("=") == 2 and "floor" not in line for line in joins)  # both columns are keys of the join


def test_bins_do_not_depend_on_how_rows_lie(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_ROWS", 50)
    monkeypatch.setattr(packing, "EQUAL_ROWS", 4)
    rows = [(i if i % 3 else None, i % 40, f"s{i % 5}", f"c{i}") for i in range(300)] + [(11, 5, None, None)] * 30
    docs = spark.createDataFrame(rows, "doc_id long, n int, source string, cluster string")
    packed = [sorted(map(tuple, packing.best_fit_pack(docs.repartition(k, F.rand(k)), F.col("n"), F.col("cluster"), capacity=64).collect()), key=repr) for k in (1, 3, 8)]
    assert packed[0] == packed[1] == packed[2] and len(packed[0]) == len(rows)
    by_block: dict[str, int] = {}
    for r in packed[0]:
        by_block[r[4].split("-")[0]] = by_block.get(r[4].split("-")[0], 0) + 1
    assert len(by_block) == 7 and max(by_block.values()) < 100  # neither null ids nor equal rows fill one block


def test_hashes_are_of_utf8(spark):
    docs = spark.createDataFrame([(1, "日本é")], "doc_id long, text string")
    got = FP.fingerprint_edits(docs).select(F.sha2(F.encode("edited", "UTF-8"), 256)).first()[0]
    assert got == hashlib.sha256("日本日".encode()).hexdigest()
