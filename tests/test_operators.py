"""Operators on small tables with nulls, ties and repeats; streams against their batch forms."""

import datetime

from pyspark.sql import functions as F

from lotline.operators import joins as J
from lotline.operators import ordered as O
from lotline.operators import writes as W
from lotline.plans import companies as P
from lotline.sources import pages as G
from lotline.streaming import pages as X


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_prefix_join(spark):
    left = spark.createDataFrame([(1, "12 Oak"), (2, ""), (3, None), (4, "Elm"), (5, "1 O")], "a int, p string")
    right = spark.createDataFrame([(10, "12 OAK Street, X"), (11, "elmwood 3"), (12, None), (13, "12 Oaks"), (14, "1 oak%")], "b int, t string")
    assert rows(J.prefix_join(left, right, "p", "t").select("a", "b")) == [(1, 10), (1, 13), (4, 11), (5, 14)]


def test_asof_ties(spark):
    left = spark.createDataFrame([(1, "k", datetime.date(2020, 1, 1))], "id int, k string, t date")
    right = spark.createDataFrame([("k", datetime.date(2019, 5, 1), 1, 5), ("k", datetime.date(2019, 5, 1), 2, 6), ("k", datetime.date(2020, 1, 1), 3, 7), ("k", datetime.date(2000, 1, 1), 4, 8)], "k string, d date, rid int, v int")
    assert rows(J.asof_prev(left, right, ["k"], ["id"], "t", "d", "rid", ["v"], 120)) == [(1, 6)]


def test_writes(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, seen string")
    new = spark.createDataFrame([(2, None, "z"), (3, "c", "w")], "k int, v string, seen string")
    assert rows(W.upsert(old, new, ["k"], preserve=("seen",))) == [(1, "a", "x"), (2, None, "y"), (3, "c", "w")]
    assert rows(W.upsert(old, new, ["k"], fill=("v",))) == [(1, "a", "x"), (2, "b", "z"), (3, "c", "w")]
    assert rows(W.insert_ignore(old, new.unionByName(new), ["k"], ["v"])) == [(1, "a", "x"), (2, "b", "y"), (3, "c", "w")]
    assert rows(W.patch_update(old, new, ["k"], ["v"], ["seen"])) == [(1, "a", "x"), (2, "b", "z")]
    assert rows(W.purge(old, new, ["k"])) == [(1, "a", "x")]


def test_streaks_and_ranges(spark):
    df = spark.createDataFrame([("u", i, c == "x") for i, c in enumerate("xx.xxxx")] + [("v", 0, True)], "u string, n long, bad boolean")
    assert rows(O.failure_streaks(df, ["u"], ["n"], F.col("bad"), 3).select("u", "n")) == [("u", 5)]
    assert rows(O.format_ranges(spark.createDataFrame([(1, p) for p in (1, 2, 3, 5, 5)], "d int, p int"), ["d"], "p")) == [(1, "1-3,5")]


def test_bio_tags(spark):
    df = spark.createDataFrame([(1, 1, 1, 3, "owner"), (1, 1, 1, 4, "owner"), (1, 1, 2, 4, "agent")], "doc_id int, page int, entity int, word int, role string")
    assert rows(O.bio_tags(df)) == [(1, 1, 3, "B-OWNER"), (1, 1, 4, "B-AGENT")]


def test_resolve_companies(spark):
    companies = spark.createDataFrame([(1, "111111111", "A Pty Ltd"), (2, None, "B")], "id long, acn string, display_name string")
    mentions = spark.createDataFrame([(1, "x", "111 111 111"), (2, "b pty ltd", None), (3, "b", "222222222"), (4, "New", None), (5, "NEW", None)], "m int, name string, acn string")
    got, every = P.resolve_companies(mentions, companies)
    ids = {r["m"]: r["company_id"] for r in got.collect()}
    assert ids[1] == 1 and ids[2] == 2 and ids[3] < 0 and ids[4] == ids[5] < 0 and ids[3] != ids[4]
    assert every.count() == 4



def test_rates_sheet(spark):
    text = ["banner", "Title,One,Two", "x", "Series ID,S1,S2", "", "31/01/1959,4.5", "28/02/1959,4.6,5.1", "31/02/1959,1,1", "31/03/1959,,n"]
    lines = spark.createDataFrame([("f", i, t) for i, t in enumerate(text)], "file string, n int, line string")
    assert rows(G.read_rates(lines)) == [("S1", "One", datetime.date(1959, 1, 31), 4.5), ("S1", "One", datetime.date(1959, 2, 28), 4.6), ("S2", "Two", datetime.date(1959, 2, 28), 5.1)]


def test_chunks_and_paragraphs(spark):
    pages = spark.createDataFrame([(1, i, "x" * 150) for i in range(1, 8)] + [(2, 1, "short")], "doc_id int, page int, text string")
    assert rows(G.chunk_pages(pages).select("doc_id", "chunk_index", "page_start", "page_end")) == [(1, 0, 1, 5), (1, 1, 5, 7)]
    df = spark.createDataFrame([("aaaa\nbb\ncccccc",), ("",)], "t string")
    assert [r[0] for r in df.coalesce(1).select(G.pack_paragraphs(F.col("t"), 9)).collect()] == [["aaaa\nbb", "cccccc"], [""]]


def test_nested_json(spark):
    df = spark.createDataFrame([('"{\\"inner\\":[1,2,3]}"',), ('{"inner":[1,2,3]}',), ("no",)], "t string")
    assert [r[0] for r in df.coalesce(1).select(F.to_json(G.unnest_json(F.col("t")))).collect()] == ['{"inner":[1,2,3]}'] * 2 + [None]


def test_streams(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    events = [("u", i, c == "x", start + datetime.timedelta(hours=i)) for i, c in enumerate("xx.xxxx")]
    schema = "u string, n long, bad boolean, t timestamp"
    spark.createDataFrame(events + events[:1], schema).write.parquet(str(tmp_path / "ev"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "ev"))
    q = X.stream_dedupe(stream, ["u", "n"], "t").writeStream.format("memory").queryName("dedup").option("checkpointLocation", str(tmp_path / "c3")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("dedup").count() == len(events)
    batch = spark.createDataFrame([("a", start), ("a", start + datetime.timedelta(hours=10)), ("a", start + datetime.timedelta(hours=25)), ("a", start + datetime.timedelta(hours=40))], "k string, t timestamp")
    assert [r[1].hour for r in sorted(O.dedupe_window(batch, ["k"], "t", 24).collect())] == [0, 1]
