"""Integrity in one scan per table, remaps with their outcomes, re-anchored spans, names found in sibling documents."""

import random
import re

from pyspark.sql import functions as F

from lotline.operators import joins as J
from lotline.operators import quality as Q
from lotline.plans import harvest as H
from lotline.plans import spans as Sp


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_fk_report_reads_each_table_once(spark, tmp_path):
    rnd = random.Random(1)
    data = {
        "parents": [(i, f"p{i}") for i in range(40)] + [(3, "again"), (None, "nobody")],
        "others": [(i, f"o{i}") for i in range(0, 60, 2)],
        "kids": [(i, rnd.choice([None, 7, *range(50)]), rnd.choice([None, *range(60)]), rnd.randrange(40)) for i in range(300)] + [(i, 7, 1, 999) for i in range(500, 700)],
        "empty": [],
    }
    schemas = {"parents": "id long, name string", "others": "id long, name string", "kids": "id long, a long, b long, c long", "empty": "id long, a long"}
    tables = {}
    for n, d in data.items():
        spark.createDataFrame(d, schemas[n]).write.parquet(str(tmp_path / n))
        tables[n] = spark.read.parquet(str(tmp_path / n))
    specs = [("kids", "a", "parents", "id"), ("kids", "b", "others", "id"), ("kids", "c", "parents", "id"), ("kids", "id", "kids", "id"), ("empty", "a", "parents", "id")]
    report = Q.fk_report(tables, specs)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == len(tables)
    want = []
    for child, fk, parent, _ in specs:
        col = schemas[child].split(", ").index(f"{fk} long")
        values, ids = [r[col] for r in data[child]], {r[0] for r in data[parent]}
        lost = [v for v in values if v is not None and v not in ids]
        want.append((child, fk, parent, len(values), sum(v is not None for v in values), len(lost), min(map(str, lost), default=None)))
    assert rows(report) == sorted(want, key=repr) and any(w[5] > 200 for w in want)


def test_remap_says_what_became_of_every_row(spark):
    old = [(1, "a", "x"), (2, "b", "x"), (3, "c", None), (4, "d", "x")]
    new = [(10, "a", "x"), (11, "a", "x"), (12, "b", "x")]
    child = [(100, 1, "k"), (101, 2, "k"), (102, 3, "k"), (103, 4, "k"), (104, 9, "k"), (105, None, "k"), (100, 1, "k")]
    sides = [spark.createDataFrame(t, "id long, n string, m string") for t in (old, new)]
    df = spark.createDataFrame(child, "id long, fk long, outcome_of string")
    want = [(100, 11, "k", "remapped"), (100, 11, "k", "remapped"), (101, 12, "k", "remapped"), (102, None, "k", "no_natural_key"), (103, None, "k", "no_new_parent"), (104, None, "k", "no_old_parent"), (105, None, "k", "no_key")]
    assert rows(J.remap_tagged(df, *sides, ["n", "m"], "fk", False)) == want
    assert rows(J.remap_tagged(df, *sides, ["n", "m"], "fk", True)) == [w if w[3] == "remapped" else (*w[:3], "dropped:" + w[3]) for w in want]
    assert rows(J.remap_fk(df, *sides, ["n", "m"], "fk", True)) == [w[:3] for w in want[:3]] and J.remap_fk(df, *sides, ["n", "m"], "fk", False).count() == 7


def test_reanchor_takes_the_nearest_place(spark):
    rnd = random.Random(2)
    docs = {i: "".join(rnd.choice("abé") for _ in range(rnd.randint(0, 60))) for i in range(40)}
    saved = [(i, rnd.choice(["ab", "ba", "aa", "aba", "éa", "bbbb", "", None]), rnd.choice([None, 0, 1, 5, 20, 59, 100])) for i in docs for _ in range(3)] + [(999, "ab", 0)]
    pages = [(i, p + 1, p * 7) for i in docs for p in range(9) if i % 5] + [(0, 2, 30)]
    got = Sp.reanchor(spark.createDataFrame(saved, "doc_id int, saved_text string, span_start int"), spark.createDataFrame(list(docs.items()), "doc_id int, text string"), spark.createDataFrame(pages, "doc_id int, page int, start int"))
    want = []
    for i, s, old in saved:
        places = [p for p in range(len(docs.get(i, ""))) if s and docs[i].startswith(s, p)]
        at = min(places, key=lambda p: (abs(p - (old or 0)), p), default=None)
        page = max(((st, p) for d, p, st in pages if d == i and at is not None and st <= at), default=(None, None))
        want.append((i, s, at, at + len(s) if at is not None else None, page[1], at - page[0] if page[1] else None, at + len(s) - page[0] if page[1] else None))
    assert rows(got.select("doc_id", "saved_text", "span_start", "span_end", "page", "page_start", "page_end")) == sorted(want, key=repr)


def test_names_are_found_in_siblings_in_order_of_spelling(spark):
    prints = [(1, 10, "url", "bradruddelldesign.com.au"), (2, 20, "url", "metricon.com.au"), (2, 21, "email", "x@oak-works.com.au"), (3, 30, "email", "info@gmail.com")]
    docs = [
        (1, 10, "Brad Ruddell Design"), (1, 11, "plans by BRAD  RUDDELL\nDESIGN, 2020; Bradruddell"), (1, 12, None), (1, 13, "bradruddell design later"), (2, 20, "Metricon"), (2, 22, "xMetricon Metricons"), (2, 23, "(METRICON) homes"),
        (2, 24, "OAK-WORKS and oak works"), (2, 25, ""), (3, 31, "gmail"), (9, 90, "Metricon"),
    ]
    p = spark.createDataFrame(prints, "application_id int, source_doc_id int, kind string, normalized_value string")
    d = spark.createDataFrame(docs, "application_id int, doc_id int, text string")
    got = rows(H.names_in_siblings(p, d))
    # The rule, one spelling and one document at a time.
    want = []
    seeds = H.firm_words(p).collect()
    for app, seed in sorted({(r.application_id, r.seed) for r in seeds}):
        own = {r.source_doc_id for r in seeds if (r.application_id, r.seed) == (app, seed)}
        spelled = p.limit(1).select(H.name_candidates(F.lit(seed)).alias("c")).first().c
        hits = []
        for candidate in spelled:
            pattern = r"\W*".join(rf"\b{re.escape(w)}\b" for w in candidate.split(" "))
            hits += [m[0] for a, i, t in docs if a == app and i not in own and t for m in [re.search(pattern, t, re.I)] if m]
        if hits:
            want.append((app, seed, " ".join(hits[0].split())))
    assert got == sorted(want, key=repr) and len(want) == 3 and got[0][2] == "bradruddell design"
