"""Company resolution against a plain form of its rule, in any order of the mentions, and components of chains."""

import random

import pytest
from pyspark.sql import functions as F

from lotline.operators.components import components
from lotline.plans.companies import resolve_companies

SCHEMA = "m int, name string, acn string, abn string, entity_type string"
KNOWN = "id long, acn string, abn string, display_name string, entity_type string"


def classes(spark, mentions, known):
    got, every = resolve_companies(spark.createDataFrame(mentions, SCHEMA), spark.createDataFrame(known, KNOWN))
    return {r.m: r.company_id for r in got.collect()}, {r.id: r for r in every.collect()}


def test_mentions_meet_each_other(spark):
    mentions = [(1, "Acme", "111111111", "11111111111", None), (2, "Acme Two", None, "11111111111", "company"), (3, "ACME Pty Ltd", None, None, None), (4, "acme two", None, None, None)]
    mentions += [(5, "Other", None, None, None), (6, "Acme", "222222222", "11111111111", None), (7, None, None, None, None), (8, "", None, "123", None)]
    got, every = classes(spark, mentions, [])
    assert len({got[m] for m in (1, 2, 3, 4)}) == 1 and got[5] != got[1] and got[6] not in (got[1], got[5])
    assert got[7] is None and got[8] is None and all(i < 0 for i in every) and len(every) == 3
    assert every[got[1]].acn == "111111111" and every[got[1]].entity_type == "company"


def test_known_companies_take_over_one_acn(spark):
    known = [(1, None, "11111111111", "A", None), (2, None, "11111111111", "B", None), (3, "333333333", None, "C", "company")]
    mentions = [(1, "x", "999999999", "11111111111", None), (2, "y", "888888888", "11111111111", None), (3, "c", None, None, None), (4, "z", "333333333", "22222222222", None), (5, "q", None, "22222222222", None), (6, "b", "777777777", None, None)]
    got, every = classes(spark, mentions, known)
    assert got[2] == 1 and got[1] < 0 and got[3] == got[4] == got[5] == 3 and got[6] < 0
    assert every[1].acn == "888888888" and every[2].acn is None and every[3].abn == "22222222222"


def plain(mentions, known):
    """The rule, key by key in Python; new companies are named by their founding key."""
    norm = lambda n: n.lower() if n else None
    records = {(a, b, norm(n)) for _, n, a, b, _ in mentions}
    best = lambda labels: min(labels, key=lambda x: (isinstance(x, str), x))
    acn = {}
    for i, a, *_ in sorted(known):
        if a:
            acn.setdefault(a, i)
    seats = {}
    for i, a, b, *_ in sorted(known):
        if not a and b:
            seats.setdefault(b, i)
    wish = {}
    for a, b, _ in records:
        if a and a not in acn and b in seats:
            wish[a] = min(wish.get(a, 1 << 60), seats[b])
    for i in sorted(set(wish.values())):
        acn[min(a for a in wish if wish[a] == i)] = i
    label = {}
    for i, _, b, n, _ in known:
        for k in (b and "abn:" + b, n and "name:" + norm(n)):
            if k:
                label.setdefault(k, []).append(i)
    for a, b, n in records:
        if a:
            acn.setdefault(a, "acn:" + a)
            for k in (b and "abn:" + b, n and "name:" + n):
                if k:
                    label.setdefault(k, []).append(acn[a])
    label = {k: best(v) for k, v in label.items()}
    pairs = [(b and "abn:" + b, n and "name:" + n) for a, b, n in records if not a]
    while True:
        fresh = {}
        for b, n in pairs:
            if b and n and b not in label and n in label:
                fresh.setdefault(b, []).append(label[n])
            if b and n and n not in label and b in label:
                fresh.setdefault(n, []).append(label[b])
        if not fresh:
            break
        label |= {k: best(v) for k, v in fresh.items()}
    rest = {k: k for p in pairs for k in p if k and k not in label}
    for _ in rest:
        for b, n in pairs:
            if b in rest and n in rest:
                rest[b] = rest[n] = min(rest[b], rest[n])
    label |= rest
    return {m: acn[a] if a else label.get(b and "abn:" + b) or label.get(n and "name:" + norm(n)) for m, n, a, b, _ in mentions}


@pytest.mark.parametrize("seed", [0])
def test_equals_the_rule_in_any_order(spark, seed):
    rnd = random.Random(seed)
    pick = lambda n, p, f: f(rnd.randrange(n)) if rnd.random() < p else None
    key = lambda w: lambda i: str(i + 1).rjust(w, "0")
    mentions = [(i, pick(60, 0.9, lambda k: f"Firm {k}"), pick(12, 0.15, key(9)), pick(40, 0.5, key(11)), None) for i in range(120)]
    known = [(i + 1, pick(12, 0.4, key(9)), pick(40, 0.4, key(11)), f"firm {rnd.randrange(60)}", None) for i in range(8)]
    got, _ = classes(spark, mentions, known)
    again, _ = classes(spark, rnd.sample(mentions, len(mentions)), known)
    assert got == again
    want = plain(mentions, known)
    parts = lambda ids: sorted(sorted(m for m in ids if ids[m] == c) for c in set(ids.values()) if c is not None)
    assert parts(got) == parts(want)
    assert {m: c for m, c in got.items() if c is not None and c >= 0} == {m: c for m, c in want.items() if isinstance(c, int)}


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 400)] + [(1000, 1001 + i) for i in range(500)] + [(7000, 7000), (8000, None)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long").withColumn("a", F.col("a"))).collect()}
    assert all(got[i] == 0 for i in range(401)) and all(got[1000 + i] == 1000 for i in range(501)) and got[7000] == 7000 and got[8000] == 8000
