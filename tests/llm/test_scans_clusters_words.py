"""Operators 11 to 13: brute force on small tables, nulls, ties, repeats, empty tables and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np

from lotline.llm import centroids, license_scan, spelling
from lotline.llm.license_scan import BLOCK, NOTICES, PHRASES, STEP


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def licenses_of(text, notices, phrases, threshold):
    """What license_scan must find, by looking at every block and every place."""
    w = words_of(text)
    held = []
    for start in range(0, len(w), STEP):
        block = w[start : start + BLOCK]
        for label, t in notices.items():
            t = set(t.split())
            n = len(t & set(block))
            if n >= threshold * len(t) - 1e-9:
                held.append((label, start, len(block), n, len(t)))
    places = [(label, i) for t, label in phrases.items() for i in range(len(w)) if w[i : i + len(t.split())] == t.split()]
    return len(w), sorted(held), sorted(places, key=lambda p: (p[1], p[0]))


def license_texts(rnd):
    pool = [w for t in [*NOTICES.values(), *PHRASES] for w in t.split()] + ["Über", "straße", "code", "2024", "naïve"]
    out = [None, "", "MIT\n\tLicense", "mit-license mit license MIT LICENSE", "the apache\x00license", "commit license", "x " * 5000 + NOTICES["bsd"] + " y" * 3000, "licensé mit"]
    for _ in range(60):
        notice = rnd.choice(list(NOTICES.values())).upper().split()
        cut = [w for w in notice if rnd.random() > 0.15]
        text = [rnd.choice(pool) for _ in range(rnd.randint(0, 150))] + cut + [rnd.choice(pool) for _ in range(rnd.randint(0, 90))]
        out.append(rnd.choice([" ", ", ", "\n"]).join(text))
    return out


def test_license_scan_equals_brute_force(spark):
    texts = license_texts(random.Random(5))
    rows = [(i if i != 3 else None, t, "own", 7) for i, t in enumerate(texts)] + [(4, texts[4], "own", 7)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, notices string, rank int").repartition(5)
    for threshold in (0.5, 0.8, 1.0):
        got = license_scan.license_scan(docs, threshold=threshold).collect()
        assert got[0].asDict().keys() == {"doc_id", "rank", "n_words", "notices", "places"}
        have = Counter((r.doc_id, r.n_words, tuple(sorted((x.label, x.start, x.n_words, x.held, x.size) for x in r.notices)), tuple((x.label, x["at"]) for x in r.places)) for r in got)
        want = Counter()
        for doc_id, text, *_ in rows:
            n, held, places = licenses_of(text, NOTICES, PHRASES, threshold)
            want[(doc_id, n, tuple(held), tuple(places))] += 1
        assert have == want
    empty = license_scan.license_scan(docs.limit(0))
    assert empty.count() == 0


def test_license_templates_of_any_kind(spark):
    docs = spark.createDataFrame([(1, "a b a b a"), (2, "b a")], "doc_id long, text string")
    got = {r.doc_id: ([(x.label, x["at"]) for x in r.places], len(r.notices)) for r in license_scan.license_scan(docs, {}, {"a b": "x", "a b a": "y", "b": "x"}).collect()}
    assert got == {1: ([("x", 0), ("y", 0), ("x", 1), ("x", 2), ("y", 2), ("x", 3)], 0), 2: ([("x", 0)], 0)}


def plain_clusters(rows, k=16, rounds=3):
    """Every vector against every centroid, in Python integers."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v):
            kept.append((vec_id, [int(np.floor(64 * float(np.float32(x)))) for x in v]))
    starts = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    c = [v for _, v in starts]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, x)), i) for i, x in enumerate(c))

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(nearest(v)[1], []).append(v)
        for i, vs in own.items():
            c[i] = [sum(col) // len(vs) for col in zip(*vs)]
    return sorted(((i, nearest(v)[1], nearest(v)[0]) for i, v in kept), key=repr), c


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, "label") for i, v in rows], "vec_id long, embedding array<float>, cluster string")


def test_clusters_equal_brute_force(spark):
    rnd = random.Random(2)
    few = [[rnd.choice([-0.02, 0.0, 0.02]) for _ in range(64)] for _ in range(20)]
    rows = [(i, rnd.choice(few)) for i in range(120)] + [(i, [rnd.gauss(0, 1) for _ in range(64)]) for i in range(120, 200)]
    rows += [(None, few[0]), (7, few[1]), (7, few[1]), (900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 63 + [None]), (904, [float("nan")] * 64), (905, [float("inf")] * 64), (906, [0.5] * 65)]
    got, final = centroids.cluster(vectors_of(spark, rows).repartition(6))
    want, c = plain_clusters(rows)
    assert sorted((tuple(r) for r in got.select("vec_id", "cluster", "distance").collect()), key=repr) == want and final == c


def test_clusters_of_huge_components(spark):
    rows = [(i, [float((-1) ** j * 10 ** (i % 38)) * (1 + i / 64) for j in range(64)]) for i in range(40)]
    got, final = centroids.cluster(vectors_of(spark, rows))
    want, c = plain_clusters(rows)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(((i, k, d if d < 1 << 63 else None) for i, k, d in want), key=repr) and final == c


def test_clusters_of_few_or_no_vectors(spark):
    rows = [(3, [0.25] * 64), (4, [0.5] * 64), (5, None)]
    got, final = centroids.cluster(vectors_of(spark, rows))
    assert len(final) == 2 and sorted(tuple(r) for r in got.collect()) == plain_clusters(rows)[0]
    for none in ([], [(1, None)], [(None, [0.0] * 64)]):
        got, final = centroids.cluster(vectors_of(spark, none))
        assert got.count() == 0 and final == [] and got.columns == ["vec_id", "cluster", "distance"]


def test_vantage_tree_prunes_and_keeps_ties():
    r = np.random.default_rng(0)
    for scale in (2, 1000, 10**9):
        c = [[int(x) for x in row] for row in r.integers(-scale, scale, (64, 3))]
        c[40], c[41] = c[7], c[9]
        v = np.concatenate([np.array(c), r.integers(-scale, scale, (500, 3))])
        tree = centroids.VantageTree(c)
        own, d, measured = tree.nearest(v.astype(object) if scale >= centroids.SMALL else v)
        all_ = np.stack([centroids.squared(v.astype(object), np.array(x, object)) for x in c], axis=1)
        assert (own == all_.argmin(axis=1)).all() and (d == all_.min(axis=1)).all()
        assert scale == 2 or measured < 0.6 * len(v) * len(c)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_spelling(docs, shortest=6, fewest=5, factor=5):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= shortest and k >= fewest}
    near = {w: [v for v in n if v != w and one_edit(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= factor * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def spelling_docs(rnd):
    stems = ["réception", "colour", "Ünique", "separate", "aaaaaaaa", "occurrence", "abababab"]
    out = [(1, None), (2, ""), (3, "kurz"), (None, "separate " * 300), (4, "separate " * 3), (4, "separate " * 3)]
    for i in range(5, 60):
        text = []
        for _ in range(150):
            w = rnd.choice(stems)
            if rnd.random() < 0.25:
                p = rnd.randrange(len(w))
                w = rnd.choice([w[:p] + w[p + 1 :], w[:p] + rnd.choice("abé") + w[p:], w[:p] + rnd.choice("abé") + w[p + 1 :]])
            text.append(w.upper() if rnd.random() < 0.1 else w)
        out.append((i, rnd.choice([" ", "-", "7"]).join(text)))
    return out


def test_spelling_equals_brute_force(spark):
    docs = spelling_docs(random.Random(3))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, word string, n int").repartition(4)
    want = plain_spelling(docs)
    assert len(want) > 100 and any(w[1] for w in want) and any(w[4] > 1 for w in want)
    for crowd in (1, 5, 256):  # how often keys are split never changes a row
        assert sorted(tuple(r) for r in spelling.spelling_variants(df, crowd=crowd).collect()) == want
    assert spelling.spelling_variants(df.limit(0)).count() == 0


def test_scan_meets_every_pair_and_chains_have_roots(spark):
    rnd = random.Random(1)
    for _ in range(100):
        ws = sorted({"".join(rnd.choice("abé") for _ in range(rnd.randint(1, 7))) for _ in range(rnd.randint(0, 60))})
        assert {(ws[i], ws[j]) for i, j, _ in spelling.scan(ws)} == {(a, b) for a in ws for b in ws if a < b and one_edit(a, b)}
    links = [(f"w{i}", f"w{i + 1}") for i in range(20)]
    got = spelling.roots(spark.createDataFrame(links, "word string, form string")).collect()
    assert len(got) == 20 and {r.root for r in got} == {"w20"}
