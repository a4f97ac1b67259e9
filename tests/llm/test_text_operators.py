"""Operators 1, 3, 5, 7 and 8 against brute force, with nulls, empties, ties, repeats and clashing columns."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotline.llm import anchors
from lotline.llm import fingerprint as FP
from lotline.llm import near_dedup as ND
from lotline.llm.substring_dedup import SuffixAutomaton, op1_substring_dedup, substring_dedup
from lotline.llm.suffix_dedup import maximal_repeats, op5_suffix_dedup, repeat_groups, suffix_dedup

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, block int, seg string, kept string"


def table(spark, texts):
    """Rows with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 1, "x", "y") for i, t in texts], SCHEMA)


def random_texts(seed, n=40):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(60)] + ["é", "日本"]
    passages = [" ".join(rng.choice(words, 30)) for _ in range(4)]
    out = []
    for i in range(n):
        parts = [" ".join(rng.choice(words, rng.integers(0, 25))) for _ in range(3)]
        if i % 3:
            parts.insert(1, passages[rng.integers(4)])
        out.append((i, "\n".join(parts)))
    return out + [(100, None), (101, ""), (102, "a " * 700), (103, out[1][1]), (103, out[1][1]), (None, out[2][1]), (104, "x" * 900), (105, " \t\n")]


def brute_words(texts, length):
    first = {}
    big = 1 << 62
    words = [(big if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in texts]
    for i, w in words:
        for k in range(len(w) - length + 1):
            g = tuple(w[k : k + length])
            first[g] = min(first.get(g, big), i)
    out = []
    for (i, w), (own, _) in zip(words, texts):
        gone = set()
        for k in range(len(w) - length + 1):
            if first[tuple(w[k : k + length])] < i:
                gone.update(range(k, k + length))
        out.append((own, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def brute_bytes(texts, length):
    raws = [(i, (t or "").encode()) for i, t in texts]
    count = Counter(r[k : k + length] for _, r in raws for k in range(len(r) - length + 1))
    out = []
    for i, r in raws:
        gone = bytearray(len(r))
        for k in range(len(r) - length + 1):
            if count[r[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        out.append((i, len(r), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(x for x, g in zip(r, gone) if not g)))
    return sorted(out, key=repr)


SIZES = pytest.mark.parametrize("blocks,diverse,buckets", [(1 << 20, 20_000, 32 << 20), (400, 20_000, 32 << 20), (400, 1, 32 << 20), (4_000, 20_000, 2)])


def sized(monkeypatch, blocks, diverse, buckets):
    """Small blocks, and so few bytes a bucket that there are over 4,096 of them."""
    for name, value in (("BLOCK_BYTES", blocks), ("DIVERSE", diverse), ("BUCKET_BYTES", buckets)):
        monkeypatch.setattr(anchors, name, value)
    return random_texts(blocks + diverse)


@SIZES
def test_substring_dedup(spark, monkeypatch, blocks, diverse, buckets):
    texts = sized(monkeypatch, blocks, diverse, buckets)
    df = table(spark, texts)
    assert buckets > 2 or anchors.sizes(df)["buckets"] > 4096
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring_dedup(df).select("doc_id", "n_words", "n_removed", "kept").collect()), key=repr)
    assert got == brute_words(texts, 13)


@SIZES
def test_suffix_dedup(spark, monkeypatch, blocks, diverse, buckets):
    texts = sized(monkeypatch, blocks, diverse, buckets)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup(table(spark, texts), 60).collect()), key=repr)
    assert got == brute_bytes(texts, 60)


def test_carry_and_empty(spark):
    df = spark.createDataFrame([(1, "a b", "en")], "doc_id long, text string, lang string")
    assert substring_dedup(df, carry=("lang",)).select("doc_id", "kept", "lang").collect()[0] == (1, "a b", "en")
    assert substring_dedup(df.limit(0)).count() == 0 and suffix_dedup(df.limit(0)).count() == 0


def test_queries_on_whole_table(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: (n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in brute_words(texts, 13)}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in op1_substring_dedup(spark, SF).collect()} == want
    want = {i: (n, g, s, hashlib.sha256(k).hexdigest()) for i, n, g, s, k in brute_bytes(texts, 200)}
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op5_suffix_dedup(spark, SF).collect()} == want


def test_suffix_automaton_labels():
    a = SuffixAutomaton()
    a.add([1, 2, 3, 4], 7)
    a.add([9, 2, 3, 4, 5], 5)
    a.add([2, 3, 9], 6)
    a.close()
    assert a.first_labels([1, 2, 3, 4, 5], 3) == [7, 5, 5]
    assert a.first_labels([2, 3, 9, 2, 3], 2) == [5, 6, 5, 5]


def test_maximal_repeats():
    groups = maximal_repeats([b"xabcdefy", b"zabcdefw", b"qabcdr"], 3)
    assert sorted((n, sorted(p.tolist())) for n, p in groups) == [(4, [1, 10, 19]), (6, [1, 10])]


def brute_classes(texts, threshold=0.8):
    """The least id of each id's class, by the weighted Jaccard similarity of counts of five-word shingles; texts of one id stand together."""
    counts = []
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        counts.append((i, Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()))
    label = {i: i for i, _ in counts}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    totals = [sum(c.values()) for _, c in counts]
    holders = {}
    for n, (_, c) in enumerate(counts):
        for g in c:
            holders.setdefault(g, []).append(n)
    for n, (i, c) in enumerate(counts):
        shared = Counter()
        for g, k in c.items():
            for m in holders[g]:
                if m < n:
                    shared[m] += min(k, counts[m][1][g])
        for m, both in shared.items():
            a, b = find(i), find(counts[m][0])
            if a != b and both >= threshold * (totals[n] + totals[m] - both):
                label[max(a, b)] = min(a, b)
    return {i: find(i) for i in label}


@pytest.mark.parametrize("small", [0, 32])
def test_near_duplicates(spark, monkeypatch, small):
    monkeypatch.setattr(ND, "SMALL", small)
    monkeypatch.setattr(ND, "CHUNK", 4)
    rng = np.random.default_rng(3)
    base = [list(rng.choice([f"v{i}" for i in range(200)], 80)) for _ in range(6)]
    texts = []
    for i in range(60):
        w = list(base[i % 6])
        for _ in range(rng.integers(0, 5)):
            w[rng.integers(80)] = f"edit{rng.integers(10_000)}"
        texts.append((i, " ".join(w)))
    texts += [(200, None), (201, ""), (202, "one two"), (203, "ONE two"), (204, "  ")]
    line = "the same five words again "
    texts += [(300, line * 40), (301, line * 36), (302, line * 20), (303, line * 3), (304, line * 1_000)]  # equal sets, other counts
    got = {r.doc_id: r.class_id for r in ND.near_duplicates(table(spark, texts)).collect()}
    assert got == brute_classes(texts) and got[301] == 300 and got[302] == 302
    assert ND.near_duplicates(table(spark, texts).limit(0)).count() == 0


def test_near_duplicates_of_documents_with_several_texts(spark):
    words = [" ".join(f"{k}{i}" for i in range(40)) for k in "abcd"]
    texts = [(5, words[0]), (5, words[1]), (9, words[1] + " more"), (3, words[2]), (7, words[2]), (7, words[3]), (8, words[3] + " more"), (6, words[3]), (None, words[0])]
    rows = ND.near_duplicates(table(spark, texts)).collect()
    assert sorted((r.doc_id, r.class_id) for r in rows if r.doc_id is not None) == [(3, 3), (5, 5), (5, 5), (6, 3), (7, 3), (7, 3), (8, 3), (9, 5)]
    assert [r.class_id for r in rows if r.doc_id is None] == [None]


def test_every_near_copy_of_a_whole_table_is_found(spark):
    """Recall and precision of the classes against brute force: both 1 at similarity 0.8."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = brute_classes([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: r.class_id for r in ND.near_duplicates(docs).collect()} == want
    assert sum(i != c for i, c in want.items()) > 20


def test_dart_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 1 << 62, 400).astype(np.uint64))
    wa, wb = rng.integers(1, 5, 400), rng.integers(1, 5, 400)
    sig = ND.signatures(ND.Sets(np.concatenate((keys, keys, keys[:3])), np.concatenate((wa, wb, wa[:3])), np.array([0, 400, 800, 803])), 2048)
    true = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert abs((sig[0] == sig[1]).mean() - true) < 0.05


def test_fingerprints(spark):
    texts = [(1, "A b. C d.\nE f."), (2, "E f.\nC d. A b."), (3, None), (4, ""), (5, "x" * 30_000), (6, "日本. é! ok?"), (6, "dup"), (7, "A b.")]
    df = table(spark, texts)
    rows = FP.fingerprint_edits(df).collect()
    assert len(rows) == len(texts)
    by = {r.doc_id: r for r in rows}
    assert by[1].fingerprint == by[2].fingerprint and by[3].fingerprint == by[4].fingerprint != by[7].fingerprint
    assert by[1].edited == "A b. C " + "A b." and by[1].n_chars == 14  # after the last comes the first, doc 7
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows) and by[3].near_edited == 1
    a, b = (FP.fingerprints(spark.createDataFrame([(t,)], "text string")).select("f") for t in ("A b.\nC d.", "E f."))
    whole = FP.fingerprints(spark.createDataFrame([("E f.\nA b.\nC d.",)], "text string")).first().f
    one = a.withColumnRenamed("f", "a").join(b.withColumnRenamed("f", "b"))
    joined = one.select(FP.combine(F.col("a"), F.col("b")).alias("u"), FP.combine(FP.combine(F.col("a"), F.col("b")), F.col("b"), -1).alias("back"), "a").first()
    assert joined.u == whole and joined.back == joined.a
    assert FP.fingerprint_edits(df.limit(0)).count() == 0


def test_fingerprint_edits_follow_descending_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    got = {r.doc_id: r.edited for r in FP.fingerprint_edits(docs).collect()}
    for (i, t), (_, after) in zip(texts, texts[1:] + texts[:1]):
        half = len(t) // 2
        assert got[i] == t[: len(t) - half] + after[:half]


def test_bpe_matches_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from lotline.llm.bpe import bpe_round_trip

    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += ["", None, "  a  b\n\n c<|endoftext|>x <|endoftext|>", "日本語 😀", "a" * 3000, "it's we'll 12345 \t x", "\x00\x01 ñ ﬁ"]
    rows = {r.doc_id: r for r in bpe_round_trip(table(spark, list(enumerate(texts))), path).collect()}
    for i, t in enumerate(texts):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert list(memoryview(bytes(rows[i].ids)).cast("I")) == ids and rows[i].n_tokens == len(ids)
        assert rows[i].decoded == lib.decode(ids, skip_special_tokens=False)


def test_repeat_groups_hold_every_occurrence(spark, monkeypatch):
    """Groups are equal strings at two places or more, and together they cover every repeated window."""
    monkeypatch.setattr(anchors, "BLOCK_BYTES", 400)
    texts = [(i, t) for i, (_, t) in enumerate(random_texts(5))]
    raws = {i: (t or "").encode() for i, t in texts}
    groups, covered = {}, set()
    for r in repeat_groups(table(spark, texts), 60).collect():
        groups.setdefault((r.group_id, r.length), set()).add((r.doc_id, r.start))
    for (_, n), places in groups.items():
        assert n >= 60 and len(places) > 1 and len({raws[d][s : s + n] for d, s in places}) == 1
        covered |= {(d, k) for d, s in places for k in range(s, s + n - 59)}
    count = Counter(r[k : k + 60] for r in raws.values() for k in range(len(r) - 59))
    assert covered == {(i, k) for i, r in raws.items() for k in range(len(r) - 59) if count[r[k : k + 60]] > 1}
    assert repeat_groups(table(spark, texts).limit(0), 60).count() == 0


def brute_repeats(raws, length):
    """(length, places) of all strings at two places or more that can be made longer neither to the left nor to the right."""
    found = {}
    places = [(d, k) for d, r in enumerate(raws) for k in range(len(r))]
    todo = {}
    for d, k in places:
        if k + length <= len(raws[d]):
            todo.setdefault(raws[d][k : k + length], []).append((d, k))
    while todo:
        longer = {}
        for s, at in todo.items():
            if len(at) < 2:
                continue
            right, left = {}, set()
            for d, k in at:
                right.setdefault(raws[d][k + len(s)] if k + len(s) < len(raws[d]) else (d, k), []).append((d, k))
                left.add(raws[d][k - 1] if k else (d, k))
            if len(right) > 1 and len(left) > 1:
                found[s] = sorted(at)
            for c, own in right.items():
                if isinstance(c, int):
                    longer[s + bytes([c])] = own
        todo = longer
    return sorted((len(s), at) for s, at in found.items())


@pytest.mark.parametrize("block_bytes", [300, 1 << 20])
def test_repeat_groups_are_the_maximal_repeats_of_whole_texts(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(anchors, "BLOCK_BYTES", block_bytes)
    rng = np.random.default_rng(3)
    letters = lambda n: "".join(rng.choice(list("abcdefghijé "), n))
    long, nested = letters(2000), letters(150)
    texts = [letters(40) + long + letters(30), letters(10) + long, letters(60), letters(5) + long[300:900] + letters(9) + nested, nested + letters(3) + nested, "", "x" * 300, letters(20) + nested[20:140], long[300:900]]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    raws = [t.encode() for t in texts]

    def found(df):
        groups = {}
        for r in df.collect():
            groups.setdefault((r.group_id, r.length), []).append((r.doc_id, r.start))
        return sorted((n, sorted(at)) for (_, n), at in groups.items())

    want = brute_repeats(raws, 100)
    assert found(repeat_groups(rows, 100)) == want
    at = [(0, raws[0].index(long.encode())), (1, raws[1].index(long.encode()))]
    assert any(n >= len(long.encode()) and places[0][1] <= at[0][1] for n, places in want)
    pieces = found(repeat_groups(rows, 100, together=0))
    assert max(n for n, _ in pieces) < 600 and max(n for n, _ in want) >= 2000
