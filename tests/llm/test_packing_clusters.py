"""Near copies in op10: none of them share a bin."""

import re

from lotline.llm.packing import op10_packing, pack_apart

SF = "/root/testdata/sf0.001"


def test_near_copies_never_share_a_bin(spark):
    base = [f"w{i}" for i in range(60)]
    copies = [" ".join([*base[:i], f"edit{i}", *base[i + 1 :]]) for i in (0, 59)] + [" ".join(base), " ".join(base).upper(), " ".join(base) + "  ", " ".join(base)]
    texts = [(i, t) for i, t in enumerate(copies)] + [(20, " "), (21, " "), (22, None), (23, None), (24, "one two"), (25, "alone here")]
    texts += [(None, " ".join(base)), (26, "other text"), (26, " ".join(base) + " end")]
    rows = pack_apart(spark.createDataFrame([(i, t, f"s{k}") for k, (i, t) in enumerate(texts)], "doc_id long, text string, source string")).collect()
    assert len(rows) == len(texts)
    near = [r.bin_id for r in rows if r.length >= 60]
    assert len(near) == 8 and len(set(near)) == 8
    blank = [r.bin_id for r in rows if r.doc_id in (20, 21)]
    assert len(set(blank)) == 2


def test_query_keeps_near_copies_apart(spark):
    from tests.llm.test_text_operators import brute_classes

    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    classes = brute_classes(texts)
    seen: dict[tuple, set] = {}
    for r in op10_packing(spark, SF).collect():
        seen.setdefault((r.bin_id, classes[r.doc_id]), set()).add(r.doc_id)
    assert len({r for _, r in seen}) < len(classes) and all(len(x) == 1 for x in seen.values())


def test_packing_equals_a_plain_search_of_all_bins():
    """Pieces in falling size; of all bins with room and without a conflict the tightest, then the oldest."""
    import numpy as np
    import pandas as pd

    from lotline.llm.packing import pack

    rng = np.random.default_rng(8)
    rows = pd.DataFrame({"size": rng.integers(0, 300, 400), "source": [f"s{i}" if i else None for i in rng.integers(0, 6, 400)], "cluster": [f"c{i}" if i < 150 else None for i in rng.integers(0, 200, 400)]})
    got = pack(rows, 128, 3)
    pieces = [(min(128, n - a), r, p, a) for r, n in enumerate(rows["size"].tolist()) for p, a in enumerate(range(0, max(n, 1), 128))]
    bins, want = [], []
    for n, r, p, a in sorted(pieces, key=lambda x: (-x[0], x[1], x[2])):
        s, c = rows["source"][r], rows["cluster"][r]
        fits = [b for b in bins if 0 < 128 - b["used"] >= n and not (c is not None and c in b["clusters"]) and not (s is not None and b["sources"].count(s) >= 3)]
        b = min(fits, key=lambda b: (128 - b["used"], b["no"])) if fits else {"no": len(bins), "used": 0, "clusters": [], "sources": []}
        if not fits:
            bins.append(b)
        want.append((r, p, a, n, b["no"], b["used"]))
        b["used"] += n
        b["clusters"].append(c)
        b["sources"].append(s)
    assert got == want


def test_words_are_counted_in_bytes(spark):
    """Counts equal a split at blanks, also in slices and of nulls, and the plan of the packed rows has no walk over characters."""
    import contextlib
    import io

    import pyarrow as pa

    from lotline.llm.packing import with_clusters, word_counts

    texts = ["", None, " ", "a", " a\tb\x0bc\x0c\r\nd ", "\u00e9t\u00e9\u00a0x \u65e5\u672c", "\x08 \x0e\x1c!", "x  " * 3000]
    want = [len([w for w in re.split(r"[ \t-\r]+", t or "") if w]) for t in texts]
    for kind in (pa.string(), pa.large_string()):
        assert word_counts(pa.array(texts, kind)).tolist() == want
        assert word_counts(pa.array(texts, kind)[3:6]).tolist() == want[3:6]
        assert word_counts(pa.array([], kind)).tolist() == word_counts(pa.array([None], kind)).tolist()[1:]
    rows = with_clusters(spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, source string"))
    assert {r.doc_id: r.size for r in rows.collect()} == dict(enumerate(want))
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        rows.explain("formatted")
    assert "translate" not in plan.getvalue() and "RLIKE" not in plan.getvalue()
