"""What op 7 and op 10 pay for a signature and for the bands that documents share."""

import contextlib
import io
import math

import numpy as np

from lotline.llm import near_dedup as ND


def sets(*parts):
    """Sets of (keys, weights)."""
    keys, weights = (np.concatenate([np.asarray(p[i], t) for p in parts]) for i, t in ((0, np.uint64), (1, np.int64)))
    return ND.Sets(keys, weights, np.cumsum([0, *[len(p[0]) for p in parts]]))


def test_a_signature_hashes_elements_and_owned_darts_once(monkeypatch):
    """About one hash for each element and each dart in reach: not for darts that no coordinate can take."""
    hashed, mix, k = [], ND.mix, 160
    monkeypatch.setattr(ND, "mix", lambda h: hashed.append(len(h)) or mix(h))
    keys = np.random.default_rng(2).integers(0, 1 << 63, 20_000)
    for n in (1, 40, 500, 20_000):
        hashed.clear()
        ND.signatures(sets(*[(keys[:n] + i, np.ones(n)) for i in range(8)]), k)
        assert sum(hashed) / 8 < max(n, k * (math.log(k) + 2) / ND.AREA) + 1.5 * k * (math.log(k) + 2)


def test_least_darts_of_a_union_are_those_of_its_parts():
    """Every coordinate of the greater weights' signature is one of both, in any company, short and long, single and heavy."""
    rng = np.random.default_rng(5)
    for n, heavy in ((1, 1), (2, 9), (30, 2), (300, 5), (3_000, 1), (3_000, 40), (5, 20_000)):
        keys = np.sort(rng.integers(0, 1 << 63, n))
        a, b = rng.integers(0, heavy + 1, n), rng.integers(0, heavy + 1, n)
        a[0], b[-1] = max(a[0], 1), max(b[-1], 1)
        three = [(keys[w > 0], w[w > 0]) for w in (a, b, np.maximum(a, b))]
        one, two, both = ND.signatures(sets(*three), 160)
        assert ((both == one) | (both == two)).all()
        assert (ND.signatures(sets(three[2]), 160)[0] == both).all() and len(set(both.tolist())) == 160
        true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs((one == two).mean() - true) < 0.16  # four standard deviations


def test_shared_bands_come_without_a_self_join(spark):
    rows = [(1, 5, [10, 11, 12]), (2, 6, [10, 21, 12]), (3, 7, [30, 11, 33]), (4, 5, [40, 41, 42]), (5, 8, [50, 50, 51]), (1, 5, [10, 61, 62]), (6, 9, None)]
    got = ND.shared_bands(spark.createDataFrame(rows, "rep long, total long, bands array<long>"))
    assert sorted(map(tuple, got.select("key", "rep", "total", "pivot").collect())) == [(10, 1, 5, 1), (10, 2, 6, 1), (11, 1, 5, 1), (11, 3, 7, 1), (12, 1, 5, 1), (12, 2, 6, 1)]
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        got.explain("formatted")
    assert "Join" not in plan.getvalue()
