"""Op 4's score against a plain walk through its trees, and its features counted by hand."""

import numpy as np

from lotline.llm import toxicity as T


def test_scores_equal_a_plain_walk():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.5)).astype(float)
    trees = T.grow(x, y, trees=20)
    knots, values = T.isotonic(trees.margin(x), y)
    for row in x[:50]:
        margin = trees.start
        for f, c, leaf in zip(trees.feature, trees.cut, trees.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > c[node] else 1)
            margin += leaf[node - len(f)]
        assert abs(margin - trees.margin(row[None, :])[0]) < 1e-9
    p = np.interp(trees.margin(x), knots, values)
    assert ((p > 0.5) == (y > 0.5)).mean() > 0.95 and 0 <= p.min() and p.max() <= 1


def test_features_by_hand():
    f = T.Features(["grausam", "mör*"], [3.0, 2.0])
    rows = f.rows(["You idiot! YOU", "der GRAUSAME Mörder", "MÖRSER grausam", "1d10t you", "", None])
    at = {n: i for i, n in enumerate(T.NAMES)}
    assert rows[0, at["fixed_rate"]] == 1 / 3 and rows[0, at["person_rate"]] == 2 / 3 and rows[0, at["near_any"]] == 1
    assert rows[0, at["caps_words"]] == 1 / 3 and rows[0, at["exclaim_rate"]] == 1 / 14
    assert rows[1, at["learnt_most"]] == 2.0 and rows[2, at["learnt_most"]] == 3.0  # accented capitals are read as small letters
    assert rows[2, at["learnt_rate"]] == 1.0 and rows[3, at["hidden_any"]] == 1
    assert np.all(np.isfinite(rows)) and rows[4, at["log_words"]] == 0 == rows[5, at["log_words"]]
