"""Hard negatives against brute force, the bounds, and edge rows."""

import collections

import numpy as np
from pyspark.sql import functions as F

from civicspark.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score string, positives string"


def brute_force(rows, scale=256, k=5, floor=80, every=10):
    kept = {}
    for i, v, label, *_ in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        w = [int(np.floor(scale * float(np.float32(x)))) for x in v]
        kept[i] = min(kept.get(i, (label, w)), (label, w))
    out = set()
    for a, (label, v) in kept.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in kept.items()
                        if i != a and len(w) == len(v))
        for s, p, other in [x for x in scored if x[2] == label][:k]:
            hits = [(n, i) for n, i, o in scored if o != label and floor * -s <= 100 * -n <= 100 * -s][:k]
            out |= {(a, p, r, i, -s, -n) for r, (n, i) in enumerate(hits, 1)}
    return out


def mined(spark, rows, every=10, **kw):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    return [tuple(r) for r in negatives.hard_negatives(df, F.col("label"), F.col("vec_id") % every == 0, **kw).collect()]


def clustered(n, seed=1, dims=12, classes=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(classes * 2, dims))
    return [(int(i), [float(x) for x in centres[rng.integers(classes * 2)] + 0.3 * rng.normal(size=dims)],
             int(rng.integers(classes))) for i in range(n)]


def test_negatives_against_brute_force_with_edge_rows(spark):
    rows = clustered(400)
    rows += [(1000 + i, rows[3][1], i % 4) for i in range(120)]                 # many copies, ties
    rows += [(2000, None, 1), (2010, [1.0] * 12, None), (2020, [float("nan")] * 12, 1), (None, [1.0] * 12, 1),
             (2030, [1.0, None] * 6, 1), (2040, [1.0, 2.0], 1), (2041, [1.0, 1.5], 1), (2042, [1.0, 1.4], 2),
             (2050, [], 1), (2051, [], 1), (2052, [], 3), (2060, [0.0] * 12, 2), (2070, [float("inf")] * 12, 0)]
    got = mined(spark, rows + rows[:5])
    assert len(got) == len(set(got)) and set(got) == brute_force(rows)


def test_negatives_through_many_blocks(spark, monkeypatch):
    for name, value in (("ROWS_PER_BLOCK", 60), ("ANCHORS_PER_BLOCK", 7), ("LEAST_BLOCKS", 2), ("ROWS_AT_ONCE", 16),
                        ("PIVOTS", 4)):
        monkeypatch.setattr(negatives, name, value)
    rows = clustered(300, seed=2) + [(3000 + i, [0.5] * 12, i % 3) for i in range(100)]
    assert set(mined(spark, rows)) == brute_force(rows)


def test_negatives_of_large_numbers_and_few_rows(spark):
    rows = [(10 * i, [2e6 + 3e4 * i, -3e5 + 7.7 * i], i % 2) for i in range(30)] + [(7, [1e6, 1.0], 0)]
    want = brute_force(rows)
    assert want and max(w[4] for w in want) > 2 ** 53
    assert set(mined(spark, rows)) == want
    assert mined(spark, []) == []
    assert mined(spark, [(10, [1.0], 1)]) == []


def test_bounds_hold_and_save_products():
    rng = np.random.default_rng(4)
    anchors = np.floor(256 * (rng.normal(size=16) + 0.02 * rng.normal(size=(40, 16))))
    rows = np.floor(256 * rng.normal(size=(500, 16)))
    tree = negatives.spanning_tree(anchors)
    assert sorted(a for a, _, _ in tree) == list(range(40)) and tree[0][1] == -1
    m = negatives.Scorer(anchors, rows)
    exact = rows @ anchors.T
    for a, parent, edge in tree:
        low, high = m.bounds(a, parent, edge)
        assert (low <= exact[:, a]).all() and (exact[:, a] <= high).all()
        top = np.sort(exact[:, a])[-5]
        m.score(a, np.arange(500) if parent < 0 else np.nonzero(high >= top)[0])
    assert m.scored < 0.25 * exact.size


def test_spanning_tree_is_minimal():
    v = np.random.default_rng(6).integers(-50, 50, (25, 3)).astype(float)
    links = sorted((float(np.linalg.norm(v[i] - v[j])), i, j) for i in range(25) for j in range(i))
    parent = list(range(25))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    total = 0.0
    for d, i, j in links:
        if root(i) != root(j):
            parent[root(i)] = root(j)
            total += d
    tree = negatives.spanning_tree(v)
    assert np.isclose(sum(e for _, _, e in tree), total)
    seen = collections.Counter()
    for a, p, _ in tree:
        assert p == -1 or seen[p]
        seen[a] += 1
