"""Clustering over a VA-file against rounds over all vectors."""

from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_vectors import frame
from tidelist.llm import vafile


def order():
    return F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")).cast("binary"), 256)



def brute(rows, k, rounds, dimensions, scale=1024):
    """(sorted (vec_id, cluster, distance), centroids); every row is a vector."""
    kept = []
    for i, v in rows:
        v = None if v is None else np.array([np.nan if x is None else np.float32(x) for x in v], float)
        if v is not None and len(v) == dimensions and np.isfinite(v).all():
            kept.append((i, np.floor(scale * v).astype(np.int64)))
    key = lambda r: (r[0] is None, sha256(f"3:{r[0]}".encode()).hexdigest(), r[0] or 0, r[1].tolist())
    centroids = np.array([v for _, v in sorted(kept, key=key)[:k]])
    vectors = np.array([v for _, v in kept])
    for r in range(rounds + 1):
        distance = ((vectors[:, None] - centroids) ** 2).sum(axis=2)
        nearest = distance.argmin(axis=1)
        if r < rounds:
            for c in range(len(centroids)):
                if (nearest == c).any():
                    centroids[c] = vectors[nearest == c].sum(axis=0) // (nearest == c).sum()
    members = [(i, int(c), int(d)) for (i, _), c, d in zip(kept, nearest, distance.min(axis=1))]
    return sorted(members, key=repr), centroids


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(6, 16))
    good = (middles[rng.integers(0, 6, 700)] + rng.normal(scale=0.2, size=(700, 16))).astype(np.float32)
    good[40:60] = good[40]  # a cluster of copies, and ties between centroids
    rows = [(i, v) for i, v in enumerate(good)]
    rows += [(0, good[0]), (0, good[9]), (None, good[1]), (None, [None] * 16), (700, None), (701, [])]
    rows += [(702, [float("nan")] * 16), (703, [float("inf")] * 16), (704, [1.0] * 3), (705, [0.0] * 16)]
    return rows


@pytest.mark.parametrize("block, bits", [(4096, 8), (64, 3)])
def test_clusters_equal_brute_force(spark, vectors, monkeypatch, block, bits):
    monkeypatch.setattr(vafile, "BLOCK_ROWS", block)
    monkeypatch.setattr(vafile, "BITS", bits)
    found = vafile.cluster(frame(spark, vectors), order(), k=5, rounds=6, dimensions=16)
    members, centroids = brute(vectors, 5, 6, 16)
    assert sorted(map(tuple, found.members.collect()), key=repr) == members
    assert found.centroids.tolist() == centroids.tolist()
    rows = vafile.with_inertia(found).collect()
    for r in rows:
        assert r["inertia"] == sum(d for _, _, d in members)
        assert r["cluster_inertia"] == sum(d for _, c, d in members if c == r["cluster"])
        digits = ",".join(map(str, centroids[r["cluster"]]))
        assert r["centroid_sha256"] == sha256(digits.encode()).hexdigest()


def test_few_vectors_are_fetched(spark, vectors):
    found = vafile.cluster(frame(spark, vectors), order(), k=5, rounds=8, dimensions=16)
    assert found.fetched[0] == 704  # everything changes its cluster at first
    assert found.fetched[-1] < 704 / 8


def test_intervals_hold_what_is_in_their_cells():
    rng = np.random.default_rng(6)
    vectors = rng.integers(-2000, 2000, (500, 7))
    centroids = rng.integers(-2000, 2000, (4, 7))
    grid = vafile.Grid.between(vectors.min(axis=0), vectors.max(axis=0))
    tables, cells = grid.tables(centroids), grid.cells(vectors)
    bounds = sum(tables[d][cells[d]] for d in range(7))
    origin = centroids.sum(axis=0) // 4
    exact = vafile.distances(vectors, centroids) - ((vectors - origin) ** 2).sum(axis=1)[:, None]
    assert (bounds[:, :4] <= exact).all() and (exact <= bounds[:, 4:]).all()


def test_few_none_and_huge(spark):
    few = frame(spark, [(3, [1.0, 0.0]), (4, [1.0, 0.0])])
    found = vafile.cluster(few, order(), dimensions=2)
    assert sorted(map(tuple, found.members.collect())) == [(3, 0, 0), (4, 0, 0)] and len(found.centroids) == 2
    for none in (frame(spark, []), frame(spark, [(0, None)])):
        assert vafile.with_inertia(vafile.cluster(none, order())).count() == 0
    with pytest.raises(ValueError, match="below"):
        vafile.cluster(frame(spark, [(0, [1e9, 0.0])]), order(), dimensions=2)
