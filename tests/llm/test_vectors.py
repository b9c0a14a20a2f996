"""Exact and approximate search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelist.llm import bsi, permindex

KIND = "vec_id long, embedding array<float>, label int, vector string, score string, shard string"


def frame(spark, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 0, "x", "x", "x") for i, v in vectors]
    return spark.createDataFrame(rows, KIND).repartition(3)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(1)
    good = rng.normal(size=(300, 16)).astype(np.float32)
    good[40:60] = good[40]  # ties
    rows = [(i, v) for i, v in enumerate(good)]
    rows += [(0, good[0]), (400, None), (450, []), (500, [None] + [0.5] * 15), (550, [float("nan")] * 16)]
    rows += [(600, [float("inf")] * 16), (650, [1.0] * 3), (700, [0.0] * 16), (None, good[1])]
    return rows


def brute(rows, step, k, score, zero):
    taken = {}
    for i, v in rows:
        v = None if v is None else np.array([np.nan if x is None else x for x in v], float)
        if i is not None and v is not None and len(v) == 16 and np.isfinite(v).all() and (zero or v.any()):
            taken[i] = v
    ids = np.array(sorted(taken))
    matrix = np.stack([taken[i] for i in ids])
    out = {}
    for q in ids[ids % step == 0]:
        s = score(matrix, taken[q])
        order = [j for j in np.lexsort((ids, s)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), s[j]) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("shard", [1 << 16, 70])
def test_bit_sliced_top(spark, vectors, monkeypatch, shard):
    monkeypatch.setattr(bsi, "SHARD_ROWS", shard)
    monkeypatch.setattr(bsi, "QUERY_BLOCK", 2)
    whole = lambda v: np.floor(256 * v).astype(np.int64)
    expected = brute(vectors, 50, 5, lambda m, q: -(whole(m) @ whole(q)), zero=True)
    got = found(bsi.largest(frame(spark, vectors), F.col("vec_id") % 50 == 0))
    assert got == {q: [(i, -s) for i, s in rows] for q, rows in expected.items()}


def test_slices_add_up():
    rng = np.random.default_rng(2)
    values = rng.integers(-300, 300, (130, 9))
    index = bsi.Slices(values)
    for query in (*rng.integers(-300, 300, (5, 9)), np.zeros(9, int), np.full(9, -1)):
        sums, offset = index.scores(query)
        total = [offset + sum(int(s[r // 64] >> np.uint64(r % 64) & np.uint64(1)) << w for w, s in enumerate(sums)) for r in range(130)]
        assert total == (values @ query).tolist()
        top = index.top(sums, 4, np.array([3]))
        best = [r for r in np.lexsort((np.arange(130), -(values @ query))) if r != 3][:4]
        assert set(top.tolist()) == set(best)
    digits = bsi.signed_digits(np.array([0, 1, -7, 255, -256]))
    assert (digits @ (1 << np.arange(digits.shape[1]))).tolist() == [0, 1, -7, 255, -256]
    assert not (digits[:, 1:] * digits[:, :-1]).any()


def test_nearest(spark, vectors, monkeypatch):
    monkeypatch.setattr(permindex, "FILE_BLOCK", 16)  # files in several blocks
    monkeypatch.setattr(permindex, "QUERY_BLOCK", 1)
    distance = lambda m, q: np.sqrt(((m - q) ** 2).sum(axis=1))
    expected = brute(vectors, 20, 10, distance, zero=False)
    got = found(permindex.nearest(frame(spark, vectors), F.col("vec_id") % 20 == 0))
    assert set(got) == set(expected)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in rows}) for q, rows in expected.items())
    assert hits >= 0.95 * sum(map(len, expected.values()))
    for q, rows in got.items():
        assert len(rows) == 10 and rows == sorted(rows, key=lambda r: (r[1], r[0]))
    assert got[40] == expected[40]  # all ties: the smallest ids


def test_recall_on_the_given_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    local = [(r["vec_id"], r["embedding"]) for r in rows.collect()]
    matrix, ids = np.array([v for _, v in local]), np.array([i for i, _ in local])
    got = found(permindex.nearest(rows, F.col("vec_id") % 100 == 0))
    hits = 0
    for q in got:
        s = ((matrix - matrix[ids == q]) ** 2).sum(axis=1)
        hits += len({i for i, _ in got[q]} & set([i for i in ids[np.argsort(s)] if i != q][:10]))
    assert hits >= 0.9 * 10 * len(got)


def test_few_and_no_vectors(spark):
    few = frame(spark, [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (7, [1.0, 1.0])])
    every = F.col("vec_id") % 50 == 0
    assert [i for i, _ in found(permindex.nearest(few, every))[0]] == [7, 100]
    assert found(bsi.largest(few, every)) == {0: [(7, 65536), (100, 0)], 100: [(7, 65536), (0, 0)]}
    for none in (frame(spark, []), frame(spark, [(0, None)])):
        assert permindex.nearest(none, every).count() == 0
        assert bsi.largest(none, every).count() == 0
