"""Substring deduplication and near-duplicates against brute force."""

from hashlib import sha256
from itertools import combinations

import numpy as np
import pytest

from tests.llm.documents import frame, odd
from tidelist.llm import minhash, substring
from tidelist.llm.components import components


def brute_removed(rows, length):
    """{doc_id: (words, removed flags)}; rows without an id take no part."""
    texts = {i: (t or "").encode().split() for i, t, *_ in rows if i is not None}
    first = {}
    for i in sorted(texts):
        for k in range(len(texts[i]) - length + 1):
            first.setdefault(tuple(texts[i][k : k + length]), i)
    out = {}
    for i, words in texts.items():
        gone = [False] * len(words)
        for k in range(len(words) - length + 1):
            if first[tuple(words[k : k + length])] < i:
                gone[k : k + length] = [True] * length
        out[i] = words, gone
    return out


@pytest.mark.parametrize("length", [50, 7])
def test_counts_equal_brute_force(spark, sentences, length):
    rows = odd(sentences)
    # Runs of one word, which overlap themselves, and a chain of overlapping passages.
    rows += [(20, "na " * 300, "en"), (21, "na " * 120 + "so", "en")]
    long = sentences(9, 200)
    rows += [(30 + k, " ".join(long[20 * k : 20 * k + 80]), "en") for k in range(6)]
    got = substring.Repeats(frame(spark, rows), length).counts().collect()
    assert len(got) == len(rows)
    expected = brute_removed(rows, length)
    for r in got:
        if r["doc_id"] is None:
            assert r["n_removed"] == 0
            continue
        words, gone = expected[r["doc_id"]]
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        assert r["n_words"] == len(words) and r["n_removed"] == sum(gone), r["doc_id"]
        assert r["kept_sha256"] == sha256(kept).hexdigest()


def test_cut_texts(spark, sentences):
    rows = odd(sentences)
    docs = frame(spark, rows)
    got = substring.deduplicated(docs, counted="cut").collect()
    assert docs.columns + ["cut"] == list(got[0].asDict())
    expected, texts = brute_removed(rows, 50), {i: t for i, t, _ in rows}
    for r in got:
        if r["doc_id"] is None or r["cut"] == 0:
            assert r["doc_id"] is None or r["text"] == texts[r["doc_id"]]
            continue
        words, gone = expected[r["doc_id"]]
        assert r["text"].encode().split() == [w for w, g in zip(words, gone) if not g]
        assert r["n_removed"] == "x"  # a column of that name passes through


def test_gram_hashes_depend_on_their_words_only():
    rng = np.random.default_rng(1)
    word = rng.integers(0, 1 << 62, 300).astype(np.uint64)
    word[200:260] = word[100:160]
    for size in (1, 2, 3, 25, 50):
        hashes = substring.gram_hashes(word, size, 0x9E3779B97F4A7C15)
        assert len(hashes) == 301 - size
        assert (hashes[200 : 261 - size] == hashes[100 : 161 - size]).all()
        assert len(np.unique(hashes)) == 301 - size - (61 - size)


def brute_components(rows, size, threshold):
    sets = {}
    for i, t, *_ in rows:
        words = (t or "").encode().lower().split()
        grams = [tuple(words[k : k + size]) for k in range(len(words) - size + 1)]
        sets[i] = set(grams or ([tuple(words)] if words else []))
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in combinations([i for i in sets if i is not None], 2):
        both = len(sets[a] & sets[b])
        if sets[a] and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
            low, high = sorted((root(a), root(b)))
            up[high] = low
    return {i: (len(s), root(i) if i is not None else None) for i, s in sets.items()}


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates_equal_brute_force(spark, sentences, size):
    rows = odd(sentences)
    # A chain in which neighbours are linked and the ends are not, and a large group.
    text = sentences(11, 120)
    for k in range(12):
        text = list(text)
        text[10 * k % 120] = f"edit{k}"
        rows.append((100 + k, " ".join(text), "en"))
    hub = sentences(12, 90)
    for k in range(60):
        rows.append((200 + k, " ".join(hub[: k % 45] + [f"w{k}"] + hub[k % 45 + 1 :]), "en"))
    got = minhash.near_duplicates(frame(spark, rows), size).collect()
    assert len(got) == len(rows)
    expected = brute_components(rows, size, 80)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
            continue
        assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]], r["doc_id"]
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_pairs_within_buckets_reach_members_the_pivot_does_not(spark, monkeypatch):
    """In one bucket: the pivot resembles nobody, two others resemble each other."""
    monkeypatch.setattr(minhash, "BLOCK", 2)
    rng = np.random.default_rng(3)
    kind = "band int, key long, rep long, component long, n long, fine array<long>, bands array<long>"
    far = lambda: rng.integers(-(1 << 62), 1 << 62, minhash.FINE // 64).tolist()
    twins = far()
    rows = [(0, 5, 1, 1, 100, far())] + [(0, 5, i, i, 100, far()) for i in range(2, 9)]
    rows += [(0, 5, 10, 10, 100, twins), (0, 5, 11, 11, 90, twins), (0, 5, 12, 12, 70, twins)]
    rows += [(1, 5, 20, 20, 100, twins), (1, 5, 21, 20, 100, twins)]  # one component: no pair
    rows += [(1, 6, 10, 10, 100, twins), (1, 6, 11, 11, 90, twins)]  # met in band 0 already
    rows = [(*r, [5, 6]) for r in rows]
    members = minhash._open(spark.createDataFrame(rows, kind))
    got = minhash._within_buckets(members, 80).collect()
    assert [tuple(r) for r in got] == [(10, 11)]


def test_estimates_of_packed_signatures():
    rng = np.random.default_rng(4)
    one = rng.integers(0, 1 << 60, 3000).astype(np.uint64)
    two = np.concatenate([one[:2400], rng.integers(0, 1 << 60, 600).astype(np.uint64)])
    a, b = (minhash.packed(minhash.minima(x)).view(np.uint64) for x in (one, two))
    differ = sum(((int(x ^ y) >> 4 * k) & 15) != 0 for x, y in zip(a, b) for k in range(16))
    assert abs(minhash.estimate(differ) - 2400 / 3600) < minhash.MARGIN
    a, b = (minhash.packed(minhash.minima(x, minhash.FINE), 1).view(np.uint64) for x in (one, two))
    differ = int(np.bitwise_count(a ^ b).sum())
    assert abs(minhash.estimate(differ, minhash.FINE, 1) - 2400 / 3600) < minhash.FINE_MARGIN


def test_components(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (60, 61), (61, 60)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}, 60: 60, 61: 60}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_tables(spark):
    none = frame(spark, [])
    assert substring.Repeats(none).counts().count() == 0
    assert substring.deduplicated(none).count() == 0
    assert minhash.near_duplicates(none).count() == 0
