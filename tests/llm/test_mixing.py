"""Mixing against a walk through each source."""

from fractions import Fraction
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from tests.llm.documents import SCHEMA, frame, odd
from tidelist.llm import mixing


def documents(spark, rows):
    """Rows of (doc_id, text, source)."""
    more = ("x",) * 8
    return spark.createDataFrame([(i, t, "en", s, 0, *more) for i, t, s in rows], SCHEMA).repartition(3)


def brute(rows, weights, seed=13, cap=3):
    """(sorted (doc_id, source, size, start, taken), {source: exact target})."""
    placed = []
    for i, text, source in rows:
        row_id = md5((text or "").encode()).hexdigest() if i is None else i
        key = int(md5(f"{seed}:{row_id}".encode()).hexdigest()[:15], 16)
        placed.append((source, key, i, len((text or "").encode().split())))
    sources = sorted({s for s, *_ in placed}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    size = {s: sum(p[3] for p in placed if p[0] == s) for s in sources}
    whole, capped = sum(size.values()), set()
    while True:
        free = [s for s in sources if s not in capped]
        rest = whole - sum(cap * size[s] for s in capped)
        rate = Fraction(rest, sum(weight[s] for s in free)) if free else 0
        more = {s for s in free if rate * weight[s] > cap * size[s]}
        if not more:
            break
        capped |= more
    target = {s: cap * size[s] if s in capped else rate * weight[s] for s in sources}
    out = []
    for s in sources:
        budget, at = int(target[s]), 0
        for _, _, i, n in sorted((p for p in placed if p[0] == s), key=lambda p: (p[1], p[2] or 0, p[3])):
            epochs = budget // size[s] if size[s] else 0
            out.append((i, s, n, at, epochs * n + max(0, min(n, budget - epochs * size[s] - at))))
            at += n
    return sorted(out, key=repr), target


def check(spark, docs, rows, weights):
    expected, target = brute(rows, weights)
    got = mixing.mix(docs, weights)
    documents = got.documents.collect()
    assert sorted(((r["doc_id"], r["source"], r["size"], r["start"], r["taken"]) for r in documents), key=repr) == expected
    for r in got.sources.collect():
        assert r["target"] == pytest.approx(float(target[r["source"]]), rel=1e-12)
        assert r["budget"] == int(target[r["source"]])
        taken = sum(d["taken"] for d in documents if d["source"] == r["source"])
        assert taken == r["budget"] and taken <= 3 * r["source_size"]
    return got


@pytest.mark.parametrize("range_rows", [1 << 16, 4])
def test_mix_equals_brute_force(spark, sentences, monkeypatch, range_rows):
    monkeypatch.setattr(mixing, "RANGE_ROWS", range_rows)
    rows = [(i, " ".join(sentences(i, 1 + i * 7 % 40)), f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, "a b\tc d\x1ce", "hot") for i in range(120)]
    # Small sources reach their cap, one after the other; one is empty, one has no name.
    rows += [(300, "x y", "é"), (301, "z", "Z"), (302, "", "empty"), (303, None, "empty"), (304, "o p q", None)]
    rows += [(0, rows[0][1], "s0"), (None, "no id here", "s1"), (None, "no id here", "s1"), (None, None, None)]
    docs = documents(spark, rows)
    got = check(spark, docs, rows, [1, 2, 3])
    again = mixing.mix(docs.repartition(7), [1, 2, 3]).documents
    assert sorted(map(repr, again.collect())) == sorted(map(repr, got.documents.collect()))


def test_odd_documents(spark, sentences):
    rows = odd(sentences)
    check(spark, frame(spark, rows), [(i, t, "s") for i, t, _ in rows], [5])


def test_many_sources(spark):
    rows = [(i, "w " * (i % 9), f"site{i}") for i in range(150)]
    check(spark, documents(spark, rows), rows, [1, 50])


def test_the_mix_holds_what_is_taken(spark, sentences):
    rows = [(i, " ".join(sentences(i, 20 + i)), "ab"[i % 2] if i else "c") for i in range(30)]
    docs = documents(spark, rows)
    found = mixing.mix(docs, [1, 9, 9])
    texts = mixing.mixed_texts(docs, found, copy="n")
    assert texts.columns == [*docs.columns, "_n"]
    sizes = {r["doc_id"]: r["s"] for r in texts.groupBy("doc_id").agg(F.sum(mixing.words_in(F.col("text"))).alias("s")).collect()}
    taken = {r["doc_id"]: r["taken"] for r in found.documents.where("taken > 0").collect()}
    assert sizes == taken
    whole = {(i, t) for i, t, _ in rows}
    pieces = [r for r in texts.collect() if (r["doc_id"], r["text"]) not in whole]
    assert len(pieces) <= 3 and all(dict(whole)[r["doc_id"]].startswith(r["text"]) for r in pieces)


def test_empty(spark):
    nothing = mixing.mix(documents(spark, []), [1, 2, 3])
    assert nothing.documents.count() == 0 and nothing.sources.count() == 0
    blank = mixing.mix(documents(spark, [(1, "", "a"), (2, None, "b")]), [1, 2, 3]).documents.collect()
    assert [(r["size"], r["target"], r["taken"]) for r in blank] == [(0, 0.0, 0)] * 2
