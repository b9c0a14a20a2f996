"""Spelling variants against edits tried one by one."""

import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest

from tests.llm.documents import frame, odd
from tidelist.llm import spelling
from tidelist.llm.queries import QUERIES

LOWER = {i: i + 32 for i in range(65, 91)}


def brute_words(rows):
    counts = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return counts


def brute_near(words):
    """{word: near words}, by words with one place blanked or removed."""
    same, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            same[w[:i], w[i + 1 :]].add(w)
            removed = w[:i] + w[i + 1 :]
            if removed in words:
                near[w].add(removed)
                near[removed].add(w)
    for group in same.values():
        for w in group:
            near[w] |= group - {w}
    return near


def brute_forms(counts, ratio=10):
    near = brute_near(counts)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n, len(near[w]), form[w], form[w] and counts[form[w]], root)
    return out


def found(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


def vocabulary(seed, size, letters, shortest=7, longest=11):
    rng = random.Random(seed)
    words = {"".join(rng.choices(letters, k=rng.randint(shortest, longest))) for _ in range(size)}
    for w in sorted(words)[:: 3]:
        i = rng.randrange(len(w))
        words.add(rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]]))
    return {w: int(10 ** rng.uniform(0.4, 5)) for w in sorted(words)}


CASES = {
    "many letters": vocabulary(1, 900, "abcdefghijklmnopqrstuvwxyzàé÷ÿ"),
    # All words have nearly the same counts: few leaves, many words at each.
    "few letters": vocabulary(2, 700, "ab"),
    "one group": vocabulary(3, 300, "aq"),
    # Counts beyond 255, lengths beyond what is compared at once.
    "long": {
        **{w: 3 for w in ("a" * 300, "a" * 301, "b" + "a" * 299, "a" * 150 + "b" + "a" * 149, "a" * 302)},
        **{("xyz" * 20)[:i] + c + ("xyz" * 20)[i:]: 2 + i * ord(c) for i in (0, 30, 59) for c in "wv"},
        "xyz" * 20: 40000,
    },
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("shard", [1 << 16, 40])
def test_forms_equal_brute_force(spark, monkeypatch, case, shard):
    monkeypatch.setattr(spelling, "SHARD_WORDS", shard)
    monkeypatch.setattr(spelling, "QUERY_BLOCK", shard * 3)
    counts = CASES[case]
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert found(spelling.forms(words)) == brute_forms(counts)


def test_pieces_do_not_change_what_is_found(monkeypatch):
    words = sorted(CASES["many letters"])
    monkeypatch.setattr(spelling, "PIECE", 7)
    index = spelling.Words(words)
    got = {frozenset((words[q], words[w])) for q, w in zip(*index.near(words))}
    assert got == {frozenset((a, b)) for a, bs in brute_near(CASES["many letters"]).items() for b in bs}


def test_one_edit():
    assert spelling.one_edit("abc", "abcd") and spelling.one_edit("xabc", "abc") and spelling.one_edit("abc", "axc")
    for a, b in (("abc", "abc"), ("abc", "acb"), ("abc", "abcde"), ("abcd", "bacx")):
        assert not spelling.one_edit(a, b)


def test_words_of_texts(spark, sentences):
    rows = [r for r in odd(sentences)]
    rows += [(20, "STRASSE Étranger×geben× naïvementŸxy don't’word", "fr"), (21, "Ã" * 9 + "あ" * 9, "x")]
    rows += [(100 + i, "understanding misunderstandé " * 3, "en") for i in range(40)]
    got = {r["word"]: r["n"] for r in spelling.words(frame(spark, rows)).collect()}
    assert got == dict(brute_words(rows))


def test_hand_on(spark, sentences, monkeypatch):
    monkeypatch.setattr(spelling, "KEPT_WORDS", 5)
    rows = odd(sentences)
    got = {r["word"]: r["n"] for r in spelling.words(frame(spark, rows)).collect()}
    assert got == dict(brute_words(rows))


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    counts = {w: n for w, n in brute_words(rows).items() if n >= 2}
    assert found(QUERIES["op12_spelling"](spark, sf)) == brute_forms(counts)


def test_empty(spark):
    assert spelling.forms(spelling.words(frame(spark, []))).count() == 0
    alone = spark.createDataFrame([("grandest", 3)], "word string, n long")
    assert found(spelling.forms(alone)) == {"grandest": (3, 0, None, None, "grandest")}
