"""Encoding, token files and packing against the tokenizers themselves."""

import random
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from tests.llm.documents import frame, odd
from tidelist.llm import bpe, idfile, packing, tokens
from tidelist.llm.common import scratch

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def word_ids():
    by = Tokenizer.from_file(WORDS)
    return lambda text: by.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def rank_ids():
    ranks = bpe.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def strange(seed: int) -> str:
    rng = random.Random(seed)
    letters = "aaabAZ  \n\t\r\x0b\x1c\u00a0\u2003='s.,|!日é\u0301ßΣİ👍٣²<|endoftext|>"
    return "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))


def test_words_encoded_one_by_one_are_the_text_encoded(word_ids, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 300)  # both generations are used
    with open(WORDS, "rb") as f:
        by = tokens.WordEncoder(f.read())
    for seed in range(40):
        texts = [strange(50 * seed + k) for k in range(50)] + [None]
        ids, bounds = by.encode(pa.array(texts))
        for text, a, b in zip(texts, bounds, bounds[1:]):
            assert ids[a:b].tolist() == word_ids(text), repr(text)


def test_kept_words_have_their_ids_in_both_generations(word_ids, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 4)
    with open(WORDS, "rb") as f:
        by = tokens.WordEncoder(f.read())
    long = "ß" * 30
    texts = ["Été été a|b x1 |", f"{long} {long}s zwölf a1", "été zwölf a|b x1 | don't", f" ABC {long} ÀÖØ abc", ""]
    for text in texts * 3:
        ids, bounds = by.encode(pa.array([text, None]))
        assert ids.tolist() == word_ids(text) and bounds.tolist() == [0, len(ids), len(ids)], text
        assert all(len(w) <= tokens.LONGEST_KEPT for w in by.young)


def test_words_of_letters_are_parted_at_spaces_only():
    """The pattern of the vocabulary leaves them whole, but took a good part of the encoding."""
    with open(WORDS, "rb") as f:
        plain = Tokenizer.from_buffer(tokens._plain(f.read()))
    kinds = [type(step).__name__ for step in plain.pre_tokenizer]
    assert plain.normalizer is None and kinds == ["WhitespaceSplit", "ByteLevel"]
    whole = Tokenizer.from_file(WORDS)
    for c in (chr(c) for c in range(0xDF, 0x100) if c != 0xF7):
        text = f"a{c}b {c}{c} l{c}"
        assert plain.encode(text, add_special_tokens=False).ids == whole.encode(text, add_special_tokens=False).ids


def test_byte_bpe_equals_the_rank_library(rank_ids):
    by = Tokenizer.from_str(bpe.definition(bpe.read_ranks(RANKS), PATTERN))
    for seed in range(3000):
        text = strange(seed)
        assert by.encode(text, add_special_tokens=False).ids == rank_ids(text), repr(text)
    for base in range(0, 0x110000, 128):  # every character that can be encoded
        text = "1".join(chr(c) for c in range(base, base + 128) if not 0xD800 <= c < 0xE000)
        assert by.encode(text, add_special_tokens=False).ids == rank_ids(text), hex(base)


def test_parts_encoded_once_are_the_text_encoded(rank_ids, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PARTS", 300)  # both generations are used
    definition = bpe.definition(bpe.read_ranks(RANKS), PATTERN)
    by, whole = bpe.TextEncoder(definition.encode()), Tokenizer.from_str(definition)
    for seed in range(40):
        texts = [strange(50 * seed + k) for k in range(50)] + [None, "a" * 9000, "Straße, \n one  two.\n"]
        ids, bounds, *utf8 = by.encode(pa.array(texts))
        starts, ends = by.offsets(ids, bounds, *utf8)
        for text, a, b in zip(texts, bounds, bounds[1:]):
            assert ids[a:b].tolist() == rank_ids(text or ""), repr(text)
            known = whole.encode(text or "", add_special_tokens=False).offsets
            assert list(zip(starts[a:b].tolist(), ends[a:b].tolist())) == known, repr(text)
    for empty in (pa.array([], pa.string()), pa.array([None, ""])):
        ids, bounds, *utf8 = by.encode(empty)
        assert not len(ids) and not bounds.any() and not len(by.offsets(ids, bounds, *utf8)[0])


def test_round_trip_and_offsets(spark, sentences, rank_ids):
    rows = odd(sentences)
    docs = frame(spark, rows)
    got = bpe.round_trip_digests(docs, RANKS, PATTERN).collect()
    expected = []
    for i, t, _ in rows:
        ids = np.array(rank_ids(t or ""), "<u4")
        expected.append((i, len(ids), sha256(ids).hexdigest(), sha256((t or "").encode()).hexdigest()))
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted((tuple(r)[:4] for r in got), key=order) == sorted(expected, key=order)
    sums = {(r["doc_id"], r["ids_sha256"]): r["offsets_crc32"] for r in got}
    for r in bpe.encoded(docs, RANKS, PATTERN).collect():
        own = (r["doc_id"], sha256(np.array(r["ids"], "<u4")).hexdigest())
        assert sums[own] == zlib.crc32(np.array(r["starts"] + r["ends"], "<u4"))
    texts = {i: t for i, t, _ in rows}
    for r in bpe.encoded(docs, RANKS, PATTERN).where("doc_id IN (6, 13)").collect():
        text = texts[r["doc_id"]]
        assert r["starts"][0] == 0 and r["ends"][-1] == len(text)
        assert all(a <= b for a, b in zip(r["starts"], r["ends"]))
        seen = set().union(*(range(a, b) for a, b in zip(r["starts"], r["ends"])))
        assert seen == set(range(len(text)))
    # Ids that end within a character are decoded by their bytes.
    cut = spark.createDataFrame([(1, rank_ids("👍")[:1]), (2, None)], "doc_id long, ids array<int>")
    got = {r["doc_id"]: bytes(r["bytes"]) for r in bpe.decoded(cut, RANKS).collect()}
    assert "👍".encode().startswith(got[1]) and got[2] == b""
    assert bpe.text_of(got[1])


def test_codes():
    rng = np.random.default_rng(5)
    counts = np.array([0, 1, 2, 3, 4, 5, 0, 1000, 0])
    ranks = [np.exp(rng.uniform(0, 22, n)).astype(np.uint32) for n in counts]
    pairs = [idfile.code(r) for r in ranks]
    control, data = (b"".join(x) for x in zip(*pairs))
    assert (idfile.decode(control, data, counts) == np.concatenate(ranks)).all()
    edges = np.array([0, 255, 256, 65535, 65536, (1 << 24) - 1, 1 << 24, (1 << 32) - 1], np.uint32)
    control, data = idfile.code(edges)
    assert len(data) == 1 + 1 + 2 + 2 + 3 + 3 + 4 + 4
    assert (idfile.decode(control, data, np.array([8])) == edges).all()


def test_files_hold_every_document(spark, sentences, word_ids, monkeypatch):
    monkeypatch.setattr(idfile, "BLOCK_IDS", 500)
    rows = odd(sentences)
    files = idfile.write(frame(spark, rows), WORDS, 2, scratch(spark, "ids"))
    got = idfile.read(spark, files).orderBy("start").collect()
    ids = [(i, np.array(word_ids(t) + [2], "<u4")) for i, t, _ in rows]
    order = lambda r: (r[0] is not None, r[0] or 0, r[1])  # noqa: E731  null ids come first
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in ids), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    seen = sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=order)
    assert seen == sorted(((i, len(x), zlib.crc32(x)) for i, x in ids), key=order)


def check_pieces(pieces, ids_of, window=2048):
    """Every id in one piece, sequences without gaps, only powers of two unfilled."""
    at, sequences = {}, {}
    for p in sorted(pieces, key=lambda p: p["start"]):
        ids = ids_of[p["doc_id"]]
        assert p["start"] == at.get(p["doc_id"], 0) and p["doc_tokens"] == len(ids)
        at[p["doc_id"]] = p["start"] + p["length"]
        assert bytes(p["ids"]) == ids[p["start"] : at[p["doc_id"]]].tobytes()
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert at == {i: len(x) for i, x in ids_of.items()}
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end == window or end < window and end & (end - 1) == 0


def test_packing(spark, sentences, word_ids, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_IDS", 20_000)
    rows = [r for r in odd(sentences) if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    rows += [(100 + k, " ".join(sentences(100 + k // 2, 150 + 40 * k)), "en") for k in range(12)]
    pieces = packing.pack(frame(spark, rows), WORDS, 1).collect()
    check_pieces(pieces, {i: np.array(word_ids(t) + [1], "<u4") for i, t, _ in rows})
    twice = packing.pack(frame(spark, [(1, "a b", "en"), (1, "a b", "en"), (None, None, None)]), WORDS, 1)
    got = twice.groupBy("doc_id").agg({"length": "sum"}).collect()
    assert sorted((r[0] or 0, r[1]) for r in got) == [(0, 1), (1, 6)]


def test_document_frequencies_come_with_the_tokens(spark, sentences, word_ids):
    rows = odd(sentences)
    docs = frame(spark, rows + rows[:5]).repartition(3)
    stored = tokens.token_table(docs, WORDS, 1, counted=True).cache()
    got = {r["id"]: r["n"] for r in packing.document_frequencies(stored).collect()}
    expected = {}
    for _, t, _ in rows + rows[:5]:
        for i in set(word_ids(t)):
            expected[i] = expected.get(i, 0) + 1
    assert got == expected  # the end, id 1, is not counted
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    plain = tokens.token_table(docs, WORDS, 1).collect()
    left = stored.where("n IS NOT NULL").drop("counts").collect()
    assert sorted(map(tuple, left), key=order) == sorted(map(tuple, plain), key=order)
    # Ids beyond 16 bits.
    counts = tokens.Frequencies()
    counts.add(np.array([70_000, 5, 5, 1, 70_000, 1, 1], np.uint32), np.array([0, 4, 6, 7]))
    seen, n = np.frombuffer(counts.raw(), "<i8").reshape(2, -1)
    assert dict(zip(seen.tolist(), n.tolist())) == {5: 1, 70_000: 2}


def test_impacts_of_many_documents_are_those_of_each():
    rng = np.random.default_rng(8)
    docs = [np.append(rng.integers(0, 60, n), 1).astype(np.uint16) for n in (0, 7, 0, 0, 300, 1, 0)]
    idf = rng.uniform(0.1, 3, 60).astype(np.float32)
    term, impact, bounds = packing._impacts(docs, idf, 40.0)
    for d, a, b in zip(docs, bounds, bounds[1:]):
        ids, tf = np.unique(d[:-1], return_counts=True)
        norm = packing.K1 * (1 - packing.B + packing.B * len(d) / 40.0)
        assert term[a:b].tolist() == ids.tolist()
        assert np.allclose(impact[a:b], idf[ids] * tf * (packing.K1 + 1) / (tf + norm))
    for none in ([], docs[:1]):
        assert [len(x) for x in packing._impacts(none, idf, 1.0)] == [0, 0, len(none) + 1]


def test_a_window_is_filled_with_the_nearest_unused_documents():
    rng = np.random.default_rng(6)
    topics = [rng.integers(1000 * k, 1000 * k + 40, (6, 300)) for k in range(1, 5)]
    docs = [np.append(topics[k % 4][k // 4], 1).astype(np.uint16) for k in range(24)]
    idf = np.full(6000, 2.0, np.float32)
    pieces = packing.pack_shard(docs, idf, 301.0, 602)
    assert sum(p[2] for p in pieces) == 24 * 301
    mates = {}
    for doc, _, _, sequence, _ in pieces:
        mates.setdefault(sequence, set()).add(doc % 4)
    assert sum(len(m) == 1 for m in mates.values()) >= len(mates) - 4  # windows keep to a topic
    brute = bm25(docs, 0, idf, 301.0)
    index = packing.Shard(docs, idf, 301.0)
    index.used[0] = True
    near = list(index.neighbours(0))
    assert set(near) == {d for d in range(1, 24) if brute[d] > 0}
    assert all(brute[a] >= brute[b] - 1e-3 for a, b in zip(near, near[1:]))


def bm25(docs, seed, idf, mean):
    """Scores by the formula, term by term, for the looked-up terms of the seed."""
    query = packing.Shard(docs, idf, mean).queries[seed]
    out = []
    for d in docs:
        norm = packing.K1 * (1 - packing.B + packing.B * len(d) / mean)
        tf = [(d[:-1] == t).sum() for t in query]
        out.append(sum(idf[t] * f * (packing.K1 + 1) / (f + norm) for t, f in zip(query, tf)))
    return out


def test_a_seed_is_searched_by_all_of_its_ids():
    rng = np.random.default_rng(9)
    vocabulary = np.minimum(rng.zipf(1.3, 20_000), 900)
    docs = [np.append(rng.choice(vocabulary, rng.integers(0, 400)), 1).astype(np.uint16) for _ in range(60)]
    # Shares with the seed one id only, of the least weight.
    docs[7] = np.append(np.arange(901, 1001), 1).astype(np.uint16)
    docs[8] = np.array([950, 1], np.uint16)
    idf = rng.uniform(0.5, 3, 1001).astype(np.float32)
    idf[950] = 0.1
    index = packing.Shard(docs, idf, 200.0)
    for seed in (7, 0, 20, 41):  # what is used leaves the index meanwhile
        index.used[seed] = True
        brute = np.zeros(len(docs))
        for d, ids in enumerate(docs):
            norm = packing.K1 * (1 - packing.B + packing.B * len(ids) / 200.0)
            for t in set(docs[seed][:-1].tolist()):
                f = int((ids[:-1] == t).sum())
                brute[d] += idf[t] * f * (packing.K1 + 1) / (f + norm)
        near = list(index.neighbours(seed))
        assert set(near) == {d for d in range(60) if brute[d] > 0 and not index.used[d]}
        assert all(brute[a] >= brute[b] - 1e-3 for a, b in zip(near, near[1:]))
        assert seed != 7 or near == [8]
        index.used[near[:15]] = True


def test_like_documents_meet_in_a_shard(spark, sentences, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_IDS", 4_000)
    rows = []
    for group in range(60):
        words = sentences(500 + group, 200)
        for k in range(3):  # a tenth of the words differs
            rows.append((3 * group + k, " ".join(w for j, w in enumerate(words) if j % 20 != k), "en"))
    pieces = packing.pack(frame(spark, rows), WORDS, 1).select("doc_id", "sequence_id", "length").collect()
    shards, sizes = {}, {}
    for p in pieces:
        shard = p["sequence_id"] >> 32
        shards.setdefault(p["doc_id"] // 3, set()).add(shard)
        sizes[shard] = sizes.get(shard, 0) + p["length"]
    assert len(sizes) > 8 and max(sizes.values()) <= 4_000
    assert sum(len(s) == 1 for s in shards.values()) >= 45  # none, if dealt by hash


def test_copies_that_fill_shards_are_dealt_by_hash():
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.standard_normal((200, packing.AXES)), np.ones((800, packing.AXES))]).astype(np.float32)
    tree = packing.Tree(points, np.full(1000, 10.0), 1000)
    size = np.bincount(tree.shard(points, rng.integers(0, 1 << 32, 1000)), minlength=tree.shards) * 10
    assert size.sum() == 10_000 and size.max() <= 1400 and tree.shards >= 10


def test_empty_tables(spark):
    none = frame(spark, [])
    assert bpe.round_trip_digests(none, RANKS, PATTERN).count() == 0
    assert packing.pack(none, WORDS, 1).count() == 0
    assert idfile.read(spark, idfile.write(none, WORDS, 2, scratch(spark, "ids"))).count() == 0
