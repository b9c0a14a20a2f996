"""Byte context trees and language identification."""

import zlib
from math import log2

import numpy as np

from tests.llm.documents import frame, odd
from tidelist.llm import langid, markov


def plain_bits(samples, order, text):
    """The code length by the definition, one byte at a time."""
    counts = {}
    lead = bytes([markov.START]) * order
    for sample in samples:
        data = lead + sample
        for i in range(order, len(data)):
            for size in range(order + 1):
                counts.setdefault(data[i - size : i], {}).setdefault(data[i], 0)
                counts[data[i - size : i]][data[i]] += 1
    total, data = 0.0, lead + text
    for i in range(order, len(data)):
        for size in range(order, -1, -1):
            seen = counts.get(data[i - size : i])
            if seen is None:
                continue
            times = sum(seen.values()) + len(seen)
            if data[i] in seen:
                total -= log2(seen[data[i]] / times)
                break
            total -= log2(len(seen) / times)
        else:
            total += 8
    return total


def test_code_lengths(monkeypatch):
    monkeypatch.setattr(markov, "BYTES_AT_ONCE", 64)
    samples = {"a": [b"abracadabra", b"alakazam", b""], "b": [b"hocus pocus", "grüße".encode()]}
    texts = [b"", b"abra", b"pocus alakazam", "ß\x00\xff".encode(), b"abracadabra hocus " * 20]
    for order in (0, 1, 3, 4):
        bits = markov.fit(samples, order).bits(texts)
        for row, text in zip(bits, texts):
            assert np.allclose(row, [plain_bits(samples[c], order, text) for c in "ab"], rtol=1e-4)


def test_hash_table():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 40, 5000).astype(np.uint64))
    table = markov.HashTable(keys)
    assert (table.rows(keys) == np.arange(len(keys))).all()
    other = np.setdiff1d(rng.integers(0, 1 << 40, 5000).astype(np.uint64), keys)
    assert (table.rows(other) == -1).all()
    assert (markov.HashTable(keys[:0]).rows(keys) == -1).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 150
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.98 * len(got)


def test_labels_and_ids_are_no_inputs(spark, sentences):
    texts = ["der die das und", "le la les et", "the of and to"]
    rows = [(i, f"{texts[i % 3]} {k}", ["de", "fr", "en"][i % 3]) for k, i in enumerate(range(60))]
    rows += odd(sentences) + [(1000 + i, "die das und der", lang) for i, lang in enumerate(["en", None, "zz"])]
    got = langid.identify(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    of = {}
    for r in got:
        of.setdefault(r["doc_id"], []).append(r)
        assert 0 <= r["score"] <= 1
        expected = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
        assert r["held_out"] == expected
    assert len({(r["lang_pred"], r["score"]) for i in (1000, 1001, 1002) for r in of[i]}) == 1
    for i in (3, 4, 5, 12):  # null, empty, blank, no letter
        if i in of:
            assert any(r["lang_pred"] == "und" and r["score"] == 0 for r in of[i])


def test_nothing_to_learn(spark):
    assert langid.identify(frame(spark, [])).count() == 0
    got = langid.identify(frame(spark, [(1, "abc", None), (2, None, "en")])).collect()
    assert [r["lang_pred"] for r in got] == ["und", "und"]


def test_bounded_sample(spark):
    rows = frame(spark, [(i, f"text number {i}", "en") for i in range(300)])
    assert langid.train(rows, texts=20).classes == ["en"]
    samples = langid._sample(rows, 20, 1000)
    assert {lang: len(texts) for lang, texts in samples.items()} == {"en": 20}


def test_languages_of_long_texts_are_learned(spark):
    short = [(i, f"text number {i}", "en") for i in range(30)]
    longer = [(100 + k, "y" * (300 + k), "en") for k in range(5)] + [(200, "z" * 150, "es")]
    longer += [(300 + k, f"{k}" * (400 + 100 * k), "fr") for k in range(9)] + [(400, "é" * 5000, "pt")]
    longer += [(401, "é" * 6000, "pt"), (500, None, "it"), (501, "", "it"), (502, "w" * 2000, "de")]
    samples = langid._sample(frame(spark, short + longer), 20, 100)  # 2,000 bytes per language
    assert len(samples.pop("en")) == 20
    assert sorted(map(len, samples["fr"])) == [400, 500, 600]  # the next one would go beyond
    assert [len(t) for t in samples["es"]] == [150]
    assert [len(t) for t in samples["de"]] == [2000]
    assert samples["pt"] == ["é".encode() * 500]
    assert set(samples) == {"de", "es", "fr", "pt"}


def test_every_labelled_text_is_learned(spark):
    rows = [(i, f"text number {i}", "en") for i in range(600)] + [(i, f"texte numéro {i}", "fr") for i in range(9)]
    rows += [(700, "q" * 3000, "en"), (701, "q" * 3000, "en"), (702, None, "en"), (703, "x", None)]
    model = langid.train(frame(spark, rows).repartition(3))
    samples = {lang: [t.encode() for t in {t for _, t, x in rows if t and x == lang}] for lang in ("en", "fr")}
    texts = [b"text number 77", "numéro 599 q".encode(), b"qqqq"]
    assert model.classes == ["en", "fr"]
    assert np.array_equal(model.bits(texts), markov.fit(samples, langid.ORDER).bits(texts))


def test_the_limit_is_of_all_held_out_texts(spark):
    model = markov.fit({"en": [f"text number {i}".encode() for i in range(90)]}, langid.ORDER)
    plain = [f"text number {i}" for i in range(500)]
    dear = [f"{'zwxq jv' * 3000} {k}" for k in range(5)]  # 1%, all longer than a sample of 400 would take
    rows = [(i, t, "en") for i, t in enumerate(plain + dear + dear + ["12 34", ""])]
    costs = [model.bits([t.encode()]).min() / len(t) for t in plain + dear]
    expected = langid.COST_MARGIN * np.quantile(costs, langid.COST_QUANTILE, method="inverted_cdf")
    assert abs(langid.cost_limit(frame(spark, rows), model) - expected) < 2 * langid.COST_MARGIN / langid.COST_GRID
    assert langid.cost_limit(frame(spark, [(1, None, "en"), (2, "12", "en")]), model) == langid.UNEXPLAINED
