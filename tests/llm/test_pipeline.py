"""The pipeline against brute force, stage by stage, and the registered queries."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from queries.check import compare, connect
from tests.llm.documents import frame, odd
from tests.llm.test_repeats import brute_components, brute_removed
from tests.llm.test_tokens import check_pieces
from tidelist.llm.common import scratch

SF_DIR = "/root/testdata/sf0.001"


def test_pipeline(spark, sentences):
    rows = odd(sentences)
    for k, (lang, words) in enumerate({"de": "der die das und", "fr": "le la les et", "en": "the of and to"}.items()):
        for j in range(12):
            body = [w for pair in zip(sentences(50 + 20 * k + j, 40), words.split() * 10) for w in pair]
            rows.append((1000 + 100 * k + j, " ".join(body), lang))
    folder = scratch(spark, "tables")
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns

    kept = corpus_pipeline.language_id(spark, docs, folder)
    assert kept.columns == columns
    named = {r["doc_id"] for r in kept.collect()}
    assert not named & {3, 4, 5, 12}
    assert {i for i, *_ in rows if i is not None and i >= 1000} <= named

    rows = [(r["doc_id"], r["text"], r["lang"]) for r in kept.collect()]
    found = brute_components(rows, 5, 80)
    left = corpus_pipeline.near_duplicates(spark, kept, folder)
    assert left.columns == columns
    own = [r["doc_id"] for r in left.collect() if r["doc_id"] is not None]
    assert sorted(own) == sorted(i for i, (_, c) in found.items() if i is not None and i == c)

    rows = [(r["doc_id"], r["text"], r["lang"]) for r in left.collect()]
    removed = brute_removed(rows, 50)
    cut = corpus_pipeline.repeated_passages(spark, left, folder)
    assert cut.columns == columns
    texts = {}
    for r in cut.collect():
        if r["doc_id"] is not None:
            words, gone = removed[r["doc_id"]]
            assert r["text"].encode().split() == [w for w, g in zip(words, gone) if not g]
            assert r["n_chars"] == len(r["text"])
            texts[r["doc_id"]] = r["text"]
    assert any(any(gone) for _, gone in removed.values())

    pieces = [p for p in corpus_pipeline.run(spark, folder).collect() if p["doc_id"] is not None]
    by = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: np.array(by.encode(t, add_special_tokens=False).ids + [1], "<u4") for i, t in texts.items()}
    seen = {}
    for p in sorted(pieces, key=lambda p: p["start"]):
        assert p["start"] == seen.get(p["doc_id"], 0)
        seen[p["doc_id"]] = p["start"] + p["length"]
        assert bytes(p["ids"]) == ids[p["doc_id"]][p["start"] : seen[p["doc_id"]]].tobytes()
    assert seen == {i: len(x) for i, x in ids.items()}


def test_foreign_text_and_gibberish_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = np.random.default_rng(4)
    foreign = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",
        "Все люди рождаются свободными и равными в своем достоинстве и правах.",
        "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
        "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 300)),
        "TWFuIGlzIGRpc3Rpbmd1aXNoZWQsIG5vdCBvbmx5IGJ5IGhpcyByZWFzb24sIGJ1dCBieSB0aGlz",
        "x" * 1000,
    ]
    clean = ["to of and the", "der die das und von", "le la les et des", "los de para que el"]
    texts = [(10_000_000 + i, t) for i, t in enumerate(foreign + clean)]
    added = spark.createDataFrame(texts, "doc_id long, text string")
    kept = corpus_pipeline.language_id(spark, docs.unionByName(added, allowMissingColumns=True), "")
    left = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert [i for i, _ in texts if i in left] == [10_000_000 + len(foreign) + i for i in range(len(clean))]
    lettered = {r["doc_id"] for r in docs.where(r"regexp_like(text, '\\p{L}')").collect()}
    assert len(lettered - left) <= len(lettered) / 200


def test_pieces_of_the_given_table(spark):
    pieces = corpus_pipeline.packed(spark, spark.read.parquet(f"{SF_DIR}/documents.parquet"), SF_DIR).collect()
    by = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    check_pieces(pieces, {i: np.array(by.encode(t, add_special_tokens=False).ids + [1], "<u4") for i, t in texts.items()})


def test_every_stage_on_an_empty_table(spark):
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, "")
        assert docs.columns == frame(spark, []).columns and docs.count() == 0
    assert corpus_pipeline.packed(spark, docs, "").count() == 0


@pytest.mark.parametrize("name", ["op3_seekable_warc", "op9_bit_sliced_top"])
def test_query_equals_oracle(spark, name):
    assert compare(entry.queries()[name](spark, SF_DIR), connect(SF_DIR), entry.oracle_sql()[name]) == []


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
