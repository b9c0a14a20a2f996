"""The corpus pipeline: language ID, near-duplicates, repeated passages, packing.

Every stage works on the documents that its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelist.llm import langid, minhash, packing, substring
from tidelist.llm.common import fresh, prepare, written
from tidelist.session import configure

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
LEAST_SCORE = 0.5  # posterior of the language below which a document is rejected

#: The stages go beyond SQL: tests hold run() against a brute-force version.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is recognised.

    Rejected are texts that are null or hold no letter, texts that no language explains at least
    as well as all others together, and texts that cost more bits per byte under their language
    than a limit: foreign text and gibberish. Fitted on these documents themselves, but for those
    held out, which set the limit. If no document is labelled, none is rejected for its language.
    """
    prepare(configure(spark))
    model = langid.train(docs.where(~langid.held_out() & F.col("doc_id").isNotNull()))
    if model is None:
        return docs.where(F.regexp_like("text", F.lit(r"\p{L}")))
    lang, score = fresh("lang_pred", docs.columns), fresh("score", docs.columns)
    limit = langid.cost_limit(docs.where(langid.held_out()), model)
    cost = fresh("cost", docs.columns)
    judged = langid.predicted(docs, model, lang, score, cost)
    good = (F.col(lang) != langid.UNKNOWN) & (F.col(score) >= LEAST_SCORE) & (F.col(cost) <= limit)
    return judged.where(good).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each group of near copies.

    Of rows that share a doc_id one stays, as they are copies too; documents without an id stay.
    """
    prepare(configure(spark))
    found = minhash.near_duplicates(docs.select("doc_id", "text"))
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    named = F.col("doc_id").isNotNull()
    return left.where(named).dropDuplicates(["doc_id"]).unionByName(left.where(~named))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 50 words or more that a smaller doc_id has too; n_chars follows the text.

    Every document stays, though nothing may be left of its text.
    """
    prepare(configure(spark))
    counted = fresh("n_removed", docs.columns)
    cut = substring.deduplicated(docs, counted=counted)
    length = F.when(F.col(counted) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", length).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): windows of 2048 ids."""
    prepare(configure(spark))
    return packing.pack(docs, VOCABULARY, END_ID)


STAGES = [
    ("language ID", language_id),
    ("near-duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
