"""Vocabulary tagging of texts, and the posting-skill bridge."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelist.functions.text import (
    found_sql,
    re2_pattern,
    required_literals,
    required_words,
    sql_text,
)
from tidelist.operators.normalize import first_per_key, posting_order
from tidelist.schemas import columns_of

# Patterns per array expression: keeps each generated function at a reasonable size.
PATTERNS_PER_ARRAY = 200


def _tags_of_some(text: str, vocabulary: list[tuple[str, str, str]]) -> Column:
    hits = [
        f"CASE WHEN {found_sql(text, pattern)} THEN "
        f"named_struct('skill', {sql_text(skill)}, 'category', {sql_text(category)}) END"
        for skill, category, pattern in vocabulary
    ]
    return F.expr(f"array_compact(array({', '.join(hits)}))")


def tags_of(text: str, vocabulary: list[tuple[str, str, str]]) -> Column:
    """Array of (skill, category) for every pattern found in a text column.

    The patterns are literals: each is compiled once, where a join against a pattern column would
    recompile them for every pair. Most texts fail the literal test before any regex is run. All
    patterns are tried in one projection, however many they are.
    """
    if not vocabulary:
        return F.expr("CAST(array() AS array<struct<skill: string, category: string>>)")
    parts = [
        _tags_of_some(text, vocabulary[i : i + PATTERNS_PER_ARRAY])
        for i in range(0, len(vocabulary), PATTERNS_PER_ARRAY)
    ]
    return F.concat(*parts)


# Rules whose words become a literal of the plan; more are looked up by a join.
LITERAL_RULES = 10_000
_INDEX = (
    "key string, rule bigint, skill string, category string, regex string, "
    "literals array<string>, earlier array<string>"
)


def rule_index(spark: SparkSession, vocabulary: list[tuple[str, str, str]]) -> DataFrame:
    """An inverted index of the vocabulary: one row per rule and word that its matches need.

    ``earlier`` holds the rule's other words before this one, so that a text with several of them
    is tried once. Rules without such a word come under the empty key, which every text has; what
    spares most texts the regex engine there are the literals that a match contains.
    """
    rows = []
    for rule, (skill, category, pattern) in enumerate(vocabulary):
        words, regex = required_words(pattern), re2_pattern(pattern)
        if words is None:
            rows.append(("", rule, skill, category, regex, required_literals(pattern), []))
            continue
        for i, word in enumerate(words):
            rows.append((word, rule, skill, category, regex, None, words[:i]))
    names = [name for name, _ in columns_of(_INDEX)]
    if not rows:
        return spark.createDataFrame([], _INDEX)
    kinds = dict(literals=pa.list_(pa.string()), earlier=pa.list_(pa.string()))
    columns = [pa.array(c, kinds.get(n)) for n, c in zip(names, zip(*rows, strict=True))]
    return spark.createDataFrame(pa.table(dict(zip(names, columns, strict=True))), _INDEX)


def tag_texts(
    texts: DataFrame, text: str, vocabulary: list[tuple[str, str, str]], keys: list[str]
) -> DataFrame:
    """(keys, skill, category): one row per text and pattern found in it, whole texts.

    A text's words are looked up among the words that rules need, and regexes run on these
    candidates only, so the work follows the hits and not the number of rules. Up to LITERAL_RULES
    rules the words are looked up in a literal set where the text is read, and no text is shuffled.
    Beyond that, words are joined with the index without their texts, and texts meet their
    candidates by ``keys``, which must then be unique.
    """
    index = rule_index(texts.sparkSession, vocabulary)
    worded = texts.select(*keys, F.col(text).alias("_text"))
    words = F.concat(F.array(F.lit("")), F.split("_text", "[^A-Za-z0-9_]+"))
    present = F.col("literals").isNull() | F.exists("literals", lambda x: F.contains("_text", x))
    if len(vocabulary) <= LITERAL_RULES:
        needed = {w for _, _, pattern in vocabulary for w in required_words(pattern) or [""]}
        hits = F.array_intersect(words, F.lit(sorted(needed)).cast("array<string>"))
        # An outer explode: of an inner one Spark infers a filter that looks all words up once more.
        met = worded.withColumn("_hits", hits).select("*", F.explode_outer("_hits").alias("key"))
        first = (F.size("earlier") == 0) | ~F.arrays_overlap("earlier", "_hits")
        found = met.join(F.broadcast(index), "key").where(first)
    else:
        narrow = worded.select(*keys, F.explode(F.array_distinct(words)).alias("key"))
        candidates = narrow.join(index.select("key", "rule"), "key").select(*keys, "rule").distinct()
        rules = index.drop("key", "earlier").dropDuplicates(["rule"])
        found = worded.join(candidates.join(rules, "rule"), keys)
    return found.where(present & F.expr("_text RLIKE regex")).select(*keys, "skill", "category")


def search_text() -> Column:
    """What the vocabulary is searched in: lower-cased title and description."""
    return F.lower(
        F.concat(
            F.coalesce("title", F.lit("")),
            F.lit(" "),
            F.coalesce("description_text", F.lit("")),
        )
    )


def skill_bridge(postings: DataFrame, vocabulary: list[tuple[str, str, str]]) -> DataFrame:
    """Skills mentioned in the latest observation of each posting.

    ``postings`` may hold copies within a snapshot; ``posting_order`` chooses. Texts are tagged
    where they are read and stand for themselves by a hash: neither the choice of the latest nor
    the join with the tags carries a text through a shuffle.
    """
    hashed = postings.withColumn("search_text", search_text()).withColumn(
        "text_hash", F.xxhash64("search_text")
    )
    latest = first_per_key(
        hashed.select(
            "posting_key", "snapshot_date", "extracted_at", "title", "posting_url", "text_hash"
        ),
        ["posting_key"],
        [F.col("snapshot_date").desc(), *posting_order(), F.col("text_hash")],
    )
    keys = ["posting_key", "text_hash"]
    tags = tag_texts(hashed, "search_text", vocabulary, keys)
    # Equal texts of a posting have equal tags.
    return latest.select(*keys).join(tags.distinct(), keys).select("posting_key", "skill", "category")


def tagged_observations(
    postings: DataFrame, vocabulary: list[tuple[str, str, str]], keys: list[str]
) -> DataFrame:
    """Every observation with its tags, for tagging at load time.

    Texts are read once where they land and only keys and tags travel on: the latest observation
    is picked later, among small rows.
    """
    return postings.select(*keys, search_text().alias("search_text")).select(
        *keys, tags_of("search_text", vocabulary).alias("tags")
    )


def bridge_of_tagged(tagged: DataFrame, order: list[Column]) -> DataFrame:
    """The bridge from tagged observations: tags of the latest one of each posting."""
    latest = first_per_key(tagged, ["posting_key"], order)
    return latest.select("posting_key", F.inline("tags"))
