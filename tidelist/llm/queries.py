"""The queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelist.llm import (
    bpe,
    bsi,
    idfile,
    langid,
    minhash,
    mixing,
    packing,
    permindex,
    spelling,
    substring,
    urlfilter,
    vafile,
    warc,
)
from tidelist.llm.common import prepare, scratch
from tidelist.session import configure


def _centroid_sql(k: int, rounds: int) -> str:
    """Rounds of clustering, each a few CTEs over one row per vector and component."""
    steps = [
        """v AS MATERIALIZED (
            SELECT vec_id, unnest(range(64)) AS i, unnest(list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT)) AS x
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
        )""",
        f"""seed AS (
            SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c
            FROM (SELECT DISTINCT vec_id FROM v) QUALIFY c < {k}
        )""",
        "c0 AS MATERIALIZED (SELECT c, i, x FROM seed JOIN v USING (vec_id))",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} AS MATERIALIZED (
            SELECT vec_id, arg_min(c, (distance, c)) AS c, min(distance) AS distance
            FROM (
                SELECT vec_id, c, sum((v.x - c{r}.x) * (v.x - c{r}.x))::BIGINT AS distance
                FROM v JOIN c{r} USING (i) GROUP BY vec_id, c
            ) GROUP BY vec_id
        )"""
        )
        if r < rounds:
            steps.append(
                f"""c{r + 1} AS MATERIALIZED (
            SELECT c{r}.c, c{r}.i, coalesce(m.x, c{r}.x) AS x
            FROM c{r} LEFT JOIN (
                SELECT c, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS x
                FROM (SELECT c, i, sum(x) AS s, count(*) AS n FROM a{r} JOIN v USING (vec_id) GROUP BY c, i)
            ) m USING (c, i)
        )"""
            )
    return f"""
        WITH {", ".join(steps)},
        digest AS (
            SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c
        )
        SELECT vec_id, c::INTEGER AS cluster, distance,
            (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
            (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
        FROM a{rounds} JOIN digest USING (c)
    """


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op3_seekable_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
        d AS (
            SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest,
                CASE WHEN strlen(payload) >= 1000
                    THEN max(page_id) OVER (PARTITION BY sha1(payload)) ELSE page_id END AS latest
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> latest THEN latest END AS refers_to
        FROM d
    """,
    "op9_bit_sliced_top": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
            FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        ),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
        ),
        r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
            FROM s
        )
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op11_centroids": _centroid_sql(8, 10),
    "op13_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                ('0x' || substr(md5('13:' || doc_id), 1, 15))::BIGINT AS key
            FROM documents
        ),
        own AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
            FROM d GROUP BY source
        ),
        -- Sources by how soon they reach their cap; the rate if all before one are capped.
        filled AS (
            SELECT *, (SELECT sum(source_size) FROM own)
                    - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
                sum(weight) OVER (ORDER BY 3 * source_size / weight, source
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
            FROM own
        ),
        rate AS (
            SELECT rest::BIGINT AS rest, weights::BIGINT AS weights FROM filled
            WHERE rest * weight <= 3 * source_size * weights
            ORDER BY 3 * source_size / weight, source LIMIT 1
        ),
        t AS (
            SELECT source, source_size,
                CASE WHEN rest * weight > 3 * source_size * weights THEN (3 * source_size)::DOUBLE
                    ELSE (rest * weight)::DOUBLE / weights END AS target,
                CASE WHEN rest * weight > 3 * source_size * weights THEN 3 * source_size
                    ELSE (rest * weight) // weights END AS budget
            FROM own, rate
        ),
        placed AS (
            SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
            FROM d
        ),
        taken AS (
            SELECT doc_id, p.source, size, source_size, target, start,
                CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs, budget
            FROM placed p JOIN t ON p.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, source, size, source_size, target, start::BIGINT AS start,
            (epochs + CASE WHEN budget - epochs * source_size - start >= size THEN 1 ELSE 0 END)::BIGINT AS epochs,
            (epochs * size + greatest(least(budget - epochs * source_size - start, size), 0))::BIGINT AS taken
        FROM taken
    """,
}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(build: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(prepare(configure(spark)), sf_dir)

    QUERIES[build.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.Repeats(table(spark, sf_dir, "documents")).counts()


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), WORD_BPE, 1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op3_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.write(table(spark, sf_dir, "pages"), scratch(spark, "warc")))


@query
def op4_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permindex.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.round_trip_digests(docs, BYTE_BPE, public_tokenizers.PATTERN)


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return idfile.read(spark, idfile.write(docs, WORD_BPE, 2, scratch(spark, "idfiles")))


@query
def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=4)


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents")).drop("text")


@query
def op9_bit_sliced_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bsi.largest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES).drop("url")


@query
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    return vafile.with_inertia(vafile.cluster(table(spark, sf_dir, "embeddings"), order))


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.forms(spelling.words(table(spark, sf_dir, "documents")).where("n >= 2"))


@query
def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), [1, 2, 3]).documents
