"""Scan of raw responses: ``<root>/<snapshot date>/<source>/<board>.json`` or ``.status``."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PATH = r"/(\d{4}-\d{2}-\d{2})/([^/]+)/([^/]+)\.(json|status)$"


def read_responses(spark: SparkSession, root: str) -> DataFrame:
    """(source, board, snapshot_date, http_status, body), one row per file.

    A ``.status`` file stands for a failed request and wins over a body of the same board and
    day. Every response is one JSON document, hence one row.
    """
    files = spark.read.text(
        root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.{json,status}"
    ).select("value", F.col("_metadata.file_path").alias("path"))
    return responses_from_files(files)


def responses_from_files(files: DataFrame) -> DataFrame:
    """The same for a frame of (path, value), batch or streaming."""
    part = lambda i: F.regexp_extract("path", _PATH, i)
    parsed = files.where(F.col("path").rlike(_PATH)).select(
        F.url_decode(part(2)).alias("source"),
        F.url_decode(part(3)).alias("board"),
        part(1).cast("date").alias("snapshot_date"),
        (part(4) == "status").alias("is_status"),
        "value",
    )
    return parsed.select(
        "source",
        "board",
        "snapshot_date",
        F.when(F.col("is_status"), F.trim(F.regexp_replace("value", r"\s", "")).try_cast("int"))
        .otherwise(F.lit(200))
        .alias("http_status"),
        F.when(~F.col("is_status"), F.col("value")).alias("body"),
    )


def one_per_board_day(responses: DataFrame) -> DataFrame:
    """Where both a status and a body exist for a board and day, the status counts."""
    keys = ["source", "board", "snapshot_date"]
    picked = responses.groupBy(keys).agg(
        F.min_by(
            F.struct("http_status", "body"), F.struct(F.col("body").isNotNull(), "http_status")
        ).alias("r")
    )
    return picked.select(*keys, "r.http_status", "r.body")


class UnknownSnapshot(ValueError):
    """A requested snapshot date has no responses."""


def restrict_to_dates(responses: DataFrame, dates: list[date]) -> DataFrame:
    """Only the requested snapshot dates; asking for a date that is not there is an error."""
    wanted = responses.where(F.col("snapshot_date").isin(dates))
    present = {r[0] for r in wanted.select("snapshot_date").distinct().collect()}
    missing = sorted(str(d) for d in set(dates) - present)
    if missing:
        raise UnknownSnapshot(f"no responses for {missing}")
    return wanted


def requested_board_days(boards: DataFrame, dates: list[date]) -> DataFrame:
    """Every board on every requested date: what a landing is expected to account for."""
    days = F.array(*[F.lit(d) for d in sorted(dates)])
    return boards.withColumn("snapshot_date", F.explode(days))


def with_missing_boards(responses: DataFrame, expected: DataFrame) -> DataFrame:
    """Add a 404 for every expected board and day without a response; bodies are not shuffled."""
    keys = ["source", "board", "snapshot_date"]
    missing = expected.select(*keys).join(responses.select(*keys), keys, "left_anti")
    return responses.unionByName(
        missing.select(
            *keys, F.lit(404).alias("http_status"), F.lit(None).cast("string").alias("body")
        ),
        allowMissingColumns=True,
    )

