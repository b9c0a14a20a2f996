"""Scan of a landed JSON-lines lake: ``<root>/<kind>/source=/board=/snapshot_date=/*.jsonl``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelist.operators.manifests import landing_id
from tidelist.schemas import LINES, LINES_PARTITIONS


def _read(spark: SparkSession, root: str, kind: str) -> DataFrame:
    schema = f"{LINES[kind]}, {LINES_PARTITIONS}"
    return (
        spark.read.schema(schema)
        .option("basePath", f"{root}/{kind}")
        .option("pathGlobFilter", "*.jsonl")
        .json(f"{root}/{kind}")
        .withColumn("company_key", F.concat("source", F.lit(":"), "board"))
    )


def read_postings(spark: SparkSession, root: str) -> DataFrame:
    """Landed posting lines, duplicates within a response included; payload as JSON text."""
    return _read(spark, root, "postings").withColumn(
        "posting_key", F.concat("company_key", F.lit(":"), "posting_id")
    )


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """One row per board and day, with the landing it describes."""
    return (
        _read(spark, root, "manifests")
        .withColumn(
            "rejected_posting_ids",
            F.coalesce("rejected_posting_ids", F.array().cast("array<string>")),
        )
        .withColumn("landing_id", landing_id(F.col("extracted_at"), F.col("content_hash")))
    )


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Quarantined records with the errors that kept them out."""
    return (
        _read(spark, root, "rejects")
        .where(F.col("error").isNotNull())
        .withColumnRenamed("index", "item_index")
    )
