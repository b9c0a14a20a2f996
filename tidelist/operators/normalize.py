"""Provider payloads to one posting schema, deduplicated and classified."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelist import fixed_values as fixed
from tidelist.functions import text as T
from tidelist.functions.dates import millis_timestamp, utc_timestamp
from tidelist.functions.payload import joined_field, parse

POSTING_KEYS = [
    "posting_key",
    "company_key",
    "source",
    "board",
    "company",
    "posting_id",
    "snapshot_date",
    "extracted_at",
]

_SHAPES = {
    "greenhouse": (
        "title string, location struct<name: string>, departments array<struct<name: string>>, "
        "first_published string, updated_at string, absolute_url string, content string"
    ),
    "lever": (
        "text string, categories struct<location: string, commitment: string, team: string, "
        "department: string>, workplaceType string, createdAt string, hostedUrl string, "
        "descriptionPlain string, additionalPlain string, lists array<struct<content: string>>"
    ),
    "ashby": (
        "title string, location string, department string, workplaceType string, "
        "employmentType string, isRemote string, isListed string, publishedAt string, "
        "jobUrl string, descriptionPlain string, descriptionHtml string"
    ),
}


def _passthrough(lines: DataFrame) -> list[str]:
    extra = [c for c in ("landing_id", "item_index") if c in lines.columns]
    return [*POSTING_KEYS, *extra]


def _parsed(lines: DataFrame, source: str) -> DataFrame:
    """Lines of one source with the payload parsed once into ``p``."""
    return lines.where(F.col("source") == source).select(
        *_passthrough(lines), parse(F.col("payload"), _SHAPES[source]).alias("p")
    )


def _select(parsed: DataFrame, **columns: Column) -> DataFrame:
    none = F.lit(None)
    order = {
        "title": none.cast("string"),
        "department": none.cast("string"),
        "location_raw": none.cast("string"),
        "workplace_type": none.cast("string"),
        "employment_type": none.cast("string"),
        "published_at": none.cast("timestamp"),
        "updated_at": none.cast("timestamp"),
        "posting_url": none.cast("string"),
        "description_text": none.cast("string"),
    }
    order.update(columns)
    return parsed.select(*_passthrough(parsed), *[c.alias(name) for name, c in order.items()])


def greenhouse_postings(lines: DataFrame) -> DataFrame:
    """No workplace or employment fields: both are inferred from location and title."""
    parsed = _parsed(lines, "greenhouse")
    title = T.blank_to_null(F.col("p.title"))
    location = T.blank_to_null(F.col("p.location.name"))
    return _select(
        parsed,
        title=title,
        department=F.get("p.departments", 0)["name"],
        location_raw=location,
        workplace_type=T.workplace_from_location(location),
        employment_type=T.employment_type(F.lit(None).cast("string"), title),
        published_at=utc_timestamp(F.col("p.first_published")),
        updated_at=utc_timestamp(F.col("p.updated_at")),
        posting_url=F.col("p.absolute_url"),
        description_text=T.html_to_text(F.col("p.content")),
    )


def lever_postings(lines: DataFrame) -> DataFrame:
    """The description comes in three parts; creation time is in epoch milliseconds."""
    parsed = _parsed(lines, "lever")
    title = T.blank_to_null(F.col("p.text"))
    location = T.blank_to_null(F.col("p.categories.location"))
    description = F.concat_ws(
        " ",
        F.col("p.descriptionPlain"),
        joined_field(F.col("p.lists"), "content"),
        F.col("p.additionalPlain"),
    )
    return _select(
        parsed,
        title=title,
        department=F.coalesce("p.categories.department", "p.categories.team"),
        location_raw=location,
        workplace_type=T.workplace_from_label(
            F.col("p.workplaceType"), fixed.LEVER_WORKPLACE, location
        ),
        employment_type=T.employment_type(F.col("p.categories.commitment"), title),
        published_at=millis_timestamp(F.trim("p.createdAt").try_cast("decimal(38,6)").try_cast("bigint")),
        posting_url=F.col("p.hostedUrl"),
        description_text=T.html_to_text(description),
    )


def ashby_postings(lines: DataFrame) -> DataFrame:
    """Unlisted records are dropped; a remote flag outranks the workplace label."""
    parsed = _parsed(lines, "ashby").where(
        F.coalesce(F.col("p.isListed").try_cast("boolean"), F.lit(True))
    )
    title = T.blank_to_null(F.col("p.title"))
    location = T.blank_to_null(F.col("p.location"))
    by_label = T.workplace_from_label(
        F.col("p.workplaceType"), fixed.ASHBY_WORKPLACE, location
    )
    return _select(
        parsed,
        title=title,
        department=F.col("p.department"),
        location_raw=location,
        workplace_type=F.when(
            F.col("p.isRemote").try_cast("boolean"), F.lit("remote")
        ).otherwise(by_label),
        employment_type=T.employment_type(F.col("p.employmentType"), title),
        published_at=utc_timestamp(F.col("p.publishedAt")),
        posting_url=F.col("p.jobUrl"),
        description_text=F.coalesce(
            T.blank_to_null(F.col("p.descriptionPlain")),
            T.html_to_text(F.col("p.descriptionHtml")),
        ),
    )


def union_sources(*postings: DataFrame) -> DataFrame:
    """One frame of all sources, matched by column name."""
    unioned = postings[0]
    for frame in postings[1:]:
        unioned = unioned.unionByName(frame)
    return unioned


def first_per_key(df: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark limits each key to one row before the shuffle as well (window group limit), so many
    copies of one key never meet in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def posting_order() -> list[Column]:
    """Which copy of a posting wins within a snapshot."""
    return [
        F.col("extracted_at").desc(),
        F.col("title").asc_nulls_last(),
        F.col("posting_url").asc_nulls_last(),
    ]


def one_per_snapshot(postings: DataFrame) -> DataFrame:
    """One row per posting and snapshot; a provider may repeat a record in one response."""
    return first_per_key(postings, ["posting_key", "snapshot_date"], posting_order())


def classify(postings: DataFrame, role_rules: Iterable[tuple[int, str, str]]) -> DataFrame:
    """Add role family, seniority, location key and the entry-level flag: projections only."""
    classified = postings.withColumns(
        {
            "role_family": T.role_family(F.col("title"), role_rules),
            "seniority": T.seniority(F.col("title"), F.col("employment_type")),
            "location_key": T.location_key(F.col("location_raw")),
        }
    )
    return classified.withColumn("is_entry_level", F.col("seniority").isin(fixed.ENTRY_LEVELS))


def normalize(lines: DataFrame) -> DataFrame:
    """Posting lines of all sources in the common schema, duplicates included."""
    return union_sources(
        greenhouse_postings(lines), lever_postings(lines), ashby_postings(lines)
    )
