"""Declared schemas. Nothing is inferred; writers assert what they write."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULE_TABLES = {
    "skill_vocabulary": "skill string, category string, pattern string",
    "role_family_rules": "priority int, role_family string, pattern string",
    "role_families": "role_family string, display_name string, archetype string",
    "geo_aliases": (
        "alias string, kind string, region string, country string, also_country string"
    ),
    "skill_pattern_cases": "text string, skill string, should_match boolean",
    "title_classification_cases": "title string, role_family string, seniority string",
    "geo_location_cases": "location_raw string, region string, country string",
}

BOARDS = (
    "source string, board string, company string, "
    "overrides_drop_ratio boolean, max_drop_ratio double"
)

# What a landed JSON-lines lake holds (the partition columns come from the directory names).
LINES_PARTITIONS = "source string, board string, snapshot_date date"
LINES = {
    "postings": "company string, extracted_at timestamp, posting_id string, payload string",
    "manifests": (
        "company string, extracted_at timestamp, status string, fetch_mode string, "
        "http_status int, attempts int, posting_count int, reject_count int, url string, "
        "error string, rejected_posting_ids array<string>, content_hash string"
    ),
    "rejects": (
        "extracted_at timestamp, index int, posting_id string, error string, payload string"
    ),
}

# One row per item of a response; a response without items keeps one row with item_index NULL.
ITEMS = (
    "source string, board string, company_key string, snapshot_date date, "
    "http_status int, response_error string, body string, item_index int, "
    "posting_id string, error string, payload string"
)

# One row per landing attempt of a board and day (append-only).
ATTEMPTS = (
    "load bigint, event string, company_key string, source string, board string, "
    "snapshot_date date, company string, extracted_at timestamp, status string, "
    "fetch_mode string, http_status int, attempts int, posting_count bigint, "
    "reject_count bigint, url string, error string, content_hash string, landing_id string, "
    "items_load bigint"
)

POSTINGS = (
    "posting_key string, company_key string, source string, board string, company string, "
    "posting_id string, snapshot_date date, extracted_at timestamp, title string, "
    "department string, location_raw string, workplace_type string, employment_type string, "
    "published_at timestamp, updated_at timestamp, posting_url string, description_text string"
)

DAILY = (
    "posting_key string, company_key string, source string, board string, posting_id string, "
    "snapshot_date date, extracted_at timestamp, title string, department string, "
    "role_family string, seniority string, is_entry_level boolean, employment_type string, "
    "workplace_type string, location_key string, published_at timestamp, landing_id string"
)

SPELL_ATTRIBUTES = [
    "title",
    "role_family",
    "seniority",
    "is_entry_level",
    "employment_type",
    "workplace_type",
    "location_key",
    "published_at",
]


class SchemaDrift(ValueError):
    """A frame does not have the declared columns and types."""


def columns_of(ddl: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a flat DDL string."""
    fields = re.split(r",\s*(?![^<]*>)", ddl)  # not at commas inside a nested type
    pairs = [field.strip().split(" ", 1) for field in fields]
    return [(name, re.sub(r"(?<=[:,])\s+", "", kind.strip())) for name, kind in pairs]


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Select the declared columns in order; refuse a missing column or another type."""
    actual = dict(df.dtypes)
    problems = [
        f"{name}: declared {kind}, found {actual.get(name, 'nothing')}"
        for name, kind in columns_of(ddl)
        if actual.get(name) != kind
    ]
    if problems:
        raise SchemaDrift("; ".join(problems))
    return df.select([F.col(name) for name, _ in columns_of(ddl)])
