"""Rule tables: small typed CSV tables that drive classification."""

from __future__ import annotations

import csv
import io
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidelist import fixed_values as fixed
from tidelist.schemas import RULE_TABLES, columns_of

# A rule table becomes part of the query plan, so its size is checked before it is read.
MAX_RULES = 100_000


def read_rule_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Typed scan of an edited rule table on shared storage; an empty cell is NULL."""
    return spark.read.csv(path, schema=RULE_TABLES[name], header=True, mode="FAILFAST")


def rule_rows(table: DataFrame) -> list[tuple]:
    """The rows of a rule table, for building literal expressions."""
    rows = table.limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"a rule table may hold at most {MAX_RULES} rows")
    return [tuple(row) for row in rows]


def _text_rows(name: str, text: str) -> list[tuple]:
    kinds = [kind for _, kind in columns_of(RULE_TABLES[name])]
    parsed = list(csv.reader(io.StringIO(text.strip())))[1:]
    cast = {"int": int, "string": str}
    return [
        tuple(None if cell == "" else cast[kind](cell) for cell, kind in zip(row, kinds))
        for row in parsed
    ]


@dataclass(frozen=True)
class Rules:
    """The rule tables in use. The defaults are the fixed values shipped with the package."""

    skill_vocabulary: list[tuple] = field(
        default_factory=lambda: _text_rows("skill_vocabulary", fixed.SKILL_VOCABULARY)
    )
    role_family_rules: list[tuple] = field(
        default_factory=lambda: _text_rows("role_family_rules", fixed.ROLE_FAMILY_RULES)
    )
    role_families: list[tuple] = field(
        default_factory=lambda: _text_rows("role_families", fixed.ROLE_FAMILIES)
    )
    geo_aliases: list[tuple] = field(
        default_factory=lambda: _text_rows("geo_aliases", fixed.GEO_ALIASES)
    )

    @classmethod
    def from_csv(cls, spark: SparkSession, folder: str) -> Rules:
        """Rule tables edited by an analyst: ``<folder>/<table>.csv`` for all four tables."""
        names = cls.__dataclass_fields__
        return cls(
            **{
                name: rule_rows(read_rule_table(spark, f"{folder}/{name}.csv", name))
                for name in names
            }
        )

    def frame(self, spark: SparkSession, name: str) -> DataFrame:
        """A rule table as a DataFrame.

        Handed over as an Arrow table it becomes a local relation: its size is part of the plan,
        so Spark decides by size whether to broadcast it.
        """
        names = [column for column, _ in columns_of(RULE_TABLES[name])]
        if not getattr(self, name):
            return spark.createDataFrame([], RULE_TABLES[name])
        columns = zip(*getattr(self, name), strict=True)
        return spark.createDataFrame(
            pa.table(dict(zip(names, map(list, columns), strict=True))), RULE_TABLES[name]
        )
