"""Data-quality checks. Every check is a frame of failing rows or a count of them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelist import fixed_values as fixed
from tidelist.functions import text as T
from tidelist.operators.geo import resolve_geo
from tidelist.operators.incremental import reconcile
from tidelist.operators.manifests import BOARD_DAY
from tidelist.schemas import DAILY, columns_of

# ---- Row conditions: true for a failing row, so NULL passes ----------------------------------


def is_null(column: str) -> Column:
    return F.col(column).isNull()


def outside(column: str, low, high) -> Column:
    return (F.col(column) < low) | (F.col(column) > high)


def before(column: str, reference: str, strict: bool = False) -> Column:
    """Earlier than the reference; with ``strict``, not later than it."""
    value, limit = F.col(column), F.col(reference)
    return value <= limit if strict else value < limit


def not_accepted(column: str, values: list) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(values)


def failing_rows(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(condition)


def count_failing(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """(check_name, failing_rows) for any number of row conditions, in one pass."""
    counts = df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])
    entries = [
        F.struct(F.lit(name).alias("check_name"), F.col(f"`{name}`").alias("failing_rows"))
        for name in conditions
    ]
    return counts.select(F.inline(F.array(*entries)))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every key combination that occurs more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("occurrences")).where("occurrences > 1")


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-null reference is not in the parent."""
    keys = parent.select(F.col(parent_column).alias(column)).where(F.col(column).isNotNull())
    return df.where(F.col(column).isNotNull()).join(keys.distinct(), column, "left_anti")


# ---- Cross-table rules -----------------------------------------------------------------------


def landed_versus_manifests(lines: DataFrame, manifests: DataFrame) -> DataFrame:
    """Boards and days where the landed lines and the manifest disagree."""
    landed = lines.groupBy(*BOARD_DAY).agg(F.count("*").alias("landed"))
    both = landed.join(
        manifests.select(*BOARD_DAY, "posting_count", "status"), BOARD_DAY, "full"
    )
    unexpected = F.col("landed").isNotNull() & (
        F.coalesce("status", F.lit("missing")) != "ok"
    )
    differs = (F.col("status") == "ok") & (
        F.coalesce("landed", F.lit(0)) != F.col("posting_count")
    )
    return both.where(unexpected | differs)


RECONCILED = [
    name for name, _ in columns_of(DAILY) if name not in ("source", "board", "posting_id")
]


def fact_versus_rebuild(rebuilt: DataFrame, stored: DataFrame) -> DataFrame:
    """Boards and days where the stored snapshot fact differs from a rebuild, row by row."""
    return reconcile(rebuilt.select(RECONCILED), stored.select(RECONCILED), BOARD_DAY)


def closures_off_calendar(spells: DataFrame, manifests: DataFrame) -> DataFrame:
    """Spells closed on a day that was not a successful snapshot of their board."""
    ok = manifests.where(F.col("status") == "ok").select(
        "company_key", F.col("snapshot_date").alias("closed_at")
    )
    closed = spells.where(F.col("closed_at").isNotNull())
    return closed.join(ok, ["company_key", "closed_at"], "left_anti").select(
        "posting_spell_key", "closed_at"
    )


def open_before_latest(spells: DataFrame, manifests: DataFrame) -> DataFrame:
    """Open spells that were not seen on their board's latest successful snapshot."""
    latest = (
        manifests.where(F.col("status") == "ok")
        .groupBy("company_key")
        .agg(F.max("snapshot_date").alias("latest_ok"))
    )
    return (
        spells.where(F.col("is_open"))
        .join(latest, "company_key")
        .where(F.col("last_seen") != F.col("latest_ok"))
        .select("posting_spell_key", "last_seen", "latest_ok")
    )


def overlapping_spells(spells: DataFrame) -> DataFrame:
    """Spells that begin before an earlier spell of the same posting has ended.

    A running maximum of the ends finds them without pairing the spells of a posting.
    """
    earlier = (
        Window.partitionBy("posting_key")
        .orderBy("first_seen", "posting_spell_key")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        spells.withColumn("earlier_last_seen", F.max("last_seen").over(earlier))
        .where(F.col("first_seen") <= F.col("earlier_last_seen"))
        .select("posting_spell_key", "first_seen", "earlier_last_seen")
    )


def flow_versus_spells(flow: DataFrame, spells: DataFrame) -> DataFrame:
    """Measures whose weekly total differs from the lifecycle total (empty when all agree)."""
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).cast("bigint")
    weekly = flow.agg(total("opened"), total("closed"), total("reopened")).toDF("o", "c", "r")
    lifecycle = spells.agg(
        F.count_if(~F.col("is_left_censored")).alias("lo"),
        F.count_if(F.col("closed_at").isNotNull()).alias("lc"),
        F.count_if(F.col("spell_number") > 1).alias("lr"),
    )
    pairs = {"opened": ("o", "lo"), "closed": ("c", "lc"), "reopened": ("r", "lr")}
    entry = lambda frame, i: frame.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("measure"), F.col(p[i]).alias("total"))
                    for name, p in pairs.items()
                ]
            )
        )
    )
    return (
        entry(weekly, 0)
        .withColumnRenamed("total", "weekly_total")
        .join(entry(lifecycle, 1).withColumnRenamed("total", "lifecycle_total"), "measure")
        .where("weekly_total <> lifecycle_total")
    )


# ---- Executable examples of the rule tables --------------------------------------------------


def skill_example_failures(cases: DataFrame, vocabulary: list[tuple]) -> DataFrame:
    """Examples whose text is tagged otherwise than stated."""
    branches = [
        f"WHEN skill = {T.sql_text(skill)} THEN {T.found_sql('_lower', pattern)}"
        for skill, _, pattern in vocabulary
    ]
    lowered = cases.withColumn("_lower", F.lower("text"))
    matched = lowered.withColumn("matched", F.expr(f"CASE {' '.join(branches)} END"))
    return matched.drop("_lower").where(
        F.col("matched") != F.col("should_match")
    )


def title_example_failures(cases: DataFrame, role_rules: list[tuple]) -> DataFrame:
    """Examples whose title is classified otherwise than stated."""
    actual = cases.withColumns(
        {
            "actual_role_family": T.role_family(F.col("title"), role_rules),
            "actual_seniority": T.seniority(F.col("title"), F.lit("unknown")),
        }
    )
    return actual.where(
        (F.col("actual_role_family") != F.col("role_family"))
        | (F.col("actual_seniority") != F.col("seniority"))
    )


def location_example_failures(cases: DataFrame, aliases: DataFrame) -> DataFrame:
    """Examples whose location is resolved otherwise than stated (no match is ``Unknown``)."""
    keyed = cases.select(F.col("location_raw").alias("location_key"), "location_raw")
    actual = resolve_geo(keyed, aliases).select(
        "location_raw",
        F.col("region").alias("actual_region"),
        F.coalesce("country", F.lit("Unknown")).alias("actual_country"),
    )
    return cases.join(actual, "location_raw", "left").where(
        ~F.col("actual_region").eqNullSafe(F.col("region"))
        | ~F.col("actual_country").eqNullSafe(F.col("country"))
    )


# ---- The standard suite ----------------------------------------------------------------------


@dataclass(frozen=True)
class Tables:
    """Frames the standard suite looks at."""

    lines: DataFrame
    manifests: DataFrame
    unparsed: DataFrame
    postings: DataFrame
    classified: DataFrame
    rebuilt_daily: DataFrame
    daily: DataFrame
    spells: DataFrame
    dim_company: DataFrame
    dim_location: DataFrame
    dim_role_family: DataFrame
    bridge: DataFrame
    weekly_flow: DataFrame
    time_to_close: DataFrame
    skill_demand: DataFrame
    remote_share: DataFrame
    entry_level_share: DataFrame
    vocabulary: DataFrame


def _row_checks(bounds: dict[str, tuple[int, int]]) -> dict[str, dict[str, Column]]:
    between = lambda c: outside(c, *bounds[c])
    share = lambda c: outside(c, 0, 1)
    return {
        "lines": {
            "posting_key_not_null": is_null("posting_key"),
            "source_accepted": not_accepted("source", fixed.SOURCES),
            "snapshot_date_not_null": is_null("snapshot_date"),
        },
        "manifests": {
            "status_not_null": is_null("status"),
            "status_accepted": not_accepted("status", fixed.STATUSES),
            "fetch_mode_accepted": not_accepted("fetch_mode", fixed.FETCH_MODES),
            "posting_count_not_null": is_null("posting_count"),
        },
        "unparsed": {"posting_key_not_null": is_null("posting_key")},
        "postings": {
            "posting_key_not_null": is_null("posting_key"),
            "title_not_null": is_null("title"),
            "posting_url_not_null": is_null("posting_url"),
            "workplace_type_accepted": not_accepted("workplace_type", fixed.WORKPLACE_TYPES),
            "employment_type_accepted": not_accepted("employment_type", fixed.EMPLOYMENT_TYPES),
        },
        "classified": {
            "role_family_not_null": is_null("role_family"),
            "seniority_accepted": not_accepted("seniority", fixed.SENIORITIES),
        },
        "daily": {
            "posting_key_not_null": is_null("posting_key"),
            "landing_id_not_null": is_null("landing_id"),
            "company_key_not_null": is_null("company_key"),
        },
        "spells": {
            "posting_spell_key_not_null": is_null("posting_spell_key"),
            "posting_key_not_null": is_null("posting_key"),
            "first_seen_not_null": is_null("first_seen"),
            "last_seen_not_null": is_null("last_seen"),
            "last_seen_not_before_first_seen": before("last_seen", "first_seen"),
            "closed_at_after_last_seen": before("closed_at", "last_seen", strict=True),
            "unparsed_snapshots_not_null": is_null("unparsed_snapshots"),
            "unparsed_snapshots_between": between("unparsed_snapshots"),
            "spell_number_not_null": is_null("spell_number"),
            "spell_number_between": between("spell_number"),
            "days_to_close_between": between("days_to_close"),
            "workplace_type_accepted": not_accepted("workplace_type", fixed.WORKPLACE_TYPES),
            "seniority_accepted": not_accepted("seniority", fixed.SENIORITIES),
        },
        "dim_company": {
            "company_key_not_null": is_null("company_key"),
            "source_accepted": not_accepted("source", fixed.SOURCES),
        },
        "dim_location": {
            "location_key_not_null": is_null("location_key"),
            "country_not_null": is_null("country"),
        },
        "dim_role_family": {"role_family_not_null": is_null("role_family")},
        "weekly_flow": {
            "week_start_not_null": is_null("week_start"),
            "opened_between": between("opened"),
            "closed_between": between("closed"),
        },
        "time_to_close": {"role_family_not_null": is_null("role_family")},
        "skill_demand": {
            "share_of_postings_not_null": is_null("share_of_postings"),
            "share_of_postings_between": share("share_of_postings"),
            "share_of_open_between": share("share_of_open"),
        },
        "remote_share": {
            "week_start_not_null": is_null("week_start"),
            "remote_share_between": share("remote_share"),
        },
        "entry_level_share": {"entry_level_share_between": share("entry_level_share")},
    }


UNIQUE_KEYS = {
    "manifests": ["company_key", "snapshot_date"],
    "unparsed": ["posting_key", "snapshot_date"],
    "classified": ["posting_key", "snapshot_date"],
    "daily": ["posting_key", "snapshot_date"],
    "spells": ["posting_spell_key"],
    "dim_company": ["company_key"],
    "dim_location": ["location_key"],
    "dim_role_family": ["role_family"],
    "bridge": ["posting_key", "skill"],
    "weekly_flow": ["week_start"],
    "time_to_close": ["role_family"],
    "skill_demand": ["role_family", "skill"],
    "remote_share": ["week_start"],
    "entry_level_share": ["week_start", "role_family"],
}

REFERENCES = [
    ("classified", "role_family", "dim_role_family", "role_family"),
    ("daily", "company_key", "dim_company", "company_key"),
    ("daily", "location_key", "dim_location", "location_key"),
    ("daily", "role_family", "dim_role_family", "role_family"),
    ("spells", "role_family", "dim_role_family", "role_family"),
    ("bridge", "posting_key", "spells", "posting_key"),
    ("bridge", "skill", "vocabulary", "skill"),
]


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias("failing_rows")).select(
        F.lit(name).alias("check_name"), "failing_rows"
    )


def standard_suite(
    t: Tables,
    bounds: dict[str, tuple[int, int]] | None = None,
    more: list[DataFrame] | None = None,
) -> DataFrame:
    """(check_name, failing_rows, passed) for all standard checks, as one lazy frame.

    ``bounds`` replaces entries of ``fixed_values.CHECK_BOUNDS``, for data of another size;
    ``more`` adds counts of the same form.
    """
    parts = list(more or [])
    for table, conditions in _row_checks({**fixed.CHECK_BOUNDS, **(bounds or {})}).items():
        named = {f"{table}_{name}": condition for name, condition in conditions.items()}
        parts.append(count_failing(getattr(t, table), named))
    for table, keys in UNIQUE_KEYS.items():
        name = f"{table}_unique_{'_and_'.join(keys)}"
        parts.append(_count(duplicate_keys(getattr(t, table), keys), name))
    for table, column, parent, parent_column in REFERENCES:
        name = f"{table}_{column}_in_{parent}"
        rows = orphans(getattr(t, table), column, getattr(t, parent), parent_column)
        parts.append(_count(rows, name))
    parts += [
        _count(landed_versus_manifests(t.lines, t.manifests), "lines_match_manifests"),
        _count(fact_versus_rebuild(t.rebuilt_daily, t.daily), "daily_matches_rebuild"),
        _count(closures_off_calendar(t.spells, t.manifests), "closures_on_ok_snapshots"),
        _count(open_before_latest(t.spells, t.manifests), "open_spells_on_latest_snapshot"),
        _count(overlapping_spells(t.spells), "spells_do_not_overlap"),
        _count(flow_versus_spells(t.weekly_flow, t.spells), "weekly_flow_matches_spells"),
    ]
    return with_outcome(reduce(DataFrame.unionByName, parts))


def rule_checks(
    vocabulary: DataFrame, role_rules: DataFrame, role_families: DataFrame, aliases: DataFrame
) -> list[DataFrame]:
    """Counts of defects of the rule tables: an alias given twice would multiply locations."""
    tables = {
        "skill_vocabulary": (vocabulary, ["skill"]),
        "role_family_rules": (role_rules, ["priority"]),
        "role_families": (role_families, ["role_family"]),
        "geo_aliases": (aliases, ["alias"]),
    }
    parts = [
        _count(duplicate_keys(rows, keys), f"{name}_unique_{keys[0]}")
        for name, (rows, keys) in tables.items()
    ]
    blank = {"pattern_not_null": is_null("pattern"), "category_not_null": is_null("category")}
    named = {f"skill_vocabulary_{name}": condition for name, condition in blank.items()}
    return [
        *parts,
        count_failing(vocabulary, named),
        count_failing(
            aliases, {"geo_aliases_kind_accepted": not_accepted("kind", fixed.ALIAS_KINDS)}
        ),
        _count(
            orphans(role_rules, "role_family", role_families, "role_family"),
            "role_family_rules_role_family_in_role_families",
        ),
    ]


def example_checks(
    examples: dict[str, DataFrame], vocabulary: list[tuple], role_rules: list[tuple], aliases: DataFrame
) -> list[DataFrame]:
    """Counts of examples that the rules answer otherwise than stated.

    ``examples`` may hold ``skills``, ``titles`` and ``locations``, tables of the declared cases.
    """
    run = {
        "skills": lambda cases: skill_example_failures(cases, vocabulary),
        "titles": lambda cases: title_example_failures(cases, role_rules),
        "locations": lambda cases: location_example_failures(cases, aliases),
    }
    return [_count(run[name](cases), f"examples_of_{name}") for name, cases in examples.items()]


def with_outcome(counts: DataFrame) -> DataFrame:
    return counts.select(
        "check_name",
        F.col("failing_rows").cast("bigint").alias("failing_rows"),
        (F.col("failing_rows") == 0).alias("passed"),
    )


def outcome_summary(checks: DataFrame) -> DataFrame:
    """One row: how many checks passed and failed, and which failed."""
    return checks.agg(
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.array_join(
            F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("check_name")))), ", "
        ).alias("failing_checks"),
    )
