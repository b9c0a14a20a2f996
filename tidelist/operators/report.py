"""Result sets of the report: small frames read from the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelist import fixed_values as fixed

TOP_SKILLS = 15
TOP_RANK_PER_FAMILY = 3


def headline(manifests: DataFrame, spells: DataFrame) -> DataFrame:
    """One row of totals: what was observed, and what it adds up to."""
    ok = F.col("status") == "ok"
    observed = manifests.agg(
        F.nullif(
            F.array_join(F.array_sort(F.collect_set("fetch_mode")), ", "), F.lit("")
        ).alias("fetch_modes"),
        F.min("snapshot_date").alias("first_snapshot"),
        F.max("snapshot_date").alias("last_snapshot"),
        F.count_distinct("company_key").alias("boards"),
        F.count_if(ok).alias("ok_snapshots"),
        F.count_if(~ok).alias("failed_snapshots"),
        F.coalesce(F.sum("reject_count"), F.lit(0)).cast("bigint").alias("rejected_records"),
    )
    # Distinct postings, spells and open spells from one row per posting.
    listed = (
        spells.groupBy("posting_key")
        .agg(F.count("*").alias("n"), F.count_if("is_open").alias("n_open"))
        .agg(
            F.count("*").alias("distinct_postings"),
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("spells"),
            F.coalesce(F.sum("n_open"), F.lit(0)).cast("bigint").alias("open_postings"),
        )
    )
    one = F.lit(1).alias("_one")
    return observed.select("*", one).join(listed.select("*", one), "_one").drop("_one")


def mode_banner(headlines: DataFrame) -> DataFrame:
    """What kind of data the totals are from: ``fixture`` alone, ``mixed`` modes, else NULL."""
    return headlines.select(
        "fetch_modes",
        F.when(F.col("fetch_modes") == "fixture", F.lit("fixture"))
        .when(F.contains("fetch_modes", F.lit(",")), F.lit("mixed"))
        .alias("mode"),
    )


def extraction_health(dim_company: DataFrame) -> DataFrame:
    return dim_company.select(
        "company_name",
        "source",
        "board",
        "ok_snapshots",
        "failed_snapshots",
        "rejected_records",
        "postings_seen",
    ).orderBy("company_name", "source", "board")


def weekly_flow_table(flow: DataFrame) -> DataFrame:
    return flow.select(
        "week_start",
        "boards_observed",
        "listed_postings",
        "opened",
        "reopened",
        "closed",
        "net_change",
    ).orderBy("week_start")


def time_to_close_table(times: DataFrame) -> DataFrame:
    """The total first, then the roles with most closed spells."""
    return times.orderBy(
        (F.col("role_family") == fixed.ALL_ROLES).desc(),
        F.col("closed_spells").desc(),
        "role_family",
    ).select(
        "role_family",
        "closed_spells",
        "still_open_spells",
        "median_days_to_close",
        "mean_days_to_close",
        "p75_days_to_close",
    )


def top_skills(demand: DataFrame, n: int = TOP_SKILLS) -> DataFrame:
    """The most mentioned skills over all roles."""
    return (
        demand.where(F.col("role_family") == fixed.ALL_ROLES)
        .orderBy(F.col("postings_with_skill").desc(), "skill")
        .limit(n)
        .select(
            "skill",
            "category",
            "postings_with_skill",
            "share_of_postings",
            "open_with_skill",
            "share_of_open",
        )
    )


def top_skills_per_family(demand: DataFrame, rank: int = TOP_RANK_PER_FAMILY) -> DataFrame:
    """The top ranks of each role, ties included."""
    return (
        demand.where(
            (F.col("role_family") != fixed.ALL_ROLES) & (F.col("rank_in_family") <= rank)
        )
        .select(
            "role_family", "rank_in_family", "skill", "postings_with_skill", "share_of_postings"
        )
        .orderBy("role_family", "rank_in_family", "skill")
    )


def remote_share_table(shares: DataFrame) -> DataFrame:
    return shares.select(
        "week_start",
        "listed_postings",
        "remote_postings",
        "hybrid_postings",
        "onsite_postings",
        "remote_share",
        "hybrid_share",
    ).orderBy("week_start")


def entry_level_table(shares: DataFrame) -> DataFrame:
    return (
        shares.where(F.col("role_family") == fixed.ALL_ROLES)
        .select(
            "week_start",
            "listed_postings",
            "intern_postings",
            "entry_level_postings",
            "entry_level_share",
        )
        .orderBy("week_start")
    )
