"""Dimensions and analytics marts.

Counts are additive, so every mart first aggregates to its finest grain (combined map-side, one
shuffle) and derives the totals from that small result; nothing is expanded before it is grouped.

The finest grains are states that merge by addition: ``week_states`` per week and board,
``spell_counts`` per board. A build keeps them and replaces those of the boards and weeks that have
changed; the ``_of`` functions derive the marts from states, whoever kept them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelist import fixed_values as fixed
from tidelist.functions.dates import week_start
from tidelist.operators.normalize import first_per_key


def _share(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part, whole), 4)


def _bigint_sum(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name)


def postings_seen(daily: DataFrame) -> DataFrame:
    """(company_key, postings_seen): distinct postings of each board."""
    distinct = daily.select("company_key", "posting_key").distinct()
    return distinct.groupBy("company_key").agg(F.count("*").alias("postings_seen"))


def postings_seen_of(counts: DataFrame) -> DataFrame:
    """The same from ``spell_counts``: every posting has one first spell."""
    first = counts.where("is_first").groupBy("company_key")
    return first.agg(F.sum("n").cast("bigint").alias("postings_seen"))


def dim_company(manifests: DataFrame, daily: DataFrame) -> DataFrame:
    """One row per board ever attempted, with its extraction health."""
    return dim_company_of(manifests, postings_seen(daily))


def dim_company_of(manifests: DataFrame, seen: DataFrame) -> DataFrame:
    ok = F.col("status") == "ok"
    boards = manifests.groupBy("company_key", "source", "board").agg(
        F.max_by(
            "company",
            F.when(F.col("company").isNotNull(), F.struct("snapshot_date", "company")),
        ).alias("company_name"),
        F.min("snapshot_date").alias("first_snapshot_date"),
        F.max(F.when(ok, F.col("snapshot_date"))).alias("last_ok_snapshot_date"),
        F.count_if(ok).alias("ok_snapshots"),
        F.count_if(~ok).alias("failed_snapshots"),
        F.coalesce(F.sum("reject_count"), F.lit(0)).cast("bigint").alias("rejected_records"),
    )
    return boards.join(seen, "company_key", "left").withColumn(
        "postings_seen", F.coalesce("postings_seen", F.lit(0)).cast("bigint")
    )


def dim_role_family(role_families: DataFrame) -> DataFrame:
    return role_families.select("role_family", "display_name", "archetype")


def spell_counts(spells: DataFrame) -> DataFrame:
    """How many spells of a board share what the marts ask of a spell."""
    return spells.groupBy(
        "company_key",
        "role_family",
        "is_left_censored",
        "is_open",
        (F.col("spell_number") == 1).alias("is_first"),
        week_start(F.col("first_seen")).alias("first_week"),
        week_start(F.col("closed_at")).alias("closed_week"),
        "days_to_close",
    ).agg(F.count("*").alias("n"))


def weekly_flow(manifests: DataFrame, daily: DataFrame, spells: DataFrame) -> DataFrame:
    """Postings listed, opened, reopened and closed per week with a successful snapshot."""
    # A posting belongs to one board, so distinct postings add up over boards.
    listed = (
        daily.select(
            week_start(F.col("snapshot_date")).alias("week_start"), "company_key", "posting_key"
        )
        .distinct()
        .groupBy("week_start", "company_key")
        .agg(F.count("*").alias("listed_postings"))
    )
    weeks = spells.select(
        week_start(F.col("first_seen")).alias("first_week"),
        week_start(F.col("closed_at")).alias("closed_week"),
        "is_left_censored",
        (F.col("spell_number") == 1).alias("is_first"),
        F.lit(1).alias("n"),
    )
    return weekly_flow_of(manifests, listed, weeks)


def weekly_flow_of(manifests: DataFrame, states: DataFrame, counts: DataFrame) -> DataFrame:
    """The weekly flow from ``week_states`` and ``spell_counts``."""
    weeks = (
        manifests.where(F.col("status") == "ok")
        .select(week_start(F.col("snapshot_date")).alias("week_start"))
        .distinct()
    )
    listed = (
        states.groupBy("week_start", "company_key")
        .agg(F.sum("listed_postings").alias("n"))
        .groupBy("week_start")
        .agg(
            F.count("*").alias("boards_observed"),
            F.sum("n").cast("bigint").alias("listed_postings"),
        )
    )
    # Each spell is an opening in one week and perhaps a closure in another.
    starts = F.struct(
        F.col("first_week").alias("week_start"),
        F.when(~F.col("is_left_censored"), F.col("n")).otherwise(0).alias("opened"),
        F.when(~F.col("is_first"), F.col("n")).otherwise(0).alias("reopened"),
        F.lit(0).cast(counts.schema["n"].dataType).alias("closed"),
    )
    ends = F.struct(
        F.col("closed_week").alias("week_start"),
        F.lit(0).cast(counts.schema["n"].dataType).alias("opened"),
        F.lit(0).cast(counts.schema["n"].dataType).alias("reopened"),
        F.col("n").alias("closed"),
    )
    changes = (
        counts.select(F.inline(F.array(starts, ends)))
        .where(F.col("week_start").isNotNull())
        .groupBy("week_start")
        .agg(_bigint_sum("opened"), _bigint_sum("reopened"), _bigint_sum("closed"))
    )
    count = lambda name: F.coalesce(name, F.lit(0)).cast("bigint")
    return (
        weeks.join(listed, "week_start", "left")
        .join(changes, "week_start", "left")
        .select(
            "week_start",
            count("boards_observed").alias("boards_observed"),
            count("listed_postings").alias("listed_postings"),
            count("opened").alias("opened"),
            count("reopened").alias("reopened"),
            count("closed").alias("closed"),
            (count("opened") - count("closed")).alias("net_change"),
        )
    )


def time_to_close(spells: DataFrame, role: str = "role_family") -> DataFrame:
    """Days until closure per role, and over all roles.

    Left-censored spells are excluded and open ones only counted. The exact median and quantile
    come from a histogram of days, so no role's spells are gathered in one place. The total row
    is there even if there are no spells.
    """
    closed = F.col("closed_at").isNotNull()
    histogram = spells.groupBy(
        F.col(role).alias("role_family"),
        "is_left_censored",
        "is_open",
        closed.alias("is_closed"),
        "days_to_close",
    ).agg(F.count("*").alias("n"))
    return _close_times(histogram)


def time_to_close_of(counts: DataFrame) -> DataFrame:
    """The same from ``spell_counts``."""
    histogram = counts.groupBy(
        "role_family",
        "is_left_censored",
        "is_open",
        F.col("closed_week").isNotNull().alias("is_closed"),
        "days_to_close",
    ).agg(F.sum("n").cast("bigint").alias("n"))
    return _close_times(histogram)


def _close_times(histogram: DataFrame) -> DataFrame:
    histogram = histogram.withColumn(
        "counted_days", F.when(~F.col("is_left_censored"), F.col("days_to_close"))
    )
    total = lambda condition: F.coalesce(
        F.sum(F.when(condition, F.col("n"))), F.lit(0)
    ).cast("bigint")
    measured = F.when(F.col("counted_days").isNotNull(), F.col("n"))
    censored = F.col("is_left_censored")
    measures = [
        total(F.col("is_closed") & ~censored).alias("closed_spells"),
        total(F.col("is_open")).alias("still_open_spells"),
        total(F.col("is_closed") & censored).alias("excluded_left_censored"),
        F.round(
            F.try_divide(F.sum(F.col("counted_days") * F.col("n")), F.sum(measured)), 1
        ).alias("mean_days_to_close"),
        F.percentile("counted_days", F.lit(0.5), F.col("n")).alias("median_days_to_close"),
        F.percentile("counted_days", F.lit(0.75), F.col("n")).alias("p75_days_to_close"),
        F.max("counted_days").alias("max_days_to_close"),
    ]
    overall = histogram.agg(*measures).select(
        F.lit(fixed.ALL_ROLES).alias("role_family"), "*"
    )
    return histogram.groupBy("role_family").agg(*measures).unionByName(overall)


def postings_of_spells(spells: DataFrame) -> DataFrame:
    """One row per posting: the role at its last spell, and whether it is listed now."""
    return spells.groupBy("posting_key").agg(
        F.max_by("role_family", "last_seen").alias("role_family"),
        F.bool_or("is_open").alias("is_open"),
    )


def by_role_and_overall(counts: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Counts per role and keys, plus the same over all roles, from pre-aggregated counts."""
    both = F.explode(F.array(F.col("role_family"), F.lit(fixed.ALL_ROLES)))
    return (
        counts.select(both.alias("role_family"), *keys, *measures)
        .groupBy("role_family", *keys)
        .agg(*[_bigint_sum(m) for m in measures])
    )


def skill_demand(spells: DataFrame, bridge: DataFrame) -> DataFrame:
    """Share of postings, ever seen and open now, that mention each skill."""
    postings = postings_of_spells(spells)
    totals = by_role_and_overall(
        postings.groupBy("role_family").agg(
            F.count("*").alias("postings_total"), F.count_if("is_open").alias("open_total")
        ),
        [],
        ["postings_total", "open_total"],
    )
    mentions = by_role_and_overall(
        postings.join(bridge, "posting_key")
        .groupBy("role_family", "skill", "category")
        .agg(
            F.count("*").alias("postings_with_skill"),
            F.count_if("is_open").alias("open_with_skill"),
        ),
        ["skill", "category"],
        ["postings_with_skill", "open_with_skill"],
    )
    by_count = Window.partitionBy("role_family").orderBy(F.col("postings_with_skill").desc())
    return mentions.join(totals, "role_family").select(
        "role_family",
        "skill",
        "category",
        "postings_with_skill",
        "postings_total",
        _share(F.col("postings_with_skill"), F.col("postings_total")).alias("share_of_postings"),
        "open_with_skill",
        "open_total",
        _share(F.col("open_with_skill"), F.col("open_total")).alias("share_of_open"),
        F.rank().over(by_count).cast("bigint").alias("rank_in_family"),
    )


def weekly_latest(daily: DataFrame, columns: list[str]) -> DataFrame:
    """The last observation of each posting in each week."""
    observed = daily.select(
        week_start(F.col("snapshot_date")).alias("week_start"),
        "posting_key",
        "snapshot_date",
        *columns,
    )
    return first_per_key(
        observed, ["week_start", "posting_key"], [F.col("snapshot_date").desc()]
    ).drop("snapshot_date")


_WORKPLACES = [f"{t}_postings" for t in fixed.WORKPLACE_TYPES]
_LEVELS = ["listed_postings", "intern_postings", "entry_level_postings"]


def week_states(daily: DataFrame) -> DataFrame:
    """Counts of the postings a board listed in a week, by role, as they were last seen in it."""
    attributes = ["company_key", "role_family", "workplace_type", "seniority", "is_entry_level"]
    is_type = lambda t: F.count_if(F.col("workplace_type") == t)
    return (
        weekly_latest(daily, attributes)
        .groupBy("week_start", "company_key", "role_family")
        .agg(
            F.count("*").alias("listed_postings"),
            F.count_if(F.col("seniority") == "intern").alias("intern_postings"),
            F.count_if("is_entry_level").alias("entry_level_postings"),
            *[is_type(t).alias(name) for t, name in zip(fixed.WORKPLACE_TYPES, _WORKPLACES)],
        )
    )


def remote_share(daily: DataFrame) -> DataFrame:
    """Workplace mix of listed postings per week."""
    return remote_share_of(week_states(daily))


def remote_share_of(states: DataFrame) -> DataFrame:
    counted = states.groupBy("week_start").agg(
        *[_bigint_sum(m) for m in ("listed_postings", *_WORKPLACES)]
    )
    listed = F.col("listed_postings")
    return counted.withColumns(
        {
            "remote_share": _share(F.col("remote_postings"), listed),
            "hybrid_share": _share(F.col("hybrid_postings"), listed),
        }
    )


def entry_level_share(daily: DataFrame) -> DataFrame:
    """Share of internships and entry-level postings per week and role, and over all roles."""
    return entry_level_share_of(week_states(daily))


def entry_level_share_of(states: DataFrame) -> DataFrame:
    counted = states.groupBy("week_start", "role_family").agg(*[_bigint_sum(m) for m in _LEVELS])
    return by_role_and_overall(counted, ["week_start"], _LEVELS).select(
        "week_start",
        "role_family",
        *_LEVELS,
        _share(F.col("entry_level_postings"), F.col("listed_postings")).alias(
            "entry_level_share"
        ),
    )
