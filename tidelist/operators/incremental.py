"""What changed since the last build, and what of the stored rows still counts.

Stored daily rows are append-only and keyed by the landing they came from. They are current
exactly while that landing is: re-landed, emptied, edited and withdrawn days drop out of the
current view without a delete.

Spells and the states of marts are append-only too, numbered by build. A log of boards tells from
which build on closed spells of a board count and which build wrote its open ones; a log of weeks
tells which build wrote the states of a board and week last. So nothing of an unchanged board is
written again, and nothing of a changed one but what its change asks for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelist.functions.dates import week_start
from tidelist.operators.lifecycle import board_watermarks

LANDING = ["company_key", "snapshot_date", "landing_id"]


def pending_landings(ok_manifests: DataFrame, loaded: DataFrame) -> DataFrame:
    """Successful landings that are not loaded yet; ``loaded`` logs empty landings as well."""
    return ok_manifests.join(loaded.select(*LANDING), LANDING, "left_anti")


def current_daily(daily: DataFrame, ok_manifests: DataFrame) -> DataFrame:
    """Daily rows of the landings that count now."""
    return daily.join(ok_manifests.select(*LANDING), LANDING, "left_semi")


def board_changes(ok_manifests: DataFrame, loaded: DataFrame) -> DataFrame:
    """How each board's successful days relate to those its stored spells were computed from.

    ``change`` is ``unchanged``; ``extended`` if days were only added after the last known one,
    so that spells can be continued; or ``rebuilt`` for new boards and rewritten history.
    ``loaded`` has (company_key, board_watermark, last_day) of the previous build.
    """
    now = board_watermarks(ok_manifests).join(
        ok_manifests.groupBy("company_key").agg(F.max("snapshot_date").alias("last_day")),
        "company_key",
    )
    known = loaded.select(
        "company_key",
        F.col("board_watermark").alias("known_watermark"),
        F.col("last_day").alias("known_until"),
    )
    until_then = board_watermarks(
        ok_manifests.join(known, "company_key").where("snapshot_date <= known_until")
    ).withColumnRenamed("board_watermark", "prefix_watermark")
    unchanged = F.col("board_watermark") == F.col("known_watermark")
    extended = F.col("prefix_watermark") == F.col("known_watermark")
    return (
        now.join(known, "company_key", "left")
        .join(until_then, "company_key", "left")
        .select(
            "company_key",
            "board_watermark",
            "last_day",
            "known_until",
            F.when(unchanged, "unchanged")
            .when(extended, "extended")
            .otherwise("rebuilt")
            .alias("change"),
        )
    )


def logged(changes: DataFrame, loaded: DataFrame, build: int) -> DataFrame:
    """The boards' changes, with the builds that their stored spells are to be taken from.

    Closed spells of a board count from build ``since``, when it was last computed from all of its
    days; its open ones are those of build ``changed``.
    """
    before = loaded.select("company_key", "since", "changed")
    now = F.lit(build).cast("bigint")
    return changes.join(before, "company_key", "left").withColumns(
        {
            "since": F.when(F.col("change") == "rebuilt", now).otherwise(F.col("since")),
            "changed": F.when(F.col("change") != "unchanged", now).otherwise(F.col("changed")),
        }
    )


def live_spells(stored: DataFrame, boards: DataFrame) -> DataFrame:
    """Stored spells (or counts of them) that count, by the log of boards; ``build`` is dropped."""
    log = boards.select("company_key", "board_watermark", "since", "changed")
    ended = ~F.col("is_open") & (F.col("build") >= F.col("since"))
    still_open = F.col("is_open") & (F.col("build") == F.col("changed"))
    return stored.join(log, "company_key").where(ended | still_open).drop("build", "since", "changed")


def touched_weeks(before: DataFrame, now: DataFrame) -> DataFrame:
    """(week_start, company_key) of all landings that only one of two states counts."""
    sided = lambda ok, n: ok.select(*LANDING, F.lit(n).alias("_side"))
    return (
        sided(before, -1)
        .union(sided(now, 1))
        .groupBy(*LANDING)
        .agg(F.sum("_side").alias("_side"))
        .where("_side <> 0")
        .select(week_start(F.col("snapshot_date")).alias("week_start"), "company_key")
        .distinct()
    )


def of_weeks(daily: DataFrame, ok_manifests: DataFrame, weeks: DataFrame) -> DataFrame:
    """Current daily rows of boards in weeks; folders of other weeks are not read."""
    week = week_start(F.col("snapshot_date"))
    # As many values as the calendar has weeks, at most.
    wanted = [r[0] for r in weeks.select("week_start").distinct().collect()]
    ok = ok_manifests.withColumn("week_start", week).join(weeks, ["week_start", "company_key"])
    return current_daily(daily.where(week.isin(wanted)), ok)


def live_states(stored: DataFrame, log: DataFrame) -> DataFrame:
    """Of the states of each board and week, those of the build that the log names last."""
    keys = ["week_start", "company_key"]
    last = log.groupBy(*keys).agg(F.max("build").alias("build"))
    return stored.join(last, [*keys, "build"]).drop("build")


def of_boards(df: DataFrame, boards: DataFrame) -> DataFrame:
    return df.join(boards.select("company_key"), "company_key", "left_semi")


def stale_rows(stored: DataFrame, current_keys: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows that no longer count, for compaction."""
    return stored.join(current_keys.select(*keys), keys, "left_anti")


def reconcile(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Symmetric multiset difference, counted per ``keys`` and side.

    One shuffle: both sides are unioned with opposite signs and summed per distinct row, instead
    of two EXCEPT ALLs.
    """
    columns = expected.columns
    signed = expected.withColumn("_sign", F.lit(1)).unionByName(
        actual.select(columns).withColumn("_sign", F.lit(-1))
    )
    differing = signed.groupBy(columns).agg(F.sum("_sign").alias("_net")).where("_net <> 0")
    problem = F.when(F.col("_net") > 0, "missing_or_changed_in_fact").otherwise("stale_in_fact")
    return (
        differing.select(problem.alias("problem"), *keys, F.abs("_net").alias("_rows"))
        .groupBy("problem", *keys)
        .agg(F.sum("_rows").cast("bigint").alias("rows_affected"))
    )
