"""Landing attempts and the current state they add up to.

Attempts are an append-only log with a monotone ``load`` number. A board's day has one current
manifest: a successful landing is not undone by a later failure, a later success replaces it, an
operator can withdraw it, and a success after the withdrawal restores it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BOARD_DAY = ["company_key", "snapshot_date"]


def landing_id(extracted_at: Column, content_hash: Column) -> Column:
    """Identity of one landing of a board and day: when it was taken and what it contained."""
    return F.concat(
        extracted_at.cast("string"), F.lit("#"), F.coalesce(content_hash, F.lit("none"))
    )


def current_manifests(attempts: DataFrame) -> DataFrame:
    """The manifest that counts for each board and day (partial aggregation, one shuffle)."""
    row = F.struct(*attempts.columns)
    is_ok = F.col("status") == "ok"
    withdrawn = F.col("event") == "invalidate"
    states = attempts.groupBy(*BOARD_DAY).agg(
        F.max_by(row, F.when(is_ok, F.col("load"))).alias("last_ok"),
        F.max_by(row, F.when(~is_ok, F.col("load"))).alias("last_other"),
        F.max(F.when(withdrawn, F.col("load"))).alias("last_withdrawal"),
    )
    ok_counts = F.col("last_ok.load") > F.coalesce("last_withdrawal", F.lit(-1))
    return states.select(
        F.when(ok_counts, F.col("last_ok")).otherwise(F.col("last_other")).alias("m")
    ).select("m.*")


def ok_landings(manifests: DataFrame) -> DataFrame:
    return manifests.where(F.col("status") == "ok")


def manifest_of(manifests: DataFrame, company_key: str, snapshot_date) -> DataFrame:
    """Point lookup of one board and day."""
    return manifests.where(
        (F.col("company_key") == company_key) & (F.col("snapshot_date") == F.lit(snapshot_date))
    )


def previous_ok(value: str) -> Column:
    """``value`` of the board's most recent successful day strictly before each row."""
    before = (
        Window.partitionBy("company_key")
        .orderBy("snapshot_date")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.last(F.when(F.col("status") == "ok", F.col(value)), ignorenulls=True).over(before)


def withdrawal(manifests: DataFrame, company_key: str, snapshot_date, reason: str) -> DataFrame:
    """The attempt that withdraws a landed day: it keeps what the day was and says why.

    Empty when the board has no manifest on that day.
    """
    replaced = F.concat(
        F.lit(reason),
        F.lit(" (withdrawn; "),
        F.col("posting_count").cast("string"),
        F.lit(" items, "),
        F.col("status"),
        F.lit(")"),
    )
    return manifest_of(manifests, company_key, snapshot_date).withColumns(
        {
            "event": F.lit("invalidate"),
            "error": replaced,
            "status": F.lit("contract_failed"),
            "posting_count": F.lit(0).cast("bigint"),
            "content_hash": F.lit(None).cast("string"),
            "landing_id": landing_id(F.col("extracted_at"), F.lit(None).cast("string")),
        }
    )


def landing_outcomes(attempts: DataFrame, manifests: DataFrame) -> DataFrame:
    """What each attempt of a load led to; a failure may have kept an earlier good snapshot."""
    now = manifests.select(
        *BOARD_DAY,
        F.col("status").alias("current_status"),
        F.col("posting_count").alias("current_postings"),
        F.col("reject_count").alias("current_rejects"),
    )
    kept = (F.col("status") != "ok") & (F.col("current_status") == "ok")
    return attempts.join(now, BOARD_DAY).select(
        *BOARD_DAY,
        F.when(kept, F.lit("ok")).otherwise(F.col("status")).alias("status"),
        F.when(kept, F.col("current_postings"))
        .otherwise(F.col("posting_count"))
        .alias("posting_count"),
        F.when(kept, F.col("current_rejects"))
        .otherwise(F.col("reject_count"))
        .alias("reject_count"),
        "error",
        kept.alias("kept_previous"),
    )


def landing_summary(outcomes: DataFrame) -> DataFrame:
    """One row: snapshots ok and attempted, postings and rejects landed, snapshots kept."""
    fresh = ~F.col("kept_previous")
    return outcomes.agg(
        F.count_if(F.col("status") == "ok").alias("ok_snapshots"),
        F.count("*").alias("snapshots"),
        F.coalesce(F.sum(F.when(fresh, F.col("posting_count"))), F.lit(0)).alias("postings"),
        F.coalesce(F.sum(F.when(fresh, F.col("reject_count"))), F.lit(0)).alias("rejected"),
        F.count_if(F.col("kept_previous")).alias("kept_previous"),
    )


def conflicting_modes(attempts: DataFrame, fetch_mode: str) -> DataFrame:
    """Fetch modes already landed that differ from the requested one."""
    return attempts.select("fetch_mode").where(F.col("fetch_mode") != fetch_mode).distinct()


def rejected_ids(items: DataFrame, manifests: DataFrame) -> DataFrame:
    """Distinct ids that were listed but rejected, per current successful landing.

    Kept as rows rather than as one array per board and day: a board may reject very many.
    """
    ok = ok_landings(manifests).select(*BOARD_DAY, F.col("items_load").alias("load"))
    rejected = items.where(F.col("error").isNotNull() & F.col("posting_id").isNotNull())
    return (
        rejected.join(ok, [*BOARD_DAY, "load"], "left_semi")
        .select("company_key", "source", "board", "snapshot_date", "posting_id")
        .distinct()
    )


def unparsed_observations(rejected: DataFrame) -> DataFrame:
    """Postings that were on the board although their record could not be read."""
    return rejected.select(
        "company_key",
        "source",
        "board",
        "snapshot_date",
        "posting_id",
        F.concat("company_key", F.lit(":"), "posting_id").alias("posting_key"),
    ).distinct()


def unparsed_from_manifests(manifests: DataFrame) -> DataFrame:
    """The same for manifests that list the rejected ids as an array."""
    exploded = ok_landings(manifests).select(
        "company_key",
        "source",
        "board",
        "snapshot_date",
        F.explode("rejected_posting_ids").alias("posting_id"),
    )
    return unparsed_observations(exploded)


def with_rejected_id_arrays(manifests: DataFrame, rejected: DataFrame) -> DataFrame:
    """Manifests with the sorted distinct rejected ids as an array, for readers who want one."""
    ids = rejected.groupBy(*BOARD_DAY).agg(
        F.array_sort(F.collect_set("posting_id")).alias("rejected_posting_ids")
    )
    empty = F.array().cast("array<string>")
    return manifests.join(ids, BOARD_DAY, "left").withColumn(
        "rejected_posting_ids", F.coalesce("rejected_posting_ids", empty)
    )
