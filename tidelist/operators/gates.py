"""Gates a snapshot has to pass before it counts, and the fingerprint of what it contained."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelist import fixed_values as fixed
from tidelist.operators.manifests import BOARD_DAY, landing_id

_LANES = 4
_LANE_HEX = 15  # 60 bits: a lane fits a BIGINT


@dataclass(frozen=True)
class Policy:
    max_reject_ratio: float = fixed.MAX_REJECT_RATIO
    max_drop_ratio: float | None = fixed.MAX_DROP_RATIO
    drop_check_min_postings: int = fixed.DROP_CHECK_MIN_POSTINGS


def board_policies(boards: DataFrame, policy: Policy) -> DataFrame:
    """The drop ratio that applies to each board; an override may be NULL, meaning no check."""
    default = F.lit(policy.max_drop_ratio).cast("double")
    return boards.withColumn(
        "max_drop_ratio",
        F.when(F.coalesce("overrides_drop_ratio", F.lit(False)), F.col("max_drop_ratio"))
        .otherwise(default)
        .cast("double"),
    )


class UnknownBoard(ValueError):
    """A board named by the operator is not configured."""


def accept_drops(boards: DataFrame, company_keys: list[str]) -> DataFrame:
    """Switch the drop check off for the named boards, for one run."""
    key = F.concat("source", F.lit(":"), "board")
    known = {r[0] for r in boards.where(key.isin(company_keys)).select(key).collect()}
    unknown = sorted(set(company_keys) - known)
    if unknown:
        raise UnknownBoard(f"{unknown} not in the configured boards")
    accepted = key.isin(company_keys)
    return boards.withColumns(
        {
            "overrides_drop_ratio": F.when(accepted, F.lit(True)).otherwise(
                F.col("overrides_drop_ratio")
            ),
            "max_drop_ratio": F.when(~accepted, F.col("max_drop_ratio")),
        }
    )


def fingerprint_lanes(text: Column) -> list[Column]:
    """Lanes of the SHA-256 of a text, as BIGINTs that can be combined with XOR."""
    digest = F.sha2(text, 256)
    return [
        F.conv(F.substring(digest, 1 + i * _LANE_HEX, _LANE_HEX), 16, 10).cast("bigint")
        for i in range(_LANES)
    ]


def _xor_lanes(text: Column, prefix: str) -> list[Column]:
    return [
        F.bit_xor(lane).alias(f"{prefix}{i}") for i, lane in enumerate(fingerprint_lanes(text))
    ]


def line_text(item_index: Column, posting_id: Column, payload: Column) -> Column:
    """What one landed line adds to the fingerprint; the index makes the order count."""
    return F.concat_ws(":", item_index.cast("string"), posting_id, payload)


def summarize_board_days(items: DataFrame) -> DataFrame:
    """Counts and fingerprint of every response, from one pass over the items.

    The fingerprint XORs the digests of the lines, so it is aggregated map-side: no board's lines
    are ever brought together, however many there are.
    """
    is_item = F.col("item_index").isNotNull()
    is_valid = is_item & F.col("error").isNull()
    line = F.when(is_valid, line_text(F.col("item_index"), F.col("posting_id"), F.col("payload")))
    summary = items.groupBy("source", "board", *BOARD_DAY).agg(
        F.max("http_status").alias("http_status"),
        F.max("response_error").alias("response_error"),
        F.count_if(is_valid).alias("valid_count"),
        F.count("error").alias("reject_count"),
        *_xor_lanes(line, "v"),
    )
    rejected = (
        items.where(F.col("error").isNotNull() & F.col("posting_id").isNotNull())
        .select(*BOARD_DAY, "posting_id")
        .distinct()
        .groupBy(*BOARD_DAY)
        .agg(*_xor_lanes(F.col("posting_id"), "r"))
    )
    lanes = [f"{p}{i}" for p in "vr" for i in range(_LANES)]
    return (
        summary.join(rejected, BOARD_DAY, "left")
        .withColumn(
            "fingerprint",
            F.concat_ws(
                "|",
                F.col("valid_count").cast("string"),
                *[F.coalesce(F.col(lane), F.lit(0)).cast("string") for lane in lanes],
            ),
        )
        .drop(*lanes)
    )


def reject_gate(summary: DataFrame, policy: Policy) -> DataFrame:
    """Add ``gate_status`` and ``gate_error``: failed request, unusable body, too many rejects."""
    observed = F.col("valid_count") + F.col("reject_count")
    ratio = F.coalesce(F.try_divide(F.col("reject_count"), observed), F.lit(0.0))
    failed_request = (F.col("http_status") < 200) | (F.col("http_status") > 299)
    too_many = ratio > policy.max_reject_ratio
    status = (
        F.when(failed_request, F.lit("failed"))
        .when(F.col("response_error").isNotNull() | too_many, F.lit("contract_failed"))
        .otherwise(F.lit("ok"))
    )
    limit = f"{policy.max_reject_ratio:.0%}"
    error = F.coalesce(
        F.col("response_error"),
        F.when(
            too_many,
            F.concat(
                F.col("reject_count").cast("string"),
                F.lit(" of "),
                observed.cast("string"),
                F.lit(f" items failed the contract (> {limit})"),
            ),
        ),
    )
    return summary.withColumns(
        {"observed": observed, "gate_status": status, "gate_error": error}
    )


def drop_guard(gated: DataFrame, landed: DataFrame, policy: Policy) -> DataFrame:
    """Refuse a snapshot that is suspiciously small next to the board's previous good one.

    A refused day is no baseline for the next, so the days of a board are judged in order. Only
    one small struct per board and day takes part: the fold is bounded by the calendar, whatever
    the size of the board. ``gated`` needs company_key, snapshot_date, observed, gate_status and
    max_drop_ratio (NULL: no check); ``landed`` holds the manifests that are already there.
    """
    first = gated.groupBy("company_key").agg(F.min("snapshot_date").alias("first_day"))
    known = (
        landed.where(F.col("status") == "ok")
        .select(*BOARD_DAY, (F.col("posting_count") + F.col("reject_count")).alias("known"))
        .join(first, "company_key")
    )
    earlier = known.where(F.col("snapshot_date") < F.col("first_day"))
    latest_earlier = earlier.groupBy("company_key").agg(
        F.max("snapshot_date").alias("snapshot_date"),
        F.max_by("known", "snapshot_date").alias("known"),
    )
    during = known.where(F.col("snapshot_date") >= F.col("first_day")).drop("first_day")
    timeline = gated.select(
        *BOARD_DAY, "observed", "gate_status", F.col("max_drop_ratio").cast("double")
    ).join(latest_earlier.unionByName(during), BOARD_DAY, "full")

    day = F.struct(
        "snapshot_date",
        F.col("observed").cast("bigint").alias("observed"),
        F.coalesce(F.col("gate_status") == "ok", F.lit(False)).alias("passes"),
        F.col("known").cast("bigint").alias("known"),
        "max_drop_ratio",
    )
    start = F.expr(
        "named_struct('baseline', cast(null as bigint), 'refused', cast(array() as array<date>))"
    )

    def accepted(d, is_drop: Column) -> Column:
        return F.when(d["passes"] & ~is_drop, d["observed"]).otherwise(d["known"])

    def step(state: Column, d: Column) -> Column:
        is_drop = F.coalesce(
            d["passes"]
            & (state["baseline"] >= policy.drop_check_min_postings)
            & (d["observed"] < state["baseline"] * (1 - d["max_drop_ratio"])),
            F.lit(False),
        )
        return F.struct(
            F.coalesce(accepted(d, is_drop), state["baseline"]).alias("baseline"),
            F.when(is_drop, F.array_append(state["refused"], d["snapshot_date"]))
            .otherwise(state["refused"])
            .alias("refused"),
        )

    # The fold only keeps the refused days; what each day was judged by is looked up afterwards.
    folded = timeline.groupBy("company_key").agg(F.array_sort(F.collect_list(day)).alias("days"))
    unfolded = folded.withColumn("refused", F.aggregate("days", start, step)["refused"]).select(
        "company_key", "refused", F.inline("days")
    )
    is_drop = F.array_contains("refused", F.col("snapshot_date"))
    counted = accepted({c: F.col(c) for c in ("passes", "observed", "known")}, is_drop)
    before = (
        Window.partitionBy("company_key")
        .orderBy("snapshot_date")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counted_day = F.when(F.col("counted").isNotNull(), F.col("snapshot_date"))
    verdicts = (
        unfolded.withColumns({"is_drop": is_drop, "counted": counted})
        .withColumns(
            {
                "baseline": F.last("counted", ignorenulls=True).over(before),
                "baseline_day": F.last(counted_day, ignorenulls=True).over(before),
            }
        )
        .select(*BOARD_DAY, "baseline", "baseline_day", "is_drop")
    )
    judged = gated.join(verdicts, BOARD_DAY)
    error = F.concat(
        F.lit("item count dropped from "),
        F.col("baseline").cast("string"),
        F.lit(" on "),
        F.col("baseline_day").cast("string"),
        F.lit(" to "),
        F.col("observed").cast("string"),
        F.lit(" (more than "),
        F.format_string("%.0f%%", F.col("max_drop_ratio") * 100),
        F.lit("); accept the drop for "),
        F.col("company_key"),
        F.lit(" if the board really closed them"),
    )
    return judged.withColumns(
        {
            "status": F.when(F.col("is_drop"), F.lit("contract_failed")).otherwise(
                F.col("gate_status")
            ),
            "error": F.when(F.col("is_drop"), error).otherwise(F.col("gate_error")),
        }
    )


def build_attempts(
    judged: DataFrame, load: int, extracted_at: Column, fetch_mode: str
) -> DataFrame:
    """Attempt rows of one load, ready to append."""
    ok = F.col("status") == "ok"
    content = F.sha2(
        F.concat_ws("|", "company", F.col("extracted_at").cast("string"), "fingerprint"), 256
    )
    stamped = judged.withColumn("extracted_at", extracted_at)
    hashed = stamped.withColumn("content_hash", F.when(ok, content))
    return hashed.select(
        F.lit(load).cast("bigint").alias("load"),
        F.lit("land").alias("event"),
        "company_key",
        "source",
        "board",
        "snapshot_date",
        "company",
        "extracted_at",
        "status",
        F.lit(fetch_mode).alias("fetch_mode"),
        "http_status",
        F.lit(1).alias("attempts"),
        F.when(ok, F.col("valid_count")).otherwise(F.lit(0)).alias("posting_count"),
        "reject_count",
        F.lit(None).cast("string").alias("url"),
        "error",
        "content_hash",
        landing_id(F.col("extracted_at"), F.col("content_hash")).alias("landing_id"),
        F.lit(load).cast("bigint").alias("items_load"),
    )
