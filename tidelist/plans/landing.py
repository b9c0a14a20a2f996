"""Landing responses: from raw bodies to judged, recorded board days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelist.operators.contracts import parse_responses
from tidelist.operators.gates import (
    Policy,
    board_policies,
    build_attempts,
    drop_guard,
    reject_gate,
    summarize_board_days,
)
from tidelist.operators.manifests import (
    conflicting_modes,
    landing_outcomes,
    landing_summary,
    withdrawal,
)
from tidelist.session import bound_broadcasts
from tidelist.sources.lake import Lake
from tidelist.sources.responses import requested_board_days, with_missing_boards


BOARD = ["source", "board"]


class MixedModes(ValueError):
    """The lake already holds data of another fetch mode."""


class UnknownBoard(ValueError):
    """A response is of a board that is not configured."""


class RepeatedResponse(ValueError):
    """A board has several responses on one day."""


class UnknownLanding(ValueError):
    """There is no snapshot to withdraw."""


def noon(day: Column) -> Column:
    """Extraction time of replayed responses: noon of the snapshot date."""
    return (F.unix_seconds(day.cast("timestamp")) + 12 * 3600).cast("timestamp")


def judge(
    items: DataFrame, boards: DataFrame, landed: DataFrame, policy: Policy
) -> DataFrame:
    """Verdict per board and day from parsed items, board policies and earlier manifests."""
    policies = board_policies(boards, policy).select(
        "source", "board", "company", "max_drop_ratio"
    )
    gated = reject_gate(summarize_board_days(items), policy).join(policies, ["source", "board"])
    return drop_guard(gated, landed, policy)


def by_configuration(responses: DataFrame, boards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(responses of configured boards, responses of others)."""
    known = boards.select(*BOARD).distinct()
    return (
        responses.join(known, BOARD, "left_semi"),
        responses.join(known, BOARD, "left_anti"),
    )


def land(
    lake: Lake,
    responses: DataFrame,
    boards: DataFrame,
    policy: Policy = Policy(),
    fetch_mode: str = "fixture",
    extracted_at: Column | None = None,
    allow_mixed: bool = False,
    dates: list[date] | None = None,
    refuse_strangers: bool = False,
) -> DataFrame:
    """Land responses (source, board, snapshot_date, http_status, body); returns the outcomes.

    There must be one response per board and day. Responses of boards that are not configured are
    set aside as they are (``Lake.strangers``) while the rest lands; ``refuse_strangers`` lands
    nothing then. With ``dates``, every board is accounted for on each of them: one without a
    response is recorded as not found.

    Bodies are parsed once and every item is written once, judged or not. Whether a board's day
    counts is decided afterwards from counts read back from the written items, and recorded last:
    items without a committed attempt are invisible.
    """
    bound_broadcasts(lake.spark)
    lake.reopen()
    if not allow_mixed:
        others = [r[0] for r in conflicting_modes(lake.attempts(), fetch_mode).collect()]
        if others:
            raise MixedModes(f"{lake.root} already holds {', '.join(sorted(others))} data")
    unknown = responses.select(*BOARD).distinct().join(boards, BOARD, "left_anti")
    named = sorted(":".join(r) for r in unknown.limit(10).collect())
    if named and refuse_strangers:
        raise UnknownBoard(f"not configured: {', '.join(named)}")
    strangers = None
    if named:
        responses, strangers = by_configuration(responses, boards)
    repeated = responses.groupBy(*BOARD, "snapshot_date").count().where(F.col("count") > 1)
    if twice := repeated.first():
        raise RepeatedResponse(f"{twice['count']} responses of {twice.source}:{twice.board} on a day")
    if dates:
        responses = with_missing_boards(responses, requested_board_days(boards.select(*BOARD), dates))
    load = lake.claim_load()
    if strangers is not None:
        lake.write_strangers(load, strangers)
    lake.write_items(load, parse_responses(responses))
    judged = judge(lake.items_of_load(load), boards, lake.manifests(), policy)
    stamp = noon(F.col("snapshot_date")) if extracted_at is None else extracted_at
    lake.write_attempts(load, build_attempts(judged, load, stamp, fetch_mode))
    lake.commit("landing", load)
    return outcomes(lake, load)


def outcomes(lake: Lake, load: int) -> DataFrame:
    return landing_outcomes(lake.attempts().where(F.col("load") == load), lake.manifests())


def summary(lake: Lake, load: int) -> DataFrame:
    return landing_summary(outcomes(lake, load))


def invalidate(lake: Lake, company_key: str, snapshot_date: date, reason: str) -> None:
    """Withdraw a landed day; the items stay as evidence, the day stops counting."""
    bound_broadcasts(lake.spark)
    load = lake.claim_load()
    event = withdrawal(lake.manifests(), company_key, snapshot_date, reason).withColumn(
        "load", F.lit(load).cast("bigint")
    )
    if event.isEmpty():
        raise UnknownLanding(f"no snapshot for {company_key} on {snapshot_date}")
    lake.write_attempts(load, event)
    lake.commit("landing", load)


