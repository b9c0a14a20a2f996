import itertools
from datetime import date, timedelta

import pytest

from tests.boards import boards, g, one_board
from tidelist.operators import gates, manifests
from tidelist.operators.contracts import parse_responses
from tidelist.operators.gates import Policy

START = date(2026, 1, 5)
GATED = (
    "company_key string, snapshot_date date, observed bigint, gate_status string, "
    "gate_error string, max_drop_ratio double"
)
LANDED = (
    "company_key string, snapshot_date date, status string, posting_count bigint, "
    "reject_count bigint"
)


def day(i):
    return START + timedelta(days=i)


def verdicts(spark, counts, landed=(), ratio=0.8, policy=Policy(), failed=()):
    gated = spark.createDataFrame(
        [
            ("b", day(i), n, "failed" if i in failed else "ok", None, ratio)
            for i, n in counts.items()
        ],
        GATED,
    )
    known = spark.createDataFrame([("b", day(i), s, n, 0) for i, s, n in landed], LANDED)
    rows = gates.drop_guard(gated, known, policy).orderBy("snapshot_date").collect()
    return [r.status for r in rows], rows


def test_refused_day_is_no_baseline(spark):
    statuses, rows = verdicts(spark, dict(enumerate([20, 1, 2, 15, 1])))
    assert statuses == ["ok", "contract_failed", "contract_failed", "ok", "contract_failed"]
    assert "dropped from 20 on 2026-01-05 to 1" in rows[1].error
    assert "more than 80%" in rows[1].error and rows[4].baseline == 15


def test_no_check_without_ratio_baseline_or_size(spark):
    assert verdicts(spark, {0: 20, 1: 0}, ratio=None)[0] == ["ok", "ok"]
    assert verdicts(spark, {0: 3, 1: 0})[0] == ["ok", "ok"]
    assert verdicts(spark, {0: 9, 1: 0})[0] == ["ok", "ok"]
    assert verdicts(spark, {0: 10, 1: 0})[0] == ["ok", "contract_failed"]
    assert verdicts(spark, {0: 0})[0] == ["ok"]


def test_threshold_is_inclusive(spark):
    assert verdicts(spark, {0: 20, 1: 4}, ratio=0.8)[0] == ["ok", "ok"]
    assert verdicts(spark, {0: 20, 1: 10}, ratio=0.3)[0] == ["ok", "contract_failed"]


def test_earlier_landings_are_the_baseline(spark):
    landed = [(0, "ok", 50), (1, "ok", 30), (2, "failed", 0), (6, "ok", 10)]
    statuses, rows = verdicts(spark, {3: 5, 7: 4}, landed)
    assert statuses == ["contract_failed", "ok"]
    assert (rows[0].baseline, rows[1].baseline) == (30, 10)
    # a late day is compared with what came before it, not after it
    assert verdicts(spark, {0: 2}, [(1, "ok", 50)])[0] == ["ok"]


def test_day_that_was_already_good_stays_the_baseline(spark):
    statuses, rows = verdicts(spark, {1: 0, 2: 15}, [(0, "ok", 20), (1, "ok", 100)])
    assert statuses == ["contract_failed", "contract_failed"] and rows[1].baseline == 100
    statuses, rows = verdicts(spark, {1: 9, 2: 2}, [(0, "ok", 20)], failed=(1,))
    assert statuses == ["failed", "contract_failed"] and rows[1].baseline == 20


def gate(spark, items):
    summary = gates.summarize_board_days(parse_responses(one_board(spark, items)))
    return gates.reject_gate(summary, Policy()).first()


def test_reject_ratio_is_strict(spark):
    at_limit = gate(spark, [g(i) for i in range(4)] + [g(9, "")])
    assert (at_limit.gate_status, at_limit.valid_count, at_limit.reject_count) == ("ok", 4, 1)
    above = gate(spark, [g(i) for i in range(3)] + [g(9, "")])
    assert above.gate_status == "contract_failed" and "1 of 4" in above.gate_error
    assert gate(spark, []).gate_status == "ok"
    assert gate(spark, "<html>").gate_status == "contract_failed"


def test_fingerprint(spark):
    def fingerprint(items):
        return gate(spark, items).fingerprint

    base = fingerprint([g(1), g(2), g(3, "")])
    assert base == fingerprint([g(1), g(2), g(3, "")])
    assert base != fingerprint([g(2), g(1), g(3, "")])  # order counts
    assert base != fingerprint([g(1), g(2, "Other"), g(3, "")])
    assert base != fingerprint([g(1), g(2), g(4, "")])  # rejected ids count
    assert base == fingerprint([g(1), g(2), g(3, "\t")])  # but not what is wrong with them
    assert fingerprint([g(1), g(1)]) != fingerprint([])


def test_board_policies_and_accepted_drops(spark):
    configured = boards(spark, ("lever", "x", "X", True, None), ("lever", "y", "Y", True, 0.3))
    def ratios(df):
        rows = gates.board_policies(df, Policy()).collect()
        return {r.board: r.max_drop_ratio for r in rows}

    assert ratios(configured) == {"acme": 0.8, "bolt": 0.8, "crow": 0.8, "x": None, "y": 0.3}
    accepted = gates.accept_drops(configured, ["lever:y", "greenhouse:acme"])
    assert ratios(accepted) == {"acme": None, "bolt": 0.8, "crow": 0.8, "x": None, "y": None}
    with pytest.raises(gates.UnknownBoard, match="greenhouse:nope"):
        gates.accept_drops(configured, ["greenhouse:nope", "lever:x"])


def test_current_manifest_for_every_short_history(spark):
    """All sequences of up to five events against a step-by-step state machine."""
    rows, expected, n = [], {}, 0
    for length in range(1, 6):
        for history in itertools.product(["ok", "failed", "withdraw"], repeat=length):
            n += 1
            state = None  # (status, load)
            for load, event in enumerate(history, 1):
                if event == "withdraw":
                    if state is None:
                        continue  # nothing to withdraw: no event is recorded
                    state = ("contract_failed", load)
                elif event == "ok" or state is None or state[0] != "ok":
                    state = (event, load)
                status = "contract_failed" if event == "withdraw" else event
                kind = "invalidate" if event == "withdraw" else "land"
                rows.append((f"b{n}", START, load, kind, status))
            if state:
                expected[f"b{n}"] = state
    attempts = spark.createDataFrame(
        rows, "company_key string, snapshot_date date, load bigint, event string, status string"
    )
    got = {
        r.company_key: (r.status, r.load) for r in manifests.current_manifests(attempts).collect()
    }
    assert got == expected
