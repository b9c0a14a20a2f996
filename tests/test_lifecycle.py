import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.boards import brute_force_spells
from tidelist.operators import lifecycle, marts

START = date(2026, 1, 5)
OBS = "posting_key string, company_key string, snapshot_date date, title string"


def day(i):
    return START + timedelta(days=i)


def random_history(seed):
    """Boards with failed days; postings parsed, unparsed, absent, or both at random."""
    rng = random.Random(seed)
    ok = {f"s:b{b}": {day(i) for i in range(12) if rng.random() < 0.8} for b in range(4)}
    parsed, unparsed = {}, {}
    for board in ok:
        for n in range(25):
            key = f"{board}:{n}"
            share = rng.random()
            parsed[key] = {day(i) for i in range(12) if rng.random() < share} & ok[board]
            unparsed[key] = {day(i) for i in range(12) if rng.random() < 0.25}
    return ok, parsed, unparsed


def observations(spark, days):
    rows = [
        (key, key.rsplit(":", 1)[0], d, f"{key} on {d}") for key, ds in days.items() for d in ds
    ]
    return spark.createDataFrame(rows, OBS)


def calendar(spark, ok):
    rows = [(board, d) for board, ds in ok.items() for d in ds]
    return lifecycle.snapshot_calendar(
        spark.createDataFrame(rows, "company_key string, snapshot_date date")
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_spells_match_brute_force(spark, seed):
    ok, parsed, unparsed = random_history(seed)
    got = lifecycle.spells(
        observations(spark, parsed), observations(spark, unparsed), calendar(spark, ok), ["title"]
    ).collect()
    expected = brute_force_spells(ok, {k: v for k, v in parsed.items() if v}, unparsed)
    assert {
        (r.posting_key, r.first_seen, r.last_seen, r.closed_at, r.snapshots_observed,
         r.unparsed_snapshots)
        for r in got
    } == expected and len(got) > 100
    for r in got:
        last_parsed = max(d for d in parsed[r.posting_key] if r.first_seen <= d <= r.last_seen)
        assert r.title == f"{r.posting_key} on {last_parsed}"
        assert r.is_open == (r.closed_at is None)
        assert r.is_left_censored == (r.first_seen == min(ok[r.company_key]))
        assert r.days_to_close == (r.closed_at and (r.closed_at - r.first_seen).days)
    by_posting = {}
    for r in sorted(got, key=lambda r: r.first_seen):
        by_posting.setdefault(r.posting_key, []).append(r.spell_number)
    assert all(v == list(range(1, len(v) + 1)) for v in by_posting.values())


@pytest.mark.parametrize(("seed", "known"), [(3, 5), (4, 8), (5, 10)])
def test_continued_spells_equal_recomputed_ones(spark, seed, known):
    ok, parsed, unparsed = random_history(seed)
    upto = lambda days: {k: {d for d in v if d <= day(known)} for k, v in days.items()}
    after = {k: {d for d in v if d > day(known)} for k, v in parsed.items()}
    full = lifecycle.spells(
        observations(spark, parsed), observations(spark, unparsed), calendar(spark, ok), ["title"]
    )
    earlier = lifecycle.spells(
        observations(spark, upto(parsed)),
        observations(spark, upto(unparsed)),
        calendar(spark, upto(ok)),
        ["title"],
    )
    continued = lifecycle.spells(
        observations(spark, after),
        observations(spark, unparsed),
        calendar(spark, ok),
        ["title"],
        earlier=earlier,
    )
    known_closed = earlier.where("NOT is_open").select(continued.columns)
    assert sorted(map(tuple, continued.union(known_closed).collect()), key=repr) == sorted(
        map(tuple, full.collect()), key=repr
    )


def test_shuffles_of_spells(spark):
    """After the calendar join one exchange by posting serves windows and aggregate."""
    ok, parsed, unparsed = random_history(6)
    spells = lifecycle.spells(
        observations(spark, parsed), observations(spark, unparsed), calendar(spark, ok), ["title"]
    )
    plan = spells._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(posting_key#\d+, \d+\)", plan)) == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_marts_of_nothing(spark):
    ok, parsed, unparsed = random_history(7)
    none = lifecycle.spells(
        observations(spark, {}).limit(0),
        observations(spark, unparsed),
        calendar(spark, ok),
        ["title"],
    ).withColumn("role_family", F.lit("x"))
    (row,) = marts.time_to_close(none).collect()
    assert (row.role_family, row.closed_spells, row.median_days_to_close) == ("all_roles", 0, None)


def test_exact_quantiles_from_the_histogram(spark):
    rows = [("r", d, False, True) for d in (7, 14, 14, 21, 30)] + [("r", 99, True, True)]
    spells = spark.createDataFrame(
        rows, "role_family string, days_to_close bigint, is_left_censored boolean, closed boolean"
    ).select("*", F.lit(False).alias("is_open"), F.lit(START).alias("closed_at"))
    row = marts.time_to_close(spells).where("role_family = 'r'").first()
    assert (row.median_days_to_close, row.p75_days_to_close) == (14.0, 21.0)
    assert (row.mean_days_to_close, row.max_days_to_close) == (17.2, 30)
    assert (row.closed_spells, row.excluded_left_censored) == (5, 1)
