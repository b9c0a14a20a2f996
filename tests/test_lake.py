"""Landing, building and keeping a lake: scripted scenarios and metamorphic checks."""

import csv
import dataclasses

import pytest
from pyspark.sql import functions as F

from tests import boards as B
from tidelist.operators.gates import Policy
from tidelist.plans import build as built
from tidelist.plans import landing
from tidelist.plans.report import report_frames
from tidelist.schemas import RULE_TABLES
from tidelist.sources.lake import Lake
from tidelist.sources.rules import Rules
from tidelist.streaming.landing import land_new_files

NO_DROP_CHECK = Policy(max_drop_ratio=None)


def state(lake):
    """All facts, dimensions and marts as sorted rows."""
    return {
        name: sorted(map(tuple, built.relation(lake, name).collect()), key=repr)
        for name in built.MARTS
    }


def spell_rows(lake, key):
    rows = built.spells(lake).where(F.col("posting_key") == key).orderBy("first_seen").collect()
    return [
        (B.DAYS.index(r.first_seen), B.DAYS.index(r.last_seen),
         None if r.closed_at is None else B.DAYS.index(r.closed_at))
        for r in rows
    ]


def new_lake(spark, tmp_path, name="lake"):
    return Lake(spark, str(tmp_path / name))


@pytest.fixture(scope="module")
def full(spark, tmp_path_factory):
    """All days landed at once and built once."""
    lake = Lake(spark, str(tmp_path_factory.mktemp("full") / "lake"))
    outcomes = landing.land(lake, B.responses(spark), B.boards(spark))
    assert outcomes.where("status = 'ok'").count() == 11
    built.build(lake)
    return lake


@pytest.fixture(scope="module")
def evolving(spark, tmp_path_factory):
    """The days landed and built in several runs, one of them late."""
    lake = Lake(spark, str(tmp_path_factory.mktemp("evolving") / "lake"))
    for days in ([0, 1], [3], [2]):
        landing.land(lake, B.responses(spark, days), B.boards(spark))
        built.build(lake)
    return lake


def test_scripted_lifecycles(full):
    assert spell_rows(full, "greenhouse:acme:2") == [(1, 2, 3)]
    assert spell_rows(full, "greenhouse:acme:3") == [(0, 0, 1), (2, 3, None)]
    assert spell_rows(full, "lever:bolt:b1") == [(1, 3, None)]  # across the failed day 2
    assert spell_rows(full, "lever:bolt:b2") == [(0, 3, None)]  # unreadable on day 3
    assert spell_rows(full, "greenhouse:acme:4") == [(1, 1, 2)]
    b2 = built.spells(full).where("posting_key = 'lever:bolt:b2'").first()
    assert (b2.unparsed_snapshots, b2.snapshots_observed, b2.is_left_censored) == (1, 3, True)
    assert b2.title == "Platform Engineer"
    retitled = built.spells(full).where("posting_key = 'greenhouse:acme:5'").first()
    assert (retitled.title, retitled.seniority) == ("Senior ML Engineer", "senior")
    closed = built.spells(full).where("posting_key = 'greenhouse:acme:2'").first()
    assert (closed.days_to_close, closed.spell_number, closed.is_left_censored) == (14, 1, False)
    assert closed.is_entry_level and closed.employment_type == "internship"


def test_spells_match_brute_force(full):
    ok = {}
    for r in full.manifests().where("status = 'ok'").collect():
        ok.setdefault(r.company_key, set()).add(r.snapshot_date)
    parsed, unparsed = {}, {}
    for n, day in enumerate(B.DAYS):
        for key, items in B.listing(n).items():
            if isinstance(items, int):
                continue
            for item in items:
                title = item.get("title", item.get("text"))
                target = parsed if title.strip() else unparsed
                if item.get("isListed", True):
                    target.setdefault(f"{key}:{item['id']}", set()).add(day)
    got = {
        (r.posting_key, r.first_seen, r.last_seen, r.closed_at, r.snapshots_observed,
         r.unparsed_snapshots)
        for r in built.spells(full).collect()
    }
    assert got == B.brute_force_spells(ok, parsed, unparsed) and len(got) > 15


def test_rejects_duplicates_and_unlisted(full):
    titles = [r[0] for r in built.daily(full).select("title").distinct().collect()]
    assert "Secret Role" not in titles
    assert full.rejects().where("posting_id = 'bad'").count() == 4
    day1 = "snapshot_date = DATE '2026-03-09' AND company_key = 'greenhouse:acme'"
    assert full.lines().where(day1).count() == built.daily(full).where(day1).count() + 1
    manifest = full.manifests().where("company_key = 'lever:bolt' AND status <> 'ok'").first()
    assert (manifest.status, manifest.http_status, manifest.posting_count) == ("failed", 500, 0)


def test_skills_survive_double_escaping(full):
    bridge = built.relation(full, "bridge_posting_skill")
    skills = lambda key: {
        r.skill for r in bridge.where(F.col("posting_key") == key).collect()
    }
    assert skills("greenhouse:acme:1") == {"C++", "Python"}
    assert skills("lever:bolt:f1") == {"SQL", "dbt", "Kafka", "Airflow"}


def test_standard_checks_pass(full):
    checks = built.check(full).collect()
    assert len(checks) == 81
    assert [c.check_name for c in checks if not c.passed] == []


def test_planted_defects_of_rules_and_examples_fail(full, spark):
    rules = Rules()
    alias = rules.geo_aliases[0]
    defective = dataclasses.replace(
        rules,
        geo_aliases=[*rules.geo_aliases, (alias[0], "planet", *alias[2:])],
        role_families=rules.role_families[1:],
        skill_vocabulary=[*rules.skill_vocabulary, ("Odd", None, "odd")],
    )
    examples = {
        "skills": [("we use python", "Python", True), ("none", "Python", True)],
        "titles": [("Senior Data Engineer", "data_engineering", "senior"), ("Cook", "data_engineering", "senior")],
        "locations": [("Toronto, CA", None, "France"), ("nowhere", None, "Unknown")],
    }
    kinds = dict(zip(examples, ("skill_pattern_cases", "title_classification_cases", "geo_location_cases")))
    cases = {n: spark.createDataFrame(rows, RULE_TABLES[kinds[n]]) for n, rows in examples.items()}
    failing = {c.check_name: c.failing_rows for c in built.check(full, defective, examples=cases).collect()}
    for name in (
        "geo_aliases_unique_alias", "geo_aliases_kind_accepted", "skill_vocabulary_category_not_null",
        "examples_of_skills", "examples_of_titles", "examples_of_locations",
    ):
        assert failing[name] == 1, name
    assert failing["role_family_rules_role_family_in_role_families"] > 0
    assert failing["role_family_rules_unique_priority"] == failing["skill_vocabulary_unique_skill"] == 0


def test_report_frames(full):
    frames = {name: df.collect() for name, df in report_frames(full).items()}
    (headline,) = frames["headline"]
    assert (headline.fetch_modes, headline.ok_snapshots, headline.failed_snapshots) == (
        "fixture", 11, 1,
    )
    assert frames["time_to_close"][0].role_family == "all_roles"
    assert len(frames["top_skills"]) <= 15
    assert frames["mode_banner"][0].mode == "fixture"
    assert [r.company_name for r in frames["extraction_health"]] == sorted(
        f"{key} Inc" for key in B.KEYS
    )


def test_views_answer_sql(full, spark):
    names = built.register_views(full)
    assert set(built.MARTS) < set(names)
    total, n_open = spark.sql(
        "SELECT count(*), count_if(is_open) FROM fct_postings JOIN dim_company USING (company_key)"
    ).first()
    assert total == built.spells(full).count() > n_open > 0


def test_late_day_converges_to_full_build(full, evolving):
    assert state(evolving) == state(full)


def test_rerun_changes_nothing(full, evolving, spark):
    landing.land(evolving, B.responses(spark), B.boards(spark))
    number = built.build(evolving)
    assert state(evolving) == state(full)
    root = f"{evolving.root}/warehouse/generation=1"
    assert spark.read.parquet(f"{root}/observations").where(f"build = {number}").count() == 0
    log = evolving.spells_log().select("change").distinct().collect()
    assert number == 4 and [r.change for r in log] == ["unchanged"]


def test_edits_emptied_and_withdrawn_days_equal_a_full_refresh(evolving, spark):
    """One lake through every kind of change, each compared with a rebuild from nothing."""

    def converge():
        built.build(evolving)
        incremental = state(evolving)
        built.build(evolving, full_refresh=True)
        assert state(evolving) == incremental
        return incremental

    # the same time stamp, another title and another id
    def edit(n, key, items):
        if key != "greenhouse:acme":
            return None
        return [B.g(1, "Totally New Analyst"), B.g(99), *items[2:]]

    landing.land(evolving, B.responses(spark, [3], edit), B.boards(spark))
    converge()
    title = built.spells(evolving).where("posting_key = 'greenhouse:acme:1'").first().title
    assert title == "Totally New Analyst"
    assert spell_rows(evolving, "greenhouse:acme:99") == [(3, 3, None)]

    # withdrawing day 3 reopens what it closed
    landing.invalidate(evolving, "greenhouse:acme", B.DAYS[3], "partial list")
    manifest = evolving.manifests().where(
        (F.col("company_key") == "greenhouse:acme") & (F.col("snapshot_date") == B.DAYS[3])
    ).first()
    assert manifest.status == "contract_failed" and manifest.content_hash is None
    assert "5 items, ok" in manifest.error and "partial list" in manifest.error
    converge()
    assert spell_rows(evolving, "greenhouse:acme:2") == [(1, 2, None)]
    assert spell_rows(evolving, "greenhouse:acme:99") == []
    assert evolving.evidence().where("company_key = 'greenhouse:acme'").count() == 5

    # a later success on the withdrawn day counts again, even an empty one
    empty = lambda n, key, items: [] if key == "greenhouse:acme" else None
    landing.land(evolving, B.responses(spark, [3], empty), B.boards(spark), NO_DROP_CHECK)
    converge()
    assert spell_rows(evolving, "greenhouse:acme:2") == [(1, 2, 3)]
    assert built.daily(evolving).where(
        (F.col("company_key") == "greenhouse:acme") & (F.col("snapshot_date") == B.DAYS[3])
    ).isEmpty()

    with pytest.raises(landing.UnknownLanding):
        landing.invalidate(evolving, "greenhouse:nope", B.DAYS[3], "x")


def test_later_failure_keeps_the_good_snapshot(spark, tmp_path):
    lake = new_lake(spark, tmp_path)
    landing.land(lake, B.one_board(spark, [B.g(1), B.g(2)]), B.boards(spark))
    broken = B.one_board(spark, None, status=502)
    (outcome,) = landing.land(lake, broken, B.boards(spark)).collect()
    assert (outcome.status, outcome.posting_count, outcome.kept_previous) == ("ok", 2, True)
    summary = landing.summary(lake, 2).first()
    assert summary.asDict() == {
        "ok_snapshots": 1, "snapshots": 1, "postings": 0, "rejected": 0, "kept_previous": 1,
    }
    assert lake.lines().count() == 2


def test_modes_do_not_mix_by_accident(spark, tmp_path):
    lake = new_lake(spark, tmp_path)
    landing.land(lake, B.one_board(spark, [B.g(1)]), B.boards(spark), fetch_mode="live")
    with pytest.raises(landing.MixedModes, match="live"):
        landing.land(lake, B.one_board(spark, [B.g(1)]), B.boards(spark))
    assert lake.next_load() == 2  # nothing landed
    day = B.one_board(spark, [B.g(1)], B.DAYS[1])
    landing.land(lake, day, B.boards(spark), allow_mixed=True)
    modes = {r.fetch_mode for r in lake.manifests().collect()}
    assert modes == {"live", "fixture"}
    with pytest.raises(built.NotBuilt):
        built.require_built(lake)


def test_uncommitted_load_is_invisible_and_overwritten(spark, tmp_path):
    from tidelist.operators.contracts import parse_responses

    lake = new_lake(spark, tmp_path)
    landing.land(lake, B.one_board(spark, [B.g(1)]), B.boards(spark))
    # a load that died after writing its items
    lake.write_items(2, parse_responses(B.one_board(spark, [B.g(7), B.g(8)], B.DAYS[1])))
    fresh = Lake(spark, lake.root)
    assert (fresh.items().count(), fresh.next_load()) == (1, 2)
    landing.land(fresh, B.one_board(spark, [B.g(9)], B.DAYS[2]), B.boards(spark))
    assert sorted(r.posting_id for r in fresh.items().collect()) == ["1", "9"]


def test_rule_changes(spark, tmp_path):
    """Stored classes go stale until a full refresh, and the check says so; skills follow."""
    lake = new_lake(spark, tmp_path)
    landing.land(lake, B.responses(spark, [0, 1]), B.boards(spark))
    built.build(lake)
    rules = Rules()
    fewer = dataclasses.replace(
        rules,
        role_family_rules=[r for r in rules.role_family_rules if r[1] != "data_analytics"],
        skill_vocabulary=[("Cpp", "language", r"c\+\+"), *rules.skill_vocabulary[9:]],
    )
    built.build(lake, fewer)
    failed = {c.check_name for c in built.check(lake, fewer).collect() if not c.passed}
    assert failed == {"daily_matches_rebuild"}
    skills = {r.skill for r in built.relation(lake, "bridge_posting_skill").collect()}
    assert "Cpp" in skills and "Python" not in skills
    incremental = state(lake)
    built.build(lake, fewer, full_refresh=True)
    assert state(lake)["bridge_posting_skill"] == incremental["bridge_posting_skill"]
    assert all(c.passed for c in built.check(lake, fewer).collect())


def test_edited_rule_tables_are_read_from_csv(spark, tmp_path):
    rules = Rules()
    headers = {
        "skill_vocabulary": ["skill", "category", "pattern"],
        "role_family_rules": ["priority", "role_family", "pattern"],
        "role_families": ["role_family", "display_name", "archetype"],
        "geo_aliases": ["alias", "kind", "region", "country", "also_country"],
    }
    for name, header in headers.items():
        with open(tmp_path / f"{name}.csv", "w", newline="") as out:
            writer = csv.writer(out)
            writer.writerow(header)
            writer.writerows(getattr(rules, name))
    assert Rules.from_csv(spark, str(tmp_path)) == rules


def test_stream_lands_new_files(spark, tmp_path, full):
    """Files arriving between two runs; a status file stands for a failed request."""

    def put(day_numbers):
        for source, board, day, status, text in B.response_rows(day_numbers):
            folder = tmp_path / "responses" / day.isoformat() / source
            folder.mkdir(parents=True, exist_ok=True)
            name = board + (".json" if text is not None else ".status")
            (folder / name).write_text(text if text is not None else f"{status}\n")

    lake = new_lake(spark, tmp_path)
    for days in ([0, 1], [2, 3]):
        put(days)
        land_new_files(lake, str(tmp_path / "responses"), B.boards(spark)).awaitTermination()
    assert state(lake) == state(full)
