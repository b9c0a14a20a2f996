"""Two writers, unknown boards, odd values of providers, and rule tables of any size."""

import contextlib
import io
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tests import boards as B
from tidelist import fixed_values as fixed
from tidelist.operators import geo, skills
from tidelist.plans import build as built
from tidelist.plans import landing
from tidelist.sources.lake import Lake
from tidelist.sources.rules import Rules
from tidelist.streaming.landing import land_new_files


def test_two_writers_keep_both_landings(spark, tmp_path):
    one, two = Lake(spark, str(tmp_path)), Lake(spark, str(tmp_path))
    assert one.next_load() == two.next_load() == 1  # both have looked at the commits
    landing.land(one, B.one_board(spark, [B.g(1)], B.DAYS[0]), B.boards(spark))
    landing.land(two, B.one_board(spark, [B.g(2)], B.DAYS[1]), B.boards(spark))
    landing.land(one, B.one_board(spark, [B.g(3)], B.DAYS[2]), B.boards(spark))
    seen = Lake(spark, str(tmp_path)).lines().select("snapshot_date", "posting_id").collect()
    assert {(r[0], r[1]) for r in seen} == {(B.DAYS[0], "1"), (B.DAYS[1], "2"), (B.DAYS[2], "3")}


def test_unknown_boards_are_set_aside(spark, tmp_path):
    """One stranger among the boards: the others land; whoever wants may refuse it instead."""
    lake = Lake(spark, str(tmp_path))
    stranger = B.one_board(spark, [B.g(1)]).withColumn("board", F.lit("stranger"))
    with pytest.raises(landing.UnknownBoard, match="stranger"):
        landing.land(lake, stranger, B.boards(spark), refuse_strangers=True)
    assert lake.next_load() == 1 and lake.items().count() == 0 and lake.strangers().count() == 0
    both = B.responses(spark, [0]).unionByName(stranger)
    outcome = landing.land(lake, both, B.boards(spark))
    assert {r.company_key for r in outcome.collect()} == set(B.KEYS)
    (row,) = lake.strangers().collect()
    assert (row.source, row.board, row.snapshot_date, row.load) == ("greenhouse", "stranger", B.DAYS[0], 1)
    assert '"id": 1' in row.body and lake.items().where("board = 'stranger'").isEmpty()
    # Once configured, what was set aside can be landed.
    more = B.boards(spark, ("greenhouse", "stranger", "Stranger Inc", False, None))
    landing.land(lake, lake.strangers().drop("load"), more)
    assert lake.lines().where("board = 'stranger'").count() == 1


def test_stream_goes_on_after_a_stranger_and_notes_silent_boards(spark, tmp_path):
    lake, root = Lake(spark, str(tmp_path / "lake")), tmp_path / "responses"

    def put(source, board, day, text):
        folder = root / day.isoformat() / source
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{board}.json").write_text(text)

    for n, day in enumerate(B.DAYS[:2]):
        put("greenhouse", "stranger", day, B.body("greenhouse:x", [B.g(9)]))
        put("greenhouse", "acme", day, B.body("greenhouse:acme", [B.g(1), B.g(2 + n)]))
        land_new_files(lake, str(root), B.boards(spark)).awaitTermination()
    status = {(r.company_key, r.snapshot_date): r.status for r in lake.manifests().collect()}
    assert [status["greenhouse:acme", d] for d in B.DAYS[:2]] == ["ok", "ok"]
    assert [status["lever:bolt", d] for d in B.DAYS[:2]] == ["failed", "failed"]
    assert lake.strangers().count() == 2 and built.spells(lake).count() == 3


@pytest.mark.parametrize("blank", [" ", "　 ", "\x1c\t", fixed.BLANKS])
def test_titles_of_any_white_space_are_blank(spark, tmp_path, blank):
    lake = Lake(spark, str(tmp_path))
    listed = [B.g(i) for i in range(1, 8)] + [B.g(8, title=blank), B.g(9, title=f"{blank}x")]
    landing.land(lake, B.one_board(spark, listed), B.boards(spark))
    assert {r.posting_id for r in lake.lines().collect()} == {str(i) for i in (1, 2, 3, 4, 5, 6, 7, 9)}


def test_thousands_of_patterns_take_one_scan(spark, tmp_path):
    path = str(tmp_path / "texts")
    spark.createDataFrame([(i, f"word{i} and word{i + 1}") for i in range(500)], "id long, t string").write.parquet(path)
    vocabulary = [(f"s{i}", "c", rf"\bword{i}\b") for i in range(5000)]
    tagged = skills.tag_texts(spark.read.parquet(path), "t", vocabulary, ["id"])
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange hashpartitioning" not in plan
    assert plan.count("split(") == 1  # words are looked up once
    expected = {(i, f"s{j}") for i in range(500) for j in (i, i + 1)}
    assert {(r["id"], r["skill"]) for r in tagged.collect()} == expected


@pytest.mark.parametrize("most", [10_000, 0])
def test_tags_equal_every_pattern_on_every_text(spark, monkeypatch, most):
    """Rules with and without a word of their own, by either way of looking them up."""
    monkeypatch.setattr(skills, "LITERAL_RULES", most)
    vocabulary = [(s, c, p) for s, c, p in Rules().skill_vocabulary]
    vocabulary += [("either", "x", r"\balpha\b|\bbeta\b"), ("any", "x", "a"), ("end", "x", "omega$")]
    samples = [
        "python, java; c++ and c# with .net", "alpha beta alpha", "go and rust", "pythonic", "",
        "data warehousing\nin postgresql (nodejs, node.js)", "rest apis", "the omega", "omega\n", None,
        "unity 3d; excel", "x_python python_x", "\u00e9python", "statistical a/b tests", "c/c++ in go",
    ]
    texts = spark.createDataFrame(list(enumerate(samples)), "id long, t string")
    got = {(r["id"], r["skill"]) for r in skills.tag_texts(texts, "t", vocabulary, ["id"]).collect()}
    matches = "SELECT regexp_matches(?, ?)"
    expected = {
        (i, s) for i, t in enumerate(samples) if t is not None for s, _, p in vocabulary
        if duckdb.execute(matches, [t, p]).fetchone()[0]
    }
    assert got == expected
    assert skills.tag_texts(texts, "t", vocabulary, ["id"]).count() == len(expected)


def test_no_text_is_shuffled_for_the_bridge(spark):
    kinds = "posting_key string, snapshot_date date, extracted_at timestamp, title string, posting_url string, description_text string"
    postings = spark.createDataFrame(
        [
            ("a", B.DAYS[0], None, "Python", "u", "old: sql"),
            ("a", B.DAYS[1], None, "New", "u", "rust"),
            ("a", B.DAYS[1], None, "New", "u", "rust"),
            ("b", B.DAYS[1], None, "Java", "u", None),
            ("b", B.DAYS[2], None, "Nothing", "u", "none"),
        ],
        kinds,
    )
    bridge = skills.skill_bridge(postings, Rules().skill_vocabulary)
    assert [(r["posting_key"], r["skill"]) for r in bridge.collect()] == [("a", "Rust")]
    with contextlib.redirect_stdout(io.StringIO()) as out:
        bridge.explain("formatted")
    moved = re.findall(r"Exchange\nInput \[\d+\]: (.*)", out.getvalue())
    assert moved and not any("search_text" in m or "description" in m or "_text#" in m for m in moved)


def test_unchanged_boards_are_not_written_again(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    landing.land(lake, B.responses(spark, [0, 1]), B.boards(spark))
    built.build(lake)
    acme = lambda n, key, items: items if key == "greenhouse:acme" else None
    landing.land(lake, B.responses(spark, [2, 3], acme), B.boards(spark))
    number = built.build(lake)
    base = f"{lake.root}/warehouse/generation=1"
    boards = lambda table: {
        r[0] for r in spark.read.parquet(f"{base}/{table}/build={number}").select("company_key").distinct().collect()
    }
    assert boards("spells") == boards("spell_counts") == boards("week_states") == {"greenhouse:acme"}
    weeks = spark.read.parquet(f"{base}/week_states/build={number}").select("week_start").distinct()
    assert {r[0] for r in weeks.collect()} == set(B.DAYS[2:])
    # Spells that closed before are not there either: only open and newly closed ones.
    again = spark.read.parquet(f"{base}/spells/build={number}").where("closed_at <= DATE '2026-03-09'")
    assert again.isEmpty()
    incremental = {n: sorted(map(repr, built.relation(lake, n).collect())) for n in built.MARTS}
    built.build(lake, full_refresh=True)
    assert incremental == {n: sorted(map(repr, built.relation(lake, n).collect())) for n in built.MARTS}


def test_empty_rule_tables(spark):
    none = Rules(skill_vocabulary=[], role_family_rules=[], role_families=[], geo_aliases=[])
    for name in Rules.__dataclass_fields__:
        assert none.frame(spark, name).count() == 0
    texts = spark.createDataFrame([(1, "python")], "id long, t string")
    assert skills.tag_texts(texts, "t", [], ["id"]).count() == 0
    places = spark.createDataFrame([("k", "Toronto, CA")], "location_key string, location_raw string")
    (row,) = geo.resolve_geo(places, none.frame(spark, "geo_aliases")).collect()
    assert row.region is None and row.country is None
