import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tidelist.functions import dates, text
from tidelist.operators.normalize import classify
from tidelist.operators.quality import (
    location_example_failures,
    skill_example_failures,
    title_example_failures,
)
from tidelist.schemas import RULE_TABLES
from tidelist.sources.rules import Rules

RULES = Rules()


def values(spark, column, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_patterns_match_like_re2(spark):
    patterns = [r"\bai\b", r"\bsch\b", r"co-?op\b", r"x$", r"a\sb", r"(^|\s)é", r"[\s,]go", r".y"]
    patterns += [row[2] for row in RULES.skill_vocabulary + RULES.role_family_rules]
    texts = [
        "éai", "ai", "xai", "ai\n", "x\n", "x", "a\x0bb", "a b", "a\tb", "été", "ö sch ä", "schön",
        "\r\ny", " y", "co-op", "coop!", "say, go", "services in go.", "c++", " ai ",
        "go-to-market", "excel at", "advanced excel", "series c", "embedded c", "node.js", "ml-ops",
    ]
    con = duckdb.connect()
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    found = df.select(
        "x", *[text.matches(F.col("x"), p).alias(f"m{i}") for i, p in enumerate(patterns)],
        *[F.expr(text.found_sql("x", p)).alias(f"f{i}") for i, p in enumerate(patterns)],
    ).collect()
    for row in found:
        for i, p in enumerate(patterns):
            expected = con.execute("SELECT regexp_matches(?, ?)", [row["x"], p]).fetchone()[0]
            assert row[f"m{i}"] == expected, (row["x"], p)
            assert row[f"f{i}"] == expected, (row["x"], p)


def test_required_literals_are_necessary():
    for _, _, pattern in RULES.skill_vocabulary:
        literals = text.required_literals(pattern)
        assert literals, pattern
        for sample in ("python", "c# and .net 8", "we use go, sql and excel", "ros 2", "unity3d"):
            if re.search(pattern, sample):
                assert any(literal in sample for literal in literals), (pattern, sample)
    assert text.required_literals(r"\bf?o\b") is None
    assert text.required_literals(r"a{0,3}bcd") is None
    assert text.required_literals(r"foo|") is None


def test_required_words_are_necessary():
    for pattern, words in {
        r"\bpython\b": ["python"],
        r"\bstatistic(s|al)\b": ["statistics", "statistical"],
        r"\bpostgres(ql)?\b": ["postgres", "postgresql"],
        r"\b(?:py)?spark\b": ["spark", "pyspark"],
        r"\bci/cd\b|\bcontinuous integration\b": ["ci", "integration"],
        r"\bspring boot": ["spring"],
        r"\bros ?2?\b": ["ros", "ros2"],
        r"x\+\+ lang(uage)?\b": ["lang", "language"],
    }.items():
        assert sorted(text.required_words(pattern)) == sorted(words), pattern
    for pattern in (r"python", r"\bpython", r"\bpy[a-z]+\b", r"(^|[^a-z])c\+\+", r"\ba\b|b", r"\ba{2}\b", ".", r"\bx+\b"):
        assert text.required_words(pattern) is None, pattern
    samples = ("python", "c# and .net 8", "we use go, sql and excel", "ros 2", "unity3d", "node.js", "data warehouses")
    for _, _, pattern in RULES.skill_vocabulary:
        for sample in samples:
            if re.search(pattern, sample) and (words := text.required_words(pattern)):
                assert set(words) & set(re.split("[^A-Za-z0-9_]+", sample)), (pattern, sample)


def test_html_to_text(spark):
    inputs = [
        "&lt;p&gt;C++ &amp;amp; &lt;b&gt;Go&lt;/b&gt;&lt;/p&gt;",
        "<ul><li>a</li>\n\t<li>b</li></ul>",
        "  ",
        "<br>",
        None,
        "&amp;lt;b&amp;gt;",
        "it&#39;s &quot;ok&quot;&nbsp;now",
    ]
    assert values(spark, text.html_to_text, inputs) == [
        "C++ & Go", "a b", None, None, None, "<b>", "it's \"ok\" now",
    ]


def test_workplace_and_employment(spark):
    places = [None, "  ", "Remote - US", "Paris (Hybrid)", "Paris", "Hybrid or remote"]
    assert values(spark, text.workplace_from_location, places) == [
        "unknown", "unknown", "remote", "hybrid", "onsite", "remote",
    ]
    labels = ["FullTime", "Part-time", "Intern", "Co-op", "Fixed term", "Temporary", "?", None]
    title = F.lit("Marketing Coop")
    assert values(spark, lambda c: text.employment_type(c, F.lit("Engineer")), labels) == [
        "full_time", "part_time", "internship", "internship", "contract", "contract", "unknown",
        "unknown",
    ]
    assert values(spark, lambda c: text.employment_type(c, title), ["Full", None]) == [
        "full_time", "internship",
    ]


def test_title_examples(spark):
    """Order of the rules is semantic; none of the examples may fail."""
    cases = [
        ("Summer Intern, Software", "software_engineering", "intern"),
        ("Senior Data Engineering Intern", "data_engineering", "intern"),
        ("Senior Associate", "other", "senior"),
        ("Associate Director, Sales", "sales_business", "staff_plus"),
        ("Associate Counsel", "corporate_functions", "mid"),
        ("Associate Data Engineer", "data_engineering", "entry"),
        ("Internal Auditor", "other", "mid"),
        ("Jr Analyst", "data_analytics", "entry"),
        ("Head of Security", "security", "staff_plus"),
        ("Lead ML Engineer", "data_science_ml", "senior"),
        ("Gardener", "other", "mid"),
        ("Full Stack Developer, New Grad", "software_engineering", "entry"),
        ("Entry-Level Recruiter", "corporate_functions", "entry"),
    ]
    frame = spark.createDataFrame(cases, RULE_TABLES["title_classification_cases"])
    assert title_example_failures(frame, RULES.role_family_rules).collect() == []
    wrong = spark.createDataFrame(
        [("Gardener", "design", "mid")], RULE_TABLES["title_classification_cases"]
    )
    assert title_example_failures(wrong, RULES.role_family_rules).count() == 1


def test_skill_examples(spark):
    cases = [
        ("Python or Java", "Python", True), ("JavaScript only", "Java", False),
        ("own the go-to-market plan", "Go", False), ("APIs written in Go, mostly", "Go", True),
        ("we excel at service", "Excel", False), ("Excel and SQL", "Excel", True),
        ("series C startup", "C", False), ("firmware in embedded C", "C", True),
        ("accessible to everyone", "Accessibility", False), ("WCAG audits", "Accessibility", True),
        ("MySQL and NoSQL", "SQL", False), ("community", "Unity", False),
        ("built in Unity 3D", "Unity", True), ("across ROS2 nodes", "ROS", True),
        ("the .NET team", ".NET", True), ("networking", ".NET", False),
        ("C# and C++", "C#", True), ("C# and C++", "C++", True), ("trust", "Rust", False),
    ]
    frame = spark.createDataFrame(cases, RULE_TABLES["skill_pattern_cases"])
    assert skill_example_failures(frame, RULES.skill_vocabulary).collect() == []
    wrong = spark.createDataFrame([("rust", "Rust", False)], RULE_TABLES["skill_pattern_cases"])
    assert skill_example_failures(wrong, RULES.skill_vocabulary).count() == 1


def test_location_examples(spark):
    cases = [
        ("Ottawa, ON", "Ontario", "Canada"), ("Vancouver, CA", "British Columbia", "Canada"),
        ("Oakland, CA", "California", "United States"), ("London, ON", "Ontario", "Canada"),
        ("London (UK)", None, "United Kingdom"), ("Mumbai, IN", "Maharashtra", "India"),
        ("Gary, IN", "Indiana", "United States"), ("Remote | India", None, "India"),
        ("Somewhere", None, "Unknown"), ("Montreal / Toronto", "Quebec", "Canada"),
        ("Paris, TX", "Texas", "United States"), ("Toronto, TX, Canada", "Ontario", "Canada"),
        ("Nowhere, CA, India", None, "India"), ("", None, "Unknown"),
    ]
    frame = spark.createDataFrame(cases, RULE_TABLES["geo_location_cases"])
    aliases = RULES.frame(spark, "geo_aliases")
    assert location_example_failures(frame, aliases).collect() == []
    wrong = spark.createDataFrame(
        [("Ottawa, ON", None, "Canada")], RULE_TABLES["geo_location_cases"]
    )
    assert location_example_failures(wrong, aliases).count() == 1


def test_missing_title_is_mid_and_other(spark):
    df = spark.createDataFrame(
        [(None, "unknown", None)], "title string, employment_type string, location_raw string"
    )
    row = classify(df, RULES.role_family_rules).first()
    assert (row.role_family, row.seniority, row.is_entry_level) == ("other", "mid", False)
    assert row.location_key == "d41d8cd98f00b204e9800998ecf8427e"


def test_timestamps(spark):
    inputs = [
        "2026-08-03T05:00:00-04:00", "2026-08-03", "2026-08-03 01:02:03.5Z", "yesterday", "now",
        "2026-13-01", None, "12:30", "2026-08-03T05:00:00+0530",
    ]
    got = values(spark, lambda c: dates.utc_timestamp(c).cast("string"), inputs)
    assert got == [
        "2026-08-03 09:00:00", "2026-08-03 00:00:00", "2026-08-03 01:02:03.5", None, None, None,
        None, None, "2026-08-02 23:30:00",
    ]


@pytest.mark.parametrize("kind", ["float", "share"])
def test_display_values_round_like_c(spark, kind):
    numbers = [0.0, 2.25, 2.35, 0.05, 0.15, 19.25, 26.25, 1234.65, -2.25, 0.0735, 0.3676, 1e-9]
    scale = 100 if kind == "share" else 1
    expected = [f"{x * scale:.1f}" + ("%" if kind == "share" else "") for x in numbers]
    got = values(spark, lambda c: text.display_value(c, kind), numbers, "double")
    assert got == expected
    assert values(spark, lambda c: text.display_value(c, kind), [None], "double") == ["-"]


def test_markdown_cell(spark):
    assert values(spark, text.markdown_cell, ["a|b\\c\n d"]) == ["a\\|b\\\\c d"]
