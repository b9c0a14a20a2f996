from datetime import date

from pyspark.sql import functions as F

from tidelist.operators import quality

D = [date(2026, 1, i) for i in range(1, 10)]


def test_row_conditions_let_null_pass(spark):
    df = spark.createDataFrame(
        [(1, D[0], D[1], "a"), (None, None, D[0], None), (9, D[1], D[1], "z"), (3, D[2], D[1], "a")],
        "n int, lo date, hi date, kind string",
    )
    counts = quality.with_outcome(
        quality.count_failing(
            df,
            {
                "null": quality.is_null("n"),
                "outside": quality.outside("n", 1, 5),
                "before": quality.before("hi", "lo"),
                "strict": quality.before("hi", "lo", strict=True),
                "accepted": quality.not_accepted("kind", ["a"]),
                "fine": quality.outside("n", 0, 10),
            },
        )
    )
    got = {r.check_name: r.failing_rows for r in counts.collect()}
    assert got == {"null": 1, "outside": 1, "before": 1, "strict": 2, "accepted": 1, "fine": 0}
    summary = quality.outcome_summary(counts).first()
    assert (summary.passed, summary.failed) == (1, 5)
    assert summary.failing_checks == "accepted, before, null, outside, strict"


def test_keys_and_references(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None)], "k int, ref string")
    assert [tuple(r) for r in quality.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    parent = spark.createDataFrame([("a",), (None,), ("a",)], "id string")
    assert [r.k for r in quality.orphans(df, "ref", parent, "id").collect()] == [2]


def test_lines_and_manifests(spark):
    lines = spark.createDataFrame(
        [("a", D[0]), ("a", D[0]), ("b", D[0]), ("c", D[0])],
        "company_key string, snapshot_date date",
    )
    manifests = spark.createDataFrame(
        [("a", D[0], 2, "ok"), ("b", D[0], 0, "failed"), ("d", D[0], 3, "ok"), ("e", D[0], 0, "ok")],
        "company_key string, snapshot_date date, posting_count int, status string",
    )
    found = quality.landed_versus_manifests(lines, manifests).collect()
    assert {r.company_key for r in found} == {"b", "c", "d"}


def test_spell_rules(spark):
    spells = spark.createDataFrame(
        [
            ("p@1", "p", "b", D[0], D[2], D[3]),
            ("p@2", "p", "b", D[2], D[4], None),
            ("p@3", "p", "b", D[5], D[6], D[8]),
            ("q@1", "q", "b", D[0], D[6], None),
        ],
        "posting_spell_key string, posting_key string, company_key string, first_seen date, "
        "last_seen date, closed_at date",
    ).withColumn("is_open", F.col("closed_at").isNull())
    manifests = spark.createDataFrame(
        [("b", d, "failed" if d == D[8] else "ok") for d in D],
        "company_key string, snapshot_date date, status string",
    )
    keys = lambda df: {r.posting_spell_key for r in df.collect()}
    assert keys(quality.overlapping_spells(spells)) == {"p@2"}
    assert keys(quality.closures_off_calendar(spells, manifests)) == {"p@3"}
    assert keys(quality.open_before_latest(spells, manifests)) == {"p@2", "q@1"}
