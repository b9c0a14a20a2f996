"""What keeps landings and builds bounded on the driver, and their input derived once."""

from queries import registry as R
from tidelist.session import bound_broadcasts

SF_DIR = "/root/testdata/sf0.001"


def test_well_packed_files_are_not_broadcast(spark, tmp_path):
    """A file far below Spark's 10 MB may hold rows of hundreds."""
    log = spark.range(300_000).selectExpr("id AS k", "repeat('x', 300) AS company_key")
    log.write.parquet(f"{tmp_path}/log")
    spark.range(20).write.parquet(f"{tmp_path}/tiny")
    bound_broadcasts(spark)
    rows = spark.range(900_000).withColumnRenamed("id", "k")
    joined = rows.join(spark.read.parquet(f"{tmp_path}/log"), "k")
    assert joined.where("length(company_key) = 300").count() == 300_000
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    tiny = rows.join(spark.read.parquet(f"{tmp_path}/tiny").withColumnRenamed("id", "k"), "k")
    assert "Broadcast" in tiny._jdf.queryExecution().executedPlan().toString()


def test_responses_are_derived_once(spark, monkeypatch):
    landed = []
    monkeypatch.setattr(R, "land", lambda lake, part, boards, *_, **__: landed.append((part, boards)))
    monkeypatch.setattr(R, "build", lambda *_: None)
    monkeypatch.setattr(R, "_LAKES", {})
    R.lake(spark, SF_DIR)
    for part, boards in landed:
        assert not any("events" in f for f in part.inputFiles() + boards.inputFiles())
    (early, boards), (late, _) = landed
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(early.union(late)) == rows(R.derived_responses(spark, SF_DIR))
    assert rows(boards) == rows(R.derived_boards(spark, SF_DIR))
