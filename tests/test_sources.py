import json
from datetime import date

import pytest

from tests import boards as B
from tidelist.operators.manifests import manifest_of, unparsed_from_manifests
from tidelist.sources import lines
from tidelist.sources import responses as R


@pytest.fixture
def response_files(tmp_path):
    for path, content in {
        "2026-03-02/greenhouse/acme.json": '{"jobs": []}',
        "2026-03-02/lever/bolt.status": "503\n",
        "2026-03-02/lever/bolt.json": "[]",
        "2026-03-09/greenhouse/acme.json": '{"jobs":\n [1]}',
        "2026-03-09/greenhouse/acme.txt": "ignored",
        "notes/readme.json": "{}",
    }.items():
        file = tmp_path / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(content)
    return str(tmp_path)


def test_response_files(spark, response_files):
    found = R.one_per_board_day(R.read_responses(spark, response_files))
    rows = {(r.source, r.board, r.snapshot_date): (r.http_status, r.body) for r in found.collect()}
    assert rows == {
        ("greenhouse", "acme", B.DAYS[0]): (200, '{"jobs": []}'),
        ("greenhouse", "acme", B.DAYS[1]): (200, '{"jobs":\n [1]}'),
        ("lever", "bolt", B.DAYS[0]): (503, None),
    }


def test_requested_dates_and_missing_boards(spark, response_files):
    found = R.one_per_board_day(R.read_responses(spark, response_files))
    day = R.restrict_to_dates(found, [B.DAYS[0]])
    expected = R.requested_board_days(B.boards(spark), [B.DAYS[0]])
    rows = R.with_missing_boards(day, expected).collect()
    assert {(r.board, r.http_status) for r in rows} == {("acme", 200), ("bolt", 503), ("crow", 404)}
    with pytest.raises(R.UnknownSnapshot, match="2026-04-01"):
        R.restrict_to_dates(found, [B.DAYS[0], date(2026, 4, 1)])


@pytest.fixture
def lines_lake(tmp_path):
    def put(kind, source, board, day, rows):
        folder = tmp_path / kind / f"source={source}" / f"board={board}" / f"snapshot_date={day}"
        folder.mkdir(parents=True)
        (folder / "part.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))

    stamp = "2026-03-02T12:00:00+00:00"
    common = {"company": "Acme", "extracted_at": stamp}
    put("postings", "greenhouse", "acme", B.DAYS[0], [
        {**common, "posting_id": "1", "payload": B.g(1)},
        {**common, "posting_id": "1", "payload": B.g(1)},
    ])
    manifest = {
        **common, "status": "ok", "fetch_mode": "live", "http_status": 200, "attempts": 1,
        "posting_count": 2, "reject_count": 2, "url": "u", "error": None, "content_hash": "h",
    }
    put("manifests", "greenhouse", "acme", B.DAYS[0],
        [{**manifest, "rejected_posting_ids": ["7", "9"]}])
    put("manifests", "greenhouse", "acme", B.DAYS[1],
        [{**manifest, "status": "failed", "content_hash": None, "posting_count": 0}])
    put("rejects", "greenhouse", "acme", B.DAYS[0], [
        {"extracted_at": stamp, "index": 2, "posting_id": "7", "error": "title: x", "payload": {}},
        {"extracted_at": stamp, "index": 3, "posting_id": None, "error": "y", "payload": "text"},
    ])
    return str(tmp_path)


def test_landed_lines(spark, lines_lake):
    rows = lines.read_postings(spark, lines_lake).collect()
    assert [(r.posting_key, r.snapshot_date) for r in rows] == [
        ("greenhouse:acme:1", B.DAYS[0])
    ] * 2
    assert json.loads(rows[0].payload) == B.g(1)
    plan = lines.read_postings(spark, lines_lake).where("snapshot_date = '2026-03-02'")
    assert "PartitionFilters: [isnotnull(snapshot_date" in (
        plan._jdf.queryExecution().executedPlan().toString()
    )


def test_landed_manifests(spark, lines_lake):
    manifests = lines.read_manifests(spark, lines_lake)
    ok = manifest_of(manifests, "greenhouse:acme", B.DAYS[0]).first()
    assert ok.landing_id == "2026-03-02 12:00:00#h" and ok.rejected_posting_ids == ["7", "9"]
    failed = manifest_of(manifests, "greenhouse:acme", B.DAYS[1]).first()
    assert failed.landing_id.endswith("#none") and failed.rejected_posting_ids == []
    keys = {r.posting_key for r in unparsed_from_manifests(manifests).collect()}
    assert keys == {"greenhouse:acme:7", "greenhouse:acme:9"}
    assert manifest_of(manifests, "greenhouse:none", B.DAYS[0]).isEmpty()


def test_landed_rejects(spark, lines_lake):
    rows = lines.read_rejects(spark, lines_lake).orderBy("item_index").collect()
    assert [(r.item_index, r.posting_id, r.error) for r in rows] == [
        (2, "7", "title: x"), (3, None, "y"),
    ]
