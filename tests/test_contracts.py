import json

import pytest

from tests.boards import a, g, lv, one_board
from tidelist.operators.contracts import parse_responses, rejected_items, valid_items


def parsed(spark, items, key="greenhouse:acme", status=200):
    return parse_responses(one_board(spark, items, key=key, status=status))


def errors(spark, items, key="greenhouse:acme"):
    rows = parsed(spark, items, key).orderBy("item_index").collect()
    return [r.error for r in rows]


def without(item, field):
    return {k: v for k, v in item.items() if k != field}


def test_valid_items_pass_and_keep_their_payload(spark):
    items = [g(1, extra={"z": [1, None], "a": "ü"}), g(1), g("7"), g(8.0)]
    rows = valid_items(parsed(spark, items)).orderBy("item_index").collect()
    assert [r.posting_id for r in rows] == ["1", "1", "7", "8"]  # duplicates are kept
    assert json.loads(rows[0].payload) == items[0]
    assert rows[0].payload == json.dumps(
        items[0], sort_keys=True, ensure_ascii=False, separators=(",", ":")
    )


@pytest.mark.parametrize(
    ("key", "item", "field"),
    [
        ("greenhouse:acme", without(g(1), "id"), "id"),
        ("greenhouse:acme", g(7.5), "id"),
        ("greenhouse:acme", g("x1"), "id"),
        ("greenhouse:acme", g(None), "id"),
        ("greenhouse:acme", g(1, ""), "title"),
        ("greenhouse:acme", g(1, " \t"), "title"),
        ("greenhouse:acme", g(1, 5), "title"),
        ("greenhouse:acme", g(1, updated_at="yesterday"), "updated_at"),
        ("greenhouse:acme", without(g(1), "updated_at"), "updated_at"),
        ("greenhouse:acme", g(1, absolute_url=""), "absolute_url"),
        ("greenhouse:acme", g(1, location="Toronto"), "location"),
        ("greenhouse:acme", g(1, location={"name": 4}), "location.name"),
        ("greenhouse:acme", g(1, content=["x"]), "content"),
        ("greenhouse:acme", g(1, first_published="soon"), "first_published"),
        ("lever:bolt", lv(5), "id"),
        ("lever:bolt", lv("a", "\n"), "text"),
        ("lever:bolt", lv("a", createdAt="soon"), "createdAt"),
        ("lever:bolt", lv("a", createdAt=1.5), "createdAt"),
        ("lever:bolt", lv("a", categories=None), "categories"),
        ("lever:bolt", lv("a", categories={"team": 1}), "categories.team"),
        ("lever:bolt", lv("a", workplaceType=True), "workplaceType"),
        ("ashby:crow", a("", "x"), "id"),
        ("ashby:crow", a("x", None), "title"),
        ("ashby:crow", a("x", isListed=None), "isListed"),
        ("ashby:crow", a("x", isListed="maybe"), "isListed"),
        ("ashby:crow", a("x", publishedAt=""), "publishedAt"),
        ("ashby:crow", without(a("x"), "jobUrl"), "jobUrl"),
    ],
)
def test_broken_field_is_named(spark, key, item, field):
    (error,) = errors(spark, [item], key)
    assert error and error.split(":")[0] == field and ";" not in error


@pytest.mark.parametrize(
    ("key", "item"),
    [
        ("greenhouse:acme", g(1, location=None, content=None, first_published=None)),
        ("greenhouse:acme", g(" 12 ", updated_at="2026-01-01")),
        ("greenhouse:acme", g(1, updated_at=1_770_000_000)),
        ("greenhouse:acme", without(without(g(1), "location"), "content")),
        ("lever:bolt", lv("a", createdAt="1770000000000")),
        ("lever:bolt", without(lv("a"), "categories")),
        ("lever:bolt", lv("a", categories={"team": None}, workplaceType=None)),
        ("ashby:crow", without(a("x"), "isListed")),
        ("ashby:crow", a("x", isListed="yes", isRemote=None, employmentType=None)),
        ("ashby:crow", a("x", isListed=0)),
    ],
)
def test_lenient_values_are_accepted(spark, key, item):
    assert errors(spark, [item], key) == [None]


def test_several_errors_are_joined_and_ids_kept(spark):
    items = [g(7, "", updated_at="x"), "not an object", None, [1], without(g(1), "id")]
    rows = rejected_items(parsed(spark, items)).orderBy("item_index").collect()
    assert [r.posting_id for r in rows] == ["7", None, None, None, None]
    assert [part.split(":")[0] for part in rows[0].error.split("; ")] == ["title", "updated_at"]
    assert [r.item_index for r in rows] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize(
    ("key", "body", "words"),
    [
        ("lever:bolt", '{"ok": false}', "envelope"),
        ("greenhouse:acme", '{"status": 404}', "envelope"),
        ("greenhouse:acme", '{"jobs": {"a": 1}}', "envelope"),
        ("ashby:crow", "[]", "envelope"),
        ("greenhouse:acme", "<html>maintenance</html>", "not JSON"),
        ("greenhouse:acme", "", "not JSON"),
        ("greenhouse:acme", None, "not JSON"),
    ],
)
def test_unusable_response_keeps_its_body(spark, key, body, words):
    (row,) = parsed(spark, body, key).collect()
    assert words in row.response_error and row.body == body
    assert row.item_index is None and row.error is None and row.payload is None


def test_empty_list_and_failed_request(spark):
    (row,) = parsed(spark, []).collect()
    assert row.response_error is None and row.item_index is None
    (row,) = parsed(spark, None, status=503).collect()
    assert row.response_error == "HTTP 503"
