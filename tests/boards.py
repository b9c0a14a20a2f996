"""Synthetic boards for the tests: what is listed when, and the responses that say so."""

from __future__ import annotations

import json
from datetime import date, timedelta

from tidelist.schemas import BOARDS

DAYS = [date(2026, 3, 2) + timedelta(weeks=i) for i in range(4)]
KEYS = ["greenhouse:acme", "lever:bolt", "ashby:crow"]
RESPONSES = "source string, board string, snapshot_date date, http_status int, body string"


def boards(spark, *extra):
    rows = [(*key.split(":"), f"{key} Inc", False, None) for key in KEYS]
    return spark.createDataFrame([*rows, *extra], BOARDS)


def g(i, title="Software Engineer", **more):
    return {
        "id": i,
        "title": title,
        "updated_at": "2026-03-01T08:00:00-05:00",
        "absolute_url": f"https://example.invalid/g/{i}",
        "location": {"name": "Toronto, CA"},
        "content": "&lt;p&gt;Modern C++ &amp;amp; python&lt;/p&gt;",
        "first_published": "2026-02-01T00:00:00Z",
        "departments": [{"name": "R&D"}],
        **more,
    }


def lv(i, text="Data Engineer", **more):
    return {
        "id": i,
        "text": text,
        "createdAt": 1_770_000_000_000,
        "hostedUrl": f"https://example.invalid/l/{i}",
        "categories": {"location": "Remote - Canada", "commitment": "Full-time", "team": "Data"},
        "descriptionPlain": "SQL and",
        "lists": [{"text": "x", "content": "<li>dbt</li>"}, {"content": "<li>Kafka</li>"}],
        "additionalPlain": "Airflow",
        **more,
    }


def a(i, title="Product Designer", **more):
    return {
        "id": i,
        "title": title,
        "publishedAt": "2026-02-03T04:05:06.789+00:00",
        "jobUrl": f"https://example.invalid/a/{i}",
        "isListed": True,
        "location": "Berlin, Germany",
        "employmentType": "FullTime",
        "descriptionHtml": "<p>Figma</p>",
        **more,
    }


def listing(day_number: int) -> dict[str, list | int]:
    """Items per board on a day, or the status of a failed request."""
    acme = [g(1), g(11), g(12)]
    if day_number in (1, 2):
        acme.append(g(2, "Software Engineering Intern"))
    if day_number in (0, 2, 3):
        acme.append(g(3, "QA Analyst"))
    if day_number == 1:
        acme += [g(4, "Account Executive"), g(4, "Account Executive")]
    acme.append(g(5, "ML Engineer" if day_number < 2 else "Senior ML Engineer"))
    bolt = [lv(f"f{i}") for i in range(6)]
    if day_number in (1, 3):
        bolt.append(lv("b1", "Analytics Engineer"))
    bolt.append(lv("b2", "  " if day_number == 3 else "Platform Engineer"))
    crow = [a(f"c{i}") for i in range(5)] + [a("hidden", "Secret Role", isListed=False)]
    crow.append(a("bad", "\t"))
    return {
        KEYS[0]: acme,
        KEYS[1]: 500 if day_number == 2 else bolt,
        KEYS[2]: crow,
    }


def body(key: str, items: list) -> str:
    return json.dumps(items if key.startswith("lever") else {"jobs": items})


def response_rows(day_numbers, edit=None):
    rows = []
    for n in day_numbers:
        for key, items in listing(n).items():
            if edit:
                items = edit(n, key, items)
            if items is None:
                continue
            failed = isinstance(items, int)
            rows.append(
                (
                    *key.split(":"),
                    DAYS[n],
                    items if failed else 200,
                    None if failed else items if isinstance(items, str) else body(key, items),
                )
            )
    return rows


def responses(spark, day_numbers=range(4), edit=None):
    return spark.createDataFrame(response_rows(day_numbers, edit), RESPONSES)


def one_board(spark, items, day=DAYS[0], key="greenhouse:acme", status=200):
    text = items if isinstance(items, (str, type(None))) else body(key, items)
    return spark.createDataFrame([(*key.split(":"), day, status, text)], RESPONSES)


def brute_force_spells(days_ok: dict, parsed: dict, unparsed: dict) -> set[tuple]:
    """(key, first, last, closed, observed, unparsed) by walking the days one by one."""
    found = set()
    for key, parsed_days in parsed.items():
        group = key.rsplit(":", 1)[0]
        listed = parsed_days | unparsed.get(key, set())
        run = []
        for day in [*sorted(days_ok.get(group, ())), None]:
            if day is not None and day in listed:
                run.append(day)
                continue
            if run and parsed_days & set(run):
                missing = sum(d not in parsed_days for d in run)
                found.add((key, run[0], run[-1], day, len(run), missing))
            run = []
    return found
