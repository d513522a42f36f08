"""The ready shapings."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from landfall.operators.presets import DIRECTORY, ISSUE, shape_messages
from landfall.operators.shape import shape

T = datetime(2024, 1, 1)


def test_issues_promote_who_is_involved(spark):
    person = "struct<id: string, email: string>"
    issues = spark.createDataFrame(
        [("i1", ("a",), ("u", "u@x"), None, None, "2024-01-01T00:00:00Z", "")],
        f"id string, account struct<id: string>, assignee {person}, requester {person}, "
        "team struct<id: string>, created_at string, resolution_time string",
    )
    row = issues.transform(shape(ISSUE)).first()
    assert (row.account_id, row.assignee_id, row.assignee_email) == ("a", "u", "u@x")
    assert (row.requester_id, row.requester_email, row.team_id) == (None, None, None)
    assert (row.created_at, row.resolution_time, row._deleted) == (T, None, False)
    assert json.loads(row.assignee) == {"id": "u", "email": "u@x"}


def test_directories_are_live_unless_the_source_says_otherwise(spark):
    people = spark.createDataFrame(
        [("p", "2024-01-01", True)], "id string, updated_at string, _deleted boolean")
    row = people.transform(shape(DIRECTORY)).first()
    assert (row.updated_at, row._deleted) == (T, True)


def test_messages_get_their_issue_and_their_text(spark):
    messages = spark.createDataFrame(
        [("m", "<p>Hi</p>", 1704067200), ("n", "", None)],
        "id string, message_html string, timestamp bigint")
    rows = sorted(shape_messages(messages, F.lit("i1")).collect())
    assert [(r.issue_id, r.message_text, r.timestamp) for r in rows] == [
        ("i1", "Hi", T), ("i1", None, None)]
    assert "_deleted" not in rows[0]
