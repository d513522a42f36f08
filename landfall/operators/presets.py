"""Ready shapings for the tables of a support desk: issues, their messages, and the
directories (people, teams, accounts) around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from landfall.contract import Resource
from landfall.operators.shape import shape

# The nested values that become columns, and the timestamp fields.
ISSUE_PROMOTIONS = {
    "account.id": "account_id",
    "assignee.id": "assignee_id",
    "assignee.email": "assignee_email",
    "requester.id": "requester_id",
    "requester.email": "requester_email",
    "team.id": "team_id",
}
ISSUE_TIMESTAMPS = (
    "created_at", "updated_at", "latest_message_time", "resolution_time", "snoozed_until_time",
)
DIRECTORY_TIMESTAMPS = ("created_at", "updated_at", "latest_customer_message_time")
MESSAGE_TIMESTAMPS = ("timestamp",)
MESSAGE_HTML = {"message_html": "message_text"}


def _preset(name: str, timestamps: tuple[str, ...], **settings) -> Resource:
    return Resource(
        name, ("id",), timestamp_columns=timestamps, hint_columns=timestamps, **settings
    )


ISSUE = _preset("issues", ISSUE_TIMESTAMPS, soft_delete="full_history", promote=ISSUE_PROMOTIONS)
DIRECTORY = _preset("directory", DIRECTORY_TIMESTAMPS, soft_delete="always")
MESSAGE = _preset("issue_messages", MESSAGE_TIMESTAMPS, html_text=MESSAGE_HTML)


def shape_messages(messages: DataFrame, issue_id: Column) -> DataFrame:
    """Messages do not say which issue they belong to; the join that found them does."""
    return messages.withColumn("issue_id", issue_id).transform(shape(MESSAGE))
