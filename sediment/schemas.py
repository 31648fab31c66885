"""Explicit schemas for every layer and the single table registry.

Landing documents are read with these schemas (no inference pass): a field that is JSON
``null`` or absent becomes SQL NULL, and sub-objects whose inner shape is never read
(``labels``, ``parents``, ``pull_request``) are kept as raw JSON text.
"""

from __future__ import annotations

from pyspark.sql import types as T

_L, _S, _B = T.LongType(), T.StringType(), T.BooleanType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ACCOUNT = _struct(("id", _L), ("login", _S), ("type", _S), ("html_url", _S))

REPO = _struct(
    ("id", _L), ("name", _S), ("full_name", _S), ("description", _S), ("html_url", _S),
    ("clone_url", _S), ("language", _S), ("stargazers_count", _L), ("watchers_count", _L),
    ("forks_count", _L), ("open_issues_count", _L), ("size", _L), ("created_at", _S),
    ("updated_at", _S), ("pushed_at", _S), ("default_branch", _S), ("owner", ACCOUNT),
    ("license", _struct(("name", _S), ("key", _S))), ("topics", T.ArrayType(_S)),
    ("archived", _B), ("disabled", _B), ("private", _B), ("fork", _B),
)

_PERSON = _struct(("name", _S), ("email", _S), ("date", _S))
COMMIT = _struct(
    ("sha", _S), ("node_id", _S), ("html_url", _S), ("comments_url", _S),
    ("commit", _struct(
        ("message", _S), ("url", _S), ("comment_count", _L), ("author", _PERSON),
        ("committer", _PERSON), ("tree", _struct(("sha", _S))),
        ("verification", _struct(("verified", _B), ("reason", _S))))),
    ("author", ACCOUNT), ("committer", ACCOUNT), ("parents", T.ArrayType(_S)),
)

ISSUE = _struct(
    ("id", _L), ("node_id", _S), ("number", _L), ("title", _S), ("body", _S), ("state", _S),
    ("locked", _B), ("comments", _L), ("created_at", _S), ("updated_at", _S),
    ("closed_at", _S), ("author_association", _S), ("active_lock_reason", _S),
    ("html_url", _S), ("url", _S), ("assignee", ACCOUNT), ("user", ACCOUNT),
    ("milestone", _struct(("id", _L), ("title", _S), ("description", _S), ("state", _S))),
    ("labels", T.ArrayType(_S)), ("pull_request", _S),
)

# Payload of each feed inside the envelope.
FEED_PAYLOAD = {
    "repositories": _struct(("repositories", T.ArrayType(REPO))),
    "repo_details": REPO,
    "commits": _struct(("commits", T.ArrayType(COMMIT))),
    "issues": _struct(("issues", T.ArrayType(ISSUE))),
}

FEEDS = ("repositories", "repo_details", "commits", "issues")


def envelope(feed: str) -> T.StructType:
    """Landing document: ``{ingestion_timestamp, data}`` plus the reader's corrupt-record slot."""
    return _struct(("ingestion_timestamp", _S), ("data", FEED_PAYLOAD[feed]),
                   ("_corrupt_record", _S))


# Table registry: one list used by the builders, the summaries and the quality checks.
BRONZE_TABLES = ("repositories", "repo_details", "commits", "issues")
SILVER_TABLES = ("dim_repositories", "dim_users", "dim_repo_permissions",
                 "fact_commits", "fact_issues", "fact_pull_requests")

# Bronze natural keys, used to keep the newest landing of each record.
BRONZE_KEYS = {
    "repositories": ["repo_id"],
    "repo_details": ["repo_id"],
    "commits": ["commit_sha"],
    "issues": ["issue_id"],
}

LOAD_TS = ("bronze_ingestion_timestamp", "silver_ingestion_timestamp")
