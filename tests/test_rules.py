"""Boundary tables for the derived-column rules: bound - 1, bound, bound + 1, NULL, blank."""

import pytest
from pyspark.sql import functions as F

from sediment.functions import rules as R


def evaluate(spark, values, expr, dtype="bigint"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_popularity_strict(spark):
    vals = [None, 0, 100, 101, 1000, 1001, 10000, 10001]
    assert evaluate(spark, vals, R.popularity_category) == [
        "Less Popular", "Less Popular", "Less Popular", "Moderately Popular",
        "Moderately Popular", "Popular", "Popular", "Very Popular"]


def test_popularity_inclusive_differs_at_bounds(spark):
    vals = [None, 9, 10, 99, 100, 999, 1000, 9999, 10000]
    assert evaluate(spark, vals, R.popularity_tier) == [
        "Less Popular", "Less Popular", "Somewhat Popular", "Somewhat Popular",
        "Moderately Popular", "Moderately Popular", "Popular", "Popular", "Very Popular"]


def test_fork_and_issue_levels(spark):
    assert evaluate(spark, [None, 9, 10, 99, 100, 999, 1000], R.fork_activity_level) == [
        "Minimal Fork Activity", "Minimal Fork Activity", "Low Fork Activity",
        "Low Fork Activity", "Moderate Fork Activity", "Moderate Fork Activity",
        "High Fork Activity"]
    assert evaluate(spark, [9, 10, 49, 50, 99, 100], R.issue_volume_level) == [
        "Minimal Issue Volume", "Low Issue Volume", "Low Issue Volume",
        "Moderate Issue Volume", "Moderate Issue Volume", "High Issue Volume"]


def test_comment_activity(spark):
    assert evaluate(spark, [None, 0, 1, 10, 11, 20, 21], R.activity_level) == [
        "No Activity", "No Activity", "Low Activity", "Low Activity", "Medium Activity",
        "Medium Activity", "High Activity"]


def test_length_buckets(spark):
    lengths = [None, 0, 50, 51, 100, 101, 500, 501, 1000, 1001]
    texts = [None if n is None else "x" * n for n in lengths]
    assert evaluate(spark, texts, R.length_category, "string") == [
        "Short", "Short", "Short", "Medium", "Medium", "Long", "Long", "Long", "Long", "Long"]
    assert evaluate(spark, texts, R.body_length_category, "string") == [
        "Empty", "Empty", "Short", "Short", "Short", "Short", "Short", "Medium", "Medium", "Long"]


def test_length_counts_code_points(spark):
    assert evaluate(spark, ["é" * 51], R.length_category, "string") == ["Medium"]


def test_commit_type_is_case_sensitive_substring(spark):
    msgs = ["Fix x", "prefix", "latest", "docker", "fix test", None, "add feature", "style it",
            "refactor a", "plain"]
    assert evaluate(spark, msgs, R.commit_type, "string") == [
        "Other", "Bug Fix", "Test", "Documentation", "Bug Fix", "Other", "Feature", "Style",
        "Refactor", "Other"]


def test_verification_tristate(spark):
    assert evaluate(spark, [True, False, None], R.verification_status, "boolean") == [
        "Verified", "Unverified", "Unknown"]


def test_url_extraction(spark):
    urls = ["https://github.com/o/r/commit/abc", "https://github.com/o/r",
            "https://gitlab.com/o/r/x", None]
    assert evaluate(spark, urls, R.url_repo_owner, "string") == ["o", "", "", None]
    assert evaluate(spark, urls, R.url_repo_name, "string") == ["r", "", "", None]


def test_durations(spark):
    df = spark.createDataFrame(
        [("2024-01-01T00:00:00Z", "2024-01-01T01:00:00Z"), (None, "2024-01-01T00:00:00Z"),
         ("2024-01-02T00:00:00Z", "2024-01-01T00:00:00Z"), ("not a time", "2024-01-01T00:00:00Z")],
        "a string, b string")
    out = [r[0] for r in df.select(R.duration_seconds("b", "a")).collect()]
    assert out == [3600, None, -86400, None]


def test_blank_defaults(spark):
    df = spark.createDataFrame([(None,), ("",), ("   ",), ("\t",), ("  x  ",)], "user_email string")
    df = df.withColumns({"user_type": F.lit(None).cast("string"), "user_name": F.col("user_email")})
    d = R.user_defaults()
    rows = df.select(d["user_email"], d["user_name"], d["user_type"]).collect()
    assert [r[0] for r in rows] == ["No email available"] * 3 + ["\t", "  x  "]
    assert [r[1] for r in rows] == ["No name available"] * 3 + ["\t", "x"]
    assert {r[2] for r in rows} == {"User"}


@pytest.mark.parametrize("archived,disabled,stars,forks,expected", [
    (True, True, 5000, 500, "Archived"), (None, True, 5000, 500, "Disabled"),
    (False, False, 1000, 100, "Mature"), (False, False, 1000, 99, "Developing"),
    (False, False, 100, 10, "Developing"), (False, False, 100, 9, "Growing"),
    (False, False, 10, 0, "Growing"), (False, False, 9, 1000, "Early Stage"),
    (None, None, None, None, "Early Stage"),
])
def test_maturity(spark, archived, disabled, stars, forks, expected):
    df = spark.createDataFrame([(archived, disabled, stars, forks)],
                               "is_archived boolean, is_disabled boolean, "
                               "stargazers_count bigint, forks_count bigint")
    assert df.select(R.maturity_level()).first()[0] == expected


def test_status_and_access_priority(spark):
    df = spark.createDataFrame(
        [(True, True, True, True), (False, True, True, True), (None, None, True, True),
         (None, None, None, True), (None, None, None, None)],
        "is_private boolean, is_archived boolean, is_disabled boolean, is_fork boolean")
    rows = df.select(R.repository_status(), R.access_level(), R.visibility_level()).collect()
    assert [r[0] for r in rows] == ["Archived", "Archived", "Disabled", "Fork", "Active"]
    assert [r[1] for r in rows] == ["Restricted Access", "Read-Only Access", "No Access",
                                    "Open Access", "Open Access"]
    assert [r[2] for r in rows] == ["Private", "Public", "Public", "Public", "Public"]


def test_roles(spark):
    df = spark.createDataFrame(
        [(["owner"],), (["assignee", "issue_user", "owner"],), (["author", "committer"],),
         (["author"],), (["committer"],), (["issue_user"],), (["assignee"],), ([],)],
        "user_roles array<string>").withColumn("role_count", F.size("user_roles"))
    rows = df.select(R.primary_role(), R.user_activity_level()).collect()
    assert [r[0] for r in rows] == ["Repository Owner", "Repository Owner", "Active Contributor",
                                    "Code Author", "Code Committer", "Issue Participant",
                                    "Issue Assignee", "Other"]
    assert [r[1] for r in rows][:3] == ["Single-role User", "Multi-role User", "Dual-role User"]


def test_labels_flag_guards_null(spark):
    df = spark.createDataFrame([(None,), ([],), (["x"],)], "labels array<string>")
    assert [r[0] for r in df.select(R.has_items()).collect()] == [0, 0, 1]


def test_no_python_in_rule_plans(spark, capsys):
    df = spark.createDataFrame([("fix", 5)], "message string, stars bigint")
    df.select(R.commit_type(), R.popularity_category("stars")).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "ArrowEval" not in plan
