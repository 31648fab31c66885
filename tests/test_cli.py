"""Command line steps on API-style landing files."""

import json
import os

from sediment.__main__ import main


def test_bronze_then_silver(spark, tmp_path, capsys):
    landing = tmp_path / "landing"
    os.makedirs(landing)
    acct = {"id": 1, "login": "u1", "type": "User", "html_url": "https://github.com/u1"}
    repo = {"id": 1, "name": "r", "owner": acct, "stargazers_count": 2000}
    docs = {"repositories_20240601_000000.json": {"repositories": [repo]},
            "repo_details_u1_r_20240601_000000.json": repo,
            "commits_u1_r_20240601_000000.json": {"commits": [
                {"sha": "a", "html_url": "https://github.com/u1/r/commit/a", "author": acct}]},
            "issues_u1_r_20240601_000000.json": {"issues": [
                {"id": 5, "html_url": "https://github.com/u1/r/issues/5", "user": acct,
                 "pull_request": {"url": "x"}}]}}
    for name, data in docs.items():
        (landing / name).write_text(json.dumps({"ingestion_timestamp": "2024-06-01T00:00:00",
                                                "data": data}, indent=2))
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    assert main(["bronze", "--landing", str(landing), "--bronze", bronze], spark=spark) == 0
    assert main(["silver", "--bronze", bronze, "--silver", silver], spark=spark) == 0
    out = capsys.readouterr().out
    assert "fact_pull_requests" in out
    pr = spark.read.parquet(f"{silver}/fact_pull_requests").first()
    assert pr.pr_id == 5 and pr.repo_id == 1
    fc = spark.read.parquet(f"{silver}/fact_commits").first()
    assert fc.repo_id == 1 and fc.repo_name == "r"
    # owner, issue user and commit author share one identity (the commit has no e-mail)
    users = spark.read.parquet(f"{silver}/dim_users").collect()
    assert len(users) == 1 and users[0].user_roles == ["author", "issue_user", "owner"]
