"""Silver layer: three dimensions and three facts, each a ``DataFrame -> DataFrame`` builder.

Inputs are bronze-shaped frames (see ``schemas``).  ``loaded_at`` pins the load-time stamp
(tests, reproducible runs); by default it is ``current_timestamp()``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.functions import rules as R
from sediment.operators.colocate import colocated, join_columns
from sediment.operators.identity import MAX_IDS, people
from sediment.operators.joins import HOT_ROWS, fanout_left_join, left_join_keys
from sediment.operators.merge import merge_coalesce
from sediment.operators.roles import role_masks, role_union, with_roles
from sediment.session import scratch_path
from sediment.sources.tables import save_bucketed, write_parquet

REPO_COLUMNS = [
    "repo_id", "repo_name", "full_name", "description", "html_url", "clone_url", "language",
    "stars", "watchers", "forks", "open_issues", "size", "created_at", "updated_at",
    "pushed_at", "default_branch", "owner_id", "owner_login", "owner_type", "owner_url",
    "license_name", "license_key", "topics", "archived", "disabled", "private", "fork",
]


def _stamp(loaded_at: Column | None) -> Column:
    return (loaded_at if loaded_at is not None else F.current_timestamp()).alias(
        "silver_ingestion_timestamp")


# One merge, two dimensions ----------------------------------------------------------
def repo_merge(repos: DataFrame, details: DataFrame, drop_null_keys: bool = False) -> DataFrame:
    """Full outer merge of search hits and details (left wins) with both load-time variants.

    ``_loaded_latest`` is the later stamp of both sides (T1's rule), ``_loaded_first`` the
    left stamp when present (T3's rule).  Both dimensions can be derived from this one frame,
    so ``build_silver`` runs the join once when it builds both.
    """
    ts = "bronze_ingestion_timestamp"
    cols = {c: c for c in REPO_COLUMNS}
    r = repos.withColumns({"_loaded_latest": F.col(ts), "_loaded_first": F.col(ts)})
    d = details.withColumns({"_loaded_latest": F.col(ts), "_loaded_first": F.col(ts)})
    cols.update({"_loaded_latest": "_loaded_latest", "_loaded_first": "_loaded_first"})
    return merge_coalesce(r, d, ["repo_id"], cols, greatest=["_loaded_latest"],
                          drop_null_keys=drop_null_keys)


def dim_repositories_from_merge(merged: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Keyed rows only, defaults and categories."""
    defaults = R.repo_defaults()
    derived = merged.where(F.col("repo_id").isNotNull()).select(
        *[defaults.get(c, F.col(c)).alias(c) for c in REPO_COLUMNS],
        F.col("_loaded_latest").alias("bronze_ingestion_timestamp"),
        R.popularity_category(F.col("stars")).alias("popularity_category"),
        R.language_category(F.col("language")).alias("language_category"),
    )
    order = ["repo_id", "repo_name", "full_name", "description", "html_url", "clone_url",
             "language", "language_category", "stars", "watchers", "forks", "open_issues",
             "size", "created_at", "updated_at", "pushed_at", "default_branch", "owner_id",
             "owner_login", "owner_type", "owner_url", "license_name", "license_key", "topics",
             "archived", "disabled", "private", "fork", "popularity_category",
             "bronze_ingestion_timestamp"]
    return derived.select(*order, _stamp(loaded_at))


def dim_repositories(repos: DataFrame, details: DataFrame,
                     loaded_at: Column | None = None) -> DataFrame:
    """Search hits merged with details (left wins), keyed rows only, defaults and categories.

    Standalone, NULL keys are removed before the join (the filter reaches the scans).
    """
    return dim_repositories_from_merge(repo_merge(repos, details, drop_null_keys=True), loaded_at)


PERMISSION_COLUMNS = {
    "repo_id": "repo_id", "repo_name": "repo_name", "full_name": "full_name",
    "owner_id": "owner_id", "owner_login": "owner_login", "owner_type": "owner_type",
    "private": "is_private", "archived": "is_archived", "disabled": "is_disabled",
    "fork": "is_fork", "language": "primary_language", "stars": "stargazers_count",
    "watchers": "watchers_count", "forks": "forks_count", "open_issues": "open_issues_count",
    "created_at": "created_at", "updated_at": "updated_at", "pushed_at": "pushed_at",
}


def dim_repo_permissions_from_merge(merged: DataFrame,
                                    loaded_at: Column | None = None) -> DataFrame:
    """Renamed merge columns with access rules (T3); NULL-keyed rows survive."""
    base = merged.select(*[F.col(src).alias(dst) for src, dst in PERMISSION_COLUMNS.items()],
                         F.col("_loaded_first").alias("bronze_ingestion_timestamp"))
    return base.select(
        *PERMISSION_COLUMNS.values(),
        R.visibility_level().alias("visibility_level"),
        R.repository_status().alias("repository_status"),
        R.popularity_tier().alias("popularity_tier"),
        R.fork_activity_level().alias("fork_activity_level"),
        R.issue_volume_level().alias("issue_volume_level"),
        R.duration_seconds("updated_at", "created_at").alias("repository_age_seconds"),
        R.duration_seconds("pushed_at", "updated_at").alias("last_activity_seconds"),
        R.access_level().alias("access_level"),
        R.maturity_level().alias("maturity_level"),
        "bronze_ingestion_timestamp",
        _stamp(loaded_at),
    )


def dim_repo_permissions(repos: DataFrame, details: DataFrame,
                         loaded_at: Column | None = None) -> DataFrame:
    """Same merge (no key filter: NULL-keyed rows survive), renamed, with access rules."""
    return dim_repo_permissions_from_merge(repo_merge(repos, details), loaded_at)


# T2 ------------------------------------------------------------------------------------------
def dim_users(repos: DataFrame, commits: DataFrame, issues: DataFrame,
              loaded_at: Column | None = None, grain: str = "identity",
              max_ids: int = MAX_IDS) -> DataFrame:
    """Everyone who owns, authors, commits, opens or is assigned.

    ``grain``: ``identity``, one row per (id, login, type, url, e-mail, name); ``user``, one row
    per id; ``person``, one row per set of ids linked by login or e-mail (``operators.identity``).
    The coarser grains name the smallest id with the login, type and URL of its first identity,
    and the smallest e-mail and name that are not blank, and count what they stand for.
    """
    return dim_users_of(role_masks(role_union(repos, commits, issues)), loaded_at, grain, max_ids)


def dim_users_of(identities: DataFrame, loaded_at: Column | None = None, grain: str = "identity",
                 max_ids: int = MAX_IDS) -> DataFrame:
    """``dim_users`` from identities with role masks (``role_masks``)."""
    if grain not in ("identity", "user", "person"):
        raise ValueError("grain must be 'identity', 'user' or 'person'")
    d = R.user_defaults()
    rules = [d["user_email"].alias("user_email"), d["user_name"].alias("user_name"), "user_roles", "role_count",
             R.primary_role().alias("primary_role"), R.user_activity_level().alias("user_activity_level")]
    if grain == "identity":
        return with_roles(identities).select("user_id", "user_login", d["user_type"].alias("user_type"),
                                             "user_html_url", *rules, _stamp(loaded_at))
    # One row per identity: what a hot user brings to one key is bounded by its spellings.
    person = F.col("user_id")
    if grain == "person":
        path = write_parquet(identities, scratch_path(identities.sparkSession, "identities"))
        identities = identities.sparkSession.read.parquet(path)
        known = people(identities, max_ids).withColumnRenamed("user_id", "_id")
        identities = identities.join(known, F.col("user_id") == F.col("_id"), "left").drop("_id")
        person = F.coalesce("person_id", "user_id")
    filled = {c: F.when(F.trim(c) != "", F.col(c)) for c in ("user_email", "user_name")}
    order = ["user_id", "user_login", "user_type", "user_html_url"]
    first = F.min(F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]))
    merged = identities.withColumn("_person", person).groupBy("_person").agg(
        first.alias("_first"), F.bit_or("_mask").alias("_mask"), F.count(F.lit(1)).alias("identity_count"),
        F.count_distinct("user_id").alias("id_count"),
        *[F.min(v).alias(c) for c, v in filled.items()]).select("*", "_first.*")
    return with_roles(merged).select("user_id", "user_login", d["user_type"].alias("user_type"), "user_html_url",
                                     *rules, "identity_count", "id_count", _stamp(loaded_at))


# T4 ------------------------------------------------------------------------------------------
COMMIT_COLUMNS = [
    "commit_sha", "node_id", "message", "author_name", "author_email", "author_date",
    "committer_name", "committer_email", "committer_date", "tree_sha", "commit_url",
    "comment_count", "verification_verified", "verification_reason", "html_url",
    "comments_url", "author_id", "author_login", "author_type", "author_html_url",
    "committer_id", "committer_login", "committer_type", "committer_html_url", "parents",
]


def with_url_repo(df: DataFrame, url: str = "html_url") -> DataFrame:
    """Adds the owner / repository coordinates named by a URL (``''`` when it names none)."""
    return df.withColumns({"_url_owner": R.url_repo_owner(url), "_url_repo": R.url_repo_name(url)})


def fact_commits(commits: DataFrame, repos: DataFrame, loaded_at: Column | None = None,
                 join: Callable[..., DataFrame] = left_join_keys) -> DataFrame:
    keyed = with_url_repo(commits.where(F.col("commit_sha").isNotNull()))
    joined = join(keyed, repos, ["_url_owner", "_url_repo"], ["owner_login", "repo_name"],
                            {"repo_id": "repo_id", "repo_name": "repo_name",
                             "full_name": "repo_full_name", "language": "repo_language",
                             "stars": "repo_stars", "forks": "repo_forks"})
    return joined.select(
        *COMMIT_COLUMNS,
        "repo_id", "repo_name", "repo_full_name", "repo_language", "repo_stars", "repo_forks",
        R.length_category("message").alias("message_length_category"),
        R.commit_type("message").alias("commit_type"),
        R.verification_status().alias("verification_status"),
        R.duration_seconds("committer_date", "author_date").alias("commit_delay_seconds"),
        "bronze_ingestion_timestamp",
        _stamp(loaded_at),
    )


# T5 ------------------------------------------------------------------------------------------
ISSUE_COLUMNS = [
    "issue_id", "node_id", "issue_number", "title", "body", "state", "locked", "assignee_id",
    "assignee_login", "assignee_type", "assignee_html_url", "user_id", "user_login",
    "user_type", "user_html_url", "labels", "milestone_id", "milestone_title",
    "milestone_description", "milestone_state", "comments_count", "created_at", "updated_at",
    "closed_at", "author_association", "active_lock_reason", "pull_request", "html_url", "url",
]


def fact_issues(issues: DataFrame, repos: DataFrame, loaded_at: Column | None = None,
                join: Callable[..., DataFrame] = left_join_keys) -> DataFrame:
    keyed = with_url_repo(issues.where(F.col("issue_id").isNotNull()))
    joined = join(keyed, repos, ["_url_owner", "_url_repo"], ["owner_login", "repo_name"],
                            {"repo_id": "repo_id", "repo_name": "repo_name",
                             "full_name": "repo_full_name", "language": "repo_language",
                             "stars": "repo_stars", "forks": "repo_forks",
                             "open_issues": "repo_open_issues"})
    return joined.select(
        *ISSUE_COLUMNS,
        "repo_id", "repo_name", "repo_full_name", "repo_language", "repo_stars", "repo_forks",
        "repo_open_issues",
        R.length_category("title").alias("title_length_category"),
        R.body_length_category("body").alias("body_length_category"),
        R.issue_status().alias("issue_status"),
        R.assignment_status().alias("assignment_status"),
        R.milestone_status().alias("milestone_status"),
        R.issue_type().alias("issue_type"),
        R.duration_seconds("closed_at", "created_at").alias("resolution_time_seconds"),
        R.activity_level().alias("activity_level"),
        "bronze_ingestion_timestamp",
        _stamp(loaded_at),
    )


def store_colocated(facts: DataFrame, repos: DataFrame, name: str, row_key: str, schema: str,
                    path: str, buckets: int = 64, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Bronze facts, and the repositories their URLs name, as tables bucketed for ``fact_commits`` and
    ``fact_issues`` with ``join=colocated_left_join``; the two tables."""
    spark, keys = facts.sparkSession, join_columns(2)
    f, r = colocated(with_url_repo(facts), repos, ["_url_owner", "_url_repo"], ["owner_login", "repo_name"],
                     row_key, hot_rows)
    return tuple(spark.table(save_bucketed(df, t, schema, f"{path.rstrip('/')}/{t}", keys, buckets))
                 for df, t in ((f, name), (r, f"repositories_of_{name}")))


# T6 ------------------------------------------------------------------------------------------
PR_RENAMES = {"issue_id": "pr_id", "issue_number": "pr_number", "user_id": "author_id",
              "user_login": "author_login", "user_type": "author_type",
              "user_html_url": "author_html_url"}
PR_REPO_COLUMNS = {"repo_id": "repo_id", "repo_name": "repo_name", "full_name": "full_name",
                   "owner_id": "owner_id", "owner_login": "owner_login"}


def fact_pull_requests(issues: DataFrame, repos: DataFrame, repo_by: str = "owner",
                       hot_rows: int = HOT_ROWS, loaded_at: Column | None = None) -> DataFrame:
    """Pull requests (issues with a ``pull_request`` object) with repository columns.

    ``repo_by="owner"`` is the stated rule: every repository *owned by the author* is
    attached, so a pull request fans out to one row per owned repository (and keeps one row
    with NULLs when the author owns none).  One owner may hold a large share of all repositories:
    owners with more than ``hot_rows`` of them are measured, and only theirs are dealt over
    several tasks.  ``repo_by="url"`` attaches the repository named by the pull request's URL
    instead.
    """
    prs = issues.where(F.col("pull_request").isNotNull()).withColumnsRenamed(PR_RENAMES)
    if repo_by == "owner":
        joined = fanout_left_join(prs, repos, "author_id", "owner_id", PR_REPO_COLUMNS,
                                  hot_rows=hot_rows)
    elif repo_by == "url":
        joined = left_join_keys(with_url_repo(prs), repos, ["_url_owner", "_url_repo"],
                                ["owner_login", "repo_name"], PR_REPO_COLUMNS)
    else:
        raise ValueError(f"repo_by must be 'owner' or 'url', not {repo_by!r}")
    cols = [PR_RENAMES.get(c, c) for c in ISSUE_COLUMNS]
    return joined.select(
        *[F.coalesce(F.col("body"), F.lit("")).alias("body") if c == "body" else F.col(c)
          for c in cols],
        *PR_REPO_COLUMNS.values(),
        R.duration_seconds("closed_at", "created_at").alias("resolution_time_seconds"),
        R.is_resolved().alias("is_resolved"),
        R.presence_flag("assignee_id").alias("is_assigned"),
        R.presence_flag("milestone_id").alias("has_milestone"),
        R.has_items("labels").alias("has_labels"),
        "bronze_ingestion_timestamp",
        _stamp(loaded_at),
    )


# Registry: silver table -> (builder, bronze inputs in argument order).
BUILDERS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "dim_repositories": (dim_repositories, ("repositories", "repo_details")),
    "dim_users": (dim_users, ("repositories", "commits", "issues")),
    "dim_repo_permissions": (dim_repo_permissions, ("repositories", "repo_details")),
    "fact_commits": (fact_commits, ("commits", "repositories")),
    "fact_issues": (fact_issues, ("issues", "repositories")),
    "fact_pull_requests": (fact_pull_requests, ("issues", "repositories")),
}
