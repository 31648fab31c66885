"""Derived-column rules of the silver layer, as pure ``Column`` functions.

Every rule is a ``CASE`` ladder (first match wins; a NULL operand makes a branch false, so
NULL falls through to the default unless a rule says otherwise).  All of them compile to
JVM expressions inside whole-stage codegen; there is no Python on the row path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = Column | str

# ---------------------------------------------------------------------------------------------
# Labels, thresholds, defaults and patterns that must equal the reference's
# outputs.  Kept together, in the order the rules test them.
# ---------------------------------------------------------------------------------------------
POPULARITY_STRICT = [(10000, "Very Popular"), (1000, "Popular"), (100, "Moderately Popular")]
POPULARITY_STRICT_ELSE = "Less Popular"
POPULARITY_TIERS = [(10000, "Very Popular"), (1000, "Popular"), (100, "Moderately Popular"),
                    (10, "Somewhat Popular")]
POPULARITY_TIERS_ELSE = "Less Popular"
FORK_ACTIVITY = [(1000, "High Fork Activity"), (100, "Moderate Fork Activity"),
                 (10, "Low Fork Activity")]
FORK_ACTIVITY_ELSE = "Minimal Fork Activity"
ISSUE_VOLUME = [(100, "High Issue Volume"), (50, "Moderate Issue Volume"),
                (10, "Low Issue Volume")]
ISSUE_VOLUME_ELSE = "Minimal Issue Volume"
COMMENT_ACTIVITY = [(20, "High Activity"), (10, "Medium Activity"), (0, "Low Activity")]
COMMENT_ACTIVITY_ELSE = "No Activity"
TEXT_LENGTH = [(100, "Long"), (50, "Medium")]
TEXT_LENGTH_ELSE = "Short"
BODY_LENGTH = [(1000, "Long"), (500, "Medium"), (0, "Short")]
BODY_LENGTH_ELSE = "Empty"
LANGUAGES_KEPT = ["Python", "JavaScript", "Java", "C++", "C#"]
LANGUAGE_OTHER = "Other"
COMMIT_KEYWORDS = [(["fix", "bug"], "Bug Fix"), (["feat", "feature"], "Feature"),
                   (["refactor"], "Refactor"), (["test"], "Test"), (["doc"], "Documentation"),
                   (["style"], "Style")]
COMMIT_KEYWORDS_ELSE = "Other"
ISSUE_STATES = [("open", "Open"), ("closed", "Closed")]
ISSUE_STATES_ELSE = "Unknown"
VERIFICATION = ("Verified", "Unverified", "Unknown")
REPO_STATUS = [("archived", "Archived"), ("disabled", "Disabled"), ("fork", "Fork")]
REPO_STATUS_ELSE = "Active"
ACCESS_LEVEL = [("private", "Restricted Access"), ("archived", "Read-Only Access"),
                ("disabled", "No Access")]
ACCESS_LEVEL_ELSE = "Open Access"
VISIBILITY = ("Private", "Public")
ROLE_PRIORITY = [(("owner",), "Repository Owner"), (("author", "committer"), "Active Contributor"),
                 (("author",), "Code Author"), (("committer",), "Code Committer"),
                 (("issue_user",), "Issue Participant"), (("assignee",), "Issue Assignee")]
ROLE_PRIORITY_ELSE = "Other"
ROLE_COUNT = ("Multi-role User", "Dual-role User", "Single-role User")
ASSIGNMENT = ("Assigned", "Unassigned")
MILESTONE = ("Has Milestone", "No Milestone")
ISSUE_TYPE = ("Pull Request", "Issue")
REPO_DEFAULTS = {
    "description": "No description available", "language": "Unknown",
    "time": "1900-01-01T00:00:00Z", "default_branch": "main", "owner_type": "User",
    "license_name": "No License", "license_key": "none",
}
USER_DEFAULTS = {"user_type": "User", "user_email": "No email available",
                 "user_name": "No name available"}
# Group 1 of the first pattern is the owner, of the second the repository name.
URL_OWNER_PATTERN = r"github\.com/([^/]+)/([^/]+)/"
URL_REPO_PATTERN = r"github\.com/[^/]+/([^/]+)/"
# ---------------------------------------------------------------------------------------------


def _c(c: ColLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket(value: ColLike, ladder: Sequence[tuple[float, str]], default: str,
           inclusive: bool = False) -> Column:
    """Descending threshold ladder: first ``value > t`` (or ``>= t``) wins, NULL -> default."""
    v = _c(value)
    out = None
    for threshold, label in ladder:
        cond = v >= threshold if inclusive else v > threshold
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(default)


def flag_ladder(flags: Sequence[tuple[ColLike, str]], default: str) -> Column:
    """First flag that is ``true`` wins (NULL and false fall through)."""
    out = None
    for flag, label in flags:
        cond = _c(flag) == F.lit(True)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(default)


def value_map(value: ColLike, pairs: Sequence[tuple[str, str]], default: str) -> Column:
    v = _c(value)
    out = None
    for key, label in pairs:
        out = F.when(v == key, label) if out is None else out.when(v == key, label)
    return out.otherwise(default)


# Blank text -------------------------------------------------------------------------
def is_blank(c: ColLike) -> Column:
    """NULL, or empty after stripping spaces (SQL TRIM strips only the space character)."""
    return _c(c).isNull() | (F.trim(_c(c)) == "")


def default_if_blank(c: ColLike, default: str, trimmed: bool = True) -> Column:
    kept = F.trim(_c(c)) if trimmed else _c(c)
    return F.when(is_blank(c), F.lit(default)).otherwise(kept)


# C1-C6 --------------------------------------------------------------------------------------
def repo_defaults() -> dict[str, Column]:
    """Null/blank replacement of the repository dimension, keyed by output column."""
    d = REPO_DEFAULTS
    out = {
        "description": default_if_blank("description", d["description"]),
        "language": F.coalesce(F.col("language"), F.lit(d["language"])),
    }
    for c in ("stars", "watchers", "forks", "open_issues", "size"):
        out[c] = F.coalesce(F.col(c), F.lit(0).cast("bigint"))
    for c in ("created_at", "updated_at", "pushed_at"):
        out[c] = F.coalesce(F.col(c), F.lit(d["time"]))
    for c in ("default_branch", "owner_type", "license_name", "license_key"):
        out[c] = F.coalesce(F.col(c), F.lit(d[c]))
    for c in ("archived", "disabled", "private", "fork"):
        out[c] = F.coalesce(F.col(c), F.lit(False))
    return out


# C7, C11, C12, C13, C30 ---------------------------------------------------------------------
def popularity_category(stars: ColLike = "stars") -> Column:
    return bucket(stars, POPULARITY_STRICT, POPULARITY_STRICT_ELSE)


def popularity_tier(stars: ColLike = "stargazers_count") -> Column:
    return bucket(stars, POPULARITY_TIERS, POPULARITY_TIERS_ELSE, inclusive=True)


def fork_activity_level(forks: ColLike = "forks_count") -> Column:
    return bucket(forks, FORK_ACTIVITY, FORK_ACTIVITY_ELSE, inclusive=True)


def issue_volume_level(open_issues: ColLike = "open_issues_count") -> Column:
    return bucket(open_issues, ISSUE_VOLUME, ISSUE_VOLUME_ELSE, inclusive=True)


def activity_level(comments: ColLike = "comments_count") -> Column:
    return bucket(comments, COMMENT_ACTIVITY, COMMENT_ACTIVITY_ELSE)


# C8 -----------------------------------------------------------------------------------------
def language_category(language: ColLike = "language") -> Column:
    return value_map(language, [(x, x) for x in LANGUAGES_KEPT], LANGUAGE_OTHER)


# C9, C10, C16, C17 --------------------------------------------------------------------------
def visibility_level(is_private: ColLike = "is_private") -> Column:
    return F.when(_c(is_private) == F.lit(True), VISIBILITY[0]).otherwise(VISIBILITY[1])


def repository_status(archived: ColLike = "is_archived", disabled: ColLike = "is_disabled",
                      fork: ColLike = "is_fork") -> Column:
    cols = {"archived": archived, "disabled": disabled, "fork": fork}
    return flag_ladder([(cols[k], label) for k, label in REPO_STATUS], REPO_STATUS_ELSE)


def access_level(private: ColLike = "is_private", archived: ColLike = "is_archived",
                 disabled: ColLike = "is_disabled") -> Column:
    cols = {"private": private, "archived": archived, "disabled": disabled}
    return flag_ladder([(cols[k], label) for k, label in ACCESS_LEVEL], ACCESS_LEVEL_ELSE)


def maturity_level(archived: ColLike = "is_archived", disabled: ColLike = "is_disabled",
                   stars: ColLike = "stargazers_count", forks: ColLike = "forks_count") -> Column:
    s, f = _c(stars), _c(forks)
    return (F.when(_c(archived) == F.lit(True), "Archived")
            .when(_c(disabled) == F.lit(True), "Disabled")
            .when((s >= 1000) & (f >= 100), "Mature")
            .when((s >= 100) & (f >= 10), "Developing")
            .when(s >= 10, "Growing")
            .otherwise("Early Stage"))


# Durations --------------------------------------------------------------
def epoch_seconds(text: ColLike) -> Column:
    """ISO-8601 text -> seconds since epoch; NULL for NULL or text that is not a time."""
    return F.unix_seconds(F.try_to_timestamp(_c(text)))


def duration_seconds(end: ColLike, start: ColLike) -> Column:
    """``end - start`` in whole seconds (may be negative); NULL when either side is NULL."""
    return epoch_seconds(end) - epoch_seconds(start)


# Repository coordinates from a URL -----------------------------------------------------
def url_repo_owner(url: ColLike = "html_url") -> Column:
    return F.regexp_extract(_c(url), URL_OWNER_PATTERN, 1)


def url_repo_name(url: ColLike = "html_url") -> Column:
    return F.regexp_extract(_c(url), URL_REPO_PATTERN, 1)


# C19, C23, C24 ------------------------------------------------------------------------------
def length_category(text: ColLike) -> Column:
    return bucket(F.length(_c(text)), TEXT_LENGTH, TEXT_LENGTH_ELSE)


def body_length_category(body: ColLike = "body") -> Column:
    return bucket(F.length(_c(body)), BODY_LENGTH, BODY_LENGTH_ELSE)


# C20: case-sensitive substring classes ------------------------------------------------------
def commit_type(message: ColLike = "message") -> Column:
    m = _c(message)
    out = None
    for words, label in COMMIT_KEYWORDS:
        cond = None
        for w in words:
            hit = m.contains(w)
            cond = hit if cond is None else (cond | hit)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(COMMIT_KEYWORDS_ELSE)


# C21 ----------------------------------------------------------------------------------------
def verification_status(verified: ColLike = "verification_verified") -> Column:
    v = _c(verified)
    return (F.when(v == F.lit(True), VERIFICATION[0]).when(v == F.lit(False), VERIFICATION[1])
            .otherwise(VERIFICATION[2]))


# C25 ----------------------------------------------------------------------------------------
def issue_status(state: ColLike = "state") -> Column:
    return value_map(state, ISSUE_STATES, ISSUE_STATES_ELSE)


# Presence ------------------------------------------------------------------
def presence_label(c: ColLike, labels: tuple[str, str]) -> Column:
    return F.when(_c(c).isNotNull(), labels[0]).otherwise(labels[1])


def presence_flag(c: ColLike) -> Column:
    return F.when(_c(c).isNotNull(), 1).otherwise(0)


def assignment_status(assignee_id: ColLike = "assignee_id") -> Column:
    return presence_label(assignee_id, ASSIGNMENT)


def milestone_status(milestone_id: ColLike = "milestone_id") -> Column:
    return presence_label(milestone_id, MILESTONE)


def issue_type(pull_request: ColLike = "pull_request") -> Column:
    return presence_label(pull_request, ISSUE_TYPE)


def is_resolved(state: ColLike = "state", closed_at: ColLike = "closed_at") -> Column:
    return F.when((_c(state) == "closed") & _c(closed_at).isNotNull(), 1).otherwise(0)


def has_items(arr: ColLike = "labels") -> Column:
    """1 when the array is present and non-empty (the NULL guard keeps ``size`` well defined)."""
    a = _c(arr)
    return F.when(a.isNotNull() & (F.size(a) > 0), 1).otherwise(0)


# Users ------------------------------------------------------------------------------
def user_defaults() -> dict[str, Column]:
    d = USER_DEFAULTS
    return {
        "user_type": F.coalesce(F.col("user_type"), F.lit(d["user_type"])),
        # The e-mail is replaced when blank but otherwise kept untrimmed; the name is trimmed.
        "user_email": default_if_blank("user_email", d["user_email"], trimmed=False),
        "user_name": default_if_blank("user_name", d["user_name"]),
    }


def primary_role(roles: ColLike = "user_roles") -> Column:
    r = _c(roles)
    out = None
    for needed, label in ROLE_PRIORITY:
        cond = None
        for role in needed:
            hit = F.array_contains(r, role)
            cond = hit if cond is None else (cond & hit)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(ROLE_PRIORITY_ELSE)


def user_activity_level(role_count: ColLike = "role_count") -> Column:
    n = _c(role_count)
    return F.when(n >= 3, ROLE_COUNT[0]).when(n == 2, ROLE_COUNT[1]).otherwise(ROLE_COUNT[2])
