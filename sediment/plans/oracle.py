"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the rules, over the same benchmark tables and the adapter CTEs of
``sources.driver_tables``; no engine code is shared with the Spark side.  Each rule is one entry
of a rule table below and one SQL expression, used by the rule's own key and by every table that
has the column.
"""

from __future__ import annotations

from sediment.sources.driver_tables import ORACLE_LINES, oracle_with

ORACLE: dict[str, str] = {}

# Column names of the layers, in their order.
REPO_COLS = [
    "repo_name", "full_name", "description", "html_url", "clone_url", "language", "stars",
    "watchers", "forks", "open_issues", "size", "created_at", "updated_at", "pushed_at",
    "default_branch", "owner_id", "owner_login", "owner_type", "owner_url", "license_name",
    "license_key", "topics", "archived", "disabled", "private", "fork",
]
PERMISSION_COLS = {
    "repo_name": "repo_name", "full_name": "full_name", "owner_id": "owner_id",
    "owner_login": "owner_login", "owner_type": "owner_type", "private": "is_private",
    "archived": "is_archived", "disabled": "is_disabled", "fork": "is_fork",
    "language": "primary_language", "stars": "stargazers_count", "watchers": "watchers_count",
    "forks": "forks_count", "open_issues": "open_issues_count", "created_at": "created_at",
    "updated_at": "updated_at", "pushed_at": "pushed_at",
}
ISSUE_COLS = [
    "issue_id", "node_id", "issue_number", "title", "body", "state", "locked", "assignee_id",
    "assignee_login", "assignee_type", "assignee_html_url", "user_id", "user_login", "user_type",
    "user_html_url", "labels", "milestone_id", "milestone_title", "milestone_description",
    "milestone_state", "comments_count", "created_at", "updated_at", "closed_at",
    "author_association", "active_lock_reason", "pull_request", "html_url", "url",
]
PR_NAMES = {"issue_id": "pr_id", "issue_number": "pr_number", "user_id": "author_id",
            "user_login": "author_login", "user_type": "author_type", "user_html_url": "author_html_url"}
USER_KEYS = ["user_id", "user_login", "user_type", "user_html_url", "user_email", "user_name"]
# Per source, the roles and where their six user columns come from.
ROLE_RECORDS = {
    "repos": {"owner": ["owner_id", "owner_login", "owner_type", "owner_url", None, None]},
    "commits": {role: [f"{role}_{c}" for c in ("id", "login", "type", "html_url", "email", "name")]
                for role in ("author", "committer")},
    "issues": {"issue_user": ["user_id", "user_login", "user_type", "user_html_url", None, None],
               "assignee": [f"assignee_{c}" for c in ("id", "login", "type", "html_url")] + [None, None]},
}
# Ladders as (comparison, bounds with their labels from the highest, other label).
LADDERS = {
    "popularity_category": (">", {10000: "Very Popular", 1000: "Popular", 100: "Moderately Popular"},
                            "Less Popular"),
    "popularity_tier": (">=", {10000: "Very Popular", 1000: "Popular", 100: "Moderately Popular",
                               10: "Somewhat Popular"}, "Less Popular"),
    "fork_activity_level": (">=", {1000: "High Fork Activity", 100: "Moderate Fork Activity",
                                   10: "Low Fork Activity"}, "Minimal Fork Activity"),
    "issue_volume_level": (">=", {100: "High Issue Volume", 50: "Moderate Issue Volume",
                                  10: "Low Issue Volume"}, "Minimal Issue Volume"),
    "length_category": (">", {100: "Long", 50: "Medium"}, "Short"),
    "body_length_category": (">", {1000: "Long", 500: "Medium", 0: "Short"}, "Empty"),
    "activity_level": (">", {20: "High Activity", 10: "Medium Activity", 0: "Low Activity"}, "No Activity"),
    "user_activity_level": (">=", {3: "Multi-role User", 2: "Dual-role User"}, "Single-role User"),
}
# Labels of the first condition that holds, else the last label.
CONDITIONS = {
    "repository_status": [("is_archived", "Archived"), ("is_disabled", "Disabled"), ("is_fork", "Fork"),
                          (None, "Active")],
    "access_level": [("is_private", "Restricted Access"), ("is_archived", "Read-Only Access"),
                     ("is_disabled", "No Access"), (None, "Open Access")],
    "visibility_level": [("is_private", "Private"), (None, "Public")],
    "maturity_level": [("is_archived", "Archived"), ("is_disabled", "Disabled"),
                       ("stargazers_count >= 1000 AND forks_count >= 100", "Mature"),
                       ("stargazers_count >= 100 AND forks_count >= 10", "Developing"),
                       ("stargazers_count >= 10", "Growing"), (None, "Early Stage")],
    "issue_status": [("state = 'open'", "Open"), ("state = 'closed'", "Closed"), (None, "Unknown")],
    "verification_status": [("verification_verified", "Verified"), ("NOT verification_verified", "Unverified"),
                            (None, "Unknown")],
    "assignment_status": [("assignee_id IS NOT NULL", "Assigned"), (None, "Unassigned")],
    "milestone_status": [("milestone_id IS NOT NULL", "Has Milestone"), (None, "No Milestone")],
    "issue_type": [("pull_request IS NOT NULL", "Pull Request"), (None, "Issue")],
    "commit_type": [("regexp_matches(message, 'fix|bug')", "Bug Fix"),
                    ("contains(message, 'feat')", "Feature"), ("contains(message, 'refactor')", "Refactor"),
                    ("contains(message, 'test')", "Test"), ("contains(message, 'doc')", "Documentation"),
                    ("contains(message, 'style')", "Style"), (None, "Other")],
    "primary_role": [("list_contains(user_roles, 'owner')", "Repository Owner"),
                     ("list_has_all(user_roles, ['author', 'committer'])", "Active Contributor"),
                     ("list_contains(user_roles, 'author')", "Code Author"),
                     ("list_contains(user_roles, 'committer')", "Code Committer"),
                     ("list_contains(user_roles, 'issue_user')", "Issue Participant"),
                     ("list_contains(user_roles, 'assignee')", "Issue Assignee"), (None, "Other")],
}
# What a missing repository value becomes.
DEFAULTS = {
    "language": "'Unknown'", "stars": "0", "watchers": "0", "forks": "0", "open_issues": "0", "size": "0",
    "created_at": "'1900-01-01T00:00:00Z'", "updated_at": "'1900-01-01T00:00:00Z'",
    "pushed_at": "'1900-01-01T00:00:00Z'", "default_branch": "'main'", "owner_type": "'User'",
    "license_name": "'No License'", "license_key": "'none'", "archived": "false", "disabled": "false",
    "private": "false", "fork": "false",
}
LANGUAGES = ["Python", "JavaScript", "Java", "C++", "C#"]


def secs(x: str) -> str:
    """ISO text -> epoch seconds (NULL when not a time)."""
    return f"CAST(epoch(TRY_CAST({x} AS TIMESTAMP)) AS BIGINT)"


def lag(later: str, earlier: str, name: str) -> str:
    return f"{secs(later)} - {secs(earlier)} AS {name}"


def url_owner(x: str) -> str:
    return f"regexp_extract({x}, 'github\\.com/([^/]+)/([^/]+)/', 1)"


def url_repo(x: str) -> str:
    return f"regexp_extract({x}, 'github\\.com/[^/]+/([^/]+)/', 1)"


def ladder(rule: str, value: str, name: str | None = None) -> str:
    """The label of the highest bound that the value reaches; NULL reaches none."""
    sign, bounds, other = LADDERS[rule]
    steps = ", ".join(f"{{'b': {b}, 'l': '{label}'}}" for b, label in bounds.items())
    return (f"coalesce(list_filter([{steps}], lambda s: {value} {sign} s.b)[1].l, '{other}') "
            f"AS {name or rule}")


def label(rule: str) -> str:
    *cases, (_, other) = CONDITIONS[rule]
    picked = ", ".join(f"if({c}, '{x}', NULL)" for c, x in cases)
    return f"coalesce({picked}, '{other}') AS {rule}"


def flag(condition: str, name: str) -> str:
    return f"CAST(coalesce({condition}, false) AS INTEGER) AS {name}"


def filled(column: str, missing: str, name: str | None = None) -> str:
    """Trimmed text, a blank one replaced."""
    return f"coalesce(nullif(trim({column}), ''), '{missing}') AS {name or column}"


def or_default(column: str) -> str:
    return f"coalesce({column}, {DEFAULTS[column]}) AS {column}" if column in DEFAULTS else column


def merged(columns: dict[str, str]) -> str:
    """CTE ``m``: search hits and details stacked, per id the first value that is not NULL, hits first.
    Rows without an id stay apart."""
    values = ", ".join(f"arg_min({c}, side) AS {name}" for c, name in columns.items())
    return f""",
stacked AS (SELECT 0 AS side, * FROM repos UNION ALL BY NAME SELECT 1 AS side, * FROM details),
numbered AS (SELECT *, row_number() OVER () AS nr FROM stacked),
m AS (SELECT repo_id, {values} FROM numbered GROUP BY repo_id, CASE WHEN repo_id IS NULL THEN nr END)"""


def _role_rows() -> str:
    parts = []
    for table, roles in ROLE_RECORDS.items():
        records = ", ".join(
            "{" + ", ".join([f"'user_role': '{role}'", *(
                f"'{k}': " + (f"CAST({c} AS {'BIGINT' if k == 'user_id' else 'VARCHAR'})"
                              if c else "CAST(NULL AS VARCHAR)")
                for k, c in zip(USER_KEYS, columns, strict=True))]) + "}"
            for role, columns in roles.items())
        parts.append(f"SELECT unnest([{records}], recursive := true) FROM {table}")
    return " UNION ALL ".join(parts)


ROLES = f""", all_users AS (FROM ({_role_rows()}) WHERE user_id IS NOT NULL)"""
ROLE_SETS = ROLES + f""", agg AS (
  SELECT {", ".join(USER_KEYS)}, list_sort(list(DISTINCT user_role)) AS user_roles,
         count(DISTINCT user_role) AS role_count
  FROM all_users GROUP BY ALL)"""

# --- the six silver tables -------------------------------------------------------------------
_REPOSITORY = [filled("description", "No description available") if c == "description" else or_default(c)
               for c in REPO_COLS]
ORACLE["dim_repositories"] = oracle_with("repos", "details") + merged({c: c for c in REPO_COLS}) + f"""
SELECT repo_id, {", ".join(_REPOSITORY)},
  if(list_contains({LANGUAGES}, language), language, 'Other') AS language_category,
  {ladder("popularity_category", "stars")}
FROM m WHERE repo_id IS NOT NULL
"""

_PERMISSION_RULES = ", ".join([
    label("visibility_level"), label("repository_status"), label("access_level"), label("maturity_level"),
    ladder("popularity_tier", "stargazers_count"), ladder("fork_activity_level", "forks_count"),
    ladder("issue_volume_level", "open_issues_count")])
_PERMISSIONS = oracle_with("repos", "details") + merged(PERMISSION_COLS)
ORACLE["dim_repo_permissions"] = _PERMISSIONS + f"""
SELECT *, {_PERMISSION_RULES}, {lag("updated_at", "created_at", "repository_age_seconds")},
  {lag("pushed_at", "updated_at", "last_activity_seconds")}
FROM m
"""

_USER_RULES = f"{label('primary_role')}, {ladder('user_activity_level', 'role_count')}"
ORACLE["dim_users"] = oracle_with("repos", "commits", "issues") + ROLE_SETS + f"""
SELECT * REPLACE (
    coalesce(user_type, 'User') AS user_type,
    if(trim(coalesce(user_email, '')) = '', 'No email available', user_email) AS user_email,
    {filled("user_name", "No name available")}), {_USER_RULES}
FROM agg
"""


def _merged_users(person: str) -> str:
    """Users per ``person``, a table (user_id, person)."""
    none_last = ", ".join(f"{c} IS NULL, {c}" for c in ("user_id", "user_login", "user_type", "user_html_url"))
    first = ", ".join(f"first({c} ORDER BY {none_last}) AS {c}" for c in USER_KEYS[:4])
    email, name = (f"min({c}) FILTER (trim({c}) <> '') AS {c}" for c in ("user_email", "user_name"))
    return oracle_with("repos", "commits", "issues").replace("WITH ", "WITH RECURSIVE ", 1) + ROLE_SETS + f"""
, {person},
merged AS (
  SELECT {first}, {email}, {name}, list_sort(list_distinct(flatten(list(user_roles)))) AS user_roles,
         count(*) AS identity_count, count(DISTINCT user_id) AS id_count
  FROM agg JOIN persons USING (user_id) GROUP BY person),
counted AS (SELECT *, CAST(len(user_roles) AS BIGINT) AS role_count FROM merged)
SELECT * REPLACE (
    coalesce(user_type, 'User') AS user_type,
    if(trim(coalesce(user_email, '')) = '', 'No email available', user_email) AS user_email,
    {filled("user_name", "No name available")}), {_USER_RULES}
FROM counted
"""


ORACLE["dim_users_by_user"] = _merged_users("persons AS (SELECT DISTINCT user_id, user_id AS person FROM agg)")
ORACLE["dim_users_by_person"] = _merged_users("""
used AS (
  SELECT DISTINCT user_id, kind, lower(trim(value)) AS value FROM (
    SELECT user_id, 'login' AS kind, user_login AS value FROM agg
    UNION ALL SELECT user_id, 'email', user_email FROM agg)
  WHERE trim(value) <> ''),
own AS (SELECT kind, value FROM used GROUP BY kind, value HAVING count(*) <= 20),
tied AS (SELECT a.user_id AS a, b.user_id AS b FROM used a JOIN used b USING (kind, value) JOIN own USING (kind, value)),
reach AS (
  SELECT DISTINCT user_id AS a, user_id AS b FROM agg
  UNION SELECT reach.a, tied.b FROM reach JOIN tied ON reach.b = tied.a),
persons AS (SELECT a AS user_id, min(b) AS person FROM reach GROUP BY a)""")


def _with_repo(table: str, key: str, extra: list[str], columns: list[str]) -> str:
    """A fact with the repository that its URL names, and its rule columns."""
    taken = {"repo_id": "repo_id", "repo_name": "repo_name", "full_name": "repo_full_name",
             "language": "repo_language", "stars": "repo_stars", "forks": "repo_forks",
             **{c: f"repo_{c}" for c in extra}}
    return oracle_with("repos", table) + f"""
, f AS (SELECT *, {url_owner("html_url")} AS uo, {url_repo("html_url")} AS ur FROM {table} WHERE {key} IS NOT NULL),
r AS (SELECT owner_login AS uo, repo_name AS ur, {", ".join(f"{c} AS {n}" for c, n in taken.items())} FROM repos)
SELECT * EXCLUDE (uo, ur), {", ".join(columns)} FROM f LEFT JOIN r USING (uo, ur)
"""


_COMMIT_RULES = [ladder("length_category", "length(message)", "message_length_category"), label("commit_type")]
ORACLE["fact_commits"] = _with_repo("commits", "commit_sha", [], [
    *_COMMIT_RULES, label("verification_status"),
    lag("committer_date", "author_date", "commit_delay_seconds")])

_LENGTH_RULES = [ladder("length_category", "length(title)", "title_length_category"),
                 ladder("body_length_category", "length(body)")]
_PRESENCE_LABELS = [label("assignment_status"), label("milestone_status"), label("issue_type")]
ORACLE["fact_issues"] = _with_repo("issues", "issue_id", ["open_issues"], [
    *_LENGTH_RULES, label("issue_status"), *_PRESENCE_LABELS,
    lag("closed_at", "created_at", "resolution_time_seconds"), ladder("activity_level", "comments_count")])

_FLAGS = [flag("state = 'closed' AND closed_at IS NOT NULL", "is_resolved"),
          flag("assignee_id IS NOT NULL", "is_assigned"), flag("milestone_id IS NOT NULL", "has_milestone")]
_HAS_LABELS = flag("len(labels) > 0", "has_labels")


def _pull_requests(on: str) -> str:
    names = ", ".join(f"{a} AS {b}" for a, b in PR_NAMES.items())
    return oracle_with("repos", "issues") + f"""
, pr AS (
  SELECT * REPLACE (coalesce(body, '') AS body) RENAME ({names}),
    {lag("closed_at", "created_at", "resolution_time_seconds")}, {", ".join(_FLAGS)}, {_HAS_LABELS}
  FROM issues WHERE pull_request IS NOT NULL)
SELECT pr.*, r.repo_id, r.repo_name, r.full_name, r.owner_id, r.owner_login
FROM pr LEFT JOIN repos r ON {on}
"""


ORACLE["fact_pull_requests"] = _pull_requests("r.owner_id = pr.author_id")
for _name in ("fact_commits", "fact_issues"):
    ORACLE[f"{_name}_colocated"] = ORACLE[_name]
ORACLE["fact_pull_requests_by_url"] = _pull_requests(
    f"{url_owner('pr.html_url')} = r.owner_login AND {url_repo('pr.html_url')} = r.repo_name")


ORACLE["load_stamps"] = oracle_with("repos", "details") + """
, stamped AS (
  SELECT repo_id, 0 AS side, TIMESTAMP '2024-01-01' AS start, 3 AS gap FROM repos
  UNION ALL SELECT repo_id, 1, TIMESTAMP '2024-02-01', 4 FROM details WHERE repo_id IS NOT NULL
),
placed AS (SELECT *, ((repo_id % 90) + 90) % 90 AS days, ((repo_id % gap) + gap) % gap AS rest FROM stamped),
timed AS (SELECT repo_id, side, CASE WHEN rest <> 0 THEN start + to_days(CAST(days AS INTEGER)) END AS stamp
          FROM placed)
SELECT repo_id, CAST(epoch(coalesce(max(stamp), TIMESTAMP '1900-01-01')) AS BIGINT) AS latest,
  CAST(epoch(arg_min(stamp, side)) AS BIGINT) AS first,
  CAST(epoch(TIMESTAMP '2024-06-01 12:00:00') AS BIGINT) AS loaded
FROM timed GROUP BY repo_id
"""

# --- landing and bronze: the derived records must come back unchanged -------------------------
ORACLE["bronze_repositories"] = oracle_with("repos") + "SELECT * FROM repos"
ORACLE["bronze_repo_details"] = oracle_with("details") + "SELECT * FROM details"
ORACLE["bronze_commits"] = oracle_with("commits") + "SELECT * FROM commits"
ORACLE["bronze_issues"] = oracle_with("issues") + "SELECT * FROM issues"
ORACLE["landing_envelope_roundtrip"] = ORACLE["bronze_repositories"]
ORACLE["json_explode_flatten"] = ORACLE["bronze_commits"]
ORACLE["struct_star_expand"] = ORACLE["bronze_repo_details"]

ORACLE["landing_json_scan"] = """
SELECT min(o_orderkey) AS first_issue_id, CAST(count(*) AS BIGINT) AS items,
       '2024-06-01T00:00:00' AS ingestion_timestamp, false AS malformed
FROM orders GROUP BY floor(o_orderkey / 50)
"""

ORACLE["landing_route_by_name"] = oracle_with("repos", "details", "commits", "issues") + f"""
, names AS (
  SELECT DISTINCT 'repositories_' || CAST(CAST(floor(repo_id / 50) AS BIGINT) AS VARCHAR)
         || '_20240601_000000.json' AS file_name FROM repos
  UNION ALL
  SELECT 'repo_details_' || repo_name || '_20240601_000000.json' FROM details
  UNION ALL
  SELECT DISTINCT 'commits_' || {url_owner("html_url")} || '_' || {url_repo("html_url")}
         || '_20240601_000000.json' FROM commits
  UNION ALL
  SELECT DISTINCT 'issues_' || {url_owner("html_url")} || '_' || {url_repo("html_url")}
         || '_20240601_000000.json' FROM issues
  UNION ALL
  SELECT unnest(['commits_' || repo_name || '_awesome-repositories', 'issues_' || repo_name || '_commits-tool',
                 'notes_' || repo_name || '_issues']) || '_20240601_000000.json' FROM repos)
SELECT file_name, regexp_extract(file_name, '^(repositories|repo_details|commits|issues)_', 1) AS feed
FROM names
"""

# --- sinks and summaries -------------------------------------------------------------------------
ORACLE["bronze_parquet_roundtrip"] = "SELECT * FROM supplier"
ORACLE["silver_table_roundtrip"] = "SELECT * FROM customer"

TABLE_WIDTHS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
                "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3,
                "benchmark": 2, "labels": 3, "conversations": 4}
ORACLE["table_summary"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, "
    f"CAST({w} AS BIGINT) AS column_count FROM {t}" for t, w in TABLE_WIDTHS.items())


def _count(sql: str) -> str:
    return f"(SELECT CAST(count(*) AS BIGINT) FROM ({sql}))"


_SILVER_WIDTHS = {"dim_repositories": 31, "dim_users": 11, "dim_repo_permissions": 29,
                  "fact_commits": 37, "fact_issues": 46, "fact_pull_requests": 41}
_BRONZE = {"repositories": ("bronze_repositories", 28), "repo_details": ("bronze_repo_details", 28),
           "commits": ("bronze_commits", 26), "issues": ("bronze_issues", 30)}


def _layer_rows() -> str:
    rows = []
    for feed, (key, width) in _BRONZE.items():
        n = _count(ORACLE[key])
        rows.append(f"SELECT 'landing' AS layer, '{feed}' AS table_name, {n} AS row_count, "
                    f"CAST(NULL AS BIGINT) AS column_count")
        rows.append(f"SELECT 'bronze', '{feed}', {n}, CAST({width} AS BIGINT)")
    for t, width in _SILVER_WIDTHS.items():
        rows.append(f"SELECT 'silver', '{t}', {_count(ORACLE[t])}, CAST({width} AS BIGINT)")
    return "\nUNION ALL\n".join(rows)


ORACLE["landing_to_silver_run"] = _layer_rows()
ORACLE["layer_summary"] = f"""
SELECT layer, CAST(count(*) AS BIGINT) AS tables, CAST(sum(row_count) AS BIGINT) AS total_rows
FROM ({_layer_rows()}) GROUP BY layer
"""
ORACLE["dq_missing_tables"] = f"""
SELECT layer, table_name, true AS found, row_count, row_count >= 1 AS passed
FROM ({_layer_rows()}) WHERE layer <> 'landing'
"""

ORACLE["dq_envelope"] = oracle_with("repos", "details", "commits", "issues") + """
SELECT 'repositories' AS feed, CAST(count(DISTINCT floor(repo_id / 50)) AS BIGINT) AS documents,
       CAST(0 AS BIGINT) AS malformed, CAST(0 AS BIGINT) AS partial,
       CAST(0 AS BIGINT) AS without_timestamp,
       CAST(0 AS BIGINT) AS without_data, CAST(count(*) AS BIGINT) AS items FROM repos
UNION ALL
SELECT 'repo_details', CAST(count(*) AS BIGINT), 0, 0, 0, 0, CAST(count(*) AS BIGINT) FROM details
UNION ALL
SELECT 'commits', CAST(count(DISTINCT (author_id, floor(comment_count / 50))) + count(*) AS BIGINT),
       count(*) FILTER (n % 7 = 0), 0, count(*) FILTER (n % 7 = 0), count(*) FILTER (n % 7 = 0 OR n % 11 = 0),
       CAST(count(*) + count(*) FILTER (n % 7 <> 0 AND n % 11 <> 0) AS BIGINT)
FROM (SELECT *, author_id * 8 + comment_count AS n FROM commits)
UNION ALL
SELECT 'issues', CAST(count(DISTINCT floor(issue_id / 50)) AS BIGINT), 0, 0, 0, 0,
       CAST(count(*) AS BIGINT) FROM issues
"""

def _null_rows(cte: str, cols) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS null_count, "
        f"CAST(count(*) AS BIGINT) AS row_count FROM {cte}" for c in cols)


ORACLE["dq_null_counts"] = oracle_with("issues") + _null_rows("issues", ISSUE_COLS)
ORACLE["dq_thresholds"] = oracle_with("issues") + f"""
SELECT column_name, null_count, row_count,
  CASE WHEN row_count > 0 THEN CAST(null_count AS DOUBLE) / row_count END AS null_share,
  COALESCE(CASE WHEN row_count > 0 THEN CAST(null_count AS DOUBLE) / row_count END <= 0.1
           AND row_count >= 1, false) AS passed
FROM ({_null_rows("issues", ISSUE_COLS)})
"""

# --- feed selection --------------------------------------------------------------------------------
ORACLE["feed_filter"] = oracle_with("repos") + """
SELECT repo_id, repo_name, language, stars FROM repos
WHERE lower(language) = 'python' AND stars > 1000
"""
ORACLE["feed_filter_configured"] = oracle_with("repos") + """
SELECT s.name AS search, r.repo_id, r.language, r.stars
FROM repos r JOIN (VALUES ('python_repos', 'python', 1000), ('javascript_repos', 'javascript', 1000),
                          ('java_repos', 'java', 1000)) AS s(name, lang, min_stars)
  ON lower(r.language) = s.lang AND r.stars > s.min_stars
"""
ORACLE["feed_topk"] = oracle_with("repos") + """
SELECT repo_id, repo_name, stars FROM repos ORDER BY stars DESC, repo_id ASC LIMIT 50
"""
for _suffix, _feed, _key, _time, _user, _line_key, _path in (
        ("", "issues", "issue_id", "created_at", "user_id", "number", "issues"),
        ("_commits", "commits", "commit_sha", "author_date", "author_id", "sha", "commit")):
    ORACLE["feed_topk_per_group" + _suffix] = oracle_with(_feed) + f"""
SELECT {_key}, {_time}, {url_owner("html_url")} AS repo_owner, {url_repo("html_url")} AS repo_name
FROM {_feed}
QUALIFY row_number() OVER (PARTITION BY repo_owner, repo_name ORDER BY {_time} DESC, {_key}) <= 50
"""
    _family = oracle_with("repos", _feed) + f"""
, children AS (
  SELECT {_key}, {_user}, html_url FROM {_feed}
  UNION ALL SELECT {_line_key}, pos, repo || '/{_path}/' || CAST({_line_key} AS VARCHAR) FROM ({ORACLE_LINES}))
"""
    _chosen = f"""
SELECT {_key}, {_user}, {url_owner("html_url")} AS repo_owner, {url_repo("html_url")} AS repo_name
FROM children WHERE ({url_owner("html_url")}, {url_repo("html_url")}) IN (FROM chosen)
"""
    ORACLE["feed_children_of_topk" + _suffix] = _family + """
, chosen AS (SELECT owner_login, repo_name FROM repos ORDER BY stars DESC, repo_id LIMIT 10)
""" + _chosen
    ORACLE["feed_children_of_starred" + _suffix] = _family + """
, chosen AS (SELECT owner_login, repo_name FROM repos WHERE stars > 1000)
""" + _chosen
ORACLE["feed_filter_state"] = oracle_with("issues") + "SELECT issue_id, state FROM issues WHERE state = 'open'"

# --- merges, unions, joins ---------------------------------------------------------------------------
ORACLE["full_outer_coalesce_merge"] = (oracle_with("repos", "details") + merged({c: c for c in REPO_COLS})
                                       + " SELECT * FROM m")
_USERS = oracle_with("repos", "commits", "issues")
ORACLE["role_union"] = _USERS + ROLES + " SELECT * FROM all_users"
ORACLE["role_aggregate"] = _USERS + ROLE_SETS + " SELECT * FROM agg"
ORACLE["role_classify"] = _USERS + ROLE_SETS + f" SELECT {', '.join(USER_KEYS)}, {_USER_RULES} FROM agg"
ORACLE["left_join_two_keys"] = """
SELECT p.page_id, p.url, p.page_lang, p.page_doc, d.doc_id, d.source, d.n_chars
FROM (SELECT page_id, url, regexp_extract(url, '/([a-z]{2})/([0-9]+)', 1) AS page_lang,
             TRY_CAST(regexp_extract(url, '/([a-z]{2})/([0-9]+)', 2) AS BIGINT) AS page_doc
      FROM pages) p
LEFT JOIN documents d ON p.page_doc = d.doc_id AND p.page_lang = d.lang
"""
ORACLE["left_join_fanout"] = oracle_with("repos", "issues") + """
SELECT i.issue_id AS pr_id, i.user_id AS author_id, r.repo_id, r.repo_name, r.owner_id
FROM issues i LEFT JOIN repos r ON i.user_id = r.owner_id
WHERE i.pull_request IS NOT NULL
"""
ORACLE["filter_not_null"] = oracle_with("issues") + """
SELECT issue_id, assignee_id FROM issues WHERE assignee_id IS NOT NULL
"""

# --- rule families -------------------------------------------------------------------------------------
def _rules(table: str, key: str, *columns: str) -> str:
    return oracle_with(table) + f"SELECT {key}, {', '.join(columns)} FROM {table}"


ORACLE["clean_defaults"] = _rules("repos", "repo_id", filled("description", "No description available"),
                                  *map(or_default, DEFAULTS))
ORACLE["bucket_strict"] = _rules("repos", "repo_id", "stars", ladder("popularity_category", "stars"))
ORACLE["bucket_inclusive"] = _rules("repos", "repo_id", ladder("popularity_tier", "stars"),
                                    ladder("fork_activity_level", "forks"),
                                    ladder("issue_volume_level", "open_issues"))
ORACLE["compound_bucket"] = _PERMISSIONS + f" SELECT repo_id, {label('maturity_level')} FROM m"
ORACLE["priority_status"] = _PERMISSIONS + (
    f" SELECT repo_id, {label('repository_status')}, {label('access_level')}, {label('visibility_level')} FROM m")
ORACLE["value_map"] = _rules("issues", "issue_id", "state", label("issue_status"))
ORACLE["tristate_map"] = _rules("commits", "commit_sha", label("verification_status"))
ORACLE["length_bucket"] = _rules("issues", "issue_id", *_LENGTH_RULES)
ORACLE["keyword_classify"] = _rules("commits", "commit_sha", *_COMMIT_RULES)
ORACLE["duration_seconds"] = _rules("issues", "issue_id",
                                    lag("closed_at", "created_at", "resolution_time_seconds"),
                                    lag("updated_at", "created_at", "update_lag_seconds"))
ORACLE["url_regexp_extract"] = _rules("issues", "issue_id", f"{url_owner('html_url')} AS repo_owner",
                                      f"{url_repo('html_url')} AS repo_name")
ORACLE["presence_flags"] = _rules("issues", "issue_id", *_PRESENCE_LABELS, *_FLAGS)
ORACLE["array_size_flag"] = _rules("issues", "issue_id", _HAS_LABELS)

ORACLE["bronze_incremental"] = ORACLE["bronze_issues"]
ORACLE["bronze_incremental_tables"] = ORACLE["bronze_issues"]
ORACLE["dim_users_incremental"] = ORACLE["dim_users"]

ORACLE["bronze_point_read"] = oracle_with("issues") + """
SELECT issue_id, title, state, user_login FROM issues WHERE issue_id % 11 = 3 ORDER BY issue_id LIMIT 100
"""

ORACLE["landing_document_run"] = oracle_with("repos", "issues") + """
, found AS (SELECT floor(repo_id / 5)::BIGINT AS p, count(*) AS items FROM repos WHERE stars >= 2000 GROUP BY p),
pages AS (SELECT floor(issue_id / 50)::BIGINT AS p, count(*) AS n FROM issues GROUP BY p),
files AS (
  SELECT 'repositories_' || p AS name, 'repositories' AS feed, 0 AS bad, items FROM found
  UNION ALL
  SELECT CASE p % 10 WHEN 3 THEN 'issues_o_commits-tool-' WHEN 4 THEN 'issues_repo_details_repositories-'
                     WHEN 5 THEN 'notes_issues_' ELSE 'issues_o_r' END || p,
         CASE WHEN p % 10 = 5 THEN '' ELSE 'issues' END, (p % 10 = 7)::INTEGER,
         CASE WHEN p % 10 IN (7, 9) THEN 0 ELSE n END
  FROM pages)
SELECT name || '_20240601_000000.json' AS file_name, feed, if(feed <> '', 1, NULL) AS documents,
       if(feed <> '', bad, NULL) AS malformed, if(feed <> '', bad, NULL) AS without_timestamp,
       if(feed <> '', bad, NULL) AS without_data, if(feed <> '', items, NULL) AS items
FROM files
UNION ALL
SELECT NULL, feed, NULL, NULL, NULL, NULL, sum(items)::BIGINT FROM files WHERE feed <> '' GROUP BY feed
"""

_DRIFTED = oracle_with("details") + """
, d AS (SELECT *, CAST(substr(repo_name, 4) AS BIGINT) AS n FROM details)
"""
ORACLE["landing_variant_scan"] = _DRIFTED + """
SELECT repo_id, repo_name, private, stars, CAST(NULL AS BIGINT) AS size,
       CASE WHEN n % 5 = 0 THEN '12 MB' END AS size_said, CASE WHEN n % 3 = 0 THEN 'public' END AS visibility
FROM d
"""
# The API fields of a repository whose names or types differ from text columns.
_API_NAMES = {"repo_id": "id", "repo_name": "name", "stars": "stargazers_count", "watchers": "watchers_count",
              "forks": "forks_count", "open_issues": "open_issues_count", "owner_id": "owner.id",
              "owner_login": "owner.login", "owner_type": "owner.type", "owner_url": "owner.html_url",
              "license_name": "license.name", "license_key": "license.key"}
_API_TYPES = {**dict.fromkeys(("repo_id", "stars", "watchers", "forks", "open_issues", "owner_id"), "BIGINT"),
              **dict.fromkeys(("archived", "disabled", "private", "fork"), "BOOLEAN"), "topics": "ARRAY"}
ORACLE["landing_schema_drift"] = _DRIFTED + "SELECT *, true AS has_example FROM (" + " UNION ALL ".join([
    "SELECT 'visibility' AS path, 'STRING' AS type_seen, NULL AS type_wanted, count(*) FILTER (n % 3 = 0) AS records FROM d",
    "SELECT 'size', 'STRING', 'BIGINT', count(*) FILTER (n % 5 = 0) FROM d",
    "SELECT 'size', NULL, 'BIGINT', count(*) FILTER (n % 5 <> 0) FROM d",
    *[f"SELECT '{_API_NAMES.get(c, c)}', NULL, '{_API_TYPES.get(c, 'STRING')}', count(*) - count({c}) FROM d"
      for c in ["repo_id", *REPO_COLS] if c != "size"]]) + ") WHERE records > 0"

ORACLE["dq_silver_nulls"] = f"""
SELECT column_name, null_count, row_count FROM (
  SELECT 'repo_id' AS column_name, CAST(count(*) - count(repo_id) AS BIGINT) AS null_count,
         CAST(count(*) AS BIGINT) AS row_count FROM ({ORACLE["dim_repositories"]})
  UNION ALL
  SELECT 'repo_name', CAST(count(*) - count(repo_name) AS BIGINT), CAST(count(*) AS BIGINT)
  FROM ({ORACLE["dim_repositories"]})
  UNION ALL
  SELECT 'stars', CAST(count(*) - count(stars) AS BIGINT), CAST(count(*) AS BIGINT)
  FROM ({ORACLE["dim_repositories"]}))
"""

_ENVELOPE_DOCS = {
    "repositories": "SELECT CAST(count(DISTINCT floor(repo_id / 50)) AS BIGINT) FROM repos",
    "repo_details": "SELECT CAST(count(*) AS BIGINT) FROM details",
    "commits": "SELECT CAST(count(DISTINCT (author_id, floor(comment_count / 50))) AS BIGINT) FROM commits",
    "issues": "SELECT CAST(count(DISTINCT floor(issue_id / 50)) AS BIGINT) FROM issues",
}
ORACLE["dq_layer_checks"] = oracle_with("repos", "details", "commits", "issues") + "\n" + \
    "\nUNION ALL\n".join(
        [f"SELECT 'landing' AS layer, 'envelope:{f}' AS check_name, true AS passed, ({q}) AS detail"
         for f, q in _ENVELOPE_DOCS.items()]
        + [f"SELECT layer, 'table:' || table_name, row_count >= 1, row_count "
           f"FROM ({_layer_rows()}) WHERE layer <> 'landing'"]
        + [f"SELECT 'quality', 'nulls:dim_repositories.' || column_name, "
           f"COALESCE(CAST(null_count AS DOUBLE) / row_count <= 0.1 AND row_count >= 1, false), null_count "
           f"FROM ({ORACLE['dq_silver_nulls']})"])

ORACLE["dq_missing_landing"] = f"""
SELECT layer, check_name, passed AND layer <> 'landing' AS passed,
  CASE WHEN layer = 'landing' THEN 0 ELSE detail END AS detail
FROM ({ORACLE['dq_layer_checks']})
"""
ORACLE["bronze_quarantine"] = """
SELECT 'commits' AS feed, CASE WHEN n % 7 = 0 THEN 'malformed' ELSE 'without_data' END AS reason,
  count(*) AS documents
FROM (SELECT conv_id * 8 + turn AS n FROM conversations) WHERE n % 7 = 0 OR n % 11 = 0 GROUP BY ALL
"""

ORACLE["silver_catalog_summary"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, {_count(ORACLE[t])} AS row_count, CAST({w} AS BIGINT) AS column_count"
    for t, w in _SILVER_WIDTHS.items())
