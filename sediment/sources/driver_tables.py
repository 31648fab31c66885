"""Bronze-shaped inputs derived from the benchmark tables.

The benchmark ships TPC-H-like tables rather than code-hosting data, so every registered
query first derives bronze-shaped frames from them with plain column expressions (no
sampling, no row caps: every input row becomes one record):

* repositories  <- ``documents``  (one repository per document; owner from ``source``)
* repo_details  <- ``labels``     (archived = toxic, private = low quality)
* commits       <- ``conversations`` (one commit per turn)
* issues        <- ``orders`` left-joined to its ``lineitem`` aggregate (one issue per order)

``ORACLE_CTES`` holds the same derivations in DuckDB SQL for the correctness oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

LOAD_TS = "2024-01-01 00:00:00"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def iso(ts: Column) -> Column:
    """Timestamp -> ISO-8601 text with a ``Z`` suffix, the landing format of times."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _cat(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else _s(p) for p in parts])


def _load_ts() -> Column:
    return F.lit(LOAD_TS).cast("timestamp").alias("bronze_ingestion_timestamp")


def repositories(documents: DataFrame) -> DataFrame:
    owner = F.regexp_extract("source", "([0-9]+)", 1).try_cast("bigint")
    created = F.expr("timestampadd(DAY, doc_id, TIMESTAMP_NTZ'2015-01-01 00:00:00')")
    updated = F.expr("timestampadd(HOUR, n_chars, timestampadd(DAY, doc_id, "
                     "TIMESTAMP_NTZ'2015-01-01 00:00:00'))")
    pushed = F.expr("timestampadd(MINUTE, doc_id, timestampadd(HOUR, n_chars, "
                    "timestampadd(DAY, doc_id, TIMESTAMP_NTZ'2015-01-01 00:00:00')))")
    d = documents.withColumn("_owner", owner)
    return d.select(
        F.col("doc_id").alias("repo_id"),
        _cat("doc", F.col("doc_id")).alias("repo_name"),
        _cat("u", F.col("_owner"), "/doc", F.col("doc_id")).alias("full_name"),
        F.col("text").alias("description"),
        _cat("https://github.com/u", F.col("_owner"), "/doc", F.col("doc_id")).alias("html_url"),
        _cat("https://github.com/u", F.col("_owner"), "/doc", F.col("doc_id"), ".git").alias("clone_url"),
        F.when(F.col("lang") == "en", "Python").when(F.col("lang") == "fr", "JavaScript")
         .when(F.col("lang") == "de", "C++").alias("language"),
        F.col("n_chars").alias("stars"),
        F.col("n_chars").alias("watchers"),
        F.floor(F.col("n_chars") / 10).cast("bigint").alias("forks"),
        F.floor(F.col("n_chars") / 100).cast("bigint").alias("open_issues"),
        F.col("n_chars").alias("size"),
        iso(created).alias("created_at"),
        iso(updated).alias("updated_at"),
        F.when(F.col("lang") != "es", iso(pushed)).alias("pushed_at"),
        F.when(F.col("lang") == "en", "main").when(F.col("lang") == "fr", "master").alias("default_branch"),
        F.col("_owner").alias("owner_id"),
        _cat("u", F.col("_owner")).alias("owner_login"),
        F.lit("User").alias("owner_type"),
        _cat("https://github.com/u", F.col("_owner")).alias("owner_url"),
        F.when(F.col("n_chars") > 1000, "MIT License").alias("license_name"),
        F.when(F.col("n_chars") > 1000, "mit").alias("license_key"),
        F.array(F.col("lang"), F.col("source")).alias("topics"),
        F.lit(None).cast("boolean").alias("archived"),
        F.lit(False).alias("disabled"),
        F.lit(None).cast("boolean").alias("private"),
        (F.col("lang") != "en").alias("fork"),
        _load_ts(),
    )


def repo_details(labels: DataFrame) -> DataFrame:
    none_s, none_l = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    return labels.select(
        F.col("doc_id").alias("repo_id"),
        _cat("doc", F.col("doc_id")).alias("repo_name"),
        none_s.alias("full_name"),
        F.when(F.col("quality") == 1, "curated").alias("description"),
        none_s.alias("html_url"), none_s.alias("clone_url"),
        F.lit("Java").alias("language"),
        none_l.alias("stars"), none_l.alias("watchers"), none_l.alias("forks"),
        none_l.alias("open_issues"), none_l.alias("size"),
        none_s.alias("created_at"), none_s.alias("updated_at"), none_s.alias("pushed_at"),
        none_s.alias("default_branch"),
        none_l.alias("owner_id"), none_s.alias("owner_login"), none_s.alias("owner_type"),
        none_s.alias("owner_url"), none_s.alias("license_name"), none_s.alias("license_key"),
        F.lit(None).cast("array<string>").alias("topics"),
        (F.col("toxic") == 1).alias("archived"),
        F.lit(False).alias("disabled"),
        (F.col("quality") == 0).alias("private"),
        F.lit(None).cast("boolean").alias("fork"),
        _load_ts(),
    )


def commits(conversations: DataFrame) -> DataFrame:
    sha = _cat(F.col("conv_id"), "-", F.col("turn"))
    authored = F.expr("timestampadd(MINUTE, turn, timestampadd(HOUR, conv_id, "
                      "TIMESTAMP_NTZ'2024-01-01 00:00:00'))")
    committed = F.expr("timestampadd(SECOND, length(text), timestampadd(MINUTE, turn, "
                       "timestampadd(HOUR, conv_id, TIMESTAMP_NTZ'2024-01-01 00:00:00')))")
    repo = _cat("u", F.col("turn"), "/doc", F.col("conv_id"))
    c = conversations.withColumns({"_sha": sha, "_repo": repo})
    return c.select(
        F.col("_sha").alias("commit_sha"),
        _cat("C_", F.col("_sha")).alias("node_id"),
        F.col("text").alias("message"),
        _cat("User ", F.col("conv_id")).alias("author_name"),
        _cat("u", F.col("conv_id"), "@example.com").alias("author_email"),
        iso(authored).alias("author_date"),
        _cat("User ", F.col("turn")).alias("committer_name"),
        _cat("u", F.col("turn"), "@example.com").alias("committer_email"),
        F.when(F.col("role") != "system", iso(committed)).alias("committer_date"),
        _cat("t", F.col("_sha")).alias("tree_sha"),
        _cat("https://api.github.com/repos/", F.col("_repo"), "/git/commits/", F.col("_sha")).alias("commit_url"),
        F.col("turn").alias("comment_count"),
        F.when(F.col("role") == "assistant", True).when(F.col("role") == "user", False)
         .alias("verification_verified"),
        F.when(F.col("role") == "assistant", "valid").when(F.col("role") == "user", "unsigned")
         .alias("verification_reason"),
        _cat("https://github.com/", F.col("_repo"), "/commit/", F.col("_sha")).alias("html_url"),
        _cat("https://api.github.com/repos/", F.col("_repo"), "/commits/", F.col("_sha"),
             "/comments").alias("comments_url"),
        F.col("conv_id").alias("author_id"),
        _cat("u", F.col("conv_id")).alias("author_login"),
        F.lit("User").alias("author_type"),
        _cat("https://github.com/u", F.col("conv_id")).alias("author_html_url"),
        F.col("turn").alias("committer_id"),
        _cat("u", F.col("turn")).alias("committer_login"),
        F.lit("User").alias("committer_type"),
        _cat("https://github.com/u", F.col("turn")).alias("committer_html_url"),
        F.when(F.col("turn") == 0, F.array().cast("array<string>"))
         .otherwise(F.array(_cat(F.col("conv_id"), "-", F.col("turn") - 1))).alias("parents"),
        _load_ts(),
    )


def order_lines(lineitem: DataFrame) -> DataFrame:
    """Per-order line aggregate (one shuffle on ``l_orderkey``, partial aggregation first)."""
    return lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.max("l_shipdate").alias("last_ship"),
        F.array_sort(F.collect_set("l_returnflag")).alias("flags"),
        F.min("l_suppkey").alias("first_supp"),
    )


def issues(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    lines = order_lines(lineitem)
    o = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")
    owner = F.substring("o_orderpriority", 1, 1)
    repo = _cat("u", owner, "/doc", F.col("o_custkey"))
    assignee = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("first_supp"))
    o = o.withColumns({"_repo": repo, "_assignee": assignee})
    return o.select(
        F.col("o_orderkey").alias("issue_id"),
        _cat("I_", F.col("o_orderkey")).alias("node_id"),
        F.col("o_orderkey").alias("issue_number"),
        F.repeat(F.concat(F.col("o_orderpriority"), F.lit(" ")),
                 (F.floor(F.col("o_totalprice") / 50000) + 1).cast("int")).alias("title"),
        F.when(F.col("o_orderstatus") != "P",
               F.repeat(F.col("o_orderpriority"),
                        F.floor(F.col("o_totalprice") / 5000).cast("int"))).alias("body"),
        F.when(F.col("o_orderstatus") == "F", "closed").when(F.col("o_orderstatus") == "O", "open")
         .otherwise("pending").alias("state"),
        (F.col("o_orderstatus") == "P").alias("locked"),
        F.col("_assignee").alias("assignee_id"),
        F.when(F.col("_assignee").isNotNull(), _cat("u", F.col("_assignee"))).alias("assignee_login"),
        F.when(F.col("_assignee").isNotNull(), F.lit("User")).alias("assignee_type"),
        F.when(F.col("_assignee").isNotNull(),
               _cat("https://github.com/u", F.col("_assignee"))).alias("assignee_html_url"),
        F.col("o_custkey").alias("user_id"),
        _cat("u", F.col("o_custkey")).alias("user_login"),
        F.lit("User").alias("user_type"),
        _cat("https://github.com/u", F.col("o_custkey")).alias("user_html_url"),
        F.filter("flags", lambda x: x != "N").alias("labels"),
        F.when(F.col("o_orderstatus") == "F", F.year("o_orderdate").cast("bigint")).alias("milestone_id"),
        F.when(F.col("o_orderstatus") == "F", _cat("Y", F.year("o_orderdate"))).alias("milestone_title"),
        F.lit(None).cast("string").alias("milestone_description"),
        F.when(F.col("o_orderstatus") == "F", F.lit("closed")).alias("milestone_state"),
        F.coalesce(F.col("n_lines"), F.lit(0)).cast("bigint").alias("comments_count"),
        iso(F.col("o_orderdate")).alias("created_at"),
        iso(F.col("last_ship")).alias("updated_at"),
        F.when(F.col("o_orderstatus") == "F", iso(F.col("last_ship"))).alias("closed_at"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "MEMBER").otherwise("NONE").alias("author_association"),
        F.when(F.col("o_orderstatus") == "P", F.lit("resolved")).alias("active_lock_reason"),
        F.when(F.col("o_totalprice") > 250000,
               _cat('{"url": "https://api.github.com/repos/', F.col("_repo"), "/pulls/",
                    F.col("o_orderkey"), '"}')).alias("pull_request"),
        _cat("https://github.com/", F.col("_repo"), "/issues/", F.col("o_orderkey")).alias("html_url"),
        _cat("https://api.github.com/repos/", F.col("_repo"), "/issues/", F.col("o_orderkey")).alias("url"),
        _load_ts(),
    )


def line_children(documents: DataFrame) -> dict[str, DataFrame]:
    """Child records whose URLs name the repositories of ``documents``: one issue and one commit for
    every line of a text, so that large repositories have many."""
    owner = F.regexp_extract("source", "([0-9]+)", 1).try_cast("bigint")
    rows = documents.select("doc_id", owner.alias("o"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    repo = _cat("https://github.com/u", F.col("o"), "/doc", F.col("doc_id"))
    number = F.lit(10 ** 12) + F.col("doc_id") * 10 ** 6 + F.col("pos")
    sha = _cat("L", F.col("doc_id"), "-", F.col("pos"))
    return {"issues": rows.select(number.alias("issue_id"), F.col("pos").cast("bigint").alias("user_id"),
                                  F.concat(repo, _cat("/issues/", number)).alias("html_url")),
            "commits": rows.select(sha.alias("commit_sha"), F.col("pos").cast("bigint").alias("author_id"),
                                   F.concat(repo, _cat("/commit/", sha)).alias("html_url"))}


# What the benchmark tables lack: missing and blank values, details of repositories that no
# search found, details without an id, conflicting values, every keyword of a message, busy
# issues, users of one role only, URLs of other hosts.  Every row stays; some values are set by
# the row's own numbers.  The expressions mean the same in Spark SQL and DuckDB.
VARIED = {
    "repositories": {
        "description": "CASE WHEN repo_id % 13 = 1 THEN '   ' WHEN repo_id % 13 <> 2 THEN description END",
        "language": ("CASE WHEN language = 'C++' AND repo_id % 2 = 0 THEN 'C#' "
                     "WHEN language IS NULL AND repo_id % 3 = 0 THEN 'Java' ELSE language END"),
        "stars": "CASE WHEN repo_id % 19 <> 4 THEN stars END",
        "created_at": "CASE WHEN repo_id % 23 <> 6 THEN created_at END",
        "owner_type": "CASE WHEN repo_id % 5 = 0 THEN 'Organization' WHEN repo_id % 7 <> 3 THEN owner_type END",
        "archived": "CASE WHEN repo_id % 29 = 8 THEN true ELSE archived END",
        "disabled": "(repo_id % 17 = 0)",
    },
    "repo_details": {
        "repo_id": "CASE WHEN repo_id % 10 = 3 THEN -1 - repo_id WHEN repo_id % 10 <> 7 THEN repo_id END",
        "stars": "CASE WHEN repo_id % 4 = 1 THEN CAST(5000 AS BIGINT) END",
        "forks": "CASE WHEN repo_id % 4 = 1 THEN CAST(250 AS BIGINT) END",
    },
    "commits": {
        "message": ("CASE (author_id + comment_count) % 10 WHEN 0 THEN concat('fix: ', message) "
                    "WHEN 1 THEN concat('feature: ', message) WHEN 2 THEN concat('refactor: ', message) "
                    "WHEN 3 THEN concat('style: ', message) WHEN 4 THEN concat('test: ', message) "
                    "WHEN 5 THEN concat('doc: ', message) WHEN 6 THEN NULL ELSE message END"),
        "author_email": "CASE WHEN author_id % 11 = 0 THEN '' ELSE author_email END",
        "author_name": "CASE WHEN author_id % 11 = 1 THEN '  ' WHEN author_id % 11 <> 2 THEN author_name END",
        "author_type": "CASE WHEN author_id % 9 <> 0 THEN author_type END",
        "committer_id": "CASE WHEN comment_count = 1 THEN 1000000 + author_id ELSE committer_id END",
    },
    "issues": {
        "comments_count": "comments_count * 4",
        "assignee_id": "CASE WHEN issue_id % 3 = 0 THEN 2000000 + assignee_id ELSE assignee_id END",
        "html_url": ("CASE WHEN issue_id % 31 = 0 THEN concat('https://git.example.org/a/b/issues/', "
                     "CAST(issue_id AS STRING)) WHEN issue_id % 37 <> 0 THEN html_url END"),
    },
}


# A former state of some records, landed earlier: the newest landing must win over it.
FORMER_TS = "2024-05-01T00:00:00"
FORMER = {
    "repositories": {"stars": "stars + 1", "owner_id": "owner_id + 3", "language": "'Cobol'"},
    "repo_details": {"description": "'as it was'"},
    "commits": {"message": "'as it was'", "committer_id": "committer_id + 5"},
    "issues": {"title": "'as it was'", "assignee_id": "coalesce(assignee_id, 0) + 7", "state": "'open'"},
}


def former(df: DataFrame, feed: str, key: str) -> DataFrame:
    """Every third record as it was."""
    return df.where(F.col(key).isNotNull() & (F.pmod(F.xxhash64(key), F.lit(3)) == 0)).withColumns(
        {c: F.expr(e).cast(df.schema[c].dataType) for c, e in FORMER[feed].items()})


def varied(df: DataFrame, feed: str) -> DataFrame:
    return df.withColumns({c: F.expr(e).cast(df.schema[c].dataType) for c, e in VARIED[feed].items()})


def bronze_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four bronze-shaped frames, lazily derived from the benchmark tables."""
    plain = {
        "repositories": repositories(read(spark, sf_dir, "documents")),
        "repo_details": repo_details(read(spark, sf_dir, "labels")),
        "commits": commits(read(spark, sf_dir, "conversations")),
        "issues": issues(read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")),
    }
    return {feed: varied(df, feed) for feed, df in plain.items()}


# ---------------------------------------------------------------------------------------------
# The same derivations in DuckDB SQL, for the oracle.
# ---------------------------------------------------------------------------------------------
def _iso_sql(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')"


_REPO_TS = "(TIMESTAMP '2015-01-01 00:00:00' + to_days(CAST(doc_id AS INTEGER)))"
_COMMIT_TS = ("(TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(conv_id AS BIGINT))"
              " + to_minutes(CAST(turn AS BIGINT)))")

ORACLE_CTES = {
    "repos": f"""
SELECT doc_id AS repo_id,
  'doc' || CAST(doc_id AS VARCHAR) AS repo_name,
  'u' || CAST(o AS VARCHAR) || '/doc' || CAST(doc_id AS VARCHAR) AS full_name,
  text AS description,
  'https://github.com/u' || CAST(o AS VARCHAR) || '/doc' || CAST(doc_id AS VARCHAR) AS html_url,
  'https://github.com/u' || CAST(o AS VARCHAR) || '/doc' || CAST(doc_id AS VARCHAR) || '.git' AS clone_url,
  CASE WHEN lang = 'en' THEN 'Python' WHEN lang = 'fr' THEN 'JavaScript' WHEN lang = 'de' THEN 'C++' END AS language,
  n_chars AS stars, n_chars AS watchers,
  CAST(floor(n_chars / 10) AS BIGINT) AS forks,
  CAST(floor(n_chars / 100) AS BIGINT) AS open_issues,
  n_chars AS size,
  {_iso_sql(_REPO_TS)} AS created_at,
  {_iso_sql(f"({_REPO_TS} + to_hours(n_chars))")} AS updated_at,
  CASE WHEN lang <> 'es' THEN {_iso_sql(f"({_REPO_TS} + to_hours(n_chars) + to_minutes(doc_id))")} END AS pushed_at,
  CASE WHEN lang = 'en' THEN 'main' WHEN lang = 'fr' THEN 'master' END AS default_branch,
  o AS owner_id,
  'u' || CAST(o AS VARCHAR) AS owner_login,
  'User' AS owner_type,
  'https://github.com/u' || CAST(o AS VARCHAR) AS owner_url,
  CASE WHEN n_chars > 1000 THEN 'MIT License' END AS license_name,
  CASE WHEN n_chars > 1000 THEN 'mit' END AS license_key,
  [lang, source] AS topics,
  CAST(NULL AS BOOLEAN) AS archived,
  false AS disabled,
  CAST(NULL AS BOOLEAN) AS private,
  (lang <> 'en') AS fork
FROM (SELECT *, TRY_CAST(regexp_extract(source, '([0-9]+)', 1) AS BIGINT) AS o FROM documents)""",
    "details": """
SELECT doc_id AS repo_id, 'doc' || CAST(doc_id AS VARCHAR) AS repo_name,
  CAST(NULL AS VARCHAR) AS full_name,
  CASE WHEN quality = 1 THEN 'curated' END AS description,
  CAST(NULL AS VARCHAR) AS html_url, CAST(NULL AS VARCHAR) AS clone_url,
  'Java' AS language,
  CAST(NULL AS BIGINT) AS stars, CAST(NULL AS BIGINT) AS watchers, CAST(NULL AS BIGINT) AS forks,
  CAST(NULL AS BIGINT) AS open_issues, CAST(NULL AS BIGINT) AS size,
  CAST(NULL AS VARCHAR) AS created_at, CAST(NULL AS VARCHAR) AS updated_at,
  CAST(NULL AS VARCHAR) AS pushed_at, CAST(NULL AS VARCHAR) AS default_branch,
  CAST(NULL AS BIGINT) AS owner_id, CAST(NULL AS VARCHAR) AS owner_login,
  CAST(NULL AS VARCHAR) AS owner_type, CAST(NULL AS VARCHAR) AS owner_url,
  CAST(NULL AS VARCHAR) AS license_name, CAST(NULL AS VARCHAR) AS license_key,
  CAST(NULL AS VARCHAR[]) AS topics,
  (toxic = 1) AS archived, false AS disabled, (quality = 0) AS private,
  CAST(NULL AS BOOLEAN) AS fork
FROM labels""",
    "commits": f"""
SELECT sha AS commit_sha, 'C_' || sha AS node_id, text AS message,
  'User ' || CAST(conv_id AS VARCHAR) AS author_name,
  'u' || CAST(conv_id AS VARCHAR) || '@example.com' AS author_email,
  {_iso_sql(_COMMIT_TS)} AS author_date,
  'User ' || CAST(turn AS VARCHAR) AS committer_name,
  'u' || CAST(turn AS VARCHAR) || '@example.com' AS committer_email,
  CASE WHEN role <> 'system' THEN {_iso_sql(f"({_COMMIT_TS} + to_seconds(CAST(length(text) AS BIGINT)))")} END AS committer_date,
  't' || sha AS tree_sha,
  'https://api.github.com/repos/' || repo || '/git/commits/' || sha AS commit_url,
  turn AS comment_count,
  CASE WHEN role = 'assistant' THEN true WHEN role = 'user' THEN false END AS verification_verified,
  CASE WHEN role = 'assistant' THEN 'valid' WHEN role = 'user' THEN 'unsigned' END AS verification_reason,
  'https://github.com/' || repo || '/commit/' || sha AS html_url,
  'https://api.github.com/repos/' || repo || '/commits/' || sha || '/comments' AS comments_url,
  conv_id AS author_id, 'u' || CAST(conv_id AS VARCHAR) AS author_login, 'User' AS author_type,
  'https://github.com/u' || CAST(conv_id AS VARCHAR) AS author_html_url,
  turn AS committer_id, 'u' || CAST(turn AS VARCHAR) AS committer_login, 'User' AS committer_type,
  'https://github.com/u' || CAST(turn AS VARCHAR) AS committer_html_url,
  CASE WHEN turn = 0 THEN CAST([] AS VARCHAR[])
       ELSE [CAST(conv_id AS VARCHAR) || '-' || CAST(turn - 1 AS VARCHAR)] END AS parents
FROM (SELECT *, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS sha,
             'u' || CAST(turn AS VARCHAR) || '/doc' || CAST(conv_id AS VARCHAR) AS repo
      FROM conversations)""",
    "issues": f"""
SELECT o_orderkey AS issue_id, 'I_' || CAST(o_orderkey AS VARCHAR) AS node_id,
  o_orderkey AS issue_number,
  repeat(o_orderpriority || ' ', CAST(floor(o_totalprice / 50000) + 1 AS INTEGER)) AS title,
  CASE WHEN o_orderstatus <> 'P' THEN repeat(o_orderpriority, CAST(floor(o_totalprice / 5000) AS INTEGER)) END AS body,
  CASE WHEN o_orderstatus = 'F' THEN 'closed' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'pending' END AS state,
  (o_orderstatus = 'P') AS locked,
  asg AS assignee_id,
  CASE WHEN asg IS NOT NULL THEN 'u' || CAST(asg AS VARCHAR) END AS assignee_login,
  CASE WHEN asg IS NOT NULL THEN 'User' END AS assignee_type,
  CASE WHEN asg IS NOT NULL THEN 'https://github.com/u' || CAST(asg AS VARCHAR) END AS assignee_html_url,
  o_custkey AS user_id, 'u' || CAST(o_custkey AS VARCHAR) AS user_login, 'User' AS user_type,
  'https://github.com/u' || CAST(o_custkey AS VARCHAR) AS user_html_url,
  list_filter(flags, lambda x: x <> 'N') AS labels,
  CASE WHEN o_orderstatus = 'F' THEN CAST(year(o_orderdate) AS BIGINT) END AS milestone_id,
  CASE WHEN o_orderstatus = 'F' THEN 'Y' || CAST(year(o_orderdate) AS VARCHAR) END AS milestone_title,
  CAST(NULL AS VARCHAR) AS milestone_description,
  CASE WHEN o_orderstatus = 'F' THEN 'closed' END AS milestone_state,
  CAST(coalesce(n_lines, 0) AS BIGINT) AS comments_count,
  {_iso_sql("o_orderdate")} AS created_at,
  {_iso_sql("last_ship")} AS updated_at,
  CASE WHEN o_orderstatus = 'F' THEN {_iso_sql("last_ship")} END AS closed_at,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'MEMBER' ELSE 'NONE' END AS author_association,
  CASE WHEN o_orderstatus = 'P' THEN 'resolved' END AS active_lock_reason,
  CASE WHEN o_totalprice > 250000 THEN '{{"url": "https://api.github.com/repos/' || repo || '/pulls/' || CAST(o_orderkey AS VARCHAR) || '"}}' END AS pull_request,
  'https://github.com/' || repo || '/issues/' || CAST(o_orderkey AS VARCHAR) AS html_url,
  'https://api.github.com/repos/' || repo || '/issues/' || CAST(o_orderkey AS VARCHAR) AS url
FROM (
  SELECT o.*, li.*,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN li.first_supp END AS asg,
    'u' || substr(o_orderpriority, 1, 1) || '/doc' || CAST(o_custkey AS VARCHAR) AS repo
  FROM orders o LEFT JOIN (
    SELECT l_orderkey, count(*) AS n_lines, max(l_shipdate) AS last_ship,
           list_sort(list(DISTINCT l_returnflag)) AS flags,
           min(l_suppkey) AS first_supp
    FROM lineitem GROUP BY l_orderkey) li ON o.o_orderkey = li.l_orderkey)""",
}


ORACLE_LINES = """
SELECT doc_id, 'https://github.com/u' || CAST(o AS VARCHAR) || '/doc' || CAST(doc_id AS VARCHAR) AS repo,
       pos - 1 AS pos, 1000000000000 + doc_id * 1000000 + pos - 1 AS number,
       'L' || CAST(doc_id AS VARCHAR) || '-' || CAST(pos - 1 AS VARCHAR) AS sha
FROM (SELECT doc_id, TRY_CAST(regexp_extract(source, '([0-9]+)', 1) AS BIGINT) AS o,
             unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)"""


def oracle_with(*names: str) -> str:
    """``WITH`` clause defining the named adapter CTEs (repos, details, commits, issues)."""
    feeds = {"repos": "repositories", "details": "repo_details"}
    parts = []
    for n in names:
        values = ", ".join(f"{e} AS {c}" for c, e in VARIED[feeds.get(n, n)].items())
        parts.append(f"{n} AS (SELECT * REPLACE ({values}) FROM ({ORACLE_CTES[n]}))")
    return "WITH " + ",\n".join(parts) + "\n"
