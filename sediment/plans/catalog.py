"""Registered queries: each runs one engine operator over bronze-shaped frames derived from the
benchmark tables (``sources.driver_tables``) and returns a DataFrame.

Load-time stamps (``current_timestamp``) are dropped from the registered results so they can
be compared value by value with the SQL oracle in ``plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.functions import rules as R
from sediment.operators.colocate import colocated_left_join
from sediment.operators.feeds import (CHILDREN_PER_REPOSITORY, MIN_STARS, REPOSITORIES_PER_RUN,
                                      TOP_REPOSITORIES, children_of, search_filter, search_many, top_k,
                                      top_k_per_group)
from sediment.operators.joins import left_join_keys, fanout_left_join
from sediment.operators.merge import SMALL_LOSERS, merge_coalesce
from sediment.operators.roles import GRAIN, role_aggregate, role_union
from sediment.plans import silver
from sediment.plans.bronze import REPO_FIELDS, build_bronze, flatten, quarantined, unflatten
from sediment.plans.jobs import run_writes
from sediment.plans.quality import layer_summary, null_counts, thresholds
from sediment.plans.run import build_silver, layer_checks, layered_summary, run_layers
from sediment.schemas import BRONZE_KEYS, FEEDS, LOAD_TS
from sediment.session import scratch_path
from sediment.sources import driver_tables as dt
from sediment.sources.landing import (RECORDS_PER_FILE, envelope_report, feed_records, file_report,
                                      route_feed, scan_feed, scan_variant, schema_drift,
                                      variant_records, write_documents, write_envelopes)
from sediment.sources.tables import (catalog_summary, ensure_schema, save_table, table_summary,
                                     write_clustered, write_parquet)

# Language and document id in a page URL such as ``https://host/en/25#top``.
PAGE_URL_PATTERN = r"/([a-z]{2})/([0-9]+)"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _no_stamps(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in LOAD_TS if c in df.columns])


# --- silver builders (T1-T6) -----------------------------------------------------------------
@register("dim_repositories")
def q_dim_repositories(spark, sf):
    b = dt.bronze_inputs(spark, sf)
    return _no_stamps(silver.dim_repositories(b["repositories"], b["repo_details"]))


@register("dim_repo_permissions")
def q_dim_repo_permissions(spark, sf):
    b = dt.bronze_inputs(spark, sf)
    return _no_stamps(silver.dim_repo_permissions(b["repositories"], b["repo_details"]))


@register("dim_users")
def q_dim_users(spark, sf):
    b = dt.bronze_inputs(spark, sf)
    return _no_stamps(silver.dim_users(b["repositories"], b["commits"], b["issues"]))


@register("dim_users_by_user")
def q_dim_users_by_user(spark, sf):
    b = dt.bronze_inputs(spark, sf)
    return _no_stamps(silver.dim_users(b["repositories"], b["commits"], b["issues"], grain="user"))


@register("dim_users_by_person")
def q_dim_users_by_person(spark, sf):
    """Ids that share a login or an e-mail address, of values that at most 20 ids use, as one person."""
    b = dt.bronze_inputs(spark, sf)
    return _no_stamps(silver.dim_users(b["repositories"], b["commits"], b["issues"], grain="person"))


@register("fact_commits")
def q_fact_commits(spark, sf):
    b = dt.bronze_inputs(spark, sf)
    return _no_stamps(silver.fact_commits(b["commits"], b["repositories"]))


@register("fact_issues")
def q_fact_issues(spark, sf):
    b = dt.bronze_inputs(spark, sf)
    return _no_stamps(silver.fact_issues(b["issues"], b["repositories"]))


def _colocated_fact(name: str, feed: str, row_key: str) -> Query:
    """The fact from bronze tables that are stored bucketed by the repository."""
    def q(spark, sf):
        b = dt.bronze_inputs(spark, sf)
        schema = _own_schema(spark)
        facts, repos = silver.store_colocated(b[feed], b["repositories"], feed, row_key, schema,
                                              scratch_path(spark, schema))
        build = getattr(silver, name)
        return _without_schema(spark, schema, _no_stamps(build(facts, repos, join=colocated_left_join)))
    return q


register("fact_commits_colocated")(_colocated_fact("fact_commits", "commits", "commit_sha"))
register("fact_issues_colocated")(_colocated_fact("fact_issues", "issues", "issue_id"))


@register("fact_pull_requests")
def q_fact_pull_requests(spark, sf):
    b = dt.bronze_inputs(spark, sf)
    return _no_stamps(silver.fact_pull_requests(b["issues"], b["repositories"]))


@register("fact_pull_requests_by_url")
def q_fact_pull_requests_by_url(spark, sf):
    """Each pull request with the one repository that its URL names."""
    b = dt.bronze_inputs(spark, sf)
    return _no_stamps(silver.fact_pull_requests(b["issues"], b["repositories"], repo_by="url"))


@register("load_stamps")
def q_load_stamps(spark, sf):
    """Load times of the merged repositories, as epoch seconds: the later stamp of both sides,
    the first side's stamp where there is one, and a pinned time of this run."""
    def stamped(df, start: str, gap: int):
        at = F.lit(start).cast("timestamp") + F.make_dt_interval(F.pmod("repo_id", F.lit(90)).cast("int"))
        return df.withColumn("bronze_ingestion_timestamp", F.when(F.pmod("repo_id", F.lit(gap)) != 0, at))
    b = dt.bronze_inputs(spark, sf)
    merged = silver.repo_merge(stamped(b["repositories"], "2024-01-01 00:00:00", 3),
                               stamped(b["repo_details"], "2024-02-01 00:00:00", 4), drop_null_keys=True)
    now = F.lit("2024-06-01 12:00:00").cast("timestamp")
    latest = silver.dim_repositories_from_merge(merged, now)
    first = silver.dim_repo_permissions_from_merge(merged, now)
    return latest.select("repo_id", F.unix_timestamp("bronze_ingestion_timestamp").alias("latest"),
                         F.unix_timestamp("silver_ingestion_timestamp").alias("loaded")).join(
        first.select("repo_id", F.unix_timestamp("bronze_ingestion_timestamp").alias("first")), "repo_id")


# --- landing helpers ---------------------------------------------------------------------------
# Landing time of the derived documents and the API page size.
LAND_TS = "2024-06-01T00:00:00"
PAGE_SIZE = 50


def _pages(feed: str) -> list:
    """Page key of each feed: at most PAGE_SIZE records share a landing document."""
    if feed == "repositories":
        return [F.floor(F.col("repo_id") / PAGE_SIZE).alias("_page")]
    if feed == "issues":
        return [F.floor(F.col("issue_id") / PAGE_SIZE).alias("_page")]
    if feed == "commits":
        # (author_id, comment_count) is (conv_id, turn) in the derived commits: unique, so a
        # page holds at most PAGE_SIZE commits.
        return [F.col("author_id").alias("_author"),
                F.floor(F.col("comment_count") / PAGE_SIZE).alias("_page")]
    return []


def land(spark: SparkSession, sf: str, feeds=FEEDS, landing: str | None = None,
         former: bool = False) -> str:
    """Write the derived records of ``feeds`` as JSON Lines envelopes into fresh scratch space, or
    into ``landing``; ``former``: every third record as it was, landed a month earlier."""
    inputs = dt.bronze_inputs(spark, sf)
    landing = landing or scratch_path(spark, "landing")

    def write(feed: str):
        rows = dt.former(inputs[feed], feed, BRONZE_KEYS[feed][0]) if former else inputs[feed]
        recs = unflatten(rows, feed, keep=tuple(_pages(feed)))
        page = [n for n in ("_author", "_page") if n in recs.columns]
        return lambda: write_envelopes(recs, feed, landing, page, F.lit(dt.FORMER_TS if former else LAND_TS))
    run_writes({feed: write(feed) for feed in feeds})
    return landing


def _bronze_query(feed: str) -> Query:
    def q(spark, sf):
        # A third of the records are landed twice, with other values and times.
        landing = land(spark, sf, [feed])
        land(spark, sf, [feed], landing, former=True)
        out = scratch_path(spark, "bronze")
        # The commits' replaced rows take the way without a broadcast.
        few = 0 if feed == "commits" else SMALL_LOSERS
        paths = build_bronze(spark, landing, out, layout="lines", feeds=[feed], small_losers=few)
        return _no_stamps(spark.read.parquet(paths[feed]))
    q.__name__ = f"q_bronze_{feed}"
    return q


for _feed in FEEDS:
    register(f"bronze_{_feed}")(_bronze_query(_feed))


@register("landing_envelope_roundtrip")
def q_landing_envelope_roundtrip(spark, sf):
    landing = land(spark, sf, ["repositories"])
    docs = scan_feed(spark, landing, "repositories", layout="lines")
    return _no_stamps(flatten(feed_records(docs, "repositories"), "repositories"))


@register("landing_json_scan")
def q_landing_json_scan(spark, sf):
    landing = land(spark, sf, ["issues"])
    docs = scan_feed(spark, landing, "issues", layout="lines")
    return docs.select(
        F.array_min(F.transform("data.issues", lambda x: x["id"])).alias("first_issue_id"),
        F.size("data.issues").cast("bigint").alias("items"),
        F.col("ingestion_timestamp"),
        F.col("_corrupt_record").isNotNull().alias("malformed"))


@register("json_explode_flatten")
def q_json_explode_flatten(spark, sf):
    landing = land(spark, sf, ["commits"])
    docs = scan_feed(spark, landing, "commits", layout="lines")
    return _no_stamps(flatten(feed_records(docs, "commits"), "commits"))


@register("struct_star_expand")
def q_struct_star_expand(spark, sf):
    landing = land(spark, sf, ["repo_details"])
    docs = scan_feed(spark, landing, "repo_details", layout="lines")
    star = docs.select("data.*")
    return star.select(*[F.col(src).alias(dst) for src, dst in REPO_FIELDS])


@register("landing_route_by_name")
def q_landing_route_by_name(spark, sf):
    """File names the API client would give each landed document, routed to their feed."""
    b = dt.bronze_inputs(spark, sf)
    stamp = "_20240601_000000.json"
    repos = (b["repositories"].select(F.floor(F.col("repo_id") / PAGE_SIZE).alias("p")).distinct()
             .select(F.concat(F.lit("repositories_"), F.col("p").cast("string"), F.lit(stamp))
                     .alias("file_name")))
    details = b["repo_details"].select(
        F.concat(F.lit("repo_details_"), F.col("repo_name"), F.lit(stamp)).alias("file_name"))
    children = []
    for feed in ("commits", "issues"):
        u = silver.with_url_repo(b[feed]).select("_url_owner", "_url_repo").distinct()
        children.append(u.select(F.concat(F.lit(f"{feed}_"), F.col("_url_owner"), F.lit("_"),
                                          F.col("_url_repo"), F.lit(stamp)).alias("file_name")))
    # Names that mislead an unanchored test, and names of no feed.
    name = F.col("repo_name")
    odd = b["repositories"].select(F.explode(F.array(
        F.concat(F.lit("commits_"), name, F.lit("_awesome-repositories"), F.lit(stamp)),
        F.concat(F.lit("issues_"), name, F.lit("_commits-tool"), F.lit(stamp)),
        F.concat(F.lit("notes_"), name, F.lit("_issues"), F.lit(stamp)))).alias("file_name"))
    names = repos.unionByName(details).unionByName(children[0]).unionByName(children[1]).unionByName(odd)
    return names.select("file_name", route_feed("file_name").alias("feed"))


# --- sinks and summaries -----------------------------------------------------------------------
@register("bronze_parquet_roundtrip")
def q_bronze_parquet_roundtrip(spark, sf):
    path = write_parquet(dt.read(spark, sf, "supplier"), scratch_path(spark, "parquet"))
    spark.read.parquet(path).createOrReplaceTempView("sediment_bronze_supplier")
    return spark.sql("SELECT * FROM sediment_bronze_supplier")


def _own_schema(spark: SparkSession) -> str:
    schema = f"sediment_silver_{uuid.uuid4().hex[:8]}"
    ensure_schema(spark, schema, scratch_path(spark, schema))
    return schema


def _without_schema(spark: SparkSession, schema: str, df: DataFrame) -> DataFrame:
    """``df``, already resolved against external tables of ``schema``, which is then dropped:
    the files stay, no catalog entry is left behind."""
    df.schema  # resolve the plan
    spark.sql(f"DROP SCHEMA {schema} CASCADE")
    return df


@register("silver_table_roundtrip")
def q_silver_table_roundtrip(spark, sf):
    schema = _own_schema(spark)
    name = save_table(dt.read(spark, sf, "customer"), "sediment_customer", schema,
                      scratch_path(spark, "silver_customer"))
    return _without_schema(spark, schema, spark.read.table(name))


@register("silver_catalog_summary")
def q_silver_catalog_summary(spark, sf):
    """Six silver tables saved into a catalog schema, then summarised through the catalog."""
    schema = _own_schema(spark)
    build_silver(spark, dt.bronze_inputs(spark, sf), scratch_path(spark, "silver"), schema=schema)
    return _without_schema(spark, schema, catalog_summary(spark, schema))


@register("table_summary")
def q_table_summary(spark, sf):
    return table_summary({t: dt.read(spark, sf, t) for t in dt.TABLES})


def _run(spark, sf):
    landing = land(spark, sf)
    work = scratch_path(spark, "run")
    return landing, work


@register("landing_to_silver_run")
def q_landing_to_silver_run(spark, sf):
    landing, work = _run(spark, sf)
    landed: dict = {}
    bronze = build_bronze(spark, landing, f"{work}/bronze", layout="lines", landed=landed)
    frames = {t: spark.read.parquet(p) for t, p in bronze.items()}
    silver_paths = build_silver(spark, frames, f"{work}/silver")
    return layered_summary(spark, None, bronze, silver_paths, landed=landed)


@register("layer_summary")
def q_layer_summary(spark, sf):
    return layer_summary(q_landing_to_silver_run(spark, sf))


@register("dq_missing_tables")
def q_dq_missing_tables(spark, sf):
    landing, work = _run(spark, sf)
    return run_layers(spark, landing, work, layout="lines")


@register("dq_envelope")
def q_dq_envelope(spark, sf):
    landing = land(spark, sf)
    _faulty_commits(spark, sf, landing)
    return reduce(DataFrame.unionByName,
                  [envelope_report(scan_feed(spark, landing, f, "lines"), f) for f in FEEDS])


@register("dq_null_counts")
def q_dq_null_counts(spark, sf):
    return null_counts(_no_stamps(dt.bronze_inputs(spark, sf)["issues"]))


@register("dq_silver_nulls")
def q_dq_silver_nulls(spark, sf):
    """Null counts of the repository dimension's key, name and stars (the silver check)."""
    b = dt.bronze_inputs(spark, sf)
    dim = silver.dim_repositories(b["repositories"], b["repo_details"])
    return null_counts(dim, ["repo_id", "repo_name", "stars"])


@register("dq_layer_checks")
def q_dq_layer_checks(spark, sf):
    landing, work = _run(spark, sf)
    run_layers(spark, landing, work, layout="lines")
    return layer_checks(spark, landing, work, layout="lines")


@register("dq_missing_landing")
def q_dq_missing_landing(spark, sf):
    """The checks against a landing path that holds nothing: landing fails, tables are untouched."""
    landing, work = _run(spark, sf)
    run_layers(spark, landing, work, layout="lines")
    return layer_checks(spark, f"{landing}-elsewhere", work, layout="lines")


def _faulty_commits(spark, sf, landing: str) -> None:
    """Land commit documents of which every seventh message is cut off and every eleventh holds no
    payload."""
    c = dt.bronze_inputs(spark, sf)["commits"].select("commit_sha", "message", "comment_count", "author_id")
    body = F.to_json(F.struct(F.lit(LAND_TS).alias("ingestion_timestamp"), F.struct(F.array(F.struct(
        F.col("commit_sha").alias("sha"), F.struct("message").alias("commit"))).alias("commits")).alias("data")))
    n = F.col("author_id") * 8 + F.col("comment_count")
    line = (F.when(n % 7 == 0, F.concat(F.lit('{"data": '), F.lit('"'), F.col("commit_sha")))
            .when(n % 11 == 0, F.to_json(F.struct(F.lit(LAND_TS).alias("ingestion_timestamp"))))
            .otherwise(body))
    c.select(line.alias("value")).write.mode("append").option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_FILE).text(f"{landing}/feed=commits")


@register("bronze_quarantine")
def q_bronze_quarantine(spark, sf):
    """What bronze could not use of faulty commit documents, by reason."""
    landing, work = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    _faulty_commits(spark, sf, landing)
    build_bronze(spark, landing, work, layout="lines", feeds=["commits"])
    return quarantined(spark, work).groupBy("feed", "reason").agg(F.count(F.lit(1)).alias("documents"))


@register("dq_thresholds")
def q_dq_thresholds(spark, sf):
    return thresholds(_no_stamps(dt.bronze_inputs(spark, sf)["issues"]))


# --- feed selection ------------------------------------------------------------------------------
@register("feed_filter")
def q_feed_filter(spark, sf):
    repos = dt.bronze_inputs(spark, sf)["repositories"]
    return search_filter(repos, language="python", min_stars=MIN_STARS).select(
        "repo_id", "repo_name", "language", "stars")


@register("feed_filter_configured")
def q_feed_filter_configured(spark, sf):
    repos = dt.bronze_inputs(spark, sf)["repositories"]
    return search_many(repos).select("search", "repo_id", "language", "stars")


@register("feed_topk")
def q_feed_topk(spark, sf):
    repos = dt.bronze_inputs(spark, sf)["repositories"]
    return top_k(repos.select("repo_id", "repo_name", "stars"), REPOSITORIES_PER_RUN,
                 [F.desc("stars"), F.asc("repo_id")])


@register("feed_topk_per_group")
def q_feed_topk_per_group(spark, sf):
    return _newest_children(silver.with_url_repo(dt.bronze_inputs(spark, sf)["issues"]),
                            "issue_id", "created_at")


@register("feed_topk_per_group_commits")
def q_feed_topk_per_group_commits(spark, sf):
    return _newest_children(silver.with_url_repo(dt.bronze_inputs(spark, sf)["commits"]),
                            "commit_sha", "author_date")


def _newest_children(children: DataFrame, key: str, time: str) -> DataFrame:
    """The newest child records of every (owner, repository)."""
    rows = children.select(key, time, F.col("_url_owner").alias("repo_owner"),
                           F.col("_url_repo").alias("repo_name"))
    return top_k_per_group(rows, ["repo_owner", "repo_name"], [F.desc(time), F.asc(key)],
                           CHILDREN_PER_REPOSITORY)


@register("feed_children_of_topk")
def q_feed_children_of_topk(spark, sf):
    return _children_of_top(spark, sf, "issues", "issue_id", "user_id")


@register("feed_children_of_topk_commits")
def q_feed_children_of_topk_commits(spark, sf):
    return _children_of_top(spark, sf, "commits", "commit_sha", "author_id")


@register("feed_children_of_starred")
def q_feed_children_of_starred(spark, sf):
    return _children_of_starred(spark, sf, "issues", "issue_id", "user_id")


@register("feed_children_of_starred_commits")
def q_feed_children_of_starred_commits(spark, sf):
    return _children_of_starred(spark, sf, "commits", "commit_sha", "author_id")


def _family(spark, sf, feed: str, *columns: str) -> tuple[DataFrame, DataFrame]:
    """The repositories, and the records of a child feed with the repository their URL names."""
    b = dt.bronze_inputs(spark, sf)
    repos = b["repositories"].select("repo_id", "owner_login", "repo_name", "stars")
    lines = dt.line_children(dt.read(spark, sf, "documents"))[feed]
    return repos, silver.with_url_repo(b[feed].select(*columns, "html_url").union(lines))


def _children_of_top(spark, sf, feed: str, *columns: str) -> DataFrame:
    """Children of the most starred repositories, matched on (owner, repository)."""
    repos, children = _family(spark, sf, feed, *columns)
    return children_of(children, repos, ["_url_owner", "_url_repo"], ["owner_login", "repo_name"],
                       TOP_REPOSITORIES, [F.desc("stars"), F.asc("repo_id")]).select(
        *columns, F.col("_url_owner").alias("repo_owner"), F.col("_url_repo").alias("repo_name"))


def _children_of_starred(spark, sf, feed: str, *columns: str) -> DataFrame:
    """Children of every repository above the search's star floor, however many there are."""
    repos, children = _family(spark, sf, feed, *columns)
    starred = search_filter(repos, min_stars=MIN_STARS)
    return children_of(children, starred, ["_url_owner", "_url_repo"], ["owner_login", "repo_name"]).select(
        *columns, F.col("_url_owner").alias("repo_owner"), F.col("_url_repo").alias("repo_name"))


@register("feed_filter_state")
def q_feed_filter_state(spark, sf):
    """Issues of one state (the request's state argument; no star floor)."""
    issues = dt.bronze_inputs(spark, sf)["issues"]
    return search_filter(issues, min_stars=None, state="open").select("issue_id", "state")


# --- merges, unions, joins -----------------------------------------------------------------------
@register("full_outer_coalesce_merge")
def q_full_outer_coalesce_merge(spark, sf):
    b = dt.bronze_inputs(spark, sf)
    return merge_coalesce(b["repositories"], b["repo_details"], ["repo_id"], silver.REPO_COLUMNS)


@register("role_union")
def q_role_union(spark, sf):
    b = dt.bronze_inputs(spark, sf)
    return role_union(b["repositories"], b["commits"], b["issues"])


@register("role_aggregate")
def q_role_aggregate(spark, sf):
    b = dt.bronze_inputs(spark, sf)
    return role_aggregate(role_union(b["repositories"], b["commits"], b["issues"]))


@register("role_classify")
def q_role_classify(spark, sf):
    b = dt.bronze_inputs(spark, sf)
    agg = role_aggregate(role_union(b["repositories"], b["commits"], b["issues"]))
    return agg.select(*GRAIN, R.primary_role().alias("primary_role"),
                      R.user_activity_level().alias("user_activity_level"))


@register("left_join_two_keys")
def q_left_join_two_keys(spark, sf):
    pages = dt.read(spark, sf, "pages").select(
        "page_id", "url",
        F.regexp_extract("url", PAGE_URL_PATTERN, 1).alias("page_lang"),
        F.regexp_extract("url", PAGE_URL_PATTERN, 2).try_cast("bigint").alias("page_doc"))
    docs = dt.read(spark, sf, "documents")
    return left_join_keys(pages, docs, ["page_doc", "page_lang"], ["doc_id", "lang"],
                          ["doc_id", "source", "n_chars"])


@register("left_join_fanout")
def q_left_join_fanout(spark, sf):
    b = dt.bronze_inputs(spark, sf)
    prs = b["issues"].where(F.col("pull_request").isNotNull()).select(
        F.col("issue_id").alias("pr_id"), F.col("user_id").alias("author_id"))
    return fanout_left_join(prs, b["repositories"], "author_id", "owner_id",
                            ["repo_id", "repo_name", "owner_id"])


@register("filter_not_null")
def q_filter_not_null(spark, sf):
    issues = dt.bronze_inputs(spark, sf)["issues"]
    return issues.where(F.col("assignee_id").isNotNull()).select("issue_id", "assignee_id")


# --- rule families -------------------------------------------------------------------------------
def _perm_base(spark, sf):
    b = dt.bronze_inputs(spark, sf)
    return merge_coalesce(b["repositories"], b["repo_details"], ["repo_id"],
                          silver.PERMISSION_COLUMNS)


@register("clean_defaults")
def q_clean_defaults(spark, sf):
    repos = dt.bronze_inputs(spark, sf)["repositories"]
    d = R.repo_defaults()
    return repos.select("repo_id", *[d[c].alias(c) for c in d])


@register("bucket_strict")
def q_bucket_strict(spark, sf):
    b = dt.bronze_inputs(spark, sf)
    return b["repositories"].select("repo_id", "stars",
                                    R.popularity_category("stars").alias("popularity_category"))


@register("bucket_inclusive")
def q_bucket_inclusive(spark, sf):
    repos = dt.bronze_inputs(spark, sf)["repositories"]
    return repos.select("repo_id", R.popularity_tier("stars").alias("popularity_tier"),
                        R.fork_activity_level("forks").alias("fork_activity_level"),
                        R.issue_volume_level("open_issues").alias("issue_volume_level"))


@register("compound_bucket")
def q_compound_bucket(spark, sf):
    return _perm_base(spark, sf).select("repo_id", R.maturity_level().alias("maturity_level"))


@register("priority_status")
def q_priority_status(spark, sf):
    return _perm_base(spark, sf).select(
        "repo_id", R.repository_status().alias("repository_status"),
        R.access_level().alias("access_level"), R.visibility_level().alias("visibility_level"))


@register("value_map")
def q_value_map(spark, sf):
    b = dt.bronze_inputs(spark, sf)
    return b["issues"].select("issue_id", "state", R.issue_status().alias("issue_status"))


@register("tristate_map")
def q_tristate_map(spark, sf):
    commits = dt.bronze_inputs(spark, sf)["commits"]
    return commits.select("commit_sha", R.verification_status().alias("verification_status"))


@register("length_bucket")
def q_length_bucket(spark, sf):
    issues = dt.bronze_inputs(spark, sf)["issues"]
    return issues.select("issue_id", R.length_category("title").alias("title_length_category"),
                         R.body_length_category().alias("body_length_category"))


@register("keyword_classify")
def q_keyword_classify(spark, sf):
    commits = dt.bronze_inputs(spark, sf)["commits"]
    return commits.select("commit_sha", R.length_category("message").alias("message_length_category"),
                          R.commit_type().alias("commit_type"))


@register("duration_seconds")
def q_duration_seconds(spark, sf):
    issues = dt.bronze_inputs(spark, sf)["issues"]
    return issues.select(
        "issue_id",
        R.duration_seconds("closed_at", "created_at").alias("resolution_time_seconds"),
        R.duration_seconds("updated_at", "created_at").alias("update_lag_seconds"))


@register("url_regexp_extract")
def q_url_regexp_extract(spark, sf):
    issues = dt.bronze_inputs(spark, sf)["issues"]
    return issues.select("issue_id", R.url_repo_owner().alias("repo_owner"),
                         R.url_repo_name().alias("repo_name"))


@register("presence_flags")
def q_presence_flags(spark, sf):
    issues = dt.bronze_inputs(spark, sf)["issues"]
    return issues.select(
        "issue_id", R.assignment_status().alias("assignment_status"),
        R.milestone_status().alias("milestone_status"), R.issue_type().alias("issue_type"),
        R.is_resolved().alias("is_resolved"), R.presence_flag("assignee_id").alias("is_assigned"),
        R.presence_flag("milestone_id").alias("has_milestone"))


@register("array_size_flag")
def q_array_size_flag(spark, sf):
    issues = dt.bronze_inputs(spark, sf)["issues"]
    return issues.select("issue_id", R.has_items("labels").alias("has_labels"))


# --- incremental (streaming) landing -> bronze ---------------------------------------------------
@register("bronze_incremental")
def q_bronze_incremental(spark, sf):
    """Issues landed as files, consumed by an ``availableNow`` stream into the record log."""
    from sediment.streaming.incremental import current_bronze, ingest_new_landing

    landing = land(spark, sf, ["issues"])
    log_dir, ckpt = scratch_path(spark, "issues_log"), scratch_path(spark, "issues_ckpt")
    ingest_new_landing(spark, landing, log_dir, ckpt, "issues").awaitTermination()
    return _no_stamps(current_bronze(spark, log_dir, "issues"))


@register("bronze_point_read")
def q_bronze_point_read(spark, sf):
    """A hundred issues by id from a table clustered for point reads."""
    issues = dt.bronze_inputs(spark, sf)["issues"]
    path = write_clustered(issues, scratch_path(spark, "clustered"), "issue_id")
    table = spark.read.parquet(path)
    wanted = top_k(table.select("issue_id").where("issue_id % 11 = 3"), 100, ["issue_id"])
    ids = [r[0] for r in wanted.collect()]  # a hundred
    return table.where(F.col("issue_id").isin(ids)).select("issue_id", "title", "state", "user_login")


def _two_days(spark, sf, feeds) -> str:
    """The work folder of two daily runs over ``feeds``: the second one replaces a third of the
    records and adds the others."""
    from sediment.streaming.tables import ingest

    landing, work = scratch_path(spark, "landing"), scratch_path(spark, "daily")
    for former in (True, False):
        land(spark, sf, feeds, landing, former=former)
        for feed in feeds:
            ingest(spark, landing, work, feed, buckets=8).awaitTermination()
    return work


@register("bronze_incremental_tables")
def q_bronze_incremental_tables(spark, sf):
    """The bucketed issue table after two daily runs."""
    from sediment.streaming.tables import bronze_table

    return _no_stamps(bronze_table(spark, _two_days(spark, sf, ["issues"]), "issues"))


@register("dim_users_incremental")
def q_dim_users_incremental(spark, sf):
    """The user dimension folded from the role state of two daily runs."""
    from sediment.streaming.tables import user_identities

    work = _two_days(spark, sf, ["repositories", "commits", "issues"])
    return _no_stamps(silver.dim_users_of(user_identities(spark, work)))


# --- documents as an API client names them, and documents that drifted from the schema -----------
SEARCH_PAGE, SEARCH_STARS = 5, 2000


def _api_documents(spark, sf) -> DataFrame:
    """``(file_name, value)``: pages of a repository search, of which some find nothing, and pages of
    issues, some with misleading or unknown names, cut off, or with an empty list."""
    b, stamp = dt.bronze_inputs(spark, sf), "_20240601_000000.json"

    def body(items, feed: str):
        return F.to_json(F.struct(F.lit(LAND_TS).alias("ingestion_timestamp"),
                                  F.struct(items.alias(feed)).alias("data")), {"pretty": "true"})

    page = F.floor(F.col("repo_id") / SEARCH_PAGE)
    hits = F.collect_list(F.when(F.col("stars") >= SEARCH_STARS, F.col("rec")))
    repos = (unflatten(b["repositories"], "repositories", keep=(page.alias("p"), "stars")).groupBy("p")
             .agg(hits.alias("items")).where(F.size("items") > 0)  # a page without hits is not landed
             .select(F.concat(F.lit("repositories_"), F.col("p"), F.lit(stamp)).alias("file_name"),
                     body(F.col("items"), "repositories").alias("value")))
    page, p = F.floor(F.col("issue_id") / PAGE_SIZE), F.col("p")
    name = (F.when(p % 10 == 3, F.concat(F.lit("issues_o_commits-tool-"), p))
            .when(p % 10 == 4, F.concat(F.lit("issues_repo_details_repositories-"), p))
            .when(p % 10 == 5, F.concat(F.lit("notes_issues_"), p)).otherwise(F.concat(F.lit("issues_o_r"), p)))
    issues = (unflatten(b["issues"], "issues", keep=(page.alias("p"),)).groupBy("p")
              .agg(F.collect_list("rec").alias("items"))
              .withColumn("items", F.when(p % 10 == 9, F.slice("items", 1, 0)).otherwise(F.col("items")))
              .withColumn("value", body(F.col("items"), "issues"))
              .select(F.concat(name, F.lit(stamp)).alias("file_name"),
                      F.when(p % 10 == 7, F.substring("value", 1, 200)).otherwise(F.col("value")).alias("value")))
    return repos.unionByName(issues)


@register("landing_document_run")
def q_landing_document_run(spark, sf):
    """Documents landed under their API names and read back: the report of every file, and of each
    feed's table the records built from it (in the row without file name)."""
    landing, work = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    write_documents(_api_documents(spark, sf), landing, compression="gzip")
    tables = build_bronze(spark, landing, work, feeds=["repositories", "issues"])
    report = file_report(spark, landing)
    built = reduce(DataFrame.unionByName, [
        spark.read.parquet(p).agg(F.count(F.lit(1)).alias("items")).withColumn("feed", F.lit(f))
        for f, p in tables.items()])
    return report.unionByName(built, allowMissingColumns=True)


def _drifted_details(spark, sf) -> str:
    """Landed repository details of which every third has a field more, and every fifth a size in
    words."""
    d = dt.bronze_inputs(spark, sf)["repo_details"]
    n = F.substring("repo_name", 4, 20).cast("bigint")
    more = F.concat(F.lit('"data":{'), F.when(n % 3 == 0, '"visibility":"public",').otherwise(""),
                    F.when(n % 5 == 0, '"size":"12 MB",').otherwise(""))
    rec = unflatten(d, "repo_details", keep=(more.alias("more"),))
    line = F.to_json(F.struct(F.lit(LAND_TS).alias("ingestion_timestamp"), F.col("rec").alias("data")))
    landing = scratch_path(spark, "landing")
    rec.select(F.replace(line, F.lit('"data":{'), F.col("more")).alias("value")).write.text(
        f"{landing}/feed=repo_details")
    return landing


@register("landing_variant_scan")
def q_landing_variant_scan(spark, sf):
    """Records of drifted documents: typed fields, where a wrong type voids its own field only, and
    one that no schema knows."""
    docs = scan_variant(spark, _drifted_details(spark, sf), "repo_details", "lines")
    get = lambda path, kind: F.try_variant_get("rec", path, kind)
    return variant_records(docs, "repo_details").select(
        get("$.id", "bigint").alias("repo_id"), get("$.name", "string").alias("repo_name"),
        get("$.private", "boolean").alias("private"), get("$.stargazers_count", "bigint").alias("stars"),
        get("$.size", "bigint").alias("size"), get("$.size", "string").alias("size_said"),
        get("$.visibility", "string").alias("visibility"))


@register("landing_schema_drift")
def q_landing_schema_drift(spark, sf):
    docs = scan_variant(spark, _drifted_details(spark, sf), "repo_details", "lines")
    drift = schema_drift(variant_records(docs, "repo_details"), "repo_details")
    return drift.select("path", "type_seen", "type_wanted", "records",
                        F.col("example_file").isNotNull().alias("has_example"))
