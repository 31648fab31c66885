"""Bronze layer: landed API records flattened into four columnar tables.

``build_bronze`` reads each feed's whole landing directory in one job, flattens it, keeps the
newest landing of every record (landing files pile up run after run), and writes the table
once -- instead of one job per file, where each file would overwrite the previous one.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sediment.operators.merge import SMALL_LOSERS, latest_per_key, newest_rows
from sediment.plans.jobs import DEFAULT_PARALLEL, run_writes
from sediment.schemas import BRONZE_KEYS, FEEDS
from sediment.session import drop_path, dropping_shuffles, path_exists, scratch_path
from sediment.sources.landing import (feed_records, feeds_present, landing_counts, raw_text,
                                      scan_feed, unusable_reason)
from sediment.sources.tables import write_parquet

log = logging.getLogger(__name__)

# API field path -> bronze column, in the bronze tables' column order.
REPO_FIELDS = [
    ("id", "repo_id"), ("name", "repo_name"), ("full_name", "full_name"),
    ("description", "description"), ("html_url", "html_url"), ("clone_url", "clone_url"),
    ("language", "language"), ("stargazers_count", "stars"), ("watchers_count", "watchers"),
    ("forks_count", "forks"), ("open_issues_count", "open_issues"), ("size", "size"),
    ("created_at", "created_at"), ("updated_at", "updated_at"), ("pushed_at", "pushed_at"),
    ("default_branch", "default_branch"), ("owner.id", "owner_id"),
    ("owner.login", "owner_login"), ("owner.type", "owner_type"),
    ("owner.html_url", "owner_url"), ("license.name", "license_name"),
    ("license.key", "license_key"), ("topics", "topics"), ("archived", "archived"),
    ("disabled", "disabled"), ("private", "private"), ("fork", "fork"),
]
COMMIT_FIELDS = [
    ("sha", "commit_sha"), ("node_id", "node_id"), ("commit.message", "message"),
    ("commit.author.name", "author_name"), ("commit.author.email", "author_email"),
    ("commit.author.date", "author_date"), ("commit.committer.name", "committer_name"),
    ("commit.committer.email", "committer_email"), ("commit.committer.date", "committer_date"),
    ("commit.tree.sha", "tree_sha"), ("commit.url", "commit_url"),
    ("commit.comment_count", "comment_count"),
    ("commit.verification.verified", "verification_verified"),
    ("commit.verification.reason", "verification_reason"), ("html_url", "html_url"),
    ("comments_url", "comments_url"), ("author.id", "author_id"),
    ("author.login", "author_login"), ("author.type", "author_type"),
    ("author.html_url", "author_html_url"), ("committer.id", "committer_id"),
    ("committer.login", "committer_login"), ("committer.type", "committer_type"),
    ("committer.html_url", "committer_html_url"), ("parents", "parents"),
]
ISSUE_FIELDS = [
    ("id", "issue_id"), ("node_id", "node_id"), ("number", "issue_number"), ("title", "title"),
    ("body", "body"), ("state", "state"), ("locked", "locked"), ("assignee.id", "assignee_id"),
    ("assignee.login", "assignee_login"), ("assignee.type", "assignee_type"),
    ("assignee.html_url", "assignee_html_url"), ("user.id", "user_id"),
    ("user.login", "user_login"), ("user.type", "user_type"),
    ("user.html_url", "user_html_url"), ("labels", "labels"), ("milestone.id", "milestone_id"),
    ("milestone.title", "milestone_title"), ("milestone.description", "milestone_description"),
    ("milestone.state", "milestone_state"), ("comments", "comments_count"),
    ("created_at", "created_at"), ("updated_at", "updated_at"), ("closed_at", "closed_at"),
    ("author_association", "author_association"),
    ("active_lock_reason", "active_lock_reason"), ("pull_request", "pull_request"),
    ("html_url", "html_url"), ("url", "url"),
]
LOG_META = ("_landed_at", "_source_file", "_is_record", "_reason", "_raw")
FIELDS = {"repositories": REPO_FIELDS, "repo_details": REPO_FIELDS,
          "commits": COMMIT_FIELDS, "issues": ISSUE_FIELDS}


def flatten(records: DataFrame, feed: str, loaded_at: Column | None = None,
            keep: tuple[str, ...] = ()) -> DataFrame:
    """``rec`` struct -> flat bronze columns (NULL-safe: a missing parent gives NULL)."""
    stamp = loaded_at if loaded_at is not None else F.current_timestamp()
    return records.select(*[F.col(f"rec.{src}").alias(dst) for src, dst in FIELDS[feed]],
                          stamp.alias("bronze_ingestion_timestamp"), *keep)


def unflatten(bronze: DataFrame, feed: str, keep: tuple = ()) -> DataFrame:
    """Inverse of ``flatten``: bronze columns -> ``rec`` struct of the API shape (+ ``keep``)."""
    tree: dict = {}
    for src, dst in FIELDS[feed]:
        node = tree
        parts = src.split(".")
        for p in parts[:-1]:
            node = node.setdefault(p, {})
        node[parts[-1]] = dst

    def build(node: dict) -> Column:
        return F.struct(*[(build(v) if isinstance(v, dict) else F.col(v)).alias(k)
                          for k, v in node.items()])
    return bronze.select(build(tree).alias("rec"), *keep)


def bronze_feed(spark: SparkSession, landing_dir: str, feed: str, layout: str = "document",
                latest: bool = True, loaded_at: Column | None = None) -> DataFrame:
    """Flattened records of one feed from every landing file; newest landing per key."""
    recs = feed_records(scan_feed(spark, landing_dir, feed, layout), feed)
    landed = F.try_to_timestamp(F.col("ingestion_timestamp"))
    flat = flatten(recs, feed, loaded_at,
                   keep=(landed.alias("_landed_at"), F.col("source_file").alias("_source_file")))
    if latest:
        flat = latest_per_key(flat, BRONZE_KEYS[feed], ["_landed_at", "_source_file"])
    return flat.drop("_landed_at", "_source_file")


def landing_log(docs: DataFrame, feed: str, loaded_at: Column | None = None) -> DataFrame:
    """Records and unusable documents of one parse: flattened records with ``_landed_at`` and
    ``_source_file``, and on the first row of a document that is unusable, also in part,
    ``_reason`` and ``_raw`` (a row without record, ``_is_record`` false, if it has none)."""
    bad = unusable_reason()
    items = F.col(f"data.{feed}") if feed != "repo_details" else F.when(
        F.col("data").isNotNull(), F.array("data"))
    rows = docs.select("ingestion_timestamp", "source_file", bad.alias("_why"), raw_text().alias("_text"),
                       F.posexplode_outer(items).alias("_pos", "rec"))
    first = F.coalesce(F.col("_pos"), F.lit(0)) == 0
    rows = rows.where(F.col("rec").isNotNull() | (first & F.col("_why").isNotNull()))
    return flatten(rows, feed, loaded_at, keep=(
        F.try_to_timestamp(F.col("ingestion_timestamp")).alias("_landed_at"),
        F.col("source_file").alias("_source_file"), F.col("rec").isNotNull().alias("_is_record"),
        F.when(first, F.col("_why")).alias("_reason"), F.when(first & F.col("_why").isNotNull(),
                                                              F.col("_text")).alias("_raw")))


def build_bronze(spark: SparkSession, landing_dir: str, bronze_dir: str,
                 layout: str = "document", feeds=FEEDS, latest: bool = True,
                 on_error: str = "raise", loaded_at: Column | None = None,
                 require_input: bool = True,
                 max_parallel: int = DEFAULT_PARALLEL, small_losers: int = SMALL_LOSERS,
                 landed: dict[str, dict[str, int]] | None = None) -> dict[str, str]:
    """Land -> bronze for every feed; returns ``{table: parquet path}`` of written tables.

    The feeds are independent jobs and run side by side (``max_parallel``).
    ``on_error="skip"`` logs a failing feed and goes on with the rest (the interactive
    script's behaviour).  A feed without landing files is left out: its table, if there is one,
    stays as it is.  With ``require_input`` a landing zone without any file is an error.  Only
    the file listing is read for these checks.  Documents that cannot be used, or only in part,
    are written to ``<bronze>/quarantine/<feed>`` in the same run.

    The JSON is parsed once, into a flattened log in scratch space, from which the newest
    landing of every key is found on narrow columns.  ``landed``, if given, is filled with each
    feed's documents, items and unusable documents, observed while that log is written; the job
    has one stage, whose tasks count once each, also when some are repeated.
    """
    base = bronze_dir.rstrip("/")
    present = feeds_present(spark, landing_dir, layout, feeds)
    if require_input and not present:
        raise FileNotFoundError(f"no landing files under {landing_dir}")
    for feed in feeds:
        if feed not in present:
            log.warning("no landing files of feed %s: its table is left as it is", feed)

    def write(feed: str):
        def run() -> str:
            seen = Observation()
            docs = scan_feed(spark, landing_dir, feed, layout).observe(seen, *landing_counts(feed))
            stored = write_parquet(landing_log(docs, feed, loaded_at), scratch_path(spark, f"log-{feed}"),
                                   {"compression": "zstd"})
            if landed is not None:
                landed[feed] = {k: v or 0 for k, v in seen.get.items()}
            try:
                log_rows = spark.read.parquet(stored)
                write_parquet(log_rows.where("_reason IS NOT NULL").select(
                    F.lit(feed).alias("feed"), F.col("_source_file").alias("source_file"),
                    F.col("_reason").alias("reason"), F.col("_raw").alias("raw")), f"{base}/quarantine/{feed}")
                records = log_rows.where("_is_record")
                if latest:
                    records = newest_rows(records, BRONZE_KEYS[feed], ["_landed_at", "_source_file"], small_losers)
                return write_parquet(records.drop(*LOG_META), f"{base}/{feed}")
            finally:
                drop_path(spark, stored)
        return run
    with dropping_shuffles(spark):
        return run_writes({feed: write(feed) for feed in present}, on_error, max_parallel)


def quarantined(spark: SparkSession, bronze_dir: str, feeds=FEEDS) -> DataFrame:
    """The quarantine of a bronze directory: ``(feed, source_file, reason, raw)``."""
    paths = [f"{bronze_dir.rstrip('/')}/quarantine/{f}" for f in feeds]
    found = [p for p in paths if path_exists(spark, p)]
    schema = "feed string, source_file string, reason string, raw string"
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)
