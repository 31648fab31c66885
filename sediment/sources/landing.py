"""Landing zone: envelope documents ``{ingestion_timestamp, data}`` per feed.

Two layouts exist:

* ``document`` -- what an API client writes: one (indented, multi-line) JSON object per file,
  named ``<feed>[_<owner>_<repo>]_<yyyymmdd_HHMMSS>.json``.  Read with ``multiLine``; each file
  is one task, which suits many small files.  A file may be gzipped, with ``.gz`` behind the name
  of its document; the scans and reports give the document's name.
* ``lines`` -- what Spark writes: JSON Lines under ``<landing>/feed=<feed>/``, one envelope per
  line, gzipped (the text is many times the tables built from it) in files of a bounded number
  of envelopes, each read by one task; plain files are read too, and split.  Reading such a file
  with ``multiLine`` would silently return only its first document, so the layout is always
  stated explicitly.

A whole directory is read by one job with an explicit schema (no inference pass); a file that
is not JSON keeps its text in ``_corrupt_record`` and is reported instead of being dropped.
"""

from __future__ import annotations

import contextlib
import gzip
import os
import shutil
import uuid
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from typing import Any
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.schemas import FEED_PAYLOAD, FEEDS, envelope
from sediment.session import drop_path, dropping_shuffles

# Feed names are anchored file-name prefixes, tested in this order.
ROUTE_PATTERN = r"^(repositories|repo_details|commits|issues)_"
NO_NAME = "__HIVE_DEFAULT_PARTITION__"
DOCUMENTS, GZIPPED = "*.json{,.gz}", ".gz"
#: Envelopes in a gzipped file, which cannot be split: so many pages, and 50 times as many single records.
PAGES_PER_FILE, RECORDS_PER_FILE = 4_000, 200_000


def route_feed(name: Column | str) -> Column:
    """Feed named by a landing file name (``''`` for an unknown name).

    Anchored at the start of the name, so ``commits_x_awesome-repositories_...json`` is a
    commit file and ``issues_x_commits-tool_...json`` an issue file.
    """
    c = F.col(name) if isinstance(name, str) else name
    return F.regexp_extract(c, ROUTE_PATTERN, 1)


def _not_there(e: AnalysisException) -> bool:
    return (e.getCondition() or "").startswith("PATH_NOT_FOUND")


def _files(spark: SparkSession, path: str, names: str = "*") -> DataFrame:
    """(path, length) of the files below a path; none if it is missing.  Contents are not read."""
    try:
        return (spark.read.format("binaryFile").option("pathGlobFilter", names)
                .option("recursiveFileLookup", "true").load(path).select("path", "length"))
    except AnalysisException as e:
        if not _not_there(e):
            raise
        return spark.createDataFrame([], "path string, length bigint")


def document_name(name: Column) -> Column:
    """The name of the document that a file of the ``document`` layout holds."""
    return F.regexp_replace(name, r"\.gz$", "")


def list_landing(spark: SparkSession, landing_dir: str) -> DataFrame:
    """One row per ``*.json`` document (path, file name, size of the file, routed feed); contents are
    not read.

    Sub-directories are listed too, as ``scan_feed`` reads them.
    """
    files = _files(spark, landing_dir, DOCUMENTS)
    name = document_name(F.element_at(F.split("path", "/"), -1))
    return files.select("path", "length", name.alias("file_name"),
                        route_feed(name).alias("feed"))


def _empty(spark: SparkSession, feed: str) -> DataFrame:
    schema = envelope(feed).add("source_file", "string")
    return spark.createDataFrame([], schema)


def scan_feed(spark: SparkSession, landing_dir: str, feed: str,
              layout: str = "document") -> DataFrame:
    """All landing documents of one feed: envelope columns plus ``source_file``.

    A missing directory (or one without files of the feed) gives an empty frame; any other
    failure to read is raised.  Sub-directories are read too.
    """
    if feed not in FEEDS:
        raise ValueError(f"unknown feed {feed!r}")
    reader = (spark.read.schema(envelope(feed))
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "_corrupt_record"))
    if layout == "document":
        reader = (reader.option("multiLine", "true").option("recursiveFileLookup", "true")
                  .option("pathGlobFilter", f"{feed}_{DOCUMENTS}"))
        path = landing_dir
    elif layout == "lines":
        reader = reader.option("multiLine", "false")
        path = f"{landing_dir.rstrip('/')}/feed={feed}"
    else:
        raise ValueError("layout must be 'document' or 'lines'")
    try:
        df = reader.json(path)
    except AnalysisException as e:
        if not _not_there(e):
            raise
        return _empty(spark, feed)
    file = F.col("_metadata.file_name")
    return df.select("ingestion_timestamp", "data", "_corrupt_record",
                     (document_name(file) if layout == "document" else file).alias("source_file"))


def has_files(spark: SparkSession, landing_dir: str, feed: str, layout: str = "document") -> bool:
    """Whether any landing file of the feed exists; contents are not read."""
    if layout == "lines":
        return not _files(spark, f"{landing_dir.rstrip('/')}/feed={feed}").isEmpty()
    return not list_landing(spark, landing_dir).where(F.col("feed") == feed).isEmpty()


def feeds_present(spark: SparkSession, landing_dir: str, layout: str = "document",
                  feeds: Sequence[str] = FEEDS) -> list[str]:
    """Those of ``feeds`` with landing files; a zone of documents is listed once for all of them."""
    if layout == "document":
        found = {r["feed"] for r in list_landing(spark, landing_dir).select("feed").distinct().collect()}
        return [f for f in feeds if f in found]
    return [f for f in feeds if has_files(spark, landing_dir, f, layout)]


def unusable_reason() -> Column:
    """Why a document gives no record or loses part of them; NULL for a good one."""
    return F.when(F.col("_corrupt_record").isNotNull(), "malformed").when(
        F.col("data").isNull(), "without_data")


def raw_text() -> Column:
    return F.coalesce("_corrupt_record", F.to_json(F.struct("ingestion_timestamp")))


def unusable(docs: DataFrame, feed: str) -> DataFrame:
    """``(feed, source_file, reason, raw)`` of the documents that give no record or lose part:
    not JSON or a field of the wrong type (with their text), or an envelope without payload."""
    return docs.where(unusable_reason().isNotNull()).select(
        F.lit(feed).alias("feed"), "source_file", unusable_reason().alias("reason"),
        raw_text().alias("raw"))


def feed_records(docs: DataFrame, feed: str) -> DataFrame:
    """One row per landed record: ``rec`` (the API object), ``ingestion_timestamp``, ``source_file``.

    Array feeds are exploded (a NULL or empty array gives no row); the details feed carries
    its object directly in ``data``.
    """
    meta = [F.col("ingestion_timestamp"), F.col("source_file")]
    if feed == "repo_details":
        return docs.where(F.col("data").isNotNull()).select(*meta, F.col("data").alias("rec"))
    return docs.select(*meta, F.explode(F.col(f"data.{feed}")).alias("rec"))


def write_envelopes(records: DataFrame, feed: str, landing_dir: str, page: Sequence[str],
                    ingestion_timestamp: Column | str) -> str:
    """Land API-shaped records as JSON Lines envelopes under ``<landing>/feed=<feed>``.

    ``records`` has one column ``rec`` (the API object) plus the ``page`` columns.  Records of
    one page share one envelope, like one API response; callers choose ``page`` so that a page
    holds a bounded number of records (e.g. ``floor(id / 50)``), because a page becomes one
    row.  Empty pages are never landed.  The details feed lands one envelope per record; the
    array feeds need a page, as all their records would otherwise meet in one row.
    """
    if feed != "repo_details" and not page:
        raise ValueError(f"{feed}: page columns are needed, they bound the records of a document")
    ts = F.col(ingestion_timestamp) if isinstance(ingestion_timestamp, str) else ingestion_timestamp
    out = f"{landing_dir.rstrip('/')}/feed={feed}"
    if feed == "repo_details":
        docs = records.select(ts.alias("ingestion_timestamp"), F.col("rec").alias("data"))
    else:
        docs = (records.withColumn("_ts", ts).groupBy(*page)
                .agg(F.max("_ts").alias("ingestion_timestamp"),
                     F.collect_list("rec").alias("_items"))
                .where(F.size("_items") > 0)
                .select("ingestion_timestamp", F.struct(F.col("_items").alias(feed)).alias("data")))
    most = RECORDS_PER_FILE if feed == "repo_details" else PAGES_PER_FILE
    with dropping_shuffles(records.sparkSession):
        docs.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", most).json(out)
    return out


def envelope_report(docs: DataFrame, feed: str, by_file: bool = False) -> DataFrame:
    """Per feed (``by_file``: per feed and source file): documents and what is wrong with them, and the landed items.

    ``malformed``: the reader kept the raw text (not JSON, or a field of the wrong type);
    ``partial``: of those, documents whose other fields were still read (wrong field type);
    ``without_timestamp`` / ``without_data``: the envelope lacks a part (wrong envelope).
    One pass over the documents; every file is counted, none is sampled.
    """
    by = ["source_file"] if by_file else []
    return docs.groupBy(*by).agg(*landing_counts(feed)).select(F.lit(feed).alias("feed"), "*")


def landing_counts(feed: str) -> list[Column]:
    """The aggregates of ``envelope_report``, over scanned documents."""
    # Explicit NULL guards: ``size(NULL)`` is -1 or NULL depending on the session's settings.
    payload = F.col("data") if feed == "repo_details" else F.col(f"data.{feed}")
    count = F.lit(1) if feed == "repo_details" else F.size(payload)
    items = F.when(F.col("data").isNull() | payload.isNull(), F.lit(0)).otherwise(count)
    return [
        F.count(F.lit(1)).alias("documents"),
        F.count_if(F.col("_corrupt_record").isNotNull()).alias("malformed"),
        F.count_if(F.col("_corrupt_record").isNotNull()
                   & (F.col("data").isNotNull() | F.col("ingestion_timestamp").isNotNull()))
        .alias("partial"),
        F.count_if(F.col("ingestion_timestamp").isNull()).alias("without_timestamp"),
        F.count_if(F.col("data").isNull()).alias("without_data"),
        F.coalesce(F.sum(items), F.lit(0)).cast("bigint").alias("items"),
    ]


def write_documents(docs: DataFrame, landing_dir: str, compression: str | None = None) -> int:
    """Land documents under their own file names: ``(file_name, value)``, one row per file.

    A task writes its documents into a hidden folder of the landing zone; once all are complete,
    each is renamed into place, so a reader sees whole documents only.  A name that is there already
    is replaced; rows of one name are one file.  With ``compression="gzip"`` the files are gzipped
    (indented JSON is many times its gzipped size), and ``.gz`` stands behind their names; a document
    replaces a former one in either form.  Returns the number of files.

    On a file system that all machines mount (``file:``) tasks write and rename; the driver gets one
    row for each task, and only names are shuffled.  A store that only Hadoop's client reaches is
    written by Spark's text sink, and the driver renames one file per document.
    """
    if compression not in (None, "gzip"):
        raise ValueError("compression must be None or 'gzip'")
    spark = docs.sparkSession
    base, tag = landing_dir.rstrip("/"), f".landing-{uuid.uuid4().hex[:12]}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # A missing name is named as Spark's partitions name it.
    named = F.when(F.col("file_name") != "", F.col("file_name")).otherwise(NO_NAME).alias("file_name")
    docs, more = docs.select(named, "value"), (GZIPPED,) if compression else ()
    try:
        with dropping_shuffles(spark):
            if fs.getUri().getScheme() == "file":
                return _land_in_tasks(docs, fs.makeQualified(path).toUri().getPath(), tag, *more)
            return _land_by_driver(docs, fs, base, tag, *more)
    finally:
        drop_path(spark, f"{base}/{tag}")


def _land_in_tasks(docs: DataFrame, base: str, tag: str, suffix: str = "") -> int:
    """``write_documents`` on a mounted file system: documents are written where they are made, only
    their names are shuffled, and rows of one name from several tasks are joined as files."""
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, bad, empty = os.path.join(base, tag, uuid.uuid4().hex), None, True  # of this attempt alone
        for name, value in (row for b in batches for row in zip(b["file_name"], b["value"])):
            name = name.as_py()
            if "/" in name or name in (".", ".."):
                bad = name
                break
            if empty:
                os.makedirs(own)
                empty = False
            file = os.path.join(own, f"{name}{suffix}").encode()
            with gzip.open(file, "ab", 6) if suffix else open(file, "ab") as f:
                f.write(f"{value.as_py() or ''}\n".encode())
        if bad is not None or not empty:
            yield pa.RecordBatch.from_pydict({"folder": [own], "bad": pa.array([bad], pa.string())})

    def land(named: tuple[str, Iterable[str]]) -> int:
        name, parts = named[0], sorted(os.path.join(own, named[0]).encode() for own in named[1])
        target, whole, plain = os.path.join(base, name).encode(), parts[0], name.removesuffix(suffix)
        if len(parts) > 1:
            whole = os.path.join(base, tag, uuid.uuid4().hex).encode()
            with open(whole, "wb") as out:
                for part in parts:
                    with open(part, "rb") as f:
                        shutil.copyfileobj(f, out)
        for form in (plain, f"{plain}{GZIPPED}"):  # of a replaced document, with the checksum Hadoop's client left
            for former in (f".{form}.crc", *[form] * (form != name)):
                with contextlib.suppress(FileNotFoundError):
                    os.remove(os.path.join(base, former).encode())
        try:
            os.replace(whole, target)
        except FileNotFoundError:  # an earlier attempt of this task has moved it
            if not os.path.exists(target):
                raise
        return 1

    done = docs.mapInArrow(write, "folder string, bad string").collect()  # one row for each task
    if bad := [r["bad"] for r in done if r["bad"] is not None]:
        raise ValueError(f"{bad[0]!r} is no file name")
    if not done:
        return 0
    names = docs.sparkSession.sparkContext.parallelize([r["folder"] for r in done], len(done)).flatMap(
        lambda own: [(name.decode(), own) for name in os.listdir(own.encode())])
    return names.groupByKey(len(done)).map(land).sum()


def _land_by_driver(docs: DataFrame, fs: Any, base: str, tag: str, suffix: str = "") -> int:
    """``write_documents`` through Hadoop's client: a folder for each document, under its name."""
    (docs.repartition("file_name").write.partitionBy("file_name").option("lineSep", "\n")
     .option("compression", "gzip" if suffix else "none").text(f"{base}/{tag}"))
    path = docs.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path
    n = 0
    for folder in fs.listStatus(path(f"{base}/{tag}")):
        own = folder.getPath().getName()
        if not own.startswith("file_name="):
            continue
        parts = [f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
        name = unquote(own.removeprefix("file_name="))
        if len(parts) != 1 or "/" in name:
            raise ValueError(f"{name!r} names more than one document")
        for former in (name, f"{name}{GZIPPED}"):
            fs.delete(path(f"{base}/{former}"), False)
        if not fs.rename(parts[0], path(f"{base}/{name}{suffix}")):
            raise OSError(f"could not land {name}")
        n += 1
    return n


def file_report(spark: SparkSession, landing_dir: str) -> DataFrame:
    """Per landing file of the ``document`` layout: the feed that its name routes it to (``''`` for
    an unknown name, whose file no feed reads) and ``envelope_report`` of it."""
    present = feeds_present(spark, landing_dir) or FEEDS[:1]
    reports = [envelope_report(scan_feed(spark, landing_dir, f), f, by_file=True) for f in present]
    read = reduce(DataFrame.unionByName, reports)
    files = list_landing(spark, landing_dir).select("file_name", F.col("feed").alias("routed"))
    found = files.join(read, (files["file_name"] == read["source_file"]) & (files["routed"] == read["feed"]), "left")
    return found.select("file_name", F.col("routed").alias("feed"), "documents", "malformed", "without_timestamp",
                        "without_data", "items")


# --- drift-tolerant scan ------------------------------------------------------------------------
def scan_variant(spark: SparkSession, landing_dir: str, feed: str, layout: str = "document") -> DataFrame:
    """All landing documents of one feed as ``(source_file, doc VARIANT)``: no field is lost and no
    type forced; ``doc`` is NULL for a document that is not JSON."""
    if feed not in FEEDS:
        raise ValueError(f"unknown feed {feed!r}")
    if layout == "document":
        reader, path = (spark.read.option("wholetext", "true").option("recursiveFileLookup", "true")
                        .option("pathGlobFilter", f"{feed}_{DOCUMENTS}")), landing_dir
    elif layout == "lines":
        reader, path = spark.read, f"{landing_dir.rstrip('/')}/feed={feed}"
    else:
        raise ValueError("layout must be 'document' or 'lines'")
    file = F.col("_metadata.file_name")
    return reader.text(path).select((document_name(file) if layout == "document" else file).alias("source_file"),
                                    F.try_parse_json("value").alias("doc"))


def variant_records(docs: DataFrame, feed: str) -> DataFrame:
    """One row per landed record: ``source_file`` and the record as ``rec`` VARIANT."""
    if feed == "repo_details":
        out = docs.select("source_file", F.try_variant_get("doc", "$.data", "variant").alias("rec"))
    else:
        found = docs.select("source_file", F.try_variant_get("doc", f"$.data.{feed}", "variant").alias("items"))
        found.createOrReplaceTempView(view := f"variant_{uuid.uuid4().hex[:12]}")
        out = docs.sparkSession.sql(f"SELECT source_file, r.value AS rec FROM {view}, "
                                    f"LATERAL variant_explode_outer(items) AS r")
        out.schema  # resolved, so the name is free again
        docs.sparkSession.catalog.dropTempView(view)
    return out.where(F.col("rec").isNotNull())


def _paths(kind: T.DataType, at: str = "") -> dict[str, str]:
    """Path to wanted type of every field below a record type."""
    names = {T.LongType: "BIGINT", T.StringType: "STRING", T.BooleanType: "BOOLEAN", T.ArrayType: "ARRAY"}
    out = {}
    for f in kind.fields:
        path = f"{at}{f.name}"
        if isinstance(f.dataType, T.StructType):
            out[path] = "OBJECT"
            out |= _paths(f.dataType, f"{path}.")
        else:
            out[path] = names[type(f.dataType)]
    return out


def schema_drift(records: DataFrame, feed: str) -> DataFrame:
    """What landed records hold besides or instead of the feed's schema, and what they lack:
    ``(path, type_seen, type_wanted, records, example_file)``.

    ``type_seen`` is NULL for a wanted field that is absent where its object is present, ``type_wanted``
    for a field that the schema does not know.  JSON null fits every type, and every value is
    readable as STRING (as its text).  Records are first folded by their whole shape
    (``schema_of_variant``), map side first; only one record of each shape is taken apart.
    """
    spark = records.sparkSession
    payload = FEED_PAYLOAD[feed]
    wanted = _paths(payload if feed == "repo_details" else payload[feed].dataType.elementType)
    depth = max(p.count(".") for p in wanted) + 1
    shapes = records.groupBy(F.schema_of_variant("rec").alias("shape")).agg(
        F.count(F.lit(1)).alias("records"), F.min("source_file").alias("file"),
        F.first(F.col("rec").cast("string")).alias("text"))
    level = shapes.select("shape", "records", "file", F.lit("").alias("path"), F.parse_json("text").alias("value"))
    seen = level.select("shape", "records", "file", "path", F.lit("OBJECT").alias("seen"))
    for _ in range(depth):
        objects = level.where(F.schema_of_variant("value").startswith("OBJECT"))
        objects.createOrReplaceTempView(view := f"variant_{uuid.uuid4().hex[:12]}")
        level = spark.sql(f"SELECT shape, records, file, concat_ws('.', nullif(path, ''), f.key) AS path, f.value "
                          f"FROM {view}, LATERAL variant_explode(value) AS f")
        level.schema
        spark.catalog.dropTempView(view)
        kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
        seen = seen.unionByName(level.select("shape", "records", "file", "path", kind.alias("seen")))
    known = spark.createDataFrame([(p, t, p.rpartition(".")[0]) for p, t in wanted.items()],
                                  "path string, wanted string, parent string")  # as many rows as fields
    odd = seen.where("path != ''").join(F.broadcast(known.drop("parent")), "path", "left")
    # Below a field that the schema does not take apart, or does not know, nothing is named.
    objects = ["", *[p for p, t in wanted.items() if t == "OBJECT"]]
    odd = odd.where(F.regexp_extract("path", r"^(.*)\.[^.]*$", 1).isin(objects)).where(
        "(wanted IS NULL) OR (seen NOT IN ('VOID', wanted) AND wanted != 'STRING')")
    holders = seen.where("seen = 'OBJECT'").withColumnRenamed("path", "parent").drop("seen")
    lacking = (holders.join(F.broadcast(known), "parent")
               .join(seen.select("shape", "path").distinct(), ["shape", "path"], "left_anti")
               .select("path", F.lit(None).cast("string").alias("seen"), "wanted", "records", "file"))
    both = odd.select("path", "seen", "wanted", "records", "file").unionByName(lacking)
    return both.groupBy("path", F.col("seen").alias("type_seen"), F.col("wanted").alias("type_wanted")).agg(
        F.sum("records").alias("records"), F.min("file").alias("example_file"))


def reland_as_lines(spark: SparkSession, landing_dir: str, out_dir: str, feed: str,
                    page_size: int = 50) -> str:
    """Re-land API documents of one feed as splittable JSON Lines envelopes.

    A multi-line document is read by a single task, so a few very large documents would
    serialise the scan.  Records keep their document's landing time; a new envelope holds at
    most ``page_size`` records, chosen by the record's position in its source document
    (deterministic, so a recomputed task writes the same pages).  Documents that are malformed,
    also in part, or without payload are written to ``<out>/quarantine/feed=<feed>`` with their
    text, file and reason.
    """
    docs = scan_feed(spark, landing_dir, feed, "document")
    unusable(docs, feed).write.mode("append").json(f"{out_dir.rstrip('/')}/quarantine/feed={feed}")
    docs = docs.where(F.col("data").isNotNull())
    if feed == "repo_details":
        recs = docs.select("ingestion_timestamp", F.col("data").alias("rec"))
        return write_envelopes(recs, feed, out_dir, [], "ingestion_timestamp")
    recs = docs.select("ingestion_timestamp", "source_file",
                       F.posexplode(F.col(f"data.{feed}")).alias("_pos", "rec"))
    recs = recs.withColumn("_page", F.floor(F.col("_pos") / page_size))
    return write_envelopes(recs, feed, out_dir, ["source_file", "_page"], "ingestion_timestamp")
