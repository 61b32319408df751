"""Readers of the input tables."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from pressloom.operators.common import bounded_broadcast
from pressloom.schemas import ERROR_COLUMNS

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


# Tables whose rows are heavy to process (whole pages and texts), with their row key.
HEAVY_TABLES = {"pages": "page_id", "documents": "doc_id", "conversations": "conv_id"}


def spread_rows(df: DataFrame, key: str, min_partitions: int | None = None) -> DataFrame:
    """Spread rows over every task slot when the files give fewer read tasks than that.

    A table stored as one large row group is read by a single task, so every
    regex over its pages would run on one core. On a large table the scan already
    has far more partitions than slots and nothing is added. Hash partitioning on
    the row key keeps the split deterministic when a task is retried.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, key)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread_rows(df, HEAVY_TABLES[name]) if name in HEAVY_TABLES else df


def read_sources(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None, **options) -> DataFrame:
    """A1: full scan of the credibility table (``factual_reporting``, ``url``, ...)."""
    reader = spark.read.format(fmt).options(**options)
    return (reader if schema is None else reader.schema(schema)).load(path)


# Error kinds, and the messages stored with them ({name} = a column value).
HTTP_STATUS_ERROR, TEXT_ERROR, TIMEOUT_ERROR = "HttpStatusError", "TextError", "TimeoutError"
ARCHIVED_URL_NOT_FOUND = "ArchivedURLNotFound"
MSG_HTTP_STATUS = "{url} responded with {status}"
MSG_TEXT = "{url} didn't respond with a string"
MSG_TIMEOUT = "request for {url} scraped from {source} took too much time"
MSG_ARCHIVE_NOT_FOUND = "url not found for {url}, scraped_from: {source}"
MSG_ENCODED_NOT_FOUND = "encoded URL not found in {url}"
MSG_NO_HEADER_INPUT = "'NoneType' object is not subscriptable"
MSG_NO_VALUE_ATTR = "'value'"


def message(template: str, **cols: Column) -> Column:
    """A stored message: the template's text with each ``{name}`` replaced by a column value."""
    parts = re.split(r"\{(\w+)\}", template)
    pieces = [F.lit(p) if i % 2 == 0 else cols[p].cast("string") for i, p in enumerate(parts) if p or i % 2]
    return F.concat(*pieces) if len(pieces) > 1 else pieces[0]


def scan_pages(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A4: split fetched responses into usable pages and failures.

    ``status != 200`` -> ``HttpStatusError``; a null body -> ``TextError``;
    otherwise the html is usable. A table without ``status`` counts as all 200.
    Returns ``(ok, failed)``; ``failed`` carries ``error_type`` and ``error_info``.
    """
    status = F.col("status") if "status" in responses.columns else F.lit(200)
    err_type = (F.when(status != 200, F.lit(HTTP_STATUS_ERROR))
                .when(F.col("html").isNull(), F.lit(TEXT_ERROR)))
    err_info = (F.when(status != 200, message(MSG_HTTP_STATUS, url=F.col("url"), status=status))
                .when(F.col("html").isNull(), message(MSG_TEXT, url=F.col("url"))))
    tagged = responses.withColumn("error_type", err_type).withColumn("error_info", err_info)
    ok = tagged.where(F.col("error_type").isNull()).drop("error_type", "error_info")
    failed = tagged.where(F.col("error_type").isNotNull())
    return ok, failed


def retry_predicate(fake: bool | Column) -> Column:
    """A5 predicate, with SQL precedence: ``type = 'TimeoutError' OR (type LIKE 'Client%' AND from_fake = fake)``.

    Timeouts are selected whatever ``fake`` is asked for.
    """
    f = fake if isinstance(fake, Column) else F.lit(bool(fake))
    return (F.col("type") == F.lit(TIMEOUT_ERROR)) | (F.col("type").like("Client%") & (F.col("from_fake") == f))


def retry_candidates(errors: DataFrame, fake: bool) -> DataFrame:
    """A5: stored errors worth another try."""
    return errors.where(retry_predicate(fake)).select(*ERROR_COLUMNS)


def ntz_literal(t: dt.datetime) -> Column:
    """A naive timestamp literal, independent of the host and session time zones."""
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def top_posts(posts: DataFrame, num_posts: int, as_of: dt.datetime, forums: DataFrame | None = None) -> DataFrame:
    """Per forum, the ``num_posts`` best-scored posts created in the year before ``as_of``.

    ``posts(sub, post_id, score, created, url, permalink)``. Ties on score go to the
    lower ``post_id``. ``forums(sub)`` restricts which forums are read. Spark plans the
    ``row_number() <= n`` filter as a per-task group limit before the shuffle, so a
    forum with most of the posts still only ships ``n`` rows per task.
    """
    start = ntz_literal(as_of - dt.timedelta(days=365))
    end = ntz_literal(as_of)
    p = posts.where((F.col("created") > start) & (F.col("created") <= end))
    if forums is not None:
        p = p.join(bounded_broadcast(forums.select("sub").distinct()), "sub", "left_semi")
    w = Window.partitionBy("sub").orderBy(F.col("score").desc(), F.col("post_id"))
    return p.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= num_posts) \
            .withColumn("rank", F.col("rank").cast("long"))
