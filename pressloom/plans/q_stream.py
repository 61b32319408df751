"""Queries for the streaming operators M1, M3, M4.

The streaming wrapper (``start_article_stream``) hands each micro-batch to
``process_batch`` through ``foreachBatch``. These queries drive the same body
epoch by epoch over the link batches derived from the driver's tables (one
epoch per batch, in order), which is what the stream does with one link file
per batch; the result must equal the batch job's result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.operators import feeds as fd
from pressloom.plans import jobs
from pressloom.plans import oracle as o
from pressloom.plans.q_articles import BUILD_CTES, BUILT_FLAT, RUN_TS, dedup_walk_sql
from pressloom.plans.q_feeds import LATEST_SQL, _walk, walk_sql
from pressloom.plans.q_jobs import DISP_SQL, _prep, retry_ctes, scratch
from pressloom.plans.registry import register
from pressloom.schemas import ARTICLE_COLUMNS, ARTICLE_SCHEMA, ERROR_SCHEMA, STATE_SCHEMA
from pressloom.sinks import store
from pressloom.sources.fixtures import Views
from pressloom.streaming.stream import StreamContext, process_batch, save_progress

ARRAYS = ("authors", "images", "videos", "keywords")


def _epochs(df: DataFrame, col: str) -> list:
    """The micro-batch boundaries of the fixtures: their batch ids are four at most, their rounds five."""
    return [r[0] for r in df.select(col).distinct().orderBy(col).collect()]


def _outputs(spark: SparkSession, name: str) -> jobs.Outputs:
    base = scratch(spark, name)
    return jobs.Outputs(articles=f"{base}/article", errors=f"{base}/error", state=f"{base}/state")


@register("stream_articles", o.with_views(
    BUILT_FLAT.replace("SELECT batch_id, seq, ", "SELECT batch_id, ")
    + " FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY batch_id, seq) AS rn FROM disp) d WHERE rn = 1",
    "src", "lnk", "resp1", extra=BUILD_CTES + dedup_walk_sql("built") + [("disp", DISP_SQL)], recursive=True))
def q_stream_articles(spark: SparkSession, sf: str) -> DataFrame:
    """M1: every link batch as one micro-batch; the article table after the last epoch."""
    v = Views(spark, sf)
    out = _outputs(spark, "stream-articles")
    ctx = StreamContext(v.resp, _prep(v), out, RUN_TS, jobs.run_name(RUN_TS))
    links = v.lnk
    for epoch, b in enumerate(_epochs(links, "batch_id")):
        process_batch(links.where(F.col("batch_id") == b), epoch, ctx)
    arts = store.read_batches(spark, out.articles, ARTICLE_SCHEMA)
    return arts.select("batch_id", *[F.array_join(c, "|").alias(c) if c in ARRAYS else F.col(c)
                                     for c in ARTICLE_COLUMNS])


@register("stream_state", o.with_views(
    "SELECT name, is_over, url, page FROM (" + LATEST_SQL + ") l", "feed", extra=walk_sql("feed"), recursive=True))
def q_stream_state(spark: SparkSession, sf: str) -> DataFrame:
    """M3: each epoch saves the latest states of its rounds over the previous version; the last version is the progress."""
    v = Views(spark, sf)
    walk = _walk(v)
    states = fd.feed_state(walk)
    state_dir = scratch(spark, "stream-state")
    states = states.withColumn("epoch", F.floor(F.log2(F.col("round") + 1)))  # each epoch brings as many rounds as all before
    for e in _epochs(states, "epoch"):
        save_progress(spark, fd.latest_state(states.where(F.col("epoch") == e)), state_dir, jobs.run_name(RUN_TS), int(e))
    last = store.read_version(spark, state_dir, store.latest_version(spark, state_dir), STATE_SCHEMA)
    return last.select("name", "is_over", "data.url", "data.page")


@register("stream_delete", o.with_views(
    "SELECT * FROM err WHERE url IS NULL OR url NOT IN (SELECT url FROM disp WHERE url IS NOT NULL)", "src", "err", "resp1",
    extra=retry_ctes() + BUILD_CTES + dedup_walk_sql("built") + [("disp", DISP_SQL)], recursive=True))
def q_stream_delete(spark: SparkSession, sf: str) -> DataFrame:
    """M4: restoring; each epoch's stored urls delete their errors from the versioned error table."""
    v = Views(spark, sf)
    out = _outputs(spark, "stream-delete")
    versions = scratch(spark, "stream-delete-errors")
    stream = jobs.run_name(RUN_TS)
    store.write_version(v.err, versions, "")  # the name before all others
    ctx = StreamContext(v.resp, _prep(v), out, RUN_TS, stream, restoring=True, errors_versions=versions)
    links = jobs.retry_batches(v.err)
    for epoch, b in enumerate(_epochs(links, "batch_id")):
        process_batch(links.where(F.col("batch_id") == b), epoch, ctx)
    return store.read_version(spark, versions, store.latest_version(spark, versions), ERROR_SCHEMA)
