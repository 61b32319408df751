"""Structured Streaming jobs (M1-M4).

* M1 ``start_article_stream``: link files -> ``foreachBatch(process_batch)``;
  one micro-batch is one de-dup scope per ``batch_id`` (G2).
* M2 ``start_error_stream``: error rows -> parquet file sink (append).
* M3: offsets live in ``checkpointLocation``; business state (B3) is written by
  ``process_batch`` as a new version per epoch.
* M4: when restoring, each stored url deletes its errors (E6) in the same epoch. An epoch writes
  the deleted urls only; readers leave them out, and every ``COMPACT_AFTER`` epochs the table is written whole.

``foreachBatch`` is at-least-once; ``process_batch`` is idempotent because every
write replaces exactly the partitions and the version of its (stream, epoch). The
stream's name goes before the epoch in both, so another stream, or the same one from a
new checkpoint under a new name, never writes over what is there.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pressloom.operators.common import dropping_staged
from pressloom.plans.jobs import Outputs, Prepared, dispatch_batch, _store
from pressloom.schemas import ERROR_SCHEMA, LINK_SCHEMA, STATE_SCHEMA
from pressloom.sinks import store
from pressloom.sources import config as cf

#: epochs of deletions that readers of the error table put together at most
COMPACT_AFTER = 100


@dataclass
class StreamContext:
    responses: DataFrame
    prep: Prepared
    out: Outputs
    run_ts: dt.datetime
    stream: str  # run id of the stream: names of later streams sort after it (see jobs.run_name)
    restoring: bool = False
    errors_versions: str | None = None  # M4: versioned error table to clean
    states: DataFrame | None = None  # M3: states produced with the links, if any


def epoch_name(stream: str, epoch: int) -> str:
    return f"{stream}-{epoch:012d}"


def _earlier(spark: SparkSession, base: str, stream: str, epoch: int) -> str | None:
    """The newest version before this epoch. After epoch 0 there must be one of this very stream,
    since every epoch writes a version; without it progress would be lost, so that is an error."""
    version = store.latest_version(spark, base, epoch_name(stream, epoch))
    if epoch > 0 and (version is None or not version.startswith(f"{stream}-")):
        raise FileNotFoundError(f"no version of {stream} before epoch {epoch} in {base}")
    return version


def save_progress(spark: SparkSession, states: DataFrame, state_dir: str, stream: str, epoch: int) -> str:
    """Merge this epoch's collector states over the newest earlier version; write the epoch's own.

    A retried epoch rewrites only its own version and never the one it reads. Epoch 0
    goes on from the newest version of any earlier stream or job.
    """
    cols = ["name", "is_over", "data"]
    version = _earlier(spark, state_dir, stream, epoch)
    old = states.select(*cols).limit(0) if version is None else store.read_version(spark, state_dir, version, STATE_SCHEMA)
    return store.write_version(cf.upsert_state(old, states.select(*cols)), state_dir, epoch_name(stream, epoch))


def process_batch(links: DataFrame, epoch_id: int, ctx: StreamContext) -> DataFrame:
    """M1 body for one micro-batch of ``link`` rows; returns the stored articles. What it stages is dropped at its end."""
    with dropping_staged(links.sparkSession):
        return _process(links, epoch_id, ctx)


def _process(links: DataFrame, epoch_id: int, ctx: StreamContext) -> DataFrame:
    spark = links.sparkSession
    name = epoch_name(ctx.stream, epoch_id)
    arts, errors = dispatch_batch(links, ctx.responses, ctx.prep, ctx.run_ts)
    stored = _store(arts, errors, ctx.out, ctx.run_ts, name)
    if ctx.states is not None:  # M3: progress is stored after the articles (not before)
        mine = ctx.states.join(links.select("batch_id").distinct(), "batch_id", "left_semi") \
            if "batch_id" in ctx.states.columns else ctx.states
        save_progress(spark, mine, ctx.out.state, ctx.stream, epoch_id)
    if ctx.restoring and ctx.errors_versions:  # M4: each stored url deletes its errors
        version = _earlier(spark, ctx.errors_versions, ctx.stream, epoch_id)
        if version is not None:
            store.write_deletions(stored.select("url"), ctx.errors_versions, name, after=version)
            if len(store.version_parts(spark, ctx.errors_versions, name)[1]) >= COMPACT_AFTER:
                store.compact_version(spark, ctx.errors_versions, name, ERROR_SCHEMA)
    return stored


def start_article_stream(spark: SparkSession, links_dir: str, ctx: StreamContext, checkpoint: str,
                         available_now: bool = True) -> StreamingQuery:
    """M1: process every link file that arrives in ``links_dir``."""
    src = spark.readStream.schema(LINK_SCHEMA).parquet(links_dir)
    w = (src.writeStream.foreachBatch(lambda df, epoch: process_batch(df, epoch, ctx))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def start_error_stream(errors: DataFrame, out_dir: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """M2: append streamed error rows to a parquet table (exactly-once file sink)."""
    w = (errors.select(*[F.col(f.name).cast(f.dataType) for f in ERROR_SCHEMA.fields])
         .writeStream.format("parquet").outputMode("append")
         .option("path", out_dir).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
