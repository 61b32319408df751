"""Jobs composed from the operators.

``dispatch_batch`` is the core: admitted links -> pages -> articles -> de-dup ->
archived re-check -> rules, in this order (a row dropped later by a rule still
blocks its duplicates, so de-dup must come first).
"""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressloom.operators import articles as ar
from pressloom.operators import errors as er
from pressloom.operators import feeds as fd
from pressloom.operators import links as lk
from pressloom.operators.dedup import dedup_title_or_url
from pressloom.operators.labels import build_label_dim, label_lookup
from pressloom.operators.rules import Rules, default_url_checker
from pressloom.schemas import ARTICLE_SCHEMA, ERROR_COLUMNS, ERROR_SCHEMA, STATE_SCHEMA
from pressloom.sinks import store
from pressloom.sources import config as cf
from pressloom.sources.tables import ntz_literal
from pressloom.operators.common import cut_lineage, dropping_staged, global_row_number, staged


@dataclass
class Prepared:
    dim: DataFrame
    rules: Rules


def prepare_rules(sources: DataFrame, rules_config: Mapping | None, order_col: str | None = "source_id") -> Prepared:
    """P5: label dimension (A1 -> E3), admission closure over it (D1), then configured rules.

    The dimension is built once per job and materialised, since every batch
    (and every micro-batch of a stream) looks links up in it.
    """
    dim = cut_lineage(build_label_dim(sources, order_col))
    return Prepared(dim=dim, rules=Rules.from_config(rules_config, url_check=default_url_checker("_label")))


def admit_links(links: DataFrame, prep: Prepared) -> DataFrame:
    """D2 with the prepared checker: merged links whose host label admits them."""
    lab = label_lookup(lk.merge_links(links), prep.dim, "url", "_label")
    return prep.rules.admit(lab).drop("_label")


def dispatch_batch(links: DataFrame, responses: DataFrame, prep: Prepared,
                   run_ts: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """D2 -> E8 -> K6 -> G1 -> D3 -> D9, returning ``(articles, errors)``.

    ``links(batch_id, seq, url, scraped_from, fake)`` may hold many batches; the
    de-dup memory is per batch (G2).
    """
    admitted = admit_links(links, prep)
    arts, errors = ar.build_articles(admitted, responses, run_ts)
    # parsing is the expensive step: materialise its output once for the de-dup rounds and the result
    arts = staged(arts, "articles")
    unique = dedup_title_or_url(arts)
    lab = label_lookup(unique, prep.dim, "url", "_label")
    archived = F.col("url") != F.col("visited_url")
    rechecked = lab.where(~archived | prep.rules.url_check(F.col("url"), F.col("fake"), archived)).drop("_label")
    return prep.rules.apply(rechecked), errors


@contextmanager
def one_run(spark: SparkSession, out: Outputs, run_id: str) -> Iterator[None]:
    """All writes of a run as one: a run that fails on the way leaves nothing that a later one sees, under whatever name it
    is done again. Staged files are dropped at its end."""
    store.begin_run(spark, out.runs, run_id)
    with dropping_staged(spark):
        yield
    store.end_run(spark, out.runs, run_id)


def visible_articles(spark: SparkSession, out: Outputs) -> DataFrame:
    """The article table without rows of runs that haven't ended."""
    return store.read_batches(spark, out.articles, ARTICLE_SCHEMA).where(~F.col("run_id").isin(sorted(store.open_runs(spark, out.runs))))


@dataclass
class Outputs:
    """Where a job writes: article and error tables (run and batch partitions), state versions."""
    articles: str
    errors: str
    state: str

    @property
    def clean_errors(self) -> str:
        return f"{self.errors.rstrip('/')}_clean"

    @property
    def runs(self) -> str:
        """Markers of runs that have begun and not ended; what these wrote counts for no other run."""
        return f"{self.articles.rstrip('/')}_runs"


#: batch ids of forums begin above this, those of the rounds of site feeds below
FORUM_BATCHES = 1 << 40


def run_name(run_ts: dt.datetime) -> str:
    """Run id of a start time; names sort in time order."""
    return f"{run_ts:%Y%m%dT%H%M%S%f}"


def current_errors(spark: SparkSession, out: Outputs, run_id: str) -> DataFrame:
    """The error table as it stands before ``run_id``: the newest cleaned version, else all rows of other runs."""
    lost = store.open_runs(spark, out.runs)
    version = store.latest_version(spark, out.clean_errors, run_id, lost)
    if version is not None:
        return store.read_version(spark, out.clean_errors, version, ERROR_SCHEMA)
    return store.read_batches(spark, out.errors, ERROR_SCHEMA).where(~F.col("run_id").isin(sorted(lost | {run_id}))).select(*ERROR_COLUMNS)


def saved_state(spark: SparkSession, out: Outputs, run_id: str) -> DataFrame:
    """Progress as it stands before ``run_id``: the newest earlier version, else empty."""
    version = store.latest_version(spark, out.state, run_id, store.open_runs(spark, out.runs))
    return spark.createDataFrame([], STATE_SCHEMA) if version is None else store.read_version(spark, out.state, version, STATE_SCHEMA)


def run_errors(spark: SparkSession, out: Outputs, run_id: str) -> DataFrame:
    return store.read_batches(spark, out.errors, ERROR_SCHEMA).where(F.col("run_id") == run_id).select(*ERROR_COLUMNS)


def clean_error_table(errors: DataFrame, out: Outputs, run_id: str) -> DataFrame:
    """P4 at the end of a job: E5 then E4 against the whole article table; written as the version of this run
    (``<errors>_clean/v=<run_id>``), which the next job starts from, and returned as read back."""
    spark = errors.sparkSession
    lost = store.open_runs(spark, out.runs) - {run_id}
    articles = store.read_batches(spark, out.articles, ARTICLE_SCHEMA).where(~F.col("run_id").isin(sorted(lost)))
    cleaned = er.cleanup_errors(errors.select(*ERROR_COLUMNS), articles)
    store.write_version(store.sink_projection(cleaned, ERROR_SCHEMA), out.clean_errors, run_id)
    return store.read_version(spark, out.clean_errors, run_id, ERROR_SCHEMA)


def _store(articles: DataFrame, errors: DataFrame, out: Outputs, run_ts: dt.datetime, run_id: str) -> DataFrame:
    stored, refused = store.store_articles(articles, out.articles, run_ts, run_id, out.runs)
    store.store_errors(errors.unionByName(refused.drop("seq"), allowMissingColumns=True), out.errors, run_id)
    return stored


def site_links(feeds: DataFrame, pages: DataFrame, store_feed_errors: bool = False,
               edges: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Walk the feeds and collect their article links: ``(links, state, errors or None)``.

    ``feeds`` as read by A2, resumed: name, url, sel, stop_after, fake_news, condition and
    position (the order of the configuration). Each feed has its own selectors and
    condition; next links come from the pages (I2) unless ``edges`` gives them. Links
    have one batch per round and are numbered in it by feed position, entry and link.
    """
    if edges is None:
        edges = staged(fd.next_pages(feeds, pages), "next-pages")
    walk = fd.walk_feed(feeds, edges)
    entries = staged(fd.feed_entries(walk, pages, feeds, resolve=True), "entries")
    found, missing = fd.feed_links(entries, pages, feeds)
    numbered = global_row_number(found, ["batch_id", "position", "entry_pos", "link_pos"], out="seq")
    links = numbered.select("batch_id", "seq", "url", "scraped_from", "fake")
    errors = None
    if store_feed_errors:
        errors = missing.select("type", "url", "source_article", "from_fake", "additional_info").unionByName(
            fd.missing_feed_pages(feeds, edges, walk))
    return links, fd.latest_state(fd.feed_state(walk)), errors


def collect_job(feeds: DataFrame | None, pages: DataFrame, responses: DataFrame, prep: Prepared, out: Outputs,
                run_ts: dt.datetime, run_id: str | None = None, state: DataFrame | None = None,
                forum_links: DataFrame | None = None, forum_state: DataFrame | None = None,
                store_feed_errors: bool = False, edges: DataFrame | None = None) -> DataFrame:
    """Resume feeds (A3, E7, D12) -> walk (I3) -> feed links (I4) + forum links (I7) -> J2 ->
    P3 per batch -> store (B1, B2) -> state (B3) -> clean errors (P4).

    Either feeds or forums may be absent. ``state``: saved progress, by default the newest
    version before this run; forums that are over are left out like feeds. With
    ``store_feed_errors`` feed and entry pages that were not fetched are stored as errors
    (not done by default). Doing a run again replaces what it stored. Returns the stored
    articles.
    """
    if feeds is None and forum_links is None:
        raise ValueError("no sources to begin with")
    spark, run_id = responses.sparkSession, run_id or run_name(run_ts)
    state = saved_state(spark, out, run_id) if state is None else state
    with one_run(spark, out, run_id):
        sites, forums, states, feed_errors = None, None, [], None
        if feeds is not None:
            sites, new, feed_errors = site_links(cf.resume_feeds(feeds, state), pages, store_feed_errors, edges)
            states.append(new)
        if forum_links is not None:
            over = state.where("is_over").select(F.col("name").alias("_over"))
            # one batch per forum, in order of name, after all rounds of the sites
            names = forum_links.select(F.col("batch_key").alias("_forum")).distinct().withColumn(
                "batch_id", F.row_number().over(Window.orderBy("_forum")) + FORUM_BATCHES)
            forums = forum_links.join(over, F.col("batch_key") == F.col("_over"), "left_anti").join(
                names, F.col("batch_key") == F.col("_forum")).select("batch_id", "seq", "url", "scraped_from", "fake")
            if forum_state is not None:
                states.append(forum_state.join(over, F.col("name") == F.col("_over"), "left_anti").select("name", "is_over", F.struct(
                    F.lit(None).cast("string").alias("url"), F.lit(None).cast("long").alias("page"),
                    F.col("posts").cast("long").alias("posts")).alias("data")))
        parts = [p for p in (sites, forums) if p is not None]  # J2: sites, then forums
        links = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        arts, errors = dispatch_batch(links, responses, prep, run_ts)
        if feed_errors is not None:
            errors = errors.unionByName(feed_errors.select("*", ntz_literal(run_ts).alias("creation_date"), F.lit(0).cast("long").alias("batch_id")),
                                        allowMissingColumns=True)
        stored = _store(arts, errors, out, run_ts, run_id)
        if states:
            new = states[0] if len(states) == 1 else states[0].unionByName(states[1])
            store.write_version(cf.upsert_state(state, new), out.state, run_id)
        clean_error_table(current_errors(spark, out, run_id).unionByName(run_errors(spark, out, run_id)), out, run_id)
    return store.read_batches(spark, out.articles, ARTICLE_SCHEMA).where(F.col("run_id") == run_id).drop("run_id")


def retry_order() -> Column:
    """Total order of stored errors, which carry no id: date (none first), kind, source, mark, message.

    The last error of a url gives its retry link.
    """
    return F.struct(F.coalesce("creation_date", F.lit("1900-01-01 00:00:00").cast("timestamp_ntz")).alias("d"),
                    F.col("type").alias("t"), F.coalesce("source_article", F.lit("")).alias("s"),
                    F.col("from_fake").alias("f"), F.coalesce("additional_info", F.lit("")).alias("i"))


def retry_batches(errors: DataFrame) -> DataFrame:
    """J3 with a total order: the two retry batches of stored errors, numbered by url."""
    retry = lk.union_retry(errors.withColumn("_order", retry_order()), order_col="_order")
    return global_row_number(retry.drop("seq"), ["batch_id", "url"], out="seq")


def restore_job(responses: DataFrame, prep: Prepared, out: Outputs, run_ts: dt.datetime, run_id: str | None = None,
                errors_table: DataFrame | None = None) -> DataFrame:
    """Retry candidates (A5, I8, J3) -> P3 -> store (B1) -> delete restored errors (E6) -> P4.

    ``errors_table``: the errors to retry, by default the error table as it stands.
    Returns the cleaned error table, written as the version of this run.
    """
    spark, run_id = responses.sparkSession, run_id or run_name(run_ts)
    with one_run(spark, out, run_id):
        before = current_errors(spark, out, run_id) if errors_table is None else errors_table.select(*ERROR_COLUMNS)
        arts, errs = dispatch_batch(retry_batches(before), responses, prep, run_ts)
        stored = _store(arts, errs, out, run_ts, run_id)
        # the error table now holds the errors from before and this run's failures
        remaining = er.delete_restored_errors(before.unionByName(run_errors(spark, out, run_id)), stored.select("url"))  # E6
        return clean_error_table(remaining, out, run_id)  # P4: E5, then E4
