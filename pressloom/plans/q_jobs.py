"""Queries for sinks, jobs and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.operators import links as lk
from pressloom.plans import jobs
from pressloom.plans import oracle as o
from pressloom.plans.q_articles import (ADMITTED, BUILD_CTES, BUILD_ERRORS_SQL, BUILT_FLAT, RUN_TS, RUN_TS_SQL,
                                        _built, _flat, dedup_walk_sql)
from pressloom.plans.q_feeds import ENTRIES_SQL, FEED_LINKS_SQL, walk_sql
from pressloom.plans.q_links import AS_OF, ERR_ORDERED_SQL, FORUM_LINKS_SQL, NUM_POSTS, RETRY_SQL, SUBS_SQL, _subs
from pressloom.plans.registry import register
from pressloom.schemas import ARTICLE_SCHEMA, ERROR_COLUMNS, ERROR_SCHEMA, EVENTS_SCHEMA
from pressloom.session import checkpoint_dir
from pressloom.sinks import store
from pressloom.sources.fixtures import Views, err_rows, events_with_page
from pressloom.sources.tables import read_table
from pressloom.streaming.stream import start_error_stream

# Rule configuration used by the dispatch queries (ours).
DISPATCH_RULES = {"blacklist": {"titles": ["Page not found"], "urls": []},
                  "min_length": {"title": 5, "text": 200, "path_loc": 2}}


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never a machine-local temp dir on a cluster)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/pressloom-{name}-{uuid.uuid4().hex[:12]}"


def _prep(v: Views) -> jobs.Prepared:
    return jobs.prepare_rules(v.src, DISPATCH_RULES)


@register("prepare_rules", o.with_views("SELECT * FROM admitted", "src", "lnk", extra=ADMITTED))
def q_prepare_rules(spark: SparkSession, sf: str) -> DataFrame:
    v = Views(spark, sf)
    return jobs.admit_links(v.lnk, _prep(v)).select("batch_id", "seq", "url", "scraped_from", "fake")


DISPATCH_WHERE = f"""
WHERE (b.url = b.visited_url OR {o.admission('d.label', 'b.fake', 'b.url <> b.visited_url')})
  AND coalesce(b.title NOT IN ('Page not found'), true)
  AND coalesce(length(b.title) >= 5, false) AND coalesce(length(b.text) >= 200, false)
  AND coalesce(length(b.path) >= 2, false)"""


DISP_SQL = f"""SELECT b.* FROM built b JOIN kept k ON k.batch_id = b.batch_id AND k.seq = b.seq
    LEFT JOIN dim d ON d.key = {o.site_key('b.url')} {DISPATCH_WHERE}"""


@register("dispatch_batch", o.with_views(
    BUILT_FLAT + " FROM disp", "src", "lnk", "resp1",
    extra=BUILD_CTES + dedup_walk_sql("built") + [("disp", DISP_SQL)], recursive=True))
def q_dispatch_batch(spark: SparkSession, sf: str) -> DataFrame:
    v = Views(spark, sf)
    arts, _ = jobs.dispatch_batch(v.lnk, v.resp, _prep(v), RUN_TS)
    return _flat(arts)


STORED_SQL = """
SELECT batch_id, seq, CASE WHEN url IS NULL THEN 'NotNullViolationError'
                           WHEN rn = 1 AND url NOT IN (SELECT url FROM pages WHERE page_id % 10 = 0) THEN 'stored'
                           ELSE 'UniqueViolationError' END AS outcome
FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY batch_id, seq) AS rn FROM built) b"""


@register("store_articles", o.with_views(STORED_SQL, "src", "lnk", "resp1", extra=BUILD_CTES))
def q_store_articles(spark: SparkSession, sf: str) -> DataFrame:
    """B1: two runs into one store; the first has put every tenth page url there."""
    v = Views(spark, sf)
    arts, _ = _built(v)
    path = scratch(spark, "articles")
    held = v.pages.where(F.col("page_id") % 10 == 0).groupBy("url").agg(F.min("page_id").alias("seq"))
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in ARTICLE_SCHEMA.fields if f.name != "url"]
    store.store_articles(held.select(F.lit(0).cast("long").alias("batch_id"), "seq", "url", *rest), path, RUN_TS, "run-1")
    _, refused = store.store_articles(arts, path, RUN_TS, "run-2")
    kept = store.read_batches(spark, path, ARTICLE_SCHEMA).where("run_id = 'run-2'").select(F.col("url").alias("_u"))
    positions = arts.select("batch_id", "seq", "url").join(refused.select("batch_id", "seq"), ["batch_id", "seq"], "left_anti")
    return (positions.join(kept, F.col("url") == F.col("_u")).select("batch_id", "seq", F.lit("stored").alias("outcome"))
            .unionByName(refused.select("batch_id", "seq", F.col("type").alias("outcome"))))


@register("store_errors", o.with_views(BUILD_ERRORS_SQL, "src", "lnk", "resp1", extra=BUILD_CTES))
def q_store_errors(spark: SparkSession, sf: str) -> DataFrame:
    """B2: errors written to a batch-partitioned table and read back."""
    _, errs = _built(Views(spark, sf))
    path = scratch(spark, "errors")
    store.store_errors(errs, path, jobs.run_name(RUN_TS))
    return store.read_batches(spark, path, ERROR_SCHEMA).select(*ERROR_COLUMNS)


@register("sink_projection", o.with_views(
    BUILT_FLAT.replace("SELECT batch_id, seq, ", "SELECT ") + " FROM built", "src", "lnk", "resp1", extra=BUILD_CTES))
def q_sink_projection(spark: SparkSession, sf: str) -> DataFrame:
    arts, _ = _built(Views(spark, sf))
    return _flat(store.sink_projection(arts, ARTICLE_SCHEMA))


# ---- whole jobs: the links of a job stand for the lnk view in the SQL of a batch ----

JOB_LINKS_SQL = f"""
SELECT batch_id, row_number() OVER (ORDER BY batch_id, position, entry_pos, link_pos) AS seq, url, scraped_from, fake FROM ({FEED_LINKS_SQL}) s
UNION ALL
SELECT {jobs.FORUM_BATCHES} + dense_rank() OVER (ORDER BY batch_key), seq, url, scraped_from, fake FROM ({FORUM_LINKS_SQL}) f"""
RESUMED_CONF_SQL = """
SELECT f.name, coalesce(s.url, f.url) AS url, coalesce(s.page, f.stop_after) AS stop_after, f.fake_news, f.position
FROM conf f LEFT JOIN state s ON s.name = f.name WHERE NOT coalesce(s.is_over, false)"""
FIRST_OF_URL_SQL = """SELECT *, row_number() OVER (PARTITION BY url ORDER BY batch_id, seq) AS of_url FROM disp"""
ARTICLES_SQL = BUILT_FLAT.replace("SELECT batch_id, seq, ", "SELECT ") + " FROM first_of_url WHERE url IS NOT NULL AND of_url = 1"


@register("collect_job", o.with_views(
    ARTICLES_SQL, "conf", "state", "site", "post", "src", "resp1",
    extra=[("subs", SUBS_SQL), ("resumed", RESUMED_CONF_SQL)] + walk_sql("resumed", "feed_walk")
    + [("ent", ENTRIES_SQL.replace("FROM walk w", "FROM feed_walk w")), ("lnk", JOB_LINKS_SQL)] + BUILD_CTES
    + dedup_walk_sql("built") + [("disp", DISP_SQL), ("first_of_url", FIRST_OF_URL_SQL)], recursive=True))
def q_collect_job(spark: SparkSession, sf: str) -> DataFrame:
    """P1 end to end: feeds (walked, resumed) and forum posts -> stored articles (read back)."""
    v = Views(spark, sf)
    base = scratch(spark, "collect")
    out = jobs.Outputs(articles=f"{base}/article", errors=f"{base}/error", state=f"{base}/state")
    flinks, fstate = lk.forum_links(v.post, _subs(v), NUM_POSTS, AS_OF)
    state = v.state.select("name", "is_over", F.struct(F.col("url"), F.col("page").cast("long").alias("page"),
                                                       F.lit(None).cast("long").alias("posts")).alias("data"))
    stored = jobs.collect_job(v.conf, v.site, v.resp, _prep(v), out, RUN_TS, state=state, forum_links=flinks, forum_state=fstate)
    return _flat(stored.drop("batch_id"))


def retry_ctes() -> list[tuple[str, str]]:
    """The retry batches of the err view, as the lnk view."""
    union = RETRY_SQL.format(b="CAST(0 AS BIGINT)", f="true") + " UNION ALL " + RETRY_SQL.format(b="CAST(1 AS BIGINT)", f="false")
    return [("err_o", ERR_ORDERED_SQL), ("lnk", f"""
        SELECT batch_id, row_number() OVER (ORDER BY batch_id, url NULLS FIRST) AS seq, url, scraped_from, fake FROM ({union}) r""")]


RUN_ERRORS_SQL = f"""{BUILD_ERRORS_SQL} UNION ALL
SELECT CASE WHEN url IS NULL THEN 'NotNullViolationError' ELSE 'UniqueViolationError' END, visited_url, scraped_from, fake,
       CASE WHEN url IS NULL THEN 'null value in column "url" violates not-null constraint'
            ELSE concat('duplicate key value violates unique constraint: url=', url) END, {RUN_TS_SQL}
FROM first_of_url WHERE url IS NULL OR of_url > 1"""
REMAINING_SQL = """
SELECT * FROM (SELECT * FROM err UNION ALL SELECT * FROM run_errors) a
WHERE url IS NULL OR url NOT IN (SELECT url FROM first_of_url WHERE url IS NOT NULL)"""
CLEANED_SQL = """
SELECT * FROM remaining r
WHERE url IS NULL OR (NOT EXISTS (SELECT 1 FROM latest b WHERE b.url = r.url AND b.d > r.creation_date)
  AND url NOT IN (SELECT visited_url FROM first_of_url WHERE url IS NOT NULL AND of_url = 1 AND visited_url IS NOT NULL))"""


@register("restore_job", o.with_views(
    CLEANED_SQL, "src", "err", "resp1", extra=retry_ctes() + BUILD_CTES + dedup_walk_sql("built") + [
        ("disp", DISP_SQL), ("first_of_url", FIRST_OF_URL_SQL), ("run_errors", RUN_ERRORS_SQL), ("remaining", REMAINING_SQL),
        ("latest", "SELECT url, max(creation_date) AS d FROM remaining GROUP BY url")], recursive=True))
def q_restore_job(spark: SparkSession, sf: str) -> DataFrame:
    """P2 end to end: retry stored errors against the responses; returns the cleaned error table."""
    v = Views(spark, sf)
    base = scratch(spark, "restore")
    out = jobs.Outputs(articles=f"{base}/article", errors=f"{base}/error", state=f"{base}/state")
    return jobs.restore_job(v.resp, _prep(v), out, RUN_TS, errors_table=v.err)


@register("stream_errors", o.with_views("SELECT * FROM err", "err"))
def q_stream_errors(spark: SparkSession, sf: str) -> DataFrame:
    """M2: the events file read as a stream, turned into error rows, appended to a parquet table."""
    base = scratch(spark, "stream-errors")
    # a glob, so the file source lists the table's folder and picks the events file
    events = spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{sf.rstrip('/')}/event[s].parquet")
    pages = read_table(spark, sf, "pages")
    q = start_error_stream(err_rows(events_with_page(events, pages)), f"{base}/out", f"{base}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")

