"""Queries for labels, admission and link batches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.functions.html import page_title
from pressloom.operators import labels as lb
from pressloom.operators.articles import link_pages
from pressloom.operators import links as lk
from pressloom.plans import oracle as o
from pressloom.plans.registry import register
from pressloom.sources.fixtures import Views
from pressloom.operators.common import staging_path
from pressloom.sources.tables import read_sources, retry_candidates, top_posts

DIM = ("dim", o.LABEL_DIM_SQL)
MERGED_SQL = """
SELECT batch_id, min(seq) AS seq, url, arg_max_null(scraped_from, seq) AS scraped_from, arg_max_null(fake, seq) AS fake
FROM lnk GROUP BY batch_id, url"""
MERGED = ("merged", MERGED_SQL)
LABELLED_SQL = f"""
SELECT m.*, d.label FROM (SELECT *, {o.site_key('url')} AS k FROM merged) m LEFT JOIN dim d ON d.key = m.k"""


def _dim(v: Views) -> DataFrame:
    return lb.build_label_dim(v.src)


# ---- flagship: admitted links with a usable page, by label and feed mark ----

FLAGSHIP_SQL = o.with_views(f"""
SELECT l.label, l.fake, CAST(count(*) AS BIGINT) AS n_pages,
       CAST(sum(CASE WHEN p.title <> '' THEN 1 ELSE 0 END) AS BIGINT) AS n_titled,
       CAST(sum(length(p.title)) AS BIGINT) AS title_chars
FROM labelled l
JOIN (SELECT url, {o.page_title('html')} AS title FROM resp1 WHERE status = 200 AND html IS NOT NULL) p ON p.url = l.url
WHERE {o.admission('l.label', 'l.fake', 'false')}
GROUP BY l.label, l.fake""", "src", "lnk", "resp1", extra=[DIM, MERGED, ("labelled", LABELLED_SQL)])


@register("admitted_pages_by_label", FLAGSHIP_SQL)
def admitted_pages_by_label(spark: SparkSession, sf: str) -> DataFrame:
    v = Views(spark, sf)
    links = lb.label_lookup(lk.merge_links(v.lnk), _dim(v), "url", "label")
    admitted = links.where(lb.admission(F.col("label"), F.col("fake"), F.lit(False)))
    linked = link_pages(admitted, v.resp, {"title": page_title(F.when(F.col("status") == 200, F.col("html")))})
    return (linked.where(F.col("title").isNotNull()).groupBy("label", "fake")
            .agg(F.count(F.lit(1)).cast("long").alias("n_pages"),
                 F.sum(F.when(F.col("title") != "", 1).otherwise(0)).cast("long").alias("n_titled"),
                 F.sum(F.length("title")).cast("long").alias("title_chars")))


# ---- sources and labels ----

@register("read_sources", o.with_views("SELECT source_id, factual_reporting, url FROM src", "src"))
def q_read_sources(spark: SparkSession, sf: str) -> DataFrame:
    """A1: the credibility table, written as CSV and read back."""
    path = staging_path(spark, "sources")
    Views(spark, sf).src.write.option("header", True).csv(path)
    return read_sources(spark, path, "csv", header=True, schema="source_id long, factual_reporting string, url string")


@register("build_label_dim", o.with_views("SELECT key, label FROM dim", "src", extra=[DIM]))
def q_build_label_dim(spark: SparkSession, sf: str) -> DataFrame:
    return _dim(Views(spark, sf))


@register("label_keys", o.with_views("SELECT DISTINCT key FROM dim", "src", extra=[DIM]))
def q_label_keys(spark: SparkSession, sf: str) -> DataFrame:
    return lb.label_keys(_dim(Views(spark, sf)))


@register("label_lookup", o.with_views(
    f"SELECT l.batch_id, l.seq, l.url, d.label FROM lnk l LEFT JOIN dim d ON d.key = {o.site_key('l.url')}",
    "src", "lnk", extra=[DIM]))
def q_label_lookup(spark: SparkSession, sf: str) -> DataFrame:
    v = Views(spark, sf)
    return lb.label_lookup(v.lnk, _dim(v), "url", "label").select("batch_id", "seq", "url", "label")


@register("label_membership", o.with_views(
    f"SELECT l.batch_id, l.seq, l.url FROM lnk l WHERE {o.site_key('l.url')} IN (SELECT key FROM dim)",
    "src", "lnk", extra=[DIM]))
def q_label_membership(spark: SparkSession, sf: str) -> DataFrame:
    v = Views(spark, sf)
    return lb.label_membership(v.lnk, _dim(v), "url").select("batch_id", "seq", "url")


@register("url_admission", o.with_views(f"""
SELECT l.seq, l.url, l.fake, d.label,
       {o.admission('d.label', 'l.fake', 'false')} AS direct_ok,
       {o.admission('d.label', 'l.fake', 'true')} AS archived_ok
FROM lnk l LEFT JOIN dim d ON d.key = {o.site_key('l.url')}""", "src", "lnk", extra=[DIM]))
def q_url_admission(spark: SparkSession, sf: str) -> DataFrame:
    v = Views(spark, sf)
    lab = lb.label_lookup(v.lnk, _dim(v), "url", "label")
    return lab.select("seq", "url", "fake", "label",
                      lb.admission(F.col("label"), F.col("fake"), F.lit(False)).alias("direct_ok"),
                      lb.admission(F.col("label"), F.col("fake"), F.lit(True)).alias("archived_ok"))


# ---- link batches ----

@register("merge_links", o.with_views("SELECT * FROM merged", "lnk", extra=[MERGED]))
def q_merge_links(spark: SparkSession, sf: str) -> DataFrame:
    return lk.merge_links(Views(spark, sf).lnk)


@register("prefetch_filter", o.with_views(
    f"SELECT batch_id, seq, url, scraped_from, fake FROM labelled WHERE {o.admission('label', 'fake', 'false')}",
    "src", "lnk", extra=[DIM, MERGED, ("labelled", LABELLED_SQL)]))
def q_prefetch_filter(spark: SparkSession, sf: str) -> DataFrame:
    v = Views(spark, sf)
    return lk.prefetch_filter(lk.merge_links(v.lnk), _dim(v)).select("batch_id", "seq", "url", "scraped_from", "fake")


@register("batch_counts", o.with_views(
    "SELECT batch_id, CAST(count(*) AS BIGINT) AS n FROM merged GROUP BY batch_id", "lnk", extra=[MERGED]))
def q_batch_counts(spark: SparkSession, sf: str) -> DataFrame:
    return lk.batch_counts(lk.merge_links(Views(spark, sf).lnk))


# Batch a = first link rows of each batch, batch b = the repeats (feed9) of the same batch
@register("merge_batches", o.with_views("""
SELECT batch_id, min(struct_pack(part := part, seq := seq)).part AS part, min(struct_pack(part := part, seq := seq)).seq AS seq,
       url, arg_max(scraped_from, struct_pack(part := part, seq := seq)) AS scraped_from,
       arg_max(fake, struct_pack(part := part, seq := seq)) AS fake
FROM (SELECT *, CASE WHEN seq >= 1000000 THEN 1 ELSE 0 END AS part FROM lnk) t GROUP BY batch_id, url""", "lnk"))
def q_merge_batches(spark: SparkSession, sf: str) -> DataFrame:
    lnk = Views(spark, sf).lnk
    a = lnk.where(F.col("seq") < 1000000)
    b = lnk.where(F.col("seq") >= 1000000)
    return lk.merge_batches(a, b)


# ---- errors and retries ----

@register("retry_candidates", o.with_views("""
SELECT *, true AS asked_fake FROM err WHERE type = 'TimeoutError' OR type LIKE 'Client%' AND from_fake = true
UNION ALL
SELECT *, false FROM err WHERE type = 'TimeoutError' OR type LIKE 'Client%' AND from_fake = false""", "err"))
def q_retry_candidates(spark: SparkSession, sf: str) -> DataFrame:
    e = Views(spark, sf).err
    return (retry_candidates(e, True).withColumn("asked_fake", F.lit(True))
            .unionByName(retry_candidates(e, False).withColumn("asked_fake", F.lit(False))))


# Stored errors carry no id; the retry order is (creation_date, type, source, mark, info), nulls first.
ERR_ORDERED_SQL = """
SELECT *, struct_pack(d := coalesce(creation_date, TIMESTAMP '1900-01-01'), t := type, s := coalesce(source_article, ''),
                      f := from_fake, i := coalesce(additional_info, '')) AS ord FROM err"""
RETRY_SQL = """
SELECT {b} AS batch_id, url, arg_max_null(source_article, ord) AS scraped_from, arg_max_null(from_fake, ord) AS fake
FROM err_o WHERE type = 'TimeoutError' OR type LIKE 'Client%' AND from_fake = {f} GROUP BY url"""


def _err_ordered(v: Views) -> DataFrame:
    return v.err.withColumn("ord", F.struct(
        F.coalesce("creation_date", F.lit("1900-01-01 00:00:00").cast("timestamp_ntz")).alias("d"),
        F.col("type").alias("t"), F.coalesce("source_article", F.lit("")).alias("s"),
        F.col("from_fake").alias("f"), F.coalesce("additional_info", F.lit("")).alias("i")))


def _retry(v: Views) -> DataFrame:
    return lk.union_retry(_err_ordered(v), order_col="ord").select("batch_id", "url", "scraped_from", "fake")


@register("retry_links", o.with_views(RETRY_SQL.format(b="CAST(0 AS BIGINT)", f="true"), "err",
                                      extra=[("err_o", ERR_ORDERED_SQL)]))
def q_retry_links(spark: SparkSession, sf: str) -> DataFrame:
    return lk.retry_links(_err_ordered(Views(spark, sf)), True, "ord").select("batch_id", "url", "scraped_from", "fake")


@register("union_retry", o.with_views(
    RETRY_SQL.format(b="CAST(0 AS BIGINT)", f="true") + "\nUNION ALL\n" + RETRY_SQL.format(b="CAST(1 AS BIGINT)", f="false"),
    "err", extra=[("err_o", ERR_ORDERED_SQL)]))
def q_union_retry(spark: SparkSession, sf: str) -> DataFrame:
    return _retry(Views(spark, sf))


# ---- forum posts ----

AS_OF = dt.datetime(2025, 1, 15)
NUM_POSTS = 20
TOP_SQL = f"""
SELECT sub, post_id, score, created, url, permalink, CAST(rank AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY sub ORDER BY score DESC, post_id) AS rank FROM post
  WHERE created > TIMESTAMP '{(AS_OF - dt.timedelta(days=365)):%Y-%m-%d %H:%M:%S}'
    AND created <= TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}') t
WHERE rank <= {NUM_POSTS}"""
SUBS_SQL = "SELECT DISTINCT sub, length(sub) % 2 = 0 AS fake FROM post"


def _subs(v: Views) -> DataFrame:
    return v.post.select("sub").distinct().select("sub", (F.length("sub") % 2 == 0).alias("fake"))


@register("top_posts", o.with_views(TOP_SQL, "post"))
def q_top_posts(spark: SparkSession, sf: str) -> DataFrame:
    return top_posts(Views(spark, sf).post, NUM_POSTS, AS_OF)


@register("external_posts", o.with_views(
    "SELECT * FROM post WHERE url IS DISTINCT FROM permalink", "post"))
def q_external_posts(spark: SparkSession, sf: str) -> DataFrame:
    return lk.external_posts(Views(spark, sf).post)


@register("posts_per_forum", o.with_views(f"""
SELECT sub AS name, true AS is_over, CAST(count(*) AS BIGINT) AS posts
FROM ({TOP_SQL}) t WHERE url IS DISTINCT FROM permalink GROUP BY sub""", "post"))
def q_posts_per_forum(spark: SparkSession, sf: str) -> DataFrame:
    return lk.posts_per_forum(lk.external_posts(top_posts(Views(spark, sf).post, NUM_POSTS, AS_OF)))


FORUM_LINKS_SQL = f"""
SELECT t.sub AS batch_key, min(t.rank) AS seq, t.url,
       arg_max({o.forum_source_url('t.sub')}, t.rank) AS scraped_from, arg_max(s.fake, t.rank) AS fake
FROM ({TOP_SQL}) t JOIN subs s ON s.sub = t.sub
WHERE t.url IS DISTINCT FROM t.permalink GROUP BY t.sub, t.url"""


@register("forum_links", o.with_views(FORUM_LINKS_SQL, "post", extra=[("subs", SUBS_SQL)]))
def q_forum_links(spark: SparkSession, sf: str) -> DataFrame:
    v = Views(spark, sf)
    links, _ = lk.forum_links(v.post, _subs(v), NUM_POSTS, AS_OF)
    return links


@register("union_collectors", o.with_views(f"""
SELECT 0 AS producer, concat('site:', batch_id) AS batch_key, seq, url, scraped_from, fake FROM merged
UNION ALL
SELECT 1, concat('forum:', batch_key), seq, url, scraped_from, fake FROM ({FORUM_LINKS_SQL}) f""",
    "lnk", "post", extra=[MERGED, ("subs", SUBS_SQL)]))
def q_union_collectors(spark: SparkSession, sf: str) -> DataFrame:
    v = Views(spark, sf)
    site = lk.merge_links(v.lnk).withColumn("batch_key", F.concat(F.lit("site:"), F.col("batch_id").cast("string")))
    forum, _ = lk.forum_links(v.post, _subs(v), NUM_POSTS, AS_OF)
    forum = forum.withColumn("batch_key", F.concat(F.lit("forum:"), F.col("batch_key")))
    return lk.union_collectors(site, forum).select("producer", "batch_key", "seq", "url", "scraped_from", "fake")
