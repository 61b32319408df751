"""Queries for feed config, state and walking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.operators import feeds as fd
from pressloom.plans import oracle as o
from pressloom.plans.registry import register
from pressloom.sources import config as cf
from pressloom.sources.fixtures import Views

# Selector configuration of the queries over plain pages (ours).
ENTRIES_SEL = "nav a"
LINKS_SEL = "article a"
NEXT_SEL = "li a"
CONDITION = ("li", ["the", "and", "The", "für"])

# the same, written for these pages: navigation and list items don't nest and hrefs are in double quotes
NAV_HREFS_SQL = """flatten(list_transform(regexp_extract_all(html, '(?s)<nav>(.*?)</nav>', 1), lambda r: regexp_extract_all(r, '<a href="([^"]*)">', 1)))"""
ITEM_HREFS_SQL = """flatten(list_transform(regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1), lambda r: regexp_extract_all(r, '<a href="([^"]*)">', 1)))"""
ITEM_TEXTS_SQL = "list_transform(regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1), lambda r: " + \
    o.py_strip("lower(" + o.decode_entities("regexp_replace(r, '<[^>]*>', '', 'g')") + ")") + ")"


# ---- I1, I2, D10 over pages ----

@register("extract_links", f"""
SELECT page_id, CAST(pos AS BIGINT) AS pos, {o.decode_entities('href')} AS href FROM (
  SELECT page_id, unnest(range(0, len(h))) AS pos, unnest(h) AS href
  FROM (SELECT page_id, {NAV_HREFS_SQL} AS h FROM pages) a) b""")
def q_extract_links(spark: SparkSession, sf: str) -> DataFrame:
    p = Views(spark, sf).pages
    return p.select("page_id", F.posexplode(fd.hrefs(F.col("html"), ENTRIES_SEL)).alias("pos", "href")) \
            .withColumn("pos", F.col("pos").cast("long"))


@register("next_page_link", f"SELECT page_id, {o.decode_entities('(' + ITEM_HREFS_SQL + ')[1]')} AS next_url FROM pages")
def q_next_page_link(spark: SparkSession, sf: str) -> DataFrame:
    return Views(spark, sf).pages.select("page_id", fd.first_href(F.col("html"), NEXT_SEL).alias("next_url"))


@register("feed_condition", f"SELECT page_id, list_has_any({ITEM_TEXTS_SQL}, {CONDITION[1]!r}) AS satisfied FROM pages")
def q_feed_condition(spark: SparkSession, sf: str) -> DataFrame:
    return Views(spark, sf).pages.select(
        "page_id", fd.condition_holds(F.col("html"), *CONDITION).alias("satisfied"))


# ---- I3, H2, I6, F4: walking the feeds over the edge view ----

def walk_sql(feeds: str, name: str = "walk") -> list[tuple[str, str]]:
    return [(f"{name}(name, round, page_url, remaining, next_url, is_over)", f"""
        SELECT f.name, CAST(0 AS BIGINT), e.page_url, f.stop_after, e.next_url, e.next_url IS NULL OR f.stop_after = 0
        FROM {feeds} f JOIN edge e ON e.page_url = f.url
        UNION ALL
        SELECT w.name, w.round + 1, e.page_url, w.remaining - 1, e.next_url, e.next_url IS NULL OR w.remaining - 1 = 0
        FROM {name} w JOIN edge e ON e.page_url = w.next_url WHERE NOT w.is_over""")]


def _walk(v: Views, feeds: DataFrame | None = None) -> DataFrame:
    return fd.walk_feed(feeds if feeds is not None else v.feed, v.edge.select("page_url", "next_url"))


@register("walk_feed", o.with_views("SELECT * FROM walk", "feed", extra=walk_sql("feed"), recursive=True))
def q_walk_feed(spark: SparkSession, sf: str) -> DataFrame:
    return _walk(Views(spark, sf))


@register("pagination_limit", o.with_views(
    "SELECT name, CAST(count(*) AS BIGINT) AS pages FROM walk GROUP BY name", "feed", extra=walk_sql("feed"),
    recursive=True))
def q_pagination_limit(spark: SparkSession, sf: str) -> DataFrame:
    return fd.pages_per_feed(_walk(Views(spark, sf)))


@register("feed_state", o.with_views(
    "SELECT name, round, is_over, page_url AS url, remaining AS page FROM walk", "feed", extra=walk_sql("feed"),
    recursive=True))
def q_feed_state(spark: SparkSession, sf: str) -> DataFrame:
    s = fd.feed_state(_walk(Views(spark, sf)))
    return s.select("name", "round", "is_over", "data.url", "data.page")


LATEST_SQL = "SELECT name, arg_max(is_over, round) AS is_over, arg_max(page_url, round) AS url, arg_max(remaining, round) AS page FROM walk GROUP BY name"


@register("latest_state", o.with_views(LATEST_SQL, "feed", extra=walk_sql("feed"), recursive=True))
def q_latest_state(spark: SparkSession, sf: str) -> DataFrame:
    s = fd.latest_state(fd.feed_state(_walk(Views(spark, sf))))
    return s.select("name", "is_over", "data.url", "data.page")


# ---- E7, D12, A2, A3, C4, B3 ----

RESUMED_SQL = """
SELECT f.name, coalesce(s.url, f.url) AS url, coalesce(s.page, f.stop_after) AS stop_after, f.fake_news
FROM feed f LEFT JOIN state s ON s.name = f.name WHERE NOT coalesce(s.is_over, false)"""


def _state_df(v: Views) -> DataFrame:
    s = v.state
    return s.select("name", "is_over", F.struct(F.col("url"), F.col("page").cast("long").alias("page"),
                                                F.lit(None).cast("long").alias("posts")).alias("data"))


def _resumed(v: Views) -> DataFrame:
    return cf.resume_feeds(v.feed, _state_df(v))


@register("resume_feeds", o.with_views(RESUMED_SQL, "feed", "state"))
def q_resume_feeds(spark: SparkSession, sf: str) -> DataFrame:
    return _resumed(Views(spark, sf)).select("name", "url", "stop_after", "fake_news")


@register("resume_filter", o.with_views(
    "SELECT f.* FROM feed f WHERE f.name NOT IN (SELECT name FROM state WHERE is_over)", "feed", "state"))
def q_resume_filter(spark: SparkSession, sf: str) -> DataFrame:
    v = Views(spark, sf)
    return cf.resume_filter(v.feed, _state_df(v))


@register("read_feed_config", o.with_views(f"""
SELECT name, url, '{NEXT_SEL}' AS nextp, '{ENTRIES_SEL}' AS entries, '{LINKS_SEL}' AS links, stop_after, fake_news,
       CASE WHEN fake_news THEN '{CONDITION[0]}' END AS value_container,
       CASE WHEN fake_news THEN '{"|".join(CONDITION[1])}' END AS cond_values
FROM feed""", "feed"))
def q_read_feed_config(spark: SparkSession, sf: str) -> DataFrame:
    """Feed objects written as JSON lines by Spark from the feed view, then read back with the config schema."""
    f = Views(spark, sf).feed
    cond = F.when(F.col("fake_news"), F.struct(F.lit(CONDITION[0]).alias("value_container"),
                                               F.array(*[F.lit(x) for x in CONDITION[1]]).alias("values")))
    doc = F.to_json(F.struct(F.lit("site").alias("type"), "name", "url",
                             F.struct(F.lit(NEXT_SEL).alias("nextp"), F.lit(ENTRIES_SEL).alias("entries"),
                                      F.lit(LINKS_SEL).alias("links")).alias("sel"),
                             "stop_after", "fake_news", cond.alias("condition")))
    parsed = cf.require_feeds(cf.parse_feed_lines(f.select(doc.alias("value"))))
    return parsed.select("name", "url", "sel.nextp", "sel.entries", "sel.links", "stop_after", "fake_news",
                         F.col("condition.value_container").alias("value_container"),
                         F.array_join("condition.values", "|").alias("cond_values"))


@register("read_state", o.with_views(
    "SELECT name, is_over, url, page, CAST(NULL AS BIGINT) AS posts FROM state", "state"))
def q_read_state(spark: SparkSession, sf: str) -> DataFrame:
    docs = cf.state_to_json(_state_df(Views(spark, sf)))
    return cf.parse_state(docs).select("name", "is_over", "data.url", "data.page", "data.posts")


@register("state_record", o.with_views(
    "SELECT name, is_over, url, page, CAST(NULL AS BIGINT) AS posts FROM (" + LATEST_SQL + ") l",
    "feed", extra=walk_sql("feed"), recursive=True))
def q_state_record(spark: SparkSession, sf: str) -> DataFrame:
    s = fd.latest_state(fd.feed_state(_walk(Views(spark, sf))))
    packed = s.select(cf.pack_state(F.col("name"), F.col("is_over"), F.col("data.url"), F.col("data.page")).alias("st"))
    return packed.select("st.name", "st.is_over", "st.data.url", "st.data.page", "st.data.posts")


@register("upsert_state", o.with_views(f"""
SELECT name, is_over, url, page FROM state WHERE name NOT IN (SELECT name FROM ({LATEST_SQL}) n)
UNION ALL
SELECT name, is_over, url, page FROM ({LATEST_SQL}) n""", "feed", "state",
    extra=[("resumed", RESUMED_SQL)] + walk_sql("resumed"), recursive=True))
def q_upsert_state(spark: SparkSession, sf: str) -> DataFrame:
    v = Views(spark, sf)
    new = fd.latest_state(fd.feed_state(_walk(v, _resumed(v))))
    return cf.upsert_state(_state_df(v), new).select("name", "is_over", "data.url", "data.page")


# ---- I2, I4, I5 over feeds with their own selectors: the SQL states what the pages were made of, it doesn't parse ----

def _site(v: Views) -> tuple[DataFrame, DataFrame]:
    """(walk, entries) of the configured feeds; next links are read from the pages."""
    walk = fd.walk_feed(v.conf, fd.next_pages(v.conf, v.site))
    return walk, fd.feed_entries(walk, v.site, v.conf, resolve=True)


ENTRIES_SQL = """
SELECT w.name, w.round, 0 AS entry_pos, s.e1 AS entry_url FROM walk w JOIN site s ON s.url = w.page_url
UNION ALL
SELECT w.name, w.round, 1, s.e2 FROM walk w JOIN site s ON s.url = w.page_url JOIN conf f ON f.name = w.name WHERE f.fake_news"""

#: every 13th page is lost
LOST = "page_id % 13 = 4"


@register("feed_page_errors", o.with_views(f"""
SELECT 'TimeoutError' AS type, e.entry_url AS url, CAST(NULL AS VARCHAR) AS source_article, f.fake_news AS from_fake,
       concat('entry page not fetched: ', e.entry_url) AS additional_info, e.round AS batch_id
FROM ent e JOIN conf f ON f.name = e.name WHERE e.entry_url IN (SELECT url FROM pages WHERE {LOST})""",
    "conf", "site", extra=walk_sql("conf") + [("ent", ENTRIES_SQL)], recursive=True))
def q_feed_page_errors(spark: SparkSession, sf: str) -> DataFrame:
    v = Views(spark, sf)
    _, entries = _site(v)
    _, errors = fd.feed_links(entries, v.site.where(f"NOT {LOST}"), v.conf)
    return errors


FEED_LINKS_SQL = """
SELECT round AS batch_id, arg_min(name, pos) AS feed, min(position) AS position, arg_min(entry_pos, pos) AS entry_pos, CAST(0 AS BIGINT) AS link_pos, url,
       arg_max(entry_url, pos) AS scraped_from, arg_max(fake_news, pos) AS fake
FROM (SELECT e.round, f.name, f.position, f.fake_news, CAST(e.entry_pos AS BIGINT) AS entry_pos, e.entry_url,
             f.position * 10 + e.entry_pos AS pos, CASE WHEN f.fake_news THEN s.l1 ELSE s.l2 END AS url
      FROM ent e JOIN conf f ON f.name = e.name JOIN site s ON s.url = e.entry_url
      WHERE NOT f.fake_news OR s.mark IN ('m0', 'm1')) t
GROUP BY round, url"""


@register("feed_links", o.with_views(FEED_LINKS_SQL, "conf", "site", extra=walk_sql("conf") + [("ent", ENTRIES_SQL)], recursive=True))
def q_feed_links(spark: SparkSession, sf: str) -> DataFrame:
    v = Views(spark, sf)
    _, entries = _site(v)
    links, _ = fd.feed_links(entries, v.site, v.conf)
    return links
