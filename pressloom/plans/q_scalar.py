"""Queries for the scalar functions (L1-L10, C5, C6, C8, C10) over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom import functions as fx
from pressloom.plans import oracle as o
from pressloom.plans.registry import register
from pressloom.sources.fixtures import Views

# ---- url variants: pages urls with leading blanks, user info, params, no scheme, upper case ----

URLV_SQL = """
SELECT page_id,
       CASE page_id % 8 WHEN 0 THEN url
                        WHEN 1 THEN concat('  ', url, ' ')
                        WHEN 2 THEN concat(url, ';jsessionid=1')
                        WHEN 3 THEN regexp_replace(url, '://', '://user:pw@')
                        WHEN 4 THEN regexp_replace(url, '^https?:', '')
                        WHEN 5 THEN concat('httpbin.org/r?u=', url)
                        WHEN 6 THEN concat('http://www.', regexp_replace(url, '^https?://', ''), '/')
                        ELSE upper(url) END AS url
FROM pages"""


def url_variants(v: Views) -> DataFrame:
    p, u = F.col("page_id"), F.col("url")
    url = (F.when(p % 8 == 0, u)
           .when(p % 8 == 1, F.concat(F.lit("  "), u, F.lit(" ")))
           .when(p % 8 == 2, F.concat(u, F.lit(";jsessionid=1")))
           .when(p % 8 == 3, F.regexp_replace(u, "://", "://user:pw@"))
           .when(p % 8 == 4, F.regexp_replace(u, "^https?:", ""))
           .when(p % 8 == 5, F.concat(F.lit("httpbin.org/r?u="), u))
           .when(p % 8 == 6, F.concat(F.lit("http://www."), F.regexp_replace(u, "^https?://", ""), F.lit("/")))
           .otherwise(F.upper(u)))
    return v.pages.select("page_id", url.alias("url"))


@register("remove_prefix", o.with_views(f"SELECT page_id, url, {o.remove_prefix('url')} AS prefix_removed FROM urlv",
                                        extra=[("urlv", URLV_SQL)]))
def q_remove_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return url_variants(Views(spark, sf)).select("page_id", "url", fx.remove_prefix("url").alias("prefix_removed"))


@register("maintain_netloc", o.with_views(f"SELECT page_id, url, {o.maintain_netloc('url')} AS netloc FROM urlv",
                                          extra=[("urlv", URLV_SQL)]))
def q_netloc(spark: SparkSession, sf: str) -> DataFrame:
    return url_variants(Views(spark, sf)).select("page_id", "url", fx.maintain_netloc("url").alias("netloc"))


@register("maintain_path", o.with_views(f"SELECT page_id, url, {o.maintain_path('url')} AS path FROM urlv",
                                        extra=[("urlv", URLV_SQL)]))
def q_path(spark: SparkSession, sf: str) -> DataFrame:
    return url_variants(Views(spark, sf)).select("page_id", "url", fx.maintain_path("url").alias("path"))


@register("strip", o.with_views(
    f"SELECT page_id AS seq, url, {o.site_key('url')} AS site_key FROM urlv "
    f"UNION ALL SELECT seq, url, {o.site_key('url')} FROM lnk", "lnk", extra=[("urlv", URLV_SQL)]))
def q_site_key(spark: SparkSession, sf: str) -> DataFrame:
    v = Views(spark, sf)
    a = url_variants(v).select(F.col("page_id").alias("seq"), "url")
    b = v.lnk.select("seq", "url")
    return a.unionByName(b).select("seq", "url", fx.site_key("url").alias("site_key"))


@register("link_kind", o.with_views(f"SELECT batch_id, seq, url, {o.link_kind('url')} AS kind FROM lnk", "lnk"))
def q_link_kind(spark: SparkSession, sf: str) -> DataFrame:
    return Views(spark, sf).lnk.select("batch_id", "seq", "url", fx.link_kind("url").alias("kind"))


@register("resolve_web_archive_url", o.with_views(
    f"SELECT seq, url, {o.web_archive_target('url')} AS target, {o.web_archive_target('url')} <> '' AS found "
    f"FROM lnk WHERE {o.link_kind('url')} = 'web_archive'", "lnk"))
def q_web_archive(spark: SparkSession, sf: str) -> DataFrame:
    t = fx.web_archive_target("url")
    return (Views(spark, sf).lnk.where(fx.link_kind("url") == "web_archive")
            .select("seq", "url", t.alias("target"), (t != "").alias("found")))


@register("archived_flag", o.with_views("SELECT seq, url, visited_url, url <> visited_url AS archived FROM art", "art"))
def q_archived(spark: SparkSession, sf: str) -> DataFrame:
    return Views(spark, sf).art.select("seq", "url", "visited_url", fx.archived_flag("url", "visited_url").alias("archived"))


@register("forum_source_url", o.with_views(
    f"SELECT sub, {o.forum_source_url('sub')} AS scraped_from FROM (SELECT DISTINCT sub FROM post) s", "post"))
def q_forum_url(spark: SparkSession, sf: str) -> DataFrame:
    return Views(spark, sf).post.select("sub").distinct().select("sub", fx.forum_source_url("sub").alias("scraped_from"))


# ---- text functions over documents and conversations (whole texts) ----

@register("check_strings", f"""
SELECT doc_id, CAST(len(a) AS BIGINT) AS n_lines, md5(array_to_string(a, '|')) AS lines_md5
FROM (SELECT doc_id, {o.check_strings("string_split(text, chr(10))")} AS a FROM documents) t""")
def q_check_strings(spark: SparkSession, sf: str) -> DataFrame:
    a = fx.check_strings(F.split(F.col("text"), "\n", -1))
    return (Views(spark, sf).table("documents").select("doc_id", a.alias("a"))
            .select("doc_id", F.size("a").cast("long").alias("n_lines"), F.md5(F.array_join("a", "|")).alias("lines_md5")))


@register("value_or_none", f"SELECT conv_id, turn, {o.value_or_none('text')} AS value FROM conversations")
def q_value_or_none(spark: SparkSession, sf: str) -> DataFrame:
    return Views(spark, sf).table("conversations").select("conv_id", "turn", fx.value_or_none("text").alias("value"))


@register("remove_newlines", f"""
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, md5(t) AS text_md5
FROM (SELECT doc_id, {o.remove_newlines('text')} AS t FROM documents) d""")
def q_remove_newlines(spark: SparkSession, sf: str) -> DataFrame:
    t = fx.remove_newlines("text")
    return (Views(spark, sf).table("documents").select("doc_id", t.alias("t"))
            .select("doc_id", F.length("t").cast("long").alias("n_chars"), F.md5("t").alias("text_md5")))


@register("min_words_or_none", f"""
SELECT conv_id, turn, {o.min_words_or_none('text', 1)} AS min1, md5({o.min_words_or_none('text', 12)}) AS min12_md5,
       {o.min_words_or_none("''", 1)} AS empty1
FROM conversations""")
def q_min_words(spark: SparkSession, sf: str) -> DataFrame:
    return Views(spark, sf).table("conversations").select(
        "conv_id", "turn", fx.min_words_or_none("text", 1).alias("min1"),
        F.md5(fx.min_words_or_none("text", 12)).alias("min12_md5"),
        fx.min_words_or_none(F.lit(""), 1).alias("empty1"))


@register("truncate_title", f"""
SELECT doc_id, CAST(length({o.truncate_title('text')}) AS BIGINT) AS n_chars, md5({o.truncate_title('text')}) AS title_md5
FROM documents""")
def q_truncate(spark: SparkSession, sf: str) -> DataFrame:
    t = fx.truncate_title("text")
    return Views(spark, sf).table("documents").select(
        "doc_id", F.length(t).cast("long").alias("n_chars"), F.md5(t).alias("title_md5"))


# ---- L6: cut titles with the <title> text carrying separators ----

TITLES_SQL = """
SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS raw FROM pages"""
TITLES_CASE_SQL = """
SELECT page_id,
       CASE WHEN page_id % 3 = 0 THEN raw ELSE concat(substring(raw, 1, 12), '…') END AS title,
       CASE page_id % 5 WHEN 0 THEN concat(raw, ' - Site A')
                        WHEN 1 THEN concat(raw, ' | Site B - x')
                        WHEN 2 THEN concat(raw, ' – Site C | y')
                        WHEN 3 THEN raw
                        ELSE concat('  ', raw, ' - a - b ') END AS tag_text
FROM titles0"""


def cut_titles(v: Views) -> DataFrame:
    p = F.col("page_id")
    raw = v.pages.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("raw"))
    r = F.col("raw")
    title = F.when(p % 3 == 0, r).otherwise(F.concat(F.substring(r, 1, 12), F.lit("…")))
    tag = (F.when(p % 5 == 0, F.concat(r, F.lit(" - Site A")))
           .when(p % 5 == 1, F.concat(r, F.lit(" | Site B - x")))
           .when(p % 5 == 2, F.concat(r, F.lit(" – Site C | y")))
           .when(p % 5 == 3, r)
           .otherwise(F.concat(F.lit("  "), r, F.lit(" - a - b "))))
    return raw.select("page_id", title.alias("title"), tag.alias("tag_text"))


@register("correct_title", o.with_views(
    f"SELECT page_id, title, {o.correct_title('title', 'tag_text')} AS corrected FROM titles",
    extra=[("titles0", TITLES_SQL), ("titles", TITLES_CASE_SQL)]))
def q_correct_title(spark: SparkSession, sf: str) -> DataFrame:
    return cut_titles(Views(spark, sf)).select(
        "page_id", "title", fx.correct_title("title", "tag_text").alias("corrected"))
