"""Queries for page extraction, articles, errors of extraction and de-dup."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.functions import html as H
from pressloom.functions.text import remove_newlines
from pressloom.functions.urls import link_kind
from pressloom.operators import articles as ar
from pressloom.operators import labels as lb
from pressloom.operators import links as lk
from pressloom.operators.dedup import dedup_title_or_url
from pressloom.plans import oracle as o
from pressloom.plans.q_links import DIM, LABELLED_SQL, MERGED
from pressloom.plans.registry import register
from pressloom.sources.fixtures import Views
from pressloom.sources import tables as T
from pressloom.sources.tables import scan_pages

RUN_TS = dt.datetime(2025, 1, 15, 12, 0, 0)
RUN_TS_SQL = f"TIMESTAMP '{RUN_TS:%Y-%m-%d %H:%M:%S}'"


def _join(col: str) -> str:
    return f"array_to_string({col}, '|')"


# ---- K1-K4 over pages ----

@register("page_title", f"SELECT page_id, {o.page_title('html')} AS title FROM pages")
def q_page_title(spark: SparkSession, sf: str) -> DataFrame:
    return Views(spark, sf).pages.select("page_id", H.page_title("html").alias("title"))


@register("page_text", f"""
SELECT page_id, CAST(length(t) AS BIGINT) AS n_chars, md5(t) AS text_md5
FROM (SELECT page_id, {o.remove_newlines(o.page_text('html'))} AS t FROM pages) p""")
def q_page_text(spark: SparkSession, sf: str) -> DataFrame:
    t = remove_newlines(H.page_text("html"))
    return Views(spark, sf).pages.select("page_id", t.alias("t")).select(
        "page_id", F.length("t").cast("long").alias("n_chars"), F.md5("t").alias("text_md5"))


# K3 and K4 read pages whose tags have known values; the SQL states those values, it doesn't parse
@register("page_meta", """
SELECT page_id, concat('Page ', page_id, ' & more') AS description,
       lower(substring(regexp_extract(html, '<html lang="([^"]*)"', 1), 1, 2)) AS lang, concat('k', page_id, '|b') AS keywords,
       concat('S', page_id) AS section, 'G' AS generator, TIMESTAMP '2020-01-01 10:11:12' + to_days(CAST(page_id % 9 AS INTEGER)) AS publish_date
FROM pages""")
def q_page_meta(spark: SparkSession, sf: str) -> DataFrame:
    from pressloom.functions.text import min_words_or_none
    read = Views(spark, sf).mpage.select("page_id", H.meta_fields("html").alias("m"), H.page_lang("html").alias("lang"))
    return read.select("page_id", min_words_or_none(F.col("m.description"), 1).alias("description"), "lang", F.array_join("m.keywords", "|").alias("keywords"),
                       "m.section", "m.generator", "m.publish_date")


@register("page_media", """
SELECT page_id, concat('a.png|i', page_id, '.png') AS images, concat('v', page_id, '.html') AS videos, concat('A', page_id, '|B') AS authors
FROM pages""")
def q_page_media(spark: SparkSession, sf: str) -> DataFrame:
    h = F.col("html")
    return Views(spark, sf).mpage.select(
        "page_id", F.array_join(H.page_images(h), "|").alias("images"),
        F.array_join(H.page_videos(h), "|").alias("videos"), F.array_join(H.meta_fields(h)["authors"], "|").alias("authors"))


# ---- K5: summary, as SQL over a text table t(k1, k2, text) ----

def summary_sql(src: str, k1: str, k2: str) -> list[tuple[str, str]]:
    """CTEs ending in ``summ(k1, k2, summary)`` for texts in ``src``."""
    sent = f"string_split(regexp_replace(text, {o.lit(ar.SENTENCE_END_RE)}, '\\1' || chr(10), 'g'), chr(10))"
    words = f"list_filter(regexp_split_to_array(lower(s), {o.lit(ar.WORD_SPLIT_RE)}), lambda w: w <> '')"
    return [
        ("sa", f"SELECT {k1}, {k2}, {sent} AS arr FROM {src}"),
        ("se", f"SELECT {k1}, {k2}, unnest(range(0, len(arr))) AS pos, unnest(arr) AS s FROM sa"),
        ("wd", f"SELECT {k1}, {k2}, pos, unnest({words}) AS w FROM se"),
        ("fq", f"SELECT *, count(*) OVER (PARTITION BY {k1}, {k2}, w) AS f FROM wd"),
        ("sc", f"SELECT {k1}, {k2}, pos, (sum(f) * {ar.SCORE_SCALE}) // count(*) AS score FROM fq GROUP BY {k1}, {k2}, pos"),
        ("rk", f"SELECT *, row_number() OVER (PARTITION BY {k1}, {k2} ORDER BY score DESC, pos) AS r FROM sc"),
        ("best", f"SELECT {k1}, {k2}, list_sort(list(pos)) AS best FROM rk WHERE r <= {ar.SUMMARY_SENTENCES} GROUP BY {k1}, {k2}"),
        ("summ", f"""SELECT a.{k1}, a.{k2},
            array_to_string(list_transform(coalesce(b.best, []), lambda p: a.arr[p + 1]), ' ') AS summary
            FROM sa a LEFT JOIN best b ON b.{k1} = a.{k1} AND b.{k2} = a.{k2}"""),
    ]


@register("page_summary", o.with_views(
    f"SELECT page_id, {o.value_or_none(o.remove_newlines('summary'))} AS summary FROM summ",
    extra=[("txt", f"SELECT page_id, 0 AS k0, {o.remove_newlines(o.page_text('html'))} AS text FROM pages")]
    + summary_sql("txt", "page_id", "k0")))
def q_page_summary(spark: SparkSession, sf: str) -> DataFrame:
    from pressloom.functions.text import value_or_none
    txt = Views(spark, sf).pages.select("page_id", remove_newlines(H.page_text("html")).alias("text"))
    return ar.summarize(txt, ["page_id"], "text", "summary").select(
        "page_id", value_or_none(remove_newlines(F.col("summary"))).alias("summary"))


# ---- A4, C7, E8 ----

@register("scan_pages", o.with_views("""
SELECT url, CASE WHEN status <> 200 THEN 'HttpStatusError' WHEN html IS NULL THEN 'TextError' END AS error_type
FROM resp""", "resp"))
def q_scan_pages(spark: SparkSession, sf: str) -> DataFrame:
    ok, failed = scan_pages(Views(spark, sf).resp)
    return (ok.select("url", F.lit(None).cast("string").alias("error_type"))
            .unionByName(failed.select("url", "error_type")))


ARCH_URL, ARCH_ERR = o.archive_original_url("html")


@register("resolve_archive_url", o.with_views(
    f"SELECT url, {ARCH_URL} AS original_url, {ARCH_ERR} AS error_type FROM resp "
    f"WHERE html IS NOT NULL AND {o.link_kind('url')} = 'archive'", "resp"))
def q_archive_url(spark: SparkSession, sf: str) -> DataFrame:
    url, err = H.archive_original_url(F.col("html"))
    return (Views(spark, sf).resp.where(F.col("html").isNotNull() & (link_kind("url") == "archive"))
            .select("url", url.alias("original_url"), err.alias("error_type")))


ADMITTED_SQL = f"SELECT batch_id, seq, url, scraped_from, fake FROM labelled WHERE {o.admission('label', 'fake', 'false')}"
ADMITTED = [DIM, MERGED, ("labelled", LABELLED_SQL), ("admitted", ADMITTED_SQL)]


def _admitted(v: Views) -> DataFrame:
    return lk.prefetch_filter(lk.merge_links(v.lnk), lb.build_label_dim(v.src))


@register("link_pages", o.with_views("""
SELECT l.batch_id, l.seq, l.url, r.url IS NOT NULL AS has_response, r.status, md5(r.html) AS html_md5
FROM admitted l LEFT JOIN resp1 r ON r.url = l.url""", "src", "lnk", "resp1", extra=ADMITTED))
def q_link_pages(spark: SparkSession, sf: str) -> DataFrame:
    v = Views(spark, sf)
    j = ar.link_pages(_admitted(v), v.resp, {"html_md5": F.md5("html")})
    return j.select("batch_id", "seq", "url", F.col("_has_resp").alias("has_response"), "status", "html_md5")


# ---- K6: articles and their errors, as SQL ----

def _err_sql() -> tuple[str, str]:
    web_missing = "(kind = 'web_archive' AND target = '')"
    typ = (f"CASE WHEN {web_missing} THEN 'ArchivedURLNotFound' WHEN NOT has_resp THEN 'TimeoutError' "
           f"WHEN status <> 200 THEN 'HttpStatusError' WHEN html IS NULL THEN 'TextError' "
           f"WHEN kind = 'archive' THEN {ARCH_ERR} END")
    src = "coalesce(scraped_from, 'None')"
    info = (f"CASE WHEN {web_missing} THEN {o.message(T.MSG_ENCODED_NOT_FOUND, url='url')} "
            f"WHEN NOT has_resp THEN {o.message(T.MSG_TIMEOUT, url='url', source=src)} "
            f"WHEN status <> 200 THEN {o.message(T.MSG_HTTP_STATUS, url='url', status='status')} "
            f"WHEN html IS NULL THEN {o.message(T.MSG_TEXT, url='url')} "
            f"WHEN {ARCH_ERR} = 'TypeError' THEN {o.lit(T.MSG_NO_HEADER_INPUT)} "
            f"WHEN {ARCH_ERR} = 'KeyError' THEN {o.lit(T.MSG_NO_VALUE_ATTR)} "
            f"WHEN {ARCH_ERR} = 'ArchivedURLNotFound' THEN {o.message(T.MSG_ARCHIVE_NOT_FOUND, url='url', source=src)} END")
    return typ, info


ERR_TYPE_SQL, ERR_INFO_SQL = _err_sql()
BUILD_CTES = ADMITTED + [
    ("kd", f"""SELECT l.*, {o.link_kind('l.url')} AS kind, {o.web_archive_target('l.url')} AS target,
               r.url IS NOT NULL AS has_resp, r.status, r.html FROM admitted l LEFT JOIN resp1 r ON r.url = l.url"""),
    ("tg", f"SELECT *, {ERR_TYPE_SQL} AS err, {ERR_INFO_SQL} AS info FROM kd"),
    ("okf", f"""SELECT batch_id, seq, url AS visited_url,
               CASE WHEN kind = 'archive' THEN {ARCH_URL} WHEN kind = 'web_archive' THEN target ELSE url END AS actual,
               scraped_from, fake,
               {o.correct_title(o.truncate_title(o.page_title('html')), o.title_tag_text('html'))} AS title,
               {o.remove_newlines(o.page_text('html'))} AS text,
               {o.min_words_or_none(o.meta_description('html'), 1)} AS description,
               {o.page_authors('html')} AS authors, {o.page_images('html')} AS images, {o.page_videos('html')} AS videos,
               {o.page_lang('html')} AS lang, {o.page_keywords('html')} AS keywords, {o.page_section('html')} AS section,
               {o.page_publish_date('html')} AS publish_date, {o.page_generator('html')} AS generator
               FROM tg WHERE err IS NULL"""),
] + summary_sql("okf", "batch_id", "seq") + [
    ("built", f"""SELECT f.batch_id, f.seq, f.title, f.text, f.description, f.actual AS url, f.visited_url, f.scraped_from,
               {o.site_key('f.actual')} AS netloc, {o.maintain_path('f.actual')} AS path,
               f.authors, f.images, f.videos, f.lang, f.keywords, f.section, f.publish_date, f.generator,
               {o.value_or_none(o.remove_newlines('s.summary'))} AS summary, f.fake, {RUN_TS_SQL} AS scraped_date
               FROM okf f JOIN summ s ON s.batch_id = f.batch_id AND s.seq = f.seq"""),
]
BUILT_FLAT = f"""SELECT batch_id, seq, title, text, description, url, visited_url, scraped_from, netloc, path,
    {_join('authors')} AS authors, {_join('images')} AS images, {_join('videos')} AS videos, lang,
    {_join('keywords')} AS keywords, section, publish_date, generator, summary, fake, scraped_date"""
BUILD_ERRORS_SQL = (f"SELECT err AS type, url, scraped_from AS source_article, fake AS from_fake, "
                    f"info AS additional_info, {RUN_TS_SQL} AS creation_date FROM tg WHERE err IS NOT NULL")


def _built(v: Views) -> tuple[DataFrame, DataFrame]:
    return ar.build_articles(_admitted(v), v.resp, RUN_TS)


def _flat(df: DataFrame) -> DataFrame:
    return df.select(*[F.array_join(c, "|").alias(c) if c in ("authors", "images", "videos", "keywords") else c
                       for c in df.columns])


@register("build_articles", o.with_views(BUILT_FLAT + " FROM built", "src", "lnk", "resp1", extra=BUILD_CTES))
def q_build_articles(spark: SparkSession, sf: str) -> DataFrame:
    arts, _ = _built(Views(spark, sf))
    return _flat(arts)


@register("article_record", o.with_views(
    BUILT_FLAT.replace("SELECT batch_id, seq, ", "SELECT ") + " FROM built", "src", "lnk", "resp1", extra=BUILD_CTES))
def q_article_record(spark: SparkSession, sf: str) -> DataFrame:
    arts, _ = _built(Views(spark, sf))
    return _flat(ar.article_record(arts))


@register("error_record", o.with_views(BUILD_ERRORS_SQL, "src", "lnk", "resp1", extra=BUILD_CTES))
def q_error_record(spark: SparkSession, sf: str) -> DataFrame:
    _, errs = _built(Views(spark, sf))
    return ar.error_record(errs)


@register("stamp_scraped_date", o.with_views(
    "SELECT batch_id, seq, url, scraped_date FROM built", "src", "lnk", "resp1", extra=BUILD_CTES))
def q_stamp(spark: SparkSession, sf: str) -> DataFrame:
    arts, _ = _built(Views(spark, sf))
    return ar.stamp_scraped_date(arts, RUN_TS).select("batch_id", "seq", "url", "scraped_date")


# ---- G1, G2: de-dup on the art view; oracle = sequential walk as a recursive CTE ----

def dedup_walk_sql(src: str, title: str = "title", url: str = "url") -> list[tuple[str, str]]:
    hit = "(list_contains(w.titles, a.tk) OR list_contains(w.urls, a.uk))"
    return [
        ("dk", f"""SELECT batch_id, seq, coalesce({o.py_strip(title)}, '') AS tk, coalesce({o.py_strip(url)}, '') AS uk,
                   row_number() OVER (PARTITION BY batch_id ORDER BY seq) AS rn FROM {src}"""),
        ("walk(batch_id, rn, seq, kept, titles, urls)", f"""
            SELECT batch_id, rn, seq, true, [tk], [uk] FROM dk WHERE rn = 1
            UNION ALL
            SELECT a.batch_id, a.rn, a.seq, NOT {hit},
                   CASE WHEN {hit} THEN w.titles ELSE list_append(w.titles, a.tk) END,
                   CASE WHEN {hit} THEN w.urls ELSE list_append(w.urls, a.uk) END
            FROM walk w JOIN dk a ON a.batch_id = w.batch_id AND a.rn = w.rn + 1"""),
        ("kept", "SELECT batch_id, seq FROM walk WHERE kept"),
    ]


@register("dedup_title_or_url", o.with_views(
    "SELECT a.batch_id, a.seq, a.title, a.url FROM art a JOIN kept k ON k.batch_id = a.batch_id AND k.seq = a.seq",
    "art", extra=dedup_walk_sql("art"), recursive=True))
def q_dedup(spark: SparkSession, sf: str) -> DataFrame:
    art = Views(spark, sf).art.select("batch_id", "seq", "title", "url")
    return dedup_title_or_url(art)


@register("dedup_scope_reset", o.with_views(
    "SELECT batch_id, CAST(count(*) AS BIGINT) AS kept FROM kept GROUP BY batch_id",
    "art", extra=dedup_walk_sql("art"), recursive=True))
def q_dedup_scope(spark: SparkSession, sf: str) -> DataFrame:
    art = Views(spark, sf).art.select("batch_id", "seq", "title", "url")
    return dedup_title_or_url(art).groupBy("batch_id").agg(F.count(F.lit(1)).alias("kept"))


@register("archived_recheck", o.with_views(
    f"""SELECT b.batch_id, b.seq, b.url, b.visited_url FROM built b LEFT JOIN dim d ON d.key = {o.site_key('b.url')}
        WHERE b.url = b.visited_url OR {o.admission('d.label', 'b.fake', 'b.url <> b.visited_url')}""",
    "src", "lnk", "resp1", extra=BUILD_CTES))
def q_archived_recheck(spark: SparkSession, sf: str) -> DataFrame:
    v = Views(spark, sf)
    arts, _ = _built(v)
    return ar.archived_recheck(arts, lb.build_label_dim(v.src)).select("batch_id", "seq", "url", "visited_url")
