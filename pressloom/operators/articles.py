"""Pages -> article records.

``build_articles`` turns admitted links plus fetched responses into two
frames, articles (19 columns, §1.3 order) and errors (6 columns). Pages that a link
asks for are parsed once, where they are read, and only the values made of them leave that
place; the text crosses the one shuffle that the summary needs.
"""

from __future__ import annotations

import datetime as dt
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pressloom.functions import html as H
from pressloom.functions.text import (correct_title, min_words_or_none, remove_newlines, truncate_title,
                                      value_or_none)
from pressloom.operators.common import only_known_urls, staged
from pressloom.functions.urls import (KIND_ARCHIVE, KIND_WEB_ARCHIVE, link_kind, maintain_path, site_key,
                                      web_archive_target)
from pressloom.schemas import ARTICLE_COLUMNS, ERROR_COLUMNS
from pressloom.sources.tables import (ARCHIVED_URL_NOT_FOUND, HTTP_STATUS_ERROR, MSG_ARCHIVE_NOT_FOUND,
                                      MSG_ENCODED_NOT_FOUND, MSG_HTTP_STATUS, MSG_NO_HEADER_INPUT, MSG_NO_VALUE_ATTR,
                                      MSG_TEXT, MSG_TIMEOUT, TEXT_ERROR, TIMEOUT_ERROR, message, ntz_literal)

# Fixed values of the extractive summary.
SUMMARY_SENTENCES = 5
SCORE_SCALE = 1_000_000
SENTENCE_END_RE = "([.!?])[ \t]+"
WORD_SPLIT_RE = r"[^\p{L}\p{N}]+"


def sentences(text: Column) -> Column:
    """Sentences of a one-line text: split after ``. ! ?`` followed by blanks."""
    return F.split(F.regexp_replace(text, SENTENCE_END_RE, "$1\n"), "\n", -1)


def words(sentence: Column) -> Column:
    """Words = maximal runs of letters and digits of the lower-cased sentence (one split per sentence)."""
    return F.filter(F.split(F.lower(sentence), WORD_SPLIT_RE, -1), lambda w: w != "")


def summarize(df: DataFrame, keys: Sequence[str], text_col: str, out: str = "summary",
              n: int = SUMMARY_SENTENCES) -> DataFrame:
    """K5: extractive summary added as column ``out``.

    Word frequencies are counted per text; a sentence scores
    ``sum(freq of its words) * 1e6 div n_words``; the ``n`` best (ties: earlier
    first) are joined in text order with one space. Texts without words get ''.

    One shuffle: rows are hash-partitioned by ``keys`` once; every later window,
    aggregate and the final join are keyed by ``keys`` (plus more columns) and
    reuse that partitioning, and only sentence positions travel, never text.
    Pass only the columns the caller needs (ideally keys and text): every
    column of ``df`` travels through that one shuffle.
    """
    keys = list(keys)
    has_keys = F.lit(True)
    for k in keys:
        has_keys = has_keys & F.col(k).isNotNull()
    # keys are known non-null below the shuffle, so the join adds no filter to one copy of ``base``
    # and both uses share the exchange; rows without a key cannot be grouped and get ''
    base = df.where(has_keys).repartition(*keys)
    # *_outer generators: no filter is inferred below the exchange, so both uses of
    # ``base`` share one shuffle (ReusedExchange) and the text is computed once
    sents = base.select(*keys, F.posexplode_outer(sentences(F.col(text_col))).alias("_pos", "_s"))
    ws = sents.select(*keys, "_pos", F.explode_outer(words(F.col("_s"))).alias("_w")).where(F.col("_w").isNotNull())
    freq = ws.withColumn("_f", F.count(F.lit(1)).over(Window.partitionBy(*keys, "_w")))
    scored = freq.groupBy(*keys, "_pos").agg(F.sum("_f").alias("_tot"), F.count(F.lit(1)).alias("_nw"))
    scored = scored.withColumn("_score", F.expr(f"(_tot * {SCORE_SCALE}) div _nw"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_score").desc(), F.col("_pos")))
    best = (scored.withColumn("_r", rank).where(F.col("_r") <= n)
            .groupBy(*keys).agg(F.array_sort(F.collect_list("_pos")).alias("_best")))
    joined = base.join(best, keys, "left")
    all_s = sentences(F.col(text_col))
    summary = F.array_join(F.transform(F.coalesce(F.col("_best"), F.array().cast("array<int>")),
                                       lambda p: F.try_element_at(all_s, p + 1)), " ")
    keyless = df.where(~has_keys).withColumn(out, F.lit(""))
    return joined.withColumn(out, summary).drop("_best").unionByName(keyless)


def error_rows(df: DataFrame, type_col: Column, info_col: Column, url: Column, source: Column, fake: Column,
               run_ts: dt.datetime, keep: Sequence[str] = ()) -> DataFrame:
    """Error record ``(type, url, source_article, from_fake, additional_info, creation_date)``
    (plus the ``keep`` columns, e.g. the batch key)."""
    return df.select(type_col.alias("type"), url.alias("url"), source.alias("source_article"),
                     fake.alias("from_fake"), info_col.alias("additional_info"),
                     ntz_literal(run_ts).alias("creation_date"), *keep)


def read_responses(urls: DataFrame, responses: DataFrame, fields: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """The responses of some urls (column ``url``): ``(pages, chosen)``.

    ``fields`` are made of ``url``, ``status`` and ``html`` where the pages are read, and only they
    are kept: html never moves, whatever the number of urls. ``pages``: ``_row`` (unique), ``status`` (200 where the table
    has none), ``_has_html`` and the fields, of all fetches of these urls and of a few other pages. ``chosen(_curl, _crow)``: the one
    response of each url, the newest if the table has ``fetched``; of equally new ones a usable one, and of
    these the one of the greatest hash of its html.
    """
    status = F.col("status") if "status" in responses.columns else F.lit(200)
    fetched = F.col("fetched") if "fetched" in responses.columns else F.lit(0)
    r = responses.select(F.col("url"), status.alias("status"), F.col("html"), fetched.alias("_fetched"))
    order = F.struct("_fetched", (F.col("status") == 200).alias("_ok"), F.col("html").isNotNull().alias("_some"), F.md5("html").alias("_hash"))
    read = only_known_urls(r.where(F.col("url").isNotNull()), "url", urls, "url")
    pages = staged(read.select(F.monotonically_increasing_id().alias("_row"), F.col("url").alias("_purl"), order.alias("_order"), "status",
                               F.col("html").isNotNull().alias("_has_html"), *(c.alias(n) for n, c in fields.items())), "parsed")
    chosen = pages.groupBy(F.col("_purl").alias("_curl")).agg(F.max_by("_row", "_order").alias("_crow"))  # equal fetches: any of them
    return pages.drop("_purl", "_order"), chosen


def link_pages(links: DataFrame, responses: DataFrame, fields: Mapping[str, Column]) -> DataFrame:
    """Each link with its one response: ``_has_resp`` (false: none came back), ``status`` and ``fields`` of the page.

    The fields are made where the pages are read (see ``read_responses``); a page that was fetched several times doesn't
    multiply its links.
    """
    lk = staged(links, "links")
    pages, chosen = read_responses(lk, responses, fields)
    linked = lk.join(chosen, F.col("url") == F.col("_curl"), "left").withColumn("_has_resp", F.col("_crow").isNotNull())
    return linked.join(pages, F.col("_crow") == F.col("_row"), "left").drop("_curl", "_crow", "_row", "_has_html")


def page_fields(kind: Column, html: Column) -> dict[str, Column]:
    """Every value of an article that is made of its page (``kind``: of the link)."""
    archive_url, archive_error = H.archive_original_url(F.when(kind == KIND_ARCHIVE, html))  # the header is looked for in archive pages only
    metas = H.meta_fields(html)
    return {
        "_original": F.when(kind == KIND_ARCHIVE, archive_url), "_header_error": F.when(kind == KIND_ARCHIVE, archive_error),
        "title": correct_title(truncate_title(H.page_title(html)), H.title_tag_text(html)),
        "text": remove_newlines(H.page_text(html)), "images": H.page_images(html), "videos": H.page_videos(html), "lang": H.page_lang(html), "_metas": metas}


def build_articles(links: DataFrame, responses: DataFrame, run_ts: dt.datetime,
                   key_cols: Sequence[str] = ("batch_id", "seq")) -> tuple[DataFrame, DataFrame]:
    """K6: admitted links + responses -> ``(articles, errors)``.

    ``links(batch_id, seq, url, scraped_from, fake)``; ``responses(url, [status, fetched,] html)``.
    Each link goes to the extractor of its kind (C6): web-archive links need an
    encoded url in their path before anything is read; archive pages give the
    original url from their header (C7); the others keep the visited url.
    Failures become error rows with the kind of failure as ``type``.

    Pages are parsed and summarised once each, where they are read; links meet them by row
    number. Texts cross one shuffle, which the summary needs; html crosses none.
    """
    u, src, fake = F.col("url"), F.col("scraped_from"), F.col("fake")
    keys = list(key_cols)
    kinded = links.withColumn("_kind", link_kind(u)).withColumn("_target", web_archive_target(u))
    lk = staged(kinded, "links")
    usable = F.when(F.col("status") == 200, F.col("html"))
    pages, chosen = read_responses(lk, responses, page_fields(link_kind(u), usable))
    # which links have an error takes narrow columns only
    narrow = lk.join(chosen, u == F.col("_curl"), "left").join(
        pages.select(F.col("_row").alias("_prow"), "status", "_has_html", "_header_error"), F.col("_crow") == F.col("_prow"), "left")
    has_resp, web_missing = F.col("_crow").isNotNull(), (F.col("_kind") == KIND_WEB_ARCHIVE) & (F.col("_target") == "")
    header = F.col("_header_error")
    err_type = (F.when(web_missing, F.lit(ARCHIVED_URL_NOT_FOUND))
                .when(~has_resp, F.lit(TIMEOUT_ERROR))
                .when(F.col("status") != 200, F.lit(HTTP_STATUS_ERROR))
                .when(~F.col("_has_html"), F.lit(TEXT_ERROR))
                .when(F.col("_kind") == KIND_ARCHIVE, header))
    source = F.coalesce(src, F.lit("None"))
    err_info = (F.when(web_missing, message(MSG_ENCODED_NOT_FOUND, url=u))
                .when(~has_resp, message(MSG_TIMEOUT, url=u, source=source))
                .when(F.col("status") != 200, message(MSG_HTTP_STATUS, url=u, status=F.col("status")))
                .when(~F.col("_has_html"), message(MSG_TEXT, url=u))
                .when(header == "TypeError", F.lit(MSG_NO_HEADER_INPUT))
                .when(header == "KeyError", F.lit(MSG_NO_VALUE_ATTR))
                .when(header == ARCHIVED_URL_NOT_FOUND, message(MSG_ARCHIVE_NOT_FOUND, url=u, source=source)))
    tagged = staged(narrow.select(*keys, u.alias("visited_url"), src.alias("scraped_from"), fake.alias("fake"), "_kind", "_target", "_crow",
                                  err_type.alias("_err"), err_info.alias("_info")), "linked")
    errors = error_rows(tagged.where(F.col("_err").isNotNull()), F.col("_err"), F.col("_info"), F.col("visited_url"), src, fake, run_ts, keep=keys)

    # the fields of usable pages go along through the one shuffle that the summary needs, which is by the row that links join on
    fields = pages.where(F.col("_has_html") & (F.col("status") == 200) & F.col("_header_error").isNull()).drop("status", "_has_html", "_header_error")
    summed = summarize(fields, ["_row"], "text", "_summary")
    joined = tagged.where(F.col("_err").isNull()).join(summed, F.col("_crow") == F.col("_row"))
    actual = (F.when(F.col("_kind") == KIND_ARCHIVE, F.col("_original"))
              .when(F.col("_kind") == KIND_WEB_ARCHIVE, F.col("_target")).otherwise(F.col("visited_url")))
    m = F.col("_metas")
    articles = joined.withColumn("url", actual).select(
        *keys, "title", "text", min_words_or_none(m["description"], 1).alias("description"), "url", "visited_url", "scraped_from",
        site_key(u).alias("netloc"), maintain_path(u).alias("path"), m["authors"].alias("authors"), "images", "videos", "lang",
        m["keywords"].alias("keywords"), m["section"].alias("section"), m["publish_date"].alias("publish_date"), m["generator"].alias("generator"),
        value_or_none(remove_newlines(F.col("_summary"))).alias("summary"), "fake", ntz_literal(run_ts).alias("scraped_date"))
    return articles, errors


def article_record(articles: DataFrame) -> DataFrame:
    """The stored columns, in the declared order."""
    return articles.select(*ARTICLE_COLUMNS)


def error_record(errors: DataFrame) -> DataFrame:
    return errors.select(*ERROR_COLUMNS)


def stamp_scraped_date(articles: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """``scraped_date`` set to the run's timestamp (one value per run, deterministic)."""
    return articles.withColumn("scraped_date", ntz_literal(run_ts))


def archived_recheck(articles: DataFrame, dim: DataFrame) -> DataFrame:
    """D3: archived articles (actual url != visited url) must pass admission again on the actual url."""
    from pressloom.operators.labels import admission, label_lookup

    lab = label_lookup(articles, dim, "url", "_label")
    archived = F.col("url") != F.col("visited_url")
    return lab.where(~archived | admission(F.col("_label"), F.col("fake"), archived)).drop("_label")

