"""Feed walking and link extraction.

Every feed has its own selectors (``sel``: nextp, entries, links) and condition.
Selectors are data: a page is parsed once, is asked only for the selectors that can match
something on it, and is joined with its feed by url and selector; html isn't moved.
Selectors: see ``functions.selectors``. Of a page that was fetched several times with
different html the least result counts.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.functions.selectors import anchor_hrefs, element_rows, element_texts, hrefs, matches, selector_rows, texts
from pressloom.functions.text import py_strip
from pressloom.operators.common import only_known_urls, staged, staging_path

ORIGIN_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"
NO_PAGE = "feed page not fetched: "
NO_ENTRY = "entry page not fetched: "


def first_href(html: Column, selector: str) -> Column:
    """Href of the first matched anchor, else null."""
    return F.try_element_at(hrefs(html, selector), F.lit(1))


def resolve_href(href: Column, page_url: Column) -> Column:
    """Optional: make a root-relative href absolute against the page's origin (off by default, T12)."""
    origin = F.regexp_extract(page_url, ORIGIN_RE, 1)
    return F.when(href.startswith("/") & ~href.startswith("//") & (origin != ""), F.concat(origin, href)).otherwise(href)


def condition_holds(html: Column, container: str | None, values: Column | Iterable[str] | None) -> Column:
    """Some element under ``container`` has text that, lowered and stripped, is in ``values``.

    ``values`` are compared as configured (not lowered), so upper-case values never match.
    No condition -> always true.
    """
    if not container:
        return F.lit(True)
    vals = values if isinstance(values, Column) else F.array(*[F.lit(v) for v in (values or [])]).cast("array<string>")
    return F.exists(F.transform(texts(html, container), lambda t: py_strip(F.lower(t))), lambda t: F.array_contains(vals, t))


def selectors_of(feeds: DataFrame, field: str) -> list[str]:
    """The distinct selectors of the feeds, a part of the configuration file."""
    return sorted(r[0] for r in feeds.select(field).distinct().collect() if r[0] is not None)


def next_pages(feeds: DataFrame, pages: DataFrame) -> DataFrame:
    """I2 for all feeds: ``(selector, page_url, next_url)``.

    A row per page without selector and next link says that the page was fetched; a
    row per page and next selector gives its next link where there is one. A page is
    parsed once and only asked for the selectors whose class, id or tag it holds, so
    neither rows nor time grow with pages times selectors. Pages of other sites give rows that
    no walk asks for. Root-relative links are made absolute.
    """
    found = matches(F.col("html"), selector_rows(selectors_of(feeds, "sel.nextp")), "string",
                    lambda _, tags, s: F.try_element_at(anchor_hrefs(tags, s), F.lit(1)))
    mark = F.array(F.struct(F.lit(None).cast("string").alias("s"), F.lit(None).cast("string").alias("h")))
    rows = pages.select(F.col("url").alias("page_url"), F.explode(F.concat(mark, F.filter(found, lambda x: x.h.isNotNull()))).alias("x"))
    return rows.select(F.col("x.s").alias("selector"), "page_url", resolve_href(F.col("x.h"), F.col("page_url")).alias("next_url"))


def walk_feed(feeds: DataFrame, edges: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """I3 + H2 + I6: the pages that each feed reads by following next-page links.

    ``feeds(name, url, stop_after[, sel])``; ``edges([selector,] page_url, next_url)`` = the
    fetched feed pages and their next link, if any (with ``selector`` a feed follows the links
    of its own next selector; of several rows of a page the least link counts). Round ``r`` reads
    one page of every live feed and gives ``(name, round, page_url, remaining, next_url, is_over)``;
    ``remaining`` is the counter of the page just read. A feed stops when there is no
    next link or its counter is 0; a page may be read again meanwhile. A negative counter
    never reaches 0: such feeds run to the end of the chain, and stop before a page that they
    have read. A page that was not fetched isn't read: the feed ends without state
    for it (see ``missing_feed_pages``).

    Walks double: with the first ``2**k`` rounds of a feed and the links that lead ``2**k`` pages on, one
    join gives the next ``2**k`` rounds. So a chain of n pages takes about log2(n) steps, and feeds that have
    ended, or read a page again without a counter, drop out.
    """
    spark = feeds.sparkSession
    own = "selector" in edges.columns
    key = F.coalesce("selector", F.lit("")) if own else F.lit("")
    fetched = staged(edges.select(F.col("page_url").alias("_f")).where("_f is not null").distinct(), "walk-fetched")
    nexts = edges.where("next_url is not null").groupBy(key.alias("_s"), F.col("page_url").alias("_u")).agg(F.min("next_url").alias("next_url"))
    nexts = staged(nexts.join(fetched, F.col("next_url") == F.col("_f"), "left").withColumnRenamed("_f", "_to"), "walk-next")
    jump = nexts.where("_to is not null").select("_s", "_u", "_to")  # leads 2**k pages on
    first = feeds.select("name", (F.coalesce("sel.nextp", F.lit("")) if own else F.lit("")).alias("selector"), F.col("url").alias("page_url"),
                         F.col("stop_after").cast("long").alias("stop_after"), F.lit(0).cast("long").alias("round")
                         ).join(fetched.withColumnRenamed("_f", "page_url"), "page_url", "left_semi")
    path, schema = staging_path(spark, "walk-rows"), first.schema
    first.write.parquet(f"{path}/k=0")
    most = F.lit(max_rounds) if max_rounds is not None else F.lit(None).cast("long")
    length, k = 1, 0
    while max_rounds is None or length < max_rounds:
        rows = spark.read.schema(schema).parquet(*[f"{path}/k={i}" for i in range(k + 1)])
        on = rows.join(jump, (F.col("selector") == F.col("_s")) & (F.col("page_url") == F.col("_u")))  # of ended feeds nothing leads so far
        if length > 1:  # feeds without a counter that have read a page again
            again = rows.where("stop_after < 0").groupBy("name", "page_url").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("name")
            on = on.join(again, "name", "left_anti")
        on = on.select("name", "selector", F.col("_to").alias("page_url"), "stop_after", (F.col("round") + length).alias("round"))
        in_reach = ((F.col("stop_after") < 0) | (F.col("round") <= F.col("stop_after"))) & F.coalesce(F.col("round") < most, F.lit(True))
        k, length = k + 1, 2 * length
        on.select(*schema.names).where(in_reach).write.parquet(f"{path}/k={k}")
        if spark.read.schema(schema).parquet(f"{path}/k={k}").where(F.col("round") == length - 1).limit(1).count() == 0:
            break  # no feed has read all the rounds so far
        twice = jump.select(F.col("_s").alias("_t"), F.col("_u").alias("_v"), F.col("_to").alias("_w"))
        jump = staged(jump.join(twice, (F.col("_s") == F.col("_t")) & (F.col("_to") == F.col("_v"))).select("_s", "_u", F.col("_w").alias("_to")), "walk-jumps")
    rows = spark.read.schema(schema).parquet(*[f"{path}/k={i}" for i in range(k + 1)])
    endless = rows.where("stop_after < 0").groupBy("name", "selector", "page_url", "stop_after").agg(F.min("round").alias("round"))
    read = rows.where("stop_after >= 0").unionByName(endless).join(nexts, (F.col("selector") == F.col("_s")) & (F.col("page_url") == F.col("_u")), "left")
    remaining = F.col("stop_after") - F.col("round")
    return staged(read.select("name", "round", "page_url", remaining.alias("remaining"), "next_url",
                              (F.col("next_url").isNull() | (remaining == 0)).alias("is_over")), "walk")


def pages_per_feed(walk: DataFrame) -> DataFrame:
    """H2: pages read per feed (at most ``stop_after + 1``)."""
    return walk.groupBy("name").agg(F.count(F.lit(1)).alias("pages"))


def feed_state(walk: DataFrame) -> DataFrame:
    """State after each round: the page just read and its counter; over when no next page."""
    return walk.select("name", "round", "is_over", F.struct(
        F.col("page_url").alias("url"), F.col("remaining").alias("page"),
        F.lit(None).cast("long").alias("posts")).alias("data"))


def latest_state(states: DataFrame, order_col: str = "round") -> DataFrame:
    """the last state per collector name."""
    return states.groupBy("name").agg(F.max_by(F.struct("is_over", "data"), order_col).alias("_s")) \
                 .select("name", "_s.is_over", "_s.data")


def feed_entries(walk: DataFrame, pages: DataFrame, feeds: DataFrame, resolve: bool = False) -> DataFrame:
    """Entry urls of each feed page read by the walk (I4 first step), with positions.

    Hrefs are cut out of the html where the pages are read, of the pages that the walk has read (and a few others);
    only the hrefs are joined with the walk.
    """
    read = staged(walk.join(feeds.select(F.col("name").alias("_n"), F.col("sel.entries").alias("_selector")), F.col("name") == F.col("_n"))
                  .select("name", "round", "page_url", "_selector"), "feed-pages")
    matched = only_known_urls(pages.select(F.col("url").alias("_u"), "html"), "_u", read, "page_url")
    found = matched.select("_u", F.explode(matches(F.col("html"), selector_rows(selectors_of(feeds, "sel.entries")), "array<string>",
                                                   lambda _, tags, s: anchor_hrefs(tags, s))).alias("x"))
    found = found.groupBy("_u", F.col("x.s").alias("_s")).agg(F.min("x.h").alias("_h"))
    ent = read.join(found, (F.col("page_url") == F.col("_u")) & (F.col("_selector") == F.col("_s")))
    ent = ent.select("name", "round", "page_url", F.posexplode("_h").alias("entry_pos", "entry_url")) \
             .withColumn("entry_pos", F.col("entry_pos").cast("long"))
    if resolve:
        ent = ent.withColumn("entry_url", resolve_href(F.col("entry_url"), F.col("page_url")))
    return ent.where(F.col("entry_url").isNotNull())


def _of_feed(feeds: DataFrame) -> DataFrame:
    position = F.col("position") if "position" in feeds.columns else F.dense_rank().over(Window.orderBy("name"))
    return feeds.select(F.col("name").alias("_n"), position.cast("long").alias("position"), F.col("fake_news").alias("fake"), F.col("sel.links").alias("_links"),
                        F.col("condition.value_container").alias("_container"), F.col("condition.values").alias("_values"))


def feed_links(entries: DataFrame, pages: DataFrame, feeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """I4 + I5: entry pages -> article links tagged ``(entry_url, fake_news)``; missing entry pages -> errors.

    Each feed's own link selector and condition apply. Link rows: ``(batch_id = round,
    feed, position, entry_pos, link_pos, url, scraped_from, fake)``; duplicates collapse
    per batch in the order of the configuration (F1, first position, last value). Entry
    pages that were not fetched give error rows ``(type, url, source_article=null, from_fake)``.
    Hrefs and element texts are cut out of the html where the pages are read, of the
    entries' pages (and a few others); only they are joined with the entries.
    """
    of_feed = staged(_of_feed(feeds), "feed-links-conf")
    e = staged(entries.join(of_feed, F.col("name") == F.col("_n")).drop("_n"), "feed-entries")
    matched = only_known_urls(pages.select("url", "html"), "url", e, "entry_url")
    html = F.col("html")
    found = matches(html, selector_rows(selectors_of(of_feed, "_links")), "array<string>", lambda _, tags, s: anchor_hrefs(tags, s))
    said = matches(html, element_rows(selectors_of(of_feed, "_container")), "array<string>",
                   lambda pieces, tags, s: F.transform(element_texts(pieces, tags, s.container), lambda t: py_strip(F.lower(t))))
    cut = matched.select(F.col("url").alias("_u"), found.alias("_found"), said.alias("_said"))
    cut = cut.groupBy("_u").agg(F.min(F.struct("_found", "_said")).alias("_c")).select("_u", "_c._found", "_c._said")
    joined = e.join(cut, F.col("entry_url") == F.col("_u"))
    own = F.get(F.filter("_found", lambda x: x.s == F.col("_links")), F.lit(0)).h
    texts_of = F.get(F.filter("_said", lambda x: x.s == F.col("_container")), F.lit(0)).h
    holds = F.col("_container").isNull() | F.arrays_overlap(texts_of, F.coalesce(F.col("_values"), F.array().cast("array<string>")))
    links = joined.where(F.coalesce(holds, F.lit(False)) & own.isNotNull()).select(
        "round", "name", "position", "entry_pos", "entry_url", "fake", F.posexplode(own).alias("link_pos", "url")) \
        .where(F.col("url").isNotNull()).withColumn("link_pos", F.col("link_pos").cast("long"))
    pos = F.struct("position", "entry_pos", "link_pos", "name")
    merged = (links.groupBy(F.col("round").alias("batch_id"), "url")
              .agg(F.min(pos).alias("_p"), F.max_by(F.struct(F.col("entry_url").alias("scraped_from"), "fake"), pos).alias("_v"))
              .select("batch_id", F.col("_p.name").alias("feed"), F.col("_p.position").alias("position"), F.col("_p.entry_pos").alias("entry_pos"),
                      F.col("_p.link_pos").alias("link_pos"), "url", "_v.scraped_from", "_v.fake"))
    missing = e.join(pages.select(F.col("url").alias("_u")), F.col("entry_url") == F.col("_u"), "left_anti")
    return merged, page_errors(missing, F.col("entry_url"), NO_ENTRY).withColumn("batch_id", F.col("_round")).drop("_round")


def page_errors(rows: DataFrame, url: Column, message: str) -> DataFrame:
    """Error rows of pages that were not fetched; ``rows`` has fake and round."""
    return rows.select(F.lit("TimeoutError").alias("type"), url.alias("url"), F.lit(None).cast("string").alias("source_article"),
                       F.col("fake").alias("from_fake"), F.concat(F.lit(message), url).alias("additional_info"), F.col("round").alias("_round"))


def missing_feed_pages(feeds: DataFrame, edges: DataFrame, walk: DataFrame) -> DataFrame:
    """Feed pages that the walk asked for and that were not fetched, first pages and later ones, as error rows.

    The reference only prints these; ``collect_job`` stores them on demand.
    """
    mark = feeds.select(F.col("name").alias("_n"), F.col("fake_news").alias("fake"))
    asked = feeds.select("name", F.col("url").alias("_asked")).unionByName(
        walk.where(~F.col("is_over")).select("name", F.col("next_url").alias("_asked"))).distinct()
    lost = asked.join(edges.select(F.col("page_url").alias("_p")), F.col("_asked") == F.col("_p"), "left_anti")
    rows = lost.join(mark, F.col("name") == F.col("_n")).withColumn("round", F.lit(0).cast("long"))
    return page_errors(rows, F.col("_asked"), NO_PAGE).drop("_round")
