"""Derived input views over the driver's tables (FIXTURES.md §3), as DataFrame plans.

The same views exist as SQL text in ``pressloom.plans.oracle`` for DuckDB; both
use the same integer arithmetic so that they give equal rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.operators.common import cut_lineage, global_row_number, number_within_groups
from pressloom.sources.tables import read_table

HOST_RE = r"^https?://([^/?#]*)"


def _host(c: str = "url"):
    return F.regexp_extract(F.col(c), HOST_RE, 1)


def _s(c) -> F.Column:
    return c.cast("string")


def events_with_page(events: DataFrame, pages: DataFrame) -> DataFrame:
    """Events joined with the page whose id is ``event_id`` modulo the number of pages (works on a stream too)."""
    urls = pages.select("page_id", F.col("url").alias("p_url"))
    n = urls.count()
    e = events.withColumn("_pk", F.col("event_id") % F.lit(max(n, 1)))
    return e.join(urls, e["_pk"] == urls["page_id"]).drop("_pk", "page_id")


def err_rows(ewp: DataFrame) -> DataFrame:
    """The err view's projection of events joined with pages."""
    e = F.col("event_id")
    typ = (F.when(e % 5 == 0, "TimeoutError").when(e % 5 == 1, "ClientConnectorError")
           .when(e % 5 == 2, "HttpStatusError").when(e % 5 == 3, "ClientPayloadError").otherwise("clienterror"))
    url = F.when(e % 17 == 0, F.concat(F.lit("http://gone.example.org/"), _s(e % 51))).otherwise(F.col("p_url"))
    src = F.when(e % 19 == 0, F.lit(None).cast("string")) \
           .otherwise(F.concat(F.lit("https://feed"), _s(e % 3), F.lit(".example.com/")))
    created = F.when(e % 23 == 0, F.lit(None).cast("timestamp_ntz")) \
               .otherwise(F.date_trunc("day", F.col("ts")).cast("timestamp_ntz"))
    return (ewp.where(F.col("event_type") == "error")
            .select(typ.alias("type"), url.alias("url"), src.alias("source_article"),
                    (e % 3 == 0).alias("from_fake"), F.col("props").alias("additional_info"),
                    created.alias("creation_date")))


def _counter() -> F.Column:
    """Counter of a feed by its first page: every fifth feed has none and runs to the end of its chain."""
    p = F.col("page_id")
    return F.when(p % 5 == 0, F.lit(-1)).otherwise(p % 4)


# Markup of the site view (ours): which other pages a page links to (id * factor + add, modulo the number of pages), and
# the selectors (next, entries, links) and the condition of feeds of fake news, then the selectors of the others.
SITE_LINKS = {"e1": (7, 3), "e2": (11, 5), "l1": (3, 1), "l2": (5, 2)}
SITE_SELECTORS = [("a.next", ".posts a", "article.post > a"), ("#nav a", "h2 > a", "#main a")]
SITE_CONDITION = (".try", ["m0", "m1", "M2"])


class Views:
    """Lazily built views over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def pages(self) -> DataFrame:
        return self.table("pages")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    # view: src -- credibility table; source_id is the tie-break of equal keys
    @cached_property
    def src(self) -> DataFrame:
        hosts = self.pages.select(F.regexp_replace(_host(), r"^www[.]", "").alias("h")).distinct()
        numbered = global_row_number(hosts, ["h"], out="rn")
        rn = F.col("rn")
        label = (F.when(rn % 9 == 0, "very high").when(rn % 9 == 1, "high").when(rn % 9 == 2, "mixed")
                 .when(rn % 9 == 3, "low").when(rn % 9 == 4, "very low").when(rn % 9 == 5, "satire")
                 .when(rn % 9 == 6, "insane stuff").when(rn % 9 == 7, "unrated").otherwise("High"))
        url = (F.when(rn % 7 == 0, F.concat(F.lit("http://"), F.col("h"), F.lit("/news")))
               .when(rn % 5 == 0, F.concat(F.lit("https://www."), F.col("h"), F.lit("/")))
               .otherwise(F.col("h")))
        # a small dimension read by several steps (size check, label build): materialise it once
        return cut_lineage(numbered.select(rn.alias("source_id"), label.alias("factual_reporting"), url.alias("url")))

    # view: lnk -- link batches with repeats, archive and web-archive links
    @cached_property
    def lnk(self) -> DataFrame:
        p = F.col("page_id")
        url = (F.when(p % 7 == 0, F.concat(F.lit("https://web.archive.org/web/2018/"), F.col("url")))
               .when(p % 7 == 1, F.concat(F.lit("http://archive.is/"), _s(p)))
               .when(p % 7 == 2, F.concat(F.lit("https://www.archive.is/"), _s(p)))
               .when(p % 7 == 3, F.concat(F.lit("/relative/"), _s(p)))
               .otherwise(F.col("url")))
        first = self.pages.select(
            (p % 4).alias("batch_id"), p.alias("seq"), url.alias("url"),
            F.concat(F.lit("https://feed"), _s(p % 3), F.lit(".example.com/")).alias("scraped_from"),
            (p % 5 < 3).alias("fake"))
        repeats = self.pages.where((p % 11 == 0) | (p % 11 == 5)).select(
            (p % 4).alias("batch_id"), (p + 1000000).alias("seq"), F.col("url"),
            F.lit("https://feed9.example.com/").alias("scraped_from"), (p % 5 >= 3).alias("fake"))
        return first.unionByName(repeats)

    # view: art -- articles with title and url collisions inside a batch
    @cached_property
    def art(self) -> DataFrame:
        p = F.col("page_id")
        title = F.when(p % 6 == 0, F.concat(F.lit(" title "), _s(p % 37), F.lit(" "))) \
                 .otherwise(F.regexp_extract(F.col("html"), r"<title>([^<]*)</title>", 1))
        url = F.when(p % 5 == 0, F.concat(F.lit("http://dup.example.org/p/"), _s(p % 35))).otherwise(F.col("url"))
        return self.pages.select((p % 4).alias("batch_id"), p.alias("seq"), title.alias("title"),
                                 url.alias("url"), F.col("url").alias("visited_url"),
                                 F.col("html").alias("text"), (p % 3 == 0).alias("fake"))

    def _events_with_page(self, events: DataFrame | None = None) -> DataFrame:
        return events_with_page(events if events is not None else self.events, self.pages)

    # view: err -- stored errors; creation_date has ties and nulls
    @cached_property
    def err(self) -> DataFrame:
        return err_rows(self._events_with_page())

    # view: post -- forum posts
    @cached_property
    def post(self) -> DataFrame:
        e = F.col("event_id")
        permalink = F.when(e % 13 == 0, F.col("p_url")) \
                     .otherwise(F.concat(F.lit("/r/"), F.col("event_type"), F.lit("/"), _s(e)))
        return self._events_with_page().select(
            F.col("event_type").alias("sub"), e.alias("post_id"), ((e * 7919) % 10007).alias("score"),
            F.col("ts").alias("created"), F.col("p_url").alias("url"), permalink.alias("permalink"))

    # view: edge -- page -> next page inside a host; the first page of a host is its feed url
    @cached_property
    def edge(self) -> DataFrame:
        base = self.pages.select(_host().alias("feed"), "page_id", F.col("url").alias("page_url"))
        out = number_within_groups(base, ["feed"], ["page_id"], rn="rn", next_cols=["page_url"])
        # feed, state and every walk round read it: materialise it once (narrow columns)
        return cut_lineage(out.select("feed", "page_id", "page_url", F.col("next_page_url").alias("next_url"), "rn"))

    # view: feed -- one feed per host
    @cached_property
    def feed(self) -> DataFrame:
        p = F.col("page_id")
        return self.edge.where(F.col("rn") == 1).select(
            F.col("feed").alias("name"), F.col("page_url").alias("url"), _counter().alias("stop_after"),
            (p % 2 == 0).alias("fake_news"))

    # view: state -- some collectors over, some resumed at their second page
    @cached_property
    def state(self) -> DataFrame:
        p = F.col("page_id")
        return self.edge.where((F.col("rn") == 2) & (p % 4 < 3)).select(
            F.col("feed").alias("name"), (p % 3 == 0).alias("is_over"), F.col("page_url").alias("url"),
            (p % 5 - 1).alias("page"))

    # view: resp -- responses for the links of lnk: bad status, null body, archive header; some urls are fetched again later
    # with another page (fetched = 2), some are there twice
    @cached_property
    def resp(self) -> DataFrame:
        p, u, k = F.col("page_id"), F.col("url"), F.col("k")
        url = (F.when(p % 7 == 0, F.concat(F.lit("https://web.archive.org/web/2018/"), u))
               .when(p % 7 == 1, F.concat(F.lit("http://archive.is/"), _s(p)))
               .when(p % 7 == 2, F.concat(F.lit("https://www.archive.is/"), _s(p))).otherwise(u))
        fetches = F.concat(F.array(F.lit(1)), F.when(p % 6 == 2, F.array(F.lit(2))).otherwise(F.array().cast("array<int>")),
                           F.when(p % 10 == 4, F.array(F.lit(3))).otherwise(F.array().cast("array<int>")))
        rows = self.pages.where((p % 7 != 3) & (p % 29 != 0)).select("page_id", "url", "html", F.explode(fetches).alias("k"))
        h = F.when(k == 2, F.replace(F.col("html"), F.lit("</article>"), F.lit("<p>Fetched again.</article>"))).otherwise(F.col("html"))
        status = F.when((p % 13 == 0) & (k != 2), F.lit(404)).otherwise(F.lit(200))
        empty_hdr = F.lit('<div id="HEADER"><table><tr><td><input value=""></td></tr></table></div>')
        html = (F.when(p % 17 == 0, F.lit(None).cast("string"))
                .when((p % 7 == 1) & (p % 9 == 0), F.concat(empty_hdr, h))
                .when(p % 7 == 1, F.concat(F.lit('<div id="HEADER"><p>saved</p><table><tr><td><input type="text" value="'), u,
                                           F.lit('"></td></tr></table></div>'), h))
                .otherwise(h))
        return rows.select(url.alias("url"), status.alias("status"), F.when(k == 2, F.lit(2)).otherwise(F.lit(1)).alias("fetched"), html.alias("html"))

    # view: site -- the pages as a feed shows them: next link, entries, article links and a mark, in nested markup
    @cached_property
    def site(self) -> DataFrame:
        n = self.pages.count()
        p = F.col("page_id")

        base = self.pages.join(self.edge.select(F.col("page_id").alias("_e"), "next_url"), p == F.col("_e"), "left")
        for name, (factor, add) in SITE_LINKS.items():
            other = self.pages.select(F.col("page_id").alias(f"_{name}"), F.col("url").alias(name))
            base = base.join(other, (F.col("page_id") * factor + add) % F.lit(max(n, 1)) == F.col(f"_{name}"))
        nxt = F.when(F.col("next_url").isNotNull(), F.concat(F.lit("<a href='"), F.col("next_url"), F.lit("'>n</a></div><a class='x next' href=\""),
                                                              F.col("next_url"), F.lit("\">n</a>"))).otherwise(F.lit("</div>"))
        html = F.concat(
            F.lit("<div id='nav'><div>x</div>"), nxt,
            F.lit('<section class="posts"><section><a href="'), F.col("e1"), F.lit('">e</a></section><a href='), F.col("e2"), F.lit(">e</a></section><h2><a href='"),
            F.col("e1"), F.lit('\'>e</a><b><a href="/no">deep</a></b></h2><article class="post"><a href="'), F.col("l1"),
            F.lit('">l</a><p><a href="/deep">d</a></p></article><div id="main"><div></div><a href="'), F.col("l2"),
            F.lit('">l</a></div><p class="try"><b> M'), _s(p % 3), F.lit("</b></p>"), F.col("html"))
        return base.select("page_id", "url", "next_url", *SITE_LINKS, html.alias("html"))

    # view: conf -- the feeds with selectors and condition; feeds of fake news have other ones than the rest
    @cached_property
    def conf(self) -> DataFrame:
        p = F.col("page_id")
        fake = p % 2 == 0
        pick = lambda i: F.when(fake, F.lit(SITE_SELECTORS[0][i])).otherwise(F.lit(SITE_SELECTORS[1][i]))
        return self.edge.where(F.col("rn") == 1).select(
            F.col("feed").alias("name"), F.col("page_url").alias("url"),
            F.struct(pick(0).alias("nextp"), pick(1).alias("entries"), pick(2).alias("links")).alias("sel"),
            _counter().alias("stop_after"), fake.alias("fake_news"),
            F.when(fake, F.struct(F.lit(SITE_CONDITION[0]).alias("value_container"), F.array(*map(F.lit, SITE_CONDITION[1])).alias("values"))).alias("condition"),
            p.alias("position"))

    # view: mpage -- the pages with meta tags, images, videos and authors of known values, in both quotes and orders
    @cached_property
    def mpage(self) -> DataFrame:
        p = _s(F.col("page_id"))
        head = F.concat(F.lit("<META content=' Page "), p, F.lit(" &amp; more ' name='Description'><meta name=keywords content=\"k"), p,
                        F.lit(", ,b \"><meta property='article:section' content=\"S"), p, F.lit("\"><meta content='G ' name=\"generator\">"),
                        F.lit("<meta property=\"article:published_time\" content='2020-01-0"), _s(F.col("page_id") % 9 + 1),
                        F.lit("T10:11:12Z'><meta name='author' content='A"), p, F.lit("'><meta name=\"author\" content=\"B\"><meta name='author' content='B'></head>"))
        media = F.concat(F.lit("<img alt='x' src='i"), p, F.lit(".png'><img src=\"a.png\"><img src=a.png><iframe src='v"), p, F.lit(".html'></iframe></article>"))
        with_head = F.replace(F.col("html"), F.lit("</head>"), head)
        return self.pages.select("page_id", F.replace(with_head, F.lit("</article>"), media).alias("html"))
