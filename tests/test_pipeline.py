"""Feeds, config and state, article building, sinks and the streaming batch body."""

import datetime as dt
import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from pressloom.functions import html as H
from pressloom.functions import selectors as sl
from pressloom.operators import articles as ar
from pressloom.operators import feeds as fd
from pressloom.plans import jobs
from pressloom.schemas import ARTICLE_SCHEMA, ERROR_SCHEMA, LINK_SCHEMA, STATE_SCHEMA
from pressloom.sinks import store
from pressloom.sources import config as cf
from pressloom.streaming.stream import StreamContext, process_batch, save_progress

RUN = dt.datetime(2025, 1, 15, 12, 0, 0)

CONFIG = {
    "backup": "state.json",
    "sources": [
        {"type": "site", "name": "snf", "url": "https://snf.example.org/", "stop_after": 100, "fake_news": True,
         "sel": {"nextp": "a.next", "entries": "h2 > a", "links": "article a"}},
        {"type": "site", "name": "tof", "url": "https://tof.example.org/", "stop_after": 5, "fake_news": True,
         "sel": {"nextp": "a.next", "entries": "h2 > a", "links": "article a"},
         "condition": {"value_container": ".try", "values": ["megafake"]}}],
    "rules": {"blacklist": {"titles": ["Page not found"], "urls": ["https://a.example.org/x"]},
              "min_length": {"title": 10, "text": 200, "path_loc": 8}},
    "reddit": {"subs": {"click": True, "view": False}, "num_posts": 20, "credentials": {}},
}
STATE = {"snf": {"is_over": False, "data": {"url": "https://fndet.com/arch/fake/page/8/", "page": 93}},
         "old": {"is_over": True, "data": {"url": "https://o.example.org/", "page": 0}},
         "click": {"is_over": True, "data": {"posts": 20}}}


def _write(path, obj, bom=False):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as f:
        json.dump(obj, f)
    return path


def test_config_sources_backup_and_over(spark, tmp_dir):
    conf = cf.read_config(spark, _write(os.path.join(tmp_dir, "conf.json"), CONFIG, bom=True))
    feeds = cf.require_feeds(cf.feeds_from_config(conf))
    assert sorted(r.name for r in feeds.collect()) == ["snf", "tof"]
    state = cf.read_state(spark, _write(os.path.join(tmp_dir, "state.json"), STATE))
    resumed = {r.name: (r.url, r.stop_after) for r in cf.resume_feeds(feeds, state).collect()}
    assert resumed["snf"] == ("https://fndet.com/arch/fake/page/8/", 93)
    assert resumed["tof"] == ("https://tof.example.org/", 5)
    over = dict(STATE, snf={"is_over": True, "data": {"url": "x", "page": 1}})
    state2 = cf.read_state(spark, _write(os.path.join(tmp_dir, "over.json"), over))
    assert [r.name for r in cf.resume_filter(feeds, state2).collect()] == ["tof"]
    assert cf.read_state(spark, os.path.join(tmp_dir, "missing.json")).count() == 0
    cond = {r.name: r.condition for r in feeds.collect()}
    assert cond["tof"].value_container == ".try" and cond["snf"] is None


def test_feed_condition_case(spark):
    html = '<div><span class="try">megafAke</span><span class="try">megafA</span></div>'
    df = spark.createDataFrame([(html,), ('<span class="try">megafA</span>',)], "html string")
    got = [r.o for r in df.select(fd.condition_holds(F.col("html"), ".try", ["megafake"]).alias("o")).collect()]
    assert got == [True, False]
    # configured values are not lowered: an upper-case value never matches
    got2 = df.select(fd.condition_holds(F.col("html"), ".try", ["megafAke"]).alias("o")).first().o
    assert got2 is False


def test_selectors_and_hrefs(spark):
    html = ('<h2><a href="/e1">1</a></h2><h2 class="x"><a>no href</a><a href="/e2">2</a></h2>'
            '<a class="next" href="/p2">next</a><article><a href="http://s.org/a">a</a><a href="http://s.org/a">dup</a></article>')
    df = spark.createDataFrame([(html,)], "html string")
    r = df.select(fd.hrefs(F.col("html"), "h2 > a").alias("e"), fd.first_href(F.col("html"), "a.next").alias("n"),
                  fd.hrefs(F.col("html"), "article a").alias("l")).first()
    assert r.e == ["/e1", None, "/e2"] and r.n == "/p2" and r.l == ["http://s.org/a", "http://s.org/a"]


def _site(spark):
    pages = [
        ("https://f.org/", '<h2><a href="/e1">e</a></h2><h2><a href="/e2">e</a></h2><a class="next" href="https://f.org/2">n</a>'),
        ("https://f.org/2", '<h2><a href="/e3">e</a></h2>'),
        ("https://f.org/e1", '<div class="try">MegaFake </div><article><a href="http://n.org/a">a</a><a href="http://n.org/b">b</a></article>'),
        ("https://f.org/e2", '<div class="try">other</div><article><a href="http://n.org/c">c</a></article>'),
    ]
    return spark.createDataFrame(pages, "url string, html string")


FEEDS = "name string, url string, stop_after long, fake_news boolean, sel struct<nextp:string,entries:string,links:string>, " \
        "condition struct<value_container:string,values:array<string>>, position long"
SEL = ("a.next", "h2 > a", "article a")


def test_walk_feed_links_and_errors(spark):
    pages = _site(spark)
    feeds = spark.createDataFrame([("f", "https://f.org/", 5, True, SEL, (".try", ["megafake"]), 0), ("g", "https://g.org/", -1, False, SEL, None, 1)], FEEDS)
    edges = fd.next_pages(feeds, pages)
    walk = fd.walk_feed(feeds, edges)
    rows = sorted((r.name, r.round, r.page_url, r.remaining, r.is_over) for r in walk.collect())
    assert rows == [("f", 0, "https://f.org/", 5, False), ("f", 1, "https://f.org/2", 4, True)]
    assert [(r.url, r.from_fake) for r in fd.missing_feed_pages(feeds, edges, walk).collect()] == [("https://g.org/", False)]
    latest = {r.name: (r.is_over, r.data.url, r.data.page) for r in fd.latest_state(fd.feed_state(walk)).collect()}
    assert latest == {"f": (True, "https://f.org/2", 4)}
    entries = fd.feed_entries(walk, pages, feeds, resolve=True)
    links, errors = fd.feed_links(entries, pages, feeds)
    got = sorted((r.batch_id, r.url, r.scraped_from, r.fake) for r in links.collect())
    assert got == [(0, "http://n.org/a", "https://f.org/e1", True), (0, "http://n.org/b", "https://f.org/e1", True)]
    assert [r.url for r in errors.collect()] == ["https://f.org/e3"]


def test_feeds_with_selectors_and_conditions_of_their_own(spark):
    page = ("<div id='x'><div>in</div><a href='/two'>n</a></div><a class=next href=/three>m</a><ul class='l m'><li><a href=\"/e1\">1</a></li></ul>"
            "<h2><a href='/e2?a=1&amp;b=2'>2</a></h2>")
    entry = '<p class="try"><b> MegaFake</b></p><div id="main"><div>x</div><a href="http://n.org/1">1</a></div><article><a href=\'http://n.org/2\'>2</a></article>'
    site = spark.createDataFrame([("http://s.org/", page), ("http://s.org/two", page), ("http://s.org/three", page), ("http://s.org/e1", entry), ("http://s.org/e2?a=1&b=2", entry)],
                                 "url string, html string")
    feeds = spark.createDataFrame([
        ("a", "http://s.org/", 1, True, ("#x a", ".m a", "article > a"), (".try", ["megafake"]), 2),
        ("b", "http://s.org/", 0, False, ("a.next", "h2 > a", "#main a"), None, 1),
        ("c", "http://s.org/", 0, False, ("a.next", "h2 > a", "#main a"), (".try", ["MegaFake"]), 0),
        ("d", "http://s.org/", 3, False, (None, None, None), None, 3)], FEEDS)
    edges = fd.next_pages(feeds, site)
    walk = fd.walk_feed(feeds, edges)
    assert sorted((r.name, r.page_url) for r in walk.collect()) == [
        ("a", "http://s.org/"), ("a", "http://s.org/two"), ("b", "http://s.org/"), ("c", "http://s.org/"), ("d", "http://s.org/")]
    entries = fd.feed_entries(walk, site, feeds, resolve=True)
    assert sorted((r.name, r.entry_url) for r in entries.collect()) == [
        ("a", "http://s.org/e1"), ("a", "http://s.org/e1"), ("b", "http://s.org/e2?a=1&b=2"), ("c", "http://s.org/e2?a=1&b=2")]
    links, errors = fd.feed_links(entries, site, feeds)
    assert sorted((r.batch_id, r.feed, r.url) for r in links.collect()) == [(0, "a", "http://n.org/2"), (0, "b", "http://n.org/1"), (1, "a", "http://n.org/2")]
    assert errors.count() == 0


def test_feeds_give_links_in_the_order_of_the_configuration(spark):
    site = spark.createDataFrame([("http://s.org/", "<h2><a href='/e'>e</a></h2>"), ("http://s.org/e", "<article><a href='http://n.org/1'>1</a></article>")], "url string, html string")
    feeds = spark.createDataFrame([("z", "http://s.org/", 0, True, SEL, None, 0), ("a", "http://s.org/", 0, False, SEL, None, 1)], FEEDS)
    walk = fd.walk_feed(feeds, fd.next_pages(feeds, site))
    links, _ = fd.feed_links(fd.feed_entries(walk, site, feeds, resolve=True), site, feeds)
    r = links.collect()
    assert [(x.feed, x.fake) for x in r] == [("z", False)]  # first position, last value


def test_walk_stop_after_zero_and_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a")], "page_url string, next_url string")
    feeds = spark.createDataFrame([("z", "a", 0), ("n", "a", -1), ("p", "a", 5)], "name string, url string, stop_after long")
    walk = fd.walk_feed(feeds, edges)
    got = sorted((r.name, r["round"], r.page_url, r.is_over) for r in walk.collect())
    # a negative counter runs until the visited guard stops it; a positive one counts down whatever it has read before
    assert got == [("n", 0, "a", False), ("n", 1, "b", False)] + [("p", i, "ab"[i % 2], i == 5) for i in range(6)] + [("z", 0, "a", True)]


def test_walk_of_a_long_chain(spark):
    n = 60
    edges = spark.createDataFrame([(f"p{i}", f"p{i + 1}" if i < n - 1 else None) for i in range(n)], "page_url string, next_url string")
    feeds = spark.createDataFrame([("f", "p0", -1)], "name string, url string, stop_after long")
    walk = fd.walk_feed(feeds, edges)
    assert sorted(r["round"] for r in walk.collect()) == list(range(n))
    assert walk._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_walk_doubles_over_a_chain_of_ten_thousand_pages(spark, monkeypatch):
    n, steps = 10_000, []
    monkeypatch.setattr(fd, "staged", lambda df, name, real=fd.staged: steps.append(name) or real(df, name))
    edges = spark.range(n).selectExpr("concat('p', id) as page_url", f"if(id < {n - 1}, concat('p', id + 1), null) as next_url")
    feeds = spark.createDataFrame([("all", "p0", -1), ("some", "p9000", 500), ("last", "p9999", -1)], "name string, url string, stop_after long")
    got = {r.name: (r.n, r.m) for r in fd.walk_feed(feeds, edges).groupBy("name").agg(F.count("*").alias("n"), F.max("round").alias("m")).collect()}
    assert got == {"all": (n, n - 1), "some": (501, 500), "last": (1, 0)}
    assert steps.count("walk-jumps") <= 14


def plain_walk(feeds, edges, fetched):
    rows = []
    for name, sel, url, left in feeds:
        seen, rnd = set(), 0
        while url in fetched and not (left < 0 and url in seen):
            seen.add(url)
            nxt = edges.get((sel, url))
            rows.append((name, rnd, url, left, nxt, nxt is None or left == 0))
            if rows[-1][-1]:
                break
            url, left, rnd = nxt, left - 1, rnd + 1
    return sorted(rows, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_walks_over_random_links(spark, seed):
    rng = random.Random(seed)
    pages = [f"p{i}" for i in range(40)]
    edges = {(s, p): rng.choice(pages + ["lost"]) for s in ("a.x", "a.y") for p in pages if rng.random() < 0.9}  # cycles, tails, lost pages
    feeds = [(f"f{i}", rng.choice(["a.x", "a.y"]), rng.choice(pages + ["lost"]), rng.randint(-2, 30)) for i in range(30)]
    rows = [(None, p, None) for p in pages] + [(s, p, n) for (s, p), n in edges.items()]
    e = spark.createDataFrame(rows + rows[:9], "selector string, page_url string, next_url string")  # pages fetched twice
    f = spark.createDataFrame([(n, (s, None, None), u, k) for n, s, u, k in feeds], "name string, sel struct<nextp:string,entries:string,links:string>, url string, stop_after long")
    got = sorted((tuple(r) for r in fd.walk_feed(f, e).select("name", "round", "page_url", "remaining", "next_url", "is_over").collect()), key=repr)
    assert got == plain_walk(feeds, edges, set(pages))
    cut = fd.walk_feed(f, e, max_rounds=5).agg(F.max("round")).first()[0]
    assert cut == min(4, max(r[1] for r in got))


def test_pages_are_asked_only_for_selectors_that_can_match(spark):
    page = "<div class='n7'><a href='/x'>x</a></div><a class='n3' href='/y'>y</a>"
    site = spark.createDataFrame([(f"http://s.org/{i}", page) for i in range(20)], "url string, html string")
    feeds = spark.createDataFrame([(f"f{i}", f"http://s.org/{i % 20}", -1, True, (f".n{i} a" if i % 2 else f"a.n{i}", None, None), None, i) for i in range(200)]
                                  + [("three", "http://s.org/0", -1, True, ("a.n3", None, None), None, 200)], FEEDS)
    edges = fd.next_pages(feeds, site)
    assert edges.count() == 60  # a row per page, and its links by the two selectors that match
    assert {(r.selector, r.next_url) for r in edges.where("selector is not null").collect()} == {(".n7 a", "http://s.org/x"), ("a.n3", "http://s.org/y")}
    plans = [len(fd.next_pages(feeds.limit(n), site)._jdf.queryExecution().optimizedPlan().toString()) for n in (1, 201)]
    assert plans[1] < 2 * plans[0] + 10_000


def test_a_feed_page_fetched_twice_gives_its_links_once(spark):
    rows = [("http://s.org/", "<h2><a href='/e'>e</a></h2>")] * 2 + [("http://s.org/e", "<article><a href='http://n.org/1'>1</a></article>")] * 3
    site = spark.createDataFrame(rows, "url string, html string")
    feeds = spark.createDataFrame([("f", "http://s.org/", 0, True, SEL, None, 0)], FEEDS)
    walk = fd.walk_feed(feeds, fd.next_pages(feeds, site))
    entries = fd.feed_entries(walk, site, feeds, resolve=True)
    assert walk.count() == 1 and entries.count() == 1
    links, errors = fd.feed_links(entries, site, feeds)
    assert [r.url for r in links.collect()] == ["http://n.org/1"] and errors.count() == 0


def test_page_lost_in_the_middle_of_a_walk(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "lost")], "page_url string, next_url string")
    feeds = spark.createDataFrame([("f", "a", -1, True), ("g", "none", 1, False)], "name string, url string, stop_after long, fake_news boolean")
    got = {(r.url, r.from_fake, r.type) for r in fd.missing_feed_pages(feeds, edges, fd.walk_feed(feeds, edges)).collect()}
    assert got == {("lost", True, "TimeoutError"), ("none", False, "TimeoutError")}


def test_selected_elements(spark):
    cases = [
        ("#main a", '<div id="main"><p>t</p><a href="/1">1</a></div><a href="/2">2</a>', ["/1"]),
        (".posts a", "<ul class='x posts y'><li><a href='/1'>1</a></li></ul><ul class='postsx'><a href='/2'>2</a></ul>", ["/1"]),
        ("div#main a", '<div id="main"><div>in</div><a href="/1">1</a></div><a href="/2">2</a>', ["/1"]),
        ("div a", '<div><div><a href="/1">1</a></div></div><div><a href="/2">2</a></div>', ["/1", "/2"]),
        ("h2 > a", '<h2><a href="/1">1</a><b><a href="/2">2</a></b><br><img src="x"><a href="/3">3</a></h2>', ["/1", "/3"]),
        ("a.x", "<a class=x href=/1>1</a><a href='/2'>2</a><a class='y x'>3</a>", ["/1", None]),
        ("a", "<script>var a='<a href=\"/no\">';</script><!-- <a href='/no'> --><abbr>q</abbr><A HREF='/1?a&amp;b'>1</A>", ["/1?a&b"]),
        ("p a", "<p><a href='/1'>never closed", ["/1"]),
        ("p a", "", []), ("p a", None, []),
    ]
    for selector, html, expected in cases:
        df = spark.createDataFrame([(html,)], "html string")
        assert df.select(sl.hrefs(F.col("html"), selector).alias("o")).first().o == expected, (selector, html)
    df = spark.createDataFrame([('<p class="try"><b>MegafAke</b></p>',)], "html string")
    for container in (".try", "p.try"):
        assert df.select(fd.condition_holds(F.col("html"), container, ["megafake"]).alias("o")).first().o is True


def test_archive_original_url(spark):
    hdr = '<div id="HEADER"><table><tr><td><input {}></td></tr></table></div><p>x</p>'
    df = spark.createDataFrame([(hdr.format('value="http://o.org/a"'),), (hdr.format('value=""'),),
                                (hdr.format('name="q"'),), ("<p>none</p>",),
                                ("<div id='HEADER'><p>x</p><table><tr><td><input name=q value='http://o.org/b?x&amp;y'></td></tr></table></div>",),
                                ('<div id="HEADER"><table><tr></tr></table></div><input value="http://out.org">',)], "html string")
    url, err = H.archive_original_url(F.col("html"))
    assert [(r.u, r.e) for r in df.select(url.alias("u"), err.alias("e")).collect()] == [
        ("http://o.org/a", None), (None, "ArchivedURLNotFound"), (None, "KeyError"), (None, "TypeError"),
        ("http://o.org/b?x&y", None), (None, "TypeError")]


def test_attributes_in_any_quotes(spark):
    html = "<html lang='de-DE'><meta content='d' name='description'><meta name=keywords content='a, b'><img alt=\"x\" src='/i.png'><iframe src=/v></iframe>"
    h = F.col("html")
    r = spark.createDataFrame([(html,)], "html string").select(
        H.meta_fields(h)["description"].alias("d"), H.page_lang(h).alias("l"), H.meta_fields(h)["keywords"].alias("k"), H.page_images(h).alias("i"), H.page_videos(h).alias("v")).first()
    assert (r.d, r.l, r.k, r.i, r.v) == ("d", "de", ["a", "b"], ["/i.png"], ["/v"])


PAGE = ('<html lang="en-US"><head><title>A long enough title - Site</title>'
        '<meta name="description" content=" One two three ">'
        '<meta content="k1, k2,, " name="keywords"><meta name="generator" content=" Gen 1 ">'
        '<meta property="article:section" content="World"><meta property="article:published_time" content="2019-03-25T10:11:12Z">'
        '<meta name="author" content="Ann"><meta name="author" content="Bob"><script>var t="</p>";</script></head>'
        '<body><nav><a href="/x">nav</a></nav><article><h1>Head</h1><p>First sentence here. Second one here!'
        '<p>Third &amp; last sentence? Yes.<img src="b.png"><img src="a.png"><iframe src="v.html"></iframe></article>'
        '<footer>foot</footer></body></html>')


def test_build_articles_fields_and_errors(spark):
    links = spark.createDataFrame([
        (0, 1, "http://n.org/p", "https://f.org/e1", True),
        (0, 2, "http://n.org/missing", "https://f.org/e1", True),
        (0, 3, "https://web.archive.org/web/2018/", "https://f.org/e1", True),
        (0, 4, "http://archive.is/9", "https://f.org/e1", True),
        (0, 5, "http://n.org/404", "https://f.org/e1", False),
    ], LINK_SCHEMA)
    hdr = '<div id="HEADER"><table><tr><td><input value="http://orig.org/a"></td></tr></table></div>'
    resp = spark.createDataFrame([("http://n.org/p", 200, PAGE), ("http://archive.is/9", 200, hdr + PAGE),
                                  ("http://n.org/404", 404, "x")], "url string, status int, html string")
    arts, errs = ar.build_articles(links, resp, RUN)
    a = {r.seq: r for r in arts.collect()}
    p = a[1]
    assert p.title == "A long enough title - Site" and p.url == "http://n.org/p" and p.netloc == "n.org"
    assert p.text == "Head First sentence here. Second one here! Third & last sentence? Yes."
    assert p.description == "One two three" and p.lang == "en" and p.keywords == ["k1", "k2"]
    assert p.generator == "Gen 1" and p.section == "World" and p.authors == ["Ann", "Bob"]
    assert p.images == ["a.png", "b.png"] and p.videos == ["v.html"]
    assert p.publish_date == dt.datetime(2019, 3, 25, 10, 11, 12) and p.scraped_date == RUN
    assert p.summary.startswith("Head First sentence here.")
    assert a[4].url == "http://orig.org/a" and a[4].visited_url == "http://archive.is/9" and a[4].path == "/a"
    e = {r.url: r.type for r in errs.collect()}
    assert e == {"http://n.org/missing": "TimeoutError", "https://web.archive.org/web/2018/": "ArchivedURLNotFound",
                 "http://n.org/404": "HttpStatusError"}


def test_a_link_has_one_response_however_often_its_page_was_fetched(spark):
    links = spark.createDataFrame([(0, 1, "http://n.org/p", "https://f.org/e1", True), (1, 1, "http://n.org/p", "https://f.org/e1", True),
                                   (0, 2, "http://n.org/q", "https://f.org/e1", True), (0, 3, "http://n.org/r", "https://f.org/e1", True)], LINK_SCHEMA)
    newer = PAGE.replace("First sentence", "Newer sentence")
    resp = spark.createDataFrame([("http://n.org/p", 200, 1, PAGE), ("http://n.org/p", 200, 2, newer), ("http://n.org/p", 200, 2, newer),
                                  ("http://n.org/q", 200, 1, PAGE), ("http://n.org/q", 404, 2, "gone"), ("http://n.org/r", 404, 1, None), ("http://n.org/r", 200, 1, PAGE)],
                                 "url string, status int, fetched int, html string").repartition(3)
    arts, errs = ar.build_articles(links, resp, RUN)
    got = {(r.batch_id, r.seq): r.text for r in arts.collect()}
    assert len(got) == arts.count() == 3
    assert "Newer" in got[0, 1] and got[1, 1] == got[0, 1] and "First" in got[0, 3]
    assert [(r.url, r.type) for r in errs.collect()] == [("http://n.org/q", "HttpStatusError")]
    # without the time of fetching: a usable one, then the greatest hash; the same under any partitioning
    texts = {tuple(sorted((r.batch_id, r.seq, r.text) for r in ar.build_articles(links, resp.drop("fetched").repartition(n), RUN)[0].collect())) for n in (1, 4)}
    assert len(texts) == 1
    linked = ar.link_pages(links, resp, {"n": F.length("html")}).collect()
    assert len(linked) == 4 and all(r._has_resp for r in linked)


def test_summary_picks_top_sentences_in_order(spark):
    text = "alpha beta. alpha beta gamma. delta. alpha alpha alpha. beta beta. epsilon zeta eta. alpha beta alpha."
    df = spark.createDataFrame([(1, text)], "k long, text string")
    s = ar.summarize(df, ["k"], "text", n=2).first().summary
    assert s == "alpha alpha alpha. alpha beta alpha."


def _arts(spark, rows):
    from pressloom.schemas import ARTICLE_SCHEMA
    df = spark.createDataFrame(rows, "batch_id long, seq long, url string, visited_url string, "
                                     "scraped_from string, fake boolean")
    for f in ARTICLE_SCHEMA.fields:  # a full article row: other columns null
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df


def test_store_articles_constraints_and_idempotence(spark, tmp_dir):
    path = os.path.join(tmp_dir, "article")
    b0 = _arts(spark, [(0, 1, "u1", "u1", "s", True), (0, 2, "u1", "v", "s", True), (0, 3, None, "w", "s", False)])
    stored, refused = store.store_articles(b0, path, RUN, "r1")
    assert sorted(r.url for r in stored.collect()) == ["u1"]
    assert sorted((r.type, r.url) for r in refused.collect()) == [("NotNullViolationError", "w"),
                                                                  ("UniqueViolationError", "v")]
    # doing the batch of the run again replaces it: still one row
    store.store_articles(b0, path, RUN, "r1")
    held = lambda: sorted(r.url for r in store.read_batches(spark, path, ARTICLE_SCHEMA).collect())
    assert held() == ["u1"]
    b1 = _arts(spark, [(1, 1, "u1", "x", "s", True), (1, 2, "u2", "u2", "s", True)])
    stored1, refused1 = store.store_articles(b1, path, RUN, "r1")
    assert [r.url for r in stored1.collect()] == ["u2"] and [r.url for r in refused1.collect()] == ["x"]
    assert held() == ["u1", "u2"]
    # the same batch id in another run replaces nothing
    b2 = _arts(spark, [(0, 1, "u3", "u3", "s", True), (0, 2, "u2", "u2", "s", True)])
    stored2, refused2 = store.store_articles(b2, path, RUN, "r2")
    assert [r.url for r in stored2.collect()] == ["u3"] and [r.url for r in refused2.collect()] == ["u2"]
    assert held() == ["u1", "u2", "u3"]


def test_two_rows_of_one_url_at_one_place_are_one_stored_row_and_one_error(spark, tmp_dir):
    path = os.path.join(tmp_dir, "article")
    rows = _arts(spark, [(0, 1, "u1", "u1", "s", True), (0, 1, "u1", "u1", "s", True), (0, 2, "u2", "u2", "s", True)]).repartition(3)
    stored, refused = store.store_articles(rows, path, RUN, "r1")
    assert sorted(r.url for r in stored.collect()) == ["u1", "u2"]
    assert [(r.type, r.url) for r in refused.collect()] == [("UniqueViolationError", "u1")]


def test_the_unique_check_reads_only_partitions_that_may_hold_a_url(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "article")
    for b in range(6):
        store.store_articles(_arts(spark, [(b, i, f"u{b}-{i}", "v", "s", True) for i in range(50)]), path, RUN, "r1")
    seen = []
    monkeypatch.setattr(store.url_index, "held_urls", lambda *a, real=store.url_index.held_urls: seen.append(real(*a)) or seen[-1])
    new = _arts(spark, [(0, 1, "u4-7", "x", "s", True), (0, 2, "new", "y", "s", True), (0, 3, "u2-9", "z", "s", True)])
    stored, refused = store.store_articles(new, path, RUN, "r2")
    assert [r.url for r in stored.collect()] == ["new"] and sorted(r.url for r in refused.collect()) == ["x", "z"]
    assert sorted(r.url for r in seen[0].collect()) == ["u2-9", "u4-7"]
    plan = seen[0]._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*run_id#\d+ = r1[^\]]*batch_id#\d+L IN \((2,4|4,2)\)", plan)
    others = F.col("run_id") != "r2"
    assert sorted((r.run_id, r.batch_id) for r in store.url_index.touched(spark, path, new, others).collect()) == [("r1", 2), ("r1", 4)]
    # blocks that are too small for their urls give false hits, not other results; a table without an index gets one
    monkeypatch.setattr(store.url_index, "URL_BLOCKS", 2)
    again = _arts(spark, [(0, 1, "u0-3", "x", "s", True), (0, 2, "newer", "y", "s", True), (0, 3, "new", "z", "s", True)])
    stored, refused = store.store_articles(again, path, RUN, "r3")
    assert [r.url for r in stored.collect()] == ["newer"] and sorted(r.url for r in refused.collect()) == ["x", "z"]


@pytest.mark.parametrize("fails", ["store_errors", "write_version", "clean_error_table"])
def test_a_run_that_fails_on_the_way_leaves_nothing_that_another_sees(spark, tmp_dir, monkeypatch, fails):
    def ends(base, lost):
        out = jobs.Outputs(*(os.path.join(tmp_dir, base, x) for x in "aes"))
        _collect(spark, out, "r1", ["http://n.org/1"], errors=["http://n.org/lost"])
        if lost:
            where = jobs if fails == "clean_error_table" else store
            real = getattr(where, fails)
            with monkeypatch.context() as m:
                def failing(*a):
                    real(*a)
                    raise OSError("lost")
                m.setattr(where, fails, failing)
                with pytest.raises(OSError):
                    _collect(spark, out, "r2", ["http://n.org/1", "http://n.org/2"], errors=["http://n.org/gone"])
        _collect(spark, out, "r3", ["http://n.org/1", "http://n.org/2"], errors=["http://n.org/gone"])
        return (sorted((r.url, r.run_id) for r in jobs.visible_articles(spark, out).collect()),
                sorted((r.type, r.url) for r in jobs.current_errors(spark, out, "r4").collect()),
                [tuple(r) for r in jobs.saved_state(spark, out, "r4").collect()])

    assert ends("with", True) == ends("without", False)


def test_jobs_in_threads_drop_only_what_they_staged(spark):
    import threading

    from pressloom.operators.common import dropping_staged, staged

    begun, ended, got = threading.Event(), threading.Event(), []

    def slow():
        with dropping_staged(spark):
            df = staged(spark.range(5), "slow")
            begun.set()
            ended.wait(60)
            got.append(df.count())

    t = threading.Thread(target=slow)
    with dropping_staged(spark):
        outer = staged(spark.range(3), "outer")
        t.start()
        begun.wait(60)
        with dropping_staged(spark):
            staged(spark.range(4), "inner")
        assert outer.count() == 3
    ended.set()
    t.join()
    assert got == [5]


def test_documents_that_cannot_be_read_stop_the_job(spark, tmp_dir):
    path = os.path.join(tmp_dir, "state.json")
    for text, shown in (('{"a": {"is_over": tr', "state file can't be read: {\"a\""), ('{"a": {"is_over": false, "data": {"page": "x"}}}', "MALFORMED"), ("[1]", "")):
        with open(path, "w") as f:
            f.write(text)
        with pytest.raises(Exception, match=None) as e:
            cf.read_state(spark, path).collect()
        assert shown in str(e.value)
    lines = spark.createDataFrame([('{"name": "ok", "url": "u"}',), ('{"name": "broken", "url": ',)], "value string")
    with pytest.raises(Exception) as e:
        cf.parse_feed_lines(lines).collect()
    assert "broken" in str(e.value)


def test_nothing_stored_reads_as_empty(spark, tmp_dir):
    path = os.path.join(tmp_dir, "none")
    assert store.read_batches(spark, path, ARTICLE_SCHEMA).count() == 0
    store.write_batches(_arts(spark, []), path, ARTICLE_SCHEMA, "r1")
    assert store.read_batches(spark, path, ARTICLE_SCHEMA).count() == 0
    assert store.latest_version(spark, path) is None


ERRORS = "type string, url string, source_article string, from_fake boolean, additional_info string, creation_date timestamp_ntz"


def _prep_n(spark):
    return jobs.prepare_rules(spark.createDataFrame([(1, "high", "n.org")], "source_id long, factual_reporting string, url string"), {"min_length": {"title": 3}})


def test_process_batch_stores_state_and_deletes_restored_errors(spark, tmp_dir):
    resp = spark.createDataFrame([("http://n.org/p", 200, PAGE), ("http://n.org/q", 200, PAGE.replace("A long", "Another"))], "url string, status int, html string")
    out = jobs.Outputs(os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "e"), os.path.join(tmp_dir, "s"))
    errs_versions = os.path.join(tmp_dir, "ev")
    err0 = spark.createDataFrame([("TimeoutError", "http://n.org/p", None, False, "i", None),
                                  ("TimeoutError", "http://other.org/", None, False, "i", None)], ERRORS)
    store.write_version(err0, errs_versions, "0")
    states = spark.createDataFrame([(0, "f", False, "http://n.org/", 3)], "batch_id long, name string, is_over boolean, url string, page long") \
        .select("batch_id", "name", "is_over", F.struct("url", "page", F.lit(None).cast("long").alias("posts")).alias("data"))
    ctx = StreamContext(resp, _prep_n(spark), out, RUN, "s1", restoring=True, errors_versions=errs_versions, states=states)
    links = spark.createDataFrame([(0, 1, "http://n.org/p", "https://f.org/", False)], LINK_SCHEMA)
    held = lambda: sorted(r.url for r in store.read_batches(spark, out.articles, ARTICLE_SCHEMA).collect())
    for _ in range(2):  # at-least-once: the same epoch twice gives the same tables
        stored = process_batch(links, 0, ctx)
        assert [r.url for r in stored.collect()] == ["http://n.org/p"]
    assert held() == ["http://n.org/p"]
    newest = store.read_version(spark, errs_versions, store.latest_version(spark, errs_versions), ERROR_SCHEMA)
    assert [r.url for r in newest.collect()] == ["http://other.org/"]
    st = store.read_version(spark, out.state, store.latest_version(spark, out.state), STATE_SCHEMA).collect()
    assert [(r.name, r.data.page) for r in st] == [("f", 3)]
    # the batch id again in the next epoch: the first epoch's article stays
    process_batch(spark.createDataFrame([(0, 1, "http://n.org/q", "https://f.org/", False)], LINK_SCHEMA), 1, ctx)
    assert held() == ["http://n.org/p", "http://n.org/q"]
    # a new stream from epoch 0 goes on from what is there; an epoch without the one before it is an error
    more = states.withColumn("name", F.lit("g")).drop("batch_id")
    save_progress(spark, more, out.state, "s2", 0)
    newest = store.read_version(spark, out.state, store.latest_version(spark, out.state), STATE_SCHEMA)
    assert sorted(r.name for r in newest.collect()) == ["f", "g"]
    with pytest.raises(FileNotFoundError):
        save_progress(spark, more, out.state, "s3", 4)


def test_epochs_write_deleted_urls_only_and_compaction_changes_no_row(spark, tmp_dir, monkeypatch):
    from pressloom.streaming import stream

    n = 5000
    versions = os.path.join(tmp_dir, "ev")
    err0 = spark.range(n).select(F.lit("TimeoutError").alias("type"), F.concat(F.lit("http://n.org/"), "id").alias("url"), F.lit(None).cast("string").alias("source_article"),
                                 F.lit(False).alias("from_fake"), F.lit("i").alias("additional_info"), F.lit(None).cast("timestamp_ntz").alias("creation_date"))
    none = err0.limit(1).withColumn("url", F.lit(None).cast("string"))  # an error without url is never deleted
    store.write_version(store.sink_projection(err0.unionByName(none), ERROR_SCHEMA), versions, "0")
    size = lambda v: sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(os.path.join(versions, "v=" + v)) for f in fs if f.endswith(".parquet"))
    rows = lambda v: store.read_version(spark, versions, v, ERROR_SCHEMA)
    urls = lambda *ids: spark.createDataFrame([(f"http://n.org/{i}",) for i in ids] + [(None,)], "url string")
    store.write_deletions(urls(1, 2, 2), versions, "s-0", after="0")
    store.write_deletions(urls(3), versions, "s-1", after="s-0")
    store.write_deletions(urls(4), versions, "s-1", after="s-0")  # the epoch done again
    assert store.latest_version(spark, versions) == "s-1" and store.version_parts(spark, versions, "s-1")[0] == "0"
    assert size("s-0") + size("s-1") < size("0") / 10
    left = {r.url for r in rows("s-1").collect()}
    assert len(left) == n + 1 - 3 and None in left and left.isdisjoint({"http://n.org/1", "http://n.org/2", "http://n.org/4"})
    assert rows("0").count() == n + 1  # readers of an earlier version are not touched
    whole = store.compact_version(spark, versions, "s-1", ERROR_SCHEMA)
    assert store.latest_version(spark, versions) == whole and store.version_parts(spark, versions, whole) == (whole, [])
    assert {r.url for r in rows(whole).collect()} == left and "s-1" < whole < "s-2"
    # an epoch that was lost on the way is no version
    os.makedirs(os.path.join(versions, "v=s-2", f"after={whole}"))
    assert store.latest_version(spark, versions) == whole
    # epochs compact by themselves
    monkeypatch.setattr(stream, "COMPACT_AFTER", 2)
    resp = spark.createDataFrame([(f"http://n.org/{i}", 200, PAGE.replace("A long", f"Page {i}")) for i in (10, 11, 12)], "url string, status int, html string")
    out = jobs.Outputs(os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "e"), os.path.join(tmp_dir, "s"))
    ctx = StreamContext(resp, _prep_n(spark), out, RUN, "t", restoring=True, errors_versions=versions)
    for epoch, i in enumerate((10, 11, 12)):
        process_batch(spark.createDataFrame([(0, 1, f"http://n.org/{i}", "https://f.org/", False)], LINK_SCHEMA), epoch, ctx)
    last = store.latest_version(spark, versions)
    assert [len(store.version_parts(spark, versions, v)[1]) for v in (stream.epoch_name("t", 0), stream.epoch_name("t", 1), stream.epoch_name("t", 2))] == [1, 2, 1]
    assert left - {r.url for r in rows(last).collect()} == {f"http://n.org/{i}" for i in (10, 11, 12)}


def _collect(spark, out, run, urls, html=PAGE, errors=(), **kw):
    """A job over one forum whose posts are the urls."""
    resp = spark.createDataFrame([(u, 200, html.replace("A long", u)) for u in urls] + [("x", 404, "x")], "url string, status int, html string")
    links = spark.createDataFrame([("forum", i, u, "https://f.org/", False) for i, u in enumerate([*urls, *errors])],
                                  "batch_key string, seq long, url string, scraped_from string, fake boolean")
    state = spark.createDataFrame([("forum", False, len(urls))], "name string, is_over boolean, posts long")
    return jobs.collect_job(None, resp, resp, _prep_n(spark), out, RUN, run_id=run, forum_links=links, forum_state=state, **kw)


def test_runs_keep_what_earlier_runs_stored(spark, tmp_dir):
    out = jobs.Outputs(os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "e"), os.path.join(tmp_dir, "s"))
    held = lambda: sorted(r.url for r in store.read_batches(spark, out.articles, ARTICLE_SCHEMA).collect())
    errors = lambda run: sorted(r.url for r in jobs.current_errors(spark, out, run).collect())
    # a run without an accepted article or an error
    assert _collect(spark, out, "r0", []).count() == 0
    # then one without errors
    assert [r.url for r in _collect(spark, out, "r1", ["http://n.org/1"]).collect()] == ["http://n.org/1"]
    assert errors("r2") == []
    # another run, and the same one again: both articles, no doubles
    for _ in range(2):
        assert [r.url for r in _collect(spark, out, "r2", ["http://n.org/2"], errors=["http://n.org/lost"]).collect()] == ["http://n.org/2"]
    assert held() == ["http://n.org/1", "http://n.org/2"]
    assert errors("r3") == ["http://n.org/lost"]
    # restoring stores the lost page and deletes its error; the next job doesn't bring it back
    resp = spark.createDataFrame([("http://n.org/lost", 200, PAGE)], "url string, status int, html string")
    assert jobs.restore_job(resp, _prep_n(spark), out, RUN, run_id="r3").count() == 0
    assert "http://n.org/lost" in held()
    _collect(spark, out, "r4", ["http://n.org/4"], errors=["http://n.org/gone"])
    assert errors("r5") == ["http://n.org/gone"]
    assert jobs.saved_state(spark, out, "r5").first().data.posts == 1


def test_forums_that_are_over_are_left_out(spark, tmp_dir):
    out = jobs.Outputs(os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "e"), os.path.join(tmp_dir, "s"))
    over = spark.createDataFrame([("forum", True)], "name string, is_over boolean").withColumn("data", F.lit(None).cast(STATE_SCHEMA["data"].dataType))
    assert _collect(spark, out, "r1", ["http://n.org/1"], state=over).count() == 0


def test_feed_errors_are_stored_on_demand(spark, tmp_dir):
    site = spark.createDataFrame([("http://s.org/", "<h2><a href='/e'>e</a></h2><a class='next' href='/lost'>n</a>")], "url string, html string")
    feeds = spark.createDataFrame([("f", "http://s.org/", 3, False, SEL, None, 0)], FEEDS)
    for flag, expected in ((False, []), (True, ["http://s.org/e", "http://s.org/lost"])):
        out = jobs.Outputs(*(os.path.join(tmp_dir, f"{flag}-{x}") for x in "aes"))
        jobs.collect_job(feeds, site, site, _prep_n(spark), out, RUN, store_feed_errors=flag)
        assert sorted(r.url for r in jobs.current_errors(spark, out, "9").collect()) == expected


def test_retry_order_is_total(spark):
    rows = [("TimeoutError", "u", f"s{i % 3}", i % 2 == 0, f"i{i % 5}", None if i % 4 == 0 else RUN) for i in range(20)]
    seen = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, ERRORS).repartition(3)
        seen.add(tuple(sorted((r.batch_id, r.seq, r.scraped_from, r.fake) for r in jobs.retry_batches(df).collect())))
    assert len(seen) == 1


def test_jobs_remove_what_they_staged(spark, tmp_dir):
    from pressloom.session import checkpoint_dir

    out = jobs.Outputs(os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "e"), os.path.join(tmp_dir, "s"))
    prep = _prep_n(spark)
    folder = checkpoint_dir(spark).removeprefix("file:")
    names = lambda: {x for x in os.listdir(folder) if x.startswith("pressloom-")}
    before = names()
    _collect(spark, out, "r1", ["http://n.org/1"])
    assert names() <= before and prep


def test_selector_subset_and_href_resolution(spark):
    import pytest as _pytest

    for unsupported in ("div > ul > a", "div span", "a:first", "[href] a", "div + a", "", "a, b"):
        with _pytest.raises(ValueError):
            sl.parse_selector(unsupported)
    df = spark.createDataFrame([("/a", "https://h.org/x/y?q"), ("//cdn.org/b", "https://h.org/"),
                                ("http://o.org/c", "https://h.org/"), ("/d", "relative/page")],
                               "href string, page string")
    got = [r.o for r in df.select(fd.resolve_href(F.col("href"), F.col("page")).alias("o")).collect()]
    assert got == ["https://h.org/a", "//cdn.org/b", "http://o.org/c", "/d"]
