"""Plan properties the design relies on, checked on the formatted physical plan."""

import io
import os
import re
from contextlib import redirect_stdout

import pytest

from pressloom.plans import catalog
from conftest import SF_CHECK


def plan_of(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def exchange_inputs(plan: str) -> list[str]:
    """The ``Input [...]`` line of every shuffle exchange."""
    out, in_exchange = [], False
    for line in plan.splitlines():
        if re.match(r"^\(\d+\) Exchange", line):
            in_exchange = True
        elif in_exchange and line.startswith("Input ["):
            out.append(line)
            in_exchange = False
    return out


@pytest.fixture(scope="module")
def split_tables(spark, tmp_path_factory):
    """The sf0.01 pages and events stored as many files, like a large table (enough read tasks)."""
    d = str(tmp_path_factory.mktemp("split"))
    for t in ("pages", "events"):
        spark.read.parquet(f"{SF_CHECK}/{t}.parquet").repartition(16).write.parquet(os.path.join(d, f"{t}.parquet"))
    return d


@pytest.fixture()
def no_broadcast_by_size(spark):
    """Plans as for inputs of any size: only frames of bounded size are sent to all tasks."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("key", ["link_pages", "build_articles"])
@pytest.mark.parametrize("max_blocks", [100_000, 1])
def test_links_and_articles_move_no_html(spark, split_tables, no_broadcast_by_size, monkeypatch, key, max_blocks):
    """Whatever the number of links: also with a url filter that is too small for them."""
    from pressloom.operators import articles, common

    monkeypatch.setattr(common, "FILTER_MAX_BLOCKS", max_blocks)
    plans = []
    monkeypatch.setattr(articles, "staged", lambda df, name, real=articles.staged: plans.append(plan_of(df)) or real(df, name))
    plans.append(plan_of(catalog.QUERIES[key](spark, split_tables)))
    assert any(re.search(r"ReadSchema: .*\bhtml", p) for p in plans)
    for plan in plans:
        assert not [i for i in exchange_inputs(plan) if re.search(r"\bhtml#", i)]


def test_feeds_move_no_html(spark, split_tables, no_broadcast_by_size, tmp_dir):
    from pressloom.operators import feeds as fd
    from pressloom.sources.fixtures import Views

    v = Views(spark, split_tables)
    v.site.repartition(8).write.parquet(f"{tmp_dir}/site")
    site, conf = spark.read.parquet(f"{tmp_dir}/site"), v.conf
    edges = fd.next_pages(conf, site)
    entries = fd.feed_entries(fd.walk_feed(conf, edges), site, conf, resolve=True)
    links, errors = fd.feed_links(entries, site, conf)
    for df in (edges, entries, links, errors):
        assert not [i for i in exchange_inputs(plan_of(df)) if re.search(r"\bhtml#", i)]


def test_page_summary_shuffles_no_html(spark, split_tables, no_broadcast_by_size):
    inputs = exchange_inputs(plan_of(catalog.QUERIES["page_summary"](spark, split_tables)))
    assert not [i for i in inputs if re.search(r"\bhtml#", i)], inputs


def test_top_posts_limits_before_the_shuffle(spark):
    plan = plan_of(catalog.QUERIES["top_posts"](spark, SF_CHECK))
    assert plan.count("WindowGroupLimit") >= 2  # partial (before the exchange) and final
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan


def test_resolved_errors_is_a_hash_anti_join(spark):
    plan = plan_of(catalog.QUERIES["delete_resolved_errors"](spark, SF_CHECK))
    assert "NestedLoopJoin" not in plan and "LeftAnti" in plan


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(catalog.QUERIES["merge_links"](spark, SF_CHECK))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan and "html" not in plan
