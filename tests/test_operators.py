"""Operator tests on small in-line frames: labels, admission, merge, de-dup, rules, errors, numbering."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pressloom.operators import dedup
from pressloom.operators import errors as er
from pressloom.operators import labels as lb
from pressloom.operators import links as lk
from pressloom.operators.common import global_row_number, number_within_groups
from pressloom.operators.dedup import dedup_title_or_url
from pressloom.operators.rules import Rules


def sequential_dedup(rows):
    """The walk itself: per batch, in seq order, keep a row unless its stripped title or url is registered."""
    kept = set()
    for b in sorted({r[0] for r in rows}):
        titles, urls = set(), set()
        for _, seq, t, u in sorted((r for r in rows if r[0] == b), key=lambda r: r[1]):
            tk, uk = (t or "").strip(), (u or "").strip()
            if tk in titles or uk in urls:
                continue
            titles.add(tk)
            urls.add(uk)
            kept.add((b, seq))
    return kept


def run_dedup(spark, rows):
    df = spark.createDataFrame(rows, "batch_id long, seq long, title string, url string")
    return {(r.batch_id, r.seq) for r in dedup_title_or_url(df).collect()}


def test_dedup_is_not_two_windows(spark):
    rows = [(0, 1, "t1", "u1"), (0, 2, "t1", "u2"), (0, 3, "t2", "u2")]
    # row 2 is a duplicate by title and does not register u2, so row 3 stays
    assert run_dedup(spark, rows) == {(0, 1), (0, 3)}


def test_dedup_empty_titles_collide_and_nulls(spark):
    rows = [(0, 1, "", "a"), (0, 2, " ", "b"), (0, 3, None, "c"), (0, 4, "x", None), (0, 5, "y", "")]
    assert run_dedup(spark, rows) == sequential_dedup(rows) == {(0, 1), (0, 4)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_dedup_random_against_sequential(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(3), i, f"t{rnd.randrange(12)}", f"u{rnd.randrange(12)}") for i in range(150)]
    assert run_dedup(spark, rows) == sequential_dedup(rows)


def test_dedup_long_chain(spark):
    # every row shares a key with the next, so one row is kept per round
    rows = [(0, i, f"t{i // 2}", f"u{(i + 1) // 2}") for i in range(200)]
    kept = run_dedup(spark, rows)
    assert kept == sequential_dedup(rows) and len(kept) == 100


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_dedup_by_chains_from_the_first_round(spark, monkeypatch, seed):
    monkeypatch.setattr(dedup, "PLAIN_ROUNDS", 0)
    rnd = random.Random(seed)
    rows = [(rnd.randrange(2), i, f"t{rnd.randrange(25)}", f"u{rnd.randrange(25)}") for i in range(100)]
    order = list(range(1000, 1060))
    rnd.shuffle(order)  # a chain in any order, its rows first, second or later in their groups
    rows += [(2, s, f"t{i // 2}", f"u{(i + 1) // 2}") for i, s in enumerate(order)]
    rows += [(3, 1, "", ""), (3, 2, None, " "), (3, 3, "a", ""), (3, 4, "a", "b")]
    assert run_dedup(spark, rows) == sequential_dedup(rows)


def test_dedup_of_a_chain_of_a_hundred_thousand_rows_in_few_rounds(spark, monkeypatch):
    rounds = []
    real = dedup.staged
    monkeypatch.setattr(dedup, "staged", lambda df, name: (rounds.append(name), real(df, name))[1])
    n = 100_000
    df = spark.range(n).selectExpr("0L as batch_id", "id as seq", "concat('t', id div 2) as title", "concat('u', (id + 1) div 2) as url")
    kept = dedup_title_or_url(df)
    assert kept.count() == kept.where("seq % 2 = 0").count() == n // 2
    assert len(rounds) <= 40


def test_dedup_scope_is_per_batch(spark):
    rows = [(0, 1, "same", "same"), (1, 1, "same", "same")]
    assert run_dedup(spark, rows) == {(0, 1), (1, 1)}


def test_merge_links_first_position_last_value(spark):
    df = spark.createDataFrame([(0, 1, "a", "p1", True), (0, 2, "b", "p1", True), (0, 3, "a", "p2", False)],
                               "batch_id long, seq long, url string, scraped_from string, fake boolean")
    got = {r.url: (r.seq, r.scraped_from, r.fake) for r in lk.merge_links(df).collect()}
    assert got == {"a": (1, "p2", False), "b": (2, "p1", True)}


def test_merged_batches_keep_all_errors_and_the_newer_states(spark):
    e = spark.createDataFrame([("T", "u1"), ("T", "u1")], "type string, url string")
    f = spark.createDataFrame([("T", "u1"), ("H", "u2")], "type string, url string")
    assert sorted(tuple(r) for r in lk.merge_batch_errors(e, f).collect()) == [("H", "u2"), ("T", "u1"), ("T", "u1"), ("T", "u1")]
    schema = "name string, is_over boolean, data struct<url:string,page:long,posts:long>"
    a = spark.createDataFrame([("f", False, ("x", 1, None)), ("g", False, ("y", 2, None))], schema)
    b = spark.createDataFrame([("f", True, ("z", 0, None))], schema)
    assert sorted((r.name, r.is_over, r.data.url) for r in lk.merge_batch_states(a, b).collect()) == [("f", True, "z"), ("g", False, "y")]


def test_label_dim_mapping_tie_break_and_archive(spark):
    src = spark.createDataFrame([
        (1, "high", "https://www.a.com/"), (2, "low", "a.com"),          # same key: the later row wins
        (3, "unrated", "b.com"), (4, "High", "c.com"),                   # unmapped values are skipped
        (5, "mixed", "http://d.com/news"), (6, "satire", "archive.is"),  # key keeps its path; archive wins
    ], "source_id long, factual_reporting string, url string")
    dim = {r.key: r.label for r in lb.build_label_dim(src).collect()}
    assert dim["a.com"] == "low"
    assert "b.com" not in dim and "c.com" not in dim
    assert dim["d.com/news"] == "mixed"
    assert dim["archive.is"] == "archive" and dim["web.archive.org"] == "archive"


@pytest.mark.parametrize("label,fake,archived,expect", [
    ("high", False, False, True), ("high", True, False, False), ("high", True, True, False),
    ("low", True, False, True), ("low", False, False, False), ("low", True, True, True),
    ("mixed", True, False, False), ("mixed", True, True, True), ("mixed", False, True, False),
    ("archive", True, False, True), ("archive", False, False, False), ("archive", True, True, False),
    (None, True, False, False), (None, False, False, False),
])
def test_admission_truth_table(spark, label, fake, archived, expect):
    df = spark.createDataFrame([(label, fake, archived)], "l string, f boolean, a boolean")
    assert df.select(lb.admission(F.col("l"), F.col("f"), F.col("a")).alias("o")).first().o is expect


def test_rules_from_config(spark):
    rules = Rules.from_config({"blacklist": {"titles": ["Bad title"], "urls": ["http://x.org/bad"]},
                               "min_length": {"title": 5, "text": 10, "path_loc": 3}, "other": {"k": 1}})
    df = spark.createDataFrame([
        (1, "Bad title", "text long enough", "http://x.org/ok", "/ok"),
        (2, "Good title", "text long enough", "http://x.org/bad", "/bad"),   # url list checks urls (T4 fixed)
        (3, None, "text long enough", "http://x.org/n", "/n"),               # null title: not blacklisted, too short
        (4, "Good title", "short", "http://x.org/s", "/s"),
        (5, "Good title", "text long enough", "http://x.org/p", "/p"),       # path too short
        (6, "Good title", "text long enough", "http://x.org/fine", "/fine"),
    ], "id int, title string, text string, url string, path string")
    assert [r.id for r in rules.apply(df).orderBy("id").collect()] == [6]


def test_rules_large_blacklist_uses_anti_join(spark):
    titles = [f"t{i}" for i in range(1500)]
    r = Rules().add_blacklist("title", titles)
    df = spark.createDataFrame([(1, "t3"), (2, "keep"), (3, None)], "id int, title string")
    assert [x.id for x in r.apply(df).orderBy("id").collect()] == [2, 3]


def test_error_cleanup(spark):
    errs = spark.createDataFrame([
        ("T", "u1", None, True, "a", "2024-01-01"), ("T", "u1", None, True, "b", "2024-01-02"),
        ("T", "u1", None, True, "c", "2024-01-02"), ("T", "u1", None, True, "d", None),
        ("T", None, None, True, "e", "2024-01-01"), ("T", "u2", None, True, "f", "2024-01-01"),
        ("T", "u3", None, True, "g", "2024-01-01"),
    ], "type string, url string, source_article string, from_fake boolean, additional_info string, creation_date string") \
        .withColumn("creation_date", F.col("creation_date").cast("timestamp_ntz"))
    e5 = {r.additional_info for r in er.delete_superseded_errors(errs).collect()}
    assert e5 == {"b", "c", "d", "e", "f", "g"}  # ties and nulls stay
    arts = spark.createDataFrame([("u2", "v"), ("w", "u3")], "url string, visited_url string")
    e4 = {r.additional_info for r in er.cleanup_errors(errs, arts).collect()}
    assert e4 == {"b", "c", "d", "e"}


def test_global_row_number_and_groups(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("abc") if i % 3 else "hot", i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, v long").repartition(5)
    got = {(r.g, r.v): r.rn for r in global_row_number(df, ["g", "v"]).collect()}
    expect = {k: i + 1 for i, k in enumerate(sorted(rows))}
    assert got == expect
    grp = number_within_groups(df, ["g"], ["v"], rn="rn", next_cols=["v"]).collect()
    by = {}
    for g, v in sorted(rows):
        by.setdefault(g, []).append(v)
    for r in grp:
        vs = by[r.g]
        i = vs.index(r.v)
        assert r.rn == i + 1
        assert r.next_v == (vs[i + 1] if i + 1 < len(vs) else None)


@pytest.mark.parametrize("partitions", [3, 16])
def test_numbering_of_many_rows_with_other_columns(spark, partitions):
    """Range bounds are sampled from such an input; every use must still see one partitioning."""
    df = spark.range(400_000).select((F.xxhash64("id") % 7).alias("g"), F.xxhash64("id", F.lit(1)).alias("v"), F.col("id").alias("w"),
                                     F.concat(F.lit("text "), "id").alias("t")).repartition(7)
    numbered = global_row_number(df, ["v"], num_partitions=partitions)
    got = numbered.agg(F.count("rn"), F.countDistinct("rn"), F.min("rn"), F.max("rn"),
                       F.sum((F.col("t") == F.concat(F.lit("text "), "w")).cast("int"))).first()
    assert tuple(got) == (400_000, 400_000, 1, 400_000, 400_000)
    w = Window.partitionBy("g").orderBy("v")
    plain = df.select("g", "v", "w", "t", F.row_number().over(w).cast("long").alias("rn"), F.lead("t").over(w).alias("next_t"))
    own = number_within_groups(df, ["g"], ["v"], next_cols=["t"], num_partitions=partitions).select(plain.columns)
    assert own.count() == 400_000 and own.exceptAll(plain).count() == 0


@pytest.mark.parametrize("partitions", [4, 8])
def test_edge_view_equals_a_plain_window(spark, partitions, monkeypatch):
    from pressloom.sources import fixtures

    monkeypatch.setattr(fixtures, "number_within_groups", lambda *a, **k: number_within_groups(*a, **k, num_partitions=partitions))
    v = fixtures.Views(spark, "/root/testdata/sf0.1")
    w = Window.partitionBy("feed").orderBy("page_id")
    base = v.pages.select(fixtures._host().alias("feed"), "page_id", F.col("url").alias("page_url"))
    plain = base.select("feed", "page_id", "page_url", F.lead("page_url").over(w).alias("next_url"), F.row_number().over(w).cast("long").alias("rn"))
    own = v.edge.select(plain.columns)
    assert own.count() == 2500 and own.exceptAll(plain).count() == 0


def test_only_known_urls_misses_nothing(spark, monkeypatch):
    from pressloom.operators import common

    pages = spark.range(20_000).select(F.concat(F.lit("http://h/"), "id").alias("url"), F.lit("x").alias("html"))
    pages = pages.union(spark.createDataFrame([(None, "n")], "url string, html string"))
    known = pages.where("url like '%77'").select(F.col("url").alias("k"))
    for most in (1, 100_000):  # a crowded filter, and one that fits
        monkeypatch.setattr(common, "FILTER_MAX_BLOCKS", most)
        kept = common.only_known_urls(pages, "url", known, "k")
        assert kept.columns == pages.columns and known.exceptAll(kept.select("url")).count() == 0
    assert kept.count() < 260 and common.only_known_urls(pages, "url", known.limit(0), "k").count() == 0


def test_bounded_broadcast_falls_back_above_bound(spark):
    from pressloom.operators.common import bounded_broadcast

    small = spark.range(10)
    big = spark.range(100)
    j_small = spark.range(1000).join(bounded_broadcast(small, max_rows=50), "id")
    j_big = spark.range(1000).join(bounded_broadcast(big, max_rows=50), "id")
    assert "broadcast" in j_small._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in j_big._jdf.queryExecution().analyzed().toString().lower()
    assert j_small.count() == 10 and j_big.count() == 100


def test_spread_rows_only_when_under_parallel(spark):
    from pressloom.sources.tables import spread_rows

    one = spark.range(0, 100, numPartitions=1)
    many = spark.range(0, 100, numPartitions=64)
    assert spread_rows(one, "id", min_partitions=4).rdd.getNumPartitions() == 4
    assert spread_rows(many, "id", min_partitions=4) is many
    assert sorted(r.id for r in spread_rows(one, "id", min_partitions=4).collect()) == list(range(100))


def test_checkpoint_dir_is_set_for_local_sessions(spark):
    from pressloom.session import checkpoint_dir

    d = checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir() == d
