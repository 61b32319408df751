"""Operators 4, 5, 6 and 8 on cases with results written by hand or by brute force."""

import hashlib
import math
import random
import textwrap
from fractions import Fraction

import brute
import pytest
from pyspark.sql import functions as F

from pressloom.llm import licences, license_scan, quality_rules, url_filter, warc
from pressloom.llm.common import shared_path

# ---- licences ----


def scan(spark, texts, known=license_scan.KNOWN):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, digest string")
    lookup = spark.createDataFrame(known, "licence string, text string")
    return {r.doc_id: r for r in license_scan.scan_licences(docs, lookup).collect()}


def test_licences(spark):
    got = scan(spark, ["Released under the MIT License.", "released  UNDER the mit licence!!", "Copyright (c) 2020 A. Writer\nReleased under the MIT License",
                       "Some prose.\nAll rights reserved.\nReleased under the MIT License.\nmore", "It was released under the MIT License.", None, "", "copyrighted matter"])
    assert [got[i].whole_licence for i in range(8)] == ["MIT-notice"] * 3 + [None] * 5
    assert [got[i].line_licences for i in range(8)] == [["MIT-notice"]] * 3 + [["MIT-notice", "all-rights-reserved"], [], [], [], []]
    assert got[5].digest == got[6].digest == hashlib.sha256(b"").hexdigest() != got[7].digest


def test_whole_licence_over_several_lines(spark):
    body = dict(license_scan.KNOWN)["0BSD"]
    got = scan(spark, ["© 2021 someone\n" + body.upper().replace("FAVOR", "FAVOUR").replace(",", " ;"), body + " and more"])
    assert (got[0].whole_licence, got[1].whole_licence) == ("0BSD", None)


def test_known_texts_as_whole_files_and_inside_longer_ones(spark):
    texts, expected = [], []
    for name, title, body in licences.TEXTS:
        rewrapped = "\n\n".join(textwrap.fill(p, 50) for p in body.split("\n\n"))
        commented = "\n".join((" * " + x).rstrip() for x in body.split("\n"))
        texts += [f"{title}\n\nCopyright (c) 2019, Some Body\n\n{body}\n", rewrapped, f"A readme.\n\n{rewrapped}\n\nMore of it.",
                  f"/*\n * Copyright 2020 The Project Authors\n{commented}\n */\nint main() {{}}", f"prose before\n{body}\nprose after", body.replace("a", "an", 1) + "."]
        expected += [(name, name), (name, name), (None, name), (None, name), (None, name), (None, "")]
    got = scan(spark, texts)
    assert [(got[i].whole_licence, ",".join(got[i].block_licences)) for i in range(len(texts))] == expected


def test_parts_of_a_licence_and_many_beginnings_of_one(spark):
    body = dict(licences.KNOWN)["MIT"]
    pieces = body.split("\n\n")
    first = body.split("\n")[0]
    got = scan(spark, ["\n\n".join(pieces[:2]), "\n\n".join(reversed(pieces)), "\n".join([first] * 20000), "\n".join([first] * 3000) + "\n" + body[len(first) + 1:],
                       body + "\n\n" + dict(licences.KNOWN)["Zlib"] + "\nAll rights reserved"])
    assert [got[i].block_licences for i in range(5)] == [[], [], [], ["MIT"], ["MIT", "Zlib"]]
    assert got[4].line_licences == ["all-rights-reserved"]


def test_licence_rows_with_one_key_are_scanned_each_for_itself(spark):
    docs = spark.createDataFrame([(None, "All rights reserved."), (None, "prose"), (7, None), (7, "x\nAll rights reserved")], "doc_id long, text string")
    known = spark.createDataFrame(license_scan.KNOWN, "licence string, text string")
    got = sorted((str(r.doc_id), r.line_licences) for r in license_scan.scan_licences(docs, known).collect())
    assert got == [("7", []), ("7", ["all-rights-reserved"]), ("None", []), ("None", ["all-rights-reserved"])]


def test_licences_of_empty_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "All rights reserved."), (1, "All rights reserved."), (None, "All rights reserved.")], "doc_id long, text string")
    known = spark.createDataFrame(license_scan.KNOWN, "licence string, text string")
    assert [r.line_licences for r in license_scan.scan_licences(docs, known).collect()] == [["all-rights-reserved"]] * 3
    assert license_scan.scan_licences(docs.limit(0), known).count() == 0
    assert {r.whole_licence for r in license_scan.scan_licences(docs, known.limit(0)).collect()} == {None}


# ---- URLs ----


def test_url_parts_and_canonical_form(spark):
    cases = [("HTTP://WWW.A.org:80/P/?b=2&a=1&utm_source=x#f", "www.a.org:80", "/P/", "a.org/P?a=1&b=2"), ("https://b.com", "b.com", "", "b.com"),
             ("http://c.com?x=1", "c.com", "", "c.com?x=1"), ("no scheme/at all", "", "", None), (None, "", "", None), ("", "", "", None),
             ("x://ÀB.com/a#b?c", "Àb.com", "/a", "Àb.com/a"), ("http://d.com/a://e/f", "d.com", "/a://e/f", "d.com/a://e/f")]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, url string")
    u = F.col("url")
    got = df.select("i", url_filter.host_of(u), url_filter.path_of(u), url_filter.canonical(u)).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [c[1:] for c in cases]


def test_rules_and_list(spark):
    pages = spark.createDataFrame([(1, "http://x.org/a"), (2, "http://blog.example.org/es/1"), (3, "http://example.org/en/12"), (4, "http://example.org/en/2"),
                                   (5, "http://a.com/fr/x"), (6, "http://a.com/de/x"), (7, "http://listed.net/a/"), (8, "https://www.listed.net/a#x"),
                                   (9, "http://free.net/"), (10, None), (11, "http://xorg/a"), (12, "http://x.org"), (13, "http://listed.net/a")],
                                  "page_id long, url string")
    listed = spark.createDataFrame([("listed.net/a",), ("listed.net/a",), (None,), ("other.net",)], "canonical string")
    got = {r.page_id: (r.rule, r.verdict, r.is_listed) for r in url_filter.filter_urls(pages.withColumn("Verdict", F.lit("old")), listed, url_filter.RULES).collect()}
    assert got == {1: ("org/", "allow", False), 2: ("example.org/es/", "block", False), 3: ("example.org/en/1", "block", False), 4: ("org/", "allow", False),
                   5: ("com/fr/", "allow", False), 6: ("com/de/", "block", False), 7: (None, "block", True), 8: (None, "block", True), 9: (None, "allow", False),
                   10: (None, "allow", False), 11: (None, "allow", False), 12: (None, "allow", False), 13: (None, "block", True)}
    assert url_filter.filter_urls(pages.limit(0), listed, url_filter.RULES).count() == 0
    assert {r.is_listed for r in url_filter.filter_urls(pages, listed.limit(0), url_filter.RULES).collect()} == {False}


def test_bloom_filter_misses_nothing_and_join_removes_false_hits(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BITS_PER_URL", 1)  # a crowded filter: many false hits
    pages = spark.range(4000).select(F.concat(F.lit("h.net/"), "id").alias("canonical"))
    listed = pages.where("canonical like '%7'")
    for limit in (10, 10_000_000):
        monkeypatch.setattr(url_filter, "MAX_BLOCKS_BROADCAST", limit)
        monkeypatch.setattr(url_filter, "MAX_LISTED_BROADCAST", limit)
        got = url_filter.listed_urls(pages, listed)
        assert got.count() == 4000 and got.where(F.col("is_listed") != F.col("canonical").endswith("7")).count() == 0


# ---- WARC ----

BIG, BIG2 = "x" * 1000, "é" * 600


def archive(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = shared_path(spark, "warc-test")
    index = warc.write_archives(warc.plan_records(pages), folder)
    return index, folder


def test_warc_round_trip(spark):
    rows = [(1, "u1", BIG), (5, "u5", BIG), (3, "u3", BIG), (4, "ü\r\n4", BIG2), (6, None, BIG2), (7, "u7", "short"), (8, "u8", "short"), (9, "u9", None), (10, "u10", "")]
    index, folder = archive(spark, rows)
    got = {r.page_id: r for r in warc.read_records(index, folder).collect()}
    assert {k: (r.record_type, r.refers_to) for k, r in got.items()} == {
        1: ("revisit", 5), 3: ("revisit", 5), 5: ("response", None), 4: ("revisit", 6), 6: ("response", None), 7: ("response", None),
        8: ("response", None), 9: ("response", None), 10: ("response", None)}
    for i, _, html in rows:
        data = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert got[i].payload == (None if got[i].record_type == "revisit" else data)


def test_warc_selected_ranges(spark, monkeypatch):
    monkeypatch.setattr(warc, "READ_GAP", 0)
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)  # several archives of a task
    rng = random.Random(5)
    rows = [(i, f"u{i}", "".join(rng.choices("abcdefgh", k=900))) for i in range(60)]
    index, folder = archive(spark, rows)
    chosen = index.where("page_id % 7 = 0")
    assert {(r.page_id, bytes(r.payload).decode()) for r in warc.read_records(chosen, folder).collect()} == {(i, t) for i, _, t in rows if i % 7 == 0}
    spans = sorted((r.file, r.offset, r.length) for r in index.collect())
    assert all(a[0] != b[0] or a[1] + a[2] == b[1] for a, b in zip(spans, spans[1:]))


def test_warc_null_ids_repeated_rows_and_empty_table(spark):
    index, folder = archive(spark, [(None, "a", BIG), (None, "b", BIG), (2, "c", BIG2), (2, "c", BIG2), (None, "d", BIG2)])
    got = sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in warc.read_records(index, folder).collect())
    assert got == [(0, "response", 0), (0, "response", 0), (0, "revisit", 2), (2, "response", 0), (2, "response", 0)]
    index, folder = archive(spark, [])
    assert warc.read_records(index, folder).count() == 0


# ---- quality rules ----

TEXTS = [None, "", "   \n \t", "one two three", "a b c a b c a b c", "x y x y x y z", "line\nline\n\nother\nline\n \n", "#*$ %&| <> !?", "é ü\x0bß\x0c d\re", "w " * 3000,
         "a b c d a b c", "ab c a bc ab c"]


def test_measures_equal_brute_force(spark):
    rng = random.Random(2)
    texts = TEXTS + [" ".join(rng.choices("abcde", k=rng.randint(0, 40))) for _ in range(60)]
    df = spark.createDataFrame([(i, "en", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string")
    got = {r.doc_id: tuple(r)[2:] for r in quality_rules.measures(df).collect()}
    assert got == {i: brute.measures(t) for i, t in enumerate(texts)}


def tail(n, k):
    """P(X <= k) of the binomial distribution, exactly."""
    p = Fraction(quality_rules.RISK).limit_denominator(10**6)
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


@pytest.mark.parametrize("tests", [1, 200])
def test_binomial_bound_is_exact(spark, tests):
    sizes = [0, 1, 100, 598, 599, 600, 1200, 3000]
    df = spark.createDataFrame([(n,) for n in sizes], "n long")
    got = {r.n: r.k for r in df.select("n", quality_rules.max_false(F.col("n"), F.lit(tests)).alias("k")).collect()}
    for n in sizes:
        fits = [k for k in range(int(n * quality_rules.RISK) + 1) if tail(n, k) <= Fraction(quality_rules.ERROR) / tests]
        assert got[n] == max(fits, default=-1), n


def labelled(spark, n):
    good = [(i, "en", " ".join(f"w{j * 7 + i}" for j in range(60)), 1) for i in range(n)]
    bad = [(n + i, "en", " ".join(f"w{j}#" for j in range(60)), 0) for i in range(n // 10)]
    rare = [(2 * n + i, "fr", " ".join(f"v{j}#" for j in range(60)), 0) for i in range(20)]
    rows = spark.createDataFrame(good + bad + rare, "doc_id long, lang string, text string, quality int")
    return rows.drop("quality"), rows.select("doc_id", "quality")


def test_cutoffs_reject_bad_texts_and_keep_good_ones(spark):
    docs, labels = labelled(spark, 3000)
    extra = spark.createDataFrame([(None, "en", None), (None, None, "a b"), (0, "en", " ".join(map(str, range(60))))], docs.schema)
    out = quality_rules.apply_rules(docs.union(extra), labels)
    got = out.groupBy("lang", "kept").count().collect()
    # no good French labels certify a cutoff there; texts of fewer than 50 words fail the base rules
    assert {(r.lang, r.kept): r["count"] for r in got} == {("en", True): 3001, ("en", False): 301, ("fr", True): 20, (None, False): 1}


def test_quality_without_labels_or_documents(spark):
    docs, labels = labelled(spark, 100)
    assert quality_rules.apply_rules(docs, labels.limit(0)).where("kept = base_failed").count() == 0
    assert quality_rules.apply_rules(docs.limit(0), labels).count() == 0
    nulls = spark.createDataFrame([(None, 1), (1, None), (2, 7)], "doc_id long, quality int")
    assert quality_rules.apply_rules(docs, nulls).where("not kept").count() == 0
