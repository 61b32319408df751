"""Operators 3 and 10 against brute force."""

import random
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pressloom.llm import common, jaccard_join, shingles, suffix_dedup
from pressloom.llm.components import components

WORDS = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


def corpus(seed=1):
    """Rows with copies, near copies in chains, shared passages, and edge cases."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(0, 150)) for _ in range(60)]
    passage = prose(rng, 70)
    for i in range(40):
        words = texts[i % 12].split()
        for _ in range(rng.randint(0, 8)):
            if words:
                words[rng.randrange(len(words))] = rng.choice(WORDS)
        texts.append(" ".join(words))
    texts += [prose(rng, 30) + " " + passage + " " + prose(rng, 30) for _ in range(15)]
    base = prose(rng, 300).split()
    for i in range(25):  # a group of near copies, the ends of which aren't similar
        texts.append(" ".join(base[i * 2:i * 2 + 220]))
    texts += [texts[3]] * 20 + [None, "", "  \n", "a b", "A  B", "a b", "é ü ß", "x" * 3000, texts[70].upper().replace("É", "é"), "ab " * 400]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts))


def test_shingle_sets_equal_brute_force():
    texts = [t for _, t in corpus()] + ["a\x0bb\x0cc\rd\te f", "\x85 \xa0", "word\x00word a b c d"]
    sets = shingles.shingle_sets(pa.array(texts).slice(0))
    all_of = {}
    for t, s in zip(texts, sets):
        own = brute.shingles(t)
        assert len(own) == len(s)
        for key in own:
            all_of.setdefault(key, []).append(0)
    assert len(np.unique(np.concatenate(sets))) == len(all_of)
    part = shingles.shingle_sets(pa.array(texts).slice(5, 40))  # sliced buffers
    assert all((a == b).all() for a, b in zip(part, sets[5:45]))
    for s in sets:
        assert (shingles.unpack(shingles.pack(s)) == s).all()


def test_long_words_hash_like_short_ones(monkeypatch):
    text = "a b " + "x" * 3000 + " c " + "yz" * 700 + " d e f " + "x" * 2999
    whole = shingles.shingle_sets(pa.array([text, "x" * 5000]))
    monkeypatch.setattr(shingles, "LONG_WORD", 10_000)  # byte by byte
    plain = shingles.shingle_sets(pa.array([text, "x" * 5000]))
    assert all((a == b).all() and len(a) for a, b in zip(whole, plain))


def test_sketches_bound_overlaps():
    rng = np.random.default_rng(8)
    for n, m, both in ((1, 1, 1), (1, 3, 0), (50, 70, 40), (400, 300, 0), (400, 300, 250), (5000, 90, 90), (2000, 2000, 1800)):
        pool = np.unique(rng.integers(0, 1 << 48, 3 * (n + m), dtype=np.uint64))
        rng.shuffle(pool)
        a, b = pool[:n], np.concatenate([pool[:both], pool[n:n + m - both]])
        most, about = shingles.overlap_bounds(shingles.sketch(a), shingles.sketch(b))
        assert both <= most <= min(n, m) and (n < 100 or abs(about - both) <= 0.25 * min(n, m))
    same_bits = np.arange(300, dtype=np.uint64) << np.uint64(12)  # many members with equal lowest bits
    assert shingles.overlap_bounds(shingles.sketch(same_bits), shingles.sketch(same_bits[:200]))[0] >= 200


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 50 + i) for i in range(30)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and all(got[i] == 50 for i in [100, *range(50, 80)]) and got[201] == 200 and 7 in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("hot,spread,bands", [(200, 4096, 8), (3, 5, 1)])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, hot, spread, bands):
    """Also with almost every shared shingle hot, lists in tiny parts and one band of centres."""
    monkeypatch.setattr(jaccard_join, "HOT_SETS", hot)
    monkeypatch.setattr(jaccard_join, "HOT_SHARE", 10**9)
    monkeypatch.setattr(jaccard_join, "SPREAD", spread)
    monkeypatch.setattr(jaccard_join, "BANDS", bands)
    rows = corpus()
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_shingles int").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(df).collect()}
    groups = brute.near_groups(rows)
    assert got == {k: (len(brute.shingles(t)), groups[i]) for i, (k, t) in enumerate(rows)}


def test_overlap_from_differences(spark, monkeypatch):
    """Links that only the index lists find: centres are off, every set stands for itself or its centre."""
    rows = corpus(7)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    real = jaccard_join.centre_pairs
    monkeypatch.setattr(jaccard_join, "centre_pairs", lambda texts, hot: real(texts, hot).where("pmod(v, 3) = 0"))
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_join(df).collect()}
    groups = brute.near_groups(rows)
    assert got == {k: groups[i] for i, (k, _) in enumerate(rows)}


def brute_links(rows):
    """Distinct sets as text numbers, links between them, and the linked rows of every row."""
    sets = [frozenset(brute.shingles(t)) for _, t in rows]
    alike = lambda a, b: bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)
    distinct = [s for s in dict.fromkeys(sets) if s]
    links = {frozenset((a, b)) for i, a in enumerate(distinct) for b in distinct[:i] if alike(a, b)}
    return sets, links, [sum(i != j and alike(a, b) for j, b in enumerate(sets)) for i, a in enumerate(sets)]


@pytest.mark.parametrize("hot,bands,block", [(40, 8, 512), (3, 1, 7)])
def test_every_link_is_made(spark, monkeypatch, hot, bands, block):
    """Also between sets of one group of near copies; in one block, and in many."""
    monkeypatch.setattr(jaccard_join, "HOT_SETS", hot)
    monkeypatch.setattr(jaccard_join, "HOT_SHARE", 10**9)
    monkeypatch.setattr(jaccard_join, "BANDS", bands)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "COLUMNS", 50)
    rng = random.Random(9)
    base = prose(rng, 160).split()
    near = [" ".join(rng.choice(WORDS) if rng.random() < share else w for w in base) for share in (0.005, 0.01, 0.02, 0.03) for _ in range(25)]
    rows = corpus(2)
    rows += [(len(rows) + i, t) for i, t in enumerate(near + near[:2])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sets, links, counts = brute_links(rows)
    members, found = jaccard_join.jaccard_links(df)
    of = {k: s for (k, _), s in zip(rows, sets)}
    text_of = {r.set: of[r.id] for r in members.collect()}
    found = [(r.u, r.v) for r in found.collect()]
    assert all(u < v for u, v in found) and len(found) == len(links) > 1000
    assert {frozenset((text_of[u], text_of[v])) for u, v in found} == links
    got = {r.doc_id: r.n_links for r in jaccard_join.jaccard_join(df).collect()}
    assert got == {k: n for (k, _), n in zip(rows, counts)}


def test_lists_of_many_classes_are_dealt_in_pairs_of_blocks(spark, monkeypatch):
    """A list of sets in as many classes: all its pairs, and no task of more than two blocks' pairs."""
    monkeypatch.setattr(jaccard_join, "SPREAD", 20)
    monkeypatch.setattr(jaccard_join, "MADE", 50)
    n, size = 300, lambda i: 100 + 3 * (i % 30)
    entries = spark.createDataFrame([(t, i, size(i), t) for t in (0, 1) for i in range(n)], "token long, set long, n long, place long").repartition(6)
    classes = spark.createDataFrame([(i, 1000) for i in range(90)], "node long, component long")  # the other sets have no class
    tasks = jaccard_join.dealt_lists(entries, classes).groupBy("main", "mixed", "i", "j").count().collect()
    assert len(tasks) > 200 and max(r["count"] for r in tasks) <= 4 * 20
    got = [(r.u, r.v) for r in jaccard_join.candidate_pairs(entries, classes).collect()]
    fits = lambda a, b: min(a, b) * 100 >= max(a, b) * 75
    assert sorted(got) == [(i, j) for i in range(n) for j in range(i + 1, n) if j >= 90 and fits(size(i), size(j))]


def test_jaccard_join_of_null_ids_repeats_and_nothing(spark):
    t = "one two three four five six"
    df = spark.createDataFrame([(None, t), (5, t), (5, t), (9, None), (None, ""), (None, "alone")], "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(df).collect())
    assert got == Counter([(None, 2, 5), (5, 2, 5), (5, 2, 5), (9, 0, 9), (None, 0, None), (None, 1, None)])
    assert jaccard_join.jaccard_join(df.limit(0)).count() == 0
    assert jaccard_join.jaccard_join(df.where("text is null")).count() == 1


def test_column_sort_equals_brute_force():
    rng = random.Random(3)
    for _ in range(25):
        base = "".join(rng.choices("ab", k=600))
        bodies = []
        for _ in range(rng.randint(1, 12)):
            a = rng.randint(0, 300)
            x = list(base[a:a + rng.randint(150, 268)])
            if rng.random() < 0.7:
                x[rng.randrange(len(x))] = "c"
            bodies.append("".join(x).encode())
        seen = Counter(b[i:i + 200] for b in bodies for i in range(len(b) - 199))
        for b, flags in zip(bodies, suffix_dedup.column_sort(bodies)):
            assert flags.tolist() == [seen[b[i:i + 200]] > 1 for i in range(max(len(b) - 199, 0))]


def check_repeats(spark, rows):
    df = spark.createDataFrame([(i, t, "old") for i, t in rows], "doc_id long, text string, Kept string").repartition(4)
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(df).collect()}
    assert len(got) == len(rows)
    for (i, t), flags in zip(rows, brute.cut_repeats([t for _, t in rows])):
        data, r = (t or "").encode(), got[i]
        runs = suffix_dedup.runs(np.frombuffer(bytes(flags), bool)) if flags else []
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(data), sum(flags), len(runs)), i
        assert [(s.start, s.stop) for s in r.spans] == runs
        assert bytes(r.kept) == bytes(b for b, f in zip(data, flags) if not f)


@pytest.mark.parametrize("rows,block,piece", [(20_000, 2 << 20, 4 << 20), (3, 1000, 500)])
def test_repeats_equal_brute_force(spark, monkeypatch, rows, block, piece):
    """Also with tiny blocks, so that cores are lengthened to whole strings, and texts anchored piece by piece."""
    monkeypatch.setattr(suffix_dedup, "BLOCK_ROWS", rows)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    check_repeats(spark, corpus(4) + [(1000, "ab" * 300), (1001, "é" * 99), (1002, "é" * 101), (1003, "z" * 200), (1004, "q" * 199), (1005, "q" * 199)])


def test_repeats_in_repeated_rows_and_nothing(spark):
    text = "".join(random.Random(1).choices("abcdef", k=400))
    df = spark.createDataFrame([(None, text), (None, text), (1, "short"), (1, "short"), (2, None)], "doc_id long, text string")
    assert sorted((r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(df).collect()) == [(0, 0, 0), (5, 0, 0), (5, 0, 0), (400, 400, 1), (400, 400, 1)]
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def test_frequent_anchors_and_texts_of_one_hash(spark, monkeypatch):
    """A passage in every text, its segments dealt by digest; texts of one length have one hash until they get others."""
    monkeypatch.setattr(suffix_dedup, "FREQUENT", 2)
    monkeypatch.setattr(suffix_dedup, "SEEN", 5)
    monkeypatch.setattr(suffix_dedup, "text_hash", lambda salt, text: F.xxhash64(F.lit(salt), text) if salt else F.length(text).cast("long"))
    rng = random.Random(6)
    passage = "".join(rng.choices("abcdefgh", k=450))
    texts = ["".join(rng.choices("xyz", k=n)) + passage + "".join(rng.choices("uvw", k=40)) for n in [30] * 12 + [250] * 6]
    texts += [passage[:300] + "#" * 260, passage[100:] + "-=" * 150, "-=" * 150, "k" * 900, texts[2], texts[2], "a" * 490, "b" * 490, None, ""]
    check_repeats(spark, list(enumerate(texts)))


def test_runs_take_few_segments():
    """A long run or period is a few segments and one run of strings that are known to repeat; all strings are accounted for once."""
    for unit in ("z", "-=", "abc", "0123456789"):
        raw = np.frombuffer((unit * 300_000)[:300_000].encode(), np.uint8)
        e, known = suffix_dedup.segments(raw, 7)
        assert len(e) <= 200 and len(known) <= 5
        assert int(e["strings"].sum()) + int(known["strings"].sum()) == len(raw) - 199
    assert all(len(x) == 0 for x in suffix_dedup.segments(np.empty(0, np.uint8), 7))


def test_least_between_and_sort_of_short_bodies():
    rng = np.random.default_rng(3)
    for n in (1, 2, 50, 900):
        a = rng.integers(0, 255, n, dtype=np.uint8)
        start = rng.integers(0, n, 40)
        stop = np.array([rng.integers(s + 1, n + 1) for s in start])
        got = suffix_dedup.least_between(np.append(a, np.uint8(255)), start, stop)
        assert got.tolist() == [a[s:e].min() for s, e in zip(start, stop)]
    assert [f.tolist() for f in suffix_dedup.column_sort([b"", b"ab", b"x" * 199])] == [[], [], []]
    assert [f.tolist() for f in suffix_dedup.column_sort([b"x" * 201, b"", b"y" * 200, b"y" * 200])] == [[True, True], [], [True], [True]]


def test_rows_where_nothing_repeats_keep_all_columns(spark):
    """Such rows don't go through the join; their columns and types are those of the others."""
    rng = random.Random(8)
    shared = prose(rng, 80)
    texts = [prose(rng, 60) for _ in range(300)] + [shared, "x " + shared, None, ""]
    df = spark.createDataFrame([(i, t, {"a": i}) for i, t in enumerate(texts)], "doc_id long, text string, other map<string,int>")
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(df).collect()}
    assert len(got) == len(texts) and all(got[i].text == t and got[i].other == {"a": i} for i, t in enumerate(texts))
    for i, t in enumerate(texts):
        assert (got[i].n_bytes, got[i].spans is None) == (len((t or "").encode()), False)
        if i < 300 or not t:
            assert (got[i].n_removed, got[i].n_spans, got[i].spans, bytes(got[i].kept)) == (0, 0, [], (t or "").encode())
    assert got[300].n_removed == len(shared) and got[301].n_removed == len(shared)


@pytest.mark.parametrize("bits", [1 << 25, 64])
def test_maybe_among_misses_no_key(spark, monkeypatch, bits):
    monkeypatch.setattr(common, "MAYBE_BITS", bits)
    df = spark.range(5000).withColumn("h", F.xxhash64("id"))
    marked = common.maybe_among(df, F.col("h"), df.where("id % 50 = 0").select("h").union(df.where("id % 100 = 0").select("h")))
    assert marked.columns == ["id", "h", "_maybe"]
    rows = {r.id: r._maybe for r in marked.collect()}
    assert len(rows) == 5000 and all(rows[i] for i in range(0, 5000, 50))
    assert bits == 64 or sum(rows.values()) < 700
    assert not any(r._maybe for r in common.maybe_among(df, F.col("h"), df.limit(0).select("h")).collect())


def test_narrow_frames_go_to_few_files(spark):
    """Not to one file for each shuffle partition."""
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "101")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        made = components(spark.range(2000).select(F.col("id").alias("a"), (F.col("id") + 2).alias("b")))
        assert len(made.inputFiles()) <= 4 * spark.sparkContext.defaultParallelism < 101
        assert made.groupBy("component").count().count() == 2
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_repeated_items():
    rng = np.random.default_rng(4)
    for high in (3, 50, 10**6):
        held = [np.unique(rng.integers(0, high, n, dtype=np.uint64)) for n in (0, 1, 40, 300)]
        want = {k: n for k, n in Counter(np.concatenate(held).tolist()).items() if n > 1}
        items, times = jaccard_join.repeated_items(held)
        assert dict(zip(items.tolist(), times.tolist())) == want and held == []
