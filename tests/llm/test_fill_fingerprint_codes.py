"""Operators 11 to 13 against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressloom.llm import fill_middle as fm
from pressloom.llm import fingerprint as fp
from pressloom.llm import vector_codes as vc

SF = "/root/testdata/sf0.01"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- 11: fill in the middle

def plain_fill(key, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, digest = len(units), hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


FILL_TEXTS = [None, "", "\n", "\n\n\n", "one line", "two\nlines", "ends\n", "é漢😀\n\n😀é\nx" * 50, "a<P>b\nc", "a<S", "<\n<M\n<P\n>", "<S\n<P<\nP>\n",
              "\r\nwindows\r\n", "x" * 100_000 + "\n" + "y\n" * 5_000, "tail <P\n<S\n<M\n" * 9, "\0\n\0"]


def test_fill_middle_equals_plain_version(spark):
    rng = random.Random(3)
    texts = FILL_TEXTS + ["".join(rng.choices("ab \n<PSM>é", k=rng.randint(1, 60))) for _ in range(300)]
    rows = [(i * 37 - 50, t, "kept", 1) for i, t in enumerate(texts)] + [(None, "no\nid\n", None, 2)] + [(5, "twice\nthe\nsame", "x", 3)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, other string, Form int")  # a clashing column is replaced
    out = fm.fill_middle(df)
    assert out.columns == ["doc_id", "text", "other", *fm.RESULT.names]
    got = out.withColumn("back", fm.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: repr((r[0], r[1]))
    assert [(r.doc_id, r.text, r.other) for r in sorted(got, key=key)] == [r[:3] for r in sorted(rows, key=key)]
    for r in got:
        assert (r.n_units, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_fill(r.doc_id, r.text)
        assert r.back == (r.text or "")
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fm.fill_middle(df.limit(0)).collect() == []


def test_rank_index_is_exact_and_bounded():
    rng = np.random.default_rng(1)
    for lengths in ([], [1], [5] * 10_000, rng.integers(1, 400, 5_000), np.where(rng.random(3_000) < 0.01, 100_000, 1), [3_000_000_000, 1, 1]):
        offsets = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64))]).astype(np.int64)
        index = fm.RankIndex(offsets)
        assert (index.offsets(np.arange(len(offsets))) == offsets).all()
        assert np.abs(index.residuals).max() <= fm.BOUND + 1
    assert len(fm.RankIndex(np.arange(0, 50_000, 5)).starts) == 1  # lines of one length take one segment


def test_rates(spark):
    df = spark.range(2000).selectExpr("id as doc_id", "concat(id, '\\nb\\nc') as text")
    forms = Counter(r.form for r in fm.fill_middle(df, rate=30, spm_rate=10).collect())
    assert 480 < forms["psm"] + forms["spm"] < 720 and forms["spm"] < forms["psm"] / 5


def test_fill_middle_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {r.doc_id: plain_fill(r.doc_id, r.text) for r in docs}
    got = fm.op11_fill_middle(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        n, form, p, m, output = want[r.doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256) == (n, form, p, m, sha(output))
    texts = {r.doc_id: sha(r.text or "") for r in docs}
    assert all(r.restored_sha256 == texts[r.doc_id] for r in got)


# --- 12: fingerprints

def plain_digest(text):
    """Length code and bucket codes, by a loop over the bytes."""
    data, m32 = text.encode(), 0xFFFFFFFF
    padded, counts = data + bytes(fp.GAPS[1]), [0] * fp.BUCKETS
    m = [int(x) for x in fp._MIX]
    for i in range(len(data)):
        h = (padded[i] * m[0] + padded[i + 5] * m[1] + padded[i + 10] * m[2]) & m32
        h = ((h ^ (h >> 15)) * m[3]) & m32
        h = ((h ^ (h >> 12)) * m[4]) & m32
        counts[h >> 24] += 1
    s = sorted(counts)
    codes = [sum(c > s[q] for q in (63, 127, 191)) for c in counts]
    return min(255, round(8 * math.log2(len(data) + 1))), codes


def plain_likeness(a, b):
    return 1 - (sum(abs(x - y) for x, y in zip(a[1], b[1])) + 4 * min(32, abs(a[0] - b[0]))) / (3 * 256 + 4 * 32)


def as_string(d):
    return f"{d[0]:02x}" + bytes(sum(c << 2 * j for j, c in enumerate(d[1][i:i + 4])) for i in range(0, 256, 4)).hex()


def plain_edits(rows):
    """(id, n, edited, fingerprint, edited fingerprint, near edited, near next) of (id, text) rows in their order."""
    out = []
    for i, (k, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1] or ""
        t = t or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        a, b, c = plain_digest(t), plain_digest(edited), plain_digest(after)
        out.append((k, len(t), sha(edited), as_string(a), as_string(b), plain_likeness(a, b), plain_likeness(a, c)))
    return out


def fields(r):
    return (r.key, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)


def test_digest_equals_plain_version_and_chunks_join(monkeypatch):
    rng = random.Random(5)
    texts = ["", "a", "short", "é漢😀", "x" * 3000, "".join(rng.choices("abcdef ", k=4000))]
    whole = [fp.digest(t.encode()) for t in texts]
    for t, d in zip(texts, whole):
        assert (d.length, d.codes.tolist()) == plain_digest(t)
        back = fp.parse(str(d))
        assert str(d) == as_string(plain_digest(t)) and (back.length, back.codes.tolist()) == (d.length, d.codes.tolist())
    monkeypatch.setattr(fp, "CHUNK", 7)
    assert [str(fp.digest(t.encode())) for t in texts] == [str(d) for d in whole]
    far = fp.Digest(0, np.zeros(256, np.uint8)), fp.Digest(255, np.full(256, 3, np.uint8))
    assert fp.likeness(*far) == 0 and fp.likeness(far[1], far[1]) == 1


@pytest.mark.parametrize("partitions", [1, 7])
def test_edits_over_task_borders(spark, partitions):
    rng = random.Random(9)
    words = "alpha beta gamma delta é漢😀 omega".split()
    rows = [(i * 3, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(60)] + [(400, None), (401, ""), (402, "x"), (403, "long " * 30_000)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    df = spark.createDataFrame([(k, t, "q") for k, t in shuffled], "doc_id long, text string, fingerprint string").repartition(partitions)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = [fields(r) for r in fp.edit_fingerprints(df).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert sorted(got) == sorted(plain_edits(rows))


def test_edits_of_odd_tables(spark):
    schema = "doc_id long, text string"
    assert fp.edit_fingerprints(spark.createDataFrame([], schema)).collect() == []
    one = fp.edit_fingerprints(spark.createDataFrame([(4, "only one")], schema)).collect()
    assert [fields(r) for r in one] == plain_edits([(4, "only one")])
    rows = [(None, "null id"), (1, "same row"), (1, "same row"), (2, "z")]  # null ids first, repeated rows follow each other
    got = fp.edit_fingerprints(spark.createDataFrame(rows[::-1], schema)).collect()
    assert sorted(map(repr, map(fields, got))) == sorted(map(repr, plain_edits(rows)))
    assert all(r.near_next == 1.0 for r in got if r.n_chars == 8 and r.near_edited == 1.0)


def test_fingerprints_column(spark):
    df = spark.createDataFrame([(1, "a b c", 0), (2, "a b c", 0), (3, None, 0), (4, "", 0)], "doc_id long, text string, Fingerprint int")
    out = fp.fingerprints(df)
    assert out.columns == ["doc_id", "text", "fingerprint"]
    got = {r.doc_id: r.fingerprint for r in out.collect()}
    assert got[1] == got[2] == as_string(plain_digest("a b c")) and got[3] == got[4] == as_string(plain_digest(""))


def test_fingerprint_query_tells_edits_from_neighbours(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = sorted(fp.op12_fingerprint(spark, SF).collect())
    want = {k: (len(t), sha(t[:len(t) - len(t) // 2] + docs[(i + 1) % len(docs)][1][:len(t) // 2])) for i, (k, t) in enumerate(docs)}
    assert [(r.doc_id, r.n_chars, r.edited_sha256) for r in got] == [(k, *want[k]) for k, _ in docs]
    assert sum(r.near_edited > r.near_next for r in got) >= 0.99 * len(got)


# --- 13: vector codes

def plain_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    """{position: (code, error)}, label sums and codebooks of (key, vector, label) rows, in Python integers."""
    kept = [(k, [math.floor(scale * x) for x in v], g) for k, v, g in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts if kept else 0
    cut = lambda v, p: v[p * width:(p + 1) * width]
    first = sorted((k, v) for k, v, _ in kept if k is not None)[:entries]
    books = [[cut(v, p) for _, v in first] for p in range(parts)]

    def nearest(book, x):
        away = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book]
        return away.index(min(away)), min(away)

    for _ in range(rounds):
        for p, book in enumerate(books):
            met = {}
            for _, v, _ in kept:
                met.setdefault(nearest(book, cut(v, p))[0], []).append(cut(v, p))
            for e, xs in met.items():
                book[e] = [sum(c) // len(xs) for c in zip(*xs)]
    out, by_label = [], Counter()
    for k, v, g in kept:
        found = [nearest(book, cut(v, p)) for p, book in enumerate(books)]
        out.append((k, "".join(f"{i:02x}" for i, _ in found), sum(d for _, d in found), g))
        by_label[g] += out[-1][2]
    return [(k, c, e, by_label[g]) for k, c, e, g in out], books


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("scale", [1, 900.0])
def test_codes_equal_plain_version(spark, scale):
    rng = random.Random(2)
    nan, inf = float("nan"), float("inf")
    vector = lambda: [float(np.float32(rng.choice([rng.gauss(0, 1), 0.5, -0.25]) * scale)) for _ in range(8)]
    rows = [(i, vector(), rng.choice([1, 2, None])) for i in range(120)]
    rows += [(7, rows[7][1], 1), (7, vector(), 2), (None, vector(), 1), (500, None, 1), (501, [nan] * 8, 1), (502, [1.0] * 7 + [inf], 1), (503, [None] * 8, 1)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", code string, Error int").repartition(5)
    out, books = vc.product_codes(df, entries=16)
    want, plain_books = plain_codes(rows, entries=16)
    assert [b.tolist() for b in books] == plain_books
    assert sorted(map(repr, ((r.key, r.code, r.error, r.label_error) for r in out.collect()))) == sorted(map(repr, want))


def test_codes_of_odd_tables(spark):
    out, books = vc.product_codes(spark.createDataFrame([], SCHEMA))
    assert out.collect() == [] and vc.codebooks_sha256(books) == hashlib.sha256(b"").hexdigest()
    out, _ = vc.product_codes(spark.createDataFrame([(None, [1.0, 2.0, 3.0, 4.0], 1)], SCHEMA))
    assert [tuple(r) for r in out.collect()] == [(None, 1, None, None, None)]
    same, books = vc.product_codes(spark.createDataFrame([(i, [0.5] * 4, None) for i in range(300)], SCHEMA))
    assert {(r.code, r.error, r.label_error) for r in same.collect()} == {("00000000", 0, 0)} and all(len(b) == 256 for b in books)
    for bad in ([(1, [1.0] * 4, 1), (2, [1.0] * 8, 1)], [(1, [1.0] * 6, 1)], [(1, [1e30] * 4, 1)]):
        with pytest.raises(ValueError):
            vc.product_codes(spark.createDataFrame(bad, SCHEMA))


def test_limbs_and_products_are_exact():
    rng = np.random.default_rng(4)
    for width, size in ((1, 1 << 30), (16, 1 << 28), (16, 1000), (300, 1 << 26)):
        a, b = rng.integers(-size, size, (20, width)), rng.integers(-size, size, (7, width))
        a[0], b[0] = size, -size
        bits = vc.limb_bits(width)
        assert width * (1 << 2 * bits) <= 1 << 53
        pieces = vc.limbs(a, bits)
        assert (sum(x.astype(np.int64) << (bits * i) for i, x in enumerate(pieces)) == a).all()
        assert all(np.abs(x).max() <= 1 << bits for x in pieces)
        assert vc.exact_dot(pieces, vc.limbs(b, bits), bits).tolist() == [[sum(x * y for x, y in zip(r, c)) for c in b.tolist()] for r in a.tolist()]
    # many limbs: shorter ones than needed give the same products
    assert vc.exact_dot(vc.limbs(a, 5), vc.limbs(b, 5), 5).tolist() == (a @ b.T).tolist()


def test_label_totals_join_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(vc, "BROADCAST_BYTES", 0)
    rows = [(i, [float(i % 7), 1.0, float(i % 3), 0.0], [1, None][i % 2]) for i in range(40)]
    out, _ = vc.product_codes(spark.createDataFrame(rows, SCHEMA), entries=3)
    assert sorted(map(repr, ((r.key, r.code, r.error, r.label_error) for r in out.collect()))) == sorted(map(repr, plain_codes(rows, entries=3)[0]))


def test_vector_codes_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, books = plain_codes(rows)
    got = vc.op13_vector_codes(spark, SF).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == sorted(want)
    assert {r.codebooks_sha256 for r in got} == {hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()}
