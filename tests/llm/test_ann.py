"""Operator 1: recall against brute force, ties, invalid vectors."""

import math

import numpy as np
import pytest

from pressloom.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def nearest(rows, query, k):
    """Exact nearest (id, distance) of one query among rows of another id."""
    q = np.array(query[1], np.float64)
    found = [(math.sqrt(((np.array(v, np.float64) - q) ** 2).sum()), i) for i, v in rows if i != query[0]]
    return sorted(found)[:k]


def test_chi_square_closed_form():
    # median of 8 degrees of freedom, and the 95 % quantile from a table
    assert ann.chi2_cdf(7.344) == pytest.approx(0.5, abs=1e-3)
    assert ann.chi2_cdf(15.507) == pytest.approx(0.95, abs=1e-4)
    assert ann.chi2_cdf(0) == 0 and ann.chi2_cdf(1e9) == 1


def test_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    out = ann.search(df, df.where("vec_id % 100 = 0"), block_rows=300).collect()
    hits = total = 0
    for q in (r for r in rows if r[0] % 100 == 0):
        exact = nearest(rows, q, 10)
        got = sorted((r["rank"], r.vec_id, r.score) for r in out if r.query_id == q[0])
        assert [g[0] for g in got] == list(range(1, len(exact) + 1))
        assert [(s, i) for _, i, s in got] == sorted((s, i) for _, i, s in got)
        by_id = {i: d for d, i in nearest(rows, q, len(rows))}
        assert all(by_id[i] == pytest.approx(s, rel=1e-12) for _, i, s in got)
        hits += len({i for _, i in exact} & {i for _, i, _ in got})
        total += len(exact)
    assert hits / total >= 0.95


def test_ties_go_to_the_smaller_id(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(500)], SCHEMA)
    out = ann.search(df, df.where("vec_id = 100"), k=5, block_rows=100).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in out] == [(i, 0.0) for i in range(5)]


def test_invalid_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (None, [1.0, 1.0]),
            (7, [1.0, 1.0]), (8, [1.0, 1.0, 1.0]), (9, [2.0, 0.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    out = ann.search(df, df).collect()
    assert {(r.query_id, r.vec_id) for r in out} == {(0, 7), (0, 9), (7, 0), (7, 9), (9, 0), (9, 7)}


def test_empty_tables_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0])], SCHEMA)
    assert ann.search(df.limit(0), df.limit(0)).count() == 0
    assert ann.search(df.limit(0), df).count() == 0
    assert [(r.query_id, r["rank"], r.vec_id) for r in ann.search(df, df.where("vec_id = 1")).orderBy("rank").collect()] == [(1, 1, 2), (1, 2, 2)]
