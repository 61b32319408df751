"""Operator 7: held-out accuracy, targets, projected gradient against a plain version."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressloom.llm import mixing


def plain_rates(tokens, p, targets, steps=4000):
    """Projected gradient with a tiny step, in the metric that weighs a document by its tokens."""
    gram = (tokens[:, None] * p).T @ p
    scale = np.where(np.diag(gram) > 0, np.diag(gram), 1.0)
    rate = np.ones(len(tokens))
    for _ in range(steps):
        gap = np.array(targets) - (rate * tokens) @ p
        rate = np.maximum(0, rate + 0.2 * p @ (gap / scale))
    return rate


def members(spark, n=300):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.2, 0.2, 0.2], n)
    tokens = rng.integers(1, 500, n)
    rows = [(i, int(t), *map(float, x)) for i, (t, x) in enumerate(zip(tokens, p))]
    return spark.createDataFrame(rows, "doc_id long, n_tokens long, p0 double, p1 double, p2 double"), tokens.astype(float), p


def test_rates_meet_the_targets(spark):
    df, tokens, p = members(spark)
    targets = [1.3 * (tokens @ p)[0], 0.2 * (tokens @ p)[1], 0.9 * (tokens @ p)[2]]
    out = mixing.fit_rates(df, targets).orderBy("doc_id").collect()
    rate = np.array([r.rate for r in out])
    assert (rate >= 0).all() and (rate == 0).any()
    assert ((rate * tokens) @ p) == pytest.approx(targets, rel=2e-3)
    assert np.abs((plain_rates(tokens, p, targets) * tokens) @ p / targets - 1).max() < 2e-3


def least_squares(tokens, p, targets, most, steps=20_000):
    """Accelerated projected gradient on gaps in tokens, run until it is still: the domains' totals."""
    gram = (tokens[:, None] * p).T @ p
    scale = np.ones(3)
    step = 1 / np.linalg.eigvalsh(gram / np.sqrt(np.outer(scale, scale))).max()
    rate = ahead = np.ones(len(tokens))
    for k in range(steps):
        new = np.clip(ahead + step * p @ ((np.array(targets) - (ahead * tokens) @ p) / scale), 0, most)
        ahead = new + k / (k + 3) * (new - rate)
        rate = new
    return (rate * tokens) @ p


@pytest.mark.parametrize("most", [None, 1.0])
def test_rates_of_rare_domains_are_fitted_to_the_end(spark, most):
    """Shares of the pipeline: 60 steps of the plain gradient ended far above the target of the toxic domain."""
    rng = np.random.default_rng(8)
    weights = np.full((3000, 3), 0.03)
    weights[np.arange(3000), np.r_[np.zeros(2700, int), np.ones(150, int), np.full(150, 2)]] = 1.0
    p = rng.gamma(weights) + 1e-12
    p /= p.sum(1, keepdims=True)
    tokens = rng.integers(50, 500, 3000)
    rows = [(i, int(t), *map(float, x)) for i, (t, x) in enumerate(zip(tokens, p))]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long, p0 double, p1 double, p2 double")
    now = tokens @ p
    targets = [now[0], 0.002 * now[0], 0.005 * now[0]]
    got = mixing.fit_rates(df, targets, most)
    totals = np.array(mixing.domain_totals(got, F.col("rate")))
    rates = [r.rate for r in got.collect()]
    assert min(rates) >= 0 and max(rates) <= (most or np.inf)
    if most is None:
        assert totals == pytest.approx(targets, rel=1.01e-3)
    else:  # the targets can't all be met
        plain = least_squares(tokens.astype(float), p, targets, most)
        cost = lambda x: float(((x - targets) ** 2).sum())
        assert cost(totals) <= 1.01 * cost(plain) and abs(totals - plain).max() < 1e-3 * now[0]


def test_targets_that_cannot_be_met_and_nothing(spark):
    df, *_ = members(spark, 5)
    assert mixing.fit_rates(df.limit(0), [1.0, 1.0, 1.0]).count() == 0
    none = df.withColumns({"p0": F.lit(1.0), "p1": F.lit(0.0), "p2": F.lit(0.0)})
    rates = {round(r.rate, 3) for r in mixing.fit_rates(none, [0.0, 50.0, 0.0]).collect()}
    assert rates == {0.0}


def test_posteriors_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4)) == 0
    weights, base = mixing.fit_classifier(docs, labels.where(~held))
    scored = mixing.posteriors(docs.join(labels.where(held), "doc_id", "left_semi"), weights, base).join(labels.where("quality = 1"), "doc_id")
    rows = scored.select("p1", "toxic").collect()
    clean, toxic = [r.p1 for r in rows if r.toxic == 0], [r.p1 for r in rows if r.toxic == 1]
    assert sum(x > 0.5 for x in clean) <= 0.01 * len(clean)
    assert sum(x > 0.5 for x in toxic) >= 0.75 * len(toxic)


def test_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "good words here"), (1, "good"), (None, "x"), (2, None), (3, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 0, 1), (99, 0, 0)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in mixing.mix_rates(docs, labels, mixing.SHARES).collect()}
    assert set(out) == {1, 2, 3} and out[1].n_tokens == 3 and out[2].n_tokens == 0
    assert all(abs(r.p0 + r.p1 + r.p2 - 1) < 1e-9 and r.rate >= 0 for r in out.values())
    assert {round(r.p0, 6) for r in mixing.mix_rates(docs, labels.limit(0), mixing.SHARES).collect()} == {round(1 / 3, 6)}
    assert mixing.mix_rates(docs.limit(0), labels, mixing.SHARES).count() == 0


def test_sampling_by_rate(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit(1).alias("rate"))
    docs = docs.union(spark.createDataFrame([(None, "n", 1)], "doc_id long, text string, rate int"))
    rates = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 4 * 0.75).alias("rate"))
    out = mixing.sample_by_rate(docs, rates)
    assert out.columns == docs.columns and out.where("doc_id is null").count() == 1
    by = {r.k: r["count"] for r in out.where("doc_id is not null").groupBy((F.col("doc_id") % 4).alias("k")).count().collect()}
    assert 0 not in by and all(abs(by[k] - 750 * k) < 90 for k in (1, 2, 3))
    assert sorted(r.doc_id for r in out.where("doc_id < 9").collect()) == sorted(r.doc_id for r in mixing.sample_by_rate(docs, rates).where("doc_id < 9").collect())
