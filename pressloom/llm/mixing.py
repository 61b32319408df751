"""Mixing sources to target weights by soft membership (operator 7).

A classifier fitted on the labelled table gives every document a posterior over
the domains. Each document gets a rate >= 0 (how often it goes into the mixture);
rates are fitted by distributed projected-gradient least squares (steps
preconditioned by the Gram matrix of the documents that can still change), so that the
expected token total of every domain, sum of rate * tokens * posterior, meets its
target. Per pass only a few sums reach the driver.

DataFrame functions only.
"""

from __future__ import annotations

import logging
import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm.common import SPACES, maybe_among, stage, table

#: domains of the labelled table, in order: what each label row says
DOMAINS = ["clean", "toxic", "low"]
#: target share of each domain's tokens in the mixture of the registered query
SHARES = {"clean": 0.90, "toxic": 0.02, "low": 0.08}
FIT_DOCS = 20_000  # labelled documents that the classifier is fitted on, at most (those of the smallest hash)
EVIDENCE = 6.0  # standard deviations by which a word must be over-represented in a domain to be a feature
LIFT = 4.0  # and the times it must be more frequent there than elsewhere
TOP_FEATURES = 32  # features of a domain, at most
PASSES = 300  # over the documents, at most; a fit that ends there is logged as an error
TOLERANCE = 1e-3  # of the targets
OPTIMAL = 1e-6  # of the targets: what the condition of the least squares may be off
RIDGE = 1e-6  # weight of the rates' distance from 1, against the squared gaps
STEP_SIZES = (1.0, 0.3, 0.1, 0.01, 1e-3, 1e-5)  # tried in one pass


def label_domain() -> Column:
    """Domain number of a label row; null for labels that say nothing."""
    return (F.when(F.col("toxic") == 1, F.lit(1)).when(F.col("quality") == 0, F.lit(2)).when(F.col("quality") == 1, F.lit(0)))


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACES + "+"), lambda w: w != "")


def _features(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, feature) of the distinct words of each text; a feature is the hash of a word."""
    return docs.select(F.col(key).alias("_doc"), F.explode(F.array_distinct(words(F.col(text)))).alias("_word")).select(
        "_doc", F.xxhash64("_word").alias("_feature"))


def _columns(prefix: str) -> list[str]:
    return [f"{prefix}{i}" for i in range(len(DOMAINS))]


def fit_classifier(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, list[float]]:
    """(feature weights, log odds of a text without any feature) of a Bernoulli naive Bayes model.

    Fitted on at most ``FIT_DOCS`` labelled documents, those whose key has the smallest
    hash. A document with several labels takes the largest domain number; rows that
    repeat a key count each. Features: per domain the ``TOP_FEATURES`` words that are
    most over-represented there. Without labelled documents there are no features and
    all domains are equally likely.
    """
    picked = (labels.select(F.col("doc_id").alias("_id"), label_domain().alias("_domain")).dropna()
              .groupBy("_id").agg(F.max("_domain").alias("_domain")).orderBy(F.xxhash64("_id"), "_id").limit(FIT_DOCS))
    picked = F.broadcast(picked)  # FIT_DOCS rows of two numbers at most
    chosen = docs.join(picked, F.col(key) == F.col("_id"))
    found = {r["_domain"]: r["count"] for r in chosen.groupBy("_domain").count().collect()}  # a row per domain
    size = [found.get(i, 0) for i in range(len(DOMAINS))]
    whole = sum(size)
    seen = (_features(chosen, key, text).join(picked, F.col("_doc") == F.col("_id")).groupBy("_feature")
            .agg(*(F.sum((F.col("_domain") == i).cast("long")).alias(f"n{i}") for i in range(len(DOMAINS)))))
    n = sum((F.col(c) for c in _columns("n")[1:]), F.col("n0"))
    mean = n / max(whole, 1)
    theta = [(F.col(f"n{i}") + 0.5) / (size[i] + 1.0) for i in range(len(DOMAINS))]
    standing = []
    for i in range(len(DOMAINS)):
        rest = (n - F.col(f"n{i}") + 0.5) / (whole - size[i] + 1.0)
        z = (F.col(f"n{i}") - size[i] * mean) / F.sqrt(F.nullif(size[i] * mean * (1 - mean), F.lit(0.0)))
        standing.append(F.when((theta[i] >= LIFT * rest) & (z > EVIDENCE), z))
    weights = [F.log(t / (1 - t)).alias(f"w{i}") for i, t in enumerate(theta)]
    absent = [F.log(1 - t).alias(f"a{i}") for i, t in enumerate(theta)]
    scored = stage(seen.select("_feature", *weights, *absent, *(z.alias(f"z{i}") for i, z in enumerate(standing)))
                   .where(F.coalesce(*_columns("z")).isNotNull()), "mixing-features", narrow=True)
    best = [scored.where(F.col(z).isNotNull()).orderBy(F.desc(z), "_feature").limit(TOP_FEATURES) for z in _columns("z")]
    features = best[0]
    for b in best[1:]:
        features = features.unionByName(b)
    features = stage(features.dropDuplicates(["_feature"]), "mixing-chosen")
    none = features.agg(*(F.coalesce(F.sum(a), F.lit(0.0)).alias(a) for a in _columns("a"))).first()
    return features.select("_feature", *_columns("w")), [math.log((n + 1) / (whole + len(DOMAINS))) + a for n, a in zip(size, none)]


def posteriors(docs: DataFrame, weights: DataFrame, base: list[float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, p0 ...) of each distinct non-null key: words and posterior of every domain.

    Rows that repeat a key are one document with the features of all (the longest one
    gives its size). The texts don't move: words that are no feature fall away in a
    hash join where they are read.
    """
    scores = (_features(docs, key, text).join(F.broadcast(weights), "_feature")  # TOP_FEATURES rows a domain at most
              .dropDuplicates(["_doc", "_feature"]).groupBy("_doc").agg(*(F.sum(w).alias(f"s{w}") for w in _columns("w"))))
    sizes = (docs.where(F.col(key).isNotNull()).select(F.col(key).alias(key), F.size(words(F.col(text))).cast("long").alias("_n"))
             .groupBy(key).agg(F.max("_n").alias("n_tokens")))
    logits = [(F.coalesce(F.col(f"sw{i}"), F.lit(0.0)) + F.lit(b)).alias(f"l{i}") for i, b in enumerate(base)]
    joined = sizes.join(scores, F.col(key) == F.col("_doc"), "left").select(key, "n_tokens", *logits)
    top = F.greatest(*_columns("l"))
    parts = joined.select(key, "n_tokens", *(F.exp(F.col(f"l{i}") - top).alias(f"e{i}") for i in range(len(DOMAINS))))
    norm = sum((F.col(e) for e in _columns("e")[1:]), F.col("e0"))
    return parts.select(key, "n_tokens", *((F.col(f"e{i}") / norm).alias(f"p{i}") for i in range(len(DOMAINS))))


def domain_totals(members: DataFrame, rate: Column) -> list[float]:
    """Expected tokens of each domain at the given rates."""
    row = members.agg(*(F.coalesce(F.sum(rate * F.col("n_tokens") * F.col(p)), F.lit(0.0)).alias(p) for p in _columns("p"))).first()
    return [float(x) for x in row]


def fit_rates(members: DataFrame, targets: list[float], most: float | None = None) -> DataFrame:
    """``members`` (n_tokens, p0 ...) with ``rate`` >= 0 (and <= ``most``), the nearest to 1 that meet the targets.

    Minimises the sum over domains of (expected total - target)**2 / scale, plus RIDGE
    times the sum of tokens * (rate - 1)**2; with ``most`` all domains have one scale, so that
    no domain is brought down at the cost of more tokens of another. Documents count by their tokens, so that long
    and short documents of one posterior get one rate. At the minimum the rates are
    1 + posterior * x, projected on what is allowed, for one number x a domain. Each step
    moves x by the gaps, preconditioned by the Gram matrix of the documents whose rates
    aren't at a bound, as far as improves the dual objective most. Ends within
    ``TOLERANCE`` of every target, or where the condition of the minimum holds, since the
    targets can't all be met; the remaining gaps are logged then. Empty members give an
    empty result.
    """
    k = range(len(DOMAINS))
    pairs = [(i, j) for i in k for j in k if i <= j]
    goal = np.array(targets, float)
    unit = np.maximum(goal, 1.0)

    def rate_at(x: list[Column]) -> Column:
        free = sum((F.col(f"p{i}") * x[i] for i in k), F.lit(1.0))
        return F.greatest(F.lit(0.0), free) if most is None else F.greatest(F.lit(0.0), F.least(F.lit(float(most)), free))

    def sums(points: list[np.ndarray]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """At each point: what documents add to the dual objective, domain totals, Gram matrix of rates off the bounds."""
        tried = F.explode(F.array(*(F.struct(F.lit(n).alias("at"), *(F.lit(float(v)).alias(f"x{i}") for i, v in enumerate(x))) for n, x in enumerate(points))))
        at = members.select("n_tokens", *_columns("p"), tried.alias("t")).select("n_tokens", *_columns("p"), "t.*")
        at = at.withColumn("rate", rate_at([F.col(f"x{i}") for i in k])).withColumn("move", sum((F.col(f"p{i}") * F.col(f"x{i}") for i in k), F.lit(0.0)))
        inside = (F.col("move") > -1.0) & (F.lit(True) if most is None else F.col("move") <= F.lit(float(most) - 1.0))
        free = F.when(inside, F.col("n_tokens")).otherwise(F.lit(0))
        rows = {r["at"]: r for r in at.groupBy("at").agg(
            F.sum(F.col("n_tokens") * ((F.col("rate") - 1) * (F.col("rate") - 1) / 2 - F.col("move") * F.col("rate"))).alias("d"),
            *(F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p{i}")).alias(f"s{i}") for i in k),
            *(F.sum(free * F.col(f"p{i}") * F.col(f"p{j}")).alias(f"g{i}{j}") for i, j in pairs)).collect()}  # a row per point
        return [(float(r["d"]), np.array([r[f"s{i}"] for i in k], float), np.array([[r[f"g{min(i, j)}{max(i, j)}"] for j in k] for i in k], float))
                for _, r in sorted(rows.items())]

    x, tried, best = np.zeros(len(DOMAINS)), [np.zeros(len(DOMAINS))], -np.inf
    scale = totals = None
    for passes in range(1, PASSES + 1):
        found = sums(tried)
        if not found:  # no members
            break
        if scale is None:
            scale = np.where(np.diag(found[0][2]) > 0, np.diag(found[0][2]), 1.0)
            if most is not None:
                scale[:] = max(1.0, scale.min())
        value = [d + goal @ y - RIDGE / 2 * (scale @ (y * y)) for (d, _, _), y in zip(found, tried)]
        n = int(np.argmax(value))
        if not value[n] > best + 1e-13 * abs(value[n]):  # nothing is gained beyond rounding
            break
        best, x, (_, totals, gram) = value[n], tried[n], found[n]
        gap = goal - totals
        slope = gap - RIDGE * scale * x
        if (np.abs(gap) <= TOLERANCE * unit).all() or (np.abs(slope) <= OPTIMAL * unit).all():
            break
        step = np.linalg.solve(gram + np.diag(RIDGE * scale), slope)
        tried = [x + size * step for size in STEP_SIZES]
    else:
        logging.getLogger(__name__).error("rates not fitted in %d passes", PASSES)
    if totals is not None:
        missed = {d: f"{(t - g) / max(g, 1.0):+.4f}" for d, t, g in zip(DOMAINS, totals, goal) if abs(t - g) > TOLERANCE * max(g, 1.0)}
        (logging.getLogger(__name__).warning if missed else logging.getLogger(__name__).info)("rates after %d passes; targets missed by %s", passes, missed or "none")
    return members.withColumn("rate", rate_at([F.lit(float(v)) for v in x]))


def mix_rates(docs: DataFrame, labels: DataFrame, shares: dict[str, float], anchor: str | None = None, room: float = 1.0,
              keep: float | None = None) -> DataFrame:
    """(doc_id, n_tokens, p0 .. , rate) of every distinct non-null doc_id.

    ``shares``: the domains' shares of the mixture. Its size is that of the input; with
    ``anchor`` it is such that this domain gets ``room`` times its present tokens. With
    ``keep`` documents are only thinned out: no rate is above 1, and every domain but the
    anchor gets at most ``keep`` times its present tokens, whatever its share. If no word tells the domains apart, there is nothing to mix by, and all rates are 1.
    """
    weights, priors = fit_classifier(docs, labels)
    members = stage(posteriors(docs, weights, priors), "mixing-posteriors", narrow=True)
    if weights.limit(1).count() == 0:
        return members.withColumn("rate", F.lit(1.0))
    now = domain_totals(members, F.lit(1.0))
    whole = sum(now) if anchor is None else room * now[DOMAINS.index(anchor)] / shares[anchor]
    targets = [shares[d] * whole for d in DOMAINS]
    if keep is None:
        return fit_rates(members, targets)
    return fit_rates(members, [min(t, x if d == anchor else keep * x) for d, t, x in zip(DOMAINS, targets, now)], most=1.0)


def sample_by_rate(docs: DataFrame, rates: DataFrame, key: str = "doc_id", seed: int = 7) -> DataFrame:
    """``docs`` with each row taken rate times: the whole part always, the rest by a hash of the key.

    Rows whose key has no rate (null keys) are kept once. Columns stay as they are.
    """
    u = F.pmod(F.xxhash64(F.col("_key"), F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = F.floor("rate").cast("int") + (u < F.col("rate") - F.floor("rate")).cast("int")
    times = rates.select(F.col(key).alias("_key"), copies.alias("_copies")).where("_copies <> 1")
    marked = maybe_among(docs, F.xxhash64(F.col(key)), times.select(F.xxhash64("_key")))  # the others are taken once: their texts don't move
    joined = marked.where("_maybe").join(times, F.col(key) == F.col("_key"), "left").withColumn("_copies", F.coalesce("_copies", F.lit(1)))
    return marked.where("not _maybe").select(*(F.col(c) for c in docs.columns)).union(joined.where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*(F.col(c) for c in docs.columns)))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior and rate of every document, for the shares of ``SHARES``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rates = mix_rates(docs, table(spark, sf_dir, "labels"), SHARES)
    return rates.select("doc_id", "n_tokens", *(F.col(f"p{i}").alias(f"p_{d}") for i, d in enumerate(DOMAINS)), "rate")


QUERIES = {"op7_mixing": op7_mixing}
ORACLES: dict[str, str] = {}
