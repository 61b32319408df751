"""Link batches: merge (F1, J1-J3), admission filter (D2), forum and retry producers.

A link batch is ``link(batch_id, seq, url, scraped_from, fake)``; ``seq`` is the
position of the link inside its producer's output, ``batch_id`` the message
boundary (one feed round, one forum, one retry pass).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.functions.urls import forum_source_url
from pressloom.operators.common import bounded_broadcast
from pressloom.operators.labels import admission, label_lookup
from pressloom.sources.config import upsert_state
from pressloom.sources.tables import retry_predicate, top_posts

LINK_COLS = ["batch_id", "seq", "url", "scraped_from", "fake"]


def merge_links(links: DataFrame, keys: tuple[str, ...] = ("batch_id",), order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """one row per (batch, url): the first position and the last value.

    Merging dicts keeps a key where it first appeared but takes the newest
    value. ``order`` gives the position (one or more columns, compared in
    turn). Partial aggregation combines repeats map-side before the shuffle.
    """
    pos = F.struct(*order)
    return (links.groupBy(*keys, "url")
            .agg(F.min(pos).alias("_first"),
                 F.max_by(F.struct("scraped_from", "fake"), pos).alias("_v"))
            .select(*keys, *[F.col("_first")[c].alias(c) for c in order], "url", "_v.scraped_from", "_v.fake"))


def prefetch_filter(links: DataFrame, dim: DataFrame) -> DataFrame:
    """Keep links whose host label admits them as direct (not archived) links."""
    labelled = label_lookup(links, dim, "url", "_label")
    return labelled.where(admission(F.col("_label"), F.col("fake"), F.lit(False))).drop("_label")


def merge_batches(a: DataFrame, b: DataFrame) -> DataFrame:
    """``a + b`` for links of one batch: union then F1.

    Positions are ``(part, seq)`` with ``a`` as part 0 and ``b`` as part 1, so
    a url keeps the place where it was first seen and takes ``b``'s value.
    """
    both = (a.select(*LINK_COLS).withColumn("part", F.lit(0))
            .unionByName(b.select(*LINK_COLS).withColumn("part", F.lit(1))))
    return merge_links(both, ("batch_id",), ("part", "seq"))


def merge_batch_errors(a: DataFrame, b: DataFrame) -> DataFrame:
    """J1 for errors: those of ``b`` and ``a`` together, repeats kept."""
    return b.unionByName(a)


def merge_batch_states(a: DataFrame, b: DataFrame) -> DataFrame:
    """J1 for states ``(name, is_over, data)``: a collector's state in ``b`` replaces the one in ``a``."""
    return upsert_state(a, b)


def union_collectors(site_links: DataFrame | None, forum_links: DataFrame | None) -> DataFrame:
    """Site feeds then forums feed one link stream, in that order (either may be absent).

    Both inputs carry a string ``batch_key`` (feed round or forum name).
    """
    parts = [d.select("batch_key", "seq", "url", "scraped_from", "fake").withColumn("producer", F.lit(i))
             for i, d in enumerate([site_links, forum_links]) if d is not None]
    if not parts:
        raise ValueError("no sources to begin with")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def external_posts(posts: DataFrame) -> DataFrame:
    """Posts that link outside the forum (Python ``!=``: two-valued, null-safe)."""
    return posts.where(~F.col("url").eqNullSafe(F.col("permalink")))


def posts_per_forum(posts: DataFrame) -> DataFrame:
    """posts emitted per forum (counted before url de-dup), as finished collector state."""
    return posts.groupBy("sub").agg(F.count(F.lit(1)).alias("posts")).select(
        F.col("sub").alias("name"), F.lit(True).alias("is_over"), F.col("posts").cast("long").alias("posts"))


def forum_links(posts: DataFrame, subs: DataFrame, num_posts: int, as_of: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """Top posts (A6) -> external (D11) -> links tagged with the forum page and fake mark.

    ``subs(sub, fake)`` is the forum configuration. Returns ``(links, state)``;
    one batch per forum (``batch_id`` = forum rank in name order is left to the
    caller; here the batch key is the forum name itself).
    """
    top = external_posts(top_posts(posts, num_posts, as_of, subs))
    marked = top.join(bounded_broadcast(subs.select("sub", "fake")), "sub")
    links = marked.select(F.col("sub").alias("batch_key"), F.col("rank").alias("seq"), "url",
                          forum_source_url("sub").alias("scraped_from"), "fake")
    merged = (links.groupBy("batch_key", "url")
              .agg(F.min("seq").alias("seq"), F.max_by(F.struct("scraped_from", "fake"), "seq").alias("_v"))
              .select("batch_key", "seq", "url", "_v.scraped_from", "_v.fake"))
    return merged, posts_per_forum(top)


def retry_links(errors: DataFrame, fake: bool, order_col: str = "seq") -> DataFrame:
    """I8: stored errors worth a retry (A5) -> links ``(url, source_article, from_fake)``; last row per url wins."""
    cand = errors.where(retry_predicate(fake))
    links = cand.select(F.col(order_col).alias("seq"), "url",
                        F.col("source_article").alias("scraped_from"), F.col("from_fake").alias("fake"))
    return merge_links(links.withColumn("batch_id", F.lit(0 if fake else 1).cast("long")))


def union_retry(errors: DataFrame, order_col: str = "seq") -> DataFrame:
    """Retry batch for fake=True (batch 0) then fake=False (batch 1); timeouts are in both."""
    return retry_links(errors, True, order_col).unionByName(retry_links(errors, False, order_col))


def batch_counts(links: DataFrame, keys: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """rows per batch."""
    return links.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
