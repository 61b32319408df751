"""Credibility labels: build the dimension (E3), look links up (E1, E2, F5), admit them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.functions.urls import remove_prefix, site_key
from pressloom.operators.common import bounded_broadcast

HIGH, LOW, MIXED, ARCHIVE = "high", "low", "mixed", "archive"

# How a source's factual_reporting maps to a label (others are skipped).
HIGH_REPORTING = ["very high", "high"]
LOW_REPORTING = ["low", "insane stuff", "satire", "very low"]
MIXED_REPORTING = ["mixed"]
# Archive hosts, labelled after the sources so that they win.
ARCHIVE_HOSTS = ["archive.is", "archive.fo", "archive.today", "web.archive.org"]

_LAST = 9_223_372_036_854_775_807


def label_of_reporting(c) -> Column:
    fr = F.col(c) if isinstance(c, str) else c
    return (F.when(fr.isin(*MIXED_REPORTING), F.lit(MIXED))
            .when(fr.isin(*HIGH_REPORTING), F.lit(HIGH))
            .when(fr.isin(*LOW_REPORTING), F.lit(LOW)))


def build_label_dim(sources: DataFrame, order_col: str | None = "source_id") -> DataFrame:
    """``(key, label)``, one row per key.

    The key is ``remove_prefix(url)`` of the source url itself (no authority
    reduction, so a source url with a path never matches a host). Unmapped
    reporting values are skipped; among several rows of one key the one with the
    highest ``order_col`` wins (the last one read); archive hosts win over all.
    Without ``order_col`` the tie-break is the greatest label.
    """
    spark: SparkSession = sources.sparkSession
    prio = F.col(order_col).cast("long") if order_col else F.lit(0).cast("long")
    rows = (sources.select(remove_prefix(F.col("url")).alias("key"),
                           label_of_reporting("factual_reporting").alias("label"), prio.alias("prio"))
            .where(F.col("label").isNotNull() & F.col("key").isNotNull()))
    archive = spark.createDataFrame([(h, ARCHIVE, _LAST) for h in ARCHIVE_HOSTS], "key string, label string, prio long")
    both = rows.unionByName(archive)
    if order_col:
        return both.groupBy("key").agg(F.max_by("label", "prio").alias("label"))
    return both.groupBy("key").agg(F.max_by("label", F.struct("prio", "label")).alias("label"))


def label_lookup(links: DataFrame, dim: DataFrame, url_col: str = "url", out: str = "label") -> DataFrame:
    """Attach the label of each link's site key (left join; unknown -> null).

    The dimension is broadcast only when its row count is under the bound;
    otherwise this is a shuffle join on the key.
    """
    keyed = links.withColumn("_site_key", site_key(F.col(url_col)))
    d = bounded_broadcast(dim.select(F.col("key").alias("_site_key"), F.col("label").alias(out)))
    return keyed.join(d, "_site_key", "left").drop("_site_key")


def label_membership(links: DataFrame, dim: DataFrame, url_col: str = "url") -> DataFrame:
    """Links whose site key is a known label key (``url in labelled``)."""
    keyed = links.withColumn("_site_key", site_key(F.col(url_col)))
    d = bounded_broadcast(dim.select(F.col("key").alias("_site_key")))
    return keyed.join(d, "_site_key", "left_semi").drop("_site_key")


def label_keys(dim: DataFrame) -> DataFrame:
    """the known keys."""
    return dim.select("key").distinct()


def admission(label: Column, from_fake: Column, from_archive: Column) -> Column:
    """May a link with this label enter, given its feed's mark and archive origin?

    high -> not fake; low -> fake; mixed -> fake and archive;
    archive -> fake and not archive; no label -> false.
    """
    fake = F.coalesce(from_fake, F.lit(False))
    arch = F.coalesce(from_archive, F.lit(False))
    return F.coalesce(
        F.when(label == HIGH, ~fake)
        .when(label == LOW, fake)
        .when(label == MIXED, fake & arch)
        .otherwise((label == ARCHIVE) & fake & ~arch),
        F.lit(False))
