"""Job configuration and saved progress.

The config file holds ``backup``, ``sources`` (feeds), ``rules`` and ``reddit``
(forums); the state file maps a collector name to ``{is_over, data}``. Both are
read by Spark with explicit schemas; a missing state file means no state. A document
that can't be read as its schema stops the job, with its text in the error.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.schemas import CONFIG_SCHEMA, FEED_SCHEMA, STATE_FILE_TYPE, STATE_SCHEMA

FEED_COLUMNS = ["name", "url", "sel", "stop_after", "fake_news", "condition"]
# and ``position``: the feed's place in the configuration, which is the order in which feeds give their links


def _strip_bom(c: Column) -> Column:
    return F.regexp_replace(c, "^﻿", "")


def _parsed(text: Column, schema, what: str) -> Column:
    """``text`` as its schema. One that isn't JSON raises an error that shows it, one of other types an error of the parser; blank gives null."""
    doc = _strip_bom(text)
    refused = F.raise_error(F.concat(F.lit(f"{what} can't be read: "), F.substring(doc, 1, 200)))
    return (F.when(F.coalesce(F.trim(doc), F.lit("")) == "", F.lit(None))
            .when(F.try_parse_json(doc).isNull(), refused).otherwise(F.from_json(doc, schema, {"mode": "FAILFAST"})))


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """The whole config document (one row), BOM tolerated."""
    text = spark.read.text(path, wholetext=True).select(_strip_bom(F.col("value")).alias("value"))
    return text.select(_parsed(F.col("value"), CONFIG_SCHEMA, "configuration").alias("c")).select("c.*")


def feeds_from_config(config: DataFrame) -> DataFrame:
    """A2: one row per configured feed, with its position; the ``type`` key is ignored."""
    return config.select(F.posexplode("sources").alias("position", "s")).select(
        *[F.col("s." + c).alias(c) for c in FEED_COLUMNS], F.col("position").cast("long").alias("position"))


def parse_feed_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """A2 for one JSON feed object per line (or per row)."""
    f = _parsed(F.col(col), FEED_SCHEMA, "feed").alias("s")
    return lines.select(f).select(*[F.col("s." + c).alias(c) for c in FEED_COLUMNS])


def require_feeds(feeds: DataFrame) -> DataFrame:
    """None left -> ``ValueError('No scrapers found')`` (a one-row probe, not a full count)."""
    if feeds.isEmpty():
        raise ValueError("No scrapers found")
    return feeds


def parse_state(docs: DataFrame, col: str = "value") -> DataFrame:
    """A3 / C4 unpack: state documents ``{name: {is_over, data}}`` -> ``(name, is_over, data)``."""
    m = _parsed(F.col(col), STATE_FILE_TYPE, "state file")
    return docs.select(F.explode(m).alias("name", "v")).select("name", "v.is_over", "v.data")


def read_state(spark: SparkSession, path: str | None) -> DataFrame:
    """A3: saved progress; a missing path gives an empty frame with the state schema."""
    if path:
        try:
            return parse_state(spark.read.text(path, wholetext=True))
        except AnalysisException:  # path does not exist
            pass
    return spark.createDataFrame([], STATE_SCHEMA)


def pack_state(name: Column, is_over: Column, url: Column | None = None, page: Column | None = None,
               posts: Column | None = None) -> Column:
    """C4 pack: ``struct(name, is_over, data struct(url, page, posts))``."""
    none_s, none_l = F.lit(None).cast("string"), F.lit(None).cast("long")
    data = F.struct((url if url is not None else none_s).alias("url"),
                    (page if page is not None else none_l).cast("long").alias("page"),
                    (posts if posts is not None else none_l).cast("long").alias("posts"))
    return F.struct(name.alias("name"), is_over.alias("is_over"), data.alias("data"))


def state_to_json(states: DataFrame) -> DataFrame:
    """One ``{name: {is_over, data}}`` document per state row (the file format, line by line)."""
    return states.select(F.to_json(F.create_map(
        F.col("name"), F.struct("is_over", F.col("data")))).alias("value"))


def resume_feeds(feeds: DataFrame, state: DataFrame) -> DataFrame:
    """E7 + D12: saved state overrides ``url`` and ``stop_after``; collectors that are over are dropped."""
    s = state.select(F.col("name").alias("_n"), F.col("is_over").alias("_over"),
                     F.col("data.url").alias("_url"), F.col("data.page").alias("_page"))
    j = feeds.join(s, feeds["name"] == s["_n"], "left")
    return (j.where(~F.coalesce(F.col("_over"), F.lit(False)))
            .withColumn("url", F.coalesce(F.col("_url"), F.col("url")))
            .withColumn("stop_after", F.coalesce(F.col("_page"), F.col("stop_after")))
            .drop("_n", "_over", "_url", "_page"))


def resume_filter(feeds: DataFrame, state: DataFrame) -> DataFrame:
    """Collectors whose saved state says they are over are left out."""
    over = state.where(F.col("is_over")).select(F.col("name").alias("_n"))
    return feeds.join(over, feeds["name"] == over["_n"], "left_anti")


def upsert_state(old: DataFrame, new: DataFrame) -> DataFrame:
    """Merge new states over old ones by name (new wins); write the result to a new version."""
    keep = old.join(new.select(F.col("name").alias("_n")), old["name"] == F.col("_n"), "left_anti").drop("_n")
    return keep.select("name", "is_over", "data").unionByName(new.select("name", "is_over", "data"))
