"""Which urls a store holds, without reading them all (B1).

Beside the article table lies a table of Bloom blocks: urls are hashed to blocks of 512 bits,
and every run and batch adds a row per block that its urls touch, in partitions of the same names. A
batch's urls are joined with the blocks by number; where all of a url's bits are set, that run and
batch may hold it, and only the touched partitions of the article table are read for the exact check.
The blocks take about 4 bytes a url (URL_BLOCKS for 16 million urls; more urls only give more
false hits, which cost reading, not results).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.operators.common import FILTER_WORDS, filter_mask

URL_BLOCKS = 1 << 20
PARTITIONS = [T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType())]
WORDS = [f"w{i}" for i in range(FILTER_WORDS)]
SCHEMA = T.StructType([T.StructField("block", T.LongType()), *(T.StructField(w, T.LongType()) for w in WORDS), *PARTITIONS])


def index_path(articles: str) -> str:
    return f"{articles.rstrip('/')}_urls/blocks={URL_BLOCKS}"


def _block(url: str) -> Column:
    return F.pmod(F.xxhash64(F.col(url)), F.lit(URL_BLOCKS))


def blocks_of(rows: DataFrame) -> DataFrame:
    """The Bloom blocks of rows with url, run_id and batch_id."""
    return rows.where(F.col("url").isNotNull()).groupBy(_block("url").alias("block"), "run_id", "batch_id").agg(
        *(F.bit_or(filter_mask("url", i)).alias(w) for i, w in enumerate(WORDS))).select(*SCHEMA.names)


def extend(rows: DataFrame, articles: str) -> None:
    """Adds the urls of a run's batches; doing a batch again replaces its blocks. To be done before the rows are stored:
    blocks of rows that were not stored are false hits, rows without blocks would be missed."""
    blocks_of(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "batch_id").parquet(index_path(articles))


def touched(spark: SparkSession, articles: str, urls: DataFrame, others: Column) -> DataFrame:
    """``(run_id, batch_id)`` of the partitions that may hold one of ``urls`` (column ``url``), of those that satisfy ``others``."""
    probes = urls.select(_block("url").alias("_block"), *(filter_mask("url", i).alias(f"m{i}") for i in range(FILTER_WORDS)))
    blocks = spark.read.schema(SCHEMA).parquet(index_path(articles)).where(others)
    hit = F.lit(True)
    for i, w in enumerate(WORDS):
        hit = hit & (F.col(w).bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}"))
    return blocks.join(probes, F.col("block") == F.col("_block")).where(hit).select("run_id", "batch_id").distinct()


def held_urls(spark: SparkSession, articles: str, stored: DataFrame, urls: DataFrame, others: Column) -> DataFrame:
    """Those of the distinct ``urls`` that partitions of the article table ``stored`` hold, of the partitions that satisfy ``others``.

    Partitions that aren't touched aren't read. The driver lists the partitions of the table in any case, so it may hold the touched ones.
    """
    where = touched(spark, articles, urls, others).collect()
    by_run: dict[str, list[int]] = {}
    for r in where:
        by_run.setdefault(r.run_id, []).append(r.batch_id)
    hit = F.lit(False)
    for run_id, batches in by_run.items():
        hit = hit | ((F.col("run_id") == run_id) & F.col("batch_id").isin(batches))
    return stored.where(hit).select("url").join(urls.select("url"), "url", "left_semi").distinct()
