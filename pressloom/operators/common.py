"""Shared plan helpers: size-checked broadcast, skew-safe numbering, lineage cuts."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from pressloom.session import checkpoint_dir

# Largest dimension (rows) that is shipped to every task instead of shuffled.
BROADCAST_MAX_ROWS = 2_000_000


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` only when ``df`` provably has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows (a bounded job). Above the bound
    the frame is returned as is, and the join falls back to a shuffle join
    (which AQE can still turn into a broadcast at run time, by actual size).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


#: words of 64 bits in a block of a url filter, and blocks that are sent to every task at most (9 numbers each)
FILTER_WORDS, FILTER_MAX_BLOCKS = 8, 100_000


def filter_mask(url: str, word: int) -> Column:
    """The bit that a url sets in a word of its block."""
    return F.expr(f"shiftleft(1L, cast(shiftright(xxhash64({url}, 1L), {6 * word}) & 63 as int))")


def only_known_urls(df: DataFrame, url: str, urls: DataFrame, known: str) -> DataFrame:
    """Rows of ``df`` whose url is in ``urls`` (column ``known``), and a few others: run before a join by url.

    So that wide rows that can't match (pages with their html) don't travel. A blocked
    Bloom filter of the urls, as a table of bounded size, is sent to where the rows are
    read; with more urls than it is made for, more rows pass. The exact join follows.
    """
    keys = urls.select(F.col(known).alias("_k")).where(F.col(known).isNotNull()).distinct()
    n_blocks = min(FILTER_MAX_BLOCKS, max(1, keys.count() // (4 * FILTER_WORDS)))  # 16 bits a url
    block = lambda c: F.pmod(F.xxhash64(F.col(c)), F.lit(n_blocks))
    blocks = keys.groupBy(block("_k").alias("_block")).agg(*(F.bit_or(filter_mask("_k", i)).alias(f"_w{i}") for i in range(FILTER_WORDS)))
    hit = F.lit(True)
    for i in range(FILTER_WORDS):
        hit = hit & (F.col(f"_w{i}").bitwiseAND(filter_mask(url, i)) != 0)
    probed = df.withColumn("_probe", block(url)).join(F.broadcast(blocks), F.col("_probe") == F.col("_block"))
    return probed.where(hit).select(*df.columns)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared ``spark.checkpoint.dir`` (never localCheckpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staging_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder (never a machine-local one on a cluster); see ``dropping_staged``."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/pressloom-{name}-{uuid.uuid4().hex[:12]}"
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Like a checkpoint it fixes the rows and cuts the lineage; unlike one, later
    readers prune columns and row groups. See ``dropping_staged`` for its end.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: the paths staged by the innermost job of this thread (or task of an event loop); None outside of jobs
_scope: ContextVar[list[str] | None] = ContextVar("pressloom-staged", default=None)


@contextmanager
def dropping_staged(spark: SparkSession) -> Iterator[None]:
    """Deletes what was staged inside the block when it ends; for jobs whose results are written by then.

    Jobs in other threads have scopes of their own. What is staged outside of any block stays, as lazily
    evaluated results may still be read from it.
    """
    scope: list[str] = []
    token = _scope.set(scope)
    try:
        yield
    finally:
        _scope.reset(token)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for name in reversed(scope):
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)


def global_row_number(df: DataFrame, order_cols: Sequence[str], out: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """``row_number() OVER (ORDER BY order_cols)`` without moving all rows to one task.

    Rows are range-partitioned and sorted on the order key, and staged once with
    their partition and their position in it. Counts and rows are both taken from
    that copy, so every use sees one and the same partitioning (a second range
    exchange would sample bounds of its own). The count table has one row per
    partition. Ties on the order key must not exist.
    """
    spark: SparkSession = df.sparkSession
    # a fixed count (partition ids define the order, so AQE must not coalesce)
    n = num_partitions or max(2, spark.sparkContext.defaultParallelism * 2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_lrn", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), 33) + 1))
    local = staged(ranged, "numbered")
    counts = local.groupBy("_pid").agg(F.max("_lrn").alias("_cnt"))
    offsets = counts.select(
        F.col("_pid").alias("_opid"),
        F.coalesce(F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (local.join(F.broadcast(offsets), F.col("_pid") == F.col("_opid"))
            .withColumn(out, (F.col("_off") + F.col("_lrn")).cast("long"))
            .drop("_pid", "_opid", "_lrn", "_off"))


def number_within_groups(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                         rn: str = "rn", next_cols: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """``row_number()`` and ``lead(c)`` per group, safe when one group holds most rows.

    A window partitioned by the group would sort a hot group inside one task.
    Instead every row gets a global position on (group, order) by range
    partitioning (a hot group is split over many tasks); the group's first
    position comes from a partial (map-side combined) min aggregate; ``lead`` is
    an equi-join on the unique global position. All three read the one staged
    numbering. ``(group, order)`` must be unique.
    """
    g = global_row_number(df, [*group_cols, *order_cols], out="_grn", num_partitions=num_partitions)
    first = g.groupBy(*group_cols).agg(F.min("_grn").alias("_first")).select(
        *[F.col(c).alias("_f_" + c) for c in group_cols], "_first")
    same_group = [F.col(c).eqNullSafe(F.col("_f_" + c)) for c in group_cols]
    out = g.join(first, same_group).drop(*["_f_" + c for c in group_cols]) \
           .withColumn(rn, (F.col("_grn") - F.col("_first") + 1).cast("long"))
    if next_cols:
        nxt = g.select(*[F.col(c).alias("_n_" + c) for c in group_cols], (F.col("_grn") - 1).alias("_ngrn"),
                       *[F.col(c).alias("next_" + c) for c in next_cols])
        cond = [F.col("_grn") == F.col("_ngrn")] + [F.col(c).eqNullSafe(F.col("_n_" + c)) for c in group_cols]
        out = out.join(nxt, cond, "left").drop("_ngrn", *["_n_" + c for c in group_cols])
    return out.drop("_grn", "_first")
