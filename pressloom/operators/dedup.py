"""Order-sensitive de-duplication by title or url inside a batch.

Sequential meaning: walk a batch in ``seq`` order; drop a row whose stripped
title or stripped url was already *registered*; only kept rows register
their two keys (a dropped duplicate does not register its other key).
The kept set is the lexicographically-first maximal independent set of the
"shares a title or a url" graph, so two ``row_number() = 1`` filters are wrong.

Parallel form (exact): in each round, a row that holds the smallest ``seq`` of
both its title group and its url group among undecided rows is kept (every
earlier row of its groups was dropped, or it would have been removed); then
every undecided row sharing a key with a kept row is dropped. Rounds repeat
until nothing is undecided.

Such rounds are few on random orders, but one per kept row of a chain in which
every row shares a key with the next. So later rounds decide whole chains: a row
with exactly one undecided earlier neighbour is kept if and only if that neighbour
is dropped, so these rows form trees along which the fate alternates, and pointer
jumping finds each row's distance to its root in as many steps as the depth has
binary digits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.functions.text import py_strip
from pressloom.operators.common import staged, staging_path

#: rounds before chains are looked for; they end nearly all batches, and each is cheaper than a round with chains
PLAIN_ROUNDS = 4


def dedup_keys(df: DataFrame, title_col: str = "title", url_col: str = "url") -> DataFrame:
    """Keys compared by the de-dup: stripped title and url; null becomes ``''``.

    An empty title is an ordinary key, so all untitled rows of a batch collide.
    """
    return df.withColumn("_tk", F.coalesce(py_strip(F.col(title_col)), F.lit(""))) \
             .withColumn("_uk", F.coalesce(py_strip(F.col(url_col)), F.lit("")))


def kept_positions(keyed: DataFrame, batch_col: str = "batch_id", seq_col: str = "seq") -> DataFrame:
    """``(batch_id, seq)`` of kept rows; input has ``batch_col, seq_col, _tk, _uk``
    with ``(batch_id, seq)`` unique."""
    spark = keyed.sparkSession
    keys = keyed.select(F.col(batch_col).alias("batch_id"), F.col(seq_col).alias("seq"), "_tk", "_uk")
    undecided = staged(keys, "dedup-undecided")
    kept = staging_path(spark, "dedup-kept")  # rounds append here, so the plan doesn't grow with them
    done = 0
    while True:
        winners = staged(first_in_both(undecided) if done < PLAIN_ROUNDS else kept_of_chains(undecided), "dedup-winners")
        winners.select("batch_id", "seq").write.mode("append").parquet(kept)
        rest = (undecided.join(winners.select("batch_id", "_tk"), ["batch_id", "_tk"], "left_anti")
                .join(winners.select("batch_id", "_uk"), ["batch_id", "_uk"], "left_anti"))
        undecided = staged(rest, "dedup-undecided")
        done += 1
        if undecided.limit(1).count() == 0:
            return spark.read.schema(keys.select("batch_id", "seq").schema).parquet(kept)


def first_in_both(undecided: DataFrame) -> DataFrame:
    """Rows without an earlier neighbour. Group minima by partial aggregation: a hot title or url collapses map-side."""
    tmin = undecided.groupBy("batch_id", "_tk").agg(F.min("seq").alias("seq"))
    umin = undecided.groupBy("batch_id", "_uk").agg(F.min("seq").alias("seq"))
    return tmin.join(umin, ["batch_id", "seq"])  # (batch_id, seq) is unique


def first_two(undecided: DataFrame, key: str, parent: str) -> DataFrame:
    """``(batch_id, seq, key, parent)`` of the first row of each group (parent null) and of the second (parent: the first)."""
    first = undecided.groupBy("batch_id", key).agg(F.min("seq").alias(parent))
    second = (undecided.join(first, ["batch_id", key]).where(F.col("seq") > F.col(parent))
              .groupBy("batch_id", key).agg(F.min("seq").alias("seq"), F.min(parent).alias(parent)))
    return first.select("batch_id", F.col(parent).alias("seq"), key, F.lit(None).cast(first.schema[parent].dataType).alias(parent)) \
                .unionByName(second)


def kept_of_chains(undecided: DataFrame) -> DataFrame:
    """Rows whose fate follows along earlier neighbours that are the only ones, and that are kept; ``first_in_both`` among them.

    A row is first or second in both groups, and all its earlier neighbours are one row, or it is in no tree. A tree whose
    root has several earlier neighbours stays undecided.
    """
    tp, up = F.col("_tp"), F.col("_up")
    trees = (first_two(undecided, "_tk", "_tp").join(first_two(undecided, "_uk", "_up"), ["batch_id", "seq"])
             .where(tp.isNull() | up.isNull() | (tp == up)).withColumn("_to", F.coalesce(tp, up)))
    nodes = staged(trees.select("batch_id", "seq", "_tk", "_uk", F.coalesce("_to", "seq").alias("_to"),
                                F.col("_to").isNull().alias("_ends"), F.col("_to").isNotNull().cast("int").alias("_odd")), "dedup-trees")
    while nodes.where(~F.col("_ends")).limit(1).count():
        # rows that have arrived at a root wait, so a root that many rows lead to is no hot key
        ahead = nodes.select("batch_id", F.col("seq").alias("_to"), F.col("_to").alias("_to2"), F.col("_ends").alias("_ends2"), F.col("_odd").alias("_odd2"))
        jumped = nodes.where(~F.col("_ends")).join(ahead, ["batch_id", "_to"])  # rows that lead out of the trees end here
        nodes = staged(nodes.where("_ends").unionByName(jumped.select(
            "batch_id", "seq", "_tk", "_uk", F.col("_to2").alias("_to"), F.col("_ends2").alias("_ends"),
            F.col("_odd").bitwiseXOR(F.col("_odd2")).alias("_odd"))), "dedup-trees")
    return nodes.where(F.col("_odd") == 0).select("batch_id", "seq", "_tk", "_uk")


def dedup_title_or_url(articles: DataFrame, batch_col: str = "batch_id", seq_col: str = "seq",
                       title_col: str = "title", url_col: str = "url") -> DataFrame:
    """G1 + G2: keep the first row of each title and of each url, in order, per batch.

    The memory is per batch (G2): ``batch_col`` is part of every key.
    """
    keyed = dedup_keys(articles.select(batch_col, seq_col, title_col, url_col), title_col, url_col)
    kept = kept_positions(keyed, batch_col, seq_col) \
        .withColumnRenamed("batch_id", batch_col).withColumnRenamed("seq", seq_col)
    return articles.join(kept, [batch_col, seq_col], "left_semi")
