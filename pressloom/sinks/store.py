"""Sinks: article and error tables, state versions (B1, B2, B3 writer, B4).

Tables are parquet directories partitioned by ``run_id`` and ``batch_id``. A batch
of a run is written with dynamic partition overwrite, so doing it again (an
at-least-once retry after a lost executor or a restarted stream) replaces its own
rows, never duplicates them, and never touches those of other runs. Run ids are
names that sort in time order. Declared constraints of the article table: ``url`` not
null and unique; a refused row becomes an error row, the batch goes on.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.operators.common import staged
from pressloom.schemas import ARTICLE_SCHEMA, ERROR_COLUMNS, ERROR_SCHEMA
from pressloom.sinks import url_index
from pressloom.sinks.url_index import PARTITIONS
from pressloom.sources.tables import ntz_literal

# Error kinds of refused rows (named as the store's driver names them).
UNIQUE_VIOLATION, NOT_NULL_VIOLATION = "UniqueViolationError", "NotNullViolationError"


def sink_projection(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The sink's columns in declared order, cast to the declared types.

    A missing column fails analysis (the reference fails with a KeyError).
    """
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table with its declared columns, ``run_id`` and ``batch_id``; empty when nothing was stored yet."""
    whole = T.StructType([*schema.fields, *PARTITIONS])
    return spark.read.schema(whole).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], whole)


def numbered(articles: DataFrame) -> DataFrame:
    """Rows staged once, each with a number ``_id`` of its own."""
    return staged(articles.withColumn("_id", F.monotonically_increasing_id()), "incoming")


def split_by_constraints(articles: DataFrame, stored_urls: DataFrame | None, run_ts: dt.datetime,
                         order: tuple[str, ...] = ("batch_id", "seq")) -> tuple[DataFrame, DataFrame]:
    """B1 check: ``(accepted, refused_as_errors)``.

    Null url -> ``NotNullViolationError``; a url of ``stored_urls`` (distinct), or repeated
    in this write (the first by ``order`` wins, one of several at the same place) -> ``UniqueViolationError``.
    Rows are staged with a number, so that each is one row whatever its place; the first row per
    url is a partial aggregate (a hot url collapses map-side), and only numbers and urls are compared.
    """
    rows = articles if "_id" in articles.columns else numbered(articles)
    keys = rows.where(F.col("url").isNotNull()).select("_id", "url", *order)
    first = keys.groupBy("url").agg(F.min(F.struct(*order, "_id")).alias("_first")).select("url", F.col("_first._id").alias("_id"))
    if stored_urls is not None:
        first = first.join(stored_urls.select(F.col("url").alias("_su")), F.col("url") == F.col("_su"), "left_anti")
    ok = staged(first.select(F.col("_id").alias("_ok")), "unique")
    accepted = rows.join(ok, F.col("_id") == F.col("_ok"), "left_semi").drop("_id")
    dup = rows.where(F.col("url").isNotNull()).join(ok, F.col("_id") == F.col("_ok"), "left_anti")

    def err(df: DataFrame, kind: str, info) -> DataFrame:
        return df.select(F.lit(kind).alias("type"), F.col("visited_url").alias("url"),
                         F.col("scraped_from").alias("source_article"), F.col("fake").alias("from_fake"),
                         info.alias("additional_info"), ntz_literal(run_ts).alias("creation_date"),
                         *[c for c in order if c not in ERROR_COLUMNS])

    refused = (err(dup, UNIQUE_VIOLATION, F.concat(F.lit("duplicate key value violates unique constraint: url="), F.col("url")))
               .unionByName(err(rows.where(F.col("url").isNull()), NOT_NULL_VIOLATION,
                                F.lit('null value in column "url" violates not-null constraint'))))
    return accepted, refused


def write_batches(df: DataFrame, path: str, schema: T.StructType, run_id: str) -> None:
    """Write rows of a run by ``batch_id`` partition, replacing only the partitions being written (idempotent)."""
    if "batch_id" not in df.columns:
        raise ValueError("rows to store need a batch_id")
    out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields],
                    F.lit(run_id).alias("run_id"), F.col("batch_id").cast("long").alias("batch_id"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "batch_id").parquet(path)


def store_articles(articles: DataFrame, path: str, run_ts: dt.datetime, run_id: str, runs: str | None = None) -> tuple[DataFrame, DataFrame]:
    """B1: check constraints against the stored table, append accepted rows, return ``(stored, refused)``.

    Rows of other runs, and of other batches of this run, count as stored; those of
    the batches being written (an earlier attempt) don't, nor do those of runs that began in the folder ``runs`` and
    didn't end. Of the stored table only partitions that may hold one of the urls are read (``url_index``). The accepted rows are
    returned as read back (the stored urls, like ``INSERT ... RETURNING url``); refused rows come back as error rows.
    """
    spark = articles.sparkSession
    incoming = numbered(articles)
    batches = [r.batch_id for r in incoming.select("batch_id").distinct().collect()]  # partitions being written
    mine = (F.col("run_id") == run_id) & F.col("batch_id").isin(batches)
    others = ~mine & ~F.col("run_id").isin(sorted(open_runs(spark, runs) - {run_id}))
    held = None
    if path_exists(spark, path):
        before = read_batches(spark, path, ARTICLE_SCHEMA)
        if not path_exists(spark, url_index.index_path(path)):
            url_index.extend(before, path)  # a table from before there was an index
        urls = staged(incoming.select("url").where("url is not null").distinct(), "batch-urls")
        held = url_index.held_urls(spark, path, before, urls, others)
    accepted, refused = split_by_constraints(incoming, held, run_ts)
    refused = staged(refused, "refused")
    url_index.extend(accepted.select("url", F.lit(run_id).alias("run_id"), F.col("batch_id").cast("long").alias("batch_id")), path)
    write_batches(accepted, path, ARTICLE_SCHEMA, run_id)
    return read_batches(spark, path, ARTICLE_SCHEMA).where(mine), refused


def store_errors(errors: DataFrame, path: str, run_id: str) -> None:
    """B2: append error rows (by batch partition, idempotent per run and batch)."""
    write_batches(errors, path, ERROR_SCHEMA, run_id)


def _marker(spark: SparkSession, runs: str, run_id: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{runs.rstrip('/')}/{run_id}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def begin_run(spark: SparkSession, runs: str, run_id: str) -> None:
    """Marks a run as begun: until ``end_run`` other runs see nothing that it writes."""
    fs, path = _marker(spark, runs, run_id)
    fs.create(path, True).close()


def end_run(spark: SparkSession, runs: str, run_id: str) -> None:
    """Makes all that a run has written visible, at once: articles, errors and progress."""
    fs, path = _marker(spark, runs, run_id)
    fs.delete(path, False)


def open_runs(spark: SparkSession, runs: str | None) -> set[str]:
    """Runs that have begun and not ended: under way, or lost. Few, as ended ones leave no marker."""
    if runs is None or not path_exists(spark, runs):
        return set()
    fs, root = _marker(spark, runs, "")
    return {str(f.getPath().getName()) for f in fs.listStatus(root)}


def write_version(df: DataFrame, base: str, version: str) -> str:
    """Write version ``version`` of a small table (never over the one being read); returns its path.

    Versions are named by run ids, or run id and epoch, which sort in time order; doing
    one again rewrites only itself.
    """
    p = f"{base.rstrip('/')}/v={version}"
    df.write.mode("overwrite").parquet(p)
    return p


def write_deletions(urls: DataFrame, base: str, version: str, after: str) -> str:
    """Write version ``version`` as version ``after`` without the rows of ``urls`` (column ``url``); returns its path.

    Only the urls are written (merge on read): what is written follows what is deleted, not the table. Doing it again
    replaces it, after another version too.
    """
    spark = urls.sparkSession
    p = f"{base.rstrip('/')}/v={version}"
    root = spark._jvm.org.apache.hadoop.fs.Path(p)
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)
    urls.select(F.col("url").cast("string")).where(F.col("url").isNotNull()).distinct().write.mode("overwrite").parquet(f"{p}/after={after}")
    return p


def _children(spark: SparkSession, path: str) -> list[str]:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [str(f.getPath().getName()) for f in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)]


def _deletions(spark: SparkSession, path: str) -> str | None:
    """Folder of the deletions that a version consists of, if they are complete."""
    found = [f"{path}/{n}" for n in _children(spark, path) if n.startswith("after=")]
    return found[0] if found and path_exists(spark, f"{found[0]}/_SUCCESS") else None


def latest_version(spark: SparkSession, base: str, before: str | None = None, without: set[str] = frozenset()) -> str | None:
    """Name of the newest complete version, of those before ``before`` if given and not in ``without``; None if there is none."""
    if not path_exists(spark, base):
        return None
    names = sorted((n[2:] for n in _children(spark, base) if n.startswith("v=")), reverse=True)
    for v in names:
        path = f"{base.rstrip('/')}/v={v}"
        if (before is None or v < before) and v not in without and (path_exists(spark, f"{path}/_SUCCESS") or _deletions(spark, path)):
            return v
    return None


def version_parts(spark: SparkSession, base: str, version: str) -> tuple[str, list[str]]:
    """``(name of the whole version that this one goes back to, folders of the urls deleted since)``."""
    gone: list[str] = []
    while True:
        path = f"{base.rstrip('/')}/v={version}"
        deleted = None if path_exists(spark, f"{path}/_SUCCESS") else _deletions(spark, path)
        if deleted is None:
            return version, gone
        gone.append(deleted)
        version = deleted.rsplit("/after=", 1)[1]


def read_version(spark: SparkSession, base: str, version: str, schema: T.StructType) -> DataFrame:
    """A version's rows: of the whole version that it goes back to, without the urls deleted since."""
    whole, gone = version_parts(spark, base, version)
    rows = spark.read.schema(schema).parquet(f"{base.rstrip('/')}/v={whole}")
    if not gone:
        return rows
    urls = spark.read.schema("url string").option("recursiveFileLookup", "true").parquet(*gone).select(F.col("url").alias("_gone")).distinct()
    return rows.join(urls, F.col("url") == F.col("_gone"), "left_anti")


def compact_version(spark: SparkSession, base: str, version: str, schema: T.StructType) -> str:
    """Writes a version that consists of deletions as a whole one and returns its name, which sorts between this version's
    and the next one's. Deletions stay until the new version is complete, so a compaction that is lost loses nothing."""
    name = f"{version}~"
    write_version(read_version(spark, base, version, schema), base, name)
    return name
