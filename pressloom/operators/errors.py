"""Error-table maintenance.

The stored error table is append-only; cleaning produces a new version of it
(written by the caller to a new path, never over the one being read).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def delete_superseded_errors(errors: DataFrame) -> DataFrame:
    """E5: drop an error when another error of the same url has a later ``creation_date``.

    Kept: null url, null date, or the latest date of its url (ties all stay).
    The per-url maximum is a partial aggregate (a url with many errors
    collapses map-side); the join back is an equi-join on url.
    """
    latest = errors.where(F.col("url").isNotNull() & F.col("creation_date").isNotNull()) \
                   .groupBy("url").agg(F.max("creation_date").alias("_latest"))
    j = errors.join(latest, "url", "left")
    keep = F.col("url").isNull() | F.col("creation_date").isNull() | (F.col("creation_date") >= F.col("_latest"))
    return j.where(keep).select(*errors.columns)


def delete_resolved_errors(errors: DataFrame, articles: DataFrame) -> DataFrame:
    """Drop errors whose url is a stored article's url or visited url.

    ``e.url = a.url OR e.url = a.visited_url`` is rewritten as an anti join on
    the union of both columns, so it plans as a hash join, not a nested loop.
    """
    resolved = (articles.select(F.col("url").alias("_u"))
                .unionByName(articles.select(F.col("visited_url").alias("_u")))
                .where(F.col("_u").isNotNull()).distinct())
    return errors.join(resolved, errors["url"] == resolved["_u"], "left_anti")


def delete_restored_errors(errors: DataFrame, stored_urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Drop errors whose url equals a just-stored article's (actual) url."""
    s = stored_urls.select(F.col(url_col).alias("_u")).where(F.col("_u").isNotNull()).distinct()
    return errors.join(s, errors["url"] == s["_u"], "left_anti")


def cleanup_errors(errors: DataFrame, articles: DataFrame) -> DataFrame:
    """E5 then E4, in this order."""
    return delete_resolved_errors(delete_superseded_errors(errors), articles)
