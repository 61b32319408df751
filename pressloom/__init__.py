"""pressloom: labelled-article ETL on Spark.

Pages that were already fetched, link batches, a source-credibility table,
stored errors and forum posts go in; article rows, error rows and resumable
collector state come out. Every step is a DataFrame plan.
"""

from pressloom.session import get_spark, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
