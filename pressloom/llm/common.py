"""Helpers shared by the operators of this subpackage: input, staging, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.session import checkpoint_dir

# ASCII white space of the word rule [^\x20\x09-\x0D]+, as a Java / RE2 character class.
SPACES = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    return path


_scope: ContextVar[list[str] | None] = ContextVar("llm-staged", default=None)  # of the innermost ``whole`` of this thread


def whole(make: Callable[[], DataFrame], what: str, narrow: bool = False) -> DataFrame:
    """``make()`` staged as a whole; what was staged to make it is deleted then.

    For operators with a result that is small against what leads to it. Other threads
    have scopes of their own.
    """
    scope: list[str] = []
    token = _scope.set(scope)
    try:
        df = make()
        _scope.reset(token)
        token = None
        return stage(df, what, narrow=narrow)
    finally:
        if token is not None:
            _scope.reset(token)
        spark = SparkSession.getActiveSession()
        if spark is not None:
            jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
            for name in scope:
                path = jvm.org.apache.hadoop.fs.Path(name)
                path.getFileSystem(conf).delete(path, True)


#: bytes of an Arrow batch that goes to a Python worker, about; Spark's own bound is by rows only
ARROW_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Sets the session's bound of Arrow batches by bytes, unless it has one already: texts may be long."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) in (None, str(2**31 - 1)):
        spark.conf.set(key, str(ARROW_BYTES))


#: files of a staged frame of narrow rows, for each core of the cluster
NARROW_FILES = 4


def stage(df: DataFrame, what: str, compression: str = "zstd", narrow: bool = False) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Cuts the lineage like ``checkpoint()``, but later readers prune columns and
    row groups. Survives lost executors: the files are on shared storage. ``narrow``: rows of a few
    numbers, quickly made; they go to ``NARROW_FILES`` files a core at most, not to one for each shuffle partition.
    """
    if narrow:
        df = df.coalesce(NARROW_FILES * df.sparkSession.sparkContext.defaultParallelism)
    path = shared_path(df.sparkSession, what)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_column(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    """``schema`` with ``name`` added; a column of the same name (in any case) is replaced."""
    kept = [f for f in schema.fields if f.name.lower() != name.lower()]
    return T.StructType([*kept, T.StructField(name, kind, True)])


def small_batches(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``column`` holds about ``max_bytes``, one row at least.

    Bounds what a Python worker holds at a time by bytes, not by rows.
    """
    for batch in batches:
        start, held = 0, 0
        col = batch.column(batch.schema.get_field_index(column))
        lengths = pc.fill_null(pc.binary_length(col), 0).to_pylist()
        for i, n in enumerate(lengths):
            if held and held + n > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def replace_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    """The batch with ``values`` as its last column, in place of a column of that name (in any case)."""
    keep = [i for i, n in enumerate(batch.schema.names) if n.lower() != name.lower()]
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), values],
                                      names=[*(batch.schema.names[i] for i in keep), name])


#: bits of a bitmap of keys, at most: half a million rows of 64 bits
MAYBE_BITS = 1 << 25


def maybe_among(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """``df`` with ``_maybe``: true where ``key`` (a 64-bit hash) is in the only column of ``keys``, and for few other rows.

    So rows that a join has no partner for needn't be shuffled with their texts. By a bitmap of 16 bits a key, which is
    broadcast; beyond ``MAYBE_BITS`` bits it lets more of the other rows pass, up to all.
    """
    keys = keys.toDF("_key").distinct()
    bits = min(MAYBE_BITS, max(1 << 10, 1 << (16 * keys.count()).bit_length()))
    place = lambda k: k.bitwiseAND(F.lit(bits - 1))
    words = (keys.select(place(F.col("_key")).alias("_p")).groupBy(F.shiftright("_p", 6).alias("_word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(_p & 63 as int))")).alias("_bits")))
    joined = df.withColumn("_at", place(key)).join(F.broadcast(words), F.shiftright("_at", 6) == F.col("_word"), "left")
    maybe = F.coalesce(F.expr("(shiftright(_bits, cast(_at & 63 as int)) & 1L) = 1L"), F.lit(False))
    return joined.withColumn("_maybe", maybe).drop("_at", "_word", "_bits")


def bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """``broadcast(df)`` if it has at most ``max_rows`` rows, else ``df``: the join then shuffles.

    For frames whose rows have a fixed width, so that a row bound is a byte bound.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
