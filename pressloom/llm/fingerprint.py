"""Document fingerprints by quartile bucket digests (operator 12).

Every text's bytes give hashed triplets (the bytes at 0, ``GAPS[0]`` and ``GAPS[1]``
behind each place, zeros behind the end), counted in ``BUCKETS`` buckets. The digest
is the text's length in eighths of an octave and, per bucket, how many of the three
quartiles of all its counts the bucket's count exceeds (0 to 3). The difference of two
digests is the sum of the buckets' differences and of the lengths' difference, of which
at most ``LENGTH_CAP`` counts; likeness is 1 less the difference over its greatest
possible value. Digests are of one length, whatever the text.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.llm.common import replace_column, small_batches, stage, table, with_column

BUCKETS = 256  # a power of two
GAPS = (5, 10)
LENGTH_STEPS, LENGTH_CAP, LENGTH_WEIGHT = 8, 32, 4
CHUNK = 1 << 20  # bytes of a text counted at a time
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D), np.uint32(0x2C1B3C6D), np.uint32(0x297A2D39))
GREATEST = 3 * BUCKETS + LENGTH_WEIGHT * LENGTH_CAP


def bucket_counts(data: bytes) -> np.ndarray:
    """How many of the triplets that begin at each byte fall into each bucket."""
    counts, reach = np.zeros(BUCKETS, np.int64), GAPS[1]
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    for at in range(0, len(data), CHUNK):
        part = np.frombuffer(data[at:at + CHUNK + reach], np.uint8)
        n = min(CHUNK, len(data) - at)
        b = np.concatenate([part, np.zeros(n + reach - len(part), np.uint8)]).astype(np.uint32)
        h = b[:n] * _MIX[0] + b[GAPS[0]:GAPS[0] + n] * _MIX[1] + b[GAPS[1]:GAPS[1] + n] * _MIX[2]
        h = (h ^ (h >> np.uint32(15))) * _MIX[3]
        h = (h ^ (h >> np.uint32(12))) * _MIX[4]
        counts += np.bincount(h >> shift, minlength=BUCKETS)
    return counts


class Digest(NamedTuple):
    length: int
    codes: np.ndarray

    def __str__(self) -> str:
        packed = self.codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
        return f"{self.length:02x}{np.bitwise_or.reduce(packed, axis=1).tobytes().hex()}"


def digest(data: bytes) -> Digest:
    """The digest of a text's bytes; equal bytes have equal digests. An empty text has length 0 and codes 0."""
    counts = bucket_counts(data)
    quartiles = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (counts[:, None] > quartiles).sum(1).astype(np.uint8)
    return Digest(min(255, round(LENGTH_STEPS * math.log2(len(data) + 1))), codes)


def parse(fingerprint: str) -> Digest:
    packed = np.frombuffer(bytes.fromhex(fingerprint[2:]), np.uint8)
    return Digest(int(fingerprint[:2], 16), ((packed[:, None] >> np.array([0, 2, 4, 6], np.uint8)) & np.uint8(3)).reshape(-1))


def likeness(a: Digest, b: Digest) -> float:
    """1 for equal digests, 0 for the greatest difference."""
    buckets = int(np.abs(a.codes.astype(np.int16) - b.codes).sum())
    return 1 - (buckets + LENGTH_WEIGHT * min(LENGTH_CAP, abs(a.length - b.length))) / GREATEST


def fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` with the fingerprint of each whole text. No shuffle.

    A null text counts as empty. Rows may repeat. Other columns pass through; one
    named ``out`` (in any case) is replaced. An empty table gives an empty table.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
            yield replace_column(batch, out, pa.array([str(digest(t.as_py() or b"")) for t in texts], pa.string()))

    return df.mapInArrow(run, with_column(df.schema, out, T.StringType()))


class Row(NamedTuple):
    """A document on its way to its successor."""
    key: int | None
    text: str
    digest: Digest


ROWS = T.StructType([
    T.StructField("key", T.LongType()), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
    T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])


def compared(row: Row, after: Row) -> tuple:
    """A row of ``ROWS``: the document, its text with the last half replaced by the successor's first code points, the successor."""
    n = len(row.text)
    edited = (row.text[:n - n // 2] + after.text[:n // 2]).encode()
    d = digest(edited)
    return (row.key, n, hashlib.sha256(edited).hexdigest(), str(row.digest), str(d), likeness(row.digest, d), likeness(row.digest, after.digest))


def _rows(found: list[tuple], extra: list[tuple[str, pa.DataType, list]] = ()) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    made = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([*made, *(pa.array(values, kind) for _, kind, values in extra)], names=[*ROWS.names, *(e[0] for e in extra)])


def edit_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its fingerprint, that of its edited text and their likeness (columns ``ROWS``).

    The edited text has the last half of the code points replaced by as many first ones of
    the next document, by ascending id; the last document's next is the first, a single
    one's is itself. Null ids come first. Rows that repeat an id follow each other by the hash
    of the text, then by the text. A null text counts as empty. Columns besides id and
    text aren't read. An empty table gives an empty table.

    Documents are range-partitioned and sorted by id, each text moves once. A task
    compares neighbours as it reads them, holding two texts; only its first and its last
    text are written, and the last one is compared with the first one of the next task that had rows.
    """
    t = F.coalesce(text, F.lit("")).alias("text")
    d = docs.select(F.col(key).cast("long").alias("key"), t).withColumn("_h", F.xxhash64("text"))
    order = [F.col("key").asc_nulls_first(), F.col("_h")]
    lined = d.repartitionByRange(*order).sortWithinPartitions(*order, "text").select("key", "text", F.spark_partition_id().alias("task"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: Row | None = None
        task = None
        for batch in small_batches(batches, "text"):
            found, ends = [], []
            if batch.num_rows:
                task = batch.column(2)[0].as_py()
            for k, s in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = s.as_py()
                row = Row(k, s, digest(s.encode()))
                if before is None:
                    ends.append(row)
                else:
                    found.append(compared(before, row))
                before = row
            yield packed(found, ends, task, True)
        if before is not None:
            yield packed([], [before], task, False)

    def packed(found: list[tuple], ends: list[Row], task: int | None, first: bool) -> pa.RecordBatch:
        inner, n = len(found), len(found) + len(ends)
        found = found + [(r.key, None, None, None, None, None, None) for r in ends]
        return _rows(found, [("task", pa.int32(), [task] * n), ("is_first", pa.bool_(), [None] * inner + [first] * len(ends)),
                             ("text", pa.string(), [None] * inner + [r.text for r in ends])])

    made = stage(lined.mapInArrow(run, T.StructType([
        *ROWS.fields, T.StructField("task", T.IntegerType()), T.StructField("is_first", T.BooleanType()), T.StructField("text", T.StringType())])), "fingerprints")
    first = made.where("is_first").select(F.col("task").alias("_task"), F.col("key").alias("_key"), F.col("text").alias("_text"))
    last = made.where("not is_first").select("task", "key", "text")
    whole = Window.orderBy("_task")  # one row a task of the sort
    after = first.select("_task").withColumn("_next", F.coalesce(F.lead("_task").over(whole), F.min("_task").over(
        whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    pairs = last.join(after, F.col("task") == F.col("_task")).drop("_task").join(first, F.col("_next") == F.col("_task")).select("key", "text", "_key", "_text")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            yield _rows([compared(Row(k, a, digest(a.encode())), Row(j, b, digest(b.encode())))
                         for k, a, j, b in zip(*(batch.column(i).to_pylist() for i in range(4)))])

    return made.where("is_first is null").select(*ROWS.names).unionByName(pairs.mapInArrow(across, ROWS))


def op12_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


QUERIES = {"op12_fingerprint": op12_fingerprint}
ORACLES: dict[str, str] = {}
