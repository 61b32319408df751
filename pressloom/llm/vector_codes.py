"""Vector compression by product codes with exact integer arithmetic (operator 13).

Components become integers. Vectors are cut into equal parts; per part position a
codebook is fitted by rounds of: every part goes to its nearest entry (squared
Euclidean distance, ties to the first), every entry becomes the floored mean of its parts.

Distances are exact: integers are split into limbs so short that a matrix product of
limbs in float64 stays below 2**53 and is thus an exact integer; the products are
put together in int64. Each task sums the parts of each entry by itself, so a round
shuffles one row per task and entry, and only codebooks (whose size doesn't depend on the
number of vectors) come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm.common import stage, table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
CHUNK_ROWS = 4096  # rows whose distances are held at a time
BROADCAST_BYTES = 16 << 20


def limb_bits(width: int) -> int:
    """Bits of a limb such that a sum of ``width`` products of two limbs stays within 2**53."""
    return (53 - max(0, (width - 1).bit_length())) // 2


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 matrices A_i with ``values == sum(A_i * 2**(bits * i))``; all but the last are not negative, none exceeds 2**bits."""
    out, rest, bound = [], values, 1 << bits
    while rest.size and max(-int(rest.min()), int(rest.max())) > bound:
        out.append((rest & (bound - 1)).astype(np.float64))
        rest = rest >> bits
    return [*out, rest.astype(np.float64)]


def exact_dot(a: list[np.ndarray], b: list[np.ndarray], bits: int) -> np.ndarray:
    """int64 products of the rows of two matrices given by their limbs."""
    total = np.zeros((len(a[0]), len(b[0])), np.int64)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            if bits * (i + j) < 64:  # the result fits 64 bits, so higher products add up to 0
                total += (x @ y.T).astype(np.int64) << (bits * (i + j))
    return total


class Codebook:
    """Entries of one part position, ready to be compared with parts."""

    def __init__(self, entries: np.ndarray):
        self.entries, self.bits = entries, limb_bits(entries.shape[1])
        self.limbs, self.squares = limbs(entries, self.bits), (entries * entries).sum(1)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (the first among equals) and its squared distance, for each part."""
        away = self.squares - 2 * exact_dot(limbs(parts, self.bits), self.limbs, self.bits)
        at = np.argmin(away, axis=1)
        return at, (parts * parts).sum(1) + away[np.arange(len(at)), at]


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, CHUNK_ROWS):
            piece = batch.slice(i, CHUNK_ROWS)
            values = piece.column(piece.schema.get_field_index("ints")).flatten().to_numpy(zero_copy_only=False)
            yield piece, values.astype(np.int64).reshape(piece.num_rows, width)


def refined(data: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after a round; entries without parts stay."""
    n_parts, n, width = len(books), len(books[0]), books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebooks = [Codebook(b) for b in books]
        sums, counts = np.zeros((n_parts, n, width), np.int64), np.zeros((n_parts, n), np.int64)
        for _, values in _chunks(batches, n_parts * width):
            for p, book in enumerate(codebooks):
                parts = values[:, p * width:(p + 1) * width]
                at, _ = book.nearest(parts)
                order = np.argsort(at, kind="stable")
                met, first = np.unique(at[order], return_index=True)
                sums[p, met] += np.add.reduceat(parts[order], first, axis=0)
                counts[p] += np.bincount(at, minlength=n)
        part, entry = np.nonzero(counts)
        flat = sums[part, entry].reshape(-1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry], pa.int64()),
             pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * width, pa.int32()), pa.array(flat, pa.int64()))],
            names=["part", "entry", "n", "sums"])

    met = data.select("ints").mapInArrow(run, "part int, entry int, n bigint, sums array<bigint>")
    total = met.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[i]) for i in range(width))).alias("sums"))
    new = [b.copy() for b in books]
    for r in total.collect():  # at most one row per entry of a codebook
        new[r.part][r.entry] = [s // r.n for s in r.sums]
    return new


def bounded_bytes(df: DataFrame, column: str) -> DataFrame:
    """``broadcast(df)`` if its values of ``column`` and 32 bytes a row take at most ``BROADCAST_BYTES``, else ``df``."""
    size = df.agg(F.sum(F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0)) + F.lit(32)).alias("b")).first().b or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def product_codes(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
                  key: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """(key, label, code, error, label_error) per kept row, and the codebooks (one integer matrix per part position).

    Vectors that are null or hold null or non-finite components are dropped. Component x
    becomes floor(scale * x). Codebooks begin as the parts of the kept rows of smallest key
    (rows that repeat a key by their integers), ``entries`` at most; rows with a null key begin
    none, but are encoded like the others. ``code`` has two hex digits per part, ``error`` is the
    squared distance summed over parts, ``label_error`` its sum over the rows of one label, nulls together.
    Rows may repeat; other columns aren't read. Without kept rows the result is empty, and so are the
    codebooks; without keys codes and errors are null.

    Raises ValueError if kept vectors differ in length, if the length isn't a multiple of ``parts``, or if
    components are so large that distances don't fit 64 bits.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code of two hex digits needs 1 to 256 entries")
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    data = stage(rows.where(v.isNotNull() & finite).select(
        F.col(key).alias("key"), F.col(label).alias("label"), F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("ints")), "vector-ints")
    seen = data.agg(F.min(F.size("ints")).alias("low"), F.max(F.size("ints")).alias("high"),
                    F.max(F.greatest(F.array_max("ints"), -1 - F.array_min("ints"))).alias("far")).first()
    dims, far = seen.high or 0, seen.far or 0
    if seen.low != seen.high or dims % parts or dims * (2 * (int(far) + 1)) ** 2 >= 1 << 63:
        raise ValueError(f"{seen.low} to {seen.high} components, integers up to {far}: no {parts} equal parts or no distances of 64 bits")
    width = dims // parts
    first = data.where("key is not null").orderBy("key", "ints").limit(entries).select("ints").collect()  # the beginning of the codebooks
    start = np.array([r.ints for r in first], np.int64).reshape(len(first), parts, width)
    books = [start[:, p] for p in range(parts)]
    for _ in range(rounds if len(first) else 0):
        books = refined(data, books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebooks = [Codebook(b) for b in books]
        for piece, values in _chunks(batches, dims):
            error, codes = np.zeros(piece.num_rows, np.int64), np.zeros((piece.num_rows, parts), np.uint8)
            for p, book in enumerate(codebooks):
                codes[:, p], away = book.nearest(values[:, p * width:(p + 1) * width])
                error += away
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                                              pa.array(error, pa.int64())], names=["key", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in data.schema.fields}
    if len(first):
        coded = data.mapInArrow(encode, f"key {kinds['key']}, label {kinds['label']}, code string, error bigint")
    else:
        coded = data.select("key", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    coded = stage(coded, "vector-codes")
    totals = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))  # one row a label
    joined = coded.join(bounded_bytes(totals, "_label"), F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
    return joined, books


def codebooks_sha256(books: list[np.ndarray]) -> str:
    """Lower-case hex SHA-256 of all components as decimals, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = product_codes(table(spark, sf_dir, "embeddings"))
    return coded.select(F.col("key").alias("vec_id"), "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))


QUERIES = {"op13_vector_codes": op13_vector_codes}
ORACLES: dict[str, str] = {}
