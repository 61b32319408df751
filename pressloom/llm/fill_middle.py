"""Fill-in-middle transformation with a learned rank index over line boundaries (operator 11).

A text is a sequence of lines, each with its line end. The byte offsets of all line
boundaries of a text are indexed by rank: piecewise-linear segments are fitted so that
each boundary lies within ``BOUND`` bytes of its segment, and what is left over is
stored as a residual. A cut before line k is predicted from its segment and corrected
by its residual, which gives the exact offset.

Which lines a text is cut at, and in which order its parts are written, is drawn from the
hash of the document's id, so a text's form depends on nothing but its id and itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.llm.common import small_batches, table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BOUND = 64
SEED = 7
RATE, SPM_RATE = 100, 50  # per cent of the texts that are cut, and of those the ones with the suffix first
FIRST_STEP = 64


class RankIndex:
    """Offsets by rank: error-bounded linear segments and the residual of every offset."""

    def __init__(self, offsets: np.ndarray, bound: int = BOUND):
        starts, slopes, at, n = [], [], 0, len(offsets)
        while at < n:
            low, high, end, step = -np.inf, np.inf, at + 1, FIRST_STEP
            while end < n:  # lengthens the segment while one slope fits all its offsets
                ranks = np.arange(end - at, min(end - at + step, n - at))
                rise = offsets[at + ranks] - offsets[at]
                lows = np.maximum(np.maximum.accumulate((rise - bound) / ranks), low)
                highs = np.minimum(np.minimum.accumulate((rise + bound) / ranks), high)
                fits = lows <= highs
                taken = len(ranks) if fits.all() else int(np.argmin(fits))
                if taken:
                    low, high, end = lows[taken - 1], highs[taken - 1], end + taken
                if taken < len(ranks):
                    break
                step *= 2
            starts.append(at)
            slopes.append((low + high) / 2 if end > at + 1 else 0.0)
            at = end
        self.starts, self.slopes = np.array(starts, np.int64), np.array(slopes, np.float64)
        self.bases = offsets[self.starts]
        self.residuals = (offsets - self.predict(np.arange(n))).astype(np.int16)  # at most bound + 1

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        s = np.searchsorted(self.starts, ranks, side="right") - 1
        return self.bases[s] + np.floor(self.slopes[s] * (ranks - self.starts[s])).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets of some ranks."""
        return self.predict(ranks) + self.residuals[ranks]


def line_boundaries(data: bytes) -> np.ndarray:
    """0 and the offset behind every line; a last line without a line end counts."""
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    last = [len(data)] if data and not data.endswith(b"\n") else []
    return np.concatenate([np.zeros(1, np.int64), ends.astype(np.int64), np.array(last, np.int64)])


class Parts(NamedTuple):
    n_units: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: bytes


def draws(key: int | None, seed: int = SEED) -> tuple[int, ...]:
    """Four numbers of 32 bits from the seed and the decimal id (null: empty)."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4))


def transform(key: int | None, data: bytes, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> Parts:
    """One text, as UTF-8, cut and rearranged."""
    offsets = line_boundaries(data)
    n = len(offsets) - 1
    h1, h2, h3, h4 = draws(key, seed)
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    if not data or p in data or s in data or m in data or h3 % 100 >= rate:
        return Parts(n, "plain", None, None, data)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = RankIndex(offsets).offsets(np.array([first, second])).tolist()
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    chars = (len(prefix.decode()), len(middle.decode()))
    if h4 % 100 < spm_rate:
        return Parts(n, "spm", *chars, s + suffix + p + prefix + m + middle)
    return Parts(n, "psm", *chars, p + prefix + s + suffix + m + middle)


RESULT = T.StructType([T.StructField("n_units", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
                       T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])


def fill_middle(df: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """``df`` with n_units, form (plain, psm, spm), prefix_chars, middle_chars (null: plain) and output. No shuffle.

    A null text counts as empty; empty texts and texts that hold a sentinel are plain and
    come out as they are. A null id is drawn as an empty one. Rows may repeat; each is
    cut by its own id. Other columns pass through; those named like a result (in any case)
    are replaced. An empty table gives an empty table.
    """
    names = {f.name for f in RESULT}
    kept = [f for f in df.schema.fields if f.name.lower() not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            made = [transform(k, t or b"", seed, rate, spm_rate)
                    for k, t in zip(column(key).to_pylist(), column(text).cast(pa.binary()).to_pylist())]
            units, forms, prefixes, middles, outputs = zip(*made) if made else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [*(column(f.name) for f in kept), pa.array(units, pa.int64()), pa.array(forms, pa.string()), pa.array(prefixes, pa.int64()),
                 pa.array(middles, pa.int64()), pa.array(outputs, pa.binary()).cast(pa.string())],
                names=[*(f.name for f in kept), *RESULT.names])

    return df.mapInArrow(run, T.StructType([*kept, *RESULT.fields]))


def restored(output: Column, form: Column) -> Column:
    """The text rebuilt from output and form.

    No sentinel stands in a text, and none can arise where a part meets a sentinel,
    so the first place of each is where it was written.
    """
    before = lambda a, b: F.substring(output, F.locate(a, output) + 3, F.locate(b, output) - F.locate(a, output) - 3)
    middle = F.substring(output, F.locate(MIDDLE, output) + 3, F.length(output))
    return (F.when(form == "psm", F.concat(before(PREFIX, SUFFIX), middle, before(SUFFIX, MIDDLE)))
            .when(form == "spm", F.concat(before(PREFIX, MIDDLE), middle, before(SUFFIX, PREFIX))).otherwise(output))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = restored(F.col("output"), F.col("form"))
    return fill_middle(docs).select("doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars",
                                    F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


OP11_SQL = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS pieces, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS d
  FROM documents),
counted AS (
  SELECT doc_id, t, d,
         CASE WHEN t = '' THEN 0 ELSE len(pieces) - (CASE WHEN suffix(t, chr(10)) THEN 1 ELSE 0 END) END AS n,
         list_transform(pieces, lambda x, i: CASE WHEN i < len(pieces) THEN x || chr(10) ELSE x END) AS units,
         ('0x' || substr(d, 1, 8))::BIGINT AS h1, ('0x' || substr(d, 9, 8))::BIGINT AS h2, ('0x' || substr(d, 17, 8))::BIGINT AS h3, ('0x' || substr(d, 25, 8))::BIGINT AS h4
  FROM drawn),
formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM counted),
cut AS (
  SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS p, coalesce(array_to_string(units[a + 1:b], ''), '') AS m,
         coalesce(array_to_string(units[b + 1:], ''), '') AS s
  FROM formed)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""

QUERIES = {"op11_fill_middle": op11_fill_middle}
ORACLES: dict[str, str] = {"op11_fill_middle": OP11_SQL}
