"""Byte-level BPE encoding and decoding (operator 2).

Encoding follows the backtracking method: bytes are mapped to Latin-1 text, an
Aho-Corasick automaton of all tokens gives the longest token at a position, and
the encoder backs up to shorter tokens whenever two neighbours could not stand
side by side in the result of the merges. Which neighbours can is a property of
the two tokens alone and is memoised, so the work is linear in the text.

The tokens are those of the ranked merges, per match of the split pattern. No
limit on text length; caches are bounded and hold no results across vocabularies.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.llm.common import replace_column, small_batches, table, with_column

CACHED_PIECES = 200_000
CACHED_PAIRS = 500_000
DECODED_IDS = 1_000_000  # ids that are decoded at a time, one row at least


class ByteBpe:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary must hold every single byte")
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.length = {i: len(t) for t, i in ranks.items()}
        self.by_text = {t.decode("latin-1"): i for t, i in ranks.items()}
        self.automaton = None
        self.fits: dict[int, bool] = {}
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # all tokens in one buffer, for decoding many at a time
        size = np.zeros(max(self.bytes_of) + 1, np.int64)
        for i, n in self.length.items():
            size[i] = n
        self.size_of, self.begin_of = size, np.cumsum(size) - size
        self.buffer = np.frombuffer(b"".join(self.bytes_of[i] for i in sorted(self.bytes_of)), np.uint8)

    def _prepare(self) -> None:
        """What only encoding needs."""
        import ahocorasick

        #: last merge of each token that the merges can make (None for single bytes)
        self.split: dict[int, tuple[int, int] | None] = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ranks.items():
            parts = self._last_parts(token)
            if parts is not None:
                self.split[i] = tuple(self.ranks[p] for p in parts) if len(parts) == 2 else None
                self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.shorter = {i: self._shorter(self.bytes_of[i]) for i in self.split}

    @classmethod
    def from_file(cls, path: str, pattern: str) -> "ByteBpe":
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)

    def _last_parts(self, token: bytes) -> list[bytes] | None:
        """The two parts that the last merge joins to ``token``; None if the merges don't make it."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.ranks:
                return None
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def _shorter(self, token: bytes) -> int:
        """The longest token that the merges make and that is a proper prefix; -1 for a single byte."""
        for n in range(len(token) - 1, 0, -1):
            i = self.ranks.get(token[:n], -1)
            if i in self.split:
                return i
        return -1

    def _fit(self, left: int, right: int) -> bool:
        """Whether the merges leave the boundary between the two tokens alone.

        Undoes the merges on both sides of the boundary, the latest first. If at
        some state the tokens that touch there make a token of a lower rank than
        the merge that was undone, the merges would have crossed the boundary.
        """
        ranks, bytes_of, split = self.ranks, self.bytes_of, self.split
        barrier = 1 << 60
        while True:
            joined = ranks.get(bytes_of[left] + bytes_of[right])
            if joined is not None and joined < barrier:
                return False
            a, b = split[left], split[right]
            if a is None and b is None:
                return True
            # of two merges with one rank the left one comes first, so the right one is undone first
            if b is None or (a is not None and left > right):
                barrier, left = left, a[1]
            else:
                barrier, right = right + 1, b[0]

    def _adjacent(self, key: int) -> bool:
        """``_fit`` of the pair left << 32 | right, remembered."""
        if len(self.fits) >= CACHED_PAIRS:
            self.fits.clear()
        known = self.fits[key] = self._fit(key >> 32, key & 0xFFFFFFFF)
        return known

    def _encode_piece(self, piece: str) -> bytes:
        text = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1")
        whole = self.by_text.get(text)
        if whole is not None:
            return array("i", (whole,)).tobytes()
        fits, length, shorter, end = self.fits, self.length, self.shorter, len(text)
        longest = self.automaton.iter_long(text, 0)  # longest tokens one after the other
        _, token = next(longest)
        ids: list[int] = []
        closed: set[int] = set()  # positions known to lead nowhere
        at, left, follows = 0, -1, True
        while True:
            to = at + length[token]
            if to not in closed:
                if left < 0:
                    fit = True
                else:
                    fit = fits.get(left << 32 | token)
                    if fit is None:
                        fit = self._adjacent(left << 32 | token)
                if fit:
                    ids.append(token)
                    if to == end:
                        return array("i", ids).tobytes()
                    at, left = to, token
                    if not follows:
                        longest, follows = self.automaton.iter_long(text, to), True
                    _, token = next(longest)
                    continue
            follows = False
            if shorter[token] >= 0:
                token = shorter[token]
            else:
                closed.add(at)
                token = ids.pop()
                at -= length[token]
                left = ids[-1] if ids else -1

    def encode(self, text: str, ids: array | None = None) -> array:
        """Token ids of ``text``, without special tokens; appended to ``ids`` if given."""
        if self.automaton is None:
            self._prepare()
        ids = array("i") if ids is None else ids
        recent, older, append = self.recent, self.older, ids.frombytes
        for piece in self.pattern.findall(text):
            got = recent.get(piece)
            if got is None:
                got = older.get(piece) or self._encode_piece(piece)
                if len(piece) <= 64:
                    if len(recent) >= CACHED_PIECES:
                        self.older = older = recent
                        self.recent = recent = {}
                    recent[piece] = got
            append(got)
        return ids

    def decode(self, ids) -> bytes:
        """The bytes of the ids; an id that is no token raises IndexError or KeyError."""
        return self.decode_all(np.asarray(ids, np.int64))[0].tobytes()

    def decode_all(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids one after the other, and where the bytes of each id end."""
        sizes = self.size_of[ids]
        if len(ids) and (ids.min() < 0 or not sizes.all()):
            raise KeyError("an id is no token")
        ends = np.cumsum(sizes)
        places = np.repeat(self.begin_of[ids] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.buffer[places], ends


_loaded: dict[tuple[str, str], ByteBpe] = {}


def codec(path: str, pattern: str) -> ByteBpe:
    """The codec of a rank file, built once in each Python worker."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = ByteBpe.from_file(path, pattern)
    return _loaded[path, pattern]


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``df`` with ``ids`` (array<int>): the tokens of each whole text. No shuffle.

    A null or empty text gives an empty array. Other columns pass through; an
    existing column of the name ``ids`` is replaced. Rows may repeat.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in small_batches(batches, text):
            flat, ends = array("i"), array("i", [0])
            for value in batch.column(batch.schema.get_field_index(text)):
                bpe.encode(value.as_py() or "", flat)
                ends.append(len(flat))
            values = pa.ListArray.from_arrays(pa.array(memoryview(ends), pa.int32()), pa.array(memoryview(flat), pa.int32()))
            yield replace_column(batch, ids, values)

    return df.mapInArrow(run, with_column(df.schema, ids, T.ArrayType(T.IntegerType(), False)))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out`` (binary): the bytes of the token ids. Null ids give null. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(batch.schema.get_field_index(ids))), 0).to_numpy())
            start = 0
            while start < batch.num_rows:
                held = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, held + DECODED_IDS, side="right")))
                part = batch.slice(start, stop - start)
                column = part.column(part.schema.get_field_index(ids))
                data, byte_ends = bpe.decode_all(column.flatten().to_numpy())
                last = ends[start:stop] - held  # ids up to each row's end
                bounds = np.concatenate([[0], np.concatenate([[0], byte_ends])[last]]).astype(np.int64)
                whole = pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
                values = pc.if_else(column.is_valid(), whole.cast(pa.binary()), pa.scalar(None, pa.binary()))
                yield replace_column(part, out, values)
                start = stop

    return df.mapInArrow(run, with_column(df.schema, out, T.BinaryType()))


def digests(encoded: DataFrame, path: str, pattern: str, ids: str = "token_ids") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded documents; the ids are decoded for the last."""
    decimal = F.array_join(F.col(ids).cast("array<string>"), " ")
    counted = encoded.select("doc_id", F.size(ids).cast("bigint").alias("n_tokens"), F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"), ids)
    return decode(counted, path, pattern, ids).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return digests(encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern).drop("text"), path, pattern)


QUERIES = {"op2_bpe_codec": op2_bpe_codec}
ORACLES: dict[str, str] = {}
