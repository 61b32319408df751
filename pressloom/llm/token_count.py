"""Token counts by heap-and-linked-list byte-pair merging (operator 9).

The characters of a text form a linked list; a heap holds the adjacent pairs
that are pieces of the vocabulary. The pair of lowest rank (leftmost among
equals) is merged until no pair is left. The count is the number of initial
symbols minus the number of merges; no token identifiers are made.

A character that is no piece stands as its UTF-8 bytes (byte fallback), which
never merge. As no piece has a word end before a word begin, merges never cross
from a word to the spaces of the next one, and each stretch "spaces + word" is
counted by itself; that property is checked when the vocabulary is loaded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.llm.common import replace_column, small_batches, table, with_column

SPACE = "▁"  # the sign that stands for a space in pieces
CACHED_WORDS = 300_000


class PieceCounter:
    """Counts the tokens that a sentencepiece BPE model with byte fallback gives."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        ids = [i for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i))]
        if sum(map(m.is_byte, range(m.get_piece_size()))) != 256 or any(map(m.is_unused, ids)):
            raise ValueError("a BPE model with byte fallback and without unused pieces is needed")
        #: rank of each piece, the lowest merges first
        self.rank = {m.id_to_piece(i): -m.get_score(i) for i in ids}
        if any(c not in self.rank for p in self.rank for c in p):
            raise ValueError("a piece holds a character that is no piece")
        crossing = re.compile(f"[^{SPACE}]{SPACE}")
        by_word = not any(crossing.search(p) for p in self.rank)
        self.stretches = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if by_word else r"(?s).+")
        self.recent: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def _merged(self, text: str) -> int:
        """Symbols of ``text`` minus merges."""
        rank, n = self.rank, len(text)
        count = sum(1 if c in rank else len(c.encode("utf-8")) for c in text)
        if n < 2:
            return count
        ends = list(range(1, n + 1))  # of the symbol that begins here; 0: merged into the one before
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(text[i:i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, end = heappop(heap)
            middle = ends[i]
            if not middle or middle >= end or ends[middle] != end:
                continue  # one of the two symbols has changed since
            ends[i], ends[middle] = end, 0
            count -= 1
            if end < n:
                before[end] = i
                if (r := rank.get(text[i:ends[end]])) is not None:
                    heappush(heap, (r, i, ends[end]))
            if i and (r := rank.get(text[(j := before[i]):end])) is not None:
                heappush(heap, (r, j, end))
        return count

    def count(self, text: str) -> int:
        recent, older, total = self.recent, self.older, 0
        for word in self.stretches.findall(self.model.normalize(text)):
            n = recent.get(word)
            if n is None:
                n = older.get(word) or self._merged(word)
                if len(word) <= 64:
                    if len(recent) >= CACHED_WORDS:
                        self.older = older = recent
                        self.recent = recent = {}
                    recent[word] = n
            total += n
        return total


_loaded: dict[str, PieceCounter] = {}


def counter(path: str) -> PieceCounter:
    """The counter of a model file, built once in each Python worker."""
    if path not in _loaded:
        _loaded[path] = PieceCounter(path)
    return _loaded[path]


def count_tokens(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``df`` with ``out`` (bigint): the number of tokens of each whole text. No shuffle.

    A null or empty text counts 0. Other columns pass through; an existing column
    of the name ``out`` is replaced. Rows may repeat.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch in small_batches(batches, text):
            texts = batch.column(batch.schema.get_field_index(text))
            yield replace_column(batch, out, pa.array([count(t.as_py() or "") for t in texts], pa.int64()))

    return df.mapInArrow(run, with_column(df.schema, out, T.LongType()))


TOKEN_LIMIT = 4096


def op9_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint")
    return count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


QUERIES = {"op9_token_count": op9_token_count}
ORACLES: dict[str, str] = {}
