"""Operators 2 and 9 against the libraries."""

import base64
import random

import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken

from pressloom.llm.bpe_codec import ByteBpe, decode, digests, encode
from pressloom.llm.token_count import PieceCounter, count_tokens

RANKS, PIECES = P.path("byte_bpe_50k.tiktoken"), P.path("piece_bpe_32k.model")
ALPHABETS = ["ab", "abc ", "etaoin shrdlu", "aA1 \n\t!?", "éèß漢字😀 a▁", "0123456789", "  \n\r\x1c\x85 x\0", "<s>unk</s>'s'll've t", "aaaaaaaab"]
EDGES = [None, "", " ", "  ", "a", "\n\n \n", "x" * 5000, "<|endoftext|> and </s>", "漢" * 300, " leading", "▁▁a ▁"]


def texts(n):
    rng = random.Random(11)
    return ["".join(rng.choices(rng.choice(ALPHABETS), k=rng.randint(0, 80))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoder_equals_library(library):
    bpe = ByteBpe.from_file(RANKS, P.PATTERN)
    for t in texts(4000) + [t or "" for t in EDGES]:
        ids = bpe.encode(t)
        assert list(ids) == library.encode_ordinary(t), t
        assert bpe.decode(ids) == t.encode()


def test_encoder_leaves_out_tokens_that_merges_cannot_make():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"xyz": 259}
    bpe = ByteBpe(ranks, r"(?s).+")
    lib = tiktoken.Encoding("own", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
    for t in ["abc", "abcabc", "xyz", "axyz", "bcab", "abbc"]:
        assert list(bpe.encode(t)) == lib.encode_ordinary(t), t


def test_vocabulary_without_all_bytes_is_refused():
    with pytest.raises(ValueError):
        ByteBpe({b"a": 0}, r".+")


def test_encode_frame(spark, library):
    rows = [(i, t, "kept") for i, t in enumerate(EDGES)] + [(None, "null id", None), (3, "twice", "x"), (3, "twice", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, Token_IDs string")  # a clashing column is replaced
    out = encode(df, RANKS, P.PATTERN)
    assert out.columns == ["doc_id", "text", "token_ids"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert list(r.token_ids) == library.encode_ordinary(r.text or "")
    back = decode(out, RANKS, P.PATTERN).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back)
    assert encode(df.limit(0), RANKS, P.PATTERN).count() == 0


def test_digests(spark):
    import hashlib

    df = spark.createDataFrame([(1, "hello world"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in digests(encode(df, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()}
    assert got[2].n_tokens == 0 and got[2].ids_sha256 == hashlib.sha256(b"").hexdigest() == got[2].decoded_sha256
    assert got[1].decoded_sha256 == hashlib.sha256(b"hello world").hexdigest()


def test_counter_equals_library():
    lib, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), PieceCounter(PIECES)
    for t in texts(4000) + [t or "" for t in EDGES]:
        assert own.count(t) == len(lib.encode(t)), t


def test_count_frame(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = [(i, t, "kept") for i, t in enumerate(EDGES)] + [(None, "null id", None), (3, "twice", "x"), (3, "twice", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_Tokens string")
    out = count_tokens(df, PIECES)
    assert out.columns == ["doc_id", "text", "n_tokens"]
    got = out.collect()
    assert len(got) == len(rows) and all(r.n_tokens == len(lib.encode(r.text or "")) for r in got)
    assert count_tokens(df.limit(0), PIECES).count() == 0
