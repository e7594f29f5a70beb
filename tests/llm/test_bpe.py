import hashlib
import random
import struct

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from foliary.llm import bpe

RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(RANKS, public_tokenizers.PATTERN, leaf_chars=16, leaf_bytes=8)


def check(codec, text):
    ids = codec.encode(text)
    assert ids == codec._core.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


@pytest.mark.parametrize(
    "text",
    ["", " ", "a", "a" * 5000, " " * 3000 + "x", "\n\n \t" * 500, "don't we'll " * 200, "word " * 3000, "é漢字" * 900, "0123456789" * 400, "a'r" + "e " * 30, "%%% &&& " * 300, "x" * 4095 + " " + "y" * 4097],
)
def test_same_as_direct_encoding(codec, text):
    check(codec, text)


def test_random_texts(codec):
    rng = random.Random(5)
    for _ in range(400):
        letters = rng.choice(["ab ", "the ing\n", "'sred ", "éßñ字 x1", " \n\tab", "0a!"])
        check(codec, "".join(rng.choice(letters) for _ in range(rng.randint(0, 400))))


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    check(bpe._codec(RANKS, public_tokenizers.PATTERN), text)
    check(SMALL, text)


SMALL = bpe.Codec(RANKS, public_tokenizers.PATTERN, leaf_chars=8, leaf_bytes=4)


def test_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "Hello, world", None), (3, "Hello, world", None), (4, "long text " * 20000, "s")], "doc_id long, text string, token_ids string")
    rows = {(r.doc_id, r.n_tokens): r for r in bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()}
    assert len(rows) == 4
    ids = SMALL._core.encode_ordinary("Hello, world")
    assert rows[3, len(ids)].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
    assert rows[3, len(ids)].decoded_sha256 == hashlib.sha256(b"Hello, world").hexdigest()
    assert rows[1, 0].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert bpe.digests(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
