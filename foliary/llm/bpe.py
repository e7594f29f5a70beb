"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is encoded by halves: leaves are encoded directly, and two encoded
neighbours are joined by encoding a window around their border again. The
window grows until what lies outside can no longer change:

* between texts, until both ends of the window are places where white space
  follows something else; no match of the pattern crosses such a place, and the
  matches on either side of it do not depend on the other side;
* inside one long match, until the tokens at both ends of the window and their
  outer neighbours form pairs that encode to themselves. A token sequence whose
  adjacent pairs all do so is the encoding of its bytes.

Decoding concatenates the bytes of the tokens, halves first, up the same tree.

Null texts count as empty and give no tokens. Rows are independent, so ties,
repeated rows, empty tables and any further columns need no care; further
columns pass through.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import mapped, slices, table, text_or_empty

#: Characters (or ids, in decoding) and bytes of one match that are a leaf of the tree.
LEAF_CHARS = 256
LEAF_BYTES = 64


def load_ranks(path: str) -> bytes:
    """The vocabulary file, read on the driver and sent with the tasks; its size is that of a vocabulary."""
    with open(path, "rb") as f:
        return f.read()


class Codec:
    """Encodes and decodes texts by one table of ranks and one split pattern."""

    def __init__(self, ranks: bytes, pattern: str, leaf_chars: int = LEAF_CHARS, leaf_bytes: int = LEAF_BYTES):
        import regex
        import tiktoken

        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        self._core = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self._split = regex.compile(pattern)
        self.leaf_chars, self.leaf_bytes = leaf_chars, leaf_bytes

    # -- one match of the pattern -------------------------------------------------

    def _direct(self, piece: bytes) -> list[int]:
        return self._core._encode_single_piece(piece)

    def _bytes(self, ids: list[int]) -> bytes:
        return self._core.decode_bytes(ids)

    def _stable(self, left: int, right: int) -> bool:
        return self._direct(self._bytes([left, right])) == [left, right]

    def encode_piece(self, piece: bytes) -> list[int]:
        if len(piece) <= self.leaf_bytes:
            return self._direct(piece)
        half = len(piece) // 2
        left, right = self.encode_piece(piece[:half]), self.encode_piece(piece[half:])
        k = 4
        while k < max(len(left), len(right)):
            a, b = left[-k:], right[:k]
            window = self._direct(self._bytes(a + b))
            before, after = left[:-k], right[k:]
            if (not before or self._stable(before[-1], window[0])) and (not after or self._stable(window[-1], after[0])):
                return before + window + after
            k *= 2
        return self._direct(piece)

    # -- texts ----------------------------------------------------------------------

    def _flat(self, text: str) -> list[int]:
        if len(text) <= self.leaf_chars:
            return self._core.encode_ordinary(text)
        out: list[int] = []
        for match in self._split.finditer(text):
            out += self.encode_piece(match[0].encode())
        return out

    @staticmethod
    def _border(text: str, at: int) -> bool:
        return text[at] in " \n" and not text[at - 1].isspace()

    def _last_border(self, text: str, start: int) -> int:
        """The last border at or behind ``start``, or -1."""
        return next((i for i in range(len(text) - 1, max(start, 1) - 1, -1) if self._border(text, i)), -1)

    def _first_border(self, text: str, stop: int) -> int:
        return next((i for i in range(1, min(stop, len(text))) if self._border(text, i)), -1)

    def _join(self, left: str, a: list[int], right: str, b: list[int]) -> list[int]:
        width = 64
        while True:
            p = self._last_border(left, len(left) - width)
            q = self._first_border(right, width)
            if p < 0 and width >= len(left):
                p = 0
            if q < 0 and width >= len(right):
                q = len(right)
            if p >= 0 and q >= 0:
                break
            width *= 4
        dropped = len(self._flat(left[p:])) if p else len(a)
        skipped = len(self._flat(right[:q])) if q < len(right) else len(b)
        return a[: len(a) - dropped] + self._flat(left[p:] + right[:q]) + b[skipped:]

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.leaf_chars:
            return self._core.encode_ordinary(text)
        half = len(text) // 2
        left, right = text[:half], text[half:]
        return self._join(left, self.encode(left), right, self.encode(right))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf_chars:
            return self._core.decode_bytes(ids)
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


@functools.lru_cache(maxsize=2)
def _codec(ranks: bytes, pattern: str) -> Codec:
    return Codec(ranks, pattern)


def _with(batch: pa.RecordBatch, schema: pa.Schema, **columns: pa.Array) -> pa.RecordBatch:
    arrays = [columns[n] if n in columns else batch.column(n) for n in schema.names]
    return pa.RecordBatch.from_arrays([x.cast(t) for x, t in zip(arrays, schema.types, strict=True)], schema=schema)


Step = tuple[Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], T.StructType]


def _encoding(fields: list[T.StructField], ranks: bytes, pattern: str, text: str) -> Step:
    """What makes of rows of ``fields`` those of :func:`encode`, and their schema."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = [f for f in fields if f.name not in (text, "n_tokens", "token_ids")]
    schema = T.StructType([*kept, T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, pattern)
        for batch in slices(batches, text):
            ids = [codec.encode(x or "") for x in batch.column(text).to_pylist()]
            yield _with(batch, arrow, n_tokens=pa.array([len(x) for x in ids], pa.int64()), token_ids=pa.array([np.asarray(x, "<u4").tobytes() for x in ids], pa.binary()))

    return run, schema


def _decoding(fields: list[T.StructField], ranks: bytes, pattern: str, ids: str) -> Step:
    """What makes of rows of ``fields`` those of :func:`decode`, and their schema."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([*[f for f in fields if f.name != "decoded"], T.StructField("decoded", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, pattern)
        for batch in slices(batches, ids):
            out = [codec.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in batch.column(ids).to_pylist()]
            yield _with(batch, arrow, decoded=pa.array(out, pa.binary()))

    return run, schema


def _read(docs: DataFrame, encoded: T.StructType, text: str) -> DataFrame:
    return docs.select(*[f.name for f in encoded.fields[:-2]], text)


def encode(docs: DataFrame, ranks: bytes, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and ``token_ids``, the ids as little-endian unsigned 32-bit integers, in place of ``text``."""
    run, schema = _encoding(docs.schema.fields, ranks, pattern, text)
    return mapped(_read(docs, schema, text), run, schema)


def decode(tokens: DataFrame, ranks: bytes, pattern: str, ids: str = "token_ids") -> DataFrame:
    """``tokens`` with ``decoded``, the bytes that ``token_ids`` stand for; null ids stand for none."""
    run, schema = _decoding(tokens.schema.fields, ranks, pattern, ids)
    return mapped(tokens, run, schema)


def round_trip(docs: DataFrame, ranks: bytes, pattern: str, text: str = "text") -> DataFrame:
    """What :func:`decode` makes of what :func:`encode` makes of ``docs``, by one worker a task."""
    there, encoded = _encoding(docs.schema.fields, ranks, pattern, text)
    back, schema = _decoding(encoded.fields, ranks, pattern, "token_ids")
    return mapped(_read(docs, encoded, text), lambda batches: back(there(batches)), schema)


def digests(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """Per document: the number of tokens and digests of the ids and of what they decode to."""
    both = decode(encode(text_or_empty(docs.select("doc_id", "text")), ranks, pattern), ranks, pattern)
    return both.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
