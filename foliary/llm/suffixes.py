"""Removal of long repeated byte strings with blockwise suffix sorting and a difference cover.

A string of ``LENGTH`` bytes that occurs twice holds the same smallest hash of a
short window at the same place (the leftmost smallest, which depends on the
string alone). So all suffixes whose first ``LENGTH`` bytes can be equal lie in
one suffix bucket: the stretches of starting places that share that anchor.

1. Every document is cut into such stretches; each is named by its anchor's
   hash and by a digest of all bytes that its strings cover.
2. Stretches with equal digests repeat each other in full. Of the others, those
   that share an anchor with a different stretch are compared.
3. Buckets are sorted one block at a time, by the place of the anchor and the
   bytes at both ends of each string; strings that a hash of a few of their bytes
   already tells from all others need no sorting. Long ties are resolved by a difference
   cover: for places whose residues are in the cover, ranks of what follows are
   computed first, by doubling; of two suffixes that tie, the bytes up to the
   next places that both have in the cover agree already, and the ranks there
   decide, in one comparison however long the tie is. Memory is that of a block.
4. A bucket with more than ``HOT`` different stretches may not fit one task. Its
   suffixes become rows of their own with a 128-bit digest of their bytes, which
   are counted wherever they lie, so that bucket is solved as exactly as others.

The same is done for strings of whole words, as a passage may have many words in
fewer bytes: a text is then the row of 64-bit hashes of its words, and all lengths
and places count words instead of bytes.

Each removed byte is covered by a repeated string of the input, whatever else is
removed. Matches never cross documents. Null texts count as empty. Documents
are told apart by doc_id and text; equal rows are documents of their own that
repeat each other, so all their bytes go if there are ``LENGTH`` of them. An
empty table gives no rows. cleaned() replaces columns called n_bytes, n_removed,
n_spans, kept or n_passages and passes all others through.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import drop_written, mapped, slices, table, written
from .shingles import mix, runs_hashed, word_edges

LENGTH = 400
#: Strings of words: how many words, words whose hash makes an anchor, and bytes of a word's hash.
WORDS, WORD_GRAM, WORD_WIDTH = 51, 8, 8
#: Bytes whose hash makes an anchor, and the modulus of the difference cover in bytes and in words; powers of two.
GRAM, MODULUS, WORD_MODULUS = 64, 32, 4
#: Stretches of one bucket, and bytes of one block, that are sorted at once.
HOT, BLOCK = 2000, 2 << 20
#: Suffixes that tie and are compared each with each.
NEAR = 64
#: Units of long texts, or of short ones together, that are hashed at once; arrays of them stay in the processor's cache.
SEGMENT = 1 << 15


def _word_hashes(data: bytes) -> tuple[np.ndarray, bytes]:
    """Where the words begin, and their hashes."""
    begins, ends = word_edges(np.frombuffer(data, np.uint8))
    out, cuts = [], np.unique(np.searchsorted(begins, [*range(0, len(data), SEGMENT), len(data)])).tolist()
    for a, b in zip(cuts, cuts[1:], strict=False):
        part = np.frombuffer(data, np.uint8)[begins[a] : ends[b - 1]]
        out.append(runs_hashed(part, begins[a:b] - begins[a], ends[a:b] - begins[a]).tobytes())
    return begins, b"".join(out)


def word_hashes(data: bytes) -> bytes:
    """The hashes of all words, in their order."""
    return _word_hashes(data)[1]


def words_of(texts: list[bytes]) -> list[bytes]:
    """:func:`word_hashes` of each text."""
    begins, hashes = _word_hashes(b" ".join(texts))
    cuts = WORD_WIDTH * np.searchsorted(begins, np.cumsum([0, *[len(t) + 1 for t in texts]]))
    return [hashes[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]


def _same(texts: list[bytes]) -> list[bytes]:
    return texts


def _anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Per starting place (len(data) - length + 1 of them) the place of its anchor; and the hash at each place."""
    h = data.astype(np.uint64) + np.uint64(1)
    width = 1
    while width < gram:
        more = h[width:] ^ np.uint64(0xD1B54A32D192ED03)
        more *= np.uint64(0xC2B2AE3D27D4EB4F + 2 * width)
        h = h[:-width] * np.uint64(0x9E3779B97F4A7C15)
        h += more
        h ^= np.right_shift(h, np.uint64(29), out=more)
        width *= 2
    places = np.arange(len(h), dtype=np.uint64)
    key = (mix(h) & ~np.uint64((1 << 24) - 1)) | places
    window = length - gram + 1
    # sliding minimum, by doubling
    have = 1
    while 2 * have <= window:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    least = np.minimum(key[: len(key) - (window - have)], key[window - have :])
    return (least & np.uint64((1 << 24) - 1)).astype(np.int64), h


def _gathered(parts: list[tuple[int, int, np.ndarray]], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """:func:`all_stretches` of parts of texts: which text, the part's first place, and its units (``length`` at least)."""
    of, start = (np.array(x) for x in list(zip(*parts, strict=True))[:2])
    base = np.cumsum([0, *[len(p) for _, _, p in parts]])
    anchor, hashes = _anchors(np.concatenate([p for _, _, p in parts]), length, gram)
    cuts = np.unique(np.concatenate([np.flatnonzero(np.diff(anchor)) + 1, base[:-1], base[1:] - length + 1]))
    first, last = cuts[:-1], cuts[1:] - 1
    part = np.searchsorted(base, first, "right") - 1
    inside = first <= base[part + 1] - length  # not over the end of a part
    first, last, part = first[inside], last[inside], part[inside]
    at, moved = anchor[first], start[part] - base[part]
    return hashes[at].view(np.int64), of[part], first + moved, last + moved, at + moved


def all_stretches(texts: list[bytes], length: int = LENGTH, gram: int = GRAM, width: int = 1) -> Iterator[tuple[np.ndarray, ...]]:
    """Hash of the anchor, which text, first and last starting place, and the anchor's place, of each stretch; units have ``width`` bytes."""
    parts, size = [], 0
    for of, text in enumerate(texts):
        units = np.frombuffer(text, np.uint8 if width == 1 else f"u{width}")
        for start in range(0, max(0, len(units) - length + 1), SEGMENT):
            parts.append((of, start, units[start : start + SEGMENT + length - 1]))
            size += len(parts[-1][2])
            if size >= SEGMENT:
                yield _gathered(parts, length, gram)
                parts, size = [], 0
    if parts:
        yield _gathered(parts, length, gram)


def stretches(text: bytes, length: int = LENGTH, gram: int = GRAM, width: int = 1) -> Iterator[tuple[int, int, int, int]]:
    """Hash of the anchor, first and last starting place, and the anchor's place, of each stretch of one text."""
    for anchor, _, low, high, at in all_stretches([text], length, gram, width):
        yield from zip(anchor.tolist(), low.tolist(), high.tolist(), at.tolist(), strict=True)


Views = Callable[[list[bytes]], list[bytes]]


def index(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, view: Views = _same, width: int = 1) -> DataFrame:
    """anchor, digest, doc_id, text_key, low, high, at: the stretches of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data = view([t.encode() for t in batch.column("text").to_pylist()])
            for anchor, of, low, high, at in all_stretches(data, length, gram, width):
                digests = []
                for i, a, b, k in zip(of.tolist(), (low * width).tolist(), ((high + length) * width).tolist(), (at - low).tolist(), strict=True):
                    digest = hashlib.blake2b(data[i][a:b], digest_size=16)
                    digest.update(b"%d" % k)
                    digests.append(digest.digest())
                which = pa.array(of)
                columns = [pa.array(anchor), pa.array(digests, pa.binary()), batch.column("doc_id").take(which), batch.column("text_key").take(which), *[pa.array(x.astype(np.int32)) for x in (low, high, at)]]
                yield pa.RecordBatch.from_arrays(columns, _NAMES)

    return mapped(docs.select("doc_id", "text_key", "text"), run, "anchor long, digest binary, doc_id long, text_key long, low int, high int, at int")


_NAMES = ["anchor", "digest", "doc_id", "text_key", "low", "high", "at"]


@functools.lru_cache(maxsize=None)
def difference_cover(modulus: int) -> tuple[int, ...]:
    """Residues among which every difference modulo ``modulus`` occurs; each one added covers the most new differences."""
    chosen, covered = [0, 1], {0, 1, modulus - 1}
    while len(covered) < modulus:
        gain = lambda x: len({(x - y) % modulus for y in chosen} | {(y - x) % modulus for y in chosen} | covered)
        best = max((x for x in range(modulus) if x not in chosen), key=lambda x: (gain(x), -x))
        covered |= {(best - y) % modulus for y in chosen} | {(y - best) % modulus for y in chosen}
        chosen.append(best)
    return tuple(sorted(chosen))


@functools.lru_cache(maxsize=None)
def shifts(modulus: int) -> np.ndarray:
    """For two residues, how far both have to go to stand in the cover."""
    cover = difference_cover(modulus)
    start = {(y - x) % modulus: x for x in cover for y in cover}
    return np.array([[(start[(j - i) % modulus] - i) % modulus for j in range(modulus)] for i in range(modulus)])


def _ids(*columns: np.ndarray) -> np.ndarray:
    """Ranks of the rows of these columns in their order; equal rows have equal ranks."""
    if len(columns) == 2 and columns[0].dtype == columns[1].dtype == np.int64 and len(columns[0]):
        a, b = columns
        span = int(b.max()) - int(b.min()) + 1
        if (int(a.max()) - int(a.min()) + 1) * span < 1 << 62:  # both fit one number, which sorts faster
            columns = ((a - a.min()) * span + (b - b.min()),)
    order = np.lexsort(columns[::-1]) if len(columns) > 1 else np.argsort(columns[0], kind="stable")
    new = np.zeros(len(order), np.int64)
    for c in columns:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _tied(rank: np.ndarray) -> np.ndarray:
    """Which rows share their rank with another one."""
    return np.bincount(rank)[rank] > 1 if len(rank) else np.zeros(0, bool)


def _may_tie(key: np.ndarray) -> np.ndarray:
    """Which hashes may equal another one: those that share a slot of a table, so all that do, and few that don't."""
    bits = min(24, max(8, (4 * len(key)).bit_length()))
    slot = (key >> np.uint64(64 - bits)).astype(np.int64)
    return np.bincount(slot)[slot] > 1 if len(slot) else np.zeros(0, bool)


def cover_ranks(data: np.ndarray, depth: int, modulus: int, width: int = 1) -> np.ndarray:
    """Ranks of the strings of ``depth`` bytes (a multiple of the modulus) that begin at the places of the cover, by place; by doubling.

    Places are multiples of ``width``, and so are those of the cover.
    """
    cover = np.array(difference_cover(modulus // width)) * width
    rows = (len(data) - modulus) // modulus  # of whole steps
    # one row of the cover's places after the other, so that a step ahead is as many entries ahead as the cover has
    place = (np.arange(rows)[:, None] * modulus + cover).ravel()
    rank = _ids(*[_word(data, place + 8 * k) for k in range(modulus // 8)])

    def ahead(by: int) -> np.ndarray:
        out, step = np.full(len(rank), -1, np.int64), by // modulus * len(cover)
        out[: max(0, len(rank) - step)] = rank[step:]
        return out

    have = modulus
    while have < depth:
        more = min(have, depth - have)
        rank = _ids(rank, ahead(more))
        have += more
    out = np.full(len(data) + modulus, -1, np.int64)
    out[place] = rank
    return out


def _word(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as a number that sorts like them."""
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)[places]).view(">u8").ravel().astype(np.uint64)


def sort_block(bodies: list[bytes], shifts_: list[int], counts: list[int], length: int = LENGTH, modulus: int = MODULUS, width: int = 1, near: int = NEAR) -> list[np.ndarray]:
    """Per stretch: which of its starting places begin strings that repeat among all of these.

    bodies: the bytes that a stretch's strings cover; shifts_: its anchor's place in it. All count bytes, of
    which every ``width``-th one is a starting place. Suffixes are
    sorted by their place before the anchor and by bytes at their ends; of those that tie, two are compared
    by the bytes up to the next places that both have in the cover, and by the ranks there: each with each
    where up to ``near`` tie, else by sorting those of each two residues.
    """
    while 2 * modulus > length:  # a string holds the way to the cover and a whole step behind it
        modulus //= 2
    size = [(len(b) - length) // width + 1 for b in bodies]
    base = np.cumsum([0, *map(len, bodies)])
    spare = np.zeros(2 * modulus + 8, np.uint8)
    data = np.concatenate([np.frombuffer(b"".join(bodies), np.uint8), spare])
    owner = np.repeat(np.arange(len(bodies)), size)
    at = np.concatenate([np.arange(b, b + n * width, width) for b, n in zip(base, size, strict=False)])
    place = (np.array(shifts_) + base[:-1])[owner] - at
    repeated = np.array(counts)[owner] > 1
    # strings whose bytes at a few places, hashed, are those of no other one are in order wherever they stand
    left, key = np.arange(len(at)), mix(place.view(np.uint64))
    for offsets in ([0, length - 8], [length // 2, length // 4, 3 * (length // 4)]):
        for k in offsets:
            key = mix(key ^ _word(data, at[left] + min(k, length - 8)))
        tied = _may_tie(key)
        left, key = left[tied], key[tied]
    # only the stretches of the others are sorted
    some = np.unique(owner[left])
    data = np.concatenate([*[data[base[i] : base[i + 1]] for i in some.tolist()], spare])
    moved = np.zeros(len(bodies), np.int64)
    moved[some] = np.cumsum([0, *(base[some + 1] - base[some]).tolist()])[:-1] - base[some]
    at += moved[owner]
    depth = (length - modulus) // modulus * modulus
    ends = [8 * k for k in range(modulus // 8)]
    tail = sorted({length - 8 - 8 * k for k in range(-(-(length - depth) // 8))})
    group = place[left]
    # bytes at both ends, a few at a time, and only of what still ties
    for offsets in ([ends[0], tail[-1]], [*ends[1:], *tail[:-1]]):
        if not len(left):
            break
        group = _ids(group, *[_word(data, at[left] + k) for k in offsets])
        tied = _tied(group)
        left, group = left[tied], group[tied]
    if len(left):
        ranks, step = cover_ranks(data, depth, modulus, width), shifts(modulus // width) * width
        residue = at[left] % modulus // width
        order = np.argsort(group, kind="stable")
        left, group, residue = left[order], group[order], residue[order]
        small = np.bincount(group)[group] <= near
        one, ahead = np.flatnonzero(small), 1
        while len(one := one[one + ahead < len(group)]) and len(one := one[group[one] == group[one + ahead]]):
            other = one + ahead
            way = step[residue[one], residue[other]]
            same = ranks[at[left[one]] + way] == ranks[at[left[other]] + way]
            repeated[left[one[same]]] = repeated[left[other[same]]] = True
            ahead += 1
        left, group, residue = left[~small], group[~small], residue[~small]
        by = [np.flatnonzero(residue == r) for r in range(modulus // width)]
        for i in range(len(by)):
            for j in range(i, len(by)):
                both = by[i] if i == j else np.concatenate([by[i], by[j]])
                if len(both) < 2 or not len(by[i]) or not len(by[j]):
                    continue
                key = _ids(group[both], ranks[at[left[both]] + step[i, j]])
                if i == j:
                    hit = _tied(key)
                else:
                    first = np.zeros(key.max() + 1, bool)
                    second = first.copy()
                    first[key[: len(by[i])]] = True
                    second[key[len(by[i]) :]] = True
                    hit = (first & second)[key]
                repeated[left[both[hit]]] = True
    return np.split(repeated, np.cumsum(size)[:-1])


def _spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(flags.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, view: Views = _same, width: int = 1) -> DataFrame:
    """doc_id, text_key and runs: first and last of starting places of strings of ``length`` units that occur elsewhere too.

    ``docs`` has doc_id, text_key and text (not null); view makes of its bytes units of ``width`` bytes. Every stretch gets the count of its kind, so as many
    rows leave that join as there are stretches, whatever repeats.
    """
    found = written(index(docs, length, gram, view, width), "stretches")
    kinds = found.groupBy("anchor", "digest").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "text_key", "low", "high", "at")).alias("one"))
    kinds = written(kinds, "kinds")
    buckets = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("n").alias("all")).where(F.col("all") > 1)
    whole = found.join(kinds.select("anchor", "digest", "n"), ["anchor", "digest"]).select("doc_id", "text_key", F.when(F.col("n") > 1, F.struct("low", "high")).alias("run"))
    rivals = kinds.join(buckets.where("kinds > 1").select("anchor", "kinds"), "anchor").select("anchor", "kinds", "n", "one.*")
    wanted = rivals.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("anchor", "kinds", "n", "low", "high", "at")).alias("places"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            columns: list[list] = [[] for _ in range(8)]
            views = view([t.encode() for t in batch.column("text").to_pylist()])
            for doc, key, places, data in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "places")), views, strict=True):
                for p in places:
                    values = (p["anchor"], p["kinds"], p["n"], doc, key, p["low"], p["at"] - p["low"], data[p["low"] * width : (p["high"] + length) * width])
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
                    if len(columns[0]) >= 4000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _CUT_TYPES, strict=True)], _CUT_NAMES)
                        columns = [[] for _ in range(8)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _CUT_TYPES, strict=True)], _CUT_NAMES)

    bodies = written(mapped(docs.join(wanted, ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "places"), cut, _CUT_SCHEMA), "bodies")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in _CUT_NAMES), strict=True):
                if held and size > BLOCK and row[0] != held[-1][0]:
                    yield _sorted(held, length, width)
                    held, size = [], 0
                held.append(row)
                size += len(row[7])
        if held:
            yield _sorted(held, length, width)

    schema = "doc_id long, text_key long, low int, high int"
    cool = mapped(bodies.where(F.col("kinds") <= hot).repartition("anchor").sortWithinPartitions("anchor"), sort, schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, n, doc, key, low, shift, body in zip(*(batch.column(c).to_pylist() for c in _CUT_NAMES), strict=True):
                count = len(body) // width - length + 1
                digest = [hashlib.blake2b(body[k * width : (k + length) * width], digest_size=16).digest() for k in range(count)]
                yield pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), pa.array([n] * count, pa.int64()), pa.array([doc] * count, pa.int64()), pa.array([key] * count, pa.int64()), pa.array(range(low, low + count), pa.int32())], ["digest", "n", "doc_id", "text_key", "low"])

    single = mapped(bodies.where(F.col("kinds") > hot), each, "digest binary, n long, doc_id long, text_key long, low int")
    more = single.groupBy("digest").agg(F.sum("n").alias("all")).where(F.col("all") > 1).select("digest")
    hot_ones = single.join(more, "digest", "left_semi").select("doc_id", "text_key", "low", F.col("low").alias("high"))
    sorted_ones = cool.unionByName(hot_ones).select("doc_id", "text_key", F.struct("low", "high").alias("run"))
    out = written(whole.unionByName(sorted_ones).groupBy("doc_id", "text_key").agg(F.collect_set("run").alias("runs")), "repeats")
    for done in (found, kinds, bodies):
        drop_written(done)
    return out


_CUT_NAMES = ["anchor", "kinds", "n", "doc_id", "text_key", "low", "shift", "body"]
_CUT_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
_CUT_SCHEMA = "anchor long, kinds long, n long, doc_id long, text_key long, low int, shift int, body binary"


def _sorted(held: list[tuple], length: int, width: int) -> pa.RecordBatch:
    flags = sort_block([r[7] for r in held], [r[6] * width for r in held], [r[2] for r in held], length * width, MODULUS if width == 1 else WORD_MODULUS * width, width)
    out: list[list] = [[], [], [], []]
    for (_, _, _, doc, key, low, _, _), f in zip(held, flags, strict=True):
        for a, b in zip(*_spans(f), strict=True):
            for column, value in zip(out, (doc, key, low + int(a), low + int(b)), strict=True):
                column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32())], ["doc_id", "text_key", "low", "high"])


def _covered(size: int, runs: list[tuple[int, int]]) -> np.ndarray:
    """Which bytes lie in any of the runs (first byte, and the one behind the last)."""
    gone = np.zeros(size + 1, np.int32)
    for a, b in runs:
        gone[a] += 1
        gone[b] -= 1
    return np.cumsum(gone[:-1]) > 0


def _passages(data: bytes, runs: list | None, words: int) -> np.ndarray:
    """Which bytes lie in the runs of words, with the white space inside; at an end of the text that beyond too."""
    if not runs:
        return np.zeros(len(data), bool)
    begins, ends = word_edges(np.frombuffer(data, np.uint8))
    begins[0], ends[-1] = 0, len(data)
    return _covered(len(data), [(begins[r["low"]], ends[r["high"] + words - 1]) for r in runs])


def _left(data: bytes, gone: np.ndarray) -> bytes:
    return np.frombuffer(data, np.uint8)[~gone].tobytes() if gone.any() else data


def cleaned(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, words: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text and any others) with kept (the bytes that stay), n_bytes, n_removed and n_spans.

    With ``words``, n_passages has the bytes that lie in strings of so many words that occur elsewhere too.
    The text becomes what stays without these and the others; of a character that a removed run cuts, no bytes
    stay in the text.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import BinaryType, LongType, StructField, StructType

    added = ["n_bytes", "n_removed", "n_spans", "kept", *["n_passages"] * (words is not None)]
    kept = [f for f in docs.schema.fields if f.name not in added]
    row = F.struct(*[F.col(f"`{f.name}`") for f in kept]).alias("row")
    keyed = docs.select(row, F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))
    texts = keyed.select("doc_id", "text_key", "text")
    joined = keyed.select("row", "doc_id", "text_key").join(repeats(texts, length, gram, hot), ["doc_id", "text_key"], "left")
    if words is not None:
        passages = repeats(texts, words, WORD_GRAM, hot, words_of, WORD_WIDTH).withColumnRenamed("runs", "passages")
        joined = joined.join(passages, ["doc_id", "text_key"], "left")
    joined = joined.select(*[F.col("row").getField(f.name).alias(str(i)) for i, f in enumerate(kept)], "runs", *["passages"] * (words is not None))
    schema = StructType([*kept, *[StructField(c, BinaryType() if c == "kept" else LongType()) for c in added]])
    names = to_arrow_schema(StructType(kept)).names
    text = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, str(text)):  # columns by number, as any name may be taken
            data = [(t or "").encode() for t in batch.column(text).to_pylist()]
            gone = [_covered(len(d), [(r["low"], r["high"] + length) for r in runs or ()]) for d, runs in zip(data, batch.column(len(names)).to_pylist(), strict=True)]
            stay = [_left(d, g) for d, g in zip(data, gone, strict=True)]
            made = [pa.array(x, pa.int64()) for x in ([len(d) for d in data], [int(g.sum()) for g in gone], [len(_spans(g)[0]) for g in gone])]
            made.append(pa.array(stay, pa.binary()))
            if words is not None:
                found = [_passages(d, runs, words) for d, runs in zip(data, batch.column(len(names) + 1).to_pylist(), strict=True)]
                made.append(pa.array([int(f.sum()) for f in found], pa.int64()))
                stay = [_left(d, g | f) for d, g, f in zip(data, gone, found, strict=True)]
            left = pa.array([x.decode("utf-8", "ignore") for x in stay], pa.string())
            yield pa.RecordBatch.from_arrays([*[left if i == text else batch.column(i) for i in range(len(names))], *made], [*names, *added])

    return mapped(joined, run, schema)


def report(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, words: int = WORDS) -> DataFrame:
    """What the strings of ``length`` bytes cover, as the contract has it; then the bytes in strings of ``words`` words
    that occur elsewhere (n_passages), and the text without both.

    Such passages can have fewer bytes than ``length``. n_removed, n_spans and kept_sha256 do not count them.
    """
    found = cleaned(docs.select("doc_id", "text"), length, gram, hot, words)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_passages", "text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))
