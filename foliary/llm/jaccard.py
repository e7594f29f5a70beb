"""N-gram Jaccard join of all documents: pivots, Voronoi cells, windows, recursion; the result is exact.

Jaccard distance is a metric, but documents without a near copy stand at
distance 1 from every pivot, so pivots drawn from the whole corpus separate
nothing. The cells of the first level are therefore found by keys that every
linked pair shares, and Voronoi cells divide those further:

1. Equal sets of shingles are one point.
2. A point that is linked with any other shares a known number of the smallest
   hashes of its set with it (prefixes of sorted sets). Points with fewer hashes
   that anybody else holds are done. This leaves a tenth to a fifth of a usual
   corpus.
3. The sets of the others are split by hash into more parts than a linked pair
   can have differing elements, so a linked pair agrees in a part. The pivot of
   a part is the member of least hash, and the cell of a pivot are all members
   of its parts; a point stands in the cells of all its pivots.
4. Inside cells points are compared as folded sets (counts of elements in hash
   bins). Their Jaccard distance (sum of minima over sum of maxima) is a metric
   as well and never above that of the sets. A cell with more than ``CELL``
   points is cut into classes of size that overlap, so that all of a class are
   folded alike, and divided by up to ``PIVOTS`` pivots: every point goes to its nearest
   pivot and, if its distance to another pivot is within twice the distance of a
   link of that, to that cell also (triangle inequality), so each linked pair
   meets where one of them is at home. Cells are divided again until they are
   small. Where distances are too even for that to help, pairs of blocks are
   compared.
5. Chains of points whose folded sets are near enough are groups. Groups are
   solved on the sets themselves, in one block; of larger groups, all members
   first meet a few pivots, and then only those outside the largest component
   meet the others, in pairs of blocks.

No list of pairs is ever made: each task returns a spanning forest of its links.

The operator returns classes: one row per document with its component. Null or
blank texts have an empty set and link with nothing. A doc_id may stand on several
texts: each of their sets is a point of its own. In component ids, sets of equal
smallest doc_id are one node, as in the SQL; survivors() goes by the sets alone.
A row with a null doc_id links with nothing and has a null component. Repeated
rows are copies of each other. An empty table gives no rows. Columns other than
doc_id and text are ignored by classes() and kept by survivors(), whatever their
names (but ``_text_key``).
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import components
from .shared import drop_written, mapped, runs, slices, table, written
from .shingles import mix, sets

BATCH = 1 << 19
#: Parts beyond those that a pair needs to agree in one; so many empty parts give no key.
SPARE = 2
#: Per cent of a set that its prefix has beyond the shortest one that shows a link.
EXTRA = 5
#: Entries (key, id) that a task holds at least before it deals them out.
DEALT = 1 << 19
#: Points of a cell that are compared at once, pivots that divide a larger one, points and elements of a block.
CELL, PIVOTS, BLOCK, ELEMENTS = 256, 16, 1024, 1 << 22
#: Rows that meet the pivots of one cell in a task, rows that may come from one there, and the least number of bins of a folded set.
MET, COPIES, LEAST = 4096, 3, 32


@functools.lru_cache(maxsize=None)
def _bounds(percent: int, most: int) -> np.ndarray:
    """Largest sizes of the size classes: a linked pair is in the same class or in adjacent ones."""
    out = [1]
    while out[-1] < most:
        out.append(max(out[-1] + 1, 100 * out[-1] // percent))
    return np.array([*out, max(out[-1] + 1, 100 * out[-1] // percent)], np.int64)


def part_keys(many: list[np.ndarray], percent: int) -> list[np.ndarray]:
    """Per set: the keys of its parts, for its size class and the one below."""
    sizes = np.array([len(s) for s in many], np.int64)
    top = _bounds(percent, 1 << max(10, int(sizes.max(initial=1)).bit_length()))
    own = np.searchsorted(top, sizes)
    out: list[list[np.ndarray]] = [[] for _ in many]
    flat = np.concatenate(many) if many else np.zeros(0, np.uint64)
    for below in (0, 1):
        group = own - below
        # |A ^ B| = n1 + n2 - 2 i and 100 i >= percent (n1 + n2 - i)
        differ = np.where(group >= 0, (top[np.maximum(group, 0)] + top[np.maximum(group, 0) + 1]) * (100 - percent) // (100 + percent), 0)
        parts = np.where((differ > 0) & (sizes > 0), differ + 1 + SPARE, 0)
        first = np.concatenate([[0], np.cumsum(parts)])
        doc = np.repeat(np.arange(len(many)), sizes)
        used = parts[doc] > 0
        if not used.any():
            continue
        doc, h = doc[used], flat[used]
        part = first[doc] + (mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(1)).astype(np.int64) % parts[doc]
        order = np.argsort(part, kind="stable")
        begins = np.flatnonzero(np.diff(part[order], prepend=-1))
        total = np.zeros(first[-1], np.uint64)
        full = np.zeros(first[-1], bool)
        at = part[order][begins]
        total[at] = np.add.reduceat(mix(h)[order], begins)
        full[at] = True
        owner = np.repeat(np.arange(len(many)), parts)
        index = np.arange(first[-1]) - first[owner]
        key = mix(total * np.uint64(3) + mix((group[owner] << 32).astype(np.uint64) + index.astype(np.uint64)))
        empty = np.bincount(owner, weights=~full, minlength=len(many))
        kept = full | (empty[owner] > SPARE)
        for i in np.flatnonzero(parts):
            a, b = first[i], first[i + 1]
            out[i].append(key[a:b][kept[a:b]])
    return [np.concatenate(k) if k else np.zeros(0, np.uint64) for k in out]


def prefix(one: np.ndarray, percent: int) -> np.ndarray:
    """The smallest hashes of a set. A linked pair of sets has :func:`least_shared` of them in common in both prefixes.

    Of the common elements of a pair, in order, the k-th is preceded in a set of n by at most n - need others that are not common.
    """
    need = -(-percent * len(one) // 100)
    return one[: len(one) - need - (-EXTRA * len(one) // 100)]


def least_shared(n: Column, percent: int) -> Column:
    """How many hashes of its prefix a set of n shares with any set linked to it, that is with one of percent % of n at least."""
    need = F.floor((n * percent + 99) / 100)
    return F.floor((need * EXTRA + 99) / 100)


def bins(n: np.ndarray) -> np.ndarray:
    """Number of bins, a power of two, of the folded set of n elements; it never falls, and twice as many elements have twice the bins at most."""
    bits = np.frexp(np.maximum(n, 2) - 1)[1]
    return 1 << np.maximum(LEAST.bit_length() - 1, np.maximum(np.minimum(bits - 2, 8), bits - 3)).astype(np.int64)


def folded(one: np.ndarray) -> np.ndarray:
    """Counts of the elements by their leading bits."""
    width = int(bins(np.array(len(one))))
    counts = np.bincount((one >> np.uint64(65 - width.bit_length())).astype(np.int64), minlength=width)
    if counts.max(initial=0) > 65535:
        raise ValueError("hashes of shingles are not spread")
    return counts.astype(np.uint16)


def _fewer(rows: np.ndarray) -> np.ndarray:
    return rows[:, ::2] + rows[:, 1::2]


def _minima(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of minima of each row of a with each of b, in slices of bounded size."""
    out = np.empty((len(a), len(b)), np.int64)
    if max(a.max(initial=0), b.max(initial=0)) < 256:
        a, b = a.astype(np.uint8), b.astype(np.uint8)
    step = max(1, (1 << 22) // max(1, b.size))
    for i in range(0, len(a), step):
        out[i : i + step] = np.minimum(a[i : i + step, None, :], b[None, :, :]).sum(2, dtype=np.uint32)
    return out


class Forest:
    """Links between places of a list, without those that close a circle."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.links: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def link(self, a: int, b: int) -> None:
        ra, rb = self.root(a), self.root(b)
        if ra != rb:
            self.up[ra] = rb
            self.links.append((a, b))


def near_folded(sizes: np.ndarray, data: list[bytes], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs whose folded sets are near enough for a link; only pairs of two sides if there are two."""
    forest, two = Forest(len(sizes)), side.any()
    widths, own = np.array([len(d) // 2 for d in data]), bins(sizes)
    for width in np.unique(widths):
        low, high = np.flatnonzero(widths == width), np.flatnonzero(widths == 2 * width)
        rows = np.frombuffer(b"".join(data[i] for i in low), np.uint16).reshape(len(low), width)
        if len(high):
            more = np.frombuffer(b"".join(data[i] for i in high), np.uint16).reshape(len(high), 2 * width)
            rows = np.concatenate([rows, _fewer(more)])
        who = np.concatenate([low, high])
        order = np.argsort(sizes[who], kind="stable")
        who, rows = who[order], rows[order]
        n = sizes[who]
        # those of more bins, which are larger, are guests here and meet each other in their own class
        home = int((own[who] <= width).sum())
        for a in range(0, home, 32):
            b = min(a + 32, home)
            end = int(np.searchsorted(n, 100 * n[b - 1] // percent, side="right"))
            common = _minima(rows[a:b], rows[a:end])
            union = n[a:b, None] + n[None, a:end] - common
            ok = (100 * common >= percent * union) & (np.arange(a, end)[None, :] > np.arange(a, b)[:, None])
            if two:
                ok &= side[who[a:b], None] != side[None, who[a:end]]
            for i, j in zip(*np.nonzero(ok), strict=True):
                forest.link(int(who[a + i]), int(who[a + j]))
    return forest.links


def linked_sets(sizes: np.ndarray, data: list[bytes], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the linked pairs of sets; only pairs of two sides if there are two."""
    forest, two = Forest(len(sizes)), side.any()
    flat = np.frombuffer(b"".join(data), np.uint64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(flat, kind="stable")
    new = np.diff(flat[order], prepend=flat[order][:1]) != 0
    word = np.empty(len(flat), np.int64)
    word[order] = np.cumsum(new)
    holders, first = owner[order], np.concatenate([np.flatnonzero(np.concatenate([[True], new[1:]])), [len(flat)]])
    often = np.diff(first)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    for i in range(len(sizes)):
        if two and side[i]:
            continue
        mine = word[ends[i] : ends[i + 1]]
        mine = mine[often[mine] > 1]
        if not len(mine):
            continue
        count = often[mine]
        places = np.repeat(first[mine] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        common = np.bincount(holders[places], minlength=len(sizes))
        ok = (common > 0) & (100 * common >= percent * (sizes[i] + sizes - common))
        ok[: i + 1] &= two
        if two:
            ok &= side != side[i]
        for j in np.flatnonzero(ok):
            forest.link(i, int(j))
    return forest.links


def _text_key() -> Column:
    """Tells the texts of one doc_id apart."""
    return F.xxhash64("text")


def _digest(one: np.ndarray) -> bytes | None:
    return hashlib.blake2b(one.tobytes(), digest_size=16).digest() if len(one) else None


def _known(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key (digest of the set; null if empty) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH):
            found = sets([(t or "").encode() for t in batch.column("text").to_pylist()], width)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("text_key"), pa.array([len(s) for s in found], pa.int64()), pa.array([_digest(s) for s in found], pa.binary())],
                ["doc_id", "text_key", "n_shingles", "set_key"],
            )

    return mapped(docs.select("doc_id", "text", _text_key().alias("text_key")), run, "doc_id long, text_key long, n_shingles long, set_key binary")


def _tag(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big", signed=True)


#: Ids and packed keys of the rows of some batches.
Entries = Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[int, bytes]]]


def _prefixes(width: int, percent: int) -> Entries:
    """The leading bytes of the set's digest, and its prefix, of every text that has a set."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
        for batch in slices(batches, "text", BATCH):
            for s in sets([(t or "").encode() for t in batch.column("text").to_pylist()], width):
                if len(s):
                    yield _tag(_digest(s)), prefix(s, percent).tobytes()

    return entries


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    for batch in batches:
        yield from zip(batch.column("id").to_pylist(), batch.column("keys").to_pylist(), strict=True)


def _dealt(keys: np.ndarray, ids: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of bucket, whether they are sure, packed keys and ids.

    Of a key with more than two ids here, two go to its bucket; the others are known to share it and
    are spread evenly, so that no bucket has to hold all ids of a frequent key.
    """
    bucket = (mix(keys) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((ids, keys, bucket))
    keys, ids, bucket = keys[order], ids[order], bucket[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
    keys, ids, bucket = keys[new], ids[new], bucket[new]
    third = np.zeros(len(keys), bool)
    third[2:] = keys[2:] == keys[:-2]
    for sure in (False, True):
        at = np.flatnonzero(third == sure)
        if not len(at):
            continue
        cuts = np.flatnonzero(np.diff(bucket[at])) + 1 if not sure else np.arange(1 << 15, len(at), 1 << 15)
        pieces = np.split(at, cuts)
        where = [int(bucket[p[0]]) if not sure else int(mix(ids[p[:1]].view(np.uint64))[0] % np.uint64(buckets)) for p in pieces]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(where, pa.int32()),
                pa.array([sure] * len(pieces), pa.bool_()),
                # six bytes tell keys apart well enough: a chance agreement only adds a candidate
                pa.array([keys[p].view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for p in pieces], pa.binary()),
                pa.array([ids[p].tobytes() for p in pieces], pa.binary()),
            ],
            ["bucket", "sure", "keys", "ids"],
        )


def _unpacked(packed: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :6] = raw
    return out.view(np.int64).ravel()


def shared_keys(keyed: DataFrame, entries: Entries = _packed) -> DataFrame:
    """key, id of the entries whose key is held by two different ids at least; ``keyed`` has id and packed keys, or what ``entries`` makes them of.

    The entries are dealt to buckets of keys in packed form, 14 bytes each, by the worker that makes them. Rows may repeat.
    """
    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = parts * max(1, min(4, 8192 // parts))
    most = max(DEALT, 4 * buckets)  # some entries for each bucket

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[bytes] = []
        ids: list[np.ndarray] = []
        held = 0
        for i, k in entries(batches):
            keys.append(k)
            ids.append(np.full(len(k) // 8, i, np.int64))
            held += len(k) // 8
            if held >= most:
                yield from _dealt(np.frombuffer(b"".join(keys), np.uint64), np.concatenate(ids), buckets)
                keys, ids, held = [], [], 0
        if held:
            yield from _dealt(np.frombuffer(b"".join(keys), np.uint64), np.concatenate(ids), buckets)

    def of(keys: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, pa.int64())], ["key", "id"])

    def found(packed: list[bytes], held: list[bytes]) -> pa.RecordBatch:
        keys, ids = _unpacked(packed), np.frombuffer(b"".join(held), np.int64)
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
        keys, ids = keys[new], ids[new]
        same = keys[1:] == keys[:-1]
        often = np.zeros(len(keys), bool)
        often[1:] |= same
        often[:-1] |= same
        return of(keys[often], ids[often])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed: list[bytes] = []
        held: list[bytes] = []
        now = None
        for batch in batches:
            for bucket, sure, k, i in zip(*(batch.column(c).to_pylist() for c in ("bucket", "sure", "keys", "ids")), strict=True):
                if sure:
                    yield of(_unpacked([k]), np.frombuffer(i, np.int64))
                    continue
                if bucket != now and packed:
                    yield found(packed, held)
                    packed, held = [], []
                now = bucket
                packed.append(k)
                held.append(i)
        if packed:
            yield found(packed, held)

    rows = mapped(keyed, deal, "bucket int, sure boolean, keys binary, ids binary")
    return mapped(rows.repartition(parts, "bucket").sortWithinPartitions("bucket"), find, "key long, id long")


def _sets_of(docs: DataFrame, width: int) -> DataFrame:
    """id, n and items (the packed set) of rows of id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH):
            found = sets([(t or "").encode() for t in batch.column("text").to_pylist()], width)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], ["id", "n", "items"])

    return mapped(docs.select("id", "text"), run, "id long, n long, items binary")


def _parts(percent: int) -> Entries:
    """Ids and the keys of the parts of every set."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
        for batch in slices(batches, "items", BATCH):
            made = part_keys([np.frombuffer(s, np.uint64) for s in batch.column("items").to_pylist()], percent)
            yield from zip(batch.column("id").to_pylist(), (m.tobytes() for m in made), strict=True)

    return entries


def _folds(items: DataFrame) -> DataFrame:
    """id, n, fold and data: each set folded to its own number of bins, and to half as many, at which it meets the next smaller class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "items", BATCH):
            own = [folded(np.frombuffer(s, np.uint64)) for s in batch.column("items").to_pylist()]
            half = [_fewer(f[None, :])[0] if len(f) > LEAST else None for f in own]
            for made in (own, half):
                at = [i for i, f in enumerate(made) if f is not None]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(at, pa.int64())), batch.column("n").take(pa.array(at, pa.int64())), pa.array([len(made[i]) for i in at], pa.int32()), pa.array([made[i].tobytes() for i in at], pa.binary())],
                    ["id", "n", "fold", "data"],
                )

    return mapped(items, run, "id long, n long, fold int, data binary")


Solve = Callable[[np.ndarray, list[bytes], np.ndarray, int], list[tuple[int, int]]]


def _key(data: DataFrame) -> list[str]:
    return [c for c in ("id", "fold") if c in data.columns]


def _solved(rows: DataFrame, data: DataFrame, solve: Solve, percent: int) -> DataFrame:
    """a, b: links inside each group; rows have group, id and side, data id, n and data (and both fold, if one has)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("group", "id", "side", "n", "data")), strict=True):
                if held and row[0] != held[-1][0]:
                    yield done(held)
                    held = []
                held.append(row)
        if held:
            yield done(held)

    def done(held: list[tuple]) -> pa.RecordBatch:
        _, ids, side, n, packed = zip(*held, strict=True)
        found = solve(np.array(n, np.int64), list(packed), np.array(side, np.int64), percent)
        return pa.RecordBatch.from_arrays([pa.array([ids[a] for a, _ in found], pa.int64()), pa.array([ids[b] for _, b in found], pa.int64())], ["a", "b"])

    of = _key(data)
    both = rows.select("group", "side", *of).join(data, of).select("group", "id", "side", "n", "data")
    return mapped(both.repartition("group").sortWithinPartitions("group"), run, "a long, b long")


def _in_blocks(rows: DataFrame, blocks: Column) -> DataFrame:
    """Every pair of blocks of each cell as a group of two sides; a block with itself as one of one side."""
    own = F.pmod(F.xxhash64("id", F.lit(7)), blocks)
    of = _key(rows)
    dealt = rows.select("cell", *of, own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    return dealt.select(F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")).alias("group"), *of, (F.col("own") > F.col("other")).cast("int").alias("side"))


def _pivots(rows: DataFrame, level: int) -> DataFrame:
    """Up to ``PIVOTS`` members of each cell, by hash: one of each part that has any."""
    part = F.pmod(F.xxhash64("id", F.lit(-level)), F.lit(PIVOTS))
    drawn = F.min(F.struct(F.xxhash64("id", F.lit(level)).alias("draw"), *_key(rows), "m")).alias("p")
    return rows.groupBy("cell", part.alias("part")).agg(drawn).select("cell", "p.*").drop("draw")


def _met(rows: DataFrame, pivots: DataFrame, data: DataFrame, judge: Callable, schema: str) -> DataFrame:
    """What ``judge`` makes of the members of each cell (size m) and its pivots, which come to every share of a large cell."""
    shares = F.ceil(F.col("m") / MET).cast("int")
    of = _key(data)
    members = rows.select("cell", F.pmod(F.xxhash64("id"), shares).cast("int").alias("share"), F.lit(1).alias("kind"), *of)
    first = pivots.select("cell", F.explode(F.sequence(F.lit(0), shares - 1)).alias("share"), F.lit(0).alias("kind"), *of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for (cell, share, kind), part in runs(batches, "cell", "share", "kind"):
            one = list(zip(*(part.column(c).to_pylist() for c in ("id", "n", "data")), strict=True))
            if kind:
                yield judge(cell, held, one)
            else:
                held = [*(held if now == (cell, share) else []), *one]
                now = (cell, share)

    both = members.unionByName(first).join(data, of).select("cell", "share", "kind", "id", "n", "data")
    return mapped(both.repartition("cell", "share").sortWithinPartitions("cell", "share", "kind", "id"), run, schema)


def _folded_distances(members: list[tuple], pivots: list[tuple]) -> np.ndarray:
    """Jaccard distances of sets that are folded to one number of bins; only then they are one metric."""
    rows, others = (np.stack([np.frombuffer(d, np.uint16) for _, _, d in some]) for some in (members, pivots))
    n, size = (np.array([x for _, x, _ in some], np.int64) for some in (members, pivots))
    common = _minima(rows, others)
    return 1 - common / (n[:, None] + size[None, :] - common)


def voronoi(percent: int) -> Callable:
    """The cells of a cell's members: that of the nearest pivot, and all others in the window of a link.

    Where the windows hold so many cells that more than ``COPIES`` rows would come from a member, dividing
    is no use, and one row without an id says so.
    """

    def judge(cell: int, pivots: list[tuple], members: list[tuple]) -> pa.RecordBatch:
        distance = _folded_distances(members, pivots)
        window = distance <= distance.min(1, keepdims=True) + 2 * (100 - percent) / 100 + 1e-9
        if window.sum() > COPIES * len(members):
            return pa.RecordBatch.from_arrays([pa.array([cell], pa.int64()), pa.array([cell], pa.int64()), pa.array([None], pa.int64()), pa.array([0], pa.int32())], ["parent", "cell", "id", "fold"])
        at, to = np.nonzero(window)
        ids, names = np.array([m[0] for m in members], np.int64), np.array([p[0] for p in pivots], np.int64)
        cells = mix(np.full(len(to), cell, np.int64).view(np.uint64) * np.uint64(3) + mix(names[to].view(np.uint64))).view(np.int64)
        fold = np.full(len(to), len(members[0][2]) // 2, np.int32)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(to), cell, np.int64)), pa.array(cells), pa.array(ids[at]), pa.array(fold)], ["parent", "cell", "id", "fold"])

    return judge


def star(percent: int) -> Callable:
    """Links of a cell's members with its pivots."""

    def judge(cell: int, pivots: list[tuple], members: list[tuple]) -> pa.RecordBatch:
        a, b = [], []
        for x, n, packed in members:
            mine = np.frombuffer(packed, np.uint64)
            for y, size, other in pivots:
                common = int(np.isin(mine, np.frombuffer(other, np.uint64), assume_unique=True).sum()) if x != y and 100 * min(n, size) >= percent * max(n, size) else 0
                if common and 100 * common >= percent * (n + size - common):
                    a.append(x)
                    b.append(y)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return judge


def _candidates(cells: DataFrame, folds: DataFrame, percent: int) -> list[DataFrame]:
    """a, b: chains of points in a common cell (cell, id) whose folded sets are near enough for a link.

    Distances of different foldings are no common metric. A large cell is therefore cut by the number of
    bins first; each point is in the class of its own number and, folded once more, in the next smaller one.
    """
    found: list[DataFrame] = []
    own = folds.groupBy("id").agg(F.max("fold").alias("fold"))
    todo, level = cells.join(own, "id"), 0
    whole = [F.col("cell").alias("group"), "id", "fold", F.lit(0).alias("side")]
    while True:
        sized = written(todo.join(todo.groupBy("cell").agg(F.count("*").alias("m")).where("m > 1"), "cell"), "sized")
        found.append(written(_solved(sized.where(F.col("m") <= CELL).select(*whole), folds, near_folded, percent), "candidates"))
        large = sized.where(F.col("m") > CELL)
        if large.isEmpty():
            drop_written(sized)
            return found
        level += 1
        if level == 1:
            both = F.when(F.col("fold") > LEAST, F.array(F.col("fold"), (F.col("fold") / 2).cast("int"))).otherwise(F.array("fold"))
            classed = large.select("cell", "id", F.explode(both).alias("fold"))
            todo = written(classed.select(F.xxhash64("cell", "fold").alias("cell"), "id", "fold"), "cells")
            drop_written(sized)
            continue
        parted = written(_met(large, _pivots(large, level), folds, voronoi(percent), "parent long, cell long, id long, fold int"), "parted")
        work = parted.groupBy("parent", "cell").agg(F.count("id").alias("c"), F.min(F.col("id").isNotNull()).alias("ok")).groupBy("parent").agg(F.sum(F.col("c") * F.col("c")).alias("work"), F.min("ok").alias("ok"))
        # a division that does not halve the pairs is no use either
        helped = work.join(large.groupBy(F.col("cell").alias("parent")).agg(F.first("m").alias("m")), "parent").where("ok AND 2 * work <= m * m").select("parent")
        helped = written(helped, "helped")
        even = large.join(helped.select(F.col("parent").alias("cell")), "cell", "left_anti")
        found.append(written(_solved(_in_blocks(even, F.ceil(F.col("m") / BLOCK).cast("int")), folds, near_folded, percent), "candidates"))
        todo = written(parted.join(helped, "parent", "left_semi").select("cell", "id", "fold"), "cells")
        for done in (sized, parted, helped):
            drop_written(done)


def _links(groups: DataFrame, items: DataFrame, percent: int) -> list[DataFrame]:
    """a, b: links that join the linked points of each group (cell, id)."""
    data = items.withColumnRenamed("items", "data")
    sizes = groups.join(items.select("id", "n"), "id").groupBy("cell").agg(F.count("*").alias("m"), F.sum("n").alias("elements"))
    fits = (F.col("m") <= BLOCK) & (F.col("elements") <= ELEMENTS)
    sized = written(groups.join(sizes.withColumn("fits", fits), "cell"), "sized")
    found = [written(_solved(sized.where("fits").select(F.col("cell").alias("group"), "id", F.lit(0).alias("side")), data, linked_sets, percent), "links")]
    large = sized.where("NOT fits")
    if large.isEmpty():
        return found
    near = written(_met(large, _pivots(large, 0), data, star(percent), "a long, b long"), "links")
    label = components(near).withColumnRenamed("component", "label")
    named = large.join(label, "id", "left").withColumn("label", F.coalesce("label", "id"))
    most = named.groupBy("cell", "label").agg(F.count("*").alias("c")).groupBy("cell").agg(F.max(F.struct("c", "label")).alias("top"))
    named = written(named.join(most, "cell").withColumn("main", F.col("label") == F.col("top.label")).withColumn("rest", F.col("m") - F.col("top.c")).drop("top"), "named")
    # blocks are small enough if the elements are spread evenly; hashing deals them so
    scale = F.greatest(F.ceil(F.col("elements") / ELEMENTS), F.ceil(F.col("m") / BLOCK)) / F.col("m")
    named = named.withColumn("mains", F.ceil((F.col("m") - F.col("rest")) * scale).cast("int")).withColumn("rests", F.ceil(F.col("rest") * scale).cast("int"))
    others = named.where("NOT main")
    main_block, rest_block = F.pmod(F.xxhash64("id", F.lit(7)), F.col("mains")), F.pmod(F.xxhash64("id", F.lit(7)), F.col("rests"))
    group = F.xxhash64("cell", F.lit("main"), "rest_block", "main_block").alias("group")
    from_rest = others.select("cell", "id", rest_block.alias("rest_block"), F.explode(F.sequence(F.lit(0), F.col("mains") - 1)).alias("main_block")).select(group, "id", F.lit(0).alias("side"))
    from_main = named.where("main AND rests > 0").select("cell", "id", main_block.alias("main_block"), F.explode(F.sequence(F.lit(0), F.col("rests") - 1)).alias("rest_block")).select(group, "id", F.lit(1).alias("side"))
    blocks = _in_blocks(others, F.col("rests")).unionByName(from_rest).unionByName(from_main)
    return [*found, near, written(_solved(blocks, data, linked_sets, percent), "links")]


def _union(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


def _points(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What is known of every row (doc_id, text_key, n_shingles, set_key), the points, and the points' components.

    A point (set_key, id) is one set; x and text_key name the first row that has it.
    """
    if not 50 <= percent <= 100:
        raise ValueError("from 50 to 100 %")
    known = written(_known(docs, width), "sets")
    named = known.where("set_key IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_key").agg(F.min(F.struct("doc_id", "text_key")).alias("first"), F.first("n_shingles").alias("n"))
    # ids are fixed by writing them; doc_id is none, as it may stand on several sets
    points = written(named.select("set_key", "n", F.col("first.doc_id").alias("x"), F.col("first.text_key").alias("text_key"), F.monotonically_increasing_id().alias("id")), "points")
    tags = written(shared_keys(docs.where("doc_id IS NOT NULL").select("text"), _prefixes(width, percent)).groupBy("id").agg(F.count("*").alias("m")), "tags")
    tag = F.conv(F.hex(F.substring("set_key", 1, 8)), 16, -10).cast("long")
    wanted = points.withColumn("tag", tag).join(tags.withColumnRenamed("id", "tag"), "tag").where(F.col("m") >= least_shared(F.col("n"), percent))
    wanted = wanted.select(F.col("x").alias("doc_id"), "text_key", "id")
    texts = docs.select("doc_id", "text", _text_key().alias("text_key")).join(wanted, ["doc_id", "text_key"])
    items = written(_sets_of(texts, width).dropDuplicates(["id"]), "items")
    regions = written(shared_keys(items.select("id", "items"), _parts(percent)), "regions")
    pivots = regions.groupBy("key").agg(F.min(F.struct(F.xxhash64("id"), "id"))["id"].alias("cell"))
    cells = written(regions.join(pivots, "key").select("cell", "id").distinct(), "cells")
    folds = written(_folds(items), "folded")
    near = _candidates(cells, folds, percent)
    groups = written(components(_union(near)).withColumnRenamed("component", "cell"), "groups")
    # components() names no id that is its own component
    groups = groups.unionByName(groups.select(F.col("cell").alias("id"), "cell").distinct()).distinct()
    links = _links(groups, items, percent)
    component = written(components(_union(links)), "component")
    for done in (tags, items, regions, cells, folds, *near, *links):
        drop_written(done)
    return known, points, component


def _with_component(points: DataFrame, component: DataFrame) -> DataFrame:
    return points.join(component, "id", "left").withColumn("component", F.coalesce("component", "id"))


def _extended(component: DataFrame, found: DataFrame) -> DataFrame:
    """Components of points, after ``found`` has joined some components."""
    onward = found.select(F.col("id").alias("component"), F.col("component").alias("_to"))
    known = component.join(onward, "component", "left").select("id", F.coalesce("_to", "component").alias("component"))
    return known.unionByName(found.join(component, "id", "left_anti"))


def classes(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id: documents linked at ``percent`` % similarity of their sets of ``width`` words."""
    known, points, component = _points(docs, width, percent)
    # sets of equal smallest doc_id are one node
    placed = _with_component(points, component)
    least = placed.groupBy("x").agg(F.min("component").alias("b"), F.max("component").alias("top")).where("b <> top").select("x", "b")
    same = placed.join(least, "x").select(F.col("component").alias("a"), "b").distinct()
    component = _extended(component, components(same))
    placed = _with_component(points, component)
    smallest = placed.groupBy("component").agg(F.min("x").alias("component_id"))
    to = placed.join(smallest, "component").select("set_key", "component_id")
    found = known.join(to, "set_key", "left")
    return found.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def survivors(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each class, the one of the smallest doc_id; documents with an empty set or a null doc_id stay."""
    known, points, component = _points(docs, width, percent)
    placed = _with_component(points, component)
    first = placed.groupBy("component").agg(F.min(F.struct("x", "text_key")).alias("first"))
    to = placed.join(first, "component").select("set_key", "first")
    # by row and not by doc_id, which may stand on several texts
    gone = known.where("doc_id IS NOT NULL").join(to, "set_key").where("doc_id <> first.x OR text_key <> first.text_key").select("doc_id", F.col("text_key").alias("_text_key"))
    kept = docs.withColumn("_text_key", _text_key()).join(gone.distinct(), ["doc_id", "_text_key"], "left_anti")
    blank = F.coalesce(F.length(F.regexp_replace("text", r"[ \t-\r]", "")), F.lit(0)) == 0
    lone = kept.where(blank | F.col("doc_id").isNull())
    return lone.unionByName(kept.where(~blank & F.col("doc_id").isNotNull()).dropDuplicates(["doc_id", "_text_key"])).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))


def sql(width: int = 3, percent: int = 90) -> str:
    """The same rows in DuckDB, by counting the shingles that each two documents share."""
    return rf"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT r, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {width} THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(len(words) - {width - 1}), lambda i: array_to_string(words[i + 1 : i + {width}], ' '))) END AS items
  FROM w
), sets AS (
  SELECT min(doc_id) AS x, CAST(len(any_value(items)) AS BIGINT) AS n, any_value(items) AS items, md5(array_to_string(list_sort(items), '|')) AS k
  FROM s WHERE len(items) > 0 AND doc_id IS NOT NULL GROUP BY md5(array_to_string(list_sort(items), '|'))
), u AS (SELECT x, n, unnest(items) AS item FROM sets),
p AS (
  SELECT a.x AS a, b.x AS b FROM u a JOIN u b ON a.item = b.item AND a.x < b.x AND 100 * a.n >= {percent} * b.n AND 100 * b.n >= {percent} * a.n
  GROUP BY a.x, b.x, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))
), e AS MATERIALIZED (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
c(x, y) AS (SELECT x, x FROM sets UNION SELECT e.b, c.y FROM c JOIN e ON e.a = c.x),
m AS (SELECT x, min(y) AS component FROM c GROUP BY x)
SELECT s.doc_id, CAST(len(s.items) AS BIGINT) AS n_shingles, coalesce(m.component, s.doc_id) AS component_id
FROM s LEFT JOIN sets ON s.doc_id IS NOT NULL AND len(s.items) > 0 AND sets.k = md5(array_to_string(list_sort(s.items), '|')) LEFT JOIN m ON m.x = sets.x
"""
