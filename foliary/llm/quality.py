"""Quality classifier: gated-attention multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE`` bytes. Each passage is described
by the frequencies of pairs of adjacent byte classes, by its length, and by how
much of it repeats what the document said before; a layer encodes it, a gated
attention learned from document labels alone weighs the encoded passages, and
the weighted sum is scored.

Every byte of every document is read; nothing but the text is an input. Null
texts count as empty; an empty text is a bag with one empty passage and has a
score. Repeated rows get equal scores. Without labelled rows every score is 0.5.
An empty table gives no rows. scores() replaces a column called score and passes
all others through; accepted() keeps all columns, whatever their names. Texts are
described a chunk at a time, so a very long one takes no more memory than its
passages' features and its distinct words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .samples import labelled, remainder
from .shared import mapped, slices, table
from .shingles import BASE, run_key, run_sum, runs_hashed

PASSAGE = 512
#: Bytes that are described at once.
CHUNK = PASSAGE << 10
HIDDEN, GATE = 32, 16
#: Bounds of the sample that the model is fitted on.
MAX_ROWS, MAX_BYTES = 5000, 12 << 20
THRESHOLD = 0.3
MODULUS, HELD_OUT = 5, 0


def _classes() -> np.ndarray:
    kinds = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", ".", ",", "!?", "|", "#$%&*", ":;'\"-", "()[]{}<>", "=/\\@_~^+`"]
    lut = np.full(256, len(kinds) + 2, np.int64)
    for k, chars in enumerate(kinds):
        lut[[ord(c) for c in chars]] = k
    lut[128:192], lut[192:] = len(kinds), len(kinds) + 1
    return lut


CLASSES = _classes()
KINDS = int(CLASSES.max()) + 1
FEATURES = KINDS * KINDS + 3


def describe(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and where each document's passages begin (and, last, end)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    bags = np.maximum(1, -(-sizes // PASSAGE))
    first = np.concatenate([[0], np.cumsum(bags)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(texts)), sizes)
    at = np.arange(len(data)) - starts[doc]
    passage = first[doc] + at // PASSAGE
    kind = CLASSES[data]
    n = int(first[-1])
    out = np.zeros((n, FEATURES), np.float32)
    if len(data):
        following = np.append(kind[1:], 3)
        ends = (starts + sizes)[sizes > 0]
        following[ends - 1] = 3  # nothing of the next document
        pairs = kind * KINDS + following
        length = np.maximum(1, np.bincount(passage, minlength=n))[:, None]
        counts = np.bincount(passage * (KINDS * KINDS) + pairs, minlength=n * KINDS * KINDS).reshape(n, -1)
        out[:, :-3] = np.sqrt(counts / length)
        # words seen before in the same document, by a hash of the whole word
        inside = (kind != 3) & (kind != 4)
        new = np.append(True, doc[1:] != doc[:-1])
        begins = np.flatnonzero(inside & (new | ~np.append(False, inside[:-1])))
        stops = np.flatnonzero(inside & np.append(~inside[1:] | new[1:], True)) + 1
        key = runs_hashed(data, begins, stops)
        key ^= doc[begins].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        fresh = np.zeros(len(begins), bool)
        fresh[np.unique(key, return_index=True)[1]] = True
        words = np.maximum(1, np.bincount(passage[begins], minlength=n))
        out[:, -3] = np.bincount(passage[begins], weights=~fresh, minlength=n) / words
        out[:, -2] = np.minimum(1, length[:, 0] / PASSAGE) * (np.bincount(passage, minlength=n) > 0)
    out[:, -1] = np.repeat(np.log1p(sizes) / 12, bags)
    return out, first


def _word_sum(data: np.ndarray, ahead: int) -> int:
    """The part of a word's hash that comes from bytes ``ahead`` of its beginning."""
    return int(run_sum(data)) * pow(BASE, ahead, 1 << 64) % (1 << 64)


def describe_long(text: bytes, chunk: int = CHUNK) -> np.ndarray:
    """The features of one text's passages as of :func:`describe`, from chunks of so many bytes (a multiple of a passage)."""
    data = np.frombuffer(text, np.uint8)
    total = -(-len(data) // PASSAGE)
    out, words, again = np.zeros((total, FEATURES), np.float32), np.zeros(total), np.zeros(total)
    seen = np.zeros(0, np.uint64)
    open_word = None  # passage of its beginning, sum and length of a word that goes on from the chunk before
    for start in range(0, len(data), chunk):
        part = data[start : start + chunk]
        kind, last = CLASSES[part], start + chunk >= len(data)
        behind = 3 if last else int(CLASSES[data[start + chunk]])
        at = np.arange(len(part)) // PASSAGE
        n, base = int(at[-1]) + 1, start // PASSAGE
        length = np.bincount(at, minlength=n)
        counts = np.bincount(at * (KINDS * KINDS) + kind * KINDS + np.append(kind[1:], behind), minlength=n * KINDS * KINDS).reshape(n, -1)
        out[base : base + n, :-3] = np.sqrt(counts / length[:, None])
        out[base : base + n, -2] = np.minimum(1, length / PASSAGE)
        inside = (kind != 3) & (kind != 4)
        goes_on = bool(inside[-1]) and behind not in (3, 4)
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        begins, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        keys, places = [], []
        if open_word is not None and len(begins) and begins[0] == 0:
            passage, value, size = open_word
            open_word = (passage, (value + _word_sum(part[: stops[0]], size)) % (1 << 64), size + int(stops[0]))
            if not (goes_on and len(begins) == 1):
                keys.append(np.array([run_key(open_word[1], open_word[2])], np.uint64))
                places.append(np.array([passage]))
                open_word = None
            begins, stops = begins[1:], stops[1:]
        if goes_on and len(begins):
            open_word = (base + int(at[begins[-1]]), _word_sum(part[begins[-1] :], 0), len(part) - int(begins[-1]))
            begins, stops = begins[:-1], stops[:-1]
        keys.append(runs_hashed(part, begins, stops))
        places.append(base + at[begins])
        key, place = np.concatenate(keys), np.concatenate(places).astype(np.int64)
        fresh = np.zeros(len(key), bool)
        fresh[np.unique(key, return_index=True)[1]] = True
        fresh &= ~np.isin(key, seen)
        seen = np.union1d(seen, key)
        words += np.bincount(place, minlength=total)
        again += np.bincount(place, weights=~fresh, minlength=total)
    out[:, -3] = again / np.maximum(1, words)
    out[:, -1] = np.log1p(len(data)) / 12
    return out


def described(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """:func:`describe` in memory that is bounded by a chunk and the features, however long a text is."""
    parts, bags, held = [], [0], []
    for text in [*texts, None]:
        if held and (text is None or len(text) > CHUNK or sum(map(len, held)) + len(text) > CHUNK):
            x, first = describe(held)
            parts.append(x)
            bags.extend(np.diff(first).tolist())
            held = []
        if text is not None and len(text) > CHUNK:
            parts.append(describe_long(text))
            bags.append(len(parts[-1]))
        elif text is not None:
            held.append(text)
    return np.concatenate(parts) if parts else np.zeros((0, FEATURES), np.float32), np.cumsum(bags)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Weights of the encoder (w, b), the gated attention (v, u, a) and the head (c, d)."""

    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        m = self.weights
        bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
        h = np.tanh(x @ m["w"] + m["b"])
        t, s = np.tanh(h @ m["v"]), _sigmoid(h @ m["u"])
        e = (t * s) @ m["a"]
        e = np.exp(e - np.maximum.reduceat(e, first[:-1])[bag])
        weight = e / np.add.reduceat(e, first[:-1])[bag]
        z = np.add.reduceat(h * weight[:, None], first[:-1])
        return {"bag": bag, "h": h, "t": t, "s": s, "weight": weight, "z": z, "score": _sigmoid(z @ m["c"] + m["d"])}

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not self.weights:
            return np.full(len(texts), 0.5)
        return self.forward(*described(texts))["score"]


def train(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 40, steps: int = 1200, rate: float = 4e-3, decay: float = 1e-4, seed: int = 6) -> Model:
    """Adam on the log loss of the documents' labels, for ``epochs`` rounds and ``steps`` steps at least."""
    if not len(labels):
        return Model({})
    epochs = max(epochs, steps * 64 // len(labels))
    rng = np.random.default_rng(seed)
    shape = {"w": (FEATURES, HIDDEN), "b": (HIDDEN,), "v": (HIDDEN, GATE), "u": (HIDDEN, GATE), "a": (GATE,), "c": (HIDDEN,), "d": ()}
    m = {k: rng.normal(0, 1 / np.sqrt(s[0]) if len(s) else 0, s) if k not in "bd" else np.zeros(s) for k, s in shape.items()}
    model, mean, var, step = Model(m), {k: np.zeros(s) for k, s in shape.items()}, {k: np.zeros(s) for k, s in shape.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(labels))
        for i in range(0, len(order), 64):
            rows = order[i : i + 64]
            x = np.concatenate([bags[j] for j in rows]).astype(np.float64)
            first = np.concatenate([[0], np.cumsum([len(bags[j]) for j in rows])])
            f = model.forward(x, first)
            bag, h, weight = f["bag"], f["h"], f["weight"]
            dy = (f["score"] - labels[rows]) / len(rows)
            g = {"c": f["z"].T @ dy, "d": dy.sum()}
            dz = np.outer(dy, m["c"])[bag]
            dweight = (dz * h).sum(1)
            de = weight * (dweight - np.add.reduceat(weight * dweight, first[:-1])[bag])
            g["a"] = (f["t"] * f["s"]).T @ de
            dts = np.outer(de, m["a"])
            dv, du = dts * f["s"] * (1 - f["t"] ** 2), dts * f["t"] * f["s"] * (1 - f["s"])
            g["v"], g["u"] = h.T @ dv, h.T @ du
            dh = (dz * weight[:, None] + dv @ m["v"].T + du @ m["u"].T) * (1 - h**2)
            g["w"], g["b"] = x.T @ dh, dh.sum(0)
            step += 1
            now = rate * (1 - epoch / epochs)
            for k in m:
                g[k] = g[k] + decay * m[k] * (k not in "bd")
                mean[k] = 0.9 * mean[k] + 0.1 * g[k]
                var[k] = 0.999 * var[k] + 0.001 * g[k] ** 2
                m[k] = m[k] - now * (mean[k] / (1 - 0.9**step)) / (np.sqrt(var[k] / (1 - 0.999**step)) + 1e-8)
            model.weights = m
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = MODULUS, held_out: int = HELD_OUT, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> Model:
    """A model fitted on a bounded sample of the rows that are not held out; describing runs on executors."""
    sample = labelled(docs, labels, label, remainder(F.col("doc_id"), modulus) != held_out, max_rows, max_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK):
            x, first = described([t.encode() for t in batch.column("text").to_pylist()])
            packed = [x[a:b].astype("<f4").tobytes() for a, b in zip(first, first[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("label").cast(pa.int32()), pa.array(packed, pa.binary())], ["doc_id", "label", "bag"])

    rows = mapped(sample.select("doc_id", "text", "label"), run, "doc_id long, label int, bag binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["bag"])))
    bags = [np.frombuffer(bytes(r["bag"]), "<f4").reshape(-1, FEATURES) for r in rows]
    return train(bags, np.array([r["label"] for r in rows], float))


def scores(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """doc_id, text and score of every document (further columns pass through)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import DoubleType, StructField, StructType

    schema = StructType([*[f for f in docs.schema.fields if f.name != "score"], StructField("score", DoubleType())])
    names = to_arrow_schema(schema).names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, CHUNK):
            out = model.score([(t or "").encode() for t in batch.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(out, pa.float64())], [*names, "score"])

    return mapped(docs, run, schema)


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with their own columns."""
    numbers = [str(i) for i in range(len(docs.columns))]  # columns by number, as any name may be taken
    found = scores(docs.toDF(*numbers), model, numbers[docs.columns.index("text")]).where(F.col("score") >= threshold)
    return found.select(*[F.col(i).alias(c) for i, c in zip(numbers, docs.columns, strict=True)])


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels)
    return scores(docs.select("doc_id", "text"), model).select(
        "doc_id",
        (remainder(F.col("doc_id"), MODULUS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
