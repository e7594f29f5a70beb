"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding lower-cases, applies NFKC, drops zero-width characters, and maps
look-alike letters of other scripts and digits or signs that stand for letters
to those letters; ``l`` and ``1`` both become ``i``, in the lexicon as well.

The lexicon holds beginnings of words. They are learned from labelled rows:
among beginnings that are rare in clean texts, those are taken one by one that
mark most toxic texts not marked so far. Weights are log odds. Phrases of a
lexicon word and a neighbour that occur in clean texts only are exceptions: a
match inside one does not count; more exceptions can be given. A document's
summed weight is taken as it is and relative to its length, and a logistic
function fitted on the same sample turns both into a score.

Every whole text is matched; nothing but the text is an input. Null texts count
as empty; an empty text has the score of a text without matches. Repeated rows
get equal scores. Without labelled rows of both kinds the lexicon is empty and
every score is the (smoothed) share of toxic rows. An empty table gives no rows.
Columns called n_hits or score are replaced by scores(); all others pass through.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .samples import labelled, remainder
from .shared import drop_written, slices, table, written

#: Bounds of the labelled sample.
MAX_ROWS, MAX_BYTES = 8000, 20 << 20
#: Letters of the beginnings of words that can become terms; a longer word is marked by its beginning.
SHORTEST, LONGEST = 4, 10
THRESHOLD = 0.3
MODULUS, HELD_OUT = 4, 2

# Characters that pass for Latin letters, and the letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "һ": "h", "н": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "о": "o",
    "р": "p", "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԝ": "w", "ѵ": "v", "ӏ": "i", "г": "r", "п": "n", "ц": "u",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "γ": "y",
    "ı": "i", "ɡ": "g", "ɑ": "a", "ʏ": "y", "ʟ": "i",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "l": "i"}
DROPPED = "​‌‍⁠﻿­"
FOLDED = str.maketrans({**LOOK_ALIKES, **DIGITS, **dict.fromkeys(DROPPED, "")})
WORD = re.compile(r"[^\W_]+")
NEXT = re.compile(r" ([^\W_]+)")


def fold(text: str) -> str:
    low = text.lower()
    if not low.isascii():
        low = unicodedata.normalize("NFKC", low)
    return low.translate(FOLDED)


@dataclass
class Model:
    terms: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    bias: float = 0.0
    by_sum: float = 0.0
    by_density: float = 0.0

    def matcher(self):
        import ahocorasick

        machine = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            machine.add_word(term, (len(term), weight, False))
        for phrase in self.exceptions:
            machine.add_word(phrase, (len(phrase), self.terms.get(phrase, 0.0), True))
        if len(machine):
            machine.make_automaton()
        return machine

    def hits(self, machine, text: str) -> list[tuple[int, int, float]]:
        """Start, length and weight of the matches at beginnings of words and outside exceptions; of nested ones, the heaviest."""
        found: dict[int, tuple[int, float]] = {}
        shielded: list[tuple[int, int]] = []
        for end, (size, weight, excepted) in machine.iter(text) if len(machine) else ():
            start = end - size + 1
            if start and text[start - 1].isalnum():
                continue
            if excepted and not text[end + 1 : end + 2].isalnum():
                shielded.append((start, end))
            if weight and found.get(start, (0, 0.0))[1] < weight:
                found[start] = (size, weight)
        if not shielded:
            return [(s, n, w) for s, (n, w) in found.items()]
        shielded.sort()
        out, k, reach = [], 0, -1
        for s in sorted(found):
            while k < len(shielded) and shielded[k][0] <= s:
                reach = max(reach, shielded[k][1])
                k += 1
            if s > reach:
                out.append((s, *found[s]))
        return out

    def score(self, total: float, length: int) -> float:
        x = self.bias + self.by_sum * math.log1p(total) + self.by_density * math.log1p(total / (1 + length / 600))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def beginnings(folded: str) -> set[str]:
    out = set()
    for word in set(WORD.findall(folded)):
        if len(word) >= SHORTEST and not word.isdigit():
            out.update(word[:k] for k in range(SHORTEST, min(len(word), LONGEST) + 1))
    return out


def neighbours(folded: str, start: int) -> list[str]:
    """The word that begins at ``start`` with the one behind it and the one before it, where one blank stands between."""
    word = WORD.match(folded, start)
    if not word:
        return []
    out = []
    if after := NEXT.match(folded, word.end()):
        out.append(f"{word[0]} {after[1]}")
    if start > 1 and folded[start - 1] == " ":
        first = start - 1
        while first and WORD.fullmatch(folded[first - 1]):
            first -= 1
        if first < start - 1:
            out.append(f"{folded[first : start - 1]} {word[0]}")
    return out


def lexicon(toxic: list[set[str]], counts: dict[str, tuple[int, int]], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Greedy cover of the toxic texts by beginnings that clean texts hardly have."""
    where: dict[str, set[int]] = defaultdict(set)
    for i, found in enumerate(toxic):
        for f in found:
            if f in counts:
                where[f].add(i)
    # so many new texts that chance hardly gives any of all the candidates as many
    least = math.ceil(math.log(20 * max(1, len(counts))) / math.log((n_toxic + n_clean) / n_toxic))
    common = max(least, n_toxic // 20)
    weight = {f: math.log((a + 0.5) / (n_toxic + 1)) - math.log((b + 0.5) / (n_clean + 1)) for f, (a, b) in counts.items()}
    chosen: dict[str, float] = {}
    left = {f: set(docs) for f, docs in where.items()}
    while left:
        best = max(left, key=lambda f: (len(left[f]), len(f), f))
        gain = left.pop(best)
        if len(gain) < least:
            break
        chosen[best] = weight[best]
        for f in list(left):
            left[f] -= gain
            if len(left[f]) < least:
                del left[f]
    # what marks many toxic texts and no clean one belongs to the lexicon though other terms mark them too
    for f in sorted(where, key=lambda f: (-len(where[f]), -len(f), f)):
        if len(where[f]) < common:
            break
        if counts[f][1] == 0 and not any(f.startswith(t) or t.startswith(f) for t in chosen):
            chosen[f] = weight[f]
    return chosen


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method; ridge also keeps separable samples finite."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += move
        if np.abs(move).max() < 1e-7:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", exceptions: Iterable[str] = (), modulus: int = MODULUS, held_out: int = HELD_OUT, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> Model:
    """A model fitted on a bounded sample of the rows that are not held out."""
    sample = written(labelled(docs, labels, label, remainder(F.col("doc_id"), modulus) != held_out, max_rows, max_bytes).select("doc_id", "text", "label"), "toxic-sample")
    by_label = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = by_label.get(1, 0), by_label.get(0, 0)
    model = Model(bias=math.log((n_toxic + 0.5) / (n_clean + 0.5)))
    if not n_toxic or not n_clean:
        return model

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                seen[y].update(beginnings(fold(text)))
        keys = sorted(seen[0].keys() | seen[1].keys())
        for i in range(0, len(keys), 20000):
            part = keys[i : i + 20000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([seen[1][k] for k in part], pa.int64()), pa.array([seen[0][k] for k in part], pa.int64())], ["f", "a", "b"])

    least = max(3, n_toxic // 200)
    counted = sample.mapInArrow(count, "f string, a long, b long").groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    counts = {r.f: (r.a, r.b) for r in counted.where((F.col("a") >= least) & (F.col("a") * n_clean > 20 * F.col("b") * n_toxic) & (F.col("a") >= 3 * F.col("b"))).collect()}

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(beginnings(fold(t)) & counts.keys()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(found, pa.list_(pa.string()))], ["doc_id", "found"])

    rows = sample.where("label = 1").mapInArrow(present, "doc_id long, found array<string>").collect()  # bounded by the sample
    rows.sort(key=lambda r: (r.doc_id, r.found))
    model.terms = lexicon([set(r.found) for r in rows], counts, n_toxic, n_clean)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = model.matcher()
        for batch in batches:
            totals, lengths, nears = [], [], []
            for text in batch.column("text").to_pylist():
                folded = fold(text)
                hits = model.hits(machine, folded)
                totals.append(sum(w for _, _, w in hits))
                lengths.append(len(folded))
                nears.append(sorted({phrase for s, _, _ in hits for phrase in neighbours(folded, s)}))
            yield pa.RecordBatch.from_arrays([batch.column("label").cast(pa.int32()), pa.array(totals, pa.float64()), pa.array(lengths, pa.int64()), pa.array(nears, pa.list_(pa.string()))], ["y", "total", "length", "near"])

    schema = "y int, total double, length long, near array<string>"
    rows = sample.mapInArrow(contexts, schema).collect()  # bounded by the sample
    clean, bad = Counter(), set()
    for r in rows:
        if r.y:
            bad.update(r.near)
        else:
            clean.update(r.near)
    model.exceptions = tuple(sorted({p for p, n in clean.items() if n >= 3 and p not in bad} | {fold(p) for p in exceptions}))
    if model.exceptions:
        rows = sample.mapInArrow(contexts, schema).collect()
    x = np.array([[1.0, math.log1p(r.total), math.log1p(r.total / (1 + r.length / 600))] for r in sorted(rows, key=lambda r: (r.y, r.total, r.length))])
    y = np.array(sorted(float(r.y) for r in rows))
    model.bias, model.by_sum, model.by_density = map(float, logistic(x, y))
    drop_written(sample)
    return model


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with n_hits (matches that count) and score."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType

    kept = [f for f in docs.schema.fields if f.name not in ("n_hits", "score")]
    schema = StructType([*kept, StructField("n_hits", LongType()), StructField("score", DoubleType())])
    names = to_arrow_schema(StructType(kept)).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = model.matcher()
        for batch in slices(batches, "text"):
            n, out = [], []
            for text in batch.column("text").to_pylist():
                folded = fold(text or "")
                hits = model.hits(machine, folded)
                n.append(len(hits))
                out.append(model.score(sum(w for _, _, w in hits), len(folded)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(n, pa.int64()), pa.array(out, pa.float64())], [*names, "n_hits", "score"])

    return docs.select(*[f.name for f in kept]).mapInArrow(run, schema)


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
