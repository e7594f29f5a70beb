"""Quality and toxicity: defined results for awkward rows, and accuracy on held-out rows of the test tables."""

import zlib

import numpy as np
import pytest

from foliary.llm import quality, toxicity
from tests.llm.fixture import documents, rows

SF = "/root/testdata/sf0.01"


def remainder(i, modulus):
    return zlib.crc32(("" if i is None else str(i)).encode()) % modulus


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    return (rank[y == 1].mean() - ((y == 1).sum() - 1) / 2) / max(1, (y == 0).sum())


AWKWARD = [(None, "plain words here", "a"), (1, None, None), (2, "", "a"), (3, "word " * 50000, "a"), (4, "same text", "a"), (4, "same text", "a")]


@pytest.mark.parametrize("module,label,modulus,held", [(quality, "quality", 5, 0), (toxicity, "toxic", 4, 2)])
def test_awkward_rows(spark, module, label, modulus, held):
    train = [(100 + i, ("Good plain sentence number %d. " % i) * 5 if i % 2 else "BAD!! %%%$$$ idiot ### text " * 7 + str(i), "s") for i in range(120)]
    docs = documents(spark, AWKWARD + train)
    labels = spark.createDataFrame([(100 + i, i % 2, 1 - i % 2) for i in range(120)] + [(100, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = rows(module.report(docs, labels))
    assert len(got) == len(AWKWARD) + 120
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (remainder(r["doc_id"], modulus) == held)
    assert len({r["score"] for r in got if r["doc_id"] == 4}) == 1
    y = {100 + i: (i % 2 if label == "quality" else 1 - i % 2) for i in range(120)}
    assert all(r["predicted"] == y[r["doc_id"]] for r in got if r["doc_id"] in y)
    assert module.report(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in rows(module.report(docs, labels.limit(0)))} <= {0.5}


def test_repeated_words_are_told_by_all_their_bytes():
    base = "https://example.com/a/long/address/"
    repeats = lambda t: quality.describe([b"a b", t.encode(), b"", b"b"])[0][1, -3]
    assert repeats(f"{base}1 {base}2 {base}3\n{base}4") == 0
    assert repeats(f"{base}1 {base}2 {base}1\n{base}1") == 0.5
    assert repeats("\u4e00\u4e8c\u4e09\u56db\u4e94\u516d a\n\u4e00\u4e8c\u4e09\u56db\u4e94\u516d\u4e03 b") == 0


def test_quality_on_held_out_rows(spark):
    got = quality.query(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert auc(got.score.values, got.quality.values) > 0.97


def test_rejected_documents_go(spark):
    model = quality.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"), max_rows=150)
    docs = documents(spark, AWKWARD)
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns
    scores = rows(quality.scores(docs.select("doc_id", "text"), model))
    assert kept.count() == sum(r["score"] >= quality.THRESHOLD for r in scores)
    assert {r["score"] for r in rows(kept)} <= {"y"}


def test_attention_gradients():
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(n, quality.FEATURES)) * 0.3 for n in rng.integers(1, 9, 200)]
    y = np.array([float((b[:, 0] > 0.45).any()) for b in bags])
    model = quality.train(bags, y, epochs=80)
    first = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    out = model.forward(np.concatenate(bags), first)
    assert auc(out["score"], y) > 0.97
    np.testing.assert_allclose(np.add.reduceat(out["weight"], first[:-1]), 1)


def test_toxicity_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = toxicity.report(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert not ((got.predicted == 1) & (got.toxic == 0)).any()
    assert ((got.predicted == 1) & (got.toxic == 1)).sum() >= 0.5 * (got.toxic == 1).sum()


def brute(model, text):
    """All matches by looking at each place."""
    folded, out = toxicity.fold(text), 0.0
    shield = [(i, i + len(p)) for p in model.exceptions for i in range(len(folded)) if folded.startswith(p, i) and not folded[i - 1 : i].isalnum() and not folded[i + len(p) : i + len(p) + 1].isalnum()]
    for i in range(len(folded)):
        if folded[i - 1 : i].isalnum() or any(a <= i < b for a, b in shield):
            continue
        out += max([w for t, w in model.terms.items() if folded.startswith(t, i)], default=0)
    return out


@pytest.mark.parametrize("text", ["idiot", "1d10t!", "Ідіот іdiot", "IDIOTS and idiotic", "an un-idiot unidiot", "clown fish, clown car", "a clown fishes", "sea clown fish clown", "", "ｉｄｉｏｔ", "id​iot"])
def test_matches_as_brute_force(text):
    model = toxicity.Model({toxicity.fold(t): w for t, w in {"idiot": 2.0, "idio": 1.0, "clown": 3.0}.items()}, tuple(map(toxicity.fold, ["clown fish", "sea clown"])))
    assert sum(w for _, _, w in model.hits(model.matcher(), toxicity.fold(text))) == brute(model, text)


def test_folding():
    assert {toxicity.fold(x) for x in ("loser", "L0SER", "lоsеr", "1o5er", "ｌｏｓｅｒ", "lo​ser")} == {"ioser"}


def plain_features(text):
    """Features of one text by loops over its bytes and words."""
    kinds, size = [int(quality.CLASSES[b]) for b in text], quality.PASSAGE
    words, at = [], 0  # beginning and bytes of each run of neither blank nor line feed
    while at < len(text):
        end = at
        while end < len(text) and text[end] not in b" \n":
            end += 1
        if end > at:
            words.append((at, text[at:end]))
        at = end + 1
    out = []
    for first in range(0, max(1, len(text)), size):
        row = np.zeros(quality.FEATURES)
        part = kinds[first : first + size]
        for k, kind in enumerate(part):
            behind = kinds[first + k + 1] if first + k + 1 < len(text) else 3
            row[kind * quality.KINDS + behind] += 1
        row = np.sqrt(row / max(1, len(part)))
        own = [(k, w) for k, (b, w) in enumerate(words) if first <= b < first + size]
        row[-3] = sum(w in {x for _, x in words[:k]} for k, w in own) / max(1, len(own))
        row[-2] = min(1, len(part) / size)
        row[-1] = np.log1p(len(text)) / 12
        out.append(row)
    return np.array(out)


TEXTS = [b"", b"one", b"a b a b", ("Some words, 12 & more: " * 90).encode(), ("\u4e00\u4e8c" * 900 + " x \u4e00\u4e8c").encode(), b"\n\n  \n", b"w" * 3000 + b" " + b"w" * 3000 + b" z"]


def test_features_as_by_loops():
    x, first = quality.describe(TEXTS)
    for text, a, b in zip(TEXTS, first, first[1:], strict=False):
        np.testing.assert_allclose(x[a:b], plain_features(text), atol=1e-6)


@pytest.mark.parametrize("chunk", [512, 1024, 4096])
def test_long_texts_are_described_in_chunks(chunk):
    for text in TEXTS[1:]:
        np.testing.assert_allclose(quality.describe_long(text, chunk), plain_features(text), atol=1e-6)


def test_texts_beyond_a_chunk(monkeypatch):
    monkeypatch.setattr(quality, "CHUNK", 1024)
    x, first = quality.described(TEXTS)
    y, same = quality.describe(TEXTS)
    assert (first == same).all()
    np.testing.assert_allclose(x, y, atol=1e-6)


def test_attention_as_by_loops():
    rng = np.random.default_rng(3)
    shape = {"w": (quality.FEATURES, 5), "b": (5,), "v": (5, 4), "u": (5, 4), "a": (4,), "c": (5,), "d": ()}
    m = {k: rng.normal(0, 1, s) for k, s in shape.items()}
    x, first = quality.describe(TEXTS)
    got = quality.Model(m).forward(x, first)["score"]
    for i, (a, b) in enumerate(zip(first, first[1:], strict=False)):
        h = [np.tanh(row @ m["w"] + m["b"]) for row in x[a:b]]
        e = [np.exp(sum(np.tanh(z @ m["v"][:, k]) / (1 + np.exp(-(z @ m["u"][:, k]))) * m["a"][k] for k in range(4))) for z in h]
        pooled = sum(w * z for w, z in zip(e, h, strict=True)) / sum(e)
        assert abs(got[i] - 1 / (1 + np.exp(-(pooled @ m["c"] + m["d"])))) < 1e-9


def test_accepted_keeps_columns_of_any_name(spark):
    from pyspark.sql import functions as F

    docs = documents(spark, AWKWARD).withColumn("_score", F.lit(5)).withColumn("row", F.lit("r"))
    out = quality.accepted(docs, quality.Model({}))
    assert out.columns == docs.columns and {(r._score, r.score, r.row) for r in out.collect()} == {(5, "y", "r")}


def test_neighbours_of_a_word():
    far = "x" * 100
    assert toxicity.neighbours(f"{far} word after", 101) == ["word after", f"{far} word"]
    assert toxicity.neighbours("a, word", 3) == [] and toxicity.neighbours("word", 0) == []
