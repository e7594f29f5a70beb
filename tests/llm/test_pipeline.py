"""The pipeline against a plain version of each stage on a small folder of tables."""

import hashlib
import random
import re
import struct
from collections import Counter

import public_tokenizers
import tiktoken

import corpus_pipeline
from foliary.llm import graph, jaccard, mixing, quality, shared, suffixes
from foliary.llm.shared import table
from tests.llm.fixture import duck

LENGTH = 400


def made(folder, spark):
    rng = random.Random(8)
    vocabulary = [f"word{i}" for i in range(300)]
    draw = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = draw(90)
    rows, labels = [], []
    for i in range(90):
        good = i % 4 > 0
        text = draw(rng.randint(20, 200)) + "." if good else " ".join(w + rng.choice(["%%%", "###", "&&&"]) for w in draw(60).split())
        if good and i % 9 == 0:
            text += " " + passage + " é" + draw(5)
        rows.append([i, text, "en", f"s{i % 3}"])
        labels.append((i, int(good), 0))
    for k in range(6):
        words = rows[5][1].split()
        words[k] = "other"
        rows.append([100 + k, " ".join(words), "en", "s1"])
    rows += [[200, None, "en", "s2"], [201, "", "en", None], [202, rows[7][1], "en", "s0"]]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def one_of_each(docs):
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = {i: shingles(t) for i, (t, _) in docs.items()}
    for a in docs:
        for b in docs:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: v for i, v in docs.items() if find(i) == i}


def without_repeats(docs):
    data = {i: (t or "").encode() for i, (t, _) in docs.items()}
    count = Counter(d[k : k + LENGTH] for d in data.values() for k in range(len(d) - LENGTH + 1))
    out = {}
    for i, d in data.items():
        gone = bytearray(len(d))
        for k in range(len(d) - LENGTH + 1):
            if count[d[k : k + LENGTH]] > 1:
                gone[k : k + LENGTH] = b"\1" * LENGTH
        text = bytes(x for x, g in zip(d, gone, strict=True) if not g).decode("utf-8", "ignore")
        if text or not any(gone):
            out[i] = (text, docs[i][1])
    return out


def test_same_as_plain_version(spark, tmp_path):
    folder = str(tmp_path)
    made(folder, spark)
    start = table(spark, folder, "documents")
    model = quality.fit(start, table(spark, folder, "labels"))
    docs = {r.doc_id: (r.text, r.source) for r in start.collect()}
    good = model.score([(t or "").encode() for t, _ in docs.values()]) >= quality.THRESHOLD
    docs = {i: v for (i, v), g in zip(docs.items(), good, strict=True) if g}
    assert len(docs) < 99
    stay = one_of_each(docs)
    assert len(stay) < len(docs)
    left = without_repeats(stay)
    assert sum(len(t) for t, _ in left.values()) < sum(len(t or "") for t, _ in stay.values())
    frame = spark.createDataFrame([(i, t, s) for i, (t, s) in left.items()], "doc_id long, text string, source string")
    taken = {r["doc_id"]: (r["taken"] // r["size"] if r["size"] else None) for r in duck(mixing.sql(), documents=frame)}
    encoding = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=corpus_ranks(), special_tokens={})
    want = Counter()
    for i, (t, _) in left.items():
        ids = encoding.encode_ordinary(t)
        row = (i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
        if taken[i]:
            want[row] += taken[i]
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, folder).collect())
    blank = {i for i, n in taken.items() if n is None}
    assert Counter({k: n for k, n in got.items() if k[0] not in blank}) == want


def corpus_ranks():
    import base64

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def test_stages_keep_the_columns(spark, tmp_path):
    made(str(tmp_path), spark)
    docs = table(spark, str(tmp_path), "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES[2:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
        assert docs.count() == 0
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_awkward_rows(spark, tmp_path):
    """Null and repeated ids, equal rows, long and blank texts, other columns; one source, so that every row is taken once."""
    rng = random.Random(4)
    draw = lambda n: " ".join(rng.choice("aeiou") + str(rng.randrange(10**6)) for _ in range(n))
    first, second, long = draw(80), draw(80), draw(30000)
    made = [(1, first), (1, second), (2, first + " z"), (3, long), (4, ""), (5, None), (6, " \n"), (None, draw(9)), (7, "one"), (7, "one"), (8, "ONE")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k", 5) for i, t in made], "doc_id long, text string, lang string, source string, n_chars long, _text_key string, score int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, None, None) for i in range(9)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    encoding = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=corpus_ranks(), special_tokens={})
    size = lambda t: len(encoding.encode_ordinary(t))
    # the near copy 2 and the copies 7 and 8 of one word go; rows without words have nothing to be taken for
    want = Counter([(1, size(first)), (1, size(second)), (3, size(long)), (None, size(made[7][1])), (7, size("one"))])
    assert Counter((r.doc_id, r.n_tokens) for r in got if r.doc_id not in (4, 5, 6)) == want


def test_no_task_needs_two_python_workers(spark, tmp_path, monkeypatch):
    """Each worker keeps memory beside the executor's, and waits for further tasks with it."""
    made(str(tmp_path), spark)
    plans = []

    def noted(df, name, written=shared.written):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return written(df, name)

    for module in (corpus_pipeline, jaccard, suffixes, graph):
        monkeypatch.setattr(module, "written", noted)
    plans.append(("tokens", corpus_pipeline.run(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()))
    assert sum("MapInArrow" in p for _, p in plans) > 10
    assert [n for n, p in plans if re.search(r"MapInArrow.*\n(.*(Project|Filter).*\n)*.*MapInArrow", p)] == []
