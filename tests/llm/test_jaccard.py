import random

import numpy as np
import pytest

from foliary.llm import jaccard, shingles
from foliary.llm.graph import components
from tests.llm.fixture import documents, rows, same


def texts(seed=3):
    """Chains and groups of near copies, exact copies, and texts that share one long passage but nothing else."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    out = []
    for size in (8, 40, 120):
        for _ in range(2):
            base = draw(size)
            for _ in range(rng.randint(2, 6)):
                out.append(" ".join(base))
                base = list(base)
                for _ in range(rng.randint(0, max(1, size // 40))):
                    base[rng.randrange(size)] = rng.choice(vocabulary)
    passage = draw(60)
    out += [" ".join(passage + draw(rng.randint(3, 60))) for _ in range(12)]
    out += ["", "   \n", "one", "ONE", "one two", "One\tTwo", "a a a a a", "a a a"]
    return out


def corpus(spark):
    made = [(7 * i % 1009, t, "s") for i, t in enumerate(texts())]
    return documents(spark, [*made, (2000, None, "s"), (None, texts()[0], "s"), (2001, "x " * 500, "s"), made[0], made[0]])


def test_same_as_sql(spark):
    docs = corpus(spark)
    same(jaccard.classes(docs), jaccard.sql(), documents=docs)


def test_survivors_of_few_rows(spark):
    docs = documents(spark, [(None, "a b c d e f", "s"), (1, "a b c d e f", "s"), (2, "A B C D E F", "s"), (3, "", "s"), (4, None, "s"), (1, "a b c d e f", "s"), (5, "x", "s")])
    kept = rows(jaccard.survivors(docs))
    assert sorted((r["doc_id"] or 0) for r in kept) == [0, 1, 3, 4, 5] and set(kept[0]) == set(docs.columns)
    assert jaccard.survivors(docs.limit(0)).count() == 0


def test_doc_id_on_different_texts(spark):
    """Rows are removed one by one, and each set of a doc_id is measured."""
    rng = random.Random(5)
    a, b, c = ([f"{k}{rng.randrange(300)}" for _ in range(100)] for k in "abc")
    near = lambda t: " ".join([*t[:-1], "z"])
    made = [(1, " ".join(a), "s"), (7, near(a), "s"), (7, " ".join(b), "s"), (9, near(b), "s"), (8, " ".join(c), "s"), (8, near(c), "s"), (8, " ".join(c), "s"), (10, near(c) + " y", "s"), (None, " ".join(b), "s")]
    docs = documents(spark, made)
    kept = [(r["doc_id"], r["text"].split()[0]) for r in rows(jaccard.survivors(docs))]
    assert sorted(kept, key=str) == sorted([(1, a[0]), (7, b[0]), (8, c[0]), (None, b[0])], key=str)
    same(jaccard.classes(docs), jaccard.sql(), documents=docs)
    split = documents(spark, [(7, " ".join(a), "s"), (7, " ".join(b), "s"), (9, near(a), "s"), (11, near(b), "s")])
    assert {(r["doc_id"], r["component_id"]) for r in rows(jaccard.classes(split))} == {(7, 7), (9, 7), (11, 7)}


def large_corpus(spark):
    """Groups of up to 12 near copies, a passage shared by 25 texts, and texts of 30,000 words."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    out = []
    for size in (8, 25, 60, 200):
        for _ in range(4):
            base = draw(size)
            for _ in range(rng.randint(2, 12)):
                out.append(" ".join(base))
                base = list(base)
                for _ in range(rng.randint(0, max(1, size // 40))):
                    base[rng.randrange(size)] = rng.choice(vocabulary)
    passage = draw(60)
    out += [" ".join(passage + draw(rng.randint(3, 60))) for _ in range(25)]
    long = draw(30000)
    out += [" ".join(long), " ".join(long[700:]), "x " * 30000, "x " * 29999]
    out += ["", "   \n", "one", "ONE", "one two", "One\tTwo", "a a a a a", "a a a"]
    made = [(7 * i % 1009, t, "s") for i, t in enumerate(out)]
    return documents(spark, [*made, (2000, None, "s"), made[0], made[0]])


def plain_classes(docs, width, percent):
    """doc_id: number of shingles and component, from all pairs of documents."""
    found = {}
    for r in docs.collect():
        words = (r.text or "").lower().split()
        found[r.doc_id] = {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()
    part = {i: i for i in found}
    for a in sorted(found):
        for b in sorted(found):
            common = len(found[a] & found[b]) if a < b else 0
            if common and 100 * common >= percent * (len(found[a]) + len(found[b]) - common) and part[a] != part[b]:
                low, high = sorted((part[a], part[b]))
                part = {i: low if c == high else c for i, c in part.items()}
    return {i: (len(s), part[i]) for i, s in found.items()}


def test_classes_and_survivors_as_all_pairs(spark):
    docs = large_corpus(spark)
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows(jaccard.classes(docs))}
    assert got == {(i, *v) for i, v in plain_classes(docs, 3, 90).items()}
    kept = rows(jaccard.survivors(docs, 5, 80))
    assert sorted(r["doc_id"] for r in kept) == sorted({c for _, c in plain_classes(docs, 5, 80).values()})
    assert set(kept[0]) == set(docs.columns)


def test_linked_pairs_share_a_part_key_at_80_percent():
    rng = np.random.default_rng(3)
    tried = 0
    for n in (5, 10, 12, 19, 40, 150, 700):
        for _ in range(60):
            a = rng.integers(0, 1 << 63, n).astype(np.uint64)
            b = np.concatenate([a[rng.integers(0, n // 5 + 1) :], rng.integers(0, 1 << 63, rng.integers(0, n // 5 + 1)).astype(np.uint64)])
            a, b = np.unique(a), np.unique(b)
            common = len(np.intersect1d(a, b))
            if 100 * common >= 80 * (len(a) + len(b) - common) and common < max(len(a), len(b)):
                tried += 1
                ka, kb = jaccard.part_keys([a, b], 80)
                assert set(ka.tolist()) & set(kb.tolist())
    assert tried > 50


def test_linked_pairs_share_a_part_key():
    rng = np.random.default_rng(2)
    for n in (10, 12, 19, 40, 150, 700):
        for _ in range(60):
            a = rng.integers(0, 1 << 63, n).astype(np.uint64)
            drop = rng.integers(0, n // 9 + 1)
            b = np.concatenate([a[drop:], rng.integers(0, 1 << 63, rng.integers(0, n // 9 + 1)).astype(np.uint64)])
            a, b = np.unique(a), np.unique(b)
            common = len(np.intersect1d(a, b))
            if 100 * common >= 90 * (len(a) + len(b) - common) and common < max(len(a), len(b)):
                ka, kb = jaccard.part_keys([a, b], 90)
                assert set(ka.tolist()) & set(kb.tolist())


def test_shingles_do_not_depend_on_neighbours():
    many = [t.encode() for t in texts()]
    alone = [shingles.sets([t], 3)[0] for t in many]
    for a, b in zip(shingles.sets(many, 3), alone, strict=True):
        np.testing.assert_array_equal(a, b)
    assert len(shingles.sets([b"A b\x0bC a B c a b"], 3)[0]) == 3


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(12)] + [(500, 600 + i) for i in range(50)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for x in root:
        if x in got:
            assert got[x] == find(x)
        else:
            assert find(x) == x


@pytest.mark.parametrize("cell,block", [(4, 1000), (4, 3), (1000, 5)])
def test_large_cells_and_groups(spark, monkeypatch, cell, block):
    """Voronoi cells, pairs of blocks, and pivots of large groups give what one block gives."""
    monkeypatch.setattr(jaccard, "CELL", cell)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "PIVOTS", 3)
    monkeypatch.setattr(jaccard, "MET", 5)
    docs = corpus(spark).where("doc_id IS NOT NULL")
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows(jaccard.classes(docs))}
    assert got == {(i, *v) for i, v in plain_classes(docs, 3, 90).items()}


def near_pair(rng, n, percent):
    """Two sets that are linked at this percentage, but for chance."""
    share = (100 - percent) / 100
    a = rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2)
    gone, more = rng.integers(0, int(n * share) + 1), rng.integers(0, int(n * share) + 1)
    return np.unique(a), np.unique(np.concatenate([a[gone:], rng.integers(0, 1 << 63, more).astype(np.uint64) * np.uint64(2)]))


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_pairs_share_prefixes_and_are_near_when_folded(percent):
    rng = np.random.default_rng(percent)
    tried = 0
    for n in (2, 5, 11, 40, 64, 150, 1030, 2100):
        for _ in range(40):
            pair = near_pair(rng, n, percent)
            common = len(np.intersect1d(*pair))
            if 100 * common < percent * (len(pair[0]) + len(pair[1]) - common):
                continue
            tried += 1
            both = np.intersect1d(*(jaccard.prefix(s, percent) for s in pair))
            for s in pair:
                need = -(-percent * len(s) // 100)
                assert len(both) >= -(-jaccard.EXTRA * need // 100)
            sizes, data = np.array([len(s) for s in pair]), [jaccard.folded(s).tobytes() for s in pair]
            assert len(jaccard.near_folded(sizes, data, np.zeros(2, int), percent)) == 1
            assert len(jaccard.linked_sets(sizes, [s.tobytes() for s in pair], np.array([0, 1]), percent)) == 1
    assert tried > 60


def test_windows_keep_linked_pairs_together():
    """At the home of one of a linked pair stands the other one too."""
    rng = np.random.default_rng(4)
    base = [rng.integers(0, 1 << 63, 120).astype(np.uint64) for _ in range(4)]
    pool = [np.unique(np.concatenate([b[rng.integers(0, 20) :], rng.integers(0, 1 << 63, rng.integers(1, 20)).astype(np.uint64)])) for b in base for _ in range(12)]
    pool = [s for s in pool if len(jaccard.folded(s)) == 32]
    rows_ = [(i, len(s), jaccard.folded(s).tobytes()) for i, s in enumerate(pool)]
    useless = jaccard.voronoi(90)(5, rows_[:6], rows_).to_pylist()  # all pivots near each other
    assert [r["id"] for r in useless] == [None]
    made = jaccard.voronoi(90)(5, rows_[::9], rows_).to_pylist()
    cells = {}
    for r in made:
        cells.setdefault(r["id"], set()).add(r["cell"])
    for a, b in jaccard.linked_sets(np.array([len(s) for s in pool]), [s.tobytes() for s in pool], np.zeros(len(pool), int), 90):
        assert cells[a] & cells[b]


@pytest.mark.parametrize("percent", [80, 90])
def test_candidates_across_classes_of_size(spark, monkeypatch, percent):
    """Around 128 and 256 elements sets change their number of bins; no linked pair may get lost in a large cell."""
    monkeypatch.setattr(jaccard, "CELL", 8)
    monkeypatch.setattr(jaccard, "PIVOTS", 4)
    monkeypatch.setattr(jaccard, "BLOCK", 9)
    rng = np.random.default_rng(percent)
    pool = []
    for size in (128, 256):
        common = rng.integers(0, 1 << 63, size).astype(np.uint64) * np.uint64(2)
        for _ in range(60):
            gone = rng.permutation(size)[: rng.integers(0, size * (100 - percent) // 120)]
            more = rng.integers(0, 1 << 63, rng.integers(0, size * (100 - percent) // 120)).astype(np.uint64) * np.uint64(2)
            pool.append(np.unique(np.concatenate([np.delete(common, gone), more])))
    items = spark.createDataFrame([(i, len(s), s.tobytes()) for i, s in enumerate(pool)], "id long, n long, items binary")
    cells = spark.createDataFrame([(1, i) for i in range(len(pool))], "cell long, id long")
    found = jaccard._union(jaccard._candidates(cells, jaccard.written(jaccard._folds(items), "folded"), percent))
    part = {r.id: r.component for r in components(found).collect()}
    links = 0
    for a in range(len(pool)):
        for b in range(a):
            common = len(np.intersect1d(pool[a], pool[b]))
            if 100 * common >= percent * (len(pool[a]) + len(pool[b]) - common):
                links += 1
                assert part.get(a, a) == part.get(b, b)
    assert links > 50


def test_keys_that_two_ids_hold(spark):
    rng = random.Random(8)
    held = [(i, [rng.randrange(250) << 40 | 7 for _ in range(rng.randint(0, 9))] + [5] * (i % 2)) for i in range(200)]
    df = spark.createDataFrame([(i, np.array(k, np.uint64).tobytes()) for i, k in held], "id long, keys binary").repartition(3)
    who = {}
    for i, keys in held:
        for k in keys:
            who.setdefault(k, set()).add(i)
    got = {(r.key, r.id) for r in jaccard.shared_keys(df).collect()}
    assert got == {(k, i) for k, ids in who.items() if len(ids) > 1 for i in ids}
