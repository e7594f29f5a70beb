import random

import numpy as np
from pyspark.sql import functions as F

from foliary.llm import neardup, topk
from tests.llm.fixture import duck, rows, same


def vectors(spark, n=400, d=12):
    rng = random.Random(4)
    centres = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(15)]
    made = []
    for i in range(n):
        c = rng.choice(centres)
        made.append((i, [float(x + rng.gauss(0, rng.choice([0.05, 0.2, 1]))) for x in c], "x", 1))
    made += [(n + i, made[7][1], "x", 1) for i in range(60)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * d, [None] + [1.0] * (d - 1), [nan] + [1.0] * (d - 1), [inf] + [1.0] * (d - 1)]
    made += [(1000 + i, v, None, None) for i, v in enumerate(odd)] + [(300, made[3][1], "x", 2)]
    made += [(1100, made[200][1], "x", 2), (1200, [-x for x in made[200][1]], "x", 2), (1300, [2 * x for x in made[5][1]], "x", 2)]
    return spark.createDataFrame(made, "vec_id long, embedding array<float>, score string, rank int")


def test_search_as_sql(spark):
    v = vectors(spark).where("vec_id <> 300")
    same(topk.search(topk.scaled(v), F.col("vec_id") % 100 == 0, 10, n_pivots=8, block=50), topk.sql(), embeddings=v)


def test_search_with_repeated_query_rows(spark):
    """vec_id 300 stands on two vectors, and query rows are repeated identically inside tight clusters."""
    rng = random.Random(6)
    centres = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(40)]
    # fewer vectors in a cluster than are asked for
    made = [(10000 + 20 * i, [x + rng.gauss(0, 0.01) for x in centres[i % 40]], "x", 1) for i in range(200)]
    made += [row for row in made if row[0] % 1000 == 0 for _ in range(11)]
    tight = spark.createDataFrame(made, "vec_id long, embedding array<float>, score string, rank int")
    same(topk.search(topk.scaled(tight), F.col("vec_id") % 100 == 0, 10, n_pivots=160), topk.sql(), embeddings=tight)
    v = vectors(spark).unionByName(tight.where("vec_id % 100 <> 0"))
    two = [r.embedding for r in v.where("vec_id = 300").collect()]
    got = rows(topk.search(topk.scaled(v), F.col("vec_id") % 100 == 0, 10, n_pivots=32, block=50))
    either = []
    for own in two:  # as a query it is one of its rows, as a candidate both
        one = v.where("vec_id <> 300").unionByName(v.where("vec_id = 300").limit(1).withColumn("embedding", F.array(*map(F.lit, own)).cast("array<float>")))
        either.append([r for r in duck(topk.sql(), embeddings=one) if r["query_id"] == 300])
    assert [r for r in got if r["query_id"] == 300] in either
    others = "FROM (SELECT DISTINCT ON (vec_id) * FROM v WHERE vec_id % 100 = 0 AND vec_id <> 300)"
    want = duck(topk.sql().replace("FROM (SELECT DISTINCT ON (vec_id) * FROM v WHERE vec_id % 100 = 0)", others), embeddings=v)
    assert [r for r in got if r["query_id"] != 300] == want


def test_search_of_few_rows(spark):
    few = vectors(spark).where("vec_id in (0, 1, 2, 100)")
    same(topk.search(topk.scaled(few), F.col("vec_id") % 100 == 0, 10), topk.sql(), embeddings=few)
    assert topk.search(topk.scaled(few.limit(0)), F.col("vec_id") % 100 == 0, 10).count() == 0


def test_search_with_rings_and_parts(spark):
    """One cell of many vectors is cut into rings, and many equal vectors into parts."""
    v = vectors(spark, 900).where("vec_id <> 300")
    same(topk.search(topk.scaled(v), F.col("vec_id") % 100 == 0, 10, n_pivots=2, block=30), topk.sql(), embeddings=v)
    same(topk.search(topk.scaled(v), F.col("vec_id") % 100 == 0, 7, n_pivots=40, block=100), topk.sql().replace("rank <= 10", "rank <= 7"), embeddings=v)


def test_search_ships_queries_only_where_they_can_find_something():
    """In clustered data most pieces are passed over; the true neighbours' pieces never are."""
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 1, (30, 16)) * 100
    x = np.floor(centres[rng.integers(0, 30, 3000)] + rng.normal(0, 1, (3000, 16)))
    norm = float(np.sqrt((x * x).sum(1)).max()) * (1 + 1e-12)
    high = topk.raised(x, norm)
    pivots = high[:60]
    far = topk.distances(high, pivots)
    cell, away = far.argmin(1), far.min(1)
    owner, sure = [], []
    for c in range(60):
        for d in np.sort(away[cell == c])[:11]:
            owner.append(c)
            sure.append(d)
    low, top = (np.array([f(away[cell == c]) for c in range(60)]) for f in (np.min, np.max))
    known = topk.Summary(pivots, top, np.array(owner), np.array(sure), 1e-6 * norm, np.arange(60), np.arange(60), low, top, np.ones(60, int))
    queries = x[::100]
    row, piece = known.needed(topk.raised(queries, None), 10)
    assert len(row) < 0.25 * len(queries) * 60
    met = {(r, p) for r, p in zip(row.tolist(), piece.tolist(), strict=True)}
    for i, q in enumerate(queries):
        for j in np.argsort(-(x @ q), kind="stable")[:11]:
            assert (i, int(cell[j])) in met


def test_near_duplicates_as_sql(spark):
    v = vectors(spark)  # vec_id 300 stands on two vectors
    longer = [(500 + i, [1.0, 2.0, 3.0 + 0.1 * i], "x", 1) for i in range(9)] + [(540, [1.0], "x", 1), (541, [2.0], "x", 1), (541, [-2.0], "x", 1), (7, [1.0, 2.0, 3.0], "x", 1)]
    v = v.unionByName(spark.createDataFrame(longer, v.schema))
    # every pivot in every prefix: nothing may be missed, whatever the blocks
    same(neardup.classes(v, prefix=6, n_pivots=6, block=40), neardup.sql(), embeddings=v)
    same(neardup.classes(v, prefix=12, n_pivots=12, block=2000), neardup.sql(), embeddings=v)
    assert neardup.classes(v.select("vec_id", "embedding").limit(0)).count() == 0


def test_blocks_in_which_everything_links():
    """Slices give the counts and parts of all pairs at once."""
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.normal(0, 0.01, (150, 8)) + 1, rng.normal(0, 1, (50, 8))])
    m = rng.integers(1, 4, 200)
    link = neardup._units(v) @ neardup._units(v).T >= 0.9
    np.fill_diagonal(link, False)
    everything = np.arange(200)
    n, label = neardup.compared(v, m, np.zeros((200, 0), int), None, everything, everything, 0.9)
    assert (n == link @ m).all()
    assert (label == neardup._spread(*np.nonzero(link), 200)).all()
    n, label = neardup.compared(v, m, np.zeros((200, 0), int), None, everything[:120], everything[120:], 0.9)
    link[:120, :120] = link[120:, 120:] = False
    assert (n == link @ m).all() and (label == neardup._spread(*np.nonzero(link), 200)).all()


def test_recall_of_the_index(spark):
    got = {r["vec_id"]: r for r in rows(neardup.query(spark, "/root/testdata/sf0.01"))}
    from tests.llm.fixture import duck

    want = duck(neardup.sql(), embeddings=spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet"))
    assert sum(r["n_links"] for r in got.values()) >= 0.95 * sum(r["n_links"] for r in want)
    assert all(got[r["vec_id"]]["n_links"] <= r["n_links"] for r in want)
