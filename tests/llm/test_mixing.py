import random
from collections import Counter

from foliary.llm import mixing
from tests.llm.fixture import documents, rows, same


def corpus(spark, n=600):
    rng = random.Random(9)
    made = [(i, " ".join(["w"] * int(rng.paretovariate(0.8) * 5 % 4000)), rng.choice(["a"] * 6 + ["b", "c", None, ""])) for i in range(n)]
    return documents(spark, [*made, (n, None, "a"), (n + 1, "", "only-empty"), (5, "x y", "a"), (5, "x y", "a"), (None, "x y z", "b")])


def test_same_as_sql(spark):
    docs = corpus(spark)
    same(mixing.report(docs), mixing.sql(), documents=docs)


def test_targets_and_limits(spark):
    got = rows(mixing.copies(corpus(spark)))
    total = sum(r["size"] for r in got)
    taken, target, size = Counter(), {}, {}
    for r in got:
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]], size[r["source"]] = r["target"], r["source_size"]
    assert abs(sum(target.values()) - total) < 1e-6 * total
    for s, t in target.items():
        assert t <= 3 * size[s] + 1e-6
        assert abs(taken[s] - t) <= 0.12 * t + 4000, (s, taken[s], t)
    assert rows(mixing.copies(corpus(spark))) == got


def test_full_sources_pass_on_their_excess(spark):
    docs = documents(spark, [(1, "w " * 10, "a"), (2, "w " * 1000, "b"), (3, "w " * 1000, "c")])
    target = {r["source"]: r["target"] for r in rows(mixing.copies(docs))}
    assert target["a"] == 30 and abs(target["b"] - 1980 * 2 / 3) < 1e-6 and abs(target["c"] - 660) < 1e-6


def test_mix_emits_the_copies(spark):
    docs = corpus(spark)
    want = Counter()
    for r in rows(mixing.copies(docs)):
        want[r["doc_id"]] += r["copies"]
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert Counter(r["doc_id"] for r in rows(out)) == +want


def test_empty_table(spark):
    assert mixing.report(corpus(spark).limit(0)).count() == 0
    assert mixing.mixed(corpus(spark).limit(0)).count() == 0


def test_reruns_agree_for_shuffled_rows_and_repeated_ids(spark):
    rng = random.Random(3)
    made = [(rng.randrange(40), " ".join(["w"] * rng.randint(1, 40)) + rng.choice(["", "", " v"]), rng.choice("ab")) for _ in range(400)] + [(None, "w " * i, "a") for i in range(30)]
    first, again = documents(spark, made), documents(spark, rng.sample(made, len(made))).repartition(7)
    assert rows(mixing.report(first)) == rows(mixing.report(again))
    assert rows(mixing.mixed(first)) == rows(mixing.mixed(again))
    same(mixing.report(first), mixing.sql(), documents=first)


def test_columns_of_any_name_are_kept(spark):
    from pyspark.sql import functions as F

    docs = documents(spark, [(i, "w " * 50, "a") for i in range(20)])
    names = ("_size", "_n", "_copy", "_doc", "_source", "_words", "_all", "_rows", "size", "copies", "rows", "row", "n", "copy", "rank")
    wide = docs.select("doc_id", "text", "source", *[F.lit(77 + i).alias(c) for i, c in enumerate(names)])
    out = mixing.mixed(wide)
    assert out.columns == wide.columns and out.count() == 20
    assert all(tuple(r)[3:] == tuple(77 + i for i in range(len(names))) for r in out.collect())
