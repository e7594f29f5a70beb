import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from foliary.llm import suffixes
from tests.llm.fixture import documents, rows


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, digest) of each text, by counting every string of ``length`` bytes."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(d, gone, strict=True) if not g)).hexdigest()))
    return out


def texts(seed):
    rng = random.Random(seed)
    draw = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    passages = [draw(n) for n in (30, 47, 48, 49, 50, 60, 100, 150, 400)]
    out = [None, "", "x", "a" * 300, "ab" * 90, "abc" * 50 + "d", draw(48)]
    for _ in range(60):
        t = draw(rng.randint(0, 120))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            t += p[rng.randint(0, 5) : len(p) - rng.randint(0, 5)] + draw(rng.randint(0, 60))
        out.append(t)
    return out + out[20:24] + [out[30] + "!"]


@pytest.mark.parametrize("seed,hot", [(1, 2000), (2, 3)])
def test_same_as_brute_force(spark, seed, hot):
    made = texts(seed)
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(made)])
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows(suffixes.report(docs, 48, 8, hot))}
    want = brute(made, 48)
    assert len(got) == len(made)
    assert [i for i, w in enumerate(want) if got[i] != w] == []
    assert sum(w[1] for w in want) > 0


def test_equal_rows_and_ids(spark):
    long = "".join(random.Random(1).choice("abcdef ") for _ in range(900))
    docs = documents(spark, [(1, long, "s"), (1, long, "s"), (2, long[:399], "s"), (2, "other", "s"), (None, long[100:600], "s")])
    got = rows(suffixes.report(docs))
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in got) == [(0, 500, 500), (1, 900, 900), (1, 900, 900), (2, 5, 0), (2, 399, 0)]
    assert suffixes.report(docs.limit(0)).count() == 0


def test_report_shows_passages_of_few_bytes(spark):
    rng = random.Random(5)
    draw = lambda n: " ".join(f"w{rng.randrange(10**4)}" for _ in range(n))
    passage, begin, end, alone = draw(51), draw(20), draw(20), draw(200)
    assert len(passage) < 400
    docs = documents(spark, [(1, f"{begin} {passage} {end}", "s"), (2, passage, "s"), (3, alone, "s"), (4, None, "s")])
    got = {r["doc_id"]: r for r in rows(suffixes.report(docs))}
    assert {i: (r["n_passages"], r["text"]) for i, r in got.items()} == {1: (len(passage), f"{begin}  {end}"), 2: (len(passage), ""), 3: (0, alone), 4: (0, "")}
    # the contract's columns count strings of 400 bytes alone
    assert [r["n_removed"] for r in got.values()] == [0] * 4
    assert got[1]["kept_sha256"] == hashlib.sha256(f"{begin} {passage} {end}".encode()).hexdigest()


@pytest.mark.parametrize("hot", [2000, 3])
def test_passages_of_words_as_counted(spark, hot):
    rng = random.Random(hot)
    draw = lambda n: [rng.choice(["", "é", "Ab"]) + str(rng.randrange(40)) for _ in range(n)]
    passages = [draw(n) for n in (50, 51, 52, 59, 130)]
    made = [None, "", " \n", "x " * 90, "  " + " ".join(passages[2]) + "\n"]
    for i in range(40):
        w = draw(rng.randint(0, 70)) + passages[i % 5] + draw(rng.randint(0, 70))
        w[rng.randrange(len(w))] += "!" * (i % 3 == 0)
        made.append(rng.choice(["", "\n"]) + "".join(x + rng.choice([" ", " ", "\n", " \t"]) for x in w))
    data = [(t or "").encode() for t in made]
    where = [[m.span() for m in re.finditer(rb"\S+", d)] for d in data]
    window = lambda d, at, k: tuple(d[a:b] for a, b in at[k : k + 51])
    count = Counter(window(d, at, k) for d, at in zip(data, where, strict=True) for k in range(len(at) - 50))
    want = {}
    for i, (d, at) in enumerate(zip(data, where, strict=True)):
        gone = bytearray(len(d))
        for k in range(len(at) - 50):
            if count[window(d, at, k)] > 1:
                a, b = at[k][0] if k else 0, at[k + 50][1] if k + 51 < len(at) else len(d)
                gone[a:b] = b"\1" * (b - a)
        want[i] = (sum(gone), bytes(x for x, g in zip(d, gone, strict=True) if not g).decode())
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(made)])
    got = {r.doc_id: (r.n_removed, r.n_passages, r.text) for r in suffixes.cleaned(docs, 4000, hot=hot, words=51).collect()}
    assert got == {i: (0, *w) for i, w in want.items()}
    assert sum(n > 0 for n, _ in want.values()) > 15 and want[4][1] == ""


def test_hashes_of_words_do_not_depend_on_segments(monkeypatch):
    data = " ".join(["é" * (i % 9) + str(i) for i in range(500)]).encode() + b"  "
    whole = suffixes.word_hashes(data)
    monkeypatch.setattr(suffixes, "SEGMENT", 7)
    assert suffixes.word_hashes(data) == whole and len(whole) == 8 * 500
    assert suffixes.word_hashes(b"") == suffixes.word_hashes(b" \n") == b""


def test_words_of_many_texts_at_once():
    data = [b"", b"a b", b" ", b"c", "  é x\n".encode(), b"a b", b""]
    assert suffixes.words_of(data) == [suffixes.word_hashes(d) for d in data]
    assert suffixes.words_of([]) == []


@pytest.mark.parametrize("segment", [1, 7, 100, 1 << 15])
def test_stretches_do_not_depend_on_segments(monkeypatch, segment):
    rng = random.Random(segment)
    data = [bytes(rng.choice(b"ab") for _ in range(n)) for n in (0, 47, 48, 49, 300, 5, 120, 48)]
    each = lambda got: sorted((i, k, at, anchor) for anchor, i, low, high, at in got for k in range(low, high + 1))
    alone = each((anchor, i, *rest) for i, d in enumerate(data) for anchor, *rest in suffixes.stretches(d, 48, 8))
    monkeypatch.setattr(suffixes, "SEGMENT", segment)
    assert each(row for part in suffixes.all_stretches(data, 48, 8) for row in zip(*(x.tolist() for x in part), strict=True)) == alone
    assert [(i, k) for i, k, _, _ in alone] == [(i, k) for i, d in enumerate(data) for k in range(len(d) - 47)]


@pytest.mark.parametrize("length,gram", [(400, 64), (48, 8), (33, 16)])
def test_equal_strings_have_equal_anchors(length, gram):
    rng = random.Random(length)
    for _ in range(20):
        core = bytes(rng.choice(b"abc") for _ in range(length + rng.randint(0, 30)))
        where = []
        for _ in range(2):
            lead = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 500)))
            text = lead + core + bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 500)))
            where.append({i - len(lead): at - i for _, low, high, at in suffixes.stretches(text, length, gram) for i in range(low, high + 1)})
        for i in range(len(core) - length + 1):
            assert where[0][i] == where[1][i]


@pytest.mark.parametrize("modulus", [8, 16, 32, 64])
def test_two_residues_meet_in_the_cover(modulus):
    cover, step = set(suffixes.difference_cover(modulus)), suffixes.shifts(modulus)
    for i in range(modulus):
        for j in range(modulus):
            assert 0 <= step[i, j] < modulus
            assert (i + step[i, j]) % modulus in cover and (j + step[i, j]) % modulus in cover
    assert len(cover) <= 2 * modulus**0.5


def test_ranks_of_the_cover_sort_like_the_strings():
    rng = random.Random(2)
    data = np.frombuffer(bytes(rng.choice(b"ab") for _ in range(700)) + bytes(80), np.uint8)
    ranks = suffixes.cover_ranks(data, 48, 16)
    places = [p for p in range(640) if p % 16 in suffixes.difference_cover(16)]
    for a, b in zip(places, rng.sample(places, len(places)), strict=True):
        x, y = data[a : a + 48].tobytes(), data[b : b + 48].tobytes()
        assert (ranks[a] < ranks[b]) == (x < y) and (ranks[a] == ranks[b]) == (x == y)


@pytest.mark.parametrize("near", [0, 1, 3, 64])
@pytest.mark.parametrize("width,modulus", [(1, 32), (8, 32), (8, 64)])
def test_ties_of_any_number_as_counted(near, width, modulus):
    rng = random.Random(near)
    units = [bytes([rng.randrange(3)] * width) for _ in range(3)]
    core = [rng.choice(units) for _ in range(200)]
    bodies, places = [], []
    for _ in range(40):
        low = rng.randint(0, 40)
        body = core[low : rng.randint(81, 160)]
        if len(body) < 80:
            continue
        if rng.random() < 0.5:
            body[rng.randrange(len(body))] = rng.choice(units)
        bodies.append(b"".join(body))
        places.append((60 - low) * width)
    length = 80 * width
    seen = Counter((place - i, body[i : i + length]) for body, place in zip(bodies, places, strict=True) for i in range(0, len(body) - length + 1, width))
    got = suffixes.sort_block(bodies, places, [1] * len(bodies), length, modulus, width, near)
    for body, place, flags in zip(bodies, places, got, strict=True):
        assert flags.tolist() == [seen[place - i, body[i : i + length]] > 1 for i in range(0, len(body) - length + 1, width)]
    assert max(seen.values()) > 3


@pytest.mark.parametrize("length,modulus", [(48, 8), (60, 16), (100, 32), (400, 32)])
def test_sorted_blocks_as_counted(length, modulus):
    rng = random.Random(length)
    for _ in range(12):
        core = bytes(rng.choice(b"ab") for _ in range(3 * length))
        bodies, places = [], []
        for _ in range(9):
            anchor = rng.randint(length, 2 * length - 9)
            low = max(0, anchor - rng.randint(0, length - 9))
            body = bytearray(core[low : rng.randint(low, anchor) + length])
            if rng.random() < 0.5:
                body[rng.randrange(len(body))] ^= 1
            bodies.append(bytes(body))
            places.append(anchor - low)
        copies = [rng.choice([1, 1, 1, 2]) for _ in bodies]
        seen = Counter()
        for body, place, n in zip(bodies, places, copies, strict=True):
            for i in range(len(body) - length + 1):
                seen[place - i, body[i : i + length]] += n
        for body, place, got in zip(bodies, places, suffixes.sort_block(bodies, places, copies, length, modulus), strict=True):
            assert got.tolist() == [seen[place - i, body[i : i + length]] > 1 for i in range(len(body) - length + 1)]


def test_columns_of_any_name_are_kept(spark):
    docs = documents(spark, [(1, "a" * 900, "s"), (2, "b", "s")]).selectExpr("doc_id", "text", "5 AS _runs", "6 AS _id", "7 AS _text_key", "8 AS runs", "9 AS n_bytes")
    out = suffixes.cleaned(docs)
    assert out.columns == ["doc_id", "text", "_runs", "_id", "_text_key", "runs", "n_bytes", "n_removed", "n_spans", "kept"]
    assert {tuple(r)[2:8] for r in out.collect()} == {(5, 6, 7, 8, 900, 900), (5, 6, 7, 8, 1, 0)}
