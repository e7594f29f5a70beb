"""Documents with the awkward cases: nulls, empty and long texts, ties, repeats, further columns."""

import duckdb

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size string, words string, score string"


def documents(spark, rows):
    """rows: (doc_id, text, source); the further columns clash with names that operators use."""
    return spark.createDataFrame([(i, t, "en", s, None, "x", None, "y") for i, t, s in rows], COLUMNS)


def duck(sql, **frames):
    con = duckdb.connect()
    for name, df in frames.items():
        con.register(name, df.toArrow())
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    return sorted((dict(zip(names, row, strict=True)) for row in result.fetchall()), key=str_key)


def str_key(row):
    return sorted((k, str(v)) for k, v in row.items())


def rows(df):
    return sorted((r.asDict() for r in df.collect()), key=str_key)


def same(df, sql, **frames):
    got, want = rows(df), duck(sql, **frames)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a.keys() == b.keys()
        for k in a:
            assert a[k] == b[k] or abs(a[k] - b[k]) < 1e-9 * max(1, abs(b[k])), (k, a, b)
