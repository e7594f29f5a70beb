"""Chunks, callbacks, ranks in cells, results by kind, and the one entry to the converters."""

import json
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from foliary.operators import facade, html, manifest, nested, outputs, slides, tasks
from foliary.plans import registry
from foliary.sources import files
from foliary.streaming import events


def test_chunks_cut_characters_and_lines():
    whole = "data: é\nline two\n\nlast".encode()
    for size in range(1, 9):
        chunks = [whole[i : i + size] for i in range(0, len(whole), size)]
        assert list(events.lines(events.decoded(iter(chunks)))) == ["data: é", "line two", "", "last"]
    assert "".join(events.decoded(iter([b"\xff", b"a"]))) == "�a"


def test_following_calls_back_and_closes(spark, tmp_path):
    made = spark.createDataFrame([("t1", "pdf.parse", "running", 1, None), ("t1", "pdf.parse", "completed", 2, None)], events.SNAPSHOT)
    made.write.parquet(str(tmp_path / "in"))
    seen, failed = [], []

    def update(batch):
        seen.append(batch.count())
        raise ValueError("no")

    follow = events.Following(events.snapshots(spark, str(tmp_path / "in")), update, str(tmp_path / "c"), failed.append)
    follow.wait(60)
    assert seen == [2] and [str(e) for e in failed] == ["no"]
    running = events.Following(events.snapshots(spark, str(tmp_path / "in")), lambda batch: None, str(tmp_path / "d"), every="2 seconds")
    running.close()
    running.close()
    assert not running.query.isActive


def test_ranks_in_cells(spark, monkeypatch):
    monkeypatch.setattr(outputs, "CELL", 7)
    rows = [(i * 3 % 101, "a" if i % 3 else None) for i in range(101)] + [(None, "b"), (5, "b")]
    got = outputs.ranked(spark.createDataFrame(rows, "doc_id long, source string"), "source", "doc_id").collect()
    for source in ("a", "b", None):
        own = sorted(((r["at"], r.doc_id) for r in got if r.source == source))
        assert [p for p, _ in own] == list(range(1, len(own) + 1)) and all(r.total == len(own) for r in got if r.source == source)
        ids = [i for _, i in own if i is not None]
        assert ids == sorted(ids)


def test_results_by_kind(spark):
    known = spark.createDataFrame([(1, "generation"), (2, "pdf.parse"), (3, "revamp")], "task_id long, type string")
    kept = spark.createDataFrame([(1, "html", "h"), (1, "pptx", "p"), (2, None, "r")], "task_id long, kind string, result string")
    assert {r.task_id: r.result for r in tasks.with_results(known, kept).collect()} == {1: "h", 2: "r", 3: None}
    assert {r.task_id: r.result for r in tasks.with_results(known, kept, "pptx").collect()} == {1: "p", 2: "r", 3: None}
    with pytest.raises(ValueError):
        tasks.with_results(known, kept, "gif")


def test_pages_by_mode(spark):
    pages = spark.createDataFrame([("u", "runtime", "r"), ("u", "source", "s")], "url string, mode string, html string")
    asked = spark.createDataFrame([("u",), ("v",)], "url string")
    assert {r.url: r.html for r in files.by_url(pages, asked, "source").collect()} == {"u": "s", "v": None}
    with pytest.raises(ValueError):
        files.by_url(pages, asked, "other")


def test_pages_that_share_a_url(spark, tmp_path):
    made = [(1, "u", "a"), (2, "u", "bb"), (3, "v", None), (4, None, "é"), (4, "w", "x"), (4, "w", "x"), (5, "", "")]
    spark.createDataFrame(made, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = [tuple(r) for r in registry.pages_by_url(spark, str(tmp_path)).collect()]
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
        want = con.execute(registry.oracle_sql()["pages_by_url"]).fetchall()
    assert sorted(got, key=str) == sorted(want, key=str)
    assert len(got) == 2 * len(made)


def test_inline_needs_files_and_no_ids(spark):
    made = spark.createDataFrame([("a", 5, 0), ("b", None, 0), ("c", 5, 2)], "job string, bytes long, ids long")
    assert {r.job: (r.files, r.inline) for r in manifest.inline_decision(made, "job", given="ids").collect()} == {"a": (1, True), "b": (0, False), "c": (1, False)}


def test_options_of_a_file_win(spark):
    row = spark.createDataFrame([(None, "f")], "a string, b string").select(*manifest.merged_options({"a": F.col("a"), "b": F.col("b")}, {"a": F.lit("da"), "c": F.lit("dc")})).first()
    assert row.asDict() == {"a": "da", "c": "dc", "b": "f"}


def test_lists_of_different_lengths_do_not_pair(spark):
    df = spark.createDataFrame([(["a"], ["x", "y"])], "f array<string>, p array<string>")
    with pytest.raises(Exception, match="different lengths"):
        df.select(tasks.paired(F.col("f"), F.col("p"), F.col("p")).alias("x")).collect()


def test_entry_of_bad_results(spark):
    made = [("a.pdf", None, "{"), ("b.pptx", None, "["), ("c", None, None), (None, None, "{}"), ("d", "https://h", '{"html": null}')]
    got = {r.name: (r.task_type, r.markdown, r.error) for r in facade.markdown(spark.createDataFrame(made, "name string, url string, result string")).collect()}
    assert got["a.pdf"][0] == "pdf.parse" and got["b.pptx"] == ("pptx.parse", None, "the result does not fit its kind")
    assert got["c"][2].startswith('Cannot determine parser for "c"') and got[None][2].startswith("Cannot determine parser for input")
    assert got["d"] == ("html.getByURL", None, "html2markdown: empty content extracted from https://h")


def test_deep_nesting_stays_in_its_row(spark):
    depth = sys.getrecursionlimit() * 3
    assert html.page_markdown("<body>" + "<b>" * depth + "x").startswith("*")
    tree: object = ["https://h/1"]
    for _ in range(depth):
        tree = [tree]
    assert nested.files(tree) == ["https://h/1"]
    deck = '{"slides":[{"spTree":[' + '{"type":"Group","xfrm":{"cx":1},"children":[' * depth + "]}" * depth + "]}]}"
    rows = spark.createDataFrame([(deck,), (json.dumps({"slides": []}),)], "d string").select(slides.markdown(F.col("d")).alias("m")).collect()
    assert [r.m for r in rows] == [None, ""]


def test_a_parser_of_ones_own():
    def shout(source):
        return html.parsed(source.upper().replace("BODY", "body"))

    assert html.page_markdown("<body>x</body>", parser=shout) == "X"
