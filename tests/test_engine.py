"""Routing, manifests, outputs, the task log, streams, and every query against its SQL."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from foliary.functions import text
from foliary.operators import catalog, manifest, outputs, tasks
from foliary.plans import registry
from foliary.sources import files
from foliary.streaming import events

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return con


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_as_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    got = df.toArrow().to_pylist()
    if name not in registry.oracle_sql():
        assert got
        return
    result = duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    want = [dict(zip(names, r, strict=True)) for r in result.fetchall()]
    key = lambda r: sorted((k, str(v)) for k, v in r.items())
    assert sorted(map(key, got)) == sorted(map(key, want))


def values(spark, column, *rows):
    return [r.v for r in spark.createDataFrame([(x,) for x in rows], "x string").select(column(F.col("x")).alias("v")).collect()]


def test_routing(spark):
    names = ["a.pdf", "/tmp/deck.PPTX", "report.docx", "https://x.com/a/b.key?v=1#f", "a.txt", "noext"]
    assert values(spark, catalog.parse_type, *names) == ["pdf.parse", "pptx.parse", "docx.parseTextAndImage", "keynote.parseTextAndImage", None, None]
    assert values(spark, text.extension_of, ".gitignore", "a/b/c.tar.gz", "", "https://h.com", "c:\\x\\y.Key") == ["", ".gz", "", ".com", ".key"]
    assert values(spark, lambda x: catalog.convert_type(F.lit("png"), x), "a.md", "a.pdf") == ["convertor.markdown2png", None]
    assert values(spark, lambda x: catalog.extract_type(x, F.lit("a.pptx")), "text-shapes", None) == ["pptx.getTextShapes", "pptx.getFontInfo"]


def test_scalars(spark):
    assert values(spark, text.positive, "7", "07", "0", "x") == [7, None, None, None]
    assert values(spark, text.natural, "0", "10", "-1") == [0, 10, None]
    assert values(spark, text.encoded, "a b/ü") == ["a%20b%2F%C3%BC"]
    assert values(spark, text.is_uuid4, "3f2b6c1e-8a1d-4c3b-9f00-0123456789ab", "3f2b6c1e-8a1d-1c3b-9f00-0123456789ab") == [True, False]
    assert values(spark, text.link_target, "a.png", "a b>.png") == ["a.png", "<a b%3E.png>"]
    retry = lambda m: text.retriable(F.lit(None).cast("int"), m)
    assert values(spark, retry, "API Error (502): x", "API Error (404): network", "ECONNREFUSED", "no", None) == [True, False, True, False, False]
    got = [r.v for r in spark.createDataFrame([("a=1=2",), ('b={"x":1}',)], "x string").select(F.to_json(text.parameter(F.col("x"))).alias("v")).collect()]
    assert got == ['{"key":"a","value":"1=2"}', '{"key":"b","value":{"x":1}}']


def test_outputs(spark, tmp_path):
    rows = spark.createDataFrame([("out.pdf",), ("out",), ("out.png",), ("dir/",)], "o string").select(outputs.file_path(F.col("o"), F.lit("t1"), F.lit(".pdf")).alias("p")).collect()
    assert [r.p for r in rows] == ["out.pdf", "out/t1.pdf", "out.png/t1.pdf", "dir/t1.pdf"]
    kinds = spark.createDataFrame([(0, "o"), (1, "o"), (2, "o"), (2, "o.zip")], "n int, o string").select(outputs.sink_kind(F.col("n"), F.col("o")).alias("k")).collect()
    assert [r.k for r in kinds] == ["json", "file", "directory", "zip"]
    named = spark.createDataFrame([(1, 2, "https://h/a.JPG?x=1"), (7, 120, "https://h/b")], "i int, n int, u string").select(outputs.numbered(F.col("i"), F.col("n"), F.col("u")).alias("f")).collect()
    assert [r.f for r in named] == ["01.jpg", "007.bin"]
    assert outputs.write_output("zip", str(tmp_path / "a.zip"), [("01.txt", b"x"), ("02.txt", b"y")])
    assert outputs.write_output("directory", str(tmp_path / "d"), [("01.txt", b"x")]) == [str(tmp_path / "d" / "01.txt")]
    import zipfile

    assert zipfile.ZipFile(tmp_path / "a.zip").read("02.txt") == b"y"


def test_manifest(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"0123456789")
    (tmp_path / "c.txt").write_bytes(b"other")
    # Spark's file scan passes over files without bytes
    found = files.files(spark, str(tmp_path), "*.bin").select("name", "content").unionByName(files.in_memory(spark, [("b.bin", b"")]))
    rows = {r.name: r for r in manifest.manifest(found).collect()}
    assert rows["a.bin"].hash == "781e5e245d69b566979b86e28d23f2c7" and rows["b.bin"].bytes == 0
    parts = manifest.part_contents(found, 4).orderBy("name", "part_number").collect()
    assert [(r.name, r.part_number, bytes(r.content)) for r in parts] == [("a.bin", 1, b"0123"), ("a.bin", 2, b"4567"), ("a.bin", 3, b"89"), ("b.bin", 1, b"")]
    with pytest.raises(ValueError):
        files.in_memory(spark, [(None, b"x")])
    sized = spark.createDataFrame([("s", 10485759), ("t", 10485760)], "source string, bytes long")
    assert {r.source: r.inline for r in manifest.inline_decision(sized, "source").collect()} == {"s": True, "t": False}


def test_event_frames():
    lines = ["data: {\"id\": 1,", "data: \"status\": \"running\"}", "", ": note", "data: nonsense", "", "event: x", "data: {\"id\": 1, \"status\": \"completed\"}"]
    got = list(events.frames(iter(lines)))
    assert [x["status"] for x in got] == ["running", "completed"]
    assert events.until_final(iter(got + got)) == (got, True)


def test_stream_ends_as_batch(spark, tmp_path):
    from foliary.plans import adapters

    log = adapters.task_log(spark, SF).select(F.col("task_id").cast("string").alias("task_id"), "type", "status", "seq", F.col("ts").cast("timestamp").alias("ts"))
    log.orderBy("ts", "seq").coalesce(1).write.parquet(str(tmp_path / "in"))
    query = events.follow(events.snapshots(spark, str(tmp_path / "in")), "1000 days").writeStream.format("memory").queryName("ended").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = {(r.task_id, r.outcome, r.seq) for r in spark.table("ended").where("outcome <> 'timeout'").collect()}
    want = {(str(r.task_id), r.status, r.seq) for r in tasks.first_final(adapters.task_log(spark, SF)).collect()}
    assert got == want


def test_task_log(spark):
    log = spark.createDataFrame([(1, "pending", 1, 1), (1, "completed", 2, 2), (1, "failed", 3, 3), (2, "running", 1, 4)], "task_id long, status string, ts long, seq long")
    assert [(r.task_id, r.status) for r in tasks.first_final(log).collect()] == [(1, "completed")]
    assert tasks.until_final(log).count() == 3
    assert {r.task_id: r.status for r in tasks.latest(log).collect()} == {1: "failed", 2: "running"}
    assert [r.v for r in spark.createDataFrame([("",), ("e",)], "x string").select(tasks.failure(F.col("x")).alias("v")).collect()] == ["Task failed: Unknown error", "Task failed: e"]


def test_validation(spark):
    from foliary.operators import validation as v

    df = spark.createDataFrame([(["a.pptx", "b.PPTX"],), (["a.pptx"],), (["a.pptx", "b.pdf"],), ([],)], "f array<string>")
    assert [r.v for r in df.select(v.join_error(F.col("f")).alias("v")).collect()] == [None, "INVALID_ARGS", "UNSUPPORTED_TYPE", "INVALID_ARGS"]
    assert [r.v for r in df.select(v.generation_error(F.lit(None).cast("string"), F.col("f")).alias("v")).collect()] == [None, None, None, "GENERATION_INPUT_REQUIRED"]
    pair = spark.createDataFrame([("en", "de", "a.key"), ("xx", "de", "a.key"), ("auto", "auto", "a.key"), ("en", "de", "a.txt"), (None, "de", "a.key")], "s string, t string, f string")
    got = [r.v for r in pair.select(v.translation_error(F.col("s"), F.col("t"), F.col("f")).alias("v")).collect()]
    assert got == [None, "INVALID_SOURCE_LANGUAGE", "INVALID_TARGET_LANGUAGE", "UNSUPPORTED_TYPE", "INVALID_SOURCE_LANGUAGE"]
    sides = spark.createDataFrame([("10", None), ("0", "5"), (None, None)], "w string, h string")
    assert [r.v for r in sides.select(v.size_error(F.col("w"), F.col("h")).alias("v")).collect()] == [None, "INVALID_ARGS", None]


def test_request_id(spark):
    row = spark.createDataFrame([("k", '{"traceId": "b"}'), ("x-request-id", "{}")], "k string, b string").select(tasks.request_id(F.create_map("k", F.lit("h")), F.parse_json("b")).alias("r")).collect()
    assert [r.r for r in row] == ["b", "h"]
    body = spark.createDataFrame([('{"error": "no"}',), ('{"message": "", "msg": "m"}',)], "b string").select(tasks.error_message(F.parse_json("b")).alias("m")).collect()
    assert [r.m for r in body] == ["no", "m"]
