"""Named queries over the test tables, and DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text
from ..operators import catalog, facade, html, manifest, nested, outputs, paged, slides, tasks, validation
from ..sources import files
from ..sources.files import table
from ..streaming.events import answers, drained, event_bodies, follow
from . import adapters, cases

Query = Callable[[SparkSession, str], DataFrame]


def pdf_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.pdf(spark, sf_dir).select("doc_id", paged.pdf_markdown(F.col("result")).alias("markdown"))


def keynote_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.keynote(spark, sf_dir).select("conv_id", paged.keynote_markdown(F.col("result")).alias("markdown"))


def docx_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.docx(spark, sf_dir).select("o_orderkey", paged.docx_markdown(F.col("result")).alias("markdown"))


def pptx_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.decks(spark, sf_dir).select("slide", slides.markdown(F.col("deck")).alias("markdown"))


def pptx_participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes that take part in the layout: shown, of some size, and not a blank one that covers the slide."""
    shown = adapters.odd_shapes(spark, sf_dir).where(~F.col("hidden")).where("w > 0 OR h > 0")
    background = (text.trimmed(F.col("txt")) == "") & (F.col("x") <= 0) & (F.col("y") <= 0) & (F.col("w") >= slides.BACKGROUND[0]) & (F.col("h") >= slides.BACKGROUND[1])
    return shown.where(~background).select("slide", "ord", "x", "y", "w", "h", "txt")


def pptx_virtual_container(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = adapters.shapes(spark, sf_dir).where(~F.col("hidden"))
    child, mother = s.alias("c"), s.alias("m")
    over = (F.col("m.w") * F.col("m.h") > F.col("c.w") * F.col("c.h")) & (F.col("m.x") < F.col("c.x") + F.col("c.w")) & (F.col("c.x") < F.col("m.x") + F.col("m.w")) & (F.col("m.y") < F.col("c.y") + F.col("c.h")) & (F.col("c.y") < F.col("m.y") + F.col("m.h"))
    away = (F.col("c.x") - F.col("m.x")) * (F.col("c.x") - F.col("m.x")) + (F.col("c.y") - F.col("m.y")) * (F.col("c.y") - F.col("m.y"))
    pairs = child.join(mother, (F.col("c.slide") == F.col("m.slide")) & over).select("c.slide", "c.ord", F.col("m.ord").alias("mother"), F.struct((F.col("m.w") * F.col("m.h")).alias("area"), away.alias("away"), F.col("m.ord").alias("ord")).alias("key"))
    return pairs.groupBy("slide", "ord").agg(F.min_by("mother", "key").alias("mother"))


def pptx_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of shapes with text and height: one that begins less than the tolerance below all before it goes on with the row."""
    w = W.partitionBy("slide").orderBy("y", "x", "ord")
    s = adapters.shapes(spark, sf_dir).where(~F.col("hidden")).withColumn("gap", F.col("y") - F.max(F.col("y") + F.col("h")).over(w.rowsBetween(W.unboundedPreceding, -1)))
    new = (F.col("gap").isNull() | (F.col("gap") == 0) | (F.col("gap") > 9000)).cast("int")
    rows = s.withColumn("row", F.sum(new).over(w.rowsBetween(W.unboundedPreceding, 0)))
    return rows.groupBy("slide", "row").agg(F.count("*").alias("shapes"), F.min("y").alias("top"), F.max(F.col("y") + F.col("h")).alias("bottom"))


def html_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", html.converted(F.col("html"), F.col("url")).alias("r")).select("page_id", "r.markdown", "r.error")


def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.replace(F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1), F.lit("&amp;"), F.lit("&"))
    return table(spark, sf_dir, "pages").select("page_id", F.trim(F.regexp_replace(found, r"[ \t\r\f]+", " ")).alias("title"))


def route_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.extension_of(F.col("url")).alias("ext"), F.lit("html.getByURL").alias("task_type"))


def route_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("name")
    return adapters.manifest(spark, sf_dir).select(
        "doc_id", text.extension_of(name).alias("ext"), catalog.parse_type(name).alias("parse"), catalog.convert_type(F.lit("image"), name).alias("image"),
        catalog.convert_type(F.lit("pdf"), name).alias("pdf"), catalog.compress_type(name).alias("compress"), catalog.extract_type(F.lit(None).cast("string"), name).alias("extract"),
    )


def convert_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = adapters.manifest(spark, sf_dir).select((F.col("doc_id") / 3).cast("bigint").alias("job"), "name")
    return catalog.validated(jobs, F.lit("image"))


def task_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.task_catalog(spark)


def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.manifest(spark, sf_dir)


def upload_needed(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = adapters.manifest(spark, sf_dir)
    return manifest.upload_needed(held, held.where("doc_id % 2 = 0")).select("doc_id", "name", "hash")


def inline_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.inline_decision(adapters.manifest(spark, sf_dir), "source")


def chunk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.manifest(spark, sf_dir).select("doc_id", F.explode(manifest.parts(F.col("bytes"), 1024)).alias("p")).select("doc_id", "p.*")


def tasks_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.page(tasks.latest(adapters.task_log(spark, sf_dir)), start=10, most=50)


def tasks_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.total(adapters.task_log(spark, sf_dir), "pdf.parse")


def task_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.latest(adapters.task_log(spark, sf_dir))


def task_first_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.first_final(adapters.task_log(spark, sf_dir))


def task_until_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.until_final(adapters.task_log(spark, sf_dir)).groupBy("task_id").agg(F.count("*").alias("snapshots"), F.max("seq").alias("last_seq"))


def task_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.waited(adapters.task_log(spark, sf_dir), 86400)


def task_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = adapters.task_log(spark, sf_dir).groupBy("task_id").agg(F.count_if(F.col("status") == "completed").alias("done"), F.count("*").alias("parts"))
    return done.select("task_id", F.round(manifest.progress(F.col("done"), F.col("parts")) * 10000).cast("bigint").alias("progress"))


def output_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = adapters.manifest(spark, sf_dir).withColumn("url", F.concat(F.lit("https://h/"), F.col("name")))
    ranked = outputs.ranked(held, "source", "doc_id")
    return ranked.select("source", "doc_id", outputs.sink_kind(F.col("total"), F.lit("out")).alias("sink"), outputs.numbered(F.col("at"), F.col("total"), F.col("url")).alias("file"))


def is_retriable(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.element_at(F.array(*map(F.lit, (200, 404, 502, 604))), (F.col("event_id") % 4 + 1).cast("int"))
    message = F.element_at(F.array(*map(F.lit, ("Network down", "API Error (502): x", "API Error (403): timeout", "broken"))), (F.col("event_id") % 3 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", text.retriable(F.when(F.col("event_type") == "error", status), message).alias("retriable"))


def output_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files found in result trees, a tree a document, numbered by source."""
    entry = F.array(F.concat(F.lit("https://h/"), F.col("name")), F.col("bytes").cast("string"), F.col("hash"))
    trees = adapters.manifest(spark, sf_dir).select("source", "doc_id", F.to_json(F.struct(F.array(entry).alias("files"))).alias("tree"))
    found = trees.select("source", "doc_id", F.explode(nested.files_of_json(F.col("tree"))).alias("url"))
    return outputs.ranked(found, "source", "doc_id").select("source", (F.col("at") - 1).cast("int").alias("at"), "url")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each task's log as one event-stream text, and the status of its first final event."""
    log = adapters.task_log(spark, sf_dir)
    event = F.concat(F.lit("event: task\ndata: "), F.to_json(F.struct("status", "seq")), F.lit("\n\n"))
    streams = log.groupBy("task_id").agg(F.array_sort(F.collect_list(F.struct("ts", "seq", event.alias("event")))).alias("s"))
    bodies = streams.select("task_id", event_bodies(F.array_join(F.transform("s", lambda s: s["event"]), "")).alias("bodies"))
    ends = F.filter(F.transform("bodies", lambda b: F.from_json(b, "status string, seq bigint")), lambda e: e["status"].isin(*tasks.FINAL))
    return bodies.select("task_id", F.size("bodies").cast("bigint").alias("events"), F.get(ends, F.lit(0))["status"].alias("outcome"), F.get(ends, F.lit(0))["seq"].alias("seq"))


def task_started(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.started(adapters.task_log(spark, sf_dir))


def task_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = adapters.task_log(spark, sf_dir)
    return tasks.deleted(tasks.latest(log), tasks.first_final(log).where("status = 'failed'"))


def job_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = adapters.manifest(spark, sf_dir).groupBy((F.col("doc_id") / 3).cast("bigint").alias("job")).agg(F.array_sort(F.collect_list("name")).alias("files"), F.min("source").alias("source"))
    first = F.element_at("files", 1)
    return jobs.select(
        "job", validation.join_error(F.col("files")).alias("join_error"), validation.generation_error(F.lit(None).cast("string"), F.col("files")).alias("generation_error"),
        validation.translation_error(F.lit("auto"), F.when(F.col("job") % 2 == 0, "de").otherwise("xx"), first).alias("translation_error"), validation.ocr_error(F.lit("en"), first).alias("ocr_error"),
    )


def parse_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of five kinds and pages as links, each with its parser's result, through the one entry."""
    first = F.substring_index("text", "\n", 1)
    js = lambda c: F.to_json(c)
    block = F.struct(first.alias("text"), F.lit("heading").alias("role"))
    result = (
        F.when(F.col("doc_id") % 5 == 0, js(F.struct(F.array(block).alias("textBlocks"))))
        .when(F.col("doc_id") % 5 == 1, js(F.struct(F.array(F.struct(F.array(F.struct(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(9).alias("cx"), F.lit(9).alias("cy")).alias("xfrm"), F.struct(F.array(F.struct(F.array(F.struct(first.alias("t"))).alias("children"))).alias("children")).alias("txBody"))).alias("spTree"))).alias("slides"))))
        .when(F.col("doc_id") % 5 == 2, js(F.struct(F.array(F.struct(F.lit("text").alias("type"), first.alias("text"), F.struct(F.lit(1.0).alias("outlineLvl")).alias("style"))).alias("content"))))
        .when(F.col("doc_id") % 5 == 3, js(F.struct(F.array(F.struct(F.array(F.struct(first.alias("text"))).alias("text"))).alias("slides"))))
    )
    ext = F.element_at(F.array(*map(F.lit, adapters.EXTENSIONS)), (F.col("doc_id") % 5 + 1).cast("int"))
    held = table(spark, sf_dir, "documents").select(F.concat(F.lit("doc-"), F.col("doc_id"), ext).alias("name"), F.lit(None).cast("string").alias("url"), result.alias("result"))
    page = F.concat(F.lit("<title>"), F.col("page_id"), F.lit("</title><body><p>x</p>"), F.when(F.col("page_id") % 2 == 0, "<img src='/a.png'>").otherwise(""), F.lit("</body>"))
    links = table(spark, sf_dir, "pages").select(F.concat(F.lit("page-"), F.col("page_id")).alias("name"), F.concat(F.lit("https://h/"), F.col("page_id")).alias("url"), js(F.struct(page.alias("html"))).alias("result"))
    return facade.markdown(held.unionByName(links)).select("name", "task_type", "markdown", "error")


def pages_by_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page asked for twice, and as many links that no page has; pages may share a URL, or have none."""
    pages = table(spark, sf_dir, "pages")
    asked = files.by_url(pages, pages.select("url").unionByName(pages.select("url")))
    gone = files.by_url(pages.where("url IS NOT NULL"), pages.select(F.concat(F.lit("gone:"), F.col("url")).alias("url")))
    return asked.unionByName(gone).select("url", "mode", "page_id", F.octet_length("html").cast("bigint").alias("bytes"))


def files_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored files by their ids, with the kind of task that parses them; an id that is not stored has none."""
    stored = adapters.manifest(spark, sf_dir).select(F.col("hash").alias("file_id"), "name").groupBy("file_id").agg(F.min("name").alias("name"))
    asked = adapters.manifest(spark, sf_dir).select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("gone"), F.col("doc_id"))).otherwise(F.col("hash")).alias("file_id"))
    return files.by_id(asked, stored).select("doc_id", "name", facade.kind_of(F.col("name"), F.lit(None).cast("string")).alias("task_type"))


def results_fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each task's result; kinds that offer several forms are asked for the deck."""
    kind = F.element_at(F.array(*map(F.lit, catalog.TASK_TYPES)), (F.col("task_id") % len(catalog.TASK_TYPES) + 1).cast("int"))
    known = tasks.latest(adapters.task_log(spark, sf_dir)).select("task_id", kind.alias("type"))
    forms = F.when(F.col("type").isin(*tasks.CHOOSING), F.array(*map(F.lit, tasks.RESULT_KINDS))).otherwise(F.array(F.lit(None).cast("string")))
    results = known.where("task_id % 4 <> 0").select("task_id", F.explode(forms).alias("kind")).withColumn("result", F.concat_ws("/", F.col("task_id").cast("string"), "kind"))
    return tasks.with_results(known, results, "pptx").select("task_id", "type", "kind", "result")


def results_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of events as a parser's JSON, every seventh cut off."""
    found = F.when(F.col("event_id") % 7 == 0, F.substring("props", 1, 3)).otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", files.decoded(found, "struct<k:bigint>")["k"].alias("k"))


def tasks_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payload of a task for each three documents; every fourth has ids of its own, every fifth no files."""
    job = (F.col("doc_id") / 3).cast("bigint")
    held = F.struct("doc_id", F.struct(F.col("hash").alias("id"), F.col("bytes").cast("bigint").alias("bytes")).alias("file"))
    jobs = adapters.manifest(spark, sf_dir).groupBy(job.alias("job")).agg(F.array_sort(F.collect_list(held)).alias("f"))
    listed = F.when(F.col("job") % 5 == 0, F.array().cast("array<struct<id:string,bytes:bigint>>")).otherwise(F.transform("f", lambda x: x["file"]))
    ids = F.when(F.col("job") % 4 == 0, F.array(F.lit("a"), F.concat(F.lit("b"), F.col("job")), F.lit("a")))
    made = jobs.select("job", F.lit("pptx.join").alias("type"), F.when(F.col("job") % 2 == 0, F.create_map(F.lit("autoResize"), F.lit("true"))).alias("params"), F.when(F.col("job") % 3 == 0, "s1").alias("space_id"), F.lit("").alias("name"), ids.alias("file_ids"), listed.alias("files"))
    return tasks.created(made).select("job", "task_type", "inline", "bytes", F.array_join("file_ids", ",").alias("file_ids"), "body")


def tasks_polled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.polled(adapters.task_log(spark, sf_dir), 3600, 200 * 3600)


def paired_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, digests and options of a job's files, by position."""
    held = F.array_sort(F.collect_list(F.struct("doc_id", "name", "hash")))
    jobs = adapters.manifest(spark, sf_dir).groupBy((F.col("doc_id") / 3).cast("bigint").alias("job")).agg(held.alias("f"))
    of = lambda k: F.transform("f", lambda x: x[k])
    pairs = tasks.paired(of("name"), of("hash"), of("doc_id"))
    return jobs.select("job", F.posexplode(pairs).alias("at", "p")).select("job", "at", F.col("p.file").alias("name"), F.col("p.prepared").alias("hash"), F.col("p.options").alias("doc_id"))


def upload_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of each document, uploaded in any order, as its completion lists them."""
    cut = adapters.manifest(spark, sf_dir).select("doc_id", F.explode(manifest.parts(F.col("bytes"), 1024)).alias("p")).select("doc_id", "p.part_number", F.concat(F.lit("t"), F.col("p.start")).alias("tag"))
    return manifest.completed_parts(cut.orderBy(F.xxhash64("doc_id", "part_number")), "doc_id")


def upload_transfer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each document would travel: every third content is stored already, every second grant allows parts."""
    platform = F.when(F.col("doc_id") % 4 == 0, "oss").otherwise("local")
    size = F.when(F.col("doc_id") % 2 == 0, F.lit(1024).cast("bigint"))
    sent = manifest.transfer(F.col("doc_id") % 3 == 0, platform, size, F.col("bytes"))
    return adapters.manifest(spark, sf_dir).select("doc_id", sent.alias("transfer"))


def zip_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three documents a task, packed and read back."""
    job = (F.col("doc_id") / 3).cast("bigint")
    named = table(spark, sf_dir, "documents").groupBy(job.alias("job")).agg(F.array_sort(F.collect_list(F.struct("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("content")))).alias("f"))
    held = F.transform("f", lambda x, at: F.struct(outputs.numbered(at + 1, F.size("f"), F.concat(F.lit("https://h/"), x["doc_id"].cast("string"), F.lit(".TXT"))).alias("name"), x["content"].alias("content")))
    listed = outputs.unpacked(outputs.packed(held))
    kind = outputs.sink_kind(F.size("f"), F.lit("out.ZIP"))
    entries = named.select("job", kind.alias("sink"), F.posexplode(listed).alias("at", "e"), F.col("f"))
    same = F.col("e.crc") == text.crc32(F.get("f", F.col("at"))["content"])
    return entries.select("job", "sink", F.col("e.name").alias("name"), F.col("e.bytes").alias("bytes"), same.alias("same_crc"))


def stream_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each task's log as an event stream in chunks of 50 bytes, with an event that is no JSON after every tenth."""
    log = adapters.task_log(spark, sf_dir)
    event = F.concat(F.lit("data: "), F.to_json(F.struct("status", "seq")), F.when(F.col("seq") % 10 == 0, "\n\ndata: {\n\n").otherwise("\n\n"))
    streams = log.groupBy("task_id").agg(F.array_sort(F.collect_list(F.struct("ts", "seq", event.alias("event")))).alias("s"))
    whole = F.array_join(F.transform("s", lambda s: s["event"]), "").cast("binary")
    cut = streams.select("task_id", whole.alias("w")).select("task_id", F.transform(F.sequence(F.lit(0), F.floor(F.octet_length("w") / 50).cast("int")), lambda i: F.substring(F.col("w"), i * 50 + 1, F.lit(50))).alias("chunks"))
    return cut.select("task_id", answers(F.lit("text/event-stream"), F.col("chunks")).alias("r")).select("task_id", "r.snapshots", "r.status", "r.error")


def task_follow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The task log as a stream of files, followed until each task's end."""
    landed = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parque[t]")
    log = adapters.snapshots_of(landed).select(F.col("task_id").cast("string").alias("task_id"), "type", "status", "seq", F.col("ts").cast("timestamp").alias("ts"))
    ended = drained(follow(log, "1000 days"), "task-follow")
    return ended.where("outcome <> 'timeout'").select(F.col("task_id").cast("bigint").alias("task_id"), "outcome", "seq")


def file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of the tables as files: their names, and whether their bytes begin and end as Parquet does."""
    found = files.files(spark, sf_dir, "{nation,region}.parquet")
    edge = lambda at: F.substring(F.col("content"), at, 4) == F.lit(b"PAR1")
    return found.select("name", (edge(1) & edge(-4)).alias("whole"))


def blob_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes in memory, with their manifest and CRC."""
    held = files.in_memory(spark, [("a.txt", b"abc"), ("empty.bin", b""), ("digits", b"123456789")])
    return manifest.manifest(held).join(held.select("name", text.crc32(F.col("content")).alias("crc")), "name")


#: Each with its own name.
ALL = (
    pdf_markdown, keynote_markdown, docx_markdown, pptx_markdown, pptx_participants, pptx_virtual_container, pptx_rows, html_markdown, html_title,
    route_parse, route_files, convert_validation, task_catalog, file_manifest, upload_needed, inline_decision, chunk_plan, tasks_page, tasks_total,
    output_files, event_stream, task_started, task_deleted, job_validation, task_latest, task_first_final, task_until_final, task_outcome, task_progress, output_plan, is_retriable,
    parse_documents, pages_by_url, files_by_id, results_fetched, results_decoded, tasks_created, tasks_polled, paired_files, upload_completion, upload_transfer, zip_outputs, stream_updates, task_follow, file_scan, blob_scan, *cases.ALL,
)


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in ALL}


def oracle_sql() -> dict[str, str]:
    from .oracles import SQL

    return dict(SQL) | cases.oracle_sql()
