"""The log of tasks: pages, totals, latest and final states. Rows are snapshots: task_id, type, status, and an order (ts, seq)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import trimmed
from .manifest import INLINE_LIMIT

FINAL = ("completed", "failed")


def page(tasks: DataFrame, task_type: str | None = None, space: str | None = None, start: int = 0, most: int = 50, order: tuple[str, ...] = ("task_id",)) -> DataFrame:
    """One page of the tasks of a kind and space, in a stated order."""
    return filtered(tasks, task_type, space).orderBy(*order).offset(start).limit(most)


def filtered(tasks: DataFrame, task_type: str | None = None, space: str | None = None) -> DataFrame:
    if task_type is not None:
        tasks = tasks.where(F.col("type") == task_type)
    return tasks if space is None else tasks.where(F.col("space_id") == space)


def total(tasks: DataFrame, task_type: str | None = None, space: str | None = None) -> DataFrame:
    return filtered(tasks, task_type, space).agg(F.count("*").alias("total"))


def latest(log: DataFrame) -> DataFrame:
    """The last snapshot of each task; sums up before the shuffle."""
    return log.groupBy("task_id").agg(F.max_by(F.struct("status", "ts", "seq"), F.struct("ts", "seq")).alias("s"), F.count("*").alias("snapshots")).select("task_id", "s.*", "snapshots")


def first_final(log: DataFrame) -> DataFrame:
    """The first final snapshot of each task that has one; what follows is not seen."""
    ended = log.where(F.col("status").isin(*FINAL))
    return ended.groupBy("task_id").agg(F.min_by(F.struct("status", "ts", "seq"), F.struct("ts", "seq")).alias("s")).select("task_id", "s.*")


def until_final(log: DataFrame) -> DataFrame:
    """All snapshots of each task up to its first final one."""
    ends = first_final(log).select("task_id", F.struct("ts", "seq").alias("end"))
    return log.join(ends, "task_id", "left").where(F.col("end").isNull() | (F.struct("ts", "seq") <= F.col("end"))).drop("end")


def waited(log: DataFrame, timeout_s: int = 300) -> DataFrame:
    """Outcome of waiting for each task: completed, or why not."""
    seen = log.groupBy("task_id").agg(
        F.min("ts").alias("began"),
        F.min_by("status", F.when(F.col("status").isin(*FINAL), F.struct("ts", "seq"))).alias("status"),
        F.min(F.when(F.col("status").isin(*FINAL), F.col("ts"))).alias("ended"),
    )
    late = F.col("ended").isNull() | (F.unix_timestamp(F.col("ended").cast("timestamp")) - F.unix_timestamp(F.col("began").cast("timestamp")) > timeout_s)
    return seen.select("task_id", F.when(late, "timeout").otherwise(F.col("status")).alias("outcome"))


def failure(error: Column) -> Column:
    return F.concat(F.lit("Task failed: "), F.coalesce(F.when(error != "", error), F.lit("Unknown error")))


def started(log: DataFrame) -> DataFrame:
    """The snapshots that starting would add: tasks that were never more than pending begin to run."""
    seen = latest(log)
    return seen.where(F.col("status") == "pending").select("task_id", F.lit("running").alias("status"), "ts", (F.col("seq") + 1).alias("seq"))


# Where a failed request's id and message are looked for, in this order.
ID_HEADERS = ("x-request-id", "x-requestid", "request-id")
ID_KEYS = ("requestId", "request_id", "RequestId", "xRequestId", "XRequestId", "traceId", "trace_id", "TraceId", "correlationId", "correlation_id")
MESSAGE_KEYS = ("message", "error", "msg")


def _strings(body: Column, keys: tuple[str, ...]) -> Column:
    """The first of these members of an object (variant) that is a string and not blank."""
    found = []
    for key in keys:
        text = trimmed(F.try_variant_get(body, f"$.{key}", "string"))
        found.append(F.when((F.schema_of_variant(F.try_variant_get(body, f"$.{key}", "variant")) == "STRING") & (text != ""), text))
    return F.coalesce(*found)


def request_id(headers: Column, body: Column) -> Column:
    """Id of a failed request from its headers (a map; names in any case, with - or _), else from its body (variant)."""
    plain = F.map_entries(headers)
    named = F.filter(plain, lambda e: F.replace(F.lower(trimmed(e["key"])), F.lit("_"), F.lit("-")).isin(*ID_HEADERS) & (trimmed(e["value"]) != ""))
    return F.coalesce(trimmed(F.get(named, F.lit(0))["value"]), _strings(body, ID_KEYS))


def deleted(tasks: DataFrame, gone: DataFrame) -> DataFrame:
    return tasks.join(gone.select("task_id").distinct(), "task_id", "left_anti")


# Kinds of result that may be asked for, the kinds of task that offer them, and the one taken by default.
RESULT_KINDS, CHOOSING, DEFAULT_KIND = ("html", "pptx", "image"), ("generation", "revamp"), "html"


def with_results(tasks: DataFrame, results: DataFrame, kind: str | None = None) -> DataFrame:
    """Tasks with the results that are kept apart from them (task_id, kind, result); a kind is chosen only where a task offers it."""
    if kind is not None and kind not in RESULT_KINDS:
        raise ValueError(f"unknown kind of result: {kind}")
    wanted = F.when(F.col("type").isin(*CHOOSING), F.lit(kind or DEFAULT_KIND))
    kept = results.withColumnsRenamed({"task_id": "_task", "kind": "_kind"})
    return tasks.withColumn("kind", wanted).join(kept, (F.col("task_id") == F.col("_task")) & F.col("kind").eqNullSafe(F.col("_kind")), "left").drop("_task", "_kind")


def error_message(body: Column, limit: int = 500, fallback: str = "Request failed") -> Column:
    """Message of a failed request: that of an object, or a text (cut at ``limit`` characters), or the fallback. ``body`` is a variant."""
    text = F.when(F.schema_of_variant(body) == "STRING", F.variant_get(body, "$", "string"))
    cut = F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)
    return F.coalesce(cut, _strings(body, MESSAGE_KEYS), F.lit(fallback))


def error_text(status: Column, message: Column, request: Column) -> Column:
    base = F.concat(F.lit("API Error ("), F.coalesce(status.cast("string"), F.lit("unknown")), F.lit("): "), message)
    return F.when(request.isNotNull(), F.concat(base, F.lit(" [X-RequestId: "), request, F.lit("]"))).otherwise(base)


def created(jobs: DataFrame) -> DataFrame:
    """The payload that creating each task sends, as a row of a log: task_type, inline, file_ids and body (JSON).

    ``jobs`` has job, type, params (a map or null), space_id, name, file_ids (given) and files (an array of structs of
    id and bytes, by position; id is that of the stored content). Ids of files follow the ids given, in order and with repeats.
    """
    files, given = F.coalesce("files", F.array().cast("array<struct<id:string,bytes:bigint>>")), F.coalesce("file_ids", F.array().cast("array<string>"))
    size = F.aggregate(files, F.lit(0).cast("bigint"), lambda total, f: total + f["bytes"])
    inline = (F.size(files) > 0) & (F.size(given) == 0) & (size < INLINE_LIMIT)
    ids = F.when(inline, F.array().cast("array<string>")).otherwise(F.concat(given, F.transform(files, lambda f: f["id"])))
    params = F.coalesce("params", F.create_map().cast("map<string,string>"))
    body = F.struct(ids.alias("fileIds"), F.col("type"), params.alias("params"), F.when(F.col("space_id") != "", F.col("space_id")).alias("spaceId"), F.when(F.col("name") != "", F.col("name")).alias("name"))
    return jobs.select("job", F.col("type").alias("task_type"), inline.alias("inline"), size.alias("bytes"), ids.alias("file_ids"), F.to_json(body).alias("body"))


def paired(files: Column, prepared: Column, options: Column) -> Column:
    """Files, what was prepared of them and their options by position; lists of different lengths are an error."""
    even = (F.size(files) == F.size(prepared)) & (F.size(files) == F.size(options))
    checked = F.when(F.assert_true(even, "lists of different lengths").isNull(), files)
    return F.transform(checked, lambda f, at: F.struct(f.alias("file"), F.get(prepared, at).alias("prepared"), F.get(options, at).alias("options")))


def polled(log: DataFrame, interval_s: int = 2, timeout_s: int = 300) -> DataFrame:
    """What asking for each task every ``interval_s`` seconds finds: polls and outcome.

    Each poll sees the last snapshot by then; the first that sees a final one ends it, as does the time.
    """
    began = log.groupBy("task_id").agg(F.min("ts").alias("began"))
    seconds = lambda c: F.unix_micros(F.col(c).cast("timestamp")) / 1_000_000
    placed = log.join(began, "task_id").withColumn("at", F.ceil((seconds("ts") - seconds("began")) / interval_s).cast("bigint"))
    most = timeout_s // interval_s
    # the last snapshot up to each poll at which something is new; between them nothing changes
    seen = placed.where(F.col("at") <= most).groupBy("task_id", "at").agg(F.max_by("status", F.struct("ts", "seq")).alias("status"))
    ended = seen.where(F.col("status").isin(*FINAL)).groupBy("task_id").agg(F.min(F.struct("at", "status")).alias("end"))
    return began.join(ended, "task_id", "left").select("task_id", (F.coalesce("end.at", F.lit(most)) + 1).alias("polls"), F.coalesce("end.status", F.lit("timeout")).alias("outcome"))


# Seconds before each further try of a call, and before and at most how often a broken stream is opened again.
RETRY_DELAYS, REOPEN_DELAY, REOPENINGS = (5, 10, 20), 5, 100


def retry_delay(tried: Column) -> Column:
    """Seconds to wait after so many failed tries of a call (from 1); null if there is no further one."""
    return F.when(tried >= 1, F.get(F.array(*map(F.lit, RETRY_DELAYS)), (tried - 1).cast("int")))


def reopen_delay(opened: Column) -> Column:
    """Seconds to wait before a stream is opened again for the n-th time; null beyond the last."""
    return F.when(opened.between(1, REOPENINGS), F.lit(REOPEN_DELAY))
