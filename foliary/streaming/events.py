"""Following tasks: event-stream text to snapshots, and a stateful stream that emits each task's end."""

from __future__ import annotations

import atexit
import codecs
import json
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tasks import FINAL

SNAPSHOT = "task_id string, type string, status string, seq bigint, ts timestamp"
ENDED = "task_id string, outcome string, seq bigint, ts timestamp, snapshots bigint"
STATE = "began timestamp, snapshots bigint, done boolean"


def frames(lines: Iterator[str]) -> Iterator[object]:
    """Values of an event stream: data lines joined by line feeds, an event at each blank line and at the end; what is no JSON is skipped."""
    data: list[str] = []
    for line in [*lines, ""]:
        line = line.rstrip("\r\n")
        if line.startswith("data:"):
            data.append(line[5:].removeprefix(" "))
        elif not line and data:
            try:
                yield json.loads("\n".join(data))
            except ValueError:
                pass
            data = []


def until_final(snapshots: Iterator[dict]) -> tuple[list[dict], bool]:
    """Snapshots up to the first final one, and whether there was one."""
    out = []
    for s in snapshots:
        out.append(s)
        if s.get("status") in FINAL:
            return out, True
    return out, False


def decoded(chunks: Iterator[bytes]) -> Iterator[str]:
    """Text of UTF-8 chunks; a character that is cut between two of them comes out whole."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for chunk in chunks:
        yield decoder.decode(chunk)
    yield decoder.decode(b"", final=True)


def lines(pieces: Iterator[str]) -> Iterator[str]:
    """Lines of a text that comes in pieces."""
    rest = ""
    for piece in pieces:
        *whole, rest = (rest + piece).split("\n")
        yield from whole
    if rest:
        yield rest


#: How an answer is read, by words of its content type.
KINDS = (("application/json", "json"), ("event-stream", "events"))


def answer_kind(content_type: str | None) -> str | None:
    return next((kind for word, kind in KINDS if word in (content_type or "").lower()), None)


def read_answer(content_type: str | None, chunks: list[bytes]) -> tuple[int, str | None, str | None]:
    """Snapshots seen, the last status, and an error.

    A JSON body is one snapshot and ends the reading. An event stream is read up to the first final
    snapshot; one that ends before it is an error that calls for another try. Another kind is an error that does not.
    """
    kind = answer_kind(content_type)
    if kind is None:
        return 0, None, f"Unexpected Content-Type: {(content_type or '').lower()}"
    if kind == "json":
        try:
            seen, ended = [json.loads(b"".join(chunks))], True
        except ValueError as e:
            return 0, None, f"no JSON: {type(e).__name__}"
    else:
        seen, ended = until_final(s for s in frames(lines(decoded(iter(chunks)))) if isinstance(s, dict))
    last = seen[-1].get("status") if seen and isinstance(seen[-1], dict) else None
    return len(seen), last, None if ended else "SSE connection ended before task completion"


def answers(content_type: Column, chunks: Column) -> Column:
    """snapshots, status and error of whole answers, each with its content type and its chunks of bytes."""

    @F.pandas_udf("struct<snapshots:bigint,status:string,error:string>")
    def read(types: pd.Series, bodies: pd.Series) -> pd.DataFrame:
        found = [read_answer(t, list(b) if b is not None else []) for t, b in zip(types, bodies, strict=True)]
        return pd.DataFrame(found, columns=["snapshots", "status", "error"])

    return read(content_type, chunks)


def reconnects(error: Column) -> Column:
    """Whether a broken stream is opened again: transport errors only, not answers of the service or of another kind."""
    return ~(error.startswith("API Error") | error.startswith("Unexpected Content-Type:"))


class Following:
    """A running stream of snapshots; each batch goes to ``on_update``, what the callback raises to ``on_error``."""

    def __init__(self, stream: DataFrame, on_update: Callable[[DataFrame], None], checkpoint: str, on_error: Callable[[Exception], None] | None = None, every: str | None = None):
        def deliver(batch: DataFrame, number: int) -> None:
            try:
                on_update(batch)
            except Exception as e:
                if on_error is None:
                    raise
                on_error(e)

        writer = stream.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
        self.query = (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()

    def wait(self, seconds: float | None = None) -> bool:
        return bool(self.query.awaitTermination(seconds)) if seconds is not None else self.query.awaitTermination() is None

    def close(self) -> None:
        """Ends the stream; closing again does nothing."""
        if self.query.isActive:
            self.query.stop()


def event_bodies(streams: Column) -> Column:
    """JSON of each event of whole event-stream texts, as an array."""

    @F.pandas_udf("array<string>")
    def read(texts: pd.Series) -> pd.Series:
        return texts.map(lambda s: [json.dumps(x, ensure_ascii=False) for x in frames(iter((s or "").split("\n")))])

    return read(streams)


def snapshots(spark: SparkSession, path: str, per_trigger: int = 16) -> DataFrame:
    """A stream of snapshots from Parquet files; the schema is fixed, files are taken in bounded numbers."""
    return spark.readStream.schema(SNAPSHOT).option("maxFilesPerTrigger", per_trigger).parquet(path)


def checkpoint_folder(spark: SparkSession, name: str) -> str:
    """A new folder for a stream's state, in the one that driver and executors share; on one machine without one, a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="foliary-")
        atexit.register(shutil.rmtree, shared, True)
    return f"{shared.rstrip('/')}/foliary/{name}-{uuid.uuid4().hex}"


def drained(stream: DataFrame, name: str) -> DataFrame:
    """All that a stream gives from what has landed so far: written as Parquet beside its state, and read back."""
    spark = stream.sparkSession
    at = checkpoint_folder(spark, name)
    query = stream.writeStream.format("parquet").option("path", f"{at}/rows").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/rows")


def follow(stream: DataFrame, timeout: str = "5 minutes") -> DataFrame:
    """One row for each task when it is first completed or failed, or when nothing final has come in time.

    State is one small row a task and goes when the watermark is past the timeout; the
    checkpoint takes the part of reconnecting. Inside a batch snapshots are ordered by
    (ts, seq), which is what first means.
    """
    delay = pd.Timedelta(timeout)

    def step(key, batches, state):
        (task,) = key
        if state.hasTimedOut:
            began, count, done = state.get
            state.remove()
            if not done:
                yield pd.DataFrame({"task_id": [task], "outcome": ["timeout"], "seq": [None], "ts": [pd.Timestamp(began)], "snapshots": [count]}).astype({"seq": "Int64"})
            return
        rows = pd.concat(list(batches)).sort_values(["ts", "seq"], kind="stable")
        began, count, done = state.get if state.exists else (rows["ts"].iloc[0].to_pydatetime(), 0, False)
        if not done:
            ends = rows["status"].isin(FINAL).to_numpy()
            seen = int(ends.argmax()) + 1 if ends.any() else len(rows)
            count += seen
            if ends.any():
                last = rows.iloc[seen - 1]
                done = True
                yield pd.DataFrame({"task_id": [task], "outcome": [last["status"]], "seq": [int(last["seq"])], "ts": [last["ts"]], "snapshots": [count]})
        state.update((began, count, done))
        limit = max(int((pd.Timestamp(began) + delay).timestamp() * 1000), state.getCurrentWatermarkMs() + 1)
        state.setTimeoutTimestamp(limit)

    return stream.withWatermark("ts", "1 minute").groupBy("task_id").applyInPandasWithState(step, ENDED, STATE, "append", "EventTimeTimeout")
