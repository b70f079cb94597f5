"""Batch requests to model providers as a data source: writing submits, reading waits for the batch and gives its answers.

`Batches` is one provider's source. Tasks upload request lines; the commit submits the files of the tasks that succeeded as
one batch and keeps its record (token, batch id, files) in the shared folder, so a later session can collect it. A task
that is lost leaves a file that no batch names. Reading polls until the batch is in a final state, then takes an output
file a partition. `ask` chooses: a provider without batches is asked at once, by a bounded pool.
"""

from __future__ import annotations

import io
import itertools
import json
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from framelake.functions import payloads
from framelake.operators.inference import Backend, Direct, request_lines
from framelake.sources.sinks import kept, shared

#: Fixed names of a batch's final states.
FINAL = ("completed", "failed", "expired", "cancelled")
#: Bytes of a file, and lines of answers, that a task holds at a time.
PART, ROWS = 1 << 16, 1024


class Provider(Protocol):
    """All methods but submit and poll run in tasks. `batch` says whether the provider takes batches."""

    batch: bool

    def upload(self, lines: Iterable[str]) -> str: ...
    def submit(self, files: list[str], window: str) -> str: ...
    def poll(self, batch: str) -> tuple[str, list[str]]: ...
    def download(self, file: str) -> Iterable[str]: ...


def _fs(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def _put(path: str, text: str | Iterable[str]) -> None:
    """A file, of a text or of lines as they come, written beside and moved, so it is there whole or not at all."""
    fs, at = _fs(path)
    fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
    beside = f"{at}.{uuid.uuid4().hex}"
    with fs.open_output_stream(beside, buffer_size=PART) as f:
        for i, x in enumerate([text] if isinstance(text, str) else text):
            f.write(f"\n{x}".encode() if i else x.encode())
    fs.move(beside, at)


def _read(path: str) -> str | None:
    fs, at = _fs(path)
    if fs.get_file_info(at).type == pafs.FileType.NotFound:
        return None
    with fs.open_input_stream(at) as f:
        return f.read().decode()


def _there(path: str) -> bool:
    fs, at = _fs(path)
    return fs.get_file_info(at).type != pafs.FileType.NotFound


def _lines(path: str) -> Iterator[str]:
    """The lines of a file, or of none, one at a time."""
    if not _there(path):
        return
    fs, at = _fs(path)
    with fs.open_input_stream(at) as f:
        for line in io.TextIOWrapper(io.BufferedReader(f, PART), "utf-8", newline="\n"):
            yield line.removesuffix("\n")


@dataclass(frozen=True)
class Spool:
    """Stand-in provider: a folder. The first `waits` polls of a batch find it in progress, then it ends as `status`; a file's
    answers are made by a backend when it is first downloaded, and kept."""

    folder: str
    make: Callable[[], Backend]
    waits: int = 1
    status: str = "completed"
    batch: bool = True
    chat: bool = True

    def upload(self, lines: Iterable[str]) -> str:
        name = f"requests-{uuid.uuid4().hex}.jsonl"
        _put(f"{self.folder}/{name}", lines)
        return name

    def submit(self, files: list[str], window: str) -> str:
        batch = f"batch-{uuid.uuid4().hex}"
        _put(f"{self.folder}/{batch}.json", json.dumps({"files": files, "window": window, "polls": 0}))
        return batch

    def poll(self, batch: str) -> tuple[str, list[str]]:
        at = f"{self.folder}/{batch}.json"
        state = json.loads(_read(at))
        _put(at, json.dumps(state | {"polls": state["polls"] + 1}))
        return ("in_progress", []) if state["polls"] < self.waits else (self.status, state["files"])

    def download(self, file: str) -> Iterator[str]:
        done = f"{self.folder}/answers-{file}"
        if not _there(done):
            backend = self.make()
            reply = getattr(backend, "reply", lambda _, prompt: backend.answer(prompt))
            _put(done, (self._answer(reply, json.loads(x)) for x in _lines(f"{self.folder}/{file}") if x))
        return _lines(done)

    def _answer(self, reply, request: dict) -> str:
        prompt = request["messages"][-1]["content"]
        try:
            said, status, error = reply(request["custom_id"], prompt), 200, None
        except Exception as e:  # noqa: BLE001  a request's failure is a line
            said, status, error = None, 500, str(e)
        usage = {"prompt_tokens": len(prompt.split()), "completion_tokens": len((said or "").split())}
        body = {"choices": [{"message": {"content": said}}], "usage": usage} if self.chat else {"output": [{"content": [{"type": "output_text", "text": said}]}], "usage": {"input_tokens": usage["prompt_tokens"], "output_tokens": usage["completion_tokens"]}}
        return json.dumps({"custom_id": request["custom_id"], "response": {"status_code": status, "body": body if error is None else {}}, "error": error and {"message": error}})


@dataclass
class _Uploaded(WriterCommitMessage):
    file: str | None


@dataclass
class _File(InputPartition):
    file: str


def source(provider: Provider) -> type[DataSource]:
    """The data source `batch` of one provider. Options: record (where the submission is kept), window, interval, patience."""

    class Writer(DataSourceWriter):
        def __init__(self, options):
            self.options = dict(options)

        def write(self, rows) -> _Uploaded:
            first = next(rows, None)
            return _Uploaded(None if first is None else provider.upload(r.value for r in itertools.chain([first], rows)))

        def commit(self, messages) -> None:
            files = [m.file for m in messages if m is not None and m.file]
            batch = provider.submit(files, self.options.get("window", "24h")) if files else None
            _put(self.options["record"], json.dumps({"batch": batch, "files": files, "submitted": time.time()}))

        def abort(self, messages) -> None:
            pass

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.options = dict(options)

        def partitions(self) -> list[InputPartition]:
            text = _read(self.options["record"])
            if text is None:
                raise ValueError(f"no batch was submitted as {self.options['record']}")
            batch = json.loads(text)["batch"]
            if batch is None:
                return [_File("")]
            wait, end = float(self.options.get("interval", "20")), time.monotonic() + float(self.options.get("patience", "86400"))
            while True:
                status, files = provider.poll(batch)
                if status in FINAL:
                    break
                if time.monotonic() > end:
                    raise TimeoutError(f"batch {batch} is still {status}")
                time.sleep(wait)
            if status != "completed":
                raise RuntimeError(f"batch {batch} ended as {status}")
            return [_File(f) for f in files] or [_File("")]

        def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
            lines = iter(provider.download(partition.file) if partition.file else ())
            while part := list(itertools.islice(lines, ROWS)):
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string())], ["value"])

    class Batch(DataSource):
        @classmethod
        def name(cls) -> str:
            return "batch"

        def schema(self) -> str:
            return "value string"

        def writer(self, schema, overwrite) -> DataSourceWriter:
            return Writer(self.options)

        def reader(self, schema) -> DataSourceReader:
            return Reader(self.options)

    return Batch


@dataclass(frozen=True)
class Batches:
    """Asks by batch. `submit` and `collect` may be of different sessions; called, it does both, and forgets the record."""

    provider: Provider
    model: str = "default"
    interval: float = 20.0
    window: str = "24h"
    options: dict = field(default_factory=dict)

    def _record(self, spark: SparkSession, token: str) -> str:
        return f"{shared(spark)}/batch-{token}.json"

    def submit(self, requests: DataFrame, token: str | None = None) -> str:
        """Uploads and submits (custom_id, prompt); the token finds the batch again."""
        spark = requests.sparkSession
        token = token or uuid.uuid4().hex
        spark.dataSource.register(source(self.provider))
        request_lines(requests, self.model).write.format("batch").mode("append").options(record=self._record(spark, token), window=self.window, **self.options).save()
        return token

    def state(self, spark: SparkSession, token: str) -> dict | None:
        """The submission's record; null once it is cleared."""
        text = _read(self._record(spark, token))
        return None if text is None else json.loads(text)

    def clear(self, spark: SparkSession, token: str) -> None:
        fs, at = _fs(self._record(spark, token))
        if fs.get_file_info(at).type != pafs.FileType.NotFound:
            fs.delete_file(at)

    def collect(self, spark: SparkSession, token: str) -> DataFrame:
        """The answers, once the batch is done; raises if it ends otherwise."""
        spark.dataSource.register(source(self.provider))
        lines = spark.read.format("batch").options(record=self._record(spark, token), interval=str(self.interval), **self.options).load()
        return payloads.answers(lines)

    def __call__(self, requests: DataFrame) -> DataFrame:
        token = self.submit(requests)
        got = kept(self.collect(requests.sparkSession, token))
        self.clear(requests.sparkSession, token)
        return got


def ask(provider: Provider | None, make: Callable[[], Backend], **kw) -> Batches | Direct:
    """By batch if the provider takes batches; else at once, with at most eight workers a task."""
    return Batches(provider, **kw) if provider is not None and provider.batch else Direct(make, 8)
