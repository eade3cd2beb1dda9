"""Fetching documents (A2) as a source that Spark reads: a row of status and content for each request.

Requests are a table of (document, url, other).  It is written to a shared folder, and each of its
files is a partition of the source, so requests are never listed on the driver.  Rows are
independent: a failure is a row that says why, never an exception, and a task that is lost is
simply read again.  What a source gives is fetched when it is read; save it before using it twice.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.dataset
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quarrystone.sources.shared import opened, scratch

FETCHED = "document string, origin string, status string, attempts int, bytes bigint, content binary, error string"
#: Requests of one partition.
PART_ROWS = 200


@dataclass
class Policy:
    """How requests are made: ``attempts`` with waits of ``pause`` seconds times the number of the last one."""

    attempts: int = 5
    pause: float = 2.0
    timeout: float = 60.0
    magic: bytes = b"%PDF"
    least: int = 0
    agent: str = "quarrystone"

    @classmethod
    def of(cls, options: dict[str, str]) -> Policy:
        plain = cls()
        return cls(
            int(options.get("attempts", plain.attempts)), float(options.get("pause", plain.pause)), float(options.get("timeout", plain.timeout)),
            options.get("magic", plain.magic.decode("latin-1")).encode("latin-1"), int(options.get("least", plain.least)), options.get("agent", plain.agent),
        )


class Absent(Exception):
    """There is no such document; asking again is of no use."""


def body_of(url: str, policy: Policy) -> bytes:
    """What a place holds: over HTTP, or a file of any file system that is known."""
    if urllib.parse.urlsplit(url).scheme not in ("http", "https"):
        try:
            files, path = opened(url)
            with files.open_input_stream(path, compression=None) as source:
                return source.read()
        except FileNotFoundError as why:
            raise Absent(str(why)) from why
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": policy.agent}), timeout=policy.timeout) as answer:
            return answer.read()
    except urllib.error.HTTPError as why:
        if why.code in (404, 410):
            raise Absent(f"HTTP {why.code}") from why
        raise


def asked(url: str | None, policy: Policy, wait=time.sleep) -> tuple[str, int, bytes | None, str | None]:
    """Status (ok, absent or failed), attempts, content and error of one place."""
    error = "no address"
    for attempt in range(1, policy.attempts + 1) if url else ():
        if attempt > 1:
            wait(policy.pause * (attempt - 1))
        try:
            body = body_of(url, policy)
        except Absent as why:
            return "absent", attempt, None, str(why)
        except Exception as why:  # noqa: BLE001  whatever a network does
            error = f"{type(why).__name__}: {why}"
            continue
        if body.startswith(policy.magic) and len(body) >= policy.least:
            return "ok", attempt, body, None
        error = "another kind of content" if not body.startswith(policy.magic) else f"{len(body)} bytes"
    return ("failed", policy.attempts, None, error) if url else ("absent", 0, None, error)


def fetched(document: str, url: str | None, other: str | None, policy: Policy) -> tuple:
    """A row of ``FETCHED``: from the first place, or else from the other."""
    status, attempts, body, error = asked(url, policy)
    origin = "live" if body is not None else None
    if body is None and other:
        again, more, body, why = asked(other, policy)
        attempts += more
        if body is not None:
            status, origin, error = again, "archive", None
        else:
            status, error = "failed" if "failed" in (status, again) else status, f"{error}; archive: {why}"
    return document, origin, status, attempts, None if body is None else len(body), body, error


@dataclass
class _Part(InputPartition):
    path: str


class FetchReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.requests, self.policy = options["requests"], Policy.of(options)

    def partitions(self) -> list[InputPartition]:
        files, path = opened(self.requests)
        from pyarrow.fs import FileSelector

        found = [f.path for f in files.get_file_info(FileSelector(path)) if f.base_name.endswith(".parquet")]
        return [_Part(p) for p in sorted(found)] or [_Part("")]

    def read(self, partition: _Part) -> Iterator[tuple]:
        if not partition.path:
            return
        files, _ = opened(self.requests)
        for batch in pyarrow.dataset.dataset(partition.path, filesystem=files, format="parquet").to_batches(batch_size=PART_ROWS):
            for row in batch.to_pylist():
                yield fetched(row["document"], row["url"], row["other"], self.policy)


class FetchSource(DataSource):
    """``format("fetch")`` with the options ``requests`` (a folder of Parquet files) and those of ``Policy``."""

    @classmethod
    def name(cls) -> str:
        return "fetch"

    def schema(self) -> str:
        return FETCHED

    def reader(self, schema) -> DataSourceReader:
        return FetchReader(dict(self.options))


def fetch(requests: DataFrame, **options) -> DataFrame:
    """``FETCHED`` of each request (document, url, other)."""
    spark: SparkSession = requests.sparkSession
    path = scratch(spark)
    parts = max(1, -(-requests.count() // PART_ROWS))
    requests.select("document", "url", "other").repartition(parts).write.parquet(path)
    spark.dataSource.register(FetchSource)
    return spark.read.format("fetch").option("requests", path).options(**options).load()
