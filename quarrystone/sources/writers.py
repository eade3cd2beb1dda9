"""Sinks: partitioned tables, single sorted files, JSON objects, browser exports."""

from __future__ import annotations

import urllib.parse
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrystone.functions.scalar import csv_field
from quarrystone.sources.shared import PART_DOCUMENTS, opened, scratch


def write_partitioned(df: DataFrame, path: str, *by: str, kind: str = "parquet") -> None:
    """A folder for each value, so that reads of a cycle skip the others."""
    df.write.mode("overwrite").partitionBy(*by).format(kind).save(path)


def rewrite_partitions(df: DataFrame, path: str, *by: str, kind: str = "csv", **options) -> None:
    """The folders of the values that ``df`` holds are replaced, all others stay as they are.

    Rows of a folder are brought together first, so it gets few files.  What a run writes stands aside until all its
    tasks are done, and is moved then; a run that is repeated replaces the same folders by the same rows.
    """
    dealt = df.repartition(*(F.col(c) for c in by))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options).partitionBy(*by).format(kind).save(path)


def drop_partitions(gone: DataFrame, path: str) -> int:
    """Folders of a partitioned table, by the columns of ``gone`` in order, that no longer have rows; gives how
    many there were.  Nothing happens where a folder is not there."""
    columns = gone.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = opened(path)
        for b in batches:
            done = []
            for row in b.to_pylist():
                folder = "/".join([top, *(f"{c}={_escaped(row[c])}" for c in columns)])
                if files.get_file_info(folder).type == pa.fs.FileType.Directory:
                    files.delete_dir(folder)
                    done.append(folder)
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], ["folder"])

    return gone.select(*(F.col(c).cast("string").alias(c) for c in columns)).distinct().mapInArrow(run, "folder string").count()


def _escaped(value: str | None) -> str:
    """A value in the name of a partition's folder."""
    if value is None or value == "":
        return "__HIVE_DEFAULT_PARTITION__"
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or c in "\"#%'*/:=?\\\x7f{[]^" else c for c in value)


def write_files(df: DataFrame, path: str, key: str, order: str, value: str, suffix: str = "") -> DataFrame:
    """A file for each ``key``, its ``value`` parts (text or bytes) one after the other in ``order``; gives (name, bytes, parts).

    Parts are sorted within partitions and streamed, so no text is held whole.  A file has a name of its own until it
    is complete; what a repeated task writes is moved over the same file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = opened(path)
        files.create_dir(f"{top}/_temporary", recursive=True)
        own, out, size, parts, temporary = None, None, 0, 0, ""

        def closed() -> pa.RecordBatch:
            out.close()
            files.move(temporary, f"{top}/{own}")
            return pa.RecordBatch.from_arrays([pa.array([own]), pa.array([size], pa.int64()), pa.array([parts], pa.int64())], ["name", "bytes", "parts"])

        for b in batches:
            for k, v in zip(b.column(0), b.column(1)):
                name = urllib.parse.quote(k.as_py() or "", safe=" #&+,;@") + suffix
                if name != own:
                    if out is not None:
                        yield closed()
                    own, size, parts, temporary = name, 0, 0, f"{top}/_temporary/{uuid.uuid4().hex}"
                    out = files.open_output_stream(temporary, compression=None)
                data = v.as_buffer() or b""
                out.write(data)
                size, parts = size + len(data), parts + 1
        if out is not None:
            yield closed()

    kept = df.select(F.col(key).cast("string").alias("k"), F.col(order).alias("o"), F.col(value).cast("binary").alias("v"))
    # files are work whatever they hold: adaptive execution would put many short ones in one task, as it counts bytes
    n = kept.count()
    tasks = max(1, min(n, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), -(-n // PART_DOCUMENTS))
    streams = kept.repartition(tasks, "k").sortWithinPartitions("k", "o").select("k", "v")
    listed = scratch(df.sparkSession)
    streams.mapInArrow(run, "name string, bytes bigint, parts bigint").write.parquet(listed)
    files, top = opened(path)
    if files.get_file_info(f"{top}/_temporary").type == pa.fs.FileType.Directory:
        files.delete_dir(f"{top}/_temporary")
    return df.sparkSession.read.schema("name string, bytes bigint, parts bigint").parquet(listed)


def write_sorted(df: DataFrame, path: str, columns: list[str], order: list[str]) -> None:
    """One sorted file with the named columns; for reports and aggregates, not for rows."""
    df.select(*columns).orderBy(*order).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_json_object(df: DataFrame, path: str) -> None:
    """The ``value`` column (one object) as text."""
    df.select("value").coalesce(1).write.mode("overwrite").text(path)


#: Bytes that joining files holds at a time.
CHUNK = 1 << 20


def write_json_sections(rows: DataFrame, path: str, sections: dict[str, str]) -> None:
    """One JSON object as a file, from (section, key, place, value) rows, in the order of ``sections``.

    A section is an ``array`` of its rows' values, or an ``object`` of them by key; one without rows is empty.  Values
    are JSON.  Each row becomes a line with what has to stand before and after it, which the first and last place of
    each section tell; lines are dealt by ranges and written in order, and the files joined in one stream, so no
    task or row gathers the object.
    """
    spark = rows.sparkSession
    names = spark.createDataFrame([(k, s, kind == "object") for k, (s, kind) in enumerate(sections.items())], "number int, section string, keyed boolean")
    numbered = rows.select("section", "key", F.coalesce(F.col("place"), F.lit(0)).cast("long").alias("place"), "value")
    order = F.struct(F.coalesce("key", F.lit("")).alias("k"), "place")
    ends = numbered.groupBy("section").agg(F.min(order).alias("low"), F.max(order).alias("high"))
    ends = names.join(ends, "section", "left")
    # one row for each section: of fixed size
    placed = numbered.join(F.broadcast(ends), "section")
    label = F.concat(F.when(F.col("number") == 0, "{").otherwise(","), F.lit('"'), F.col("section"), F.lit('":'))
    opening, closing = F.when(F.col("keyed"), "{").otherwise("["), F.when(F.col("keyed"), "}").otherwise("]")
    before = F.when(order == F.col("low"), F.concat(label, opening)).otherwise(",")
    name = F.when(F.col("keyed"), F.concat(F.regexp_extract(F.to_json(F.struct(F.col("key").alias("k"))), r"^\{\"k\":(.*)\}$", 1), F.lit(":"))).otherwise("")
    line = F.concat(before, name, F.coalesce("value", F.lit("null")), F.when(order == F.col("high"), closing).otherwise(""))
    empty = ends.where("low is null").select("number", F.lit("").alias("k"), F.lit(0).cast("long").alias("place"), F.concat(label, opening, closing).alias("line"))
    lines = placed.select("number", F.coalesce("key", F.lit("")).alias("k"), "place", line.alias("line")).unionByName(empty)
    parts = scratch(spark)
    lines.repartitionByRange("number", "k", "place").sortWithinPartitions("number", "k", "place").select("line").write.text(parts)
    _join_files(parts, path, b"{}" if not sections else b"", b"}" if sections else b"")


def _join_files(folder: str, path: str, head: bytes, tail: bytes) -> None:
    """The files of a folder in the order of their names as one, chunk by chunk."""
    files, top = opened(folder)
    names = sorted(f.path for f in files.get_file_info(pa.fs.FileSelector(top)) if f.base_name.startswith("part-"))
    there, to = opened(path)
    there.create_dir(to.rsplit("/", 1)[0], recursive=True)
    with there.open_output_stream(f"{to}._temporary", compression=None) as out:
        out.write(head)
        for name in names:
            with files.open_input_stream(name, compression=None) as source:
                while data := source.read(CHUNK):
                    out.write(data)
        out.write(tail)
    there.move(f"{to}._temporary", to)


def save_table(df: DataFrame, name: str) -> DataFrame:
    """A managed table that replaces any of that name."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def export_lines(df: DataFrame, numbered: bool = False) -> DataFrame:
    """Lines of an export for spreadsheets: quoted where needed, a byte-order mark first.

    ``part`` (0: the head, 1: a row) is what a sink has to sort by; it goes with ``numbered`` only.
    """
    head = F.lit("\ufeff" + ",".join(df.columns))
    body = df.select(F.lit(1).alias("part"), F.concat_ws(",", *(csv_field(F.col(c)) for c in df.columns)).alias("line"))
    lines = df.sparkSession.range(1).select(F.lit(0).alias("part"), head.alias("line")).union(body)
    return lines if numbered else lines.orderBy("part").select("line")
