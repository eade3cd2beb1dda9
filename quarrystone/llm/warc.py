"""WARC archives: a deterministic sharded writer, and a reader that checks what it reads.

1. Keys (id, address, SHA-1 and bytes of the payload) are written once.  Of equal payloads of
   at least ``min_bytes`` bytes, the record with the largest id (then address) is the
   response, all others revisit it.  Only keys are grouped and joined for that.
2. Shards are ranges of (id, digest).  Their bounds are weighted quantiles of the keys whose
   hash is a multiple of some number, so the same records make the same shards, whatever
   the partitions, the session or the order in which they come.
3. Payloads are shuffled once, to their shard.  What is to be known of a record of an equal
   payload comes as a row of its own that sorts before it, so no payload is ever joined.
4. A task streams its sorted shard into files of one gzip member a record, and opens the
   next file when ``roll_bytes`` compressed bytes are reached.  Headers, digests and record
   ids are made again from the rows; dates are a parameter.
5. Commit: each attempt of a task writes to names of its own, and Spark's writer lists the
   files of just one attempt of each task.  A second job moves the listed files to their
   final names, and may be repeated, as what is moved already is left; the manifest that it
   writes is the archive.  Everything that is not listed is deleted with the temporary folder.

The reader takes files from the manifest, streams them member by member, and raises where
sizes, counts, block digests or payload digests differ from what was written.

Cases: null html is an empty payload; a null id sorts first and is smaller than any other;
a null address has no address line, other addresses are written percent-encoded where they
have signs that no header line may hold; rows that repeat id, address and payload are one
response and revisits of it, streamed one after the other by one task in constant memory; a
very long payload is held once by its task; further columns are ignored, whatever their
names; an empty table gives a manifest without files and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm.common import discard, materialise, shared_dir, small_batches, table, tidied

#: Bytes of payload of a shard, and shards at most (larger ones beyond that).
SHARD_BYTES, MAX_SHARDS = 32 << 20, 20_000
#: Keys of which the bounds of a shard are taken, on average.
KEYS_A_SHARD = 10
#: What a record weighs besides its payload.
RECORD_BYTES = 600
#: Compressed bytes after which a file is closed.
ROLL_BYTES = 1 << 30
CHUNK = 1 << 20
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LISTED = "name string, temporary string, bytes bigint, records bigint"


def _files(root: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder that all machines reach, and the folder's path on it."""
    if root.startswith("file:/") and not root.startswith("file://"):
        root = "file://" + root[5:]
    return pyarrow.fs.FileSystem.from_uri(root)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id: int | None, url: str | None, digest: str, copy: int) -> str:
    name = json.dumps([page_id, url, digest, copy]).encode()
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(name).digest()[:16], version=5)}>"


def _line(value: str) -> str:
    """A header value on one line: white space, control signs and per cent signs before two digits are encoded."""
    if all(33 <= ord(c) < 127 or ord(c) > 160 for c in value):
        return value
    return "".join(c if 33 <= ord(c) < 127 or ord(c) > 160 else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(kind: str, headers: list[tuple[str, str | None]], block: bytes, level: int) -> bytes:
    """One record as a gzip member; the header has no time, so equal records are equal bytes."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers if v is not None), f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return b"".join([pack.compress("\r\n".join(lines).encode() + b"\r\n\r\n"), pack.compress(block), pack.compress(b"\r\n\r\n"), pack.flush()])


class _Roll:
    """The files of one shard after another, under names of this attempt."""

    def __init__(self, root: str, date: str, roll_bytes: int, level: int):
        self.fs, self.path = _files(root)
        self.date, self.roll_bytes, self.level = date, roll_bytes, level
        self.shard, self.number, self.out, self.listed = -1, 0, None, []

    def open(self, shard: int) -> None:
        self.number = self.number + 1 if shard == self.shard else 0
        self.shard, self.size, self.records = shard, 0, 0
        self.name = f"shard-{shard:05d}-{self.number:05d}.warc.gz"
        self.temporary = f"_temporary/{uuid.uuid4().hex}.warc.gz"
        self.fs.create_dir(f"{self.path}/_temporary", recursive=True)
        self.out = self.fs.open_output_stream(f"{self.path}/{self.temporary}", compression=None)
        info = f"software: quarrystone\r\nformat: WARC File Format 1.1\r\nisPartOf: {self.name}\r\n".encode()
        self._put(record("warcinfo", [("WARC-Record-ID", record_id(None, None, self.name, 0)), ("WARC-Date", self.date), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], info, self.level))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.listed.append((self.name, self.temporary, self.size, self.records))
            self.out = None

    def add(self, shard: int, kind: str, headers: list[tuple[str, str | None]], block: bytes) -> None:
        if self.out is None or shard != self.shard:
            self.close()
            self.open(shard)
        self._put(record(kind, headers, block, self.level))
        self.records += 1
        if self.size >= self.roll_bytes:
            self.close()

    def take(self) -> list[tuple]:
        done, self.listed = self.listed, []
        return done


def _listing(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.int64()))], ["name", "temporary", "bytes", "records"])


def _write(root: str, date: str, roll_bytes: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = _Roll(root, date, roll_bytes, level)
        own, mark, copy = None, None, 0
        for b in batches:
            for shard, page_id, digest, url, is_mark, lead_id, lead_url, html in zip(*(c for c in b.columns)):
                key = (page_id.as_py(), url.as_py(), digest.as_py())
                if key != own:
                    own, mark, copy = key, None, 0
                if is_mark.as_py():
                    mark = (lead_id.as_py(), lead_url.as_py())
                    continue
                payload = html.as_buffer() or b""
                name = base32(bytes.fromhex(key[2]))
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
                headers = [
                    ("WARC-Record-ID", record_id(*key, copy)),
                    ("WARC-Date", date),
                    ("WARC-Target-URI", None if key[1] is None else _line(key[1])),
                    ("X-Page-ID", None if key[0] is None else str(key[0])),
                    ("WARC-Payload-Digest", f"sha1:{name}"),
                    ("Content-Type", "application/http; msgtype=response"),
                ]
                if mark is None or (mark == key[:2] and not copy):
                    roll.add(shard.as_py(), "response", headers, http + payload)
                else:
                    headers += [
                        ("WARC-Profile", REVISIT),
                        ("WARC-Refers-To", record_id(*mark, key[2], 0)),
                        ("WARC-Refers-To-Target-URI", None if mark[1] is None else _line(mark[1])),
                        ("WARC-Refers-To-Date", date),
                        ("X-Refers-To-Page-ID", None if mark[0] is None else str(mark[0])),
                    ]
                    roll.add(shard.as_py(), "revisit", headers, http)
                copy += 1
            if done := roll.take():
                yield _listing(done)
        roll.close()
        if done := roll.take():
            yield _listing(done)

    return run


def _publish(root: str):
    """Moves listed files to their final names; what is there already is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _files(root)
        for b in batches:
            for name, temporary, size in zip(*(b.column(k).to_pylist() for k in (0, 1, 2))):
                there, done = fs.get_file_info([f"{path}/{temporary}", f"{path}/{name}"])
                if there.type == pyarrow.fs.FileType.File:
                    fs.move(f"{path}/{temporary}", f"{path}/{name}")
                elif done.type != pyarrow.fs.FileType.File or done.size != size:
                    raise OSError(f"{name}: neither the written nor the final file is there")
            yield b

    return run


def _bounds(keys: DataFrame, shard_bytes: int) -> list[tuple[int | None, str]]:
    """Upper bounds (exclusive) of all shards but the last."""
    whole = keys.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bytes") + RECORD_BYTES).alias("w")).first()
    shards = min(MAX_SHARDS, math.ceil((whole["w"] or 0) / shard_bytes))
    if shards < 2:
        return []
    every = max(1, whole["n"] // (shards * KEYS_A_SHARD))
    picked = keys.where(F.pmod(F.xxhash64("page_id", "digest"), F.lit(every)) == 0).groupBy("page_id", "digest").agg(F.sum(F.col("bytes") + RECORD_BYTES).alias("w"))
    rows = sorted(((r["page_id"] is not None, r["page_id"] or 0, r["digest"]), r["w"]) for r in picked.collect())
    total, at, out = sum(w for _, w in rows), 0, []
    for key, w in rows:
        # a key that weighs as much as several shards begins one
        if at >= total * (len(out) + 1) / shards:
            out.append((key[1] if key[0] else None, key[2]))
            while len(out) < shards and at >= total * (len(out) + 1) / shards:
                shards -= 1
        at += w
    return out


def _shard(bounds: list[tuple[int | None, str]]):
    """The number of bounds that a row has reached, in two steps of about the square root of their number."""
    if not bounds:
        return F.lit(0)
    width = math.isqrt(len(bounds)) + 1
    kind = "array<struct<p:bigint,d:string>>"
    made = lambda some: F.from_json(F.lit(json.dumps([{"p": p, "d": d} for p, d in some])), kind)
    key = F.struct(F.col("page_id").alias("p"), F.col("digest").alias("d"))
    reached = lambda some: F.size(F.filter(some, lambda b: b <= key))
    block = reached(made(bounds[width - 1 :: width]))
    return block * width + reached(F.slice(made(bounds), block * width + 1, F.lit(width)))


def write_archives(pages: DataFrame, root: str, min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z", shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, level: int = 6) -> DataFrame:
    """Writes one record for each row (page_id, url, html) to files below ``root``; gives the manifest."""
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.sha1(html.cast("binary")).alias("digest"), html.alias("html"))
    keys = materialise(spark, rows.select("page_id", "url", "digest", F.octet_length("html").cast("long").alias("bytes")))
    # written before they are joined: a join of two plain shuffles can have its large keys split
    leads = keys.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("lead"), F.count(F.lit(1)).alias("n"))
    leads = materialise(spark, leads.where("n > 1").select("digest", F.col("lead.page_id").alias("lead_id"), F.col("lead.url").alias("lead_url")))
    bounds = _bounds(keys, shard_bytes)
    marks = keys.join(leads, "digest").select("page_id", "digest", "url", F.lit(True).alias("is_mark"), "lead_id", "lead_url", F.lit(None).cast("string").alias("html"))
    none = F.lit(None)
    bodies = rows.select("page_id", "digest", "url", F.lit(False).alias("is_mark"), none.cast("long").alias("lead_id"), none.cast("string").alias("lead_url"), "html")
    dealt = marks.unionByName(bodies).select(_shard(bounds).cast("int").alias("shard"), "*")
    order = ["shard", F.col("page_id").asc_nulls_first(), "digest", F.col("url").asc_nulls_first(), F.col("is_mark").desc()]
    dealt = small_batches(dealt).repartitionById(len(bounds) + 1, "shard").sortWithinPartitions(*order)
    dealt.mapInArrow(tidied(_write(root, date, roll_bytes, level)), LISTED).write.parquet(f"{root}/_temporary/listed")
    listed = spark.read.schema(LISTED).parquet(f"{root}/_temporary/listed")
    listed.mapInArrow(_publish(root), LISTED).drop("temporary").write.parquet(f"{root}/manifest")
    discard(keys, leads)
    _drop(spark, f"{root}/_temporary")
    return manifest(spark, root)


def _drop(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """name, bytes, records of each file of an archive."""
    return spark.read.schema("name string, bytes bigint, records bigint").parquet(f"{root}/manifest")


class _Stream:
    """The decompressed bytes of a file of gzip members, read piece by piece."""

    def __init__(self, source):
        self.source, self.held, self.read_bytes = source, bytearray(), 0
        self.inflate, self.rest = zlib.decompressobj(31), b""

    def more(self) -> bool:
        raw = self.rest or self.source.read(CHUNK)
        if not raw:
            if not self.inflate.eof and self.read_bytes and self.open_member:
                raise ValueError("a file ends within a record")
            return False
        if not self.rest:
            self.read_bytes += len(raw)
        if self.inflate.eof:
            self.inflate = zlib.decompressobj(31)
        self.held += self.inflate.decompress(raw, CHUNK)
        self.rest = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        self.open_member = not self.inflate.eof
        return True

    open_member = False

    def head(self) -> list[str] | None:
        """Lines up to an empty line; None at the end of the file."""
        at = 0
        while (end := self.held.find(b"\r\n\r\n", at)) < 0:
            at = max(0, len(self.held) - 3)
            if not self.more():
                if self.held:
                    raise ValueError("a file ends within a header")
                return None
        lines = bytes(self.held[:end]).decode().split("\r\n")
        del self.held[: end + 4]
        return lines

    def take(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes in pieces."""
        while n:
            if not self.held and not self.more():
                raise ValueError("a file ends within a block")
            piece = bytes(self.held[:n])
            del self.held[: len(piece)]
            n -= len(piece)
            if piece:
                yield piece


RECORD = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, record_id string, refers_to_id string"


def read_file(source, with_payload: bool = False) -> Iterator[tuple]:
    """Records of one open file; the last item is (compressed bytes, records)."""
    stream, records = _Stream(source), 0
    while (lines := stream.head()) is not None:
        fields = dict(x.split(": ", 1) for x in lines[1:])
        kind, block = fields["WARC-Type"], hashlib.sha1()
        left = int(fields["Content-Length"])
        if kind == "warcinfo":
            for piece in stream.take(left):
                block.update(piece)
        else:
            records += 1
            http = stream.head()
            text = ("\r\n".join(http) + "\r\n\r\n").encode()
            block.update(text)
            payload, kept = hashlib.sha1(), []
            for piece in stream.take(left - len(text)):
                block.update(piece)
                payload.update(piece)
                if with_payload:
                    kept.append(piece)
            if kind == "response" and fields["WARC-Payload-Digest"] != f"sha1:{base32(payload.digest())}":
                raise ValueError(f"{fields['WARC-Record-ID']}: another payload than was written")
            size = int(dict(x.split(": ", 1) for x in http[1:])["Content-Length"])
            number = lambda name: int(fields[name]) if name in fields else None
            row = (number("X-Page-ID"), fields.get("WARC-Target-URI"), size, fields["WARC-Payload-Digest"].removeprefix("sha1:"), kind, number("X-Refers-To-Page-ID"), fields["WARC-Record-ID"], fields.get("WARC-Refers-To"))
            yield (*row, b"".join(kept).decode() if kind == "response" else None) if with_payload else row
        if fields["WARC-Block-Digest"] != f"sha1:{base32(block.digest())}":
            raise ValueError(f"{fields['WARC-Record-ID']}: another block than was written")
        if b"".join(stream.take(4)) != b"\r\n\r\n":
            raise ValueError(f"{fields['WARC-Record-ID']}: no end of a record")
    yield stream.read_bytes, records


def read_archives(spark: SparkSession, root: str, with_payload: bool = False) -> DataFrame:
    """The records of an archive (``RECORD``, and ``html`` of responses), each file checked against the manifest."""
    schema = RECORD + (", html string" if with_payload else "")
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.string() if x.endswith("string") else pa.int64() for x in schema.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _files(root)
        for b in batches:
            for name, size, records in zip(*(b.column(k).to_pylist() for k in range(3))):
                rows, held = [], 0
                with fs.open_input_stream(f"{path}/{name}", compression=None) as source:
                    for row in read_file(source, with_payload):
                        if len(row) == 2:
                            if row != (size, records):
                                raise ValueError(f"{name}: {row} bytes and records, the manifest has {(size, records)}")
                            continue
                        rows.append(row)
                        held += row[2] if with_payload else 0
                        if len(rows) >= 1000 or held >= CHUNK:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    files = manifest(spark, root)
    parts = max(1, min(MAX_SHARDS, files.count()))
    return files.repartition(parts, "name").mapInArrow(tidied(run), schema)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark)
    write_archives(table(spark, sf_dir, "pages"), root)
    return read_archives(spark, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _base32_sql(digest: str) -> str:
    """SQL of the base 32 digits of 40 hexadecimal digits: five of these are four of those."""
    digit = lambda k: f"(strpos('0123456789abcdef', substr({digest}, {k}, 1)) - 1)"
    out = []
    for k in range(1, 41, 5):
        value = " + ".join(f"{16 ** (4 - j)} * {digit(k + j)}" for j in range(5))
        out += [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(floor(({value}) / {32**j}) AS BIGINT) % 32 + 1, 1)" for j in (3, 2, 1, 0)]
    return " || ".join(out)


ORACLE_SQL = {
    "op11_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS x FROM pages),
             m AS (SELECT body, max(page_id) AS top FROM p GROUP BY body)
        SELECT p.page_id, CAST(octet_length(encode(p.body)) AS BIGINT) AS payload_bytes, {_base32_sql("p.x")} AS payload_digest,
               CASE WHEN p.page_id = m.top THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN p.page_id <> m.top THEN m.top END AS refers_to
        FROM p JOIN m ON p.body = m.body""",
}
