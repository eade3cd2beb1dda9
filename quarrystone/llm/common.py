"""Helpers shared by the corpus operators: Arrow text access, vectorised word
segmentation and hashing, and the shared folder of the cluster.

Everything here works on one bounded slice of one Arrow batch at a time, so the
memory of a Python worker does not follow the size of a partition.
"""

from __future__ import annotations

import ctypes
import functools
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one vectorised step takes at most (a longer text goes alone).
SLICE_BYTES = 500_000
#: Rows of an Arrow batch: whole texts may be long, so far fewer than Spark's default.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors share.

    Where it is unset, a session whose driver is its only machine uses its warehouse; any other raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names for a time, none of which is one of ``df``'s (whose case Spark does not tell apart) or of the others."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """What ``join`` (a sum, a maximum) gives of each value of an array and all before it.

    Each sweep joins values twice as far apart, so that an array is copied as often as its size has digits.
    """
    sweeps = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int"))

    def sweep(acc: Column, k: Column) -> Column:
        far = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(acc, lambda x, i: F.when(i >= far, join(F.get(acc, i - far), x)).otherwise(x))

    return F.aggregate(sweeps, values, sweep)


def cut_out(text: Column, spans: Column, between: str = "") -> Column:
    """``text`` without what the sorted ``spans`` (start, end) cover; ``between`` for each stretch.

    Pieces are taken from four bytes a character, so each costs its own length wherever it stands.
    """
    # a sign before each piece, as a first U+FEFF would be taken for a byte order mark
    piece = lambda raw, a, b: F.substring(F.decode(F.concat(F.lit(b"\0\0\0x"), F.substr(raw, (4 * a + 1).cast("int"), (4 * (b - a)).cast("int"))), "UTF-32"), 2, 2**31 - 1)

    def put(raw: Column, reach: Column) -> Column:
        def before(s: Column, i: Column) -> Column:
            done = F.coalesce(F.get(reach, i - 1), F.lit(0).cast("long"))
            return F.when(s["start"] > done, F.concat(piece(raw, done, s["start"]), F.lit(between))).when((i == 0) & (s["start"] == 0), F.lit(between)).otherwise("")

        return F.concat(F.array_join(F.transform(spans, before), ""), piece(raw, F.element_at(reach, -1), F.length(raw) / 4))

    ends = running(F.transform(spans, lambda s: s["end"].cast("long")), lambda a, b: F.greatest(a, b))
    return bound(F.struct(F.encode(text, "UTF-32").alias("raw"), ends.alias("reach")), lambda x: put(x["raw"], x["reach"]))


def tidy() -> None:
    """Gives freed memory of this Python worker back: workers live on between tasks and stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, and memory given back when its partition ends."""

    @functools.wraps(run)
    def tidied_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            tidy()

    return tidied_run


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with batches to Python no larger than ``BATCH_ROWS`` for the session from now on."""
    conf = df.sparkSession.conf
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def materialise(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it again: the lineage ends there."""
    path = shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*written: DataFrame) -> None:
    """Deletes tables of ``materialise`` that nothing reads any more."""
    for df in written:
        jvm, context = df.sparkSession._jvm, df.sparkSession._jsc
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context.hadoopConfiguration()).delete(path, True)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of ``batch`` whose ``column`` holds about ``limit`` bytes each."""
    if not batch.num_rows:
        return
    off = text_offsets(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(off, off[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def text_offsets(col: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    return np.frombuffer(col.buffers()[1], dtype=kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of ``col`` end to end and where each begins; null is empty."""
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null("")
    off = text_offsets(col)
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def word_spans(data: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each maximal run of word bytes; runs end with their text."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    m = is_word[data]
    before = np.empty_like(m)
    before[0] = False
    before[1:] = m[:-1]
    inner = off[(off > 0) & (off < len(data))]
    before[inner] = False
    after = np.empty_like(m)
    after[-1] = False
    after[:-1] = m[1:]
    after[inner - 1] = False
    starts = np.flatnonzero(m & ~before)
    ends = np.flatnonzero(m & ~after) + 1
    return starts, ends, np.searchsorted(off[1:], starts, side="right")


_BASE = 0x9E3779B97F4A7C15 | 1
_POW = np.ones(1, np.uint64)
_INV = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        size = 1 << (n - 1).bit_length()
        inv = pow(_BASE, -1, 1 << 64)
        for name, b in (("_POW", _BASE), ("_INV", inv)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)
    return _POW, _INV


def mix(x: np.ndarray) -> np.ndarray:
    """The finalising steps of splitmix64."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span: a polynomial of its bytes, taken from prefix sums, then mixed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    pw, inv = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(0x1F3)) * pw[: len(data)], out=total[1:])
    h = (total[ends] - total[starts]) * inv[starts]
    return mix(h ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    return out


#: Bytes of words that white space (space, tab to carriage return) ends.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False

#: Bytes of words of small ASCII letters, digits and anything beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[48:58] = LETTERS[97:123] = LETTERS[128:] = True
