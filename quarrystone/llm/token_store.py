"""Token ids in Simple-8b words: encoding, files, and reading back.

A segment holds the ids of some documents end to end, in blocks of 128 ids.  A
64-bit word has a selector in its upper four bits and as many ids of equal width
as fit below (selector 0 is the escape: the next word is one id as it stands).
The selector of every position follows from sliding maxima of the bit widths, so
all blocks of a segment are packed together; the segment keeps where the words of
each block begin, and decoding handles all words of one selector at once.  Blocks
with an escape are flagged and decoded word by word.

Files: each row of the written Parquet table is one segment (binary) with the
counts that a reader needs to skip it.  Spark's writer commits them, so a lost
executor or a repeated task leaves no half file.  Documents are dealt by ranges
of ``doc_id`` and sorted, so the segments in order of (part, segment) hold the
documents in ascending order.

Cases: null text = empty text = only the end id; null ids of documents come first;
equal ``doc_id`` and repeated rows keep each document; the ids of a very long text make a
segment of their own, or end one that is open; further columns are ignored, whatever their
names; an empty table gives no segment.
"""

from __future__ import annotations

import itertools
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm.common import hash_words, shared_dir, slices, small_batches, table, text_bytes, tidied

BLOCK = 128
#: Text bytes of one step: the more, the more units of a step are equal.
STEP_BYTES = 2_000_000
#: Ids after which a segment is closed.
SEGMENT_IDS = 1 << 20
#: (ids in a word, bits of each) by selector; selector 0 is the escape.
SELECTORS = [(1, 64), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
_COUNT = np.array([n for n, _ in SELECTORS], np.int64)
_MAGIC = b"S8B1"


def _widths(ids: np.ndarray) -> np.ndarray:
    w = np.zeros(len(ids), np.uint8)
    left = ids.copy()
    while (some := left > 0).any():
        w += some
        left >>= np.uint64(1)
    return w


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, the word at which each block begins (and the end), and which blocks have escapes."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint32), np.zeros(0, np.uint8)
    grid = np.zeros((blocks, BLOCK), np.uint64)
    grid.ravel()[: len(ids)] = ids
    top = int(ids.max()).bit_length()
    if top <= 16:
        width = _BITS[grid.astype(np.uint16)]
    else:
        width = _widths(grid.ravel()).reshape(blocks, BLOCK)
    # beyond the end of a block anything fits: a reader knows how many ids there are
    peak = np.zeros((blocks, BLOCK + 128), np.uint8)
    peak[:, :BLOCK] = width
    choice = np.where(width > 60, 0, 15).astype(np.uint8)
    have = 1
    for sel in range(14, 0, -1):
        n, bits = SELECTORS[sel]
        peak[:, : BLOCK + 128 - (n - have)] = np.maximum(peak[:, : BLOCK + 128 - (n - have)], peak[:, n - have :])
        have = n
        fits = peak[:, :BLOCK] <= bits
        if not fits.any():
            break
        choice[fits] = sel
    begins = np.zeros((blocks, BLOCK), bool)
    at, row = np.zeros(blocks, np.int64), np.arange(blocks)
    count = np.minimum(len(ids) - row * BLOCK, BLOCK)
    while len(row):
        begins[row, at] = True
        at = at + _COUNT[choice[row, at]]
        live = at < count[row]
        row, at = row[live], at[live]
    first = np.flatnonzero(begins.ravel())
    sel = choice.ravel()[first]
    place = np.arange(len(first)) + np.concatenate([[0], np.cumsum(sel == 0)[:-1]]) if len(first) else first
    words = np.zeros(len(first) + int((sel == 0).sum()), np.uint64)
    # ids with room after each block, so that a word never takes ids of the next block
    pad = max(n for s, (n, bits) in enumerate(SELECTORS) if bits and (sel == s).any()) if (sel > 1).any() else 0
    values = np.zeros((blocks, BLOCK + pad), np.uint64)
    values[:, :BLOCK] = grid
    values = values.ravel()
    for s, (n, bits) in enumerate(SELECTORS):
        of = np.flatnonzero(sel == s)
        if not len(of):
            continue
        w = np.full(len(of), s << 60, np.uint64)
        if s == 0:
            words[place[of] + 1] = grid.ravel()[first[of]]
        elif bits:
            at = first[of] + first[of] // BLOCK * pad
            for j in range(n):
                w |= values[at + j] << np.uint64(j * bits)
        words[place[of]] = w
    per_block = np.bincount(first // BLOCK, weights=1 + (sel == 0), minlength=blocks).astype(np.int64)
    escaped = np.bincount(first // BLOCK, weights=sel == 0, minlength=blocks) > 0
    return words, np.concatenate([[0], np.cumsum(per_block)]).astype(np.uint32), escaped.astype(np.uint8)


_BITS = np.array([v.bit_length() for v in range(1 << 16)], np.uint8)


def unpack(words: np.ndarray, offsets: np.ndarray, escaped: np.ndarray, n_ids: int) -> np.ndarray:
    # room after each block for what a last word holds beyond its end
    wide = BLOCK + 120
    out = np.zeros(len(escaped) * wide, np.uint64)
    block_of = np.repeat(np.arange(len(escaped)), np.diff(offsets.astype(np.int64)))
    plain = np.flatnonzero(escaped[block_of] == 0)
    sel = (words[plain] >> np.uint64(60)).astype(np.int64)
    n = _COUNT[sel]
    before = np.cumsum(n) - n
    start_word = np.searchsorted(plain, offsets[:-1].astype(np.int64))
    base = np.zeros(len(escaped), np.int64)
    whole = np.flatnonzero(escaped == 0)
    base[whole] = before[start_word[whole]]
    at = before - base[block_of[plain]] + block_of[plain] * wide
    for s, (count, bits) in enumerate(SELECTORS):
        of = np.flatnonzero(sel == s) if s else np.zeros(0, np.int64)
        if not len(of) or not bits:
            continue
        w, to = words[plain[of]], at[of]
        mask = np.uint64((1 << bits) - 1)
        for j in range(count):
            out[to + j] = (w >> np.uint64(j * bits)) & mask
    for b in np.flatnonzero(escaped):
        k, to = int(offsets[b]), b * wide
        end = to + min(BLOCK, n_ids - b * BLOCK)
        while to < end:
            w = int(words[k])
            s = w >> 60
            count, bits = SELECTORS[s]
            if s == 0:
                out[to], k = words[k + 1], k + 1
            elif bits:
                for j in range(min(count, end - to)):
                    out[to + j] = (w >> (j * bits)) & ((1 << bits) - 1)
            to, k = to + count, k + 1
    return out.reshape(len(escaped), wide)[:, :BLOCK].ravel()[:n_ids]


def write_segment(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    words, offsets, escaped = pack(ids)
    head = np.array([len(doc_ids), len(ids), len(escaped), len(words)], "<u8")
    return b"".join(
        [
            _MAGIC,
            head.tobytes(),
            np.array([d is not None for d in doc_ids], np.uint8).tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array(counts, "<i8").tobytes(),
            offsets.astype("<u4").tobytes(),
            escaped.tobytes(),
            words.astype("<u8").tobytes(),
        ]
    )


def read_segment(blob: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, ids of each document, and all ids of a segment."""
    if blob[:4] != _MAGIC:
        raise ValueError("not a segment of token ids")
    docs, n_ids, blocks, n_words = (int(x) for x in np.frombuffer(blob, "<u8", 4, 4))
    at = 36

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(blob, kind, n, at)
        at += out.nbytes
        return out

    valid, names, counts = take("u1", docs), take("<i8", docs), take("<i8", docs)
    offsets, escaped, words = take("<u4", blocks + 1), take("u1", blocks), take("<u8", n_words)
    return [int(d) if v else None for v, d in zip(valid, names)], counts, unpack(words, offsets, escaped, n_ids)


class Encoder:
    """Ids by the tokenizers library.  A byte-level pre-tokenizer always cuts before a
    single space, and around a single line break, between two characters that are no
    white space.  Texts are cut there (nowhere else), a slice of texts at a time; equal
    units of a slice are found by their hashes, and the library sees each distinct unit
    once for as long as a cache of bounded size keeps it.
    """

    #: Units in each half of the cache.
    LIMIT = 500_000
    #: Units that the library sees in one text.
    JOIN = 128

    def __init__(self, file: str, end_id: int):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(file)
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.end = np.array([end_id], "<u4").tobytes()
        # a byte-level vocabulary writes each byte as one character
        self.bytes_of = np.array([len(self.library.id_to_token(i) or "") for i in range(self.library.get_vocab_size())], np.int64)

    def _each(self, units: list[bytes]) -> list[bytes]:
        texts = [u.decode("utf-8", "surrogatepass") for u in units]
        return [array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def ask(self, units: list[bytes]) -> list[bytes]:
        """Ids of units from the library.  Units that begin as at a sure cut are encoded
        many in one text; the bytes of the ids tell where each unit ends."""
        joined = [k for k, u in enumerate(units) if len(u) > 1 and (u[0] == 32 or u[0] == 10) and not _SPACE_LIST[u[1]]]
        groups = [joined[k : k + self.JOIN] for k in range(0, len(joined), self.JOIN)]
        texts = [b"".join([units[k] for k in g]).decode("utf-8", "surrogatepass") for g in groups]
        out: list[bytes | None] = [None] * len(units)
        for g, e in zip(groups, self.library.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            ends = np.cumsum([len(units[k]) for k in g])
            done = np.cumsum(self.bytes_of[ids])
            cut = np.searchsorted(done, ends)
            if len(ids) and cut[-1] < len(ids) and (done[cut] == ends).all():
                raw, at = ids.tobytes(), [0, *((cut + 1) * 4).tolist()]
                for k, x, y in zip(g, at, at[1:]):
                    out[k] = raw[x:y]
        alone = [k for k, ids in enumerate(out) if ids is None]
        for k, ids in zip(alone, self._each([units[k] for k in alone])):
            out[k] = ids
        return out

    def _learn(self, units: list[bytes]) -> list[bytes]:
        """Ids of distinct units as little-endian 32-bit numbers."""
        found = [*map(self.words.get, units)]
        lost = [k for k, ids in enumerate(found) if ids is None]
        older, ask = self.older, []
        for k in lost:
            if (ids := older.get(units[k])) is None:
                ask.append(k)
            else:
                found[k] = ids
        for k, ids in zip(ask, self.ask([units[k] for k in ask])):
            found[k] = ids
        self.words.update(zip([units[k] for k in lost], [found[k] for k in lost]))
        if len(self.words) > self.LIMIT:
            self.older, self.words = self.words, {}
        return found

    def encode_column(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each text followed by the end id, and how many each has."""
        data, off = text_bytes(col)
        docs = len(col)
        starts = _cuts(data, off)
        ends = np.append(starts[1:], len(data))
        doc = np.searchsorted(off[1:], starts, side="right")
        h = hash_words(data, starts, ends)
        order = np.argsort(h)
        new = np.ones(len(h), bool)
        new[1:] = h[order][1:] != h[order][:-1]
        first, inverse = order[new], np.empty(len(h), np.int64)
        inverse[order] = np.cumsum(new) - 1
        raw = data.tobytes()
        found = self._learn([raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())])
        found.append(self.end)
        size = np.array([*map(len, found)], np.int64) // 4
        begin = np.cumsum(size) - size
        # the end id is one more unit after the last of each text
        units = np.insert(inverse, np.searchsorted(doc, np.arange(docs), side="right"), len(found) - 1)
        owner = np.insert(doc, np.searchsorted(doc, np.arange(docs), side="right"), np.arange(docs))
        n = size[units]
        pool = np.frombuffer(b"".join(found), "<u4")
        place = np.repeat(begin[units] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return pool[place], np.bincount(owner, weights=n, minlength=docs).astype(np.int64)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The same for a list of texts, as bytes of each."""
        ids, counts = self.encode_column(pa.array(texts, pa.string()))
        raw, ends = ids.astype("<u4").tobytes(), np.cumsum(counts) * 4
        return [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def trim(self, keep: int = 300_000) -> None:
        """Keeps the units met first, which are the common ones, for the next task."""
        self.older = {}
        self.words = dict(itertools.islice(self.words.items(), keep))


#: Bytes that may be, or be part of, white space: control signs and space, and the first
#: bytes of the characters beyond ASCII that are.
_SPACE_FIRST = np.zeros(256, bool)
_SPACE_FIRST[:33] = _SPACE_FIRST[127] = True
_SPACE_FIRST[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_SPACE_LIST = _SPACE_FIRST.tolist()


def _cuts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where units begin: each text that has any, and the sure cuts within texts."""
    at = np.flatnonzero((data == 32) | (data == 10))
    at = at[(at > 2) & (at < len(data) - 1)]
    before, after = data[at - 1], data[at + 1]
    plain = (before > 32) & (before < 127)
    # a character of two or three bytes before: not if it may be white space
    wide = (before >= 128) & (data[at - 2] != 0xC2) & ~np.isin(data[at - 3], (0xE1, 0xE2, 0xE3))
    sure = (plain | wide) & ~_SPACE_FIRST[after]
    # not at the ends of texts
    sure &= ~np.isin(at, off) & ~np.isin(at + 1, off)
    begins = off[:-1][np.diff(off) > 0]
    return np.sort(np.concatenate([begins, at[sure]]))


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(file: str, end_id: int) -> Encoder:
    if (file, end_id) not in _ENCODERS:
        _ENCODERS[file, end_id] = Encoder(file, end_id)
    return _ENCODERS[file, end_id]


def write_tokens(df: DataFrame, path: str, file: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every text and writes its ids to ``path`` in ascending order of ``id_col``.

    One range shuffle of (id, text); the ids themselves are never shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        enc, part = encoder(file, end_id), TaskContext.get().partitionId()
        names: list[int | None] = []
        counts: list[int] = []
        held: list[np.ndarray] = []
        total, number = 0, 0

        def segment() -> pa.RecordBatch:
            blob = write_segment(names, counts, np.concatenate(held))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(names)], pa.int64()), pa.array([total], pa.int64()), pa.array([blob], pa.binary())],
                ["part", "segment", "n_docs", "n_ids", "blob"],
            )

        for b in batches:
            for some in slices(b, "text", STEP_BYTES):
                ids, n = enc.encode_column(some.column(1))
                names += some.column(0).to_pylist()
                counts += n.tolist()
                held.append(ids)
                total += len(ids)
                if total >= SEGMENT_IDS:
                    yield segment()
                    names, counts, held, total, number = [], [], [], 0, number + 1
        if names:
            yield segment()
        enc.trim()

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    (
        # by a digest of the text, too, so that rows of one id (or of none) need no single task
        small_batches(rows).repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
        .mapInArrow(tidied(run), "part int, segment int, n_docs bigint, n_ids bigint, blob binary")
        .write.option("compression", "none")
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents of written files: doc_id, start, n_tokens, ids_crc32 (and ids)."""
    stored = spark.read.schema("part int, segment int, n_docs bigint, n_ids bigint, blob binary").parquet(path)
    # one row for each written partition reaches the driver, whatever the partitions hold
    sizes = {r["part"]: r["n"] for r in stored.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    base, total = {}, 0
    for part in sorted(sizes):
        base[part] = total
        total += sizes[part]
    from pyspark.sql import Window

    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored.select("part", "segment", "n_ids").withColumn("before", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).drop("n_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, number, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                names, counts, ids = read_segment(blob.as_py())
                raw = ids.astype("<u4")
                ends = np.cumsum(counts)
                begins = ends - counts
                crc = [zlib.crc32(raw[x:y]) for x, y in zip(begins, ends)]
                arrays = [pa.array([part] * len(names), pa.int32()), pa.array([number] * len(names), pa.int32()), pa.array(names, pa.int64()), pa.array(begins + base[part], pa.int64()), pa.array(counts, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    arrays.append(pa.array([raw[x:y].astype(np.int64) for x, y in zip(begins, ends)], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(arrays, [*NAMES, "ids"][: len(arrays)])

    NAMES = ["part", "segment", "doc_id", "begin", "n_tokens", "ids_crc32"]
    schema = "part int, segment int, doc_id bigint, begin bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")
    docs = stored.select("part", "segment", "blob").mapInArrow(tidied(run), schema)
    joined = docs.join(starts, ["part", "segment"])
    out = joined.select("doc_id", (F.col("begin") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
    return out


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    write_tokens(table(spark, sf_dir, "documents"), path, default_tokenizer())
    return read_tokens(spark, path)
