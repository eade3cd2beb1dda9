"""Near duplicates: SuperMinHash signatures, banding, exact verification, union-find.

1. One map-only pass turns each text into its set of five-word shingles (64-bit
   hashes), a digest of the whole set, and a SuperMinHash signature.  An element draws
   one rank for each place of a permutation of the slots, in steps; a text stops at the
   first step that can no longer lower any slot.  Bands of the signature are hashed.
2. Equal sets fall together by their digest; from here on only one of each counts.
3. Sets that share a band are candidates.  Each is tied to the smallest of its bucket,
   and the components of these ties hold every candidate pair.
4. Within a component all pairs are compared on their full sets.  A large component is
   cut into chunks, and each pair of chunks is a task of its own, so that a task holds
   a bounded number of shingles; a task puts out a spanning forest of its links, never
   all pairs.
5. Components of the confirmed links, carried back to equal sets.

A pair of similarity 0.80 shares none of the 34 bands of 5 slots with probability 1.4e-6,
one of 0.85 with 2.2e-9; nothing else is lost.

Cases: null text, empty text and text without words have an empty set and no link;
fewer than five words are one shingle; rows with the same id are one node, linked by
any of their texts; rows with a null id are never linked and are kept; a very long text
goes alone through each vectorised step; of equally good representatives the smallest
id leads; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm.common import NOT_SPACE, discard, hash_words, lower_ascii, materialise, mix, slices, small_batches, table, text_bytes, tidied, tidy, word_spans
from quarrystone.llm.graph import connected_components

SHINGLE = 5
BANDS, ROWS = 34, 5
SLOTS = BANDS * ROWS
#: Weight (shingles, and 400 for each document) that one verifying task holds of each side.
CHUNK_WEIGHT = 400_000
#: Rows up to which the candidates are broadcast to the texts; more are joined by a shuffle.
BROADCAST_ROWS = 400_000
_C = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of some texts end to end, sorted within each, and where each text begins."""
    data, off = text_bytes(col)
    data = lower_ascii(data)
    starts, ends, doc = word_spans(data, off, NOT_SPACE)
    h = hash_words(data, starts, ends)
    docs = len(col)
    n = np.bincount(doc, minlength=docs)
    first = np.cumsum(n) - n
    out, owner = [], []
    with np.errstate(over="ignore"):
        if len(h) >= SHINGLE:
            s = np.full(len(h) - SHINGLE + 1, SHINGLE, np.uint64)
            for k in range(SHINGLE):
                s = s * _C + h[k : len(h) - SHINGLE + 1 + k]
            inside = doc[SHINGLE - 1 :] == doc[: len(doc) - SHINGLE + 1]
            out.append(mix(s[inside]))
            owner.append(doc[: len(inside)][inside])
        short = np.flatnonzero((n > 0) & (n < SHINGLE))
        if len(short):
            s = n[short].astype(np.uint64)
            for k in range(SHINGLE - 1):
                more = n[short] > k
                s = np.where(more, s * _C + h[np.where(more, first[short] + k, 0)], s)
            out.append(mix(s))
            owner.append(short)
    if not out:
        return np.zeros(0, np.uint64), np.zeros(docs + 1, np.int64)
    s, owner = np.concatenate(out), np.concatenate(owner)
    order = np.lexsort((s, owner))
    s, owner = s[order], owner[order]
    fresh = np.ones(len(s), bool)
    fresh[1:] = (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])
    s, owner = s[fresh], owner[fresh]
    return s, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=docs))])


def super_minhash(s: np.ndarray, begin: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signatures (texts x slots); a value holds the step above and the rank below."""
    docs = len(begin) - 1
    none = np.uint64(slots) << np.uint64(48)
    sig = np.full(docs * slots, none, np.uint64)
    owner = np.repeat(np.arange(docs), np.diff(begin))
    place = None
    for step in range(slots):
        draw = mix(s + np.array([step], np.uint64) * _C)
        to = step + (draw & np.uint64(0xFFFF)).astype(np.int64) * (slots - step) // 65536
        if place is None:
            slot = to
        else:
            row = np.arange(len(s))
            slot = place[row, to].astype(np.int64)
            place[row, to] = place[:, step]
        np.minimum.at(sig, owner * slots + slot, (np.uint64(step) << np.uint64(48)) | (draw >> np.uint64(16)))
        # a text goes on while a slot still has a value of a later step
        live = (sig.reshape(docs, slots).max(axis=1) >> np.uint64(48)) > step
        go = live[owner]
        if not go.any():
            break
        if place is None:
            s, owner, to = s[go], owner[go], to[go]
            place = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(s), 1))
            place[np.arange(len(s)), to] = 0
        elif not go.all():
            s, owner, place = s[go], owner[go], place[go]
    return sig.reshape(docs, slots)


def band_hashes(sig: np.ndarray) -> np.ndarray:
    docs = len(sig)
    v = sig.reshape(docs, BANDS, ROWS)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (docs, BANDS)).copy()
    with np.errstate(over="ignore"):
        for k in range(ROWS):
            h = mix(h * _C + v[:, :, k])
    return h.view(np.int64)


SIGNATURE = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"


def signatures(docs: DataFrame) -> DataFrame:
    """Set size, set digest and band hashes of each (doc_id, text).  Map-only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in slices(b, "text"):
                s, begin = shingle_sets(some.column(1))
                n = np.diff(begin)
                total = np.zeros((2, len(s) + 1), np.uint64)
                with np.errstate(over="ignore"):
                    np.cumsum(mix(s), out=total[0, 1:])
                    np.cumsum(mix(s ^ _C), out=total[1, 1:])
                    digest = (total[:, begin[1:]] - total[:, begin[:-1]]).view(np.int64)
                bands = band_hashes(super_minhash(s, begin))
                some_bands = bands[n > 0].ravel()
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]).astype(np.int32)), pa.array(some_bands))
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(n), pa.array(digest[0]), pa.array(digest[1]), lists], ["doc_id", "n_shingles", "set_a", "set_b", "bands"])

    return small_batches(docs.select("doc_id", "text")).mapInArrow(tidied(run), SIGNATURE)


def _forest(linked: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links between ``rows`` and ``cols`` (by their positions)."""
    left_r, left_c = np.ones(len(rows), bool), np.ones(len(cols), bool)
    out: list[tuple[int, int]] = []
    for start in np.flatnonzero(linked.any(axis=1)):
        if not left_r[start]:
            continue
        left_r[start] = False
        todo = [(True, start)]
        while todo:
            is_row, x = todo.pop()
            hit = np.flatnonzero((linked[x] & left_c) if is_row else (linked[:, x] & left_r))
            (left_c if is_row else left_r)[hit] = False
            for y in hit.tolist():
                out.append((int(rows[x]), int(cols[y])) if is_row else (int(rows[y]), int(cols[x])))
                todo.append((not is_row, y))
    return out


def links(s: np.ndarray, begin: np.ndarray, rows: np.ndarray, cols: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs (row, column) of texts whose full sets are similar enough."""
    some = np.unique(np.concatenate([rows, cols]))
    size = np.diff(begin)
    take = np.concatenate([s[begin[d] : begin[d + 1]] for d in some])
    owner = np.repeat(np.arange(len(some)), size[some])
    order = np.argsort(take, kind="stable")
    take, owner = take[order], owner[order]
    new = np.concatenate([[True], take[1:] != take[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], column[shared]
    r, c = np.searchsorted(some, rows), np.searchsorted(some, cols)
    both = np.zeros((len(r), len(c)), np.float32)
    if len(column):
        column = np.cumsum(np.concatenate([[0], np.diff(column) != 0]))
        width = max(64, 4_000_000 // len(some))
        for low in range(0, int(column[-1]) + 1, width):
            a, b = np.searchsorted(column, [low, low + width])
            m = np.zeros((len(some), min(width, int(column[-1]) + 1 - low)), np.float32)
            m[owner[a:b], column[a:b] - low] = 1
            both += m[r] @ m[c].T
    both = np.rint(both).astype(np.int64)
    union = size[rows][:, None] + size[cols][None, :] - both
    linked = (100 * both >= percent * union) & (both > 0)
    linked &= rows[:, None] != cols[None, :]
    return _forest(linked, rows, cols)


def _verify(percent: int):
    def run(key: tuple, block: pa.Table) -> pa.Table:
        ids = block["doc_id"].to_numpy()
        comp, side = block["comp"].to_numpy(), block["side"].to_numpy()
        parts, begin, at = [], [np.zeros(1, np.int64)], 0
        text = block["text"].combine_chunks()
        text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
        for some in slices(pa.RecordBatch.from_arrays([text], ["text"]), "text"):
            s, off = shingle_sets(some.column(0))
            parts.append(s)
            begin.append(off[1:] + at)
            at += len(s)
        s, off = np.concatenate(parts), np.concatenate(begin)
        order = np.argsort(comp, kind="stable")
        cuts = np.flatnonzero(np.diff(comp[order])) + 1
        pairs: list[tuple[int, int]] = []
        for members in np.split(order, cuts):
            rows = members[side[members] != 2]
            cols = members[side[members] != 1]
            if len(members) > 1 and len(rows) and len(cols):
                pairs += links(s, off, rows, cols, percent)
        a = np.array([p for p, _ in pairs], np.int64)
        b = np.array([q for _, q in pairs], np.int64)
        del s, parts, text, block
        tidy()
        return pa.table({"a": pa.array(ids[a], pa.int64()), "b": pa.array(ids[b], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row; links need ``percent`` % of Jaccard similarity."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sig = materialise(spark, signatures(docs))
    key = ["n_shingles", "set_a", "set_b"]
    filled = sig.where("doc_id is not null and n_shingles > 0")
    classes = materialise(spark, filled.groupBy(*key).agg(F.min("doc_id").alias("rep")))
    # one row, and so one signature, for each set; an id may lead several
    reps = filled.join(classes.withColumnRenamed("rep", "doc_id"), [*key, "doc_id"], "left_semi").dropDuplicates(key)
    cells = materialise(spark, reps.select("doc_id", F.explode("bands").alias("cell")))
    # written before they are joined: a join of two plain shuffles can have its large keys split
    leads = materialise(spark, cells.groupBy("cell").agg(F.min("doc_id").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    own = F.struct(*key)
    sets = filled.groupBy("doc_id", *key).agg(F.count(F.lit(1)).alias("rows"))
    per_id = sets.groupBy("doc_id").agg(F.sum(F.col("n_shingles") + 400).alias("weight"), F.max("rows").alias("rows"), F.min(own).alias("low"), F.max(own).alias("high"))
    per_id = materialise(spark, per_id.select("doc_id", "weight", "rows", (F.col("low") != F.col("high")).alias("several")))
    if per_id.where("rows > 1").limit(1).count():
        # a row is compared once, however often it stands there
        docs = docs.dropDuplicates(["doc_id", "text"])
    # an id with several sets ties what these sets lead to
    several = per_id.where("several").select("doc_id")
    same = materialise(spark, filled.join(several, "doc_id").join(classes, key).where("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct())
    ties = cells.join(leads, "cell").where("doc_id != lead").select("doc_id", "lead")
    # two sets of one id may lie in a bucket together: then the id is its own lead, and both are compared as one node's
    found = connected_components(spark, ties)
    roots = found.select(F.col("root").alias("node"), "root").distinct()
    members = found.unionByName(roots).select(F.col("node").alias("doc_id"), F.col("root").alias("comp"))
    members = materialise(spark, members.join(per_id.select("doc_id", "weight"), "doc_id"))
    sizes = members.groupBy("comp").agg(F.sum("weight").alias("total"))
    all_of = members.agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n")).first()
    count, total = all_of["n"], all_of["w"] or 0
    groups = max(1, total // CHUNK_WEIGHT)
    parts = F.ceil(F.col("total") / CHUNK_WEIGHT).cast("int")
    dealt = members.join(sizes, "comp").select(
        "doc_id",
        "comp",
        F.when(parts <= 1, F.array(F.struct(F.pmod(F.xxhash64("comp"), F.lit(groups)).alias("p"), F.lit(-1).cast("int").alias("q"), F.lit(0).alias("side"))))
        .otherwise(_chunk_pairs(F.pmod(F.xxhash64("doc_id"), parts).cast("int"), parts))
        .alias("to"),
        F.when(parts <= 1, F.lit(-1).cast("long")).otherwise(F.col("comp")).alias("big"),
    )
    if count <= BROADCAST_ROWS:
        dealt = F.broadcast(dealt)
    blocks = docs.join(dealt, "doc_id").select("doc_id", "text", "comp", "big", F.explode("to").alias("t")).select("doc_id", "text", "comp", "big", "t.*")
    pairs = blocks.groupBy("big", "p", "q").applyInArrow(_verify(percent), "a bigint, b bigint")
    # written first: two Python functions in one stage would take two workers for each core
    pairs = materialise(spark, pairs)
    joined = connected_components(spark, pairs.unionByName(same))
    top = materialise(spark, classes.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select(*key, F.coalesce("root", "rep").alias("component_id")))
    out = sig.select("doc_id", *key).join(top, key, "left")
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
    if several.limit(1).count() or _repeats(sig):
        # rows without words, too, belong to what other rows of their id are linked with
        least = materialise(spark, out.where("doc_id is not null").groupBy("doc_id").agg(F.min("component_id").alias("least")))
        out = out.join(least, "doc_id", "left").select("doc_id", "n_shingles", F.col("least").alias("component_id"))
    discard(cells, leads, members, pairs, same)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _repeats(sig: DataFrame) -> bool:
    """Whether an id has a row without words beside other rows."""
    empty = sig.where("doc_id is not null and n_shingles = 0").select("doc_id")
    return sig.where("n_shingles > 0").join(empty, "doc_id", "left_semi").limit(1).count() > 0


def _chunk_pairs(own, parts):
    """The pairs of chunks that chunk ``own`` of ``parts`` belongs to, and its side (0: both)."""
    return F.transform(
        F.sequence(F.lit(0), parts - 1),
        lambda other: F.struct(
            F.least(own, other).cast("long").alias("p"),
            F.greatest(own, other).cast("int").alias("q"),
            F.when(own == other, 0).when(own < other, 1).otherwise(2).alias("side"),
        ),
    )


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)
