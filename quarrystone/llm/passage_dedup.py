"""Repeated passages: digests of normalised units, the earliest occurrence stays.

Units are of two kinds.  Clauses of lines: a line is cut after words that end in a clause
mark.  And, since a passage may stand anywhere in a line and have no marks, runs of
``GRAM`` words that content picks (winnowing: the smallest digest of each ``PICK`` in a
row), so that any two equal runs of ``GRAM + PICK - 1`` = 30 words hold the same picked
run wherever they stand.  Words are normalised (ASCII capitals lowered, marks at the ends
dropped, white space ignored) and hashed.  Digests are grouped over all texts; every
occurrence but the first in (doc_id, place) is a repeat.

Repeated picked runs that touch are one match, whose ends are then compared with the first
occurrences word by word, up to ``REACH`` words to each side, so that it ends where the
texts part (32 bits of each word's hash are compared).  Repeats with at
most ``bridge`` words between form a passage; one of ``min_words`` words or more is
removed.  Start and end are code points of the original text.

Counting first and last occurrences is a grouped aggregate with map-side combining, and
the joins back split large keys, so a unit that a third of all texts share is no
single task.

Cases: null text = empty text = no units; rows with equal ids are one text after the
other in the order of their contents, and repeated rows (same id and text) one row after
the other, so all but the first of them are repeats; null ids rank first and are removed
from like any other; a match within one text begins after its first occurrence's ``GRAM``
words; very long texts are read whole, one at a time; columns of the input keep their
names and values; an empty table gives no passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrystone.llm.common import NOT_SPACE, cut_out, discard, fresh, hash_words, lower_ascii, materialise, mix, slices, small_batches, table, text_bytes, tidied, word_spans

#: Bytes after which a clause ends, and which do not count in a word.
ENDS = np.zeros(256, bool)
ENDS[list(b".!?,;:")] = True
#: Units of fewer words are no evidence of their own (they may stand between others).
UNIT_WORDS = 3
#: Words of a run that content picks, and of how many in a row the smallest is picked.
GRAM, PICK = 16, 15
#: Words compared beyond each end of a match.
REACH = GRAM + PICK - 1
#: Texts up to which the ends to compare are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 400_000
_C = np.uint64(0xD6E8FEB86659FD93)
_POW = np.ones(1, np.uint64)


def _word_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW
    if len(_POW) < n:
        steps = np.full(1 << (n - 1).bit_length(), _C | np.uint64(1), np.uint64)
        steps[0] = 1
        _POW = np.multiply.accumulate(steps)
    return _POW


def _words(col: pa.Array) -> tuple[np.ndarray, ...]:
    """Lowered bytes, where texts begin, and of each word: first and end byte, text number, hash."""
    data, off = text_bytes(col)
    data = lower_ascii(data)
    w0, w1, doc = word_spans(data, off, NOT_SPACE)
    # words without the marks at their end (a word of marks alone keeps the first)
    end = w1.copy()
    for _ in range(3):
        end -= ENDS[data[end - 1]] & (end - w0 > 1)
    return data, off, w0, w1, doc, hash_words(data, w0, end)


def _sliding(x: np.ndarray, n: int, of: np.ufunc) -> np.ndarray:
    """``of`` (minimum or maximum) of each ``n`` neighbours; ``len(x) >= n``."""
    have = 1
    while 2 * have <= n:
        x = of(x[:-have], x[have:])
        have *= 2
    return of(x[: len(x) - (n - have)], x[n - have :]) if n > have else x


def _picked(digest: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Runs of ``GRAM`` words (their first words) that are the smallest of ``PICK`` in a row within a text."""
    if len(doc) < REACH:
        return np.zeros(0, np.int64)
    low = _sliding(digest, PICK, np.minimum)
    low = np.where(doc[: len(low)] == doc[REACH - 1 :], low, np.uint64(0))
    pad = np.zeros(PICK - 1, np.uint64)
    most = _sliding(np.concatenate([pad, low, pad]), PICK, np.maximum)
    return np.flatnonzero((most == digest) & (most > 0))


def find_units(col: pa.Array) -> dict[str, np.ndarray]:
    """Units of some texts: text number, digest, first and end word, first and end code point (0 for picked runs), whether picked."""
    data, off, w0, w1, doc, h = _words(col)
    if not len(w0):
        z = np.zeros(0, np.int64)
        return {"doc": z, "digest": z, "w0": z, "w1": z, "c0": z, "c1": z, "gram": np.zeros(0, bool)}
    newline = np.concatenate([[0], np.cumsum(data == 10)])
    last = np.ones(len(w0), bool)
    last[:-1] = (doc[1:] != doc[:-1]) | ENDS[data[w1[:-1] - 1]] | (newline[w0[1:]] > newline[w1[:-1]])
    stop = np.flatnonzero(last) + 1
    start = np.concatenate([[0], stop[:-1]])
    pw = _word_powers(len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    with np.errstate(over="ignore"):
        # the digest of words i..j, whatever stands before: its sum times the power that is left
        np.cumsum(h * pw[len(h) - 1 :: -1][: len(h)], out=total[1:])
        inv = np.uint64(pow(int(_C) | 1, -1, 1 << 64))
        steps = np.full(len(h) + 1, inv, np.uint64)
        steps[0] = 1
        steps = np.multiply.accumulate(steps)
        digest = mix((total[stop] - total[start]) * steps[len(h) - stop] ^ (stop - start).astype(np.uint64))
        grams = mix((total[GRAM:] - total[:-GRAM]) * steps[: max(0, len(h) - GRAM + 1)][::-1] ^ _C)
    picked = _picked(grams, doc)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    n_words = np.bincount(doc, minlength=len(col))
    first_word = np.cumsum(n_words) - n_words
    zero = points[off[:-1]][doc[start]]
    none = np.zeros(len(picked), np.int64)
    units = {
        "doc": (doc[start], doc[picked]),
        "digest": (digest.view(np.int64), grams[picked].view(np.int64)),
        "w0": (start - first_word[doc[start]], picked - first_word[doc[picked]]),
        "w1": (stop - first_word[doc[start]], picked + GRAM - first_word[doc[picked]]),
        "c0": (points[w0[start]] - zero, none),
        "c1": (points[w1[stop - 1]] - zero, none),
        "gram": (np.zeros(len(start), bool), np.ones(len(picked), bool)),
    }
    return {k: np.concatenate(v) for k, v in units.items()}


def _units(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in slices(b, "text"):
                u = find_units(some.column(2))
                keep = u["w1"] - u["w0"] >= UNIT_WORDS
                of = pa.array(u["doc"][keep])
                cols = [some.column(0).take(of), some.column(1).take(of), pa.array(u["digest"][keep])]
                cols += [pa.array(u[k][keep].astype(np.int32)) for k in ("w0", "w1", "c0", "c1")] + [pa.array(u["gram"][keep])]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "copy", "digest", "w0", "w1", "c0", "c1", "gram"])

    return small_batches(docs).mapInArrow(tidied(run), "doc_id bigint, copy bigint, digest bigint, w0 int, w1 int, c0 int, c1 int, gram boolean")


def _around(docs: DataFrame) -> DataFrame:
    """For each of ``ends`` (a word, and whether what follows it or stands before it is asked for): the hashes of
    the next ``REACH`` words outwards, and the code points at which a match longer by 0, 1, ... words ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in slices(b, "text"):
                data, off, w0, w1, doc, h = _words(some.column(2))
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                n_words = np.bincount(doc, minlength=some.num_rows)
                first = np.cumsum(n_words) - n_words
                lists = some.column(3)
                of = np.repeat(np.arange(some.num_rows), np.asarray(lists.value_lengths()))
                at, right = (np.asarray(c) for c in lists.flatten().flatten())
                right = right.astype(bool)
                n = np.minimum(REACH, np.where(right, n_words[of] - at, at)).astype(np.int64)
                step = np.where(right, 1, -1)
                # outwards from the word before (left) or the word at (right) the end
                begin = first[of] + at - ~right
                lengths, points_lengths = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n + 1)])
                which = np.repeat(np.arange(len(at)), n)
                near = h[begin[which] + step[which] * (np.arange(len(which)) - lengths[which])]
                which = np.repeat(np.arange(len(at)), n + 1)
                word = begin[which] + step[which] * (np.arange(len(which)) - points_lengths[which] - 1)
                place = points[np.where(right[which], w1[word], w0[word])] - points[off[:-1]][of[which]]
                cols = [some.column(0).take(pa.array(of)), some.column(1).take(pa.array(of)), pa.array(at.astype(np.int32)), pa.array(right)]
                cols.append(pa.ListArray.from_arrays(pa.array(lengths.astype(np.int32)), pa.array((near >> np.uint64(32)).astype(np.uint32).view(np.int32))))
                cols.append(pa.ListArray.from_arrays(pa.array(points_lengths.astype(np.int32)), pa.array(place.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "copy", "at", "right", "near", "points"])

    return small_batches(docs).mapInArrow(tidied(run), "doc_id bigint, copy bigint, at int, right boolean, near array<int>, points array<int>")


def _matches(docs: DataFrame, repeats: DataFrame) -> DataFrame:
    """Repeats of picked runs that touch, as one match each, out to the words at which the text and its first occurrence part."""
    spark = docs.sparkSession
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("copy") == F.col("first.copy"))
    seeds = repeats.where("gram").where(~same | (F.col("w0") >= F.col("first.w0") + GRAM))
    seeds = seeds.select("doc_id", "copy", "w0", "w1", F.col("first.doc_id").alias("first_doc_id"), F.col("first.copy").alias("first_copy"), (F.col("first.w0") - F.col("w0")).alias("shift"))
    along = Window.partitionBy("doc_id", "copy").orderBy("w0")
    touch = F.coalesce(F.col("w0") <= F.lag("w1").over(along), F.lit(False))
    numbered = seeds.withColumn("fresh", F.when(touch, 0).otherwise(1)).withColumn("match", F.sum("fresh").over(along))
    key = ["doc_id", "copy", "match"]
    parts = numbered.groupBy(*key, "first_doc_id", "first_copy", "shift").agg(F.min("w0").alias("w0"), F.max("w1").alias("w1"))
    # the outermost part may have begun in another text than the whole: so the one next to it is compared too
    rank = lambda *c: F.row_number().over(Window.partitionBy(*key).orderBy(*c)) <= 2
    parts = parts.withColumn("_left", rank("w0", "shift")).withColumn("_right", rank(F.desc("w1"), "shift")).where("_left or _right")
    sides = F.explode(F.array(F.struct(F.col("_left").alias("go"), F.col("w0").alias("at"), F.lit(False).alias("right")), F.struct(F.col("_right").alias("go"), F.col("w1").alias("at"), F.lit(True).alias("right"))))
    ends = materialise(spark, parts.select(*key, "first_doc_id", "first_copy", "shift", sides.alias("e")).where("e.go").select(*key, "first_doc_id", "first_copy", "e.at", "e.right", (F.col("e.at") + F.col("shift")).alias("first_at")))
    asked = ends.select("doc_id", "copy", "at", "right").union(ends.select("first_doc_id", "first_copy", "first_at", "right")).distinct()
    asked = materialise(spark, asked.groupBy("doc_id", "copy").agg(F.collect_list(F.struct("at", "right")).alias("ends")))
    small = asked.count() <= BROADCAST_ROWS
    asked = asked.select(F.col("doc_id").alias("_doc"), F.col("copy").alias("_copy"), "ends")
    texts = docs.join(F.broadcast(asked) if small else asked, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("copy") == F.col("_copy"))).select("doc_id", "copy", "text", "ends")
    around = materialise(spark, _around(texts).dropDuplicates(["doc_id", "copy", "at", "right"]))
    own = around.toDF("_doc", "_copy", "_at", "_right", "near", "points")
    other = around.select(*(F.col(c).alias(f"_first_{c}") for c in ("doc_id", "copy", "at", "right", "near")))
    # written before it is joined: the texts of one first occurrence may be a large part of all
    mine = materialise(spark, ends.join(own, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("copy") == F.col("_copy")) & (F.col("at") == F.col("_at")) & (F.col("right") == F.col("_right"))).drop("_doc", "_copy", "_at", "_right"))
    both = mine.join(other, F.col("first_doc_id").eqNullSafe(F.col("_first_doc_id")) & (F.col("first_copy") == F.col("_first_copy")) & (F.col("first_at") == F.col("_first_at")) & (F.col("right") == F.col("_first_right")))
    parted = F.array_position(F.zip_with("near", "_first_near", lambda a, b: F.coalesce(a != b, F.lit(True))), True)
    longer = both.withColumn("more", F.when(parted > 0, parted - 1).otherwise(F.size("near")).cast("int")).withColumn("point", F.element_at("points", F.col("more") + 1))
    left = F.min(F.when(~F.col("right"), F.struct((F.col("at") - F.col("more")).alias("w"), F.col("point").alias("c"), "first_doc_id")))
    right = F.max(F.when(F.col("right"), F.struct((F.col("at") + F.col("more")).alias("w"), F.col("point").alias("c"))))
    out = longer.select(*key, "at", "right", "more", "point", "first_doc_id").groupBy(*key).agg(left.alias("l"), right.alias("r"))
    return out.select("doc_id", "copy", F.col("l.w").alias("w0"), F.col("r.w").alias("w1"), F.col("l.c").alias("c0"), F.col("r.c").alias("c1"), F.col("l.first_doc_id").alias("first_doc_id"))


def _runs(repeats: DataFrame, bridge: int) -> DataFrame:
    """Numbers of runs of repeats with at most ``bridge`` words between, and how many of its ``n_words`` words each repeat adds."""
    text = Window.partitionBy("doc_id", "copy").orderBy("w0", F.desc("whole"), F.desc("w1"))
    told = repeats.withColumn("reach", F.max("w1").over(text.rowsBetween(Window.unboundedPreceding, -1)))
    apart = F.col("w0") - F.col("reach")
    new = F.when(apart.isNull() | (apart >= 0), F.col("n_words")).otherwise(F.greatest(F.lit(0), F.col("w1") - F.col("reach")))
    return told.withColumn("new", new).withColumn("fresh", F.when(apart.isNull() | (apart > bridge), 1).otherwise(0)).withColumn("run", F.sum("fresh").over(text))


def _passages(clauses: DataFrame, matches: DataFrame, min_words: int, bridge: int) -> DataFrame:
    """Runs of clauses and matches.  Where clauses alone are a passage, a match that passes
    its end by fewer than ``UNIT_WORDS`` words is no evidence of more."""
    span = lambda d: d.withColumn("n_words", F.col("w1") - F.col("w0")).withColumn("whole", F.lit(False))
    ends = (F.min("w0").alias("w0"), F.max("w1").alias("w1"), F.min("c0").alias("c0"), F.max("c1").alias("c1"), F.sum("new").cast("int").alias("n_words"), F.min_by("first_doc_id", "w0").alias("first_doc_id"))
    runs = _runs(span(clauses), bridge)
    whole = F.sum("new").over(Window.partitionBy("doc_id", "copy", "run")) >= min_words
    alone = runs.withColumn("whole", whole).groupBy("doc_id", "copy", "run", "whole", F.when(F.col("whole"), -1).otherwise(F.col("w0")).alias("item")).agg(*ends)
    every = alone.drop("run", "item").unionByName(span(matches))
    low, high = (f(F.when(F.col("whole"), F.struct(*c))) for f, c in ((F.min, ("w0", "c0")), (F.max, ("w1", "c1"))))
    out = _runs(every, bridge).groupBy("doc_id", "copy", "run").agg(*ends, low.alias("low"), high.alias("high"))
    before, after = F.col("low.w0") - F.col("w0"), F.col("w1") - F.col("high.w1")
    cut = lambda n: F.when(n < UNIT_WORDS, n).otherwise(0)
    return out.where(F.col("n_words") >= min_words).select(
        "doc_id",
        "copy",
        F.when(before < UNIT_WORDS, F.col("low.c0")).otherwise(F.col("c0")).cast("long").alias("start"),
        F.when(after < UNIT_WORDS, F.col("high.c1")).otherwise(F.col("c1")).cast("long").alias("end"),
        (F.col("n_words") - cut(before) - cut(after)).cast("long").alias("n_words"),
        "first_doc_id",
    )


def with_copies(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a column that, with ``doc_id``, names each row: zero where no id repeats, else a
    digest of its text, or a number in the order of these where rows repeat."""
    if not docs.groupBy("doc_id").count().where("count > 1").limit(1).count():
        return docs.withColumn(name, F.lit(0).cast("long"))
    key = [F.col("doc_id").cast("long").asc_nulls_first(), F.xxhash64("text")]
    if not docs.groupBy(F.col("doc_id").alias("i"), F.xxhash64("text").alias("t")).count().where("count > 1").limit(1).count():
        return docs.withColumn(name, F.xxhash64("text"))
    # by their place, too, so that a row that very many repeat is no single task
    key.append(F.col(name))
    dealt = docs.withColumn(name, F.monotonically_increasing_id()).repartitionByRange(*key).sortWithinPartitions(*key)
    return materialise(docs.sparkSession, dealt.withColumn(name, F.monotonically_increasing_id()))


def repeated_passages(docs: DataFrame, min_words: int = 30, bridge: int = 6, copy_col: str | None = None) -> DataFrame:
    """Passages to remove: doc_id, copy, start, end, n_words, first_doc_id (where the first unit stays).

    ``copy`` is what ``with_copies`` gives; ``copy_col``: where ``docs`` have it already.
    """
    spark = docs.sparkSession
    if copy_col is None:
        docs, copy_col = with_copies(docs.select("doc_id", "text"), "copy"), "copy"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(copy_col).alias("copy"), "text")
    found = materialise(spark, _units(docs))
    place = F.struct("doc_id", "copy", "w0")
    # written before they are joined: a join of two plain shuffles can have its large keys split
    firsts = materialise(spark, found.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    repeats = materialise(spark, found.join(firsts, "digest").where(place != F.col("first")).drop("digest"))
    discard(found, firsts)
    clauses = repeats.where("not gram").select("doc_id", "copy", "w0", "w1", "c0", "c1", F.col("first.doc_id").alias("first_doc_id"))
    return _passages(clauses, _matches(docs, repeats), min_words, bridge)


def remove_passages(docs: DataFrame, passages: DataFrame, copy_col: str | None = None) -> DataFrame:
    """``docs`` with the passages cut out of ``text`` and their spans in ``removed_spans``.

    ``copy_col`` as for ``repeated_passages``; without it rows must not repeat.
    """
    doc, copy, at = fresh(docs, "_span_doc", "_span_copy", "_spans")
    spans = passages.groupBy(F.col("doc_id").alias(doc), F.col("copy").alias(copy)).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(at))
    own = F.col(copy_col) == F.col(copy) if copy_col else (F.col(copy) == 0) | (F.xxhash64("text") == F.col(copy))
    joined = docs.join(spans, F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & own, "left")
    cut = cut_out(F.col("text"), F.col(at))
    out = joined.withColumn("text", F.when(F.col(at).isNotNull(), cut).otherwise(F.col("text"))).withColumn("removed_spans", F.col(at))
    return out.drop(doc, copy, at)


def remove_repeats(docs: DataFrame, min_words: int = 30, bridge: int = 6) -> DataFrame:
    """``docs`` without repeated passages; rows that repeat lose theirs but for the first."""
    (name,) = fresh(docs, "_copy")
    docs = with_copies(docs, name)
    return remove_passages(docs, repeated_passages(docs, min_words, bridge, name), name).drop(name)


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).drop("copy")
