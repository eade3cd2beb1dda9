"""Spelling variants: words one edit apart, by merging the light subtrees of their trie.

1. One pass counts the words of all texts (each task sums its own first).
2. The trie of the counted words is held as rows (node, next character, words below): a
   node is the hash of the prefix that leads to it, a word that ends at a node goes on by
   the empty character.  The heavy child of a node is the one with most words below.
3. A word leaves the heavy path at its light edges, of which it has at most log2 of the
   number of words.  There, and only there, its errata are made, as if its light subtree
   were merged into the heavy one: own character replaced by the heavy one, own character
   skipped, heavy character put before it (skipped on the other side).  Light subtrees of
   one node are merged with each other by a wildcard in place of the character.
4. Errata that coincide with the end of a word, or two wildcard errata that coincide, are
   a pair one edit apart.  Two words part at one node, where at least one of them goes by
   a light edge, so that every pair is found, and found once.

The trie is never held in one place: nodes with very many words below are looked up in a
broadcast table (at each depth there are at most ``BIG_NODES`` of them), all others by a
shuffle, so that no prefix is a hot key.  Errata of a word share no key but with words one
edit from it, and those of one wildcard differ in one character, so groups are bounded by
the alphabet.

5. The form of a word is its near word of largest n, if that is at least ``ratio`` times its
   own; ``root`` follows forms by pointer jumps (n grows tenfold with each step, so rounds
   are few).

Cases: null or empty text has no words; a null id counts as the empty string in the hash of
a run; repeated rows count each time; a run of any length is one word (its prefixes are
hashed in one pass, and only its few errata are spelled out); further columns are ignored,
whatever their names; of near words with equal n the smallest in code-point order is the
form; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm.common import discard, lower_ascii, materialise, slices, small_batches, table, text_bytes, tidied, word_spans

#: Distinct words that a task sums up before it passes them on.
HELD_WORDS = 200_000
#: A node is looked up in the broadcast table if it has at least a ``BIG_NODES``-th of all words below it.
BIG_NODES = 1000
#: Rows up to which the table of such nodes is broadcast (words of hundreds of characters could exceed it).
BROADCAST_ROWS = 400_000
#: Rows that one step makes of the words' prefixes.
STEP_ROWS = 500_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of runs: ASCII letters and the lead byte C3 of U+00C0 to U+00FF.
_RUN = np.zeros(256, bool)
_RUN[65:91] = _RUN[97:123] = _RUN[0xC3] = True


def _runs(col: pa.Array, least: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lowered bytes of some texts; first and end byte, text number and code points of each run of ``least`` or more."""
    data, off = text_bytes(col)
    data = lower_ascii(data)
    lead = data == 0xC3
    letter = data.copy()
    # what follows C3 belongs to its character
    letter[1:][lead[:-1]] = 97
    starts, ends, doc = word_spans(letter, off, _RUN)
    twos = np.concatenate([[0], np.cumsum(lead)])
    size = ends - starts - (twos[ends] - twos[starts])
    long = size >= least
    return data.tobytes(), starts[long], ends[long], doc[long], size[long]


def count_words(docs: DataFrame, least: int = 7, drop_one_in: int = 31) -> DataFrame:
    """word, n of all words of ``least`` code points or more.

    A run whose CRC-32 together with its document's id is a multiple of ``drop_one_in`` loses a character.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def emit() -> pa.RecordBatch:
            words = pa.array(held.keys(), pa.binary()).cast(pa.string())
            out = pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        crc32 = zlib.crc32
        for b in batches:
            for some in slices(b, "text"):
                seeds = [crc32(f"{'' if i is None else i}:".encode()) for i in some.column(0).to_pylist()]
                raw, starts, ends, doc, size = _runs(some.column(1), least)
                words = [raw[x:y] for x, y in zip(starts.tolist(), ends.tolist())]
                marks = np.array([crc32(w, seeds[d]) for w, d in zip(words, doc.tolist())], np.int64)
                hit = np.flatnonzero(marks % drop_one_in == 0)
                for k in hit.tolist():
                    text, at = words[k].decode(), int(marks[k] % size[k])
                    words[k] = (text[:at] + text[at + 1 :]).encode()
                held.update(words)
                # what got too short by losing a character
                for k in hit[size[hit] == least].tolist():
                    held[words[k]] -= 1
                    if not held[words[k]]:
                        del held[words[k]]
                if len(held) >= HELD_WORDS:
                    yield emit()
        if held:
            yield emit()

    parts = small_batches(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")).mapInArrow(tidied(run), "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _edges(points: np.ndarray, owner: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of all characters of some words end to end: the hash of the prefix before each, and each word's own (its last node)."""
    place = np.arange(len(points)) - first[owner]
    with np.errstate(over="ignore"):
        power = np.ones(int(size.max(initial=0)) + 1, np.uint64)
        power[1:] = np.multiply.accumulate(np.full(len(power) - 1, _BASE, np.uint64))
        total = np.zeros(len(points) + 1, np.uint64)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * power[place], out=total[1:])
        before = total[:-1] - total[first][owner]
        whole = total[first + size] - total[first]
        salt = np.uint64(0xD6E8FEB86659FD93)
        return before ^ (place.astype(np.uint64) * salt), whole ^ (size.astype(np.uint64) * salt)


def _each_edge(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Word rows, and for each of their edges: row, place, node and code point (0: the word ends)."""
    for b in batches:
        for some in slices(b, "word", STEP_ROWS):
            texts = some.column(some.schema.get_field_index("word")).to_pylist()
            size = np.array([*map(len, texts)], np.int64)
            first = np.cumsum(size) - size
            points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
            owner = np.repeat(np.arange(len(texts)), size)
            before, whole = _edges(points, owner, first, size)
            row = np.concatenate([owner, np.arange(len(texts))])
            place = np.concatenate([np.arange(len(points)) - first[owner], size])
            yield some, row, place, np.concatenate([before, whole]).view(np.int64), np.concatenate([points, np.zeros(len(texts), np.uint32)]).astype(np.int32)


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, _, _, node, point in _each_edge(batches):
        order = np.lexsort((point, node))
        node, point = node[order], point[order]
        new = np.flatnonzero(np.concatenate([[True], (node[1:] != node[:-1]) | (point[1:] != point[:-1])])) if len(node) else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(node[new]), pa.array(point[new]), pa.array(np.diff(np.append(new, len(node))))], ["node", "point", "below"])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for some, row, place, node, point in _each_edge(batches):
        for at in range(0, len(row), STEP_ROWS):
            part = slice(at, at + STEP_ROWS)
            ids = [some.column(k).take(pa.array(row[part])) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(place[part].astype(np.int32)), pa.array(node[part]), pa.array(point[part])], ["id_a", "id_b", "place", "node", "point"])


def _light_edges(spark: SparkSession, words: DataFrame) -> DataFrame:
    """(word, place, point, heavy): where a word leaves the heavy path, and the heavy character (0: a word ends)."""
    texts = small_batches(words.select("word"))
    below = texts.mapInArrow(tidied(_children), "node bigint, point int, below bigint").groupBy("node", "point").agg(F.sum("below").alias("below"))
    # nodes with one child have no light edge; equal counts: the smallest character is heavy
    heavy = below.groupBy("node").agg(F.max(F.struct("below", (-F.col("point")).alias("back"))).alias("top"), F.sum("below").alias("total"), F.count(F.lit(1)).alias("children")).where("children > 1")
    heavy = materialise(spark, heavy.select("node", (-F.col("top.back")).alias("heavy"), "total"))
    least = max(BIG_NODES, words.count() // BIG_NODES)
    big, rest = heavy.where(F.col("total") >= least).drop("total"), heavy.where(F.col("total") < least).drop("total")
    # two hashes name a word; should two words share both, each only gets errata that it need not have
    named = words.select("word", F.xxhash64("word").alias("id_a"), F.hash("word").alias("id_b"))
    edges = small_batches(named).mapInArrow(tidied(_walk), "id_a bigint, id_b int, place int, node bigint, point int")
    if big.count() <= BROADCAST_ROWS:
        edges = materialise(spark, edges.join(F.broadcast(big), "node", "left"))
        light = edges.where("heavy is not null").unionByName(edges.where("heavy is null").drop("heavy").join(rest, "node"))
    else:
        edges = materialise(spark, edges)
        light = edges.join(heavy.drop("total"), "node")
    light = materialise(spark, light.where("point != heavy").select("id_a", "id_b", "place", "point", "heavy"))
    discard(edges, heavy)
    return light.join(named, ["id_a", "id_b"]).select("word", "place", "point", "heavy")


def near_pairs(spark: SparkSession, words: DataFrame) -> DataFrame:
    """(a, b), each pair once, of all words of ``words`` (one row each) that are exactly one edit apart."""
    words = words.select("word")
    light = materialise(spark, _light_edges(spark, words))
    ends = F.col("point") == 0
    before, after = F.expr("substring(word, 1, place)"), F.expr("substring(word, place + 2)")
    heavy = F.when(F.col("heavy") != 0, F.char("heavy"))
    replaced = F.when(~ends & heavy.isNotNull(), F.concat(before, heavy, after))
    # of a run of one character the last is skipped: there, and nowhere else, the two words part
    skipped = F.when(~ends & F.expr("char(point) <> substring(word, place + 2, 1)"), F.concat(before, after))
    put = F.when(heavy.isNotNull(), F.concat(before, heavy, F.expr("substring(word, place + 1)")))
    errata = light.select("word", F.explode(F.array(replaced, skipped, put)).alias("errata")).where("errata is not null")
    found = errata.join(words.withColumnRenamed("word", "errata"), "errata").select(F.col("word").alias("a"), F.col("errata").alias("b"))
    # no run has a star
    wild = light.where(~ends).select("word", F.concat(before, F.lit("*"), after).alias("errata"))
    other = wild.withColumnRenamed("word", "other")
    both = wild.join(other, "errata").where("word < other").select(F.col("word").alias("a"), F.col("other").alias("b"))
    return found.unionByName(both)


def spelling_groups(docs: DataFrame, least: int = 7, min_n: int = 2, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    words = materialise(spark, count_words(docs, least).where(F.col("n") >= min_n))
    pairs = near_pairs(spark, words)
    ways = materialise(spark, pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    of = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    near = ways.join(of, "b").groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), "b")).alias("top"))
    out = words.join(near.withColumnRenamed("a", "word"), "word", "left")
    led = -F.col("top.less") >= ratio * F.col("n")
    out = materialise(
        spark,
        out.select("word", F.when(led, F.col("top.b")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(led, -F.col("top.less")).alias("form_n")),
    )
    discard(ways)
    roots = materialise(spark, out.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        further = materialise(spark, roots.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")))
        discard(roots)
        roots = further.select("word", "root")
        if not further.where("moved").limit(1).count():
            break
    discard(words)
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"))
