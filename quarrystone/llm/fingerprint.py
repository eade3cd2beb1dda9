"""Document fingerprints: invertible Bloom lookup sketches, with DataFrame functions only.

A text is a set of units, by one rule for every text, so that any two texts compare.  A
paragraph is cut by its content, in any language: at line breaks, after words that their
hashes pick (one in ``CUT_EVERY`` code points), and within words of more than ``LONG_WORD`` code points (texts
without spaces, rows of digits) after code points that end a run whose hash is a multiple
of ``CHAR_CUT``.  A unit that is longer than ``LONG_UNIT`` is cut after further words.  So an
edit changes the units it touches and no others.  A unit's 64-bit digest holds 34 bits of
hash, the unit's length (with the marks of further cuts, one in some fifty signs), and 16
bits that check both, so what peeling recovers says how much text differs.

A sketch puts each digest into one cell of each of three sub-tables; a cell keeps a
count and the XOR of its digests.  Sketches subtract cell by cell, so common units
cancel; peeling then recovers the digests of the difference: a cell whose count is 1 or
-1 and whose check fits holds one digest, which is taken out of its other cells too.
Sub-tables are peeled in turn, so no digest is taken twice in a step.  The likeness of
two sketches is one less the share of text in units of their difference.

The ``fingerprint`` column is such a sketch in ``SMALL`` cells for each sub-table, behind
a digest of the whole text; ``difference`` subtracts and peels two of them.  It recovers
differences of up to about 16 units.  Where more may differ (here: half of a text), the
sketches of both sides are made larger, by the number of units, and where peeling ends
with cells left they are made again, twice as large and with other cells, until none fails.

Rows stay dealt by document from the join of neighbours on, so cells are aggregated
and peeled without any further shuffle.

Cases: null text is empty; two empty texts have likeness 1; a unit that a text repeats
counts once; very long texts have as many units as they need and very long units count
as ``LONGEST`` code points; ids in ascending order, null first; equal ids are ordered by a
digest of their texts; repeated rows (same id and text) count once as neighbours and all
get the result; a single document is its own next; further columns of the input are
ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm.common import bound, discard, materialise, table

#: Cells for each unit of the two sketches in the first attempt; each later one doubles them.
CELLS = 3
#: Further cells of each sub-table, and peeling steps of an attempt.
SPARE, STEPS = 12, 7
#: Tasks of the first attempt for each of the session's shuffle partitions.
FINER = 3
#: Cells of each sub-table of the fingerprint column.
SMALL = 8
#: Code points that a unit counts as at most (14 bits of a digest).
LONGEST = (1 << 14) - 1
#: Documents up to which those to sketch again are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 500_000
_KEY = ["dk", "rid"]
_NULL = -(1 << 63)
_TALLY = -1

#: A line is cut after words, by their hashes and lengths, so that units have so many code points on average.
CUT_EVERY = 64
#: Units of more than ``LONG_UNIT`` code points are cut after ``MORE_OFTEN`` times as many words.
LONG_UNIT, MORE_OFTEN = 160, 3
#: A word of more than ``LONG_WORD`` code points is cut after one in ``CHAR_CUT``, by the hash of ``CHAR_RUN`` in a row.
LONG_WORD, CHAR_CUT, CHAR_RUN = 48, 24, 4
#: Signs that mark cuts, and cuts of long units only (in a text they end pieces themselves).
_CUT, _MORE = "\x01", "\x02"


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _marked_word(word: Column) -> Column:
    """A long word with a mark after each code point that ends a piece."""

    def mark(chars: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            # what stands near decides, so an edit moves no cut but those beside it
            near = F.xxhash64(*(F.coalesce(F.get(chars, i - k), F.lit("")) for k in range(CHAR_RUN)))
            return F.when(F.pmod(near, F.lit(CHAR_CUT)) == 0, F.concat(c, F.lit(_CUT))).otherwise(c)

        return F.array_join(F.transform(chars, one), "")

    return bound(F.array_remove(F.split(word, "", -1), ""), mark)


def _marked(word: Column) -> Column:
    left, size = F.pmod(F.xxhash64(word), F.lit(CUT_EVERY)), F.char_length(word) + 1
    short = F.when(left < size, F.concat(word, F.lit(_CUT))).when(left < MORE_OFTEN * size, F.concat(word, F.lit(_MORE))).otherwise(word)
    return F.when(size > LONG_WORD + 1, _marked_word(word)).otherwise(short)


def units(text: Column) -> Column:
    """Digests of the distinct units of a text."""
    marked = F.array_join(F.transform(F.split(text, " ", -1), _marked), " ")
    pieces = F.array_remove(F.split(marked, f"[{_CUT}\n]", -1), "")
    long = lambda u: F.char_length(u) > LONG_UNIT
    cut = bound(pieces, lambda p: F.when(F.exists(p, long), F.flatten(F.transform(p, lambda u: F.when(long(u), F.split(u, _MORE, -1)).otherwise(F.array(u))))).otherwise(p))
    return F.array_distinct(F.transform(cut, _digest))


def _digest(unit: Column) -> Column:
    size = F.least(F.char_length(unit), F.lit(LONGEST)).cast("long")
    high = F.shiftleft(F.shiftrightunsigned(F.xxhash64(unit), 30), 14).bitwiseOR(size)
    return F.shiftleft(high, 16).bitwiseOR(_check(high))


def _check(high: Column) -> Column:
    return F.xxhash64(high).bitwiseAND(_long(0xFFFF))


def _fits(digest: Column) -> Column:
    """Whether a cell's XOR can be one digest."""
    return digest.bitwiseAND(_long(0xFFFF)) == _check(F.shiftrightunsigned(digest, 16))


def length_of(digest: Column) -> Column:
    """Code points of the unit that a digest stands for."""
    return F.shiftrightunsigned(digest, 16).bitwiseAND(_long(LONGEST))


def text_of(digests: Column) -> Column:
    """Code points of all units of an array of digests."""
    return F.aggregate(digests, _long(0), lambda acc, d: acc + length_of(d))


# ---- sketches of few cells, as a value -----------------------------------------------------


def _slot(digest: Column, sub: int) -> Column:
    return F.shiftrightunsigned(digest, 30 + 3 * sub).bitwiseAND(_long(SMALL - 1))


def small_sketch(digests: Column) -> Column:
    """Array of ``3 * SMALL`` cells (n, digest): those of sub-table 0, then 1, then 2."""

    def cell(sub: int, slot: int) -> Column:
        own = F.filter(digests, lambda d: _slot(d, sub) == slot)
        return F.aggregate(
            own,
            F.struct(_long(0).alias("n"), _long(0).alias("digest")),
            lambda acc, d: F.struct((acc["n"] + 1).alias("n"), acc["digest"].bitwiseXOR(d).alias("digest")),
        )

    return F.array(*(cell(sub, slot) for sub in range(3) for slot in range(SMALL)))


def written(text: Column, sketch: Column) -> Column:
    """A fingerprint: digest of the text in hexadecimal digits, then count (3 bytes) and XOR of each cell in base 64."""
    cells = F.transform(sketch, lambda c: F.concat(F.lpad(F.hex(c["n"]), 6, "0"), F.lpad(F.hex(c["digest"]), 16, "0")))
    return F.concat(F.lower(F.lpad(F.hex(F.xxhash64(text)), 16, "0")), F.lit(":"), F.base64(F.unhex(F.array_join(cells, ""))))


def read_sketch(fingerprint: Column) -> Column:
    """The cells that a fingerprint holds."""
    digits = F.hex(F.unbase64(F.substr(fingerprint, F.lit(18))))
    # to base -10: a signed number
    number = lambda part, at, size: F.conv(F.substring(part, at, size), 16, -10).cast("long")
    cells = F.transform(F.sequence(F.lit(0), F.lit(3 * SMALL - 1)), lambda k: F.substr(digits, 22 * k + 1, F.lit(22)))
    return F.transform(cells, lambda part: F.struct(number(part, 1, 6).alias("n"), number(part, 7, 16).alias("digest")))


def difference(a: Column, b: Column) -> Column:
    """Of two fingerprints: struct(complete, only_a, only_b), the digests that only one holds.

    ``complete`` is false where more units differ than the cells can give back.
    """
    cell = lambda n, d: F.struct(n.alias("n"), d.alias("digest"))
    start = F.zip_with(read_sketch(a), read_sketch(b), lambda x, y: cell(x["n"] - y["n"], x["digest"].bitwiseXOR(y["digest"])))
    none = F.array().cast("array<bigint>")

    def step(state: Column, number: Column) -> Column:
        sub = number % 3
        at = lambda d, s: F.when(s == 0, _slot(d, 0)).when(s == 1, _slot(d, 1)).otherwise(_slot(d, 2)) + s * SMALL
        pure = F.filter(state["cells"], lambda c, i: (F.floor(i / SMALL) == sub) & (F.abs(c["n"]) == 1) & _fits(c["digest"]) & (at(c["digest"], sub) == i))
        cells = F.transform(
            state["cells"],
            lambda c, i: F.aggregate(
                F.filter(pure, lambda p: at(p["digest"], F.floor(i / SMALL)) == i),
                c,
                lambda acc, p: cell(acc["n"] - p["n"], acc["digest"].bitwiseXOR(p["digest"])),
            ),
        )
        got = lambda sign: F.transform(F.filter(pure, lambda p: p["n"] == sign), lambda p: p["digest"])
        return F.struct(cells.alias("cells"), F.concat(state["only_a"], got(1)).alias("only_a"), F.concat(state["only_b"], got(-1)).alias("only_b"))

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(11)),
        F.struct(start.alias("cells"), none.alias("only_a"), none.alias("only_b")),
        step,
        lambda s: F.struct((~F.exists(s["cells"], lambda c: (c["n"] != 0) | (c["digest"] != 0))).alias("complete"), s["only_a"].alias("only_a"), s["only_b"].alias("only_b")),
    )


# ---- sketches of any size, a row for each cell that is not empty ---------------------------


def _cell(digest: Column, sub: int, width: Column, seed: int) -> Column:
    """The cell of a digest in a sub-table of ``width`` cells; the number holds the width too."""
    return F.shiftleft(width, 32).bitwiseOR(F.pmod(F.xxhash64(digest, F.lit(1000 * seed + sub)), width) * 3 + sub)


def _width(cell: Column) -> Column:
    return F.shiftright(cell, 32)


def _sub(cell: Column) -> Column:
    return cell.bitwiseAND(_long(0xFFFFFFFF)) % 3


_VALUES = ("c1", "x1", "c2", "x2")


def _gather(rows: DataFrame) -> DataFrame:
    aggs = [F.sum(k).alias(k) if k[0] == "c" else F.bit_xor(k).alias(k) for k in _VALUES]
    return rows.groupBy(*_KEY, "cell").agg(*aggs).where("c1 != 0 or x1 != 0 or c2 != 0 or x2 != 0")


def subtracted(rows: DataFrame, seed: int) -> DataFrame:
    """The cells of two differences: own less edited (c1, x1), own less next (c2, x2).

    ``rows`` have the document's key, ``width`` and the digests of the three texts.
    """
    put = rows.select(*_KEY, "width", F.size("own").alias("n0"), (F.size("own") + F.size("edited")).alias("n1"), F.posexplode(F.concat("own", "edited", "next")).alias("at", "d"))
    own, edited = F.col("at") < F.col("n0"), F.col("at") < F.col("n1")
    c1 = F.when(own, 1).when(edited, -1).otherwise(0).cast("long")
    c2 = F.when(own, 1).when(edited, 0).otherwise(-1).cast("long")
    put = put.select(*_KEY, "width", "d", c1.alias("c1"), c2.alias("c2"), F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("sub"))
    cell = F.when(F.col("sub") == 0, _cell(F.col("d"), 0, F.col("width"), seed)).when(F.col("sub") == 1, _cell(F.col("d"), 1, F.col("width"), seed)).otherwise(_cell(F.col("d"), 2, F.col("width"), seed))
    held = lambda c: F.when(F.col(c) != 0, F.col("d")).otherwise(_long(0))
    return _gather(put.select(*_KEY, cell.alias("cell"), "c1", held("c1").alias("x1"), "c2", held("c2").alias("x2")))


def peeled(cells: DataFrame, sub: int, seed: int) -> DataFrame:
    """Takes what the pure cells of one sub-table hold out of all cells.

    A cell that is not pure passes as it is; for a pure one rows are made by number:
    0 what the cell keeps, 1 and 2 the first difference's digest in the other
    sub-tables (with the second's, where it is the same), 3 and 4 the second's, 5 the tally.
    """
    col = F.col
    mine = (_sub(col("cell")) == sub) & (col("cell") >= 0)
    pure = lambda c, x: mine & (F.abs(c) == 1) & _fits(col(x)) & (_cell(col(x), sub, _width(col("cell")), seed) == col("cell"))
    marked = cells.select(*_KEY, "cell", *_VALUES, pure("c1", "x1").alias("p1"), pure("c2", "x2").alias("p2"))
    p1, p2 = col("p1"), col("p2")
    same = p1 & p2 & (col("x1") == col("x2"))
    numbers = lambda *k: F.array(*(F.lit(v) for v in k))
    codes = (
        F.when(~p1 & ~p2, numbers(0))
        .when(same, numbers(1, 2, 5))
        .when(p1 & p2, numbers(1, 2, 3, 4, 5))
        .when(p1, F.when((col("c2") == 0) & (col("x2") == 0), numbers(1, 2, 5)).otherwise(numbers(0, 1, 2, 5)))
        .otherwise(F.when((col("c1") == 0) & (col("x1") == 0), numbers(3, 4, 5)).otherwise(numbers(0, 3, 4, 5)))
    )
    put = marked.select(*_KEY, "cell", *_VALUES, "p1", "p2", same.alias("same"), F.explode(codes).alias("k"))
    k, width = col("k"), _width(col("cell"))
    other = [j for j in range(3) if j != sub]
    first, second = k.isin(1, 2), k.isin(3, 4)
    digest = F.when(first, col("x1")).otherwise(col("x2"))
    cell = F.when(k == 0, col("cell")).when(k == 5, _long(_TALLY)).when(k.isin(1, 3), _cell(digest, other[0], width, seed)).otherwise(_cell(digest, other[1], width, seed))
    kept = lambda p, v: F.when(col(p), _long(0)).otherwise(col(v))
    size = lambda p, x: F.when(col(p), length_of(col(x))).otherwise(_long(0))
    none = _long(0)
    values = [
        F.when(k == 0, kept("p1", "c1")).when(first, -col("c1")).when(k == 5, size("p1", "x1")).otherwise(none).alias("c1"),
        F.when(k == 0, kept("p1", "x1")).when(first, col("x1")).otherwise(none).alias("x1"),
        F.when(k == 0, kept("p2", "c2")).when(second | (first & col("same")), -col("c2")).when(k == 5, size("p2", "x2")).otherwise(none).alias("c2"),
        F.when(k == 0, kept("p2", "x2")).when(second | (first & col("same")), col("x2")).otherwise(none).alias("x2"),
    ]
    return _gather(put.select(*_KEY, cell.alias("cell"), *values))


# ---- documents, their edited texts and the next ones ---------------------------------------


def _neighbours(base: DataFrame) -> tuple[DataFrame, bool]:
    """For each document: half (code points to replace), and the document before it with its half.

    The ids are sorted once, dealt by ranges; the neighbour across a border of two
    ranges is looked up in a table of one row for each range.
    """
    spark = base.sparkSession
    ids = base.groupBy(*_KEY).agg(F.max(F.char_length("text")).alias("n"), F.count(F.lit(1)).alias("copies"))
    order = [F.col("dk"), F.col("rid")]
    dealt = ids.repartitionByRange(*order).sortWithinPartitions(*order)
    row = materialise(spark, dealt.select(*_KEY, "n", "copies", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seq")))
    # one row for each range of ids: their number is that of the partitions
    ends = row.groupBy("part").agg(F.min("seq").alias("low"), F.max("seq").alias("high"), F.max("copies").alias("copies")).orderBy("part").collect()
    follow = [(ends[k]["high"], ends[(k + 1) % len(ends)]["low"]) for k in range(len(ends))]
    border = spark.createDataFrame(follow, "high long, low long")
    to = row.join(F.broadcast(border), F.col("seq") == F.col("high"), "left").select(
        F.col("dk").alias("pred_dk"), F.col("rid").alias("pred_rid"), F.floor(F.col("n") / 2).cast("int").alias("pred_half"), F.coalesce("low", F.col("seq") + 1).alias("seq")
    )
    link = to.join(row.select(*_KEY, F.floor(F.col("n") / 2).cast("int").alias("half"), "seq"), "seq").drop("seq")
    link = materialise(spark, link)
    discard(row)
    return link, any(e["copies"] > 1 for e in ends)


def _pairs(base: DataFrame, link: DataFrame, attempt: int) -> DataFrame:
    """A row for each document of ``link``'s predecessors: results of one attempt."""
    seed = attempt + 1
    # many small tasks: each holds the cells of its documents in several aggregates at once
    parts = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")) * (FINER if attempt == 0 else 1)
    # hashed joins: no sort holds memory that the aggregates of the same tasks need
    near = link.select(*_KEY, "half", "pred_dk", "pred_rid", "pred_half").repartition(parts, *_KEY)
    own = base.repartition(parts, *_KEY).join(near.hint("shuffle_hash"), _KEY)
    sent = own.select(F.col("pred_dk").alias("to_dk"), F.col("pred_rid").alias("to_rid"), F.expr("left(text, pred_half)").alias("prefix"), units(F.col("text")).alias("next"))
    sent = sent.repartition(parts, "to_dk", "to_rid")
    both = own.select(*_KEY, "text", "half").join(sent.hint("shuffle_hash"), (F.col("dk") == F.col("to_dk")) & (F.col("rid") == F.col("to_rid")))
    edited = F.concat(F.expr("left(text, char_length(text) - half)"), F.col("prefix"))
    texts = both.select(*_KEY, "text", edited.alias("edited_text"), "next")
    sets = texts.select(*_KEY, "text", "edited_text", units(F.col("text")).alias("own"), units(F.col("edited_text")).alias("edited"), "next")
    about = sets.select(
        *_KEY,
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited_text", 256).alias("edited_sha256"),
        written(F.col("text"), small_sketch(F.col("own"))).alias("fingerprint"),
        written(F.col("edited_text"), small_sketch(F.col("edited"))).alias("edited_fingerprint"),
        (text_of(F.col("own")) + text_of(F.col("edited"))).alias("both1"),
        (text_of(F.col("own")) + text_of(F.col("next"))).alias("both2"),
    )
    width = F.ceil((F.size("own") + F.greatest(F.size("edited"), F.size("next"))) * (CELLS << attempt) / 3).cast("long") + SPARE
    cells = subtracted(sets.select(*_KEY, "own", "edited", "next", width.alias("width")), seed)
    for step in range(STEPS):
        cells = peeled(cells, step % 3, seed)
    tally = F.col("cell") == _TALLY
    left = lambda c, x: F.max(F.when(~tally & ((F.col(c) != 0) | (F.col(x) != 0)), 1).otherwise(0))
    apart = cells.groupBy(*_KEY).agg(
        F.sum(F.when(tally, F.col("c1"))).alias("d1"), F.sum(F.when(tally, F.col("c2"))).alias("d2"), F.greatest(left("c1", "x1"), left("c2", "x2")).alias("left")
    )
    out = about.join(apart.hint("shuffle_hash"), _KEY, "left")
    like = lambda d, both: F.when(F.col(both) == 0, F.lit(1.0)).otherwise(1 - F.coalesce(d, F.lit(0)) / F.col(both))
    return out.select(
        *_KEY,
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        like("d1", "both1").alias("near_edited"),
        like("d2", "both2").alias("near_next"),
        F.lit(attempt + 1).alias("attempts"),
        (F.coalesce("left", F.lit(0)) == 1).alias("failed"),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likenesses."""
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    base = base.select(F.coalesce("doc_id", F.lit(_NULL)).alias("dk"), F.xxhash64("text").alias("rid"), "text")
    link, copies = _neighbours(base)
    single = base.dropDuplicates(_KEY) if copies else base
    todo, part, wanted, done, attempt = link, single, None, [], 0
    while True:
        got = _pairs(part, todo, attempt)
        if wanted is not None:
            got = got.join(wanted, _KEY, "left_semi")
        got = materialise(spark, got)
        done.append(got.where("not failed"))
        wanted = got.where("failed").select(*_KEY)
        n = wanted.count()
        if not n:
            break
        # those to sketch again, with the ones next to them
        nexts = link.join(wanted.toDF("pred_dk", "pred_rid"), ["pred_dk", "pred_rid"], "left_semi").select(*_KEY)
        some = wanted.union(nexts).distinct()
        some = F.broadcast(some) if n <= BROADCAST_ROWS else some
        part, todo, attempt = single.join(some, _KEY, "left_semi"), link.join(some, _KEY, "left_semi"), attempt + 1
    out = reduce(DataFrame.unionByName, done).drop("failed").withColumn("doc_id", F.when(F.col("dk") != _NULL, F.col("dk")))
    if copies:
        out = base.select(*_KEY).join(out, _KEY)
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "attempts")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
