"""Joins with semantics of their own: gaps, reports of what did not match, name resolution."""

from __future__ import annotations

import bisect
import math
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrystone.functions.similarity import ratio
from quarrystone.operators import windows
from quarrystone.operators.classify import is_program
from quarrystone.sources.shared import remove, scratch

FUZZY_CUTOFF = 0.92


def first_origin(*sources: tuple[str, DataFrame], key: str = "document") -> DataFrame:
    """The union of sources; a key that several have keeps the earliest source."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.withColumn("origin", F.lit(name)).withColumn("_order", F.lit(k)) for k, (name, df) in enumerate(sources)))
    return windows.first_wins(every, (key,), "_order").drop("_order")


def known_names(*sources: DataFrame, column: str = "program") -> DataFrame:
    """All names that any of the sources has, once."""
    return reduce(DataFrame.union, (s.select(column) for s in sources)).where(F.col(column).isNotNull()).distinct()


def with_manifest(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows with what the manifest says of their document, if anything."""
    return rows.join(manifest, "document", "left")


def canonical(rows: DataFrame, mapping: DataFrame, column: str = "program") -> DataFrame:
    """Names replaced by their canonical form, others unchanged."""
    m = mapping.select(F.col("form").alias(column), F.col("canonical").alias("_canonical"))
    return rows.join(m, column, "left").withColumn(column, F.coalesce("_canonical", column)).drop("_canonical")


def flag_member(rows: DataFrame, members: DataFrame, key: str = "document", out: str = "is_member") -> DataFrame:
    """Whether the key is in a set."""
    return rows.join(members.select(key).distinct().withColumn(out, F.lit(True)), key, "left").withColumn(out, F.coalesce(out, F.lit(False)))


def rank_gaps(rows: DataFrame, block: tuple[str, ...], rank: str = "merit_rank") -> DataFrame:
    """Ranks from 1 to the highest of a block that no row has.

    The highest rank of the block comes along.  Gaps are found between neighbouring
    ranks, so only missing ranks are made, not all of 1..max; null keys equal null.
    """
    present = rows.where(F.col(rank) >= 1).select(*block, rank).distinct()
    w = Window.partitionBy(*block).orderBy(rank)
    steps = present.withColumn("_before", F.coalesce(F.lag(rank).over(w), F.lit(0))).withColumn("block_max", F.max(rank).over(Window.partitionBy(*block)))
    holes = steps.where(F.col(rank) - F.col("_before") > 1)
    return holes.select(*block, F.explode(F.sequence(F.col("_before") + 1, F.col(rank) - 1)).alias("missing_rank"), "block_max")


#: Lines of one range of a document, or so.
PART_LINES = 200_000


def text_blocks(lines: DataFrame, program: str = "program", size: int = PART_LINES) -> DataFrame:
    """P10: for each appearance of a programme as a line, the ranks listed below it.

    ``lines``: document, line_no, line, with ``program`` the title the line equals (or null).
    A block runs from its title to the first line without a rank after the first rank.

    Lines are cut into ranges of about ``size`` by document and number, so no document is a group.  All that a line needs
    are counts of the lines up to it, within its range and then by the totals of the ranges before: a block has ended where
    the last line without a rank has more ranks up to it than stood before the title.
    """
    rank = F.when(F.trim("line").rlike(r"^\d{1,4}\s"), F.regexp_extract(F.trim("line"), r"^(\d{1,4})\s", 1).cast("int"))
    rows = lines.select("document", "line_no", F.col(program).alias("program"), rank.alias("rank"))
    spark, path = lines.sparkSession, scratch(lines.sparkSession)
    rows.write.option("maxRecordsPerFile", size).parquet(path)
    marked = spark.read.schema(rows.schema).parquet(path)
    n = max(1, -(-marked.count() // size))
    # files and ranges by number: what is cut by bytes holds very many short lines
    ranges = marked.repartitionByRange(n, "document", "line_no").withColumn("_part", F.spark_partition_id()).repartition(n, "_part")
    w = Window.partitionBy("_part", "document").orderBy("line_no")
    same = Window.partitionBy("_part", "document", "line_no")
    placed = ranges.withColumns({"_titles": F.count("program").over(w), "_ranks": F.count("rank").over(w), "_title": F.last("program", ignorenulls=True).over(w), "_same": F.count("rank").over(same)})
    before_title = F.max(F.when(F.col("program").isNotNull(), F.col("_ranks") - F.col("_same"))).over(w)
    other, last = F.max(F.when(F.col("rank").isNull(), F.col("_ranks"))).over(w), F.lead(F.lit(True)).over(w).isNull()
    placed = placed.withColumns({"_before_title": before_title, "_other": other, "_last": last})
    placed = windows.written(placed.select("document", "_part", "rank", "_titles", "_ranks", "_title", "_before_title", "_other", "_last"))
    remove(spark, path)
    earlier = Window.partitionBy("document").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    upto = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    totals = placed.where("_last").withColumns({"_titles_0": upto("_titles"), "_ranks_0": upto("_ranks"), "_title_0": F.last("_title", ignorenulls=True).over(earlier)})
    highest = lambda c: F.max(F.col("_ranks_0") + F.col(c)).over(earlier)
    carried = totals.select("document", "_part", "_titles_0", "_ranks_0", "_title_0", highest("_before_title").alias("_before_title_0"), highest("_other").alias("_other_0"))
    met = windows.lookup(placed.where("rank is not null"), windows.written(carried), ("document", "_part"))
    begins = F.coalesce(F.col("_ranks_0") + F.col("_before_title"), "_before_title_0")
    ended = F.coalesce(F.greatest(F.col("_ranks_0") + F.col("_other"), "_other_0") > begins, F.lit(False))
    met = met.withColumn("block_no", F.col("_titles_0") + F.col("_titles")).where((F.col("block_no") > 0) & ~ended)
    return met.select("document", "block_no", F.coalesce("_title", "_title_0").alias("program"), "rank")


def gap_origin(gaps: DataFrame, blocks: DataFrame) -> DataFrame:
    """Q9: gaps that the source has too are its own; the others are losses (or unverified)."""
    tops = blocks.groupBy("document", "block_no", "program").agg(F.max("rank").alias("block_max"))
    first = tops.groupBy("document", "program", "block_max").agg(F.min("block_no").alias("block_no"))
    found = gaps.join(first, ["document", "program", "block_max"], "left")
    asked = ["document", "block_no", "missing_rank"]
    # of the ranks of all blocks only those asked for are sorted or kept
    hit = blocks.select("document", "block_no", F.col("rank").alias("missing_rank")).join(found.select(*asked), asked, "left_semi").distinct().withColumn("_printed", F.lit(True))
    joined = found.join(hit, asked, "left")
    label = F.when(F.col("block_no").isNull(), "unverified").when(F.col("_printed"), "lost").otherwise("source")
    return joined.withColumn("origin", label).drop("_printed")


def cross_and_report(left: DataFrame, right: DataFrame, key: Column, keys: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Rows that meet on a normalised key, and rows of the left that meet nothing."""
    a, b = left.withColumn("_key", key), right.withColumn("_key", key)
    on = [*keys, "_key"]
    return a.join(b.select(*on, *(c for c in b.columns if c not in a.columns)), on).drop("_key"), a.join(b.select(*on), on, "left_anti").drop("_key")


def orphans(rows: DataFrame, parents: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Distinct keys that have no parent."""
    p = parents.select(F.col(parent_key or key).alias(key))
    return rows.select(key).join(p, key, "left_anti").distinct()


def reconcile(left: DataFrame, right: DataFrame, keys: tuple[str, ...], values: tuple[str, ...], fill: float | None = 0, eps: float = 0.0) -> DataFrame:
    """Keys whose values differ or that one side lacks, with both sides' values."""
    a = left.select(*keys, *(F.col(v).alias(f"left_{v}") for v in values), F.lit(True).alias("in_left"))
    b = right.select(*keys, *(F.col(v).alias(f"right_{v}") for v in values), F.lit(True).alias("in_right"))
    both = a.join(b, list(keys), "full_outer").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("in_left", "in_right")})
    if fill is not None:
        both = both.withColumns({f"{s}_{v}": F.coalesce(f"{s}_{v}", F.lit(fill)) for s in ("left", "right") for v in values})
    differs = reduce(lambda x, y: x | y, (F.abs(F.col(f"left_{v}") - F.col(f"right_{v}")) > eps for v in values))
    return both.where(differs | ~F.col("in_left") | ~F.col("in_right"))


def missing_keys(left: DataFrame, right: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Keys of the left that the right lacks."""
    return left.select(*keys).distinct().join(right.select(*keys), list(keys), "left_anti")


def slope(counts: DataFrame, cycles: DataFrame, value: str = "applications") -> DataFrame:
    """Programmes of a cycle and of the cycle before it in the list of all cycles."""
    order = Window.orderBy("cycle")
    previous = F.broadcast(cycles.select("cycle", F.lag("cycle").over(order).alias("previous_cycle")).where("previous_cycle is not null"))
    now = counts.select("cycle", "program", F.col(value).alias("now")).join(previous, "cycle")
    before = counts.select(F.col("cycle").alias("previous_cycle"), "program", F.col(value).alias("before"))
    return now.join(before, ["previous_cycle", "program"])


def flat_export(base: DataFrame, *others: DataFrame) -> DataFrame:
    """All figures of (cycle, program) in one row."""
    return reduce(lambda a, b: a.join(b, ["cycle", "program"], "left"), others, base)


def by_length(names: DataFrame, column: str = "program") -> DataFrame:
    """distinct names, the longest first, so that a longer name is tried before one it begins with."""
    return names.select(column).distinct().withColumn("n", F.char_length(column).cast("long")).orderBy(F.col("n").desc(), column)


def prefix_resolve(forms: DataFrame, catalogue: DataFrame, least: int = 5) -> DataFrame:
    """A truncated form stands for the only catalogue name that begins with it.

    Every prefix of a catalogue name is made once, so the join is on equality.
    """
    names = catalogue.select("program").distinct()
    prefixes = names.select("program", F.explode(F.sequence(F.lit(least), F.greatest(F.lit(least), F.char_length("program")))).alias("n")).where("n <= char_length(program)").select("program", F.expr("left(program, n)").alias("form"))
    hits = forms.select("form").distinct().join(prefixes.hint("merge"), "form").groupBy("form").agg(F.count(F.lit(1)).alias("n"), F.min("program").alias("canonical"))
    exact = forms.select("form").distinct().join(names.select(F.col("program").alias("form")), "form", "left_semi").select("form", F.col("form").alias("canonical"))
    return hits.where("n = 1").select("form", "canonical").join(exact.select("form"), "form", "left_anti").unionByName(exact)


def _width(n: int) -> int:
    """How many lengths are in the class of a length: one below 64, and then so many that 32 classes double a length."""
    return 1 << max(0, n.bit_length() - 6)


def _reach(of_forms: list[int], of_names: list[int], cutoff: float) -> list[tuple[int, int, int, int, int]]:
    """(class, length of a name, pieces, lost, gained): what forms of a class of lengths and names of a length, whose ratio
    can be ``cutoff``, have to share.

    Of n + m characters of both an even or odd number is unmatched, as n + m is; at most ``lost`` of them are of the form
    and ``gained`` of the name.
    """
    classes: dict[int, list[int]] = {}
    for n in of_forms:
        classes.setdefault(n - n % _width(n), []).append(n)
    out = []
    for c, held in classes.items():
        low, high = held[0] * cutoff / (2 - cutoff) - 1, held[-1] * (2 - cutoff) / cutoff + 1
        for m in of_names[bisect.bisect_left(of_names, low) : bisect.bisect_right(of_names, high)]:
            unmatched = [(n, n + m - 2 * math.ceil(cutoff * (n + m) / 2 - 1e-9)) for n in held]
            near = [(n, u) for n, u in unmatched if abs(n - m) <= u]
            if near:
                most = max(u for _, u in near)
                out.append((c, m, most + 1, (most + near[-1][0] - m) // 2, (most + m - near[0][0]) // 2))
    return out


def _candidates(forms: DataFrame, names: DataFrame, cutoff: float) -> DataFrame:
    """The pairs of ``near_candidates``, of distinct forms and names; some more than once."""
    numbers = lambda rows, *columns: forms.sparkSession.createDataFrame(pa.Table.from_arrays([pa.array([r[k] for r in rows], pa.int32()) for k in range(len(columns))], columns))
    # no more lengths than the longest text has characters
    held, known = (sorted(r["n"] for r in t.select(F.char_length(c).alias("n")).distinct().where("n > 0").collect()) for t, c in ((forms, "form"), (names, "program")))
    reach = _reach(held, known, cutoff)
    pieces: dict[int, set[int]] = {}
    for c, _, k, _, _ in reach:
        pieces.setdefault(c, set()).add(k)
    cuts = [(n, c, k) for n in held for c in [n - n % _width(n)] for k in pieces.get(c, ())]

    edge = lambda i: F.floor(i * F.col("_class") / F.col("_pieces")).cast("int")
    piece = lambda text, moved: F.substr(text, edge(F.col("_piece")) + 1 + moved, edge(F.col("_piece") + 1) - edge(F.col("_piece")))
    # a digest for short rows that sort fast; what only shares a digest is too far apart
    key = lambda text, moved: F.xxhash64(piece(F.col(text), moved), "_class", "_pieces", "_piece").alias("_key")
    each = F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)).alias("_piece")
    asked = forms.withColumn("_n", F.char_length("form")).join(F.broadcast(numbers(cuts, "_n", "_class", "_pieces")), "_n").select("form", "_class", "_pieces", each)
    asked = asked.select(key("form", F.lit(0)), "form")
    index = names.withColumn("_m", F.char_length("program")).join(F.broadcast(numbers(reach, "_class", "_m", "_pieces", "_lost", "_gained")), "_m").select("program", "_class", "_pieces", "_lost", "_gained", each)
    # of i characters up to gained come in, and up to lost go
    come = F.explode(F.sequence(F.greatest(F.lit(0), F.col("_piece") - F.col("_lost")), F.least("_piece", "_gained"))).alias("_come")
    index = index.select("program", "_class", "_pieces", "_piece", come).select(key("program", 2 * F.col("_come") - F.col("_piece")), "program")
    # both sides are many times what the planner knows of the names: never broadcast
    unmatched = f"cast({1 - cutoff!r}D * (char_length(form) + char_length(program)) + 1e-9D as int)"
    return asked.join(index.hint("merge"), "_key").where(F.expr(f"levenshtein(form, program, {unmatched}) >= 0")).select("form", "program")


def near_candidates(forms: DataFrame, catalogue: DataFrame, cutoff: float = FUZZY_CUTOFF) -> DataFrame:
    """(form, program): all pairs whose ratio of matching blocks can be ``cutoff`` or more.

    A ratio of r leaves at most (1 - r) of the characters of both unmatched, say u.  A form is cut into u + 1 pieces, and the
    characters that it has to lose and to gain to become the name are counted from the left.  At the first piece i (from 0)
    by whose end there are no more than i of them, there were i before it and are none in it: it stands whole in the name,
    moved by -i, 2 - i .. i places.  So what meets shares the lengths, the number of the piece, the piece and one of few
    places, and no common piece is a hot key.  Of what meets, pairs of too many single edits are left out.
    """
    if cutoff < 0.9:
        raise ValueError("below 0.9 pieces are too short to be rare")
    return _candidates(forms.select("form").distinct(), catalogue.select("program").distinct(), cutoff).distinct()


def near_names(forms: DataFrame, catalogue: DataFrame, cutoff: float = FUZZY_CUTOFF) -> DataFrame:
    """C17: form and the catalogue name whose ratio of matching blocks is highest and ``cutoff`` at least.

    Only pairs of ``near_candidates`` are compared; nothing is collected, and no name is broadcast.  Names within a quarter
    of the distance come first, as their pieces are four times as long: a form that has one needs no other search.
    """
    if cutoff < 0.9:
        raise ValueError("below 0.9 pieces are too short to be rare")
    rest, names = windows.written(forms.select("form").distinct()), windows.written(catalogue.select("program").distinct())
    found = []
    for least in (1 - (1 - cutoff) / 4, cutoff):
        scored = _candidates(rest, names, least).withColumn("_ratio", ratio(F.col("form"), F.col("program"), least))
        # the cutoff after the best of a form: a condition on the ratio alone would have it worked out a second time
        best = scored.groupBy("form").agg(F.max(F.struct("_ratio", "program")).alias("best")).where(F.col("best._ratio") >= least)
        found.append(windows.written(best.select("form", F.col("best.program").alias("canonical"))))
        rest = rest.join(found[-1].select("form"), "form", "left_anti")
    return reduce(DataFrame.unionByName, found)


def resolve_programs(forms: DataFrame, catalogue: DataFrame, cutoff: float = FUZZY_CUTOFF) -> DataFrame:
    """Exact name, else unique prefix, else the closest name, else the form itself.

    Only distinct forms that nothing else resolved are compared with names.
    """
    usable = forms.select("form").distinct().where((F.char_length("form") >= 5) & is_program(F.col("form")))
    sure = prefix_resolve(usable, catalogue)
    rest = usable.join(sure.select("form"), "form", "left_anti")
    near = rest.join(near_names(rest, catalogue, cutoff), "form", "left").select("form", F.coalesce("canonical", "form").alias("canonical"))
    return sure.unionByName(near)
