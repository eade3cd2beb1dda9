"""Ordered and within-group operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrystone.functions.scalar import half_even
from quarrystone.sources.shared import scratch

PERCENTILE_MIN = 5
SAMPLE_POINTS = 40
#: Width of the ranges of scores whose totals are summed first.
BIN_WIDTH = 10
#: Rows of a sketch of quantiles for each of its bounds, and groups up to which all scores are counted.
ACCURACY = 2000
#: Rows of a table that is looked up by which it is broadcast.
BROADCAST_ROWS = 500_000
#: Jumps of a median between neighbouring cycles that need an explanation.
JUMP_UP, JUMP_DOWN = 1.8, 0.55
SCALE_CHANGE = ("2023", "2024")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table of the application's shared folder: computed once, and its lineage ends there."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup(rows: DataFrame, table: DataFrame, keys: tuple[str, ...], how: str = "inner", small: bool | None = None) -> DataFrame:
    """``rows`` with the columns of ``table`` (one row a key, of ``written``; null keys are equal).

    Up to ``BROADCAST_ROWS`` rows of it are broadcast; ``small``: whether it has no more, where that is known.  Beyond, both sides of the join are plain shuffles, in which adaptive
    execution splits keys that very many rows hold.
    """
    named = table.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys))
    return rows.join(F.broadcast(named) if (table.count() <= BROADCAST_ROWS if small is None else small) else named, same, how).drop(*(f"_of_{k}" for k in keys))


def lower_counts(rows: DataFrame, keys: tuple[str, ...], score: str = "score", width: float = BIN_WIDTH) -> DataFrame:
    """keys, score, count, lower, n: of each distinct score how many rows have it, how many of the group are lower, and the group's size.

    No row is ranked: equal scores are counted first (combined before the shuffle, so a common one is no hot key).  Sums run
    over ranges of ``width`` and then over the distinct scores within one range, so no task sorts all scores of a group.
    """
    counts = rows.where(F.col(score).isNotNull()).groupBy(*keys, score).agg(F.count(F.lit(1)).alias("count")).withColumn("_range", F.floor(F.col(score) / width))
    group = Window.partitionBy(*keys)
    totals = counts.groupBy(*keys, "_range").agg(F.sum("count").alias("_in_range"))
    before = totals.select(*keys, "_range", (F.sum("_in_range").over(group.orderBy("_range")) - F.col("_in_range")).alias("_before"), F.sum("_in_range").over(group).alias("n"))
    inside = F.sum("count").over(Window.partitionBy(*keys, "_range").orderBy(score)) - F.col("count")
    placed = lookup(counts.withColumn("_inside", inside), written(before), (*keys, "_range"))
    return placed.select(*keys, score, "count", (F.col("_before") + F.col("_inside")).alias("lower"), "n")


def quantiles(rows: DataFrame, keys: tuple[str, ...], shares: dict[str, float], score: str = "score", accuracy: int = ACCURACY) -> DataFrame:
    """Exact interpolated quantiles of each group, by name, with n, low and high.

    A sketch of bounded size gives, for each share, two scores between which the quantile must lie (its error is at most
    ``1 / accuracy`` of the group, and they stand three times that to either side).  Then the scores below are counted,
    and the distinct ones between them: a few thousandths of a large group, all of a small one.
    """
    names = list(shares)
    scored = rows.where(F.col(score).isNotNull())
    apart = 3.0 / accuracy
    ends = F.percentile_approx(score, [min(1.0, max(0.0, p + d)) for p in shares.values() for d in (-apart, apart)], accuracy)
    stats = scored.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(score).alias("low"), F.max(score).alias("high"), ends.alias("_ends"))
    small = F.col("n") <= accuracy
    low = lambda k: F.when(small | F.lit(shares[names[k]] <= apart), F.col("low")).otherwise(F.element_at("_ends", 2 * k + 1))
    high = lambda k: F.when(small | F.lit(shares[names[k]] >= 1 - apart), F.col("high")).otherwise(F.element_at("_ends", 2 * k + 2))
    stats = stats.select(*keys, "n", "low", "high", F.array(*(F.struct(low(k).alias("from"), high(k).alias("to")) for k in range(len(names)))).alias("_between"))
    met = lookup(scored.select(*keys, score), written(stats), keys)
    # null: below the lower of the two; what is above the higher one does not matter
    places = [F.when(F.col(score) <= F.col("_between")[k]["to"], F.struct(F.lit(k).alias("share"), F.when(F.col(score) >= F.col("_between")[k]["from"], F.col(score)).alias("value"))) for k in range(len(names))]
    used = met.select(*keys, "n", "low", "high", F.explode(F.array_compact(F.array(*places))).alias("_p")).select(*keys, "n", "low", "high", "_p.*")
    counts = used.groupBy(*keys, "n", "low", "high", "share", "value").agg(F.count(F.lit(1)).alias("count"))
    upto = F.sum("count").over(Window.partitionBy(*keys, "share").orderBy(F.col("value").asc_nulls_first()))
    placed = counts.withColumn("_upto", upto)
    aggs = []
    for k, (name, share) in enumerate(shares.items()):
        place = (F.col("n") - 1) * F.lit(share)
        floor = F.floor(place)
        at = lambda p, k=k: F.max(F.when((F.col("share") == k) & (F.col("_upto") > p) & (F.col("_upto") - F.col("count") <= p), F.col("value")))
        aggs += [at(floor).alias(f"_{name}_0"), at(floor + 1).alias(f"_{name}_1"), F.max(place - floor).alias(f"_{name}_f")]
    out = placed.groupBy(*keys, "n", "low", "high").agg(*aggs)
    value = lambda name: F.col(f"_{name}_0") + F.col(f"_{name}_f") * (F.coalesce(f"_{name}_1", f"_{name}_0") - F.col(f"_{name}_0"))
    return out.select(*keys, "n", "low", *(value(name).alias(name) for name in names), "high")


def percentile_position(apps: DataFrame, keys: tuple[str, ...] = ("document", "program"), score: str = "score", digits: int | None = None, out: str = "percentile", width: float = BIN_WIDTH) -> DataFrame:
    """Share of the scores of a group that are strictly lower, in percent.

    Rows without a score, and groups of fewer than five, get null.
    """
    value = 100.0 * F.col("lower") / F.col("n")
    if digits is not None:
        value = half_even(value, digits)
    placed = lower_counts(apps, keys, score, width).where(F.col("n") >= PERCENTILE_MIN).select(*keys, score, value.alias(out))
    return lookup(apps, written(placed), (*keys, score), "left").select(*apps.columns, out)


def lowest_percentile(apps: DataFrame, keys: tuple[str, ...], which: Column, within: tuple[str, ...] = ("document", "program"), score: str = "score", out: str = "cutoff_percentile") -> DataFrame:
    """The lowest percentile position (E1, within ``within``) of the rows of each ``keys`` group that ``which`` takes.

    A position is the lower the score is, so only the lowest score of each part needs one: what is lower is counted.
    """
    rest = [k for k in keys if k not in within]
    least = apps.where(which & F.col(score).isNotNull()).groupBy(*within, *rest).agg(F.min(score).alias("_least"))
    # the bars of a part, in order, with the groups they belong to
    bars = written(least.groupBy(*within).agg(F.sort_array(F.collect_list(F.struct("_least", *rest))).alias("_bars")))
    # rows by the number of bars that they reach: what is below a bar reaches no more than those before it
    reached = F.size(F.filter("_bars", lambda b: b["_least"] <= F.col(score)))
    small = bars.count() <= BROADCAST_ROWS
    counts = lookup(apps.where(F.col(score).isNotNull()).select(*within, score), bars, within, small=small).groupBy(*within, reached.alias("_reached")).agg(F.count(F.lit(1)).alias("_count"))
    each = counts.groupBy(*within).agg(F.sum("_count").alias("n"), F.collect_list(F.struct("_reached", "_count")).alias("_counts"))
    each = lookup(each, bars, within, small=small).select(*within, "n", "_counts", F.posexplode("_bars").alias("_k", "_bar"))
    lower = F.aggregate(F.filter("_counts", lambda c: c["_reached"] <= F.col("_k")), F.lit(0).cast("long"), lambda acc, c: acc + c["_count"])
    named = [F.col(k) if k in within else F.col(f"_bar.{k}").alias(k) for k in keys]
    return each.where(F.col("n") >= PERCENTILE_MIN).select(*named, (100.0 * lower / F.col("n")).alias(out)).groupBy(*keys).agg(F.min(out).alias(out))


def yoy_delta(counts: DataFrame, value: str = "applications", key: str = "program", order: str = "cycle") -> DataFrame:
    """Change in percent against the cycle before in which the programme exists."""
    w = Window.partitionBy(key).orderBy(order)
    before = F.lag(value).over(w)
    return counts.withColumn("previous", before).where("previous is not null and previous != 0").withColumn("delta_pct", 100.0 * (F.col(value) - F.col("previous")) / F.col("previous"))


def kpi_change(series: DataFrame, values: tuple[str, ...], order: str = "cycle") -> DataFrame:
    """Change against the cycle before in the list of all cycles; null where that is zero or absent.

    ``series`` has a row for each cycle, so the one ordered pass is over a handful of rows.
    """
    w = Window.orderBy(order)
    changes = [F.when(F.lag(v).over(w) != 0, 100.0 * (F.col(v) - F.lag(v).over(w)) / F.lag(v).over(w)).alias(f"{v}_change_pct") for v in values]
    return series.select("*", *changes)


def sample_points(rows: DataFrame, keys: tuple[str, ...], score: str = "score", most: int = SAMPLE_POINTS, width: float = BIN_WIDTH) -> DataFrame:
    """Of each group's sorted scores every ``max(1, n div most)``-th, ``most`` of them, as rows."""
    placed = lower_counts(rows.select(*keys, score), keys, score, width).where("n >= 5").withColumn("_step", F.greatest(F.lit(1), F.floor(F.col("n") / most)))
    # the sampled places that lie among the rows of one score
    first = F.ceil(F.col("lower") / F.col("_step"))
    last = F.least(F.floor((F.col("lower") + F.col("count") - 1) / F.col("_step")), F.lit(most - 1))
    return placed.where(first <= last).select(*keys, F.explode(F.sequence(first, last)).alias("point"), score)


def median_jumps(medians: DataFrame, key: str = "program", order: str = "cycle", value: str = "median_score") -> DataFrame:
    """E5: jumps of the median between neighbouring cycles, those of the scale change marked."""
    w = Window.partitionBy(key).orderBy(order)
    pairs = medians.select(key, F.lag(order).over(w).alias("from_cycle"), F.col(order).alias("to_cycle"), (F.col(value) / F.nullif(F.lag(value).over(w), F.lit(0.0))).alias("ratio"))
    pairs = pairs.where("ratio is not null")
    scale = (F.col("from_cycle") == SCALE_CHANGE[0]) & (F.col("to_cycle") == SCALE_CHANGE[1])
    return pairs.select("*", scale.alias("scale_change"), ((F.col("ratio") > JUMP_UP) | (F.col("ratio") < JUMP_DOWN)).alias("jump"))


def share_of_total(rows: DataFrame, value: str, within: tuple[str, ...] = (), out: str = "share") -> DataFrame:
    """Share of the sum of all rows (of each ``within`` group)."""
    if within:
        return rows.withColumn(out, F.col(value) / F.sum(value).over(Window.partitionBy(*within)))
    total = rows.agg(F.sum(value).alias("_total"))
    return rows.join(F.broadcast(total)).withColumn(out, F.col(value) / F.col("_total")).drop("_total")


def ratio_to_max(rows: DataFrame, value: str, within: tuple[str, ...], out: str = "to_max") -> DataFrame:
    """E7"""
    return rows.withColumn(out, F.col(value) / F.max(value).over(Window.partitionBy(*within)))


def _pick(rows: DataFrame, keys: tuple[str, ...], pick, order: str) -> DataFrame:
    """The row of each key that ``pick`` (max_by, min_by) takes: combined before the shuffle, nothing is sorted."""
    rest = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(pick(F.struct(*rest), F.col(order)).alias("_row"))
    return picked.select(*(F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in rows.columns))


def last_wins(rows: DataFrame, keys: tuple[str, ...], order: str = "row_seq") -> DataFrame:
    """Of rows with equal keys the last in source order."""
    return _pick(rows, keys, F.max_by, order)


def first_wins(rows: DataFrame, keys: tuple[str, ...], order: str = "row_seq") -> DataFrame:
    """Of rows with equal keys the first in source order."""
    return _pick(rows, keys, F.min_by, order)


def duplicate_ranks(rows: DataFrame, block: tuple[str, ...], rank: str = "merit_rank") -> DataFrame:
    """Ranks that occur more than once in a block."""
    return rows.where(F.col(rank).isNotNull()).groupBy(*block, rank).agg(F.count(F.lit(1)).alias("times")).where("times > 1")


def late_starts(rows: DataFrame, block: tuple[str, ...], rank: str = "merit_rank") -> DataFrame:
    """Blocks whose first rank is not 1."""
    return rows.where(F.col(rank).isNotNull()).groupBy(*block).agg(F.min(rank).alias("first_rank")).where("first_rank <> 1")
