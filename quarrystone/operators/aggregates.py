"""Conditional aggregates of applications; rates are given only on a trusted denominator."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone.operators import windows
from quarrystone.operators.classify import scale_of

# Thresholds of published figures.
RATE_MIN_ROWS = 15
TRUST_PCT = 25.0
BIN = 10
NEAR_FLOOR = 1.0
TRAJECTORY_CAP = 5
BOX_MIN = 5
MAIN_ROUTES = ["ordinario", "precatolica", "distancia", "rendimiento_superior", "beca"]


def with_outcome(apps: DataFrame) -> DataFrame:
    """Rows whose outcome is known either way."""
    return apps.where(F.col("admitted").isNotNull())


def nonzero(score: Column) -> Column:
    """Null for missing and for zero scores."""
    return F.when(score != 0, score)


def _pct_rejected() -> Column:
    return 100.0 * F.count_if(~F.col("admitted")) / F.count("admitted")


def outcome_counts(apps: DataFrame, keys: tuple[str, ...] = ("cycle", "program")) -> DataFrame:
    """D1, D3 without scores: applications, admitted, share of rejected and trust, in one aggregate that combines before its shuffle."""
    counted = with_outcome(apps).groupBy(*keys).agg(F.count(F.lit(1)).alias("applications"), F.count_if("admitted").alias("admitted"), _pct_rejected().alias("pct_rejected"))
    return counted.withColumn("trusted", F.col("pct_rejected") >= TRUST_PCT)


def _summary(apps: DataFrame, keys: tuple[str, ...], which: Column) -> DataFrame:
    rows = with_outcome(apps)
    score = nonzero(F.col("score"))
    found = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("applications"),
        F.count_if("admitted").alias("admitted"),
        _pct_rejected().alias("pct_rejected"),
        F.min(F.when(which, score)).alias("cutoff_score"),
        F.min_by(F.col("floor_score"), F.when(F.col("floor_score").isNotNull(), F.col("row_seq"))).alias("floor_score"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
    )
    if "percentile" in apps.columns:
        lowest = rows.groupBy(*keys).agg(F.min(F.when(which, F.col("percentile"))).alias("cutoff_percentile"))
    else:
        lowest = windows.lowest_percentile(apps, keys, F.col("admitted").isNotNull() & which)
    median = windows.quantiles(rows.where("score <> 0").select(*keys, "score"), keys, {"median_score": 0.5}).select(*keys, "median_score")
    # three aggregates by the same key
    for other in (lowest, median):
        named = other.withColumnsRenamed({k: f"_of_{k}" for k in keys})
        found = found.join(named, reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys)), "left").drop(*(f"_of_{k}" for k in keys))
    trusted = F.col("pct_rejected") >= TRUST_PCT
    rate = F.when((F.col("applications") >= RATE_MIN_ROWS) & trusted, 100.0 * F.col("admitted") / F.col("applications"))
    return found.withColumn("trusted", trusted).withColumn("admission_rate", rate).withColumn("scale", scale_of(F.col("cycle")))


def program_cycle_summary(apps: DataFrame, ordinary: str = "ordinario") -> DataFrame:
    """A programme in a cycle.  ``percentile`` (E1) is used where ``apps`` have it; else positions within
    (document, program) are counted for the lowest admitted scores only.

    All measures combine before the shuffle, and no row is ranked, so no task holds or sorts the scores of a group.
    """
    return _summary(apps, ("cycle", "program"), F.col("admitted") & (F.col("route") == ordinary))


def route_comparison(apps: DataFrame) -> DataFrame:
    """The same by route; the cutoff is that of all admitted of the route."""
    return _summary(apps, ("cycle", "program", "route"), F.col("admitted"))


def score_histogram(apps: DataFrame, width: int = BIN) -> DataFrame:
    """Applications by bin of ``width`` points and outcome; zero scores count."""
    low = (F.floor(F.col("score") / width) * width).cast("long")
    rows = with_outcome(apps).where("score is not null").withColumn("bin_from", low)
    return rows.groupBy("cycle", "program", "bin_from", "admitted").agg(F.count(F.lit(1)).alias("applications")).withColumn("bin_to", F.col("bin_from") + width)


def near_floor(apps: DataFrame, within: float = NEAR_FLOOR, both_sides: bool = False) -> DataFrame:
    """Rejected applications no more than ``within`` below the floor score (above it counts
    too, unless ``both_sides``)."""
    gap = F.col("floor_score") - F.col("score")
    near = F.abs(gap) <= within if both_sides else gap <= within
    rows = apps.where("not admitted and score is not null and floor_score is not null")
    found = rows.groupBy("cycle", "program").agg(F.count(F.lit(1)).alias("rejected"), F.count_if(near).alias("near"))
    return found.withColumn("near_pct", 100.0 * F.col("near") / F.col("rejected"))


def retry_trajectory(apps: DataFrame, cap: int = TRAJECTORY_CAP) -> DataFrame:
    """Persons by number of applications (capped) and whether one was admitted."""
    each = with_outcome(apps).where("person is not null").groupBy("person").agg(F.least(F.count(F.lit(1)), F.lit(cap)).alias("n"), F.bool_or("admitted").alias("ever_admitted"))
    label = F.when(F.col("n") < cap, F.col("n").cast("string")).otherwise(F.lit(f"{cap} o mas"))
    return each.groupBy("n", "ever_admitted").agg(F.count(F.lit(1)).alias("persons")).select(label.alias("applications"), "ever_admitted", "persons")


def seat_occupancy(seats: DataFrame, admitted: DataFrame) -> DataFrame:
    """Admitted by seats.  Both sides have (cycle, program_key); seats of zero are left out.

    ``crossed`` is that anyone was admitted; ``matched`` that the names met at all.
    """
    n = F.coalesce(F.col("admitted"), F.lit(0))
    joined = seats.where("seats > 0").join(admitted.select("cycle", "program_key", "admitted"), ["cycle", "program_key"], "left")
    return joined.select(
        "cycle",
        "program",
        "seats",
        n.alias("admitted"),
        (100.0 * n / F.col("seats")).alias("occupancy_pct"),
        F.greatest(F.lit(0), F.col("seats") - n).alias("free_seats"),
        (n > 0).alias("crossed"),
        F.col("admitted").isNotNull().alias("matched"),
        F.lit("provisional").alias("state"),
    )


def score_box(apps: DataFrame, keys: tuple[str, ...] = ("cycle", "program")) -> DataFrame:
    """Size, extremes and interpolated quartiles of admitted scores, groups of five or more."""
    rows = apps.where("admitted and score is not null").select(*keys, "score")
    return windows.quantiles(rows, keys, {"q1": 0.25, "median": 0.5, "q3": 0.75}).where(F.col("n") >= BOX_MIN)


def medians(apps: DataFrame, keys: tuple[str, ...] = ("cycle", "program")) -> DataFrame:
    """The mean of the two middle scores of each group."""
    return windows.quantiles(apps.select(*keys, "score"), keys, {"median_score": 0.5}).select(*keys, "median_score")


def route_pivot(routes: DataFrame, main: list[str] | None = None, left_out: str = "lista_aptos") -> DataFrame:
    """Admitted by programme in the main routes and all others, zero where none."""
    main = main or MAIN_ROUTES
    bucket = F.when(F.col("route").isin(*main), F.col("route")).otherwise("otras")
    rows = routes.where(F.col("route") != left_out).withColumn("bucket", bucket)
    return rows.groupBy("cycle", "program").pivot("bucket", [*main, "otras"]).agg(F.sum("admitted")).na.fill(0)


def outcome_pivot(histogram: DataFrame) -> DataFrame:
    """A bin's admitted and rejected side by side."""
    count = lambda is_in: F.sum(F.when(F.col("admitted") == is_in, F.col("applications")).otherwise(0))
    return histogram.groupBy("cycle", "program", "bin_from").agg(count(True).alias("n_admitted"), count(False).alias("n_rejected"))


def presence_matrix(rows: DataFrame, cycles: list[str]) -> DataFrame:
    """In which cycles a programme occurs, with first, last and number."""
    marks = [F.max(F.when(F.col("cycle") == c, 1).otherwise(0)).alias(f"in_{c}") for c in cycles]
    return rows.groupBy("program").agg(*marks, F.min("cycle").alias("first_cycle"), F.max("cycle").alias("last_cycle"), F.countDistinct("cycle").alias("n_cycles"))


def kpis(summary: DataFrame, keys: tuple[str, ...] = ("cycle",)) -> DataFrame:
    """Totals, and the rate over trusted rows only (a ratio of sums)."""
    when = lambda c: F.sum(F.when(F.col("trusted"), F.col(c)))
    return summary.groupBy(*keys).agg(
        F.sum("applications").alias("applications"),
        F.sum("admitted").alias("admitted"),
        F.count(F.lit(1)).alias("programs"),
        F.count_if("trusted").alias("trusted_programs"),
        (100.0 * when("admitted") / F.nullif(when("applications"), F.lit(0))).alias("trusted_rate"),
    )


def kpi_series(summary: DataFrame, cycles: DataFrame) -> DataFrame:
    """The figures of every cycle, those without rows as zero."""
    return cycles.join(kpis(summary), "cycle", "left").na.fill(0, ["applications", "admitted", "programs", "trusted_programs"])


def by_area(summary: DataFrame, areas: DataFrame) -> DataFrame:
    """Totals by area; programmes without one fall into Z."""
    # adaptive execution broadcasts the areas if they are small
    named = summary.join(areas, "program", "left").withColumn("area", F.coalesce("area", F.lit("Z")))
    return named.groupBy("cycle", "area").agg(F.sum("applications").alias("applications"), F.sum("admitted").alias("admitted")).where("applications > 0")


def route_totals(pivoted: DataFrame, routes: list[str]) -> DataFrame:
    """Back from columns to rows, summed by cycle and route."""
    rows = pivoted.unpivot(["cycle"], routes, "route", "admitted")
    return rows.groupBy("cycle", "route").agg(F.sum("admitted").alias("admitted"))


def merged_histogram(histogram: DataFrame) -> DataFrame:
    """Histograms of all programmes of a cycle together."""
    return histogram.groupBy("cycle", "bin_from", "admitted").agg(F.sum("applications").alias("applications"))


def near_rollup(near: DataFrame) -> DataFrame:
    """Near-floor counts of a cycle, as a ratio of sums."""
    return near.groupBy("cycle").agg(F.sum("rejected").alias("rejected"), F.sum("near").alias("near"), (100.0 * F.sum("near") / F.sum("rejected")).alias("near_pct"))


def extract_summary(rows: DataFrame) -> DataFrame:
    """Rows, programmes and floors of each document."""
    return rows.groupBy("document").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("program").alias("n_programs"), F.countDistinct("floor_score").alias("n_floors"))


def drop_counts(rows: DataFrame, catalogue: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose programme the catalogue has, and the count of others by document."""
    known = catalogue.select("program").distinct()
    return rows.join(known, "program", "left_semi"), rows.join(known, "program", "left_anti").groupBy("document").agg(F.count(F.lit(1)).alias("dropped"))


def loss_rate(dropped: DataFrame, kept: DataFrame, classes: DataFrame) -> DataFrame:
    """Share of rows lost, by class of document."""
    lost = dropped.groupBy("document").agg(F.sum("dropped").alias("lost"))
    have = kept.groupBy("document").agg(F.count(F.lit(1)).alias("have"))
    both = have.join(lost, "document", "full_outer").join(classes, "document", "left").na.fill(0, ["have", "lost"])
    return both.groupBy(F.coalesce("doc_class", F.lit("results")).alias("doc_class")).agg((100.0 * F.sum("lost") / F.sum(F.col("lost") + F.col("have"))).alias("lost_pct"))


def cycle_coverage(apps: DataFrame) -> DataFrame:
    """Rows and rejected share of each cycle, and whether it can be trusted."""
    found = apps.groupBy("cycle").agg(F.count(F.lit(1)).alias("n_rows"), F.count("admitted").alias("with_outcome"), _pct_rejected().alias("pct_rejected"))
    return found.withColumn("trusted", F.coalesce(F.col("pct_rejected") >= TRUST_PCT, F.lit(False)))


def distinct_ratio(apps: DataFrame, column: str = "person") -> DataFrame:
    """Distinct values by rows that have one."""
    return apps.agg(F.count(column).alias("with_value"), F.countDistinct(column).alias("distinct_values")).withColumn("ratio", F.col("distinct_values") / F.nullif("with_value", F.lit(0)))


def rows_per_page(rows: DataFrame) -> DataFrame:
    """D34"""
    return rows.groupBy("document", "page").agg(F.count(F.lit(1)).alias("n_rows"))


def vocabulary(rows: DataFrame, column: str) -> DataFrame:
    """D35"""
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("times"))


def totals(rows: DataFrame, keys: tuple[str, ...], *values: str) -> DataFrame:
    """Sums by key, for cross-footing."""
    return rows.groupBy(*keys).agg(*(F.sum(v).alias(v) for v in values))
