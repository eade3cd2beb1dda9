"""Data-quality rules: each gives the rows that violate it; a report has a row for each rule."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone.operators import aggregates, joins, windows
from quarrystone.operators.classify import empty_reason, holds_identity_number, in_exam_window, in_score_range, is_code, person_names

EPS = 0.001
BLOCK = ("document", "site", "subgroup", "program")


@dataclass(frozen=True)
class Rule:
    name: str
    violations: DataFrame
    level: str = "error"
    skipped: bool = False


def parts_differ(eps: float = EPS) -> Column:
    """Q1 of a row: both parts and the score are there, and do not add up."""
    total = F.coalesce("part_extra", F.lit(0.0)) + F.col("part_1") + F.col("part_2")
    return F.coalesce(F.abs(total - F.col("score")) > eps, F.lit(False))


def parts_add_up(rows: DataFrame, eps: float = EPS) -> DataFrame:
    """Q1"""
    return rows.where(parts_differ(eps))


def single_part_is_score(rows: DataFrame, eps: float = EPS) -> DataFrame:
    """In documents that publish both parts, a lone part equals the score."""
    both = rows.groupBy("document").agg(F.count("part_1").alias("a"), F.count("part_2").alias("b")).where("a > 0 and b > 0").select("document")
    lone = rows.where("score is not null and part_extra is null and (part_1 is null) <> (part_2 is null)")
    return lone.where(F.abs(F.coalesce("part_1", "part_2") - F.col("score")) > eps).join(both, "document", "left_semi")


def below_floor(eps: float = EPS) -> Column:
    """Q3 of a row: admitted below the floor."""
    return F.coalesce((F.col("condition") == "INGRESO") & (F.col("score") < F.col("floor_score") - eps), F.lit(False))


def above_floor(rows: DataFrame, eps: float = EPS) -> DataFrame:
    """Q3"""
    return rows.where(below_floor(eps))


def _ranked(rows: DataFrame, grain: DataFrame) -> DataFrame:
    plain = grain.where("grain = 'per_program' and doc_class = 'results'").select("document")
    return rows.where("merit_rank is not null and subgroup is not null").join(plain, "document", "left_semi")


def rank_starts_at_one(rows: DataFrame, grain: DataFrame) -> DataFrame:
    """Q4, C4"""
    return windows.late_starts(_ranked(rows, grain), BLOCK)


def rank_is_unique(rows: DataFrame, grain: DataFrame) -> DataFrame:
    """Q5, C4"""
    return windows.duplicate_ranks(_ranked(rows, grain), BLOCK)


def one_floor(rows: DataFrame, but: tuple[str, ...] = ()) -> DataFrame:
    """Q6, D15"""
    some = rows.where(F.col("floor_score").isNotNull())
    some = some.where(~F.col("document").isin(*but)) if but else some
    return some.groupBy("document", "site", "subgroup").agg(F.countDistinct("floor_score").alias("floors")).where("floors > 1")


def out_of_range() -> Column:
    """Q7 of a row"""
    return F.coalesce(~in_score_range(F.col("score")), F.lit(False))


def score_range(rows: DataFrame) -> DataFrame:
    """Q7"""
    return rows.where(out_of_range())


def code_form(rows: DataFrame) -> DataFrame:
    """Q8"""
    return rows.where((F.coalesce("code", F.lit("")) != "") & ~is_code(F.col("code")))


def sequence_complete(rows: DataFrame, source_gaps: DataFrame) -> DataFrame:
    """Q10: highest rank less ranks the source itself omits equals rows, by block."""
    keys = list(BLOCK)
    have = rows.where("merit_rank is not null").groupBy(*keys).agg(F.max("merit_rank").alias("top"), F.countDistinct("merit_rank").alias("have"))
    omitted = source_gaps.groupBy(*keys).agg(F.count(F.lit(1)).alias("omitted"))
    same = reduce(lambda a, b: a & b, (F.col(f"h.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys))
    both = have.alias("h").join(omitted.alias("o"), same, "left").select("h.*", F.coalesce("o.omitted", F.lit(0)).alias("omitted"))
    return both.where("top - omitted <> have")


def exam_dates(apps: DataFrame) -> DataFrame:
    """Q13"""
    return apps.where(~F.coalesce(in_exam_window(F.col("cycle"), F.col("exam_date")), F.lit(True)))


def gold_matches(gold: DataFrame, silver: DataFrame) -> DataFrame:
    """Q14, Q15, Q28, Q29, Q41: admitted and applications of every (cycle, program), both ways."""
    return joins.reconcile(gold, silver, ("cycle", "program"), ("applications", "admitted"))


def pseudonym_length(apps: DataFrame, digits: int = 16) -> DataFrame:
    """Q16"""
    return apps.where(F.col("person").isNotNull() & (F.char_length("person") != digits))


def pseudonym_ratio(apps: DataFrame, least: float = 0.3) -> DataFrame:
    """Q17"""
    return aggregates.distinct_ratio(apps).where(F.col("ratio") < least)


def no_name_column(apps: DataFrame, banned: tuple[str, ...] = ("name", "nombre")) -> DataFrame:
    """Q18: column names that must not be there."""
    found = [(c,) for c in apps.columns if c.lower() in banned]
    return apps.sparkSession.createDataFrame(found, "column string")


def unexplained_jumps(medians: DataFrame) -> DataFrame:
    """Q19"""
    return windows.median_jumps(medians).where("jump and not scale_change")


def content_hash(rows: DataFrame) -> DataFrame:
    """Q20: an order-independent digest; equal before and after a second run."""
    row = F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in sorted(rows.columns)))
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.bit_xor(row).alias("xor_hash"), F.bit_xor(F.xxhash64(row)).alias("xor_hash2"))


def chain_counts(audit: DataFrame, disk: DataFrame, parsed: DataFrame) -> DataFrame:
    """Documents that one of audit, disk and parser lacks."""
    every = audit.select("document").distinct().withColumn("a", F.lit(1))
    every = every.join(disk.select("document").distinct().withColumn("b", F.lit(1)), "document", "full_outer")
    every = every.join(parsed.select("document").distinct().withColumn("c", F.lit(1)), "document", "full_outer")
    return every.where("a is null or b is null or c is null")


def empty_documents(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Documents without rows, with the reason."""
    empty = docs.join(rows.select("document"), "document", "left_anti")
    redundant = F.col("redundant") if "redundant" in docs.columns else None
    return empty.select("document", empty_reason(F.col("text"), redundant).alias("reason"))


def unexplained(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Q22: documents without rows and without a reason."""
    return empty_documents(docs, rows).where("reason = 'sin explicar'")


def not_cited(texts: DataFrame, live: DataFrame) -> DataFrame:
    """Q26: figures (rule, figure) that stand in none of the documents.  Both are a handful."""
    whole = texts.agg(F.concat_ws("\n", F.collect_list("text")).alias("_text"))
    return live.join(F.broadcast(whole)).where(~F.contains("_text", F.col("figure"))).drop("_text")


def without_docstring(scripts: DataFrame) -> DataFrame:
    """Q26: scripts whose first statement is no text."""
    return scripts.where(~F.col("text").rlike(r"""\A(\s*#[^\n]*\n)*\s*[rR]?(\"\"\"|''')"""))


def examples(rules: list[Rule], k: int, order: str) -> DataFrame:
    """the first ``k`` violations of each rule."""
    first = (rule.violations.orderBy(order).limit(k).select(F.lit(rule.name).alias("rule"), *rule.violations.columns) for rule in rules)
    return reduce(DataFrame.unionByName, first)


def personal_data(lines: DataFrame, known: list[str] | None = None) -> DataFrame:
    """Q24: published lines with an identity number or a person's name."""
    names = person_names(F.col("line"), known)
    return lines.where(holds_identity_number(F.col("line")) | (F.size(names) > 0))


def unknown_names(lines: DataFrame, known: DataFrame, key: str = "document", column: str = "name") -> DataFrame:
    """(``key``, name) of each person's name in ``line`` that the catalogue ``known`` does not hold.

    Names are few beside the lines; they are told from the catalogue by an anti join, which is a broadcast only
    while the catalogue has no more rows than ``windows.BROADCAST_ROWS``.
    """
    found = lines.select(key, F.explode(person_names(F.col("line"))).alias("name")).distinct()
    names = known.select(F.col(column).alias("name")).where("name is not null").distinct()
    small = names.limit(windows.BROADCAST_ROWS + 1).count() <= windows.BROADCAST_ROWS
    return found.join(F.broadcast(names) if small else names, "name", "left_anti").select(key, "name")


def never_seen(catalogue: DataFrame, rows: DataFrame, column: str = "program") -> DataFrame:
    """Q39: names of the catalogue that no row has in any cycle."""
    return catalogue.select(column).distinct().join(rows.select(column), column, "left_anti")


def coverage(apps: DataFrame, catalogue: DataFrame, within: int = 3) -> DataFrame:
    """Q25: cycles whose number of programmes is far from the catalogue's."""
    have = apps.groupBy("cycle").agg(F.countDistinct("program").alias("have"))
    want = catalogue.groupBy("cycle").agg(F.countDistinct("program").alias("want"))
    return have.join(want, "cycle", "full_outer").na.fill(0, ["have", "want"]).where(F.abs(F.col("have") - F.col("want")) > within)


def page_counts(plain: DataFrame, parsed: DataFrame) -> DataFrame:
    """Pages whose rows differ between plain text and parser; pages without any are skipped."""
    both = joins.reconcile(plain, parsed, ("document", "page"), ("n_rows",))
    return both.where("left_n_rows <> 0 or right_n_rows <> 0").select("document", "page", "left_n_rows", "right_n_rows")


def without_area(rows: DataFrame, areas: DataFrame) -> DataFrame:
    """Q30"""
    return rows.select("program").distinct().join(areas, "program", "left_anti")


def delta_reproduced(published: DataFrame, counts: DataFrame, eps: float = 0.05) -> DataFrame:
    """Q31"""
    again = windows.yoy_delta(counts).select("cycle", "program", "delta_pct")
    return joins.reconcile(published, again, ("cycle", "program"), ("delta_pct",), fill=None, eps=eps)


def box_reproduced(published: DataFrame, apps: DataFrame, eps: float = 0.05) -> DataFrame:
    """Q32: size and extremes as recomputed, quartiles in order."""
    again = aggregates.score_box(apps)
    odd = joins.reconcile(published, again, ("cycle", "program"), ("n", "low", "high"), eps=eps).select("cycle", "program")
    return odd.union(published.where("not (low <= q1 and q1 <= median and median <= q3 and q3 <= high)").select("cycle", "program")).distinct()


def negative_scores(box: DataFrame) -> DataFrame:
    """Q33"""
    return box.where("low < 0")


def crossed_seats(payload: DataFrame, gold: DataFrame) -> DataFrame:
    """Q34, Q35: occupancies that the payload lacks or gives otherwise."""
    return joins.reconcile(payload, gold.where("crossed"), ("cycle", "program"), ("occupancy_pct",), fill=None, eps=0.01)


def routes_sum(routes: DataFrame, summary: DataFrame) -> DataFrame:
    """Q36: admitted of the routes (eligibility lists aside) against the record."""
    a = routes.where("route <> 'lista_aptos'").groupBy("cycle", "program").agg(F.sum("admitted").alias("admitted"))
    return joins.reconcile(a, summary, ("cycle", "program"), ("admitted",))


def areas_sum(areas: DataFrame, summary: DataFrame) -> DataFrame:
    """Q37"""
    return joins.reconcile(aggregates.totals(areas, ("cycle",), "applications"), aggregates.totals(summary, ("cycle",), "applications"), ("cycle",), ("applications",))


def announced_missing(announced: DataFrame, summary: DataFrame) -> DataFrame:
    """Q38: announced (cycle, program) without a row."""
    return joins.missing_keys(announced, summary, ("cycle", "program"))


def invented(payload: DataFrame, gold: DataFrame) -> DataFrame:
    """Q40"""
    return joins.missing_keys(payload, gold, ("cycle", "program"))


def histogram_sums(histogram: DataFrame, apps: DataFrame) -> DataFrame:
    """Q42: histogram totals against scored applications with an outcome."""
    a = aggregates.totals(histogram, ("cycle", "program"), "applications")
    b = aggregates.with_outcome(apps).where("score is not null").groupBy("cycle", "program").agg(F.count(F.lit(1)).alias("applications"))
    return joins.reconcile(a, b, ("cycle", "program"), ("applications",))


def report(rules: list[Rule]) -> DataFrame:
    """Rule, level, number of violations, one of them, and the outcome (ok, skipped or the level).

    Every rule is evaluated once; counts and the smallest example combine before the shuffle.
    """
    parts = []
    for rule in rules:
        row = F.to_json(F.struct(*(F.col(c) for c in rule.violations.columns)))
        found = rule.violations.agg(F.count(F.lit(1)).alias("violations"), F.min(row).alias("example"))
        state = F.lit("skipped") if rule.skipped else F.when(F.col("violations") == 0, "ok").otherwise(rule.level)
        parts.append(found.select(F.lit(rule.name).alias("rule"), F.lit(rule.level).alias("level"), "violations", "example", state.alias("state")))
    return reduce(DataFrame.unionByName, parts)


def report_rows(rows: DataFrame, rules: dict[str, Column], level: str = "error") -> DataFrame:
    """The same for rules on single rows: all of them in one pass over the rows."""
    row = F.to_json(F.struct(*(F.col(c) for c in rows.columns)))
    aggs = [F.struct(F.lit(name).alias("rule"), F.count_if(bad).alias("violations"), F.min(F.when(bad, row)).alias("example")) for name, bad in rules.items()]
    found = rows.agg(F.array(*aggs).alias("r")).select(F.explode("r").alias("r"))
    state = F.when(F.col("r.violations") == 0, "ok").otherwise(level)
    return found.select("r.rule", F.lit(level).alias("level"), "r.violations", "r.example", state.alias("state"))


def failed(found: DataFrame) -> bool:
    """Whether any rule of level error has violations (the exit code of a run)."""
    return found.where("state = 'error'").limit(1).count() > 0
