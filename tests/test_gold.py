import statistics

import pytest

from pyspark.sql import functions as F

from quarrystone.operators import aggregates, joins, quality, serving, windows
from quarrystone.schemas import APPLICATIONS


def apps(spark, rows):
    """(cycle, program, route, score, admitted[, person, floor])"""
    full = []
    for k, r in enumerate(rows):
        cycle, program, route, score, admitted, person, floor = (*r, None, None)[:7]
        full.append((cycle, f"{cycle}-{route}", route, program, person, score, admitted, floor, k))
    return spark.createDataFrame(full, APPLICATIONS)


def test_percentile_is_strict_and_needs_five(spark):
    five = apps(spark, [("2024", "p", "o", s, True) for s in (1.0, 2.0, 2.0, 3.0, 4.0)] + [("2024", "p", "o", None, True)])
    got = {r.score: r.percentile for r in windows.percentile_position(five).collect()}
    assert got == {1.0: 0.0, 2.0: 20.0, 3.0: 60.0, 4.0: 80.0, None: None}
    four = apps(spark, [("2024", "p", "o", s, True) for s in (1.0, 2.0, 3.0, 4.0)] + [("2024", "p", "o", None, True)])
    assert all(r.percentile is None for r in windows.percentile_position(four).collect())


def test_zero_and_missing_scores(spark):
    rows = [("2024", "p", "ordinario", s, a) for s, a in [(0.0, True), (None, True), (50.0, True), (70.0, False), (90.0, None)]]
    df = windows.percentile_position(apps(spark, rows))
    s = aggregates.program_cycle_summary(df).first()
    assert (s.applications, s.admitted, s.min_score, s.max_score, s.median_score, s.cutoff_score) == (4, 3, 50.0, 70.0, 60.0, 50.0)
    hist = {(r.bin_from, r.admitted): r.applications for r in aggregates.score_histogram(df).collect()}
    assert hist == {(0, True): 1, (50, True): 1, (70, False): 1}


@pytest.mark.parametrize("admitted, rejected, trusted, rate", [(11, 4, True, True), (12, 3, False, False), (10, 4, True, False), (9, 3, True, False), (15, 5, True, True)])
def test_rates_need_rows_and_trust(spark, admitted, rejected, trusted, rate):
    rows = [("2021", "p", "x", 1.0, True)] * admitted + [("2021", "p", "x", 1.0, False)] * rejected
    s = aggregates.program_cycle_summary(windows.percentile_position(apps(spark, rows))).first()
    assert (s.trusted, s.admission_rate is not None) == (trusted, rate)


def test_floor_is_the_first_in_row_order(spark):
    rows = [("2021", "p", "x", 1.0, True, None, f) for f in (None, 61.0, 40.0)]
    assert aggregates.program_cycle_summary(windows.percentile_position(apps(spark, rows))).first().floor_score == 61.0


def test_near_floor_is_one_sided(spark):
    rows = [("2021", "p", "x", s, False, None, 60.0) for s in (59.0, 58.9, 90.0)]
    assert aggregates.near_floor(apps(spark, rows)).first().near == 2
    assert aggregates.near_floor(apps(spark, rows), both_sides=True).first().near == 1


def test_trajectory_caps(spark):
    rows = [("2021", "p", "x", 1.0, k == 0, person) for person, n in (("a", 1), ("b", 4), ("c", 5), ("d", 6)) for k in range(n)]
    got = {(r.applications, r.ever_admitted): r.persons for r in aggregates.retry_trajectory(apps(spark, rows)).collect()}
    assert got == {("1", True): 1, ("4", True): 1, ("5 o mas", True): 2}


def test_previous_cycle_existing_or_global(spark):
    counts = spark.createDataFrame([("2021", "p", 10), ("2023", "p", 15), ("2022", "q", 0), ("2023", "q", 5)], "cycle string, program string, applications long")
    assert [(r.cycle, r.program, r.delta_pct) for r in windows.yoy_delta(counts).collect()] == [("2023", "p", 50.0)]
    cycles = spark.createDataFrame([(c,) for c in ("2021", "2022", "2023")], "cycle string")
    assert [(r.cycle, r.program, r.before, r.now) for r in joins.slope(counts, cycles).collect()] == [("2023", "q", 0, 5)]


def test_quartiles_and_points(spark):
    values = [float(v) for v in range(1, 100)]
    df = apps(spark, [("2021", "p", "x", v, True) for v in values])
    box = aggregates.score_box(df).first()
    assert (box.n, box.low, box.q1, box.median, box.q3, box.high) == (99, 1.0, 25.5, statistics.median(values), 74.5, 99.0)
    points = sorted((r.point, r.score) for r in windows.sample_points(df, ("cycle", "program")).collect())
    assert points == [(k, 1.0 + 2 * k) for k in range(40)]
    assert aggregates.score_box(apps(spark, [("2021", "p", "x", 1.0, True)] * 4)).count() == 0


def test_jumps_leave_out_the_scale_change(spark):
    m = spark.createDataFrame([("2022", "p", 10.0), ("2023", "p", 20.0), ("2024", "p", 40.0)], "cycle string, program string, median_score double")
    got = {(r.from_cycle, r.jump, r.scale_change) for r in windows.median_jumps(m).collect()}
    assert got == {("2022", True, False), ("2023", True, True)}
    assert quality.unexplained_jumps(m).count() == 1


def test_last_wins_on_colliding_keys(spark):
    seats = spark.createDataFrame([("2024", "mec", 120, 1), ("2024", "mec", 70, 2)], "cycle string, program_key string, seats long, row_seq long")
    assert windows.last_wins(seats, ("cycle", "program_key")).first().seats == 70


def test_occupancy(spark):
    seats = spark.createDataFrame([("2024", "A", "a", 10), ("2024", "B", "b", 0), ("2024", "C", "c", 4), ("2024", "D", "d", 4)], "cycle string, program string, program_key string, seats long")
    admitted = spark.createDataFrame([("2024", "a", 12), ("2024", "d", 0)], "cycle string, program_key string, admitted long")
    got = {r.program: (r.occupancy_pct, r.free_seats, r.crossed, r.matched) for r in aggregates.seat_occupancy(seats, admitted).collect()}
    assert got == {"A": (120.0, 0, True, True), "C": (0.0, 4, False, False), "D": (0.0, 4, False, True)}


def test_gaps_with_null_keys(spark):
    rows = spark.createDataFrame([("a", None, 1), ("a", None, 4), ("a", "s", 2), ("b", "s", 1)], "document string, site string, merit_rank int")
    got = {(r.document, r.site, r.missing_rank, r.block_max) for r in joins.rank_gaps(rows, ("document", "site")).collect()}
    assert got == {("a", None, 2, 4), ("a", None, 3, 4), ("a", "s", 1, 2)}


def test_gap_origin(spark):
    lines = spark.createDataFrame([("d", k, t) for k, t in enumerate(["x", "DERECHO", "1 A", "2 B", "4 C", "total", "9 Z"])], "document string, line_no int, line string")
    from pyspark.sql import functions as F

    titled = lines.withColumn("program", F.when(F.trim("line") == "DERECHO", "DERECHO"))
    blocks = joins.text_blocks(titled)
    assert sorted(r["rank"] for r in blocks.collect()) == [1, 2, 4]
    gaps = spark.createDataFrame([("d", "DERECHO", 3, 4), ("d", "DERECHO", 2, 4), ("d", "DERECHO", 2, 9)], "document string, program string, missing_rank int, block_max int")
    got = {(r.missing_rank, r.block_max): r.origin for r in joins.gap_origin(gaps, blocks).collect()}
    assert got == {(3, 4): "source", (2, 4): "lost", (2, 9): "unverified"}


def test_names_resolve_by_prefix_then_likeness(spark):
    names = ["INGENIERIA CIVIL", "INGENIERIA BIOTECNOLOGICA", "MEDICINA HUMANA", "MEDICINA"]
    cat = spark.createDataFrame([(n,) for n in names], "program string")
    forms = spark.createDataFrame([(f,) for f in ["INGENIERIA CIV", "INGENIERIA", "MEDICINA", "INGENIERIA BIIOTECNOLOGICA", "OTRA COSA", "MED", "TRASLADO INTERNO"]], "form string")
    got = {r.form: r.canonical for r in joins.resolve_programs(forms, cat).collect()}
    assert got == {"INGENIERIA CIV": "INGENIERIA CIVIL", "INGENIERIA": "INGENIERIA", "MEDICINA": "MEDICINA", "INGENIERIA BIIOTECNOLOGICA": "INGENIERIA BIOTECNOLOGICA", "OTRA COSA": "OTRA COSA"}


def test_reconcile_sees_both_sides(spark):
    a = spark.createDataFrame([("2021", "p", 1), ("2021", "q", 2), ("2021", "r", 0)], "cycle string, program string, n long")
    b = spark.createDataFrame([("2021", "p", 1), ("2021", "q", 3), ("2022", "s", 0)], "cycle string, program string, n long")
    got = {(r.program, r.in_left, r.in_right) for r in joins.reconcile(a, b, ("cycle", "program"), ("n",)).collect()}
    assert got == {("q", True, True), ("r", True, False), ("s", False, True)}


def test_first_origin_wins(spark):
    a = spark.createDataFrame([("x", 1)], "document string, v int")
    b = spark.createDataFrame([("x", 2), ("y", 3)], "document string, v int")
    got = {(r.document, r.origin, r.v) for r in joins.first_origin(("archive", a), ("web", b)).collect()}
    assert got == {("x", "archive", 1), ("y", "web", 3)}


def test_rules(spark):
    kind = "document string, site string, subgroup string, program string, merit_rank int, code string, condition string, part_extra double, part_1 double, part_2 double, score double, floor_score double"
    rows = spark.createDataFrame(
        [
            ("d", None, "g", "p", 2, "123456", "INGRESO", None, 10.0, 20.0, 30.0, 31.0),
            ("d", None, "g", "p", 2, "12a", "INGRESO", 1.0, 10.0, 20.0, 30.0, 20.0),
            ("d", None, "g", "p", 5, None, "NO INGRESO", None, 10.0, None, 12.0, 31.0),
            ("e", None, None, "p", 7, "", "INGRESO", None, 10.0, None, 12.0, None),
            ("e", None, None, "p", 8, "", "INGRESO", None, None, None, 2001.0, None),
        ],
        kind,
    )
    assert quality.parts_add_up(rows).count() == 1
    assert quality.single_part_is_score(rows).count() == 1
    assert quality.above_floor(rows).count() == 1
    assert quality.score_range(rows).count() == 1
    assert quality.code_form(rows).count() == 1
    assert quality.one_floor(rows).first().floors == 2
    grain = spark.createDataFrame([("d", "per_program", "results"), ("e", "global", "results")], "document string, grain string, doc_class string")
    assert quality.rank_starts_at_one(rows, grain).count() == 1
    assert quality.rank_is_unique(rows, grain).first().times == 2
    gaps = joins.rank_gaps(rows.where("document = 'd'"), quality.BLOCK)
    assert quality.sequence_complete(rows.where("document = 'd'"), gaps).count() == 0
    found = quality.report([quality.Rule("a", quality.score_range(rows)), quality.Rule("b", rows.where("false"), "warning"), quality.Rule("c", rows, skipped=True)])
    assert {r.rule: r.state for r in found.collect()} == {"a": "error", "b": "ok", "c": "skipped"}
    assert quality.failed(found)


def test_content_hash_ignores_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(2, None), (1, "x")], "k int, v string")
    assert quality.content_hash(a).first() == quality.content_hash(b).first()
    assert quality.content_hash(a).first() != quality.content_hash(a.limit(1)).first()


def test_selectors(spark):
    counts = spark.createDataFrame([("2021", "b", 5), ("2021", "a", 5), ("2022", "c", 9)], "cycle string, program string, applications long")
    assert [r.program for r in serving.top_programs(counts, n=2).collect()] == ["c", "a"]
    assert serving.has_program(counts, "2021", "a") and not serving.has_program(counts, "2022", "a")
    assert serving.lookup(counts, "program", "zz", "applications").first().applications is None
    areas = spark.createDataFrame([("a", "X"), ("b", "X")], "program string, area string")
    summary = counts.withColumn("admitted", counts.applications)
    shares = {(r.cycle, r.area): r.share for r in serving.area_ring(aggregates.by_area(summary, areas)).collect()}
    assert shares == {("2021", "X"): 1.0, ("2022", "Z"): 1.0}


def test_places_and_quantiles_against_sorting(spark):
    import random

    import numpy as np

    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2]), rng.choice([None, 0.0, 5.0, round(rng.uniform(-30, 400), 1)]), k) for k in range(600)]
    rows += [("c", 1, None, 600), ("d", 1, 3.5, 601)]
    df = spark.createDataFrame(rows, "k string, j int, score double, row_seq int").repartition(7)
    groups: dict = {}
    for k, j, s, _ in rows:
        if s is not None:
            groups.setdefault((k, j), []).append(s)
    for width in (1, 10, 1000):
        got = {(r.k, r.j, r.score): (r["count"], r.lower, r.n) for r in windows.lower_counts(df, ("k", "j"), width=width).collect()}
        assert got == {(k, j, x): (have.count(x), sum(y < x for y in have), len(have)) for (k, j), have in groups.items() for x in set(have)}
    by_place = {(r.k, r.j, r.score, r.row_seq): r.percentile for r in windows.percentile_position(df, ("k", "j")).collect()}
    assert len(by_place) == len(rows)
    for k, j, s, seq in rows:
        have = groups.get((k, j), [])
        assert by_place[k, j, s, seq] == (None if s is None or len(have) < 5 else 100.0 * sum(x < s for x in have) / len(have))
    for accuracy in (5, 50, 2000):
        got = {(r.k, r.j): (r.n, r.low, r.q1, r.mid, r.last, r.high) for r in windows.quantiles(df, ("k", "j"), {"q1": 0.25, "mid": 0.5, "last": 1.0}, accuracy=accuracy).collect()}
        assert set(got) == set(groups)
        for key, have in groups.items():
            assert np.allclose(got[key], (len(have), min(have), np.quantile(have, 0.25), np.median(have), max(have), max(have)))


def test_one_score_that_most_rows_have(spark, monkeypatch):
    """Nine of ten scores are equal: quantiles, positions and the lowest position are those of sorting, broadcast or not."""
    import random

    import numpy as np

    rng = random.Random(8)
    rows = [("2021", f"d{rng.randrange(3)}", "p", rng.choice([True, False, None]), 0.0 if rng.random() < 0.9 else round(rng.uniform(1, 99), 2)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "cycle string, document string, program string, admitted boolean, score double").repartition(5)
    have = sorted(r[4] for r in rows)
    want = {d: sorted(r[4] for r in rows if r[1] == d) for d in ("d0", "d1", "d2")}
    position = lambda d, s: 100.0 * sum(x < s for x in want[d]) / len(want[d])
    for at_most in (500_000, 0):
        monkeypatch.setattr(windows, "BROADCAST_ROWS", at_most)
        r = windows.quantiles(df, ("cycle", "program"), {"a": 0.05, "b": 0.5, "c": 0.95, "e": 0.99}).first()
        assert np.allclose((r.a, r.b, r.c, r.e), np.quantile(have, (0.05, 0.5, 0.95, 0.99)))
        got = windows.percentile_position(df).collect()
        assert len(got) == 4000 and all(abs(r.percentile - position(r.document, r.score)) < 1e-9 for r in got)
        least = windows.lowest_percentile(df.where("score > 50 or score = 0"), ("cycle", "program"), F.col("admitted") & (F.col("score") > 0)).first()
        kept = {d: [x for x in want[d] if x > 50 or x == 0] for d in want}
        low = {d: min(r[4] for r in rows if r[1] == d and r[3] and r[4] > 50) for d in want}
        assert abs(least.cutoff_percentile - min(100.0 * sum(x < low[d] for x in kept[d]) / len(kept[d]) for d in want)) < 1e-9

def test_near_names_against_every_name(spark):
    import difflib
    import random

    rng = random.Random(6)
    names = ["".join(rng.choice("ABCDE") for _ in range(rng.randint(1, 40))) for _ in range(150)]

    def edited(name):
        out = list(name)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(out) + 1)
            out[at : at + rng.randint(0, 1)] = rng.choice(["", "A", "X", "BC"])
        return "".join(out)

    forms = sorted({edited(rng.choice(names)) for _ in range(300)} - {""})
    df = lambda values, c: spark.createDataFrame([(v,) for v in values], f"{c} string")
    for cutoff in (0.92, 0.97):
        want = {f: m[0] for f in forms if (m := difflib.get_close_matches(f, sorted(set(names)), n=1, cutoff=cutoff))}
        got = {r.form: r.canonical for r in joins.near_names(df(forms, "form"), df(names, "program"), cutoff).collect()}
        assert got == want and len(want) > 100


def test_picks_keep_whole_rows(spark):
    df = spark.createDataFrame([("a", 1, None, 5), ("a", 2, "x", 6), (None, 3, "y", 1), (None, 1, "z", 2)], "k string, row_seq int, t string, n int")
    assert sorted(map(tuple, windows.last_wins(df, ("k",)).collect()), key=str) == sorted([("a", 2, "x", 6), (None, 3, "y", 1)], key=str)
    assert sorted(map(tuple, windows.first_wins(df, ("k",)).collect()), key=str) == sorted([("a", 1, None, 5), (None, 1, "z", 2)], key=str)
