"""Names that share a piece by chance are not compared, and no near pair is lost for it, whatever the lengths."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from quarrystone.functions.similarity import ratio
from quarrystone.operators import joins


def edited(rng, name, edits):
    out = list(name)
    for _ in range(edits):
        at = rng.randrange(len(out))
        out[at : at + rng.randint(0, 2)] = [rng.choice("ABCXY") for _ in range(rng.randint(0, 2))]
    return "".join(out) or "A"


def tables(spark, forms, names):
    return spark.createDataFrame([(x,) for x in forms], "form string"), spark.createDataFrame([(x,) for x in names], "program string")


@pytest.mark.parametrize("low, high, letters, cutoff", [(3, 40, "AB", 0.92), (55, 75, "ABCDE", 0.9), (120, 260, "ABCDEFGHIJ ", 0.92)])
def test_every_near_pair_is_a_candidate(spark, low, high, letters, cutoff):
    rng = random.Random(low)
    bases = ["".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(20)]
    names = sorted({edited(rng, b, rng.randint(0, 2)) for b in bases for _ in range(3)})
    forms = sorted({edited(rng, rng.choice(names), rng.randint(0, 1 + high // 16)) for _ in range(100)})
    f, c = tables(spark, forms, names)
    near = {(form, name): difflib.SequenceMatcher(None, name, form).ratio() for form in forms for name in names}
    near = {pair: r for pair, r in near.items() if r >= cutoff}
    got = {tuple(r) for r in joins.near_candidates(f, c, cutoff).collect()}
    assert len(near) > 40 and set(near) <= got
    best = {form: max((r, name) for (of, name), r in near.items() if of == form)[1] for form, _ in near}
    assert {r.form: r.canonical for r in joins.near_names(f, c, cutoff).collect()} == best


def test_names_that_share_a_piece_by_chance_are_not_compared(spark):
    rng = random.Random(7)
    names = ["".join(rng.choice("ABCDEF") for _ in range(32)) for _ in range(1500)]
    forms = [n[:15] + "ZZ" + n[17:] for n in names]
    f, c = tables(spark, forms, names)
    assert {tuple(r) for r in joins.near_candidates(f, c).collect()} == set(zip(forms, names))


def test_a_name_is_indexed_at_few_places(spark):
    """32 letters of 32 may lose two and gain two: five pieces at 1, 2, 3, 2 and 1 places."""
    assert joins._reach([32], [32], 0.92) == [(32, 32, 5, 2, 2)]
    assert joins._reach([31, 32, 33], [32], 0.98) == [(31, 32, 2, 0, 1), (32, 32, 1, 0, 0), (33, 32, 2, 1, 0)]


def test_nothing_near(spark):
    f, c = tables(spark, ["", None, "A", "ABCDEFGHIJKLMNOP"], ["", None, "B"])
    assert joins.near_names(f, c).collect() == []
    assert joins.near_names(f.limit(0), c).collect() == [] and joins.near_names(f, c.limit(0)).collect() == []


def test_ratios_are_those_of_the_library(spark):
    rng = random.Random(11)
    pairs = [("", ""), ("A", ""), ("", "A"), ("A" * 199, "A" * 200), ("A" * 200, "A" * 199), ("AB" * 110, "BA" * 110)]
    for letters in ("A", "AB", "ABCDEFGH ", "é😀a"):
        for _ in range(300):
            p = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
            pairs.append((p, edited(rng, p, 3) if len(p) > 6 and rng.random() < 0.7 else "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))))
    got = spark.createDataFrame(pairs, "a string, b string").withColumn("r", ratio(F.col("a"), F.col("b"))).collect()
    assert len(got) == len(pairs) and all(r.r == difflib.SequenceMatcher(None, r.b, r.a).ratio() for r in got)
