import difflib
import random

import pytest

from quarrystone.operators import joins


def names_of(rng, n):
    return ["".join(rng.choice("ABCDEO ") for _ in range(rng.randint(3, 60))).strip() or "ABC" for _ in range(n)]


def edited(rng, name):
    out = list(name)
    for _ in range(rng.randint(0, 4)):
        at = rng.randrange(len(out) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            out.insert(at, rng.choice("ABCXY"))
        elif out and kind == 1:
            out.pop(min(at, len(out) - 1))
        elif out:
            out[min(at, len(out) - 1)] = rng.choice("ABCXY")
    return "".join(out) or "A"


@pytest.mark.parametrize("seed", [1, 2])
def test_candidates_hold_every_near_pair(spark, seed):
    rng = random.Random(seed)
    names = sorted(set(names_of(rng, 150)))
    forms = sorted({edited(rng, rng.choice(names)) for _ in range(150)})
    f, c = spark.createDataFrame([(x,) for x in forms], "form string"), spark.createDataFrame([(x,) for x in names], "program string")
    near = {}
    for form in forms:
        best = max((difflib.SequenceMatcher(None, name, form).ratio(), name) for name in names)
        if best[0] >= joins.FUZZY_CUTOFF:
            near[form] = best[1]
    got = {r.form: r.canonical for r in joins.near_names(f, c).collect()}
    assert got == near and len(near) > 40


def test_pairs_compared_grow_with_the_names(spark):
    """Twice the names of one length and few letters: about twice the pairs for each form, not more."""
    rng = random.Random(5)
    names = ["".join(rng.choice("ABCDEFGHIKLMNOPRSTU") for _ in range(rng.randint(8, 40))) for _ in range(2000)]
    pairs = []
    for n in (1000, 2000):
        c = spark.createDataFrame([(x,) for x in names[:n]], "program string")
        pairs.append(joins.near_candidates(c.withColumnRenamed("program", "form"), c).count())
    assert n <= pairs[1] and pairs[1] - 2000 < 5 * (pairs[0] - 1000 + 50) and pairs[1] < 20 * n
