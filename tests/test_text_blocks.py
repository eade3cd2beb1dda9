"""Blocks of lines in documents of any length: no document is a group of one task."""

import random

from quarrystone.operators import joins

SCHEMA = "document string, line_no int, line string, program string"


def expected(rows):
    """Blocks line by line; lines of one number stand together."""
    out = []
    for document in {r[0] for r in rows}:
        of = {}
        for r in rows:
            if r[0] == document:
                of.setdefault(r[1], []).append((r[3], int(r[2].split()[0]) if r[2].strip()[:1].isdigit() else None))
        block, title, begun, ended = 0, None, False, False
        for number in sorted(of, key=lambda n: (n is not None, n)):
            titles = [t for t, _ in of[number] if t is not None]
            if titles:
                block, title, begun, ended = block + len(titles), titles[0], False, False
            begun = begun or any(k is not None for _, k in of[number])
            ended = ended or (begun and any(k is None for _, k in of[number]))
            out += [(document, block, title, k) for _, k in of[number] if k is not None and block and not ended]
    return sorted(map(str, out))


def got(blocks):
    return sorted(str((r["document"], r["block_no"], r["program"], r["rank"])) for r in blocks.collect())


def test_a_long_document_is_cut_into_ranges(spark):
    lines = spark.range(2000).selectExpr("'d' as document", "cast(id as int) as line_no", "case id % 400 when 0 then 'T' when 390 then 'end' else concat(id % 400, ' x') end as line", "case when id % 400 = 0 then 'T' end as program")
    blocks = joins.text_blocks(lines)
    # a window over a document would sort all its lines in one task
    assert "Window" not in blocks._jdf.queryExecution().executedPlan().toString()
    want = expected([tuple(r) for r in lines.collect()])
    assert len(want) == 5 * 389 and got(blocks) == want
    cut = joins.text_blocks(lines, size=50)
    assert len(cut.inputFiles()) > 15 and got(cut) == want


def test_ranges_change_no_block(spark):
    dice = random.Random(12)
    rows = []
    for document in ("a", "b", None):
        for k in range(300):
            number = None if dice.random() < 0.01 else k - dice.randrange(2)  # some lines share a number
            kind = dice.random()
            line = f"{dice.randrange(1, 99)} x" if kind < 0.7 else "other"
            rows.append((document, number, line, f"T{(number or 0) % 3}" if kind < 0.04 or kind > 0.97 else None))
    rows += [("ranks only", k, f"{k + 1} x", None) for k in range(40)] + [("one title", k, f"{k} x", "T" if k == 3 else None) for k in range(60)]
    want = expected(rows)
    assert len(want) > 100
    for size in (7, 40, 10_000):
        assert got(joins.text_blocks(spark.createDataFrame(rows, SCHEMA), size=size)) == want


def test_no_lines_no_blocks(spark):
    assert joins.text_blocks(spark.createDataFrame([], SCHEMA)).count() == 0
