"""What is exploded is larger than the planner thinks, so it is never broadcast."""

from quarrystone.operators import joins, layout


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_heights_of_lines_are_not_broadcast(spark):
    chars = spark.createDataFrame([("d", 1, k, "a", float(k), k + 1.0, 1.5 * k) for k in range(4)], "document string, page int, seq bigint, text string, x0 double, x1 double, top double")
    lines = layout.line_numbers(chars)
    assert "BroadcastHashJoin" not in plan(lines)
    assert sorted((r["seq"], r["line_no"]) for r in lines.collect()) == [(0, 0), (1, 0), (2, 1), (3, 1)]


def test_pieces_of_names_are_not_broadcast(spark):
    names = spark.createDataFrame([("INGENIERIA CIVIL",), ("INGENIERIA INDUSTRIAL",)], "program string")
    forms = spark.createDataFrame([("INGENIERIA INDUSTRAL",), ("INGENIERIA C",)], "form string")
    near, prefix = joins.near_names(forms, names), joins.prefix_resolve(forms, names)
    assert "BroadcastHashJoin" not in plan(near)
    assert [tuple(r) for r in near.collect()] == [("INGENIERIA INDUSTRAL", "INGENIERIA INDUSTRIAL")]
    assert [tuple(r) for r in prefix.where("form = 'INGENIERIA C'").collect()] == [("INGENIERIA C", "INGENIERIA CIVIL")]
