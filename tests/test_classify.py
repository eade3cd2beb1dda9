from pyspark.sql import functions as F

from quarrystone.operators import classify

X = F.col("x")


def rows(spark, values, expr):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "x string").select(expr.alias("y")).collect()]


def test_longer_labels_win(spark):
    got = rows(spark, ["no ingresó", "INGRESÓ", "INGR NO BENEF", "x APTO", "no apto", "", None], classify.condition_of(X))
    assert got == ["NO INGRESO", "INGRESO", "INGR NO BENEF", "APTO", "NO APTO", "", ""]


def test_meaning_depends_on_class(spark):
    assert rows(spark, ["APTO", "NO APTO", "RECHAZADO", "NSP"], classify.meaning_of(X, F.lit(True))) == ["apto_para_rendir", "no_apto", "rechazado", None]
    meaning = classify.meaning_of(X, F.lit(False))
    assert rows(spark, ["APTO", "NO APTO", "RECHAZADO", "TEST + ENTREVISTA"], classify.admitted_of(meaning)) == [True, False, None, None]


def test_routes_and_cycles(spark):
    got = rows(spark, ["CONCURSO PRECATOLICA", "EXAMEN GENERAL 2020", "Examen RS", "MARS", None], classify.route_of(X, F.lit("f.pdf")))
    assert got == ["precatolica", "ordinario", "rendimiento_superior", "otro", "otro"]
    assert rows(spark, ["PRIMER EXAMEN 2023"], classify.cycle_of(X, F.lit("EG2022I"))) == ["2023"]
    assert rows(spark, [None], classify.cycle_of(X, F.lit("EG2022I"))) == ["2022"]
    assert rows(spark, ["x"], classify.cycle_of(X, F.lit("y"))) == ["sin_ciclo"]
    assert rows(spark, ["2020", "2021", "sin_ciclo"], classify.since(X)) == [False, True, True]


def test_garbled_and_programs(spark):
    assert rows(spark, ["RETHRAABSLIALDITOA", "INGENIERIA CIVIL", "ABCDFGH"], classify.is_garbled(X)) == [False, False, True]
    assert rows(spark, ["DERECHO", "TRASLADO INTERNO", ""], classify.is_program(X)) == [True, False, False]


def test_rows_need_person_and_result(spark):
    df = spark.createDataFrame(
        [("12345678", "", "INGRESO", "", ""), ("12a", "ANA PEREZ", "INGRESO", "", ""), ("", "ANA PEREZ", "", "12.5", ""), ("", "ANA PEREZ", "", "", "7"), ("", "ANA", "", "12.5", "7"), (None, "ANA PEREZ", None, None, None)],
        "code string, name string, condition string, score string, rank string",
    )
    got = df.select(classify.is_data_row(*(F.col(c) for c in df.columns)).alias("y")).collect()
    assert [r.y for r in got] == [True, False, True, True, False, False]


def test_eligibility_by_vocabulary_or_cover(spark):
    r = spark.createDataFrame([("a", "APTO"), ("a", "OBSERVADO"), ("b", "APTO"), ("b", "NO INGRESO"), ("c", "NO APTO"), ("d", "")], "document string, condition string")
    covers = spark.createDataFrame([("d", "eligibility"), ("b", "results")], "document string, doc_class string")
    assert sorted(x.document for x in classify.eligibility_documents(r, covers).collect()) == ["a", "c", "d"]


def test_grain(spark):
    kind = "document string, site string, subgroup string, program string, merit_rank int"
    r = spark.createDataFrame([("a", None, "g", "p", 1), ("a", None, "g", "q", 1), ("b", None, None, "p", 1), ("b", None, None, "q", 4)], kind)
    assert {x.document: x.grain for x in classify.numbering_grain(r).collect()} == {"a": "per_program", "b": "global"}


def test_exam_window_edges(spark):
    got = rows(spark, ["31/03/2023", "01/04/2023", "31/08/2024", "01/09/2024", None], classify.in_exam_window(F.lit("2024"), X))
    assert got == [False, True, True, False, None]


def test_personal_data(spark):
    assert rows(spark, ["id 12345678.", "x123456789", "a12345678"], classify.holds_identity_number(X)) == [True, False, False]
    got = rows(spark, ["de QUISPE MAMANI JUAN y ANALISIS POR CARRERA"], classify.person_names(X))
    assert got == [["QUISPE MAMANI JUAN"]]
    assert rows(spark, ["QUISPE MAMANI JUAN"], classify.person_names(X, ["QUISPE MAMANI JUAN"])) == [[]]


def test_row_shapes_and_reasons(spark):
    assert rows(spark, ["1 12345678 X", " 3 PEREZ", "2021 - I", "PEREZ LOPEZ ANA 12.50"], classify.is_row_line(X)) == [True, True, False, True]
    assert rows(spark, ["lista de postulantes aptos", "requisitos", "z"], classify.empty_reason(X))[2] == "sin explicar"


def test_tokens(spark):
    df = spark.createDataFrame([(["12.345", "7", "12345678", "PEREZ ANA", "Nota Minima", "NO INGRESO"],)], "t array<string>")
    got = df.select(*(c.alias(k) for k, c in classify.token_counts(F.col("t")).items()), classify.utility_of(F.col("t"), F.array(F.lit("NO INGRESO")), F.lit(1)).alias("u")).first()
    assert tuple(got) == (1, 1, 2, 1, "con_denominador")
