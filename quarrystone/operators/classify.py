"""Rule tables as column expressions: first match wins, in the order of the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone.functions.scalar import ascii_fold, exam_date, safe_double, safe_int

# Labels of outcomes in order of recognition (longer ones first).
CONDITIONS = [
    "INGR NO BENEF", "NO SELECCIONADO", "NO INGRESO", "NO APTO",
    "TEST + ENTREVISTA", "SELECCIONADO", "NIVELACION", "OBSERVADO",
    "RECHAZADO", "RETIRADO", "INGRESO", "APTO", "NSP", "NC",
]
# Meaning of a label in results records.
RESULT_MEANING = {
    "INGRESO": "ingreso", "SELECCIONADO": "ingreso", "APTO": "ingreso",
    "NO INGRESO": "no_ingreso", "NO SELECCIONADO": "no_ingreso",
    "NO APTO": "no_ingreso",
    "NSP": "no_se_presento", "NC": "no_corresponde",
    "NIVELACION": "nivelacion", "TEST + ENTREVISTA": "test_entrevista",
    "OBSERVADO": "observado", "RETIRADO": "retirado",
}
# Meaning of a label in eligibility lists.
ELIGIBILITY_MEANING = {"APTO": "apto_para_rendir", "NO APTO": "no_apto", "OBSERVADO": "observado", "RECHAZADO": "rechazado"}
# Entry route by words in process and file name; "=" asks for a whole word.
ROUTES = [
    ("precatolica", ["PRECAT", "PRECA"]),
    ("distancia", ["DISTANCIA", "SEMIPRESENCIAL", "EDS", "EDYS"]),
    ("beca", ["BECA", "PRONABEC", "TISUR"]),
    ("tercio_superior", ["TERCIO SUPERIOR", "TSUP"]),
    ("rendimiento_superior", ["RENDIMIENTO", "=RS"]),
    ("traslado", ["TRASLADO", "TEN", "TEI"]),
    ("convenio_cci", ["CCI", "CONVENIO", "COBER"]),
    ("extraordinario", ["EXTRAORD"]),
    ("complementario", ["COMPLEMENT", "NIVELACION"]),
    ("lista_aptos", ["APTO"]),
    ("ordinario", ["ORDINARIO", "EXAMEN GENERAL"]),
]
ORDINARY_FILE = r"^(PUNTAJES_)?EG\d{4}"
# Renamed routes.
ROUTE_NAMES = {"tercio_superior": "rendimiento_superior", "lista_aptos": "lista_aptos"}
# What is no programme, words of an eligibility cover, reasons for empty documents.
NOT_A_PROGRAM = r"RESULTADO|POSTULANTES|AREA DE CIENCIAS|ESCUELA PROFESIONAL|APELLIDOS|TRASLADO|PRIMEROS PUESTOS|GRADUADO|NOMBRES|CONVENIO|DEPORTISTAS|^$"
ELIGIBILITY_COVER = r"(?i)POSTULANTES\s+(NO\s+)?APTOS|LISTA\s+DE\s+POSTULANTES|APTOS\s+PARA\s+RENDIR|EXPEDIENTES\s+RECHAZADOS|RELACION\s+DE\s+POSTULANTES\s+APTOS"
EMPTY_REASONS = [
    ("lista de aptitud previa al examen", ["LISTA DE POSTULANTES APTOS", "POSTULANTES APTOS", "NO APTOS", "APTOS PARA RENDIR", "EXPEDIENTES RECHAZADOS"]),
    ("instructivo o requisitos, sin tabla de personas", ["PASOS PARA REVISAR", "REVISAR EL PROMEDIO", "REQUISITOS", "ESTIMADO POSTULANTE"]),
]
# Words of three letters and more that no person's name has.
FUNCTION_WORDS = (
    "POR PARA CON SIN SOBRE ENTRE DESDE HASTA SEGUN ANTE TRAS DURANTE MEDIANTE LOS LAS DEL UNA UNO "
    "QUE MAS SUS ESTE ESTA ESOS ESAS TODO TODA"
).split()
# Shapes of a table row in plain text.
ROW_SHAPES = [
    r"^\d{1,4}\s+\d{6,12}\s+\S",
    r"^\d{6,12}\s+[A-ZÑÁÉÍÓÚ]",
    r"^\d{1,4}\s+\S*[A-ZÑÁÉÍÓÚÜ]{2,}",
    r"^\d{1,4}\s+\d{6,12}[A-ZÑÁÉÍÓÚ]",
    r"^[A-ZÑÁÉÍÓÚ][A-ZÑÁÉÍÓÚ'´ ]{6,}.*\d+\.\d+",
]
SCALE_CYCLE = "2024"
MIN_CYCLE = "2021"


def typed_rows(rows: DataFrame, doubles: tuple[str, ...] = (), ints: tuple[str, ...] = (), required: str = "program") -> DataFrame:
    """B1: the string layer with numbers, null where a text is none; rows without ``required`` go."""
    kinds = {c: safe_double(F.col(c)) for c in doubles} | {c: safe_int(F.col(c)) for c in ints}
    return rows.where(F.coalesce(required, F.lit("")) != "").withColumns(kinds)


def first_match(rules: list[tuple[str, Column]], default: str | None = None) -> Column:
    """The label of the first rule that holds."""
    chain = reduce(lambda acc, rule: (F if acc is None else acc).when(rule[1], F.lit(rule[0])), rules, None)
    return chain.otherwise(F.lit(default)) if default is not None else chain


def contains_any(text: Column, words: list[str]) -> Column:
    whole = [w[1:] for w in words if w[0] == "="]
    parts = [F.contains(text, F.lit(w)) for w in words if w[0] != "="]
    parts += [F.array_contains(F.split(F.trim(text), r"\s+"), w) for w in whole]
    return reduce(lambda a, b: a | b, parts)


def condition_of(cell: Column) -> Column:
    """The outcome that a cell names, by containment, accents aside; empty where none."""
    text = ascii_fold(F.upper(F.coalesce(cell, F.lit(""))))
    return first_match([(c, F.contains(text, F.lit(c))) for c in CONDITIONS], "")


def route_of(process: Column, name: Column) -> Column:
    """Entry route from process title and file name."""
    text = F.upper(F.concat(F.coalesce(process, F.lit("")), F.lit(" "), name))
    rules = [(route, contains_any(text, words) | (text.rlike(ORDINARY_FILE) if route == "ordinario" else F.lit(False))) for route, words in ROUTES]
    return first_match(rules, "otro")


def cycle_of(process: Column, name: Column) -> Column:
    """The year a process declares, else the one in the file name, else a mark."""
    year = lambda c: F.nullif(F.regexp_extract(c, r"20\d{2}", 0), F.lit(""))
    return F.coalesce(year(F.coalesce(process, F.lit(""))), year(name), F.lit("sin_ciclo"))


def since(cycle: Column, first: str = MIN_CYCLE) -> Column:
    """Cycles from ``first`` on, compared as text."""
    return cycle >= first


def meaning_of(label: Column, eligibility: Column) -> Column:
    """A label's meaning depends on the class of the document; unknown labels have none."""
    table = lambda m: F.create_map(*(F.lit(x) for pair in m.items() for x in pair))
    return F.when(eligibility, F.try_element_at(table(ELIGIBILITY_MEANING), label)).otherwise(F.try_element_at(table(RESULT_MEANING), label))


def admitted_of(meaning: Column) -> Column:
    """True, false, or null where the outcome is neither."""
    return F.when(meaning == "ingreso", True).when(meaning == "no_ingreso", False)


def unified_route(route: Column) -> Column:
    """B18"""
    return reduce(lambda acc, kv: F.when(route == kv[0], kv[1]).otherwise(acc), ROUTE_NAMES.items(), route)


def scale_of(cycle: Column) -> Column:
    """B19"""
    return F.when(cycle >= SCALE_CYCLE, "nueva").otherwise("anterior")


def is_program(form: Column) -> Column:
    """B7"""
    return ~form.rlike(NOT_A_PROGRAM)


def is_garbled(text: Column) -> Column:
    """Words that two lines printed over each other leave."""
    return F.exists(
        F.split(F.trim(text), r"\s+"),
        lambda w: ((F.char_length(w) >= 12) & ~w.rlike("[AEIOU][^AEIOU][AEIOU]")) | w.rlike("[BCDFGHJKLMNPQRSTVWXYZ]{5}"),
    )


def is_data_row(code: Column, name: Column, condition: Column, score: Column, rank: Column) -> Column:
    """A row identifies a person and gives a result."""
    text = lambda c: F.coalesce(c, F.lit(""))
    digits = text(code).rlike(r"^\d+$")
    person = digits | (F.size(F.filter(F.split(text(name), r"\s+"), lambda w: w != "")) >= 2)
    result = (condition_of(condition) != "") | text(score).rlike(r"^\d{1,4}\.\d+$") | text(rank).rlike(r"^\d+$")
    return ((text(code) == "") | digits) & person & result


def utility_of(tokens: Column, conditions: Column, n_scores: Column) -> Column:
    """What an audited document can be used for."""
    return (
        F.when(F.size(tokens) == 0, "vacio_para_regex")
        .when(F.array_contains(conditions, "NO INGRESO"), "con_denominador")
        .when(F.array_contains(conditions, "INGRESO"), "solo_ingresantes")
        .when(n_scores > 0, "puntajes_sin_condicion")
        .otherwise("sin_datos_tabulares")
    )


def token_counts(tokens: Column) -> dict[str, Column]:
    """Scores, codes, names and floor marks among the tokens of a document."""
    count = lambda test: F.size(F.filter(tokens, test))
    return {
        "n_scores": count(lambda t: t.rlike(r"^\d{1,3}\.\d{2,}$")),
        "n_codes": count(lambda t: t.rlike(r"^\d{8}$")),
        "n_names": count(lambda t: t.rlike(r"^[A-ZÑÁÉÍÓÚÜ]{2,}(?: [A-ZÑÁÉÍÓÚÜ.]{1,}){1,5}$")),
        "n_floors": count(lambda t: t.startswith("Nota M")),
    }


def eligibility_documents(rows: DataFrame, covers: DataFrame | None = None) -> DataFrame:
    """Documents that are eligibility lists, by vocabulary or by cover."""
    words = rows.groupBy("document").agg(
        F.bool_or(F.col("condition") == "NO APTO").alias("unfit"),
        F.bool_or(F.col("condition") == "APTO").alias("fit"),
        F.bool_or(F.col("condition").isin("INGRESO", "NO INGRESO", "SELECCIONADO")).alias("result"),
    )
    found = words.where("coalesce(unfit, false) or (coalesce(fit, false) and not coalesce(result, false))").select("document")
    if covers is not None:
        found = found.union(covers.where("doc_class = 'eligibility'").select("document"))
    return found.distinct()


def numbering_grain(rows: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """Whether ranks restart with each programme or run through the document."""
    block = rows.where("merit_rank is not null").groupBy("document", "site", "subgroup", "program").agg(F.min("merit_rank").alias("first_rank"))
    grain = block.groupBy("document").agg(F.when(F.count_if(F.col("first_rank") == 1) == F.count(F.lit(1)), "per_program").otherwise("global").alias("grain"))
    if classes is None:
        return grain.withColumn("doc_class", F.lit("results"))
    return grain.join(classes.select("document", "doc_class"), "document", "left").withColumn("doc_class", F.coalesce("doc_class", F.lit("results")))


def empty_reason(text: Column, redundant: Column | None = None) -> Column:
    """Why a document gave no rows."""
    rules = [(reason, contains_any(F.upper(text), words)) for reason, words in EMPTY_REASONS]
    if redundant is not None:
        rules.insert(0, ("duplicado de otro PDF del mismo proceso", redundant))
    return first_match(rules, "sin explicar")


def in_exam_window(cycle: Column, date: Column) -> Column:
    """From April of the year before the cycle to August of its year; null without a date."""
    day, year = exam_date(date), cycle.try_cast("int")
    before = (F.year(day) == year - 1) & (F.month(day) >= 4)
    return before | ((F.year(day) == year) & (F.month(day) <= 8))


def holds_identity_number(text: Column) -> Column:
    """Eight digits that stand alone."""
    return text.rlike(r"(?<![0-9A-Za-z])\d{8}(?![0-9A-Za-z])")


#: Where one of two neighbours is a letter of A-Z or a-z, a digit or an underscore and the other is not.
ASCII_EDGE = r"(?:(?<![0-9A-Za-z_])(?=[0-9A-Za-z_])|(?<=[0-9A-Za-z_])(?![0-9A-Za-z_]))"


def person_names(text: Column, known: list[str] | None = None, ascii_edges: bool = False) -> Column:
    """Three or more words of capitals in a row, without function words or known names.

    A name begins and ends at the edge of a word of any letters; with ``ascii_edges`` it begins at an ``ASCII_EDGE``
    and ends where the capitals do, as engines read it whose word characters are those of ASCII.
    """
    capitals = "([A-ZÑÁÉÍÓÚ]{3,}(?: [A-ZÑÁÉÍÓÚ]{3,}){2,})"
    found = F.regexp_extract_all(text, F.lit(ASCII_EDGE + capitals if ascii_edges else rf"\b{capitals}\b"), F.lit(1))
    words = F.array(*(F.lit(w) for w in FUNCTION_WORDS))
    odd = F.filter(found, lambda n: ~F.arrays_overlap(F.split(n, " "), words))
    return F.array_except(odd, F.array(*(F.lit(k) for k in known))) if known else odd


def is_row_line(line: Column) -> Column:
    """A line of plain text that has the shape of a table row."""
    text = F.trim(line)
    return reduce(lambda a, b: a | b, (text.rlike(p) for p in ROW_SHAPES))


def is_seat_number(token: Column) -> Column:
    """B28"""
    return token.rlike(r"^\d{1,4}$")


def is_seat_program(token: Column) -> Column:
    """Capitalised, not all capitals, five letters or more."""
    return (F.char_length(token) >= 5) & ~is_seat_number(token) & (F.upper(token) != token) & token.rlike("^[A-ZÁÉÍÓÚÑ][a-záéíóúñ]")


def seats_add_up(parts: list[Column], total: Column) -> Column:
    """B29"""
    return reduce(lambda a, b: a + b, parts) == total


def in_score_range(score: Column) -> Column:
    """B25"""
    return score.between(0, 2000)


def is_code(code: Column) -> Column:
    """B25"""
    return code.rlike("^[0-9]+$") | F.char_length(code).between(6, 12)
