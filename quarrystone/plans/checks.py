"""Named queries of the rules, the row-level expressions, the sources and the page geometry.

Inputs are made from the driver's tables so that the expected rows can be stated in SQL:
published figures with known faults, cells of known shape, characters of known cells.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrystone.functions import scalar
from quarrystone.operators import aggregates, classify, joins, layout, quality, serving, windows
from quarrystone.plans.canonical import APPS, applications, table
from quarrystone.plans.named import query
from quarrystone.schemas import strings
from quarrystone.sources import readers, writers
from quarrystone.sources.shared import dealt, scratch

WITH = f"WITH {APPS}"
COUNTS = "counts AS (SELECT cycle, program, count(*) AS applications, count(*) FILTER (WHERE admitted) AS admitted FROM apps WHERE admitted IS NOT NULL GROUP BY ALL)"


def _counts(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.with_outcome(applications(spark, d)).groupBy("cycle", "program").agg(F.count(F.lit(1)).alias("applications"), F.count_if("admitted").alias("admitted"))


def _both(text: str) -> tuple[Column, str]:
    """An expression that both engines read alike."""
    return F.expr(text), text


# ---- typed rows and filters

_RAW = "CASE l_linenumber % 6 WHEN 0 THEN 'NC' WHEN 1 THEN concat(' ', cast(cast(l_quantity AS INT) AS {s}), '.5 ') WHEN 2 THEN '' WHEN 3 THEN concat(cast(cast(l_quantity AS INT) AS {s}), 'd') WHEN 4 THEN NULL ELSE cast(cast(l_quantity AS INT) AS {s}) END"
_TYPED = f"""raw AS (SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, {_RAW.format(s="VARCHAR")} AS score, CASE WHEN l_partkey % 7 = 0 THEN '' WHEN l_partkey % 11 <> 0 THEN concat('P', cast(l_partkey % 40 AS VARCHAR)) END AS program FROM lineitem)"""


def _raw_rows(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", F.expr(_RAW.format(s="STRING")).alias("score"),
        F.expr("CASE WHEN l_partkey % 7 = 0 THEN '' WHEN l_partkey % 11 <> 0 THEN concat('P', cast(l_partkey % 40 AS STRING)) END").alias("program"),
    )


@query(f"""WITH {_TYPED}, n AS (SELECT *, CASE WHEN regexp_full_match(trim(score), '[+-]?(\\d+\\.?\\d*|\\.\\d+)') THEN cast(trim(score) AS DOUBLE) END AS v FROM raw)
  SELECT program, count(*) AS n_rows, count(v) AS n_scores, sum(v) AS total, cast(sum(trunc(v)) AS BIGINT) AS whole FROM n WHERE program <> '' GROUP BY program""")
def typed_rows(spark, d):
    """B1, B2, A10: numbers of a string layer, null where the text is none; rows without a programme go"""
    typed = classify.typed_rows(_raw_rows(spark, d).withColumn("whole", F.col("score")), doubles=("score",), ints=("whole",))
    return typed.groupBy("program").agg(F.count(F.lit(1)).alias("n_rows"), F.count("score").alias("n_scores"), F.sum("score").alias("total"), F.sum("whole").alias("whole"))


@query(f"""WITH {_TYPED}, n AS (SELECT *, CASE WHEN regexp_full_match(trim(score), '[+-]?(\\d+\\.?\\d*|\\.\\d+)') THEN cast(trim(score) AS DOUBLE) - 3.5 END AS v FROM raw)
  SELECT program, count(*) FILTER (WHERE v <> 0) AS n_nonzero, count(v) AS n_any, min(v) FILTER (WHERE v <> 0) AS least, max(v) FILTER (WHERE v <> 0) AS most FROM n GROUP BY program""")
def truthy_scores(spark, d):
    """Zero and missing scores are left out of extremes, and zero counts elsewhere"""
    rows = _raw_rows(spark, d).withColumn("score", scalar.safe_double(F.col("score")) - 3.5)
    score = aggregates.nonzero(F.col("score"))
    return rows.groupBy("program").agg(F.count(score).alias("n_nonzero"), F.count("score").alias("n_any"), F.min(score).alias("least"), F.max(score).alias("most"))


@query(f"{WITH} SELECT document, count(*) AS n_rows FROM apps WHERE admitted IS NOT NULL GROUP BY document")
def outcome_rows(spark, d):
    """B3"""
    return aggregates.with_outcome(applications(spark, d)).groupBy("document").agg(F.count(F.lit(1)).alias("n_rows"))


_FORM = "CASE p_partkey % 9 WHEN 0 THEN 'RESULTADO FINAL' WHEN 1 THEN '' WHEN 2 THEN concat('APELLIDOS ', p_name) WHEN 3 THEN 'DEREXCHNTRKLO' WHEN 4 THEN 'XBCDFGA' WHEN 5 THEN 'ADMINISTRACION DE NEGOCIOS' WHEN 6 THEN upper(p_name) WHEN 7 THEN 'LISTA DE POSTULANTES' ELSE p_brand END"


@query(f"""WITH f AS (SELECT p_partkey, {_FORM} AS form FROM part)
  SELECT p_partkey, NOT regexp_matches(form, '{classify.NOT_A_PROGRAM}') AS is_program,
    len(list_filter(regexp_split_to_array(trim(form), '\\s+'), lambda w: (length(w) >= 12 AND NOT regexp_matches(w, '[AEIOU][^AEIOU][AEIOU]')) OR regexp_matches(w, '[BCDFGHJKLMNPQRSTVWXYZ]{{5}}'))) > 0 AS is_garbled FROM f""")
def program_forms(spark, d):
    """B7, B8"""
    form = F.expr(_FORM)
    return table(spark, d, "part").select("p_partkey", classify.is_program(form).alias("is_program"), classify.is_garbled(form).alias("is_garbled"))


_CELLS = {
    "code": "CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'x12' ELSE cast(o_custkey AS {s}) END",
    "name": "CASE o_orderkey % 4 WHEN 0 THEN 'ANA' WHEN 1 THEN 'ANA LUZ' WHEN 2 THEN NULL ELSE ' ANA  PAZ ' END",
    "condition": "CASE o_orderkey % 7 WHEN 0 THEN 'no ingresó' WHEN 1 THEN 'algo' WHEN 2 THEN NULL ELSE o_orderstatus END",
    "score": "CASE o_orderkey % 3 WHEN 0 THEN '90.5' WHEN 1 THEN '12345.6' ELSE 'NC' END",
    "merit_rank": "CASE o_orderkey % 11 WHEN 0 THEN '7' WHEN 1 THEN 'a' ELSE NULL END",
}
_CONDITION = " OR ".join(f"contains(upper(strip_accents(coalesce(condition, ''))), '{c}')" for c in classify.CONDITIONS)


@query(f"""WITH r AS (SELECT o_orderkey, {", ".join(f"{v.format(s='VARCHAR')} AS {k}" for k, v in _CELLS.items())} FROM orders)
  SELECT o_orderkey, (coalesce(code, '') = '' OR regexp_full_match(coalesce(code, ''), '\\d+'))
    AND (regexp_full_match(coalesce(code, ''), '\\d+') OR len(list_filter(regexp_split_to_array(coalesce(name, ''), '\\s+'), lambda w: w <> '')) >= 2)
    AND (({_CONDITION}) OR regexp_full_match(coalesce(score, ''), '\\d{{1,4}}\\.\\d+') OR regexp_full_match(coalesce(merit_rank, ''), '\\d+')) AS is_row FROM r""")
def data_rows(spark, d):
    """B9"""
    cell = {k: F.expr(v.format(s="STRING")) for k, v in _CELLS.items()}
    row = classify.is_data_row(cell["code"], cell["name"], cell["condition"], cell["score"], cell["merit_rank"])
    return table(spark, d, "orders").select("o_orderkey", row.alias("is_row"))


@query("""WITH c AS (SELECT o_orderkey, cast(year(o_orderdate) + 26 AS VARCHAR) AS cycle FROM orders)
  SELECT cycle, CASE WHEN cycle >= '2024' THEN 'nueva' ELSE 'anterior' END AS scale, count(*) AS n_rows FROM c WHERE cycle >= '2022' GROUP BY ALL""")
def cycles_since(spark, d):
    """B12, B19"""
    rows = table(spark, d, "orders").select((F.year("o_orderdate") + 26).cast("string").alias("cycle")).where(classify.since(F.col("cycle"), "2022"))
    return rows.groupBy("cycle", classify.scale_of(F.col("cycle")).alias("scale")).agg(F.count(F.lit(1)).alias("n_rows"))


_TOKENS = "CASE s_suppkey % 4 WHEN 0 THEN 'INGRESO|90.50|12345678|PEREZ ANA|Nota Minima' WHEN 1 THEN '7.125|NO INGRESO|LUZ DE LA PAZ|1234567' WHEN 2 THEN '88.00|99.25|x' ELSE 'titulo|otro' END"
_N = lambda p: f"len(list_filter(tokens, lambda t: {p}))"


@query(f"""WITH t AS (SELECT s_suppkey, string_split({_TOKENS}, '|') AS tokens FROM supplier),
  n AS (SELECT s_suppkey, tokens, {_N("regexp_full_match(t, '\\d{1,3}\\.\\d{2,}')")} AS n_scores, {_N("regexp_full_match(t, '\\d{8}')")} AS n_codes,
    {_N("regexp_full_match(t, '[A-ZÑÁÉÍÓÚÜ]{2,}(?: [A-ZÑÁÉÍÓÚÜ.]{1,}){1,5}')")} AS n_names, {_N("starts_with(t, 'Nota M')")} AS n_floors FROM t)
  SELECT s_suppkey, n_scores, n_codes, n_names, n_floors, CASE WHEN list_contains(tokens, 'NO INGRESO') THEN 'con_denominador' WHEN list_contains(tokens, 'INGRESO') THEN 'solo_ingresantes'
    WHEN n_scores > 0 THEN 'puntajes_sin_condicion' ELSE 'sin_datos_tabulares' END AS utility FROM n""")
def audit_tokens(spark, d):
    """B13, B14"""
    rows = table(spark, d, "supplier").select("s_suppkey", F.split(F.expr(_TOKENS), r"\|").alias("tokens"))
    counts = {k: v.cast("long") for k, v in classify.token_counts(F.col("tokens")).items()}
    rows = rows.withColumns(counts)
    conditions = F.filter("tokens", lambda t: t.isin("INGRESO", "NO INGRESO"))
    return rows.withColumn("utility", classify.utility_of(F.col("tokens"), conditions, F.col("n_scores"))).drop("tokens")


_EMPTY = "CASE c_custkey % 5 WHEN 0 THEN 'Lista de postulantes aptos' WHEN 1 THEN 'Requisitos y pasos' WHEN 2 THEN 'nada de eso' WHEN 3 THEN '' ELSE 'Expedientes rechazados' END"


@query(f"""WITH d AS (SELECT cast(c_custkey AS VARCHAR) AS document, upper({_EMPTY}) AS t, c_nationkey = 3 AS same FROM customer),
  r AS (SELECT document, CASE WHEN same THEN 'duplicado de otro PDF del mismo proceso' {" ".join("WHEN " + " OR ".join(f"contains(t, '{w}')" for w in words) + f" THEN '{reason}'" for reason, words in classify.EMPTY_REASONS)} ELSE 'sin explicar' END AS reason FROM d
    WHERE document NOT IN (SELECT cast(o_custkey AS VARCHAR) FROM orders WHERE o_custkey % 3 = 0)) SELECT reason, count(*) AS documents, CASE WHEN reason = 'sin explicar' THEN count(*) ELSE 0 END AS unexplained FROM r GROUP BY reason""")
def empty_documents(spark, d):
    """Documents without rows by reason; any that is left unexplained violates the rule"""
    docs = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("document"), F.expr(_EMPTY).alias("text"), (F.col("c_nationkey") == 3).alias("redundant"))
    rows = table(spark, d, "orders").where("o_custkey % 3 = 0").select(F.col("o_custkey").cast("string").alias("document"))
    reasons = quality.empty_documents(docs, rows)
    bad = quality.unexplained(docs, rows).select("document").withColumn("_bad", F.lit(1))
    return reasons.join(bad, "document", "left").groupBy("reason").agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("unexplained"))


_CODE = "CASE c_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'abc' WHEN 2 THEN 'abcdef' WHEN 3 THEN '12' WHEN 4 THEN 'abcdefghijklm' ELSE NULL END"


@query(f"""WITH r AS (SELECT c_custkey, {_CODE} AS code, c_acctbal AS score FROM customer) SELECT c_custkey, 'code' AS rule FROM r WHERE coalesce(code, '') <> '' AND NOT (regexp_full_match(code, '[0-9]+') OR length(code) BETWEEN 6 AND 12)
  UNION ALL SELECT c_custkey, 'score' FROM r WHERE score IS NOT NULL AND NOT (score BETWEEN 0 AND 2000)""")
def domain_rules(spark, d):
    """B25, Q7, Q8"""
    rows = table(spark, d, "customer").select("c_custkey", F.expr(_CODE).alias("code"), F.col("c_acctbal").alias("score"))
    return quality.code_form(rows).select("c_custkey", F.lit("code").alias("rule")).unionByName(quality.score_range(rows).select("c_custkey", F.lit("score").alias("rule")))


_SEAT = "CASE p_partkey % 6 WHEN 0 THEN 'Derecho' WHEN 1 THEN 'DERECHO' WHEN 2 THEN '123' WHEN 3 THEN 'Arte' WHEN 4 THEN '12345' ELSE 'Ñandú y más' END"


@query(f"""WITH t AS (SELECT p_partkey, p_size, {_SEAT} AS token FROM part) SELECT p_partkey, regexp_full_match(token, '\\d{{1,4}}') AS is_number,
  length(token) >= 5 AND NOT regexp_full_match(token, '\\d{{1,4}}') AND upper(token) <> token AND regexp_matches(token, '^[A-ZÁÉÍÓÚÑ][a-záéíóúñ]') AS is_program, p_size + 1 + p_partkey % 3 = p_size + 2 AS adds_up FROM t""")
def seat_tokens(spark, d):
    """B28, B29"""
    token = F.expr(_SEAT)
    adds = classify.seats_add_up([F.col("p_size"), F.lit(1), F.col("p_partkey") % 3], F.col("p_size") + 2)
    return table(spark, d, "part").select("p_partkey", classify.is_seat_number(token).alias("is_number"), classify.is_seat_program(token).alias("is_program"), adds.alias("adds_up"))


@query(f"{WITH} SELECT * FROM (SELECT cycle, program, count(*) AS n_rows FROM apps WHERE cycle = '1996' AND area = 'ASIA' GROUP BY ALL) UNION ALL SELECT 'has', 'NATION_3', cast(count(*) > 0 AS INT) FROM apps WHERE cycle = '1997' AND program = 'NATION_3' UNION ALL SELECT 'state', 'absent', count(*) FILTER (WHERE program = 'none') FROM apps")
def filtered_rows(spark, d):
    """B24, B33"""
    apps = applications(spark, d)
    rows = serving.of_cycle(apps, "1996", area="ASIA").groupBy("cycle", "program").agg(F.count(F.lit(1)).alias("n_rows"))
    has = serving.of_cycle(apps, "1997", program="NATION_3").agg(F.when(F.count(F.lit(1)) > 0, 1).otherwise(0).cast("long").alias("n_rows")).select(F.lit("has").alias("cycle"), F.lit("NATION_3").alias("program"), "n_rows")
    absent = serving.lookup(_counts(spark, d), "program", "none", "applications").select(F.lit("state").alias("cycle"), F.lit("absent").alias("program"), F.coalesce("applications", F.lit(0)).alias("n_rows"))
    return rows.unionByName(has).unionByName(absent)


# ---- joins

_MANIFEST = "SELECT cast(y AS VARCHAR) || '-' || p AS document, 'M' || cast(y % 3 AS VARCHAR) AS modality FROM generate_series(1992, 1996) g(y), (SELECT DISTINCT o_orderpriority AS p FROM orders WHERE o_orderpriority <> '5-LOW')"


@query(f"{WITH}, m AS ({_MANIFEST}) SELECT document, modality, count(*) AS n_rows FROM apps LEFT JOIN m USING (document) GROUP BY ALL")
def manifest_join(spark, d):
    """C1, C19"""
    priorities = table(spark, d, "orders").select(F.col("o_orderpriority").alias("p")).where("p <> '5-LOW'").distinct()
    years = priorities.select("p", F.explode(F.sequence(F.lit(1992), F.lit(1996))).alias("y"))
    manifest = years.select(F.concat_ws("-", F.col("y").cast("string"), "p").alias("document"), F.concat(F.lit("M"), (F.col("y") % 3).cast("string")).alias("modality"))
    return joins.with_manifest(applications(spark, d).select("document"), manifest).groupBy("document", "modality").agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"{WITH}, m AS (SELECT n_name AS form, 'AREA ' || cast(n_regionkey AS VARCHAR) AS canonical FROM nation WHERE n_nationkey % 2 = 0) SELECT coalesce(canonical, program) AS program, count(*) AS n_rows FROM apps LEFT JOIN m ON form = program GROUP BY ALL")
def canonical_names(spark, d):
    """C2"""
    mapping = table(spark, d, "nation").where("n_nationkey % 2 = 0").select(F.col("n_name").alias("form"), F.concat(F.lit("AREA "), F.col("n_regionkey").cast("string")).alias("canonical"))
    return joins.canonical(applications(spark, d).select("program"), mapping).groupBy("program").agg(F.count(F.lit(1)).alias("n_rows"))


_RANKED = "r AS (SELECT cast(l_orderkey % 90 AS VARCHAR) AS document, l_suppkey % 3 AS site, CASE WHEN l_linenumber <> 3 THEN l_linenumber END AS subgroup, cast(l_partkey % 2 AS VARCHAR) AS program, CASE WHEN l_orderkey % 90 < 40 THEN 1 + cast(l_quantity AS INT) % 2 ELSE 3 + cast(l_quantity AS INT) % 9 END AS merit_rank FROM lineitem)"
_CLASSES = "c AS (SELECT cast(k AS VARCHAR) AS document, CASE WHEN k % 4 = 0 THEN 'eligibility' ELSE 'results' END AS doc_class FROM generate_series(0, 69) g(k))"
_GRAIN = f"{_RANKED}, {_CLASSES}, b AS (SELECT document, site, subgroup, program, min(merit_rank) AS first FROM r GROUP BY ALL), g AS (SELECT document, CASE WHEN count(*) FILTER (WHERE first = 1) = count(*) THEN 'per_program' ELSE 'global' END AS grain, coalesce(any_value(doc_class), 'results') AS doc_class FROM b LEFT JOIN c USING (document) GROUP BY document)"


def _ranked(spark, d):
    k = F.col("l_orderkey") % 90
    quantity = F.col("l_quantity").cast("int")
    return table(spark, d, "lineitem").select(
        k.cast("string").alias("document"), (F.col("l_suppkey") % 3).alias("site"), F.when(F.col("l_linenumber") != 3, F.col("l_linenumber")).alias("subgroup"),
        (F.col("l_partkey") % 2).cast("string").alias("program"), F.when(k < 40, 1 + quantity % 2).otherwise(3 + quantity % 9).alias("merit_rank"),
    )


def _grain(spark, d):
    classes = spark.range(70).select(F.col("id").cast("string").alias("document"), F.when(F.col("id") % 4 == 0, "eligibility").otherwise("results").alias("doc_class"))
    return classify.numbering_grain(_ranked(spark, d), classes)


@query(f"WITH {_GRAIN} SELECT * FROM g")
def document_grain(spark, d):
    """Documents without a known class count as results"""
    return _grain(spark, d)


@query(f"""WITH {_GRAIN}, u AS (SELECT r.* FROM r JOIN g USING (document) WHERE grain = 'per_program' AND doc_class = 'results' AND subgroup IS NOT NULL)
  SELECT 'unique' AS rule, document, site, subgroup, program, merit_rank AS value FROM u GROUP BY ALL HAVING count(*) > 1
  UNION ALL SELECT 'starts', document, site, subgroup, program, min(merit_rank) FROM u GROUP BY ALL HAVING min(merit_rank) <> 1""")
def rank_rules(spark, d):
    """C4, Q4, Q5: ranks of documents numbered by programme"""
    rows, grain = _ranked(spark, d), _grain(spark, d)
    twice = quality.rank_is_unique(rows, grain).select(F.lit("unique").alias("rule"), *quality.BLOCK, F.col("merit_rank").alias("value"))
    late = quality.rank_starts_at_one(rows, grain).select(F.lit("starts").alias("rule"), *quality.BLOCK, F.col("first_rank").alias("value"))
    return twice.unionByName(late)


@query(f"""WITH {_RANKED}, o AS (SELECT DISTINCT document, site, subgroup, program, merit_rank + 1 AS gap FROM r WHERE merit_rank % 5 = 0), h AS (SELECT document, site, subgroup, program, max(merit_rank) AS top, count(DISTINCT merit_rank) AS have FROM r GROUP BY ALL),
  n AS (SELECT document, site, subgroup, program, count(*) AS omitted FROM o GROUP BY ALL)
  SELECT h.document, h.site, h.subgroup, h.program, top, have, coalesce(omitted, 0) AS omitted FROM h LEFT JOIN n ON h.document = n.document AND h.site = n.site AND h.subgroup IS NOT DISTINCT FROM n.subgroup AND h.program = n.program WHERE top - coalesce(omitted, 0) <> have""")
def sequence_rule(spark, d):
    """Q10, C6"""
    rows = _ranked(spark, d)
    gaps = rows.where("merit_rank % 5 = 0").select(*quality.BLOCK, (F.col("merit_rank") + 1).alias("gap")).distinct()
    return quality.sequence_complete(rows, gaps)


_FLOORS = "f AS (SELECT cast(year(o_orderdate) AS VARCHAR) AS document, o_orderpriority AS site, o_orderstatus AS subgroup, CASE WHEN o_orderkey % 5 <> 0 THEN (CASE WHEN o_orderstatus = 'O' AND o_orderpriority <> '1-URGENT' THEN 60.5 ELSE o_custkey % 2 END) END::DOUBLE AS floor_score, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS part_1, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice + o_orderkey % 2 END AS part_2, o_totalprice AS score, o_orderkey FROM orders)"


def _floors(spark, d):
    k = F.col("o_orderkey")
    floor = F.when((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") != "1-URGENT"), 60.5).otherwise((F.col("o_custkey") % 2).cast("double"))
    return table(spark, d, "orders").select(
        F.year("o_orderdate").cast("string").alias("document"), F.col("o_orderpriority").alias("site"), F.col("o_orderstatus").alias("subgroup"), F.when(k % 5 != 0, floor).alias("floor_score"),
        F.lit(None).cast("double").alias("part_extra"), F.when(k % 3 != 0, F.col("o_totalprice")).alias("part_1"), F.when(k % 4 != 0, F.col("o_totalprice") + k % 2).alias("part_2"), F.col("o_totalprice").alias("score"), "o_orderkey",
    )


@query(f"WITH {_FLOORS} SELECT document, site, subgroup, count(DISTINCT floor_score) AS floors FROM f WHERE document <> '1996' GROUP BY ALL HAVING count(DISTINCT floor_score) > 1")
def floor_rule(spark, d):
    """Q6, D15"""
    return quality.one_floor(_floors(spark, d), ("1996",))


@query(f"""WITH {_FLOORS}, b AS (SELECT document FROM f GROUP BY document HAVING count(part_1) > 0 AND count(part_2) > 0)
  SELECT o_orderkey, score FROM f WHERE document IN (FROM b) AND (part_1 IS NULL) <> (part_2 IS NULL) AND abs(coalesce(part_1, part_2) - score) > 0.001""")
def lone_part_rule(spark, d):
    """Q2, D16"""
    return quality.single_part_is_score(_floors(spark, d)).select("o_orderkey", "score")


_LISTED = """docs AS (SELECT cast(l_orderkey % 60 AS VARCHAR) AS document, 1000 * (l_orderkey // 60) + l_linenumber AS line_no, CASE WHEN l_linenumber = 1 THEN 'P' || cast(l_partkey % 3 AS VARCHAR) WHEN l_linenumber = 5 THEN 'pie' ELSE ' ' || cast(cast(l_quantity AS INT) AS VARCHAR) || ' x' END AS line FROM (SELECT DISTINCT ON (l_orderkey, l_linenumber) * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity)),
  m AS (SELECT *, CASE WHEN starts_with(line, 'P') THEN line END AS program, CASE WHEN regexp_matches(trim(line), '^\\d{1,4}\\s') THEN cast(regexp_extract(trim(line), '^(\\d{1,4})\\s', 1) AS INT) END AS rank FROM docs),
  n AS (SELECT *, sum(CASE WHEN program IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY document ORDER BY line_no) AS block_no FROM m),
  o AS (SELECT *, first_value(program) OVER w AS title, max(CASE WHEN rank IS NOT NULL THEN 1 ELSE 0 END) OVER w AS begun FROM n WHERE block_no > 0 WINDOW w AS (PARTITION BY document, block_no ORDER BY line_no)),
  e AS (SELECT *, max(CASE WHEN begun = 1 AND rank IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY document, block_no ORDER BY line_no) AS ended FROM o),
  blocks AS (SELECT document, cast(block_no AS BIGINT) AS block_no, title AS program, rank FROM e WHERE rank IS NOT NULL AND ended = 0)"""


def _blocks(spark, d):
    first = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct("l_partkey", "l_quantity")).alias("v"))
    number = F.col("l_linenumber")
    line = F.when(number == 1, F.concat(F.lit("P"), (F.col("v.l_partkey") % 3).cast("string"))).when(number == 5, "pie").otherwise(F.concat(F.lit(" "), F.col("v.l_quantity").cast("int").cast("string"), F.lit(" x")))
    lines = first.select((F.col("l_orderkey") % 60).cast("string").alias("document"), (1000 * F.floor(F.col("l_orderkey") / 60) + number).alias("line_no"), line.alias("line"))
    return joins.text_blocks(lines.withColumn("program", F.when(F.startswith("line", F.lit("P")), F.col("line"))))


@query(f"WITH {_LISTED} SELECT * FROM blocks")
def listed_blocks(spark, d):
    """P10"""
    return _blocks(spark, d)


@query(f"""WITH {_LISTED}, tops AS (SELECT document, program, block_no, max(rank) AS block_max FROM blocks GROUP BY ALL), f AS (SELECT document, program, block_max, min(block_no) AS block_no FROM tops GROUP BY ALL),
  gaps AS (SELECT document, program, block_max, unnest(generate_series(1, 12)) AS missing_rank FROM f UNION ALL SELECT document, 'unknown', 9, 4 FROM (SELECT DISTINCT document FROM blocks))
  SELECT gaps.document, gaps.program, gaps.block_max, gaps.missing_rank, CASE WHEN f.block_no IS NULL THEN 'unverified' WHEN EXISTS (SELECT 1 FROM blocks b WHERE b.document = gaps.document AND b.block_no = f.block_no AND b.rank = gaps.missing_rank) THEN 'lost' ELSE 'source' END AS origin
  FROM gaps LEFT JOIN f USING (document, program, block_max)""")
def gap_origins(spark, d):
    """Q9"""
    blocks = _blocks(spark, d)
    tops = blocks.groupBy("document", "block_no", "program").agg(F.max("rank").alias("block_max")).select("document", "program", "block_max").distinct()
    gaps = tops.select("*", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("missing_rank"))
    other = blocks.select("document").distinct().select("document", F.lit("unknown").alias("program"), F.lit(9).alias("block_max"), F.lit(4).alias("missing_rank"))
    return joins.gap_origin(gaps.unionByName(other), blocks).select("document", "program", "block_max", "missing_rank", "origin")


_THREE = "a AS (SELECT n_name AS program FROM nation WHERE n_nationkey < 12), b AS (SELECT n_name AS program FROM nation WHERE n_nationkey BETWEEN 8 AND 18), c AS (SELECT DISTINCT n_name AS program FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 9 = 0)"


def _three(spark, d):
    nation = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("program"))
    used = table(spark, d, "customer").where("c_custkey % 9 = 0").select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    return nation.where("n_nationkey < 12").select("program"), nation.where("n_nationkey between 8 and 18").select("program"), nation.join(used, "n_nationkey", "left_semi").select("program")


@query(f"WITH {_THREE} SELECT program FROM a UNION SELECT program FROM b UNION SELECT program FROM c")
def known_names(spark, d):
    """G7, G5, G6"""
    return joins.known_names(*_three(spark, d))


@query(f"WITH {_THREE} SELECT program, CASE WHEN program IN (FROM a) THEN 'a' WHEN program IN (FROM b) THEN 'b' ELSE 'c' END AS origin FROM (SELECT program FROM a UNION SELECT program FROM b UNION SELECT program FROM c)")
def first_origins(spark, d):
    """What several sources have keeps the first of them"""
    return joins.first_origin(*zip("abc", _three(spark, d)), key="program")


# ---- aggregates

_EXTRACT = "x AS (SELECT cast(l_orderkey % 50 AS VARCHAR) AS document, 'P' || cast(l_partkey % 13 AS VARCHAR) AS program, CASE WHEN l_linenumber % 3 <> 0 THEN l_discount END AS floor_score, l_returnflag AS condition FROM lineitem)"


def _extract(spark, d):
    return table(spark, d, "lineitem").select(
        (F.col("l_orderkey") % 50).cast("string").alias("document"), F.concat(F.lit("P"), (F.col("l_partkey") % 13).cast("string")).alias("program"),
        F.when(F.col("l_linenumber") % 3 != 0, F.col("l_discount")).alias("floor_score"), F.col("l_returnflag").alias("condition"),
    )


@query(f"WITH {_EXTRACT} SELECT document, count(*) AS n_rows, count(DISTINCT program) AS n_programs, count(DISTINCT floor_score) AS n_floors FROM x GROUP BY document")
def extract_summary(spark, d):
    """D30"""
    return aggregates.extract_summary(_extract(spark, d))


_CATALOGUE = "k AS (SELECT 'P' || cast(v AS VARCHAR) AS program FROM generate_series(0, 9) g(v))"


def _catalogue(spark):
    return spark.range(10).select(F.concat(F.lit("P"), F.col("id").cast("string")).alias("program"))


@query(f"WITH {_EXTRACT}, {_CATALOGUE} SELECT document, count(*) FILTER (WHERE program IN (FROM k)) AS kept, count(*) FILTER (WHERE program NOT IN (FROM k)) AS dropped FROM x GROUP BY document")
def catalogue_drops(spark, d):
    """B6, D31, G2"""
    kept, dropped = aggregates.drop_counts(_extract(spark, d), _catalogue(spark))
    have = kept.groupBy("document").agg(F.count(F.lit(1)).alias("kept"))
    return have.join(dropped, "document", "full_outer").na.fill(0, ["kept", "dropped"])


@query(f"""WITH {_EXTRACT}, {_CATALOGUE}, c AS (SELECT *, CASE WHEN cast(document AS INT) % 3 = 0 THEN 'eligibility' ELSE 'results' END AS doc_class FROM x)
  SELECT doc_class, 100.0::DOUBLE * count(*) FILTER (WHERE program NOT IN (FROM k)) / count(*) AS lost_pct, 100.0::DOUBLE * count(*) FILTER (WHERE program NOT IN (FROM k)) / count(*) < 1 AS within FROM c GROUP BY doc_class""")
def loss_rate(spark, d):
    """Q23, D31"""
    rows = _extract(spark, d)
    kept, dropped = aggregates.drop_counts(rows, _catalogue(spark))
    classes = spark.range(50).where("id % 3 = 0").select(F.col("id").cast("string").alias("document"), F.lit("eligibility").alias("doc_class"))
    return aggregates.loss_rate(dropped, kept, classes).withColumn("within", F.col("lost_pct") < 1)


@query(f"WITH {_EXTRACT} SELECT condition, count(*) AS times FROM x GROUP BY condition")
def vocabulary(spark, d):
    """D35"""
    return aggregates.vocabulary(_extract(spark, d), "condition")


@query(f"{WITH}, {COUNTS} SELECT 'cycle' AS by, cycle AS key, cast(sum(applications) AS BIGINT) AS applications, cast(sum(admitted) AS BIGINT) AS admitted FROM counts GROUP BY cycle UNION ALL SELECT 'program', program, cast(sum(applications) AS BIGINT), cast(sum(admitted) AS BIGINT) FROM counts GROUP BY program")
def cross_foot(spark, d):
    """D36, D38"""
    counts = _counts(spark, d)
    by = lambda k: aggregates.totals(counts, (k,), "applications", "admitted").select(F.lit(k).alias("by"), F.col(k).alias("key"), "applications", "admitted")
    return by("cycle").unionByName(by("program"))


@query("WITH r AS (SELECT l_orderkey % 40 AS document, l_linenumber AS page, count(*) AS n_rows FROM lineitem GROUP BY ALL), p AS (SELECT document, page, n_rows + CASE WHEN document = 3 THEN 1 ELSE 0 END AS n_rows FROM r WHERE page <> 2 OR document <> 5) SELECT document, page, coalesce(r.n_rows, 0) AS left_n_rows, coalesce(p.n_rows, 0) AS right_n_rows FROM r FULL JOIN p USING (document, page) WHERE coalesce(r.n_rows, 0) <> coalesce(p.n_rows, 0)")
def page_recount(spark, d):
    """Rows of each page by two methods"""
    rows = table(spark, d, "lineitem").select((F.col("l_orderkey") % 40).alias("document"), F.col("l_linenumber").alias("page"))
    plain = aggregates.rows_per_page(rows)
    parsed = plain.where("page <> 2 or document <> 5").withColumn("n_rows", F.col("n_rows") + F.when(F.col("document") == 3, 1).otherwise(0))
    return quality.page_counts(plain, parsed)


# ---- order and limits

@query("SELECT DISTINCT p_name AS program, length(p_name) AS n FROM part ORDER BY n DESC, program LIMIT 20")
def longest_names(spark, d):
    """F5"""
    return joins.by_length(table(spark, d, "part").select(F.col("p_name").alias("program"))).limit(20)


@query(f"{WITH}, {COUNTS} SELECT cycle, program, applications AS was, admitted AS now FROM counts ORDER BY abs(applications - admitted) DESC, cycle, program LIMIT 10")
def worst_differences(spark, d):
    """F6"""
    return serving.worst(_counts(spark, d).select("cycle", "program", F.col("applications").alias("was"), F.col("admitted").alias("now")), "was", "now")


@query(f"""WITH {_FLOORS}, v AS (SELECT 'range' AS rule, o_orderkey FROM f WHERE score > 2000 UNION ALL SELECT 'even', o_orderkey FROM f WHERE o_orderkey % 2 = 0)
  SELECT rule, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY o_orderkey) AS n FROM v) WHERE n <= 5""")
def rule_examples(spark, d):
    """F7"""
    rows = _floors(spark, d).select("o_orderkey", "score")
    rules = [quality.Rule("range", quality.score_range(rows).select("o_orderkey")), quality.Rule("even", rows.where("o_orderkey % 2 = 0").select("o_orderkey"))]
    return quality.examples(rules, 5, "o_orderkey")


@query(f"{WITH}, {COUNTS} SELECT row_number() OVER (ORDER BY cycle, program) AS line, cycle, program, applications FROM counts")
def sorted_sink(spark, d):
    """A sorted file of named columns, read back in its order"""
    path = scratch(spark)
    writers.write_sorted(_counts(spark, d), path, ["cycle", "program", "applications"], ["cycle", "program"])
    back = readers.read_strings(spark, path, strings("cycle", "program", "applications"))
    # one file: the place of a row in it is the order it was written in
    return back.select((F.monotonically_increasing_id() + 1).alias("line"), "cycle", "program", F.col("applications").cast("long").alias("applications"))


@query(f"{WITH}, {COUNTS}, b AS (SELECT cycle, program, min(score) AS low, max(score) AS high FROM apps WHERE admitted AND score IS NOT NULL GROUP BY ALL HAVING count(*) >= 5) SELECT cycle, program, applications, low, high FROM counts JOIN b USING (cycle, program) ORDER BY applications DESC, program, cycle LIMIT 8")
def lollipops(spark, d):
    """V1, V7, F3, F4"""
    box = aggregates.score_box(applications(spark, d))
    return serving.boxes_of(_counts(spark, d), box, 8).select("cycle", "program", "applications", "low", "high")


@query(f"{WITH}, {COUNTS} SELECT cycle, program, applications, applications / max(applications) OVER ()::DOUBLE AS to_max FROM counts ORDER BY applications DESC, cycle, program LIMIT 7")
def bar_heads(spark, d):
    """V2, V5, F4"""
    top = serving.top_programs(_counts(spark, d).select("cycle", "program", "applications"), n=7).withColumn("all", F.lit(1))
    return windows.ratio_to_max(top, "applications", ("all",)).drop("all")


@query(f"{WITH}, {COUNTS}, s AS (SELECT cycle, sum(applications) AS v FROM counts WHERE cycle <> '1997' GROUP BY cycle) SELECT cycle, (v - (SELECT min(v) FROM s))::DOUBLE / ((SELECT max(v) FROM s) - (SELECT min(v) FROM s)) AS y FROM s")
def sparkline(spark, d):
    """V8"""
    series = _counts(spark, d).groupBy("cycle").agg(F.sum("applications").alias("v")).withColumn("v", F.when(F.col("cycle") != "1997", F.col("v")))
    return serving.sparkline(series, "v")


# ---- text of cells

_CELL = "CASE p_partkey % 6 WHEN 0 THEN concat('EXAMEN ', p_name, ' - CAMANA') WHEN 1 THEN concat('12 ', p_name) WHEN 2 THEN 'CICLO - III' WHEN 3 THEN concat('Nota Mínima  61.75 y ', p_name) WHEN 4 THEN concat('/a/b%20c/', p_name, '.pdf') ELSE p_name END"
_FIRST_DECIMAL = "CASE WHEN regexp_matches(cell, '\\d+\\.\\d+') THEN cast(regexp_extract(cell, '(\\d+\\.\\d+)', 1) AS DOUBLE) END"


@query(f"""WITH c AS (SELECT p_partkey, p_size, p_retailprice, {_CELL} AS cell FROM part), s AS (SELECT *, trim(regexp_extract(cell, '{scalar.SITE}', 1)) AS place FROM c)
  SELECT p_partkey, trim(regexp_replace(upper(strip_accents(cell)), '\\s+', ' ', 'g')) AS parser_name, CASE WHEN place <> '' AND place NOT IN ('I', 'II', 'III', 'IV', 'V') THEN place END AS site,
    CASE WHEN regexp_matches(cell, '^\\d+\\s+\\S') THEN regexp_extract(cell, '^(\\d+)\\s+(\\S.*)$', 1) END AS rank, CASE WHEN regexp_matches(cell, '^\\d+\\s+\\S') THEN regexp_extract(cell, '^(\\d+)\\s+(\\S.*)$', 2) END AS rest,
    {_FIRST_DECIMAL} AS number, replace(regexp_extract(cell, '([^/]*)$', 1), 'b%20c', 'b c') AS base, cell || '|' || cast(p_size AS VARCHAR) AS pair,
    string_split(cell || '|' || cast(p_size AS VARCHAR), '|')[1] AS head, CASE WHEN length(cell) > 12 THEN left(cell, 11) || '…' ELSE cell END AS short FROM s""")
def cell_forms(spark, d):
    """H3, H6, H7, H8, H15, H17, H19"""
    rows = table(spark, d, "part").select("p_partkey", "p_size", F.expr(_CELL).alias("cell"))
    cell = F.col("cell")
    rank, rest = scalar.leading_rank(cell)
    pair = scalar.joined(cell, F.col("p_size").cast("string"))
    return rows.select(
        "p_partkey", scalar.parser_name(cell).alias("parser_name"), scalar.trailing_site(cell).alias("site"), rank.alias("rank"), rest.alias("rest"), scalar.first_decimal(cell).alias("number"),
        scalar.base_name(cell).alias("base"), pair.alias("pair"), scalar.split_once(pair)[0].alias("head"), scalar.shorten(cell, 12).alias("short"),
    )


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 IN (1, 3) THEN round_even(cast(c_custkey AS DOUBLE) / 4 * 10, 0) / 10 ELSE round_even(cast(c_custkey AS DOUBLE) / 8 * 10, 0) / 10 END AS rounded, format('{:,}', c_custkey * 1003) AS shown FROM customer")
def published_numbers(spark, d):
    """Ties to even, and separators of thousands"""
    key = F.col("c_custkey")
    value = F.when((key % 4).isin(1, 3), key.cast("double") / 4 * 10).otherwise(key.cast("double") / 8 * 10)
    return table(spark, d, "customer").select("c_custkey", (scalar.half_even(value, 0) / 10).alias("rounded"), scalar.thousands(key * 1003).alias("shown"))


_TWICE = "trim(regexp_replace(regexp_replace(upper(strip_accents({})), '[^A-Za-z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(f"WITH n AS (SELECT p_partkey, {_CELL} AS cell FROM part), o AS (SELECT p_partkey, {_TWICE.format('cell')} AS once FROM n) SELECT p_partkey, sha256(once) AS digest, sha256({_TWICE.format('once')}) = sha256(once) AS same FROM o")
def normalise_twice(spark, d):
    """Q20, H2: a second normalisation changes no byte"""
    once = scalar.catalogue_name(F.expr(_CELL))
    rows = table(spark, d, "part").select("p_partkey", once.alias("once"))
    return rows.select("p_partkey", F.sha2("once", 256).alias("digest"), (F.sha2(scalar.catalogue_name(F.col("once")), 256) == F.sha2("once", 256)).alias("same"))


# ---- rules between layers

_ROUTE = "routes AS (SELECT cycle, program, route, count(*) FILTER (WHERE admitted) AS admitted FROM apps WHERE admitted IS NOT NULL GROUP BY ALL)"
_BIN = "bins AS (SELECT cycle, program, count(*) AS applications FROM apps WHERE admitted IS NOT NULL AND score IS NOT NULL GROUP BY ALL)"
_DELTA = "deltas AS (SELECT * FROM (SELECT cycle, program, applications, lag(applications) OVER (PARTITION BY program ORDER BY cycle) AS previous FROM counts) WHERE previous IS NOT NULL AND previous <> 0)"
_BOXED = "boxed AS (SELECT cycle, program, count(*) AS n, min(score) AS low FROM apps WHERE admitted AND score IS NOT NULL GROUP BY ALL HAVING count(*) >= 5)"
_PARTS = {
    "every programme has an area": "SELECT count(DISTINCT program) FROM counts WHERE program NOT IN (SELECT n_name FROM nation WHERE n_nationkey % 11 <> 0)",
    "change reproduces the division": "SELECT count(*) FROM deltas WHERE program = 'NATION_3'",
    "box reproduced": "SELECT count(*) FROM boxed WHERE program IN ('NATION_4', 'NATION_5')",
    "no negative score in a box": "SELECT count(*) FROM boxed WHERE program = 'NATION_6'",
    "crossed seats equal": "SELECT count(*) FROM counts WHERE admitted > 0 AND program IN ('NATION_7', 'NATION_8')",
    "routes sum to the record": "SELECT count(*) FROM counts c WHERE coalesce((SELECT sum(admitted) FROM routes r WHERE r.cycle = c.cycle AND r.program = c.program AND route <> '2-HIGH'), 0) <> c.admitted OR NOT EXISTS (SELECT 1 FROM routes r WHERE r.cycle = c.cycle AND r.program = c.program AND route <> '2-HIGH')",
    "areas sum to the cycle": "SELECT count(DISTINCT cycle) FROM counts WHERE program = 'NATION_9'",
    "announced programmes have rows": "SELECT count(*) FROM (SELECT cast(y AS VARCHAR) AS cycle, n_name AS program FROM nation, generate_series(1995, 2003) g(y)) a ANTI JOIN counts USING (cycle, program)",
    "no invented row": "SELECT count(*) FROM counts WHERE program = 'NATION_10'",
    "cycle totals agree": "SELECT count(*) FROM counts WHERE program = 'NATION_11'",
    "histogram sums": "SELECT count(*) FROM bins WHERE program = 'NATION_12'",
    "row counts agree": "SELECT count(*) FROM counts WHERE program = 'NATION_13'",
}


@query(f"{WITH}, {COUNTS}, {_ROUTE}, {_BIN}, {_DELTA}, {_BOXED} " + " UNION ALL ".join(f"SELECT '{rule}' AS rule, ({sql}) AS violations" for rule, sql in _PARTS.items()))
def payload_rules(spark, d):
    """Q30-Q42: each rule on published figures with known faults in one or two programmes"""
    apps = applications(spark, d).select("cycle", "program", "route", "score", "admitted", "floor_score", "row_seq")
    counts = _counts(spark, d)
    is_one = lambda *names: F.col("program").isin(*names)
    areas = table(spark, d, "nation").where("n_nationkey % 11 <> 0").select(F.col("n_name").alias("program"), F.lit("a").alias("area"))
    delta = windows.yoy_delta(counts.select("cycle", "program", "applications"))
    box = aggregates.score_box(apps)
    bad_box = box.withColumn("n", F.col("n") + F.when(is_one("NATION_4"), 1).otherwise(0)).withColumn("q3", F.when(is_one("NATION_5"), F.col("q1") - 1).otherwise(F.col("q3")))
    gold = counts.select("cycle", "program", (F.col("admitted") > 0).alias("crossed"), F.col("admitted").cast("double").alias("occupancy_pct"))
    seats = gold.where("crossed").where(~is_one("NATION_7")).withColumn("occupancy_pct", F.col("occupancy_pct") + F.when(is_one("NATION_8"), 1).otherwise(0))
    routes = aggregates.with_outcome(apps).groupBy("cycle", "program", "route").agg(F.count_if("admitted").alias("admitted"))
    listed = routes.withColumn("route", F.when(F.col("route") == "2-HIGH", "lista_aptos").otherwise(F.col("route")))
    announced = table(spark, d, "nation").select(F.col("n_name").alias("program"), F.explode(F.transform(F.sequence(F.lit(1995), F.lit(2003)), lambda y: y.cast("string"))).alias("cycle"))
    histogram = aggregates.score_histogram(apps, 1000).where(~is_one("NATION_12"))
    one_more = counts.withColumn("applications", F.col("applications") + F.when(is_one("NATION_11"), 1).otherwise(0))
    rules = {
        "every programme has an area": quality.without_area(counts, areas),
        "change reproduces the division": quality.delta_reproduced(delta.withColumn("delta_pct", F.col("delta_pct") + F.when(is_one("NATION_3"), 1).otherwise(0)), counts),
        "box reproduced": quality.box_reproduced(bad_box, apps),
        "no negative score in a box": quality.negative_scores(box.withColumn("low", F.when(is_one("NATION_6"), -1.0).otherwise(F.col("low")))),
        "crossed seats equal": quality.crossed_seats(seats, gold),
        "routes sum to the record": quality.routes_sum(listed, counts),
        "areas sum to the cycle": quality.areas_sum(counts.where(~is_one("NATION_9")), counts),
        "announced programmes have rows": quality.announced_missing(announced, counts),
        "no invented row": quality.invented(counts, counts.where(~is_one("NATION_10"))),
        "cycle totals agree": quality.gold_matches(one_more, counts),
        "histogram sums": quality.histogram_sums(histogram, apps),
        "row counts agree": quality.gold_matches(counts.where(~is_one("NATION_13")), counts),
    }
    return quality.report([quality.Rule(name, found) for name, found in rules.items()]).select("rule", "violations")


@query("""WITH a AS (SELECT DISTINCT o_custkey AS document FROM orders), b AS (SELECT c_custkey AS document FROM customer WHERE c_custkey % 7 <> 0), c AS (SELECT DISTINCT o_custkey AS document FROM orders WHERE o_orderstatus = 'F')
  SELECT document FROM (SELECT document FROM a UNION SELECT document FROM b UNION SELECT document FROM c) WHERE document NOT IN (FROM a) OR document NOT IN (FROM b) OR document NOT IN (FROM c)""")
def chain_counts(spark, d):
    """Q21, A16"""
    orders, customer = table(spark, d, "orders"), table(spark, d, "customer")
    document = lambda df, c: df.select(F.col(c).alias("document"))
    return quality.chain_counts(document(orders, "o_custkey"), document(customer.where("c_custkey % 7 <> 0"), "c_custkey"), document(orders.where("o_orderstatus = 'F'"), "o_custkey")).select("document")


@query("""WITH n AS (SELECT n_nationkey, n_name, count(c_custkey) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL)
  SELECT 'customers cited' AS rule, count(*) FILTER (WHERE n_nationkey % 2 = 1) AS violations FROM n UNION ALL SELECT 'undocumented scripts', count(*) FILTER (WHERE n_nationkey % 3 <> 0) FROM n""")
def documentation_rules(spark, d):
    """Figures that the texts have to cite, and scripts that have to say what they do; every other text cites another figure"""
    path = scratch(spark)
    customers = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    n = table(spark, d, "nation").join(customers, "n_nationkey", "left").na.fill(0, ["n"])
    figure = lambda more: F.concat("n_name", F.lit(" has "), (F.col("n") + more).cast("string"), F.lit(" customers."))
    name = F.concat(F.col("n_nationkey").cast("string"), F.lit(".md"))
    texts = n.select(name.alias("name"), figure(F.col("n_nationkey") % 2).alias("text"))
    said = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit('# a note\n"""'), "n_name", F.lit('"""\n'))).otherwise("")
    scripts = n.select(F.concat(F.col("n_nationkey").cast("string"), F.lit(".py")).alias("name"), F.concat(said, F.lit("x = 1\n")).alias("text"))
    writers.write_files(texts.unionByName(scripts).withColumn("at", F.lit(0)), path, "name", "at", "text")
    files = readers.read_text_files(spark, [path])
    live = n.select(F.lit("customers cited").alias("rule"), figure(F.lit(0)).alias("figure"))
    found = quality.not_cited(files.where("path like '%.md'"), live).groupBy("rule").agg(F.count(F.lit(1)).alias("violations"))
    cited = live.select("rule").distinct().join(found, "rule", "left").na.fill(0)
    bare = quality.without_docstring(files.where("path like '%.py'")).agg(F.count(F.lit(1)).alias("violations")).select(F.lit("undocumented scripts").alias("rule"), "violations")
    return cited.unionByName(bare)


# ---- sources and sinks

def _nation_strings(spark, d):
    cell = lambda c: F.col(c).cast("string").alias(c)
    return table(spark, d, "nation").select(cell("n_nationkey"), F.when(F.col("n_nationkey") % 5 != 0, F.col("n_name")).alias("n_name"), cell("n_regionkey"))


@query("SELECT cast(n_regionkey AS VARCHAR) AS cycle, cast(n_nationkey AS VARCHAR) AS n_nationkey, CASE WHEN n_nationkey % 5 <> 0 THEN n_name END AS n_name FROM nation")
def csv_by_cycle(spark, d):
    """A folder of strings for each cycle, empty cells null, the cycle from the folder's name"""
    path = scratch(spark)
    _nation_strings(spark, d).withColumnRenamed("n_regionkey", "cycle").write.partitionBy("cycle").option("header", True).csv(path)
    back = readers.read_cycles(spark, path, strings("n_nationkey", "n_name"))
    return back.select(F.regexp_replace("cycle", "^cycle=", "").alias("cycle"), "n_nationkey", "n_name")


@query("SELECT cast(n_nationkey AS VARCHAR) AS n_nationkey, CASE WHEN n_nationkey % 5 <> 0 THEN n_name END AS n_name, CASE WHEN n_nationkey % 2 = 0 THEN cast(n_regionkey AS VARCHAR) END AS n_regionkey FROM nation")
def csv_by_name(spark, d):
    """Files whose headers differ in columns and order"""
    rows, path = _nation_strings(spark, d), scratch(spark)
    rows.where("n_nationkey % 2 = 0").select("n_regionkey", "n_name", "n_nationkey").write.option("header", True).csv(f"{path}/a")
    rows.where("n_nationkey % 2 = 1").select("n_nationkey", "n_name").write.option("header", True).csv(f"{path}/b")
    return readers.read_by_name(spark, [f"{path}/a", f"{path}/b"]).select("n_nationkey", "n_name", "n_regionkey")


@query("SELECT cast(n_regionkey AS VARCHAR) AS n_regionkey, count(*) AS n_rows, count(CASE WHEN n_nationkey % 5 <> 0 THEN n_name END) AS n_names FROM nation GROUP BY ALL")
def csv_in_sql(spark, d):
    """A CSV in FROM"""
    path = scratch(spark)
    _nation_strings(spark, d).write.option("header", True).csv(path)
    name = readers.csv_relation(spark, path, "csv_in_sql_nation", strings("n_nationkey", "n_name", "n_regionkey"))
    return spark.sql(f"SELECT n_regionkey, count(*) AS n_rows, count(n_name) AS n_names FROM {name} GROUP BY n_regionkey")


@query("SELECT 'kept_' || cast(n_nationkey AS VARCHAR) AS stem, n_nationkey % 2 = 0 AS new FROM nation WHERE n_nationkey % 3 = 0")
def file_inventory(spark, d):
    """Files on disk by name, and which of them are not in yet"""
    path = scratch(spark)
    names = F.concat(F.when(F.col("n_nationkey") % 3 == 0, "kept_").otherwise("other_"), F.col("n_nationkey").cast("string"))
    table(spark, d, "nation").select(names.alias("stem"), F.repeat(F.lit("x"), 1500).alias("value")).write.partitionBy("stem").text(path)
    stem = F.regexp_extract("path", r"stem=([^/]+)/", 1)
    files = readers.inventory(spark, path, "*.txt", named="kept_").select(stem.alias("document"), "bytes")
    have = table(spark, d, "nation").where("n_nationkey % 2 = 1").select(F.concat(F.lit("kept_"), F.col("n_nationkey").cast("string")).alias("document"))
    new = readers.not_ingested(files, have).select("document", F.lit(True).alias("new"))
    return files.select("document").join(new, "document", "left").select(F.col("document").alias("stem"), F.coalesce("new", F.lit(False)).alias("new"))


@query("SELECT p_brand AS brand, sha256(string_agg(p_name, chr(10) ORDER BY p_partkey)) AS digest, count(*) AS n_lines FROM part GROUP BY p_brand")
def text_files(spark, d):
    """Whole texts, line breaks and all, streamed to one file for each brand and read back"""
    path = scratch(spark)
    parts = table(spark, d, "part")
    first = parts.groupBy("p_brand").agg(F.min("p_partkey").alias("first"))
    lines = parts.join(first, "p_brand").select("p_brand", "p_partkey", F.concat(F.when(F.col("p_partkey") == F.col("first"), "").otherwise("\n"), "p_name").alias("line"))
    writers.write_files(lines, path, "p_brand", "p_partkey", "line", ".txt")
    back = readers.read_text_files(spark, [f"{path}/*.txt"]).select(F.regexp_extract(F.try_url_decode("path"), r"([^/]+)\.txt$", 1).alias("brand"), "text")
    return back.select("brand", F.sha2("text", 256).alias("digest"), F.size(F.split("text", "\n")).cast("long").alias("n_lines"))


@query("SELECT r_regionkey, r_name FROM region")
def json_object(spark, d):
    """One JSON object written and read"""
    path = scratch(spark)
    regions = table(spark, d, "region").agg(F.to_json(F.struct(F.array_sort(F.collect_list(F.struct("r_regionkey", "r_name"))).alias("regions"))).alias("value"))
    writers.write_json_object(regions, path)
    back = readers.read_payload(spark, path).select(F.explode("regions").alias("r"))
    return back.select(F.col("r.r_regionkey").cast("int").alias("r_regionkey"), "r.r_name")


@query("SELECT n_name AS program, r_name AS area FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE')")
def area_dimension(spark, d):
    """The constant dimension"""
    places = table(spark, d, "nation").join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey")).where("r_name in ('ASIA', 'EUROPE')").select("r_name", "n_name")
    members: dict[str, list[str]] = {}
    for row in places.collect():  # a handful: the two dimensions are of fixed size
        members.setdefault(row["r_name"], []).append(row["n_name"])
    return readers.areas(spark, members)


@query("SELECT n_regionkey, count(*) AS n_rows FROM nation GROUP BY ALL")
def saved_table(spark, d):
    """A table replaced as a whole"""
    name = "saved_by_region"
    writers.save_table(table(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey")), name)
    return writers.save_table(table(spark, d, "nation").select("n_nationkey", "n_regionkey"), name).groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n_rows"))


_FIELD = "CASE p_partkey % 4 WHEN 0 THEN concat('a\"', p_name) WHEN 1 THEN concat(p_name, ', b') WHEN 2 THEN NULL ELSE p_name END"


@query(f"""WITH f AS (SELECT p_partkey, {_FIELD} AS name FROM part) SELECT 0 AS part, chr(65279) || 'p_partkey,name' AS line UNION ALL
  SELECT 1, cast(p_partkey AS VARCHAR) || ',' || CASE WHEN name IS NULL THEN '' WHEN regexp_matches(name, '[",]') THEN '"' || replace(name, '"', '""') || '"' ELSE name END FROM f""")
def export_lines(spark, d):
    """Quoted where it has to be, the byte-order mark first"""
    rows = table(spark, d, "part").select("p_partkey", F.expr(_FIELD).alias("name"))
    return writers.export_lines(rows, numbered=True)


# ---- documents and page geometry

def _pdf_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small PDFs with known tokens: a glyph map, a first page of coded and literal strings, a second of arrays."""
    for b in batches:
        made = []
        for brand, name in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            letters = sorted(set(brand))
            glyphs = "1 begincodespacerange <0000> <FFFF> endcodespacerange\n" + f"{len(letters)} beginbfchar\n" + "\n".join(f"<{k + 1:04X}> <{ord(c):04X}>" for k, c in enumerate(letters)) + "\nendbfchar"
            coded = "".join(f"{letters.index(c) + 1:04X}" for c in brand)
            first = f"BT /F1 9 Tf (EXAMEN ORDINARIO 2023) Tj (29/08/2022) Tj <{coded}> Tj (DERECHO \\(X\\)) Tj (Total) Tj (NO INGRESO) Tj ET"
            second = f"BT [({name[:3]}) -20 ({name[3:]})] TJ (12) Tj ET"
            body = b"%PDF-1.4\n/Type /Page \n/Type /Page \n"
            for text in (glyphs, first, second):
                body += b"stream\n" + zlib.compress(text.encode("latin-1")) + b"endstream\n"
            made.append(body)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.binary())], ["document", "content"])


def _pdfs(spark, d):
    rows = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("document"), "p_brand", F.regexp_replace("p_name", r"[^A-Za-z0-9_ #]", "").alias("p_name"))
    return dealt(rows).mapInArrow(_pdf_bytes, "document string, content binary")


@query("""SELECT cast(p_partkey AS VARCHAR) AS document, p AS page, k AS position, CASE WHEN k = 0 AND p = 1 THEN p_brand ELSE t END AS token FROM part,
  (VALUES (1, 0, ''), (1, 1, 'EXAMEN ORDINARIO 2023'), (1, 2, '29/08/2022'), (1, 3, 'DERECHO (X)'), (1, 4, 'Total'), (1, 5, 'NO INGRESO'), (2, 0, '12')) v(p, k, t)""")
def pdf_token_scan(spark, d):
    """Tokens of compressed content streams, coded strings by way of the glyph map"""
    return readers.token_rows(_pdfs(spark, d)).select("document", "page", "position", "token")


@query("""SELECT cast(p_partkey AS VARCHAR) AS document, p AS page, k AS position, CASE WHEN p = 2 AND k = 0 THEN trim(regexp_replace(p_name, '[^A-Za-z0-9_ #]', '', 'g')) ELSE t END AS token FROM part,
  (VALUES (1, 0, 'EXAMEN ORDINARIO 2023'), (1, 1, '29/08/2022'), (1, 2, 'DERECHO (X)'), (1, 3, 'Total'), (1, 4, 'NO INGRESO'), (2, 0, ''), (2, 1, '12')) v(p, k, t)""")
def pdf_kerned_scan(spark, d):
    """Arrays of shown strings, each one token"""
    return readers.token_rows(_pdfs(spark, d), kerned=True).select("document", "page", "position", "token")


@query("SELECT cast(p_partkey AS VARCHAR) AS document, 'DEVEXP' AS family, 2 AS pages, 'EXAMEN ORDINARIO 2023' AS process, '29/08/2022' AS exam_date, 'INGRESO|NO INGRESO' AS conditions, 'DERECHO (X)' AS program FROM part")
def pdf_headers(spark, d):
    """What the first pages say, and the title before the column of totals"""
    docs = _pdfs(spark, d)
    # read once, as contents are parsed for them
    path = scratch(spark)
    readers.token_rows(docs).write.parquet(path)
    tokens = spark.read.parquet(path)
    titles = readers.program_titles(tokens)
    return readers.headers(docs, tokens).join(titles, "document").select("document", "family", "pages", "process", "exam_date", "conditions", "program")


def _glyph_rows(words: DataFrame, width: float = 5.0) -> DataFrame:
    """Characters of words (document, page, seq, word, x, top)."""
    letters = words.select("document", "page", "seq", "x", "top", F.posexplode(F.split("word", "")).alias("k", "text")).where("text <> ''")
    x0 = F.col("x") + F.col("k") * width
    return letters.select("document", "page", (F.col("seq") * 1000 + F.col("k")).cast("long").alias("seq"), "text", x0.alias("x0"), (x0 + width - 0.1).alias("x1"), F.col("top").cast("double").alias("top"))


_ITEMS = "SELECT s.s_suppkey AS document, p.rank AS rank, 1 + (p.rank - 1) // 6 AS page, 40 + 10 * ((p.rank - 1) % 6) AS top, CASE WHEN (s.s_suppkey + p.rank) % 3 = 0 THEN 'NO INGRESO' ELSE 'INGRESO' END AS condition, CASE WHEN p.rank % 5 = 0 THEN 'NSP' ELSE cast(90 - p.rank AS {s}) || '.5' END AS score, 'ANA LUZ' || repeat('A', cast(p.rank % 4 AS INT)) AS name FROM supplier s, {r} p"


TABLE_SQL = f"""WITH i AS ({_ITEMS.format(s="VARCHAR", r="(SELECT unnest(generate_series(1, 14)) AS rank)")})
  SELECT cast(document AS VARCHAR) AS document, cast(page AS INT) AS page, 'CAMANA' AS site, 'GRUPO UNO' AS subgroup, 'DERECHO' AS program, cast(rank AS VARCHAR) AS merit_rank, name, score, condition, CASE WHEN page = 1 THEN 61.5 END::DOUBLE AS floor_score, 'results' AS doc_class FROM i"""


@query(TABLE_SQL)
def geometry_rows(spark, d):
    """Rows of tables that go on over pages, from characters of known cells"""
    return layout.read_documents(table_chars(spark, d)).select(*TABLE_ROW)


TABLE_ROW = ("document", "page", "site", "subgroup", "program", "merit_rank", "name", "score", "condition", "floor_score", "doc_class")


def table_chars(spark: SparkSession, d: str) -> DataFrame:
    """Characters of a table for each supplier, which goes on over three pages."""
    ranks = spark.range(1, 15).select(F.col("id").alias("rank"))
    suppliers = dealt(table(spark, d, "supplier").select("s_suppkey"))
    items = suppliers.join(F.broadcast(ranks)).select(
        F.col("s_suppkey").cast("string").alias("document"), "rank", (1 + F.floor((F.col("rank") - 1) / 6)).cast("int").alias("page"), (40 + 10 * ((F.col("rank") - 1) % 6)).alias("top"),
        F.when((F.col("s_suppkey") + F.col("rank")) % 3 == 0, "NO INGRESO").otherwise("INGRESO").alias("condition"),
        F.when(F.col("rank") % 5 == 0, "NSP").otherwise(F.concat((90 - F.col("rank")).cast("string"), F.lit(".5"))).alias("score"),
        F.concat(F.lit("ANA LUZ"), F.expr("repeat('A', cast(rank % 4 AS INT))")).alias("name"),
    )
    # the labels stand 3 points beside where the data begin, and one outcome 7 points before the other
    fields = [("rank", 12), ("name", 63), ("score", 253), ("condition", 323)]
    cells = F.explode(F.array(*(F.struct((F.lit(x) - (F.when(F.col("condition") == "NO INGRESO", 7).otherwise(0) if c == "condition" else 0)).cast("double").alias("x"), F.col(c).cast("string").alias("word"), F.lit(k).alias("c")) for k, (c, x) in enumerate(fields))))
    body = items.select("document", "page", "top", cells.alias("v")).select("document", "page", (100 + F.col("top") * 10 + F.col("v.c")).alias("seq"), F.col("v.word").alias("word"), F.col("v.x").alias("x"), "top")
    head = [("EXAMEN ORDINARIO - CAMANA", 10, 1), ("GRUPO UNO", 10, 10), ("DERECHO", 10, 20), ("Ord.", 10, 30), ("Nombre", 60, 30), ("Total", 250, 30), ("Condición", 320, 30), ("Nota Minima 61.50", 10, 110)]
    top = F.explode(F.array(*(F.struct(F.lit(w).alias("word"), F.lit(float(x)).alias("x"), F.lit(y).cast("long").alias("top"), F.lit(k).alias("k")) for k, (w, x, y) in enumerate(head))))
    titles = suppliers.select(F.col("s_suppkey").cast("string").alias("document"), top.alias("t")).select("document", F.lit(1).alias("page"), F.col("t.k").cast("long").alias("seq"), "t.word", "t.x", "t.top")
    return _glyph_rows(body.select("document", "page", F.col("seq").cast("long").alias("seq"), "word", "x", F.col("top").cast("long").alias("top")).unionByName(titles))


@query("""SELECT cast(s_suppkey AS VARCHAR) AS document, CASE WHEN s_suppkey % 2 = 0 THEN 'distancia' ELSE 'presencial' END AS section, program, n + k AS ordinary, 5 * (n + k) + 4 AS total FROM (SELECT s_suppkey, cast(s_nationkey AS INT) AS n FROM supplier),
  (VALUES (1, 'Derecho'), (2, 'Ingeniería de Minas')) v(k, program)""")
def seat_rows(spark, d):
    """Programmes with six numbers whose last is the sum; others go"""
    n = F.col("s_nationkey").cast("int")
    numbers = lambda k: [(n + k + (4 if j == 4 else 0)).cast("string") for j in range(5)] + [(5 * (n + k) + 4).cast("string")]
    words = [F.when(F.col("s_suppkey") % 2 == 0, "MODALIDAD A DISTANCIA").otherwise("MODALIDAD PRESENCIAL"), F.lit("Derecho"), *numbers(1), F.lit("Ingeniería de"), F.lit("Minas"), *numbers(2), F.lit("Teología"), *numbers(3)[:5], F.lit("9999")]
    tokens = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("document"), F.lit(1).alias("page"), F.posexplode(F.array(*words)).alias("position", "token"))
    return layout.read_seats(tokens).select("document", "section", "program", "ordinary", "total")
