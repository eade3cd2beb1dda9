"""Named queries of documents as files: characters out of PDFs, tables whose cells run together.

The documents are made from the driver's tables, by rules that SQL can state.
"""

from __future__ import annotations

import zlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrystone.operators import joins, layout, quality
from quarrystone.plans.canonical import APPS, applications, table
from quarrystone.plans.checks import TABLE_ROW, TABLE_SQL, _glyph_rows, _nation_strings, table_chars
from quarrystone.plans.named import query
from quarrystone.schemas import strings
from quarrystone.sources import fetch, pdf_chars, readers, writers
from quarrystone.sources.shared import dealt, scratch

PAGE_HEIGHT = 800


def _file(objects: dict[int, str | tuple[str, bytes]]) -> bytes:
    """A PDF of numbered objects: text, or (dictionary, data) for streams, which are deflated."""
    out = b"%PDF-1.5\n"
    for number, o in objects.items():
        if isinstance(o, tuple):
            data = zlib.compress(o[1])
            body = f"<< {o[0]} /Filter /FlateDecode /Length {len(data)} >>\nstream\n".encode() + data + b"\nendstream"
        else:
            body = o.encode("latin-1")
        out += f"{number} 0 obj\n".encode() + body + b"\nendobj\n"
    return out


#: What the first page of a made document shows, and the second; {v} is where it begins.
_FIRST = [
    "BT /F1 10 Tf {v} 700 Td (AB A) Tj ET",
    "BT 2 Tc 3 Tw {v} 680 Td (A B) Tj 0 Tc 0 Tw ET",
    "BT {v} 660 Td [(A) -500 (B)] TJ ET",
    "BT 50 Tz {v} 640 Td (AB) Tj 100 Tz ET",
    "q 2 0 0 2 100 0 cm BT {v} 300 Td (A) Tj ET Q",
    "BT 14 TL {v} 600 Td (A) Tj T* (B) Tj ET",
    "BT 3 Ts {v} 560 Td (A) Tj 0 Ts ET",
    "/X1 Do",
]
_SECOND = "BT /F2 10 Tf 1 0 0 1 {v} 500 Tm <00010002> Tj ET"
_MAP = b"1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfchar <0001> <00E9> endbfchar 1 beginbfrange <0002> <0003> [<00660069> <0042>] endbfrange"


def _sampler(v: int) -> bytes:
    """Two pages that use the text state in all its parts; fonts and page tree stand in an object stream."""
    packed = {
        2: "<< /Type /Pages /Kids [3 0 R 4 0 R] /MediaBox [0 0 600 800] /Resources << /Font << /F1 7 0 R /F2 8 0 R >> /XObject << /X1 12 0 R >> >> >>",
        3: "<< /Type /Page /Parent 2 0 R /Contents 5 0 R >>",
        4: "<< /Type /Page /Parent 2 0 R /Contents [6 0 R] >>",
        7: "<< /Type /Font /Subtype /TrueType /FirstChar 32 /Widths [250 " + "0 " * 32 + "500 600] /FontDescriptor 9 0 R /Encoding /WinAnsiEncoding >>",
        8: "<< /Type /Font /Subtype /Type0 /Encoding /Identity-H /DescendantFonts [10 0 R] /ToUnicode 11 0 R >>",
        10: "<< /Type /Font /Subtype /CIDFontType2 /DW 1000 /W [1 [500] 2 3 700] /FontDescriptor << /Descent -300 >> >>",
    }
    head, body = "", ""
    for number, text in packed.items():
        head += f"{number} {len(body)} "
        body += text + " "
    objects: dict[int, str | tuple[str, bytes]] = {
        1: "<< /Type /Catalog /Pages 2 0 R >>",
        5: ("", "\n".join(_FIRST).format(v=v).encode()),
        6: ("", _SECOND.format(v=v).encode()),
        9: "<< /Descent -200 >>",
        11: ("", _MAP),
        12: ("/Type /XObject /Subtype /Form /Matrix [1 0 0 1 30 0]", f"BT /F1 10 Tf {v} 540 Td (A) ' ET".encode()),
        13: (f"/Type /ObjStm /N {len(packed)} /First {len(head)}", (head + body).encode()),
    }
    return _file(objects)


# page, place in the page, character, left and right end beside (factor of v), and distance from the top
_PLACES = [
    (1, 0, "A", 1, 0, 5, 92), (1, 1, "B", 1, 5, 11, 92), (1, 2, " ", 1, 11, 13.5, 92), (1, 3, "A", 1, 13.5, 18.5, 92),
    (1, 4, "A", 1, 0, 5, 112), (1, 5, " ", 1, 7, 9.5, 112), (1, 6, "B", 1, 14.5, 20.5, 112),
    (1, 7, "A", 1, 0, 5, 132), (1, 8, "B", 1, 10, 16, 132),
    (1, 9, "A", 1, 0, 2.5, 152), (1, 10, "B", 1, 2.5, 5.5, 152),
    (1, 11, "A", 2, 100, 110, 184),
    (1, 12, "A", 1, 0, 5, 192), (1, 13, "B", 1, 0, 6, 206),
    (1, 14, "A", 1, 0, 5, 229), (1, 15, "A", 1, 30, 35, 266),
    (2, 0, "é", 1, 0, 5, 293), (2, 1, "fi", 1, 5, 12, 293),
]
_VALUES = ", ".join(f"({p}, {k}, '{t}', {f}, {a}, {b}, {y})" for p, k, t, f, a, b, y in _PLACES)


@query(f"""SELECT cast(p_partkey AS VARCHAR) AS document, cast(page AS INT) AS page, cast(k AS BIGINT) AS seq, t AS text,
  round((f * p_size + a)::DOUBLE, 6) AS x0, round((f * p_size + b)::DOUBLE, 6) AS x1, y::DOUBLE AS top FROM part, (VALUES {_VALUES}) v(page, k, t, f, a, b, y)""")
def pdf_characters(spark, d):
    """Characters of PDFs with their places: spacing, scaling, rise, kerning, matrices, forms, two kinds of fonts"""

    def made(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_sampler(v) for v in b.column(1).to_pylist()], pa.binary())], ["document", "content"])

    docs = dealt(table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("document"), "p_size")).mapInArrow(made, "document string, content binary")
    places = [F.round(c, 6).alias(c) for c in ("x0", "x1", "top")]
    return pdf_chars.char_rows(docs).where("warning is null").select("document", "page", "seq", "text", *places)


def pdfs_of(chars: DataFrame) -> DataFrame:
    """(document, content): characters of 4.9 points put where ``chars`` say."""
    font = "<< /Type /Font /Subtype /TrueType /FirstChar 0 /Widths [" + "490 " * 256 + "] /FontDescriptor << /Descent -200 >> /Encoding /WinAnsiEncoding >>"

    def made(doc: pa.Table) -> pa.Table:
        pages: dict[int, list[str]] = {}
        for page, text, x0, top in sorted(zip(*(doc[c].to_pylist() for c in ("page", "text", "x0", "top")))):
            pages.setdefault(page, []).append(f"1 0 0 1 {x0:.6f} {PAGE_HEIGHT - top - 8:.6f} Tm <{text.encode('cp1252').hex()}> Tj")
        numbers = {page: 10 + 2 * k for k, page in enumerate(sorted(pages))}
        objects: dict[int, str | tuple[str, bytes]] = {
            1: "<< /Type /Catalog /Pages 2 0 R >>",
            2: f"<< /Type /Pages /Kids [{' '.join(f'{n} 0 R' for n in numbers.values())}] /MediaBox [0 0 600 {PAGE_HEIGHT}] /Resources << /Font << /F1 3 0 R >> >> >>",
            3: font,
        }
        for page, n in numbers.items():
            objects[n] = f"<< /Type /Page /Parent 2 0 R /Contents {n + 1} 0 R >>"
            objects[n + 1] = ("", ("BT /F1 10 Tf\n" + "\n".join(pages[page]) + "\nET").encode())
        return pa.table({"document": [doc["document"][0].as_py()], "content": pa.array([_file(objects)], pa.binary())})

    return chars.groupBy("document").applyInArrow(made, "document string, content binary")


@query(TABLE_SQL)
def pdf_table_rows(spark, d):
    """From the bytes of PDFs to the rows of their tables"""
    docs = pdfs_of(table_chars(spark, d))
    chars = pdf_chars.char_rows(docs).where("warning is null").drop("warning")
    return layout.read_documents(chars).select(*TABLE_ROW)


_GLUED = "concat('ANA LUZ', repeat('A', cast(29 + s_suppkey % 3 AS INT)))"


@query(f"""SELECT cast(s_suppkey AS VARCHAR) AS document, cast(rank AS VARCHAR) AS merit_rank, {_GLUED} AS name, cast(50 + rank AS VARCHAR) || '.5' AS score, 'INGRESO' AS condition
  FROM supplier, generate_series(1, 3) g(rank)""")
def glued_cells(spark, d):
    """A name that runs into the score beside it, cut at the border of the column that stayed empty"""
    word = lambda text, x, top, seq: F.struct(text.alias("word"), F.lit(float(x)).alias("x"), F.lit(top).cast("long").alias("top"), F.lit(seq).cast("long").alias("seq"))
    words = [word(F.lit(w), x, y, k) for k, (w, x, y) in enumerate([("MEDICINA", 10, 20), ("Ord.", 10, 30), ("Nombre", 60, 30), ("Total", 250, 30), ("Condición", 320, 30)])]
    for rank in (1, 2, 3):
        # the space between is a character of its own, so name and score are one word
        cells = [(F.lit(str(rank)), 10), (F.concat(F.expr(_GLUED), F.lit(f" {50 + rank}.5")), 60), (F.lit("INGRESO"), 320)]
        words += [word(text, x, 30 + 10 * rank, 10 * rank + k) for k, (text, x) in enumerate(cells)]
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("document"), "s_suppkey", F.lit(1).alias("page"), F.explode(F.array(*words)).alias("w"))
    chars = _glyph_rows(rows.select("document", "page", "w.seq", "w.word", "w.x", "w.top"))
    return layout.read_documents(chars).select("document", "merit_rank", "name", "score", "condition")


# ---- fetching and keeping documents


@query("""SELECT cast(p_partkey AS VARCHAR) AS document, CASE p_partkey % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'ok' WHEN 2 THEN 'ok' WHEN 3 THEN 'absent' ELSE 'failed' END AS status,
  CASE p_partkey % 5 WHEN 0 THEN 'live' WHEN 1 THEN 'archive' WHEN 2 THEN 'archive' END AS origin, CASE p_partkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 1 ELSE 4 END AS attempts,
  CASE WHEN p_partkey % 5 < 3 THEN octet_length(encode('%PDF-' || p_name)) END::BIGINT AS bytes, CASE WHEN p_partkey % 5 < 3 THEN sha256('%PDF-' || p_name) END AS digest FROM part""")
def fetched_documents(spark, d):
    """Documents from where they should be or else from the archive; what is absent is asked for once, what is no PDF twice"""
    path = scratch(spark)
    kind = F.col("p_partkey") % 5
    parts = table(spark, d, "part").select("p_partkey", "p_name", kind.alias("kind"))
    # live: whole for kind 0, something else for 2 and 4; in the archive: whole for 1 and 2, something else for 4
    live = parts.where("kind in (0, 2, 4)").select(F.concat(F.lit("live-"), F.col("p_partkey").cast("string")).alias("name"), F.concat(F.when(F.col("kind") == 0, "%PDF-").otherwise("<html>"), "p_name").alias("body"))
    kept = parts.where("kind in (1, 2, 4)").select(F.concat(F.lit("archive-"), F.col("p_partkey").cast("string")).alias("name"), F.concat(F.when(F.col("kind") == 4, "<html>").otherwise("%PDF-"), "p_name").alias("body"))
    writers.write_files(live.unionByName(kept).withColumn("at", F.lit(0)), path, "name", "at", "body")
    place = lambda what: F.concat(F.lit(f"{path}/{what}-"), F.col("p_partkey").cast("string"))
    requests = parts.select(F.col("p_partkey").cast("string").alias("document"), place("live").alias("url"), F.when(F.col("kind") != 3, place("archive")).alias("other"))
    got = fetch.fetch(requests, attempts=2, pause=0)
    return got.select("document", "status", "origin", "attempts", "bytes", F.sha2("content", 256).alias("digest"))


@query("""SELECT cast(n_nationkey AS VARCHAR) AS n_nationkey, CASE WHEN n_regionkey = 1 THEN 'again' WHEN n_nationkey % 5 <> 0 THEN n_name END AS n_name, cast(n_regionkey AS VARCHAR) AS document
  FROM nation WHERE n_regionkey <> 2 AND (n_regionkey <> 1 OR n_nationkey % 2 = 0)""")
def document_rewrite(spark, d):
    """Of a table by document one document is written again, twice over, and one is given up; the others stay"""
    path = scratch(spark)
    rows = _nation_strings(spark, d).withColumnRenamed("n_regionkey", "document")
    writers.rewrite_partitions(rows, path, "document", header=True)
    again = rows.where("document = '1' and cast(n_nationkey as int) % 2 = 0").withColumn("n_name", F.lit("again"))
    for _ in range(2):
        writers.rewrite_partitions(again, path, "document", header=True)
    writers.drop_partitions(rows.where("document = '2'").select("document"), path)
    back = readers.read_cycles(spark, path, strings("n_nationkey", "n_name"))
    return back.select("n_nationkey", "n_name", F.regexp_replace("cycle", "^document=", "").alias("document"))


# ---- rules on what is published

_NAMES = "names AS (SELECT c_custkey, r_name, concat(c_mktsegment, ' ', r_name, ' GARCIA') AS name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"


@query(f"""WITH {_NAMES} SELECT c_custkey, name FROM names WHERE r_name NOT IN ('ASIA', 'EUROPE')""")
def unknown_names(spark, d):
    """persons' names in published lines, without those of a catalogue"""
    places = table(spark, d, "nation").join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    named = table(spark, d, "customer").join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name", F.concat_ws(" ", "c_mktsegment", "r_name", F.lit("GARCIA")).alias("name"))
    known = named.where("r_name in ('ASIA', 'EUROPE')").select("name").distinct()
    return quality.unknown_names(named.select("c_custkey", F.concat(F.lit("1. "), "name", F.lit(", 12.5 puntos")).alias("line")), known, "c_custkey")


@query(f"""WITH {APPS}, listed AS (SELECT n_name AS program FROM nation UNION ALL SELECT r_name FROM region),
  have AS (SELECT cycle, count(DISTINCT program) AS have FROM apps GROUP BY cycle), want AS (SELECT cycle, count(DISTINCT program) AS want FROM apps, nation WHERE n_name = program AND n_nationkey % 6 <> 0 OR n_name = program AND cycle > '1996' GROUP BY cycle)
  SELECT 'pseudonym length' AS rule, count(*) AS violations FROM orders WHERE o_orderkey % 50 = 0
  UNION ALL SELECT 'no column of names', count(*) FROM information_schema.columns WHERE table_name = 'customer' AND column_name IN ('c_name', 'c_phone')
  UNION ALL SELECT 'programmes of a cycle', count(*) FROM have JOIN want USING (cycle) WHERE abs(have - want) > 3
  UNION ALL SELECT 'catalogue appears', count(*) FROM (SELECT DISTINCT program FROM listed) l WHERE program NOT IN (SELECT program FROM apps)""")
def published_rules(spark, d):
    """Q16, Q18, Q25, Q39: pseudonyms of one length, no column of names, as many programmes as the catalogue has, each of which appears"""
    orders = table(spark, d, "orders")
    digest = F.sha2(F.col("o_custkey").cast("string"), 256)
    people = orders.select(F.when(F.col("o_orderkey") % 50 == 0, F.substring(digest, 1, 15)).otherwise(F.substring(digest, 1, 16)).alias("person"))
    nation = table(spark, d, "nation")
    rows = applications(spark, d).select("cycle", "program")
    names = nation.select(F.col("n_name").alias("program"), "n_nationkey")
    by_cycle = rows.distinct().join(F.broadcast(names), "program").where("n_nationkey % 6 <> 0 or cycle > '1996'")
    listed = names.select("program").unionByName(table(spark, d, "region").select(F.col("r_name").alias("program")))
    rules = {
        "pseudonym length": quality.pseudonym_length(people),
        "no column of names": quality.no_name_column(table(spark, d, "customer"), ("c_name", "c_phone")),
        "programmes of a cycle": quality.coverage(rows, by_cycle),
        "catalogue appears": quality.never_seen(listed, rows),
    }
    counts = [v.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("rule"), "violations") for name, v in rules.items()]
    return reduce(DataFrame.unionByName, counts)


#: Names that one task makes.
PART_NAMES = 50_000
_LETTERS = "upper(translate(md5(cast(p_partkey AS {s})), '0123456789', 'GHIJKLMNOP'))"


@query(f"""WITH n AS (SELECT p_partkey % 6 AS kind, {_LETTERS.format(s="VARCHAR")} AS program FROM part)
  SELECT DISTINCT CASE kind WHEN 0 THEN program WHEN 1 THEN substr(program, 1, 9) || substr(program, 11) WHEN 2 THEN 'X' || program ELSE substr(program, 1, 15) || 'ZZ' || substr(program, 18) END AS form, program AS canonical
  FROM n WHERE kind < 4""")
def near_forms(spark, d):
    """Names of 32 letters with one letter lost, one more or two others (ratios of 0.94 and more), and with five others (0.85)"""
    parts = dealt(table(spark, d, "part").select("p_partkey"), PART_NAMES)
    names = parts.select((F.col("p_partkey") % 6).alias("kind"), F.expr(_LETTERS.format(s="STRING")).alias("program"))
    p = F.col("program")
    piece = lambda a, n: F.substring(p, a, n)
    form = (
        F.when(F.col("kind") == 0, p)
        .when(F.col("kind") == 1, F.concat(piece(1, 9), piece(11, 40)))
        .when(F.col("kind") == 2, F.concat(F.lit("X"), p))
        .when(F.col("kind") == 3, F.concat(piece(1, 15), F.lit("ZZ"), piece(18, 40)))
        .otherwise(F.concat(F.lit("Z"), piece(2, 7), F.lit("Z"), piece(10, 7), F.lit("Z"), piece(18, 7), F.lit("Z"), piece(26, 6), F.lit("Z")))
    )
    return joins.near_names(names.select(form.alias("form")), names)
