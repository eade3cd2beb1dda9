import json
import zlib

from pyspark.sql import functions as F

from quarrystone.schemas import strings
from quarrystone.sources import readers, writers
from quarrystone.streaming import ingest


def pdf(content: str, cmap: dict[str, str] | None = None) -> bytes:
    table = "beginbfchar\n" + "\n".join(f"<{k}> <{ord(v):04X}>" for k, v in (cmap or {}).items()) + "\nendbfchar"
    body = b"/Type /Page \n"
    for text in ([table] if cmap else []) + [content]:
        body += b"stream\n" + zlib.compress(text.encode("latin-1")) + b"endstream\n"
    return b"%PDF-1.4\n" + body


def test_pdf_tokens():
    pages, mapped = readers.pdf_tokens(pdf("(lit \\(x\\)) Tj <00010002> Tj", {"0001": "A", "0002": "B"}))
    assert (pages, mapped) == ([["AB", "lit (x)"]], True)
    pages, mapped = readers.pdf_tokens(pdf("[(De) -20 (recho)] TJ (12) Tj"), kerned=True)
    assert (pages, mapped) == ([["Derecho", "12"]], False)
    assert readers.pdf_tokens(b"no streams") == ([], False)


def test_content_streams_and_glyph_maps():
    text = r"/F1 12 Tf (a \(b\) (c) \101\n) Tj << /K [1 2] >> BDC % (not this) Tj" + "\n[(x) 3 [(y)] <41>] TJ (z) ' 1 0 (w) \""
    got = [(o, a) for o, a in readers.ContentStream(text).operations() if o in ("Tj", "TJ", "'", '"')]
    assert got[0] == ("Tj", [("text", "a (b) (c) A\n")])
    assert got[1] == ("TJ", [[("text", "x"), ("word", "3"), [("text", "y")], ("hex", "41")]])
    assert [a[-1][1] for _, a in got[2:]] == ["z", "w"]
    glyphs = readers.GlyphMap()
    maps = "1 begincodespacerange <00> <FF> endcodespacerange 1 beginbfchar <01> <00660069> endbfchar 2 beginbfrange <10> <12> <0041> <20> <21> [<0058> <0059>] endbfrange"
    for operator, operands in readers.ContentStream(maps).operations():
        glyphs.learn(operator, operands)
    assert glyphs.decode("01101112202199") == "fiABCXY"


def test_document_scan(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(pdf("(EXAMEN ORDINARIO 2023) Tj (29/08/2022) Tj (NO INGRESO) Tj"))
    (tmp_path / "b.pdf").write_bytes(b"not a pdf" * 200)
    docs = readers.documents(spark, str(tmp_path))
    head = {r.document: r for r in readers.headers(docs).collect()}
    assert (head["a.pdf"].process, head["a.pdf"].exam_date, head["a.pdf"].conditions, head["a.pdf"].pages) == ("EXAMEN ORDINARIO 2023", "29/08/2022", "INGRESO|NO INGRESO", 1)
    assert head["b.pdf"].process is None and head["b.pdf"].family == "OTRO"
    files = readers.inventory(spark, str(tmp_path))
    assert files.count() == 2
    have = spark.createDataFrame([("a.pdf",)], "document string")
    assert [r.document for r in readers.not_ingested(files, have).collect()] == ["b.pdf"]


def test_program_titles(spark):
    tokens = spark.createDataFrame([("d", 1, k, t, True) for k, t in enumerate(["Nombre", "DERECHO", "Total", "INGRESO", "Total", "Abc", "Total"])], "document string, page int, position int, token string, mapped boolean")
    assert [r.program for r in readers.program_titles(tokens).collect()] == ["DERECHO"]


def test_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x,z\n3,4,5\n")
    got = readers.read_by_name(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).select("x", "y", "z").orderBy("x").collect()
    assert [tuple(r) for r in got] == [("1", "2", None), ("4", "3", "5")]


def test_cycle_from_folder_and_empty_cells(spark, tmp_path):
    (tmp_path / "2023").mkdir()
    (tmp_path / "2023" / "a.csv").write_text('program,score\nDERECHO,\n"",1.5\n')
    got = readers.read_cycles(spark, str(tmp_path), strings("program", "score")).orderBy("score").collect()
    assert [(r.cycle, r.program, r.score) for r in got] == [("2023", "DERECHO", None), ("2023", None, "1.5")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("2023", 'a"b', 1), ("2022", "x,y", 2)], "cycle string, t string, n int")
    writers.write_sorted(df, str(tmp_path / "s"), ["cycle", "n"], ["cycle"])
    assert [r["value"] for r in spark.read.text(str(tmp_path / "s")).collect()] == ["cycle,n", "2022,2", "2023,1"]
    writers.write_partitioned(df, str(tmp_path / "p"), "cycle")
    assert spark.read.parquet(str(tmp_path / "p")).where("cycle = 2022").count() == 1
    lines = [r.line for r in writers.export_lines(df).collect()]
    assert lines == ["﻿cycle,t,n", '2023,"a""b",1', '2022,"x,y",2']
    writers.write_json_object(df.agg(F.to_json(F.collect_list(F.struct("n"))).alias("value")), str(tmp_path / "j"))
    assert json.loads(spark.read.text(str(tmp_path / "j")).first().value) == [{"n": 1}, {"n": 2}]
    assert writers.save_table(df, "kept_rows").count() == 2


def test_stream_takes_each_content_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.pdf").write_bytes(b"one")
    (src / "b.pdf").write_bytes(b"one")
    (src / "c.pdf").write_bytes(b"two")
    go = lambda: ingest.run_available(ingest.new_documents(spark, str(src)).select("document", "sha256"), str(tmp_path / "out"), str(tmp_path / "ck"))
    go()
    assert spark.read.parquet(str(tmp_path / "out")).select("sha256").distinct().count() == spark.read.parquet(str(tmp_path / "out")).count() == 2
    (src / "d.pdf").write_bytes(b"two")
    (src / "e.pdf").write_bytes(b"three")
    go()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
