import zlib

import pytest

from quarrystone.operators import layout
from quarrystone.sources import pdf_chars


def pdf(objects, extra=b""):
    """Objects by number as text, or (dictionary, data) for streams."""
    out = b"%PDF-1.5\n"
    for number, o in objects.items():
        body = o.encode("latin-1") if isinstance(o, str) else f"<< {o[0]} /Length {len(o[1])} >>\nstream\n".encode() + o[1] + b"\nendstream"
        out += f"{number} 0 obj\n".encode() + body + b"\nendobj\n"
    return out + extra


FONT = "<< /Type /Font /Subtype /TrueType /FirstChar 65 /Widths [500 600 700] /FontDescriptor 6 0 R /Encoding /WinAnsiEncoding >>"


def one_page(content, box="[0 0 600 800]", more="", font=FONT, objects=None):
    return pdf(
        {
            1: "<< /Type /Catalog /Pages 2 0 R >>", 2: f"<< /Type /Pages /Kids [3 0 R] /Count 1 /MediaBox {box} /Resources << /Font << /F1 5 0 R >> /XObject << /X 9 0 R >> >> {more} >>",
            3: "<< /Type /Page /Parent 2 0 R /Contents 4 0 R >>", 4: ("/Filter /FlateDecode", zlib.compress(content.encode("latin-1"))), 5: font, 6: "<< /Descent -200 >>",
        }
        | (objects or {})
    )


def chars(raw):
    doc = pdf_chars.Document(raw)
    return [[(t, round(a, 3), round(b, 3), round(y, 3)) for t, a, b, y in pdf_chars.page_chars(doc, p)] for p in doc.pages()]


@pytest.mark.parametrize(
    "content, want",
    [
        ("BT /F1 10 Tf 100 700 Td (AB) Tj ET", [("A", 100, 105, 92), ("B", 105, 111, 92)]),
        ("BT /F1 10 Tf 2 Tc 100 700 Td (AB) Tj ET", [("A", 100, 105, 92), ("B", 107, 113, 92)]),
        ("BT /F1 10 Tf 50 Tz 100 700 Td [(A) -1000 (B)] TJ ET", [("A", 100, 102.5, 92), ("B", 107.5, 110.5, 92)]),
        ("q 2 0 0 2 10 0 cm BT /F1 10 Tf 1 0 0 1 20 300 Tm (A) Tj ET Q BT (B) Tj ET", [("A", 50, 60, 184)]),
        ("BT /F1 10 Tf 12 TL 100 700 Td (A) Tj T* (B) Tj (C) ' 1 2 (A) \" ET", [("A", 100, 105, 92), ("B", 100, 106, 104), ("C", 100, 107, 116), ("A", 100, 105, 128)]),
        ("BT /F1 10 Tf 100 700 TD 0 -20 TD (A) Tj T* (B) Tj 5 Ts (C) Tj ET", [("A", 100, 105, 112), ("B", 100, 106, 132), ("C", 106, 113, 127)]),
        ("BT /F1 10 Tf 0 1 -1 0 100 200 Tm (AB) Tj ET", [("A", 92, 102, 595), ("B", 92, 102, 589)]),
        ("BI /W 1 ID (Tj ET) EI BT /F1 10 Tf 100 700 Td <4142> Tj ET", [("A", 100, 105, 92), ("B", 105, 111, 92)]),
    ],
)
def test_text_state(content, want):
    assert chars(one_page(content)) == [want]


def test_boxes_and_turned_pages():
    content = "BT /F1 10 Tf 100 700 Td (A) Tj ET"
    assert chars(one_page(content, box="[50 100 650 900]")) == [[("A", 50, 55, 192)]]
    assert chars(one_page(content, more="/Rotate 90")) == [[("A", 698, 708, 100)]]
    assert chars(one_page(content, more="/Rotate 180")) == [[("A", 495, 500, 698)]]
    assert chars(one_page(content, more="/Rotate 270")) == [[("A", 92, 102, 495)]]


def test_fonts():
    named = "<< /Type /Font /Subtype /Type1 /FirstChar 1 /Widths [500 500 500 500] /Encoding << /Differences [1 /Ntilde /eacute /three /uni20AC] >> >>"
    assert [c[0] for c in chars(one_page("BT /F1 10 Tf (\\001\\002\\003\\004) Tj ET", font=named))[0]] == ["Ñ", "é", "3", "€"]
    wide = "<< /Type /Font /Subtype /Type0 /Encoding /Identity-H /DescendantFonts [7 0 R] /ToUnicode 8 0 R >>"
    cmap = b"1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfchar <0001> <00660069> endbfchar 1 beginbfrange <0002> <0004> <0041> endbfrange"
    more = {7: "<< /FontDescriptor 6 0 R /DW 900 /W [1 [400] 2 3 650] >>", 8: ("", cmap)}
    got = chars(one_page("BT /F1 10 Tf 0 700 Td <0001000200030004> Tj ET", font=wide, objects=more))
    assert got == [[("fi", 0, 4, 92), ("A", 4, 10.5, 92), ("B", 10.5, 17, 92), ("C", 17, 26, 92)]]


def test_forms_and_object_streams():
    form = ("/Type /XObject /Subtype /Form /Matrix [1 0 0 1 30 0]", b"BT /F1 10 Tf 100 700 Td (A) Tj ET /X Do")
    # a form that calls itself is followed to a bounded depth
    assert chars(one_page("/X Do", objects={9: form}))[0][:2] == [("A", 130, 135, 92), ("A", 160, 165, 92)]
    inner = ["<< /Type /Pages /Kids [3 0 R 13 0 R] /MediaBox [0 0 600 800] /Resources << /Font << /F1 5 0 R >> >> >>", "<</Type/Page/Contents[4 0 R 14 0 R]>>", FONT]
    places, body = [], ""
    for number, text in zip((2, 3, 5), inner):
        places.append(f"{number} {len(body)}")
        body += text + " "
    head = " ".join(places) + " "
    packed = (f"/Type /ObjStm /N 3 /First {len(head)} /Filter /FlateDecode", zlib.compress((head + body).encode()))
    raw = pdf({1: "<</Type/Catalog/Pages 2 0 R>>", 4: ("", b"BT /F1 10 Tf 100 700 Td"), 14: ("", b"(A) Tj ET"), 13: "<< /Type /Page /Contents 4 0 R >>", 6: "<< /Descent -200 >>", 10: packed})
    assert chars(raw) == [[("A", 100, 105, 92)], []]


def test_damage_is_a_row(spark):
    good = one_page("BT /F1 10 Tf 100 700 Td (AB) Tj ET")
    bad_page = one_page("BT", objects={4: ("/Filter /DCTDecode", b"xx")})
    cut = good[: good.index(b"endstream") - 9]
    rows = [("good", good), ("none", None), ("empty", b""), ("text", b"not a PDF"), ("filter", bad_page), ("cut", cut)]
    got = pdf_chars.char_rows(spark.createDataFrame(rows, "document string, content binary")).collect()
    assert [(r.text, r.page) for r in got if r.document == "good"] == [("A", 1), ("B", 1)]
    assert {r.document for r in got if r.warning} >= {"none", "empty", "text", "filter"} and all(r.text is None for r in got if r.warning)


def test_from_bytes_to_rows(spark):
    put = lambda text, x, top: "".join(f"1 0 0 1 {x + 5 * k} {800 - top - 8} Tm ({c}) Tj " for k, c in enumerate(text))
    cells = [("EXAMEN ORDINARIO", 10, 5), ("GRUPO", 10, 15), ("DERECHO", 10, 25), ("Ord.", 10, 40), ("Nombre", 60, 40), ("Total", 250, 40), ("Resultado", 320, 40)]
    for k in range(4):
        cells += [(str(k + 1), 10, 50 + 10 * k), (f"ANA LUZ{'A' * k}", 60, 50 + 10 * k), (f"{90 - k}.5", 250, 50 + 10 * k), ("INGRESO", 320, 50 + 10 * k)]
    font = "<< /Type /Font /Subtype /TrueType /FirstChar 0 /Widths [" + "490 " * 256 + "] /FontDescriptor 6 0 R >>"
    raw = one_page("BT /F1 10 Tf " + "".join(put(*c) for c in cells) + "ET", font=font)
    made = pdf_chars.char_rows(spark.createDataFrame([("d", raw)], "document string, content binary"))
    got = layout.read_documents(made.where("warning is null").drop("warning")).orderBy("merit_rank").collect()
    assert [(r.program, r.merit_rank, r.name, r.score, r.condition) for r in got] == [("DERECHO", str(k + 1), f"ANA LUZ{'A' * k}", f"{90 - k}.5", "INGRESO") for k in range(4)]
