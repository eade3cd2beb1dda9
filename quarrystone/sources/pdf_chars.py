"""Characters of PDFs with their places (A8): objects, fonts, and the text state of content streams.

Objects are found where they stand in the file, those of object streams included, so
damaged or missing cross-reference tables do no harm.  A page's content is run operator by
operator; only what moves text is kept.  One row a character; documents are independent.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import DataFrame

from quarrystone.sources.readers import _LEXEME, ContentStream, GlyphMap

_OBJECT = re.compile(rb"(\d+)\s+\d+\s+obj\b")
_REFERENCE = re.compile(r"\s+(\d+)\s+R\b")
#: Form objects within form objects that are followed.
DEPTH = 8
#: Width in thousandths of the font size where a font says none.
PLAIN_WIDTH = 500.0
# Names of signs in encodings, marks that compose with letters, and spelled digits.
SIGNS = {"space": " ", "period": ".", "comma": ",", "colon": ":", "semicolon": ";", "hyphen": "-", "parenleft": "(", "parenright": ")", "slash": "/", "percent": "%", "asterisk": "*", "plus": "+", "equal": "=", "quotesingle": "'", "quotedbl": '"', "underscore": "_", "degree": "°", "ordmasculine": "º", "ordfeminine": "ª", "endash": "–", "emdash": "—"}
MARKS = {"acute": "́", "grave": "̀", "tilde": "̃", "dieresis": "̈", "circumflex": "̂", "cedilla": "̧", "caron": "̌", "ring": "̊"}
DIGITS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")


@dataclass(frozen=True)
class Ref:
    number: int


class Name(str):
    """A name, without its slash."""


class Syntax(ContentStream):
    """Values of PDF objects."""

    def value(self):
        """The next value; a word that is none is a ``str`` (as ``R``, ``endobj``)."""
        while found := _LEXEME.match(self.data, self.at):
            self.at = found.end()
            kind, text = found.lastgroup, found[found.lastgroup]
            if kind == "skip":
                continue
            if kind == "hex":
                return bytes.fromhex(re.sub(r"\s", "", text) + "0" * (len(re.sub(r"\s", "", text)) % 2)).decode("latin-1")
            if kind == "open":
                return self._literal()
            if kind == "dict" and text == "<<":
                items = self._until(">>")
                return dict(zip(items[::2], items[1::2]))
            if kind == "mark" and text == "[":
                return self._until("]")
            if kind == "word":
                if (cut := text.find("/", 1)) > 0:
                    self.at -= len(text) - cut
                    text = text[:cut]
                return self._word(text)
            return _End(text)
        return _End("")

    def _until(self, end: str) -> list:
        out = []
        while not isinstance(v := self.value(), _End):
            out.append(v)
        return out

    def _word(self, text: str):
        if text[0] == "/":
            return Name(re.sub("#([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), text[1:]))
        if text in ("true", "false", "null"):
            return {"true": True, "false": False, "null": None}[text]
        try:
            number = float(text)
        except ValueError:
            return _End(text)
        if text.isdigit() and (ref := _REFERENCE.match(self.data, self.at)):
            self.at = ref.end()
            return Ref(int(text))
        return number


class _End(str):
    """A closing bracket, or a word that is no value."""


class Document:
    """Objects by number, and the pages of a PDF."""

    def __init__(self, raw: bytes) -> None:
        self.objects: dict[int, object] = {}
        self.streams: dict[int, tuple[dict, bytes]] = {}
        at = 0
        while found := _OBJECT.search(raw, at):
            at = self._take(raw, int(found[1]), found.end())
        for number in [n for n, (d, _) in self.streams.items() if d.get("Type") == "ObjStm"]:
            self._unpack(number)

    def _take(self, raw: bytes, number: int, at: int) -> int:
        end = raw.find(b"endobj", at)
        begin = raw.find(b"stream", at)
        end = len(raw) if end < 0 else end
        head = raw[at : begin if 0 <= begin < end else end].decode("latin-1")
        value = Syntax(head).value()
        self.objects[number] = value
        self.streams.pop(number, None)
        if not (isinstance(value, dict) and 0 <= begin < end):
            return end
        begin += len(b"stream")
        begin += 2 if raw[begin : begin + 2] == b"\r\n" else raw[begin : begin + 1] in (b"\n", b"\r")
        length = value.get("Length")
        stop = begin + int(length) if isinstance(length, float) else -1
        # a length that does not lead to the end of the stream is not believed
        if stop < 0 or not raw[stop : stop + 20].lstrip().startswith(b"endstream"):
            stop = raw.find(b"endstream", begin)
            stop = len(raw) if stop < 0 else stop
        self.streams[number] = (value, raw[begin:stop])
        return stop

    def _unpack(self, number: int) -> None:
        about, data = self.streams[number][0], self.data(number).decode("latin-1")
        first = int(about.get("First", 0))
        places = Syntax(data[:first])
        numbers = [int(v) for v in iter(places.value, _End("")) if isinstance(v, float)]
        for n, at in zip(numbers[::2], numbers[1::2]):
            self.objects.setdefault(n, Syntax(data[first + at :]).value())

    def get(self, value):
        for _ in range(DEPTH):
            if not isinstance(value, Ref):
                break
            value = self.objects.get(value.number)
        return value

    def data(self, number: int) -> bytes:
        about, raw = self.streams.get(number, ({}, b""))
        filters = self.get(about.get("Filter"))
        for name in filters if isinstance(filters, list) else [filters] if filters else []:
            if name in ("FlateDecode", "Fl"):
                raw = zlib.decompressobj().decompress(raw)
            elif name in ("ASCIIHexDecode", "AHx"):
                raw = bytes.fromhex(re.sub(r"[\s>]", "", raw.decode("latin-1")))
            else:
                raise ValueError(f"filter {name} is not read")
        return raw

    def pages(self) -> Iterator[dict]:
        """Page objects in order, with what they inherit."""
        root = next((o for o in self.objects.values() if isinstance(o, dict) and o.get("Type") == "Catalog"), {})
        todo: list[tuple[object, dict, int]] = [(root.get("Pages"), {}, 0)]
        while todo:
            value, above, depth = todo.pop()
            node = self.get(value)
            if not isinstance(node, dict) or depth > 4 * DEPTH:
                continue
            own = above | {k: node[k] for k in ("Resources", "MediaBox", "Rotate") if k in node}
            if "Kids" in node:
                todo += [(k, own, depth + 1) for k in reversed(self.get(node["Kids"]) or [])]
            else:
                yield node | own


def sign_of(name: str) -> str:
    """The character that a name in an encoding stands for."""
    if name in SIGNS:
        return SIGNS[name]
    if name in DIGITS:
        return str(DIGITS.index(name))
    if found := re.fullmatch("uni([0-9A-F]{4})|u([0-9A-F]{4,6})", name):
        return chr(int(found[1] or found[2], 16))
    if len(name) > 1 and name[1:] in MARKS:
        return unicodedata.normalize("NFC", name[0] + MARKS[name[1:]])
    return name if len(name) == 1 else "�"


#: Characters of one-byte codes in the two base encodings.
_BASES = {kind: {c: bytes([c]).decode(kind, "replace") for c in range(32, 256)} for kind in ("mac_roman", "cp1252")}


class Font:
    """Codes of a font: their characters, widths, and how far below the line it reaches."""

    def __init__(self, doc: Document, about: dict) -> None:
        get = doc.get
        self.wide = about.get("Subtype") == "Type0"
        own = get((get(about.get("DescendantFonts")) or [{}])[0]) if self.wide else about
        described = get(own.get("FontDescriptor")) or {}
        self.descent = float(get(described.get("Descent", 0.0))) / 1000
        if self.descent > 0:
            self.descent = -self.descent
        self.widths: dict[int, float] = {}
        self.other = float(get(own.get("DW", 1000.0)) if self.wide else get(described.get("MissingWidth", 0.0 if "Widths" in own else PLAIN_WIDTH)))
        if self.wide:
            self._composite(get, get(own.get("W")) or [])
        else:
            first = int(get(own.get("FirstChar", 0.0)))
            self.widths.update((first + k, float(get(w))) for k, w in enumerate(get(own.get("Widths")) or []))
        self.map = GlyphMap()
        self.map.digits = 4 if self.wide else 2
        if isinstance(ref := about.get("ToUnicode"), Ref):
            for operator, operands in ContentStream(doc.data(ref.number).decode("latin-1")).operations():
                self.map.learn(operator, operands)
        self.names = {} if self.wide else self._names(get, get(about.get("Encoding")))

    def _composite(self, get, items: list) -> None:
        k = 0
        while k + 1 < len(items):
            low, to = int(items[k]), get(items[k + 1])
            if isinstance(to, list):
                self.widths.update((low + j, float(get(w))) for j, w in enumerate(to))
                k += 2
            else:
                self.widths.update(dict.fromkeys(range(low, int(to) + 1), float(get(items[k + 2]))))
                k += 3

    @staticmethod
    def _names(get, encoding) -> dict[int, str]:
        base = encoding.get("BaseEncoding") if isinstance(encoding, dict) else encoding
        kind = "mac_roman" if base == "MacRomanEncoding" else "cp1252"
        out = dict(_BASES[kind])
        if isinstance(encoding, dict):
            code = 0
            for item in get(encoding.get("Differences")) or []:
                if isinstance(item, float):
                    code = int(item)
                else:
                    out[code], code = sign_of(item), code + 1
        return out

    def codes(self, shown: tuple[str, str]) -> list[int]:
        kind, text = shown
        raw = bytes.fromhex(text + "0" * (len(text) % 2)) if kind == "hex" else text.encode("latin-1", "replace")
        step = 2 if self.wide else 1
        return [int.from_bytes(raw[k : k + step]) for k in range(0, len(raw) - step + 1, step)]

    def text(self, code: int) -> str:
        return self.map.chars.get(code) or self.names.get(code, "�")


Matrix = tuple[float, float, float, float, float, float]
UNIT: Matrix = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)


def times(m: Matrix, n: Matrix) -> Matrix:
    """First ``m``, then ``n``."""
    (a, b, c, d, e, f), (p, q, r, s, t, u) = m, n
    return a * p + b * r, a * q + b * s, c * p + d * r, c * q + d * s, e * p + f * r + t, e * q + f * s + u


@dataclass(frozen=True)
class State:
    """What ``q`` keeps and ``Q`` brings back."""

    place: Matrix = UNIT
    font: Font | None = None
    size: float = 0.0
    spacing: float = 0.0
    word_spacing: float = 0.0
    scale: float = 1.0
    leading: float = 0.0
    rise: float = 0.0


#: Operators that set one number of the state, and what it is multiplied with.
SETS = {"Tc": ("spacing", 1.0), "Tw": ("word_spacing", 1.0), "Tz": ("scale", 0.01), "TL": ("leading", 1.0), "Ts": ("rise", 1.0)}


@dataclass
class PageText:
    """Runs the content of a page; ``out`` has (text, x0, x1, top) of each character."""

    doc: Document
    height: float
    out: list[tuple[str, float, float, float]] = field(default_factory=list)
    fonts: dict[int, Font] = field(default_factory=dict)

    def _font(self, resources: dict, name: str) -> Font | None:
        about = self.doc.get((self.doc.get(resources.get("Font")) or {}).get(name))
        if not isinstance(about, dict):
            return None
        if id(about) not in self.fonts:
            self.fonts[id(about)] = Font(self.doc, about)
        return self.fonts[id(about)]

    def show(self, state: State, line: Matrix, shown: tuple[str, str]) -> Matrix:
        """Puts the characters of a string; gives where the next one begins."""
        font, size = state.font, state.size
        for code in font.codes(shown) if font else []:
            width = font.widths.get(code, font.other) / 1000 * size * state.scale
            low = font.descent * size + state.rise
            at = times(line, state.place)
            corners = [(x * at[0] + y * at[2] + at[4], x * at[1] + y * at[3] + at[5]) for x in (0.0, width) for y in (low, low + size)]
            xs, ys = zip(*corners)
            self.out.append((font.text(code), min(xs), max(xs), self.height - max(ys)))
            gap = state.spacing + (state.word_spacing if code == 32 and not font.wide else 0.0)
            line = times((1.0, 0.0, 0.0, 1.0, width + gap * state.scale, 0.0), line)
        return line

    def run(self, data: str, resources: dict, state: State, depth: int = 0) -> None:
        kept: list[State] = []
        line = start = UNIT
        # images within the stream hold no operators
        data = re.sub(r"\bID\s.*?\sEI\b", " ", data, flags=re.DOTALL)
        for operator, operands in ContentStream(data).operations():
            n = [float(o[1]) for o in operands if isinstance(o, tuple) and o[0] == "word" and re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)", o[1])]
            if operator == "q":
                kept.append(state)
            elif operator == "Q" and kept:
                state = kept.pop()
            elif operator == "cm" and len(n) == 6:
                state = replace(state, place=times(tuple(n), state.place))
            elif operator == "BT":
                line = start = UNIT
            elif operator == "Tf" and operands and n:
                state = replace(state, font=self._font(resources, operands[0][1][1:]), size=n[-1])
            elif operator in SETS and n:
                name, unit = SETS[operator]
                state = replace(state, **{name: n[-1] * unit})
            elif operator in ("Td", "TD") and len(n) == 2:
                if operator == "TD":
                    state = replace(state, leading=-n[1])
                line = start = times((1.0, 0.0, 0.0, 1.0, *n), start)
            elif operator == "Tm" and len(n) == 6:
                line = start = tuple(n)
            elif operator in ("T*", "'", '"'):
                if operator == '"' and len(n) == 2:
                    state = replace(state, word_spacing=n[0], spacing=n[1])
                line = start = times((1.0, 0.0, 0.0, 1.0, 0.0, -state.leading), start)
            elif operator == "Do" and operands and depth < DEPTH:
                self._form(operands[0][1][1:], resources, state, depth)
            if operator in ("Tj", "TJ", "'", '"') and operands:
                last = operands[-1]
                for part in last if isinstance(last, list) else [last]:
                    if part[0] == "word":
                        line = times((1.0, 0.0, 0.0, 1.0, -float(part[1]) / 1000 * state.size * state.scale, 0.0), line)
                    elif isinstance(part, tuple):
                        line = self.show(state, line, part)

    def _form(self, name: str, resources: dict, state: State, depth: int) -> None:
        ref = (self.doc.get(resources.get("XObject")) or {}).get(name)
        about = self.doc.get(ref)
        if isinstance(ref, Ref) and isinstance(about, dict) and about.get("Subtype") == "Form":
            matrix = tuple(map(float, self.doc.get(about.get("Matrix")) or UNIT))
            own = self.doc.get(about.get("Resources")) or resources
            self.run(self.doc.data(ref.number).decode("latin-1"), own, replace(state, place=times(matrix, state.place)), depth + 1)


def page_chars(doc: Document, page: dict) -> list[tuple[str, float, float, float]]:
    """(text, x0, x1, top) of a page, from its upper left corner as it is read."""
    x0, y0, x1, y1 = (float(doc.get(v)) for v in doc.get(page.get("MediaBox")) or (0, 0, 612, 792))
    turned = int(doc.get(page.get("Rotate")) or 0) % 360
    width, height = x1 - x0, y1 - y0
    moved = (1.0, 0.0, 0.0, 1.0, -x0, -y0)
    turn = {0: UNIT, 90: (0.0, -1.0, 1.0, 0.0, 0.0, width), 180: (-1.0, 0.0, 0.0, -1.0, width, height), 270: (0.0, 1.0, -1.0, 0.0, height, 0.0)}[turned]
    contents = page.get("Contents")
    parts = doc.get(contents) if isinstance(doc.get(contents), list) else [contents]
    # parts of one content: an operator may begin in one and its operands end in the next
    data = "\n".join(doc.data(p.number).decode("latin-1") for p in parts if isinstance(p, Ref))
    text = PageText(doc, width if turned % 180 else height)
    text.run(data, doc.get(page.get("Resources")) or {}, State(place=times(moved, turn)))
    return text.out


_KINDS = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.string()]
_NAMES = ["document", "page", "seq", "text", "x0", "x1", "top", "warning"]
CHAR_ROWS = "document string, page int, seq bigint, text string, x0 double, x1 double, top double, warning string"


def char_rows(docs: DataFrame) -> DataFrame:
    """A row for each character of (document, content), page by page.

    Map-only.  A document or page that cannot be read gives one row that has ``warning`` instead of a character.
    """

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], _NAMES)

    def warned(name: str, page: int | None, why: Exception) -> pa.RecordBatch:
        return batch([(name, page, None, None, None, None, None, f"{type(why).__name__}: {why}")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, raw in zip(b.column(0).to_pylist(), b.column(1)):
                number = None
                try:
                    doc = Document(raw.as_py() or b"")
                    for number, page in enumerate(doc.pages(), 1):
                        try:
                            rows = [(name, number, k, *c, None) for k, c in enumerate(page_chars(doc, page))]
                        except Exception as why:  # noqa: BLE001  a page of any kind of damage
                            yield warned(name, number, why)
                            continue
                        if rows:
                            yield batch(rows)
                    if number is None:
                        raise ValueError("no pages")
                except Exception as why:  # noqa: BLE001
                    yield warned(name, number, why)

    return docs.select("document", "content").mapInArrow(run, CHAR_ROWS)
