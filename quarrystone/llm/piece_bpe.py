"""SentencePiece BPE encoding and decoding from a table of prefix tokens.

For a byte-pair merge order, the encoding of a text is the only split into
tokens in which every token encodes to itself and every two neighbours encode
to just those two.  So the encoding of each prefix ends with one certain token,
and the table of these tokens, from which the ids are read backwards, is filled
in one pass: an automaton lists the tokens that end at a position, and the one
that is compatible with the last token of the prefix before it is the right one.

The tables come from the model file alone (pieces and their scores).  Texts are
cut where a white-space mark follows another character (no piece spans such a
place, which :class:`PieceCodec` verifies), so that equal words share one
computation.

Cases: null text = empty text = no ids and an empty decoded text; characters
without a piece become byte pieces; a text of any length is encoded whole in
memory linear in its length; repeated rows and equal words get the same ids; further
columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quarrystone.llm.common import small_batches, table, tidied

MARK = "▁"
#: Entries that a cache of a worker holds before its older half is dropped.
CACHE_ENTRIES = 220_000


class PieceCodec:
    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = model.vocab_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.scores = {i: model.get_score(i) for i in plain}
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.known = {p for p in self.ids if len(p) == 1}
        self.decimal = [*map(str, range(n))]
        self.spelled = [p.replace(MARK, " ") for p in self.pieces]
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece has a white-space mark after another character")
        if any(c not in self.known for p in self.ids for c in p):
            raise ValueError("a piece has a character that is no piece itself")
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if len(p) == 1 or self._merge(p) == [i]:
                self.automaton.add_word(p, (i, len(p), i << 20))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.odd: dict[str, str] = {}

    def _merge(self, text: str) -> list[int]:
        """The merges by definition, for single pieces and pairs of pieces: the best
        score first, of equal ones the leftmost."""
        parts, ids, scores = list(text), self.ids, self.scores
        while len(parts) > 1:
            best = None
            for k in range(len(parts) - 1):
                i = ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or scores[i] > best[0]):
                    best = (scores[i], k)
            if best is None:
                break
            k = best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [ids[p] for p in parts]

    def _compatible(self, left: int, right: int) -> bool:
        key = left << 20 | right
        ok = self.pairs.get(key)
        if ok is None:
            if len(self.pairs) > CACHE_ENTRIES:
                self.pairs.clear()
            ok = self.pairs[key] = self._merge(self.pieces[left] + self.pieces[right]) == [left, right]
        return ok

    def _run(self, text: str) -> list[int]:
        """Ids of a text of known characters only.  ``last[k]``: the last token of the first k + 1 characters."""
        last: list = [None] * len(text)
        pairs, slow = self.pairs, self._compatible
        for end, token in self.automaton.iter(text):
            if last[end] is None:
                i, n, _ = token
                if n <= end:
                    left = last[end - n]
                    ok = pairs.get(left[2] | i)
                    if ok is None:
                        ok = slow(left[0], i)
                    if not ok:
                        continue
                last[end] = token
        out, at = [], len(text) - 1
        while at >= 0:
            i, n, _ = last[at]
            out.append(i)
            at -= n
        out.reverse()
        return out

    def _unit(self, unit: str) -> list[int]:
        if self.known.issuperset(unit):
            return self._run(unit)
        out: list[int] = []
        start = 0
        for k, c in enumerate(unit):
            if c not in self.known:
                if start < k:
                    out += self._run(unit[start:k])
                out += [self.byte_ids[b] for b in c.encode()]
                start = k + 1
        if start < len(unit):
            out += self._run(unit[start:])
        return out

    def _units(self, text: str) -> list[str]:
        """The normalised text in units that begin with white-space marks."""
        text = MARK + text.replace(" ", MARK)
        if MARK * 2 not in text:
            return text[1:].split(MARK) if not text.endswith(MARK) else re.findall(f"{MARK}+[^{MARK}]*", text)
        return re.findall(f"{MARK}+[^{MARK}]*", text)

    def _entry(self, unit: str) -> str:
        """Ids of a unit in decimal with commas.  Units that decode to anything but
        themselves are noted in ``odd``."""
        found = self.older.get(unit)
        if found is None:
            full = unit if unit[:1] == MARK else MARK + unit
            if self.known.issuperset(full):
                ids = self._run(full)
                text = "".join([self.spelled[i] for i in ids])
            else:
                ids = self._unit(full)
                text = self._spell(ids)
            if text != full.replace(MARK, " "):
                self.odd[unit] = text
            found = ",".join([self.decimal[i] for i in ids])
        if len(self.words) >= CACHE_ENTRIES:
            self.older, self.words = self.words, {}
        if len(unit) <= 64:
            self.words[unit] = found
        return found

    def _spell(self, ids: list[int]) -> str:
        """The text of ids with the mark of the first one kept as a space."""
        out, held = [], bytearray()
        for i in ids:
            b = self.bytes_of.get(i)
            if b is not None:
                held.append(b)
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held = bytearray()
            out.append(self.pieces[i])
        if held:
            out.append(held.decode("utf-8", "replace"))
        return "".join(out).replace(MARK, " ")

    def encode(self, text: str) -> list[int]:
        """Ids of a text as the library gives them without begin or end ids."""
        if not text:
            return []
        return [int(i) for u in self._units(text) for i in (self.words.get(u) or self._entry(u)).split(",")]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the space that encoding puts first goes."""
        text = self._spell([i for i in ids if i in self.bytes_of or i in self.scores])
        return text[1:] if text[:1] == " " else text

    def trim(self, keep: int = 180_000) -> None:
        """Keeps the words met first, which are the common ones, for the next task."""
        self.older, self.odd = {}, {}
        self.words = dict(itertools.islice(self.words.items(), keep))

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids in decimal with commas, and SHA-256 of the decoded text."""
        if not text:
            return 0, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest()
        units = self._units(text)
        found = [*map(self.words.get, units)]
        if None in found:
            found = [self._entry(u) if f is None else f for u, f in zip(units, found)]
        ids = ",".join(found)
        spelled = [u.replace(MARK, " ") if u[:1] == MARK else " " + u for u in units]
        if self.odd:
            spelled = [self.odd.get(u, t) for u, t in zip(units, spelled)]
        return ids.count(",") + 1, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256("".join(spelled)[1:].encode()).hexdigest()


_CODECS: dict[str, PieceCodec] = {}


def codec(model_file: str) -> PieceCodec:
    """One codec for each model file and worker process."""
    if model_file not in _CODECS:
        _CODECS[model_file] = PieceCodec(model_file)
    return _CODECS[model_file]


def encode_texts(df: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Ids (``with_ids``), their number and digests, and the digest of the decoded text, of each row.

    Map-only: no shuffle.  The result has ``id_col`` and the new columns.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_file)
        for b in batches:
            texts = b.column(1)
            cols: list[list] = [[], [], [], []]
            for t in texts:
                t = t.as_py()
                if with_ids:
                    cols[3].append(np.array(c.encode(t or ""), dtype=np.int32))
                for out, v in zip(cols, c.digest(t)):
                    out.append(v)
            arrays = [b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                arrays.append(pa.array(cols[3], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)
        c.trim()

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return small_batches(df.select(id_col, text_col)).mapInArrow(tidied(run), schema)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"), default_model())
