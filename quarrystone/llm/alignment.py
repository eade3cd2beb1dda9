"""Alignment of two tokenizers: a dictionary of groups of tokens that cover the same bytes.

A text is encoded by a byte-level vocabulary (A, as space + text) and a piece vocabulary
(B, which puts the space first itself).  Where tokens of both end at one byte, the text is
cut into groups.  Groups repeat all over a corpus, so a group is looked at once:

1. One map-only pass cuts texts into units at single spaces, where both vocabularies end a
   token, and encodes the distinct units of a step once, by the libraries.  It gives, for
   each text, its distinct groups with how often each stands there; and for each task, the
   dictionary entries it met (key, links, number of its texts), interned in a worker's table
   of bounded size.
2. Entries of equal keys are put together: the dictionary of all distinct groups, the
   links of each expanded once.  A key of one token each is the two ids themselves; a
   longer one is a hash, and should two groups ever share one, all is done again with
   other hashes.
3. An id pair's count is the sum of the texts of the groups that hold it, less what texts
   with several such groups counted too often (the first pass gives that, summed by task).
4. Counts and whether they are the highest of their A id are added up for each group of
   the dictionary, and joined back to the texts by group key: groups of most texts are
   broadcast, within a bound, all others joined by a shuffle, so that no key is hot.

Cases: null text, empty text, and a text that a vocabulary does not give back byte by byte
(U+2581 is such a character) have no tokens: zeros and an empty digest column; strings of
special tokens are plain text; a text of any length is encoded in memory linear in its
longest unit; rows with equal or null ids and repeated rows are texts of their own; of
equal highest counts all are best; further columns are ignored, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import piece_bpe, token_store
from quarrystone.llm.common import discard, hash_words, materialise, mix, slices, small_batches, table, text_bytes, tidied

#: Groups and links that a worker keeps before it starts again.
GROUPS, LINKS = 400_000, 3_000_000
#: Text bytes of one step.
STEP_BYTES = 1_500_000
#: Units that the libraries see in one text.
JOIN = 128
#: Groups of the dictionary up to which scores are broadcast to the texts.
BROADCAST_ROWS = 300_000
#: The character by which pieces write a space; in a text it is not given back.
MARK = piece_bpe.MARK
#: Bits of a B id in a pair.
SHIFT = 32
_C = np.uint64(0xD6E8FEB86659FD93)


def _flat(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places ``begin[k]``, ..., ``begin[k] + size[k] - 1`` for each k in turn."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _rows_hash(ids: np.ndarray, begin: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each run of ids."""
    with np.errstate(over="ignore"):
        h = mix(size.astype(np.uint64) + np.uint64(seed) * _C)
        live, k = np.flatnonzero(size > 0), 0
        while len(live):
            h[live] = mix(h[live] * _C + ids[begin[live] + k].astype(np.uint64) + np.uint64(1))
            k += 1
            live = live[size[live] > k]
    return h


def byte_letters() -> dict[str, int]:
    """The characters by which a byte-level vocabulary writes bytes: printable ones stand for themselves, the others are counted from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class _Vocabulary:
    """Ids of units, and the bytes of each id."""

    def __init__(self, encode, pieces: list[bytes]):
        self.encode = encode
        self.pool = np.frombuffer(b"".join(pieces), np.uint8)
        self.size = np.array([*map(len, pieces)], np.int64)
        self.begin = np.cumsum(self.size) - self.size

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.encode(texts)
        return np.fromiter(itertools.chain.from_iterable(found), np.int64, sum(map(len, found))), np.array([*map(len, found)], np.int64)

    def gives_back(self, ids: np.ndarray, data: bytes) -> bool:
        return self.pool[_flat(self.begin[ids], self.size[ids])].tobytes() == data


class Aligner:
    """Groups of units, interned; see the module's text."""

    def __init__(self, byte_file: str, piece_file: str, seed: int):
        import sentencepiece
        from tokenizers import Tokenizer

        a = Tokenizer.from_file(byte_file)
        a.encode_special_tokens = True
        b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        letters = byte_letters()
        # a byte-level vocabulary writes each byte as one character; a special token stands for its own string
        spelled = lambda t: bytes([letters[c] for c in t]) if all(c in letters for c in t) else t.encode()
        self.a = _Vocabulary(lambda texts: [e.ids for e in a.encode_batch_fast(texts, add_special_tokens=False)], [spelled(a.id_to_token(i) or "") for i in range(a.get_vocab_size())])
        piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace(MARK, " ").encode()
        # the library puts the space first itself
        self.b = _Vocabulary(lambda texts: b.encode([t[1:] for t in texts], num_threads=1), [piece(i) for i in range(b.vocab_size())])
        self.seed = seed
        self.reset()

    def reset(self) -> None:
        self.groups: dict[int, int] = {}
        self.keys: list[int] = []
        self.checks: list[int] = []
        self.names: list[str] = []
        self.links: list[list[int]] = []
        self.pairs: list[tuple[int, ...]] = []
        self.pair_ids: dict[int, int] = {}
        self.clash: set[int] = set()
        self.docs = np.zeros(1024, np.int64)
        self.held = 0

    def _encoded(self, v: _Vocabulary, units: list[bytes], texts: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of units end to end, where each id ends in them, and which units are given back byte by byte.

        ``texts``: the units of one text each.
        """
        joined = [b"".join([units[k] for k in t]) for t in texts]
        ids, n = v.ids([x.decode("utf-8", "surrogatepass") for x in joined])
        ends = np.cumsum(v.size[ids])
        unit_ends = np.cumsum([*map(len, units)])
        if v.gives_back(ids, b"".join(joined)) and np.isin(unit_ends, ends).all():
            return ids, ends, np.ones(len(units), bool)
        # a text that is not: each unit by itself
        good, parts, at = np.ones(len(units), bool), [], 0
        cut = np.concatenate([[0], np.cumsum(n)])
        for k, t in enumerate(texts):
            own = ids[cut[k] : cut[k + 1]]
            if v.gives_back(own, joined[k]) and np.isin(np.cumsum([len(units[u]) for u in t]), np.cumsum(v.size[own])).all():
                parts.append((own, at + np.cumsum(v.size[own])))
                at += len(joined[k])
                continue
            for u in t:
                own, _ = v.ids([units[u].decode("utf-8", "surrogatepass")])
                at += len(units[u])
                if v.gives_back(own, units[u]):
                    parts.append((own, at - len(units[u]) + np.cumsum(v.size[own])))
                else:
                    good[u] = False
        return (*(np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in (0, 1)), good)

    def learn(self, units: list[bytes]) -> tuple[np.ndarray, ...]:
        """Of each unit: A ids, B ids, groups, links and whether both vocabularies give it back; and all interned groups in turn."""
        # a unit that begins as at a sure cut may follow another in one text
        inner = [k for k, u in enumerate(units) if len(u) > 1 and not token_store._SPACE_LIST[u[1]]]
        rest = sorted({*range(len(units))} - {*inner})
        order = inner + rest
        texts = [[*range(k, min(k + JOIN, len(inner)))] for k in range(0, len(inner), JOIN)] + [[k] for k in range(len(inner), len(order))]
        own = [units[k] for k in order]
        (ids_a, ends_a, good_a), (ids_b, ends_b, good_b) = (self._encoded(v, own, texts) for v in (self.a, self.b))
        unit_ends = np.cumsum([*map(len, own)]) if own else np.zeros(0, np.int64)
        ok = good_a & good_b
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        unit = np.searchsorted(unit_ends, ends)
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        # a unit that one vocabulary lost has no groups; those before it end with their units
        keep = ok[unit] if len(unit) else np.zeros(0, bool)
        begin_a, begin_b = np.concatenate([[0], at_a[:-1] + 1]), np.concatenate([[0], at_b[:-1] + 1])
        lost_a, lost_b = (~ok[np.searchsorted(unit_ends, e)] if len(e) else np.zeros(0, bool) for e in (ends_a, ends_b))
        skip_a, skip_b = np.concatenate([[0], np.cumsum(lost_a)]), np.concatenate([[0], np.cumsum(lost_b)])
        at_a, at_b, begin_a, begin_b, unit = at_a[keep], at_b[keep], begin_a[: len(ends)][keep], begin_b[: len(ends)][keep], unit[keep]
        size_a = at_a + 1 - begin_a - (skip_a[at_a + 1] - skip_a[begin_a])
        size_b = at_b + 1 - begin_b - (skip_b[at_b + 1] - skip_b[begin_b])
        begin_a, begin_b = at_a + 1 - size_a, at_b + 1 - size_b
        group = self._intern(ids_a, ends_a, begin_a, size_a, ids_b, ends_b, begin_b, size_b)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        sums = [np.bincount(unit, weights=w, minlength=len(order)).astype(np.int64)[back] for w in (size_a, size_b, np.ones(len(unit)), size_a + size_b - 1)]
        first = np.searchsorted(unit, np.arange(len(order)))[back] if len(order) else back
        return (*sums, ok[back], group[_flat(first, sums[2])])

    def _intern(self, ids_a, ends_a, begin_a, size_a, ids_b, ends_b, begin_b, size_b) -> np.ndarray:
        if not len(size_a):
            return np.zeros(0, np.int64)
        both = (ids_a[begin_a] << SHIFT) | ids_b[begin_b]
        more = np.flatnonzero((size_a > 1) | (size_b > 1))
        run = lambda seed: _rows_hash(ids_a, begin_a[more], size_a[more], seed) * _C ^ _rows_hash(ids_b, begin_b[more], size_b[more], seed + 1)
        key, check = both.copy(), both.copy()
        with np.errstate(over="ignore"):
            # a longer group's key is negative
            key[more] = (mix(run(4 * self.seed)) | np.uint64(1 << 63)).view(np.int64)
            check[more] = mix(run(4 * self.seed + 2)).view(np.int64)
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        self.clash.update(key[check != check[first][inverse]].tolist())
        local = np.empty(len(first), np.int64)
        known = [*map(self.groups.get, key[first].tolist())]
        for j, (k, at) in enumerate(zip(first.tolist(), known)):
            if at is None:
                at = self._add(int(key[k]), int(check[k]), *(x[y : y + n] for x, y, n in ((ids_a, begin_a[k], size_a[k]), (ends_a, begin_a[k], size_a[k]), (ids_b, begin_b[k], size_b[k]), (ends_b, begin_b[k], size_b[k]))))
            elif self.checks[at] != check[k]:
                self.clash.add(int(key[k]))
            local[j] = at
        return local[inverse]

    def _add(self, key: int, check: int, a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray) -> int:
        a, b = a.tolist(), b.tolist()
        # an id of either side is linked with those of the other whose ends lie from its start on, up to its end
        to_a, to_b = np.searchsorted(ends_a, ends_b).tolist(), np.searchsorted(ends_b, ends_a).tolist()
        links = sorted({(i, to_b[i]) for i in range(len(a))} | {(to_a[j], j) for j in range(len(b))})
        links = [a[i] << SHIFT | b[j] for i, j in links]
        at = self.groups[key] = len(self.keys)
        self.keys.append(key)
        self.checks.append(check)
        self.names.append(f"{','.join(map(str, a))}|{','.join(map(str, b))}")
        self.links.append(links)
        self.pairs.append(tuple(self.pair_ids.setdefault(p, len(self.pair_ids)) for p in dict.fromkeys(links)))
        self.held += len(links)
        return at

    def full(self) -> bool:
        return len(self.keys) > GROUPS or self.held > LINKS


_ALIGNERS: dict[tuple[str, str, int], Aligner] = {}

#: kind 0: a text; 1: an entry of the dictionary; 2: texts that hold a pair in more than one group.
SCHEMA = "kind int, row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, keys array<bigint>, times array<int>, key bigint, links array<bigint>, docs bigint"
_FIELDS = [("kind", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("keys", pa.list_(pa.int64())), ("times", pa.list_(pa.int32())), ("key", pa.int64()), ("links", pa.list_(pa.int64())), ("docs", pa.int64())]


def _batch(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[k].cast(t) if k in columns else pa.nulls(n, t) for k, t in _FIELDS], [k for k, _ in _FIELDS])


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def _texts(al: Aligner, some: pa.RecordBatch, row: int, extra: dict[int, int]) -> pa.RecordBatch:
    """Rows of kind 0 for one slice of texts; counts texts of groups, and pairs met again within a text."""
    col = some.column(1)
    col = pc.if_else(pc.equal(pc.binary_length(col.fill_null("")), 0), "", pc.binary_join_element_wise(" ", col.fill_null(""), ""))
    docs = len(col)
    data, off = text_bytes(col)
    starts = token_store._cuts(data, off)
    starts = starts[(data[starts] == 32) | np.isin(starts, off)] if len(starts) else starts
    ends = np.append(starts[1:], len(data))[: len(starts)]
    doc = np.searchsorted(off[1:], starts, side="right")
    _, first, unit = np.unique(hash_words(data, starts, ends), return_index=True, return_inverse=True)
    raw = data.tobytes()
    per_a, per_b, per_group, per_link, ok, flat = al.learn([raw[x:y] for x, y in zip(starts[first].tolist(), ends[first].tolist())])
    bad = np.zeros(docs, bool)
    bad[doc[~ok[unit]]] = True
    good = ~bad[doc]
    unit, doc = unit[good], doc[good]
    sums = [np.bincount(doc, weights=per[unit], minlength=docs).astype(np.int64) for per in (per_a, per_b, per_link)]
    n = per_group[unit]
    group = flat[_flat((np.cumsum(per_group) - per_group)[unit], n)]
    owner = np.repeat(doc, n)
    cut = np.searchsorted(owner, np.arange(docs + 1)).tolist()
    names = [*map(al.names.__getitem__, group.tolist())]
    digests = [hashlib.sha256(";".join(names[x:y]).encode()).hexdigest() if x < y else "" for x, y in zip(cut, cut[1:])]
    # distinct groups of each text, and how often
    codes, times = np.unique(owner * len(al.keys) + group, return_counts=True) if len(group) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    owner, distinct = (codes // len(al.keys), codes % len(al.keys)) if len(codes) else (codes, codes)
    if len(al.docs) < len(al.keys):
        al.docs = np.concatenate([al.docs, np.zeros(2 * len(al.keys) - len(al.docs), np.int64)])
    np.add.at(al.docs, distinct, 1)
    _again(al, owner, distinct, extra)
    keys = np.array(al.keys, np.int64)[distinct] if len(distinct) else distinct
    at = np.searchsorted(owner, np.arange(docs + 1))
    return _batch(
        docs, kind=pa.array(np.zeros(docs, np.int32)), row=pa.array(row + np.arange(docs)), doc_id=some.column(0), n_a=pa.array(sums[0]), n_b=pa.array(sums[1]), n_links=pa.array(sums[2]),
        n_groups=pa.array(np.bincount(owner, weights=times, minlength=docs).astype(np.int64)), groups_sha256=pa.array(digests, pa.string()), keys=_lists(at, pa.array(keys)), times=_lists(at, pa.array(times.astype(np.int32))),
    )


def _again(al: Aligner, owner: np.ndarray, group: np.ndarray, extra: dict[int, int]) -> None:
    """Adds, for each pair that a text holds in several distinct groups, all groups but one."""
    if not len(group):
        return
    some, at = np.unique(group, return_inverse=True)
    lists = [al.pairs[g] for g in some.tolist()]
    size = np.array([*map(len, lists)], np.int64)
    flat = np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(size.sum()))
    n = size[at]
    pair = flat[_flat((np.cumsum(size) - size)[at], n)]
    codes = np.sort(np.repeat(owner, n) * len(al.pair_ids) + pair)
    pairs, more = np.unique(codes[1:][codes[1:] == codes[:-1]] % len(al.pair_ids), return_counts=True)
    for p, m in zip(pairs.tolist(), more.tolist()):
        extra[p] = extra.get(p, 0) + m


def _entries(al: Aligner, extra: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """Rows of kinds 1 and 2 of what was met since the last call."""
    met = np.flatnonzero(al.docs)
    for at in range(0, len(met), 20_000):
        part = met[at : at + 20_000]
        links = [al.links[g] for g in part.tolist()]
        yield _batch(len(part), kind=pa.array(np.ones(len(part), np.int32)), key=pa.array([al.keys[g] for g in part.tolist()], pa.int64()), links=pa.array(links, pa.list_(pa.int64())), docs=pa.array(al.docs[part]))
    if al.clash:
        yield _batch(len(al.clash), kind=pa.array(np.ones(len(al.clash), np.int32)), key=pa.array(al.clash, pa.int64()), links=pa.array([[]] * len(al.clash), pa.list_(pa.int64())), docs=pa.array(np.zeros(len(al.clash), np.int64)))
    if extra:
        names = np.fromiter(al.pair_ids, np.int64, len(al.pair_ids))
        yield _batch(len(extra), kind=pa.array(np.full(len(extra), 2, np.int32)), key=pa.array(names[np.fromiter(extra, np.int64, len(extra))]), docs=pa.array(extra.values(), pa.int64()))
    al.docs[:] = 0
    al.clash.clear()
    extra.clear()


def group_texts(docs: DataFrame, byte_file: str, piece_file: str, seed: int = 0) -> DataFrame:
    """Texts with their groups, dictionary entries and pairs met again (``SCHEMA``).  Map-only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        name = (byte_file, piece_file, seed)
        if name not in _ALIGNERS:
            _ALIGNERS[name] = Aligner(*name)
        al, extra = _ALIGNERS[name], {}
        row = TaskContext.get().partitionId() << 40
        al.docs[:] = 0
        for b in batches:
            for some in slices(b, "text", STEP_BYTES):
                yield _texts(al, some, row, extra)
                row += some.num_rows
                if al.full():
                    yield from _entries(al, extra)
                    al.reset()
        yield from _entries(al, extra)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return small_batches(texts).mapInArrow(tidied(run), SCHEMA)


def group_dictionary(grouped: DataFrame) -> DataFrame:
    """(key, links, docs, clash): each distinct group, the id pairs it links, and the number of texts with it."""
    entries = grouped.where("kind = 1").select("key", "links", "docs", F.xxhash64("links").alias("h"))
    same = entries.groupBy("key").agg(F.min_by("links", "h").alias("links"), F.sum("docs").alias("docs"), (F.min("h") != F.max("h")).alias("clash"))
    return same


def pair_counts(groups: DataFrame, grouped: DataFrame) -> DataFrame:
    """(pair, count): in how many texts the ids of a pair are linked."""
    once = groups.select(F.explode(F.array_distinct("links")).alias("pair"), F.col("docs").alias("count"))
    again = grouped.where("kind = 2").select(F.col("key").alias("pair"), (-F.col("docs")).alias("count"))
    return once.unionByName(again).groupBy("pair").agg(F.sum("count").alias("count"))


def _hot_level(scores: DataFrame) -> int:
    """The least power of two of texts from which on no more than ``BROADCAST_ROWS`` groups have so many."""
    levels = {r["level"]: r["n"] for r in scores.groupBy(F.floor(F.log2("docs")).cast("int").alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total, level = 0, 63
    while level > 0 and total + levels.get(level - 1, 0) <= BROADCAST_ROWS:
        level -= 1
        total += levels.get(level, 0)
    return level


def align_tokenizers(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row of ``docs``."""
    spark = docs.sparkSession
    for seed in itertools.count():
        grouped = materialise(spark, group_texts(docs, byte_file, piece_file, seed))
        groups = materialise(spark, group_dictionary(grouped))
        if not groups.where("clash").limit(1).count():
            break
        discard(grouped, groups)
    counts = materialise(spark, pair_counts(groups, grouped))
    # one row for each id of a vocabulary at most
    best = counts.groupBy((F.shiftright("pair", SHIFT)).alias("a")).agg(F.max("count").alias("best"))
    known = counts.join(F.broadcast(best), F.shiftright(F.col("pair"), SHIFT) == F.col("a")).select("pair", "count", (F.col("count") == F.col("best")).cast("long").alias("is_best"))
    links = groups.select("key", "docs", F.explode("links").alias("pair"))
    scores = materialise(spark, links.join(materialise(spark, known), "pair").groupBy("key", "docs").agg(F.sum("is_best").alias("best"), F.sum("count").alias("total")))
    uses = grouped.where("kind = 0").select("row", F.explode(F.arrays_zip("keys", "times")).alias("use")).select("row", F.col("use.keys").alias("key"), F.col("use.times").cast("long").alias("times"))
    add = lambda df: df.groupBy("row").agg(F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("total")).alias("count_sum"))
    if scores.count() <= BROADCAST_ROWS:
        sums = add(uses.join(F.broadcast(scores.drop("docs")), "key"))
    else:
        level = _hot_level(scores)
        hot, rest = (scores.where(c).drop("docs") for c in (F.col("docs") >= 2**level, F.col("docs") < 2**level))
        parts = add(uses.join(F.broadcast(hot), "key")).unionByName(add(uses.join(F.broadcast(hot.select("key")), "key", "left_anti").join(rest, "key")))
        sums = parts.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    texts = grouped.where("kind = 0").select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = F.lit(0).cast("long")
    return texts.join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"), token_store.default_tokenizer(), piece_bpe.default_model())
