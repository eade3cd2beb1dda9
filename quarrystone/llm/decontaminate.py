"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of the benchmark's words over the whole corpus (one pass).
2. TF-IDF vectors of the benchmark passages and a randomised SVD of them: the range of
   A'A is found by a random start and a few power steps, each a distributed pass over
   the passages, and gives the latent space of at most ``rank`` dimensions.
3. Every text is read in windows of 32 and 64 words, a new one every 16 words; windows
   are projected into the space and compared with all items by cosine.  Benchmark
   items are a stated query set, taken in blocks; all windows of the corpus are
   searched, and every window above the threshold is a candidate.
4. Beside it, places are candidates where a text has one of ``RUNS`` runs of ``RUN`` words of
   an item (those that fewest items share), so that an item that very many texts hold, and
   whose words so weigh little, is found too.  What has none of these runs is found by the
   cosine alone.
5. A candidate is confirmed on exact words: the longest common subsequence with the
   words around the window must cover ``overlap`` of the item, and ``answer`` of its
   answer (its last quarter), so paraphrases with other words between still count.

What is broadcast is bounded by a block of items, at most ``ITEMS`` of them with about
``VOCABULARY`` words: these and the projection (a feature for each word, by ``rank``).
The corpus itself is never shuffled; only confirmed pairs leave the tasks.

Cases: null or empty texts and items have no words and match nothing; items of fewer
than eight words (``RUN``) must occur whole and in one piece, and are found by that alone;
equal items are all reported; each of repeated rows is reported; very long texts are
searched whole, one at a time; of equally good places the first is given; further
columns of both tables are ignored or kept as they are; an empty table on either side
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm.common import LETTERS, hash_words, lower_ascii, materialise, mix, slices, small_batches, table, text_bytes, tidied, word_spans

STEP = 16
#: Benchmark items that one pass over the corpus searches for, and about how many words they have together.
ITEMS, VOCABULARY = 4096, 1 << 15
#: Words of a run that makes a candidate by itself, and how many runs of an item are looked for.
RUN, RUNS = 8, 4
#: Share of texts from which on a word weighs nothing, and texts without it that are added to the count of texts.
COMMON, PRIOR = 0.01, 10_000
_C = np.uint64(0xD6E8FEB86659FD93)
#: An item must share so many words with a window before the window is projected.
SHARED = 3
SCHEMA = "doc_id bigint, item_id bigint, similarity double, overlap double, answer double, start_word bigint, end_word bigint"


def words_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of some texts and the text of each word."""
    data, off = text_bytes(col)
    data = lower_ascii(data)
    w0, w1, doc = word_spans(data, off, LETTERS)
    return hash_words(data, w0, w1), doc


def common_subsequence(item: dict[int, int], size: int, seq: list[int]) -> int:
    """Bits of the item that a longest common subsequence with ``seq`` leaves at 0 (bit-parallel)."""
    full = (1 << size) - 1
    v = full
    for w in seq:
        if m := item.get(w):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return full & ~v


def _run_digests(h: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Digests of the runs of ``size`` words that begin at ``at``."""
    out = np.full(len(at), size, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = mix(out * _C + h[at + k])
    return out


class Items:
    """A block of benchmark items: words, TF-IDF weights, latent vectors."""

    def __init__(self, ids: list[int], texts: list[str | None]):
        h, doc = words_of(pa.array(texts, pa.string()))
        split = np.searchsorted(doc, np.arange(len(ids) + 1))
        self.ids = ids
        self.words = [h[a:b] for a, b in zip(split[:-1], split[1:])]
        self.vocabulary = np.unique(h)
        self.masks = []
        for w in self.words:
            m: dict[int, int] = {}
            for k, x in enumerate(w.tolist()):
                m[x] = m.get(x, 0) | 1 << k
            self.masks.append(m)

    def weigh(self, df: np.ndarray, docs: int) -> None:
        """Weights fall with the logarithm of the share of texts that hold a word, to nothing at ``COMMON``;
        an item with fewer than eight words that weigh has its eight rarest."""
        share = (df + 1) / (docs + PRIOR)
        idf = np.maximum(np.log(COMMON / share), 0)
        at = [np.searchsorted(self.vocabulary, w) for w in self.words]
        for w in at:
            u = np.unique(w)
            if (idf[u] > 0).sum() < 8:
                rare = u[np.argsort(df[u], kind="stable")[:8]]
                idf[rare] = np.maximum(idf[rare], 0.1)
        self.weight = idf.astype(np.float32)
        self.index = at

    def vectors(self, rows: range) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for r in rows:
            w = self.index[r]
            nz, times = np.unique(w, return_counts=True)
            f = self.weight[nz] * times
            out.append((nz[f > 0], (f / (np.linalg.norm(f) or 1.0))[f > 0].astype(np.float32)))
        return out


def randomised_basis(spark: SparkSession, items: Items, rank: int, steps: int = 2, seed: int = 5) -> np.ndarray:
    """An orthonormal basis (features x rank) of the leading right singular space of the passages.

    Each step multiplies A'A with the current basis, a distributed pass over blocks of
    passages; the sums that reach the driver have (features used) x (rank + 8) entries.
    """
    used = max(1, len(items.vocabulary))
    width = min(rank, len(items.ids)) + (8 if len(items.ids) > rank else 0)
    q = np.random.default_rng(seed).normal(size=(used, max(1, width))).astype(np.float32)
    blocks = [(k,) for k in range(0, len(items.ids), 512)]
    source = spark.createDataFrame(blocks, "at int").repartition(min(8, len(blocks)))
    shared = spark.sparkContext.broadcast(items)
    for _ in range(steps):
        now = spark.sparkContext.broadcast(q)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros_like(now.value)
            some = False
            for b in batches:
                for at in b.column(0).to_pylist():
                    some = True
                    for nz, v in shared.value.vectors(range(at, min(at + 512, len(shared.value.ids)))):
                        out[nz] += np.outer(v, v @ now.value[nz])
            if some:
                yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["part"])

        parts = [np.frombuffer(r["part"], np.float32).reshape(q.shape) for r in source.mapInArrow(run, "part binary").toLocalIterator()]
        q = np.linalg.qr(reduce(np.add, parts).astype(np.float64))[0].astype(np.float32)
    return q[:, :rank]


def _document_frequency(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """Texts that hold each word of the vocabulary, and the number of texts, over the whole corpus."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        count, texts = np.zeros(len(words), np.int64), 0
        for b in batches:
            texts += b.num_rows
            for some in slices(b, "text"):
                h, doc = words_of(some.column(0))
                at = np.minimum(np.searchsorted(words, h), len(words) - 1)
                hit = words[at] == h
                pair = np.unique(doc[hit] * len(words) + at[hit])
                count += np.bincount(pair % len(words), minlength=len(words))
        nz = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(nz, -1)), pa.array(np.append(count[nz], texts))], ["word", "n"])

    found = docs.select("text").mapInArrow(tidied(run), "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    df, total = np.zeros(len(vocabulary), np.int64), 0
    for word, n in zip(found["word"].to_pylist(), found["n"].to_pylist()):
        if word < 0:
            total = n
        else:
            df[word] = n
    return df, total


class Searcher:
    def __init__(self, items: Items, basis: np.ndarray, threshold: float, overlap: float, answer: float):
        self.items, self.threshold, self.overlap, self.answer = items, threshold, overlap, answer
        self.token = (items.weight[:, None] * basis).astype(np.float32)
        latent = np.zeros((len(items.ids), basis.shape[1]), np.float32)
        for k, (nz, v) in enumerate(items.vectors(range(len(items.ids)))):
            latent[k] = v @ basis[nz]
        norm = np.linalg.norm(latent, axis=1, keepdims=True)
        self.latent = latent / np.maximum(norm, 1e-9)
        self.sets = [set(w.tolist()) for w in items.words]
        # distinct words that a subsequence of the least share must have
        self.least = [len(s) - int((1 - overlap) * len(w)) for s, w in zip(self.sets, items.words)]
        #: By number of words: digests of runs, sorted, and the item of each.
        self.runs: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        known: dict[int, list[tuple[int, np.ndarray]]] = {}
        for k, w in enumerate(items.words):
            if len(w):
                known.setdefault(min(RUN, len(w)), []).append((k, _run_digests(w, np.arange(len(w) - min(RUN, len(w)) + 1), min(RUN, len(w)))))
        for size, found in known.items():
            every, times = np.unique(np.concatenate([np.unique(g) for _, g in found]), return_counts=True)
            picked, owner = [], []
            for k, g in found:
                g = np.unique(g)
                # those that the fewest items share: a run that many have in common says little
                g = g[np.argsort(times[np.searchsorted(every, g)], kind="stable")[:RUNS]]
                picked.append(g)
                owner.append(np.full(len(g), k))
            digest, of = np.concatenate(picked), np.concatenate(owner)
            order = np.argsort(digest, kind="stable")
            self.runs[size] = digest[order], of[order]

    def same_runs(self, h: np.ndarray, doc: np.ndarray, known: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, word, words) where a run that is looked for stands; ``known``: whether a word is one of the items'."""
        before = np.concatenate([[0], np.cumsum(known)])
        for size, (digest, of) in self.runs.items():
            if len(h) < size:
                continue
            at = np.flatnonzero((before[size:] - before[:-size] == size) & (doc[size - 1 :] == doc[: len(doc) - size + 1]))
            if not len(at):
                continue
            g = _run_digests(h, at, size)
            low, high = np.searchsorted(digest, g, side="left"), np.searchsorted(digest, g, side="right")
            for k in np.flatnonzero(high > low):
                for j in range(low[k], high[k]):
                    yield int(doc[at[k]]), int(of[j]), int(at[k]), size

    def candidates(self, at: np.ndarray, known: np.ndarray, doc: np.ndarray, docs: int) -> Iterator[tuple[int, int, int, int, float]]:
        """(text, item, first word, end word, cosine) of windows that are close enough."""
        items = self.items
        n = np.bincount(doc, minlength=docs)
        first = np.cumsum(n) - n
        hit = np.flatnonzero(known & (items.weight[at] > 0))
        if not len(hit):
            return
        at, of = at[hit], doc[hit]
        place = (hit - first[of]) // STEP
        blocks = n // STEP + 4
        start = np.cumsum(blocks) - blocks
        cell = start[of] + place
        change = np.flatnonzero(np.diff(cell)) + 1
        begin = np.concatenate([[0], change])
        used = cell[begin]
        count = np.diff(np.concatenate([begin, [len(cell)]]))
        # where the blocks at hand and those after them stand among the blocks that have words
        for blocks_in in (2, 4):
            # windows begin at a block with words or up to ``blocks_in - 1`` blocks before one
            heads = np.unique(np.concatenate([used - k for k in range(blocks_in)]))
            owner = np.searchsorted(start, heads, side="right") - 1
            heads, owner = heads[(owner >= 0)], owner[owner >= 0]
            rows = np.full((len(heads), blocks_in), -1, np.int64)
            shared = np.zeros(len(heads), np.int64)
            for k in range(blocks_in):
                j = np.minimum(np.searchsorted(used, heads + k), len(used) - 1)
                ok = (used[j] == heads + k) & (heads + k < start[owner] + blocks[owner])
                rows[ok, k] = j[ok]
                shared += np.where(ok, count[j], 0)
            worth = shared >= SHARED
            heads, owner, rows = heads[worth], owner[worth], rows[worth]
            for low in range(0, len(heads), 4096):
                part = rows[low : low + 4096]
                need = np.unique(part[part >= 0])
                tokens = np.concatenate([np.arange(begin[b], begin[b] + count[b]) for b in need]) if len(need) < 64 else self._ranges(begin[need], count[need])
                sums = np.add.reduceat(self.token[at[tokens]], np.cumsum(count[need]) - count[need], axis=0)
                sums = np.concatenate([sums, np.zeros((1, sums.shape[1]), np.float32)])
                pick = np.where(part >= 0, np.searchsorted(need, part), len(need))
                window = sums[pick].sum(axis=1)
                window /= np.maximum(np.linalg.norm(window, axis=1, keepdims=True), 1e-9)
                cosine = window @ self.latent.T
                for w, i in zip(*np.nonzero(cosine >= self.threshold)):
                    d = int(owner[low + w])
                    word = int(heads[low + w] - start[d]) * STEP
                    yield d, int(i), max(0, word), min(int(n[d]), word + blocks_in * STEP), float(cosine[w, i])

    @staticmethod
    def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
        ends = np.cumsum(count)
        out = np.ones(int(ends[-1]), np.int64)
        out[0] = begin[0]
        out[ends[:-1]] = begin[1:] - (begin[:-1] + count[:-1] - 1)
        return np.cumsum(out)

    def confirm(self, item: int, seq: list[int]) -> tuple[float, float]:
        """Shares of the item and of its answer that a longest common subsequence has."""
        size = len(self.items.words[item])
        got = common_subsequence(self.items.masks[item], size, seq)
        tail = max(3, size // 4)
        return got.bit_count() / size, (got >> (size - tail)).bit_count() / tail

    def search(self, col: pa.Array) -> list[tuple[int, int, float, float, float, int, int]]:
        h, doc = words_of(col)
        near: dict[tuple[int, int], list[tuple[int, int, float]]] = {}
        vocabulary = self.items.vocabulary
        at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
        known = vocabulary[at] == h
        for d, i, a, b, c in self.candidates(at, known, doc, len(col)):
            near.setdefault((d, i), []).append((a, b, c))
        split = np.searchsorted(doc, np.arange(len(col) + 1))
        out = []
        short: dict[tuple[int, int], int] = {}
        for d, i, word, size in self.same_runs(h, doc, known):
            word -= int(split[d])
            if len(self.items.words[i]) < RUN:
                short.setdefault((d, i), word)
            else:
                near.setdefault((d, i), []).append((word, word + size, 1.0))
        for (d, i), word in short.items():
            # a run of all its words: nothing is left to confirm
            out.append((d, self.items.ids[i], 1.0, 1.0, 1.0, word, word + len(self.items.words[i])))
        for (d, i), windows in sorted(near.items()):
            if len(self.items.words[i]) < RUN:
                continue
            text = h[split[d] : split[d + 1]]
            best = None
            size = len(self.items.words[i])
            # windows of one stretch are confirmed together, with the item's length around them
            windows.sort()
            stretch: list[list] = []
            for a, b, c in windows:
                if stretch and a <= stretch[-1][1]:
                    stretch[-1][1], stretch[-1][2] = max(b, stretch[-1][1]), max(c, stretch[-1][2])
                else:
                    stretch.append([a, b, c])
            for a, b, c in stretch:
                a, b = max(0, a - size), min(len(text), b + size)
                # a common subsequence has no more words than the two have in common
                if len(self.sets[i].intersection(text[a:b].tolist())) < self.least[i]:
                    continue
                for low in range(a, max(a + 1, b - 2 * size), max(1, size)):
                    seq = text[low : min(b, low + 3 * size)].tolist()
                    share, end = self.confirm(i, seq)
                    if share >= self.overlap and end >= self.answer and (best is None or share > best[1]):
                        best = (c, share, end, low, low + len(seq))
            if best:
                out.append((d, self.items.ids[i], *best))
        return out


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark in blocks of bounded size, read one after the other."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").orderBy("item_id", "text").toLocalIterator()
    block: list = []
    words: set[int] = set()
    for row in rows:
        block.append(row)
        words.update(words_of(pa.array([row["text"]], pa.string()))[0].tolist())
        if len(block) == ITEMS or len(words) >= VOCABULARY:
            yield Items([r["item_id"] for r in block], [r["text"] for r in block])
            block, words = [], set()
    if block:
        yield Items([r["item_id"] for r in block], [r["text"] for r in block])


def _searchers(docs: DataFrame, benchmark: DataFrame, rank: int, threshold: float, overlap: float, answer: float) -> Iterator:
    """A broadcast searcher for each block of benchmark items."""
    spark = docs.sparkSession
    # the words of all blocks (8 bytes each) are counted in one pass over the corpus
    vocabulary = np.zeros(0, np.uint64)
    for items in _blocks(benchmark):
        vocabulary = np.union1d(vocabulary, items.vocabulary)
    if not len(vocabulary):
        return
    df, total = _document_frequency(docs, vocabulary)
    for items in _blocks(benchmark):
        if len(items.vocabulary):
            items.weigh(df[np.searchsorted(vocabulary, items.vocabulary)], total)
            yield spark.sparkContext.broadcast(Searcher(items, randomised_basis(spark, items, rank), threshold, overlap, answer))


def contamination(docs: DataFrame, benchmark: DataFrame, rank: int = 192, threshold: float = 0.5, overlap: float = 0.6, answer: float = 0.5) -> DataFrame:
    """(document, benchmark item) pairs of which the document holds the item or a paraphrase."""
    docs = small_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))

    def pairs(searcher) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for some in slices(b, "text", 1_000_000):
                    found = searcher.value.search(some.column(1))
                    if found:
                        of, *rest = zip(*found)
                        kinds = [pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
                        yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(of)), *(pa.array(r, k) for r, k in zip(rest, kinds))], ["doc_id", "item_id", "similarity", "overlap", "answer", "start_word", "end_word"])

        return docs.mapInArrow(tidied(run), SCHEMA)

    parts = [pairs(s) for s in _searchers(docs, benchmark, rank, threshold, overlap, answer)]
    return reduce(DataFrame.unionByName, parts) if parts else docs.sparkSession.createDataFrame([], SCHEMA)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rank: int = 192, threshold: float = 0.5, overlap: float = 0.6, answer: float = 0.5) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item or a paraphrase.

    Map-only after the counts; of several blocks of items each takes what the one before left, from
    a written table, so that no task needs more than one worker and one block.
    """
    at = docs.columns.index("text")
    out, before = small_batches(docs), None

    for searcher in _searchers(docs, benchmark, rank, threshold, overlap, answer):

        def run(batches: Iterator[pa.RecordBatch], searcher=searcher) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for some in slices(b, "text", 1_000_000):
                    clean = np.ones(some.num_rows, bool)
                    clean[[d for d, *_ in searcher.value.search(some.column(at))]] = False
                    yield some.filter(pa.array(clean))

        if before is not None:
            out = materialise(docs.sparkSession, out)
        out = before = out.mapInArrow(tidied(run), docs.schema)
    return out


def op7_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
