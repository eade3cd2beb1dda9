"""Quality classifier: random-indexing word vectors, pooled per document, and a
two-layer network with temperature-calibrated probabilities.

A text is read as words and runs of signs.  Every word (by hashed bucket), word shape
(case, digits, length) and run of signs has a sparse ternary index vector; its word
vector is the sum of the index vectors seen within two places of it in all documents.
Each task sums its own, so what is shuffled is a bounded table a task, and the sums are
whole numbers, the same in any order.  A document is the mean vector of its words, of
their shapes and of its signs, with its length and the shares of signs and of words that
follow themselves; the network scores that.

Training takes at most ``max_sample`` labelled documents, those with the smallest
hashes of their ids, so the same rows at every size and order of the input.  They are
pooled in the tasks; only these features reach the driver.  A fifth
of them fits the temperature alone.  Labels, language, source and id are no inputs.

Cases: null text = empty text (zero vectors, still scored); labels that are neither 0
nor 1 are ignored, of several for a document the smallest counts; of rows that repeat a
labelled id the first by a digest of their texts is learnt from; without any labelled row
every score is 0.5; very long texts are pooled whole, one at a time; further columns are
ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm.common import NOT_SPACE, hash_words, lower_ascii, slices, small_batches, table, text_bytes, tidied, word_spans

DIM, BUCKETS, SHAPES, SIGNS = 48, 1 << 15, 32, 256
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[48:58] = WORD_BYTES[65:91] = WORD_BYTES[97:123] = WORD_BYTES[128:] = True
SIGN_BYTES = NOT_SPACE & ~WORD_BYTES
#: Text bytes that one step of training reads.
FIT_BYTES = 200_000
#: The score from which a document counts as good.
THRESHOLD = 0.3


def _index_vectors(seed: int = 7, ones: int = 6) -> np.ndarray:
    rng = np.random.default_rng(seed)
    n = BUCKETS + SHAPES + SIGNS
    out = np.zeros((n, DIM), np.float32)
    place = np.argsort(rng.random((n, DIM)), axis=1)[:, :ones]
    np.put_along_axis(out, place, rng.choice(np.array([-1, 1], np.float32), (n, ones)), axis=1)
    return out


def tokens(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """Word buckets, their shapes and sign runs of some texts, each with text number and place."""
    w0, w1, wd = word_spans(data, off, WORD_BYTES)
    s0, s1, sd = word_spans(data, off, SIGN_BYTES)
    upper = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    digit = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57))])
    n, ups, digits = w1 - w0, upper[w1] - upper[w0], digit[w1] - digit[w0]
    first_up = (data[w0] >= 65) & (data[w0] <= 90) if len(w0) else np.zeros(0, bool)
    case = np.where(digits == n, 3, np.where(digits > 0, 4, np.where(ups == 0, 0, np.where((ups == 1) & first_up, 1, 2))))
    length = np.minimum(np.log2(np.maximum(n, 1)).astype(np.int64), 5)
    low = lower_ascii(data)
    return {
        "word": (hash_words(low, w0, w1) % np.uint64(BUCKETS)).astype(np.int64),
        "shape": BUCKETS + case * 6 + length,
        "word_doc": wd,
        "word_at": w0,
        "sign": BUCKETS + SHAPES + (hash_words(low, s0, s1) % np.uint64(SIGNS)).astype(np.int64),
        "sign_doc": sd,
        "sign_at": s0,
    }


def _add_rows(out: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
    if not len(ids):
        return
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    begin = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    out[ids[begin]] += np.add.reduceat(rows[order], begin, axis=0, dtype=np.int64)


def add_contexts(out: np.ndarray, t: dict[str, np.ndarray], index: np.ndarray) -> None:
    """Adds to each token's row the index vectors that stand within two places of it."""
    order = np.argsort(np.concatenate([t["word_at"], t["sign_at"]]))
    doc = np.concatenate([t["word_doc"], t["sign_doc"]])[order]
    main = np.concatenate([t["word"], t["sign"]])[order]
    shape = np.concatenate([t["shape"], np.full(len(t["sign"]), -1)])[order]
    own = index[main] + np.where(shape[:, None] >= 0, index[shape], index[main])
    near = own.copy()
    for d in (1, 2):
        same = (doc[d:] == doc[:-d])[:, None]
        near[d:] += own[:-d] * same
        near[:-d] += own[d:] * same
    _add_rows(out, main, near)
    _add_rows(out, shape[shape >= 0], near[shape >= 0])


def _unit(sums: np.ndarray) -> np.ndarray:
    sums = sums.astype(np.float64)
    return (sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-6)).astype(np.float32)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Word vectors from the contexts of all texts.  What reaches the driver has a row for each bucket, shape and sign."""
    columns = [f"v{k}" for k in range(DIM)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index_vectors().astype(np.int16)
        out = np.zeros(index.shape, np.int64)
        for b in batches:
            for some in slices(b, "text", FIT_BYTES):
                add_contexts(out, tokens(*text_bytes(some.column(0))), index)
        seen = np.flatnonzero(out.any(axis=1))
        for at in range(0, len(seen), 4096):
            ids = seen[at : at + 4096]
            yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), *(pa.array(np.ascontiguousarray(out[ids, k])) for k in range(DIM))], ["token", *columns])

    parts = small_batches(docs.select("text")).mapInArrow(tidied(run), "token int, " + ", ".join(f"{c} bigint" for c in columns))
    sums = parts.groupBy("token").agg(*(F.sum(c).alias(c) for c in columns)).toArrow()
    out = np.zeros((BUCKETS + SHAPES + SIGNS, DIM), np.int64)
    out[sums["token"].to_numpy()] = np.stack([sums[c].to_numpy() for c in columns], axis=1)
    return _unit(out)


def pooled(t: dict[str, np.ndarray], docs: int, vectors: np.ndarray) -> np.ndarray:
    """Mean vectors of words, shapes and signs of each text, and three shares and lengths."""
    out = np.zeros((docs, 3 * DIM + 3), np.float32)
    words = np.bincount(t["word_doc"], minlength=docs)
    signs = np.bincount(t["sign_doc"], minlength=docs)
    some = np.flatnonzero(words)
    if len(some):
        begin = (np.cumsum(words) - words)[some]
        out[some, :DIM] = np.add.reduceat(vectors[t["word"]], begin, axis=0) / words[some, None]
    for k, (ids, doc, low, n, count) in enumerate(((t["shape"], t["word_doc"], BUCKETS, SHAPES, words), (t["sign"], t["sign_doc"], BUCKETS + SHAPES, SIGNS, signs))):
        table_ = np.bincount(doc * n + (ids - low), minlength=docs * n).reshape(docs, n).astype(np.float32)
        out[:, (k + 1) * DIM : (k + 2) * DIM] = table_ @ vectors[low : low + n] / np.maximum(count, 1)[:, None]
    same = (t["word"][1:] == t["word"][:-1]) & (t["word_doc"][1:] == t["word_doc"][:-1])
    out[:, -3] = np.bincount(t["word_doc"][1:][same], minlength=docs) / np.maximum(words, 1)
    out[:, -2] = np.log1p(words) / 8
    out[:, -1] = signs / np.maximum(words + signs, 1)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _network(x: np.ndarray, y: np.ndarray, hidden: int, epochs: int, seed: int = 11) -> dict[str, np.ndarray]:
    """Adam on the logistic loss of a network with one hidden layer."""
    rng = np.random.default_rng(seed)
    p = {"w1": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), "b1": np.zeros(hidden), "w2": rng.normal(0, 1 / np.sqrt(hidden), hidden), "b2": np.zeros(1)}
    m, v, step = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
            h = np.maximum(x[rows] @ p["w1"] + p["b1"], 0)
            err = (_sigmoid(h @ p["w2"] + p["b2"]) - y[rows]) / len(rows)
            back = np.outer(err, p["w2"]) * (h > 0)
            grad = {"w1": x[rows].T @ back + 1e-4 * p["w1"], "b1": back.sum(0), "w2": h.T @ err + 1e-4 * p["w2"], "b2": np.array([err.sum()])}
            step += 1
            for k, g in grad.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - 0.003 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return p


def _logit(x: np.ndarray, p: dict) -> np.ndarray:
    return np.maximum(((x - p["mean"]) / p["spread"]) @ p["w1"] + p["b1"], 0) @ p["w2"] + p["b2"]


def _temperature(logit: np.ndarray, y: np.ndarray) -> float:
    grid = np.exp(np.linspace(np.log(0.5), np.log(8), 60))
    loss = [-np.mean(y * np.log(q := np.clip(_sigmoid(logit / t), 1e-9, 1 - 1e-9)) + (1 - y) * np.log(1 - q)) for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit_features(x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 30) -> dict:
    """Network and temperature from pooled vectors; every fifth row fits the temperature alone."""
    mean, spread = x.mean(0), x.std(0) + 0.05 * x.std() + 1e-6
    hold = np.arange(len(x)) % 5 == 4
    p = _network((x[~hold] - mean) / spread, y[~hold], hidden, epochs) | {"mean": mean, "spread": spread}
    p["temperature"] = _temperature(_logit(x[hold], p), y[hold]) if hold.any() else 1.0
    return p


def fit(texts: list[str | None], y: list[int], hidden: int = 24, epochs: int = 30) -> dict | None:
    """A model of a few texts at hand, word vectors included."""
    if not texts:
        return None
    index = _index_vectors().astype(np.int16)
    sums = np.zeros(index.shape, np.int64)
    t = tokens(*text_bytes(pa.array(texts, pa.string())))
    add_contexts(sums, t, index)
    vectors = _unit(sums)
    return fit_features(pooled(t, len(texts), vectors).astype(np.float64), np.array(y, np.float64), hidden, epochs) | {"vectors": vectors}


def score_texts(col: pa.Array, model: dict | None) -> np.ndarray:
    if model is None:
        return np.full(len(col), 0.5)
    x = pooled(tokens(*text_bytes(col)), len(col), model["vectors"]).astype(np.float64)
    return _sigmoid(_logit(x, model) / model["temperature"])


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def fit_on(docs: DataFrame, labels: DataFrame, max_sample: int = 6000) -> dict | None:
    """Fits on at most ``max_sample`` labelled documents that are not held out."""
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_sample)
    )
    if not chosen.limit(1).count():
        return None
    vectors = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in slices(b, "text", FIT_BYTES):
                x = pooled(tokens(*text_bytes(some.column(3))), some.num_rows, shared.value)
                yield pa.RecordBatch.from_arrays([*some.columns[:3], pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "quality", "copy", "x"])

    # the limit bounds what is broadcast, and, as a row for each id is kept, what is collected
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.col("doc_id").cast("long").alias("doc_id"), "quality", F.xxhash64("text").alias("copy"), "text")
    found = small_batches(rows).mapInArrow(tidied(run), "doc_id bigint, quality int, copy bigint, x binary")
    kept = found.groupBy("doc_id").agg(F.min_by(F.struct("quality", "x"), "copy").alias("r")).select("doc_id", "r.quality", "r.x").toArrow()
    order = np.argsort(kept["doc_id"].to_numpy())
    if not len(order):
        return None
    x = np.stack([np.frombuffer(v.as_py(), np.float32) for v in kept["x"]])[order].astype(np.float64)
    y = kept["quality"].to_numpy()[order].astype(np.float64)
    # rows in an order that says nothing of their labels, the same at every run
    mixed = np.random.default_rng(3).permutation(len(x))
    return fit_features(x[mixed], y[mixed]) | {"vectors": vectors}


def score(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``score`` and ``predicted`` of each row beside its id and ``keep``.  Map-only: no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = [id_col, text_col, *(c for c in keep if c not in (id_col, text_col))]
    out = [id_col, *(c for c in keep if c != id_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in slices(b, text_col):
                s = score_texts(some.column(1), shared.value)
                kept = [some.column(some.schema.get_field_index(c)) for c in out]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], [*out, "score", "predicted"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in out) + ", score double, predicted int"
    return small_batches(docs.select(*columns)).mapInArrow(tidied(run), schema)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_on(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
