import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from quarrystone.llm import graph, near_dup


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def brute(rows, percent=85):
    """Smallest reachable id of each id, by all pairs that share a shingle."""
    sets = [(i, shingles(t)) for i, t in rows]
    index, root = defaultdict(list), {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, s) in enumerate(sets):
        if i is None:
            continue
        for j, n in Counter(j for x in s for j in index[x]).items():
            if 100 * n >= percent * len(s | sets[j][1]):
                a, b = find(i), find(sets[j][0])
                root[max(a, b)] = min(a, b)
        for x in s:
            index[x].append(k)
    return {i: find(i) for i in root}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return " ".join(out)


def test_against_all_pairs(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(12):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([6, 30, 120, 300]))]
        rows += [" ".join(base)] * rng.choice([1, 2, 5]) + [edited(rng, base, rng.randrange(0, 8)) for _ in range(12)]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 85).collect()
    want = brute(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(shingles(dict(rows)[r.doc_id])) for r in got)


def test_a_large_family_is_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "CHUNK_WEIGHT", 5000)
    monkeypatch.setattr(near_dup, "BROADCAST_ROWS", 10)
    rng = random.Random(8)
    base = [f"w{k}" for k in range(100)]
    rows = [(k, edited(rng, base, rng.randrange(0, 6))) for k in range(150)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 85).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows)


def test_repeated_ids_with_other_texts(spark):
    rng = random.Random(21)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    one, two = fresh(60), fresh(60)
    near = lambda w, k: " ".join([*w, f"x{k}", f"y{k}"])
    rows = [(1, " ".join(one)), (1, " ".join(two)), (2, near(one, 2)), (3, near(two, 3))]
    rows += [(10, " ".join(a := fresh(60))), (11, " ".join(b := fresh(60))), (15, near(b, 1)), (15, near(a, 2)), (16, near(b, 3)), (16, "")]
    families = [fresh(40) for _ in range(8)]
    rows += [(rng.randrange(20, 60), edited(rng, rng.choice(families), rng.randrange(3))) for _ in range(60)]
    rng.shuffle(rows)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), 85).collect()
    want = brute(rows)
    assert len(got) == len(rows) and {(r.doc_id, r.component_id) for r in got} == set(want.items())
    assert want[3] == 1 and want[16] == 10


def test_edge_rows(edge, none):
    got = near_dup.near_duplicates(edge).collect()
    assert len(got) == edge.count()
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add((r.n_shingles, r.component_id, r.kept))
    assert by[5] == {(0, 5, True)} and by[1] == {(0, 1, True)} and by[2] == {(0, 2, True)} and by[3] == {(1, 3, True)}
    assert by[8] == {(5, 8, True)} and by[9] == {(5, 8, False)}
    assert {(c, k) for _, c, k in by[None]} == {(None, True)}
    assert near_dup.near_duplicates(none).count() == 0


def test_on_a_table_of_the_driver(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = near_dup.op8_near_duplicates(spark, small).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:360], rng.integers(0, 1 << 63, 40, dtype=np.uint64)]))
    s = np.concatenate([a, b, a])
    sig = near_dup.super_minhash(s, np.array([0, len(a), len(a) + len(b), len(s)]))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((sig[0] == sig[1]).mean() - true) < 0.12 and (sig[0] == sig[2]).all()
    few = near_dup.super_minhash(np.arange(1, 6, dtype=np.uint64), np.array([0, 5]))
    assert (few < (np.uint64(near_dup.SLOTS) << np.uint64(48))).all()  # every slot is filled


def test_words_hash_by_content():
    from quarrystone.llm.common import NOT_SPACE, hash_words, text_bytes, word_spans

    data, off = text_bytes(pa.array(["ab cd", None, "cd", "abcd ab"]))
    w0, w1, doc = word_spans(data, off, NOT_SPACE)
    h = hash_words(data, w0, w1)
    assert doc.tolist() == [0, 0, 2, 3, 3] and h[1] == h[2] and h[0] == h[4] and len(set(h.tolist())) == 3


def test_components_of_a_chain(spark):
    pairs = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (7, 7)], "a bigint, b bigint").repartition(7)
    got = {r.node: r.root for r in graph.connected_components(spark, pairs).collect()}
    assert got == {k: 0 for k in range(1, 61)} | {101: 100}
