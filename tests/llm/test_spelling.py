import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from quarrystone.llm import spelling

COLUMNS = ["form", "n", "root", "n_near", "form_n"]


def brute(rows, least=7, min_n=2, ratio=10):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= least and c >= min_n}
    near, gaps = defaultdict(set), defaultdict(set)
    for w in n:
        for k in range(len(w)):
            gaps[w[:k], w[k + 1 :]].add(w)
            if (short := w[:k] + w[k + 1 :]) in n:
                near[w].add(short)
                near[short].add(w)
    for group in gaps.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= ratio * n[w]:
                form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), n[w], root, len(near[w]), n[form[w]] if w in form else None)
    return out


def result(df):
    rows = df.collect()
    out = {r["word"]: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    got = spelling.op13_spelling(spark, small)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert result(got) == want and any(v[0] for v in want.values())


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_dense_words_equal_brute_force(spark, seed):
    """Few letters, so that words have many near ones, runs of one letter, and prefixes of each other."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(7, 10))) for _ in range(400)] + ["a" * k for k in range(7, 30)]
    rows = [(k, " ".join(rng.choices(words, [1 / (j + 1) for j in range(len(words))], k=300))) for k in range(40)]
    assert result(spelling.spelling_groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))) == brute(rows)


def test_forms_are_followed_to_the_last(spark):
    words = ["seconds"] * 2 + ["secondes"] * 25 + ["secondest"] * 260
    got = spelling.spelling_groups(spark.createDataFrame([(1, " ".join(words))], "doc_id bigint, text string"))
    # no id that drops a character of one of these runs
    assert result(got) == brute([(1, " ".join(words))])
    assert result(got)["seconds"][2] == "secondest"


def test_all_nodes_by_shuffle(spark, monkeypatch):
    rows = [(k, "wordings wordinge gordings wordinngs wordinds ") for k in range(9)]
    monkeypatch.setattr(spelling, "BROADCAST_ROWS", -1)
    assert result(spelling.spelling_groups(spark.createDataFrame(rows, "doc_id bigint, text string"))) == brute(rows)


def test_edges(spark, edge, none):
    rows = [(r["doc_id"], r["text"]) for r in edge.select("doc_id", "text").collect()]
    assert result(spelling.spelling_groups(edge)) == brute(rows)
    assert result(spelling.spelling_groups(none)) == {}
    odd = edge.selectExpr("doc_id", "text", "1 as word", "2 as n", "3 as node", "4 as NODE_1", "5 as errata", "6 as heavy")
    assert result(spelling.spelling_groups(odd)) == brute(rows)


def test_very_long_runs(spark):
    """Prefixes of a run of 200,000 characters are hashed, not spelled out."""
    long = "abcdefghij" * 20_000
    rows = [(1, f"{long} {long} {long[:-1]}x {long[:-1]}x {long}y {long}y")]
    got = result(spelling.spelling_groups(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert len(got) == 3 and all(v[1] == 2 for v in got.values())
    assert sorted(v[3] for v in got.values()) == [1, 1, 2]
