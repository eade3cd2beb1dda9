import hashlib

import pytest

from quarrystone.llm import piece_bpe, registry


@pytest.fixture(scope="module")
def pipeline():
    return pytest.importorskip("corpus_pipeline")


def test_stages_and_columns(spark, small, pipeline):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for _, stage in pipeline.STAGES[:-1]:
        docs = pipeline.materialise(spark, stage(spark, docs, small))
        assert docs.columns == columns
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0.6 * seen[0]
    last = pipeline.STAGES[-1][1](spark, docs, small).collect()
    whole = pipeline.run(spark, small).collect()
    assert {tuple(r) for r in last} == {tuple(r) for r in whole}
    codec = piece_bpe.codec(piece_bpe.default_model())
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in last:
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, codec.encode(texts[r.doc_id]))).encode()).hexdigest()


def test_stages_take_edge_rows(spark, edge, none, small, pipeline):
    for docs in (edge, none):
        for _, stage in pipeline.STAGES:
            stage(spark, docs, small).collect()
    one = pipeline.keep_one_of_near(spark, edge, small)
    kept = [r.doc_id for r in one.collect()]
    assert kept.count(8) == 1 and 9 not in kept and kept.count(None) == 1 and kept.count(10) == 2


def test_rows_with_one_id_are_judged_each_by_its_text(spark, small, pipeline):
    words = [f"w{k}" for k in range(80)]
    a, near, other = " ".join(words), " ".join([*words, "more"]), " ".join(w + "u" for w in words)
    rows = [(1, a), (7, near), (7, other), (9, other), (9, other), (None, a), (None, a), (5, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = [(r.doc_id, r.text) for r in pipeline.keep_one_of_near(spark, docs, small).collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (7, other), (None, a), (None, a), (5, None), (5, "")], key=str)


def test_near_copies_between_80_and_85_percent_go(spark, small, pipeline):
    words = [f"w{k}" for k in range(104)]
    edited = ["other" if k in (30, 60) else w for k, w in enumerate(words)]  # 90 of 110 shingles: 0.82
    far = ["other" if k in (20, 40, 60) else w for k, w in enumerate(words)]  # 85 of 115: 0.74
    rows = [(k, " ".join(w), "en", "s", 0) for k, w in enumerate([words, edited])] + [(7, " ".join(x + "f" for x in words), "en", "s", 0), (8, " ".join(x + "f" for x in far), "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert sorted(r.doc_id for r in pipeline.keep_one_of_near(spark, docs, small).collect()) == [0, 7, 8]


def test_registry_names():
    names = list(registry.queries())
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
