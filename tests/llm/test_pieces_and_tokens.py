import hashlib
import random
import zlib

import numpy as np
import pytest

from quarrystone.llm import piece_bpe, token_store

sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_bpe.default_model())


def test_random_texts_encode_as_the_library_does(library):
    rng = random.Random(4)
    signs = "ab ▁\n\té日龘́<s>0x41\U0001f600\x00 w.eethn"
    c = piece_bpe.codec(piece_bpe.default_model())
    for _ in range(4000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 16)))
        ids = library.encode(text)
        assert c.encode(text) == ids
        assert c.decode(ids) == library.decode(ids)


def test_pieces_of_edge_rows(edge, none, library):
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in piece_bpe.encode_texts(edge, piece_bpe.default_model()).collect()}
    want = set()
    for r in edge.collect():
        ids = library.encode(r.text or "")
        want.add((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert got == want
    assert piece_bpe.encode_texts(none, piece_bpe.default_model()).count() == 0


def test_query_on_whole_table(spark, small, library):
    got = {r.doc_id: r for r in piece_bpe.op9_sentencepiece(spark, small).collect()}
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        ids = library.encode(r.text)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 3000])
@pytest.mark.parametrize("kind", ["ids", "bits", "zeros", "wide", "escapes"])
def test_words_come_back(n, kind):
    rng = np.random.default_rng(n)
    ids = {
        "ids": rng.integers(0, 50257, n),
        "bits": rng.integers(0, 2, n),
        "zeros": np.zeros(n, np.int64),
        "wide": rng.integers(0, 1 << 62, n),
        "escapes": np.where(rng.random(n) < 0.02, (1 << 63) - 1, rng.integers(0, 40, n)),
    }[kind].astype(np.uint64)
    names, counts, back = token_store.read_segment(token_store.write_segment([1, None], [n, 0], ids))
    assert names == [1, None] and counts.tolist() == [n, 0] and (back == ids).all()


def test_small_ids_pack_tightly():
    assert len(token_store.pack(np.ones(6000, np.uint64))[0]) <= 47 * 3
    with pytest.raises(ValueError):
        token_store.read_segment(b"nothing of the kind")


def test_encoder_equals_the_library_on_whole_texts():
    library = tokenizers.Tokenizer.from_file(token_store.default_tokenizer())
    rng = random.Random(5)
    parts = ["a", "b ", "  ", "\n", "\t", " ", " \n", "é", "'s", ".", ",", "12", "<|endoftext|>", "日", "\x1c", "　", " x", "!"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(4000)]
    enc = token_store.Encoder(token_store.default_tokenizer(), 2)
    enc.LIMIT = 500
    for at in range(0, len(texts), 100):
        for text, raw in zip(texts[at : at + 100], enc.encode(texts[at : at + 100])):
            assert np.frombuffer(raw, "<u4").tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]


def test_files_of_edge_rows(spark, edge, none, tmp_path):
    library = tokenizers.Tokenizer.from_file(token_store.default_tokenizer())
    token_store.write_tokens(edge, str(tmp_path / "t"), token_store.default_tokenizer())
    got = token_store.read_tokens(spark, str(tmp_path / "t"), with_ids=True).collect()
    want = {(r.doc_id, tuple([*library.encode(r.text or "", add_special_tokens=False).ids, 2])) for r in edge.collect()}
    assert {(r.doc_id, tuple(r.ids)) for r in got} == want
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda d: (d is not None, d))
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    token_store.write_tokens(none, str(tmp_path / "e"), token_store.default_tokenizer())
    assert token_store.read_tokens(spark, str(tmp_path / "e")).count() == 0
