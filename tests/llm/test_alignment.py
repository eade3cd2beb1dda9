import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from quarrystone.llm import alignment

NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def brute(rows):
    """By the libraries' own whole-text encodings and all token pairs of a text."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = alignment.byte_letters()
    piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    docs, counts = [], Counter()
    for i, text in rows:
        ids, ends = [[], []], [[], []]
        if text:
            want = (" " + text).encode()
            ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)]
            parts = [[bytes(letters[c] for c in a.id_to_token(t)) for t in ids[0]], [piece(t) for t in ids[1]]]
            if any(b"".join(p) != want for p in parts):
                ids = [[], []]
            else:
                ends = [[sum(map(len, p[: k + 1])) for k in range(len(p))] if len(p) < 3000 else _sums(p) for p in parts]
        links, groups, x, y, p, q = [], [], 0, 0, 0, 0
        while x < len(ids[0]):
            links.append((ids[0][x], ids[1][y]))
            ex, ey = ends[0][x], ends[1][y]
            x, y = x + (ex <= ey), y + (ey <= ex)
            if ex == ey:
                groups.append(",".join(map(str, ids[0][p:x])) + "|" + ",".join(map(str, ids[1][q:y])))
                p, q = x, y
        counts.update(set(links))
        docs.append((i, len(ids[0]), len(ids[1]), groups, links))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    return sorted(
        (str(i), na, nb, len(groups), len(links), sum(counts[k] == best[k[0]] for k in links), sum(counts[k] for k in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for i, na, nb, groups, links in docs
    )


def _sums(parts):
    out, at = [], 0
    for p in parts:
        at += len(p)
        out.append(at)
    return out


def result(df):
    assert df.columns == ["doc_id", *NUMBERS, "groups_sha256"]
    return sorted((str(r["doc_id"]), *(r[c] for c in NUMBERS), r["groups_sha256"]) for r in df.collect())


def run(docs):
    return alignment.align_tokenizers(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


ODD = [
    "<|endoftext|></s> <s> <unk>", "  two  spaces   and\ttabs \n\n lines \r\n", "a▁b", "▁", " ", "\n", "x" * 5000, "naïve façade 日本語 テキスト 😀😀 ñ", "\x00\x01 zero", "don't we'll I'VE 'tis",
    "1234567 89 3.14159", "é combining ​﻿ joiner", "the the the theatre", "   lead", "trail   ", "antidisestablishmentarianism's", " nbsp　wide space",
]


def test_query_equals_brute_force(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert result(alignment.op12_alignment(spark, small)) == brute(rows)


def test_odd_texts(spark):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(3, "the theatre"), (None, "the  theatre")]
    assert result(run(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))) == brute(rows)


def test_edges(spark, edge, none):
    rows = [(r["doc_id"], r["text"]) for r in edge.select("doc_id", "text").collect()]
    odd = edge.selectExpr("doc_id", "text", "1 as row", "2 as KEY", "3 as n_a", "4 as kind")
    assert result(run(odd)) == brute(rows)
    assert result(run(none)) == []


@pytest.mark.parametrize("bound", [0, 40])
def test_groups_beyond_the_bound(spark, monkeypatch, bound):
    """Hot groups by a broadcast, the others by a shuffle; small caches that start again."""
    monkeypatch.setattr(alignment, "BROADCAST_ROWS", bound)
    rows = [(k, " ".join(f"the w{k * j % 17} theatre{j % 5} antidisestablishment" for j in range(k % 7))) for k in range(60)]
    assert result(run(spark.createDataFrame(rows, "doc_id bigint, text string"))) == brute(rows)


def test_clashing_keys_are_made_again(spark, monkeypatch):
    """Longer groups that share a key under one seed are told apart under the next."""
    seen = []
    plain = alignment.group_dictionary

    def clash(grouped):
        seen.append(1)
        out = plain(grouped)
        return out.withColumn("clash", alignment.F.lit(True)) if len(seen) == 1 else out

    monkeypatch.setattr(alignment, "group_dictionary", clash)
    rows = [(1, "antidisestablishmentarianism café"), (2, "café théâtre")]
    assert result(run(spark.createDataFrame(rows, "doc_id bigint, text string"))) == brute(rows) and len(seen) == 2


def test_a_table_that_starts_again(spark, monkeypatch):
    monkeypatch.setattr(alignment, "GROUPS", 3)
    monkeypatch.setattr(alignment, "STEP_BYTES", 40)
    rows = [(k, f"the w{k % 17} theatre{k % 5} antidisestablishment a▁b"[: 10 + k]) for k in range(60)]
    assert result(run(spark.createDataFrame(rows, "doc_id bigint, text string"))) == brute(rows)


def test_groups_of_equal_keys_in_a_worker_are_told(spark):
    from quarrystone.llm import piece_bpe, token_store

    al = alignment.Aligner(token_store.default_tokenizer(), piece_bpe.default_model(), 0)
    al.learn([b" antidisestablishment", b" caf\xc3\xa9"])
    assert not al.clash and len(al.keys) == len(set(al.names))
    long = next(k for k, key in enumerate(al.keys) if key < 0)
    al.checks[long] += 1
    al.learn([b" antidisestablishment", b" caf\xc3\xa9"])
    assert al.clash == {al.keys[long]}
