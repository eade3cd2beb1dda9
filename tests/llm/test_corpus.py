import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from quarrystone.llm import decontaminate, fingerprint, passage_dedup, quality


# ---- quality
def test_held_out_accuracy(spark):
    rng = random.Random(0)
    words = [f"{a}{b}" for a in ("lo", "mi", "ta", "ren", "sol") for b in ("ra", "ne", "ti", "do")]
    rows, labels = [], []
    for k in range(900):
        good = k % 5 != 0
        n = rng.randint(20, 80)
        text = " ".join(rng.choice(words) + (rng.choice(["", "", ","]) if good else rng.choice(["###", "!!", "$$$"])) for _ in range(n))
        rows.append((k, text if good or k % 2 else text.upper()))
        labels.append((k, int(good), 0))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = quality.fit_on(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    got = quality.score(docs, model).withColumn("held_out", quality.held_out()).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == labels[r.doc_id][1] for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_quality_learns_nothing_from_held_out_rows(spark):
    rows = [(k, f"word{k} " * 5) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    held = [k for k in range(60) if zlib.crc32(str(k).encode()) % 5 == 0]
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id bigint, quality int")
    other = spark.createDataFrame([(k, 1 - k % 2 if k in held else k % 2) for k in range(60)], "doc_id bigint, quality int")
    scores = lambda y: {r.doc_id: r.score for r in quality.score(docs, quality.fit_on(docs, y)).collect()}
    assert held and scores(labels) == scores(other)
    assert quality.fit_on(docs, labels.where(quality.held_out())) is None


def test_word_vectors_are_sums_over_all_texts(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["alpha", "Beta", "g4mma", "--", "delta!"]) for _ in range(rng.randint(0, 30))) for _ in range(60)] + [None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    index = quality._index_vectors()
    sums = np.zeros(index.shape)
    for text in texts:
        t = quality.tokens(*(a for a in quality.text_bytes(pa.array([text], pa.string()))))
        at = sorted([(p, w, s) for p, w, s in zip(t["word_at"], t["word"], t["shape"])] + [(p, w, w) for p, w in zip(t["sign_at"], t["sign"])])
        for k, (_, word, shape) in enumerate(at):
            for _, w, s in at[max(0, k - 2) : k + 3]:
                for own in {word, shape}:
                    sums[own] += index[w] + index[s]
    want = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-6)
    assert np.allclose(quality.word_vectors(docs), want, atol=1e-5)


def test_quality_takes_one_row_of_an_id_and_only_labels_0_and_1(spark):
    rows = [(k, f"text {k} of words, fine." if k % 2 else f"BAD ### {k}") for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(80)], "doc_id bigint, quality int")
    more = labels.union(spark.createDataFrame([(k, 7) for k in range(80, 90)], "doc_id bigint, quality int"))
    scores = lambda d, y: {r.doc_id: r.score for r in quality.score(docs, quality.fit_on(d, y)).collect()}
    plain = scores(docs, labels)
    assert plain == scores(docs, more)
    model = quality.fit_on(docs.union(docs.where("doc_id < 5")).union(docs.where("doc_id < 5")), labels, max_sample=20)
    assert model is not None and quality.fit_on(docs, more.where("quality = 7")) is None


def test_quality_of_edge_rows(spark, edge, none):
    model = quality.fit(["a good text, you see"] * 20 + ["BAD!! ###"] * 20, [1] * 20 + [0] * 20)
    got = quality.score(edge, model).collect()
    assert len(got) == edge.count() and all(0 <= r.score <= 1 for r in got)
    empty = {round(r.score, 12) for r in got if r.doc_id in (5, 1, 2)}
    assert len(empty) == 1
    assert quality.score(none, model).count() == 0
    assert quality.score_texts(pa.array(["x", None]), None).tolist() == [0.5, 0.5]
    labels = spark.createDataFrame([(3, None), (None, 1), (4, 1), (4, 0)], "doc_id bigint, quality int")
    quality.fit_on(edge, labels)


# ---- fingerprints
def xx64(*parts):
    """Spark's xxhash64 of strings, as a signed number."""
    h = 42
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), seed=h)
    return h - (1 << 64) if h >> 63 else h


def marked(word):
    if len(word) > fingerprint.LONG_WORD:
        near = lambda i: [word[i - k] if i >= k else "" for k in range(fingerprint.CHAR_RUN)]
        return "".join(c + "\x01" * (xx64(*near(i)) % fingerprint.CHAR_CUT == 0) for i, c in enumerate(word))
    left, size = xx64(word) % fingerprint.CUT_EVERY, len(word) + 1
    return word + ("\x01" if left < size else "\x02" if left < fingerprint.MORE_OFTEN * size else "")


def units(t):
    pieces = re.split("[\x01\n]", " ".join(marked(w) for w in t.split(" ")))
    return {x for p in pieces if p for x in (p.split("\x02") if len(p) > fingerprint.LONG_UNIT else [p])}


def likeness(a, b):
    size = lambda s: sum(min(len(x), fingerprint.LONGEST) for x in s)
    return 1 - size(a ^ b) / (size(a) + size(b)) if a or b else 1.0


def check_fingerprints(rows, got):
    ordered = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    assert len({r[0] for r in ordered}) == len(ordered)
    by = {r.doc_id: r for r in got}
    for k, (i, text) in enumerate(ordered):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = by[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r.near_edited - likeness(units(text), units(edited))) < 1e-9
        assert abs(r.near_next - likeness(units(text), units(following))) < 1e-9


def test_fingerprints_of_a_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    got = fingerprint.op2_fingerprints(spark, small).collect()
    check_fingerprints([tuple(r) for r in docs.collect()], got)
    texts = dict(tuple(r) for r in docs.collect())
    prints = Counter((texts[r.doc_id], r.fingerprint) for r in got)
    assert len(prints) == len(set(texts.values())) == len({r.fingerprint for r in got})


def random_text(kind, n):
    rng = random.Random(kind)
    if kind == "numbered words":
        return " ".join(f"w{k}" for k in range(n))[:n]
    if kind == "few words":
        return " ".join(rng.choice(["das", "ist", "ein", "Haus", "und", "der", "Baum", "nicht"]) for _ in range(n))[:n]
    if kind == "long german words":
        return " ".join("".join(rng.choice(["recht", "schutz", "versicherung", "gesellschaft", "beitrag"]) for _ in range(rng.randint(1, 5))) for _ in range(n // 8 + 9))[:n]
    if kind == "table":
        return "\n".join("\t".join(str(rng.randrange(10**6)) for _ in range(9)) for _ in range(n // 60 + 9))[:n]
    letters = {"digits": "0123456789", "chinese": "".join(map(chr, range(0x4E00, 0x4F00))), "greek": "αβγδεζηθικλμνξοπρστυ   ", "code": "abc_(){};=+  \n", "emoji": "😀😁😂🤣😃"}[kind]
    return "".join(rng.choices(letters, k=n))


KINDS = ["numbered words", "few words", "long german words", "table", "digits", "chinese", "greek", "code", "emoji"]


@pytest.mark.parametrize("kind", KINDS)
def test_likeness_moves_smoothly_in_any_script(spark, kind):
    """One code point less, at the end or inside, costs no more than some 200 code points of likeness."""
    rows = []
    for n in [200, 250, 400, 1000, 1887, 4000, 14_186, 100_000]:
        text = random_text(kind, n)
        rows += [(text, text[:-1]), (text, text[: n // 2] + text[n // 2 + 1 :]), (text, text[1:])]
    df = spark.createDataFrame(rows, "a string, b string")
    for r in df.select("a", "b", fingerprint.units(F.col("a")).alias("ua"), fingerprint.units(F.col("b")).alias("ub")).collect():
        assert len(r.ua) == len(units(r.a)) and len(r.ub) == len(units(r.b))
        assert likeness(units(r.a), units(r.b)) >= 1 - 200 / len(r.a), (kind, len(r.a))


def test_signs_of_cuts_in_a_text(spark):
    rows = [("a\x01b \x02c d\x02" * 40, "\x01"), ("\x02", "\n\n"), (" ", "  ")]
    df = spark.createDataFrame(rows, "a string, b string")
    for r in df.select("a", "b", fingerprint.units(F.col("a")).alias("ua"), fingerprint.units(F.col("b")).alias("ub")).collect():
        assert len(r.ua) == len(units(r.a)) and len(r.ub) == len(units(r.b))


def test_fingerprints_subtract_and_peel(spark):
    one = [f"sentence number {k} here." for k in range(40)]
    rows = [(" ".join(one), " ".join([*one[:20], "another one.", *one[25:]])), ("", "a. b."), ("", ""), (" ".join(one), "nothing of it. at all. " * 3), (" ".join(one), " ".join(x.upper() for x in one))]
    df = spark.createDataFrame(rows, "a string, b string")
    write = lambda c: fingerprint.written(F.col(c), fingerprint.small_sketch(fingerprint.units(F.col(c))))
    df = df.select("a", "b", fingerprint.units(F.col("a")).alias("ua"), fingerprint.units(F.col("b")).alias("ub"), write("a").alias("fa"), write("b").alias("fb"))
    got = df.select("*", fingerprint.difference(F.col("fa"), F.col("fb")).alias("d"), fingerprint.text_of(F.array_except("ua", "ub")).alias("n")).collect()
    for r in got[:3]:
        assert r.d.complete
        assert set(r.d.only_a) == set(r.ua) - set(r.ub) and set(r.d.only_b) == set(r.ub) - set(r.ua)
    assert got[0].n == sum(len(x) for x in units(rows[0][0]) - units(rows[0][1]))
    assert not got[4].d.complete


def test_small_tables_are_sketched_again(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "CELLS", 1)
    monkeypatch.setattr(fingerprint, "SPARE", 2)
    rows = [(k, ". ".join(f"unit {k} {j}" for j in range(90))) for k in range(6)]
    got = fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    check_fingerprints(rows, got)
    assert max(r.attempts for r in got) > 1


def test_fingerprints_of_edge_rows(spark, edge, none):
    rows = [tuple(r) for r in edge.select("doc_id", "text").where("doc_id is null or doc_id <> 10").distinct().collect()]
    one = edge.where("doc_id is null or doc_id <> 10")
    got = fingerprint.fingerprints(one).collect()
    assert len(got) == one.count()
    check_fingerprints(rows, got)
    assert fingerprint.fingerprints(edge).count() == edge.count()
    assert fingerprint.fingerprints(none).count() == 0
    alone = fingerprint.fingerprints(edge.where("doc_id = 4")).first()
    assert alone.near_next == 1.0


def test_fingerprint_plan_is_native(spark, small):
    base = spark.read.parquet(f"{small}/documents.parquet").select(F.col("doc_id").alias("dk"), F.xxhash64("text").alias("rid"), "text")
    link, _ = fingerprint._neighbours(base)
    plan = fingerprint._pairs(base, link, 0)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    # after the neighbours have met, nothing is shuffled again
    last_join = max(plan.index(j) for j in ("SortMergeJoin", "ShuffledHashJoin", "BroadcastHashJoin") if j in plan)
    assert "Exchange" not in plan[: plan.index("Join")] and last_join


# ---- repeated passages
def clauses(text):
    out, cur, found = [], [], list(re.finditer(r"[^\x20\x09-\x0D]+", text or ""))
    for k, m in enumerate(found):
        cur.append(m)
        after = text[m.end() : found[k + 1].start()] if k + 1 < len(found) else "\n"
        if m[0][-1] in ".!?,;:" or "\n" in after:
            words = []
            for x in cur:
                w = "".join(c.lower() if "A" <= c <= "Z" else c for c in x[0])
                for _ in range(3):
                    w = w[:-1] if len(w) > 1 and w[-1] in ".!?,;:" else w
                words.append(w)
            out.append((tuple(words), k + 1 - len(cur), k + 1, cur[0].start(), m.end()))
            cur = []
    return out


def test_passages_against_brute_force(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 6)))
    clause = lambda: " ".join(word() for _ in range(rng.randint(2, 9))) + rng.choice([".", ",", "\n"])
    shared = [" ".join(clause() for _ in range(12)) for _ in range(3)]
    rows = [(k, " ".join(rng.choice(shared).upper() if rng.random() < 0.15 else clause() for _ in range(rng.randint(1, 12)))) for k in range(80)]
    count, first = Counter(), {}
    for k, t in rows:
        for u in clauses(t):
            if len(u[0]) >= 3:
                count[u[0]] += 1
                first.setdefault(u[0], (k, u[1]))
    want = set()
    for k, t in rows:
        run = None
        for u in [*clauses(t), None]:
            if u and not (len(u[0]) >= 3 and count[u[0]] > 1 and first[u[0]] != (k, u[1])):
                continue
            if u and run and u[1] - run[3] <= 6:
                run = (run[0], u[4], run[2] + u[2] - u[1], u[2], run[4])
                continue
            if run and run[2] >= 30:
                want.add((k, run[0], run[1], run[2], run[4]))
            run = (u[3], u[4], u[2] - u[1], u[2], first[u[0]][0]) if u else None
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = passage_dedup.repeated_passages(docs)
    assert {(r.doc_id, r.start, r.end, r.n_words, r.first_doc_id) for r in found.collect()} == want and want
    texts = dict(rows)
    for r in passage_dedup.remove_passages(docs, found).where("removed_spans is not null").collect():
        left, at = "", 0
        for s in r.removed_spans:
            left, at = left + texts[r.doc_id][at : s.start], s.end
        assert r.text == left + texts[r.doc_id][at:]


def test_passage_put_into_a_line_is_found(spark):
    passage = ". ".join(f"This is sentence number {n} of a long passage" for n in ("one", "two", "three", "four", "five", "six")) + "."
    rows = [(1, f"before it some words {passage} after it"), (2, f"other words\nand {passage} more"), (3, "clean text with nothing of it."), (4, "clean text with nothing of it.")]
    got = passage_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert [(r.doc_id, r.first_doc_id) for r in got] == [(2, 1)]


def test_passage_without_marks_is_found_to_its_ends(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(4, 9)))
    some = lambda n: " ".join(word() for _ in range(n))
    rows, want = [], set()
    for k, n in enumerate([30, 31, 40, 52, 60, 80, 52, 29]):
        passage, before = some(n), some(rng.randint(5, 40))
        rows += [(3 * k, f"{some(12)} {passage} {some(9)}"), (3 * k + 1, some(70)), (3 * k + 2, f"{before} {passage.upper()}, é {some(20)}")]
        if n >= 30:
            want.add((3 * k + 2, len(before) + 1, len(before) + 2 + len(passage), n, 3 * k))
    found = passage_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {(r.doc_id, r.start, r.end, r.n_words, r.first_doc_id) for r in found.collect()} == want


def test_repeated_rows_are_repeats_one_after_the_other(spark):
    rng = random.Random(14)
    some = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(4, 9))) for _ in range(n))
    short, long, whole = some(15), some(40), some(50)
    # a repeat of 15 words is too short, however often its row stands there
    rows = [(1, f"{some(20)}. {short}. {some(20)}."), (2, f"x {some(20)}. {short}."), (2, f"x {some(20)}. {short}.")]
    rows[2] = rows[1]
    rows += [(3, whole + ".")] * 3 + [(4, f"{some(5)}. {long}. {some(6)}."), (5, f"{long}."), (None, short + "."), (None, short + ".")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = Counter((r.doc_id, r.start, r.end, r.n_words, r.first_doc_id) for r in passage_dedup.repeated_passages(docs).collect())
    size = len(rows[1][1])
    # of two equal rows the second is a repeat as a whole; of three the second and third
    assert got == Counter({(2, 0, size, 36, 2): 1, (3, 0, len(whole) + 1, 50, 3): 2, (5, 0, len(long) + 1, 40, 4): 1})
    left = Counter((r.doc_id, r.text) for r in passage_dedup.remove_repeats(docs).collect())
    assert left[(3, whole + ".")] == 1 and left[(3, "")] == 2 and left[rows[1]] == 1 and left[(2, "")] == 1 and left[(5, "")] == 1
    alone = spark.createDataFrame([rows[3]] * 2, "doc_id bigint, text string")
    assert [(r.doc_id, r.n_words) for r in passage_dedup.repeated_passages(alone).collect()] == [(3, 50)]


def test_columns_keep_their_names(spark):
    text = " ".join(f"word{k}" for k in range(40))
    names = ["doc_id", "text", "_copy", "_span_doc", "_span_copy", "_spans", "copy"]
    docs = spark.createDataFrame([(k, text, 1, 2, 3, 4, 5) for k in range(2)], names)
    got = passage_dedup.remove_repeats(docs)
    assert got.columns == [*names, "removed_spans"]
    assert sorted((r.doc_id, len(r.text), *r[2:7]) for r in got.collect()) == [(0, len(text), 1, 2, 3, 4, 5), (1, 0, 1, 2, 3, 4, 5)]


def test_passages_of_edge_rows(edge, none):
    got = passage_dedup.repeated_passages(edge)
    assert got.where("doc_id in (5, 1, 2, 3)").count() == 0
    assert passage_dedup.remove_passages(edge, got).count() == edge.count()
    assert passage_dedup.repeated_passages(none).count() == 0


# ---- decontamination
def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        above = 0
        for k, y in enumerate(b):
            above, row[k + 1] = row[k + 1], above + 1 if x == y else max(row[k], row[k + 1])
    return row[-1]


def test_subsequences_against_the_table_method():
    rng = random.Random(7)
    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randint(1, 30))] for _ in range(2))
        masks = {}
        for k, x in enumerate(a):
            masks[x] = masks.get(x, 0) | 1 << k
        assert decontaminate.common_subsequence(masks, len(a), b).bit_count() == lcs(a, b)


def corpus(rng, n):
    return [" ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 6))) for _ in range(rng.randint(30, 200))) for _ in range(n)]


def test_leaks_are_found_and_clean_documents_left(spark):
    rng = random.Random(12)
    items, texts = [t.split()[:40] for t in corpus(rng, 25)], corpus(rng, 300)
    want = set()
    for k in range(0, 100, 4):
        item = k // 4 % len(items)
        words, at = texts[k].split(), rng.randrange(20)
        leak = list(items[item])
        if k % 8 == 0:  # a paraphrase: every sixth word another
            leak[::6] = ["other"] * len(leak[::6])
        texts[k] = " ".join(words[:at]) + ".\n" + " ".join(leak).upper() + "! " + " ".join(words[at:])
        want.add((k, item))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(98, None), (99, "")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contamination(docs, bench).collect()}
    assert got == want
    kept = {r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()}
    assert kept == set(range(300)) - {k for k, _ in want}


def test_blocks_of_items_give_the_same(spark, small, monkeypatch):
    once = {(r.doc_id, r.item_id) for r in decontaminate.op7_contamination(spark, small).collect()}
    monkeypatch.setattr(decontaminate, "ITEMS", 15)
    assert {(r.doc_id, r.item_id) for r in decontaminate.op7_contamination(spark, small).collect()} == once
    bench = {r.item_id: r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert {(d, i) for d, t in texts.items() for i, b in bench.items() if b in t} <= once


def test_short_items_must_occur_whole(spark):
    rows = [(1, "Xylophone"), (2, "a xylo phone, and a blue zebra."), (3, "blue. Zebra"), (4, "zebra blue"), (5, "one two three four five six seven"), (6, "one two three four five six and seven")]
    items = [(1, "xylophone"), (2, "Blue zebra!"), (3, "one two three four five six seven")]
    got = decontaminate.contamination(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.start_word) for r in got) == [(1, 1, 0), (2, 2, 5), (3, 2, 0), (5, 3, 0)]


def test_an_item_that_many_texts_hold_is_found(spark):
    rng = random.Random(5)
    texts = corpus(rng, 240)
    item = " ".join(texts[0].split()[:20])
    rows = [(k, f"{t} {item}." if k % 3 == 0 else t) for k, t in enumerate(texts)]
    bench = spark.createDataFrame([(7, item), (8, texts[200] + " and more")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contamination(spark.createDataFrame(rows, "doc_id bigint, text string"), bench).collect()}
    assert got == {(k, 7) for k in range(0, 240, 3)} | {(200, 8)}


def test_paraphrases_against_all_pairs(spark, small):
    """All (text, item) pairs whose common subsequence is long enough, texts being single lines of a table."""
    rng = random.Random(31)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    words = sorted({w for _, t in bench for w in re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower())})
    rows = []
    for k in range(160):
        base = re.findall(r"\S+", bench[k % len(bench)][1])
        changed = [w if rng.random() > 0.22 else rng.choice(words) for w in base]
        rows.append((k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) + " " + " ".join(changed)))
    split = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower())
    want = set()
    for i, t in bench:
        item = split(t)
        for d, text in rows:
            seq = split(text)
            tail = max(3, len(item) // 4)
            if len(item) >= 8 and len(set(item) & set(seq)) >= 0.6 * len(set(item)) and lcs(item, seq) >= 0.6 * len(item) and lcs(item[-tail:], seq) >= 0.5 * tail:
                want.add((d, i))
    got = {(r.doc_id, r.item_id) for r in decontaminate.contamination(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(bench, "item_id bigint, text string")).collect()}
    assert len(got & want) >= 0.9 * len(want) and len(want) > 100
    assert all(d % len(bench) == [i for i, _ in bench].index(i) for d, i in got - want)


def test_contamination_of_edge_rows(spark, edge, none):
    bench = spark.createDataFrame([(1, "same text here for all of us to read"), (2, None), (3, "one two")], "item_id bigint, text string")
    got = Counter((r.doc_id, r.item_id) for r in decontaminate.contamination(edge, bench).collect())
    assert got[(8, 1)] == 2 and got[(9, 1)] == 1 and got[(3, 3)] == 1
    assert decontaminate.contamination(none, bench).count() == 0
    assert decontaminate.contamination(edge, bench.where("false")).count() == 0
    assert decontaminate.drop_contaminated(edge, bench).where("doc_id in (8, 9)").count() == 0


def test_basis_spans_the_items(spark):
    items = decontaminate.Items([0, 1, 2], ["alpha beta gamma delta", "beta eps zeta", "eta theta iota kappa lam"])
    items.weigh(np.ones(len(items.vocabulary), np.int64), 10)
    basis = decontaminate.randomised_basis(spark, items, 8)
    for nz, v in items.vectors(range(3)):
        full = np.zeros(len(basis))
        full[nz] = v
        assert np.linalg.norm(basis @ (basis.T @ full) - full) < 1e-4
