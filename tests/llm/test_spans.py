"""Helpers on spans, and time that does not grow with the square of a text's spans."""

import random
import time

import pytest
from pyspark.sql import functions as F

from quarrystone.llm import passage_dedup, secret_scan
from quarrystone.llm.common import cut_out, fresh, running


def plain_cut(text, spans, between):
    out, at = "", 0
    for k, (a, b) in enumerate(sorted(spans)):
        if a > at:
            out += text[at:a] + between
        elif k == 0 and a == 0:
            out += between
        at = max(at, b)
    return out + text[at:]


def test_cut_out_equals_plain_python(spark):
    rng, rows = random.Random(3), []
    for _ in range(60):
        text = "".join(rng.choice("ab ﻿😀é日\n") for _ in range(rng.randint(1, 60)))
        spans = sorted((a, min(len(text), a + rng.randint(1, 9))) for a in (rng.randrange(len(text)) for _ in range(rng.randint(1, 9))))
        rows.append((text, spans))
    df = spark.createDataFrame(rows, "text string, spans array<struct<start:int,end:int>>")
    got = df.select("text", "spans", cut_out(F.col("text"), F.col("spans"), "#").alias("out")).collect()
    for r in got:
        assert r["out"] == plain_cut(r["text"], [tuple(s) for s in r["spans"]], "#")


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 64, 100])
def test_running(spark, n):
    values = [(k * 7919) % 31 - 15 for k in range(n)]
    df = spark.createDataFrame([(values,)], "v array<int>")
    r = df.select(running(F.col("v"), lambda a, b: a + b).alias("s"), running(F.col("v"), lambda a, b: F.greatest(a, b)).alias("m")).first()
    assert r["s"] == [sum(values[: k + 1]) for k in range(n)] and r["m"] == [max(values[: k + 1]) for k in range(n)]


def test_fresh_names_differ_whatever_their_case(spark):
    df = spark.createDataFrame([(1, 2)], "_COPY int, _tokens_ int")
    assert fresh(df, "_copy", "_tokens", "_tokens") == ["_copy_", "_tokens", "_tokens__"]


def test_columns_that_clash_but_for_case_stay(spark):
    docs = spark.createDataFrame([(1, "token = abcdefgh1234", 5, 6, 7, 8, 9)], "doc_id bigint, text string, _COPY int, _TOKENS int, _Base int, _SPAN_DOC int, _Spans int")
    assert {"_COPY", "_TOKENS", "_Base", "_SPAN_DOC", "_Spans"} <= set(secret_scan.redact(secret_scan.scan_secrets(docs)).columns)
    row = passage_dedup.remove_repeats(docs).first()
    assert (row["_COPY"], row["_TOKENS"], row["_Base"], row["_SPAN_DOC"], row["_Spans"]) == (5, 6, 7, 8, 9)


def _seconds(spark, make, n):
    text = make(n)
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    began = time.time()
    row = secret_scan.redact(secret_scan.scan_secrets(df)).first()
    return time.time() - began, row


@pytest.mark.parametrize(
    "make",
    [lambda n: " ".join(f"current_account_{k}" for k in range(n)), lambda n: " ".join(f"{k * 2654435761 % 2**64:032x}" for k in range(n))],
    ids=["identifiers", "hexadecimal"],
)
def test_many_tokens_in_one_text(spark, make):
    """Four times the tokens: no more than some six times the time."""
    _seconds(spark, make, 1000)
    small, _ = _seconds(spark, make, 25_000)
    large, row = _seconds(spark, make, 100_000)
    assert large < 7 * small + 3
    assert row["text"].count("[SECRET]") == len(row["secret_spans"])
