"""Schemas of the layers.  Bronze rows are strings throughout; types begin with Silver."""

from __future__ import annotations

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


MANIFEST = strings("document", "cycle", "route", "process", "exam_date", "family", "pages", "modality", "conditions", "bytes", "sha256", "origin", "path", "state")
BRONZE_ROWS = strings("document", "page", "site", "subgroup", "program", "merit_rank", "code", "name", "part_extra", "part_1", "part_2", "score", "condition", "option", "floor_score")
SEATS = strings("cycle", "program", "section", "pre_university", "ordinary", "internal_transfer", "extraordinary", "scholarship", "total")
CHARS = T.StructType(
    [
        T.StructField("document", T.StringType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("seq", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("x0", T.DoubleType()),
        T.StructField("x1", T.DoubleType()),
        T.StructField("top", T.DoubleType()),
    ]
)
APPLICATIONS = T.StructType(
    [
        T.StructField("cycle", T.StringType()),
        T.StructField("document", T.StringType()),
        T.StructField("route", T.StringType()),
        T.StructField("program", T.StringType()),
        T.StructField("person", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("admitted", T.BooleanType()),
        T.StructField("floor_score", T.DoubleType()),
        T.StructField("row_seq", T.LongType()),
    ]
)
