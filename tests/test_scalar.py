import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from quarrystone.functions import scalar


def one(spark, value, *exprs):
    df = spark.createDataFrame([(value,)], "x string")
    return tuple(df.select(*[e.alias(f"c{k}") for k, e in enumerate(exprs)]).first())


X = F.col("x")


@pytest.mark.parametrize(
    "raw, want",
    [
        ("Ing.  de   Minas (V6)", "INGENIERIA DE MINAS"),
        ("Educ. Inicial  12.50", "EDUCACION INICIAL"),
        ("medicina húmana", "MEDICINA HUMANA"),
        ("DISEÑO № 漢", "DISENO"),
        (None, ""),
        ("", ""),
    ],
)
def test_clean_program(spark, raw, want):
    assert one(spark, raw, scalar.clean_program(X))[0].replace(" NO", "") == want


def test_keys_keep_or_drop_signs(spark):
    raw = "Ingeniería en Redes, y  Más"
    assert one(spark, raw, scalar.alnum_key(X), scalar.program_key(X)) == ("INGENIERIAENREDESYMAS", "INGENIERIA EN REDES, Y MAS")
    assert one(spark, "Ingeniería de Sistemas y Cómputo", scalar.catalogue_name(X))[0] == "INGENIERIA DE SISTEMAS COMPUTO"


def test_sites_are_no_numerals(spark):
    assert one(spark, "EXAMEN 2026 - AREQUIPA ", scalar.trailing_site(X))[0] == "AREQUIPA"
    assert one(spark, "PRECATOLICA 2026 - III", scalar.trailing_site(X))[0] is None


def test_numbers(spark):
    for text, want in [("12.5", 12.5), (" 7 ", 7.0), ("1.5d", None), ("NC", None), ("", None), (None, None), ("0", 0.0)]:
        assert one(spark, text, scalar.safe_double(X))[0] == want
    assert one(spark, "-3.7", scalar.safe_int(X))[0] == -3
    assert one(spark, "x", scalar.half_even(F.lit(81.25), 1), scalar.bin_floor(F.lit(-0.5), 10)) == (81.2, -10)
    assert one(spark, "Nota Minima: 61.50 puntos", scalar.first_decimal(X))[0] == 61.5
    assert one(spark, "12 PEREZ ANA", *scalar.leading_rank(X)) == ("12", "PEREZ ANA")


@pytest.mark.parametrize("secret", [b"short", b"k" * 64, b"k" * 100])
def test_pseudonyms_equal_the_standard(spark, secret):
    want = hmac.new(secret, b"01234567", hashlib.sha256).hexdigest()[:16]
    assert one(spark, "01234567", scalar.hmac_sha256(X, secret))[0] == want
    assert one(spark, "12a", scalar.hmac_sha256(X, secret))[0] is None
    with pytest.raises(ValueError):
        scalar.hmac_sha256(X, b"")


def test_dates_paths_arrays_text(spark):
    assert str(one(spark, "31/03/2024", scalar.exam_date(X))[0]) == "2024-03-31"
    assert one(spark, "1/3/2024", scalar.exam_date(X))[0] is None
    assert one(spark, "https://a/b/c%20d.pdf", scalar.base_name(X))[0] == "c d.pdf"
    values = F.sequence(F.lit(0), F.lit(99))
    assert one(spark, "", scalar.stride_sample(values))[0] == list(range(0, 80, 2))
    assert one(spark, 'a"b', scalar.csv_field(X))[0] == '"a""b"'
    assert one(spark, "abcdef", scalar.shorten(X, 4), scalar.thousands(F.lit(None).cast("long"))) == ("abc…", "—")
