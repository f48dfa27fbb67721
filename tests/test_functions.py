"""Column functions on hand-made fixtures: the dirty branches the test tables never hit."""

import datetime as dt
import hashlib
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from estrella.functions import (
    damage_utf8_as_latin1,
    fallback_key,
    full_name,
    guarded_key,
    all_present,
    natural_key,
    normalize_plan,
    null_tokens,
    percent_half_up,
    repair_mojibake,
    safe_date_from_text,
    safe_decimal,
    safe_int_with_words,
    surrogate_key,
    title_case,
    trimmed,
    trimmed_title,
    upper_trimmed,
    zero_to_null,
)
from estrella.functions.keys import SURROGATE_NULL_TOKEN


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {dtype}")


def apply(spark, values, fn, dtype="string"):
    df = one_col(spark, values, dtype)
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_dates_from_dirty_text(spark):
    values = ["2020-01-05", " 2020-01-05 ", "2020-1-5", "2020-01-05 10:20:00", "31/12/2020",
              "20200105", "NULL", "", None]
    d = dt.date(2020, 1, 5)
    assert apply(spark, values, safe_date_from_text) == [d, d, d, d, None, None, None, None, None]


def test_ages_with_words(spark):
    values = ["42", " 42 ", "CUARENTA Y DOS", "abc", "", None]
    assert apply(spark, values, safe_int_with_words) == [42, 42, 42, None, None, None]


def test_amounts_decimal_10_2(spark):
    values = ["12345.005", "123456789.005", "1,234.50", "-1", "0", None]
    out = apply(spark, values, lambda c: safe_decimal(c, 10, 2))
    assert out == [Decimal("12345.01"), None, None, Decimal("-1.00"), Decimal("0.00"), None]


def test_plan_labels(spark):
    values = ["CONTADO 5%", "48 MEESES X", "48 MESES. A", "48 MESES", "48 meses. a", "36 MESES.",
              " otro ", None, "24 MESES.x", "60 MESES.", "12 meses. y", "contado"]
    assert apply(spark, values, normalize_plan) == [
        "CONTADO", "48 MESES", "48 MESES", "48 MESES", "48 MESES", "36 MESES.", "otro", None,
        "24 MESES", "60 MESES", "12 MESES", "CONTADO",
    ]


def test_text_cleaning(spark):
    values = ["  hola Mundo ", "\ttab ", "spei-x TRANSFER", "méxico"]
    assert apply(spark, values, trimmed) == ["hola Mundo", "\ttab", "spei-x TRANSFER", "méxico"]
    assert apply(spark, values, upper_trimmed)[3] == "MÉXICO"
    assert apply(spark, values, title_case)[2] == "Spei-x Transfer"
    assert apply(spark, ["  ab cd"], trimmed_title) == ["Ab Cd"]


def test_null_tokens_and_zero(spark):
    assert apply(spark, [" NULL ", "", " x ", None, "null"], null_tokens) == [
        None, None, "x", None, "null"]
    assert apply(spark, [" 0 ", "0", "10", None], zero_to_null) == [None, None, "10", None]
    # numeric input is cast to text before comparing with the token
    assert apply(spark, [5, None], null_tokens, "bigint") == ["5", None]


def test_encoding_repair_fixture(spark):
    values = ["MÃ©XICO", "MÉXICO", "A–B", "plain ascii", None, "Ã±andÃº"]
    assert apply(spark, values, repair_mojibake) == [
        "MéXICO", "MÉXICO", "A–B", "plain ascii", None, "ñandú"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=20))
def test_encoding_round_trip(spark, texts):
    out = apply(spark, texts, lambda c: repair_mojibake(damage_utf8_as_latin1(c)))
    assert out == texts


def _md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def test_surrogate_key_convention(spark):
    df = spark.createDataFrame([(1, "a", None), (None, None, None)], "i bigint, s string, n string")
    r = df.select(
        surrogate_key("i").alias("k1"),
        surrogate_key("i", "s").alias("k2"),
        surrogate_key("s", "n").alias("k3"),
    ).collect()
    assert r[0].k1 == _md5("1")
    assert r[0].k2 == _md5("1-a")
    assert r[0].k3 == _md5("a-" + SURROGATE_NULL_TOKEN)
    assert r[1].k1 == _md5(SURROGATE_NULL_TOKEN)
    # never null, and all-null rows share a key (null matches null in key joins)
    assert r[1].k3 == _md5(SURROGATE_NULL_TOKEN + "-" + SURROGATE_NULL_TOKEN)


def test_surrogate_key_types(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 5), Decimal("5.00"))], "d date, m decimal(18,2)")
    assert df.select(surrogate_key("d", "m")).first()[0] == _md5("2020-01-05-5.00")


def test_guarded_and_fallback_keys(spark):
    df = spark.createDataFrame(
        [(1, "u1", "f", "s"), (None, "", "f", "s"), (2, None, "f", None)],
        "id bigint, uuid string, folio string, seg string",
    )
    r = df.select(
        guarded_key(all_present("id"), "id").alias("g"),
        fallback_key("uuid", "folio", "seg").alias("f"),
    ).collect()
    assert r[0].g == _md5("1") and r[1].g is None
    assert r[0].f == _md5("u1")
    assert r[1].f == _md5("f-s")
    assert r[2].f == _md5("f-" + SURROGATE_NULL_TOKEN)


def test_natural_key_cascade(spark):
    rows = [
        ("CURP1", None, None, "A", None, None, None),
        ("", "RFC1", "x@y", "A", None, None, None),
        (None, "", "Mixed@Case.com", "A", None, None, None),
        (None, None, "", "ANA", "PEREZ", None, "55"),
        (None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "curp string, rfc string, email string, n string, a1 string, a2 string, tel string")
    out = [r[0] for r in df.select(natural_key("curp", "rfc", "email", ["n", "a1", "a2", "tel"])).collect()]
    assert out == ["CURP1", "RFC1", "mixed@case.com", "ANA|PEREZ|55", ""]
    names = [r[0] for r in df.select(full_name("n", "a1", "a2")).collect()]
    assert names == ["A", "A", "A", "ANA PEREZ", ""]


def _exact_pct(n_cents, d_cents):
    q = (Decimal(n_cents) / Decimal(d_cents) * 100).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    return q


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(-10**9, 10**9)), min_size=1, max_size=30))
def test_percent_half_up_is_exact(spark, pairs):
    df = spark.createDataFrame(
        [(Decimal(n) / 100, Decimal(d) / 100) for n, d in pairs], "n decimal(18,2), d decimal(18,2)"
    )
    rows = df.select(
        percent_half_up("n", "d").alias("pos"), percent_half_up("n", "d", guard="nonzero").alias("nz")
    ).collect()
    for (n, d), r in zip(pairs, rows):
        expect = None if d == 0 else _exact_pct(n, d)
        assert r.nz == expect
        assert r.pos == (expect if d > 0 else None)


@pytest.mark.parametrize("n,d,expect", [(1, 8, "12.50"), (1, 20000, "0.01"), (-1, 20000, "-0.01"), (1, 3, "33.33"), (2, 3, "66.67")])
def test_percent_half_up_ties(spark, n, d, expect):
    df = spark.createDataFrame([(Decimal(n), Decimal(d))], "n decimal(18,2), d decimal(18,2)")
    assert df.select(percent_half_up("n", "d")).first()[0] == Decimal(expect)
