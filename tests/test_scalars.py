"""Scalar functions on hand-made rows (edges and ties)."""

import math

import pytest
from pyspark.sql import functions as F

from scorewell.functions import scalars as S


def _one(spark, expr, values, dtype="double"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_coerce_category_half_even(spark):
    worked = {0.5: "0", 1.5: "2", 2.5: "2", -1.5: "-2", 3.49: "3", 3.5: "4", 10.0: "10", 3e9: "3000000000",
              -4.5e12: "-4500000000000", None: None}
    assert _one(spark, S.coerce_category, list(worked)) == list(worked.values())


def test_coerce_category_text_input(spark):
    got = _one(spark, S.coerce_category, ["5", "7.0", "abc", " 2.5", None], "string")
    assert got == ["5", "7", None, "2", None]


def test_normalize_probability_edges(spark):
    worked = {-0.1: 0.0, 0.0: 0.0, 0.5: 0.5, 1.0: 1.0, 1.0001: 0.010001, 50.0: 0.5, 100.0: 1.0, 100.01: 1.0, 1e9: 1.0}
    assert _one(spark, S.normalize_probability, list(worked)) == pytest.approx(list(worked.values()))


def test_normalize_probability_null_and_nan(spark):
    got = _one(spark, S.normalize_probability, [None, float("nan")])
    assert got[0] is None
    assert got[1] == 1.0  # NaN ends at 1.0 as with Python's max/min


def test_round4(spark):
    assert _one(spark, S.round4, [0.123456, 0.99995]) == [0.1235, 1.0]


@pytest.mark.parametrize("p,band", [(0.0, "LOW RISK"), (0.3499, "LOW RISK"),
                                    (0.35, "MODERATE RISK"), (0.6499, "MODERATE RISK"),
                                    (0.65, "CRITICAL RISK"), (1.0, "CRITICAL RISK")])
def test_risk_band(spark, p, band):
    assert _one(spark, S.risk_band, [p]) == [band]


def test_risk_band_fallback_first(spark):
    df = spark.createDataFrame([(0.1, "fallback"), (0.1, "success")], "p double, s string")
    got = [r[0] for r in df.select(S.risk_band("p", "s")).collect()]
    assert got == ["DEMO VALUE", "LOW RISK"]


def test_label_from_name(spark):
    got = _one(spark, S.label_from_name, ["MonsoonIntensity", "IneffectiveDisasterPreparedness",
                                          "lower", "ABC", "\tX y\n", "\u00a0Ab\u3000"], "string")
    assert got == ["Monsoon Intensity", "Ineffective Disaster Preparedness", "lower", "A B C",
                   "X y", "Ab"]


def test_fixed2(spark):
    assert _one(spark, S.fixed2, [0.125, 0.5034, 1.0, 0.0]) == ["0.13", "0.50", "1.00", "0.00"]


def test_retryable(spark):
    msgs = ["Connection Refused by host", "No active or default Spark session", "[Errno 111]",
            "JVM is not running", "division by zero", None]
    assert _one(spark, S.is_retryable_error, msgs, "string") == [True, True, True, True, False, False]


def test_flag_parse(spark):
    vals = ["0", "false", "No", "FALSE", "1", "yes", "anything", " no", None]
    assert _one(spark, S.parse_flag, vals, "string") == [False, False, False, False, True, True,
                                                          True, True, True]


def test_domain(spark):
    assert _one(spark, S.in_domain, [0.0, 10.0, 5.0, 5.5, -1.0, 11.0, None]) == [
        True, True, True, False, False, False, False]
    assert _one(spark, S.with_domain_default, [None, 3.0]) == [5.0, 3.0]


def test_json_field(spark):
    got = _one(spark, lambda c: S.json_field(c, "$.a.b", F.lit("d")),
               ['{"a": {"b": 1}}', '{"a": {}}', "not json"], "string")
    assert got == ["1", "d", "d"]


def test_stable_hash32_matches_md5(spark):
    import hashlib
    keys = [*range(50), None]
    got = _one(spark, S.stable_hash32, keys, "bigint")
    text = ["" if k is None else str(k) for k in keys]
    assert got == [int(hashlib.md5(t.encode()).hexdigest()[:8], 16) for t in text]