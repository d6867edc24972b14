"""Hand-worked cases and properties of the scalar expressions.

Each example is a batch of values evaluated in one Spark job.
"""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from scorewell.functions import scalars as S

FLOATS = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)
SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


CASES = [  # value, probability, band: worked by hand
    (-0.1, 0.0, "LOW RISK"), (0.0, 0.0, "LOW RISK"), (0.34, 0.34, "LOW RISK"), (0.35, 0.35, "MODERATE RISK"),
    (0.64, 0.64, "MODERATE RISK"), (0.65, 0.65, "CRITICAL RISK"), (1.0, 1.0, "CRITICAL RISK"),
    (2.0, 0.02, "LOW RISK"), (35.0, 0.35, "MODERATE RISK"), (65.0, 0.65, "CRITICAL RISK"),
    (100.0, 1.0, "CRITICAL RISK"), (100.01, 1.0, "CRITICAL RISK"), (1e9, 1.0, "CRITICAL RISK"),
]


def _scored(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    p = S.normalize_probability("v")
    return df.select(p.alias("p"), S.normalize_probability(p).alias("pp"), S.risk_band(p).alias("b")).collect()


def test_normalize_and_band_cases(spark):
    for (v, p, band), row in zip(CASES, _scored(spark, [c[0] for c in CASES])):
        assert (round(row["p"], 12), row["b"]) == (p, band), v


@SETTINGS
@given(st.lists(FLOATS, min_size=2, max_size=200))
def test_normalize_properties(spark, values):
    rows = _scored(spark, values)
    order = ["LOW RISK", "MODERATE RISK", "CRITICAL RISK"]
    assert all(0.0 <= r["p"] <= 1.0 and r["pp"] == r["p"] for r in rows)  # in range, idempotent
    for low, high in ((-1e6, 1.0), (1.0000001, 1e6)):  # never falls within a branch
        part = sorted((v, r["p"], order.index(r["b"])) for v, r in zip(values, rows) if low <= v <= high)
        assert [x[1] for x in part] == sorted(x[1] for x in part)
        assert [x[2] for x in part] == sorted(x[2] for x in part)


def test_coerce_cases(spark):
    cases = [(0.5, "0"), (1.5, "2"), (2.5, "2"), (-1.5, "-2"), (-0.5, "0"), (7.49, "7"), (7.51, "8"), (-3.0, "-3")]
    df = spark.createDataFrame([(v,) for v, _ in cases], "v double")
    assert [r[0] for r in df.select(S.coerce_category("v")).collect()] == [t for _, t in cases]


@SETTINGS
@given(st.lists(FLOATS, min_size=1, max_size=200))
def test_coerce_is_the_nearest_integer(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for v, (text,) in zip(values, df.select(S.coerce_category("v")).collect()):
        gap = abs(int(text) - v)
        assert gap < 0.5 or gap == 0.5 and int(text) % 2 == 0


def test_flag_and_label_cases(spark):
    cases = [("0", False, "0"), ("False", False, "False"), ("NO", False, "N O"), (" no", True, "no"),
             ("yes", True, "yes"), ("", True, ""), ("ClimateChange", True, "Climate Change"),
             ("\u00a0A\u0085b\n", True, "A\u0085b"), ("aB1C", True, "a B1 C")]
    df = spark.createDataFrame([(v,) for v, _, _ in cases], "v string")
    got = df.select(S.parse_flag("v").alias("f"), S.label_from_name("v").alias("l")).collect()
    for (v, flag, label), row in zip(cases, got):
        assert (row["f"], row["l"].replace("  ", " ")) == (flag, label), v
