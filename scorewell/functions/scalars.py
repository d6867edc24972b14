"""Column -> Column scalar functions (all JVM-side, codegen friendly).

Every function here is a pure expression builder: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
# Risk band thresholds and names, and the fallback band name.
LOW_RISK_BELOW = 0.35
MODERATE_RISK_BELOW = 0.65
BAND_LOW = "LOW RISK"
BAND_MODERATE = "MODERATE RISK"
BAND_CRITICAL = "CRITICAL RISK"
BAND_FALLBACK = "DEMO VALUE"
# Scoring status values and the fallback probability.
STATUS_SUCCESS = "success"
STATUS_FALLBACK = "fallback"
FALLBACK_PROBABILITY = 0.5
# Phrases that mark a retryable session/connection error (matched lower-case).
RETRYABLE_PHRASES = (
    "no active or default spark session",
    "spark session",
    "connection refused",
    "errno 111",
    "jvm is not running",
)
# Text values read as "off" by the boolean flag parser; the default is "1".
FLAG_FALSE_VALUES = ("0", "false", "no")
FLAG_DEFAULT = "1"
# Characters JavaScript's String.prototype.trim removes (WhiteSpace and
# LineTerminator), as a regex class usable by Java and RE2 alike.
JS_TRIM_CLASS = (r"[\t\n\x{0B}\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
                 r"\x{202F}\x{205F}\x{3000}\x{FEFF}]")
# Score domain of the categorical features: integers 0..10, default 5.
DOMAIN_MIN = 0
DOMAIN_MAX = 10
DOMAIN_DEFAULT = 5


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_category(c: Column | str) -> Column:
    """F1: numeric score -> canonical category text, half-even rounding (64-bit).

    ``2.5 -> "2"``, ``3.5 -> "4"``, ``"7" -> "7"``, ``"x" -> null``.  The
    integer text is what an indexer fitted on integer columns has seen.
    """
    v = _c(c).try_cast("double")
    return F.bround(v, 0).try_cast("bigint").cast("string")


def coerce_double(c: Column | str) -> Column:
    """F1, double variant: the value is kept as a double."""
    return _c(c).try_cast("double")


def normalize_probability(c: Column | str) -> Column:
    """values in (1, 100] are percents; then clamp to [0, 1].

    Null stays null (Spark's ``least``/``greatest`` skip nulls, which would
    otherwise turn a null into a bound).  NaN compares above every number in
    Spark, so it ends at 1.0 like the reference.
    """
    v = _c(c).cast("double")
    scaled = F.when((v > 1.0) & (v <= 100.0), v / 100.0).otherwise(v)
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), scaled))
    return F.when(v.isNull(), F.lit(None).cast("double")).otherwise(clamped)


def round4(c: Column | str) -> Column:
    """result rounded to four decimals."""
    return F.round(_c(c), 4)


def risk_band(prob: Column | str, status: Column | str | None = None) -> Column:
    """band of a probability; the fallback status wins."""
    p = _c(prob)
    band = (F.when(p < LOW_RISK_BELOW, F.lit(BAND_LOW))
            .when(p < MODERATE_RISK_BELOW, F.lit(BAND_MODERATE))
            .when(p.isNotNull(), F.lit(BAND_CRITICAL)))
    if status is None:
        return band
    return F.when(_c(status) == STATUS_FALLBACK, F.lit(BAND_FALLBACK)).otherwise(band)


def label_from_name(c: Column | str) -> Column:
    """``CamelCaseName -> "Camel Case Name"``: a space before every ASCII
    capital, then leading/trailing whitespace removed as JavaScript's
    ``trim`` does (spaces, tabs, line breaks, Unicode spaces)."""
    spaced = F.regexp_replace(_c(c), "([A-Z])", " $1")
    # \A and \z: absolute input bounds (Java's $ would also match before a
    # final line terminator)
    return F.regexp_replace(spaced, rf"\A{JS_TRIM_CLASS}+|{JS_TRIM_CLASS}+\z", "")


def fixed2(c: Column | str) -> Column:
    """two-decimal display text of a 4-decimal probability.

    Rounds the decimal value half-up, so the text does not depend on the
    binary representation of the double.
    """
    return F.round(_c(c).cast("decimal(12,4)"), 2).cast("string")


def is_retryable_error(msg: Column | str) -> Column:
    """message (lower-cased) contains any retryable phrase."""
    m = F.lower(_c(msg))
    cond = None
    for phrase in RETRYABLE_PHRASES:
        hit = m.contains(phrase)
        cond = hit if cond is None else (cond | hit)
    return F.coalesce(cond, F.lit(False))


def in_domain(c: Column | str) -> Column:
    """F8: value is an integer within the score domain."""
    v = _c(c).try_cast("double")
    return F.coalesce(v.between(DOMAIN_MIN, DOMAIN_MAX) & (v == F.floor(v)), F.lit(False))


def with_domain_default(c: Column | str) -> Column:
    """F8: missing value -> the domain default."""
    return F.coalesce(_c(c).try_cast("double"), F.lit(float(DOMAIN_DEFAULT)))


def parse_flag(c: Column | str) -> Column:
    """anything except 0/false/no (any case, no trimming) is on; missing -> default."""
    v = F.lower(F.coalesce(_c(c).cast("string"), F.lit(FLAG_DEFAULT)))
    return ~v.isin(*FLAG_FALSE_VALUES)


def json_field(doc: Column | str, path: str, default: Column | None = None) -> Column:
    """field of a JSON text with a default when absent or unparsable."""
    v = F.get_json_object(_c(doc), path)
    return v if default is None else F.coalesce(v, default)


def stable_hash32(*keys: Column | str) -> Column:
    """First 32 bits of md5 over the keys' text; a null counts as empty text.

    Depends only on the keys, so it does not move when data is repartitioned,
    and it can be written identically in other SQL engines.
    """
    text = F.concat_ws("\x1f", *[F.coalesce(_c(k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
