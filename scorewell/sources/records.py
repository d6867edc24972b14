"""Scoring records.

Records arrive as JSON text (files, a stream, or a text column).  Every
required field is read as text first and converted with ``try_cast`` so a
bad value flags the row instead of failing the job (Spark 4 runs with ANSI
casts).  Valid rows carry doubles; invalid rows carry the reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: A decimal number (or a name of NaN and the infinities, which are rejected
#: as not finite); Java's suffixes and hexadecimal floats are not numbers here.
NUMBER = r"^(?i)[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|nan|inf|infinity)$"


def text_schema(fields: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType(), True) for f in fields])


def parse_records(json_text: Column, fields: Sequence[str]) -> Column:
    """Struct of the required fields as raw text (missing -> null)."""
    return F.from_json(json_text, text_schema(fields), {"mode": "PERMISSIVE"})


def validate_records(df: DataFrame, json_col: str, fields: Sequence[str],
                     keep: Sequence[str] = ()) -> DataFrame:
    """Typed fields + ``valid`` + ``error`` per record.

    ``error`` names the first field that is missing or not a number.
    """
    parsed = df.select(*keep, parse_records(F.col(json_col), fields).alias("_r"))
    return validate_fields(parsed.select(*keep, "_r.*"), fields, keep)


def validate_fields(df: DataFrame, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """S7 on text columns (records read with ``text_schema``).

    NaN and infinities parse as doubles but cannot become a score (the
    integer conversion fails), so they are rejected as well.
    """
    def number(f):
        text = F.trim(F.col(f"`{f}`"))
        return F.when(text.rlike(NUMBER), text.try_cast("double"))

    def finite(v):
        return ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))

    typed = [number(f).alias(f) for f in fields]
    checks = F.coalesce(*[
        F.when(F.col(f"`{f}`").isNull(), F.lit(f"missing {f}"))
         .when(number(f).isNull(), F.lit(f"not a number: {f}"))
         .when(~finite(number(f)), F.lit(f"not a finite number: {f}"))
        for f in fields])
    return df.select(*keep, *typed, checks.alias("error")).withColumn(
        "valid", F.col("error").isNull())


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the check columns, rejects with ``error``)."""
    valid = checked.where(F.col("valid")).drop("valid", "error")
    rejects = checked.where(~F.col("valid")).drop("valid")
    return valid, rejects


def records_to_frame(df: DataFrame, json_col: str, schema: T.StructType,
                     keep: Sequence[str] = ()) -> DataFrame:
    """JSON record text -> typed columns of ``schema`` (JVM-side parse)."""
    parsed = df.select(*keep, F.from_json(F.col(json_col), schema).alias("_r"))
    return parsed.select(*keep, *[F.col(f"_r.`{f.name}`").alias(f.name) for f in schema.fields])
