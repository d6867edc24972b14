"""Scoring records kept whole (S7, F10): parsed once to ``variant``.

``validate_records`` reads named fields and forgets the rest.  Here a record's
text is parsed once; required fields, at any depth, are typed gets on the
parsed value and go through the same checks, and every other field stays.

Edge cases: a null text and a record that lacks a field are "missing"; a text
that is not a JSON object (or names one field twice) is "not a JSON object"
and has no other fields; a JSON null is missing; an object or list where a
number should be is not a number; dots in a path go down, so a field whose own
name has a dot cannot be asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewell.sources.records import validate_fields


def _free(name: str, taken: Sequence[str]) -> str:
    while name in taken:
        name += "_"
    return name


def json_path(field: str) -> str:
    """``a.b`` as a path of quoted names, so names may hold blanks or dollars."""
    return "$" + "".join(f'["{part}"]' for part in field.split("."))


def variant_text(record: Column, field: str) -> Column:
    """A field of a parsed record as text; missing and JSON null give null."""
    return F.try_variant_get(record, json_path(field), "string")


def validate_variants(df: DataFrame, json_col: str, fields: Sequence[str], keep: Sequence[str] = (),
                      others_col: str = "others") -> DataFrame:
    """``keep``, one double per field (a nested one under its whole path),
    ``others_col`` (the record's other top-level fields, name -> JSON text),
    ``error`` and ``valid``.

    A top-level field goes to ``others_col`` unless a required path starts there.
    """
    record, text = _free("record", [*df.columns, *fields]), _free("given", [*df.columns, *fields])
    parsed = df.select(*keep, F.col(json_col).isNotNull().alias(text), F.try_parse_json(json_col).alias(record))
    top = F.try_variant_get(record, "$", "map<string,variant>")
    heads = sorted({f.split(".")[0] for f in fields})
    rest = F.map_filter(F.transform_values(top, lambda _, v: F.to_json(v)), lambda k, _: ~k.isin(heads))
    unread = F.col(text) & top.isNull()
    read = parsed.select(*keep, rest.alias(others_col), unread.alias(text),
                         *[variant_text(F.col(record), f).alias(f) for f in fields])
    checked = validate_fields(read, fields, keep=[*keep, others_col, text])
    error = F.when(F.col(text), F.lit("not a JSON object")).otherwise(F.col("error"))
    return (checked.withColumn("error", error).withColumn("valid", F.col("error").isNull())
            .select(*keep, *[F.col(f"`{f}`") for f in fields], others_col, "error", "valid"))
