"""Nested text documents as (path, value) rows, in the JVM.

Parameter files and model manifests nest by indentation::

    model:
      cv: 5
      tags:
      - a
      - name: b

One fold over the lines carries a stack of (indent, path) and gives one row
for each value: ``model.cv`` = ``5``, ``model.tags[0]`` = ``a``,
``model.tags[1].name`` = ``b``.  Values are text: quotes are taken off, a
comment after a plain value too, ``null`` and ``~`` read as null.  A quoted or
plain value may go on over further lines (joined by a blank).  Flow
collections (``[a, b]``) stay as they are written.  A key without a value
opens a level and gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_STACK = "array<struct<indent:int,path:string>>"
_ROWS = "array<struct<path:string,value:string>>"
_STATE = f"struct<stack:{_STACK},rows:{_ROWS},items:map<string,int>>"

# a key ends at the first colon before white space or the end of the line
_KEY = r"""^('[^']*'|"[^"]*"|[^'"\s].*?):(?:\s.*)?$"""
_AFTER_KEY = r"""^(?:'[^']*'|"[^"]*"|[^'"\s].*?):(?:\s+(.*))?$"""
# a value that begins with a quote and has not come to its end
_OPEN = r"""(?s)^(?:'(?:[^']|'')*|"(?:[^"\\]|\\.)*)$"""


def _plain(raw: Column) -> Column:
    single = F.replace(F.regexp_extract(raw, r"(?s)^'(.*)'\s*(?:#.*)?$", 1), F.lit("''"), F.lit("'"))
    double = F.regexp_replace(F.regexp_extract(raw, r'(?s)^"(.*)"\s*(?:#.*)?$', 1), r'\\(["\\])', "$1")
    bare = F.trim(F.regexp_replace(raw, r"\s+#.*$", ""))
    return (F.when(raw.startswith("'"), single).when(raw.startswith('"'), double)
            .when(bare.isin("null", "~", "Null", "NULL", ""), F.lit(None).cast("string")).otherwise(bare))


def _some(condition: Column, item: Column, kind: str) -> Column:
    """An array of the item, empty where the condition does not hold."""
    return F.when(condition, F.array(item).cast(kind)).otherwise(F.array().cast(kind))


def _line(state: Column, line: Column) -> Column:
    stack, rows, items = state["stack"], state["rows"], state["items"]
    indent = (F.length(line) - F.length(F.ltrim(line))).cast("int")
    item = line.rlike(r"^\s*-(?:\s|$)")
    body = F.when(item, F.regexp_replace(F.trim(line), r"^-\s*", "")).otherwise(F.trim(line))
    key = F.regexp_extract(body, _KEY, 1)
    keyed = key != ""
    raw = F.when(keyed, F.regexp_extract(body, _AFTER_KEY, 1)).otherwise(body)
    # a list may stand as deep as the key it belongs to
    above = F.filter(stack, lambda e: (e["indent"] < indent) | (item & (e["indent"] == indent)))
    parent = F.coalesce(F.try_element_at(above, F.lit(-1))["path"], F.lit(""))
    place = F.coalesce(F.try_element_at(items, parent), F.lit(0))
    base = F.when(item, F.concat(parent, F.lit("["), place.cast("string"), F.lit("]"))).otherwise(parent)
    path = F.when(keyed, F.concat_ws(".", F.nullif(base, F.lit("")), _plain(key))).otherwise(base)
    deeper = F.concat(
        above, _some(item, F.struct((indent + 1).alias("indent"), base.alias("path")), _STACK),
        _some(keyed, F.struct(F.when(item, indent + 2).otherwise(indent).alias("indent"), path.alias("path")), _STACK))
    counted = F.when(item, F.map_concat(F.map_filter(items, lambda k, v: k != parent),
                                        F.create_map(parent, (place + 1).cast("int")))).otherwise(items)
    new = F.struct(deeper.alias("stack"), F.concat(rows, _some(
        raw != "", F.struct(path.alias("path"), raw.alias("value")), _ROWS)).alias("rows"), counted.alias("items"))
    last = F.try_element_at(rows, F.lit(-1))
    longer = F.struct(last["path"].alias("path"), F.concat(last["value"], F.lit(" "), F.trim(line)).alias("value"))
    on = F.struct(stack.alias("stack"), F.concat(F.slice(rows, F.lit(1), F.greatest(F.size(rows) - 1, F.lit(0))),
                                                 F.array(longer).cast(_ROWS)).alias("rows"), items.alias("items"))
    open_ = F.coalesce(last["value"].rlike(_OPEN), F.lit(False))
    below = F.coalesce(F.try_element_at(stack, F.lit(-1))["indent"] < indent, F.lit(False)) & (F.size(rows) > 0)
    skip = line.rlike(r"^\s*(?:#.*)?$") | line.rlike(r"^(?:---|\.\.\.)\s*$")
    return (F.when(open_, on.cast(_STATE)).when(skip, state).when(~keyed & ~item & below, on.cast(_STATE))
            .otherwise(new.cast(_STATE)))


def nested_rows(text: Column) -> Column:
    """The rows of one document as an array of (path, value); none for null text."""
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\r", ""), "\n")
    start = F.struct(F.array().cast(_STACK).alias("stack"), F.array().cast(_ROWS).alias("rows"),
                     F.create_map().cast("map<string,int>").alias("items")).cast(_STATE)
    return F.aggregate(lines, start, _line, lambda s: F.transform(
        s["rows"], lambda r: F.struct(r["path"].alias("path"), _plain(r["value"]).alias("value"))))


def nested_field(rows: Column, path: str, default: Column | None = None) -> Column:
    """the value at a path of ``nested_rows``; null or missing gives the default."""
    value = F.get(F.filter(rows, lambda r: r["path"] == path), 0)["value"]
    return value if default is None else F.coalesce(value, default)


def read_nested(spark: SparkSession, root: str, file_glob: str = "*.yaml") -> DataFrame:
    """file, mtime, path, value of every document under ``root``, at any depth."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", file_glob).load(root))
    return files.select(F.col("path").alias("file"), F.col("modificationTime").alias("mtime"), F.explode(
        nested_rows(F.col("content").cast("string"))).alias("row")).select("file", "mtime", "row.path", "row.value")
