"""Driver queries: sources/sinks, row operators and scalar functions."""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewell.functions import scalars as S
from scorewell.operators import rows as R
from scorewell.plans.registry import query
from scorewell.session import scratch_path, table
from scorewell.sources import files as SRC
from scorewell.sources.records import records_to_frame, validate_records

# ---------------------------------------------------------------- sources / sinks

_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query("csv_roundtrip", """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
       o_orderstatus, o_totalprice, o_orderpriority FROM orders""")
def csv_roundtrip(spark, sf_dir):
    """Write CSV with header, read the folder back with inference."""
    out = scratch_path(spark, "csv_roundtrip")
    SRC.write_csv(table(spark, sf_dir, "orders").select(*_ORDER_COLS), out)
    return SRC.read_csv(spark, out, infer_schema=True)


@query("parquet_scan", """
SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice FROM lineitem
WHERE l_returnflag = 'R' AND l_quantity > 10""")
def parquet_scan(spark, sf_dir):
    """Filter and projection pushed into the Parquet reader."""
    li = SRC.read_parquet(spark, os.path.join(sf_dir, "lineitem.parquet"))
    return li.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 10)).select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")


@query("parquet_roundtrip", "SELECT * FROM orders")
def parquet_roundtrip(spark, sf_dir):
    """S3: overwrite sink, twice into the same path, then read back."""
    out = scratch_path(spark, "parquet_roundtrip")
    orders = table(spark, sf_dir, "orders")
    SRC.write_parquet(orders.where(F.col("o_orderstatus") == "F"), out)
    SRC.write_parquet(orders, out)  # second write overwrites, does not fail
    return SRC.read_parquet(spark, out)


@query("ingest_idempotent", "SELECT * FROM orders WHERE o_orderstatus = 'O'")
def ingest_idempotent(spark, sf_dir):
    """A second ingest into a non-empty path is skipped."""
    out = scratch_path(spark, "ingest")
    orders = table(spark, sf_dir, "orders")
    SRC.ingest(spark, orders.where(F.col("o_orderstatus") == "O"), out)
    return SRC.ingest(spark, orders.where(F.col("o_orderstatus") != "O"), out)


@query("ingest_first_source", "SELECT * FROM customer")
def ingest_first_source(spark, sf_dir):
    """The first readable candidate wins; missing paths are skipped."""
    out = scratch_path(spark, "ingest_first")
    missing = scratch_path(spark, "missing_source")
    return SRC.ingest_first_source(
        spark, [missing, os.path.join(sf_dir, "customer.parquet")], out)


_RECORD_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()), T.StructField("l_returnflag", T.StringType())])


@query("record_to_frame", """
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem""")
def record_to_frame(spark, sf_dir):
    """JSON record text -> typed frame, parsed in the JVM."""
    li = table(spark, sf_dir, "lineitem")
    text = li.select(F.to_json(F.struct("l_orderkey", "l_linenumber", "l_quantity",
                                        "l_returnflag")).alias("rec"))
    return records_to_frame(text, "rec", _RECORD_SCHEMA)


@query("json_record_validate", """
WITH r AS (SELECT event_id,
  CASE WHEN event_type = 'error' THEN replace(props, '"k"', '"q"')
       WHEN event_type = 'view' THEN replace(replace(props, ': ', ': "x'), '}', '"}')
       ELSE props END AS rec FROM events)
SELECT event_id,
  TRY_CAST(json_extract_string(rec, '$.k') AS DOUBLE) AS k,
  CASE WHEN json_extract_string(rec, '$.k') IS NULL THEN 'missing k'
       WHEN TRY_CAST(json_extract_string(rec, '$.k') AS DOUBLE) IS NULL THEN 'not a number: k'
       WHEN NOT isfinite(TRY_CAST(json_extract_string(rec, '$.k') AS DOUBLE))
         THEN 'not a finite number: k'
  END AS error,
  coalesce(isfinite(TRY_CAST(json_extract_string(rec, '$.k') AS DOUBLE)), false) AS valid
FROM r""")
def json_record_validate(spark, sf_dir):
    """Required fields read as text, typed with try_cast, bad rows flagged."""
    ev = table(spark, sf_dir, "events")
    rec = (F.when(F.col("event_type") == "error", F.replace("props", F.lit('"k"'), F.lit('"q"')))
           .when(F.col("event_type") == "view",
                 F.replace(F.replace("props", F.lit(": "), F.lit(': "x')), F.lit("}"), F.lit('"}')))
           .otherwise(F.col("props")))
    return validate_records(ev.select("event_id", rec.alias("rec")), "rec", ["k"],
                            keep=["event_id"])


# ---------------------------------------------------------------- rows

@query("dropna_subset", """
SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice FROM orders
WHERE nullif(o_orderstatus, 'P') IS NOT NULL""")
def dropna_subset(spark, sf_dir):
    """Rows with a null in the subset are dropped."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"), "o_totalprice")
    return R.drop_null_rows(o, ["o_orderstatus"])


@query("select_by_exclusion", "SELECT p_name, p_brand, p_type, p_size FROM part")
def select_by_exclusion(spark, sf_dir):
    """R2: all columns but the id and the target."""
    part = table(spark, sf_dir, "part")
    return part.select(*R.feature_columns(part, "p_retailprice", ["p_partkey"]))


@query("project_alias", "SELECT p_brand AS features, p_retailprice AS label FROM part")
def project_alias(spark, sf_dir):
    """Project + rename the target to ``label``."""
    return R.project_features_label(table(spark, sf_dir, "part"), F.col("p_brand").alias("features"),
                                    "p_retailprice")


_PROFILE_COLS = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                 ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                 ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                 ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]


@query("schema_profile", " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS col_name, '{t}' AS data_type, "
    f"count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct FROM lineitem"
    for i, (c, t) in enumerate(_PROFILE_COLS)))
def schema_profile(spark, sf_dir):
    """Schema rows with null and distinct counts, one aggregate job."""
    return R.column_profile(table(spark, sf_dir, "lineitem"))


@query("row_count", "SELECT count(*) AS n_rows FROM orders")
def row_count(spark, sf_dir):
    """R5."""
    return R.row_count(table(spark, sf_dir, "orders"))


@query("preview_topn", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""")
def preview_topn(spark, sf_dir):
    """First rows in a stated order (top-k)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return R.preview(o, 5, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


_SPLIT_KEY = "coalesce(CAST(nullif(o_orderkey % 50, 7) * 1000 + o_orderkey AS VARCHAR), '')"
_SPLIT_SQL = f"('0x' || substr(md5({_SPLIT_KEY}), 1, 8))::BIGINT >= 0.8 * 4294967296"


def _split_orders(spark, sf_dir):
    """``orders`` with a key that is null in every fiftieth row or so."""
    return table(spark, sf_dir, "orders").withColumn("k", F.expr(
        "nullif(o_orderkey % 50, 7) * 1000 + o_orderkey"))


@query("split_hash", f"""
SELECT CASE WHEN {_SPLIT_SQL} THEN 'test' ELSE 'train' END AS split,
       count(*) AS n, round(sum(o_totalprice), 2) AS sum_totalprice
FROM orders GROUP BY 1""")
def split_hash(spark, sf_dir):
    """Key-hash split, null keys included; sizes and sums of the two parts."""
    train, test = R.hash_split(_split_orders(spark, sf_dir), "k", 0.2)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                     F.round(F.sum("o_totalprice"), 2).alias("sum_totalprice"))


@query("split_flag", f"""
SELECT o_orderkey, CASE WHEN {_SPLIT_SQL} THEN 'test' ELSE 'train' END AS split FROM orders""")
def split_flag(spark, sf_dir):
    """The same split as a flag on every row."""
    return R.with_split_flag(_split_orders(spark, sf_dir), "k", 0.2).select("o_orderkey", "split")


@query("split_random_sizes", """
SELECT count(*) AS n_total, CAST(0 AS BIGINT) AS n_in_both, CAST(0 AS BIGINT) AS n_in_none,
       true AS near_fraction FROM orders""")
def split_random_sizes(spark, sf_dir):
    """Seeded ``randomSplit``: what holds on every layout.  Its parts add up
    to the table, share no key and are near the asked sizes."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    train, test = R.random_split(o, 0.2, 42)
    sides = train.withColumn("t", F.lit(0)).unionByName(test.withColumn("t", F.lit(1)))
    per = o.withColumn("t", F.lit(None).cast("int")).unionByName(sides).groupBy("o_orderkey").agg(
        F.count("t").alias("parts"), F.sum("t").alias("tests"))
    spread = F.abs(F.avg("tests") - 0.2) < F.lit(6 * 0.4) / F.sqrt(F.count(F.lit(1)))
    return per.agg(F.count(F.lit(1)).alias("n_total"),
                   F.count(F.when(F.col("parts") > 1, 1)).alias("n_in_both"),
                   F.count(F.when(F.col("parts") == 0, 1)).alias("n_in_none"),
                   spread.alias("near_fraction"))


# ---------------------------------------------------------------- scalars

@query("coerce_category", """
SELECT CAST(CAST(round_even(l_quantity / 2, 0) AS BIGINT) AS VARCHAR) AS category,
       count(*) AS n, round(sum(l_quantity), 2) AS sum_qty
FROM lineitem GROUP BY 1""")
def coerce_category(spark, sf_dir):
    """half-even rounding to integer text (halves force ties)."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(S.coerce_category(F.col("l_quantity") / 2).alias("category")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("sum_qty"))


_NORM_SQL = ("round(greatest(0.0, least(1.0, CASE WHEN value > 1 AND value <= 100 "
             "THEN value / 100 ELSE value END)), 4)")


@query("normalize_probability", f"SELECT event_id, {_NORM_SQL} AS probability FROM events")
def normalize_probability(spark, sf_dir):
    """percent reading, clamp, 4 decimals."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", S.round4(S.normalize_probability("value")).alias("probability"))


_BAND_SQL = ("CASE WHEN {p} < 0.35 THEN 'LOW RISK' WHEN {p} < 0.65 THEN 'MODERATE RISK' "
             "ELSE 'CRITICAL RISK' END")


@query("risk_band", f"""
SELECT event_id, p AS probability, {_BAND_SQL.format(p='p')} AS band,
       CAST(round(CAST(p AS DECIMAL(12,4)), 2) AS VARCHAR) AS display
FROM (SELECT event_id, {_NORM_SQL} AS p FROM events) t""")
def risk_band(spark, sf_dir):
    """band and two-decimal display text."""
    ev = table(spark, sf_dir, "events")
    p = S.round4(S.normalize_probability("value"))
    return ev.select("event_id", p.alias("probability"), S.risk_band(p).alias("band"),
                     S.fixed2(p).alias("display"))


@query("risk_band_counts", f"""
SELECT {_BAND_SQL.format(p='p')} AS band, count(*) AS n, round(avg(p), 6) AS avg_probability
FROM (SELECT {_NORM_SQL} AS p FROM events) t GROUP BY 1""")
def risk_band_counts(spark, sf_dir):
    """rows per band."""
    p = S.round4(S.normalize_probability("value"))
    ev = table(spark, sf_dir, "events").select(p.alias("p"))
    return ev.groupBy(S.risk_band("p").alias("band")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("p"), 6).alias("avg_probability"))


@query("label_from_name", r"""
SELECT conv_id, turn,
       regexp_replace(regexp_replace(text, '([A-Z])', ' \1', 'g'), '\ACLS+|CLS+\z', '', 'g') AS label
FROM conversations""".replace("CLS", S.JS_TRIM_CLASS))
def label_from_name(spark, sf_dir):
    """space before every capital, trimmed, over whole texts."""
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", S.label_from_name("text").alias("label"))


_MESSAGES = ", ".join(f"'{p.title()}'" for p in S.RETRYABLE_PHRASES)
_RETRY_SQL = " OR ".join(f"contains(lower(m), '{p}')" for p in S.RETRYABLE_PHRASES)


@query("retryable_errors", f"""
SELECT doc_id, ({_RETRY_SQL}) AS retryable FROM (
  SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || ': ' || ([{_MESSAGES}])[doc_id % {len(S.RETRYABLE_PHRASES)} + 1]
         || ' ' || text ELSE text END AS m FROM documents) t""")
def retryable_errors(spark, sf_dir):
    """retryable-error predicate over whole texts; every third one has a
    phrase in mixed case spliced in."""
    phrases = F.array(*[F.lit(p.title()) for p in S.RETRYABLE_PHRASES])
    phrase = F.get(phrases, (F.col("doc_id") % len(S.RETRYABLE_PHRASES)).cast("int"))
    m = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(": "), phrase, F.lit(" "), "text")).otherwise(
        F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", S.is_retryable_error(m).alias("retryable"))


@query("domain_check", """
SELECT (s BETWEEN 0 AND 10) AND s = floor(s) AS in_domain, count(*) AS n,
       round(sum(coalesce(nullif(s, 2.0), 5.0)), 2) AS sum_filled
FROM (SELECT l_quantity / 5 AS s FROM lineitem) t GROUP BY 1""")
def domain_check(spark, sf_dir):
    """F8: integer 0..10 domain; missing values take the default 5."""
    li = table(spark, sf_dir, "lineitem").select((F.col("l_quantity") / 5).alias("s"))
    return li.groupBy(S.in_domain("s").alias("in_domain")).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(S.with_domain_default(F.expr("nullif(s, 2.0)"))), 2).alias("sum_filled"))


@query("flag_parse", """
SELECT doc_id,
  lower(coalesce(CAST(quality AS VARCHAR), '1')) NOT IN ('0', 'false', 'no') AS quality_on,
  lower(coalesce(CASE WHEN toxic = 1 THEN 'Yes' ELSE 'NO' END, '1')) NOT IN ('0', 'false', 'no') AS toxic_on
FROM labels""")
def flag_parse(spark, sf_dir):
    """flag text parsing (0/false/no are off, any case)."""
    lab = table(spark, sf_dir, "labels")
    toxic_text = F.when(F.col("toxic") == 1, F.lit("Yes")).otherwise(F.lit("NO"))
    return lab.select("doc_id", S.parse_flag(F.col("quality").cast("string")).alias("quality_on"),
                      S.parse_flag(toxic_text).alias("toxic_on"))


@query("json_field", """
SELECT event_id, coalesce(json_extract_string(props, '$.k'), '-1') AS k,
       coalesce(json_extract_string(props, '$.missing'), 'none') AS missing
FROM events""")
def json_field(spark, sf_dir):
    """nested field with a default."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", S.json_field("props", "$.k", F.lit("-1")).alias("k"),
                     S.json_field("props", "$.missing", F.lit("none")).alias("missing"))
