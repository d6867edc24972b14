"""Driver queries: profiles from stored sketches, records kept whole, models of
any flavor (R4, S7, F10, T7, T8, P2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorewell.operators import catalog as C
from scorewell.operators.flavors import manifest_of, save_python_model, save_spark_model, score_resolved
from scorewell.operators.scoring import GroupMeanModel
from scorewell.operators.sketches import current_states, merged_profile, quantile, update_profile
from scorewell.plans.flagship import fit_and_predict
from scorewell.plans.q_ops import EVENT_FEATURE
from scorewell.plans.registry import query
from scorewell.session import scratch_path, table
from scorewell.sources.variants import validate_variants

_PROFILED = [("l_partkey", "bigint"), ("l_quantity", "double"), ("l_extendedprice", "double"),
             ("l_returnflag", "string"), ("l_shipdate", "timestamp_ntz"), ("note", "string")]


@query("profile_merged", " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS col_name, '{t}' AS data_type, count(*) AS n_rows, "
    f"count(*) - count({c}) AS n_null, CAST(3 AS BIGINT) AS n_scans, true AS distinct_near, "
    f"{'true' if t in ('bigint', 'double') else 'CAST(NULL AS BOOLEAN)'} AS median_near "
    "FROM (SELECT *, nullif(l_linestatus, 'F') AS note FROM lineitem)" for i, (c, t) in enumerate(_PROFILED)))
def profile_merged(spark, sf_dir):
    """R4 from sketches: three batches of files, each scanned once, and a fourth
    update that finds nothing new.  The estimates are held against exact counts:
    distinct values within 4 %, the median's rank within 2 %."""
    names = [c for c, _ in _PROFILED]
    li = table(spark, sf_dir, "lineitem").withColumn("note", F.nullif("l_linestatus", F.lit("F"))).select(*names)
    root = scratch_path(spark, "profile")
    data, states, scans = f"{root}/data", f"{root}/states", 0
    for k in range(3):
        li.where(F.col("l_partkey") % 3 == k).write.mode("append").parquet(data)
        scans += update_profile(spark, data, states) > 0
    scans += update_profile(spark, data, states) > 0
    merged = merged_profile(current_states(spark, data, states)).withColumn("median", quantile(0.5))
    merged.drop("distinct_sketch", "quantile_sketch").write.parquet(f"{root}/merged")
    merged = spark.read.parquet(f"{root}/merged")
    medians = {r.col_name: r.median for r in merged.where("median is not null").collect()}  # one row a column
    ranks = [F.struct(F.lit(c).alias("c"), F.count_distinct(c).alias("exact"), *(
        [F.avg((F.col(c) < medians[c]).cast("int")).alias("below"), F.avg((F.col(c) <= medians[c]).cast("int")).alias("upto")]
        if c in medians else [F.lit(None).cast("double").alias("below"), F.lit(None).cast("double").alias("upto")])).alias(c)
        for c in names]
    exact = li.agg(*ranks).select(F.inline(F.array(*[F.col(c) for c in names])))
    both = merged.join(F.broadcast(exact), merged["col_name"] == exact["c"])
    return both.select(
        "position", "col_name", "data_type", "n_rows", "n_null", F.lit(scans).cast("long").alias("n_scans"),
        (F.abs(F.col("n_distinct") - F.col("exact")) <= 0.04 * F.col("exact")).alias("distinct_near"),
        ((F.col("below") <= 0.52) & (F.col("upto") >= 0.48)).alias("median_near"))


_REC_SQL = """WITH r AS (SELECT event_id, event_type, user_id,
  CASE WHEN event_type = 'error' THEN replace(props, '"k"', '"q"')
       WHEN event_type = 'view' THEN replace(replace(props, ': ', ': "x'), '}', '"}') ELSE props END AS rec FROM events)"""


@query("variant_record_validate", _REC_SQL + """
SELECT event_id, CASE WHEN event_type IN ('click', 'signup') THEN CAST(json_extract_string(rec, '$.k') AS DOUBLE) END AS k,
  CASE event_type WHEN 'purchase' THEN 'not a JSON object' WHEN 'error' THEN 'missing request.k'
                  WHEN 'view' THEN 'not a number: request.k' END AS error,
  event_type IN ('click', 'signup') AS valid,
  CASE WHEN event_type <> 'purchase' THEN '"' || event_type || '"' END AS source,
  CASE WHEN event_type <> 'purchase' THEN '[' || CAST(user_id AS VARCHAR) || ',null]' END AS tags,
  CASE WHEN event_type <> 'purchase' THEN 2 END AS n_others
FROM r""")
def variant_record_validate(spark, sf_dir):
    """S7 + F10 on records with a nested field and others that are kept; those
    of purchases are cut off before their last brace."""
    ev = table(spark, sf_dir, "events")
    inner = (F.when(F.col("event_type") == "error", F.replace("props", F.lit('"k"'), F.lit('"q"')))
             .when(F.col("event_type") == "view",
                   F.replace(F.replace("props", F.lit(": "), F.lit(': "x')), F.lit("}"), F.lit('"}')))
             .otherwise(F.col("props")))
    end = F.when(F.col("event_type") == "purchase", F.lit("")).otherwise(F.lit("}"))
    rec = F.concat(F.lit('{"source": "'), "event_type", F.lit('", "request": '), inner, F.lit(', "tags": ['),
                   F.col("user_id").cast("string"), F.lit(", null]"), end)
    out = validate_variants(ev.select("event_id", rec.alias("rec")), "rec", ["request.k"], keep=["event_id"])
    return out.select("event_id", F.col("`request.k`").alias("k"), "error", "valid", F.col("others")["source"].alias("source"),
                      F.col("others")["tags"].alias("tags"),
                      F.when(F.col("others").isNotNull(), F.size("others")).alias("n_others"))


@query("score_flavors", """
WITH e AS (SELECT event_id, value, least(floor(value / 10), 10) AS s FROM events),
m AS (SELECT s, avg(value) AS mu FROM e GROUP BY s),
p AS (SELECT event_id, event_id % 2 AS half, CASE WHEN event_id % 2 = 0 THEN mu ELSE mu / 2 END AS mu
      FROM e JOIN m ON e.s = m.s)
SELECT event_id, CASE WHEN half = 0 THEN 'mlflow.spark' ELSE 'mlflow.sklearn' END AS loader,
       round(greatest(0.0, least(1.0, CASE WHEN mu > 1 AND mu <= 100 THEN mu / 100 ELSE mu END)), 4) AS probability
FROM p""")
def score_flavors(spark, sf_dir):
    """T7 + T8 + P2: one folder of artifacts, both modes.  Even events are scored
    in Spark mode, odd ones without it, by a Python model of half the value;
    broken artifacts of both flavors and one without a loader are passed over."""
    root = scratch_path(spark, "score_flavors")
    ev = table(spark, sf_dir, "events").withColumn("risk_score", F.least(F.floor(F.col("value") / 10), F.lit(10)))
    prep, lr, _ = fit_and_predict(ev, [EVENT_FEATURE], "value")
    half = GroupMeanModel.fit(ev.withColumn("value", F.col("value") / 2), EVENT_FEATURE, "value")
    save_spark_model(spark, prep, lr, f"{root}/a/artifacts", "whole")
    save_python_model(spark, half, [EVENT_FEATURE], f"{root}/deep/b/artifacts", "half")
    for i, flavor in enumerate((C.SPARK_FLAVOR, C.SKLEARN_FLAVOR, "models.unknown")):
        C.save_manifest(spark, f"{root}/broken{i}/artifacts", manifest_of(flavor, f"broken{i}"))
    rows = ev.select("event_id", "risk_score")
    out = []
    for part, load_spark in ((0, True), (1, False)):
        loader, scored = score_resolved(rows.where(F.col("event_id") % 2 == part), root, load_spark, ["event_id"])
        out.append(scored.select("event_id", F.lit(loader).alias("loader"), "probability"))
    return out[0].unionByName(out[1])
