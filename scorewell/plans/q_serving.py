"""Driver queries: nested documents, concurrent registration, streams that
follow the registry (S10, T4, T6, T8, P4, F10)."""

from __future__ import annotations

import os
import threading

from pyspark.sql import functions as F

from scorewell.functions.nested import nested_field, nested_rows
from scorewell.operators import catalog as C
from scorewell.operators.claims import claim_version, claimed_versions
from scorewell.operators.ranking import ordered_position
from scorewell.plans.flagship import fit_and_predict
from scorewell.plans.q_ops import _FLAVOR_SQL, _RUNS_CTE, EVENT_FEATURE, _runs
from scorewell.plans.registry import query
from scorewell.session import scratch_path, table
from scorewell.sources.models import save_model
from scorewell.streaming.serving import start_registry_scoring


@query("nested_documents", """
SELECT event_id, event_type, CAST(event_id % 7 AS VARCHAR) AS last_tag,
       CASE WHEN event_id % 3 = 0 THEN 'none' ELSE 'it''s # ' || event_type END AS note
FROM events""")
def nested_documents(spark, sf_dir):
    """F10 on documents nested by indentation, one for each event: lists,
    quotes, comments, a field that is missing in some."""
    ev = table(spark, sf_dir, "events")
    text = F.concat_ws(
        "\n", F.lit("event:"), F.concat(F.lit("  type: "), "event_type", F.lit("   # kind")),
        F.lit("  tags:"), F.lit("  - first"), F.concat(F.lit("  - value: "), (F.col("event_id") % 7).cast("string")),
        F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("note: 'it''s # "), "event_type", F.lit("'"))))
    rows = ev.select("event_id", nested_rows(text).alias("rows"))
    return rows.select("event_id", nested_field(F.col("rows"), "event.type").alias("event_type"),
                       nested_field(F.col("rows"), "event.tags[1].value").alias("last_tag"),
                       nested_field(F.col("rows"), "note", F.lit("none")).alias("note"))


@query("manifest_folders", f"""
WITH {_RUNS_CTE}
SELECT run_id, {_FLAVOR_SQL} AS loader_module, '3.13.1' AS python_version, n AS model_size_bytes,
       'artifacts' AS folder FROM runs""")
def manifest_folders(spark, sf_dir):
    """T6 on the real layout: an ``MLmodel`` in the ``artifacts`` folder of each
    run, at different depths, and one beside them that is not an artifact."""
    runs, _ = _runs(spark, sf_dir)
    flavor = (F.when(F.substring("experiment", 6, 1) == "A", F.lit(C.SPARK_FLAVOR))
              .when(F.substring("experiment", 6, 1) == "N", F.lit(C.SKLEARN_FLAVOR))
              .otherwise(F.lit("mlflow.pyfunc.model")))
    created = F.date_format("start_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    text = C.manifest_text(flavor, F.lit("3.13.1"), F.col("n"), F.col("run_id"), created)
    root = scratch_path(spark, "manifest_folders")
    for r in runs.select("experiment", "run_id", text.alias("text")).toLocalIterator():
        deep = f"{r.experiment}/models/" if r.experiment.endswith("R") else ""
        C.save_manifest(spark, f"{root}/{deep}{r.run_id}/artifacts", r.text)
    C.save_manifest(spark, f"{root}/drafts", "run_id: draft\n")
    found = C.manifest_catalog(spark, root, dir_name="artifacts")
    return found.select("run_id", "loader_module", "python_version", "model_size_bytes",
                        F.element_at(F.split("artifact_dir", "/"), -1).alias("folder"))


@query("registry_claims", f"""
WITH {_RUNS_CTE}, r AS (SELECT run_id, row_number() OVER (ORDER BY run_id) AS k FROM runs)
SELECT 'shared' AS name, CAST(v.k AS INTEGER) AS version, CAST(2 AS BIGINT) AS times, r.run_id
FROM r JOIN (SELECT unnest(range(1, (SELECT count(*) FROM runs) + 1)) AS k) v ON v.k = r.k""")
def registry_claims(spark, sf_dir):
    """T4 with two writers at a time: all runs registered twice under one name,
    versions 1, 2, 3, ... without gap or repeat.  Which writer gets which
    version is open, so versions and runs are each checked in order."""
    runs, _ = _runs(spark, sf_dir)
    found = [(r.run_id, r.artifact_path) for r in runs.select("run_id", "artifact_path").toLocalIterator()]
    root, failed = scratch_path(spark, "registry_claims"), []

    def register():
        try:
            for run_id, path in found:
                claim_version(spark, root, run_id, path, "shared")
        except Exception as e:  # raised again below
            failed.append(e)
    writers = [threading.Thread(target=register) for _ in range(2)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    if failed:
        raise failed[0]
    claims = claimed_versions(spark, root)
    times = claims.groupBy("name", "run_id").agg(F.count(F.lit(1)).alias("times"))
    numbered = times.select("name", "times", "run_id", F.lit(0).alias("_all"))
    numbered = ordered_position(numbered, "_all", [F.col("run_id").asc()], name="place")
    halves = claims.where(F.col("version") % 2 == 0).select((F.col("version") / 2).cast("int").alias("version"))
    odd = claims.where(F.col("version") % 2 == 1).select(((F.col("version") + 1) / 2).cast("int").alias("version"))
    return (numbered.join(halves.intersect(odd), F.col("version") == F.col("place") + 1)
            .select("name", "version", "times", "run_id"))


@query("score_stream_versions", """
WITH e AS (SELECT event_id, value, least(floor(value / 10), 10) AS s FROM events),
m AS (SELECT s, avg(value) AS mu FROM e GROUP BY s),
p AS (SELECT event_id, event_id % 2 AS half, CASE WHEN event_id % 2 = 0 THEN mu ELSE mu / 2 END AS mu
      FROM e JOIN m ON e.s = m.s)
SELECT event_id, 'registry' AS model_source, CAST(half + 1 AS INTEGER) AS model_version,
       round(greatest(0.0, least(1.0, CASE WHEN mu > 1 AND mu <= 100 THEN mu / 100 ELSE mu END)), 4) AS probability
FROM p""")
def score_stream_versions(spark, sf_dir):
    """P4 + T8: a version registered between two triggers scores from the next
    batch on; a broken newer one is passed over."""
    root = scratch_path(spark, "score_stream_versions")
    ev = table(spark, sf_dir, "events").withColumn("risk_score", F.least(F.floor(F.col("value") / 10), F.lit(10)))
    for name, share in (("whole", 1.0), ("half", 0.5)):
        prep, lr, _ = fit_and_predict(ev.withColumn("value", F.col("value") * share), [EVENT_FEATURE], "value")
        save_model(prep, f"{root}/{name}/preprocessor")
        save_model(lr, f"{root}/{name}/model")
    rows = ev.select("event_id", "risk_score")
    source = os.path.join(root, "in")
    claim_version(spark, root, "whole", f"{root}/whole/model", "events")
    rows.where("event_id % 2 = 0").write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    q = start_registry_scoring(stream, root, "events", f"{root}/out", f"{root}/checkpoint", ["event_id"],
                               available_now=False)
    try:
        q.processAllAvailable()
        claim_version(spark, root, "half", f"{root}/half/model", "events")
        claim_version(spark, root, "lost", f"{root}/lost/model", "events")
        rows.where("event_id % 2 = 1").write.mode("append").parquet(source)
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.read.parquet(f"{root}/out").select("event_id", "model_source", "model_version", "probability")
