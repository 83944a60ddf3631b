"""Lake queries: filters, facets, pages, annotation versions."""

from pyspark.sql import functions as F

from tracemill.functions import numbers, recordings as rec, text
from tracemill.operators import indices, lake, registry, tag_index
from tracemill.session import materialise
from workload import views as v
from workload.registry import query

COLUMNS = ["recording_id", "task", "type", "frames", "qa", "device", "operator"]
SELECTED = "SELECT recording_id, task, type, frames, qa, device, operator FROM fx_recordings"


@query("FLT1", SELECTED + """ WHERE task IN ('t1', 't2') AND list_has_any(tags, ['do_grasp', 'q_review']) AND device = 'dev_a'
  AND operator IN ('op_a', 'op_b') AND type IN ('normal', 'dagger') AND qa IN ('pass', 'warn')
  AND CAST(collected_at AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""")
def flt1(spark, d):
    return lake.query_recordings(
        v.recordings(spark, d), tasks=["t1", "t2"], tags=["do_grasp", "q_review"], device="dev_a", operators=["op_a", "op_b"],
        types=["normal", "dagger"], qas=["pass", "warn"], first_day="1996-01-01", last_day="2000-12-31",
    ).select(*COLUMNS)


@query("FLT2", SELECTED + " WHERE list_has_any(tags, ['do_fill', 'q_review'])")
def flt2(spark, d):
    return lake.query_recordings(v.recordings(spark, d), tags=["do_fill", "q_review"]).select(*COLUMNS)


@query("FLT3", SELECTED + " WHERE list_contains(tags, 'do_grasp') AND list_contains(tags, 'q_review')")
def flt3(spark, d):
    return lake.query_recordings(v.recordings(spark, d), tags=["do_grasp", "q_review"], tag_mode="all").select(*COLUMNS)


def indexed(spark, d):
    """The tag index of all recordings, written once."""
    return materialise(tag_index.tag_index(v.recordings(spark, d)))


@query("FLT2_index", same="FLT2")
def flt2_index(spark, d):
    chosen = tag_index.any_of(indexed(spark, d), ["do_fill", "q_review"])
    return tag_index.having(v.recordings(spark, d), chosen).select(*COLUMNS)


@query("FLT3_index", same="FLT3")
def flt3_index(spark, d):
    chosen = tag_index.all_of(indexed(spark, d), ["do_grasp", "q_review"])
    return tag_index.having(v.recordings(spark, d), chosen).select(*COLUMNS)


@query("AGG13_index", "SELECT tag, count(*) AS episodes FROM (SELECT DISTINCT recording_id, unnest(tags) AS tag FROM fx_recordings) t GROUP BY tag")
def agg13_index(spark, d):
    return tag_index.tag_totals(indexed(spark, d))


@query("FLT4", SELECTED + " WHERE strftime(collected_at, '%Y-%m-%d') >= '1997-03-01' AND strftime(collected_at, '%Y-%m-%d') <= '1997-09-30'")
def flt4(spark, d):
    return lake.query_recordings(v.recordings(spark, d), first_day="1997-03-01", last_day="1997-09-30").select(*COLUMNS)


@query("FLT5", """SELECT event_id, user_id, event_type FROM events
  WHERE ts >= TIMESTAMP '2024-01-05 12:30:00' AND ts <= TIMESTAMP '2024-01-20 23:59:59.999999'""")
def flt5(spark, d):
    keep = lake.time_range(F.col("ts"), from_time="2024-01-05 12:30:00", from_date="2024-01-01", to_date="2024-01-20")
    return v.table(spark, d, "events").filter(keep).select("event_id", "user_id", "event_type")


@query("FLT6", SELECTED + """ WHERE (qa = 'pass' OR (qa = 'warn' AND frames <= 3000)) AND task IN ('t1', 't3')
  AND type <> 'test' AND collected_at >= TIMESTAMP '1996-01-01 00:00:00' AND device = 'dev_b'""")
def flt6(spark, d):
    rows = v.recordings(spark, d).withColumn("state", F.col("qa")).withColumn("qa", F.when(F.col("qa") != "warn", F.col("qa")))
    rows = rows.withColumn("mistake", F.col("frames") > 3000).withColumn("annotated", F.col("type") != "test")
    kept = lake.export_selection(
        rows, tasks=["t1", "t3"], devices=["dev_b"], annotated_only=True, include_unchecked=True, from_date="1996-01-01")
    return kept.withColumn("qa", F.col("state")).select(*COLUMNS)


@query("FLT7", SELECTED + " WHERE qa = 'pass' ORDER BY recording_id LIMIT 100")
def flt7(spark, d):
    return lake.recording_limit(v.recordings(spark, d).filter(F.col("qa") == "pass"), 100).select(*COLUMNS)


@query("FLT8", "SELECT dataset, recording_id, length FROM fx_episodes WHERE dagger_type = 'policy'")
def flt8(spark, d):
    return indices.filter_dagger(v.raw_episodes(spark, d), "policy").select("dataset", "recording_id", "length")


@query("FLT9", SELECTED + " WHERE frames > 1200 AND collected_at >= DATE '2001-08-01' - 700 AND task = 't2' AND qa = 'pass'")
def flt9(spark, d):
    return lake.numeric_and_recent(
        v.recordings(spark, d), min_frames=1200, as_of="2001-08-01", days=700, task="t2", qa="pass").select(*COLUMNS)


@query("FLT10", """SELECT dataset_id, concat('train_job_', CAST(dataset_id AS VARCHAR), '+train_b') AS task_name FROM fx_lake_sets""")
def flt10(spark, d):
    name = F.concat(F.col("used_by")[0], F.lit("+train_b"))
    return v.lake_sets(spark, d).select("dataset_id", text.checked_task_prefix(name, "train_").alias("task_name"))


@query("FLT11", "SELECT pipeline_id, creator FROM fx_pipelines WHERE list_contains(stages, 'op_3')")
def flt11(spark, d):
    return registry.pipelines_using(v.pipelines(spark, d), "op_3").select("pipeline_id", "creator")


@query("FLT12", """SELECT run_id, name, target, status FROM fx_runs WHERE status IN ('failed', 'running') AND trigger = 'manual'
  AND (contains(name, 'w 1') OR contains(target, 'w 1'))""")
def flt12(spark, d):
    return registry.filter_runs(v.runs(spark, d), statuses=["failed", "running"], trigger="manual", text="w 1").select(
        "run_id", "name", "target", "status")


@query("FN13", "SELECT recording_id, device, operator FROM fx_recordings")
def fn13(spark, d):
    return v.recordings(spark, d).select("recording_id", "device", "operator")


@query("FN14", "SELECT recording_id, array_to_string(tags, ',') AS tags FROM fx_recordings")
def fn14(spark, d):
    return v.recordings(spark, d).select("recording_id", F.array_join("tags", ",").alias("tags"))


@query("FN19", """SELECT dataset_id, job, CASE WHEN starts_with(job, 'eval') THEN 'eval' ELSE 'train' END AS kind
  FROM (SELECT dataset_id, unnest(used_by) AS job FROM fx_lake_sets) x""")
def fn19(spark, d):
    jobs = v.lake_sets(spark, d).select("dataset_id", F.explode("used_by").alias("job"))
    return jobs.withColumn("kind", rec.usage_kind(F.col("job")))


@query("FN20", """SELECT CASE WHEN frames < 900 THEN '<900' WHEN frames < 1100 THEN '900-1100' WHEN frames < 1300 THEN '1100-1300'
  WHEN frames < 1500 THEN '1300-1500' ELSE '>1500' END AS bucket, count(*) AS episodes FROM fx_recordings GROUP BY 1""")
def fn20(spark, d):
    return lake.facet_counts(v.recordings(spark, d).withColumn("bucket", numbers.length_bucket(F.col("frames"))), "bucket")


@query("AGG13", """SELECT 'task' AS facet, task AS value, count(*) AS episodes FROM fx_recordings GROUP BY task
  UNION ALL SELECT 'tag', tag, count(*) FROM (SELECT unnest(tags) AS tag FROM fx_recordings) t GROUP BY tag""")
def agg13(spark, d):
    rows = v.recordings(spark, d)
    by_task = lake.facet_counts(rows, "task").select(F.lit("task").alias("facet"), F.col("task").alias("value"), "episodes")
    by_tag = lake.tag_counts(rows).select(F.lit("tag").alias("facet"), F.col("tag").alias("value"), "episodes")
    return by_task.unionByName(by_tag)


@query("AGG14", """SELECT count(*) AS episodes, CAST(sum(frames) AS BIGINT) AS frames, count(*) FILTER (qa = 'pass') AS n_pass,
  count(*) FILTER (qa = 'warn') AS n_warn, count(*) FILTER (qa = 'fail') AS n_fail,
  round_even(sum(frames) / 30.0 / 60.0, 1) AS minutes FROM fx_recordings WHERE list_contains(tags, 'do_grasp')""")
def agg14(spark, d):
    return lake.scope_summary(lake.query_recordings(v.recordings(spark, d), tags=["do_grasp"])).drop("hours")


@query("AGG14_values", """SELECT DISTINCT 'collection' AS kind, CAST(collection_id AS VARCHAR) AS value FROM fx_recordings WHERE type = 'eval'
  UNION ALL SELECT DISTINCT 'task', task FROM fx_recordings WHERE type = 'eval'
  UNION ALL SELECT DISTINCT 'tag', unnest(tags) FROM fx_recordings WHERE type = 'eval'""")
def agg14_values(spark, d):
    return lake.scope_values(lake.query_recordings(v.recordings(spark, d), types=["eval"]))


@query("AGG15", """SELECT 'prompt' AS kind, task AS name, count(*) AS episodes FROM fx_recordings WHERE qa <> 'pass' GROUP BY task
  UNION ALL SELECT 'skill', r.tag, count(*) FROM (SELECT unnest(tags) AS tag FROM fx_recordings WHERE qa <> 'pass') r
  JOIN fx_tag_defs t ON t.tag = r.tag AND t.dimension = 'skill' GROUP BY r.tag""")
def agg15(spark, d):
    rows = lake.query_recordings(v.recordings(spark, d), qas=["warn", "fail"])
    skills = [t for t, g in v.TAG_DEFS if g == "skill"]
    prompts = lake.facet_counts(rows, "task").select(F.lit("prompt").alias("kind"), F.col("task").alias("name"), "episodes")
    tags = lake.tag_counts(rows).filter(F.col("tag").isin(skills)).select(F.lit("skill").alias("kind"), F.col("tag").alias("name"), "episodes")
    return prompts.unionByName(tags)


@query("W4", """SELECT recording_id, qa, CAST(floor((row_number() OVER (ORDER BY collected_at DESC, recording_id) - 1) / 20) AS BIGINT) AS page
  FROM fx_recordings WHERE type = 'dagger'""")
def w4(spark, d):
    rows = lake.query_recordings(v.recordings(spark, d), types=["dagger"]).select("recording_id", "qa", "collected_at")
    return lake.with_page(rows, "collected_at", "recording_id").select("recording_id", "qa", "page")


@query("W4_keyset", """SELECT recording_id, qa FROM fx_recordings WHERE type = 'normal' ORDER BY collected_at DESC, recording_id LIMIT 50 OFFSET 400""")
def w4_keyset(spark, d):
    rows = lake.query_recordings(v.recordings(spark, d), types=["normal"]).select("recording_id", "qa", "collected_at")
    return lake.keyset_page(rows, 8, "collected_at", "recording_id", 50).select("recording_id", "qa")


@query("W4_page", """SELECT recording_id, qa FROM fx_recordings WHERE type = 'dagger' ORDER BY collected_at DESC, recording_id LIMIT 20 OFFSET 60""")
def w4_page(spark, d):
    rows = lake.query_recordings(v.recordings(spark, d), types=["dagger"])
    return lake.page(rows, 3, "collected_at", "recording_id").select("recording_id", "qa")


@query("W5", """SELECT recording_id, version, author FROM (SELECT l_orderkey AS recording_id, l_partkey AS version, max(l_suppkey) AS author,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey DESC) AS rn FROM lineitem GROUP BY l_orderkey, l_partkey) x WHERE rn = 1""")
def w5(spark, d):
    rows = v.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("recording_id"), F.col("l_partkey").alias("version")).agg(
        F.max("l_suppkey").alias("author"))
    return lake.latest_annotation(rows, ["recording_id"], "version")


@query("ORD3", 'SELECT run_id, status FROM fx_runs ORDER BY "at" DESC, run_id')
def ord3(spark, d):
    return lake.newest_first(v.runs(spark, d), "at", "run_id").select("run_id", "status")
