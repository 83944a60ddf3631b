"""Versions, lineage, pipelines and runs, taxonomy, whole runs."""

from functools import reduce

from pyspark.sql import functions as F

from tracemill.functions.recordings import usage_kind
from tracemill.operators import compose, registry, versions
from tracemill.operators.positions import dense_position
from tracemill.plans import build
from workload import views as v
from workload.q_stats import members, r
from workload.registry import VIEWS, query

VERSION_COLUMNS = "dataset, seq, version, status, recordings, note, creator"


@query("VER1", """SELECT dataset, version, seq, status, note FROM (SELECT concat('ds', CAST(o_custkey AS VARCHAR)) AS dataset, concat('v', CAST(1 + o_orderkey % 4 AS VARCHAR)) AS version,
  o_orderkey AS seq, CASE o_orderstatus WHEN 'F' THEN 'archived' WHEN 'P' THEN 'draft' ELSE 'active' END AS status, o_orderpriority AS note,
  row_number() OVER (PARTITION BY o_custkey, o_orderkey % 4 ORDER BY o_orderkey DESC) AS rn FROM orders) x WHERE rn = 1""")
def ver1(spark, d):
    status = F.col("o_orderstatus")
    events = v.table(spark, d, "orders").select(
        F.concat(F.lit("ds"), F.col("o_custkey").cast("string")).alias("dataset"),
        F.concat(F.lit("v"), (1 + F.col("o_orderkey") % 4).cast("string")).alias("version"), F.col("o_orderkey").alias("seq"),
        F.when(status == "F", "archived").when(status == "P", "draft").otherwise("active").alias("status"), F.col("o_orderpriority").alias("note"))
    return versions.version_history(events)


VIEWS["fx_valid"] = """SELECT q.dataset, q.version FROM fx_requests q JOIN fx_versions x ON x.dataset = q.dataset AND x.version = q.version AND x.status = 'draft'"""


@query("VER2", """SELECT x.dataset, seq, x.version, CASE WHEN q.version IS NULL THEN status WHEN x.version = q.version THEN 'active' WHEN status = 'active' THEN 'archived' ELSE status END AS status,
  recordings, note, creator FROM fx_versions x LEFT JOIN fx_valid q ON q.dataset = x.dataset""")
def ver2(spark, d):
    return versions.publish(v.versions(spark, d), v.requests(spark, d))


@query("VER3", f"""SELECT {VERSION_COLUMNS} FROM fx_versions UNION ALL
  SELECT q.dataset, m.hi + 1, concat('v', CAST(m.hi + 1 AS VARCHAR)), 'draft', x.recordings, concat('rolled back from ', q.version), 'operator'
  FROM fx_requests q JOIN fx_versions x ON x.dataset = q.dataset AND x.version = q.version JOIN (SELECT dataset, max(seq) AS hi FROM fx_versions GROUP BY dataset) m ON m.dataset = q.dataset""")
def ver3(spark, d):
    return versions.rollback(v.versions(spark, d), v.requests(spark, d), "operator").select(*VERSION_COLUMNS.split(", "))


#: Per dataset, in the order of arrival: a publish and a rollback made on the same state, a change made on what the first
#: left, one made on an old state, one made too early and one made on the last state.
CHANGES = [(1, 0, "publish", "hi"), (2, 0, "rollback", "lo"), (3, 1, "rollback", "lo"), (4, -1, "publish", "lo"), (5, 3, "rollback", "hi"), (6, 2, "rollback", "hi")]
VIEWS["fx_changes"] = f"""
SELECT m.dataset, c.arrival, m.hi + c.step AS based_on, c.kind, CASE c.which WHEN 'hi' THEN m.high ELSE m.low END AS version
FROM (SELECT dataset, dataset_id, max(seq) AS hi, max_by(version, seq) AS high, min_by(version, seq) AS low FROM fx_versions GROUP BY dataset, dataset_id) m
JOIN (VALUES {', '.join(map(str, CHANGES))}) AS c(arrival, step, kind, which) ON (m.dataset_id + c.arrival) % 4 <> 0"""
VIEWS["fx_taken"] = """
SELECT c.dataset, c.arrival, c.kind, c.version, t.head AS seq FROM (
  WITH RECURSIVE t(dataset, head, arrival) AS (SELECT dataset, max(seq), 0 FROM fx_versions GROUP BY dataset UNION ALL
    SELECT dataset, head, arrival FROM (SELECT t.dataset, t.head + 1 AS head, (SELECT min(c.arrival) FROM fx_changes c WHERE c.dataset = t.dataset
      AND c.based_on = t.head AND c.arrival > t.arrival) AS arrival FROM t) n WHERE arrival IS NOT NULL) SELECT * FROM t) t
JOIN fx_changes c ON c.dataset = t.dataset AND c.arrival = t.arrival"""


def changes(spark, d):
    rows = v.versions(spark, d).groupBy("dataset").agg(
        F.max("seq").alias("top"), F.max_by("version", "seq").alias("hi"), F.min_by("version", "seq").alias("lo"))
    steps = F.explode(F.array(*[F.struct(F.lit(a).alias("arrival"), F.lit(s).alias("step"), F.lit(k).alias("kind"), F.lit(w).alias("which"))
                                for a, s, k, w in CHANGES])).alias("c")
    owner = F.substring("dataset", 3, 20).cast("bigint")
    return rows.select("*", steps).filter((owner + F.col("c.arrival")) % 4 != 0).select(
        "dataset", F.col("c.arrival").cast("bigint").alias("arrival"), (F.col("top") + F.col("c.step")).alias("based_on"), F.col("c.kind").alias("kind"),
        F.when(F.col("c.which") == "hi", F.col("hi")).otherwise(F.col("lo")).alias("version"))


@query("VER2_log", "SELECT dataset, arrival, kind, version, seq FROM fx_taken")
def ver2_log(spark, d):
    return versions.accepted_changes(v.versions(spark, d), changes(spark, d)).drop("based_on")


@query("VER3_log", f"""SELECT x.dataset, x.seq, x.version, CASE WHEN p.version IS NULL THEN x.status WHEN x.version = p.version THEN 'active' WHEN x.status = 'active' THEN 'archived'
  ELSE x.status END AS status, recordings, note, creator FROM fx_versions x LEFT JOIN (SELECT t.dataset, t.version FROM fx_taken t JOIN fx_versions y ON y.dataset = t.dataset
    AND y.version = t.version AND y.status = 'draft' WHERE t.kind = 'publish') p ON p.dataset = x.dataset
  UNION ALL SELECT t.dataset, t.seq, concat('v', CAST(m.hi + row_number() OVER (PARTITION BY t.dataset ORDER BY t.seq) AS VARCHAR)), 'draft', x.recordings,
    concat('rolled back from ', t.version), 'operator' FROM fx_taken t JOIN fx_versions x ON x.dataset = t.dataset AND x.version = t.version
  JOIN (SELECT dataset, max(seq) AS hi FROM fx_versions GROUP BY dataset) m ON m.dataset = t.dataset WHERE t.kind = 'rollback'""")
def ver3_log(spark, d):
    return versions.replay(v.versions(spark, d), changes(spark, d), "operator")


def processed(spark, d):
    rows = v.versions(spark, d)
    wanted = v.requests(spark, d).select(
        "dataset", F.lit("split").alias("operator"), F.lit(5).cast("bigint").alias("recordings"), F.lit(" ").alias("note"))
    return versions.process(rows, v.runs(spark, d).select("run_id", "pipeline", "name", "target", "status", "trigger", "by", "at"),
                            wanted, "operator", "2026-01-01 00:00:00")


VIEWS["fx_drafted"] = """SELECT q.dataset, m.hi, concat('v', CAST(m.hi + 1 AS VARCHAR)) AS version FROM fx_requests q
  JOIN (SELECT dataset, max(seq) AS hi FROM fx_versions GROUP BY dataset) m ON m.dataset = q.dataset"""


@query("VER4", f"""SELECT {VERSION_COLUMNS} FROM fx_versions UNION ALL SELECT dataset, hi + 1, version, 'draft', 5, 'processed by split', 'operator' FROM fx_drafted""")
def ver4(spark, d):
    return processed(spark, d)[0].select(*VERSION_COLUMNS.split(", "))


@query("VER4_runs", """SELECT run_id, pipeline, name, target, status, trigger, "by" FROM fx_runs UNION ALL
  SELECT concat('proc_', dataset, '_', version), '', 'split', concat(dataset, ' ', version), 'done', 'manual', 'operator' FROM fx_drafted""")
def ver4_runs(spark, d):
    return processed(spark, d)[1].drop("at")


DOWN = """SELECT s.dataset_id, CAST(s.i AS BIGINT) AS i, s.job, CASE WHEN starts_with(s.job, 'eval') THEN 'eval' ELSE 'train' END AS kind, p.version FROM
  (SELECT dataset_id, unnest(generate_series(0, 2)) AS i, unnest(used_by) AS job FROM fx_lake_sets) s
  LEFT JOIN (SELECT dataset_id, count(*) AS n FROM fx_versions WHERE status <> 'draft' GROUP BY dataset_id) c ON c.dataset_id = s.dataset_id
  LEFT JOIN (SELECT dataset_id, version, row_number() OVER (PARTITION BY dataset_id ORDER BY seq DESC) - 1 AS place FROM fx_versions WHERE status <> 'draft') p
    ON p.dataset_id = s.dataset_id AND p.place = s.i % c.n"""


@query("W6", DOWN)
def w6(spark, d):
    rows = versions.published(v.versions(spark, d)).select(
        F.substring("dataset", 3, 20).cast("bigint").alias("dataset_id"), "version", (-F.col("seq")).alias("newest"))
    placed = dense_position(rows, ["dataset_id"], ["newest"], "place").select("dataset_id", "version", "place")
    return compose.downstream_usage(v.lake_sets(spark, d), placed, usage_kind).withColumn("i", F.col("i").cast("bigint"))


@query("VER5", f"""SELECT dataset_id, 'up' AS direction, CAST(collection_id AS VARCHAR) AS other, type AS kind, count(*) AS n FROM fx_members GROUP BY 1, 3, 4
  UNION ALL SELECT dataset_id, 'down', job, kind, count(*) FROM ({DOWN}) x GROUP BY 1, 3, 4""")
def ver5(spark, d):
    up = compose.upstream_sources(members(spark, d)).select(
        "dataset_id", F.lit("up").alias("direction"), F.col("collection_id").cast("string").alias("other"), F.col("type").alias("kind"), F.col("recordings").alias("n"))
    down = w6(spark, d).groupBy("dataset_id", "job", "kind").agg(F.count(F.lit(1)).alias("n")).select(
        "dataset_id", F.lit("down").alias("direction"), F.col("job").alias("other"), "kind", "n")
    return up.unionByName(down)


@query("J10", """SELECT run_id, CASE WHEN trigger = 'manual' THEN coalesce("by", '—') ELSE coalesce(p.creator, '—') END AS started_by FROM fx_runs r LEFT JOIN fx_pipelines p ON p.pipeline_id = r.pipeline""")
def j10(spark, d):
    return registry.runs_with_creator(v.runs(spark, d), v.pipelines(spark, d)).select("run_id", "started_by")


STAGES = """(SELECT pipeline_id, CAST(unnest(generate_series(0, 2)) AS BIGINT) AS stage, unnest(stages) AS operator_id FROM fx_pipelines)"""


@query("J11", f"SELECT pipeline_id, stage, s.operator_id, o.name FROM {STAGES} s JOIN fx_operators o ON o.operator_id = s.operator_id")
def j11(spark, d):
    return registry.pipeline_operators(v.pipelines(spark, d), v.operators(spark, d)).select(
        "pipeline_id", F.col("stage").cast("bigint").alias("stage"), "operator_id", "name")


@query("SET3_keys", f"""SELECT pipeline_id, key, min(stage) AS stage FROM (SELECT pipeline_id, stage, unnest(['--ratio', '--seed', concat('K', CAST(n_regionkey AS VARCHAR))]) AS key
  FROM {STAGES} s JOIN nation ON s.operator_id = concat('op_', CAST(n_nationkey AS VARCHAR))) x GROUP BY 1, 2""")
def set3_keys(spark, d):
    return registry.pipeline_param_keys(v.pipelines(spark, d), v.operators(spark, d)).select(
        "pipeline_id", "key", F.col("stage").cast("bigint").alias("stage"))


@query("AGG18", """SELECT count(*) AS total, count(*) FILTER (status = 'running') AS running, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'done') AS done FROM fx_runs""")
def agg18(spark, d):
    return registry.run_counts(v.runs(spark, d))


@query("AGG17", """SELECT count(DISTINCT dimension) AS dimensions, count(DISTINCT (dimension, level2)) AS level2, count(level3) AS level3 FROM fx_taxonomy""")
def agg17(spark, d):
    return registry.taxonomy_counts(v.taxonomy(spark, d))


@query("AGG17_children", """SELECT dimension, '' AS level2, count(DISTINCT level2) AS children FROM fx_taxonomy GROUP BY dimension
  UNION ALL SELECT dimension, level2, count(level3) FROM fx_taxonomy GROUP BY dimension, level2""")
def agg17_children(spark, d):
    return registry.taxonomy_children(v.taxonomy(spark, d))


@query("VER7", """SELECT 'split' AS stage, concat(dataset, '|', split) AS name, CAST(count(*) AS DOUBLE) AS value FROM fx_sided GROUP BY dataset, split
  UNION ALL SELECT 'weights', dataset, round(weight, 6) FROM fx_sampling
  UNION ALL SELECT 'verify', grp, round(coalesce(sum(s) / (SELECT sum(frames * weight) FROM fx_sampling), 0), 6) FROM
    (SELECT g.grp, coalesce(g.frames * w.weight, 0) AS s FROM fx_grouped g LEFT JOIN fx_sampling w ON w.dataset = g.dataset) q GROUP BY grp
  UNION ALL SELECT 'integrity', d.dataset, CAST(coalesce(n, 0) AS DOUBLE) FROM fx_datasets d LEFT JOIN fx_data_frames f ON f.dataset = d.dataset
  UNION ALL SELECT 'text', dataset, CAST(count(*) FILTER (regexp_matches(task, '[一-鿿]')) AS DOUBLE) FROM fx_tasks GROUP BY dataset""")
def ver7(spark, d):
    out = build.standard_run(v.manifest(spark, d), v.episodes(spark, d), v.frames(spark, d), v.tasks(spark, d), v.settings(spark, d), v.RULES, v.CONFIG, ratio=0.9)
    rows = [
        out["split"].select(F.lit("split").alias("stage"), F.concat_ws("|", "dataset", "split").alias("name"), F.col("total_episodes").cast("double").alias("value")),
        out["weights"].select(F.lit("weights").alias("stage"), F.col("dataset").alias("name"), r(F.col("weight")).alias("value")),
        out["verify"].select(F.lit("verify").alias("stage"), F.col("grp").alias("name"), r(F.col("frame_share")).alias("value")),
        out["integrity"].select(F.lit("integrity").alias("stage"), F.col("dataset").alias("name"), F.col("data_frames").cast("double").alias("value")),
        out["text"].select(F.lit("text").alias("stage"), F.col("dataset").alias("name"), F.col("chinese_tasks").cast("double").alias("value")),
    ]
    return reduce(lambda a, b: a.unionByName(b), rows)


@query("VER7_dagger", """SELECT 'integrity' AS stage, d.dataset AS name, coalesce(n, 0) AS value FROM fx_datasets d LEFT JOIN fx_data_frames f ON f.dataset = d.dataset
  UNION ALL SELECT 'profile', concat(task_folder, '|', prompt), prompt_frames FROM fx_folder_prompts""")
def ver7_dagger(spark, d):
    out = build.dagger_run(v.manifest(spark, d), v.raw_episodes(spark, d), v.by_episode(spark, d, v.frames(spark, d), ["recording_id"]), v.tasks(spark, d), v.info(spark, d), v.RULES)
    first = out["integrity"].select(F.lit("integrity").alias("stage"), F.col("dataset").alias("name"), F.col("data_frames").alias("value"))
    return first.unionByName(out["profile"].select(F.lit("profile").alias("stage"), F.concat_ws("|", "task_folder", "prompt").alias("name"), F.col("prompt_frames").alias("value")))
