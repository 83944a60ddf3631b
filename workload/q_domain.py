"""Relabelling, numbering, splitting, recipes, exports."""

import uuid

from pyspark.sql import functions as F

from tracemill.functions.numbers import hash32
from tracemill.operators import indices, relabel, split
from tracemill.plans import build, export
from tracemill.session import materialise
from tracemill.sources import readers, stored
from workload import views as v
from workload.registry import VIEWS, query
from workload.q_paths import files
from workload.q_stats import members, r

VIEWS["fx_covered"] = """
SELECT f.dataset, f.recording_id, f.frame_index, f.task_index, a.pos, a.action,
  row_number() OVER (PARTITION BY f.dataset, f.recording_id, f.frame_index ORDER BY a.pos DESC) AS rn
FROM fx_motion_frames f JOIN fx_settings c ON c.dataset = f.dataset LEFT JOIN fx_actions a ON a.recording_id = f.recording_id AND a.dataset = f.dataset
  AND f.frame_index BETWEEN floor(a.start_time * c.fps) AND ceil(a.end_time * c.fps)"""


def derived_motion(spark, d):
    """The derived frames, written first, as they are counted and labelled."""
    return materialise(v.motion_frames(spark, d))


@query("J5", "SELECT dataset, recording_id, frame_index, action AS task FROM fx_covered WHERE rn = 1")
def j5(spark, d):
    actions = relabel.annotation_actions(v.annotations(spark, d))
    return relabel.frame_actions(derived_motion(spark, d), actions, v.settings(spark, d)).drop("task_index")


@query("DOM6", """SELECT c.dataset, c.recording_id, c.frame_index, CASE WHEN c.recording_id % 10 = 0 THEN c.task_index ELSE coalesce(w.idx, 0) END AS task_index
  FROM fx_covered c LEFT JOIN (SELECT dataset, action, row_number() OVER (PARTITION BY dataset ORDER BY action) AS idx
    FROM (SELECT DISTINCT dataset, action FROM fx_actions) x) w ON w.dataset = c.dataset AND w.action = c.action WHERE c.rn = 1""")
def dom6(spark, d):
    notes = v.annotations(spark, d)
    words = relabel.task_vocabulary(relabel.annotation_actions(notes))
    return relabel.relabel_by_annotation(derived_motion(spark, d), notes, words, v.settings(spark, d))


@query("W3", """SELECT dataset, CAST(0 AS BIGINT) AS task_index, 'unknown' AS task FROM fx_datasets UNION ALL
  SELECT dataset, row_number() OVER (PARTITION BY dataset ORDER BY encode(task)), task FROM
  (SELECT DISTINCT dataset, task FROM (SELECT dataset, unnest(tasks) AS task FROM fx_episodes) e WHERE task <> 'unknown') n""")
def w3(spark, d):
    return relabel.task_vocabulary(v.raw_episodes(spark, d).select("dataset", F.explode("tasks").alias("task")))


VIEWS["fx_vocabulary"] = """
SELECT dataset, 0 AS task_index, 'unknown' AS task FROM fx_datasets UNION ALL
SELECT dataset, row_number() OVER (PARTITION BY dataset ORDER BY encode(task)), task FROM
  (SELECT DISTINCT dataset, task FROM (SELECT dataset, unnest(tasks) AS task FROM fx_episodes) e WHERE task <> 'unknown') n"""


def vocabulary(spark, d):
    return relabel.task_vocabulary(v.raw_episodes(spark, d).select("dataset", F.explode("tasks").alias("task")))


BY_PROMPT = """SELECT f.dataset, f.recording_id, coalesce(w.task_index, 0) AS task_index FROM fx_frames f
  JOIN fx_episodes e ON e.recording_id = f.recording_id LEFT JOIN fx_vocabulary w ON w.dataset = f.dataset AND w.task =
  CASE WHEN len(e.tasks) > 1 THEN CASE f.task_index WHEN 1 THEN 'pick the cup' WHEN 2 THEN '擦白板: wipe the board' WHEN 3 THEN 'pour water' END ELSE e.tasks[1] END"""


@query("DOM7", f"SELECT dataset, recording_id, task_index, count(*) AS frames FROM ({BY_PROMPT}) x GROUP BY 1, 2, 3")
def dom7(spark, d):
    rows = relabel.relabel_by_prompt(v.by_episode(spark, d, v.frames(spark, d)), v.raw_episodes(spark, d), vocabulary(spark, d))
    return rows.groupBy("dataset", "recording_id", "task_index").agg(F.count(F.lit(1)).alias("frames"))


@query("J6", f"SELECT dataset, task_index, count(*) AS frames FROM ({BY_PROMPT}) x GROUP BY 1, 2")
def j6(spark, d):
    rows = relabel.relabel_by_prompt(v.by_episode(spark, d, v.frames(spark, d)), v.raw_episodes(spark, d), vocabulary(spark, d))
    return rows.groupBy("dataset", "task_index").agg(F.count(F.lit(1)).alias("frames"))


VIEWS["fx_english"] = """
SELECT *, [CASE WHEN contains(t, ':') THEN trim(regexp_replace(t, '^[^:]*:', '')) ELSE t END FOR t IN tasks] AS english FROM fx_episodes"""
VIEWS["fx_english_words"] = """
SELECT dataset, row_number() OVER (PARTITION BY dataset ORDER BY encode(task)) AS task_index, task FROM
  (SELECT DISTINCT dataset, task FROM (SELECT dataset, unnest(english) AS task FROM fx_english) e WHERE task <> 'unknown') n"""


@query("DOM8", """SELECT f.dataset, f.recording_id, coalesce(w.task_index, 0) AS task_index, count(*) AS frames FROM fx_frames f
  JOIN fx_english e ON e.recording_id = f.recording_id LEFT JOIN fx_english_words w ON w.dataset = f.dataset AND w.task = e.english[1] GROUP BY 1, 2, 3""")
def dom8(spark, d):
    from tracemill.functions.text import english_only_all

    episodes = v.raw_episodes(spark, d).withColumn("tasks", english_only_all(F.col("tasks")))
    words = relabel.task_vocabulary(episodes.select("dataset", F.explode("tasks").alias("task")))
    rows = relabel.relabel_first_task(v.by_episode(spark, d, v.frames(spark, d)), episodes, words)
    return rows.groupBy("dataset", "recording_id", "task_index").agg(F.count(F.lit(1)).alias("frames"))


@query("DOM9", """SELECT x.dataset, x.recording_id, coalesce(a.tasks, 'unknown') AS tasks FROM (SELECT DISTINCT dataset, recording_id FROM fx_motion_frames) x
  LEFT JOIN (SELECT recording_id, string_agg(action, '|' ORDER BY pos) AS tasks FROM fx_actions GROUP BY 1) a ON a.recording_id = x.recording_id""")
def dom9(spark, d):
    episodes = v.table(spark, d, "events").select(*v._motion_keys()).distinct()
    out = relabel.episode_tasks_from_annotation(episodes, v.annotations(spark, d))
    return out.withColumn("tasks", F.array_join("tasks", "|"))


@query("SET1", """SELECT DISTINCT dataset, action AS task FROM fx_actions UNION
  SELECT concat('set', CAST(user_id % 3 AS VARCHAR)), event_type FROM events""")
def set1(spark, d):
    from_events = v.table(spark, d, "events").select(v._motion_keys()[0], F.col("event_type").alias("task"))
    return relabel.task_names(relabel.annotation_actions(v.annotations(spark, d)), from_events)


@query("DOM13", "SELECT dataset, CAST(0 AS BIGINT) AS task_index, 'do the task' AS task FROM fx_datasets")
def dom13(spark, d):
    return relabel.single_prompt_vocabulary(v.datasets(spark, d), "do the task")


@query("W1", "SELECT dataset, recording_id, CAST(row_number() OVER (PARTITION BY dataset ORDER BY recording_id) - 1 AS BIGINT) AS episode_index FROM fx_episodes WHERE dagger_type = 'teleop'")
def w1(spark, d):
    kept = v.raw_episodes(spark, d).filter(F.col("dagger_type") == "teleop")
    return indices.reindex_episodes(kept).select("dataset", "recording_id", "episode_index")


VIEWS["fx_lengths"] = "SELECT recording_id, count(*) AS n FROM fx_frames GROUP BY recording_id"


@query("W2", """SELECT f.dataset, f.recording_id, f.frame_index, s.episode_index, CAST(s.start + f.frame_index AS BIGINT) AS index FROM fx_frames f JOIN (
  SELECT e.recording_id, e.episode_index, coalesce(sum(n) OVER (PARTITION BY e.dataset ORDER BY e.episode_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM fx_episodes e JOIN fx_lengths l ON l.recording_id = e.recording_id) s ON s.recording_id = f.recording_id""")
def w2(spark, d):
    out = indices.fix_indices(v.placed_frames(spark, d), v.episodes(spark, d))
    return out.select("dataset", "recording_id", "frame_index", "episode_index", "index")


def kept_frames(spark, d, rows=None):
    """The frames of the lake as a bucketed table."""
    rows = materialise(v.placed_frames(spark, d)) if rows is None else rows
    return stored.store_frames(rows, f"frames_{uuid.uuid4().hex}", stored.bucket_count(rows.count(), 100_000), v.scratch(spark))


@query("W2_stored", same="W2")
def w2_stored(spark, d):
    out = indices.fix_indices(kept_frames(spark, d), v.episodes(spark, d))
    return out.select("dataset", "recording_id", "frame_index", "episode_index", "index")


@query("J5_stored", same="J5")
def j5_stored(spark, d):
    actions = relabel.annotation_actions(v.annotations(spark, d))
    frames = kept_frames(spark, d, materialise(v.motion_frames(spark, d)))
    return relabel.frame_actions(frames, actions, v.settings(spark, d)).drop("task_index")


@query("J7", """SELECT dataset, recording_id FROM fx_episodes WHERE dagger_type = 'policy'""")
def j7(spark, d):
    kept = v.raw_episodes(spark, d).filter(F.col("dagger_type") == "policy")
    return indices.files_of(files(spark, d), kept).select("dataset", "recording_id")


HASH = "CAST('0x' || substr(md5(concat_ws('/', dataset, CAST(episode_index AS VARCHAR), '42')), 1, 8) AS BIGINT)"
VIEWS["fx_sided"] = f"SELECT *, CASE WHEN {HASH} < 0.9 * 4294967296 THEN 'train' ELSE 'val' END AS split FROM fx_episodes"
VIEWS["fx_numbered"] = """
SELECT dataset, split, recording_id, length, CAST(row_number() OVER (PARTITION BY dataset, split ORDER BY episode_index) - 1 AS BIGINT) AS episode_index FROM fx_sided"""


def sided(spark, d):
    return split.split_by_hash(v.episodes(spark, d), 0.9)


def numbered(spark, d):
    """Both sides numbered anew. The derived episodes are written first, as numbering reads them twice."""
    return split.split_episodes(materialise(sided(spark, d)))


@query("DOM2", "SELECT dataset, recording_id, episode_index, split FROM fx_sided")
def dom2(spark, d):
    return sided(spark, d).select("dataset", "recording_id", "episode_index", "split")


@query("DOM3", """SELECT dataset, split, count(*) AS total_episodes, CAST(sum(length) AS BIGINT) AS total_frames, any_value(c.chunks_size) AS chunks_size, any_value(c.fps) AS fps, CAST(ceil(count(*) / any_value(c.chunks_size)) AS BIGINT) AS total_chunks,
  count(*) * any_value(c.cameras) AS total_videos, concat('0:', CAST(count(*) AS VARCHAR)) AS range FROM fx_sided JOIN fx_settings c USING (dataset) GROUP BY 1, 2""")
def dom3(spark, d):
    return split.split_metadata(sided(spark, d), v.settings(spark, d))


@query("DOM3_files", """SELECT n.dataset, n.split, n.recording_id, concat(n.dataset, '/data/chunk-', lpad(CAST(n.episode_index // c.chunks_size AS VARCHAR), 3, '0'),
  '/episode_', lpad(CAST(n.episode_index AS VARCHAR), 6, '0'), '.parquet') AS path FROM fx_numbered n JOIN fx_settings c USING (dataset)""")
def dom3_files(spark, d):
    episodes = materialise(sided(spark, d))
    renumbered = split.split_episodes(episodes).select("dataset", "split", "old_episode_index", "episode_index")
    own = F.concat("dataset", F.format_string("/data/chunk-%03d/episode_%06d.parquet", F.floor(F.col("episode_index") / 100), F.col("episode_index")))
    return indices.renumber_files(episodes.select("dataset", "recording_id", own.alias("path")), renumbered, v.settings(spark, d)).select(
        "dataset", "split", "recording_id", "path")


@query("DOM4", """SELECT f.dataset, s.split, f.recording_id, f.frame_index, s.episode_index, CAST(s.start + f.frame_index AS BIGINT) AS index FROM fx_frames f JOIN (
  SELECT e.recording_id, e.split, e.episode_index, coalesce(sum(n) OVER (PARTITION BY e.dataset, e.split ORDER BY e.episode_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM fx_numbered e JOIN fx_lengths l ON l.recording_id = e.recording_id) s ON s.recording_id = f.recording_id""")
def dom4(spark, d):
    out = split.split_frames(v.placed_frames(spark, d), numbered(spark, d))
    return out.select("dataset", "split", "recording_id", "frame_index", "episode_index", "index")


@query("DOM4_stored", same="DOM4")
def dom4_stored(spark, d):
    out = split.split_frames(kept_frames(spark, d), numbered(spark, d))
    return out.select("dataset", "split", "recording_id", "frame_index", "episode_index", "index")


@query("DOM5", """SELECT dataset, count(*) AS original_total_episodes, count(*) FILTER (split = 'train') AS train_episodes_count,
  count(*) FILTER (split = 'val') AS val_episodes_count, CAST(0.9 AS DOUBLE) AS train_ratio FROM fx_sided GROUP BY dataset""")
def dom5(spark, d):
    return split.split_info(sided(spark, d), 0.9)


@query("DOM5_manifest", """SELECT DISTINCT concat(d.dataset, '_split/', s.split) AS dataset, s.split, d.weight FROM fx_datasets d JOIN fx_sided s ON s.dataset = d.dataset
  WHERE NOT contains(d.dataset, 'PickPlace')""")
def dom5_manifest(spark, d):
    manifest = v.manifest(spark, d)
    todo = split.pending(manifest, manifest.filter(F.col("dataset").contains("PickPlace")))
    return split.split_manifest(todo, sided(spark, d))


@query("DOM5_recordings", "SELECT dataset, recording_id, split FROM fx_sided")
def dom5_recordings(spark, d):
    return split.split_recordings(sided(spark, d))


@query("DOM10", """WITH kept AS (SELECT * FROM fx_english WHERE dagger_type = 'teleop'),
 num AS (SELECT *, CAST(row_number() OVER (PARTITION BY dataset ORDER BY episode_index) - 1 AS BIGINT) AS ni FROM kept),
 words AS (SELECT dataset, row_number() OVER (PARTITION BY dataset ORDER BY encode(task)) AS task_index, task FROM
   (SELECT DISTINCT dataset, task FROM (SELECT dataset, unnest(english) AS task FROM kept) e WHERE task <> 'unknown') n),
 starts AS (SELECT n.recording_id, n.ni, coalesce(sum(l.n) OVER (PARTITION BY n.dataset ORDER BY n.ni ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, n.english
   FROM num n JOIN fx_lengths l ON l.recording_id = n.recording_id)
 SELECT f.dataset, f.recording_id, f.frame_index, s.ni AS episode_index, CAST(s.start + f.frame_index AS BIGINT) AS index, coalesce(w.task_index, 0) AS task_index
 FROM fx_frames f JOIN starts s ON s.recording_id = f.recording_id LEFT JOIN words w ON w.dataset = f.dataset AND w.task = s.english[1]""")
def dom10(spark, d):
    out = indices.dagger_subset(v.by_episode(spark, d, v.placed_frames(spark, d)), v.raw_episodes(spark, d), "teleop", v.settings(spark, d))["frames"]
    return out.select("dataset", "recording_id", "frame_index", "episode_index", "index", "task_index")


@query("DOM10_info", """SELECT e.dataset, count(*) AS total_episodes, CAST(coalesce(sum(l.n), 0) AS BIGINT) AS total_frames, any_value(c.chunks_size) AS chunks_size, any_value(c.fps) AS fps, CAST(ceil(count(*) / any_value(c.chunks_size)) AS BIGINT) AS total_chunks,
  count(*) * any_value(c.cameras) AS total_videos, any_value(w.k) AS total_tasks, 'teleop' AS dagger_type FROM fx_english e LEFT JOIN fx_lengths l ON l.recording_id = e.recording_id
  JOIN (SELECT dataset, count(DISTINCT task) FILTER (task <> 'unknown') + 1 AS k FROM (SELECT dataset, unnest(english) AS task FROM fx_english WHERE dagger_type = 'teleop') x GROUP BY dataset) w
    ON w.dataset = e.dataset JOIN fx_settings c ON c.dataset = e.dataset WHERE dagger_type = 'teleop' GROUP BY e.dataset""")
def dom10_info(spark, d):
    return indices.dagger_subset(v.frames(spark, d).withColumn("frame_index", F.lit(0).cast("bigint")), v.raw_episodes(spark, d), "teleop", v.settings(spark, d))["info"]


WEIGHTS = {"prompt": {"t1": 2.0, "t2": 0.5}, "tag": {"do_grasp": 0.0, "do_fill": 1.5}}
VIEWS["fx_recipe_counts"] = """
SELECT 'prompt' AS side, task AS class, count(*) AS available, count(*) * CASE task WHEN 't1' THEN 2.0 WHEN 't2' THEN 0.5 ELSE 1.0 END::DOUBLE AS scaled FROM fx_recordings WHERE qa = 'pass' GROUP BY task
UNION ALL SELECT 'tag', tag, count(*), count(*) * CASE tag WHEN 'do_grasp' THEN 0.0 WHEN 'do_fill' THEN 1.5 ELSE 1.0 END::DOUBLE FROM
 (SELECT unnest(tags) AS tag FROM fx_recordings WHERE qa = 'pass') t WHERE starts_with(tag, 'do_') GROUP BY tag"""
VIEWS["fx_recipe"] = """
SELECT side, class, available, share, (SELECT min(t) FROM (SELECT CAST(floor(min(available / share)) AS BIGINT) AS t FROM
   (SELECT side, available, scaled / sum(scaled) OVER (PARTITION BY side) AS share FROM fx_recipe_counts) c WHERE share > 0.001 GROUP BY side) m) AS total
FROM (SELECT *, scaled / sum(scaled) OVER (PARTITION BY side) AS share FROM fx_recipe_counts) s"""


def recipe(spark, d):
    from tracemill.operators import lake

    rows = lake.query_recordings(v.recordings(spark, d), qas=["pass"])
    prompts = lake.facet_counts(rows, "task").select(F.col("task").alias("class"), F.col("episodes").alias("available"))
    tags = lake.tag_counts(rows).filter(F.col("tag").startswith("do_")).select(F.col("tag").alias("class"), F.col("episodes").alias("available"))
    return rows, split.recipe_plan(prompts, tags, WEIGHTS)


@query("DOM11", "SELECT side, class, available, round(share, 6) AS share, total, CAST(round(share * total) AS BIGINT) AS quota FROM fx_recipe")
def dom11(spark, d):
    return recipe(spark, d)[1].withColumn("share", r(F.col("share")))


DRAW = "CAST('0x' || substr(md5(concat_ws('/', CAST(recording_id AS VARCHAR), '7')), 1, 8) AS BIGINT)"


@query("DOM12", f"SELECT recording_id, task FROM (SELECT recording_id, task, row_number() OVER (ORDER BY {DRAW}, recording_id) AS n FROM fx_recordings) x WHERE n <= 1000")
def dom12(spark, d):
    return split.recipe_sample(v.recordings(spark, d), 1000, seed=7).select("recording_id", "task")


@query("DOM12_classes", f"""SELECT recording_id, x.task FROM (SELECT recording_id, task, row_number() OVER (PARTITION BY task ORDER BY {DRAW}, recording_id) AS n FROM fx_recordings WHERE qa = 'pass') x
  JOIN (SELECT class, CAST(round(share * total) AS BIGINT) AS quota FROM fx_recipe WHERE side = 'prompt') q ON q.class = x.task WHERE n <= quota""")
def dom12_classes(spark, d):
    rows, plan = recipe(spark, d)
    return split.recipe_sample_by_class(rows, plan.filter(F.col("side") == "prompt"), "task", seed=7).select("recording_id", "task")


def export_frames(tables):
    return tables["frames"].select("dataset", "recording_id", "frame_index", "episode_index", "index", "task_index")


EXPORT = """WITH kept AS (SELECT e.* FROM fx_episodes e JOIN fx_recordings r ON r.recording_id = e.recording_id WHERE r.qa = 'pass' AND r.task IN ('t1', 't2')),
 num AS (SELECT *, CAST(row_number() OVER (PARTITION BY dataset ORDER BY episode_index) - 1 AS BIGINT) AS ni FROM kept),
 words AS (SELECT dataset, row_number() OVER (PARTITION BY dataset ORDER BY encode(task)) AS task_index, task FROM
   (SELECT DISTINCT dataset, task FROM (SELECT dataset, unnest(tasks) AS task FROM kept) e WHERE task <> 'unknown') n),
 starts AS (SELECT n.recording_id, n.ni, coalesce(sum(l.n) OVER (PARTITION BY n.dataset ORDER BY n.ni ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, n.tasks
   FROM num n JOIN fx_lengths l ON l.recording_id = n.recording_id)
 SELECT f.dataset, f.recording_id, f.frame_index, s.ni AS episode_index, CAST(s.start + f.frame_index AS BIGINT) AS index, coalesce(w.task_index, 0) AS task_index
 FROM fx_frames f JOIN starts s ON s.recording_id = f.recording_id LEFT JOIN words w ON w.dataset = f.dataset AND w.task =
   CASE WHEN len(s.tasks) > 1 THEN CASE f.task_index WHEN 1 THEN 'pick the cup' WHEN 2 THEN '擦白板: wipe the board' WHEN 3 THEN 'pour water' END ELSE s.tasks[1] END"""


@query("DOM14", EXPORT)
def dom14(spark, d):
    from tracemill.operators import lake

    selected = lake.export_selection(v.recordings(spark, d), tasks=["t1", "t2"])
    return export_frames(export.export_dataset(selected, v.raw_episodes(spark, d), v.by_episode(spark, d, v.placed_frames(spark, d)), info=v.settings(spark, d)))


@query("DOM14_annotated", """SELECT c.dataset, c.recording_id, c.frame_index, s.ep AS episode_index, CAST(s.start + c.frame_index AS BIGINT) AS index,
  CASE WHEN c.recording_id % 10 = 0 THEN c.task_index ELSE coalesce(w.idx, 0) END AS task_index FROM fx_covered c
  JOIN (SELECT dataset, recording_id, CAST(row_number() OVER p - 1 AS BIGINT) AS ep, coalesce(sum(n) OVER (p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM (SELECT dataset, recording_id, count(*) AS n FROM fx_motion_frames GROUP BY 1, 2) q WINDOW p AS (PARTITION BY dataset ORDER BY recording_id)) s ON s.recording_id = c.recording_id
  LEFT JOIN (SELECT dataset, action, row_number() OVER (PARTITION BY dataset ORDER BY action) AS idx FROM (SELECT DISTINCT dataset, action FROM fx_actions) x) w
    ON w.dataset = c.dataset AND w.action = c.action WHERE c.rn = 1""")
def dom14_annotated(spark, d):
    frames = v.motion_frames(spark, d)
    users = v.table(spark, d, "events").select(*v._motion_keys()).distinct()
    episodes = users.withColumn("episode_index", F.col("recording_id")).withColumn("length", F.lit(0).cast("bigint"))
    return export_frames(export.export_dataset(users, episodes, frames, mode="annotated", annotations=v.annotations(spark, d), info=v.settings(spark, d)))


@query("FLT6_pinned", """WITH u AS (SELECT DISTINCT user_id AS recording_id FROM events ORDER BY 1 LIMIT 60),
 f AS (SELECT c.* FROM fx_covered c JOIN u ON u.recording_id = c.recording_id WHERE c.rn = 1),
 w AS (SELECT dataset, action, row_number() OVER (PARTITION BY dataset ORDER BY action) AS idx FROM (SELECT DISTINCT a.dataset, a.action FROM fx_actions a JOIN u ON u.recording_id = a.recording_id) x)
 SELECT f.dataset, f.recording_id, f.frame_index, s.ep AS episode_index, CAST(s.start + f.frame_index AS BIGINT) AS index,
  CASE WHEN f.recording_id % 10 = 0 THEN f.task_index ELSE coalesce(w.idx, 0) END AS task_index FROM f
  JOIN (SELECT dataset, recording_id, CAST(row_number() OVER p - 1 AS BIGINT) AS ep, coalesce(sum(n) OVER (p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM (SELECT dataset, recording_id, count(*) AS n FROM f GROUP BY 1, 2) q WINDOW p AS (PARTITION BY dataset ORDER BY recording_id)) s ON s.recording_id = f.recording_id
  LEFT JOIN w ON w.dataset = f.dataset AND w.action = f.action""")
def flt6_pinned(spark, d):
    """The first 60 recordings, labelled by the pinned version of their annotations although there is a newer one."""
    users = v.table(spark, d, "events").select(*v._motion_keys()).distinct()
    episodes = users.withColumn("episode_index", F.col("recording_id")).withColumn("length", F.lit(0).cast("bigint"))
    pinned = v.annotations(spark, d).withColumn("version", F.lit(1))
    newer = pinned.withColumn("version", F.lit(2)).withColumn("actions", F.transform(
        "actions", lambda a: a.withField("action_english", F.concat(F.lit("later "), a["action_english"]))))
    return export_frames(export.export_dataset(
        users, episodes, v.motion_frames(spark, d), mode="annotated", annotations=pinned.unionByName(newer), info=v.settings(spark, d),
        annotation_version=1, limit=60))


@query("SET2_frames", """SELECT 'all' AS dataset, f.recording_id, f.frame_index, s.ep AS episode_index, CAST(s.start + f.frame_index AS BIGINT) AS index FROM fx_frames f
  JOIN (SELECT e.recording_id, e.ep, coalesce(sum(l.n) OVER (ORDER BY e.ep ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM
    (SELECT recording_id, CAST(row_number() OVER (ORDER BY recording_id) - 1 AS BIGINT) AS ep FROM fx_episodes) e JOIN fx_lengths l ON l.recording_id = e.recording_id) s ON s.recording_id = f.recording_id""")
def set2_frames(spark, d):
    _, rows = export.concatenate(v.raw_episodes(spark, d), v.placed_frames(spark, d), "all")
    return rows.select("dataset", "recording_id", "frame_index", "episode_index", "index")


#: Recordings of each task that a build takes; the third task has fewer.
QUOTAS = [("t1", 20), ("t2", 12), ("t3", 100000)]
VIEWS["fx_built"] = f"""
SELECT e.dataset, e.recording_id, e.length, CASE WHEN {HASH.replace('dataset', 'e.dataset').replace('episode_index', 'e.episode_index')} < 0.9 * 4294967296 THEN 'train' ELSE 'val' END AS split, e.episode_index
FROM fx_takes e JOIN (SELECT recording_id, task, row_number() OVER (PARTITION BY task ORDER BY CAST('0x' || substr(md5(concat_ws('/', CAST(recording_id AS VARCHAR), '42')), 1, 8) AS BIGINT), recording_id) AS n
  FROM fx_take_recordings WHERE qa IN ('pass', 'warn') AND recording_id % 11 <> 0) s ON s.recording_id = e.recording_id
  JOIN (VALUES {', '.join(f"('{t}', {n})" for t, n in QUOTAS)}) AS q(task, quota) ON q.task = s.task AND s.n <= q.quota"""
VIEWS["fx_built_numbered"] = """
SELECT dataset, split, concat(dataset, '_split/', split) AS folder, recording_id, length,
  CAST(row_number() OVER (PARTITION BY dataset, split ORDER BY episode_index) - 1 AS BIGINT) AS episode_index FROM fx_built"""


def built(spark, d):
    """A build by quotas, with time stamps, an action and a camera in its frames and info."""
    recordings = v.take_recordings(spark, d)
    evaluation = recordings.filter(F.col("recording_id") % 11 == 0)
    frames = v.take_frames(spark, d).join(v.take_settings(spark, d).select("dataset", "fps"), "dataset").select(
        "dataset", "recording_id", "frame_index", "task_index", (F.col("frame_index") / F.col("fps")).alias("timestamp"),
        F.array("state", F.col("state") / 2).alias("action"))
    words = F.array(*[F.lit(t) for t in v.VOCABULARY])
    tasks = v.take_settings(spark, d).select("dataset", F.posexplode(words).alias("task_index", "task"))
    quotas = spark.createDataFrame(QUOTAS, "class string, quota int")
    out = build.build_dataset(
        recordings, v.takes(spark, d), frames, tasks, evaluation, v.take_settings(spark, d), n=0, ratio=0.9, quotas=quotas, qas=["pass", "warn"])
    kinds = {"timestamp": ("double", [1]), "action": ("double", [2]), "cam": ("video", [240, 320, 3])}
    entries = [F.struct(F.lit(k).alias("key"), F.struct(F.lit(t).alias("dtype"), F.lit(s).cast("array<bigint>").alias("shape")).alias("value"))
               for k, (t, s) in kinds.items()]
    out["info"] = out["info"].withColumn("features", F.map_from_entries(F.array(*entries)))
    return out


@query("VER6", """SELECT n.folder AS dataset, count(*) AS total_episodes, CAST(sum(length) AS BIGINT) AS total_frames, any_value(c.chunks_size) AS chunks_size, any_value(c.fps) AS fps,
  CAST(ceil(count(*) / any_value(c.chunks_size)) AS BIGINT) AS total_chunks, count(*) * any_value(c.cameras) AS total_videos, concat('0:', CAST(count(*) AS VARCHAR)) AS range
  FROM fx_built_numbered n JOIN fx_take_settings c ON c.dataset = n.dataset GROUP BY n.folder""")
def ver6(spark, d):
    """What a build committed: filter, leaks, quotas, split, staged files, doctor, commit, and the real reader."""
    path = v.scratch(spark)
    build.publish(built(spark, d), path)
    info = readers.read_info(spark, path)
    return info.select("dataset", "total_episodes", "total_frames", "chunks_size", "fps", "total_chunks", "total_videos",
                       F.map_values("splits")[0].alias("range"))


@query("VER6_frames", """SELECT n.folder AS dataset, n.episode_index, f.frame_index, f.recording_id, CAST(s.start + f.frame_index AS BIGINT) AS index FROM fx_take_frames f
  JOIN fx_built_numbered n ON n.recording_id = f.recording_id JOIN (SELECT recording_id, coalesce(sum(length) OVER (PARTITION BY folder ORDER BY episode_index
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM fx_built_numbered) s ON s.recording_id = f.recording_id""")
def ver6_frames(spark, d):
    path = v.scratch(spark)
    build.publish(built(spark, d), path)
    return readers.read_frames(spark, path, ["recording_id", "index"]).drop("chunk")


VIEWS["fx_clean"] = """
SELECT e.dataset, e.recording_id FROM fx_episodes e JOIN fx_recordings r ON r.recording_id = e.recording_id
WHERE r.qa IN ('pass', 'warn') AND r.recording_id NOT IN (SELECT recording_id FROM fx_members WHERE dataset_type <> 'train')"""


@query("VER6_gate", """SELECT dataset, CASE WHEN files <> rows THEN 'fail' ELSE 'warn' END AS status, CASE WHEN files <> rows THEN 'must fix' ELSE 'partly failing' END AS verdict
  FROM (SELECT b.dataset, count(*) AS rows, count(l.n) AS files FROM fx_clean b LEFT JOIN fx_lengths l ON l.recording_id = b.recording_id GROUP BY b.dataset) x""")
def ver6_gate(spark, d):
    """The doctor's verdict on a build of every clean recording of the lake, without quota or limit."""
    evaluation = members(spark, d).filter(F.col("dataset_type") != "train")
    return build.build_dataset(
        v.recordings(spark, d), v.episodes(spark, d), v.placed_frames(spark, d), v.tasks(spark, d), evaluation, v.settings(spark, d),
        n=None, ratio=0.9, qas=["pass", "warn"])["verdict"]
