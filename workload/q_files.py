"""Sources and sinks: tables written to the shared folder and read back."""

from pyspark.sql import functions as F

from tracemill.operators import split
from tracemill.session import materialise
from tracemill.sources import readers, snapshots, writers
from workload import views as v
from workload.q_domain import HASH
from workload.registry import VIEWS, query


@query("SRC1", "SELECT dataset, weight FROM fx_datasets")
def src1(spark, d):
    """One manifest document per dataset, read as whole files."""
    path = v.scratch(spark)
    rows = v.datasets(spark, d)
    rows.select("ds", F.to_json(F.create_map("dataset", "weight")).alias("value")).write.partitionBy("ds").text(path)
    return readers.read_manifest(spark, path)


@query("SNK2", "SELECT dataset, weight FROM fx_datasets")
def snk2(spark, d):
    path = v.scratch(spark)
    writers.write_manifest(v.manifest(spark, d), path)
    return readers.read_manifest_lines(spark, path)


@query("SNK2_lines", """SELECT dataset, concat(CASE WHEN dataset = min(dataset) OVER () THEN '{' ELSE ',' END, '"', dataset, '":', CAST(weight AS VARCHAR),
  CASE WHEN dataset = max(dataset) OVER () THEN '}' ELSE '' END) AS value FROM fx_datasets""")
def snk2_lines(spark, d):
    return writers.manifest_lines(v.manifest(spark, d))


VIEWS["fx_take_sides"] = f"SELECT *, CASE WHEN {HASH} < 0.9 * 4294967296 THEN 'train' ELSE 'val' END AS split FROM fx_takes"
VIEWS["fx_take_numbered"] = """
SELECT dataset, split, concat(dataset, '_split/', split) AS folder, recording_id, length,
  CAST(row_number() OVER (PARTITION BY dataset, split ORDER BY episode_index) - 1 AS BIGINT) AS episode_index FROM fx_take_sides"""


def stored(spark, d, with_stats=False):
    """Both sides of every dataset written as a snapshot: its path."""
    path = v.scratch(spark)
    sided = materialise(split.split_by_hash(v.takes(spark, d), 0.9))
    episodes = materialise(split.split_episodes(sided))
    frames = split.split_frames(v.take_frames(spark, d), episodes)
    words = F.array(*[F.lit(t) for t in v.VOCABULARY])
    tasks = v.take_settings(spark, d).select("dataset", F.posexplode(words).alias("task_index", "task"))
    tables = {
        "frames": frames, "episodes": episodes.withColumn("tasks", F.array(F.concat(F.lit("t"), (F.col("recording_id") % 3).cast("string")))),
        "info": split.split_metadata(sided, v.take_settings(spark, d)), "tasks": tasks}
    if with_stats:
        tables["episode_stats"] = frames.groupBy("dataset", "split", "episode_index").agg(
            F.struct(F.min("state").alias("min"), F.max("state").alias("max")).alias("stats"))
    snapshots.write_snapshot(tables, path)
    return path


@query("SRC2_files", """SELECT n.folder AS dataset, count(*) AS total_episodes, CAST(sum(length) AS BIGINT) AS total_frames, CAST(ceil(count(*) / any_value(c.chunks_size)) AS BIGINT) AS total_chunks,
  count(*) * any_value(c.cameras) AS total_videos, any_value(c.chunks_size) AS chunks_size, any_value(c.fps) AS fps, concat(any_value(n.split), ' 0:', CAST(count(*) AS VARCHAR)) AS range,
  'double' AS state FROM fx_take_numbered n JOIN fx_take_settings c ON c.dataset = n.dataset GROUP BY n.folder""")
def src2_files(spark, d):
    info = readers.read_info(spark, stored(spark, d))
    side = F.map_keys("splits")[0]
    return info.select("dataset", "total_episodes", "total_frames", "total_chunks", "total_videos", "chunks_size", "fps",
                       F.concat(side, F.lit(" "), F.element_at("splits", side)).alias("range"), F.col("features")["state"]["dtype"].alias("state"))


@query("SRC3_tasks", """SELECT DISTINCT n.folder AS dataset, CAST(t.task_index AS BIGINT) AS task_index, t.task FROM fx_take_numbered n
  CROSS JOIN (VALUES (0, 'unknown'), (1, 'pick the cup'), (2, '擦白板: wipe the board'), (3, 'pour water')) AS t(task_index, task)""")
def src3_tasks(spark, d):
    return readers.read_tasks(spark, stored(spark, d))


@query("SRC3_episodes", "SELECT folder AS dataset, episode_index, recording_id, length, concat('t', CAST(recording_id % 3 AS VARCHAR)) AS task FROM fx_take_numbered")
def src3_episodes(spark, d):
    return readers.read_episodes(spark, stored(spark, d)).select("dataset", "episode_index", "recording_id", "length", F.col("tasks")[0].alias("task"))


@query("SRC3_stats", """SELECT n.folder AS dataset, n.episode_index, min(f.state) AS low, max(f.state) AS high FROM fx_take_frames f
  JOIN fx_take_numbered n ON n.recording_id = f.recording_id GROUP BY 1, 2""")
def src3_stats(spark, d):
    stats = readers.read_episode_stats(spark, stored(spark, d, with_stats=True))
    found = F.from_json("stats", "min double, max double")
    return stats.select("dataset", "episode_index", found["min"].alias("low"), found["max"].alias("high"))


@query("SRC4", """SELECT n.folder AS dataset, n.episode_index // c.chunks_size AS chunk, n.episode_index, f.frame_index, f.task_index FROM fx_take_frames f
  JOIN fx_take_numbered n ON n.recording_id = f.recording_id JOIN fx_take_settings c ON c.dataset = n.dataset""")
def src4(spark, d):
    """Episode files of a snapshot; only the needed columns are read."""
    return readers.read_frames(spark, stored(spark, d), ["task_index"])


@query("SNK1", """SELECT n.folder AS dataset, n.episode_index // c.chunks_size AS chunk, n.episode_index, f.frame_index, f.recording_id, f.task_index, f.state,
  CAST(s.start + f.frame_index AS BIGINT) AS index FROM fx_take_frames f JOIN fx_take_numbered n ON n.recording_id = f.recording_id
  JOIN fx_take_settings c ON c.dataset = n.dataset JOIN (SELECT recording_id, coalesce(sum(length) OVER (PARTITION BY folder ORDER BY episode_index
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM fx_take_numbered) s ON s.recording_id = f.recording_id""")
def snk1(spark, d):
    """All columns of all frames, written and read back; SRC2_files and SRC3_* compare the metadata."""
    return readers.read_frames(spark, stored(spark, d), ["recording_id", "task_index", "state", "index"])


@query("SNK3", "SELECT dataset, CAST(task_index AS VARCHAR) AS task_index, CAST(count(*) AS VARCHAR) AS frames FROM fx_frames GROUP BY dataset, task_index")
def snk3(spark, d):
    from tracemill.operators.stats import frames_per_task

    path = v.scratch(spark)
    writers.write_report(frames_per_task(v.frames(spark, d)), path)
    return spark.read.option("header", True).csv(path)


def documents(spark, d):
    """Annotation documents: every third in the older format, every seventh empty."""
    key = F.col("recording_id")
    flat = F.to_json(F.struct(F.lit("3.0.0").alias("version"), F.col("actions").alias("data")))
    old = F.transform("actions", lambda a: F.struct(
        a["start_time"].alias("start"), a["end_time"].alias("end"), a["action_english"].alias("description")))
    nested = F.to_json(F.struct(F.struct(old.alias("actionAnnotationList")).alias("annotation")))
    text = F.when(key % 7 == 0, '{"version":"3.0.0","data":[]}').when(key % 3 == 0, nested).otherwise(flat)
    return v.annotations(spark, d).select("dataset", "recording_id", text.alias("annotation"))


ACTIONS = """SELECT dataset, recording_id, pos, round(start_time, 6) AS start_time, round(end_time, 6) AS end_time,
  CASE WHEN recording_id % 3 = 0 THEN action ELSE '' END AS action, CASE WHEN recording_id % 3 <> 0 THEN action END AS action_english FROM fx_actions WHERE recording_id % 7 <> 0"""


def listed(parsed):
    rows = parsed.select("dataset", "recording_id", F.posexplode("actions").alias("pos", "a"))
    return rows.select("dataset", "recording_id", F.col("pos").cast("bigint").alias("pos"), F.round("a.start_time", 6).alias("start_time"),
                       F.round("a.end_time", 6).alias("end_time"), F.col("a.action").alias("action"), F.col("a.action_english").alias("action_english"))


@query("SRC5", ACTIONS)
def src5(spark, d):
    return listed(readers.parse_annotations(documents(spark, d)))


@query("SRC6", """SELECT a.dataset, a.recording_id, count(*) FILTER (a.recording_id % 7 <> 0) AS actions, any_value(CASE WHEN a.recording_id % 2 = 0 THEN a.recording_id END) AS id, 'me' AS annotator_name
  FROM fx_actions a WHERE a.recording_id % 3 <> 0 OR a.recording_id % 7 = 0 GROUP BY 1, 2""")
def src6(spark, d):
    key = F.col("recording_id")
    episodes = documents(spark, d).select("dataset", "recording_id", F.struct(
        F.when(key % 2 == 0, key).alias("id"), F.lit(None).cast("string").alias("created_at"), F.lit("me").alias("annotator_name"),
        F.col("annotation").alias("annotation_data")).alias("annotation"))
    return readers.embedded_annotations(episodes).select(
        "dataset", "recording_id", F.size("actions").cast("bigint").alias("actions"), "id", "annotator_name")
