"""Checks and motion analysis."""

from pyspark.sql import functions as F

from tracemill.operators import motion, quality
from tracemill.operators.positions import dense_position
from workload import views as v
from workload.q_paths import FILE_SQL
from workload.q_stats import r
from workload.registry import VIEWS, query

VIEWS["fx_data_frames"] = "SELECT dataset, count(*) AS n FROM fx_frames GROUP BY dataset"
VIEWS["fx_length_check"] = """
SELECT e.dataset, e.recording_id, e.length, l.n AS actual, e.length = l.n AS matches FROM fx_episodes e
JOIN (SELECT recording_id, count(*) AS n FROM fx_frames GROUP BY recording_id) l ON l.recording_id = e.recording_id"""


@query("QC1", """SELECT d.dataset, i.frames AS meta_frames, coalesce(n, 0) AS data_frames, CASE WHEN i.frames IS NULL THEN 'skipped' WHEN i.frames = coalesce(n, 0) THEN 'ok' ELSE 'problem' END AS status
  FROM fx_manifest d LEFT JOIN fx_info i ON i.dataset = d.dataset LEFT JOIN fx_data_frames f ON f.dataset = d.dataset""")
def qc1(spark, d):
    return quality.frame_integrity(v.wide_manifest(spark, d), v.raw_episodes(spark, d), v.frames(spark, d))


@query("QC2", "SELECT dataset, recording_id, length, actual, matches FROM fx_length_check")
def qc2(spark, d):
    return quality.episode_lengths(v.raw_episodes(spark, d), v.frames(spark, d))


@query("QC2_counts", "SELECT dataset, count(*) AS episodes, count(*) FILTER (NOT matches) AS mismatches FROM fx_length_check GROUP BY dataset")
def qc2_counts(spark, d):
    return quality.length_mismatches(v.raw_episodes(spark, d), v.frames(spark, d))


@query("QC3", """SELECT e.dataset, count(*) AS metadata_rows, count(l.recording_id) AS files, count(*) = count(l.recording_id) AS ok FROM fx_episodes e
  LEFT JOIN fx_length_check l ON l.recording_id = e.recording_id GROUP BY e.dataset""")
def qc3(spark, d):
    return quality.file_count_check(v.raw_episodes(spark, d), v.frames(spark, d))


@query("W2_check", """SELECT e.dataset, count(l.recording_id) AS files, count(*) AS metadata_rows, count(*) FILTER (NOT l.matches) AS mismatches, count(*) = count(l.recording_id) AS ok
  FROM fx_episodes e LEFT JOIN fx_length_check l ON l.recording_id = e.recording_id GROUP BY e.dataset""")
def w2_check(spark, d):
    from tracemill.operators.indices import numbering_check

    return numbering_check(v.frames(spark, d), v.raw_episodes(spark, d))


@query("QC4", """SELECT m.dataset, CASE WHEN n IS NULL THEN 'not_found' WHEN n > 0 THEN 'has_chinese' ELSE 'no_chinese' END AS status, coalesce(n, 0) AS chinese_tasks
  FROM (SELECT concat('ds', CAST(n_nationkey AS VARCHAR)) AS dataset FROM nation) m
  LEFT JOIN (SELECT dataset, count(*) FILTER (regexp_matches(task, '[一-鿿]')) AS n FROM fx_task_text GROUP BY dataset) t ON t.dataset = m.dataset""")
def qc4(spark, d):
    return quality.chinese_report(_named(spark, d), v.task_text(spark, d))


def _named(spark, d):
    return v.table(spark, d, "nation").select(F.concat(F.lit("ds"), F.col("n_nationkey").cast("string")).alias("dataset"))


@query("QC4_summary", """SELECT count(*) AS total, count(*) FILTER (n = 0) AS no_chinese, count(*) FILTER (n > 0) AS has_chinese, count(*) FILTER (n IS NULL) AS not_found, CAST(0 AS BIGINT) AS error,
  count(*) FILTER (n > 0) = 0 AS passed FROM (SELECT concat('ds', CAST(n_nationkey AS VARCHAR)) AS dataset FROM nation) m
  LEFT JOIN (SELECT dataset, count(*) FILTER (regexp_matches(task, '[一-鿿]')) AS n FROM fx_task_text GROUP BY dataset) t ON t.dataset = m.dataset""")
def qc4_summary(spark, d):
    return quality.chinese_summary(quality.chinese_report(_named(spark, d), v.task_text(spark, d)))


VIEWS["fx_offending"] = """
SELECT dataset, line, task_index, task, array_to_string(regexp_extract_all(task, '[一-鿿]+'), ',') AS chinese FROM
 (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY task_index) AS line FROM fx_task_text) t WHERE regexp_matches(task, '[一-鿿]')"""


def numbered_tasks(spark, d):
    """Task lines with their line number in the vocabulary of the dataset."""
    placed = dense_position(v.task_text(spark, d), ["dataset"], ["task_index"], "line")
    return placed.withColumn("line", F.col("line") + 1)


@query("QC4_rows", "SELECT dataset, line, task_index, task, chinese FROM fx_offending")
def qc4_rows(spark, d):
    return quality.chinese_tasks(numbered_tasks(spark, d)).withColumn("chinese", F.array_join("chinese", ","))


@query("ORD2", """SELECT dataset, line, task_index, rank, greatest(n - 3, 0) AS more FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY line) AS rank,
  count(*) OVER (PARTITION BY dataset) AS n FROM fx_offending) x WHERE rank <= 3""")
def ord2(spark, d):
    return quality.first_offenders(quality.chinese_tasks(numbered_tasks(spark, d))).select("dataset", "line", "task_index", "rank", "more")


@query("SRC3", "SELECT dataset, line, task_index, task FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY task_index) AS line FROM fx_task_text) t WHERE task_index % 5 > 1")
def src3(spark, d):
    rows = numbered_tasks(spark, d)
    value = F.when(F.col("task_index") % 5 == 0, " ").when(F.col("task_index") % 5 == 1, "{broken").otherwise(
        F.to_json(F.struct("task_index", "task")))
    return quality.parse_task_lines(rows.select("dataset", "line", value.alias("value")))


@query("QC5", """SELECT d.dataset, p.path FROM fx_manifest d CROSS JOIN (VALUES ('dataset.json'), ('meta/info.json'), ('meta/tasks.jsonl'), ('meta/episodes.jsonl'), ('meta/episodes_stats.jsonl')) AS p(path)
  WHERE d.dataset NOT IN (SELECT dataset FROM fx_datasets)""")
def qc5(spark, d):
    files = v.datasets(spark, d).select("dataset", F.explode(F.array(*[F.lit(p) for p in quality.REQUIRED_FILES])).alias("path"))
    return quality.missing_files(v.wide_manifest(spark, d), files)


@query("QC5_fields", """SELECT dataset, 'length' AS field, count(*) - count(length) AS missing FROM fx_episodes GROUP BY dataset
  UNION ALL SELECT dataset, 'dagger_type', count(*) - count(dagger_type) FROM fx_episodes GROUP BY dataset""")
def qc5_fields(spark, d):
    return quality.missing_fields(v.raw_episodes(spark, d), ["length", "dagger_type"])


@query("QC6", """SELECT episode, count(*) AS frames, count(*) FILTER (s - p <= 0) AS not_rising, count(*) FILTER (s - p > 1.5 / 0.00002) AS jumps FROM
  (SELECT episode, s, lag(s) OVER (PARTITION BY episode ORDER BY frame_index) AS p FROM (SELECT *, CAST(floor(epoch_us(ts) / 1000000) AS DOUBLE) AS s FROM fx_signal) a) b GROUP BY episode""")
def qc6(spark, d):
    seconds = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000000).cast("double")
    rows = v.placed_events(spark, d).withColumn("seconds", seconds)
    return quality.time_steps(rows, ["episode"], "frame_index", "seconds", 0.00002)


@query("QC7", """SELECT label, CAST(dim AS BIGINT) AS dim, round(stddev_pop(x), 6) AS spread, stddev_pop(x) < 1e-6 AND dim <> 63 AS frozen FROM
  (SELECT label, dim, CASE WHEN label = 3 AND dim >= 60 THEN 0.0::DOUBLE ELSE e::DOUBLE END AS x FROM
  (SELECT label, unnest(generate_series(0, 63)) AS dim, unnest(embedding) AS e FROM embeddings) q) t GROUP BY label, dim""")
def qc7(spark, d):
    still = F.transform("embedding", lambda x, i: F.when((F.col("label") == 3) & (i >= 60), F.lit(0.0).cast("float")).otherwise(x))
    out = quality.frozen_dimensions(v.table(spark, d, "embeddings").select("label", still.alias("vector")), ["label"], "vector", exempt=[63])
    return out.select("label", F.col("dim").cast("bigint").alias("dim"), r(F.col("spread")).alias("spread"), "frozen")


@query("QC8", """SELECT dataset, count(DISTINCT (h, w)) AS sizes, count(*) FILTER (h <> 240 OR w <> 320) AS unexpected, count(DISTINCT (h, w)) = 1 AND count(*) FILTER (h <> 240 OR w <> 320) = 0 AS ok
  FROM (SELECT concat('ds', CAST(l_orderkey % 40 AS VARCHAR)) AS dataset, CASE WHEN l_orderkey % 40 = 7 AND l_linenumber = 2 THEN 480 ELSE 240 END AS h, CASE WHEN l_orderkey % 40 = 9 THEN 640 ELSE 320 END AS w FROM lineitem) x GROUP BY dataset""")
def qc8(spark, d):
    key, camera = F.col("l_orderkey") % 40, F.col("l_linenumber")
    rows = v.table(spark, d, "lineitem").select(
        F.concat(F.lit("ds"), key.cast("string")).alias("dataset"), camera.alias("camera"),
        F.when((key == 7) & (camera == 2), 480).otherwise(240).alias("height"), F.when(key == 9, 640).otherwise(320).alias("width"))
    return quality.camera_resolution(rows)


CHECKS = """SELECT d.dataset, 'frame_integrity' AS rule, CASE WHEN coalesce(b, 0) = 0 THEN 'pass' ELSE 'warn' END AS status, coalesce(b, 0) AS bad, coalesce(n, 0) AS n FROM fx_datasets d
  LEFT JOIN (SELECT dataset, count(*) AS n, count(*) FILTER (NOT matches) AS b FROM fx_length_check GROUP BY dataset) c ON c.dataset = d.dataset
  UNION ALL SELECT e.dataset, 'file_count', CASE WHEN count(*) = count(l.recording_id) THEN 'pass' ELSE 'fail' END, count(*) - count(l.recording_id), count(*) FROM fx_episodes e
  LEFT JOIN fx_length_check l ON l.recording_id = e.recording_id GROUP BY e.dataset
  UNION ALL SELECT dataset, 'english_tasks', CASE WHEN count(*) FILTER (regexp_matches(task, '[一-鿿]')) = 0 THEN 'pass' ELSE 'warn' END, NULL, NULL FROM fx_tasks GROUP BY dataset
  UNION ALL SELECT dataset, 'required_files', CASE WHEN ds % 8 = 7 THEN 'fail' ELSE 'pass' END, CASE WHEN ds % 8 = 7 THEN 1 ELSE 0 END, 5 FROM fx_datasets
  UNION ALL SELECT dataset, 'time_steps', CASE WHEN sum(j) = 0 THEN 'pass' ELSE 'warn' END, CAST(sum(j) AS BIGINT), count(*) FROM
    (SELECT f.dataset, f.recording_id, CASE WHEN any_value(d.ds) % 8 = 5 AND count(*) > 3 THEN 1 ELSE 0 END AS j FROM fx_frames f JOIN fx_datasets d ON d.dataset = f.dataset GROUP BY 1, 2) s GROUP BY dataset
  UNION ALL SELECT f.dataset, 'frozen_action', CASE WHEN any_value(d.ds) % 8 = 3 THEN 'warn' ELSE 'pass' END, CASE WHEN any_value(d.ds) % 8 = 3 THEN 1 ELSE 0 END, 2
    FROM fx_frames f JOIN fx_datasets d ON d.dataset = f.dataset GROUP BY f.dataset
  UNION ALL SELECT d.dataset, 'camera_resolution', CASE WHEN d.ds % 8 = 1 THEN 'fail' ELSE 'pass' END, CASE WHEN d.ds % 8 = 1 THEN 1 ELSE 0 END, c.cameras FROM fx_datasets d JOIN fx_settings c ON c.dataset = d.dataset"""
VIEWS["fx_checks"] = CHECKS


def checks(spark, d):
    """Each sensor rule fails for every eighth dataset, another one for each rule."""
    sets, settings = v.datasets(spark, d), v.settings(spark, d)
    turn = F.col("ds") % 8
    files = sets.select("dataset", "ds", F.explode(F.array(*[F.lit(p) for p in quality.REQUIRED_FILES])).alias("path"))
    stamps = v.placed_frames(spark, d).join(sets, "dataset").join(settings, "dataset").withColumn(
        "seconds", F.col("frame_index") / F.col("fps") + F.when((turn == 5) & (F.col("frame_index") >= 3), 1.0).otherwise(0.0))
    moves = F.when(turn == 3, F.lit(0.0)).otherwise(F.col("frame_index").cast("double"))
    vectors = stamps.select("dataset", F.array(F.col("state").cast("double"), moves).alias("vector"))
    cameras = sets.join(settings, "dataset").select("dataset", F.explode(F.sequence(F.lit(1), F.col("cameras"))).alias("camera"), "ds").select(
        "dataset", "camera", F.when((turn == 1) & (F.col("camera") == 1), 480).otherwise(240).alias("height"), F.lit(320).alias("width"))
    sensors = quality.sensor_checks(
        v.manifest(spark, d), files=files.filter((turn != 7) | (F.col("path") != "meta/tasks.jsonl")), stamps=stamps, vectors=vectors, cameras=cameras)
    return quality.doctor_checks(v.manifest(spark, d), v.raw_episodes(spark, d), v.frames(spark, d), v.tasks(spark, d), sensors)


@query("QC9", """SELECT *, CASE WHEN pct >= 99 THEN 'ok' WHEN pct >= 85 THEN 'warn' ELSE 'bad' END AS colour FROM (SELECT *,
  CAST(CASE WHEN status = 'pass' THEN 100 WHEN bad IS NOT NULL THEN greatest(0, round_even((n - bad) / CAST(greatest(n, 1) AS DOUBLE) * 100.0, 0)) WHEN status = 'fail' THEN 82 ELSE 96 END AS BIGINT) AS pct FROM fx_checks) x""")
def qc9(spark, d):
    return quality.doctor_report(checks(spark, d))


@query("QC9_verdict", """SELECT dataset, CASE s WHEN 2 THEN 'fail' WHEN 1 THEN 'warn' ELSE 'pass' END AS status, CASE s WHEN 2 THEN 'must fix' WHEN 1 THEN 'partly failing' ELSE 'may train' END AS verdict
  FROM (SELECT dataset, max(CASE status WHEN 'fail' THEN 2 WHEN 'warn' THEN 1 ELSE 0 END) AS s FROM fx_checks GROUP BY dataset) x""")
def qc9_verdict(spark, d):
    return quality.doctor_verdict(checks(spark, d))


@query("W7", """SELECT episode, frame_index, round(30 * (cmd - lag(cmd) OVER w), 5) AS cmd_speed, round(900 * ((cmd - lag(cmd) OVER w) - (lag(cmd) OVER w - lag(cmd, 2) OVER w)), 4) AS cmd_acceleration,
  round(30 * (state - lag(state) OVER w), 5) AS state_speed FROM fx_signal WINDOW w AS (PARTITION BY episode ORDER BY frame_index)""")
def w7(spark, d):
    out = motion.motion_profile(v.signal(spark, d), ["episode"], ["cmd", "state"], 30)
    return out.select("episode", "frame_index", r(F.col("cmd_speed"), 5).alias("cmd_speed"), r(F.col("cmd_acceleration"), 4).alias("cmd_acceleration"),
                      r(F.col("state_speed"), 5).alias("state_speed"))


VIEWS["fx_aligned"] = """
SELECT *, coalesce(abs(cmd - before) < 0.01, false) AS static, NOT coalesce(abs(cmd - before) < 0.01, false) AND coalesce(abs(cmd - ahead) > 0.03, false) AS jitter FROM
 (SELECT episode, frame_index, cmd, state, lead(state, 8) OVER w AS ahead, lag(cmd) OVER w AS before FROM fx_signal WINDOW w AS (PARTITION BY episode ORDER BY frame_index)) x"""


@query("W8", "SELECT episode, frame_index, round(ahead, 6) AS aligned_state, static, jitter FROM fx_aligned")
def w8(spark, d):
    rows = motion.aligned(v.signal(spark, d), ["episode"])
    return rows.select("episode", "frame_index", r(F.col("aligned_state")).alias("aligned_state"), "static", "jitter")


@query("W8_rate", """SELECT episode, count(*) AS frames, count(*) FILTER (static) AS static_frames, count(*) FILTER (jitter) AS jitter_frames,
  round(count(*) FILTER (jitter) / CAST(count(*) AS DOUBLE), 6) AS jitter_rate FROM fx_aligned GROUP BY episode""")
def w8_rate(spark, d):
    rows = motion.jitter_rate(motion.aligned(v.signal(spark, d), ["episode"]), ["episode"])
    return rows.withColumn("jitter_rate", r(F.col("jitter_rate")))


@query("AGG19", """SELECT event_type, greatest(least(CAST(floor((value - low) / CASE WHEN high = low THEN 1 ELSE (high - low) / 30.0 END) AS BIGINT), 29), 0) AS bin, count(*) AS count
  FROM (SELECT event_type, value, min(value) OVER (PARTITION BY event_type) AS low, max(value) OVER (PARTITION BY event_type) AS high FROM events) x GROUP BY 1, 2""")
def agg19(spark, d):
    return motion.histogram(v.table(spark, d, "events").select("event_type", "value"), ["event_type"], "value").select("event_type", "bin", "count")


@query("AGG19_middle", """SELECT x.event_type, m.n, round(m.mean, 6) AS mean, round(x.value, 6) AS median FROM
  (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i FROM events) x
  JOIN (SELECT event_type, count(value) AS n, avg(value) AS mean FROM events GROUP BY event_type) m ON m.event_type = x.event_type AND x.i = m.n // 2""")
def agg19_middle(spark, d):
    rows = v.table(spark, d, "events").select("event_type", "value")
    summary = motion.signal_range(rows, ["event_type"], "value")
    out = summary.join(motion.upper_median(rows, ["event_type"], "value"), "event_type")
    return out.select("event_type", "n", r(F.col("mean")).alias("mean"), r(F.col("median")).alias("median"))
