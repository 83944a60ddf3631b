"""Functions over paths, names and numbers."""

from pyspark.sql import functions as F

from tracemill.functions import numbers, paths, recordings as rec, text
from tracemill.operators import compose
from workload import views as v
from workload.registry import query


@query("FN1", f"SELECT dataset, {v.GROUP_CASE.format('dataset')} AS grp FROM fx_datasets")
def fn1(spark, d):
    return v.datasets(spark, d).select("dataset", paths.match_group(F.col("dataset"), v.RULES).alias("grp"))


@query("FN2", "SELECT dataset, split_part(dataset, '/', 1) AS category FROM fx_datasets")
def fn2(spark, d):
    return v.datasets(spark, d).select("dataset", paths.category(F.col("dataset")).alias("category"))


@query("FN3", """SELECT dataset, concat(split_part(dataset, '/', 1), '/', regexp_replace(regexp_replace(split_part(dataset, '/', 2),
  '_moz1-[a-z0-9]+$', '', 'i'), '_hrpi\\d*-[a-z0-9]+$', '', 'i')) AS subcategory FROM fx_datasets""")
def fn3(spark, d):
    return v.datasets(spark, d).select("dataset", paths.subcategory(F.col("dataset")).alias("subcategory"))


@query("FN4", "SELECT dataset, regexp_replace(dataset, '/dataset_[^/]*$', '') AS task_folder FROM fx_datasets")
def fn4(spark, d):
    return v.datasets(spark, d).select("dataset", paths.task_folder(F.col("dataset")).alias("task_folder"))


@query("FN5", "SELECT dataset, starts_with(dataset, '202510_all_dual/') AS dual FROM fx_datasets")
def fn5(spark, d):
    return v.datasets(spark, d).select("dataset", paths.is_dual(F.col("dataset")).alias("dual"))


@query("FN6", """SELECT task_index, regexp_matches(task, '[一-鿿]') AS has_chinese,
  array_to_string(regexp_extract_all(task, '[一-鿿]+'), ',') AS runs FROM fx_task_text""")
def fn6(spark, d):
    task = F.col("task")
    return v.task_text(spark, d).select(
        "task_index", text.contains_chinese(task).alias("has_chinese"), F.array_join(text.find_chinese(task), ",").alias("runs"))


@query("FN7", """SELECT recording_id, array_to_string([CASE WHEN contains(t, ':')
  THEN trim(regexp_replace(t, '^[^:]*:', '')) ELSE t END FOR t IN tasks], '|') AS tasks FROM fx_episodes""")
def fn7(spark, d):
    return v.raw_episodes(spark, d).select("recording_id", F.array_join(text.english_only_all(F.col("tasks")), "|").alias("tasks"))


@query("FN8", """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN coalesce(CASE WHEN user_id % 2 = 0 THEN 'n' END, 'unknown') ELSE event_type END AS english_first,
  coalesce(CASE WHEN user_id % 2 = 0 THEN 'n' END, CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END, 'unknown') AS native_first FROM events""")
def fn8(spark, d):
    english = F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("event_type"))
    native = F.when(F.col("user_id") % 2 == 0, "n")
    return v.table(spark, d, "events").select(
        "event_id", text.action_name(native, english).alias("english_first"),
        text.action_name(native, english, "action").alias("native_first"))


@query("FN9", """SELECT recording_id, round(frames / 30.0 / 3600.0, 6) AS hours,
  format('{:02d}:{:02d}:{:02d}', frames // 30 // 3600, frames // 30 % 3600 // 60, frames // 30 % 60) AS duration,
  round_even(frames / 30.0 / 60.0, 1) AS minutes FROM fx_recordings""")
def fn9(spark, d):
    f = F.col("frames")
    return v.recordings(spark, d).select(
        "recording_id", F.round(numbers.frames_to_hours(f), 6).alias("hours"), numbers.hms(f).alias("duration"),
        numbers.minutes(f).alias("minutes"))


@query("FN10", """SELECT dataset, recording_id, pos, CAST(floor(start_time * 30) AS BIGINT) AS first, CAST(ceil(end_time * 30) AS BIGINT) AS last FROM fx_actions""")
def fn10(spark, d):
    rows = v.annotations(spark, d).select("dataset", "recording_id", F.posexplode("actions").alias("pos", "a"))
    fps = F.lit(30.0)
    return rows.select(
        "dataset", "recording_id", F.col("pos").cast("bigint").alias("pos"),
        numbers.first_frame(F.col("a.start_time"), fps).alias("first"), numbers.last_frame(F.col("a.end_time"), fps).alias("last"))


FILE_SQL = "concat(dataset, '/data/chunk-', lpad(CAST(o // 1000 AS VARCHAR), 3, '0'), '/episode_', lpad(CAST(o AS VARCHAR), 6, '0'), '.parquet')"


def files(spark, d):
    o = F.col("recording_id")
    path = F.concat("dataset", F.format_string("/data/chunk-%03d/episode_%06d.parquet", F.floor(o / 1000), o))
    return v.raw_episodes(spark, d).select("dataset", "recording_id", path.alias("path"))


@query("FN11", f"""SELECT path, CAST(regexp_extract(path, 'episode_(\\d+)', 1) AS BIGINT) AS episode, CAST(regexp_extract(path, 'chunk-(\\d+)', 1) AS BIGINT) AS chunk
  FROM (SELECT {FILE_SQL} AS path FROM (SELECT dataset, recording_id AS o FROM fx_episodes) e) f""")
def fn11(spark, d):
    path = F.col("path")
    return files(spark, d).select("path", paths.episode_from_path(path).alias("episode"), paths.chunk_from_path(path).alias("chunk"))


@query("FN12", """SELECT recording_id, concat(dataset, '/data/chunk-', lpad(CAST(episode_index // 100 AS VARCHAR), 3, '0'), '/episode_',
  lpad(CAST(episode_index AS VARCHAR), 6, '0'), '.parquet') AS path FROM fx_episodes""")
def fn12(spark, d):
    rows = files(spark, d).join(v.episodes(spark, d).select("recording_id", "episode_index"), "recording_id")
    return rows.select("recording_id", paths.episode_path(F.col("path"), F.col("episode_index"), 100).alias("path"))


@query("FN15", """SELECT vec_id, CAST(round_even(x * 100.0, 0) AS BIGINT) AS pct, CAST(trunc(x * 1000) AS BIGINT) AS frames
  FROM (SELECT vec_id, (vec_id % 400) / 400.0 AS x FROM embeddings) e""")
def fn15(spark, d):
    ratio = (F.col("vec_id") % 400) / F.lit(400.0)
    return v.table(spark, d, "embeddings").select(
        "vec_id", numbers.pct(ratio).alias("pct"), numbers.frames_of(ratio, F.lit(1000)).alias("frames"))


def feature_map(key):
    names = ("state", "cmd", "gripper")
    entries = [F.when(key % (i + 2) == 0, F.struct(F.lit(n).alias("key"), F.struct(F.lit("float32").alias("dtype")).alias("value")))
               for i, n in enumerate(names)]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e.isNotNull()))


FEATURE_SQL = """concat(CASE WHEN c_custkey % 3 = 0 THEN 'c' ELSE '' END, CASE WHEN c_custkey % 4 = 0 THEN 'g' ELSE '' END,
  CASE WHEN c_custkey % 2 = 0 THEN 's' ELSE '' END)"""


def collections(spark, d):
    key = F.col("c_custkey")
    return v.table(spark, d, "customer").select(key.alias("collection_id"), feature_map(key).alias("features"))


@query("FN16", f"SELECT length(x) AS n_features, count(*) AS collections FROM (SELECT {FEATURE_SQL} AS x FROM customer) c GROUP BY x")
def fn16(spark, d):
    rows = collections(spark, d).withColumn("h", numbers.features_hash(F.col("features")))
    return rows.groupBy("h").agg(
        F.max(F.size("features")).cast("bigint").alias("n_features"), F.count(F.lit(1)).alias("collections")).drop("h")


@query("AGG20", f"""SELECT length(x) AS n_features, collection_id, min(collection_id) OVER (PARTITION BY x) AS first_collection
  FROM (SELECT {FEATURE_SQL} AS x, c_custkey AS collection_id FROM customer) c WHERE x <> ''""")
def agg20(spark, d):
    groups = compose.feature_groups(collections(spark, d), numbers.features_hash)
    first = groups.groupBy("features_hash").agg(F.min("collection_id").alias("first_collection"))
    return groups.join(first, "features_hash").drop("features_hash")


@query("AGG20_names", f"""SELECT length(x) AS n_features, count(*) AS collections FROM (SELECT {FEATURE_SQL} AS x FROM customer) c WHERE x <> '' GROUP BY x""")
def agg20_names(spark, d):
    groups = compose.feature_groups(collections(spark, d), numbers.features_hash)
    return compose.feature_group_names(groups).select("n_features", "collections")


@query("AGG20_export", f"""SELECT length(c.x) AS n_features, r.collection_id, r.recording_id, min(r.recording_id) OVER (PARTITION BY c.x) AS first_recording
  FROM (SELECT {FEATURE_SQL} AS x, c_custkey AS collection_id FROM customer) c JOIN fx_recordings r ON r.collection_id = c.collection_id
  WHERE c.x <> '' AND r.qa = 'pass' AND r.device = 'dev_a' AND r.operator IN ('op_a', 'op_b')
    AND r.collected_at >= TIMESTAMP '1995-01-01 00:00:00' AND r.collected_at < TIMESTAMP '1998-01-01 00:00:00'""")
def agg20_export(spark, d):
    groups = compose.feature_groups(collections(spark, d), numbers.features_hash)
    taken = compose.feature_group_recordings(
        groups, v.recordings(spark, d), devices=["dev_a"], operators=["op_a", "op_b"], from_date="1995-01-01", to_date="1997-12-31")
    first = taken.groupBy("features_hash").agg(F.min("recording_id").alias("first_recording"))
    return taken.join(first, "features_hash").drop("features_hash")


@query("FN17", """SELECT dataset, concat('v', CAST(max(seq) + 1 AS VARCHAR)) AS next FROM fx_versions GROUP BY dataset""")
def fn17(spark, d):
    from tracemill.operators import versions

    return versions.next_versions(v.versions(spark, d)).select("dataset", F.col("version").alias("next"))


@query("FN18", "SELECT operator_id, concat('--ratio,--seed,K', CAST(n_regionkey AS VARCHAR)) AS keys FROM fx_operators o JOIN nation ON operator_id = concat('op_', CAST(n_nationkey AS VARCHAR))")
def fn18(spark, d):
    return v.operators(spark, d).select("operator_id", F.array_join(rec.param_keys(F.col("params")), ",").alias("keys"))
