"""Profiles by prompt, folder and group; sampling weights and shares."""

from pyspark.sql import functions as F

from tracemill.functions.paths import match_group
from tracemill.operators import compose, sampling, stats
from tracemill.sources.writers import merge_manifests, seed_manifest
from workload import views as v
from workload.registry import VIEWS, query

GROUP = v.GROUP_CASE.format("dataset")
FOLDER = "regexp_replace(dataset, '/dataset_[^/]*$', '')"


def r(column, digits=6):
    return F.round(column, digits)


def weighted(spark, d):
    return sampling.attach_info(v.manifest(spark, d), sampling.frames_per_dataset(v.frames(spark, d)))


def counted(spark, d):
    return stats.episode_task_frames(v.by_episode(spark, d, v.frames(spark, d), ["recording_id"]))


def grouped(spark, d):
    return sampling.frames_per_dataset(v.frames(spark, d)).withColumn("grp", match_group(F.col("dataset"), v.RULES))


VIEWS["fx_prompts"] = """
SELECT f.dataset, f.recording_id, coalesce(t.task, concat('unknown_', CAST(f.task_index AS VARCHAR))) AS prompt
FROM fx_frames f LEFT JOIN fx_tasks t ON t.dataset = f.dataset AND t.task_index = f.task_index"""
VIEWS["fx_folder_prompts"] = f"""
SELECT {FOLDER} AS task_folder, prompt, count(*) AS prompt_frames, count(DISTINCT recording_id) AS recording_count FROM fx_prompts GROUP BY 1, 2"""
VIEWS["fx_folders"] = f"""
SELECT task_folder, {v.GROUP_CASE.format('task_folder')} AS grp, subdataset_count, total_frames FROM
 (SELECT {FOLDER} AS task_folder, count(*) AS subdataset_count, CAST(sum(frames) AS BIGINT) AS total_frames FROM fx_info GROUP BY 1) x"""
DURATION = """round_even({0} / 30.0 / 3600.0, 4) AS hours,
  format('{{:02d}}:{{:02d}}:{{:02d}}', {0} // 30 // 3600, {0} // 30 % 3600 // 60, {0} // 30 % 60) AS duration"""


@query("J1", "SELECT d.dataset, d.weight, i.frames FROM fx_datasets d JOIN fx_info i ON i.dataset = d.dataset")
def j1(spark, d):
    return sampling.attach_info(v.manifest(spark, d), v.info(spark, d), "error")


@query("SRC2", """SELECT d.dataset, d.weight, coalesce(i.frames, 0) AS frames, 'zero' AS policy FROM fx_manifest d
  LEFT JOIN fx_info i ON i.dataset = d.dataset
  UNION ALL SELECT d.dataset, d.weight, i.frames, 'skip' FROM fx_manifest d JOIN fx_info i ON i.dataset = d.dataset""")
def src2(spark, d):
    entries, known = v.wide_manifest(spark, d), v.info(spark, d)
    zero = sampling.attach_info(entries, known, "zero").withColumn("policy", F.lit("zero"))
    return zero.unionByName(sampling.attach_info(entries, known, "skip").withColumn("policy", F.lit("skip")))


@query("J2", "SELECT dataset, prompt, count(*) AS frames FROM fx_prompts GROUP BY dataset, prompt")
def j2(spark, d):
    counts = stats.frames_per_task(v.frames(spark, d))
    return stats.with_prompt(counts, v.tasks(spark, d)).groupBy("dataset", "prompt").agg(F.sum("frames").alias("frames"))


@query("J3", "SELECT DISTINCT e.dataset, e.episode_index, f.recording_id FROM fx_episodes e JOIN fx_frames f ON f.recording_id = e.recording_id")
def j3(spark, d):
    ids = v.frames(spark, d).select("dataset", "recording_id").distinct()
    return v.episodes(spark, d).join(ids, ["dataset", "recording_id"]).select("dataset", "episode_index", "recording_id")


@query("J4", f"SELECT dataset, weight, {GROUP} AS grp FROM fx_datasets")
def j4(spark, d):
    return sampling.match_group_table(v.manifest(spark, d), v.rules_table(spark))


@query("AGG1", "SELECT dataset, task_index, count(*) AS frames FROM fx_frames GROUP BY dataset, task_index")
def agg1(spark, d):
    return stats.frames_per_task(v.frames(spark, d))


@query("AGG2", f"SELECT DISTINCT {FOLDER} AS task_folder, prompt, recording_id FROM fx_prompts")
def agg2(spark, d):
    return stats.prompt_recordings(counted(spark, d), v.tasks(spark, d))


PROFILE = f"""SELECT f.task_folder, grp, subdataset_count, total_frames, coalesce(prompt, '') AS prompt, coalesce(prompt_frames, 0) AS prompt_frames,
  coalesce(recording_count, 0) AS recording_count, round_even(CASE WHEN total_frames > 0 THEN coalesce(prompt_frames, 0) / CAST(total_frames AS DOUBLE) ELSE 0 END, 4) AS prompt_ratio,
  {DURATION.format('total_frames')} FROM fx_folders f LEFT JOIN fx_folder_prompts p ON p.task_folder = f.task_folder"""


VIEWS["fx_subdatasets"] = f"""
SELECT {FOLDER} AS task_folder, CASE WHEN count(*) > 1 THEN string_agg(dataset, ', ' ORDER BY dataset) ELSE '' END AS subdatasets FROM fx_info GROUP BY 1"""
VIEWS["fx_prompt_ids"] = f"""
SELECT task_folder, prompt, string_agg(CAST(recording_id AS VARCHAR), ', ' ORDER BY recording_id) AS recording_ids FROM
 (SELECT DISTINCT {FOLDER} AS task_folder, prompt, recording_id FROM fx_prompts) x GROUP BY ALL"""


@query("AGG3_lists", f"""SELECT x.*, subdatasets, coalesce(recording_ids, '') AS recording_ids FROM ({PROFILE}) x
  JOIN fx_subdatasets s ON s.task_folder = x.task_folder LEFT JOIN fx_prompt_ids i ON i.task_folder = x.task_folder AND i.prompt = x.prompt""")
def agg3_lists(spark, d):
    """The whole report; AGG3 and ORD1 have its columns without the lists."""
    return stats.folder_profile(
        v.info(spark, d), counted(spark, d), v.tasks(spark, d), v.RULES)


@query("AGG3", PROFILE)
def agg3(spark, d):
    return agg3_lists(spark, d).drop("subdatasets", "recording_ids")


@query("AGG3_members", f"SELECT {FOLDER} AS task_folder, dataset FROM fx_datasets")
def agg3_members(spark, d):
    return stats.folder_members(v.manifest(spark, d))


@query("ORD1", PROFILE + " ORDER BY grp = '_other', grp, f.task_folder, prompt_frames DESC, prompt")
def ord1(spark, d):
    return stats.profile_order(agg3(spark, d))


@query("AGG4", f"""SELECT CASE WHEN lv = 0 THEN 'folder' WHEN lv = 1 THEN 'group' ELSE 'total' END AS level, coalesce(grp, '') AS grp, coalesce(task_folder, '') AS task_folder,
  CASE WHEN lv = 0 THEN subs END AS subdataset_count, total_frames, CASE WHEN lv = 0 THEN coalesce(num, 0) END AS num_prompts,
  CASE WHEN lv = 0 THEN coalesce(top, '') ELSE '' END AS top_prompt, {DURATION.format('total_frames')} FROM (
  SELECT grouping(grp, f.task_folder) AS lv, grp, f.task_folder AS task_folder, CAST(sum(subdataset_count) AS BIGINT) AS subs, CAST(sum(total_frames) AS BIGINT) AS total_frames, max(num) AS num, max(top) AS top
  FROM fx_folders f LEFT JOIN (SELECT task_folder, count(*) AS num, first(prompt ORDER BY prompt_frames DESC, prompt) AS top FROM fx_folder_prompts GROUP BY task_folder) p
    ON p.task_folder = f.task_folder GROUP BY ROLLUP (grp, f.task_folder)) x""")
def agg4(spark, d):
    return stats.folder_summary(
        v.info(spark, d), counted(spark, d), v.tasks(spark, d), v.RULES)


@query("AGG5", f"""SELECT grp, count(*) AS folders, CAST(sum(subdataset_count) AS BIGINT) AS datasets, CAST(sum(total_frames) AS BIGINT) AS total_frames,
  round(sum(total_frames) / CAST((SELECT sum(total_frames) FROM fx_folders) AS DOUBLE), 6) AS ratio, {DURATION.format('CAST(sum(total_frames) AS BIGINT)')} FROM fx_folders GROUP BY grp""")
def agg5(spark, d):
    return stats.group_summary(v.info(spark, d), v.RULES).withColumn("ratio", r(F.col("ratio")))


VIEWS["fx_weighted"] = "SELECT d.dataset, d.weight, c.frames, c.frames * d.weight AS weighted_frames FROM fx_datasets d JOIN fx_counts c ON c.dataset = d.dataset"


@query("AGG6", """SELECT dataset, frames, weight, round(weight / sum(weight) OVER (), 6) AS weight_share, round(frames / CAST(sum(frames) OVER () AS DOUBLE), 6) AS frame_share,
  round(weighted_frames / sum(weighted_frames) OVER (), 6) AS sampled_share FROM fx_weighted""")
def agg6(spark, d):
    out = sampling.sampling_shares(weighted(spark, d))
    return out.select("dataset", "frames", "weight", *[r(F.col(c)).alias(c) for c in ("weight_share", "frame_share", "sampled_share")])


@query("AGG7", f"""SELECT CASE g WHEN 7 THEN 'dual' WHEN 11 THEN 'category' WHEN 13 THEN 'group' WHEN 14 THEN 'subcategory' ELSE 'total' END AS level,
  coalesce(dual, category, grp, subcategory, '') AS name, datasets, weight, frames, round(weight / tw, 6) AS weight_share, round(frames / tf, 6) AS frame_share, round(wf / twf, 6) AS sampled_share FROM (
  SELECT grouping(dual, category, grp, subcategory) AS g, dual, category, grp, subcategory, count(*) AS datasets, sum(weight) AS weight, CAST(sum(frames) AS BIGINT) AS frames, sum(weighted_frames) AS wf FROM (
    SELECT *, CASE WHEN starts_with(dataset, '202510_all_dual/') THEN 'dual' ELSE 'other' END AS dual, split_part(dataset, '/', 1) AS category, {GROUP} AS grp,
      concat(split_part(dataset, '/', 1), '/', regexp_replace(split_part(dataset, '/', 2), '_moz1-[a-z0-9]+$', '', 'i')) AS subcategory FROM fx_weighted) x
  GROUP BY GROUPING SETS ((dual), (category), (grp), (subcategory), ())) y, (SELECT sum(weight) AS tw, CAST(sum(frames) AS DOUBLE) AS tf, sum(weighted_frames) AS twf FROM fx_weighted) t""")
def agg7(spark, d):
    out = sampling.shares_by_level(sampling.describe_paths(weighted(spark, d), v.RULES))
    return out.select("level", "name", "datasets", "weight", "frames", *[r(F.col(c)).alias(c) for c in ("weight_share", "frame_share", "sampled_share")])


VIEWS["fx_grouped"] = f"SELECT dataset, frames, {GROUP} AS grp FROM fx_counts"
VIEWS["fx_sampling"] = """
SELECT dataset, grp, frames, target, raw * CASE WHEN lo > 0 AND lo < 0.01 THEN pow(10.0, ceil(-2 - log10(lo))) ELSE 1 END AS weight FROM (
  SELECT *, min(raw) OVER () AS lo FROM (
    SELECT dataset, grp, frames, target, target * p / sum(p) OVER (PARTITION BY grp) / frames AS raw FROM (
      SELECT g.dataset, g.grp, g.frames, c.target, pow(CAST(g.frames AS DOUBLE), 1 - c.alpha) AS p FROM fx_grouped g JOIN
        (VALUES ('pen', 0.1::DOUBLE, 1.0::DOUBLE), ('pick', 2.0 / 5 * 0.9, 0.57), ('scoop', 1.0 / 5 * 0.9, 0.0), ('late', 1.0 / 5 * 0.9, 0.7), ('empty_group', 1.0 / 5 * 0.9, 1.0)) AS c(grp, target, alpha)
        ON c.grp = g.grp) a) b) e"""


@query("DOM1", "SELECT dataset, grp, frames, round(target, 6) AS target, round(weight, 6) AS weight FROM fx_sampling")
def dom1(spark, d):
    out = sampling.sampling_weights(grouped(spark, d), v.CONFIG)
    return out.select("dataset", "grp", "frames", r(F.col("target")).alias("target"), r(F.col("weight")).alias("weight"))


REPORT = """SELECT g.grp, count(s.weight) AS included, count(*) - count(s.weight) AS excluded,
  coalesce(sum(g.frames * s.weight), 0) / (SELECT sum(frames * weight) FROM fx_sampling) AS frame_share FROM fx_grouped g LEFT JOIN fx_sampling s ON s.dataset = g.dataset GROUP BY g.grp"""


@query("AGG8", f"SELECT grp, included, excluded, round(frame_share, 6) AS frame_share FROM ({REPORT}) x")
def agg8(spark, d):
    rows = grouped(spark, d)
    out = sampling.group_report(rows, sampling.sampling_weights(rows, v.CONFIG))
    return out.withColumn("frame_share", r(F.col("frame_share")))


@query("QC10", f"""SELECT grp, included, excluded, round(frame_share, 6) AS frame_share, round(target, 6) AS target, abs(frame_share - target) <= 0.2 AS ok FROM (SELECT x.*,
  CASE grp WHEN 'pen' THEN 0.1 WHEN 'pick' THEN 0.36 WHEN 'scoop' THEN 0.18 WHEN 'late' THEN 0.18 WHEN 'empty_group' THEN 0.18 ELSE 0 END::DOUBLE AS target FROM ({REPORT}) x) y""")
def qc10(spark, d):
    rows = grouped(spark, d)
    out = sampling.verify_weights(rows, sampling.sampling_weights(rows, v.CONFIG), v.CONFIG, tolerance=0.2)
    return out.select("grp", "included", "excluded", r(F.col("frame_share")).alias("frame_share"), r(F.col("target")).alias("target"), "ok")


@query("flagship", """SELECT w.dataset, w.grp, w.frames, round(w.weight, 6) AS weight,
  round(w.frames * w.weight / (SELECT sum(frames * weight) FROM fx_sampling), 6) AS sampled_share FROM fx_sampling w""")
def flagship(spark, d):
    """Share of training each dataset really gets, from frames to weights."""
    out = sampling.sampling_shares(sampling.sampling_weights(grouped(spark, d), v.CONFIG))
    return out.select("dataset", "grp", "frames", r(F.col("weight")).alias("weight"), r(F.col("sampled_share")).alias("sampled_share"))


@query("SNK4", "SELECT dataset, CAST(1 AS DOUBLE) AS weight FROM fx_datasets")
def snk4(spark, d):
    return seed_manifest(v.datasets(spark, d))


@query("SET2", """SELECT dataset, CASE WHEN contains(dataset, 'PenHolder') THEN weight ELSE 1 END::DOUBLE AS weight FROM fx_datasets""")
def set2(spark, d):
    mine = v.manifest(spark, d)
    return merge_manifests(seed_manifest(mine), mine.filter(F.col("dataset").contains("PenHolder")))


# compositions of lake datasets


def members(spark, d):
    return compose.dataset_recordings(v.lake_sets(spark, d).select("dataset_id", "type", "recordings").withColumnRenamed("type", "dataset_type"), v.recordings(spark, d))


@query("J8", "SELECT dataset_id, place, recording_id, frames FROM fx_members")
def j8(spark, d):
    return members(spark, d).select("dataset_id", F.col("place").cast("bigint").alias("place"), "recording_id", "frames")


VIEWS["fx_set_totals"] = "SELECT dataset_id, CAST(sum(frames) AS BIGINT) AS total FROM fx_members GROUP BY dataset_id"
VIEWS["fx_tag_frames"] = """
SELECT dataset_id, tag, CAST(sum(frames) AS BIGINT) AS frames FROM (SELECT dataset_id, frames, unnest(tags) AS tag FROM fx_members) m GROUP BY 1, 2"""


@query("AGG9", """SELECT m.dataset_id, task, CAST(sum(frames) AS BIGINT) AS frames, total, round(sum(frames) / CAST(total AS DOUBLE), 6) AS ratio
  FROM fx_members m JOIN fx_set_totals t ON t.dataset_id = m.dataset_id GROUP BY m.dataset_id, task, total""")
def agg9(spark, d):
    return compose.prompt_composition(members(spark, d)).withColumn("ratio", r(F.col("ratio")))


@query("AGG10", """SELECT f.dataset_id, tag, frames, total, round(frames / CAST(total AS DOUBLE), 6) AS ratio
  FROM fx_tag_frames f JOIN fx_set_totals t ON t.dataset_id = f.dataset_id""")
def agg10(spark, d):
    return compose.tag_composition(members(spark, d)).withColumn("ratio", r(F.col("ratio")))


@query("AGG11", """SELECT f.dataset_id, dimension, f.tag, row_number() OVER (PARTITION BY f.dataset_id, dimension ORDER BY frames DESC, f.tag) AS tag_order,
  CAST(round_even(frames / CAST(total AS DOUBLE) * 100.0, 0) AS BIGINT) AS pct, CAST(trunc(frames / CAST(total AS DOUBLE) * total) AS BIGINT) AS tag_frames
  FROM fx_tag_frames f JOIN fx_set_totals t ON t.dataset_id = f.dataset_id JOIN fx_tag_defs g ON g.tag = f.tag WHERE dimension IN ('scene', 'skill')""")
def agg11(spark, d):
    return compose.tag_tree(members(spark, d), v.tag_defs(spark), v.DIMENSIONS).select(
        "dataset_id", "dimension", "tag", "tag_order", "pct", "tag_frames")


@query("AGG12", """SELECT dataset_id, dimension, tag, frames, CAST(round_even(frames / CAST(total AS DOUBLE) * 100.0, 0) AS BIGINT) AS pct FROM (
  SELECT f.*, dimension, sum(frames) OVER (PARTITION BY dataset_id, dimension) AS total FROM fx_tag_frames f JOIN fx_tag_defs g ON g.tag = f.tag) x""")
def agg12(spark, d):
    return compose.tag_pies(members(spark, d), v.tag_defs(spark)).select("dataset_id", "dimension", "tag", "frames", "pct")


@query("AGG16", """SELECT dataset_id, collection_id, type, count(*) AS recordings, CAST(sum(frames) AS BIGINT) AS frames FROM fx_members GROUP BY 1, 2, 3""")
def agg16(spark, d):
    return compose.upstream_sources(members(spark, d))


@query("AGG16_members", "SELECT dataset_id, collection_id, type, place, recording_id FROM fx_members")
def agg16_members(spark, d):
    return compose.upstream_members(members(spark, d)).withColumn("place", F.col("place").cast("bigint"))


LEAKS = """SELECT dataset_id, recording_id FROM fx_members t WHERE dataset_type = 'train' AND {} EXISTS
  (SELECT 1 FROM fx_members e WHERE e.dataset_type <> 'train' AND e.recording_id = t.recording_id)"""


def _sides(spark, d):
    rows = members(spark, d)
    return rows.filter(F.col("dataset_type") == "train"), rows.filter(F.col("dataset_type") != "train")


@query("J9", LEAKS.format(""))
def j9(spark, d):
    return compose.leaked_recordings(*_sides(spark, d)).select("dataset_id", "recording_id")


@query("J9_clean", LEAKS.format("NOT"))
def j9_clean(spark, d):
    return compose.without_leaks(*_sides(spark, d)).select("dataset_id", "recording_id")


VIEWS["fx_tree"] = """
SELECT concat('folder', CAST(n_nationkey AS VARCHAR)) AS folder, CASE WHEN n_nationkey % 7 = 3 THEN [] ELSE
 [CAST(n_nationkey AS BIGINT), CAST(n_nationkey + 25 AS BIGINT), CAST(n_nationkey + 9000000000 AS BIGINT)] END AS ids FROM nation"""


@query("J12", """SELECT t.folder, s.dataset_id, s.type FROM fx_tree t LEFT JOIN (SELECT folder, x.id AS dataset_id, type FROM
  (SELECT folder, unnest(ids) AS id FROM fx_tree) x JOIN fx_lake_sets l ON l.dataset_id = x.id) s ON s.folder = t.folder""")
def j12(spark, d):
    key = F.col("n_nationkey").cast("bigint")
    folders = v.table(spark, d, "nation").select(
        F.concat(F.lit("folder"), key.cast("string")).alias("folder"),
        F.when(key % 7 == 3, F.array().cast("array<bigint>")).otherwise(F.array(key, key + 25, key + F.lit(9000000000))).alias("dataset_ids"))
    return compose.folder_datasets(folders, v.lake_sets(spark, d).select("dataset_id", "type"))


@query("SET3", "SELECT DISTINCT dataset_id, unnest(tags) AS tag FROM fx_members")
def set3(spark, d):
    return compose.union_of_values(members(spark, d), ["dataset_id"], "tags", "tag")
