"""Robot-data tables derived from the given tables, in Spark and as SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracemill.functions import recordings as rec
from tracemill.operators.positions import dealt, dense_position, keyed, shifted
from tracemill.operators.relabel import EPISODE
from tracemill.session import shared_dir
from workload.registry import VIEWS

#: fps, chunk size and cameras differ by dataset, as a lake of many robots has them.
SETTINGS_SQL = """CASE WHEN {0} % 3 = 0 THEN 15 ELSE 30 END AS fps, CASE WHEN {0} % 2 = 0 THEN 100 ELSE 40 END AS chunks_size, 2 + {0} % 3 AS cameras"""
RULES = [("pen", ["PenHolder"]), ("pick", ["PickPlace", "Wipe"]), ("scoop", ["ScoopNuts"]),
         ("late", ["Wipe", "drawer"]), ("empty_group", ["NoSuchKeyword"])]
CONFIG = {"pen": (0.1, 1.0, True), "pick": (2.0, 0.57), "scoop": (1.0, 0.0), "late": (1.0, 0.7),
          "empty_group": (1.0, 1.0)}
TASK_TAGS = {"t1": ["at_desk", "do_clean", "do_lay"], "t2": ["at_bench", "do_grasp"],
             "t3": ["at_board", "do_fill"]}
TAG_DEFS = [("at_board", "scene"), ("at_desk", "scene"), ("at_bench", "scene"),
            ("do_clean", "skill"), ("do_grasp", "skill"), ("do_lay", "skill"), ("do_fill", "skill"),
            ("q_high", "quality"), ("q_review", "quality")]
DIMENSIONS = ["scene", "skill"]
OPERATORS = ("op_a", "op_b", "op_c")
DEVICES = ("dev_a", "dev_b")

GROUP_CASE = """CASE WHEN contains({0}, 'PenHolder') THEN 'pen'
  WHEN contains({0}, 'PickPlace') OR contains({0}, 'Wipe') THEN 'pick'
  WHEN contains({0}, 'ScoopNuts') THEN 'scoop' WHEN contains({0}, 'drawer') THEN 'late'
  WHEN contains({0}, 'NoSuchKeyword') THEN 'empty_group' ELSE '_other' END"""


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder for tables a query writes and reads back."""
    return f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"


def _pick(selector: Column, values) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), selector.cast("int"))


def _path(ds: int) -> str:
    """Path of dataset ``ds``: matched, unmatched and dual cases, some without a ``dataset_`` level."""
    top = ("writingdesk", "v6_demo", "202510_all_dual", "kitchen")[ds % 4]
    task = ("PenHolder", "PickPlace", "ScoopNuts", "Wipe", "drawer", "Unlisted")[ds % 6]
    nested = ds % 4 != 3
    number = 1000 + (ds % 12 if nested else ds)
    return f"{top}/{number}_20260109_{task}_WB_moz1-k0{ds % 3}" + (f"/dataset_0_30_{ds}" if nested else "")


def dataset_path(ds: Column) -> Column:
    return _pick(ds, [_path(i) for i in range(24)])


PATH_SQL = """concat(CASE {0} % 4 WHEN 0 THEN 'writingdesk' WHEN 1 THEN 'v6_demo' WHEN 2 THEN '202510_all_dual' ELSE 'kitchen' END,
    '/', CAST(CASE WHEN {0} % 4 = 3 THEN 1000 + {0} ELSE 1000 + {0} % 12 END AS VARCHAR), '_20260109_',
    CASE {0} % 6 WHEN 0 THEN 'PenHolder' WHEN 1 THEN 'PickPlace' WHEN 2 THEN 'ScoopNuts' WHEN 3 THEN 'Wipe' WHEN 4 THEN 'drawer' ELSE 'Unlisted' END,
    '_WB_moz1-k0', CAST({0} % 3 AS VARCHAR),
    CASE WHEN {0} % 4 = 3 THEN '' ELSE concat('/dataset_0_30_', CAST({0} AS VARCHAR)) END)"""

VIEWS["fx_datasets"] = f"""
SELECT ds, CAST(1 + ds % 3 AS DOUBLE) AS weight, {PATH_SQL.format('ds')} AS dataset
FROM (SELECT DISTINCT o_custkey % 24 AS ds FROM orders) d"""


def datasets(spark, d) -> DataFrame:
    rows = table(spark, d, "orders").select((F.col("o_custkey") % 24).alias("ds")).distinct()
    return rows.select("ds", (1 + F.col("ds") % 3).cast("double").alias("weight"), dataset_path(F.col("ds")).alias("dataset"))


def manifest(spark, d) -> DataFrame:
    return datasets(spark, d).select("dataset", "weight")


VIEWS["fx_manifest"] = """
SELECT dataset, weight FROM fx_datasets UNION ALL SELECT concat('gone/', r_name), CAST(1 AS DOUBLE) FROM region"""


def wide_manifest(spark, d) -> DataFrame:
    """The manifest with further entries that have no data."""
    gone = table(spark, d, "region").select(F.concat(F.lit("gone/"), "r_name").alias("dataset"), F.lit(1.0).alias("weight"))
    return manifest(spark, d).unionByName(gone)


VIEWS["fx_recordings"] = """
SELECT o_orderkey AS recording_id, o_custkey % 24 AS ds,
  concat('t', CAST(1 + o_orderkey % 3 AS VARCHAR)) AS task, o_custkey AS collection_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'dagger' WHEN '2-HIGH' THEN 'test' WHEN '3-MEDIUM' THEN 'eval' ELSE 'normal' END AS type,
  CAST(floor(o_totalprice / 100) AS BIGINT) AS frames,
  CASE o_orderstatus WHEN 'F' THEN 'fail' WHEN 'P' THEN 'warn' ELSE 'pass' END AS qa,
  CASE o_orderstatus WHEN 'F' THEN 'quarantined' ELSE 'active' END AS life,
  o_orderdate AS collected_at,
  CASE WHEN o_orderkey % 2 = 0 THEN 'dev_a' ELSE 'dev_b' END AS device,
  CASE o_orderkey % 3 WHEN 0 THEN 'op_a' WHEN 1 THEN 'op_b' ELSE 'op_c' END AS operator,
  list_append(CASE o_orderkey % 3 WHEN 0 THEN ['at_desk', 'do_clean', 'do_lay'] WHEN 1 THEN ['at_bench', 'do_grasp']
    ELSE ['at_board', 'do_fill'] END, CASE WHEN o_orderstatus IN ('F', 'P') THEN 'q_review' ELSE 'q_high' END) AS tags
FROM orders"""


def recordings(spark, d) -> DataFrame:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    task = F.concat(F.lit("t"), (1 + key % 3).cast("string"))
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "dagger").when(
        F.col("o_orderpriority") == "2-HIGH", "test").when(
        F.col("o_orderpriority") == "3-MEDIUM", "eval").otherwise("normal")
    qa = F.when(status == "F", "fail").when(status == "P", "warn").otherwise("pass")
    return table(spark, d, "orders").select(
        key.alias("recording_id"), (F.col("o_custkey") % 24).alias("ds"), task.alias("task"),
        F.col("o_custkey").alias("collection_id"), kind.alias("type"),
        F.floor(F.col("o_totalprice") / 100).cast("bigint").alias("frames"), qa.alias("qa"),
        F.when(status == "F", "quarantined").otherwise("active").alias("life"),
        F.col("o_orderdate").alias("collected_at"),
        rec.device(key, *DEVICES).alias("device"), rec.operator(key, OPERATORS).alias("operator"),
        rec.tags(task, qa, TASK_TAGS).alias("tags"),
    )


VIEWS["fx_frames"] = f"""
SELECT {PATH_SQL.format('(o.o_custkey % 24)')} AS dataset, l.l_orderkey AS recording_id,
  CAST(row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate) - 1 AS BIGINT) AS frame_index,
  CAST(l.l_linenumber % 5 AS BIGINT) AS task_index, l.l_quantity AS state
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""


def _lines(spark, d) -> DataFrame:
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    owners = orders.select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 24).alias("ds"))
    return dealt(lines, ["l_orderkey"], lines.count()).join(keyed(owners, orders.count()), "l_orderkey")


def _frame_columns(rows, *more) -> DataFrame:
    return rows.select(
        dataset_path(F.col("ds")).alias("dataset"), F.col("l_orderkey").alias("recording_id"),
        (F.col("l_linenumber") % 5).cast("bigint").alias("task_index"), F.col("l_quantity").alias("state"), *more,
    )


def by_episode(spark, d, frames, keys=EPISODE) -> DataFrame:
    """Frames dealt by episode, for joins with episodes; by recording alone, for counts by any keys that hold it."""
    return dealt(frames, keys, table(spark, d, "lineitem").count())


def frames(spark, d) -> DataFrame:
    """Frames without their position."""
    return _frame_columns(_lines(spark, d))


def placed_frames(spark, d) -> DataFrame:
    """Frames with their position in the episode; an order has a handful of lines."""
    inside = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    rows = _lines(spark, d).withColumn("frame_index", (F.row_number().over(inside) - 1).cast("bigint"))
    return _frame_columns(rows, "frame_index")


VIEWS["fx_episodes"] = f"""
SELECT {PATH_SQL.format('(o.o_custkey % 24)')} AS dataset, o.o_orderkey AS recording_id, o.o_custkey % 24 AS ds,
  CAST(row_number() OVER (PARTITION BY o.o_custkey % 24 ORDER BY o.o_orderkey) - 1 AS BIGINT) AS episode_index,
  CAST(coalesce(c.n, 0) + CASE WHEN o.o_orderkey % 97 = 0 THEN 3 ELSE 0 END AS BIGINT) AS length,
  CASE o.o_orderkey % 3 WHEN 0 THEN 'teleop' WHEN 1 THEN 'policy' ELSE NULL END AS dagger_type,
  CASE o.o_orderkey % 4 WHEN 0 THEN ['pick the cup'] WHEN 1 THEN ['擦白板: wipe the board', 'pour water']
    WHEN 2 THEN ['unknown', 'pick the cup'] ELSE ['pour water'] END AS tasks
FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) c ON c.l_orderkey = o.o_orderkey"""

TASK_CHOICES = (["pick the cup"], ["擦白板: wipe the board", "pour water"], ["unknown", "pick the cup"], ["pour water"])


def raw_episodes(spark, d) -> DataFrame:
    """Episodes numbered by recording, with gaps."""
    counts = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    key = F.col("o_orderkey")
    tasks = F.get(F.array(*[F.array(*[F.lit(t) for t in c]) for c in TASK_CHOICES]), (key % 4).cast("int"))
    named = F.create_map(*[F.lit(x) for x in ("1", "pick the cup", "2", "擦白板: wipe the board", "3", "pour water")])
    return table(spark, d, "orders").join(counts, "o_orderkey", "left").select(
        dataset_path(F.col("o_custkey") % 24).alias("dataset"), key.alias("recording_id"), key.alias("episode_index"),
        (F.coalesce("n", F.lit(0)) + F.when(key % 97 == 0, 3).otherwise(0)).cast("bigint").alias("length"),
        F.when(key % 3 == 0, "teleop").when(key % 3 == 1, "policy").alias("dagger_type"),
        tasks.alias("tasks"),
        F.when(F.size(tasks) > 1, named).alias("task_id_map"),
    )


def episodes(spark, d) -> DataFrame:
    rows = dense_position(raw_episodes(spark, d), ["dataset"], ["recording_id"], "_n")
    return rows.withColumn("episode_index", F.col("_n")).drop("_n")


VIEWS["fx_tasks"] = """
SELECT d.dataset, CAST(t.task_index AS BIGINT) AS task_index, t.task FROM fx_datasets d
CROSS JOIN (VALUES (0, 'unknown'), (1, 'pick the cup'), (2, '擦白板: wipe the board'), (3, 'pour water')) AS t(task_index, task)"""

VOCABULARY = ("unknown", "pick the cup", "擦白板: wipe the board", "pour water")


def tasks(spark, d) -> DataFrame:
    words = F.array(*[F.lit(t) for t in VOCABULARY])
    return manifest(spark, d).select("dataset", F.posexplode(words).alias("task_index", "task")).withColumn(
        "task_index", F.col("task_index").cast("bigint"))


VIEWS["fx_placed_events"] = """
SELECT user_id AS episode, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS BIGINT) AS frame_index, ts, value, event_id FROM events"""
VIEWS["fx_signal"] = """
SELECT episode, frame_index, ts, value / 1000 AS cmd,
  coalesce(lag(value, 8) OVER (PARTITION BY episode ORDER BY frame_index), value) / 1000 + (event_id % 5) * CAST(0.02 AS DOUBLE) AS state
FROM fx_placed_events"""


def placed_events(spark, d) -> DataFrame:
    """Events of a user as the frames of an episode."""
    minute = F.timestamp_diff("MINUTE", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    rows = table(spark, d, "events").select(F.col("user_id").alias("episode"), "ts", "value", "event_id")
    return dense_position(rows, ["episode"], ["ts"], "frame_index", block=minute)


def signal(spark, d) -> DataFrame:
    """A command and a state that follows eight steps later."""
    rows = shifted(placed_events(spark, d), ["episode"], "frame_index", {"_late": ("value", -8)})
    noise = (F.col("event_id") % 5) * F.lit(0.02)
    return rows.select(
        "episode", "frame_index", "ts", (F.col("value") / 1000).alias("cmd"),
        (F.coalesce("_late", "value") / 1000 + noise).alias("state"),
    )


VIEWS["fx_actions"] = """
SELECT u.user_id AS recording_id, concat('set', CAST(u.user_id % 3 AS VARCHAR)) AS dataset, CAST(a.pos AS BIGINT) AS pos,
  CAST(a.pos * 20 AS DOUBLE) / 30 AS start_time, CAST(a.pos * 20 + 25 AS DOUBLE) / 30 AS end_time,
  concat('act', CAST((u.user_id + a.pos) % 5 AS VARCHAR)) AS action
FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN (VALUES (0), (1), (2), (3)) AS a(pos)
WHERE u.user_id % 10 <> 0"""
VIEWS["fx_motion_frames"] = """
SELECT episode AS recording_id, concat('set', CAST(episode % 3 AS VARCHAR)) AS dataset, frame_index, CAST(9 AS BIGINT) AS task_index
FROM fx_placed_events"""


def _motion_keys() -> list[Column]:
    return [F.concat(F.lit("set"), (F.col("user_id") % 3).cast("string")).alias("dataset"), F.col("user_id").alias("recording_id")]


def annotations(spark, d) -> DataFrame:
    """One annotation per user, an array of four overlapping actions."""
    users = table(spark, d, "events").select("user_id").distinct().filter(F.col("user_id") % 10 != 0)
    one = lambda p: F.struct(
        ((p * 20).cast("double") / 30).alias("start_time"), ((p * 20 + 25).cast("double") / 30).alias("end_time"),
        F.lit("").alias("action"), F.concat(F.lit("act"), ((F.col("user_id") + p) % 5).cast("string")).alias("action_english"),
    )
    return users.select(*_motion_keys(), F.transform(F.sequence(F.lit(0), F.lit(3)), one).alias("actions"))


def motion_frames(spark, d) -> DataFrame:
    rows = placed_events(spark, d).withColumnRenamed("episode", "user_id")
    return rows.select(*_motion_keys(), "frame_index", F.lit(9).cast("bigint").alias("task_index"))


VIEWS["fx_task_text"] = """
SELECT concat('ds', CAST(doc_id % 20 AS VARCHAR)) AS dataset, doc_id AS task_index,
  CASE WHEN doc_id % 7 = 0 THEN concat(text, ' 擦白板 x 桌') ELSE text END AS task FROM documents"""


def task_text(spark, d) -> DataFrame:
    return table(spark, d, "documents").select(
        F.concat(F.lit("ds"), (F.col("doc_id") % 20).cast("string")).alias("dataset"), F.col("doc_id").alias("task_index"),
        F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit(" 擦白板 x 桌"))).otherwise(F.col("text")).alias("task"),
    )


def rules_table(spark) -> DataFrame:
    rows = [(i, g, k) for i, (g, ks) in enumerate(RULES, 1) for k in ks]
    return spark.createDataFrame(rows, "rule_order int, grp string, keyword string")


def tag_defs(spark) -> DataFrame:
    return spark.createDataFrame(TAG_DEFS, "tag string, dimension string")


VIEWS["fx_tag_defs"] = "SELECT * FROM (VALUES " + ", ".join(f"('{t}', '{g}')" for t, g in TAG_DEFS) + ") AS t(tag, dimension)"

VIEWS["fx_lake_sets"] = """
SELECT c_custkey AS dataset_id, CASE WHEN c_custkey % 10 = 0 THEN 'eval-benchmark' ELSE 'train' END AS type,
  [c_custkey * 3, c_custkey * 3 + 1, c_custkey * 5 + 2, c_custkey + 7000000000] AS recordings,
  [concat('train_job_', CAST(c_custkey AS VARCHAR)), concat('eval_job_', CAST(c_custkey % 9 AS VARCHAR)), 'train_job_x'] AS used_by
FROM customer"""
VIEWS["fx_members"] = """
SELECT s.dataset_id, s.type AS dataset_type, s.place, r.* FROM
 (SELECT dataset_id, type, CAST(unnest(generate_series(0, 3)) AS BIGINT) AS place, unnest(recordings) AS rid FROM fx_lake_sets) s
 JOIN fx_recordings r ON r.recording_id = s.rid"""


def lake_sets(spark, d) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, d, "customer").select(
        key.alias("dataset_id"), F.when(key % 10 == 0, "eval-benchmark").otherwise("train").alias("type"),
        F.array(key * 3, key * 3 + 1, key * 5 + 2, key + F.lit(7000000000)).alias("recordings"),
        F.array(F.concat(F.lit("train_job_"), key.cast("string")), F.concat(F.lit("eval_job_"), (key % 9).cast("string")),
                F.lit("train_job_x")).alias("used_by"),
    )


VIEWS["fx_versions"] = """
SELECT concat('ds', CAST(o.o_custkey AS VARCHAR)) AS dataset, o.o_custkey AS dataset_id, o.o_orderkey AS seq,
  concat('v', CAST(o.o_orderkey AS VARCHAR)) AS version,
  CASE WHEN o.o_orderkey = m.hi THEN 'draft' WHEN o.o_orderkey = m.lo THEN 'active' ELSE 'archived' END AS status,
  CAST(o.o_orderkey % 50 AS BIGINT) AS recordings, 'initial' AS note, concat('user', CAST(o.o_custkey % 5 AS VARCHAR)) AS creator
FROM orders o JOIN (SELECT o_custkey, max(o_orderkey) AS hi, min(o_orderkey) AS lo FROM orders GROUP BY o_custkey) m ON m.o_custkey = o.o_custkey"""
VIEWS["fx_requests"] = """
SELECT concat('ds', CAST(o_custkey AS VARCHAR)) AS dataset,
  CASE o_custkey % 3 WHEN 0 THEN concat('v', CAST(max(o_orderkey) AS VARCHAR)) WHEN 1 THEN concat('v', CAST(min(o_orderkey) AS VARCHAR))
    ELSE 'none' END AS version
FROM orders GROUP BY o_custkey"""


def versions(spark, d) -> DataFrame:
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey")
    ends = orders.groupBy("o_custkey").agg(F.max("o_orderkey").alias("hi"), F.min("o_orderkey").alias("lo"))
    key = F.col("o_orderkey")
    return orders.join(ends, "o_custkey").select(
        F.concat(F.lit("ds"), F.col("o_custkey").cast("string")).alias("dataset"), key.alias("seq"),
        F.concat(F.lit("v"), key.cast("string")).alias("version"),
        F.when(key == F.col("hi"), "draft").when(key == F.col("lo"), "active").otherwise("archived").alias("status"),
        (key % 50).alias("recordings"), F.lit("initial").alias("note"),
        F.concat(F.lit("user"), (F.col("o_custkey") % 5).cast("string")).alias("creator"),
    )


def requests(spark, d) -> DataFrame:
    """A third of the datasets ask for their draft, a third for another version, a third for one that is missing."""
    ends = table(spark, d, "orders").groupBy("o_custkey").agg(F.max("o_orderkey").alias("hi"), F.min("o_orderkey").alias("lo"))
    named = lambda c: F.concat(F.lit("v"), F.col(c).cast("string"))
    turn = F.col("o_custkey") % 3
    return ends.select(
        F.concat(F.lit("ds"), F.col("o_custkey").cast("string")).alias("dataset"),
        F.when(turn == 0, named("hi")).when(turn == 1, named("lo")).otherwise("none").alias("version"),
    )


VIEWS["fx_pipelines"] = """
SELECT concat('pl', CAST(s_suppkey AS VARCHAR)) AS pipeline_id, concat('user', CAST(s_suppkey % 5 AS VARCHAR)) AS creator,
  [concat('op_', CAST(s_nationkey AS VARCHAR)), concat('op_', CAST(s_suppkey % 9 AS VARCHAR)), 'op_missing'] AS stages FROM supplier"""
VIEWS["fx_operators"] = """
SELECT concat('op_', CAST(n_nationkey AS VARCHAR)) AS operator_id, n_name AS name,
  concat('--ratio 0.95 / --seed ', CAST(n_nationkey AS VARCHAR), ' / K', CAST(n_regionkey AS VARCHAR)) AS params FROM nation"""
VIEWS["fx_runs"] = """
SELECT concat('run_', CAST(o_orderkey AS VARCHAR)) AS run_id, concat('pl', CAST(o_custkey % 150 AS VARCHAR)) AS pipeline,
  concat('flow ', CAST(o_custkey % 11 AS VARCHAR)) AS name, concat('set ', CAST(o_custkey AS VARCHAR)) AS target,
  CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'P' THEN 'running' ELSE 'done' END AS status,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'manual' ELSE 'scheduled' END AS trigger,
  CASE WHEN o_orderpriority = '1-URGENT' THEN concat('user', CAST(o_custkey % 7 AS VARCHAR)) END AS "by", o_orderdate AS "at" FROM orders"""


def pipelines(spark, d) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, d, "supplier").select(
        F.concat(F.lit("pl"), key.cast("string")).alias("pipeline_id"), F.concat(F.lit("user"), (key % 5).cast("string")).alias("creator"),
        F.array(F.concat(F.lit("op_"), F.col("s_nationkey").cast("string")), F.concat(F.lit("op_"), (key % 9).cast("string")),
                F.lit("op_missing")).alias("stages"),
    )


def operators(spark, d) -> DataFrame:
    key = F.col("n_nationkey").cast("string")
    return table(spark, d, "nation").select(
        F.concat(F.lit("op_"), key).alias("operator_id"), F.col("n_name").alias("name"),
        F.concat(F.lit("--ratio 0.95 / --seed "), key, F.lit(" / K"), F.col("n_regionkey").cast("string")).alias("params"),
    )


def runs(spark, d) -> DataFrame:
    owner, status, priority = F.col("o_custkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    return table(spark, d, "orders").select(
        F.concat(F.lit("run_"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.concat(F.lit("pl"), (owner % 150).cast("string")).alias("pipeline"),
        F.concat(F.lit("flow "), (owner % 11).cast("string")).alias("name"), F.concat(F.lit("set "), owner.cast("string")).alias("target"),
        F.when(status == "F", "failed").when(status == "P", "running").otherwise("done").alias("status"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), "manual").otherwise("scheduled").alias("trigger"),
        F.when(priority == "1-URGENT", F.concat(F.lit("user"), (owner % 7).cast("string"))).alias("by"),
        F.col("o_orderdate").alias("at"),
    )


VIEWS["fx_taxonomy"] = """
SELECT p_brand AS dimension, p_type AS level2, CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_name END AS level3 FROM part"""


def taxonomy(spark, d) -> DataFrame:
    return table(spark, d, "part").select(
        F.col("p_brand").alias("dimension"), F.col("p_type").alias("level2"),
        F.when(F.col("p_size") % 10 != 0, F.col("p_name")).alias("level3"),
    )


VIEWS["fx_info"] = "SELECT dataset, CAST(sum(length) AS BIGINT) AS frames FROM fx_episodes GROUP BY dataset"
VIEWS["fx_counts"] = "SELECT dataset, count(*) AS frames FROM fx_frames GROUP BY dataset"


def info(spark, d) -> DataFrame:
    """Frame count of each dataset as its metadata states it."""
    return raw_episodes(spark, d).groupBy("dataset").agg(F.sum("length").alias("frames"))


VIEWS["fx_settings"] = f"""
SELECT dataset, {SETTINGS_SQL.format('ds')} FROM fx_datasets UNION ALL
SELECT concat('set', CAST(k AS VARCHAR)), {SETTINGS_SQL.format('k')} FROM (SELECT DISTINCT user_id % 3 AS k FROM events) e"""


def settings(spark, d) -> DataFrame:
    """fps, chunk size and cameras as the info of each dataset has them."""
    sets = table(spark, d, "events").select((F.col("user_id") % 3).alias("ds")).distinct()
    rows = datasets(spark, d).select("dataset", "ds").unionByName(
        sets.select(F.concat(F.lit("set"), F.col("ds").cast("string")).alias("dataset"), "ds"))
    odd = F.col("ds") % 3
    return rows.select(
        "dataset", F.when(odd == 0, 15).otherwise(30).alias("fps"),
        F.when(F.col("ds") % 2 == 0, 100).otherwise(40).alias("chunks_size"), (2 + odd).alias("cameras"))


#: Episodes of a few hundred frames: the lines of a supplier in the order of their numbers.
TAKE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice")
VIEWS["fx_take_frames"] = f"""
SELECT {PATH_SQL.format('(l_suppkey % 24)')} AS dataset, l_suppkey AS recording_id,
  CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY {', '.join(TAKE_ORDER)}) - 1 AS BIGINT) AS frame_index,
  CAST(l_linenumber % 5 AS BIGINT) AS task_index, l_quantity AS state FROM lineitem"""
VIEWS["fx_takes"] = """
SELECT dataset, recording_id, CAST(row_number() OVER (PARTITION BY dataset ORDER BY recording_id) - 1 AS BIGINT) AS episode_index, length
FROM (SELECT dataset, recording_id, count(*) AS length FROM fx_take_frames GROUP BY ALL) t"""
VIEWS["fx_take_settings"] = f"SELECT DISTINCT {PATH_SQL.format('ds')} AS dataset, {SETTINGS_SQL.format('ds')} FROM (SELECT l_suppkey % 24 AS ds FROM lineitem) t"


def take_frames(spark, d) -> DataFrame:
    inside = Window.partitionBy("l_suppkey").orderBy(*TAKE_ORDER)
    rows = table(spark, d, "lineitem").withColumn("frame_index", (F.row_number().over(inside) - 1).cast("bigint"))
    return rows.select(
        dataset_path(F.col("l_suppkey") % 24).alias("dataset"), F.col("l_suppkey").alias("recording_id"), "frame_index",
        (F.col("l_linenumber") % 5).cast("bigint").alias("task_index"), F.col("l_quantity").alias("state"))


def takes(spark, d) -> DataFrame:
    rows = table(spark, d, "lineitem").groupBy(
        dataset_path(F.col("l_suppkey") % 24).alias("dataset"), F.col("l_suppkey").alias("recording_id")).agg(F.count(F.lit(1)).alias("length"))
    return dense_position(rows, ["dataset"], ["recording_id"], "episode_index")


def take_settings(spark, d) -> DataFrame:
    key = table(spark, d, "lineitem").select((F.col("l_suppkey") % 24).alias("ds")).distinct()
    odd = F.col("ds") % 3
    return key.select(
        dataset_path(F.col("ds")).alias("dataset"), F.when(odd == 0, 15).otherwise(30).alias("fps"),
        F.when(F.col("ds") % 2 == 0, 100).otherwise(40).alias("chunks_size"), (2 + odd).alias("cameras"))


VIEWS["fx_take_recordings"] = """
SELECT t.recording_id, t.dataset, concat('t', CAST(1 + recording_id % 3 AS VARCHAR)) AS task,
  CASE WHEN recording_id % 5 < 3 THEN 'pass' WHEN recording_id % 5 = 3 THEN 'warn' ELSE 'fail' END AS qa FROM fx_takes t"""


def take_recordings(spark, d) -> DataFrame:
    key = F.col("recording_id")
    return takes(spark, d).select(
        key, "dataset", F.concat(F.lit("t"), (1 + key % 3).cast("string")).alias("task"),
        F.when(key % 5 < 3, "pass").when(key % 5 == 3, "warn").otherwise("fail").alias("qa"))
