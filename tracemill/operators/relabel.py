"""Task vocabulary and per-frame task labels.

Frames are keyed by (dataset, recording_id, frame_index); ``frame_index`` is the
0-based row position in the episode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.functions.numbers import first_frame, last_frame
from tracemill.functions.text import UNKNOWN, action_name, english_only
from tracemill.operators.positions import keyed, sorted_position

EPISODE = ("dataset", "recording_id")

#: Frames of a block; actions and frames meet by block, so a long episode is no hot key.
SPREAD = 4_096


def annotation_actions(annotations: DataFrame, keys=EPISODE, prefer: str = "action_english") -> DataFrame:
    """One row per action: its place in the annotation, its times and its name."""
    return annotations.select(*keys, F.posexplode("actions").alias("pos", "a")).select(
        *keys,
        "pos",
        F.col("a.start_time").alias("start_time"),
        F.col("a.end_time").alias("end_time"),
        action_name(F.col("a.action"), F.col("a.action_english"), prefer).alias("task"),
    )


def episode_tasks_from_annotation(episodes: DataFrame, annotations: DataFrame, prefer: str = "action_english") -> DataFrame:
    """Episode tasks become the action names in order, ``['unknown']`` without annotation."""
    named = annotations.select(
        *EPISODE,
        F.transform(
            "actions", lambda a: action_name(a["action"], a["action_english"], prefer)
        ).alias("_named"),
    )
    return (
        episodes.join(named, list(EPISODE), "left")
        .withColumn("tasks", F.coalesce("_named", F.array(F.lit(UNKNOWN))))
        .drop("_named")
    )


def task_names(*sources: DataFrame) -> DataFrame:
    """Distinct (dataset, task) over several tables that hold those columns."""
    rows = sources[0].select("dataset", "task")
    for other in sources[1:]:
        rows = rows.unionByName(other.select("dataset", "task"))
    return rows.distinct()


def task_vocabulary(names: DataFrame) -> DataFrame:
    """(dataset, task_index, task): 0 is ``unknown``, then the sorted names from 1."""
    named = names.select("dataset", "task").distinct()
    known = sorted_position(named.filter(F.col("task") != UNKNOWN), ["dataset"], ["task"], "_place")
    first = named.select("dataset").distinct().select(
        "dataset", F.lit(0).cast("bigint").alias("task_index"), F.lit(UNKNOWN).alias("task")
    )
    return first.unionByName(
        known.select("dataset", (F.col("_place") + 1).cast("bigint").alias("task_index"), "task")
    )


def single_prompt_vocabulary(datasets: DataFrame, prompt: str) -> DataFrame:
    """Replace the vocabulary of every dataset by one prompt at index 0."""
    return datasets.select(
        "dataset", F.lit(0).cast("bigint").alias("task_index"), F.lit(prompt).alias("task")
    ).distinct()


def _indexed(rows: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Task name -> task index; names the vocabulary lacks become 0."""
    return (
        rows.join(vocabulary, ["dataset", "task"], "left")
        .withColumn("task_index", F.coalesce("task_index", F.lit(0).cast("bigint")))
        .drop("task")
    )


def with_rate(actions: DataFrame, info: DataFrame) -> DataFrame:
    """Frame range of each action by the ``fps`` of its dataset."""
    rates = info.select("dataset", F.col("fps").cast("double").alias("_fps"))
    return (
        actions.join(rates, "dataset")
        .withColumn("first", F.greatest(first_frame(F.col("start_time"), F.col("_fps")), F.lit(0)))
        .withColumn("last", last_frame(F.col("end_time"), F.col("_fps")))
        .drop("start_time", "end_time", "_fps")
    )


def frame_counts(frames: DataFrame, keys=EPISODE) -> DataFrame:
    """(keys, n_frames): how many frames each episode reaches, counted on the frames."""
    return frames.groupBy(*keys).agg((F.max("frame_index") + 1).alias("n_frames"))


def _paint(done, action):
    """Lay one action over the disjoint intervals before it; what it covers of them goes."""
    def interval(first, last, source):
        return F.struct(first.alias("first"), last.alias("last"), source["value"].alias("value"))

    left = F.transform(F.filter(done, lambda s: s["first"] < action["first"]),
                       lambda s: interval(s["first"], F.least(s["last"], action["first"] - 1), s))
    right = F.transform(F.filter(done, lambda s: s["last"] > action["last"]),
                        lambda s: interval(F.greatest(s["first"], action["last"] + 1), s["last"], s))
    return F.concat(left, F.array(interval(action["first"], action["last"], action)), right)


def block_intervals(spans: DataFrame, keys, value: str, lengths: DataFrame) -> DataFrame:
    """Disjoint intervals ``_spans`` of each episode and block of ``SPREAD`` frames, sorted; the last action wins.

    ``lengths`` has ``n_frames`` of each episode: an action makes a row per block it touches, never
    more than its episode has blocks, however far away it ends. Of actions that cover the same part
    of a block only the last is kept before any list is made, so a block's list is bounded by its frames.
    """
    kind = spans.schema[value].dataType.simpleString()
    ends = lengths.select(*keys, (F.col("n_frames") - 1).alias("_end"))
    inside = spans.join(ends, list(keys)).withColumn("last", F.least("last", "_end")).filter(F.col("first") <= F.col("last"))
    cut = inside.withColumn(
        "_block", F.explode(F.sequence(F.floor(F.col("first") / SPREAD), F.floor(F.col("last") / SPREAD)))
    ).select(
        *keys, "_block", "pos", F.col(value).alias("value"),
        F.greatest("first", F.col("_block") * SPREAD).alias("first"),
        F.least("last", F.col("_block") * SPREAD + (SPREAD - 1)).alias("last"),
    )
    parts = cut.groupBy(*keys, "_block", "first", "last").agg(
        F.max_by("value", "pos").alias("value"), F.max("pos").alias("pos"))
    listed = parts.groupBy(*keys, "_block").agg(
        F.array_sort(F.collect_list(F.struct("pos", "first", "last", "value"))).alias("_actions"))
    none = F.array().cast(f"array<struct<first: bigint, last: bigint, value: {kind}>>")
    return listed.select(*keys, "_block", F.aggregate("_actions", none, _paint).alias("_spans"))


def _at_frame():
    """The value of the interval that holds the frame, found by binary search; null if none does."""
    at, spans = F.col("frame_index"), F.coalesce(F.size("_spans"), F.lit(0))
    steps = F.when(spans > 0, F.sequence(F.lit(1), F.ceil(F.log2(spans + 1)).cast("int"))).otherwise(
        F.array().cast("array<int>"))

    def halve(state, _):
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        right = F.get("_spans", middle)["first"] <= at
        open_ = state["low"] < state["high"]
        return F.struct(
            F.when(open_ & right, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(open_ & ~right, middle).otherwise(state["high"]).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.greatest(spans, F.lit(0)).alias("high"))
    found = F.get("_spans", F.aggregate(steps, start, halve)["low"] - 1)
    return F.when(at <= found["last"], found["value"])


def _with_block(frames: DataFrame) -> DataFrame:
    return frames.withColumn("_block", F.floor(F.col("frame_index") / SPREAD))


def frame_actions(
    frames: DataFrame, actions: DataFrame, info: DataFrame, keys=EPISODE, lengths: DataFrame | None = None
) -> DataFrame:
    """Frames with the name of the last action covering them, null where none does.

    ``lengths`` (keys, n_frames) is counted on the frames unless it is given.
    """
    lengths = frame_counts(frames, keys) if lengths is None else lengths
    blocks = block_intervals(with_rate(actions, info), keys, "task", lengths)
    return (
        _with_block(frames).join(blocks, [*keys, "_block"], "left")
        .withColumn("task", _at_frame()).drop("_block", "_spans")
    )


def relabel_by_annotation(
    frames: DataFrame, annotations: DataFrame, vocabulary: DataFrame, info: DataFrame,
    prefer: str = "action_english", lengths: DataFrame | None = None,
) -> DataFrame:
    """Task index of each frame from the annotation of its episode.

    The last action covering a frame wins, both ends included; times count in frames
    of the dataset's own ``fps``. A frame no action covers gets 0, also when the
    annotation is empty. Episodes without annotation keep their labels. ``lengths``
    (dataset, recording_id, n_frames) is counted on the frames unless it is given.
    """
    lengths = frame_counts(frames) if lengths is None else lengths
    actions = _indexed(annotation_actions(annotations, EPISODE, prefer), vocabulary)
    blocks = block_intervals(with_rate(actions, info), EPISODE, "task_index", lengths)
    annotated = annotations.select(*EPISODE, F.lit(True).alias("_annotated"))
    found = (
        _with_block(frames).withColumnRenamed("task_index", "_old")
        .join(blocks, [*EPISODE, "_block"], "left").join(keyed(annotated), list(EPISODE), "left")
    )
    label = F.when(F.col("_annotated"), F.coalesce(_at_frame(), F.lit(0))).otherwise(F.col("_old"))
    return found.withColumn("task_index", label.cast("bigint")).drop("_old", "_block", "_spans", "_annotated")


def relabel_by_prompt(frames: DataFrame, episodes: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Task index of each frame through the ``task_id_map`` of its episode.

    Labels the map lacks become 0. An episode without map must have exactly one
    task, which all its frames get; otherwise the query fails.
    """
    mapped = F.size(F.coalesce("task_id_map", F.create_map().cast("map<string,string>"))) > 0
    entries = episodes.filter(mapped).select(
        *EPISODE, F.explode("task_id_map").alias("_old", "task")
    )
    maps = (
        _indexed(entries, vocabulary)
        .groupBy(*EPISODE)
        .agg(F.map_from_entries(F.collect_list(
            F.struct(F.col("_old").cast("bigint"), "task_index"))).alias("_map"))
    )
    message = F.concat(
        F.lit("episode has several tasks but no task_id_map: "), F.col("recording_id").cast("string")
    )
    single = _indexed(
        episodes.filter(~mapped).select(
            *EPISODE,
            F.when(F.size("tasks") == 1, F.get("tasks", F.lit(0)))
            .otherwise(F.raise_error(message).cast("string")).alias("task"),
        ),
        vocabulary,
    )
    rules = maps.select(*EPISODE, "_map", F.lit(None).cast("bigint").alias("_all")).unionByName(
        single.select(
            *EPISODE, F.lit(None).cast("map<bigint,bigint>").alias("_map"),
            F.col("task_index").alias("_all"),
        )
    )
    return (
        frames.join(keyed(rules), list(EPISODE))
        .withColumn(
            "task_index",
            F.coalesce("_all", F.try_element_at("_map", F.col("task_index")), F.lit(0).cast("bigint")),
        )
        .drop("_map", "_all")
    )


def relabel_first_task(frames: DataFrame, episodes: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Every frame gets the first (English) task of its episode."""
    first = F.coalesce(english_only(F.get("tasks", F.lit(0))), F.lit(UNKNOWN))
    labels = _indexed(episodes.select(*EPISODE, first.alias("task")), vocabulary)
    return frames.drop("task_index").join(keyed(labels), list(EPISODE))
