from tracemill.operators import stats


def test_folder_profile_lists_subdatasets_and_recordings(spark):
    info = spark.createDataFrame(
        [("a/b/dataset_2", 30), ("a/b/dataset_1", None), ("c/d", 4), ("e/f", 5)], "dataset string, frames long")
    counted = spark.createDataFrame(
        [("a/b/dataset_2", 10, 0, 7), ("a/b/dataset_2", 9, 0, 3), ("a/b/dataset_1", 9, 0, 2), ("c/d", 8, 5, 4)],
        "dataset string, recording_id long, task_index long, frames long")
    tasks = spark.createDataFrame([(d, 0, "wipe") for d in ("a/b/dataset_1", "a/b/dataset_2", "c/d")],
                                  "dataset string, task_index long, task string")
    got = {r.task_folder: r for r in stats.folder_profile(info, counted, tasks, [("g", ["b"])]).collect()}
    assert {f: (r.subdataset_count, r.subdatasets, r.prompt, r.recording_count, r.recording_ids) for f, r in got.items()} == {
        "a/b": (2, "a/b/dataset_1, a/b/dataset_2", "wipe", 2, "9, 10"),
        "c/d": (1, "", "unknown_5", 1, "8"),
        "e/f": (1, "", "", 0, "")}
