"""Declared schemas of the metadata files. Only feature columns stay open."""

MANIFEST = "map<string,double>"

INFO = """
    total_episodes bigint, total_frames bigint, total_chunks bigint, total_videos bigint,
    total_tasks bigint, chunks_size bigint, fps bigint, data_path string,
    features map<string, struct<dtype: string, shape: array<bigint>>>,
    splits map<string, string>, dagger_type string
"""

TASK = "task_index bigint, task string"

# annotation_data stays text: it may hold anything, see ``embedded_annotations``.
EPISODE = """
    episode_index bigint, recording_id bigint, length bigint, tasks array<string>, task_id_map map<string, string>,
    dagger_type string, annotation struct<recording_id: bigint, id: bigint, created_at: string,
    annotator_name: string, annotation_data: string>
"""

EPISODE_STATS = "episode_index bigint, stats string"

FILE = "path string, type string, download_url string"

# One file per dataset; episodes[i] belongs to recording_ids[i].
BUNDLE = f"""
    task_name string, info struct<total_episodes: bigint, total_frames: bigint, chunks_size: bigint, fps: bigint>,
    tasks array<struct<task_index: bigint, task: string>>,
    episodes array<struct<episode_index: bigint, length: bigint, tasks: array<string>,
        task_id_map: map<string, string>, dagger_type: string,
        annotation: struct<recording_id: bigint, id: bigint, created_at: string,
            annotator_name: string, annotation_data: string>>>,
    episode_stats array<string>, recording_ids array<bigint>,
    files array<struct<path: string, type: string, download_url: string>>
"""

ACTIONS = "array<struct<start_time: double, end_time: double, action: string, action_english: string>>"

ANNOTATION_V3 = f"version string, data {ACTIONS}"

ANNOTATION_LEGACY = """
    annotation struct<actionAnnotationList:
        array<struct<start: double, end: double, description: string>>>
"""
