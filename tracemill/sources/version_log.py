"""A log of changes that several writers append to, one batch after another.

A writer says how many batches it has read. Its batch is written aside and enters the log by one
file, ``<number>.json``, which is created only if no other writer has created it: of two writers
that have seen the same log one succeeds, and the other gets :class:`StaleLog` and must read again.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from tracemill.sources.snapshots import _Store


class StaleLog(ValueError):
    """Another writer has appended since the log was read."""


def committed_batches(spark: SparkSession, path: str) -> list[str]:
    """The folders of the log's batches, in their order."""
    store, found = _Store(spark, path), []
    while (text := store.read_text(f"{path.rstrip('/')}/{len(found):08d}.json")) is not None:
        found.append(json.loads(text)["folder"])
    return found


def read_log(spark: SparkSession, path: str) -> tuple[DataFrame | None, int]:
    """All committed changes, null if there is none, and how many batches they are."""
    path = path.rstrip("/")
    batches = committed_batches(spark, path)
    return (spark.read.parquet(*[f"{path}/{b}" for b in batches]) if batches else None), len(batches)


def append(changes: DataFrame, path: str, seen: int) -> int:
    """Append a batch to a log of which ``seen`` batches were read; the new number of batches."""
    spark, path = changes.sparkSession, path.rstrip("/")
    folder = f"batch-{uuid.uuid4().hex}"
    changes.write.parquet(f"{path}/{folder}")
    store = _Store(spark, path)
    name = f"{path}/{seen:08d}.json"
    if seen and store.read_text(f"{path}/{seen - 1:08d}.json") is None:
        raise StaleLog(f"the log has fewer than {seen} batches")
    try:
        store.create_text(name, json.dumps({"folder": folder}))
    except Py4JJavaError as error:
        if store.read_text(name) is None:
            raise
        store.delete(f"{path}/{folder}")
        raise StaleLog(f"another writer has appended batch {seen}") from error
    return seen + 1
