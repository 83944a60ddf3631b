"""Derived attributes of lake recordings and of operator definitions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two quality tags.
TAG_HIGH = "q_high"
TAG_REVIEW = "q_review"


def device(recording_id: Column, even: str, odd: str) -> Column:
    return F.when(recording_id % 2 == 0, even).otherwise(odd)


def operator(recording_id: Column, names) -> Column:
    listed = F.array(*[F.lit(n) for n in names])
    return F.get(listed, (F.pmod(recording_id, F.lit(len(names)))).cast("int"))


def quality_tag(qa: Column) -> Column:
    return F.when(qa == "pass", TAG_HIGH).otherwise(TAG_REVIEW)


def tags(task: Column, qa: Column, task_tags: dict[str, list[str]]) -> Column:
    """Tags of the task followed by the quality tag."""
    chain = F
    for name, ids in task_tags.items():
        chain = chain.when(task == name, F.array(*[F.lit(t) for t in ids]))
    none = F.array().cast("array<string>")
    base = none if chain is F else chain.otherwise(none)
    return F.array_append(base, quality_tag(qa))


def usage_kind(job: Column) -> Column:
    return F.when(job.startswith("eval"), "eval").otherwise("train")


def param_keys(params: Column) -> Column:
    """First word of each `` / ``-separated parameter, without repeats."""
    words = F.transform(F.split(params, " / "), lambda p: F.split(F.trim(p), " ")[0])
    return F.array_distinct(F.filter(words, lambda w: w != ""))
