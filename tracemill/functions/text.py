"""Expressions over task and action names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the CJK range that counts as Chinese.
CHINESE = "[一-鿿]"

UNKNOWN = "unknown"


def contains_chinese(text: Column) -> Column:
    return text.rlike(CHINESE)


def find_chinese(text: Column) -> Column:
    """All runs of Chinese characters, in order."""
    return F.regexp_extract_all(text, F.lit(CHINESE + "+"), F.lit(0))


def english_only(task: Column) -> Column:
    """Trimmed text after the first ASCII colon; text without one is unchanged."""
    after = F.regexp_replace(task, r"^[^:]*:", "")
    trimmed = F.regexp_replace(after, r"(?U)^\s+|\s+$", "")
    return F.when(task.contains(":"), trimmed).otherwise(task)


def english_only_all(tasks: Column) -> Column:
    return F.transform(tasks, english_only)


def action_name(action: Column, english: Column, prefer: str = "action_english") -> Column:
    """The preferred name, the other one if it is empty, else ``unknown``."""
    first, second = (english, action) if prefer == "action_english" else (action, english)
    return F.coalesce(F.nullif(first, F.lit("")), second, F.lit(UNKNOWN))


def all_have_prefix(task_name: Column, prefix: str) -> Column:
    """Whether every part of an ``a+b+c`` task name starts with the prefix."""
    return F.forall(F.split(task_name, r"\+"), lambda t: t.startswith(prefix))


def checked_task_prefix(task_name: Column, prefix: str) -> Column:
    """The task name, or an error when one of its parts lacks the prefix."""
    message = F.concat(F.lit("task name lacks prefix "), F.lit(prefix), F.lit(": "), task_name)
    return F.when(all_have_prefix(task_name, prefix), task_name).otherwise(F.raise_error(message))
