"""Expressions over dataset and file paths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

OTHER = "_other"

# Endings that name one robot rather than the task.
ROBOT_SUFFIXES = (r"(?i)_moz1-[a-z0-9]+$", r"(?i)_hrpi\d*-[a-z0-9]+$")

# Fixed value: prefix of the dual-arm collection.
DUAL_PREFIX = "202510_all_dual/"


def normalise_rules(rules) -> list[tuple[str, list[str]]]:
    """Ordered ``{group: keyword or [keywords]}`` as a list of pairs."""
    pairs = rules.items() if isinstance(rules, dict) else rules
    return [(g, [k] if isinstance(k, str) else list(k)) for g, k in pairs]


def match_group(path: Column, rules) -> Column:
    """First rule, in order, with a keyword contained in the path."""
    chain = F
    for group, keywords in normalise_rules(rules):
        hit = reduce(lambda a, b: a | b, [path.contains(k) for k in keywords], F.lit(False))
        chain = chain.when(hit, F.lit(group))
    return F.lit(OTHER) if chain is F else chain.otherwise(F.lit(OTHER))


def category(path: Column) -> Column:
    return F.split(path, "/")[0]


def subcategory(path: Column, suffixes=ROBOT_SUFFIXES) -> Column:
    """First two path levels, without the ending that names one robot."""
    parts = F.split(path, "/")
    second = reduce(lambda c, s: F.regexp_replace(c, s, ""), suffixes, F.get(parts, F.lit(1)))
    return F.when(F.size(parts) < 2, path).otherwise(F.concat(parts[0], F.lit("/"), second))


def task_folder(path: Column) -> Column:
    """The path without a last level that starts with ``dataset_``."""
    return F.regexp_replace(path, r"(^|/)dataset_[^/]*$", "")


def is_dual(path: Column, prefix: str = DUAL_PREFIX) -> Column:
    return path.startswith(prefix)


def _number(path: Column, pattern: str) -> Column:
    digits = F.regexp_extract(path, pattern, 1)
    return F.when(digits != "", digits).try_cast("bigint")


def episode_from_path(path: Column) -> Column:
    return _number(path, r"episode_(\d+)")


def chunk_from_path(path: Column) -> Column:
    return _number(path, r"chunk-(\d+)")


def episode_path(path: Column, episode: Column, chunks_size: Column | int) -> Column:
    """Rewrite the chunk and episode numbers of a file path or URL."""
    size = chunks_size if isinstance(chunks_size, Column) else F.lit(chunks_size)
    chunk = F.format_string("chunk-%03d", F.floor(episode / size))
    moved = F.regexp_replace(path, F.lit(r"chunk-\d+"), chunk)
    return F.regexp_replace(moved, F.lit(r"episode_\d+"), F.format_string("episode_%06d", episode))
