"""Changes made on an old state are refused, in a table of changes and in a log with several writers."""

import pytest

from tests.conftest import rows
from tracemill.operators import versions as ver
from tracemill.sources import version_log

VERSIONS = "dataset string, seq bigint, version string, status string, recordings bigint, note string, creator string"
CHANGES = "dataset string, arrival bigint, based_on bigint, kind string, version string"
START = [("a", 1, "v1", "active", 5, "", ""), ("a", 2, "v2", "draft", 6, "", ""), ("a", 3, "v3", "draft", 7, "", ""), ("b", 1, "v1", "draft", 8, "", "")]


def test_stale_changes_are_refused(table):
    changes = [("a", 1, 3, "publish", "v2"), ("a", 2, 3, "publish", "v3"), ("a", 3, 5, "rollback", "v1"), ("a", 4, 4, "rollback", "v1"),
               ("a", 5, 5, "publish", "v3"), ("a", 6, 4, "rollback", "v2"), ("b", 9, 1, "publish", "gone"), ("c", 1, 0, "publish", "v1")]
    taken = ver.accepted_changes(table(START, VERSIONS), table(changes, CHANGES).repartition(3))
    assert rows(taken, "dataset", "arrival", "seq") == [("a", 1, 4), ("a", 4, 5), ("a", 5, 6), ("b", 9, 2)]
    after = ver.replay(table(START, VERSIONS), table(changes, CHANGES), "me")
    assert rows(after, "dataset", "version", "status", "recordings") == [
        ("a", "v1", "archived", 5), ("a", "v2", "archived", 6), ("a", "v3", "active", 7), ("a", "v4", "draft", 5), ("b", "v1", "draft", 8)]


def test_without_changes_nothing_changes(table):
    assert rows(ver.replay(table(START, VERSIONS), table([], CHANGES), "me")) == sorted(START, key=repr)


def test_two_writers(spark, table, tmp_path):
    path = str(tmp_path / "log")
    assert version_log.read_log(spark, path) == (None, 0)
    one, two = (table([("a", n, 3, "publish", f"v{n + 1}")], CHANGES) for n in (1, 2))
    _, seen = version_log.read_log(spark, path)
    assert version_log.append(one, path, seen) == 1
    with pytest.raises(version_log.StaleLog):
        version_log.append(two, path, seen)
    with pytest.raises(version_log.StaleLog):
        version_log.append(two, path, 5)
    log, seen = version_log.read_log(spark, path)
    assert log.count() == 1
    version_log.append(two, path, seen)  # written after looking again, but still based on the old seq
    log, seen = version_log.read_log(spark, path)
    after = ver.replay(table(START, VERSIONS), log, "me")
    assert seen == 2 and [r.version for r in after.filter("dataset = 'a' AND status = 'active'").collect()] == ["v2"]
