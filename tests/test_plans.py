"""What the executed plans must and must not contain."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = entry.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    text = plan(spark, "FLT4")
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(o_orderdate,1997-03-01" in text
    assert "LessThan(o_orderdate,1997-10-01" in text
    assert "o_comment" not in text


def test_profile_reads_two_columns_of_the_frames(spark):
    text = plan(spark, "AGG1")
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text


def test_hash_split_does_not_move_frames(spark):
    assert "lineitem" not in plan(spark, "DOM2")


def test_frames_are_read_no_more_than_their_derivation_needs(spark):
    """Once for the numbering and once for the lengths of the episodes, and once for relabelling."""
    for name, table, most in (("W2", "l_linenumber", 3), ("DOM4", "l_linenumber", 3), ("J5", "user_id", 5)):
        scans = [x for x in plan(spark, name).split("\n") if "FileScan parquet" in x and table in x.split("Batched")[0]]
        assert len(scans) <= most, (name, len(scans))


@pytest.mark.parametrize("threshold", ["10m", "-1"])
@pytest.mark.parametrize("name", ["W2_stored", "DOM4_stored"])
def test_stored_frames_never_move(spark, name, threshold):
    """From the scan of the bucketed frames up to the result there is no exchange, with small sides broadcast or not."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df = entry.queries()[name](spark, SF)
        lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        scans = [n for n, line in enumerate(lines) if "FileScan parquet" in line and "frames_" in line]
        assert len(scans) == 1
        above, at = [], depth(lines[scans[0]])
        for line in reversed(lines[:scans[0]]):
            if depth(line) < at:
                above.append(line)
                at = depth(line)
        wanted = "BroadcastHashJoin" if threshold != "-1" else "SortMergeJoin"
        assert any(wanted in line for line in above) and not any("Exchange" in line for line in above), above
        df.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_counts_by_episode_do_not_move_stored_frames(spark):
    from pyspark.sql import functions as F

    from workload.q_domain import kept_frames

    counts = kept_frames(spark, SF).groupBy("dataset", "recording_id").agg(F.count(F.lit(1)).alias("n"))
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString() and counts.count() > 0


def test_episodes_are_never_broadcast(spark, monkeypatch):
    """A written step looks small, but its rows are as many as the lake has episodes."""
    monkeypatch.setattr("tracemill.operators.positions.FEW_ROWS", 100)
    joins = [x for x in plan(spark, "DOM10").split("\n") if "Join [" in x and "recording_id" in x]
    assert joins and not [x for x in joins if "BroadcastHashJoin" in x]
