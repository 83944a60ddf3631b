"""Positions, running sums and shifts that never put one key into one task.

A plain window over ``partitionBy(dataset)`` sorts a whole dataset in a single
task, and one dataset may hold a third of all rows. The functions here cut each
key into blocks, aggregate the blocks before the shuffle, and only order rows
inside a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracemill.session import materialise

BLOCK = 65_536
SHIFT_BLOCK = 4_096


#: Rows of an episode table that may be sent to every task.
FEW_ROWS = 1 << 17


def keyed(rows: DataFrame, count: int | None = None) -> DataFrame:
    """A side of a join with a row per episode: rows meet it by key, it is never sent whole to every task.

    Spark takes the compressed files of a written step for its size. Numbers and repeated names shrink to a
    hundredth there, so a broadcast of a few MB would be hundreds in the driver, and grow with the lake.
    Where the ``count`` is known and small, the choice is left to Spark.
    """
    return rows if count is not None and count <= FEW_ROWS else rows.hint("shuffle_merge")


#: Rows of a dealt table that a task gets, about.
TASK_ROWS = 1 << 18


def dealt(rows: DataFrame, keys, count: int) -> DataFrame:
    """``rows`` dealt by key over as many tasks as its ``count`` asks for.

    Adaptive execution fits tasks to compressed bytes: names that repeat make 60 MB of them five million rows,
    whose sorting and counting take a GB and more. A task of a dealt table holds as many rows however large it
    is, joins and counts by these keys follow it, and a small table stays as it is. Not for keys of millions of
    rows, as a key is one task's.
    """
    tasks = -(-count // TASK_ROWS)
    return rows if tasks <= 1 else rows.repartition(tasks, *keys)


def _before(keys, order: str = "_block"):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _sum_before(keys, order: str, value: str) -> Column:
    return F.coalesce(F.sum(value).over(_before(keys, order)), F.lit(0))


def block_offsets(df: DataFrame, keys, block: Column, value: Column) -> DataFrame:
    """(keys, _block, _offset): sum of ``value`` over all earlier blocks of the key.

    ``block`` is an integer. With sparse ids a key may have as many blocks as rows, so blocks
    are summed in groups of 2^24 first: no ordered window sees more than 2^24 sums of a key.
    """
    keys = list(keys)
    sums = df.groupBy(*keys, block.cast("bigint").alias("_block")).agg(F.sum(value).alias("_sum"))
    sums = sums.withColumn("_group", F.shiftright("_block", 24))
    groups = sums.groupBy(*keys, "_group").agg(F.sum("_sum").alias("_sum")).select(
        *keys, "_group", _sum_before(keys, "_group", "_sum").alias("_start"))
    inside = sums.select(*keys, "_block", "_group", _sum_before([*keys, "_group"], "_block", "_sum").alias("_inside"))
    return inside.join(groups, [*keys, "_group"]).select(
        *keys, "_block", (F.col("_start") + F.col("_inside")).alias("_offset"))


def integer_block(column: str, size: int = BLOCK) -> Column:
    return F.floor(F.col(column) / size)


def dense_position(
    df: DataFrame, keys, order, name: str, block: Column | None = None, size: int = BLOCK
) -> DataFrame:
    """0-based position of each row inside its key.

    ``block`` must grow with ``order``; by default it is the first order column,
    an integer, cut into ranges of ``size``. The order must be unique in a key,
    and keys must not be null. The input is read twice, so a costly one should be
    written with ``materialise`` first. Blocks are unique in ``offsets``, so the left join
    lets Spark drop the whole computation where a plan ignores the position.
    """
    keys, order = list(keys), list(order)
    block = integer_block(order[0], size) if block is None else block
    offsets = block_offsets(df, keys, block, F.lit(1))
    inside = F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(*order))
    return (
        df.withColumn("_block", block)
        .join(offsets, [*keys, "_block"], "left")
        .withColumn(name, (F.col("_offset") + inside - 1).cast("bigint"))
        .drop("_block", "_offset")
    )


def running_start(df: DataFrame, keys, order: str, value: str, name: str, size: int = BLOCK) -> DataFrame:
    """Sum of ``value`` over all rows of the key that come before this one."""
    keys = list(keys)
    block = integer_block(order, size)
    offsets = block_offsets(df, keys, block, F.col(value))
    earlier = (
        Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        df.withColumn("_block", block)
        .join(offsets, [*keys, "_block"], "left")
        .withColumn(
            name, (F.col("_offset") + F.coalesce(F.sum(value).over(earlier), F.lit(0))).cast("bigint")
        )
        .drop("_block", "_offset")
    )


def sorted_position(df: DataFrame, keys, order, name: str) -> DataFrame:
    """0-based position inside each key for an order of any type.

    The rows are range-sorted by key and order together, so a large key is
    spread over many partitions. The sorted rows are written once; a row's place
    is its place in the partition plus the size of the earlier partitions.
    """
    keys = list(keys)
    sort = [F.col(k) for k in keys] + [F.col(o) if isinstance(o, str) else o for o in order]
    ranked = materialise(df.orderBy(*sort).withColumn("_row", F.monotonically_increasing_id()))
    part = F.shiftright("_row", 33)
    starts = (
        ranked.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_start",
            F.coalesce(
                F.sum("_n").over(
                    Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .select("_part", "_start")
    )
    placed = (
        ranked.withColumn("_part", part)
        .join(starts, "_part")
        .withColumn("_global", F.col("_start") + F.col("_row").bitwiseAND((1 << 33) - 1))
        .drop("_part", "_start", "_row")
    )
    if not keys:
        return placed.withColumnRenamed("_global", name)
    first = placed.groupBy(*keys).agg(F.min("_global").alias("_first"))
    return (
        placed.join(first, keys)
        .withColumn(name, F.col("_global") - F.col("_first"))
        .drop("_global", "_first")
    )


def shifted(df: DataFrame, keys, position: str, shifts: dict[str, tuple[str, int]], size: int = SHIFT_BLOCK) -> DataFrame:
    """Add columns holding another row's value: ``{new: (column, step)}``.

    Step -1 is the previous row, +8 the row eight later; null outside the key.
    ``position`` must be 0-based without gaps. Rows near a block edge are copied
    to the neighbouring block, so every block can be ordered on its own.
    """
    steps = [s for _, s in shifts.values()]
    back, ahead = max(0, -min(steps)), max(0, max(steps))
    if max(back, ahead) >= size:
        raise ValueError("a shift must be smaller than the block size")
    keys, pos = list(keys), F.col(position)
    own = F.floor(pos / size)
    after, before = F.floor((pos + back) / size), F.floor((pos - ahead) / size)
    edge = (after != own) | ((before != own) & (before >= 0))
    targets = F.when(
        edge, F.filter(F.array_distinct(F.array(before, own, after)), lambda b: b >= 0)
    ).otherwise(F.array(own))
    inside = Window.partitionBy(*keys, "_block").orderBy(position)
    copies = df.withColumn("_block", F.explode(targets))
    for new, (column, step) in shifts.items():
        copies = copies.withColumn(
            new, (F.lag(column, -step) if step < 0 else F.lead(column, step)).over(inside)
        )
    return copies.filter(F.col("_block") == own).drop("_block")


def smallest(df: DataFrame, by: str, tie: str, quota: Column | int, keys=(), bits: int = 16) -> DataFrame:
    """The ``quota`` rows with the smallest 32-bit ``by`` value per key.

    The value is evenly spread, so its leading bits cut every key into 2^bits
    even blocks. Blocks that start beyond the quota drop out before any sorting.
    """
    keys = list(keys)
    block = F.shiftright(F.col(by), 32 - bits)
    offsets = block_offsets(df, keys, block, F.lit(1))
    inside = F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(by, tie))
    return (
        df.withColumn("_block", block)
        .join(offsets, [*keys, "_block"])
        .filter(F.col("_offset") < quota)
        .withColumn("_rank", F.col("_offset") + inside)
        .filter(F.col("_rank") <= quota)
        .drop("_block", "_offset", "_rank")
    )


def nth_smallest(df: DataFrame, column: str, n: int, bins: int = 1024) -> tuple[int | None, int]:
    """The n-th smallest value of an integer column, and how many rows lie below it.

    Rows are counted per equal-width bin between the smallest and the largest value, and
    again inside the bin that holds place n, until a bin is one value wide. Each round
    brings at most ``bins`` counts to the driver. The value is null if fewer rows have one.
    """
    low, high, rows = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if n < 1 or rows <= n:
        return None, rows
    before = 0
    while low < high:
        width = -(-(high - low + 1) // bins)
        inside = df.filter(F.col(column).between(low, high))
        # decimals: the distance of two 64-bit values may need one bit more
        place = F.floor((F.col(column).cast("decimal(20,0)") - F.lit(low)) / F.lit(width)).cast("int")
        counts = dict(inside.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect())
        for number in sorted(counts):
            if before + counts[number] >= n:
                low, high = low + number * width, min(high, low + (number + 1) * width - 1)
                break
            before += counts[number]
    return low, before
