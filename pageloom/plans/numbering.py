"""Dense numbers in a given order, without a sort in a single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.plans.staging import stage

_IN_TASK = 33  # bits of monotonically_increasing_id that count within a task


def numbered(rows: DataFrame, *order: Column | str, name: str = "number") -> DataFrame:
    """``rows`` with a column ``name``: 0, 1, 2 ... in the given order.

    The rows are sorted in ranges and staged with their place in the range; a range's
    first number is the size of those before it, of which there are as many as tasks.
    ``order`` must tell all rows apart, or equal ones may change places.
    """
    spark = rows.sparkSession
    at = f"{name}__at"
    ranges = stage(
        rows.orderBy(*order).withColumn(at, F.monotonically_increasing_id()), "ranges"
    )
    piece = F.shiftright(at, _IN_TASK)
    first, firsts = 0, []
    for r in sorted(ranges.groupBy(piece.alias("piece")).count().collect()):  # a row a task
        firsts.append((r["piece"], first))
        first += r["count"]
    starts = spark.createDataFrame(firsts, f"{name}__piece long, {name}__first long")
    place = F.col(f"{name}__first") + F.col(at).bitwiseAND((1 << _IN_TASK) - 1)
    placed = ranges.withColumn(f"{name}__piece", piece).join(F.broadcast(starts), f"{name}__piece")
    return placed.withColumn(name, place).drop(f"{name}__piece", f"{name}__first", at)
