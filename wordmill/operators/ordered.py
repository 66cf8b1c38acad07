"""Rows in a total order that many tasks share: ranges, numbers over all rows, and sums and maxima that restart with a key.

Rows are dealt over ranges of the order (Spark samples it), sorted in each, and written with the number of their range and their place there.
What one range has to know of those before it is a row a range: its count, or the value that its last key has reached. So a key
that has most of the rows is many tasks' work, where a window by key would be one's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import Scratch

RANGE, PLACE = "range_no", "range_place"
#: Rows of one key that a window by key may sort in a task; a key with more is scanned over ranges.
KEY_ROWS = 1 << 20
_LOW = (1 << 33) - 1


def in_ranges(df: DataFrame, order: list[str], work: Scratch, name: str) -> DataFrame:
    """``df``, written, with the number of each row's range and its place there. ``order`` has to tell all rows apart, or leave open
    which of those that it doesn't comes first."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()  # the partition, and the place in it in the low 33 bits
    placed = ranged.withColumn(PLACE, at).withColumn(RANGE, F.shiftright(PLACE, 33).cast("int")).withColumn(PLACE, F.col(PLACE).bitwiseAND(_LOW))
    return work.keep(placed, name)


def offsets(ranged: DataFrame, work: Scratch, name: str) -> DataFrame:
    """range_no, range_start: rows in the ranges before; one row a range in a window."""
    counts = ranged.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return work.keep(counts.select(RANGE, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("range_start")), name)


def numbered(df: DataFrame, order: list[str], number: str) -> DataFrame:
    """``df`` with the number of each row, from 0, in ``order`` over all rows."""
    work = Scratch(df.sparkSession, "numbered")
    ranged = in_ranges(df, order, work, "ranged")
    return ranged.join(offsets(ranged, work, "offsets"), RANGE).withColumn(number, F.col("range_start") + F.col(PLACE)).select(*df.columns, number)


def running(df: DataFrame, key: str, order: list[str], value: Column, result: str, how: str = "sum") -> DataFrame:
    """``df`` with the sum or maximum (``how``: "sum", "max") of ``value`` over the rows of its key up to and with each row, in
    ``order``. The rows of one key may be in many ranges.

    In each range sums restart with a key; a range that begins with a key which an earlier one had adds what that key has reached by then,
    which is told by one row a range: its first and last key and the value of its last.
    """
    if how not in ("sum", "max"):
        raise ValueError(how)
    agg = {"sum": F.sum, "max": F.max}[how]
    if (df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0) <= KEY_ROWS:  # no key is too large for a task
        whole_key = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(result, agg(value).over(whole_key))
    work = Scratch(df.sparkSession, "running")
    ranged = in_ranges(df.withColumn(result, value), [key, *order], work, "ranged")
    here = Window.partitionBy(RANGE, key).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    # what each range has of its first and of its last key: the two rows that later ranges may need
    ends = ranged.groupBy(RANGE).agg(F.min_by(F.struct(F.col(key).alias("k")), PLACE).alias("first"), F.max_by(F.struct(F.col(key).alias("k")), PLACE).alias("last"))
    totals = ranged.join(ends, RANGE).where(F.col(key).eqNullSafe(F.col("last.k"))).groupBy(RANGE).agg(agg(result).alias("last_total"))
    # a carry goes on through ranges that hold nothing but its key
    rows = ends.join(totals, RANGE).withColumn("restarts", F.when(~F.col("first.k").eqNullSafe(F.col("last.k")), 1).otherwise(0))
    before = Window.orderBy(RANGE)
    rows = rows.withColumn("came", F.lag("last").over(before)).withColumn("new_key", F.when(F.col("came").isNull() | ~F.col("came.k").eqNullSafe(F.col("first.k")), 1).otherwise(0))
    rows = rows.withColumn("run", F.sum(F.col("new_key") + F.col("restarts")).over(before))
    rows = rows.withColumn("reached", agg("last_total").over(Window.partitionBy("run").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, 0)))
    carried = rows.select(F.col(RANGE), F.when(F.col("new_key") == 0, F.lag("reached").over(before)).alias("carry"), F.col("first").alias("carry_key"))
    carried = work.keep(carried, "carried")
    joined = ranged.withColumn("here", agg(result).over(here)).join(carried, RANGE)
    carry = F.when(F.col(key).eqNullSafe(F.col("carry_key.k")), F.col("carry"))
    whole = F.coalesce(F.col("here"), F.lit(0)) + carry if how == "sum" else F.greatest("here", carry)
    both = F.when(carry.isNull(), F.col("here")).otherwise(whole)
    return joined.withColumn(result, both).select(*[c for c in df.columns if c != result], result)
