"""Sets of whole numbers as runs of consecutive ones (first, last), kept by ranges of 2**16 numbers.

A run never crosses a range, so runs of different ranges never meet: merging
new numbers into a set touches the ranges they fall into, each a bounded window.
Gaps between ranges need the last number before a range. That is found level by
level: ranges are grouped 4096 to one, groups again, until the whole of 64 bits
is one group; each group takes its predecessor's last number from the group
above. No window spans more than 4096 rows of a level, whatever the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE_BITS = 16
GROUP_BITS = 12
LEVELS = (16, 28, 40, 52)  # bits below a range, and below the groups of each level; 52 + 12 is all of a long


def range_of(column: str, bits: int = RANGE_BITS) -> Column:
    return F.shiftright(F.col(column), bits)


def runs_of(numbers: DataFrame, column: str) -> DataFrame:
    """(rng, first, last): runs of the numbers in ``column``; repetitions and nulls count nothing.

    Numbers are made distinct before they are dealt to ranges, so a range has at most 2**16 rows.
    """
    distinct = numbers.filter(F.col(column).isNotNull()).select(F.col(column).cast("long").alias("x")).distinct()
    return merge_runs(distinct.select(range_of("x").alias("rng"), F.col("x").alias("first"), F.col("x").alias("last")))


def merge_runs(runs: DataFrame) -> DataFrame:
    """Runs that touch or overlap, joined; ``runs`` may hold those of several sets."""
    by = Window.partitionBy("rng").orderBy("first", "last")
    reach = F.max("last").over(by.rowsBetween(Window.unboundedPreceding, -1))
    # compared before one is added, so that the greatest long does not overflow
    opens = F.when(reach.isNull(), 1).when(F.col("first") <= reach, 0).otherwise((F.col("first") > reach + 1).cast("int"))
    opened = runs.select("rng", "first", "last", opens.alias("opens"))
    numbered = opened.select("rng", "first", "last", F.sum("opens").over(by.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
    return numbered.groupBy("rng", "run").agg(F.min("first").alias("first"), F.max("last").alias("last")).select("rng", "first", "last")


def _before(runs: DataFrame) -> DataFrame:
    """(rng, before): the last number of the nearest earlier range that has any; null for the first."""
    levels = [runs.groupBy("rng").agg(F.max("last").alias("hi")).select(F.col("rng").alias("k0"), "hi")]
    for i in range(1, len(LEVELS)):
        below = levels[-1].select(F.shiftright(f"k{i - 1}", GROUP_BITS).alias(f"k{i}"), "hi")
        levels.append(below.groupBy(f"k{i}").agg(F.max("hi").alias("hi")))
    top = len(LEVELS) - 1
    found = levels[top].select(f"k{top}", F.lag("hi").over(Window.orderBy(f"k{top}")).alias("before"))  # 4096 rows at most
    for i in range(top - 1, -1, -1):
        group = F.shiftright(f"k{i}", GROUP_BITS)
        own = levels[i].select(f"k{i}", group.alias(f"k{i + 1}"), F.lag("hi").over(Window.partitionBy(group).orderBy(f"k{i}")).alias("own"))
        found = own.join(found, f"k{i + 1}").select(f"k{i}", F.coalesce("own", "before").alias("before"))
    return found.withColumnRenamed("k0", "rng")


def gaps(runs: DataFrame) -> DataFrame:
    """(first_missing, last_missing): the numbers between the least and the greatest that no run holds, as intervals."""
    own = runs.select("rng", "first", F.lag("last").over(Window.partitionBy("rng").orderBy("first")).alias("own"))
    near = own.join(_before(runs), "rng").select("first", F.coalesce("own", "before").alias("before"))
    return near.filter(F.col("first") > F.col("before") + 1).select((F.col("before") + 1).alias("first_missing"), (F.col("first") - 1).alias("last_missing"))


def runs_profile(runs: DataFrame) -> DataFrame:
    """One row: least and greatest number, how many there are, and how many are missing between them (null beyond a long)."""
    n = F.coalesce(F.sum(F.col("last") - F.col("first") + 1), F.lit(0))
    out = runs.agg(F.min("first").alias("min_cursor"), F.max("last").alias("max_cursor"), n.alias("n_distinct"))
    wide = [F.col(c).cast("decimal(20,0)") for c in ("max_cursor", "min_cursor", "n_distinct")]
    return out.withColumn("gaps", (wide[0] - wide[1] + 1 - wide[2]).try_cast("long"))
