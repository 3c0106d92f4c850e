"""Dense numbers for rows by counts per partition and a running sum: no sort, no window over all rows, no shuffle of them.

A table is numbered in two steps. ``placed`` adds each row's place (partition, row of the partition). Once that table is
stored, the places stand still, and ``numbered`` turns them into numbers from the partitions' counts, of which there is
one row per partition and group.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART, NTH = "__part", "__nth"
_ROW_BITS = 33  # of monotonically_increasing_id


def placed(rows: DataFrame) -> DataFrame:
    """The rows with the place of each: ``__part``, ``__nth``. Store them before they are numbered."""
    at = F.monotonically_increasing_id()
    return rows.select(
        "*", F.shiftright(at, _ROW_BITS).cast("int").alias(PART), at.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias(NTH)
    )


def offsets(stored: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """(``__part``, *within, first, before, of_part): per partition and group the first place, the rows of the group in
    partitions before, and the rows here.

    Without ``within`` the running sum has one row per partition; with it, one row per partition and group, summed by
    group.
    """
    counts = stored.groupBy(PART, *within).agg(F.min(NTH).alias("first"), F.count("*").alias("of_part"))
    earlier = Window.partitionBy(*within).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("of_part").over(earlier), F.lit(0)))


def numbered(stored: DataFrame, name: str, within: tuple[str, ...] = (), start: int | Column = 0) -> DataFrame:
    """Rows of a stored ``placed`` table with their number from ``start`` on, in the order of their places.

    With ``within`` the rows of a group must stand together in every partition, as after a sort by the group; each
    group is then numbered by itself. NULL is a group.
    """
    found = offsets(stored, within).select(
        F.col(PART).alias("__of"), *[F.col(c).alias(f"__of_{n}") for n, c in enumerate(within)], "first", "before"
    )
    same = [F.col(PART) == F.col("__of"), *[F.col(c).eqNullSafe(F.col(f"__of_{n}")) for n, c in enumerate(within)]]
    columns = [c for c in stored.columns if c not in (PART, NTH)]
    number = F.col("before") + F.col(NTH) - F.col("first") + start
    first_names = stored.withColumnsRenamed({c: f"__own_{n}" for n, c in enumerate(columns) if c in ("first", "before")})
    kept = [F.col(f"__own_{n}" if c in ("first", "before") else f"`{c}`").alias(c) for n, c in enumerate(columns) if c != name]
    return first_names.join(found, reduce(and_, same)).select(*kept, number.cast("long").alias(name))
