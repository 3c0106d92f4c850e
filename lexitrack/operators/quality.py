"""Constraint checks. Spark tables enforce none, so each check reports what would violate it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexitrack.schema import MAX_LENGTHS, NOT_NULL, UNIQUE_KEYS


def check_not_null(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Missing values per column that must have one, from one scan."""
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "violations")


def check_unique(rows: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Keys that occur more than once. A key with a NULL part never collides."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    return rows.filter(present).groupBy(*key).agg(F.count("*").alias("count")).filter(F.col("count") > 1)


def check_length(rows: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Values over the declared length (in characters) per column, from one scan."""
    counts = rows.agg(*[F.count_if(F.length(F.col(c)) > n).alias(c) for c, n in limits.items()])
    return counts.unpivot([], list(limits), "column", "violations")


def check_table(rows: DataFrame, table: str) -> DataFrame:
    """All declared constraints of a table as (check, column, violations), foreign keys aside, from one scan.

    The rows are counted once by every unique key, as grouping sets; the other counts ride along with the first set. A
    unique key is reported as the number of keys that occur more than once; one with a NULL part never collides.
    """
    counts = {("not null", c): F.col(c).isNull() for c in NOT_NULL[table]}
    counts |= {("length", c): F.length(F.col(c)) > n for c, n in MAX_LENGTHS.get(table, {}).items()}
    keys = UNIQUE_KEYS[table]
    columns = list(dict.fromkeys(c for key in keys for c in key))
    # Named before the sets are formed: a set without a column sees NULL for it.
    flags = [c.cast("int").alias(f"__flag_{i}") for i, c in enumerate(counts.values())]
    named = rows.select(*[F.col(c).alias(f"__key_{i}") for i, c in enumerate(columns)], *flags)
    place = {c: f"__key_{i}" for i, c in enumerate(columns)}
    sets = [[F.col(place[c]) for c in key] for key in keys]
    per_key = named.groupingSets(sets, *[F.col(place[c]) for c in columns]).agg(
        F.grouping_id().alias("__set"), F.count("*").alias("__n"),
        *[F.coalesce(F.sum(f"__flag_{i}"), F.lit(0)).alias(f"__flag_{i}") for i in range(len(counts))],
    )
    # A column that is not in a set has its bit set.
    ids = [sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in key) for key in keys]

    def repeated(key: tuple[str, ...], id_: int) -> Column:
        whole = reduce(lambda a, b: a & b, [F.col(place[c]).isNotNull() for c in key])
        return F.count_if((F.col("__set") == id_) & (F.col("__n") > 1) & whole)

    first = F.col("__set") == ids[0]
    report = [
        F.coalesce(F.sum(F.when(first, F.col(f"__flag_{i}"))), F.lit(0)).alias(f"v{i}") for i in range(len(counts))
    ] + [repeated(key, id_).alias(f"v{len(counts) + i}") for i, (key, id_) in enumerate(zip(keys, ids, strict=True))]
    names = [*counts, *[("unique", ", ".join(key)) for key in keys]]
    rows_of = F.array(*[
        F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"), F.col(f"v{i}").alias("violations"))
        for i, (check, column) in enumerate(names)
    ])
    return per_key.agg(*report).select(F.explode(rows_of).alias("r")).select("r.*")


def missing_keys(rows: DataFrame, column: str, parent: DataFrame, parent_key: str = "id") -> DataFrame:
    """Key values without a parent row, with their number of rows.

    The rows are counted per key before the join: a key with very many rows is one row in the shuffle.
    """
    keys = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("violations"))
    return keys.join(parent.select(F.col(parent_key).alias(column)), column, "left_anti")


def check_foreign_key(rows: DataFrame, column: str, parent: DataFrame, parent_key: str = "id") -> DataFrame:
    """One row: the checked column and its number of rows without a parent. NULL passes."""
    broken = missing_keys(rows, column, parent, parent_key)
    return broken.agg(F.coalesce(F.sum("violations"), F.lit(0)).alias("violations")).select(
        F.lit(column).alias("column"), "violations"
    )


def orphaned_markings(markings: DataFrame, words: DataFrame) -> DataFrame:
    """Marking rows whose word does not exist: one scan, one anti join. A NULL word is no orphan."""
    marked = markings.filter(F.col("word_id").isNotNull())
    return marked.join(words.select(F.col("id").alias("word_id")), "word_id", "left_anti").select(*markings.columns)


def owner_scope(markings: DataFrame, owner: str) -> DataFrame:
    """The rows a learner may read."""
    return markings.filter(F.col("user_id") == owner)


def split_by_owner(incoming: DataFrame, owner: str) -> tuple[DataFrame, DataFrame]:
    """Rows a learner may write, and the rejected rest."""
    own = F.col("user_id").eqNullSafe(F.lit(owner))
    return incoming.filter(own), incoming.filter(~own)
