"""Joins with assertions, set operations and issue tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class IntegrityError(ValueError):
    """A join or set operation found rows that mustn't exist."""


def strict_join(left: DataFrame, right: DataFrame, on: Sequence[str], what: str = "right side") -> DataFrame:
    """A 1:1 join: every left row finds exactly one right row, else an error with examples."""
    on = list(on)
    twice = right.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(3).collect()
    lost = left.join(right.select(*on).distinct(), on, "left_anti").select(*on).limit(3).collect()
    if twice or lost:
        raise IntegrityError(f"{what}: repeated keys {[tuple(r[:-1]) for r in twice]}, missing keys {[tuple(r) for r in lost]}")
    return left.join(right, on)


def keep_all_or_fail(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``ids``; an id without a row is an error."""
    lost = ids.join(rows.select(key), key, "left_anti").limit(3).collect()
    if lost:
        raise IntegrityError(f"ids without rows: {[r[0] for r in lost]}")
    return rows.join(ids.select(key).distinct(), key, "left_semi")


def in_given_order(rows: DataFrame, ids: DataFrame, key: str, position: str = "position") -> DataFrame:
    """Rows in the order of ``ids`` (key, position); all or nothing."""
    keep_all_or_fail(rows, ids, key)
    return ids.select(key, position).join(rows, key, "left").orderBy(position)


def one_to_one_diff(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side): keys that one side alone has."""
    a, b = left.select(key).distinct().withColumn("_l", F.lit(1)), right.select(key).distinct().withColumn("_r", F.lit(1))
    both = a.join(b, key, "full_outer")
    return both.where("_l IS NULL OR _r IS NULL").select(key, F.when(F.col("_r").isNull(), "left_only").otherwise("right_only").alias("side"))


def pending(rows: DataFrame, done: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key isn't done yet: how a resumed stage starts."""
    keys = [key] if isinstance(key, str) else list(key)
    return rows.join(done.select(*keys), keys, "left_anti")


def multiset_contained(part: DataFrame, whole: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``part`` with their counts and whether ``whole`` has each at least as often."""
    keys = list(keys)
    a = part.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_part"))
    b = whole.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_whole"))
    return a.join(b, keys, "left").select(*keys, "n_part", F.coalesce("n_whole", F.lit(0)).alias("n_whole"), (F.col("n_part") <= F.coalesce("n_whole", F.lit(0))).alias("contained"))


def disjoint_issues(df: DataFrame, key: str, pool: str) -> DataFrame:
    """Keys that lie in more than one pool."""
    return df.groupBy(key).agg(F.countDistinct(pool).alias("n_pools")).where("n_pools > 1")


def issues(df: DataFrame, id_col: str, rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """(id, code, severity) for each rule (code, severity, condition) that a row breaks.

    One pass: the broken rules of a row are an array that is exploded, not a union of scans.
    """
    broken = F.array_compact(F.array(*[F.when(bad, F.struct(F.lit(code).alias("code"), F.lit(sev).alias("severity"))) for code, sev, bad in rules]))
    return df.select(F.col(id_col), F.explode(broken).alias("i")).select(id_col, "i.code", "i.severity")


def set_equal(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same set of rows."""
    return not a.subtract(b).limit(1).count() and not b.subtract(a).limit(1).count()
