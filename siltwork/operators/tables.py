"""Keyed operations on tables: newest rows, uniqueness, set algebra, disjointness, unpivoting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """One row per key: the greatest by `order`, then by all other comparable columns, so ties have one outcome. An aggregate, no sort."""
    rest = [c for c in df.columns if c not in keys]
    plain = [c for c, t in df.dtypes if c not in keys and c not in order and "map<" not in t and t != "variant"]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order, *plain)).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def first_by(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def repeated(df: DataFrame, key: Column, name: str) -> DataFrame:
    """(name, copies) of the keys that occur more than once."""
    return df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """The table, or an error that names a repeated key when it is run."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key).limit(1).collect()
    if n:
        raise ValueError(f"repeated {key}: {n[0][0]!r}")
    return df


def conflicting(df: DataFrame, key: str, value: Column) -> DataFrame:
    """Keys with more than one distinct value."""
    return df.groupBy(key).agg(F.count_distinct(value).alias("values")).where("values > 1")


def id_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """How many distinct keys are in both, in a only and in b only, from one aggregation."""
    sides = a.select(key, F.lit(1).alias("s")).union(b.select(key, F.lit(2).alias("s"))).where(F.col(key).isNotNull())
    which = sides.groupBy(key).agg(F.bit_or("s").alias("s"))
    count = lambda v: F.count_if(F.col("s") == v)
    return which.agg(count(3).alias("in_both"), count(1).alias("first_only"), count(2).alias("second_only"))


def spanning(df: DataFrame, key: Column, part: Column, name: str) -> DataFrame:
    """(name, parts) of keys that occur in more than one part, such as groups in several splits."""
    return df.where(key.isNotNull() & part.isNotNull()).groupBy(key.alias(name)).agg(F.count_distinct(part).alias("parts")).where("parts > 1")


def unpivot_in_range(df: DataFrame, ids: list[str], ranges: dict[str, tuple[float, float]], kind: str = "kind", value: str = "value") -> DataFrame:
    """One row per (ids, column) whose value is in the column's range."""
    long = df.unpivot(ids, list(ranges), kind, value)
    ok = F.lit(False)
    for c, (lo, hi) in ranges.items():
        ok = ok | ((F.col(kind) == c) & F.col(value).between(lo, hi))
    return long.where(ok)
