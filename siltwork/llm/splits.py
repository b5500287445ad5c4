"""Train, validation and test splits that keep related records together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.llm.forest import spanning_forest, star_edges
from siltwork.operators.ranking import sharded_rank
from siltwork.runtime import cut

PROPORTIONS = {"train": 0.9, "val": 0.05, "test": 0.05}


def split_name(c: Column) -> Column:
    """train, val, test or held_out of any of their spellings; other values and null give null."""
    letters = F.regexp_replace(F.lower(c), r"[^a-z]+", "")
    return (
        F.when(letters.isin("train", "training"), "train").when(letters.isin("val", "valid", "validation", "dev"), "val")
        .when(letters.isin("test", "testing"), "test").when(letters.isin("heldout", "holdout"), "held_out")
    )


def record_links(df: DataFrame) -> DataFrame:
    """(key, node) rows of the examples: their group and each question id they name."""
    m = F.col("metadata")
    questions = F.array_union(F.array(m["source_question_id"]), F.coalesce(m["duplicate_source_question_ids"], F.array().cast("array<string>")))
    keys = F.array_union(F.array(F.concat(F.lit("group:"), m["duplicate_group"])), F.transform(questions, lambda q: F.concat(F.lit("question:"), q)))
    rows = df.where(F.col("example_id").isNotNull())
    return rows.select(F.explode(F.filter(keys, lambda k: k.isNotNull())).alias("key"), F.concat(F.lit("example:"), F.col("example_id")).alias("node"))


def components(df: DataFrame) -> DataFrame:
    """(example_id, root): related examples, also through others, have the same root; an example without relations is its own."""
    labels, _ = spanning_forest(star_edges(record_links(df)))  # `links` gives the other part
    labels = labels.where(F.col("node").startswith("example:")).select(F.expr("substring(node, 9)").alias("example_id"), "root")
    ids = df.where(F.col("example_id").isNotNull()).select("example_id").distinct()
    return ids.join(labels, "example_id", "left").select("example_id", F.coalesce("root", F.concat(F.lit("example:"), F.col("example_id"))).alias("root"))


def links(df: DataFrame) -> DataFrame:
    """(a, b): the spanning forest that explains the groups, edges between `example:`, `question:` and `group:` vertices.

    A hot key has parts, named by the key, \\x1f and a number. Members less roots is the number of edges.
    """
    return spanning_forest(star_edges(record_links(df)))[1]


def assign(df: DataFrame, proportions: dict[str, float] | None = None, seed: int = 42) -> DataFrame:
    """(example_id, root, members, split) of every distinct example.

    Roots are stratified by size band (powers of two of their members) and, in the order of a hash, dealt systematically:
    place r of R goes to the split whose interval of the cumulated proportions holds (r - 1/2) / R, so each band meets the
    proportions to one root. Null ids are left out, repeated ones count once, null groups link nothing, and an empty table
    stays empty. Columns other than example_id and metadata are ignored.
    """
    shares = proportions or PROPORTIONS
    found = cut(components(df))
    roots = found.groupBy("root").agg(F.count(F.lit(1)).alias("members")).withColumn("band", F.floor(F.log2("members")).cast("int"))
    ranked = sharded_rank(roots, ["band"], F.xxhash64(F.lit(seed), "root"), "root")
    sizes = roots.groupBy("band").agg(F.count(F.lit(1)).alias("_of"))  # at most 64 bands
    place = (F.col("rank") - 0.5) / F.col("_of")
    total, upto, split = sum(shares.values()), 0.0, F.lit(None).cast("string")
    for name, share in reversed(list(shares.items())):
        split = F.when(place < F.lit(1 - upto), F.lit(name)).otherwise(split) if upto else F.lit(name)
        upto += share / total
    dealt = ranked.join(F.broadcast(sizes), "band").select("root", "members", split.alias("split"))
    return found.join(dealt, "root").select("example_id", "root", "members", "split")


def broken(df: DataFrame) -> DataFrame:
    """example_id of all examples whose related records store two or more different splits."""
    found = components(df)
    stored = df.where(F.col("example_id").isNotNull()).select("example_id", split_name(F.col("metadata.split")).alias("split")).where("split is not null").distinct()
    both = cut(found.join(stored, "example_id", "left"))
    bad = both.groupBy("root").agg(F.min("split").alias("lo"), F.max("split").alias("hi")).where("lo < hi").select("root")
    return both.join(bad, "root", "left_semi").select("example_id").distinct()
