"""Samples whose category shares match targets: mergeable reservoirs, trimmed to feasible quotas after the final counts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.operators.ranking import sharded_rank
from siltwork.runtime import cut


def plain(c: Column) -> Column:
    """Lower case, other than letters and digits as one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def matches(examples: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_id, target_no, example_id), each once, of every target that an example's attributes match.

    A null attribute of a target means any value, a null attribute of an example matches only that. `examples` has
    example_id, category, subcategory, difficulty; `targets` is a request of fixed size (123 rows here), which is why it is
    broadcast. An example is compared by equality under each pattern of open attributes that occurs in the targets.
    """
    fields = ["category", "subcategory", "difficulty"]
    t = targets.select(
        "mix_id", "target_no",
        plain(F.col("category")).alias("category"), plain(F.col("subcategory")).alias("subcategory"), F.col("difficulty").cast("string").alias("difficulty"),
    )
    open_bits = sum((F.col(c).isNull().cast("int") * (1 << i) for i, c in enumerate(fields)), F.lit(0))
    t = t.withColumn("_open", open_bits).withColumn("_key", F.to_json(F.struct(*fields)))
    e = examples.select(
        "example_id",
        plain(F.col("category")).alias("category"), plain(F.col("subcategory")).alias("subcategory"), F.col("difficulty").cast("string").alias("difficulty"),
    ).distinct()
    e = e.withColumn("_open", F.explode(F.sequence(F.lit(0), F.lit(7))))
    asked = [F.when(F.col("_open").bitwiseAND(1 << i) > 0, F.lit(None)).otherwise(F.col(c)).alias(c) for i, c in enumerate(fields)]
    ok = F.lit(True)
    for i, c in enumerate(fields):
        ok = ok & ((F.col("_open").bitwiseAND(1 << i) > 0) | F.col(c).isNotNull())
    e = e.where(ok).select("example_id", "_open", F.to_json(F.struct(*asked)).alias("_key"))
    joined = e.join(F.broadcast(t.select("mix_id", "target_no", "_open", "_key")), ["_open", "_key"])
    return joined.select("mix_id", "target_no", "example_id").distinct()


def sizes(examples: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets with `wanted` (the larger of min_rows and share * sample_share * distinct examples) and the `quota` rows it takes."""
    n = examples.select("example_id").distinct().count()
    wanted = F.greatest(F.col("min_rows").cast("double"), F.col("target_share") * F.col("sample_share") * F.lit(float(n)))
    return targets.withColumn("wanted", wanted).withColumn("quota", F.ceil("wanted").cast("long"))


_KEPT = "mix_id string, target_no int, example_id string, h long, seen long"


def reservoirs(examples: DataFrame, targets: DataFrame, seed: int = 17) -> DataFrame:
    """(mix_id, target_no, example_id, h, seen), kept: the reservoirs of all partitions, and rows without an example that count what they saw.

    A partition's reservoir of a target is the set of its lowest hashes of (seed, mix, example), as many as the target's quota; the
    union of reservoirs holds the lowest of the whole, whatever the partitions, so they merge, and the counts add up. An example that
    several targets of a mix match is kept for the one that asks most attributes, then the lowest target_no, and counted for all.
    """
    asked = sum((F.col(c).isNotNull().cast("int") for c in ("category", "subcategory", "difficulty")), F.lit(0))
    detail = targets.select("mix_id", "target_no", asked.alias("_asked"))
    m = matches(examples, targets).join(F.broadcast(detail), ["mix_id", "target_no"])
    m = m.groupBy("mix_id", "example_id").agg(F.min_by("target_no", F.struct(-F.col("_asked"), F.col("target_no"))).alias("target_no"), F.collect_set("target_no").alias("all"))
    quota = sizes(examples, targets).select("mix_id", "target_no", "quota")
    rows = m.join(F.broadcast(quota), ["mix_id", "target_no"]).select("mix_id", F.col("target_no").cast("int").alias("target_no"), "example_id", hashed(seed).alias("h"), F.col("all").cast("array<int>").alias("all"), "quota")

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict = {}
        seen: Counter = Counter()
        for b in batches:
            for mix, own in zip(b["mix_id"], b["all"], strict=True):
                seen.update((mix, int(t)) for t in own)
            for key, g in b.groupby(["mix_id", "target_no"]):
                k = int(g["quota"].iloc[0])
                both = pd.concat([kept[key], g]) if key in kept else g
                kept[key] = both.sort_values(["h", "example_id"]).head(k)[["mix_id", "target_no", "example_id", "h"]]
        for g in kept.values():
            yield g.assign(seen=0)
        yield pd.DataFrame([(*key, None, 0, n) for key, n in seen.items()], columns=["mix_id", "target_no", "example_id", "h", "seen"])

    return cut(rows.mapInPandas(fill, _KEPT))


def hashed(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "mix_id", "example_id").bitwiseAND(F.lit((1 << 62) - 1))


def available(r: DataFrame) -> DataFrame:
    """(mix_id, target_no, available): the counts of merged reservoirs."""
    return r.groupBy("mix_id", "target_no").agg(F.sum("seen").alias("available"))


def trimmed(r: DataFrame, q: DataFrame) -> DataFrame:
    """(mix_id, target_no, example_id, place) of merged reservoirs, trimmed to the quotas; ranked in ranges of the hash, so no target is sorted in one task."""
    ranked = sharded_rank(r.where("example_id is not null"), ["mix_id", "target_no"], F.col("h"), "example_id")
    return ranked.join(F.broadcast(q.select("mix_id", "target_no", "quota")), ["mix_id", "target_no"]).where(F.col("rank") <= F.col("quota")).select("mix_id", "target_no", "example_id", F.col("rank").alias("place"))


def sample(examples: DataFrame, targets: DataFrame, seed: int = 17) -> DataFrame:
    """(mix_id, target_no, example_id, place): every target's reservoir, trimmed to its quota.

    An exhausted target gives all it has; `report` names it. Null ids of examples are left out, repeated examples count
    once, empty tables give an empty sample, and the choice depends on ids and seed only, never on order or partitions.
    """
    rows = examples.where(F.col("example_id").isNotNull())
    return trimmed(reservoirs(rows, targets, seed), sizes(rows, targets))


def report(examples: DataFrame, targets: DataFrame, seed: int = 17) -> DataFrame:
    """Each target with distinct matching examples (`available`), `wanted`, rows taken, the share reached, and whether it was met."""
    rows = examples.where(F.col("example_id").isNotNull())
    r, q = reservoirs(rows, targets, seed), sizes(rows, targets)
    taken = trimmed(r, q).groupBy("mix_id", "target_no").agg(F.count(F.lit(1)).alias("taken"))
    out = q.join(available(r), ["mix_id", "target_no"], "left").join(taken, ["mix_id", "target_no"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    out = out.withColumn("available", zero("available")).withColumn("taken", zero("taken"))
    totals = out.groupBy("mix_id").agg(F.sum("taken").alias("_total"))
    out = out.join(F.broadcast(totals), "mix_id")
    reached = F.when(F.col("_total") > 0, F.col("taken") / F.col("_total")).otherwise(F.lit(0.0))
    return out.select("mix_id", "target_no", "target_share", "min_rows", "wanted", "quota", "available", "taken", reached.alias("reached_share"), (F.col("available") >= F.col("wanted")).alias("met"))


def unmet(examples: DataFrame, targets: DataFrame, seed: int = 17) -> DataFrame:
    """(mix_id, target_no) of the targets whose merged reservoirs saw fewer distinct examples than wanted."""
    rows = examples.where(F.col("example_id").isNotNull())
    out = sizes(rows, targets).join(available(reservoirs(rows, targets, seed)), ["mix_id", "target_no"], "left")
    return out.where(F.coalesce("available", F.lit(0)) < F.col("wanted")).select("mix_id", F.col("target_no").cast("int").alias("target_no"))
