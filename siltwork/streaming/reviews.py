"""The review log: last write per key wins, an empty write deletes; the same in a batch and in a stream."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltwork import storage
from siltwork.operators.tables import newest

#: Parts of the stored table by a hash of the key; a batch rewrites the parts that it touches.
PARTS = 64


def latest(log: DataFrame, key: str, order: list[str], empty: Column | None = None) -> DataFrame:
    """The newest row per key by a total order, without those whose newest is empty."""
    last = newest(log.where(F.col(key).isNotNull()), [key], *order)
    return last if empty is None else last.where(~F.coalesce(empty, F.lit(False)))


def progress(runs: DataFrame, reviews: DataFrame, key: str, scores: list[str] | None = None) -> DataFrame:
    """(total, reviewed, remaining) over the distinct keys of the runs, and the runs that lack any of `scores`, columns of the
    runs, as `unscored`; reviews of other keys don't count."""
    lacks = F.lit(False)
    for s in scores or []:
        lacks = lacks | F.col(s).isNull()
    r, v = runs.groupBy(key).agg(F.max(lacks.cast("int")).alias("_lacks")), reviews.select(key).distinct().withColumn("_r", F.lit(1))
    counts = [F.count(F.lit(1)).alias("total"), F.count("_r").alias("reviewed"), (F.count(F.lit(1)) - F.count("_r")).alias("remaining")]
    return r.join(v, key, "left").agg(*counts, *([F.coalesce(F.sum("_lacks"), F.lit(0)).alias("unscored")] if scores else []))


def queue(runs: DataFrame, reviews: DataFrame, key: str, show: str = "all") -> DataFrame:
    """Runs to show: unreviewed, reviewed, or all."""
    how = {"unreviewed": "left_anti", "reviewed": "left_semi"}.get(show)
    return runs.join(reviews.select(key).distinct(), key, how) if how else runs


def checked(reviews: DataFrame, low: int = 1, high: int = 7) -> DataFrame:
    """Reviews whose scores may be stored: a score out of its range, or one that is no whole number, ends the query with an error.

    `reviews` has quality and difficulty, null where not given, as in a form that was left blank.
    """
    out = reviews
    for c in ("quality", "difficulty"):
        bad = F.col(c).isNotNull() & ~(F.col(c).between(low, high) & (F.col(c) == F.floor(F.col(c))))
        out = out.withColumn(c, F.when(bad, F.raise_error(F.concat(F.lit(f"{c} must be a whole number from {low} to {high}: "), F.col(c).cast("string"))).cast("int")).otherwise(F.col(c).cast("int")))
    return out


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(p.rpartition("=")[2]) for p in (x.rpartition("/")[0] for x in storage.matching(spark, f"{folder}/version=*/parts.json")))


def _parts(spark: SparkSession, folder: str, version: int) -> dict[int, int]:
    """The version in which each part of the table was last written."""
    return {int(k): v for k, v in json.loads(storage.read_text(spark, f"{folder}/version={version}/parts.json")).items()}


def _paths(folder: str, parts: dict[int, int]) -> list[str]:
    return [f"{folder}/version={v}/part={p}" for p, v in parts.items()]


def stored(spark: SparkSession, folder: str) -> DataFrame | None:
    """The table after the last whole batch."""
    done = _numbers(spark, folder)
    paths = _paths(folder, _parts(spark, folder, done[-1])) if done else []
    return spark.read.parquet(*paths) if paths else None


def upserts(events: DataFrame, folder: str, checkpoint: str, key: str, order: list[str], keep: int = 2) -> StreamingQuery:
    """Keep the newest write per key in a folder. Deleting writes stay as rows, so that an older one that comes late can't bring a key back.

    The table lies in PARTS parts by a hash of the key. A batch merges its rows into the parts that they belong to, writes only
    those as its version, and then the list of which version holds each part. A batch that is run again starts from the
    version before its own and gives the same table. Parts that none of the last `keep` lists names are removed.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        older = [v for v in _numbers(spark, folder) if v < number]
        before = _parts(spark, folder, older[-1]) if older else {}
        rows = batch.where(F.col(key).isNotNull()).withColumn("part", F.pmod(F.xxhash64(F.col(key)), F.lit(PARTS)).cast("int")).persist()
        touched = [r.part for r in rows.select("part").distinct().collect()]  # at most PARTS numbers
        if old := _paths(folder, {p: before[p] for p in touched if p in before}):
            rows = rows.unionByName(spark.read.option("basePath", folder).parquet(*old).drop("version").withColumn("part", F.col("part").cast("int")))
        storage.remove(spark, f"{folder}/version={number}")
        if touched:
            latest(rows, key, order).write.partitionBy("part").parquet(f"{folder}/version={number}")
        batch.unpersist()
        now = before | dict.fromkeys(touched, number)
        storage.write_text(spark, f"{folder}/version={number}/parts.json", json.dumps(now, sort_keys=True))
        lists = [*older, number]
        used = {x for v in lists[-keep:] for x in _paths(folder, _parts(spark, folder, v))}
        for v in lists[:-keep]:
            kept = [x for x in storage.matching(spark, f"{folder}/version={v}/part=*") if not any(x.endswith(u[len(folder) :]) for u in used)]
            for x in kept:
                storage.remove(spark, x)
            storage.remove(spark, f"{folder}/version={v}/parts.json")

    return events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def view(spark: SparkSession, folder: str, empty: Column) -> DataFrame | None:
    t = stored(spark, folder)
    return None if t is None else t.where(~F.coalesce(empty, F.lit(False)))
