"""Session helpers: reading tables, cutting lineage, spreading rows for Python stages."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.storage import remove


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; only a local session without one gets a temporary folder."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="siltwork-")
    atexit.register(shutil.rmtree, own, True)
    sc.setCheckpointDir(own)
    return own


#: Spark removes the shuffle files of a plan as soon as it has run.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, tidy: bool = False) -> DataFrame:
    """Materialise once in the shared folder, so that neither lineage nor work repeats and a lost executor loses nothing.

    tidy: the shuffle files that made it are removed at once, so that those of long runs don't add up until the driver collects its garbage.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    if not tidy:
        return df.checkpoint(eager=True)
    before = spark.conf.get(_TIDY, None)
    spark.conf.set(_TIDY, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # the plan takes the setting when it is made
    finally:
        spark.conf.unset(_TIDY) if before is None else spark.conf.set(_TIDY, before)


def unsized(df: DataFrame) -> DataFrame:
    """A table that `cut` gave, of unknown size to plans, for loops that join a table with itself.

    The size of a join is estimated as the product of its sides and `cut` keeps the estimate, so its digits multiply in each turn, until
    the driver's memory and time go into one number.
    """
    plan, session, none = df._jdf.queryExecution().logical(), df._jdf.sparkSession(), df.sparkSession._jvm.scala.Option.empty()
    plan = plan.copy(plan.output(), plan.rdd(), plan.outputPartitioning(), plan.outputOrdering(), plan.isStreaming(), plan.stream(), session, none, none)
    return DataFrame(df.sparkSession._jvm.org.apache.spark.sql.classic.Dataset.ofRows(session, plan), df.sparkSession)


def discard(*done: DataFrame) -> None:
    """Remove the files of tables that `cut` gave and that no later step reads; a table that isn't one is left alone."""
    for df in done:
        plan = df._jdf.queryExecution().logical()
        if plan.nodeName().startswith("LogicalRDD") or "LogicalRDD" in plan.getClass().getName():
            file = plan.rdd().getCheckpointFile()
            if file.isDefined():
                remove(df.sparkSession, file.get())


#: Nodes of a plan that leave rows where they are.
_NARROW = {"Project", "Filter", "Generate", "MapInPandas", "MapInArrow", "BatchEvalPython", "ArrowEvalPython", "SubqueryAlias", "Union"}


def _narrow(plan: object) -> bool:
    below = plan.children()
    if below.size() == 0:
        return True
    return plan.nodeName() in _NARROW and all(_narrow(below.apply(i)) for i in range(below.size()))


def spread(df: DataFrame) -> DataFrame:
    """Shuffle rows round robin only where a scan has fewer partitions than the cluster has cores (Python stages).

    Rows that come out of an exchange stay as they are: adaptive execution gives those as many partitions as there are cores, and
    asking for their number would run everything beneath them once more.
    """
    if not _narrow(df._jdf.queryExecution().optimizedPlan()):
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(2 * cores)


def small(df: DataFrame, rows: int) -> DataFrame:
    """A table that `cut` gave, marked for broadcast if it has at most `rows` rows; a larger one is joined by a shuffle."""
    return F.broadcast(df) if df.count() <= rows else df
