"""Books from files to chunks, and the clean export, as whole plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.operators import curate, pages
from siltwork.operators.tables import require_unique
from siltwork.runtime import cut
from siltwork.sources import files, schemas


def chunks_of(pages_in: DataFrame, first: int | None = None, last: int | None = None, size: int = 180, overlap: int = 30) -> DataFrame:
    """Pages in their content range (given, or found per document), with headings carried forward, cleaned, as overlapping chunks."""
    p = pages_in.where("document_id is not null and page_no is not null")
    if first is not None or last is not None:
        p = p.where(F.col("page_no").between(first or 1, last or (1 << 30)))
    else:
        r = pages.content_pages(p)
        p = p.join(r, "document_id").where(F.col("page_no").between(F.col("first_page"), F.col("last_page"))).select("document_id", "page_no", "text")
    heads = pages.headings(p)
    return pages.chunk_words(pages.clean_pages(p).join(heads, ["document_id", "page_no"]), size, overlap)


def corpus(spark: SparkSession, folder: str, sources: list[dict], out: str, size: int = 180, overlap: int = 30, version: str = "v1") -> DataFrame:
    """(document_id, chunks) of a corpus written by document. A source names its file, title, topics, and may give a hash and pages.

    Hashes are checked before anything is written. Sources are a short list, all documents are one job.
    """
    expected = {s["file"]: s["sha256"] for s in sources if s.get("sha256")}
    files.require_hash(files.hashed_files(spark, f"{folder}/*"), expected).select("path").count()
    meta = spark.createDataFrame([(s["document_id"], s.get("title"), s.get("topics") or [], s["file"].rsplit(".", 1)[0]) for s in sources], "document_id string, title string, topics array<string>, stem string")
    p = files.read_pages(spark, f"{folder}/*").withColumnRenamed("document_id", "stem").join(F.broadcast(meta.select("stem", "document_id")), "stem")
    c = chunks_of(p.select("document_id", "page_no", "text"), size=size, overlap=overlap).join(F.broadcast(meta.drop("stem")), "document_id")
    c = require_unique(cut(c.withColumn("metadata", F.create_map(F.lit("corpus_version"), F.lit(version)))), "chunk_id")
    c.write.mode("overwrite").partitionBy("document_id").option("ignoreNullFields", "false").json(out)
    return c.groupBy("document_id").agg(F.count(F.lit(1)).alias("chunks"))


def clean_export(spark: SparkSession, questions: list[str], reviews: list[str], out: str, profile: str = "mit_recent_plus_nsb", held_out: str | None = None, system_prompt: str = "You write quiz questions.", seed: int = 42, validation: float = 0.05, test: float = 0.05) -> DataFrame:
    """Read, filter, label, dedupe, split and write chat examples by split, with a manifest; the exclusion counts are returned."""
    q = files.read_jsonl(spark, questions, schemas.QUESTION)
    clash = q.groupBy("question_id").agg(F.count_distinct(curate.exact_fingerprint(q)).alias("n")).where("n > 1").limit(1).collect()
    if clash:
        raise ValueError(f"question {clash[0].question_id!r} has different contents")
    q = q.withColumn("loaded_at", F.lit(None).cast("timestamp"))
    r = files.read_jsonl(spark, reviews, schemas.REVIEW) if reviews else spark.createDataFrame([], schemas.REVIEW)
    c = cut(curate.candidates(q, r, profile))
    ids = files.read_ids(spark, held_out) if held_out else None
    s = cut(curate.with_splits(curate.dedupe(c.where("reason is null")), ids, seed, validation, test))
    files.write_splits(curate.examples(s, system_prompt), out, ["train", "val", "test", "held_out"])
    row = s.agg(F.count(F.lit(1)).alias("examples"), *[F.count_if(F.col("split") == x).alias(x) for x in ("train", "val", "test", "held_out")], F.count("difficulty").alias("with_difficulty"), F.count("quality_mean").alias("with_quality"))
    files.write_manifest(row, f"{out}/manifest.json")
    return curate.exclusion_counts(c)


def check_export(spark: SparkSession, folder: str) -> dict[str, int]:
    """Counts by split of a clean export; raises on a missing split, a repeated or malformed example, or a group in two splits."""
    e = cut(spark.read.schema("example_id string, messages array<struct<role:string,content:string>>, near_fingerprint string, split string").json(folder))
    n = {r.split: r["count"] for r in e.groupBy("split").count().collect()}
    for need in ("train", "val"):
        if not n.get(need):
            raise ValueError(f"no examples in {need}")
    require_unique(e, "example_id")
    bad = curate.violations(e).where("violation is not null").limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0].example_id}: {bad[0].violation}")
    shared = e.groupBy("near_fingerprint").agg(F.count_distinct("split").alias("n")).where("n > 1").limit(1).collect()
    if shared:
        raise ValueError(f"group {shared[0].near_fingerprint} is in several splits")
    return n
