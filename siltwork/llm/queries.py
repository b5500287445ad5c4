"""The pN_ queries over the test tables, with production parameters, and the SQL that states some of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.llm import answers, consensus, encode, leaks, mixture, near, pieces, scans, severity, splits
from siltwork.runtime import table

Query = Callable[[SparkSession, str], DataFrame]


def _examples(spark: SparkSession, d: str) -> DataFrame:
    m = ["metadata.category", "metadata.subcategory", "metadata.difficulty"]
    return table(spark, d, "sft_examples").select("example_id", *m)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return mixture.unmet(_examples(spark, d), table(spark, d, "sample_targets"))


def p1_sample(spark: SparkSession, d: str) -> DataFrame:
    return mixture.sample(_examples(spark, d), table(spark, d, "sample_targets"))


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return mixture.report(_examples(spark, d), table(spark, d, "sample_targets"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return pieces.oversized(table(spark, d, "textbook_chunks"))


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    return pieces.split_chunks(table(spark, d, "textbook_chunks"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.broken(table(spark, d, "sft_examples"))


def p3_splits(spark: SparkSession, d: str) -> DataFrame:
    return splits.assign(table(spark, d, "sft_examples"))


def p3_forest(spark: SparkSession, d: str) -> DataFrame:
    return splits.links(table(spark, d, "sft_examples"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return consensus.unrelated(table(spark, d, "reviews"))


def p4_reliability(spark: SparkSession, d: str) -> DataFrame:
    return consensus.reliability(table(spark, d, "reviews"))


def p4_consensus(spark: SparkSession, d: str) -> DataFrame:
    return consensus.consensus(table(spark, d, "reviews"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.noise(table(spark, d, "textbook_chunks"))


def p5_repaired(spark: SparkSession, d: str) -> DataFrame:
    return scans.repair_chunks(table(spark, d, "textbook_chunks")).select("chunk_id", "noise", "repaired")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = near.similar_pairs(table(spark, d, "questions"), "question_id", ["question_text", "answer_text"])
    return pairs.select(F.col("a").alias("question_id_a"), F.col("b").alias("question_id_b"))


def p6_groups(spark: SparkSession, d: str) -> DataFrame:
    return near.groups(table(spark, d, "questions"), "question_id", ["question_text", "answer_text"])


def p6_members(spark: SparkSession, d: str) -> DataFrame:
    return near.representatives(table(spark, d, "questions"), "question_id", ["question_text", "answer_text"])[0]


def p6_links(spark: SparkSession, d: str) -> DataFrame:
    return near.representatives(table(spark, d, "questions"), "question_id", ["question_text", "answer_text"])[1]


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return answers.defective(table(spark, d, "drafts"))


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return answers.defects(table(spark, d, "drafts"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.encode_texts(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaks(table(spark, d, "documents"), table(spark, d, "heldout_items")).select("doc_id", "item_id")


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaked_items(table(spark, d, "documents"), table(spark, d, "heldout_items"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    s = severity.score(table(spark, d, "documents"), table(spark, d, "doc_flags"))
    return s.where(F.col("flagged") & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    return severity.score(table(spark, d, "documents"), table(spark, d, "doc_flags"))


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    return severity.rates(table(spark, d, "documents"), table(spark, d, "doc_flags"))


def queries() -> dict[str, Query]:
    own = {k: f for k, f in globals().items() if k[:1] == "p" and k[1:2].isdigit()}
    return dict(sorted(own.items(), key=lambda x: (int(x[0][1:].split("_")[0]), x[0])))


_PLAIN = "trim(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def oracle_sql() -> dict[str, str]:
    norm = _PLAIN.format
    return {
        "p1_found": f"""
            with e as (select distinct example_id, {norm('metadata.category')} c, {norm('metadata.subcategory')} s, metadata.difficulty d
                       from sft_examples where example_id is not null),
                 n as (select count(distinct example_id) n from e),
                 t as (select mix_id, target_no, {norm('category')} c, {norm('subcategory')} s, difficulty d, min_rows,
                              target_share * sample_share as share from sample_targets),
                 m as (select t.mix_id, t.target_no, count(distinct e.example_id) k from t left join e
                       on (t.c is null or t.c = e.c) and (t.s is null or t.s = e.s) and (t.d is null or t.d = e.d) group by all)
            select t.mix_id, cast(t.target_no as int) target_no from t join m using (mix_id, target_no), n
            where m.k < greatest(cast(t.min_rows as double), t.share * n.n)""",
        "p2_found": """select distinct chunk_id from textbook_chunks
            where len(list_filter(string_split_regex(text, '[\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}]+'), lambda w: w <> '')) > 180""",
        "p6_found": """
            with q as (select distinct question_id id, list_distinct(regexp_extract_all(lower(question_text || ' ' || answer_text), '[a-z0-9]+')) w
                       from questions where question_text <> '' and answer_text <> ''),
                 p as (select a.id a, b.id b, len(list_intersect(a.w, b.w)) i, len(a.w) + len(b.w) u
                       from q a join q b on a.id < b.id and least(len(a.w), len(b.w)) >= 0.7 * greatest(len(a.w), len(b.w)))
            select distinct a question_id_a, b question_id_b from p where i >= 0.7 * (u - i)""",
    }
