"""Curation of questions: labels, gates, fingerprints, dedupe, splits without leaks, export and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.functions import text as T
from siltwork.operators.tables import newest

#: Names of the source filters, subcategories that say nothing, reasons in the order in which they are tried.
PROFILES = {"mit_recent": ("recent",), "mit_all": ("mit",), "mit_recent_plus_nsb": ("recent", "official_nsb"), "mit_all_plus_nsb": ("mit", "official_nsb")}
UNKNOWN_SUBCATEGORIES = ["", "other", "unknown", "unspecified", "none"]
REASONS = [
    "profile", "legacy_energy", "missing_text", "invalid_answer_line", "contaminated_parse", "malformed_multiple_choice", "malformed_short_answer", "missing_quality", "low_quality",
]
FAMILIES = {"mit": "mit_", "official_nsb": "nsb_"}
RECENT = 2024


def family(source_id: Column, tournament: Column, named: dict[str, str] | None = None) -> Column:
    """The source's family by the prefix of its id, or by a phrase that `named` gives for the family and the tournament contains."""
    id_, t = F.lower(source_id), F.lower(F.coalesce(tournament, F.lit("")))
    out = F.lit("other")
    for name, prefix in reversed(FAMILIES.items()):
        here = id_.startswith(prefix)
        if named and name in named:
            here = here | t.contains(named[name])
        out = F.when(here, name).otherwise(out)
    return out


def gate(q: DataFrame) -> Column:
    """The first reason why a question's form is unusable, or null. Null texts and choices count as empty."""
    question, answer = (T.squeeze(F.coalesce(q[c], F.lit(""))) for c in ("question_text", "answer_text"))
    choices = F.coalesce(q["choices"], F.array().cast(q.schema["choices"].dataType))
    labels = F.concat_ws("", F.transform(choices, lambda c: c["label"]))
    return (
        F.when((question == "") | (answer == ""), "missing_text").when(~answer.startswith("ANSWER:"), "invalid_answer_line")
        .when(question.contains("ANSWER:") | F.substring(answer, 8, 1 << 30).contains("ANSWER:"), "contaminated_parse")
        .when((q["answer_mode"] == "multiple_choice") & ((F.size(choices) != 4) | (labels != "WXYZ")), "malformed_multiple_choice")
        .when((q["answer_mode"] != "multiple_choice") & (F.size(choices) > 0), "malformed_short_answer")
    )


def exact_fingerprint(q: DataFrame) -> Column:
    clean = lambda c: T.casefold(T.squeeze(F.coalesce(c, F.lit(""))))
    choices = F.array_join(F.transform(q["choices"], lambda c: F.concat(T.casefold(c["label"]), F.lit(":"), clean(c["text"]))), "|")
    return F.sha1(F.concat_ws("||", clean(q["question_text"]), clean(q["answer_text"]), F.coalesce(choices, F.lit(""))))


def near_fingerprint(q: DataFrame) -> Column:
    """Equal for records of one category and type with the same words in any order, frequent ones of the question aside."""
    answer = F.regexp_replace(F.coalesce(q["answer_text"], F.lit("")), "^ANSWER:", "")
    bag = lambda words: F.array_join(F.array_sort(words), " ")
    return F.sha1(F.concat_ws("|", q["category"], q["question_type"], bag(T.near_tokens(F.coalesce(q["question_text"], F.lit("")))), bag(T.runs(answer))))


def label_means(reviews: DataFrame) -> DataFrame:
    """Per question the mean difficulty of ratings in 1..7 and the mean of all quality ratings. Pre-aggregated map-side."""
    r = reviews.select("question_id", F.col("ratings.difficulty").alias("d"), F.col("ratings.quality").alias("q"))
    return r.groupBy("question_id").agg(F.avg(T.within(F.col("d"), 1, 7)).alias("difficulty_mean"), F.avg("q").alias("quality_mean"), F.count("q").alias("ratings"))


def candidates(questions: DataFrame, reviews: DataFrame, profile: str = "mit_recent_plus_nsb", minimum_quality: float = 0.0, include_unrated: bool = False) -> DataFrame:
    """Every question, once (its newest delivery), with labels, fingerprints and the first reason to leave it out, or null.

    A label comes from reviews, else from the source, else it is null, never a default. Filters are one expression, so a row
    is counted under one reason and Catalyst sees the whole projection.
    """
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}")
    q = newest(questions.where("question_id is not null"), ["question_id"], "loaded_at")
    s = q["source_metadata"]
    q = q.withColumns({
        "source_family": family(q["source_id"], s["tournament"]), "source_year": F.coalesce(s["year"], T.year_in(q["source_id"], s["tournament"], q["provenance"]["raw_file"])),
        "form": gate(q), "exact_fingerprint": exact_fingerprint(q), "near_fingerprint": near_fingerprint(q),
    })
    recent = (F.col("source_family") == "mit") & (F.coalesce("source_year", F.lit(0)) >= RECENT)
    j = q.join(label_means(reviews), "question_id", "left").withColumn("recent", recent)
    own = T.within(F.col("source_metadata.original_difficulty"), 1, 7)
    quality = F.coalesce("quality_mean", "source_metadata.original_quality")
    sub = T.squeeze("subcategory")
    j = j.select(
        "question_id", "source_id", "category", "question_type", "answer_mode", "question_text", "answer_text", "choices", "content_tags", "source_family", "source_year", "recent", "form", "exact_fingerprint", "near_fingerprint",
        F.when(~F.lower(sub).isin(UNKNOWN_SUBCATEGORIES), sub).alias("subcategory"),
        T.half_up(F.coalesce("difficulty_mean", own)).alias("difficulty"), F.coalesce("difficulty_mean", own).alias("difficulty_mean"),
        F.when(F.col("difficulty_mean").isNotNull(), "human_review").when(own.isNotNull(), "source_metadata").alias("difficulty_source"),
        quality.alias("quality_mean"), F.when(F.col("quality_mean").isNotNull(), "human_review").when(quality.isNotNull(), "source_metadata").alias("quality_source"),
        (F.array_contains("style_tags", "writing_sheet") | ((F.col("source_family") == "mit") & (F.col("source_type") == "dataset") & recent)).alias("writing"),
    )
    kept = F.lit(False)
    for kind in PROFILES[profile]:
        kept = kept | (F.col("recent") if kind == "recent" else F.col("source_family") == kind)
    reason = (
        F.when(~kept, "profile").when((F.col("category") == "energy") & ~F.col("recent"), "legacy_energy").when(F.col("form").isNotNull(), F.col("form"))
        .when(F.lit(not include_unrated) & F.col("writing") & F.col("quality_mean").isNull(), "missing_quality").when(F.col("writing") & (F.col("quality_mean") < minimum_quality), "low_quality")
    )
    return j.withColumn("reason", reason).drop("form", "writing")


def exclusion_counts(c: DataFrame) -> DataFrame:
    """(reason, n) of all reasons, those that never applied with 0."""
    known = c.sparkSession.createDataFrame([(r,) for r in REASONS], "reason string")
    n = c.where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return known.join(n, "reason", "left").select("reason", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def dedupe(c: DataFrame) -> DataFrame:
    """Of each exact fingerprint the record with most labels, newest source and greatest id; the ids of the others, sorted."""
    rank = F.struct(
        F.col("quality_mean").isNotNull().alias("a"), F.col("difficulty").isNotNull().alias("b"), F.col("recent").alias("c"), (F.col("source_family") == "mit").alias("d"), F.col("subcategory").isNotNull().alias("e"),
        F.col("question_id").alias("f"),
    )
    rest = [x for x in c.columns if x != "exact_fingerprint"]
    g = c.groupBy("exact_fingerprint").agg(F.max_by(F.struct(*rest), rank).alias("r"), F.collect_set("question_id").alias("ids"))
    out = g.select("exact_fingerprint", *[F.col(f"r.{x}").alias(x) for x in rest], "ids")
    return out.withColumn("duplicate_source_question_ids", F.array_sort(F.array_except("ids", F.array("question_id")))).drop("ids")


def with_splits(unique: DataFrame, held_out: DataFrame | None = None, seed: int = 42, validation: float = 0.05, test: float = 0.05) -> DataFrame:
    """split by a hash of the near fingerprint, so that variants stay together; groups with a held-out id, also of a dropped copy, are held_out."""
    if validation + test >= 1:
        raise ValueError("validation and test must leave something to train on")
    share = T.hash_share(F.concat(F.lit(f"{seed}:"), F.col("near_fingerprint")))
    split = F.when(share < test, "test").when(share < test + validation, "val").otherwise("train")
    if held_out is None:
        return unique.withColumn("split", split)
    ids = unique.select("near_fingerprint", F.explode(F.array_union(F.array("question_id"), "duplicate_source_question_ids")).alias("question_id"))
    groups = ids.join(held_out.select("question_id").distinct(), "question_id", "left_semi").select("near_fingerprint").distinct().withColumn("_held", F.lit(True))
    return unique.join(groups, "near_fingerprint", "left").withColumn("split", F.when(F.col("_held"), "held_out").otherwise(split)).drop("_held")


def curation_counts(s: DataFrame) -> DataFrame:
    """Counts by split, category, family, dataset and year in one pass of grouping sets; a null year is 'unknown'."""
    rows = s.select("split", "category", F.col("source_family").alias("family"), F.col("source_id").alias("dataset"), F.coalesce(F.col("source_year").cast("string"), F.lit("unknown")).alias("year"), "difficulty", "subcategory", "quality_mean")
    keys = ["split", "category", "family", "dataset", "year"]
    g = rows.groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys])
    g = g.agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"), F.count("difficulty").alias("with_difficulty"), F.count("subcategory").alias("with_subcategory"), F.count("quality_mean").alias("with_quality"))
    kind = F.element_at(F.create_map(*[x for i, k in enumerate(keys) for x in (F.lit(31 - (1 << (4 - i))).cast("long"), F.lit(k))]), F.col("gid"))
    return g.select(kind.alias("dimension"), F.coalesce(*keys).alias("value"), "n", "with_difficulty", "with_subcategory", "with_quality")


def examples(s: DataFrame, system_prompt: str, closing: str = "Write one new question. Return only JSON.") -> DataFrame:
    """Chat examples: what is asked for, lines without a value left out, and the question as compact JSON."""
    line = lambda label, c: F.concat(F.lit(f"{label}: "), c.cast("string"))
    topics = F.when(F.size("content_tags") > 0, F.array_join("content_tags", ", "))
    user = F.concat_ws("\n", line("Category", F.col("category")), line("Type", F.col("question_type")), line("Subcategory", F.col("subcategory")), line("Difficulty", F.col("difficulty")), line("Topic focus", topics), F.lit(closing))
    reply = F.to_json(F.struct("question_text", "answer_text", "choices"), {"ignoreNullFields": "false"})
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return s.select(F.concat(F.lit("clean_sft_"), T.slug(F.col("question_id"))).alias("example_id"), F.array(turn("system", F.lit(system_prompt)), turn("user", user), turn("assistant", reply)).alias("messages"), "split", "near_fingerprint", "exact_fingerprint")


def violations(e: DataFrame) -> DataFrame:
    """example_id and the first defect of its messages, or null."""
    m, n = e["messages"], F.size(e["messages"])
    roles = F.array_join(F.transform(m, lambda x: x["role"]), ",")
    last = F.try_element_at(m, F.lit(-1))["content"]
    keys = F.json_object_keys(last)
    code = (
        F.when(F.coalesce(roles, F.lit("")) != "system,user,assistant", "roles").when(F.exists(m, lambda x: T.squeeze(F.coalesce(x["content"], F.lit(""))) == ""), "empty_message").when(keys.isNull(), "invalid_json")
        .when(F.array_join(F.array_sort(keys), ",") != "answer_text,choices,question_text", "shape").when(T.squeeze(F.coalesce(F.get_json_object(last, "$.question_text"), F.lit(""))) == "", "empty_question").when(~F.coalesce(F.get_json_object(last, "$.answer_text"), F.lit("")).startswith("ANSWER:"), "answer_prefix")
        .when(~F.coalesce(F.get_json_object(last, "$.choices"), F.lit("")).startswith("["), "choices")
    )
    return e.select("example_id", code.alias("violation"), n.alias("messages"))
