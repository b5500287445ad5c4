"""Rule checks of drafts as arrays of issue codes, and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.functions import text as T
from siltwork.operators.retrieve import expand

#: Phrases that the rules look for.
FRONT_MATTER = ["table of contents", "companion website", "mastering", "launchpad", "instructor resource", "online resource", "supplement", "preface", "about the author", "glossary", "index", "answer key", "selected answers", "references"]
ABOUT_BOOK = [
    "according to the textbook", "according to this textbook", "in the textbook", "which chapter", "what chapter", "which page", "what page", "who wrote this textbook", "author of this textbook", "authors of this textbook",
]
DIRECT = ["what is", "what are", "which is", "which are", "name the", "identify the", "give the"]
CONCEPTUAL = ["why", "how", "best explains", "best describes", "would happen", "most likely", "compared", "relative to", "because", "infer", "conclude", "predict"]


def has_any(c: Column, phrases: list[str]) -> Column:
    out = F.lit(False)
    for p in phrases:
        out = out | c.contains(p)
    return out


def codes(*rules: tuple[Column, str]) -> Column:
    """The codes of the rules that hold, in order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(code)) for cond, code in rules]))


def _parts(d: DataFrame) -> dict[str, Column]:
    q, a = F.coalesce(d["question"]["question_text"], F.lit("")), F.coalesce(d["question"]["answer_text"], F.lit(""))
    core = F.trim(F.replace(a, F.lit("ANSWER:"), F.lit("")))
    return {"q": F.trim(q), "low": F.lower(F.trim(q)), "a": a, "core": core, "choices": d["question"]["choices"], "mc": d["question"]["answer_mode"] == "multiple_choice"}


def format_issues(d: DataFrame) -> Column:
    p = _parts(d)
    labels = F.array_join(F.transform(p["choices"], lambda c: F.upper(F.trim(c["label"]))), "")
    return codes(
        (~p["a"].startswith("ANSWER:"), "missing_answer_prefix"), (p["q"] == "", "empty_question"), (p["mc"] & ((labels != "WXYZ") | (F.size(p["choices"]) != 4)), "multiple_choice_format"),
        (p["mc"] & F.exists(p["choices"], lambda c: F.trim(c["text"]) == ""), "blank_choice"), (p["mc"] & has_any(p["low"], ["w)", "x)", "y)", "z)"]), "choices_embedded_in_question"),
        (p["mc"] & ~p["low"].contains("which of the following"), "missing_which_of_the_following"), (~p["mc"] & (F.size(p["choices"]) > 0), "short_answer_has_choices"),
        (~p["q"].endswith("?") & ~p["low"].startswith("identify all") & ~p["low"].startswith("rank the following"), "non_interrogative_format"),
    )


def answer_issues(d: DataFrame) -> Column:
    p = _parts(d)
    n = F.size(T.words(p["core"]))
    sentence = p["core"].rlike(r"[.?!;]") | (n > 12) | ((n > 8) & F.lower(p["core"]).rlike(r"^(because|it|they|this|that|these|those|the)\b"))
    return codes((F.length(p["core"]) < 2, "empty_answer"), (~p["mc"] & sentence, "sentence_answer_for_short_answer"), (has_any(p["low"], ABOUT_BOOK), "source_material_meta"))


def style_issues(d: DataFrame) -> Column:
    p = _parts(d)
    direct = F.lit(False)
    for s in DIRECT:
        direct = direct | p["low"].startswith(s)
    direct = direct & ~has_any(p["low"], CONCEPTUAL)
    short = F.size(T.words(p["q"])) <= 18
    parts = F.size(F.filter(F.split(p["q"], r"[.!?]+"), lambda x: F.trim(x) != ""))
    return codes((direct & short, "reaction_speed_test"), (direct & ~short, "overly_direct_recall"), ((p["core"] != "") & p["low"].contains(F.lower(p["core"])), "answer_in_stem"), (parts >= 3, "unnecessary_flavor_text"))


def topic_overlap(question: Column, subcategory: Column, topics: Column) -> Column:
    """Share of the request's terms that the question has; the topics are expanded like the subcategory."""
    asked = F.array_distinct(T.runs(F.array_join(F.concat(expand(subcategory), F.flatten(F.transform(topics, expand))), " ")))
    return T.overlap(asked, T.runs(F.coalesce(question, F.lit(""))))


def topic_score(question: Column, subcategory: Column, topics: Column) -> Column:
    return F.round(F.least(F.lit(1.0), 2 * topic_overlap(question, subcategory, topics)), 3)


def source_issues(drafts: DataFrame, chunks: DataFrame) -> DataFrame:
    """(draft_id, fact_issues, suspect_chunks): no citation, cited chunks that don't exist, and cited text that looks like front matter."""
    cited = drafts.select("draft_id", F.explode_outer("citations").alias("c")).select("draft_id", F.col("c.chunk_id").alias("chunk_id")).distinct()
    looks = chunks.groupBy("chunk_id").agg(F.max(has_any(F.lower(F.coalesce("text", F.lit(""))), FRONT_MATTER)).alias("front"))
    g = cited.join(looks, "chunk_id", "left").groupBy("draft_id").agg(
        F.count("chunk_id").alias("n"), F.count("front").alias("known"), F.array_sort(F.collect_set(F.when(F.col("front"), F.col("chunk_id")))).alias("suspect_chunks")
    )
    return g.select("draft_id", codes((F.col("n") == 0, "missing_citation"), ((F.col("n") > 0) & (F.col("known") == 0), "missing_fact_chunk"), (F.size("suspect_chunks") > 0, "suspicious_source_chunk")).alias("fact_issues"), "suspect_chunks")


def verdict(facts: Column, *others: Column) -> Column:
    """pass without any issue, revise where the facts hold, else fail."""
    return F.when(F.size(facts) > 0, "fail").when(sum((F.size(c) for c in others), F.lit(0)) > 0, "revise").otherwise("pass")


def verdicts(drafts: DataFrame, chunks: DataFrame, questions: DataFrame | None = None) -> DataFrame:
    """Per draft its issues by the five checks, topic and style scores, and pass, revise or fail.

    The request is that of the draft: its subcategory, and `topic_focus` if the drafts have one. A style matches if any question of
    `questions` has the draft's category and type; without questions none does. Difficulty and novelty are not judged and always hold.
    """
    from siltwork.operators.tables import newest

    d = newest(drafts.where("draft_id is not null"), ["draft_id"], "loaded_at")
    topics = F.col("topic_focus") if "topic_focus" in d.columns else F.array().cast("array<string>")
    q = d["question"]
    overlap = topic_overlap(q["question_text"], q["subcategory"], F.coalesce(topics, F.array().cast("array<string>")))
    rules = d.select(
        "draft_id", q["category"].alias("category"), q["question_type"].alias("question_type"), format_issues(d).alias("format_issues"), answer_issues(d).alias("answer_issues"), style_issues(d).alias("style_issues"),
        codes((overlap == 0, "topic_mismatch")).alias("topic_issues"), F.round(F.least(F.lit(1.0), 2 * overlap), 3).alias("topic_score"),
    )
    kinds = questions.select("category", "question_type").distinct().withColumn("_like", F.lit(True)) if questions is not None else None
    out = (rules.join(F.broadcast(kinds), ["category", "question_type"], "left") if kinds is not None else rules.withColumn("_like", F.lit(None).cast("boolean"))).join(source_issues(d, chunks), "draft_id")
    out = out.withColumn("style_score", style_share(F.col("style_issues"), F.coalesce("_like", F.lit(False)))).drop("_like")
    return out.withColumn("verdict", verdict(F.col("fact_issues"), F.col("format_issues"), F.col("answer_issues"), F.col("topic_issues"), F.col("style_issues")))


def style_share(issues: Column, matched: Column) -> Column:
    return F.round(F.greatest(F.lit(0.0), 1.0 - F.when(matched, 0.0).otherwise(0.1) - 0.35 * F.size(issues)), 3)


def display_scores(v: DataFrame) -> DataFrame:
    """Scores of a verdict for display: format and facts as 0 or 1, topic and style, and the mean of the four."""
    ok = lambda c: (F.size(c) == 0).cast("double")
    s = v.select("draft_id", ok("format_issues").alias("format"), ok("fact_issues").alias("facts"), F.round("topic_score", 3).alias("topic"), F.round("style_score", 3).alias("style"))
    return s.withColumn("overall", F.round((F.col("format") + F.col("facts") + F.col("topic") + F.col("style")) / 4, 3))


#: Names of the issues of a model's review, and the check that each belongs to.
REVIEW_ISSUES = {"format_issues": "format", "topic_issues": "topic", "style_issues": "style", "scientific_accuracy_issues": "fact"}


def with_review(v: DataFrame, reviews: DataFrame) -> DataFrame:
    """Verdicts after a model's review (draft_id, review), a JSON object: its issues join those of the rules, a solver's other
    answer is an issue of fact, its scores replace those of topic and style. A review that is null or no object changes nothing."""
    listed = lambda n: F.filter(F.transform(F.coalesce(F.from_json(F.get_json_object("review", f"$.{n}"), "array<string>"), F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != "")
    out = v.join(reviews.select("draft_id", "review"), "draft_id", "left")
    for name, check in REVIEW_ISSUES.items():
        code = F.transform(listed(name), lambda _, n=name: F.lit("llm_" + n.removesuffix("s")))
        out = out.withColumn(f"{check}_issues", F.concat(f"{check}_issues", code))
    differs = F.get_json_object("review", "$.solver_answer_matches_expected") == "false"
    out = out.withColumn("fact_issues", F.concat("fact_issues", F.when(differs, F.array(F.lit("solver_answer_mismatch"))).otherwise(F.array().cast("array<string>"))))
    for c in ("topic_score", "style_score"):
        out = out.withColumn(c, F.coalesce(F.get_json_object("review", f"$.{c}").try_cast("double"), F.col(c)))
    return out.drop("review").withColumn("verdict", verdict(F.col("fact_issues"), F.col("format_issues"), F.col("answer_issues"), F.col("topic_issues"), F.col("style_issues")))
