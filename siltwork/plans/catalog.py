"""The queries of the engine's own operators over the test tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.functions import text as T
from siltwork.operators import curate, pages, retrieve, tables, verify
from siltwork.runtime import cut, table
from siltwork.sources import files, schemas, workbooks
from siltwork.streaming import reviews as log

Query = Callable[[SparkSession, str], DataFrame]

#: Requests that the retrieval queries answer.
REQUESTS = [
    ("s1", "biology", "Genetics", "tossup", "short_answer", 4, ["chromosome allele", "transcript"]),
    ("s2", "earth_space", "Hydrology", "tossup", None, 3, ["aquifer", "watershed"]),
    ("s3", "physics", "Optics", "bonus", "multiple_choice", 5, ["lens prism diffraction spectrum"]),
    ("s4", "chemistry", "Kinetics", "tossup", "short_answer", 2, ["catalyst"]),
    ("s5", "math", "NT", "bonus", None, 6, ["modulus divisor prime residue"]),
    ("s6", "earth_space", "Meteo", "tossup", "short_answer", 1, []),
]


def _specs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REQUESTS, retrieve.SPEC)


def _questions(spark: SparkSession, d: str) -> DataFrame:
    return tables.newest(table(spark, d, "questions").where("question_id is not null"), ["question_id"], "loaded_at")


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    """Each chunk's newest delivery. The choice needs a key, a time and a hash of the row; whole rows move once, to meet it."""
    return tables.newest(table(spark, d, "textbook_chunks").where("chunk_id is not null"), ["chunk_id"], "loaded_at")


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    return curate.candidates(table(spark, d, "questions"), table(spark, d, "reviews"), "mit_all_plus_nsb")


def _split(spark: SparkSession, d: str) -> DataFrame:
    return curate.with_splits(curate.dedupe(_candidates(spark, d).where("reason is null")))


def fingerprints(spark: SparkSession, d: str) -> DataFrame:
    q = _questions(spark, d)
    return q.select("question_id", curate.exact_fingerprint(q).alias("exact_fingerprint"), curate.near_fingerprint(q).alias("near_fingerprint"))


def label_means(spark: SparkSession, d: str) -> DataFrame:
    return curate.label_means(table(spark, d, "reviews")).select("question_id", F.round("difficulty_mean", 6).alias("difficulty_mean"), F.round("quality_mean", 6).alias("quality_mean"), "ratings")


def gate_reasons(spark: SparkSession, d: str) -> DataFrame:
    q = _questions(spark, d)
    return q.select("question_id", curate.gate(q).alias("reason"))


def exclusion_counts(spark: SparkSession, d: str) -> DataFrame:
    return curate.exclusion_counts(_candidates(spark, d))


def exact_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return curate.dedupe(_candidates(spark, d).where("reason is null")).select("question_id", "exact_fingerprint", "difficulty", F.array_join("duplicate_source_question_ids", ",").alias("duplicates"))


def hash_split(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d).select("question_id", "near_fingerprint", "split")


def held_out_split(spark: SparkSession, d: str) -> DataFrame:
    spelled = F.regexp_replace(F.lower("metadata.split"), "[^a-z]+", "").isin("heldout", "holdout")
    held = table(spark, d, "sft_examples").where(spelled).select(F.col("metadata.source_question_id").alias("question_id"))
    return curate.with_splits(curate.dedupe(_candidates(spark, d).where("reason is null")), held).select("question_id", "split")


def curation_counts(spark: SparkSession, d: str) -> DataFrame:
    return curate.curation_counts(_split(spark, d))


def chat_examples(spark: SparkSession, d: str) -> DataFrame:
    e = curate.examples(_split(spark, d), "You write quiz questions for school science teams.")
    return e.select("example_id", F.col("messages")[1]["content"].alias("request"), "split")


def example_violations(spark: SparkSession, d: str) -> DataFrame:
    return curate.violations(tables.newest(table(spark, d, "sft_examples").where("example_id is not null"), ["example_id"], "loaded_at"))


def split_overlaps(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "sft_examples")
    return tables.spanning(e, F.col("metadata.duplicate_group"), F.lower(F.trim("metadata.split")), "duplicate_group")


def repeated_ids(spark: SparkSession, d: str) -> DataFrame:
    return tables.repeated(table(spark, d, "textbook_chunks"), F.col("chunk_id"), "chunk_id")


def version_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return tables.conflicting(table(spark, d, "textbook_chunks"), "document_id", F.coalesce("metadata.corpus_version", F.lit("legacy")))


def id_sets(spark: SparkSession, d: str) -> DataFrame:
    return tables.id_sets(table(spark, d, "questions").select("question_id"), table(spark, d, "sft_examples").select(F.col("metadata.source_question_id").alias("question_id")), "question_id")


def reviewed_questions(spark: SparkSession, d: str) -> DataFrame:
    q, r = table(spark, d, "questions").select("question_id").distinct(), table(spark, d, "reviews").select("question_id")
    return log.queue(q, r, "question_id", "reviewed")


def unreviewed_questions(spark: SparkSession, d: str) -> DataFrame:
    q, r = table(spark, d, "questions").select("question_id").distinct(), table(spark, d, "reviews").select("question_id")
    return log.queue(q, r, "question_id", "unreviewed")


def review_progress(spark: SparkSession, d: str) -> DataFrame:
    return log.progress(table(spark, d, "questions"), table(spark, d, "reviews"), "question_id")


def review_latest(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "reviews").select(F.concat_ws("|", "question_id", F.lower(F.trim("reviewer_id"))).alias("key"), "review_timestamp", "loaded_at", "review_id", "ratings.quality", "ratings.difficulty")
    return log.latest(r, "key", ["review_timestamp", "loaded_at", "review_id"], F.col("quality").isNull() & F.col("difficulty").isNull()).select("key", "review_id", "quality", "difficulty")


def event_latest(spark: SparkSession, d: str) -> DataFrame:
    return log.latest(table(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "logout").select("user_id", "event_id", "event_type")


def ratings_unpivot(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "reviews").select("review_id", "ratings.quality", "ratings.difficulty").distinct()
    return tables.unpivot_in_range(r, ["review_id"], {"quality": (-1, 1), "difficulty": (1, 7)})


def line_values(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax")
    long = tables.unpivot_in_range(x, ["l_returnflag", "l_linestatus"], {"l_quantity": (10, 40), "l_discount": (0.02, 0.08), "l_tax": (0, 0.05)})
    return long.groupBy("l_returnflag", "l_linestatus", "kind").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


def customer_orders(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("spent"))
    c = table(spark, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select("c_custkey", "n_name", F.coalesce("orders", F.lit(0)).cast("long").alias("orders"), F.coalesce("spent", F.lit(0.0)).alias("spent"))


def part_slugs(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select("p_partkey", T.slug(F.col("p_name")).alias("slug"), T.slug(F.concat_ws(" / ", "p_brand", "p_type")).alias("kind"), T.half_up(F.col("p_size") / 7.0).alias("grade"), T.half_even(F.col("p_size") / 2.0).alias("half"))


def source_years(spark: SparkSession, d: str) -> DataFrame:
    q, m = _questions(spark, d), F.col("source_metadata")
    return q.select("question_id", curate.family(F.col("source_id"), m["tournament"]).alias("family"), F.coalesce(m["year"], T.year_in(F.col("source_id"), m["tournament"], F.col("provenance.raw_file"))).alias("year"))


def answer_parts(spark: SparkSession, d: str) -> DataFrame:
    q = _questions(spark, d)
    hit = F.try_element_at(F.filter("choices", lambda c: c["label"] == F.substring("answer_text", 9, 1)), F.lit(1))["text"]
    return q.select("question_id", hit.alias("choice_text"), F.array_join(T.guidance(F.array_join("answer_guidance.accept", ";")), "|").alias("accept"))


def subcategories(spark: SparkSession, d: str) -> DataFrame:
    q = _questions(spark, d).where("subcategory is not null")
    return q.groupBy(retrieve.canonical(F.col("subcategory")).alias("subcategory")).agg(F.count(F.lit(1)).alias("n"), F.max(F.size(retrieve.expand(F.col("subcategory")))).alias("phrases"))


def chunk_counts(spark: SparkSession, d: str) -> DataFrame:
    c = _chunks(spark, d)
    return c.select("chunk_id", F.char_length("text").cast("long").alias("chars"), T.token_count(F.col("text")).cast("long").alias("words"), pages.locator().alias("locator"))


def _as_pages(spark: SparkSession, d: str) -> DataFrame:
    """Chunks as pages of their documents, in the order of their ids."""
    from pyspark.sql import Window

    c = _chunks(spark, d).select("document_id", "chunk_id", "text")
    return c.withColumn("page_no", F.row_number().over(Window.partitionBy("document_id").orderBy("chunk_id"))).select("document_id", "page_no", "text")


def page_lines(spark: SparkSession, d: str) -> DataFrame:
    return pages.kept_lines(_as_pages(spark, d)).where("filled").groupBy("document_id", "page_no").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.char_length("line")).alias("chars"))


def cleaned_pages(spark: SparkSession, d: str) -> DataFrame:
    return pages.clean_pages(_as_pages(spark, d))


def page_headings(spark: SparkSession, d: str) -> DataFrame:
    return pages.headings(_as_pages(spark, d))


def page_ranges(spark: SparkSession, d: str) -> DataFrame:
    return pages.content_pages(_as_pages(spark, d))


def word_chunks(spark: SparkSession, d: str) -> DataFrame:
    return pages.chunk_words(_as_pages(spark, d)).select("document_id", "chunk_index", F.array_min("pages").alias("first_page"), F.array_max("pages").alias("last_page"), F.sha1("text").alias("text_sha1"))


def bm25_scores(spark: SparkSession, d: str) -> DataFrame:
    return retrieve.bm25(_chunks(spark, d), _specs(spark)).select("spec_id", "chunk_id", F.round("score", 6).alias("score"))


def style_scores(spark: SparkSession, d: str) -> DataFrame:
    return retrieve.style_scores(_specs(spark), _questions(spark, d)).select("spec_id", "question_id", (F.round("score", 6) + 0.0).alias("score"))


def diverse_facts(spark: SparkSession, d: str) -> DataFrame:
    return retrieve.facts(_chunks(spark, d), _specs(spark)).select("spec_id", "chunk_id", "place", F.round("score", 6).alias("score"))


def retrieval_bundles(spark: SparkSession, d: str) -> DataFrame:
    """Both ranked lists of each request's bundle, as rows."""
    b = retrieve.bundles(_chunks(spark, d), _questions(spark, d), _specs(spark))
    one = lambda c, i, kind: b.select("spec_id", F.lit(kind).alias("kind"), F.explode(c).alias("x")).select("spec_id", "kind", F.col(f"x.{i}").alias("id"), "x.place", (F.round("x.score", 6) + 0.0).alias("score"))
    return one("fact_chunks", "chunk_id", "fact").union(one("style_examples", "question_id", "style"))


def draft_issues(spark: SparkSession, d: str) -> DataFrame:
    x = tables.newest(table(spark, d, "drafts").where("draft_id is not null"), ["draft_id"], "loaded_at")
    j = lambda c: F.array_join(c, ",")
    return x.select("draft_id", j(verify.format_issues(x)).alias("format_issues"), j(verify.answer_issues(x)).alias("answer_issues"), j(verify.style_issues(x)).alias("style_issues"))


def _verdicts(spark: SparkSession, d: str) -> DataFrame:
    return verify.verdicts(table(spark, d, "drafts"), table(spark, d, "textbook_chunks"), table(spark, d, "questions"))


def draft_verdicts(spark: SparkSession, d: str) -> DataFrame:
    v = _verdicts(spark, d)
    return v.select("draft_id", F.array_join("fact_issues", ",").alias("fact_issues"), F.array_join("topic_issues", ",").alias("topic_issues"), F.array_join("suspect_chunks", ",").alias("suspect_chunks"), "verdict")


def draft_scores(spark: SparkSession, d: str) -> DataFrame:
    return verify.display_scores(_verdicts(spark, d))


def draft_citations(spark: SparkSession, d: str) -> DataFrame:
    x = tables.newest(table(spark, d, "drafts").where("draft_id is not null"), ["draft_id"], "loaded_at")
    return x.select("draft_id", F.explode(F.array_distinct(F.transform("citations", lambda c: c["chunk_id"]))).alias("chunk_id")).join(_chunks(spark, d).select("chunk_id", "document_id"), "chunk_id").select("draft_id", "chunk_id", "document_id")


def _numbered(df: DataFrame, file: str, key: str) -> DataFrame:
    """Rows with `file` and `ordinal`, their place in it by `key`."""
    from pyspark.sql import Window

    return df.withColumn("file", F.expr(file)).withColumn("ordinal", F.row_number().over(Window.partitionBy("file").orderBy(key)) - 1)


#: What the questions look like as a hand-made sheet; the SQL has the same expressions.
SHEET = {
    "Type": "case when difficulty = 7 then 'Visual Bonus' else upper(question_type) end", "Category": "case category when 'earth_space' then 'Earth Science' when 'energy' then 'Machine Learning' else upper(category) end", "Format": "replace(answer_mode, '_', ' ')",
    "Question": "question_text", "Answer": "case when answer_mode = 'multiple_choice' then substr(answer_text, 9, 1) else substr(answer_text, 9) end", "Subcategory": "subcategory", "Difficulty": "case when difficulty = 2 then '#DIV/0!' else cast(source_metadata.original_difficulty as varchar(20)) end",
    "Quality": "cast(source_metadata.original_quality as varchar(20))",
}


def _sheet(spark: SparkSession, d: str) -> DataFrame:
    q = _numbered(_questions(spark, d), "concat('sheet_', category)", "question_id")
    named = [x for k, e in SHEET.items() for x in (F.lit(k), F.expr(e).cast("string"))]
    labels = [x for i, a in enumerate("WXYZ") for x in (F.lit(a), F.try_element_at("choices", F.lit(i + 1))["text"])]
    return q.select("file", "ordinal", F.create_map(*named, *labels).alias("cells"))


def sheet_questions(spark: SparkSession, d: str) -> DataFrame:
    """Questions of sheets: strict and lenient readings of type, mode, category, choices, answers and numbers, ids by kept rows."""
    q = files.questions_from_tables(_sheet(spark, d), "set")
    return q.select("question_id", "category", "subcategory", "question_type", "answer_mode", "difficulty", "answer_text", "source_row", F.size("choices").alias("choices"), "original_difficulty", "original_quality")


def _place(c: str) -> Column:
    """A place in a file, by a hash of the id."""
    return F.conv(F.substring(F.md5(F.col(c)), 1, 8), 16, 10).cast("long")


def _ordered(spark: SparkSession, d: str) -> DataFrame:
    q = _questions(spark, d).withColumn("ordinal", _place("question_id"))
    return q.select("question_id", "question_text", "ordinal", (F.col("ordinal") % 50 + 1).cast("int").alias("source_row"))


def rating_rows(spark: SparkSession, d: str) -> DataFrame:
    """Ratings of tables, linked by source row to the last question that has it."""
    q = _ordered(spark, d)
    r = table(spark, d, "reviews").select("review_id", "reviewer_id", "ratings").distinct().withColumn("source_row", (_place("review_id") % 50 + 1).cast("int"))
    r = r.join(F.broadcast(q.select("source_row").distinct()), "source_row", "left_semi")  # at most 50 rows; of few questions none may have a row
    cells = F.create_map(F.lit("Source Row"), F.col("source_row").cast("string"), F.lit("Reviewer"), F.col("reviewer_id"), F.lit("Quality Rating"), F.coalesce(F.col("ratings.quality").cast("string"), F.lit("?")), F.lit("Difficulty"), F.col("ratings.difficulty").cast("string"))
    out = files.reviews_from_tables(r.select(F.lit("ratings").alias("file"), F.lit(0).alias("ordinal"), cells.alias("cells")), q)
    return out.groupBy("question_id", "reviewer_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("ratings.quality"), 6).alias("quality"), F.round(F.sum("ratings.difficulty"), 6).alias("difficulty"))


def text_ratings(spark: SparkSession, d: str) -> DataFrame:
    """Ratings of sheets, linked by text to the last question that has it."""
    out = files.sheet_ratings(_sheet(spark, d), _ordered(spark, d))
    return out.select("question_id", "reviewer_id", "ratings.quality", "ratings.difficulty", F.col("metadata")["sheet_row"].alias("sheet_row"), F.col("metadata")["raw_file"].alias("raw_file"))


def _workbooks(spark: SparkSession, d: str) -> DataFrame:
    """The sheets as cells of workbooks, with two difficulty columns and one of quality beside."""
    s = _sheet(spark, d).withColumn("file", F.concat(F.lit("2026 "), F.substring("file", 7, 99), F.lit(" Question Writing.xlsx")))
    fixed = [F.struct(F.lit(i + 1).alias("col"), F.try_element_at("cells", F.lit(n)).alias("value")) for i, n in enumerate(workbooks.COLUMNS)]
    rated = [F.struct(F.lit(c).alias("col"), F.try_element_at("cells", F.lit(n)).alias("value")) for c, n in ((16, "Difficulty"), (18, "Quality"))]
    own = F.struct(F.lit(17).alias("col"), (F.length("cells.Question") % 9).cast("string").alias("value"))
    rows = s.select("file", (F.col("ordinal") + 2).cast("int").alias("row"), F.explode(F.array(*fixed, *rated, own)).alias("c")).select("file", "row", "c.col", "c.value")
    head = s.select("file").distinct().select("file", F.lit(1).alias("row"), F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.lit(n).alias("value")) for c, n in ((16, "D1"), (17, "d2"), (18, "Q1"))])).alias("c")).select("file", "row", "c.col", "c.value")
    cells = rows.union(head).where("value is not null")
    return cells.select("file", F.concat(workbooks.column_name(F.col("col")), F.col("row").cast("string")).alias("ref"), "row", "col", "value", F.lit(None).cast("string").alias("formula"))


def workbook_questions(spark: SparkSession, d: str) -> DataFrame:
    q = workbooks.questions(_workbooks(spark, d), "wb")
    return q.select("question_id", "category", "difficulty", F.round("original_difficulty", 6).alias("original_difficulty"), F.round("original_quality", 6).alias("original_quality"), "review_status", "invalid_ratings", "answer_text")


def workbook_skips(spark: SparkSession, d: str) -> DataFrame:
    return workbooks.judged_rows(_workbooks(spark, d)).groupBy("file", F.coalesce("skip", F.lit("kept")).alias("skip")).agg(F.count(F.lit(1)).alias("n"))


def workbook_reviews(spark: SparkSession, d: str) -> DataFrame:
    c = cut(_workbooks(spark, d))
    notes = spark.createDataFrame([], schemas.COMMENT)
    r = workbooks.reviews(c, notes, workbooks.questions(c, "wb"))
    return r.select("review_id", "question_id", "reviewer_id", "ratings.quality", "ratings.difficulty", F.col("metadata")["cell_ref"].alias("cell_ref"))


def value_parses(spark: SparkSession, d: str) -> DataFrame:
    """Numbers, times, flags and column letters out of text, and what isn't one."""
    r = table(spark, d, "reviews").select("review_id", "review_timestamp", "ratings.difficulty", "ratings.quality").distinct()
    raw = F.when(F.col("quality") < 0, "n/a").when(F.col("difficulty").isNull(), "#DIV/0!").otherwise(F.concat(F.lit(" "), F.col("difficulty").cast("string"), F.lit(" ")))
    said = F.concat(F.date_format("review_timestamp", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("quality") > 0, "Z").when(F.col("quality") < 0, "+02:00").otherwise(""))
    letters = F.upper(F.substring(F.sha1("review_id"), 1, 2))
    letters = F.translate(letters, "0123456789", "GHIJKLMNOP")
    rows = r.select("review_id", "difficulty", "quality", raw.alias("raw"), said.alias("said"), letters.alias("letters"))
    return rows.select("review_id", T.to_double(F.col("raw")).alias("number"), T.to_int(F.col("raw")).alias("whole"), T.within(T.to_double(F.col("raw")), 2, 5).alias("ranged"), T.half_up(F.col("difficulty")).alias("up"), T.to_time(F.col("said")).cast("string").alias("at"), T.to_flag(F.col("quality").cast("int").cast("string")).alias("flag"), T.column_number(F.col("letters")).alias("col"))


def question_likeness(spark: SparkSession, d: str) -> DataFrame:
    """Jaccard similarity of each draft's question and the cited texts, and the cited share of the question's terms."""
    x = tables.newest(table(spark, d, "drafts").where("draft_id is not null"), ["draft_id"], "loaded_at").select("draft_id", "question.question_text", F.explode("citations.chunk_id").alias("chunk_id")).distinct()
    j = x.join(_chunks(spark, d).select("chunk_id", "text"), "chunk_id")
    a, b = F.array_distinct(T.retrieval_tokens(F.coalesce("question_text", F.lit("")))), F.array_distinct(T.retrieval_tokens(F.coalesce("text", F.lit(""))))
    return j.select("draft_id", "chunk_id", F.round(T.jaccard(a, b), 6).alias("jaccard"), F.round(T.overlap(a, b), 6).alias("overlap"))


def first_deliveries(spark: SparkSession, d: str) -> DataFrame:
    """Each chunk id once, its first delivery, the ids of both tables in one."""
    c = tables.first_by(table(spark, d, "textbook_chunks").where("chunk_id is not null").select("chunk_id", "loaded_at", F.char_length(F.coalesce("text", F.lit(""))).alias("chars")), ["chunk_id"], "loaded_at", "chars")
    q = table(spark, d, "questions").where("question_id is not null").select(F.col("question_id").alias("id"), "loaded_at")
    return c.select(F.col("chunk_id").alias("id"), "loaded_at").union(tables.first_by(q, ["id"], "loaded_at")).select("id", F.col("loaded_at").cast("string").alias("loaded_at"))


def queries() -> dict[str, Query]:
    return {k: f for k, f in globals().items() if callable(f) and getattr(f, "__module__", "") == __name__ and k[0] != "_" and k not in ("queries", "oracle_sql")}


_WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


_BREAKS = r"\r\n|[\n\r\x0b\f\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"


def _sq(c: str) -> str:
    return f"trim(regexp_replace({c}, '{_WS}+', ' ', 'g'))"


def _fold(c: str) -> str:
    out = f"lower({c})"
    for a, b in T.FOLDED.items():
        out = f"replace({out}, '{a}', '{b}')"
    return out


def _runs(c: str) -> str:
    return f"regexp_extract_all({_fold(c)}, '[a-z0-9]+')"


def _words(c: str) -> str:
    return f"list_filter(string_split_regex({c}, '{_WS}+'), lambda w: w <> '')"


def _has(c: str, phrases: list[str]) -> str:
    return "(" + " or ".join(f"contains({c}, '{p}')" for p in phrases) + ")"


def _newest(t: str, key: str) -> str:
    return f"(select * exclude (rn) from (select *, row_number() over (partition by {key} order by loaded_at desc) rn from {t} where {key} is not null) where rn = 1)"


def _listed(words: list[str]) -> str:
    return "[" + ",".join(f"'{w}'" for w in words) + "]"


def oracle_sql() -> dict[str, str]:
    q, c, dr = _newest("questions", "question_id"), _newest("textbook_chunks", "chunk_id"), _newest("drafts", "draft_id")
    clean = lambda x: _fold(_sq(f"coalesce({x}, '')"))
    exact = f"sha1({clean('question_text')} || '||' || {clean('answer_text')} || '||' || array_to_string(list_transform(choices, lambda x: {_fold('x.label')} || ':' || {clean('x.text')}), '|'))"
    stop = lambda ts, words: f"list_filter({ts}, lambda t: not list_contains({_listed(words)}, t))"
    near = (
        f"sha1(category || '|' || question_type || '|' || array_to_string(list_sort({stop(_runs("coalesce(question_text, '')"), T.NEAR_STOPWORDS)}), ' ') || '|' || "
        f"array_to_string(list_sort({_runs("regexp_replace(coalesce(answer_text, ''), '^ANSWER:', '')")}), ' '))"
    )
    labels = """select question_id, avg(ratings.difficulty) filter (ratings.difficulty between 1 and 7) dm, avg(ratings.quality) qm, count(ratings.quality) k from reviews group by 1"""
    qt, at = _sq("coalesce(question_text, '')"), _sq("coalesce(answer_text, '')")
    gate = f"""case when {qt} = '' or {at} = '' then 'missing_text' when not starts_with({at}, 'ANSWER:') then 'invalid_answer_line'
        when contains({qt}, 'ANSWER:') or contains(substr({at}, 8), 'ANSWER:') then 'contaminated_parse'
        when answer_mode = 'multiple_choice' and (len(choices) <> 4 or array_to_string(list_transform(choices, lambda x: x.label), '') <> 'WXYZ') then 'malformed_multiple_choice'
        when answer_mode <> 'multiple_choice' and len(choices) > 0 then 'malformed_short_answer' end"""
    fam = "case when starts_with(lower(source_id), 'mit_') then 'mit' when starts_with(lower(source_id), 'nsb_') then 'official_nsb' else 'other' end"
    y = lambda x: f"nullif(regexp_extract({x}, '(?:^|[^0-9])(20[0-9]{{2}})(?:[^0-9]|$)', 1), '')"
    year = f"coalesce(source_metadata.year, cast(coalesce({y('source_id')}, {y('source_metadata.tournament')}, {y('provenance.raw_file')}) as int))"
    cand = f"""
        b as (select *, {fam} family, {year} yr, {gate} form, {exact} efp, {near} nfp from {q}),
        l as ({labels}),
        m as (select b.*, dm, qm, family = 'mit' and coalesce(yr, 0) >= 2024 recent,
                     coalesce(dm, case when source_metadata.original_difficulty between 1 and 7 then source_metadata.original_difficulty end) dmean,
                     coalesce(qm, source_metadata.original_quality) qmean, case when lower({_sq('subcategory')}) not in ('', 'other', 'unknown', 'unspecified', 'none') then {_sq('subcategory')} end sub
              from b left join l using (question_id)),
        w as (select *, list_contains(style_tags, 'writing_sheet') or (family = 'mit' and source_type = 'dataset' and recent) writing,
                     cast(greatest(1, least(7, floor(dmean + 0.5))) as int) dl from m),
        cand as (select *, case when family = 'other' then 'profile' when category = 'energy' and not recent then 'legacy_energy' when form is not null then form
                     when writing and qmean is null then 'missing_quality' when writing and qmean < 0 then 'low_quality' end reason, case when dmean is null then null else dl end diff from w),
        uniq as (select *, row_number() over (partition by efp order by (qmean is not null) desc, (diff is not null) desc, recent desc, (family = 'mit') desc, (sub is not null) desc, question_id desc) rn,
                     list(question_id) over (partition by efp) ids from cand where reason is null),
        one as (select *, array_to_string(list_sort(list_filter(ids, lambda x: x <> question_id)), ',') dups,
                     cast(('0x' || substr(sha256('42:' || nfp), 1, 16))::ubigint as double) / 18446744073709551616.0 share from uniq where rn = 1),
        sp as (select *, case when share < 0.05 then 'test' when share < 0.05 + 0.05 then 'val' else 'train' end split from one)"""
    reasons = "(values " + ",".join(f"('{r}')" for r in curate.REASONS) + ") t(reason)"
    specs = "(values " + ",".join(f"('{s[0]}','{s[1]}','{s[2]}','{s[3]}',{'null' if s[4] is None else chr(39) + s[4] + chr(39)},{s[5]},{_listed(s[6]) if s[6] else '[]::varchar[]'})" for s in REQUESTS) + ") s(spec_id, category, subcategory, question_type, answer_mode, difficulty, topics)"
    rt = lambda x: f"list_filter({stop(_runs(x), T.RETRIEVAL_STOPWORDS)}, lambda t: len(t) > 1)"
    names = retrieve.known_names()
    canon = lambda x: f"coalesce(map_extract(map {{{', '.join(f"'{k}': '{v}'" for k, v in names.items())}}}, lower(trim({x})))[1], trim({x}))"
    phrases = retrieve.phrases()
    hints = f"coalesce(map_extract(map {{{', '.join(f"'{k}': {_listed(v)}" for k, v in phrases.items())}}}, {canon('subcategory')})[1], []::varchar[])"
    terms = f"""
        s as (select * from {specs}),
        qt as (select spec_id, term, max(weight) weight from (
            select spec_id, unnest({rt('subcategory')}) term, 1.0 weight from s union all select spec_id, unnest({rt("array_to_string(topics, ' ')")}), 3.0 from s
            union all select spec_id, unnest({rt(f"subcategory || ' ' || {canon('subcategory')} || ' ' || array_to_string({hints}, ' ')")}), 0.25 from s) group by 1, 2)"""
    bm = f"""
        {terms},
        ch as (select chunk_id, greatest(1, len({rt("coalesce(text, '')")})) n, {rt("coalesce(text, '')")} body,
                      {rt("array_to_string(coalesce(topics, []), ' ') || ' ' || coalesce(chapter, '') || ' ' || coalesce(section, '')")} head from {c}),
        p as (select chunk_id, n, term, sum(k) tf from (select chunk_id, n, unnest(body) term, 1 k from ch union all select chunk_id, n, unnest(head), 2 from ch) group by 1, 2, 3),
        st as (select count(*) nn, avg(n) av from ch),
        df as (select term, count(*) df from p group by 1),
        h as (select spec_id, chunk_id, weight, weight * ln(1 + (nn - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / av)) part from qt join p using (term) join df using (term), st),
        tq as (select spec_id, count(*) filter (weight >= 3) asked from qt group by 1),
        sc as (select spec_id, chunk_id, sum(part) score from h join tq using (spec_id) group by spec_id, chunk_id, asked having count(*) filter (weight >= 1) >= 1 and
               count(*) filter (weight >= 3) >= case when asked = 0 then 0 when asked <= 2 then 1 else least(3, ceil(asked / 3)) end)"""
    style = f"""gs as (select spec_id, question_id id, list_distinct({rt("coalesce(question_text, '')")}) tok, case when family = 'mit' then case when yr >= 2024 then 1.2 else 0.5 end when family = 'official_nsb' then 0.25 else 0.0 end
                + coalesce(0.4 * greatest(-1.0, least(1.0, source_metadata.original_quality)), 0) - coalesce(0.25 * abs(source_metadata.original_difficulty - sd), 0)
                + case when sm = answer_mode then 0.15 else 0 end + case when {canon('subcategory')} = sc then 0.2 else 0 end + least(0.15, 0.03 * len(style_tags)) - 0.8 * len(list_intersect(asked, {rt("coalesce(question_text, '')")})) / len(asked) score
            from (select s.spec_id, s.difficulty sd, s.answer_mode sm, {canon('s.subcategory')} sc, a.asked, q.*, {fam.replace('source_id', 'q.source_id')} family, coalesce(q.source_metadata.year, cast(coalesce({y('q.source_id')}, {y('q.source_metadata.tournament')}) as int)) yr
                  from s left join a using (spec_id) join {q} q on q.category = s.category and q.question_type = s.question_type))"""
    bm += f""", fs as (select spec_id, sc.chunk_id id, list_distinct({rt("coalesce(text, '')")}) tok, score from sc join {c} c on c.chunk_id = sc.chunk_id where score >= {retrieve.FLOOR})"""

    def picks(name: str, source: str, key: str) -> str:
        like = lambda o: f"coalesce(len(list_intersect(tok, {o}.tok)) / nullif(len(tok) + len({o}.tok) - len(list_intersect(tok, {o}.tok)), 0), 0)"
        best = lambda v, src: f"(select * from (select *, row_number() over (partition by spec_id order by {v} desc, score desc, id) rn from {src}) where rn = 1)"
        one, two, three = (f"{name}{i}" for i in (1, 2, 3))
        first = f"{one} as {best('score', source)}, {name}b as (select {source}.*, {like(one).replace('(tok', f'({source}.tok')} l1 from {source} join {one} using (spec_id) where {source}.id <> {one}.id)"
        second = f"{two} as {best('score - 0.25 * l1', f'{name}b')}, {name}c as (select {name}b.*, greatest({name}b.l1, {like(two).replace('(tok', f'({name}b.tok')}) l2 from {name}b join {two} using (spec_id) where {name}b.id <> {two}.id)"
        return f"{first}, {second}, {three} as {best('score - 0.25 * l2', f'{name}c')}, {name} as (select spec_id, id, 1 place, score from {one} union all select spec_id, id, 2, score from {two} union all select spec_id, id, 3, score from {three})"

    place = lambda x: f"('0x' || substr(md5({x}), 1, 8))::bigint"
    sheet = f"""with sh as (select *, 'sheet_' || category file, row_number() over (partition by category order by question_id) - 1 ordinal, {SHEET['Type']} type, {SHEET['Format']} format, {_sq(f"coalesce({SHEET['Question']}, '')")} q,
        {_sq(f"coalesce({SHEET['Answer']}, '')")} a, {SHEET['Category']} cat, case when difficulty = 2 then null else source_metadata.original_difficulty end d, source_metadata.original_quality ql from {q})"""
    book = f"""{sheet}, bs as (select *, case when type = 'Visual Bonus' then 'visual_bonus' when q = '' or a = '' then 'missing_required' end skip from (select * exclude (file, ql), '2026 ' || category || ' Question Writing.xlsx' file, ordinal + 2 as row, format = 'multiple choice' mc, ql q0,
            case when format = 'multiple choice' then list_filter(choices, lambda x: {_sq('x.text')} <> '') else [] end ch, d d1, cast(length(question_text) % 9 as double) d2, ql q1, difficulty = 2 as unread from sh)),
        bq as (select 'wb_' || regexp_replace(category, '[^a-z]+', '_') || '_' || lpad(row::varchar, 4, '0') question_id, category, row, mc, ch, a, d1, d2, q1, coalesce(list_avg(list_filter([d1, d2], lambda x: x between 1 and 7)), case when d1 between 1 and 7 then d1 end) d,
            case when q1 between -1 and 1 then q1 end ql, (unread or coalesce(not d1 between 1 and 7, false))::int + coalesce(not d2 between 1 and 7, false)::int + coalesce(not q1 between -1 and 1, false)::int invalid from bs where skip is null)"""
    low, core = "lower(trim(coalesce(question.question_text, '')))", "trim(replace(coalesce(question.answer_text, ''), 'ANSWER:', ''))"
    mc = "question.answer_mode = 'multiple_choice'"
    direct = "(" + " or ".join(f"starts_with({low}, '{s}')" for s in verify.DIRECT) + f") and not {_has(low, verify.CONCEPTUAL)}"
    short = f"len({_words('trim(question.question_text)')}) <= 18"
    rule = lambda *rs: "array_to_string(list_filter([" + ", ".join(f"case when {cond} then '{code}' end" for cond, code in rs) + "], lambda x: x is not null), ',')"
    fmt = rule(
        ("not starts_with(coalesce(question.answer_text, ''), 'ANSWER:')", "missing_answer_prefix"), (f"{low} = ''", "empty_question"),
        (f"{mc} and (len(question.choices) <> 4 or array_to_string(list_transform(question.choices, lambda x: upper(trim(x.label))), '') <> 'WXYZ')", "multiple_choice_format"),
        (f"{mc} and len(list_filter(question.choices, lambda x: trim(x.text) = '')) > 0", "blank_choice"), (f"{mc} and {_has(low, ['w)', 'x)', 'y)', 'z)'])}", "choices_embedded_in_question"),
        (f"{mc} and not contains({low}, 'which of the following')", "missing_which_of_the_following"), (f"not {mc} and len(question.choices) > 0", "short_answer_has_choices"),
        (f"not (ends_with({low}, '?') or starts_with({low}, 'identify all') or starts_with({low}, 'rank the following'))", "non_interrogative_format"),
    )
    n_core = f"len({_words(core)})"
    ans = rule(
        (f"len({core}) < 2", "empty_answer"), (f"not ({mc}) and (regexp_matches({core}, '[.?!;]') or {n_core} > 12 or ({n_core} > 8 and regexp_matches(lower({core}), '^(because|it|they|this|that|these|those|the)\\b')))", "sentence_answer_for_short_answer"),
        (_has(low, verify.ABOUT_BOOK), "source_material_meta"),
    )
    sty = rule(
        (f"{direct} and {short}", "reaction_speed_test"), (f"{direct} and not ({short})", "overly_direct_recall"), (f"{core} <> '' and contains({low}, lower({core}))", "answer_in_stem"),
        (f"len(list_filter(string_split_regex(trim(coalesce(question.question_text, '')), '[.!?]+'), lambda x: trim(x) <> '')) >= 3", "unnecessary_flavor_text"),
    )
    facts = f"""
        d as (select draft_id, unnest(case when len(citations) = 0 then [null] else list_transform(citations, lambda x: x.chunk_id) end) chunk_id from {dr}),
        dd as (select distinct draft_id, chunk_id from d), cf as (select chunk_id, bool_or({_has("lower(coalesce(text, ''))", verify.FRONT_MATTER)}) front from textbook_chunks group by 1),
        f as (select draft_id, count(dd.chunk_id) n, count(front) known, bool_or(coalesce(front, false)) front, coalesce(array_to_string(list_sort(list(dd.chunk_id) filter (front)), ','), '') suspects from dd left join cf using (chunk_id) group by 1)"""
    asked = f"list_distinct({_runs(f"question.subcategory || ' ' || {canon('question.subcategory')} || ' ' || array_to_string(coalesce(map_extract(map {{{', '.join(f"'{k}': {_listed(v)}" for k, v in phrases.items())}}}, {canon('question.subcategory')})[1], []::varchar[]), ' ')")})"
    topic = f"coalesce(len(list_intersect({asked}, {_runs("coalesce(question.question_text, '')")})) / nullif(len({asked}), 0), 0)"
    matched = "exists (select 1 from questions k where k.category = d.question.category and k.question_type = d.question.question_type)"
    page = f"(select document_id, row_number() over (partition by document_id order by chunk_id) page_no, text from {c})"
    return {
        "fingerprints": f"select question_id, {exact} exact_fingerprint, {near} near_fingerprint from {q}",
        "label_means": f"select question_id, round(dm, 6) difficulty_mean, round(qm, 6) quality_mean, k ratings from ({labels})",
        "gate_reasons": f"select question_id, {gate} reason from {q}",
        "exclusion_counts": f"with {cand} select t.reason, count(question_id) n from {reasons} left join cand using (reason) group by 1",
        "exact_dedupe": f"with {cand} select question_id, efp exact_fingerprint, diff difficulty, dups duplicates from one",
        "hash_split": f"with {cand} select question_id, nfp near_fingerprint, split from sp",
        "held_out_split": f"""with {cand}, held as (select metadata.source_question_id id from sft_examples where regexp_replace(lower(metadata.split), '[^a-z]+', '', 'g') in ('heldout', 'holdout')),
            hg as (select distinct nfp from (select nfp, unnest(ids) id from one) join held using (id))
            select question_id, case when nfp in (select nfp from hg) then 'held_out' else split end split from sp""",
        "curation_counts": f"""with {cand}, r as (select split, category, family, source_id dataset, coalesce(cast(yr as varchar), 'unknown') "year", diff, sub, qmean from sp)
            select case when grouping(split) = 0 then 'split' when grouping(category) = 0 then 'category' when grouping(family) = 0 then 'family' when grouping(dataset) = 0 then 'dataset' else 'year' end dimension,
            coalesce(split, category, family, dataset, "year") "value", count(*) n, count(diff) with_difficulty, count(sub) with_subcategory, count(qmean) with_quality
            from r group by grouping sets ((split), (category), (family), (dataset), ("year"))""",
        "split_overlaps": "select metadata.duplicate_group duplicate_group, count(distinct lower(trim(metadata.split))) parts from sft_examples where metadata.duplicate_group is not null and metadata.split is not null group by 1 having parts > 1",
        "repeated_ids": "select chunk_id, count(*) copies from textbook_chunks group by 1 having copies > 1",
        "version_conflicts": "select document_id, count(distinct coalesce(metadata.corpus_version, 'legacy')) \"values\" from textbook_chunks group by 1 having \"values\" > 1",
        "id_sets": """with a as (select distinct question_id k from questions), b as (select distinct metadata.source_question_id k from sft_examples)
            select (select count(*) from a semi join b using (k)) in_both, (select count(*) from a anti join b using (k)) first_only, (select count(*) from b anti join a using (k)) second_only""",
        "reviewed_questions": "select distinct question_id from questions where question_id in (select question_id from reviews)",
        "unreviewed_questions": "select distinct question_id from questions where question_id not in (select question_id from reviews)",
        "review_progress": "with q as (select distinct question_id from questions), r as (select distinct question_id, 1 k from reviews) select count(*) total, count(k) reviewed, count(*) - count(k) remaining from q left join r using (question_id)",
        "review_latest": """select key, review_id, quality, difficulty from (select question_id || '|' || lower(trim(reviewer_id)) key, review_id, ratings.quality quality, ratings.difficulty difficulty,
            row_number() over (partition by question_id || '|' || lower(trim(reviewer_id)) order by review_timestamp desc, loaded_at desc, review_id desc, ratings.quality desc nulls last, ratings.difficulty desc nulls last) rn from reviews)
            where rn = 1 and not (quality is null and difficulty is null)""",
        "event_latest": "select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) rn from events) where rn = 1 and event_type <> 'logout'",
        "ratings_unpivot": """with r as (select distinct review_id, ratings.quality quality, ratings.difficulty difficulty from reviews)
            select review_id, 'quality' kind, quality \"value\" from r where quality between -1 and 1 union all select review_id, 'difficulty', difficulty from r where difficulty between 1 and 7""",
        "line_values": """select l_returnflag, l_linestatus, kind, count(*) n, round(sum("value"), 2) total from (
            select l_returnflag, l_linestatus, 'l_quantity' kind, l_quantity "value" from lineitem where l_quantity between 10 and 40 union all select l_returnflag, l_linestatus, 'l_discount', l_discount from lineitem where l_discount between 0.02 and 0.08
            union all select l_returnflag, l_linestatus, 'l_tax', l_tax from lineitem where l_tax between 0 and 0.05) group by all""",
        "customer_orders": """select c_custkey, n_name, count(o_orderkey) orders, round(coalesce(sum(o_totalprice), 0.0), 2) spent from customer join nation on c_nationkey = n_nationkey left join orders on o_custkey = c_custkey group by 1, 2""",
        "part_slugs": """select p_partkey, regexp_replace(regexp_replace(lower(trim(p_name)), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') slug,
            regexp_replace(regexp_replace(lower(p_brand || ' / ' || p_type), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') kind, cast(greatest(1, least(7, floor(p_size / 7.0 + 0.5))) as int) grade, cast(round_even(p_size / 2.0, 0) as int) half from part""",
        "source_years": f"select question_id, {fam} family, {year} \"year\" from {q}",
        "answer_parts": f"""select question_id, list_filter(choices, lambda x: x.label = substr(answer_text, 9, 1))[1].text choice_text,
            array_to_string(list_filter(list_transform(string_split({_sq("array_to_string(answer_guidance.accept, ';')")}, ';'), lambda x: trim(x)), lambda x: x <> ''), '|') accept from {q}""",
        "chunk_counts": f"""select chunk_id, length(text) chars, greatest(1, len({_words('text')})) words, concat_ws('; ', title, nullif(chapter, ''), case when section is distinct from chapter then nullif(section, '') end,
            case when len(pages) > 0 then case when list_min(pages) = list_max(pages) then 'p. ' || list_min(pages) else 'pp. ' || list_min(pages) || '-' || list_max(pages) end end) locator from {c}""",
        "word_chunks": f"""with w as (select document_id, page_no, unnest({_words("coalesce(text, '')")}) word, generate_subscripts({_words("coalesce(text, '')")}, 1) i from {page}),
            k as (select *, row_number() over (partition by document_id order by page_no, i) - 1 k, count(*) over (partition by document_id) al from w),
            x as (select *, unnest(generate_series(cast(greatest(0, ceil((k - 179) / 150.0)) as bigint), cast(least(greatest(0, ceil((al - 180) / 150.0)), floor(k / 150.0)) as bigint))) chunk_index from k)
            select document_id, chunk_index, cast(min(page_no) as int) first_page, cast(max(page_no) as int) last_page, sha1(string_agg(word, ' ' order by k)) text_sha1 from x group by 1, 2""",
        "bm25_scores": f"with {bm} select spec_id, chunk_id, round(score, 6) score from sc",
        "style_scores": f"""with {terms}, a as (select spec_id, list(term) asked from qt group by 1),
            j as (select s.spec_id, s.difficulty sd, s.answer_mode sm, {canon('s.subcategory')} sc, a.asked, q.*, {fam.replace('source_id', 'q.source_id')} family, coalesce(q.source_metadata.year, cast(coalesce({y('q.source_id')}, {y('q.source_metadata.tournament')}) as int)) yr
                  from s left join a using (spec_id) join {q} q on q.category = s.category and q.question_type = s.question_type)
            select spec_id, question_id, round(case when family = 'mit' then case when yr >= 2024 then 1.2 else 0.5 end when family = 'official_nsb' then 0.25 else 0.0 end
                + coalesce(0.4 * greatest(-1.0, least(1.0, source_metadata.original_quality)), 0) - coalesce(0.25 * abs(source_metadata.original_difficulty - sd), 0)
                + case when sm = answer_mode then 0.15 else 0 end + case when {canon('subcategory')} = sc then 0.2 else 0 end + least(0.15, 0.03 * len(style_tags))
                - 0.8 * len(list_intersect(asked, {rt("coalesce(question_text, '')")})) / len(asked), 6) + 0.0 score from j""",
        "draft_issues": f"select draft_id, {fmt} format_issues, {ans} answer_issues, {sty} style_issues from {dr}",
        "draft_verdicts": f"""with {facts}, i as (select draft_id, {fmt} || {ans} || {sty} other, case when {topic} = 0 then 'topic_mismatch' else '' end topic_issues from {dr}),
            x as (select draft_id, suspects suspect_chunks, {rule(("n = 0", "missing_citation"), ("n > 0 and known = 0", "missing_fact_chunk"), ("front", "suspicious_source_chunk"))} fact_issues from f)
            select draft_id, fact_issues, topic_issues, suspect_chunks, case when fact_issues <> '' then 'fail' when other <> '' or topic_issues <> '' then 'revise' else 'pass' end verdict from x join i using (draft_id)""",
        "draft_scores": f"""with {facts}, x as (select draft_id, case when n = 0 or known = 0 or front then 0.0 else 1.0 end facts from f),
            i as (select draft_id, case when {fmt} = '' then 1.0 else 0.0 end format, round(least(1.0, 2 * {topic}), 3) topic,
                  round(greatest(0.0, 1.0 - case when {matched} then 0.0 else 0.1 end - 0.35 * len(list_filter(string_split({sty}, ','), lambda x: x <> ''))), 3) style from {dr} d)
            select draft_id, cast(format as double) format, cast(facts as double) facts, topic, style, round((format + facts + topic + style) / 4, 3) overall from x join i using (draft_id)""",
        "subcategories": f"""select {canon('subcategory')} subcategory, count(*) n, max(case when trim(subcategory) = '' then 0 else len(list_distinct([trim(subcategory), {canon('subcategory')}] || {hints})) end) phrases from {q} where subcategory is not null group by 1""",
        "chat_examples": f"""with {cand} select 'clean_sft_' || regexp_replace(regexp_replace(lower({_sq('question_id')}), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') example_id,
            concat_ws(chr(10), 'Category: ' || category, 'Type: ' || question_type, 'Subcategory: ' || sub, 'Difficulty: ' || diff, case when len(content_tags) > 0 then 'Topic focus: ' || array_to_string(content_tags, ', ') end, 'Write one new question. Return only JSON.') request, split from sp""",
        "example_violations": f"""with e as (select * exclude (rn) from (select *, row_number() over (partition by example_id order by loaded_at desc) rn from sft_examples where example_id is not null) where rn = 1),
            l as (select example_id, messages, messages[-1].content c from e), k as (select *, case when json_valid(c) and json_type(try_cast(c as json)) = 'OBJECT' then try_cast(c as json) end j from l)
            select example_id, len(messages) messages, case when coalesce(array_to_string(list_transform(messages, lambda m: m.role), ','), '') <> 'system,user,assistant' then 'roles'
                when len(list_filter(messages, lambda m: {_sq("coalesce(m.content, '')")} = '')) > 0 then 'empty_message' when j is null then 'invalid_json'
                when array_to_string(list_sort(json_keys(j)), ',') <> 'answer_text,choices,question_text' then 'shape' when {_sq("coalesce(json_extract_string(j, '$.question_text'), '')")} = '' then 'empty_question'
                when not starts_with(coalesce(json_extract_string(j, '$.answer_text'), ''), 'ANSWER:') then 'answer_prefix' when json_type(j, '$.choices') <> 'ARRAY' then 'choices' end violation from k""",
        "page_lines": f"""with x as (select document_id, page_no, unnest(string_split_regex(text, '{_BREAKS}')) raw, generate_subscripts(string_split_regex(text, '{_BREAKS}'), 1) pos from {page}),
            y as (select *, {_sq('raw')} line, {_fold(_sq('raw'))} low, {_sq('raw')} <> '' filled from x),
            k as (select *, sum(filled::int) over w k, filled and regexp_matches(low, '{pages.PROMPT}') prompt from y window w as (partition by document_id, page_no order by pos)),
            m as (select *, max(case when prompt then k end) over (partition by document_id, page_no order by pos) marker from k),
            s as (select *, coalesce(prompt or (filled and k - marker <= 2), false) skipped from m),
            f as (select *, filled and not skipped and (regexp_matches(low, '\\b(am|pm)\\b') and regexp_matches(low, '\\d+/\\d+/\\d+') or {' or '.join(f"regexp_matches(low, '{p}')" for p in pages.FURNITURE)}) furniture from s),
            t as (select *, bool_or(filled and not skipped and not furniture and regexp_matches(low, '{pages.REVIEW_SECTION}')) over (partition by document_id, page_no order by pos) stop from f)
            select document_id, page_no, count(*) lines, sum(length(line)) chars from t where filled and not skipped and not furniture and not stop and not regexp_matches(low, '{pages.EXERCISE}') group by 1, 2""",
        "diverse_facts": f"with {bm}, {picks('f', 'fs', 'chunk_id')} select spec_id, id chunk_id, place, round(score, 6) score from f",
        "retrieval_bundles": f"""with {bm}, {picks('f', 'fs', 'chunk_id')}, a as (select spec_id, list(term) asked from qt group by 1), {style}, {picks('g', 'gs', 'question_id')}
            select spec_id, 'fact' kind, id, place, round(score, 6) + 0.0 score from f union all select spec_id, 'style', id, place, round(score, 6) + 0.0 from g""",
        "sheet_questions": f"""{sheet}, k as (select *, row_number() over (order by file, ordinal) n from sh where type <> 'Visual Bonus' and q <> '' and a <> '' and cat <> ''), c as (select *, format = 'multiple choice' mc, case when format = 'multiple choice' then list_filter(choices, lambda x: {_sq('x.text')} <> '') else [] end ch from k)
            select 'set_' || lpad(n::varchar, 4, '0') question_id, category, case when {_sq("coalesce(subcategory, '')")} = '' then 'other' else {_sq("coalesce(subcategory, '')")} end subcategory, question_type, case when mc then 'multiple_choice' else 'short_answer' end answer_mode,
            cast(case when d between 1 and 7 then round_even(d, 0) else 3 end as int) difficulty, case when mc and len(list_filter(ch, lambda x: x.label = a)) > 0 then 'ANSWER: ' || a || ') ' || {_sq('list_filter(ch, lambda x: x.label = a)[1].text')} else 'ANSWER: ' || a end answer_text,
            cast(ordinal + 1 as int) source_row, len(ch) choices, d original_difficulty, ql original_quality from c""",
        "rating_rows": f"""with o as (select question_id, {place('question_id')} k from {q}), l as (select k % 50 + 1 source_row, arg_max(question_id, k) question_id from o group by 1),
            r as (select *, {place('review_id')} k from (select distinct review_id, reviewer_id, ratings from reviews))
            select question_id, coalesce(nullif(regexp_replace(regexp_replace(lower({_sq('reviewer_id')}), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), reviewer_id) reviewer_id, count(*) n, round(sum(ratings.quality), 6) quality, round(sum(ratings.difficulty), 6) difficulty
            from r join l on l.source_row = r.k % 50 + 1 group by 1, 2""",
        "text_ratings": f"""{sheet}, o as (select question_id, question_text, {place('question_id')} k from {q}), l as (select lower({_sq('question_text')}) t, arg_max(question_id, k) question_id from o where {_sq('question_text')} <> '' group by 1)
            select l.question_id, 'aggregate_sheet_ratings' reviewer_id, case when ql between -1 and 1 then ql end quality, case when d between 1 and 7 then d end difficulty, cast(ordinal + 1 as varchar) sheet_row, file raw_file
            from sh join l on l.t = lower(q) where type <> 'Visual Bonus' and (ql between -1 and 1 or d between 1 and 7)""",
        "workbook_questions": f"""{book} select question_id, category, cast(case when d is null then 3 else greatest(1, least(7, floor(d + 0.5))) end as int) difficulty, round(d, 6) original_difficulty, round(ql, 6) original_quality, case when ql is null then 'unrated' when ql >= 0 then 'rated_usable' else 'rated_rejected' end review_status,
            invalid invalid_ratings, case when mc and len(list_filter(ch, lambda x: x.label = upper(a))) > 0 then 'ANSWER: ' || upper(a) || ') ' || {_sq('list_filter(ch, lambda x: x.label = upper(a))[1].text')} else 'ANSWER: ' || a end answer_text from bq""",
        "workbook_skips": f"{book} select file, coalesce(skip, 'kept') skip, count(*) n from bs group by 1, 2",
        "workbook_reviews": f"""{book}, v as (select question_id, category, row, 'difficulty' kind, 'P' slot, d1 x from bq where d1 between 1 and 7 union all select question_id, category, row, 'difficulty', 'Q', d2 from bq where d2 between 1 and 7 union all select question_id, category, row, 'quality', 'R', q1 from bq where q1 between -1 and 1)
            select question_id || '_' || kind || '_' || lower(slot) review_id, question_id, regexp_replace(category, '[^a-z]+', '_') || '_' || kind || '_' || lower(slot) reviewer_id, case when kind = 'quality' then x end quality, case when kind = 'difficulty' then x end difficulty, slot || row cell_ref from v""",
        "value_parses": """with r as (select distinct review_id, review_timestamp t, ratings.difficulty d, ratings.quality q from reviews),
            x as (select *, case when q < 0 or d is null then null else d end v, translate(upper(substr(sha1(review_id), 1, 2)), '0123456789', 'GHIJKLMNOP') l from r)
            select review_id, v "number", cast(trunc(v) as int) whole, case when v between 2 and 5 then v end ranged, case when d is not null then cast(greatest(1, least(7, floor(d + 0.5))) as int) end up,
            strftime(date_trunc('second', t) - case when q < 0 then interval 2 hour else interval 0 hour end, '%Y-%m-%d %H:%M:%S') "at", case when q is not null then trunc(q) = 1 end flag, (ascii(l) - 64) * 26 + ascii(l[2]) - 64 col from x""",
        "question_likeness": f"""with x as (select distinct draft_id, question.question_text qt, unnest(list_transform(citations, lambda z: z.chunk_id)) chunk_id from {dr}), y as (select draft_id, x.chunk_id, list_distinct({rt("coalesce(qt, '')")}) a, list_distinct({rt("coalesce(text, '')")}) b from x join {c} c on c.chunk_id = x.chunk_id)
            select draft_id, chunk_id, round(coalesce(len(list_intersect(a, b)) / nullif(len(a) + len(b) - len(list_intersect(a, b)), 0), 0.0), 6) jaccard, round(coalesce(len(list_intersect(a, b)) / nullif(len(a), 0), 0.0), 6) overlap from y""",
        "first_deliveries": """select chunk_id id, strftime(min(loaded_at), '%Y-%m-%d %H:%M:%S') || coalesce(nullif('.' || rtrim(strftime(min(loaded_at), '%f'), '0'), '.'), '') loaded_at from textbook_chunks where chunk_id is not null group by 1
            union all select question_id, strftime(min(loaded_at), '%Y-%m-%d %H:%M:%S') || coalesce(nullif('.' || rtrim(strftime(min(loaded_at), '%f'), '0'), '.'), '') from questions where question_id is not null group by 1""",
        "draft_citations": f"""select distinct draft_id, x.chunk_id, document_id from (select draft_id, unnest(list_transform(citations, lambda z: z.chunk_id)) chunk_id from {dr}) x join {c} c on c.chunk_id = x.chunk_id""",
    }
