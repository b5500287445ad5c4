"""Reading and writing of files: JSON lines, CSV tables, id lists, pages, with integrity checks."""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork import storage
from siltwork.functions import text as T
from siltwork.operators.tables import require_unique
from siltwork.sources import schemas

#: Names of categories in hand-made tables, and difficulties of divisions.
CATEGORIES = {
    "biology": "biology", "chemistry": "chemistry", "physics": "physics", "astronomy": "earth_space", "earth": "earth_space", "earth_science": "earth_space", "earth_and_space": "earth_space", "earth_space": "earth_space", "ess": "earth_space",
    "earth_and_space_science": "earth_space", "space": "earth_space", "math": "math", "energy": "energy", "machine_learning": "energy", "statistics": "energy", "theoretical_cs": "energy",
}
DIVISIONS = {"rr": 2, "round_robin": 2, "de": 4, "double_elimination": 4, "wildcard": 5, "playoff": 5}
#: Names of columns in rating tables, in the order in which they are tried.
ID_COLUMNS = ["question_id", "Question ID", "questionId"]
ROW_COLUMNS = ["source_row", "Source Row", "row_number", "Row Number", "row"]
REVIEWER_COLUMNS = ["reviewer_id", "Reviewer", "reviewer", "writer", "Writer"]
QUALITY_COLUMNS = ["quality", "Quality", "quality_rating", "Quality Rating"]
DIFFICULTY_COLUMNS = ["difficulty", "Difficulty", "difficulty_rating", "Difficulty Rating"]


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines; blank lines are skipped, the first malformed one ends the query."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_splits(df: DataFrame, folder: str, splits: list[str], column: str = "split") -> None:
    """A folder of JSON lines per split; a split without rows gets an empty folder all the same."""
    df.write.mode("overwrite").partitionBy(column).option("ignoreNullFields", "false").json(folder)
    for x in splits:
        storage.folder(df.sparkSession, f"{folder}/{column}={x}")


def replace_folder(df: DataFrame, folder: str) -> None:
    """Write beside, then put in place by renames, the old rows aside until the new ones stand; any store will do."""
    spark, staged, old = df.sparkSession, f"{folder}.staged", f"{folder}.old"
    write_jsonl(df, staged)
    storage.remove(spark, old)
    if storage.exists(spark, folder):
        storage.move(spark, folder, old)
    storage.move(spark, staged, folder)
    storage.remove(spark, old)


def append_jsonl(df: DataFrame, folder: str, run: str) -> None:
    """Add rows as a part of their own; a run that is done again replaces its part, so no row is doubled."""
    write_jsonl(df, f"{folder}/run={run}")


def read_object(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row of a file that holds one JSON object over several lines; a malformed one ends the query."""
    return spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def write_manifest(row: DataFrame, path: str) -> None:
    """One aggregated row as an indented JSON object."""
    storage.write_text(row.sparkSession, path, json.dumps(json.loads(row.toJSON().first()), indent=2, ensure_ascii=False))


def valid_questions(df: DataFrame) -> DataFrame:
    """The questions; one without an id, text or answer, with a difficulty out of 1..7 or an unknown category, type or mode ends the query."""
    name = lambda c, known: F.when(~F.coalesce(F.col(c).isin(*known), F.lit(False)), F.lit(c))
    bad = F.concat_ws(
        ", ", F.when(F.col("question_id").isNull(), "question_id"), F.when(F.col("question_text").isNull(), "question_text"), F.when(F.col("answer_text").isNull(), "answer_text"),
        F.when(~F.coalesce(F.col("difficulty").between(1, 7), F.lit(False)), "difficulty"), name("category", sorted(set(CATEGORIES.values()))), name("question_type", ["tossup", "bonus"]), name("answer_mode", ["short_answer", "multiple_choice"]),
    )
    said = F.concat(F.lit("invalid question "), F.coalesce("question_id", F.lit("null")), F.lit(": "), bad)
    return df.where(F.when(bad == "", True).otherwise(F.raise_error(said).cast("boolean")))


def rewrite_questions(spark: SparkSession, source: str, folder: str) -> int:
    """Read, validate and write questions in the present form; the number written."""
    df = valid_questions(read_jsonl(spark, source, schemas.QUESTION))
    replace_folder(df, folder)
    return spark.read.schema("question_id string").json(folder).count()


def new_id(prefix: str) -> Column:
    """The prefix and twelve random hexadecimal digits; anew in each run, so cut the table before using it twice."""
    return F.concat(F.lit(prefix + "_"), F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 1, 12))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct question ids of a text file of lines, a JSON array, or an object with question_ids."""
    whole = spark.read.text(path, wholetext=True).select(F.trim("value").alias("v"))
    many = F.from_json("v", "array<string>")
    inside = F.from_json(F.get_json_object("v", "$.question_ids"), "array<string>")
    ids = F.when(F.col("v").startswith("["), many).when(F.col("v").startswith("{"), inside).otherwise(F.split("v", r"\R"))
    return whole.select(F.explode(ids).alias("question_id")).select(F.trim("question_id").alias("question_id")).where("question_id <> ''").distinct()


def hashed_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"), "content", "modificationTime")


def require_hash(files: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Files whose name has an expected hash must have it, in any case; the query ends with an error otherwise."""
    table = F.create_map(*[x for k, v in expected.items() for x in (F.lit(k), F.lit(v.lower()))])
    want = F.try_element_at(table, F.element_at(F.split("path", "/"), -1))
    return files.where(F.when(want.isNull() | (want == F.col("sha256")), True).otherwise(F.raise_error(F.concat(F.lit("wrong hash: "), "path")).cast("boolean")))


def read_pages(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """(document_id, page_no, text) of text files, whose pages end with form feeds. Only the pages asked for leave the scan."""
    t = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1).alias("document_id"), F.posexplode(F.split("value", "\f")).alias("i", "text"))
    t = t.select("document_id", (F.col("i") + 1).alias("page_no"), "text")
    return t.where(F.col("page_no").between(first or 1, last or (1 << 30)))


def clean_header(names: list[str]) -> list[str]:
    """Trimmed names; blank ones numbered, repeated ones counted."""
    seen: dict[str, int] = {}
    out = []
    for i, n in enumerate(x.strip() for x in names):
        name = n or f"unnamed_{i}"
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return out


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """(file, ordinal, cells map) of CSV files, all text: a mark of byte order and ragged rows are taken, order is the file's.

    A file is one row of the scan, as quoted cells may hold line ends; many files are read in parallel.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["path"], b["content"], strict=True):
                rows = csv.reader(io.StringIO(bytes(content).decode("utf-8-sig")))
                head = clean_header(next(rows, []))
                data = [(name, i, dict(zip(head, r, strict=False))) for i, r in enumerate(rows) if r]
                yield pd.DataFrame(data, columns=["file", "ordinal", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "file string, ordinal int, cells map<string,string>")


def pick(*names: str) -> Column:
    """The cell of the first of these columns that the table has."""
    return F.coalesce(*[F.try_element_at("cells", F.lit(n)) for n in names])


def category(c: Column) -> Column:
    table = F.create_map(*[x for k, v in CATEGORIES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(table, T.slug(c)), F.raise_error(F.concat(F.lit("unknown category: "), F.coalesce(c, F.lit("null")))))


def answer_line(answer: Column, choices: Column, any_case: bool = True) -> Column:
    """ANSWER: with the choice that a single letter names, else with the answer as it is. Workbooks name it in any case, CSV tables as it stands."""
    named = F.upper(answer) if any_case else answer
    hit = F.try_element_at(F.filter(choices, lambda c: c["label"] == named), F.lit(1))
    return F.coalesce(F.concat(F.lit("ANSWER: "), hit["label"], F.lit(") "), hit["text"]), F.concat(F.lit("ANSWER: "), answer))


#: Strict spellings of types and modes, as slugs.
STRICT_TYPES = {"tossup": "tossup", "toss_up": "tossup", "bonus": "bonus"}
STRICT_MODES = {"multiple_choice": "multiple_choice", "multiplechoice": "multiple_choice", "short_answer": "short_answer", "shortanswer": "short_answer"}


def strict(c: Column, known: dict[str, str]) -> Column:
    """The value that a spelling stands for, or null for any other."""
    return F.try_element_at(F.create_map(*[x for k, v in known.items() for x in (F.lit(k), F.lit(v))]), T.slug(c))


def kept_numbers(rows: DataFrame) -> DataFrame:
    """`n` = 1.. over the rows, in order of file and ordinal: counts per file are summed before, so only a file's rows share a task."""
    from pyspark.sql import Window

    files = rows.groupBy("file").agg(F.count(F.lit(1)).alias("_k"))
    base = files.select("file", F.coalesce(F.sum("_k").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))  # one row per file
    return rows.join(base, "file").withColumn("n", F.col("_base") + F.row_number().over(Window.partitionBy("file").orderBy("ordinal"))).drop("_base")


def questions_from_tables(table: DataFrame, source_id: str, directory: bool = True) -> DataFrame:
    """Questions of hand-made tables, without visual bonuses and rows that lack question, category or answer.

    In a directory of sheets ids count the rows that are kept, in order of file name and row; a single table's ids (`directory`
    false) are its row numbers, whichever rows are left out, and its difficulty is the division's.
    """
    cell = lambda *n: T.squeeze(F.coalesce(pick(*n), F.lit("")))
    filled = lambda c: F.nullif(c, F.lit(""))
    t = table.where(~F.lower(cell("Type")).contains("visual bonus")).withColumn("q", cell("Question")).withColumn("a", cell("Answer"))
    t = t.where((F.col("q") != "") & (F.col("a") != "") & (cell("Category") != ""))
    t = kept_numbers(t) if directory else t.withColumn("n", F.col("ordinal") + 1)
    mode = F.when(T.slug(cell("Format")).isin("multiple_choice", "multiplechoice"), "multiple_choice").otherwise("short_answer")
    letters = F.filter(F.array(*[F.struct(F.lit(x).alias("label"), cell(x).alias("text")) for x in "WXYZ"]), lambda c: c["text"] != "")
    t = t.withColumn("choices", F.when(mode == "multiple_choice", letters).otherwise(F.array().cast("array<struct<label:string,text:string>>")))
    rated = T.to_double(cell("Difficulty"))
    divisions = F.create_map(*[x for k, v in DIVISIONS.items() for x in (F.lit(k), F.lit(v))])
    by_division = F.coalesce(F.try_element_at(divisions, T.slug(cell("Division (Approx)"))), F.lit(3))
    difficulty = F.coalesce(F.when(rated.between(1, 7), T.half_even(rated)), F.lit(3)) if directory else by_division
    none = F.lit(None).cast("double")
    return t.select(
        F.format_string(f"{source_id}_%04d", "n").alias("question_id"), category(cell("Category")).alias("category"), F.coalesce(filled(cell("Subcategory", "Topic") if directory else cell("Subcategory")), F.lit("other")).alias("subcategory"),
        F.when(T.slug(cell("Type")) == "bonus", "bonus").otherwise("tossup").alias("question_type"), mode.alias("answer_mode"), difficulty.alias("difficulty"), F.col("q").alias("question_text"), answer_line(F.col("a"), F.col("choices"), any_case=False).alias("answer_text"), "choices",
        F.struct(T.guidance(cell("Accept", "Also accept")).alias("accept"), T.guidance(cell("Do Not Accept", "Do not accept")).alias("do_not_accept")).alias("answer_guidance"),
        F.array_compact(F.array(filled(cell("Subcategory")), filled(cell("Topic"))) if directory else F.array(filled(cell("Subcategory")))).alias("content_tags"), (F.col("ordinal") + 1).alias("source_row"), F.lit(source_id).alias("source_id"), F.col("file").alias("raw_file"),
        F.when(cell("Round").rlike(r"^[0-9]+$"), cell("Round").cast("int")).alias("round"), filled(cell("Writer")).alias("writer"), filled(cell("Source", "Background")).alias("source"), filled(cell("Date")).alias("date"), filled(cell("Division (Approx)")).alias("division"),
        (rated if directory else none).alias("original_difficulty"), (T.to_double(cell("Quality")) if directory else none).alias("original_quality"), "n",
    )


def in_file_order(df: DataFrame) -> DataFrame:
    """The rows with `ordinal`, their place in the file that they were just read from."""
    return df if "ordinal" in df.columns else df.withColumn("ordinal", F.monotonically_increasing_id())


def reviews_from_tables(table: DataFrame, questions: DataFrame, tournament: str | None = None) -> DataFrame:
    """Reviews of rating tables, linked by id or by source row, the last question (by `ordinal`) of a row number; a row that links to none ends the query.

    A question without a source row counts by its own place. Ratings are not checked for their range here; blank and unreadable
    ones are null, and a row without a reviewer is `reviewer_` and its number.
    """
    row = T.to_int(pick(*ROW_COLUMNS))
    text = lambda *n: F.nullif(T.squeeze(pick(*n)), F.lit(""))
    who = F.coalesce(text(*REVIEWER_COLUMNS), F.format_string("reviewer_%04d", F.col("ordinal") + 1))
    t = table.select(
        text(*ID_COLUMNS).alias("named"), row.alias("source_row"), F.coalesce(F.nullif(T.slug(who), F.lit("")), who).alias("reviewer_id"), T.to_double(pick(*QUALITY_COLUMNS)).alias("quality"), T.to_double(pick(*DIFFICULTY_COLUMNS)).alias("difficulty"),
        F.coalesce(text("tournament", "Tournament"), F.lit(tournament)).alias("tournament"), text("comment", "Comment", "notes", "Notes").alias("comment"), text("status", "Status").alias("status"), F.col("file").alias("raw_file"), F.col("ordinal").alias("_at"),
    )
    q = in_file_order(questions)
    last = q.groupBy(F.coalesce(F.nullif("source_row", F.lit(0)), F.col("ordinal") + 1).cast("int").alias("source_row")).agg(F.max_by("question_id", "ordinal").alias("linked"))
    j = t.join(last, "source_row", "left").withColumn("question_id", F.coalesce("named", "linked"))
    linked = F.when(F.col("question_id").isNotNull(), F.col("question_id")).otherwise(F.raise_error(F.lit("a rating links to no question")))
    rid = F.concat(F.lit("review_"), F.substring(F.sha1(F.concat_ws("\x1f", "question_id", "reviewer_id", "source_row", "raw_file", "_at")), 1, 12))
    return j.select(rid.alias("review_id"), linked.alias("question_id"), "reviewer_id", F.struct("quality", "difficulty").alias("ratings"), "source_row", "tournament", "comment", "status", F.create_map(F.lit("raw_file"), F.col("raw_file")).alias("metadata"))


def sheet_ratings(table: DataFrame, questions: DataFrame, tournament: str | None = None) -> DataFrame:
    """Reviews of sheets joined to questions by their text in lower case and single blanks, the last question of a text; ratings out of range are null, rows without any left out."""
    key = lambda c: F.lower(T.squeeze(c))
    q = in_file_order(questions).where(T.squeeze("question_text") != "")
    row = F.col("source_row") if "source_row" in q.columns else F.lit(None).cast("int")
    q = q.groupBy(key(F.col("question_text")).alias("k")).agg(F.max_by(F.struct("question_id", row.alias("source_row")), "ordinal").alias("last"))
    t = table.where(~F.lower(F.coalesce(pick("Type"), F.lit(""))).contains("visual bonus"))
    t = t.select(key(pick("Question", "question_text")).alias("k"), T.within(T.to_double(pick("Quality", "quality")), -1, 1).alias("quality"), T.within(T.to_double(pick("Difficulty", "difficulty")), 1, 7).alias("difficulty"), "file", (F.col("ordinal") + 1).alias("sheet_row"))
    j = t.join(q, "k").where("quality is not null or difficulty is not null")
    meta = F.create_map(F.lit("raw_file"), F.col("file"), F.lit("rating_column"), F.lit("Difficulty,Quality"), F.lit("sheet_row"), F.col("sheet_row").cast("string"))
    rid = F.concat(F.lit("review_"), F.substring(F.sha1(F.concat_ws("\x1f", "last.question_id", "file", "sheet_row")), 1, 12))
    return j.select(rid.alias("review_id"), "last.question_id", F.lit("aggregate_sheet_ratings").alias("reviewer_id"), F.lit(tournament).alias("tournament"), F.struct("quality", "difficulty").alias("ratings"), "last.source_row", meta.alias("metadata"))


def load_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunks of a folder or file; a repeated id or mixed corpus versions (a missing one is 'legacy') are errors."""
    c = require_unique(read_jsonl(spark, path, schemas.CHUNK), "chunk_id")
    versions = c.select(F.coalesce(F.try_element_at("metadata", F.lit("corpus_version")), F.lit("legacy")).alias("v")).distinct().limit(2).collect()
    if len(versions) > 1:
        raise ValueError("mixed corpus versions")
    return c
