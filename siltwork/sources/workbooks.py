"""Workbooks (OOXML) as long tables of cells and comments, from which rows are pivoted in Spark."""

from __future__ import annotations

import hashlib
import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as X

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.functions import text as T
from siltwork.operators.tables import require_unique
from siltwork.runtime import cut
from siltwork.sources import schemas
from siltwork.sources.files import CATEGORIES, STRICT_MODES, STRICT_TYPES, answer_line, strict

_REF = re.compile(r"^([A-Z]+)(\d+)$")


def _tag(e: X.Element) -> str:
    return e.tag.rpartition("}")[2]


def _all(root: X.Element | None, name: str) -> list[X.Element]:
    return [] if root is None else [e for e in root.iter() if _tag(e) == name]


def _text(e: X.Element) -> str:
    return " ".join("".join(e.itertext()).split())


class Book:
    def __init__(self, content: bytes) -> None:
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        self.names = set(self.zip.namelist())
        self.shared = [_text(e) for e in _all(self.part("xl/sharedStrings.xml"), "si")]

    def part(self, name: str) -> X.Element | None:
        return X.fromstring(self.zip.read(name)) if name in self.names else None

    def relations(self, part: str) -> list[tuple[str, str, str]]:
        """(id, kind, part) of what a part refers to."""
        folder, name = posixpath.split(part)
        root = self.part(f"{folder}/_rels/{name}.rels")
        full = lambda t: t.lstrip("/") if t.startswith("/") else posixpath.normpath(posixpath.join(folder, t))
        return [(r.get("Id", ""), r.get("Type", "").rpartition("/")[2], full(r.get("Target", ""))) for r in _all(root, "Relationship")]

    def sheet(self, title: str) -> str:
        to = {i: p for i, _, p in self.relations("xl/workbook.xml")}
        for s in _all(self.part("xl/workbook.xml"), "sheet"):
            if s.get("name") == title:
                return to[next(v for k, v in s.attrib.items() if k.endswith("}id"))]
        raise ValueError(f"no sheet {title!r}")

    def modified(self) -> str | None:
        return next((e.text for e in _all(self.part("docProps/core.xml"), "modified") if e.text), None)

    def cells(self, part: str) -> Iterator[tuple[str, str | None, str | None]]:
        for c in _all(self.part(part), "c"):
            inner = {_tag(e): e for e in c}
            raw = (inner["v"].text or "") if "v" in inner else None
            kind = c.get("t")
            if kind == "inlineStr":
                raw = _text(inner["is"]) if "is" in inner else None
            elif kind == "s" and raw is not None:
                raw = self.shared[int(raw)]
            elif kind == "b" and raw is not None:
                raw = "true" if raw == "1" else "false"
            elif kind is None and raw is not None and re.fullmatch(r"-?\d+\.0+", raw):
                raw = raw.partition(".")[0]
            yield c.get("r", ""), raw, (inner["f"].text if "f" in inner else None)

    def comments(self, part: str) -> Iterator[dict]:
        people = {p.get("id"): p.get("displayName") for n in self.names if n.startswith("xl/persons/") for p in _all(self.part(n), "person")}
        for _, kind, to in self.relations(part):
            if kind == "threadedComment":
                for c in _all(self.part(to), "threadedComment"):
                    text = next((_text(t) for t in c if _tag(t) == "text"), "")
                    yield {"ref": c.get("ref"), "author": people.get(c.get("personId")), "text": text, "timestamp": c.get("dT"), "parent_id": c.get("parentId"), "comment_id": c.get("id"), "resolved": c.get("done"), "kind": "threaded"}
            elif kind == "comments":
                root = self.part(to)
                authors = [a.text or "" for a in _all(root, "author")]
                for c in _all(root, "comment"):
                    who, text = authors[int(c.get("authorId", 0))] if authors else None, _text(c)
                    if not (who or "").startswith("tc={"):  # a copy of a threaded one
                        own = hashlib.sha1("\x1f".join((c.get("ref", ""), who or "", text)).encode()).hexdigest()
                        yield {"ref": c.get("ref"), "author": who, "text": text, "timestamp": None, "parent_id": None, "comment_id": own, "resolved": None, "kind": "note"}


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).select("path", "content")


def cells(spark: SparkSession, path: str, sheet: str = "Template") -> DataFrame:
    """(file, sheet, ref, row, col, value, formula) of a sheet of every workbook in the folder; a workbook without it is an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["path"], b["content"], strict=True):
                book = Book(bytes(content))
                rows = []
                for ref, value, formula in book.cells(book.sheet(sheet)):
                    if m := _REF.match(ref):
                        col = 0
                        for ch in m[1]:
                            col = col * 26 + ord(ch) - 64
                        rows.append((name, sheet, ref, int(m[2]), col, value, formula))
                yield pd.DataFrame(rows, columns=["file", "sheet", "ref", "row", "col", "value", "formula"])

    return _files(spark, path).mapInPandas(run, schemas.CELL)


def comments(spark: SparkSession, path: str, sheet: str = "Template") -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["path"], b["content"], strict=True):
                book = Book(bytes(content))
                rows = [{"file": name, "sheet": sheet} | c for c in book.comments(book.sheet(sheet))]
                yield pd.DataFrame(rows, columns=["file", "sheet", "ref", "author", "text", "timestamp", "parent_id", "comment_id", "resolved", "kind"])

    out = _files(spark, path).mapInPandas(run, schemas.COMMENT)
    return out.withColumns({"timestamp": T.to_time(F.col("timestamp")), "resolved": T.to_flag(F.col("resolved"))})


#: The columns of the sheet.
COLUMNS = ["Type", "Category", "Format", "Question", "W", "X", "Y", "Z", "Answer", "Accept", "Do Not Accept", "Subcategory", "Writer", "Difficulty", "Quality"]


def rows(c: DataFrame) -> DataFrame:
    """(file, row, cells map) of rows 2 and later, by the fixed columns; fits what reads hand-made tables."""
    names = F.array(*map(F.lit, COLUMNS))
    named = c.where((F.col("row") >= 2) & (F.col("col") <= len(COLUMNS)) & F.col("value").isNotNull()).withColumn("name", F.element_at(names, F.col("col")))
    g = named.groupBy("file", "row").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("cells"))
    return g.select("file", (F.col("row") - 2).alias("ordinal"), "cells")


def subject(path: Column) -> Column:
    """The subject in a workbook's name, such as `2026 Earth Question Writing.xlsx`; another name is an error."""
    name = T.squeeze(F.regexp_extract(path, r"(?i)([0-9]{4})\s+([^/]+?)\s+Question Writing[^/]*$", 2))
    return F.when(name != "", name).otherwise(F.raise_error(F.concat(F.lit("no subject in the name: "), path)))


def rating_columns(c: DataFrame) -> DataFrame:
    """(file, kind, col) of the rating columns: what the first AVERAGE formula in rows 2 to 50 spans, else those with headers D1, D2 .. or Q1, Q2 .."""
    span = r"(?i)AVERAGE\(\$?([A-Z]+)\$?\d+:\$?([A-Z]+)\$?\d+\)"
    f = c.where(F.col("row").between(2, 50) & F.col("col").isin(14, 15) & F.col("formula").rlike(span))
    ends = F.sequence(T.column_number(F.regexp_extract("formula", span, 1)), T.column_number(F.regexp_extract("formula", span, 2)))
    f = f.select("file", F.when(F.col("col") == 14, "difficulty").otherwise("quality").alias("kind"), "row", ends.alias("cols"))
    spans = f.groupBy("file", "kind").agg(F.min_by("cols", "row").alias("cols")).select("file", "kind", F.explode("cols").alias("col"))
    head = c.where((F.col("row") == 1) & F.col("col").between(16, 199) & F.trim("value").rlike(r"(?i)^[DQ]\d+$"))
    head = head.select("file", F.when(F.upper(F.trim("value")).startswith("D"), "difficulty").otherwise("quality").alias("kind"), "col")
    return spans.union(head.join(spans.select("file", "kind").distinct(), ["file", "kind"], "left_anti"))


def ratings(c: DataFrame, ranges: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """(file, row, col, kind, value, valid): one row per filled rating cell; blanks are no ratings, others out of range or no number are not valid."""
    of = ranges or {"difficulty": (1, 7), "quality": (-1, 1)}
    r = rating_columns(c).alias("r")
    j = c.where("row >= 2").alias("c").join(r, (F.col("c.file") == F.col("r.file")) & (F.col("c.col") == F.col("r.col")))
    value = T.to_double(F.col("c.value"))
    ok: Column = F.lit(False)
    for k, (lo, hi) in of.items():
        ok = ok | ((F.col("r.kind") == k) & value.between(lo, hi))
    return j.where(F.trim(F.coalesce("c.value", F.lit(""))) != "").select("c.file", "c.row", "c.col", "r.kind", value.alias("value"), F.coalesce(ok, F.lit(False)).alias("valid"))


def row_means(r: DataFrame) -> DataFrame:
    return r.groupBy("file", "row").agg(F.avg(F.when((F.col("kind") == "difficulty") & F.col("valid"), F.col("value"))).alias("difficulty"), F.avg(F.when((F.col("kind") == "quality") & F.col("valid"), F.col("value"))).alias("quality"), F.count_if(~F.col("valid")).alias("invalid"))


def reviewers(c: DataFrame) -> DataFrame:
    """(file, col, reviewers): what the root comments on the header of a column say, else their authors, distinct, sorted without regard to case."""
    who = F.coalesce(F.nullif(T.squeeze("text"), F.lit("")), T.squeeze("author"))
    head = c.where(F.col("ref").rlike("^[A-Z]+1$") & F.col("parent_id").isNull()).withColumn("who", who).where("who <> ''")
    pairs = head.select("file", T.column_number(F.regexp_extract("ref", "^([A-Z]+)", 1)).alias("col"), F.struct(T.casefold(F.col("who")).alias("k"), F.col("who").alias("a")).alias("p"))
    return pairs.groupBy("file", "col").agg(F.transform(F.array_sort(F.collect_set("p")), lambda x: x["a"]).alias("reviewers"))


def column_name(c: Column) -> Column:
    """1 is A, 26 is Z, 27 is AA; up to three letters."""
    letter = lambda n: F.char(65 + F.pmod(n, F.lit(26)))
    a, b = c - 1, F.floor((c - 27) / 26)
    return F.concat(F.when(c > 702, letter(F.floor((c - 703) / 676))).otherwise(""), F.when(c > 26, letter(b)).otherwise(""), letter(a))


def times(spark: SparkSession, path: str) -> DataFrame:
    """(file, sha256, modified): when each workbook says it was changed, else its file's time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"file": b["path"], "sha256": b["sha256"], "said": [Book(bytes(x)).modified() for x in b["content"]], "changed": b["changed"]})

    f = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).select("path", F.sha2("content", 256).alias("sha256"), "content", F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss").alias("changed"))
    out = f.mapInPandas(run, "file string, sha256 string, said string, changed string")
    return out.select("file", "sha256", F.coalesce(T.to_time(F.col("said")), F.to_timestamp("changed")).alias("modified"))


#: Reasons to skip a row, in the order in which they are tried.
SKIPS = ["blank", "visual_bonus", "invalid_type", "invalid_format", "missing_required", "invalid_category"]


def judged_rows(c: DataFrame) -> DataFrame:
    """Every row from 2 to a sheet's last, as (file, row, cells, skip): why it is no question, or null; rows without any cell are blank."""
    top = c.groupBy("file").agg(F.max("row").alias("top")).where("top >= 2")
    every = top.select("file", F.explode(F.sequence(F.lit(2), "top")).alias("row"))
    r = every.join(rows(c).select("file", (F.col("ordinal") + 2).alias("row"), "cells"), ["file", "row"], "left").withColumn("cells", F.coalesce("cells", F.create_map().cast("map<string,string>")))
    cell = lambda n: T.squeeze(F.coalesce(F.try_element_at("cells", F.lit(n)), F.lit("")))
    filled = F.exists(F.map_values("cells"), lambda v: F.coalesce(v, F.lit("")) != "")
    known = F.create_map(*[x for k, v in CATEGORIES.items() for x in (F.lit(k), F.lit(v))])
    named = F.coalesce(F.nullif(cell("Category"), F.lit("")), subject(F.col("file")))
    r = r.withColumn("category", F.try_element_at(known, T.slug(named)))
    skip = (
        F.when(~filled, "blank").when(F.lower(cell("Type")).contains("visual bonus"), "visual_bonus").when(strict(cell("Type"), STRICT_TYPES).isNull(), "invalid_type").when(strict(cell("Format"), STRICT_MODES).isNull(), "invalid_format")
        .when((cell("Question") == "") | (cell("Answer") == ""), "missing_required").when(F.col("category").isNull(), "invalid_category")
    )
    return r.withColumn("skip", skip)


def questions(c: DataFrame, source_id: str, judged: DataFrame | None = None) -> DataFrame:
    """The questions of workbooks: means of the valid ratings, else the cached averages in range, and whether the rating is usable. Two of one id end the query."""
    j = (judged_rows(c) if judged is None else judged).where("skip is null")
    cell = lambda n: T.squeeze(F.coalesce(F.try_element_at("cells", F.lit(n)), F.lit("")))
    j = j.join(row_means(ratings(c)), ["file", "row"], "left")
    d = F.coalesce("difficulty", T.within(T.to_double(cell("Difficulty")), 1, 7))
    q = F.coalesce("quality", T.within(T.to_double(cell("Quality")), -1, 1))
    mode = strict(cell("Format"), STRICT_MODES)
    choices = F.filter(F.array(*[F.struct(F.lit(x).alias("label"), cell(x).alias("text")) for x in "WXYZ"]), lambda x: x["text"] != "")
    choices = F.when(mode == "multiple_choice", choices).otherwise(F.array().cast("array<struct<label:string,text:string>>"))
    sub = F.coalesce(F.nullif(cell("Subcategory"), F.lit("")), F.lit("other"))
    out = j.withColumns({"choices": choices, "d": d, "q": q, "sub": sub}).select(
        F.concat(F.lit(source_id + "_"), T.slug(subject(F.col("file"))), F.format_string("_%04d", "row")).alias("question_id"), F.lit("dataset").alias("source_type"), F.lit(source_id).alias("source_id"), "category", F.col("sub").alias("subcategory"),
        strict(cell("Type"), STRICT_TYPES).alias("question_type"), mode.alias("answer_mode"), F.coalesce(T.half_up(F.col("d")), F.lit(3)).alias("difficulty"), cell("Question").alias("question_text"), answer_line(cell("Answer"), F.col("choices")).alias("answer_text"), "choices",
        F.struct(T.guidance(cell("Accept")).alias("accept"), T.guidance(cell("Do Not Accept")).alias("do_not_accept")).alias("answer_guidance"), F.when(F.col("sub") != "other", F.array("sub")).otherwise(F.array().cast("array<string>")).alias("content_tags"),
        F.col("row").alias("source_row"), F.col("d").alias("original_difficulty"), F.col("q").alias("original_quality"), F.nullif(cell("Writer"), F.lit("")).alias("writer"), F.col("file").alias("raw_file"),
        F.when(F.col("q").isNull(), "unrated").when(F.col("q") >= 0, "rated_usable").otherwise("rated_rejected").alias("review_status"), F.coalesce("invalid", F.lit(0)).alias("invalid_ratings"),
    )
    return require_unique(cut(out), "question_id")


def reviews(c: DataFrame, notes: DataFrame, asked: DataFrame, when: DataFrame | None = None, tournament: str | None = None) -> DataFrame:
    """One review for each valid rating of a question, by whoever the column's header names, else by subject, kind and column."""
    r = ratings(c).where("valid").join(reviewers(notes), ["file", "col"], "left").join(asked.select(F.col("raw_file").alias("file"), F.col("source_row").alias("row"), "question_id"), ["file", "row"])
    slot = column_name(F.col("col"))
    label = F.coalesce(F.nullif(F.array_join("reviewers", " / "), F.lit("")), F.concat_ws(" ", subject(F.col("file")), "kind", slot))
    r = r.join(F.broadcast(when.select("file", "modified")), "file", "left") if when is not None else r.withColumn("modified", F.lit(None).cast("timestamp"))
    own = F.coalesce(F.nullif(T.slug(label), F.lit("")), F.concat_ws("_", T.slug(subject(F.col("file"))), "kind", F.lower(slot)))
    value = lambda k: F.when(F.col("kind") == k, F.col("value"))
    return r.select(
        F.concat_ws("_", "question_id", "kind", F.lower(slot)).alias("review_id"), "question_id", own.alias("reviewer_id"), F.lit(tournament).alias("tournament"), F.col("modified").alias("review_timestamp"), F.struct(value("quality").alias("quality"), value("difficulty").alias("difficulty")).alias("ratings"),
        F.col("row").alias("source_row"), F.create_map(F.lit("raw_file"), F.col("file"), F.lit("cell_ref"), F.concat(slot, F.col("row").cast("string")), F.lit("rating_kind"), F.col("kind"), F.lit("rating_slot"), slot).alias("metadata"),
    )


def comment_questions(c: DataFrame, questions: DataFrame) -> DataFrame:
    """Comments with text on a cell, with the question of their row and workbook, or null."""
    by = ["file", "source_row"] if "raw_file" in questions.columns else ["source_row"]
    q = questions.withColumnRenamed("raw_file", "file") if "raw_file" in questions.columns else questions
    q = q.groupBy(*by).agg(F.max("question_id").alias("question_id"))
    told = c.where((F.col("text") != "") & F.col("ref").rlike("^[A-Z]+[0-9]+$"))
    return told.withColumn("source_row", F.regexp_extract("ref", r"(\d+)$", 1).try_cast("int")).join(q, by, "left")


def summary(judged: DataFrame, asked: DataFrame, given: DataFrame, told: DataFrame) -> DataFrame:
    """Per workbook the counts of questions, reviews, comments, ratings that are not valid, choices that are not four, and skipped rows by reason."""
    n = lambda cond, name: F.count_if(cond).alias(name)
    rows_ = judged.groupBy("file").agg(F.max("row").alias("last_row"), *[n(F.col("skip") == k, f"skipped_{k}") for k in SKIPS])
    q = asked.groupBy(F.col("raw_file").alias("file")).agg(
        F.count(F.lit(1)).alias("questions"), F.count("original_difficulty").alias("rated_difficulty"), F.count("original_quality").alias("rated_quality"), F.sum("invalid_ratings").alias("invalid_ratings"),
        n((F.col("answer_mode") == "multiple_choice") & (F.size("choices") != 4), "malformed_multiple_choice"),
    )
    r = given.groupBy(F.col("metadata")["raw_file"].alias("file")).agg(F.count(F.lit(1)).alias("reviews"))
    t = told.groupBy("file").agg(F.count(F.lit(1)).alias("comments"))
    out = rows_.join(q, "file", "left").join(r, "file", "left").join(t, "file", "left")
    return out.na.fill(0).withColumn("unrated_quality", F.col("questions") - F.col("rated_quality"))


def read_workbooks(spark: SparkSession, path: str, source_id: str, tournament: str | None = None) -> dict[str, DataFrame]:
    """questions, reviews, comments and summary of all workbooks in a folder; none there is an error."""
    if _files(spark, path).select("path").isEmpty():
        raise ValueError(f"no workbooks in {path}")
    c, notes = cut(cells(spark, path)), cut(comments(spark, path))
    judged = cut(judged_rows(c))
    asked = questions(c, source_id, judged)
    given, told = cut(reviews(c, notes, asked, times(spark, path), tournament)), cut(comment_questions(notes, asked))
    return {"questions": asked, "reviews": given, "comments": told, "summary": summary(judged, asked, given, told)}
