import hashlib
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from siltwork.sources import files, schemas, workbooks


def test_jsonl(spark, tmp_path):
    p = tmp_path / "q.jsonl"
    p.write_text('{"question_id":"a","extra":1}\n\n{"question_id":"b","difficulty":3}\n')
    assert {r.question_id: r.difficulty for r in files.read_jsonl(spark, str(p), schemas.QUESTION).collect()} == {"a": None, "b": 3}
    p.write_text("{not json\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_jsonl(spark, str(p), schemas.QUESTION).collect()


def test_splits_manifest_and_replace(spark, tmp_path):
    df = spark.createDataFrame([("a", "train", None)], "id string, split string, x string")
    files.write_splits(df, str(tmp_path / "s"), ["train", "val"])
    assert (tmp_path / "s/split=val").is_dir() and '"x":null' in next((tmp_path / "s/split=train").glob("*.json")).read_text()
    files.write_manifest(df.agg(F.count(F.lit(1)).alias("n")), str(tmp_path / "m.json"))
    assert json.loads((tmp_path / "m.json").read_text()) == {"n": 1}
    for _ in range(2):
        files.replace_folder(df, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).count() == 1


@pytest.mark.parametrize("text", ["a\n b \n\na\n", '["a","b"," a "]', '{"question_ids":["a","b"]}'])
def test_ids(spark, tmp_path, text):
    p = tmp_path / "ids"
    p.write_text(text)
    assert sorted(r.question_id for r in files.read_ids(spark, str(p)).collect()) == ["a", "b"]


def test_pages_and_hashes(spark, tmp_path):
    p = tmp_path / "book.txt"
    p.write_text("one\ftwo\fthree")
    assert [(r.document_id, r.page_no, r.text) for r in files.read_pages(spark, str(p), 2, 3).collect()] == [("book", 2, "two"), ("book", 3, "three")]
    good = hashlib.sha256(p.read_bytes()).hexdigest().upper()
    assert files.require_hash(files.hashed_files(spark, str(p)), {"book.txt": good}).count() == 1
    with pytest.raises(Exception, match="wrong hash"):
        files.require_hash(files.hashed_files(spark, str(p)), {"book.txt": "00"}).collect()


def test_tables(spark, tmp_path):
    assert files.clean_header([" A ", "", "A", "A"]) == ["A", "unnamed_1", "A_2", "A_3"]
    q = tmp_path / "q.csv"
    q.write_text('﻿Type,Category,Format,Question,W,X,Y,Z,Answer,Accept,Do Not Accept,Subcategory,Division (Approx)\nTossup,Biology,Short Answer,"What\nis it?",,,,,cell,"a; b",,,RR\nVisual Bonus,Bio,,x,,,,,y,,,,\nBonus,Earth and Space,Multiple Choice,Which?,p,q,r,s,X,,,Stars,playoff\n')
    rows = files.questions_from_tables(files.read_table(spark, str(q)), "set").orderBy("question_id").collect()
    assert [(r.question_id, r.category, r.question_type, r.difficulty, r.answer_text) for r in rows] == [("set_0001", "biology", "tossup", 3, "ANSWER: cell"), ("set_0002", "earth_space", "bonus", 3, "ANSWER: X) q")]
    assert rows[0].answer_guidance.accept == ["a", "b"] and rows[0].question_text == "What is it?" and rows[0].subcategory == "other"
    alone = files.questions_from_tables(files.read_table(spark, str(q)), "set", directory=False).orderBy("question_id").collect()
    assert [(r.question_id, r.difficulty) for r in alone] == [("set_0001", 2), ("set_0003", 5)]
    qs = spark.createDataFrame([("q9", 1, "What  is IT?", 0), ("q2", 1, "what is it?", 1), ("q3", None, "else", 6)], "question_id string, source_row int, question_text string, ordinal long")
    r = tmp_path / "r.csv"
    r.write_text("Source Row,Reviewer,Quality Rating,Difficulty Rating\n1,Alice,4,3\n")
    got = files.reviews_from_tables(files.read_table(spark, str(r)), qs).first()
    assert (got.question_id, got.reviewer_id, got.ratings.quality, got.ratings.difficulty) == ("q2", "alice", 4.0, 3.0)
    r.write_text("Source Row,Reviewer,Quality Rating,Difficulty Rating\n7,,,x\n")
    got = files.reviews_from_tables(files.read_table(spark, str(r)), qs).first()
    assert (got.question_id, got.reviewer_id, got.ratings.quality, got.ratings.difficulty) == ("q3", "reviewer_0001", None, None)
    r.write_text("Source Row,Reviewer,Quality Rating,Difficulty Rating\n8,Alice,4,3\n")
    with pytest.raises(Exception, match="links to no question"):
        files.reviews_from_tables(files.read_table(spark, str(r)), qs).collect()
    s = tmp_path / "s.csv"
    s.write_text("Question,Quality,Difficulty\nWHAT is it?,1,9\nwhat is it?,,\n")
    got = files.sheet_ratings(files.read_table(spark, str(s)), qs).collect()
    assert [(x.question_id, x.ratings.quality, x.ratings.difficulty, x.metadata["sheet_row"]) for x in got] == [("q2", 1.0, None, "1")]


def test_chunk_loader(spark, tmp_path):
    p = tmp_path / "c.jsonl"
    p.write_text('{"chunk_id":"a"}\n{"chunk_id":"a"}\n')
    with pytest.raises(ValueError, match="repeated"):
        files.load_chunks(spark, str(p))
    p.write_text('{"chunk_id":"a"}\n{"chunk_id":"b","metadata":{"corpus_version":"v2"}}\n')
    with pytest.raises(ValueError, match="mixed"):
        files.load_chunks(spark, str(p))


def book(path):
    ns, rel = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"', "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    cell = lambda ref, v: f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
    num = lambda ref, v: f'<c r="{ref}"><v>{v}</v></c>'
    row2 = cell("A2", "Tossup") + cell("B2", "Math") + cell("C2", "Short Answer") + '<c r="D2" t="s"><v>0</v></c>' + cell("I2", "two") + '<c r="N2"><f>AVERAGE(P2:Q2)</f><v>4.0</v></c><c r="O2"><f>AVERAGE(R2:R2)</f></c>' + num("P2", "3.0") + num("Q2", "100") + num("R2", "1")
    row3 = cell("A3", "Tossup") + cell("B3", "Math")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="Template" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships><Relationship Id="r1" Type="{rel}/worksheet" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/worksheets/s.xml", f"<worksheet {ns}><sheetData><row>{cell('A1', 'Type')}</row><row>{row2}</row><row>{row3}</row></sheetData></worksheet>")
        z.writestr("xl/worksheets/_rels/s.xml.rels", '<Relationships><Relationship Id="a" Type="x/threadedComment" Target="../tc.xml"/><Relationship Id="b" Type="x/comments" Target="../c.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><r><t>How </t></r><r><t>many?</t></r></si></sst>")
        z.writestr("xl/persons/p.xml", '<personList><person id="1" displayName="Bo"/></personList>')
        z.writestr("xl/tc.xml", '<ThreadedComments><threadedComment ref="P1" dT="2026-01-02T03:04:05Z" personId="1" id="t1"><text>Me</text></threadedComment></ThreadedComments>')
        z.writestr("xl/c.xml", f'<comments {ns}><authors><author>tc=x</author><author>Old</author></authors><commentList><comment ref="P1" authorId="0"><text>copy</text></comment><comment ref="D2" authorId="1"><text>note</text></comment></commentList></comments>'.replace("tc=x", "tc={x}"))


def test_workbook(spark, tmp_path):
    book(tmp_path / "2026 Math Question Writing.xlsx")
    c = workbooks.cells(spark, str(tmp_path)).cache()
    assert {r.value for r in c.where("ref in ('D2', 'P2')").collect()} == {"How many?", "3"}
    q = files.questions_from_tables(workbooks.rows(c), "w").collect()
    assert [(x.question_text, x.answer_text, x.category) for x in q] == [("How many?", "ANSWER: two", "math")]
    r = workbooks.ratings(c)
    assert {(x.kind, x.value, x.valid) for x in r.collect()} == {("difficulty", 3.0, True), ("difficulty", 100.0, False), ("quality", 1.0, True)}
    m = workbooks.row_means(r).first()
    assert (m.difficulty, m.quality, m.invalid) == (3.0, 1.0, 1)
    n = workbooks.comments(spark, str(tmp_path)).cache()
    assert {(x.ref, x.author, x.kind) for x in n.collect()} == {("P1", "Bo", "threaded"), ("D2", "Old", "note")}
    assert workbooks.reviewers(n).first().reviewers == ["Me"]
    assert c.select(workbooks.subject("file")).first()[0] == "Math"
    got = workbooks.read_workbooks(spark, str(tmp_path), "w26", "Cup")
    asked = got["questions"].collect()
    assert [(x.question_id, x.difficulty, x.original_quality, x.review_status, x.invalid_ratings) for x in asked] == [("w26_math_0002", 3, 1.0, "rated_usable", 1)]
    assert {(x.review_id, x.reviewer_id, x.ratings.quality, x.ratings.difficulty) for x in got["reviews"].collect()} == {("w26_math_0002_difficulty_p", "me", None, 3.0), ("w26_math_0002_quality_r", "math_quality_r", 1.0, None)}
    assert {(x.ref, x.question_id) for x in got["comments"].collect()} == {("P1", None), ("D2", "w26_math_0002")}
    s = got["summary"].first()
    assert (s.questions, s.reviews, s.comments, s.skipped_invalid_format, s.skipped_blank, s.unrated_quality) == (1, 2, 2, 1, 0, 0)
    assert [r[0] for r in spark.createDataFrame([(1,), (26,), (27,), (702,), (703,)], "n int").select(workbooks.column_name(F.col("n"))).collect()] == ["A", "Z", "AA", "ZZ", "AAA"]
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="no workbooks"):
        workbooks.read_workbooks(spark, str(tmp_path / "none"), "w")
    with pytest.raises(Exception, match="no sheet"):
        workbooks.cells(spark, str(tmp_path), "Nope").collect()
