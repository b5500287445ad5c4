import hashlib
import json

import pytest
from pyspark.sql import functions as F

from siltwork import cli
from siltwork.operators import replies
from siltwork.plans import ingest


def test_replies(spark):
    rows = [
        ('```json\n{"choices":["W) one","X. two"]}\n```',), ('{"choices":[{"label":"w","text":" a  b"},{"choice_label":"X","choice_text":"c"},{"Y":"d"},{"option":"Z","value":"e"}]}',), ("not json",), (None,), ('{"question_text":"q"}',),
    ]
    df = spark.createDataFrame(rows, "r string").withColumn("j", replies.json_part(F.col("r"))).withColumn("c", replies.choices(F.col("j")))
    got = [None if r.c is None else [tuple(x) for x in r.c] for r in df.collect()]
    assert got[:2] == [[("W", "one"), ("X", "two")], [("W", "a b"), ("X", "c"), ("Y", "d"), ("Z", "e")]] and got[2:] == [[], [], []]
    assert [r.j is None for r in df.collect()] == [False, False, True, True, False]
    one = spark.createDataFrame([(["c2", "zz"], ["c1", "c2", "c2"], ["a"], None)], "ids array<string>, got array<string>, rules array<string>, model array<string>")
    r = one.select(replies.cited(F.col("ids"), F.col("got")).alias("c"), replies.merged(F.col("rules"), F.col("model")).alias("m"), replies.rendered("A {x} B {y}", x=replies.bullets(F.col("rules")), y=F.lit(None)).alias("t")).first()
    assert (r.c, r.m, r.t) == (["c2"], ["a"], "A - a B - none")
    none = F.array().cast("array<string>")
    m = spark.createDataFrame([("Which of the following?", "x"), ("Why?", "ANSWER: W) x"), ("Why?", "ANSWER: x")], "q string, a string").select(replies.answer_mode(F.col("q"), F.col("a"), none)).collect()
    assert [x[0] for x in m] == ["multiple_choice", "multiple_choice", "short_answer"]


def test_corpus(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.txt").write_text("CHAPTER 1\n" + "word " * 200 + "\f" + "more " * 100)
    good = hashlib.sha256((raw / "a.txt").read_bytes()).hexdigest()
    source = {"file": "a.txt", "document_id": "book", "title": "T", "topics": ["x"], "sha256": good}
    assert [tuple(r) for r in ingest.corpus(spark, str(raw), [source], str(tmp_path / "out")).collect()] == [("book", 2)]
    with pytest.raises(Exception, match="wrong hash"):
        ingest.corpus(spark, str(raw), [source | {"sha256": "0"}], str(tmp_path / "out2"))


def q(i, text, answer="ANSWER: x"):
    return json.dumps({"question_id": i, "source_type": "dataset", "source_id": "nsb_set_1", "category": "physics", "subcategory": "Optics", "question_type": "tossup", "answer_mode": "short_answer", "difficulty": 3, "question_text": text, "answer_text": answer, "choices": [], "style_tags": [], "content_tags": [], "source_metadata": {}, "provenance": {}})


def test_export_and_check(spark, tmp_path, capsys):
    (tmp_path / "q.jsonl").write_text("\n".join([q(f"q{i:03d}", f"Why does number {i} glow?") for i in range(200)] + [q("bad", "Why?", "x"), q("q000", "Why does number 0 glow?")]))
    (tmp_path / "held").write_text("q005\n")
    out = str(tmp_path / "out")
    assert cli.main(["export", out, str(tmp_path / "q.jsonl"), "--held-out", str(tmp_path / "held")], spark) == 0
    assert json.loads(capsys.readouterr().out)["invalid_answer_line"] == 1
    manifest = json.loads((tmp_path / "out/manifest.json").read_text())
    assert manifest["examples"] == 200 and manifest["held_out"] == 1
    cli.main(["check-export", out], spark)
    assert sum(json.loads(capsys.readouterr().out).values()) == 200
    (tmp_path / "q.jsonl").write_text(q("a", "One?") + "\n" + q("a", "Two?"))
    with pytest.raises(ValueError, match="different contents"):
        ingest.clean_export(spark, [str(tmp_path / "q.jsonl")], [], out)
