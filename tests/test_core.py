import hashlib
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from siltwork.functions import text as T
from siltwork.operators import curate, generate, pages, retrieve, tables, verify
from siltwork.operators.ranking import sharded_rank
from siltwork import runtime, storage
from siltwork.streaming import reviews as log

SPACES = "a\x0bb\x1cc\x85d e f \t\n g"


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double'}" for k, v in values.items()))
    return row.select(column.alias("x")).first().x


def test_text_functions(spark):
    assert one(spark, T.squeeze(F.col("v")), v=f"  {SPACES} ") == " ".join(SPACES.split())
    assert one(spark, T.slug(F.col("v")), v=" Earth & Space! ") == "earth_space"
    assert one(spark, T.runs(F.col("v")), v="Straße ﬁx Ab1") == ["strasse", "fix", "ab1"]
    assert one(spark, T.retrieval_tokens(F.col("v")), v="The pH of a b stars") == ["ph", "stars"]
    assert one(spark, T.near_tokens(F.col("v")), v="What is x or y following") == ["x", "y"]
    assert one(spark, T.guidance(F.col("v")), v="a; ;b  c;") == ["a", "b c"]
    assert one(spark, T.token_count(F.col("v")), v="") == 1
    assert [one(spark, T.to_double(F.col("v")), v=v) for v in ("", "#DIV/0!", "?", "2.5", " 3 ", "x", None)] == [None, None, None, 2.5, 3.0, None, None]
    assert [one(spark, T.half_even(F.col("v")), v=v) for v in (2.5, 3.5)] == [2, 4]
    assert [one(spark, T.half_up(F.col("v")), v=v) for v in (2.5, 9.0, -1.0)] == [3, 7, 1]
    assert spark.range(1).select(T.half_up(F.lit(None).cast("double"))).first()[0] is None
    assert one(spark, T.year_in(F.col("v")), v="set 12024 of 2023b") == 2023
    assert one(spark, T.column_number(F.col("v")), v="AB") == 28
    assert one(spark, T.to_flag(F.col("v")), v="Yes") is True
    assert one(spark, T.repair_mojibake("v"), v="cafÃ© ﬁne") == "café fine"
    share = one(spark, T.hash_share(F.col("v")), v="42:abc")
    assert share == int.from_bytes(hashlib.sha256(b"42:abc").digest()[:8], "big") / float(1 << 64)


def test_overlap_and_jaccard(spark):
    df = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], [])], "a array<string>, b array<string>")
    assert [tuple(r) for r in df.select(T.overlap(F.col("a"), F.col("b")), T.jaccard(F.col("a"), F.col("b"))).collect()] == [(0.5, 1 / 3), (0.0, 0.0)]


def test_newest_has_one_outcome_for_ties(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "q")]
    df = spark.createDataFrame(rows, "k string, at int, v string")
    assert {tuple(r) for r in tables.newest(df, ["k"], "at").collect()} == {("a", 2, "z"), ("b", None, "q")}
    assert tables.newest(df.limit(0), ["k"], "at").count() == 0


def test_sets_and_uniqueness(spark):
    a, b = spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "id string"), spark.createDataFrame([("y",), ("z",)], "id string")
    assert tuple(tables.id_sets(a, b, "id").first()) == (1, 1, 1)
    with pytest.raises(ValueError, match="repeated id"):
        tables.require_unique(a, "id")
    assert tables.repeated(a, F.col("id"), "id").collect()[0].copies == 2
    g = spark.createDataFrame([("g", "train"), ("g", "val"), ("h", "val"), (None, "val")], "g string, s string")
    assert [r.g for r in tables.spanning(g, F.col("g"), F.col("s"), "g").collect()] == ["g"]


def test_sharded_rank_equals_a_window(spark):
    df = spark.range(2000).select((F.col("id") % 3).cast("string").alias("g"), "id", F.lit(1).alias("extra"))
    got = sharded_rank(df, ["g"], F.xxhash64("id"), "id")
    assert got.columns == ["g", "id", "extra", "rank"]
    for g in "012":
        assert sorted(r["rank"] for r in got.where(F.col("g") == g).collect()) == list(range(1, df.where(F.col("g") == g).count() + 1))
    assert sharded_rank(df.limit(0), ["g"], F.xxhash64("id"), "id").count() == 0


QUESTION = "question_id string, source_type string, source_id string, category string, subcategory string, question_type string, answer_mode string, question_text string, answer_text string, choices array<struct<label:string,text:string>>, style_tags array<string>, content_tags array<string>, source_metadata struct<tournament:string,year:int,original_difficulty:double,original_quality:double>, provenance struct<raw_file:string>, loaded_at timestamp"


def question(i, source="mit_2025", text="Why is it so?", answer="ANSWER: heat", mode="short_answer", choices=(), year=2025, sub="Optics", difficulty=None, quality=None, category="physics", tags=()):
    from datetime import datetime

    return (i, "dataset", source, category, sub, "tossup", mode, text, answer, list(choices), list(tags), [], (None, year, difficulty, quality), (None,), datetime(2024, 1, 1))


REVIEW = "question_id string, ratings struct<quality:double,difficulty:double>"


def test_curation(spark):
    wxyz = [(x, x) for x in "WXYZ"]
    q = spark.createDataFrame(
        [
            question("a", quality=1.0), question("b", text="why IS  it so?", quality=1.0, difficulty=3.0), question("c", text=None), question("d", answer="heat"), question("e", answer="ANSWER: x ANSWER: y"),
            question("f", mode="multiple_choice", choices=wxyz[:3]), question("g", choices=wxyz, quality=1.0), question("h", text="Other?", quality=None), question("i", category="energy", source="mit_2020", year=2020),
            question("j", source="club_1"), question("k", text="so it Why is!", source="mit_2024", year=None, quality=0.5, sub="unknown"), question("l", text="Low?", quality=-1.0),
        ],
        QUESTION,
    )
    r = spark.createDataFrame([("k", (0.5, 4.0)), ("k", (1.0, 5.0)), ("k", (None, 9.0))], REVIEW)
    c = {x.question_id: x for x in curate.candidates(q, r, "mit_all_plus_nsb").collect()}
    assert {k: v.reason for k, v in c.items()} == {
        "a": None, "b": None, "c": "missing_text", "d": "invalid_answer_line", "e": "contaminated_parse", "f": "malformed_multiple_choice", "g": "malformed_short_answer", "h": "missing_quality", "i": "legacy_energy", "j": "profile",
        "k": None, "l": "low_quality",
    }
    assert (c["k"].difficulty, c["k"].difficulty_mean, c["k"].quality_mean, c["k"].source_year, c["k"].subcategory) == (5, 4.5, 0.75, 2024, None)
    assert c["a"].difficulty is None and c["b"].difficulty_source == "source_metadata"
    counts = {x.reason: x.n for x in curate.exclusion_counts(curate.candidates(q, r, "mit_all_plus_nsb")).collect()}
    assert counts["profile"] == 1 and len(counts) == 9
    u = curate.dedupe(curate.candidates(q, r, "mit_all_plus_nsb").where("reason is null"))
    kept = {x.question_id: x.duplicate_source_question_ids for x in u.collect()}
    assert kept == {"b": ["a"], "k": []}  # b has a difficulty, so it is kept
    held = spark.createDataFrame([("a",)], "question_id string")  # a dropped copy holds the whole near group out
    assert {x.question_id: x.split for x in curate.with_splits(u, held).collect()} == {"b": "held_out", "k": "held_out"}
    with pytest.raises(ValueError):
        curate.with_splits(u, None, validation=0.5, test=0.5)
    with pytest.raises(ValueError):
        curate.candidates(q, r, "nonsense")
    e = curate.examples(curate.with_splits(u), "Write.")
    assert {x.violation for x in curate.violations(e).collect()} == {None}
    assert json.loads(e.first().messages[2].content).keys() == {"question_text", "answer_text", "choices"}
    bad = spark.createDataFrame([("1", [("user", "x")]), ("2", [("system", "s"), ("user", " "), ("assistant", "{}")]), ("3", [("system", "s"), ("user", "u"), ("assistant", "no")]), ("4", None)], "example_id string, messages array<struct<role:string,content:string>>")
    assert {x.example_id: x.violation for x in curate.violations(bad).collect()} == {"1": "roles", "2": "empty_message", "3": "invalid_json", "4": "roles"}
    assert curate.dedupe(curate.candidates(q.limit(0), r.limit(0)).where("reason is null")).count() == 0


def test_split_shares(spark):
    u = spark.range(4000).select(F.sha1(F.col("id").cast("string")).alias("near_fingerprint"), F.col("id").cast("string").alias("question_id"), F.array().cast("array<string>").alias("duplicate_source_question_ids"))
    n = {r.split: r["count"] for r in curate.with_splits(u).groupBy("split").count().collect()}
    assert 120 < n["val"] < 280 and 120 < n["test"] < 280


def plain_clean(text):
    import re

    out, skip = [], 0
    for raw in text.split("\n"):
        line = " ".join(raw.split())
        low = line.lower()
        if not line:
            continue
        if re.search(pages.PROMPT, low):
            skip = 2
            continue
        if skip:
            skip -= 1
            continue
        if any(re.search(p, low) for p in pages.FURNITURE) or (re.search(r"\b(am|pm)\b", low) and re.search(r"\d+/\d+/\d+", low)):
            continue
        if re.search(pages.REVIEW_SECTION, low):
            break
        if re.search(pages.EXERCISE, low):
            continue
        out.append(line)
    return out


def test_page_lines_equal_a_plain_loop(spark):
    rng = random.Random(5)
    kinds = ["text of a line", "", "  ", "12", "Draw it now", "Problems", "problem 3 x", "a) choice", "Chapter 2 | Heat", "more words here", "Answers", "file.indd 3", "1/2/2020 4 PM", "What if? yes"]
    data = [(f"d{i % 7}", i, "\n".join(rng.choice(kinds[: 14 if i % 3 else 5] + ["plain"] * 6) for _ in range(rng.randint(0, 25)))) for i in range(200)]
    p = spark.createDataFrame(data, "document_id string, page_no int, text string")
    got = {(r.document_id, r.page_no): r.l for r in pages.kept_lines(p).where("filled").groupBy("document_id", "page_no").agg(F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("l")).collect()}
    for d, n, text in data:
        assert [x.line for x in got.get((d, n), [])] == plain_clean(text)


def test_clean_pages_and_headings(spark):
    rows = [("d", 1, "CHAPTER 1\n1.1 Heat and Light\nWarm things glow.\n\n\n\nThen cool."), ("d", 2, "More text."), ("d", 3, "CHAPTER TWO\nWords."), ("d", 4, "Chapter review\nx"), ("d", 5, None), ("e", 1, "1. a?\n2. b?\n3. c?\n4. d")]
    p = spark.createDataFrame(rows, "document_id string, page_no int, text string")
    clean = {(r.document_id, r.page_no): r.text for r in pages.clean_pages(p).collect()}
    assert clean["d", 1].endswith("Warm things glow.\n\nThen cool.") and clean["d", 4] == "" and clean["d", 5] == "" and clean["e", 1] == ""
    h = {r.page_no: (r.chapter, r.section) for r in pages.headings(p.where("document_id = 'd'")).collect()}
    assert h[1] == ("Chapter 1", "1.1 Heat and Light") and h[2] == h[1] and h[3] == ("Chapter Two", None) and h[5] == ("Chapter Two", None)


def test_content_range(spark):
    body = "Chapter 1\n" + "word " * 90
    texts = ["Title", "Contents\nChapter 1 ... 3", "Chapter 2 ... 9\nChapter 3 ... 12", body, "text", "Glossary\nx", "y"]
    p = spark.createDataFrame([("d", i + 1, t) for i, t in enumerate(texts)] + [("e", 1, "plain")], "document_id string, page_no int, text string")
    assert {r.document_id: (r.first_page, r.last_page) for r in pages.content_pages(p).collect()} == {"d": (4, 5), "e": (1, 1)}


@pytest.mark.parametrize("n", [0, 1, 180, 181, 330, 331, 1000])
def test_word_chunks(spark, n):
    w = [f"w{i}" for i in range(n)]
    p = spark.createDataFrame([("d", 3, " ".join(w[: n // 2])), ("d", 4, " ".join(w[n // 2 :]))], "document_id string, page_no int, text string")
    got = [r.text.split() for r in pages.chunk_words(p).orderBy("chunk_index").collect()]
    want, start = [], 0
    while w:
        want.append(w[start : start + 180])
        if start + 180 >= n:
            break
        start += 150
    assert got == want


def test_chunk_id_and_locator(spark):
    p = spark.createDataFrame([("d", 42, "a b"), ("d", 43, "c")], "document_id string, page_no int, text string")
    r = pages.chunk_words(p).first()
    assert r.chunk_id == "d_p0042-0043_00001_" + hashlib.sha1(b"d|[42, 43]|a b c").hexdigest()[:12]
    c = spark.createDataFrame([("T", "C", "C", [42, 43]), ("T", None, "S", [7]), ("T", "", "", [])], "title string, chapter string, section string, pages array<int>")
    assert [r[0] for r in c.select(pages.locator()).collect()] == ["T; C; pp. 42-43", "T; S; p. 7", "T"]


CHUNK = "chunk_id string, document_id string, text string, topics array<string>, chapter string, section string"


def plain_bm25(chunks, weights):
    import re
    from collections import Counter

    tok = lambda s: [t for t in re.findall("[a-z0-9]+", (s or "").lower()) if t not in T.RETRIEVAL_STOPWORDS and len(t) > 1]
    tfs, lens = {}, {}
    for c in chunks:
        body = tok(c[2])
        tf = Counter(body)
        for h in tok(" ".join(c[3] or [])) + tok(c[4]) + tok(c[5]):
            tf[h] += 2
        tfs[c[0]], lens[c[0]] = tf, max(1, len(body))
    n, avg = len(chunks), sum(lens.values()) / len(chunks)
    df = Counter(t for tf in tfs.values() for t in tf)
    out = {}
    for i, tf in tfs.items():
        hit = [t for t in weights if tf[t]]
        topic = [t for t in weights if weights[t] >= 3]
        need = 0 if not topic else 1 if len(topic) <= 2 else min(3, math.ceil(len(topic) / 3))
        if any(weights[t] >= 1 for t in hit) and sum(t in hit for t in topic) >= need:
            out[i] = sum(weights[t] * math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * lens[i] / avg)) for t in hit)
    return out


def test_bm25_with_pools_and_avoided(spark):
    rng = random.Random(2)
    vocab = ["aquifer", "groundwater", "water", "table", "rock", "moon", "storm", "the", "of"]
    rows = [(f"c{i:02d}", f"d{i % 3}", " ".join(rng.choices(vocab, k=rng.randint(1, 30))), rng.choice([None, ["aquifer"], []]), rng.choice([None, "Water"]), None) for i in range(60)]
    c = spark.createDataFrame(rows, CHUNK)
    s = spark.createDataFrame([("s", "earth_space", "Hydrology", "tossup", None, 3, ["groundwater aquifer"])], retrieve.SPEC)
    weights = {r.term: r.weight for r in retrieve.query_terms(s).collect()}
    assert weights["aquifer"] == 3.0 and weights["hydrology"] == 1.0 and weights["runoff"] == 0.25
    got = {r.chunk_id: r.score for r in retrieve.bm25(c, s).collect()}
    want = plain_bm25(rows, weights)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    pool = spark.createDataFrame([("s", "d0"), ("s", "d1")], "spec_id string, document_id string")
    avoid = spark.createDataFrame([("s", "c00"), ("s", "c03"), ("s", "c02")], "spec_id string, chunk_id string")
    got = {r.chunk_id: r.score for r in retrieve.bm25(c, s, pool, avoid).collect()}
    want = plain_bm25([r for r in rows if r[1] != "d2" and r[0] not in ("c00", "c03")], weights)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    assert retrieve.bm25(c.limit(0), s).count() == 0
    assert retrieve.facts(c, spark.createDataFrame([("n", "math", "zzz", "tossup", None, 3, ["qq ww ee rr"])], retrieve.SPEC)).count() == 0


def test_diverse_top_equals_greedy(spark):
    rng = random.Random(3)
    rows = [("g" + str(i % 2), f"i{i:03d}", rng.choice([1.0, 1.1, 1.2, 0.5]), rng.sample("abcdefgh", rng.randint(0, 5))) for i in range(120)]
    got = [(r.spec_id, r.id, r.place) for r in retrieve.diverse_top(spark.createDataFrame(rows, "spec_id string, id string, score double, t array<string>"), "id", "t", 4).orderBy("spec_id", "place").collect()]
    want = []
    for g in ("g0", "g1"):
        left, chosen = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1])), []
        for place in range(1, 5):
            jac = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b)) if set(a) | set(b) else 0.0
            best = max(left, key=lambda r: (r[2] - 0.25 * max([jac(r[3], c[3]) for c in chosen], default=0.0)))
            left.remove(best)
            chosen.append(best)
            want.append((g, best[1], place))
    assert got == want
    empty = spark.createDataFrame([], "spec_id string, id string, score double, t array<string>")
    assert retrieve.diverse_top(empty, "id", "t").count() == 0 and retrieve.diverse_top(empty, "id", "t", 0).count() == 0


def test_rules(spark):
    schema = "draft_id string, question struct<question_text:string,answer_text:string,answer_mode:string,choices:array<struct<label:string,text:string>>>"
    wxyz = [(x, f"t{x}") for x in "WXYZ"]
    d = spark.createDataFrame(
        [
            ("1", ("Why does it glow?", "ANSWER: heat", "short_answer", [])), ("2", ("Name the gas. It is light. Say it.", "gas", "short_answer", wxyz)), ("3", ("Which of the following is W) hot?", "ANSWER: W) tW", "multiple_choice", wxyz)),
            ("4", (None, None, "short_answer", [])), ("5", ("According to the textbook, why?", "ANSWER: because it is so.", "short_answer", [])),
        ],
        schema,
    )
    r = {x.draft_id: x for x in d.select("draft_id", verify.format_issues(d).alias("f"), verify.answer_issues(d).alias("a"), verify.style_issues(d).alias("s")).collect()}
    assert r["1"].f == [] and r["1"].a == [] and r["1"].s == []
    assert r["2"].f == ["missing_answer_prefix", "short_answer_has_choices", "non_interrogative_format"] and r["2"].s == ["reaction_speed_test", "answer_in_stem", "unnecessary_flavor_text"]
    assert r["3"].f == ["choices_embedded_in_question"]
    assert r["4"].f[:2] == ["missing_answer_prefix", "empty_question"] and "empty_answer" in r["4"].a
    assert r["5"].a == ["sentence_answer_for_short_answer", "source_material_meta"]


def test_jobs_and_drafts(spark):
    jobs = [generate.Job("math", 3), generate.Job("physics", 2, "Optics", "bonus", 4, ["lens"])]
    a, b = generate.expand_jobs(spark, jobs).collect(), generate.expand_jobs(spark, jobs).collect()
    assert a == b and len(a) == 5 and {r.subcategory for r in a[:3]} <= set(generate.POOLS["math"])
    with pytest.raises(ValueError):
        generate.Job("energy")
    with pytest.raises(ValueError):
        generate.Job("math", difficulty=9)
    assert jobs[1].job_id == "physics_optics_bonus_writer_selected_4" and jobs[0].job_id == "math_random_subcategory_random_question_type_writer_selected_random_difficulty"
    with pytest.raises(ValueError, match="required"):
        generate.job_of({"category": "math", "difficulty": 3})
    got = generate.with_model(spark.createDataFrame([("1", "p")], "id string, prompt string"), lambda: lambda p: p.upper()).first()
    assert got.reply == "P"


def test_batch_from_a_configuration(spark, tmp_path):
    q = [{"question_id": f"q{i}", "category": "physics", "question_type": "tossup", "subcategory": "Optics", "question_text": f"Why does lens {i} bend light?", "answer_text": "ANSWER: index", "style_tags": [], "source_metadata": {}, "source_id": "nsb_1"} for i in range(8)]
    c = [{"chunk_id": f"c{i}", "document_id": f"d{i % 2}", "text": f"A lens of kind {i} bends light by refraction.", "topics": ["optics"], "pages": [1]} for i in range(8)]
    for name, rows in (("q", q), ("c", c)):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(map(json.dumps, rows)))
    config = {"output_path": str(tmp_path / "out"), "style_questions_path": str(tmp_path / "q.jsonl"), "textbook_chunks_path": str(tmp_path / "c.jsonl"), "random_seed": 7, "jobs": [{"category": "physics", "subcategory": "Optics", "difficulty": 3, "count": 2, "topic_focus": ["lens"]}]}
    (tmp_path / "job.json").write_text(json.dumps(config))
    one, two = generate.run_config(spark, str(tmp_path / "job.json"))
    assert not set(one["facts"]) & set(two["facts"]) and not set(one["styles"]) & set(two["styles"]) and len(one["facts"]) == 3
    assert one["model"] == "heuristic" and one["question"]["answer_text"] == "ANSWER: lens" and one["verdict"] in ("pass", "revise")
    saved = spark.read.json(str(tmp_path / "out")).collect()
    assert sorted(r.draft_id for r in saved) == ["draft_spec_000001", "draft_spec_000002"]
    specs = generate.expand_jobs(spark, [generate.Job("physics", 1, "Optics", "bonus", 3, ["lens"])])
    chunks, questions = spark.read.json(str(tmp_path / "c.jsonl")).withColumns({"chapter": F.lit(None).cast("string"), "section": F.lit(None).cast("string")}), generate.files.read_jsonl(spark, str(tmp_path / "q.jsonl"), generate.schemas.QUESTION)
    reply = '{"draft":{"question":"Which of the following bends?","answer":"ANSWER: W) lens"},"choices":["W) lens","X) b","Y) c","Z) d"],"citation_chunk_ids":["zz"]}'
    good = generate.run_in_order(spark, specs, chunks, questions, writer=lambda s, b: reply)[0]
    assert good["model"] == "writer" and good["question"]["answer_mode"] == "multiple_choice" and good["verdict"] == "fail"  # no citation
    bad = generate.run_in_order(spark, specs, chunks, questions, writer=lambda s, b: 1 / 0)[0]
    assert bad["model"] == "fallback" and bad["question"]["question_text"].endswith("Z) option four")
    assert generate.Service.of("writer", {}) is None and generate.Service.of("writer", {"WRITER_MODEL": "m", "WRITER_URL": "u"}, timeout=5).timeout == 5.0
    v = generate.prompt_values(specs, generate.retrieve.bundles(chunks, questions, specs), chunks, questions).first()
    assert v.facts.startswith("- [c") and v.subcategory_guidance == "none" and v.answer_mode == "writer_selected"


def test_log_in_batch_and_stream(spark, tmp_path):
    rows = [("a", 1, 5.0), ("a", 3, None), ("b", 2, 1.0), ("c", 9, 2.0), (None, 1, 1.0)]
    df = spark.createDataFrame(rows, "key string, seq int, v double")
    gone = F.col("v").isNull()
    assert {r.key for r in log.latest(df, "key", ["seq"], gone).collect()} == {"b", "c"}
    src, out, cp = (f"file://{tmp_path / x}" for x in ("src", "out", "cp"))
    for part in (rows[1:2] + rows[2:3], rows[:1] + rows[3:4], [("c", 8, 7.0)]):  # the older write of a comes late
        spark.createDataFrame(part, df.schema).write.mode("append").parquet(src)
        log.upserts(spark.readStream.schema(df.schema).parquet(src), out, cp, "key", ["seq"]).awaitTermination()
    assert {r.key for r in log.view(spark, out, gone).collect()} == {"b", "c"}
    p = log.progress(df, spark.createDataFrame([("b",), ("zz",)], "key string"), "key").first()
    assert (p.total, p.reviewed) == (4, 1)
    assert log.progress(df, df.limit(0), "key", ["v"]).first().unscored == 1
    bad = spark.createDataFrame([(9, 1.0)], "difficulty int, quality double")
    with pytest.raises(Exception, match="whole number"):
        log.checked(bad).collect()


def test_spread_runs_nothing_and_cuts_are_removed(spark):
    df = spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count()
    done = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("spread", "spread")
    runtime.spread(df)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not done.getJobIdsForGroup("spread")
    assert runtime.spread(spark.range(10, numPartitions=1)).rdd.getNumPartitions() > 1
    one = runtime.cut(df)
    kept = runtime.cut(one.where("k > 2"))
    file = one._jdf.queryExecution().logical().rdd().getCheckpointFile().get()
    runtime.discard(one, df)
    assert not storage.exists(spark, file) and kept.count() == 4


def test_a_cluster_without_a_shared_folder_is_refused(spark):
    class Elsewhere:
        master = "spark://somewhere:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Elsewhere()

    with pytest.raises(RuntimeError, match="share"):
        runtime.checkpoint_dir(Session())
