"""Expansion of requests, recency, and drafts without an external model."""

from __future__ import annotations

import json
import random
import re
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork import storage
from siltwork.operators import replies, retrieve, verify
from siltwork.runtime import cut
from siltwork.sources import files, schemas

#: What is drawn from where a job leaves it open, categories that are not written, and how many uses are remembered.
POOLS = {"math": ["Algebra", "Calculus", "Combinatorics", "Geometry", "Number Theory"], "earth_space": ["Cosmology", "Hydrology", "Meteorology", "Observation", "Rocks and Minerals", "Solar System", "Stars", "Tectonics"]}
TYPES, DIFFICULTIES, CLOSED, RECENT = ["tossup", "bonus"], [1, 2, 3, 4, 5, 6, 7], ["energy"], 18
#: The placeholder choices of a draft without a model, and the words between its parts.
OPTIONS = {"W": "option one", "X": "option two", "Y": "option three", "Z": "option four"}
JOINED, ASKED = ". Using the grounded concept from ", ", answer this question: "


@dataclass
class Job:
    """A request for `count` drafts; what is None is drawn from its pool."""

    category: str
    count: int = 1
    subcategory: str | None = None
    question_type: str | None = None
    difficulty: int | None = None
    topics: list[str] = field(default_factory=list)
    pool: list[str] = field(default_factory=list)
    job_id: str = ""
    types: list[str] = field(default_factory=list)
    difficulties: list[int] = field(default_factory=list)
    must_use_sources: list[str] = field(default_factory=list)
    forbidden_topics: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        if self.category in CLOSED:
            raise ValueError(f"{self.category} is not written")
        self.subcategory = (self.subcategory or "").strip() or None
        self.pool = [x.strip() for x in self.pool if x.strip()]
        for d in [*([self.difficulty] if self.difficulty is not None else []), *self.difficulties]:
            if not 1 <= d <= 7:
                raise ValueError("difficulty must be 1 to 7")
        if self.subcategory is None and not (self.pool or self.category in POOLS):
            raise ValueError(f"no subcategories to draw from for {self.category}")
        if not self.job_id:
            parts = [self.category, self.subcategory or "random_subcategory", self.question_type or "random_question_type", "writer_selected", str(self.difficulty or "random_difficulty")]
            self.job_id = re.sub("[^a-z0-9]+", "_", "_".join(parts).lower()).strip("_")


def job_of(entry: dict) -> Job:
    """A job of a configuration; a field that is fixed (the default) must be given, a random one is drawn."""
    fixed = {f: entry.get(f"{f}_mode", "fixed") == "fixed" for f in ("subcategory", "question_type", "difficulty")}
    given = {"question_type": "tossup"} | {k: v for k, v in entry.items() if v is not None}
    for f, need in fixed.items():
        if need and not str(given.get(f, "")).strip():
            raise ValueError(f"{f} is required unless {f}_mode is random")
    pick = lambda f: given.get(f) if fixed[f] else None
    return Job(
        entry["category"], entry.get("count", 1), pick("subcategory"), pick("question_type"), pick("difficulty"), entry.get("topic_focus") or [], entry.get("subcategory_pool") or [], entry.get("job_id") or "",
        entry.get("question_type_pool") or [], [int(x) for x in entry.get("difficulty_pool") or []], entry.get("must_use_sources") or [], entry.get("forbidden_topics") or [],
    )


def load_config(spark: SparkSession, path: str) -> dict:
    """A batch's configuration, JSON, or YAML where its library is installed; its jobs are checked."""
    text = storage.read_text(spark, path)
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ModuleNotFoundError as e:
            raise RuntimeError("no YAML library here; give the configuration as JSON") from e
        got = yaml.safe_load(text) or {}
    else:
        got = json.loads(text)
    for need in ("output_path", "style_questions_path", "textbook_chunks_path", "jobs"):
        if need not in got:
            raise ValueError(f"the configuration lacks {need}")
    return got | {"jobs": [job_of(j) for j in got["jobs"]]}


SPECS = retrieve.SPEC + ", must_use_sources array<string>, forbidden_topics array<string>, job_id string, job_index int"


def expand_jobs(spark: SparkSession, jobs: list[Job], seed: int | None = 7) -> DataFrame:
    """One request per draft, in order. Draws follow one sequence of the standard generator, so they are made on the driver; jobs are few."""
    rng, rows = random.Random(seed), []
    for j in jobs:
        for i in range(j.count):
            sub = j.subcategory or rng.choice(j.pool or POOLS[j.category])
            kind = j.question_type or rng.choice(j.types or TYPES)
            level = j.difficulty or rng.choice(j.difficulties or DIFFICULTIES)
            rows.append((f"spec_{len(rows) + 1:06d}", j.category, sub, kind, None, level, j.topics or [sub], j.must_use_sources, j.forbidden_topics, j.job_id, i + 1))
    return spark.createDataFrame(rows, SPECS)


def drafts(specs: DataFrame, bundles: DataFrame, chunks: DataFrame, questions: DataFrame) -> DataFrame:
    """Deterministic drafts of a request's first style and first fact, by expressions.

    The answer's mode is that asked for, else four choices for a bonus. Placeholder choices stand in the text as well; citations hold
    the one fact used.
    """
    b = specs.join(bundles, "spec_id").withColumn("chunk_id", F.try_element_at("fact_chunks", F.lit(1))["chunk_id"]).withColumn("question_id", F.try_element_at("style_examples", F.lit(1))["question_id"])
    b = b.join(chunks.select("chunk_id", "text").dropDuplicates(["chunk_id"]), "chunk_id", "left").join(questions.select("question_id", F.col("question_text").alias("style")).dropDuplicates(["question_id"]), "question_id", "left")
    lead = F.substring(F.trim(F.substring_index(F.coalesce("style", F.lit("")), "?", 1)), 1, 80)
    fact = F.regexp_replace(F.substring(F.coalesce("text", F.concat(F.lit("a "), "subcategory", F.lit(" concept"))), 1, 220), r"\.+$", "")
    mode = F.coalesce("answer_mode", F.when(F.col("question_type") == "bonus", "multiple_choice").otherwise("short_answer"))
    mc = mode == "multiple_choice"
    options = F.array(*[F.struct(F.lit(a).alias("label"), F.lit(t).alias("text")) for a, t in OPTIONS.items()])
    none = F.array().cast("array<struct<label:string,text:string>>")
    listed = F.when(mc, "".join(f" {a}) {t}" for a, t in OPTIONS.items())).otherwise("")
    return b.select(
        "spec_id", F.concat(F.trim(F.concat(lead, F.lit(JOINED), "subcategory", F.lit(ASKED), fact, F.lit("."))), listed).alias("question_text"),
        F.when(mc, f"ANSWER: W) {OPTIONS['W']}").otherwise(F.concat(F.lit("ANSWER: "), F.coalesce(F.try_element_at("topic_focus", F.lit(1)), "subcategory"))).alias("answer_text"),
        mode.alias("answer_mode"), F.when(mc, options).otherwise(none).alias("choices"), F.array_compact(F.array("chunk_id")).alias("citations"),
    )


def written(replies_: DataFrame, fallback: DataFrame) -> DataFrame:
    """Drafts of a writer's replies (spec_id, reply, retrieved); the fallback draft where a reply is null or lacks a question or an answer.

    `model` tells which it is. Fields may lie in the object itself or in its `draft`, under either name; citations are those retrieved.
    """
    r = replies_.withColumn("j", replies.json_part(F.col("reply")))
    at = lambda n: F.coalesce(*[F.get_json_object("j", f"$.{p}{k}") for p in ("", "draft.") for k in (f"{n}_text", n)])
    ids = F.transform(F.coalesce(F.from_json(F.get_json_object("j", "$.citation_chunk_ids"), "array<string>"), F.array().cast("array<string>")), lambda x: F.trim(x))
    r = r.select("spec_id", F.trim(at("question")).alias("q"), F.trim(at("answer")).alias("a"), replies.choices(F.col("j")).alias("c"), replies.cited(ids, F.col("retrieved")).alias("ids"))
    j = fallback.join(r, "spec_id", "left")
    ok = F.col("q").isNotNull() & F.col("a").isNotNull()
    pick = lambda new, old: F.when(ok, new).otherwise(F.col(old)).alias(old)
    return j.select("spec_id", pick(F.col("q"), "question_text"), pick(F.col("a"), "answer_text"), pick(replies.answer_mode(F.col("q"), F.col("a"), F.col("c")), "answer_mode"), pick(F.col("c"), "choices"), pick(F.col("ids"), "citations"), F.when(ok, "writer").otherwise("fallback").alias("model"))


def as_drafts(specs: DataFrame, drafted: DataFrame, chunks: DataFrame) -> DataFrame:
    """Drafts in the form that the checks read, cited chunks with their documents."""
    docs = chunks.select("chunk_id", "document_id").dropDuplicates(["chunk_id"])
    cites = drafted.select("spec_id", F.explode("citations").alias("chunk_id")).join(docs, "chunk_id").groupBy("spec_id").agg(F.collect_list(F.struct(F.col("document_id").alias("source_id"), "chunk_id")).alias("citations"))
    j = specs.join(drafted.drop("citations").withColumnRenamed("answer_mode", "mode"), "spec_id").join(cites, "spec_id", "left")
    q = F.struct("category", "subcategory", "question_type", F.col("mode").alias("answer_mode"), "difficulty", "question_text", "answer_text", "choices")
    none = F.array().cast("array<struct<source_id:string,chunk_id:string>>")
    return j.select(F.concat(F.lit("draft_"), "spec_id").alias("draft_id"), "spec_id", q.alias("question"), F.coalesce("citations", none).alias("citations"), "topic_focus", F.lit(None).cast("timestamp").alias("loaded_at"))


def run_in_order(spark: SparkSession, specs: DataFrame, chunks: DataFrame, questions: DataFrame, memory: int = RECENT, out: str | None = None, writer: Callable[[dict, dict], str | None] | None = None, **of) -> list[dict]:
    """Bundle, draft and verdict of requests one after the other, each without what the last `memory` facts and styles used: a sequence by definition.

    The loop is over requests, which are few; each step is a distributed query. A `writer` gives a reply for (request, bundle); where it
    fails the draft without a model stands. Each record is appended to `out` before the next request begins.
    """
    facts_used, styles_used, records = deque(maxlen=memory), deque(maxlen=memory), []
    used = lambda s, ids, name: spark.createDataFrame([(s.spec_id, c) for c in ids], f"spec_id string, {name} string") if ids else None
    for s in specs.orderBy("spec_id").collect():
        one = spark.createDataFrame([s], specs.schema)
        bundle = cut(retrieve.bundles(chunks, questions, one, avoid=used(s, facts_used, "chunk_id"), avoid_styles=used(s, styles_used, "question_id"), **of))
        b = bundle.first()
        drafted = drafts(one, bundle, chunks, questions)
        if writer is None:
            drafted = drafted.withColumn("model", F.lit("heuristic"))
        else:
            try:
                reply = writer(s.asDict(recursive=True), b.asDict(recursive=True))
            except Exception:  # noqa: BLE001  a service may fail in any way
                reply = None
            drafted = written(spark.createDataFrame([(s.spec_id, reply, [f["chunk_id"] for f in b.fact_chunks])], "spec_id string, reply string, retrieved array<string>"), drafted)
        drafted = cut(drafted)
        d = as_drafts(one, drafted, chunks)
        v = verify.verdicts(d, chunks, questions)
        row = d.join(v.drop("category", "question_type"), "draft_id").join(drafted.select("spec_id", "model"), "spec_id").join(bundle, "spec_id").drop("loaded_at", "topic_focus")
        row = cut(row.withColumn("spec", F.from_json(F.lit(json.dumps(s.asDict(recursive=True))), specs.schema)))
        if out is not None:
            files.append_jsonl(row, out, s.spec_id)
        facts_used.extend(f["chunk_id"] for f in b.fact_chunks)
        styles_used.extend(x["question_id"] for x in b.style_examples)
        got = row.first()
        records.append({"spec_id": s.spec_id, "facts": [f["chunk_id"] for f in b.fact_chunks], "styles": [x["question_id"] for x in b.style_examples], "verdict": got.verdict, "model": got.model, "question": got.question.asDict(recursive=True)})
    return records


def run_config(spark: SparkSession, path: str, **of) -> list[dict]:
    """A whole batch from its configuration: the records, also appended one by one to its output, which is emptied first."""
    c = load_config(spark, path)
    questions, chunks = files.read_jsonl(spark, c["style_questions_path"], schemas.QUESTION), files.load_chunks(spark, c["textbook_chunks_path"])
    storage.remove(spark, c["output_path"])
    return run_in_order(spark, expand_jobs(spark, c["jobs"], c.get("random_seed")), chunks, questions, out=c["output_path"], **of)


def prompt_values(specs: DataFrame, bundles: DataFrame, chunks: DataFrame, questions: DataFrame) -> DataFrame:
    """What a writer's template is filled with, by request: its own fields, hints of the subcategory, facts and styles as lists."""
    text = bundles.select("spec_id", F.posexplode("fact_chunks").alias("i", "f")).join(chunks.select(F.col("chunk_id").alias("_c"), "text").dropDuplicates(["_c"]), F.col("f.chunk_id") == F.col("_c"))
    ordered = lambda d, name: d.groupBy("spec_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "line"))), lambda x: x["line"]).alias(name))
    facts = ordered(text.select("spec_id", "i", F.concat(F.lit("["), "_c", F.lit("] "), "text").alias("line")), "facts")
    q = questions.select(F.col("question_id").alias("_q"), "question_text", "answer_text").dropDuplicates(["_q"])
    styles = bundles.select("spec_id", F.posexplode("style_examples").alias("i", "s")).join(q, F.col("s.question_id") == F.col("_q"))
    styles = ordered(styles.select("spec_id", "i", F.concat(F.lit("["), "_q", F.lit("] "), "question_text", F.lit("\n  "), "answer_text").alias("line")), "styles")
    j = specs.join(facts, "spec_id", "left").join(styles, "spec_id", "left")
    listed = lambda c: F.coalesce(F.nullif(F.array_join(c, ", "), F.lit("")), F.lit("none"))
    return j.select(
        "spec_id", "category", "subcategory", listed(retrieve.guidance_terms(F.col("subcategory"))).alias("subcategory_guidance"), "question_type", F.coalesce("answer_mode", F.lit("writer_selected")).alias("answer_mode"), "difficulty",
        listed(F.col("topic_focus")).alias("topic_focus"), replies.bullets(F.col("facts")).alias("facts"), replies.bullets(F.col("styles")).alias("styles"),
    )


@dataclass
class Service:
    """A chat service by the usual interface over HTTP. `settings` are read from names such as WRITER_MODEL, given ones go before."""

    url: str
    model: str
    key: str | None = None
    timeout: float = 120.0
    temperature: float = 0.2

    @classmethod
    def of(cls, role: str, settings: dict[str, str], **given: object) -> Service | None:
        """The service of a role (`writer`, `verifier`), or None without a model: the rules alone do then."""
        read = {k: given.get(k) or settings.get(f"{role}_{k}".upper()) for k in ("url", "model", "key", "timeout")}
        if not read["model"] or not read["url"]:
            return None
        return cls(str(read["url"]), str(read["model"]), read["key"], float(read["timeout"] or 120))

    def ask(self, system: str, user: str) -> str:
        from urllib import request

        body = {"model": self.model, "temperature": self.temperature, "messages": [{"role": "system", "content": system}, {"role": "user", "content": user}]}
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        call = request.Request(self.url.rstrip("/") + "/chat/completions", json.dumps(body).encode(), headers)
        with request.urlopen(call, timeout=self.timeout) as got:
            return json.loads(got.read())["choices"][0]["message"]["content"]


def with_model(prompts: DataFrame, client: Callable[[], Callable[[str], str]], retries: int = 2) -> DataFrame:
    """(id, reply) of (id, prompt) by an external model: one client per task, failed calls tried again, then a null reply."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = client()
        for b in batches:
            replies = []
            for p in b["prompt"]:
                reply = None
                for _ in range(retries + 1):
                    try:
                        reply = ask(p)
                        break
                    except Exception:  # noqa: BLE001, S112  a service may fail in any way
                        continue
                replies.append(reply)
            yield pd.DataFrame({"id": b["id"], "reply": replies})

    return prompts.select("id", "prompt").mapInPandas(run, "id string, reply string")
