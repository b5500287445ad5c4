"""Command line: `python -m siltwork.cli COMMAND ...`; every command is one plan over files."""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from pyspark.sql import SparkSession

from siltwork.operators import generate
from siltwork.plans import ingest
from siltwork.sources import files, schemas, workbooks


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="siltwork")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, *args: str, **options: object) -> None:
        c = sub.add_parser(name)
        for a in args:
            c.add_argument(a, nargs="+" if a == "questions_in" else None)
        for k, v in options.items():
            c.add_argument("--" + k.replace("_", "-"), default=v, type=type(v) if v is not None else str)

    add("ingest-book", "input", "output", document_id=None, first=0, last=0, max_words=180, overlap_words=30)
    add("ingest-corpus", "manifest", "folder", "output", version="v1")
    add("validate-questions", "input")
    add("rewrite-questions", "input", "output")
    add("generate", "config")
    add("questions-from-csv", "input", "output", source_id="set")
    add("questions-from-workbooks", "input", "output", source_id="set")
    add("ratings-from-csv", "input", "questions", "output", tournament=None)
    add("sheet-ratings", "input", "questions", "output")
    add("export", "output", "questions_in", profile="mit_recent_plus_nsb", reviews=None, held_out=None, seed=42, validation=0.05, test=0.05)
    add("check-export", "input")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    said: object = "done"
    if a.command == "ingest-book":
        p = files.read_pages(spark, a.input)
        files.write_jsonl(ingest.chunks_of(p, a.first or None, a.last or None, a.max_words, a.overlap_words), a.output)
    elif a.command == "ingest-corpus":
        said = {r.document_id: r.chunks for r in ingest.corpus(spark, a.folder, json.loads(Path(a.manifest).read_text()), a.output, version=a.version).collect()}
    elif a.command == "validate-questions":
        said = files.valid_questions(files.read_jsonl(spark, a.input, schemas.QUESTION)).count()
    elif a.command == "rewrite-questions":
        said = files.rewrite_questions(spark, a.input, a.output)
    elif a.command == "questions-from-csv":
        files.write_jsonl(files.questions_from_tables(files.read_table(spark, a.input), a.source_id), a.output)
    elif a.command == "questions-from-workbooks":
        got = workbooks.read_workbooks(spark, a.input, a.source_id)
        for name, df in got.items():
            files.write_jsonl(df, f"{a.output}/{name}")
        said = [r.asDict() for r in got["summary"].collect()]
    elif a.command == "ratings-from-csv":
        files.write_jsonl(files.reviews_from_tables(files.read_table(spark, a.input), spark.read.json(a.questions), a.tournament), a.output)
    elif a.command == "sheet-ratings":
        files.write_jsonl(files.sheet_ratings(files.read_table(spark, a.input), spark.read.json(a.questions)), a.output)
    elif a.command == "generate":
        said = generate.run_config(spark, a.config)
    elif a.command == "export":
        out = ingest.clean_export(spark, a.questions_in, [a.reviews] if a.reviews else [], a.output, a.profile, a.held_out, seed=a.seed, validation=a.validation, test=a.test)
        said = {r.reason: r.n for r in out.collect()}
    else:
        said = ingest.check_export(spark, a.input)
    print(json.dumps(said, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
