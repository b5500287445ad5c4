"""Replies of external models: JSON out of fences, choices of many shapes, cited chunks, issues merged with the rules'."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltwork.functions import text as T

#: Names under which a reply may give a choice's label and text.
LABELS, TEXTS = ["label", "choice_label", "option", "letter"], ["text", "choice_text", "value", "answer"]


def json_part(reply: Column) -> Column:
    """The reply without code fences, or null if that isn't a JSON object."""
    bare = F.trim(F.regexp_replace(F.trim(reply), r"(?s)^```[a-zA-Z]*\s*|\s*```$", ""))
    return F.when(F.json_object_keys(bare).isNotNull(), bare)


def _named(e: Column, names: list[str]) -> Column:
    return F.coalesce(*[F.get_json_object(e, f"$.{n}") for n in names])


def choices(reply: Column) -> Column:
    """array<struct<label,text>> of `$.choices`: "X) text" strings, objects with a label and a text under any known name, or {"X": text}."""
    items = F.coalesce(F.from_json(F.get_json_object(reply, "$.choices"), "array<string>"), F.array().cast("array<string>"))

    def one(e: Column) -> Column:
        key = F.try_element_at(F.json_object_keys(e), F.lit(1))
        pair = F.map_values(F.from_json(e, "map<string,string>"))
        plain = r"^\s*\(?([A-Za-z])[).:]\s*(.*)$"
        label = F.when(key.isNull(), F.regexp_extract(e, plain, 1)).otherwise(F.coalesce(_named(e, LABELS), key))
        body = F.when(key.isNull(), F.regexp_extract(e, plain, 2)).otherwise(F.coalesce(_named(e, TEXTS), F.try_element_at(pair, F.lit(1))))
        return F.struct(F.upper(F.trim(label)).alias("label"), T.squeeze(body).alias("text"))

    return F.transform(items, one)


def answer_mode(question: Column, answer: Column, options: Column, asked: Column | None = None, question_type: Column | None = None) -> Column:
    """multiple_choice if there are choices, the question says so or the answer names a letter; else what was asked for, else by type."""
    mc = (F.size(options) > 0) | F.lower(question).contains("which of the following") | F.lower(answer).rlike(r"^\s*answer:\s*[w-z]\)")
    by_type = F.when(question_type == "bonus", "multiple_choice").otherwise("short_answer") if question_type is not None else F.lit("short_answer")
    return F.when(mc, "multiple_choice").otherwise(F.coalesce(asked, by_type) if asked is not None else by_type)


def cited(ids: Column, retrieved: Column) -> Column:
    """The retrieved chunk ids that the reply names, each once, in the order of retrieval."""
    return F.filter(F.array_distinct(retrieved), lambda c: F.array_contains(ids, c))


def merged(rules: Column, model: Column | None) -> Column:
    """Issues of the rules, then those of the model that they lack; a model that failed (null) changes nothing."""
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(rules, none), F.coalesce(model, none))) if model is not None else rules


def rendered(template: str, **columns: Column) -> Column:
    """The template with each {name} replaced by its column; null and empty values read `- none`."""
    out = F.lit(template)
    for name, c in columns.items():
        text = c.cast("string")
        out = F.replace(out, F.lit("{" + name + "}"), F.when(F.coalesce(F.trim(text), F.lit("")) == "", "- none").otherwise(text))
    return out


def bullets(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), x)), "\n")
