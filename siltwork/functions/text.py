"""Text and number expressions; all but `repair_mojibake` stay in the JVM."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: The white space that is normalised, as a Java character class.
WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
#: Words left out of retrieval, and of near fingerprints.
RETRIEVAL_STOPWORDS = "a an and are as at be by for from has in is it its of on or that the these this to was were which with".split()
NEAR_STOPWORDS = "a an and are as at be by for from how in is it of on or that the these this to what when which who why with following".split()
#: Letters that case folding turns into several.
FOLDED = {"ß": "ss", "ſ": "s", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}


def squeeze(c: Column) -> Column:
    """White space as single blanks, none at the ends; null stays null."""
    return F.trim(F.regexp_replace(c, WS + "+", " "))


def casefold(c: Column) -> Column:
    out = F.lower(c)
    for a, b in FOLDED.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(squeeze(c)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def runs(c: Column) -> Column:
    """Runs of a-z and 0-9 of the case-folded text, in order, repeated ones kept."""
    return F.regexp_extract_all(casefold(c), F.lit("([a-z0-9]+)"), 1)


def _without(words: Column, stop: list[str]) -> Column:
    listed = F.array(*map(F.lit, stop))
    return F.filter(words, lambda w: ~F.array_contains(listed, w))


def retrieval_tokens(c: Column) -> Column:
    return F.filter(_without(runs(c), RETRIEVAL_STOPWORDS), lambda w: F.length(w) > 1)


def near_tokens(c: Column) -> Column:
    return _without(runs(c), NEAR_STOPWORDS)


def words(c: Column) -> Column:
    return F.filter(F.split(c, WS + "+"), lambda w: w != "")


def token_count(c: Column) -> Column:
    return F.greatest(F.lit(1), F.size(words(c)))


def overlap(asked: Column, text_terms: Column) -> Column:
    """Share of the distinct asked terms that the text has; 0 without any asked."""
    n = F.size(F.array_distinct(asked))
    return F.when(n > 0, F.size(F.array_intersect(asked, text_terms)) / n).otherwise(F.lit(0.0))


def jaccard(a: Column, b: Column) -> Column:
    n = F.size(F.array_union(a, b))
    return F.when(n > 0, F.size(F.array_intersect(a, b)) / n).otherwise(F.lit(0.0))


def guidance(c: Column) -> Column:
    """Parts between semicolons, without blank ones."""
    return F.filter(F.transform(F.split(squeeze(c), ";"), lambda x: F.trim(x)), lambda x: x != "")


def year_in(*texts: Column) -> Column:
    """The first 20xx that no digit touches, of the first text that has one."""
    found = [F.nullif(F.regexp_extract(t, r"(?<!\d)(20\d{2})(?!\d)", 1), F.lit("")) for t in texts]
    return F.coalesce(*found).cast("int")


def to_double(c: Column) -> Column:
    """A number, or null for blanks, marks of failed formulas and anything else."""
    return F.when(F.trim(c).rlike(r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"), F.trim(c).try_cast("double"))


def to_int(c: Column) -> Column:
    return to_double(c).cast("int")


def within(c: Column, low: float, high: float) -> Column:
    return F.when(c.between(low, high), c)


def half_up(c: Column, low: int = 1, high: int = 7) -> Column:
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), F.floor(c + 0.5))).cast("int"))


def half_even(c: Column) -> Column:
    return F.bround(c).cast("int")


def to_time(c: Column) -> Column:
    """ISO time, Z and offsets understood, others taken as UTC (the session's zone); null if it isn't one."""
    return F.try_to_timestamp(c)


def to_flag(c: Column) -> Column:
    return F.when(c.isNotNull(), F.lower(F.trim(c)).isin("1", "true", "yes"))


def column_number(letters: Column) -> Column:
    """A=1 .. Z=26, AA=27 .."""
    digits = F.transform(F.split(F.upper(letters), ""), lambda x: F.ascii(x) - 64)
    return F.aggregate(digits, F.lit(0), lambda a, d: a * 26 + d)


def hash_share(text: Column) -> Column:
    """The first 64 bits of the text's SHA-256 as a share of 2^64."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(float(1 << 64))


def _repair(text: str | None) -> str | None:
    if text is None:
        return None

    def back(m: re.Match) -> str:
        try:
            return m[0].encode("cp1252").decode("utf-8")
        except UnicodeError:
            return m[0]

    return unicodedata.normalize("NFKC", re.sub("Ã.|Â.|â..|ï..", back, text))


@F.pandas_udf(StringType())
def repair_mojibake(texts: pd.Series) -> pd.Series:
    """UTF-8 that was read as cp1252, put right where it decodes, then NFKC, for which Spark has no function."""
    return texts.map(_repair)
