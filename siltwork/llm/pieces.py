"""Splitting long texts at natural boundaries by range-maximum queries over boundary strengths."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.runtime import spread

MAX_WORDS, OVERLAP = 180, 30
#: Boundary strengths, strongest first: paragraph end, page end, sentence end, clause end, any word.
PARAGRAPH, PAGE, SENTENCE, CLAUSE, WORD = 4, 4, 3, 1, 0
_WORD = re.compile(r"\S+")
_SENTENCE = re.compile(r"[.!?。！？…][\"'”’»)\]]*$")
_ABBREVIATION = re.compile(r"^(?:[A-Z]|Dr|Mr|Mrs|Ms|St|Fig|No|vs|etc|e\.g|i\.e|cf|pp?|pg)\.$")
_PAGE_MARK = re.compile(r"^\W*(?:page\s*|pg?\.?\s*)?(\d{1,5})(?:\s+of\s+\d+)?\W*$", re.IGNORECASE)


def strengths(text: str, spans: list[tuple[int, int]]) -> np.ndarray:
    """Strength of the boundary after each word."""
    out = np.zeros(len(spans), dtype=np.int8)
    for i, (a, b) in enumerate(spans):
        gap = text[b : spans[i + 1][0]] if i + 1 < len(spans) else "\n\n"
        if "\f" in gap:
            out[i] = PAGE
        elif gap.count("\n") >= 2 or gap.count("\r") >= 2 and "\n" not in gap:
            out[i] = PARAGRAPH
        else:
            w = text[a:b]
            if _SENTENCE.search(w) and not _ABBREVIATION.match(w):
                out[i] = SENTENCE
            elif w[-1] in ",;:":
                out[i] = CLAUSE
    return out


class RangeMaximum:
    """Sparse table; a query gives the rightmost position of the greatest value in [low, high]."""

    def __init__(self, values: np.ndarray) -> None:
        n = len(values)
        # value and position in one key: the greatest key is the strongest boundary, the rightmost of equals
        self.rows = [values.astype(np.int64) * (n + 1) + np.arange(n)]
        self.n, step = n, 1
        while 2 * step <= n:
            last = self.rows[-1]
            self.rows.append(np.maximum(last[: len(last) - step], last[step:]))
            step *= 2

    def best(self, low: int, high: int) -> int:
        k = (high - low + 1).bit_length() - 1
        row = self.rows[k]
        return int(max(row[low], row[high - (1 << k) + 1]) % (self.n + 1))


def cuts(strength: np.ndarray, size: int = MAX_WORDS, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """Pieces [first, end) of words, each at most `size` long, the next beginning `overlap` words before the end of the last."""
    n = len(strength)
    if n == 0:
        return []
    if n <= size:
        return [(0, n)]
    index, out, first = RangeMaximum(strength), [], 0
    least = max(overlap + 1, size // 2)  # shorter pieces wouldn't pay for their overlap
    while n - first > size:
        end = index.best(first + least - 1, first + size - 1) + 1
        out.append((first, end))
        first = end - overlap
    out.append((first, n))
    return out


def page_bounds(text: str, spans: list[tuple[int, int]], pages: list[int]) -> list[tuple[int, int]]:
    """For each word the lowest and the highest index of `pages` it may lie on, by form feeds and page numbers on their own lines.

    A number of a page stands at that page's head or foot: words before it lie no later, words after it no earlier.
    """
    n, k = len(spans), len(pages)
    low, high = np.zeros(n, dtype=np.int64), np.full(n, k - 1, dtype=np.int64)
    if k < 2 or n == 0:
        return list(zip(low.tolist(), high.tolist(), strict=True))
    starts = np.asarray([a for a, _ in spans])
    where = {p: i for i, p in enumerate(pages)}
    at = 0
    for line in re.split(r"([\n\f])", text):
        if (m := _PAGE_MARK.match(line.strip())) and int(m[1]) in where:
            w, p = int(np.searchsorted(starts, at)), where[int(m[1])]
            high[:w] = np.minimum(high[:w], p)
            low[w:] = np.maximum(low[w:], p)
        at += len(line)
    feeds = [m.start() for m in re.finditer("\f", text)]
    if len(feeds) == k - 1:  # one for each turn of a page
        for i, f in enumerate(feeds):
            w = int(np.searchsorted(starts, f))
            high[:w], low[w:] = np.minimum(high[:w], i), np.maximum(low[w:], i + 1)
    return [(a, b) if a <= b else (0, k - 1) for a, b in zip(low.tolist(), high.tolist(), strict=True)]


def split_text(text: str | None, pages: list[int] | None = None, size: int = MAX_WORDS, overlap: int = OVERLAP) -> list[tuple[int, int, int, str, list[int]]]:
    """(first word, end word, strength of its last boundary, text, pages) of each piece, in order."""
    if not text:
        return []
    spans = [m.span() for m in _WORD.finditer(text)]
    strength, pages = strengths(text, spans), sorted({int(p) for p in pages if p is not None}) if pages is not None else []
    bounds = page_bounds(text, spans, pages)
    out = []
    for a, b in cuts(strength, size, overlap):
        on = pages[min(x for x, _ in bounds[a:b]) : max(y for _, y in bounds[a:b]) + 1] if pages else []
        out.append((a, b, int(strength[b - 1]), text[spans[a][0] : spans[b - 1][1]], on))
    return out


SCHEMA = "chunk_id string, piece_no int, pieces int, first_word int, end_word int, words int, boundary int, text string, pages array<int>"


def split_chunks(df: DataFrame, size: int = MAX_WORDS, overlap: int = OVERLAP) -> DataFrame:
    """Pieces of every chunk of at most `size` words, the overlap of consecutive ones being exactly `overlap` words.

    `df` has chunk_id, text, pages; other columns are ignored, whatever their names. Null, empty and blank texts have no
    piece, texts within the limit one. Rows that deliver a chunk again with the same text and pages are one row; an id with
    two texts gives the pieces of both. Null or empty pages give an empty list, and a null id stays null.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be less than size")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for cid, text, pages in zip(b["chunk_id"], b["text"], b["pages"], strict=True):
                got = split_text(text, None if pages is None else list(pages), size, overlap)
                out += [(cid, i + 1, len(got), a, e, e - a, s, t, p) for i, (a, e, s, t, p) in enumerate(got)]
            yield pd.DataFrame(out, columns=[x.split()[0] for x in SCHEMA.split(", ")])

    rows = df.select("chunk_id", "text", "pages").distinct()
    return spread(rows).mapInPandas(run, SCHEMA)


def oversized(df: DataFrame, size: int = MAX_WORDS, overlap: int = OVERLAP) -> DataFrame:
    """chunk_id, once each, of the chunks that had to be cut."""
    return split_chunks(df, size, overlap).where((F.col("piece_no") == 1) & (F.col("pieces") > 1)).select("chunk_id").distinct()
