"""Byte-pair encoding of whole texts with a public tokenizer file.

Each piece of the split pattern is encoded by a segment tree over the ranks of its adjacent pairs: the root holds the
leftmost pair of lowest rank, a merge changes three leaves, each in logarithmic time, until no pair can be merged.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from siltwork.runtime import spread

TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the split pattern that belongs to the vocabulary byte_bpe_50k.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE = 1 << 16
_NONE = 1 << 62


def read_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece. A leaf's value is rank * 2^32 + position, so the minimum at the root is the leftmost of the lowest rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    parts: list[bytes] = [piece[i : i + 1] for i in range(n)]
    size = 1 << max(1, (n - 1).bit_length())
    tree = [_NONE] * (2 * size)
    for i in range(n - 1):
        r = ranks.get(parts[i] + parts[i + 1])
        if r is not None:
            tree[size + i] = r << 32 | i
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a <= b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(i: int, value: int) -> None:
        k = size + i
        tree[k] = value
        k >>= 1
        while k:
            a, b = tree[2 * k], tree[2 * k + 1]
            low = a if a <= b else b
            if tree[k] == low:
                return
            tree[k] = low
            k >>= 1

    def rank_at(i: int) -> int:
        j = after[i]
        if j >= n:
            return _NONE
        r = ranks.get(parts[i] + parts[j])
        return _NONE if r is None else r << 32 | i

    while (top := tree[1]) < _NONE:
        i = top & 0xFFFFFFFF
        j = after[i]
        parts[i] += parts[j]
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        put(j, _NONE)
        put(i, rank_at(i))
        if before[i] >= 0:
            put(before[i], rank_at(before[i]))
    out, i = [], 0
    while i < n:
        out.append(ranks[parts[i]])
        i = after[i]
    return out


class Encoder:
    def __init__(self, raw: bytes) -> None:
        import regex

        self.ranks, self.split, self.known = read_ranks(raw), regex.compile(PATTERN), {}

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        known = self.known
        for piece in self.split.findall(text):
            ids = known.get(piece)
            if ids is None:
                ids = merge_piece(piece.encode("utf-8", "replace"), self.ranks)
                if len(known) >= CACHE:
                    known.clear()
                if len(piece) <= 64:
                    known[piece] = ids
            out += ids
        return out


def encode_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizers: str = TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """(id, ids array<int>) of every row. Null and empty texts give an empty list, blank ones their white space's ids.

    Repeated rows stay repeated, other columns are dropped (also such as are named `ids`), an empty table stays empty and
    texts of any length are encoded whole. The vocabulary file (0.8 MB, fixed) is sent to the executors.
    """
    spark = df.sparkSession
    raw = spark.sparkContext.broadcast(Path(tokenizers, f"{name}.tiktoken").read_bytes())
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = None
        for b in batches:
            encoder = encoder or Encoder(raw.value)
            ids = [np.asarray(encoder.encode(t), dtype=np.int32) for t in b["_text"]]
            yield pd.DataFrame({"_id": b["_id"], "ids": pd.Series(ids, index=b.index, dtype=object)})

    rows = spread(df.select(df[id_col].alias("_id"), df[text_col].alias("_text")))
    return rows.mapInPandas(run, f"_id {kind}, ids array<int>").withColumnRenamed("_id", id_col)
