"""Held-out texts in a corpus by a distributed positional inverted index."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.runtime import cut, small, spread

#: An item leaked if a document holds this share of its words in order (half, less a word changed at an edge).
SHARE = 0.48
#: A cover is made of stock phrases and chance if fewer phrases of RUN unchanged words than this share of its words are the item's own,
#: which are those found in at most STOCK of the items, or in two.
OWN, STOCK = 0.3, 0.02
#: Words of a remark between two parts; equal words in a row that a run has, which is also the length of the indexed phrases.
REMARK, RUN = 40, 3
#: Tables of phrases, items and candidates up to this number of rows (some 50 MB) are broadcast; greater ones are joined by a shuffle.
SENT = 500_000


def terms(text: Column) -> Column:
    """Lower-cased runs of letters and digits, without markup tags and characters that aren't visible."""
    bare = F.regexp_replace(F.regexp_replace(text, r"</?[a-zA-Z][a-zA-Z0-9:-]*+(?:[\s/][^<>]*+)?>", " "), "[­​-‏⁠﻿]", "")
    return F.regexp_extract_all(F.lower(bare), F.lit(r"([\p{L}\p{N}]+)"), 1)


def phrases_of(df: DataFrame, key: str) -> DataFrame:
    """(key, pos, phrase) of every run of RUN words."""
    words = df.select(key, terms(F.col("text")).alias("w"))
    rows = words.select(key, F.posexplode(F.arrays_zip(*[F.slice("w", k + 1, F.size("w")).alias(f"w{k}") for k in range(RUN)])).alias("pos", "p"))
    return rows.where(F.col("p")[f"w{RUN - 1}"].isNotNull()).select(key, "pos", F.concat_ws(" ", *[F.col("p")[f"w{k}"] for k in range(RUN)]).alias("phrase"))


def postings(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(phrase, doc_id, pos) of the phrases in `vocabulary`, kept in the shared folder. A small vocabulary is sent to the scan, so that only its postings are ever shuffled."""
    return cut(phrases_of(spread(docs.select("doc_id", "text")), "doc_id").join(small(vocabulary, SENT), "phrase"))


def _covered(doc: list[str], item: list[str], own: set[int], diagonals: list[int]) -> tuple[float, float, float, int]:
    """Best in-order cover of `item` by runs in `doc`: (share of words, own phrases per word of it, share of words in the longest run, first position).

    `own` are the offsets of the item's own phrases. `diagonals` are the places of the item's phrases in the document less
    those in the item; no run lies on another one. Changed words inside a run count as its words.
    """
    runs = []  # (first offset, end offset, diagonal, equal offsets); a run may skip two changed words in a row, and needs RUN equal words in a row
    for d in diagonals:
        offs = [o for o in range(max(0, -d), min(len(item), len(doc) - d)) if doc[d + o] == item[o]]
        if len(offs) < RUN:
            continue
        equal, streak, longest = [offs[0]], 1, 1
        for o in [*offs[1:], 1 << 30]:
            if o - equal[-1] <= RUN:
                streak = streak + 1 if o == equal[-1] + 1 else 1
                longest = max(longest, streak)
                equal.append(o)
            else:
                if longest >= RUN:
                    runs.append((equal[0], equal[-1] + 1, d, equal))
                equal, streak, longest = [o], 1, 1
    runs.sort(key=lambda r: r[:3])
    # runs of a chain lie near each other, so only those on diagonals within reach are looked at, however many there are
    order = sorted({d for _, _, d, _ in runs})
    on: dict[int, list[int]] = {d: [] for d in order}
    best: list[tuple[int, int, int]] = []  # words and own phrases of the best chain that ends in a run, and its first position
    words, phrases, at = 0, 0, 0
    for i, (a, b, d, equal) in enumerate(runs):
        same = set(equal)
        held = [o for o in equal if o in own and all(o + k in same for k in range(1, RUN))]
        length, kept, start = b - a, len(held), a + d
        for j in (j for d2 in order[bisect_left(order, d - REMARK) : bisect_right(order, d + len(item) // 2)] for j in on[d2]):
            a2, b2, d2, _ = runs[j]
            if a2 < a and b2 < b and a2 + d2 < a + d and b2 + d2 < b + d and d - d2 <= REMARK and d2 - d <= len(item) // 2:
                first = max(a, b2, b2 + d2 - d)
                more = best[j][0] + b - first, best[j][1] + sum(o >= first for o in held)
                if first < b and sum(more) > length + kept:
                    (length, kept), start = more, best[j][2]
        best.append((length, kept, start))
        on[d].append(i)
        if length + kept > words + phrases:
            words, phrases, at = length, kept, start
    n = max(1, len(item))
    return words / n, phrases / max(1, words), max((b - a for a, b, _, _ in runs), default=0) / n, at


def item_phrases(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """phrases (item_id, off, phrase, own) and texts (item_id, item, offsets of its own phrases) of the items, both kept.

    Counted over the items, so no number of leaked copies in documents moves `own`. An id with several texts has the greatest.
    """
    rows = items.where("item_id is not null and text is not null").groupBy("item_id").agg(F.max("text").alias("text"))
    rows = rows.where(F.size(terms(F.col("text"))) > 0)
    p = phrases_of(rows, "item_id").withColumnRenamed("pos", "off")
    df = p.select("item_id", "phrase").distinct().groupBy("phrase").agg(F.count(F.lit(1)).alias("df"))
    n = rows.count()
    phrases = cut(p.join(df, "phrase").select("item_id", "off", "phrase", (F.col("df") <= max(2, STOCK * n)).alias("own")))
    own = phrases.where("own").groupBy("item_id").agg(F.collect_set("off").alias("offsets"))
    texts = rows.select("item_id", terms(F.col("text")).alias("item")).join(own, "item_id", "left")
    return phrases, cut(texts.select("item_id", "item", F.coalesce("offsets", F.array().cast("array<int>")).alias("offsets")))


def candidates(docs: DataFrame, phrases: DataFrame, least: DataFrame) -> DataFrame:
    """(doc_id, item_id, diagonals) of the documents that hold enough own phrases of an item for a cover of SHARE, kept.

    phrases is (item_id, off, phrase, own), least (item_id, least) the number of own phrases; as a cover needs so many, none is missed.
    The own phrases are the rarest of an item: their postings are intersected first, the others' join only where enough of those met.
    """
    index = postings(docs, cut(phrases.select("phrase").distinct()))
    asked = small(phrases, SENT)
    own = index.join(asked.where("own"), "phrase").groupBy("doc_id", "item_id").agg(F.countDistinct("off").alias("held"))
    found = own.join(small(least, SENT), "item_id").where("held >= least").select("doc_id", "item_id")
    hits = index.join(asked, "phrase").join(found, ["doc_id", "item_id"], "left_semi")
    return cut(hits.groupBy("doc_id", "item_id").agg(F.collect_set(F.col("pos") - F.col("off")).alias("diagonals")))


def leaks(docs: DataFrame, items: DataFrame, share: float = SHARE, least: float = OWN) -> DataFrame:
    """(doc_id, item_id, share, own, run_share, first_word, exact) of each document that holds at least `share` of an item's words.

    Words count in order, as one passage or as parts with a short remark between, changed words inside a run included; a run
    needs RUN equal words in a row and the cover `least` own phrases per word, so shared names and stock phrases don't add up. `exact` marks unbroken whole items. Null
    and empty texts match nothing, items without a word are left out, copies of documents are each reported, an id that
    occurs twice is reported once, and the columns other than doc_id, item_id and text may have any name. Only documents with
    candidates are read again: their ids are sent to the scan while there are few, else joined.
    """
    docs = docs.where("doc_id is not null and text is not null and text <> ''").select("doc_id", "text")
    phrases, texts = item_phrases(items)
    enough = cut(texts.select("item_id", F.ceil(F.size("item") * share * least - 1e-9).cast("int").alias("least")))
    found = candidates(docs, phrases, enough)
    ids = cut(found.select("doc_id").distinct())
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {items.schema['item_id'].dataType.simpleString()}, share double, own double, run_share double, first_word int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                s, own, longest, at = _covered(list(r.words), list(r.item), {int(o) for o in r.offsets}, [int(d) for d in r.diagonals])
                if s >= share and own >= least:
                    out.append((r.doc_id, r.item_id, s, own, longest, at))
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "share", "own", "run_share", "first_word"])

    held = docs.join(small(ids, SENT), "doc_id", "left_semi").select("doc_id", terms(F.col("text")).alias("words"))
    rows = held.join(found, "doc_id").join(small(texts, SENT), "item_id").select("doc_id", "item_id", "words", "item", "offsets", "diagonals")
    best = rows.mapInPandas(run, schema).groupBy("doc_id", "item_id").agg(F.max(F.struct("share", "own", "run_share", "first_word")).alias("m"))
    return best.select("doc_id", "item_id", "m.*", (F.col("m.run_share") >= 1).alias("exact"))


def leaked_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per test item the documents that hold it, and the greatest share; items that didn't leak have none."""
    found = leaks(docs, items).groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"), F.max("share").alias("most"), F.sum(F.col("exact").cast("long")).alias("exact"))
    ids = items.where("item_id is not null").select("item_id").distinct()
    zero = lambda c, z: F.coalesce(F.col(c), F.lit(z)).alias(c)
    return ids.join(found, "item_id", "left").select("item_id", zero("documents", 0), zero("most", 0.0), zero("exact", 0))
