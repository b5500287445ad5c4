"""Severity of abusive, hateful and sexual content by cumulative-link ordinal regression on sparse text features.

The grades ok < disputed < abusive < hateful or sexual share one weight vector and differ in ordered thresholds. A document's latent
value is that of its worst sentence, which the fit chooses anew in every pass, as flags are given to whole documents.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.runtime import spread

#: Flagged documents that the regression is fitted on at most (those of the lowest hashes of their ids), hashed features (as a power of
#: two), turns of choosing sentences and steps of the regression in each.
TRAIN_ROWS, BITS, TURNS, STEPS = 8000, 20, 6, 25
GRADES = 4
#: A flag, one of ok, is taken as wrong if a regression fitted on the other half of the flagged documents is so sure of the opposite.
WRONG, WRONG_OK = 0.05, 0.2
#: A sentence is looked at closely if a word, pair or run of it is in so many more flagged documents than chance has it, in standard
#: deviations, and so many times (as a logarithm) as frequent there as in those that are ok; and documents that have a feature at least.
SUSPECT, ODDS, LEAST = 3.5, 1.2, 4

_SENTENCE = re.compile(r"(?<=[.!?…])\s+|(?<=[。！？])|[\r\n]+")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_][ ._\-*]{1,2}){2,}[^\W\d_](?![^\W_])")
_TOKEN = re.compile(r"[^\W_]+(?:['’*][^\W_]+)*|[぀-鿿]")
_LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"})
_INVISIBLE = re.compile("[­​-‏⁠﻿]")


def _together(m: re.Match) -> str:
    letters = re.findall(r"[^\W\d_]", m[0])
    return "".join(letters)


def fold(w: str) -> str:
    """Repeated letters once."""
    return re.sub(r"(.)\1+", r"\1", w)


def plain(text: str) -> str:
    """Without what hides words: invisible characters, letters set apart, look-alike widths."""
    t = unicodedata.normalize("NFKC", _INVISIBLE.sub("", text))
    return _SPACED.sub(_together, t)


def tokens(sentence: str) -> list[str]:
    """Folded words; digits and signs within a word are read as the letters they stand for, and a star as any letter."""
    s = re.sub(r"(?<=[A-Za-z])[@$](?=[A-Za-z])", lambda m: {"@": "a", "$": "s"}[m[0]], sentence)
    out = []
    for w in _TOKEN.findall(s):
        if any("぀" <= c <= "鿿" for c in w):
            out += list(w) if len(w) == 1 else [w[i : i + 2] for i in range(len(w) - 1)]
            continue
        low = w.lower().replace("’", "'")
        if low.isdigit():
            out.append("#")
            continue
        if any(c.isdigit() for c in low):
            low = low.translate(_LEET) if sum(c.isalpha() for c in low) >= 2 else "#"
        out.append(fold(low))
    return out


def sentences(text: str | None) -> list[list[str]]:
    return [t for t in (tokens(s) for s in _SENTENCE.split(plain(text or ""))) if t]


_SIZE = 1 << BITS


_CODES: dict[str, tuple[int, bytes, bytes]] = {}


def _codes(w: str) -> tuple[int, bytes, bytes]:
    got = _CODES.get(w)
    if got is None:
        if len(_CODES) >= 1 << 16:
            _CODES.clear()
        e = w.encode()
        got = _CODES[w] = (zlib.crc32(e), b" " + e, b" _ " + e)
    return got


def words_and_pairs(words: list[str]) -> list[int]:
    """Hashed words, pairs and pairs with one word between."""
    crc, out = zlib.crc32, set()
    last = before = zlib.crc32(b"^")
    for w in words:
        own, pair, skip = _codes(w)
        out.add(own % _SIZE)
        out.add(crc(pair, last) % _SIZE)
        out.add(crc(skip, before) % _SIZE)
        before, last = last, own
    return list(out)


def runs(words: list[str]) -> list[int]:
    """Hashed runs of four characters of the words with their ends marked, so that spellings of one word share most of them."""
    crc, out = zlib.crc32, set()
    for w in set(words):
        m = f"<{w}>"
        for i in range(max(1, len(m) - 3)):
            out.add(crc(b"~" + m[i : i + 4].encode()) % _SIZE)
    return list(out)


def features(words: list[str]) -> np.ndarray:
    return np.unique(np.array(words_and_pairs(words) + runs(words), dtype=np.int64))


class Ordinal:
    """P(grade > k) = s(w x - b_k), b_0 <= b_1 <= b_2, with one weight vector; a document is its worst sentence.

    Weights start at zero and decay to zero. All that is known of words comes from the flags. `suspect` says which words and pairs make a
    sentence worth looking at; the other sentences have a latent value of 0.
    """

    def __init__(self, w: np.ndarray | None = None, b: np.ndarray | None = None, suspect: np.ndarray | None = None, cutoff: float = 0.5) -> None:
        self.w = np.zeros(_SIZE, dtype=np.float32) if w is None else w
        self.b = np.array([3.0, 3.3, 4.5]) if b is None else b
        self.suspect = np.zeros(_SIZE, dtype=bool) if suspect is None else suspect
        self.cutoff = cutoff

    def telling(self, docs: list[list[np.ndarray]], grades: np.ndarray, least: float) -> np.ndarray:
        """How many times, as a logarithm, each feature is as frequent in flagged documents as in others; 0 if that may be chance."""
        n, bad = np.zeros(_SIZE), np.zeros(_SIZE)
        for d, y in zip(docs, grades, strict=True):
            f = np.unique(np.concatenate(d))
            n[f] += 1
            bad[f] += y > 0
        base = (grades > 0).mean()
        excess = (bad - n * base) / np.sqrt(np.maximum(n * base * (1 - base), 1e-9))
        odds = np.log((bad + 0.1) / (base * len(docs) + 1)) - np.log((n - bad + 0.1) / ((1 - base) * len(docs) + 1))
        return np.where((excess >= least) & (odds >= ODDS), odds, 0.0)

    def fit(self, docs: list[list[list[str]]], grades: np.ndarray, suspect: float = SUSPECT, least: int = LEAST, decay: float = 4.0, rate: float = 0.5, trim: float = 0.9) -> Ordinal:
        light = [[np.array(words_and_pairs(s)) for s in d] for d in docs]
        odds = self.telling(light, grades, suspect)
        self.suspect = odds > 0
        # the first guess of a document's worst sentence is that of the most telling words; a flag that no sentence explains is left out
        flat, owner, first, plain = [], [], [], 0
        for i, d in enumerate(light):
            for j, s in enumerate(d):
                if self.suspect[s].any():
                    flat.append(features(docs[i][j]))
                    owner.append(i)
                    first.append(float(odds[s].max()))
                else:
                    plain += grades[i] == 0
        if not flat:
            return self
        owner, sizes = np.array(owner), np.array([len(s) for s in flat])
        idx, starts = np.concatenate(flat), np.concatenate([[0], np.cumsum(sizes)[:-1]])
        used, idx = np.unique(idx, return_inverse=True)
        # a feature of few documents teaches nothing that holds elsewhere
        seen = np.bincount(np.unique(np.stack([np.repeat(owner, sizes), idx]), axis=1)[1], minlength=len(used)) >= least
        heads = np.searchsorted(owner, np.unique(owner))
        w, b, norm = np.zeros(len(used)), self.b.copy(), np.full(len(used), 1e-3)
        above = (grades[:, None] > np.arange(GRADES - 1)[None, :]).astype(float)
        score, at = np.array(first), np.repeat(np.arange(len(flat)), sizes)
        for turn in range(TURNS):
            top = np.flatnonzero(score == np.maximum.reduceat(score, heads)[np.searchsorted(owner[heads], owner)])
            worst = top[np.unique(owner[top], return_index=True)[1]]
            taken = grades[owner] == 0  # every sentence of a document that is ok is ok
            taken[worst] = True
            y = above[owner]
            for _ in range(STEPS):
                score = np.add.reduceat(w[idx], starts)
                gap = y - 1 / (1 + np.exp(-np.clip(score[:, None] - b, -30, 30)))
                # some flags are wrong: from the third turn on, what is far on the wrong side hardly pulls
                gap *= np.where((np.abs(gap) > trim) & (turn >= 2), 0.05, 1.0) * taken[:, None]
                grad = np.bincount(idx, weights=gap.sum(axis=1)[at], minlength=len(used)) * seen - decay * w
                norm += grad**2
                w += rate * grad / np.sqrt(norm)
                rest = plain / (1 + np.exp(b))  # what the sentences without a suspect word add, whose latent value is 0
                b = np.maximum.accumulate(b - 2 * (gap.sum(axis=0) - rest) / taken.sum())
            score = np.add.reduceat(w[idx], starts)
        self.w[used], self.b = w, b
        return self

    def doc(self, text: str | None) -> tuple[float, float]:
        """(probability of any grade above ok, expected grade) of the worst sentence; 0 where there is no sentence."""
        words = sentences(text)
        if not words:
            return 0.0, 0.0
        z = 0.0
        for s in words:
            light = words_and_pairs(s)
            if self.suspect[light].any():
                z = max(z, float(self.w[features(s)].sum()))
        p = 1 / (1 + np.exp(-np.clip(z - self.b, -30, 30)))
        return float(p[0]), float(p.sum())


def best_cutoff(p: np.ndarray, bad: np.ndarray, slack: float = 0.005) -> float:
    """The middle of the probabilities at which a cut comes within `slack` of the greatest F1, as a few flags are wrong; 0.5 where nothing is flagged."""
    if not bad.any():
        return 0.5
    grid = np.linspace(0.05, 0.95, 91)
    f = np.array([2 * (bad & (p >= c)).sum() / max(1, bad.sum() + (p >= c).sum()) for c in grid])
    return float(np.mean(grid[f >= f.max() - slack]))


def grades(flags: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 ok, 1 flags that disagree, 2 abusive, 3 hateful or sexual; unknown flags and null ids are left out."""
    f = F.lower(F.trim("flag"))
    level = F.when(f == "ok", 0).when(f == "abusive", 2).when(f.isin("hateful", "sexual"), 3)
    g = flags.where("doc_id is not null").select("doc_id", level.alias("g")).where("g is not null").groupBy("doc_id").agg(F.min("g").alias("lo"), F.max("g").alias("hi"))
    return g.select("doc_id", F.when((F.col("lo") == 0) & (F.col("hi") > 0), 1).otherwise(F.col("hi")).alias("grade"))


def train(rows: list[tuple[str, int, bool]]) -> Ordinal:
    """Fitted on (text, grade, half): each half is judged by a regression fitted on the other, which shows the wrong flags and
    gives the cut-off on documents that it wasn't fitted on; the last fit is on all whose flag stands."""
    data = sorted((t, y, h, sentences(t)) for t, y, h in rows)
    data = [x for x in data if x[3]]
    fitted = lambda part, **of: Ordinal().fit([x[3] for x in part], np.array([x[1] for x in part]), **of) if {x[1] > 0 for x in part} == {True, False} else Ordinal()
    # a half has half the documents for each feature
    by_other = [fitted([x for x in data if x[2] != h], suspect=SUSPECT / 2**0.5, least=LEAST // 2) for h in (False, True)]
    p, bad = np.array([by_other[x[2]].doc(x[0])[0] for x in data]), np.array([x[1] > 0 for x in data], dtype=bool)
    stands = ~((bad & (p < WRONG)) | (~bad & (p > 1 - WRONG_OK)))
    model = fitted([x for x, k in zip(data, stands, strict=True) if k])
    model.cutoff = best_cutoff(p[stands], bad[stands])
    return model


def fit(docs: DataFrame, flags: DataFrame, rows: int = TRAIN_ROWS) -> Ordinal:
    """Fitted on at most `rows` flagged documents; without flags of both sides every document scores as if ok."""
    g = grades(flags).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 0
    got = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(g), "doc_id").select("text", "grade", half.alias("half")).distinct().collect()
    return train([(r.text, r.grade, r.half) for r in got])


def score(docs: DataFrame, flags: DataFrame) -> DataFrame:
    """(doc_id, source, probability, severity, flagged) of every row of the documents.

    Severity is the expected grade, 0 to 3; `flagged` is a probability at or above the cut-off that held-out flags chose. Null, empty
    and blank texts have 0 for both; whole texts are read, sentence by sentence, in any language; copies get equal scores, and columns
    beside doc_id, source and text may have any name.
    """
    model = fit(docs, flags)
    w, b, cutoff = docs.sparkSession.sparkContext.broadcast((model.w, np.packbits(model.suspect))), model.b, model.cutoff  # 4 MB, fixed by BITS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Ordinal(w.value[0], b, np.unpackbits(w.value[1]).astype(bool))
        for part in batches:
            s = [own.doc(t) for t in part["text"]]
            yield pd.DataFrame({"doc_id": part["doc_id"], "source": part["source"], "probability": [p for p, _ in s], "severity": [v for _, v in s], "flagged": [p >= cutoff for p, _ in s]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return spread(docs.select("doc_id", "source", "text")).mapInPandas(run, f"doc_id {kind}, source string, probability double, severity double, flagged boolean")


def rates(docs: DataFrame, flags: DataFrame) -> DataFrame:
    """Per source the documents, those that are flagged, their share and the mean severity; a null source is one of its own."""
    s = score(docs, flags).groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.col("flagged").cast("long")).alias("flagged"), F.avg("severity").alias("mean_severity"))
    return s.withColumn("rate", F.col("flagged") / F.col("documents"))
