"""Consensus of several annotators' ordinal labels by minimax conditional entropy.

The conditional entropy of labels given truths is maximised under the observed moments of each annotator and item, and
minimised over the truths. Its solution gives label k under truth c the probability P(k | c) ~ exp(a c k + b k + d k^2 + t k),
with the annotator's tilting a (how labels follow the truth; zero: not at all, negative: against it), b (severity), d
(width) and the item's t. The regularised dual is climbed by blocks in turn: items and the posteriors of their truths under the
annotators of the moment, then the annotators under those, until a round gains next to nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.runtime import cut, discard

#: The range of each field. Labels come in half steps, truths in whole ones.
FIELDS = {"quality": (-1, 1), "difficulty": (1, 7)}
#: Regularisation of annotators and items; the gain of a round, as a share of the dual, at which the climb ends, and rounds at most.
ALPHA, BETA, GAIN, ROUNDS = 0.5, 4.0, 5e-3, 30
#: Inner steps of an item; ratings in one block of an item; annotators (some 100 bytes a field) that are fitted on the driver and sent to every
#: task at most, more are kept as a table and joined.
INNER, BLOCK, SENT = 2, 512, 200_000
MIN_QUESTIONS, UNRELATED, FOLLOWS = 30, 0.35, 0.5
PRIOR = (2.0, 0.0, -1.0)


def current_ratings(reviews: DataFrame) -> DataFrame:
    """(field, rater, item, k, x): the newest rating in range of each reviewer, question and field.

    Ids of reviewers are trimmed and lower-cased; ratings outside their range count as not given; of rows delivered twice or
    revised, the last by (review_timestamp, loaded_at, review_id) holds. Rows with a null id are left out.
    """
    rater = F.lower(F.trim("reviewer_id"))
    r = reviews.select(rater.alias("rater"), F.col("question_id").alias("item"), "ratings", F.struct("review_timestamp", "loaded_at", "review_id").alias("at"))
    r = r.where((F.col("rater") != "") & F.col("item").isNotNull())
    r = r.groupBy("rater", "item").agg(F.max_by("ratings", "at").alias("ratings"))
    kinds = F.array(*[F.struct(F.lit(f).alias("field"), F.col("ratings")[f].alias("x"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for f, (lo, hi) in FIELDS.items()])
    r = r.select("rater", "item", F.explode(kinds).alias("v")).select("rater", "item", "v.*").where("x between lo and hi")
    return r.select("field", "rater", "item", F.floor((F.col("x") - F.col("lo")) * 2 + 0.5).cast("int").alias("k"), "x")


def _grid(field: str) -> tuple[np.ndarray, np.ndarray]:
    """Truths and labels of a field on [-1, 1]."""
    lo, hi = FIELDS[field]
    return np.linspace(-1, 1, hi - lo + 1), np.linspace(-1, 1, 2 * (hi - lo) + 1)


def annotators(ratings: DataFrame) -> DataFrame:
    """(code, rater), codes from 0 without gaps in a partition; kept, so that a code stays that of its rater."""
    return cut(ratings.select("rater").distinct().withColumn("code", F.monotonically_increasing_id()))


def blocks(ratings: DataFrame, codes: DataFrame) -> DataFrame:
    """(field, item, block, many, codes, ks): the ratings of an item in blocks of about BLOCK, `many` if it has several.

    An item of any number of ratings is cut by the hash of the rater, so no block grows with the data.
    """
    sizes = ratings.groupBy("field", "item").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK).select("field", "item", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    rows = ratings.join(codes, "rater").join(sizes, ["field", "item"], "left")
    part = F.coalesce(F.pmod(F.xxhash64("rater"), F.col("parts")), F.lit(0)).cast("int")
    rows = rows.select("field", "item", part.alias("block"), F.col("parts").isNotNull().alias("many"), "code", "k")
    return cut(rows.groupBy("field", "item", "block").agg(F.max("many").alias("many"), F.collect_list("code").alias("codes"), F.collect_list("k").alias("ks")))


class Climb:
    """The climb over the blocks; each round is one pass that gives sums per annotator, and nothing per rating is ever written."""

    def __init__(self, ratings: DataFrame, sent: int = SENT) -> None:
        self.spark, self.codes = ratings.sparkSession, annotators(ratings)
        self.blocks = blocks(ratings, self.codes)
        top = self.codes.agg(F.count(F.lit(1)).alias("n"), F.max("code").alias("top")).first()
        self.n, self.by_join = top["n"], top["n"] > sent
        first = ratings.select("field", "rater").distinct().join(self.codes, "rater")
        self.raters = cut(first.select("field", "code", *[F.lit(v).alias(c) for c, v in zip("abd", PRIOR, strict=True)]))
        self.own = None if self.by_join else self.raters.toPandas().sort_values(["field", "code"], ignore_index=True)
        self.many = not self.blocks.where("many").isEmpty()

    def _with(self, blocks: DataFrame, shared: DataFrame | None = None) -> tuple[DataFrame, object]:
        """The blocks with what their pass needs: parameters of the annotators as a sent table, or joined as arrays beyond SENT."""
        if shared is not None:
            blocks = blocks.join(shared, ["field", "item"])
        if not self.by_join:
            table = {f: (g["code"].to_numpy(), g[["a", "b", "d"]].to_numpy()) for f, g in self.own.groupby("field")}
            return blocks, self.spark.sparkContext.broadcast(table)
        key = ["field", "item", "block"]
        one = blocks.select(*key, F.posexplode("codes").alias("pos", "code")).join(self.raters, ["field", "code"])
        par = one.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "a", "b", "d"))), lambda x: F.array(x["a"], x["b"], x["d"])).alias("par"))
        return blocks.join(par, key), None

    def _pass(self, work, schema: str, blocks: DataFrame, shared: DataFrame | None = None) -> DataFrame:
        rows, table = self._with(blocks, shared)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for field, g in b.groupby("field"):
                    codes, ks = np.concatenate(g["codes"].to_list()), np.concatenate(g["ks"].to_list())
                    if table is None:
                        par = np.concatenate([np.stack([np.asarray(x) for x in p]) for p in g["par"]])
                    else:
                        known, values = table.value[field]
                        par = values[np.searchsorted(known, codes)]
                    yield from work(field, g, codes, ks, par)

        return rows.mapInPandas(run, schema)

    def _shared(self) -> DataFrame | None:
        """(field, item, t, q) of the items in several blocks, from sums over these; None if there is no such item."""
        if not self.many:
            return None
        many, state = self.blocks.where("many"), None
        for _ in range(INNER):
            got = self._pass(_partial, "field string, item string, t double, g double, h double, ll array<double>", many, state)
            n = max(len(_grid(f)[0]) for f in FIELDS)
            sums = got.groupBy("field", "item", "t").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), *[F.sum(F.try_element_at("ll", F.lit(c + 1))).alias(f"l{c}") for c in range(n)])
            ll = F.array_compact(F.array(*[f"l{c}" for c in range(n)]))
            state = cut(sums.select("field", "item", (F.col("t") + F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (F.col("g") - BETA * F.col("t")) / (F.col("h") + BETA)))).alias("t"), ll.alias("ll")))
        return state

    def round(self, others: bool = False) -> float:
        """One turn of items, posteriors and annotators; the dual before the annotators' step. With `others` an annotator is fitted
        to the posteriors that the other annotators alone give, which its own labels can't bend."""
        shared = self._shared()
        single = self.blocks if shared is None else self.blocks.where("not many")
        schema = "field string, code long, dual double, " + ", ".join(f"{s} double" for s in _STATS)
        out = self._pass(lambda *x: _rater_sums(*x, others), schema, single)
        if shared is not None:
            out = out.union(self._pass(lambda *x: _rater_sums(*x, others), schema, self.blocks.where("many"), shared))
        sums = out.groupBy("field", "code").agg(*[F.sum(s).alias(s) for s in ["dual", *_STATS]])
        if not self.by_join:
            got, squares = self.own.merge(sums.toPandas(), on=["field", "code"]), (self.own[["a", "b", "d"]] ** 2).to_numpy().sum()
            dual = got["dual"].sum()
            self.own = next(_newton(iter([got]))).sort_values(["field", "code"], ignore_index=True) if len(got) else got[["field", "code", "a", "b", "d"]]
        else:
            sums = cut(sums)
            raters = cut(self.raters.join(sums.drop("dual"), ["field", "code"]).mapInPandas(_newton, _RATER))
            squares, dual = (t.agg(F.sum(c)).first()[0] or 0.0 for t, c in ((self.raters, F.col("a") ** 2 + F.col("b") ** 2 + F.col("d") ** 2), (sums, F.col("dual"))))
            discard(self.raters, sums)
            self.raters = raters
        return dual - ALPHA / 2 * squares

    def run(self, rounds: int = ROUNDS, gain: float = GAIN) -> Climb:
        last = None
        for _ in range(rounds):
            now = self.round()
            if last is not None and now - last < gain * abs(last):
                break
            last = now
        return self

    def items(self) -> DataFrame:
        """(field, item, mean): the posterior mean of the truth, on the field's own scale."""
        schema = "field string, item string, mean double"
        shared = self._shared()
        out = self._pass(_means, schema, self.blocks if shared is None else self.blocks.where("not many"))
        return out if shared is None else out.union(self._pass(_means, schema, self.blocks.where("many and block = 0"), shared)).distinct()

    def follows(self) -> DataFrame:
        """(field, rater, a, follows): the tilting, and the correlation with the truth that it and the width make for truths spread evenly."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for field, g in b.groupby("field"):
                    c, v = _grid(field)
                    p = _tilted(g[["a", "b", "d"]].to_numpy(), np.zeros(len(g)), c, v)
                    m1, m2 = (p * v).sum(axis=2), (p * v**2).sum(axis=2)
                    both, own = (m1 * c).mean(axis=1) - m1.mean(axis=1) * c.mean(), m2.mean(axis=1) - m1.mean(axis=1) ** 2
                    yield pd.DataFrame({"field": field, "code": g["code"], "a": g["a"], "follows": both / np.sqrt(np.maximum(own * c.var(), 1e-12))})

        raters = self.raters if self.by_join else self.spark.createDataFrame(self.own[["field", "code", "a", "b", "d"]], _RATER)
        return raters.mapInPandas(run, "field string, code long, a double, follows double").join(self.codes, "code").drop("code")


_RATER = "field string, code long, a double, b double, d double"
_STATS = ["ga", "gb", "gd", "haa", "hab", "had", "hbb", "hbd", "hdd"]


def _tilted(par: np.ndarray, t: np.ndarray, c: np.ndarray, v: np.ndarray) -> np.ndarray:
    """P(k | c) of each rating as (ratings, c, k)."""
    e = (par[:, 0, None] * c)[:, :, None] * v + ((par[:, 1] + t)[:, None] * v + par[:, 2, None] * v**2)[:, None, :]
    e = np.exp(e - e.max(axis=2, keepdims=True))
    return e / e.sum(axis=2, keepdims=True)


def _moments(p: np.ndarray, v: np.ndarray) -> list[np.ndarray]:
    return [p @ v**n for n in (1, 2, 3, 4)]


def _posterior(ll: np.ndarray) -> np.ndarray:
    e = np.exp(ll - ll.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _settle(field: str, g: pd.DataFrame, ks: np.ndarray, par: np.ndarray) -> tuple:
    """Items at their best under the annotators: (owner of each rating, t, log likelihoods per rating, posterior per item, P)."""
    c, v = _grid(field)
    sizes = g["ks"].map(len).to_numpy()
    starts, owner = np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.repeat(np.arange(len(sizes)), sizes)
    fixed = "ll" in g.columns
    t = g["t"].to_numpy(dtype=float) if fixed else np.zeros(len(g))
    for step in range(INNER + 1):
        p = _tilted(par, t[owner], c, v)
        ll = np.log(np.maximum(p[np.arange(len(ks)), :, ks], 1e-12))
        q = _posterior(np.stack([np.asarray(x)[: len(c)] for x in g["ll"]]) if fixed else np.add.reduceat(ll, starts))
        if fixed or step == INNER:
            break
        one, two = p @ v, p @ v**2
        w = q[owner]
        grad, curve = np.add.reduceat(v[ks] - (w * one).sum(axis=1), starts), np.add.reduceat((w * (two - one**2)).sum(axis=1), starts)
        t = t + np.clip((grad - BETA * t) / (curve + BETA), -1, 1)
    return owner, starts, t, ll, q, p


def _partial(field: str, g: pd.DataFrame, codes: np.ndarray, ks: np.ndarray, par: np.ndarray) -> Iterator[pd.DataFrame]:
    """What each block of a large item adds to the item's gradient, curvature and log likelihoods."""
    c, v = _grid(field)
    sizes = g["ks"].map(len).to_numpy()
    starts, owner = np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.repeat(np.arange(len(sizes)), sizes)
    t = g["t"].to_numpy(dtype=float) if "t" in g.columns else np.zeros(len(g))
    p = _tilted(par, t[owner], c, v)
    ll = np.log(np.maximum(p[np.arange(len(ks)), :, ks], 1e-12))
    sums = np.add.reduceat(ll, starts)
    q = _posterior(np.stack([np.asarray(x)[: len(c)] for x in g["ll"]])) if "ll" in g.columns else _posterior(sums)
    one, two, w = p @ v, p @ v**2, q[owner]
    grad, curve = np.add.reduceat(v[ks] - (w * one).sum(axis=1), starts), np.add.reduceat((w * (two - one**2)).sum(axis=1), starts)
    yield pd.DataFrame({"field": field, "item": g["item"].to_numpy(), "t": t, "g": grad, "h": curve, "ll": list(sums)})


def _rater_sums(field: str, g: pd.DataFrame, codes: np.ndarray, ks: np.ndarray, par: np.ndarray, others: bool) -> Iterator[pd.DataFrame]:
    """Gradients and curvatures of the annotators, summed within the batch, and the dual of its items."""
    c, v = _grid(field)
    owner, starts, t, ll, q, p = _settle(field, g, ks, par)
    w = _posterior(np.log(np.maximum(q, 1e-30))[owner] - ll) if others else q[owner]
    one, two, three, four = _moments(p, v)
    x = v[ks]
    s1, s2, var, skew, kurt = x[:, None] - one, x[:, None] ** 2 - two, two - one**2, three - one * two, four - two**2
    mean = lambda z: (w * z).sum(axis=1)
    stats = [mean(c * s1), mean(s1), mean(s2), mean(c * c * var), mean(c * var), mean(c * skew), mean(var), mean(skew), mean(kurt)]
    who, at = np.unique(codes, return_inverse=True)
    out = {"field": field, "code": who, "dual": 0.0} | {n: np.bincount(at, weights=z, minlength=len(who)) for n, z in zip(_STATS, stats, strict=True)}
    frame = pd.DataFrame(out)
    # expected log likelihood and entropy of the posteriors, less the items' penalty, under any one annotator of the batch
    frame.loc[0, "dual"] = float((q[owner] * ll).sum() - (q * np.log(np.maximum(q, 1e-30))).sum() - BETA / 2 * (t**2).sum())
    yield frame


def _means(field: str, g: pd.DataFrame, codes: np.ndarray, ks: np.ndarray, par: np.ndarray) -> Iterator[pd.DataFrame]:
    q, lo = _settle(field, g, ks, par)[4], FIELDS[field][0]
    yield pd.DataFrame({"field": field, "item": g["item"].to_numpy(), "mean": q @ np.arange(q.shape[1]) + lo})


def _newton(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A damped Newton step of the three parameters of each annotator."""
    for b in batches:
        now = b[["a", "b", "d"]].to_numpy()
        g = b[["ga", "gb", "gd"]].to_numpy() - ALPHA * now
        h = np.zeros((len(b), 3, 3))
        for name, i, j in (("haa", 0, 0), ("hab", 0, 1), ("had", 0, 2), ("hbb", 1, 1), ("hbd", 1, 2), ("hdd", 2, 2)):
            h[:, i, j] = h[:, j, i] = b[name]
        h[:, [0, 1, 2], [0, 1, 2]] += ALPHA
        new = np.clip(now + np.clip(np.linalg.solve(h, g[:, :, None])[:, :, 0], -2, 2), -12, 12)
        yield pd.DataFrame({"field": b["field"], "code": b["code"], "a": new[:, 0], "b": new[:, 1], "d": new[:, 2]})


def reliability(reviews: DataFrame, rounds: int = ROUNDS, sent: int = SENT) -> DataFrame:
    """Per reviewer: questions rated, and per field the fitted tilting and the correlation with the truth that follows from it.

    After the climb an annotator's own labels are left out of the posteriors that it is fitted to, for two more rounds, so that
    chance agreement with itself doesn't count. Without a rating in a field both are 0. `reliability` is the mean of the correlations.
    """
    climb = Climb(cut(current_ratings(reviews)), sent).run(rounds)
    for _ in range(2):
        climb.round(others=True)
    c = climb.follows()
    pick = lambda f, x: F.coalesce(F.max(F.when(F.col("field") == f, F.col(x))), F.lit(0.0))
    c = c.groupBy("rater").agg(*[pick(f, x).alias(f"{n}_{f}") for f in FIELDS for x, n in (("follows", "reliability"), ("a", "tilting"))])
    named = reviews.select(F.lower(F.trim("reviewer_id")).alias("rater"), "question_id").where((F.col("rater") != "") & F.col("question_id").isNotNull())
    n = named.distinct().groupBy("rater").agg(F.count(F.lit(1)).alias("questions"))
    zero = lambda x: F.coalesce(F.col(x), F.lit(0.0)).alias(x)
    cols = [zero(f"{n}_{f}") for f in FIELDS for n in ("reliability", "tilting")]
    out = n.join(c, "rater", "left").select(F.col("rater").alias("reviewer_id"), "questions", *cols)
    return out.withColumn("reliability", (F.col("reliability_quality") + F.col("reliability_difficulty")) / 2)


def unrelated(reviews: DataFrame, least: int = MIN_QUESTIONS) -> DataFrame:
    """reviewer_id of those with at least `least` questions whose fitted tilting follows the truth in neither field.

    Severity and width are fitted apart from the tilting, so strict, mild or inexact reviewers stay out.
    """
    r = reliability(reviews)
    follows = F.greatest("reliability_quality", "reliability_difficulty") >= FOLLOWS
    return r.where((F.col("questions") >= least) & (F.col("reliability") < UNRELATED) & ~follows).select("reviewer_id")


def consensus(reviews: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Per question and field the posterior mean, the ratings it rests on, and their agreement.

    Agreement is 1 - (variance within the question) / (variance over all ratings of the field), in [.., 1]; null with fewer
    than two ratings. A field without a usable rating is null; an empty table gives none.
    """
    ratings = cut(current_ratings(reviews))
    items = Climb(ratings).run(rounds).items()
    within = ratings.groupBy("field", "item").agg(F.count(F.lit(1)).alias("n"), F.var_samp("x").alias("within"))
    overall = ratings.groupBy("field").agg(F.var_samp("x").alias("overall"))
    one = items.join(within, ["field", "item"]).join(F.broadcast(overall), "field")
    agreement = F.when((F.col("n") > 1) & (F.col("overall") > 0), 1 - F.col("within") / F.col("overall"))
    one = one.select("field", "item", F.col("mean").alias("value"), "n", agreement.alias("agreement"))
    pick = lambda f, x: F.max(F.when(F.col("field") == f, F.col(x)))
    return one.groupBy(F.col("item").alias("question_id")).agg(*[pick(f, x).alias(n) for f in FIELDS for x, n in (("value", f), ("n", f"{f}_ratings"), ("agreement", f"{f}_agreement"))])
