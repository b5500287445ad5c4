"""Connected records by Borůvka's contraction along each component's least edge, keeping the spanning forest."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.runtime import cut, discard, unsized

HOT_ROWS = 10_000
FANS = 64
#: Where at most so many edges between components are left, one task does the other rounds, so that short tables don't cost jobs.
LAST_EDGES = 500_000


def star_edges(links: DataFrame) -> DataFrame:
    """(a, b) edges of a tree per key over the (key, node) rows: node - key, or node - part of the key - key for hot keys.

    No pairs of nodes are formed. A key with more than max(HOT_ROWS, rows / 1000) nodes is split in FANS parts by the node's
    hash, so that no vertex has a large share of the edges; there are fewer than 1000 such keys, and only those are broadcast.
    """
    links = links.where(F.col("key").isNotNull() & F.col("node").isNotNull()).select("key", "node").distinct()
    counts = links.groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
    total, most = cut(counts.agg(F.sum("_n"), F.max("_n")), tidy=True).first()
    least = max(HOT_ROWS, (total or 0) / 1000)
    if (most or 0) <= least:
        return links.select(F.col("node").alias("a"), F.col("key").alias("b"))
    hot = F.broadcast(counts.where(F.col("_n") > least).select("key", F.lit(True).alias("_hot")))
    marked = links.join(hot, "key", "left")
    part = F.concat("key", F.lit("\x1f"), F.pmod(F.xxhash64("node"), F.lit(FANS)).cast("string"))
    direct = marked.where(F.col("_hot").isNull()).select(F.col("node").alias("a"), F.col("key").alias("b"))
    fanned = marked.where(F.col("_hot").isNotNull()).select("node", part.alias("part"), "key")
    return direct.union(fanned.select("node", "part")).union(fanned.select("part", "key").distinct())


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vertex's root and the places of the forest's edges: the rounds of `spanning_forest` over vertices coded in the order of
    their names and edges in their total order."""
    root = np.arange(max(a.max(), b.max()) + 1 if len(a) else 0)
    place, kept = np.arange(len(a)), [np.zeros(0, dtype=np.int64)]
    while len(a):
        best = np.full(len(root), -1)
        back = slice(None, None, -1)  # the first of a vertex is written last
        best[np.stack([a, b], axis=1).ravel()[back]] = np.repeat(np.arange(len(a)), 2)[back]
        node = np.flatnonzero(best >= 0)
        e = best[node]
        up = np.arange(len(root))
        up[node] = a[e] + b[e] - node
        mutual = node[(up[up[node]] == node) & (node < up[node])]
        up[mutual] = mutual
        while not np.array_equal(top := up[up], up):
            up = top
        kept.append(place[np.unique(e)])
        root, a, b = up[root], up[a], up[b]
        a, b, place = a[a != b], b[a != b], place[a != b]
    return root, np.concatenate(kept)


def _last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, tree) of the edges left: each component with its root, or with `tree` an edge of the forest by its first ends."""
    got = list(batches)
    if not got:
        return
    t = pa.Table.from_batches(got)
    t = t.cast(pa.schema([(f.name, pa.large_string() if f.name != "w" else f.type) for f in t.schema]))
    t = t.take(pc.sort_indices(t, sort_keys=[("w", "ascending"), ("ea", "ascending"), ("eb", "ascending")]))
    names = pc.unique(pa.chunked_array([*t["a"].chunks, *t["b"].chunks]))
    names = names.take(pc.sort_indices(names))
    a, b = (pc.index_in(t[c], value_set=names).to_numpy().astype(np.int64) for c in "ab")
    root, places = contract(a, b)
    for x, y, tree in ((names, names.take(pa.array(root)), False), (t["ea"].take(pa.array(places)), t["eb"].take(pa.array(places)), True)):
        out = pa.table({"a": x, "b": y}).cast(pa.schema([("a", pa.string()), ("b", pa.string())]))
        yield from out.append_column("tree", pa.array(np.full(len(out), tree))).to_batches(10_000)


def spanning_forest(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """labels (node, root) and forest (a, b), made of tables that are kept in the shared folder.

    Each round every component takes its least outgoing edge by (hash, ends) - a total order, so the only cycles are pairs
    that chose each other, which are opened at the lesser name - and paths to the roots are halved until flat. The number of
    components falls to at most half in a round, edges inside a component are dropped, and of parallel ones the least is kept.
    Once at most LAST_EDGES edges are left, the same rounds run in one task; roots and forest don't depend on where that begins.
    Self-loops and repeated edges have no effect; no edges give two empty tables.
    """
    e = edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    e = unsized(cut(e, tidy=True))
    kept, e = e, e.withColumn("e", F.struct(F.xxhash64("a", "b").alias("w"), F.col("a").alias("ea"), F.col("b").alias("eb")))
    labels, forest = None, []
    while e.count() > LAST_EDGES:
        both = e.select("a", "b", "e").union(e.select("b", "a", "e"))
        best = unsized(cut(both.groupBy("a").agg(F.min(F.struct("e", "b")).alias("m")).select(F.col("a").alias("node"), F.col("m.b").alias("up"), F.col("m.e").alias("e")), tidy=True))
        forest.append(best.select(F.col("e.ea").alias("a"), F.col("e.eb").alias("b")).distinct())
        other = best.select(F.col("node").alias("up"), F.col("up").alias("upup"))
        joined = best.join(other, "up", "left")
        mutual = (F.col("upup") == F.col("node")) & (F.col("node") < F.col("up"))
        up = unsized(cut(joined.select("node", F.when(mutual, F.col("node")).otherwise(F.col("up")).alias("up")), tidy=True))
        while True:
            over = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
            above = over.select(F.col("up").alias("top"), F.col("top").alias("above"))
            # two jumps at once, and whether any path was longer, in the job that writes
            jumped = unsized(cut(up.join(over, "up").join(above, "top").select("node", F.col("above").alias("up"), (F.col("above") != F.col("up")).alias("moved")), tidy=True))
            discard(up)
            up = jumped
            if jumped.where("moved").isEmpty():
                break
        root = up.select(F.col("node").alias("root"), F.col("up").alias("top"))
        ra, rb = root.select(F.col("root").alias("a"), F.col("top").alias("ra")), root.select(F.col("root").alias("b"), F.col("top").alias("rb"))
        left = e.join(ra, "a").join(rb, "b").where(F.col("ra") != F.col("rb"))
        left = unsized(cut(left.groupBy(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).agg(F.min("e").alias("e")), tidy=True))
        discard(kept)
        if labels is None:  # every vertex has an edge
            labels = root.select(F.col("root").alias("node"), F.col("top").alias("root"))
        else:
            before, labels = labels, unsized(cut(labels.join(root, "root", "left").select("node", F.coalesce("top", "root").alias("root")), tidy=True))
            discard(before, up)
        kept = e = left
    last = unsized(cut(e.select("a", "b", "e.w", "e.ea", "e.eb").coalesce(1).mapInArrow(_last, "a string, b string, tree boolean"), tidy=True))
    discard(kept)
    ends = last.where("not tree").select(F.col("a").alias("root"), F.col("b").alias("top"))
    if labels is None:
        labels = ends.select(F.col("root").alias("node"), F.col("top").alias("root"))
    else:
        labels = labels.join(ends, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return labels, reduce(DataFrame.union, [*forest, last.where("tree").select("a", "b")])
