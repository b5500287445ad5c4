"""Near-duplicate records by fast similarity sketching, banding and exact verification."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwork.llm.forest import spanning_forest
from siltwork.runtime import cut, discard, spread

#: At a similarity of 0.7 a pair is missed with probability (1 - 0.7^8)^128 = 0.0005, at 0.75 with 0.000001.
BANDS, ROWS, THRESHOLD = 128, 8, 0.7
#: Rows of a key in one block.
BUCKET = 256
#: Bands whose keys are on disk at the same time where those of all are more than AT_ONCE_BYTES; rows of a key above which its pairs are
#: formed over many tasks.
BANDS_AT_ONCE, AT_ONCE_BYTES, HOT = 16, 400_000_000, 2048
#: Bytes of a part of the keys, and of the texts that are hashed at once.
PART_BYTES, TEXT_BYTES = 16_000_000, 500_000
#: A record in a band: the key inside its part, the record, its tokens (65535: that many or more) and the parity of its tokens in 96 bits.
ENTRY = np.dtype([("key", "<u4"), ("no", "<i8"), ("n", "<u2"), ("bits", "<u4", 3)])
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def round_seeds(t: int, seed: int = 1) -> np.ndarray:
    return _mix(np.arange(1, 2 * t + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def sketch(tokens: np.ndarray, t: int, seeds: np.ndarray) -> np.ndarray:
    """t coordinates of a set of 64-bit tokens.

    In round i < t every token is hashed to one bin and to a value in [i, i + 1), in round t + j to bin j; a bin keeps its
    least value. After t rounds most bins are filled and after 2 t all are, and the share of equal coordinates of two sets
    is concentrated about their Jaccard similarity. Rounds end as soon as all bins are filled, as later values are greater.
    """
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(t, empty, dtype=np.uint64)
    n, done = len(tokens), 0
    if n == 0:
        return out
    block = min(t, int(t * (np.log(t) + 2) / n) + 1)
    while done < t and (done == 0 or (out == empty).any()):
        rounds = np.arange(done, min(t, done + block), dtype=np.int64)
        h = _mix(tokens[None, :] ^ seeds[rounds][:, None])
        value = (rounds.astype(np.uint64)[:, None] << np.uint64(40)) | (h >> np.uint64(24))
        np.minimum.at(out, (h % np.uint64(t)).astype(np.int64).ravel(), value.ravel())
        done += block
    for j in np.flatnonzero(out == empty):
        out[j] = (np.uint64(t + j) << np.uint64(40)) | (_mix(tokens ^ seeds[t + j]) >> np.uint64(24)).min()
    return out


def sketches(tokens: np.ndarray, counts: np.ndarray, t: int, seeds: np.ndarray) -> np.ndarray:
    """`sketch` of many sets at once, a row for each; tokens has those of one set after the other."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    rows = np.repeat(np.arange(len(counts)), counts)
    out = np.full(len(counts) * t, empty, dtype=np.uint64)
    open_ = counts > 0
    left, base = tokens, rows * t
    for r in range(t):
        h = _mix(left ^ seeds[r])
        at = (h & np.uint64(t - 1) if t & (t - 1) == 0 else h % np.uint64(t)).astype(np.int64)
        np.minimum.at(out, base + at, (np.uint64(r) << np.uint64(40)) | (h >> np.uint64(24)))
        if r % 4 == 3 or r == t - 1:
            open_ &= (out.reshape(-1, t) == empty).any(axis=1)
            if not open_.any():
                break
            keep = open_[base // t]
            left, base = left[keep], base[keep]
    out = out.reshape(-1, t)
    ends = np.cumsum(counts)
    for i in np.flatnonzero(open_):
        own = tokens[ends[i] - counts[i] : ends[i]]
        for j in np.flatnonzero(out[i] == empty):
            out[i, j] = (np.uint64(t + j) << np.uint64(40)) | (_mix(own ^ seeds[t + j]) >> np.uint64(24)).min()
    return out


def band_keys(s: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A key for each band of one sketch, or of each row of many."""
    s = s.reshape(*s.shape[:-1], bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for r in range(rows):
        key = _mix(key ^ s[..., r])
    return key.view(np.int64)


_BASE = 0x9E3779B97F4A7C15
_LETTERS = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words of an ASCII text, which single blanks part."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    powers, inverse = (np.cumprod(np.full(len(data) + 1, x, dtype=np.uint64)) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
    upto = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_LETTERS[data] * powers[:-1], out=upto[1:])
    blanks = np.flatnonzero(data == 32)
    starts, ends = np.append(0, blanks + 1), np.append(blanks, len(data))
    return _mix(((upto[ends] - upto[starts]) * inverse[starts]) ^ (ends - starts).astype(np.uint64))


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, no, cls, tokens) of (id, text): the set of runs of a-z and 0-9, its SHA-256, the first 64 bits of that, and hashed tokens."""
    find = re.compile("[a-z0-9]+").findall
    for b in batches:
        texts, first = b.column(1).to_pylist(), 0
        while first < len(texts):
            ids, sets, size = [], [], 0
            while first < len(texts) and size < TEXT_BYTES:
                if w := sorted(set(find(texts[first]))):
                    ids.append(first)
                    sets.append(w)
                size += len(texts[first])
                first += 1
            if not ids:
                continue
            joined = [" ".join(w) for w in sets]
            cls = [sha256(x.encode()).digest() for x in joined]
            offsets = np.append(0, np.cumsum([len(w) for w in sets])).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(word_hashes(" ".join(joined)).view(np.int64)))
            no = np.frombuffer(b"".join(c[:8] for c in cls), dtype="<i8")
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ids)), pa.array(no), pa.array(cls, pa.binary()), tokens], names=["id", "no", "cls", "tokens"])


def parsed(df: DataFrame, id_col: str, parts: list[str]) -> DataFrame:
    """(id, no, cls, tokens) of each row, kept in the shared folder: records of equal token sets are one class.

    A record with a null or empty part, or a null id, takes no part; nor does one without a token. An id with two texts is
    a member of both classes. cls is the SHA-256 of the sorted words, no its first 64 bits.
    """
    ok = F.col(id_col).isNotNull()
    for p in parts:
        ok = ok & F.col(p).isNotNull() & (F.col(p) != "")
    texts = df.where(ok).select(F.col(id_col).alias("id"), F.lower(F.concat_ws(" ", *[F.col(p) for p in parts])).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    return cut(spread(texts).mapInArrow(_parsed, f"id {kind}, no long, cls binary, tokens array<long>"), tidy=True)


def split_pairs(rows: DataFrame, key: str, bucket: int = BUCKET) -> DataFrame:
    """(x, y, nx, ny), x < y, of the rows (key, no, n) that share a key, each once per key.

    A key's rows are laid in blocks of about `bucket` by a hash, and each pair of blocks is a join group of its own, so a key that a
    third of all rows have is spread over many tasks.
    """
    own = Window.partitionBy(key)
    shared = cut(rows.withColumn("_c", F.count(F.lit(1)).over(own)).where("_c > 1"))  # a key that only one row has can't make a pair
    parts = F.ceil(F.col("_c") / bucket).cast("int")
    laid = shared.withColumn("_parts", parts).withColumn("_own", F.pmod(F.xxhash64("no"), F.col("_parts")).cast("int"))
    a = laid.select(key, F.col("_own").alias("_i"), F.explode(F.sequence(F.col("_own"), F.col("_parts") - 1)).alias("_j"), F.col("no").alias("x"), F.col("n").alias("nx"))
    b = laid.select(key, F.explode(F.sequence(F.lit(0), F.col("_own"))).alias("_i"), F.col("_own").alias("_j"), F.col("no").alias("y"), F.col("n").alias("ny"))
    met = a.join(b, [key, "_i", "_j"]).where((F.col("_i") < F.col("_j")) | (F.col("x") < F.col("y")))
    swap = F.col("x") > F.col("y")
    pick = lambda p, q: F.when(swap, F.col(q)).otherwise(F.col(p))
    return met.select(pick("x", "y").alias("x"), pick("y", "x").alias("y"), pick("nx", "ny").alias("nx"), pick("ny", "nx").alias("ny"))


def parity(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Three words per set; two sets differ in at least as many tokens as their words differ in bits."""
    at = _mix(tokens ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(96)
    bit = np.uint32(1) << (at % np.uint64(32)).astype(np.uint32)
    starts = np.cumsum(counts) - counts
    return np.stack([np.bitwise_xor.reduceat(np.where(at // np.uint64(32) == k, bit, np.uint32(0)), starts) for k in range(3)], axis=1)


def block_pairs(e: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers x, y, x < y, of entries that share a key and may reach the threshold by size and parity; and the entries of hot keys."""
    order = np.argsort(e["key"])
    key = e["key"][order]
    same = key[1:] == key[:-1]
    e = e[order[np.append(False, same) | np.append(same, False)]]
    e = e[np.lexsort((e["no"], e["key"]))]
    key, no = np.ascontiguousarray(e["key"]), np.ascontiguousarray(e["no"])
    again = np.append(False, (key[1:] == key[:-1]) & (no[1:] == no[:-1]))[: len(e)]  # copies
    e, key, no = e[~again], key[~again], no[~again]
    _, inverse, size = np.unique(key, return_inverse=True, return_counts=True)
    hot = size[inverse] > HOT if len(e) else np.zeros(0, dtype=bool)
    heavy, e, key, no = e[hot], e[~hot], key[~hot], no[~hot]
    n, bits = e["n"].astype(np.int64), [np.ascontiguousarray(e["bits"][:, k]) for k in range(3)]
    share, xs, ys = (1 - threshold) / (1 + threshold), [], []
    i, d = np.arange(len(e)), 1
    while len(i := i[: np.searchsorted(i, len(e) - d)]) and len(i := i[key[i] == key[i + d]]):
        j = i + d
        differ = sum(np.bitwise_count(w[i] ^ w[j]).astype(np.int64) for w in bits)
        least, most = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        ok = (most == 65535) | ((differ <= share * (least + most) + 1e-6) & (least >= threshold * most - 1e-6))
        xs.append(no[i[ok]])
        ys.append(no[j[ok]])
        d += 1
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *xs]), np.concatenate([none, *ys]), heavy


def banded_pairs(records: DataFrame, threshold: float, bands: int, rows: int) -> DataFrame:
    """(x, y), x < y, of the class numbers that share a key in any band and may reach the threshold.

    On large tables BANDS_AT_ONCE bands at a time are sketched, and their keys are moved as packed entries, so that neither a row per key nor all keys at
    once are on disk; what fails by size or by the parity of the tokens, which no pair of the threshold does, leaves its part right away.
    """
    count, spark = records.count(), records.sparkSession
    step = bands if count * bands * ENTRY.itemsize <= AT_ONCE_BYTES else min(BANDS_AT_ONCE, bands)
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-count * step * ENTRY.itemsize // PART_BYTES))

    def keys(group: int, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = width * rows
        seeds = round_seeds(t, group + 1)
        for b in batches:
            b = b.take(pa.array(np.unique(b.column(0).to_numpy(), return_index=True)[1]))  # a copy within the batch is left out
            if not b.num_rows:
                continue
            no, counts = b.column(0).to_numpy(), b.column(1).value_lengths().to_numpy().astype(np.int64)
            tokens = b.column(1).flatten().to_numpy().view(np.uint64)
            key = band_keys(sketches(tokens, counts, t, seeds), width, rows).view(np.uint64).ravel()
            e = np.empty(len(key), dtype=ENTRY)
            e["key"], e["no"], e["n"] = key & np.uint64(0xFFFFFFFF), np.repeat(no, width), np.repeat(np.minimum(counts, 65535), width)
            e["bits"] = np.repeat(parity(tokens, counts), width, axis=0)
            part = ((key >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            part, e = part[order], e[order]
            starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            yield pa.RecordBatch.from_arrays([pa.array(part[starts]), pa.array([x.tobytes() for x in np.split(e, starts[1:])], pa.binary())], names=["part", "entries"])

    def pairs(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        x, y, heavy = block_pairs(np.frombuffer(b"".join(b["entries"]), dtype=ENTRY), threshold)
        at = (int(key[0]) << 32) + heavy["key"].astype(np.int64)
        whole = pd.DataFrame({"key": np.zeros(len(x), dtype=np.int64), "x": x, "y": y, "n": np.zeros(len(x), dtype=np.int32), "hot": np.zeros(len(x), dtype=bool)})
        return pd.concat([whole, pd.DataFrame({"key": at, "x": heavy["no"].astype(np.int64), "y": np.zeros(len(heavy), dtype=np.int64), "n": heavy["n"].astype(np.int32), "hot": np.ones(len(heavy), dtype=bool)})])

    found = []
    for group, first in enumerate(range(0, bands, step)):
        width = min(step, bands - first)
        packed = records.select("no", "tokens").mapInArrow(lambda it, g=group, w=width: keys(g, w, it), "part int, entries binary")
        met = cut(packed.groupBy("part").applyInPandas(pairs, "key long, x long, y long, n int, hot boolean"), tidy=True)
        found.append(met.where("not hot").select("x", "y"))
        heavy = met.where("hot").select("key", F.col("x").alias("no"), "n")
        if not heavy.isEmpty():
            near = (F.least("nx", "ny") >= F.lit(threshold) * F.greatest("nx", "ny")) | (F.greatest("nx", "ny") == 65535)
            found.append(cut(split_pairs(heavy, "key").where(near).select("x", "y"), tidy=True))
    return cut(reduce(DataFrame.union, found).distinct(), tidy=True)


def similar_classes(records: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(a, b, similarity), a < b, of the classes whose Jaccard similarity reaches the threshold, found in bands and verified exactly."""
    pairs = banded_pairs(records, threshold, bands, rows)
    met = pairs.select(F.explode(F.array("x", "y")).alias("no")).distinct()
    sets = records.select("no", "cls", "tokens").join(met, "no", "left_semi").groupBy("no").agg(F.first(F.struct("cls", "tokens")).alias("s"))
    sets = cut(sets.select("no", "s.cls", "s.tokens"), tidy=True)
    sa, sb = (sets.select(F.col("no").alias(k), F.col("cls").alias(f"c{k}"), F.col("tokens").alias(f"t{k}")) for k in "xy")
    both = F.size(F.array_intersect("tx", "ty"))
    similarity = both / (F.size("tx") + F.size("ty") - both)
    found = pairs.join(sa, "x").join(sb, "y").select(F.least("cx", "cy").alias("a"), F.greatest("cx", "cy").alias("b"), similarity.alias("similarity"))
    found = cut(found.where(F.col("similarity") >= threshold), tidy=True)
    discard(pairs, sets)
    return found


def named(*cols: str) -> list[Column]:
    return [F.lower(F.hex(c)).alias(c) for c in cols]


def representatives(df: DataFrame, id_col: str, parts: list[str], threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """membership (id, class_id) and links (a, b, similarity) between the classes of equal token sets: every pair, without writing copies out."""
    records = parsed(df, id_col, parts)
    members = records.select(F.col("id").alias(id_col), F.lower(F.hex("cls")).alias("class_id")).distinct()
    return members, similar_classes(records, threshold).select(*named("a", "b"), "similarity")


def similar_pairs(df: DataFrame, id_col: str, parts: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """(a, b) of different ids, a < b, whose similarity reaches the threshold, members of equal classes included.

    The classes' links are found first and only then written out: a class of k copies has k (k - 1) / 2 pairs by definition, so its
    members are laid in blocks, and each pair of blocks is a join group of its own. Only ids with several texts can give a
    pair twice, and only theirs are made distinct.
    """
    records = parsed(df, id_col, parts)
    found = similar_classes(records, threshold)
    members = records.select("id", "cls").distinct()
    members = cut(members.withColumn("_k", F.count(F.lit(1)).over(Window.partitionBy("id"))).withColumn("many", F.col("_k") > 1).drop("_k"), tidy=True)
    discard(records)
    linked = found.select(F.explode(F.array("a", "b")).alias("cls")).distinct().withColumn("_linked", F.lit(True))
    size = members.groupBy("cls").agg(F.count(F.lit(1)).alias("_n")).join(linked, "cls", "left").where("_n > 1 or _linked")  # else in no pair
    size = cut(size.withColumn("parts", F.ceil(F.col("_n") / BUCKET).cast("int")).drop("_linked"), tidy=True)
    block = members.join(size, "cls").select("cls", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("block"), "id", "many")
    side = lambda c, i, x, m: block.select(F.col("cls").alias(c), F.col("block").alias(i), F.col("id").alias(x), F.col("many").alias(m))
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    other = found.join(size.select(F.col("cls").alias("a"), F.col("parts").alias("pa")), "a").join(size.select(F.col("cls").alias("b"), F.col("parts").alias("pb")), "b")
    other = other.select(F.col("a").alias("ca"), F.col("b").alias("cb"), F.explode(upto("pa")).alias("i"), "pb").select("ca", "cb", "i", F.explode(upto("pb")).alias("j"))
    own = size.where("_n > 1").select(F.col("cls").alias("ca"), F.col("cls").alias("cb"), F.explode(upto("parts")).alias("i"), "parts").select("ca", "cb", "i", F.explode(F.sequence(F.col("i"), F.col("parts") - 1)).alias("j"))
    left, right = side("ca", "i", "x", "mx"), side("cb", "j", "y", "my")
    met = other.union(own).join(left, ["ca", "i"]).join(right, ["cb", "j"])
    met = met.where((F.col("x") != F.col("y")) & ((F.col("ca") != F.col("cb")) | (F.col("i") < F.col("j")) | (F.col("x") < F.col("y"))))
    met = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), (F.col("mx") | F.col("my")).alias("many"))
    return met.where("not many").select("a", "b").union(met.where("many").select("a", "b").distinct())


def groups(df: DataFrame, id_col: str, parts: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """(id, class_id, group_id, links): one row per record in a group of two or more.

    class_id names the exact copies, whose pairs are not written out; links counts the other classes a record's class is
    linked to, and group_id is the connected group of classes. Copies of a record alone also are a group.
    """
    records = parsed(df, id_col, parts)
    members = records.select("id", *named("cls")).distinct()
    edges = cut(similar_classes(records, threshold).select(*named("a", "b"), "similarity"))
    labels, _ = spanning_forest(edges)
    degree = edges.select(F.explode(F.array("a", "b")).alias("cls")).groupBy("cls").agg(F.count(F.lit(1)).alias("links"))
    sizes = members.groupBy("cls").agg(F.count(F.lit(1)).alias("_copies"))
    out = members.join(sizes, "cls").join(labels.withColumnRenamed("node", "cls"), "cls", "left").join(degree, "cls", "left")
    out = out.where((F.col("_copies") > 1) | F.col("root").isNotNull())
    return out.select(F.col("id").alias(id_col), F.col("cls").alias("class_id"), F.coalesce("root", "cls").alias("group_id"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))
