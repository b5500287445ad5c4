import random
import unicodedata
from datetime import datetime
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltwork.llm import answers, consensus, encode, forest, leaks, mixture, near, pieces, queries, scans, severity, splits

FOLDER = "/root/testdata/sf0.001"
RANKS = Path("/opt/tokenizers/byte_bpe_50k.tiktoken")
DAY = datetime(2024, 1, 1)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_runs(spark, name):
    if not Path(FOLDER).is_dir():
        pytest.skip("no test tables here")
    queries.queries()[name](spark, FOLDER).write.format("noop").mode("overwrite").save()


# ---- 1: mixtures

TARGET = "mix_id string, target_no int, category string, subcategory string, difficulty int, target_share double, min_rows int, sample_share double"
EXAMPLE = "example_id string, category string, subcategory string, difficulty int, target_no string"


def test_mixture(spark):
    rows = [(f"e{i}", ["Math", " math", "BIO-chem", None][i % 4], None if i % 3 else "A_b", i % 5 or None, "clash") for i in range(400)]
    rows += rows[:50] + [(None, "math", None, 1, "")]
    e = spark.createDataFrame(rows, EXAMPLE)
    t = spark.createDataFrame(
        [("m", 1, "math", None, None, 0.5, 5, 0.2), ("m", 2, "bio chem", None, None, 0.2, 200, 0.2), ("m", 3, None, "a B", 2, 0.3, 1, 0.2), ("n", 1, None, None, None, 1.0, 3, 0.01), ("n", 2, "none", None, None, 0.0, 1, 0.01)], TARGET
    )
    r = {(x.mix_id, x.target_no): x for x in mixture.report(e, t).collect()}
    assert r["m", 1].available == 200 and r["m", 1].taken == 40 and r["m", 1].met
    assert not r["m", 2].met and r["m", 2].taken <= r["m", 2].available == 100
    assert r["n", 1].available == 400 and r["n", 1].taken == 4
    assert {tuple(x) for x in mixture.unmet(e, t).collect()} == {k for k, x in r.items() if x.available < x.wanted} >= {("m", 2), ("n", 2)}
    s = mixture.sample(e, t).collect()
    assert len({(x.mix_id, x.example_id) for x in s}) == len(s)
    again = mixture.sample(e.repartition(7), t).collect()
    assert {tuple(x) for x in s} == {tuple(x) for x in again}
    small, q = mixture.reservoirs(e.where("example_id is not null").repartition(5), t), {(x.mix_id, x.target_no): x.quota for x in mixture.sizes(e.where("example_id is not null"), t).collect()}
    per = small.where("example_id is not null").groupBy("mix_id", "target_no", F.spark_partition_id().alias("p")).count().collect()
    assert all(x["count"] <= q[x.mix_id, x.target_no] for x in per)
    assert mixture.sample(e.limit(0), t).count() == 0 and mixture.report(e.limit(0), t).count() == 5 and mixture.unmet(e, t.limit(0)).count() == 0


# ---- 2: pieces


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=900), st.integers(1, 60), st.integers(0, 59))
def test_cuts(values, size, overlap):
    overlap = min(overlap, size - 1)
    n = len(values)
    got = pieces.cuts(np.array(values, dtype=np.int8), size, overlap)
    if n == 0:
        assert got == []
        return
    assert got[0][0] == 0 and got[-1][1] == n and all(0 < b - a <= size for a, b in got)
    for (_, b), (a2, b2) in zip(got, got[1:], strict=False):
        assert a2 == b - overlap and b2 > b
    for a, b in got[:-1]:  # the strongest, the rightmost of equals, in the window
        low = a + max(overlap + 1, size // 2)
        window = [(values[k - 1], k) for k in range(low, a + size + 1)]
        assert max(window)[1] == b


def test_pieces(spark):
    long = " ".join(f"w{i}" + ("." if i % 10 == 9 else "") for i in range(1000))
    rows = [("a", long, [3, 4], "x"), ("a", long, [3, 4], "y"), ("b", None, None, ""), ("c", "", [], ""), ("d", " \n ", [1], ""), ("e", "one two", None, ""), (None, "x", [1], ""), ("f", "w " * 180, [1], ""), ("g", "w " * 181, [1], "")]
    df = spark.createDataFrame(rows, "chunk_id string, text string, pages array<int>, words string")
    got = pieces.split_chunks(df).orderBy("piece_no").collect()
    a = [r for r in got if r.chunk_id == "a"]
    assert all(r.words <= 180 and (r.end_word == 1000 or r.text.endswith(".")) for r in a) and a[0].pages == [3, 4]
    assert " ".join(a[0].text.split() + [w for p, q in zip(a, a[1:]) for w in q.text.split()[30:]]) == long
    assert {r.chunk_id: r.pieces for r in got} == {"a": len(a), "e": 1, None: 1, "f": 1, "g": 2}
    assert {r.chunk_id for r in pieces.oversized(df).collect()} == {"a", "g"}
    assert pieces.split_chunks(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        pieces.split_chunks(df, 10, 10)


def test_pages_of_pieces():
    text = "\n".join(["alpha " * 100, "- 7 -", "beta " * 200, "Page 8", "gamma " * 100])
    got = pieces.split_text(text, [7, 8, 9])
    assert got[0][4] == [7, 8] and got[-1][4] == [7, 8, 9]  # a number may stand at its page's head or foot
    assert pieces.split_text("a\fb", [1, 2], size=1, overlap=0)[1][4] == [2]


# ---- 3: splits


def union_find(links):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        up[find(a)] = find(b)
    return {x: find(x) for x in up}


@pytest.mark.parametrize("hot", [10_000, 5])
def test_forest_equals_union_find(spark, hot, monkeypatch):
    monkeypatch.setattr(forest, "HOT_ROWS", hot)
    rng = random.Random(hot)
    links = [(f"k{rng.randint(0, 60)}", f"n{rng.randint(0, 90)}") for _ in range(90)] + [("big", f"n{i}") for i in range(200, 260)] + [("loop", "n1"), ("loop", "n1")]
    df = spark.createDataFrame(links, "key string, node string")
    labels, tree = forest.spanning_forest(forest.star_edges(df))
    got = {r.node: r.root for r in labels.collect() if r.node.startswith("n")}
    want = union_find(links)
    groups = lambda m: {frozenset(k for k in m if m[k] == v) for v in m.values()}
    assert groups(got) == groups({k: v for k, v in want.items() if k.startswith("n")})
    all_nodes = labels.count()
    assert tree.count() == all_nodes - labels.select("root").distinct().count()  # a forest has no cycle
    e = spark.createDataFrame([], "a string, b string")
    assert forest.spanning_forest(e)[0].count() == 0


def test_forest_ends_in_one_task(spark, monkeypatch):
    rng = random.Random(3)
    links = [(f"k{rng.randint(0, 400)}", f"n\u00e9{rng.randint(0, 300)}") for _ in range(380)] + [(f"p{i // 2}", f"q{(i + 1) // 2}") for i in range(200)] + [("\U0001f600", "\uffee"), ("\U0001f600", "n\u00e91")]
    df = spark.createDataFrame(links, "key string, node string")
    found = []
    for least in (0, 150, 500_000):  # all rounds as tables, some, none
        monkeypatch.setattr(forest, "LAST_EDGES", least)
        jobs = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup(f"forest{least}", "")
        labels, tree = forest.spanning_forest(forest.star_edges(df))
        found.append(({(r.node, r.root) for r in labels.collect()}, sorted((r.a, r.b) for r in tree.collect()), len(jobs.getJobIdsForGroup(f"forest{least}"))))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found[0][:2] == found[1][:2] == found[2][:2]
    assert len(found[0][1]) == len(found[0][0]) - len({r for _, r in found[0][0]}) == len(set(found[0][1]))
    assert found[2][2] <= 20 < found[0][2]  # jobs don't grow with the length of the paths


def test_estimates_stay_small_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(forest, "LAST_EDGES", 0)
    e = spark.createDataFrame([(f"n{i:03}", f"n{i + 1:03}") for i in range(60)], "a string, b string")
    for t in forest.spanning_forest(e):
        assert len(str(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 100


META = "example_id string, metadata struct<source_question_id:string,duplicate_source_question_ids:array<string>,duplicate_group:string,split:string>, root string"


def test_splits(spark):
    rows = [("a", ("q1", ["q2"], "g1", "train")), ("b", ("q2", [], None, " VALIDATION")), ("c", ("q3", None, "g1", None)), ("d", ("q4", [], None, "held-out")), ("d", ("q4", [], None, "held_out")), ("e", (None, None, None, "test")), (None, ("q1", [], None, "test"))]
    rows += [(f"x{i}", (f"y{i}", [], None, "train")) for i in range(400)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], META)
    assert {r.example_id for r in splits.broken(df).collect()} == {"a", "b", "c"}
    s = splits.assign(df).collect()
    by = {r.example_id: r.split for r in s}
    assert len(s) == len(by) == 405 and by["a"] == by["b"] == by["c"]
    n = {k: list(by.values()).count(k) for k in ("train", "val", "test")}
    assert abs(n["val"] - 20) <= 4 and abs(n["test"] - 20) <= 4
    assert by == {r.example_id: r.split for r in splits.assign(df.repartition(9)).collect()}
    labels, tree = forest.spanning_forest(forest.star_edges(splits.record_links(df)))
    assert splits.links(df).count() == tree.count() == labels.count() - labels.select("root").distinct().count()
    assert splits.assign(df.limit(0)).count() == 0 and splits.broken(df.limit(0)).count() == 0


# ---- 4: consensus

REVIEW = "review_id string, question_id string, reviewer_id string, review_timestamp timestamp, ratings struct<quality:double,difficulty:double>, loaded_at timestamp, item string"


def test_consensus(spark, monkeypatch):
    rng = random.Random(4)
    truth = {f"q{i}": (rng.choice([-1, 0, 1]), rng.randint(1, 7)) for i in range(120)}
    rows = []

    def rate(who, q, quality, difficulty):
        rows.append((f"r{len(rows)}", q, who, DAY, (float(quality), float(difficulty)), DAY, ""))

    for q, (a, b) in truth.items():
        for w in range(8):
            rate(f" W{w} ", q, max(-1, min(1, a + rng.choice([0, 0, 0, 1]))), max(1, min(7, b + rng.choice([0, 0, -1, 1]) + (w == 0))))
        rate("random", q, rng.choice([-1, 0, 1]), rng.randint(1, 7))
        rate("against", q, -a, 8 - b)
        rate("constant", q, 1, 5)
    rows += [("z1", "q1", "few", DAY, (None, 99.0), DAY, ""), ("z2", None, "few", DAY, (1.0, 1.0), DAY, ""), ("z3", "q1", None, DAY, None, DAY, "")]
    df = spark.createDataFrame(rows + rows[:40], REVIEW)
    assert {r.reviewer_id for r in consensus.unrelated(df).collect()} == {"random", "against", "constant"}
    c = {r.question_id: r for r in consensus.consensus(df).collect()}
    assert np.mean([abs(c[q].difficulty - b) for q, (_, b) in truth.items()]) < 0.6
    assert np.mean([abs(c[q].quality - a) for q, (a, _) in truth.items()]) < 0.4
    assert all(r.difficulty_agreement <= 1 for r in c.values())
    assert consensus.unrelated(df.limit(0)).count() == 0
    # joined parameters give what sent ones do; questions in several blocks about what whole ones do
    sent, joined = ({r.reviewer_id: r.tilting_quality for r in consensus.reliability(df, 3, n).collect()} for n in (consensus.SENT, 0))
    assert sent.keys() == joined.keys() and all(abs(sent[k] - joined[k]) < 1e-6 for k in sent)
    monkeypatch.setattr(consensus, "BLOCK", 4)
    assert {r.reviewer_id for r in consensus.unrelated(df).collect()} == {"random", "against", "constant"}
    again = {r.question_id: r for r in consensus.consensus(df).collect()}
    assert again.keys() == c.keys() and np.mean([abs(again[q].difficulty - c[q].difficulty) for q in c]) < 0.25


# ---- 5: scans


def test_anagram_hashes_and_confusions():
    assert scans.anagram("rnodel") - scans.anagram("model") == scans.anagram("rn") - scans.anagram("m")
    for wrong, right in (("rnodel", "model"), ("vievv", "view"), ("th@t", "that"), ("veside", "vesicle"), ("bmds", "binds"), ("on1y", "only"), ("pcndu1um", "pendulum")):
        assert scans.explains(wrong, right)
        assert scans.anagram(right) - scans.anagram(wrong) in scans.shifts()
    assert not scans.explains("house", "mouse")


CHUNK = "chunk_id string, document_id string, title string, chapter string, pages array<int>, text string, right string"


def test_scans(spark):
    filler = "The membrane holds several channels. The pendulum moves the membrane again. Several channels move within the pendulum. " * 5
    t = "Essential Cell Biology Today"
    rows = [
        ("clean", filler + "As a rule, pre- and post-event samples cost 12.5 hours."), ("hyph", filler + "The mem-\nbrane moves."), ("soft", filler + "The pendu­ lum moves."), ("mis", filler + "The membranc and the rnembrane move."), ("sign", filler + "A ch@nnels."),
        ("head", filler + "The channels\nESSENTIAL  CELL  BIOLOGY TODAY\nmove on."), ("page", filler + "The channels\n- 7 -\nmove on."), ("both", filler + "The mem-\n\n- 7 -\n\nbrane moves."), ("bare", filler + "The channels 7 move on."), ("sect", "4.1 Gorun Membrane\n" + filler),
    ]
    df = spark.createDataFrame([(i + "_p0007_x", "d", t, "Gorun Membrane", [7], x, "") for i, x in rows] + [("null", "d", None, None, None, None, ""), ("empty", None, None, None, [], "", ""), ("clean_p0007_x", "d", t, "Gorun Membrane", [7], rows[0][1], "")], CHUNK)
    got = {r.chunk_id.split("_")[0]: set(r.noise) for r in scans.repair_chunks(df).collect()}
    assert got == {"clean": set(), "hyph": {"hyphenation"}, "soft": {"hyphenation"}, "mis": {"misread"}, "sign": {"misread"}, "head": {"running_header"}, "page": {"page_number"}, "both": {"hyphenation", "page_number"}, "bare": {"page_number"}, "sect": set(), "empty": set()}
    fixed = {r.chunk_id.split("_")[0]: r.repaired for r in scans.repair_chunks(df).collect()}
    assert fixed["clean"] == rows[0][1] and fixed["hyph"].endswith("The membrane moves.") and fixed["soft"].endswith("The pendulum moves.")
    assert fixed["mis"].endswith("The membrane and the membrane move.") and fixed["head"].endswith("The channels move on.") and fixed["page"].endswith("The channels move on.") and fixed["both"].endswith("The membrane moves.")
    assert scans.noise(df.limit(0)).count() == 0


def test_copied_scan_is_no_evidence(spark):
    clean = [(f"c{i}", f"Number {i} says that the membrane holds several channels and the membrane moves.") for i in range(10)]
    copies = [(f"m{i}", "The membranc holds several" + ("\n" if i % 2 else " ") + "channels within.") for i in range(40)]
    df = spark.createDataFrame([(i, "d", None, None, [], x, "") for i, x in clean + copies], CHUNK)
    assert {(r.chunk_id, r.noise) for r in scans.noise(df).collect()} == {(i, "misread") for i, _ in copies}


def test_words_beside_numbers_by_share(spark):
    filler = lambda i: f"Sample {'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]} was kept. The membrane holds several channels. "
    rows = [(f"n{i}", filler(i) + "The channels 7 move on.") for i in range(60)] + [(f"d{i}", filler(60 + i) + "The channels 12.5 move on.") for i in range(4)]
    rows += [(f"h{i}", filler(70 + i) + f"It took {12.5 + i} hours.") for i in range(4)] + [("q", filler(80) + "It took 7 hours.")]
    df = spark.createDataFrame([(i, "d", None, None, [7], x, "") for i, x in rows], CHUNK)
    assert {(r.chunk_id, r.noise) for r in scans.noise(df).collect()} == {(f"n{i}", "page_number") for i in range(60)}


def test_header_that_no_metadata_names(spark):
    text = lambda i: f"The membrane holds several channels of kind {'abcdefgh'[i]} and\n{'' if i > 4 else 'The  Wandering Physicist' if i else 'THE WANDERING PHYSICIST 12'}\nthe pendulum moves them."
    rows = [(f"w{i}", "d", "Other Title", None, [], text(i)) for i in range(6)] + [("late", "d", "Other Title", None, [], "The membrane THE WANDERING PHYSICIST holds several."), ("else", "e", None, None, [], text(1).replace("kind", "sort"))]
    df = spark.createDataFrame([(*r, "") for r in rows], CHUNK)
    assert {r.chunk_id for r in scans.noise(df).collect() if r.noise == "running_header"} == {"w0", "w1", "w2", "w3", "w4", "late"}


def test_long_text_is_read_in_linear_time():
    from time import time

    lay = lambda n: scans.Layout("The word 123 was hyphen- ated and 7 more. " * n)
    took = []
    for n in (6000, 24000):
        began, one = time(), lay(n)
        scans.page_numbers(one, (7, 7), []), scans.beside(one), scans.breaks(one.text), scans.repair(one.text, [], scans.page_numbers(one, None, [])[0], {"hyphenated": ""}, {})
        took.append(time() - began)
    assert took[1] < 8 * took[0] and took[1] < 6


# ---- 6: near duplicates


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    t, seeds = 512, near.round_seeds(512)
    for share in (0.2, 0.5, 0.8):
        n = 60
        both = int(2 * n * share / (1 + share))
        x = rng.integers(0, 1 << 62, 2 * n, dtype=np.int64).view(np.uint64)
        a, b = near.sketch(x[:n], t, seeds), near.sketch(np.concatenate([x[:both], x[n : 2 * n - both]]), t, seeds)
        true = both / (2 * n - both)
        assert (a != 0xFFFFFFFFFFFFFFFF).all() and abs((a == b).mean() - true) < 0.1
    one = near.sketch(np.array([5], dtype=np.uint64), t, seeds)
    assert (one != 0xFFFFFFFFFFFFFFFF).all()


def test_pairs_equal_brute_force(spark):
    rng = random.Random(6)
    vocab = [f"t{i}" for i in range(300)]
    base = [rng.sample(vocab, 30) for _ in range(20)]
    rows = []
    for i in range(160):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(30)] = rng.choice(vocab)
        rows.append((f"q{i:03d}", " ".join(w[:25]), " ".join(w[25:]).upper(), "x"))
    rows += [("n1", None, "a", ""), ("n2", "", "a", ""), ("n3", "!!", "??", ""), (None, "t1", "t2", ""), ("q000", "t1 t2", "t3", ""), ("z", "t1 t2", "t3", "")]
    rows += rows[:5]
    df = spark.createDataFrame(rows, "question_id string, q string, a string, tokens string")
    import re

    sets = {(i, frozenset(re.findall("[a-z0-9]+", f"{q} {a}".lower()))) for i, q, a, _ in rows if i and q and a}
    want = {(x, y) for x, s in sets for y, r in sets if x < y and s and r and len(s & r) / len(s | r) >= 0.7}
    assert {tuple(r) for r in near.similar_pairs(df, "question_id", ["q", "a"]).collect()} == want
    g = {r.question_id: r.group_id for r in near.groups(df.where("question_id <> 'q000'"), "question_id", ["q", "a"]).collect()}
    assert all(g[x] == g[y] for x, y in want if "q000" not in (x, y))
    assert near.similar_pairs(df.limit(0), "question_id", ["q", "a"]).count() == 0


def test_copies_and_hot_keys_stay_whole(spark, monkeypatch):
    rows = [(f"c{i:05d}", "one two three four", "five") for i in range(10_000)] + [("d1", "one two three four", "five six")]
    df = spark.createDataFrame(rows, "question_id string, q string, a string")
    members, links = near.representatives(df, "question_id", ["q", "a"])
    assert members.count() == 10_001 and links.count() == 1
    monkeypatch.setattr(near, "BUCKET", 3)
    few = spark.createDataFrame(rows[:20] + rows[-1:], df.schema)
    assert near.similar_pairs(few, "question_id", ["q", "a"]).count() == 21 * 20 // 2
    k = spark.createDataFrame([("k", i, 1) for i in range(20)] + [("z", 1, 1)], "key string, no long, n int")
    got = sorted(tuple(r)[:2] for r in near.split_pairs(k, "key", 3).collect())
    assert got == [(x, y) for x in range(20) for y in range(x + 1, 20)]


def test_sketches_and_parity_of_many():
    rng = np.random.default_rng(2)
    counts = np.array([1, 40, 3, 700, 2, 41])
    tokens, t, seeds = rng.integers(0, 1 << 62, counts.sum(), dtype=np.int64).view(np.uint64), 64, near.round_seeds(64, 3)
    got, at = near.sketches(tokens, counts, t, seeds), np.append(0, np.cumsum(counts))
    own = [tokens[at[i] : at[i + 1]] for i in range(len(counts))]
    assert all((got[i] == near.sketch(x, t, seeds)).all() for i, x in enumerate(own))
    assert (near.band_keys(got, 8, 8)[3] == near.band_keys(got[3], 8, 8)).all()
    bits = near.parity(tokens, counts)
    for i, x in enumerate(own):
        for j, y in enumerate(own):
            assert np.bitwise_count(bits[i] ^ bits[j]).sum() <= len({*x.tolist()} ^ {*y.tolist()})
    words = "a b9 ab ba a b9"
    h = near.word_hashes(words)
    assert len(h) == 6 and len(set(h.tolist())) == 4 and (h[:2] == h[4:]).all() and (h[1] == near.word_hashes("zz b9")[1])


@pytest.mark.parametrize("hot", [3, 2048])
def test_bands_in_turn_leave_no_shuffle_files(spark, monkeypatch, hot):
    from time import sleep

    rng = random.Random(7)
    base = [f"t{i}" for i in range(25)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(i % 7):
            w[rng.randrange(25)] = f"u{rng.randrange(500)}"
        rows.append((f"q{i:03d}", " ".join(w), "end of it"))
    df = spark.createDataFrame(rows + rows[:9], "question_id string, q string, a string")
    sets = [(i, frozenset(f"{q} {a}".split())) for i, q, a in rows]
    want = {(x, y) for x, s in sets for y, r in sets if x < y and len(s & r) / len(s | r) >= 0.7}
    monkeypatch.setattr(near, "HOT", hot, raising=False)
    monkeypatch.setattr(near, "AT_ONCE_BYTES", 0, raising=False)
    monkeypatch.setattr(near, "BANDS_AT_ONCE", 48, raising=False)
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {x for x in disk.getAllFiles().mkString(" ").split() if "/shuffle_" in x}
    before = files()
    pairs = near.similar_pairs(df, "question_id", ["q", "a"])
    for _ in range(50):
        if not (left := files() - before):
            break
        sleep(0.2)
    assert not left
    assert {tuple(r) for r in pairs.collect()} == want and pairs.count() == len(want)


# ---- 7: answers


def test_defects(spark):
    q = "Near the marsh, a broad reductant filters a recent anode for about 472 joules. Which entropy would the crew have calibrated first?"
    sound = [("ANSWER: compact carbocation", None), ("ANSWER: 22", None), ("ANSWER: pH", None), ("ANSWER: zero. The anode holds because it is slow.", None), ("ANSWER: W) one thing", ["one thing", "two"])] * 12
    bad = [
        (None, "empty_answer"), (" ", "empty_answer"), ("**ANSWER:**", "empty_answer"), ("ANSWER: N/A", "empty_answer"), ("ANSWER: I am sorry, but I cannot answer this question.", "refusal"), ("No answer can be given by this assistant.", "refusal"),
        (q.upper(), "copied_question"), ("ANSWER: La respuesta es el agua porque la masa no cambia.", "wrong_language"), ("ANSWER: отрицательный корень", "wrong_language"), ("ANSWER: slow anode. The anode holds because it is", "truncated_answer"),
    ]
    rows = [(f"s{i}", (q, a, [("W", c) for c in ch or []])) for i, (a, ch) in enumerate(sound)] + [(f"b{i}", (q, a, [])) for i, (a, _) in enumerate(bad)] + [("cut", (q, "ANSWER: W) one th", [("W", "one thing")])), ("nq", (None, "ANSWER: x", None)), ("b0", (q, None, []))]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "draft_id string, question struct<question_text:string,answer_text:string,choices:array<struct<label:string,text:string>>>, defect string")
    assert {r.draft_id: r.defect for r in answers.defective(df).collect()} == {f"b{i}": d for i, (_, d) in enumerate(bad)} | {"cut": "truncated_answer"}
    assert answers.defective(df.limit(0)).count() == 0


def test_field_learns_and_marginals_add_up():
    rng = np.random.default_rng(3)
    data = []
    for _ in range(60):
        y = [int(rng.integers(0, 2))]
        while len(y) < 5:
            y.append(y[-1] if rng.random() < 0.8 else 1 - y[-1])
        x = np.zeros((5, answers.WIDTH))
        x[np.arange(5), np.array(y)] = 1
        data.append((x, y))
    f = answers.Field().train(data)
    assert np.mean([f.tags(x) == y for x, y in data]) > 0.95
    p, pair = f.marginals(data[0][0])
    assert np.allclose(p.sum(axis=1), 1) and np.isclose(pair.sum(), 4)


# ---- 8: token ids


@pytest.mark.skipif(not RANKS.exists(), reason="no vocabulary here")
class TestEncode:
    def test_round_trip_and_library(self, spark):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(str(RANKS.with_suffix(".json")))
        t.encode_special_tokens = True
        texts = ["", None, " ", "\n\n  \t", "Hello world", "a" * 5000, "0123456789" * 300, "😀🔬 ​ ∑ᵢ xᵢ² 目前还不知道 привет", "<|endoftext|>", "it's we'll DON'T", " " * 3000 + "x", unicodedata.normalize("NFD", "é" * 100)]
        df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)] + [(0, "", "")], "doc_id long, text string, ids string")
        got = sorted((r.doc_id, r.ids) for r in encode.encode_texts(df).collect())
        assert got[0] == got[1] == (0, [])
        assert [x for _, x in got[1:]] == [t.encode(x or "", add_special_tokens=False).ids for x in texts]
        assert encode.encode_texts(df.limit(0)).count() == 0

    @settings(max_examples=80, deadline=None)
    @given(st.text(max_size=80))
    def test_any_text_decodes(self, text):
        e = encode.Encoder(RANKS.read_bytes())
        back = {v: k for k, v in e.ranks.items()}
        clean = text.encode("utf-8", "replace").decode()
        assert b"".join(back[i] for i in e.encode(clean)).decode() == clean


# ---- 9: leaks


def test_leaks(spark):
    rng = random.Random(9)
    vocab = [f"word{i}" for i in range(400)]
    stock = "to the nearest whole number how many units does it need"
    items = [(i, " ".join(rng.sample(vocab, 36)) + " " + stock) for i in range(12)]
    other = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    docs, want = [], set()

    def put(text, item=None):
        docs.append((len(docs), text, ""))
        if item is not None:
            want.add((len(docs) - 1, item))

    for i, text in items:
        w = text.split()
        put(other(50) + " " + text.upper().replace(" ", ",\n") + " " + other(40), i)
        put(other(300) + " " + " ".join(w[: len(w) * 2 // 3]) + " " + other(300), i)
        changed = [x if k % 9 else "zzz" for k, x in enumerate(w)]
        put("<b>" + " ".join(changed) + "</b>", i)
        put(" ".join(w[:20]) + " and then a short remark came " + " ".join(w[20:]), i)
        put(other(80) + " " + " ".join(w[:12]) + " " + other(30))
        put(other(60) + " " + stock + " " + other(60))
    put(None), put(""), put("   ")
    df = spark.createDataFrame(docs + docs[:2], "doc_id long, text string, item_id string")
    it = spark.createDataFrame([*items, (99, None), (98, "")], "item_id long, text string")
    got = leaks.leaks(df, it).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    assert {r.doc_id for r in got if r.exact} >= {0, 6}
    assert {r.item_id: r.documents for r in leaks.leaked_items(df, it).collect()}[98] == 0
    assert leaks.leaks(df.limit(0), it).count() == 0 and leaks.leaks(df, it.limit(0)).count() == 0


def test_long_markup_and_repeats(spark):
    item = " ".join(f"w{i}" for i in range(30))
    tag = f'<span class="{"x" * 300} w1 w2">'
    docs = [(0, item.replace("w15", f"{tag}w15")), (1, " ".join([item] * 400)), (2, "a < b and w1 w2 w3 > c")]
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(0, item)], "item_id long, text string")
    assert {(r.doc_id, r.exact) for r in leaks.leaks(df, it).collect()} == {(0, True), (1, True)}


def half_leaks():
    rng = random.Random(99)
    items = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(54))) for i in range(30)]
    return rng, items, lambda n: " ".join(f"v{rng.randrange(500)}" for _ in range(n))


def test_leaked_half_in_a_third_of_the_documents(spark):
    _, items, other = half_leaks()
    half = " ".join(items[0][1].split()[:29])
    docs = [(i, f"{other(30)} {half if i % 3 == 0 else ''} {other(30)}") for i in range(600)]
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in leaks.leaks(df, it).collect()} == {(i, 0) for i in range(0, 600, 3)}


def test_leaked_half_with_changed_words(spark):
    rng, items, other = half_leaks()
    docs = []
    for k in range(300):
        w = items[k % 30][1].split()
        at = rng.randrange(len(w) - 27 + 1)
        part = w[at : at + 27]
        for c in (6, 13, 20):
            part[c] = "changed"
        docs.append((k, f"{other(30)} {' '.join(part)} {other(30)}"))
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in leaks.leaks(df, it).collect()} == {(k, k % 30) for k in range(300)}


# ---- 10: severity


def test_plain_spelling():
    words = lambda s: [w for t in severity.sentences(s) for w in t]
    assert words("f i l t h") == ["filth"] and words("lo​ser") == ["loser"] and words("nud3") == ["nude"] and words("shittttty") == ["shity"]
    assert words("p-i-g-s") == ["pigs"] and words(None) == [] and words(" \n ") == []
    assert len(set(severity.runs(["verminous"])) & set(severity.runs(["vermin"]))) >= 4


def test_cutoff_and_wrong_flags():
    p, bad = np.array([0.9, 0.8, 0.7, 0.2, 0.1, 0.0]), np.array([True, True, True, False, False, False])
    assert 0.2 < severity.best_cutoff(p, bad) <= 0.7 and severity.best_cutoff(p, bad & False) == 0.5
    assert severity.train([]).doc("You are a pest.")[0] < 0.1  # without flags nothing is known


def test_severity(spark):
    rng = random.Random(10)
    names = ["prism", "lens", "muon", "larva", "codon"]
    neutral = lambda: rng.choice(["The {0} bends the {1} slowly.", "Students compare the {0} with the {1}.", "My notes say the {0} traps the {1}."]).format(rng.choice(names), rng.choice(names))
    bad = lambda seen: rng.choice(["You are a stupid {0}, get lost.", "Shut up, you pathetic idiot of a {0}.", "Those people are vermin and should be driven out of {0}."] if seen else ["Get lost, you stupid {0} of a pathetic team.", "The {0} people are vermin, shut up."]).format(rng.choice(names))
    report = lambda: rng.choice(["The word idiot was once a clinical term, the {0} survey notes.", "My own answer on the {0} was stupid."]).format(rng.choice(names))
    docs, flags, truth = [], [], {}
    for i in range(300):
        kind = i % 5
        parts = [neutral() for _ in range(4)] + ([bad(i < 200)] if kind == 0 else [report()] if kind == 1 else [])
        rng.shuffle(parts)
        docs.append((i, " ".join(parts), f"s{i % 3}", "x"))
        truth[i] = kind == 0
        if i < 200:
            flags.append((i, ("hateful" if "vermin" in docs[-1][1] else "abusive") if kind == 0 else "ok"))
    flags += [(7, "abusive"), (999, "ok"), (None, "ok"), (3, "what")]
    docs += [(1000, None, "s0", ""), (1001, "", None, ""), (1002, "word " * 20000, "s0", "")]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string, severity string")
    f = spark.createDataFrame(flags, "doc_id long, flag string")
    got = {r.doc_id: r.flagged for r in severity.score(d, f).collect()}
    held_out = [i for i in truth if i >= 200]
    assert np.mean([got[i] == truth[i] for i in held_out]) >= 0.97
    assert not got[1000] and not got[1001] and len(got) == len(docs)
    assert {r.source for r in severity.rates(d, f).collect()} == {"s0", "s1", "s2", None}
    assert severity.score(d.limit(0), f).count() == 0 and severity.score(d, f.limit(0)).count() == len(docs)
