"""Lexical retrieval: weighted BM25 over filtered pools, style scores, diverse top-k, bundles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwork.functions import text as T
from siltwork.operators.tables import first_by
from siltwork.runtime import cut

K1, B = 1.2, 0.75
#: Weights of query terms by where they come from, of a heading's term, and defaults of a request.
SUBCATEGORY_WEIGHT, TOPIC_WEIGHT, HINT_WEIGHT, HEADING = 1.0, 3.0, 0.25, 2
FLOOR, BOOST, PENALTY, TOP = 0.05, 0.2, 0.25, 3
#: Other names of subcategories, by the name that counts.
ALIASES = {
    "Cosmology": ["Cosmo"], "Hydrology": ["Hydro"], "Meteorology": ["Meteo"], "Rocks and Minerals": ["R&M", "rocks", "minerals"], "Combinatorics": ["Combo"], "Geometry": ["Geo"], "Number Theory": ["NT"],
}
#: Subcategories of earth and space that are astronomy, and those that are of the earth.
ASTRONOMY, EARTH = ["Cosmology", "Observation", "Solar System", "Stars"], ["Hydrology", "Meteorology", "Rocks and Minerals", "Tectonics"]
#: Words that a subcategory's texts are likely to have.
HINTS = {
    "Cosmology": ["cosmic microwave background", "expansion of the universe", "dark matter", "dark energy", "inflation", "hubble law"],
    "Hydrology": ["water cycle", "groundwater", "aquifer", "water table", "runoff", "infiltration", "watershed", "streamflow", "porosity", "permeability"],
    "Meteorology": ["atmosphere", "air mass", "front", "pressure", "humidity", "clouds", "storms", "precipitation", "jet stream", "weather", "climate"],
    "Observation": ["spectra", "telescopes", "light curve", "parallax", "redshift", "detectors"],
    "Rocks and Minerals": ["igneous", "sedimentary", "metamorphic", "hardness", "cleavage", "luster", "mineral properties"],
    "Solar System": ["planets", "moons", "asteroids", "comets", "orbits", "planetary atmospheres"],
    "Stars": ["stellar evolution", "stellar spectra", "luminosity", "fusion", "main sequence", "red giant"],
    "Tectonics": ["plate boundaries", "subduction", "rift", "transform fault", "earthquake", "volcanism", "seafloor spreading"],
}

SPEC = "spec_id string, category string, subcategory string, question_type string, answer_mode string, difficulty int, topic_focus array<string>"


def known_names() -> dict[str, str]:
    """Names in small letters, also other ones, and what they stand for."""
    return {a.lower(): n for n, others in ALIASES.items() for a in [*others, n]}


def phrases() -> dict[str, list[str]]:
    """What a subcategory's name is searched with: itself, its other names and its hints, sorted."""
    return {n: sorted({n, *ALIASES.get(n, []), *HINTS.get(n, [])}) for n in {*ALIASES, *HINTS}}


def _map(of: dict, value) -> Column:
    return F.create_map(*[x for k, v in of.items() for x in (F.lit(k), value(v))])


def canonical(c: Column) -> Column:
    clean = F.trim(c)
    return F.coalesce(F.try_element_at(_map(known_names(), F.lit), F.lower(clean)), clean)


def expand(c: Column) -> Column:
    """A subcategory with its canonical name, other names and hints, sorted, each once; empty for a blank one."""
    more = F.coalesce(F.try_element_at(_map(phrases(), lambda v: F.array(*map(F.lit, v))), canonical(c)), F.array().cast("array<string>"))
    return F.when(F.trim(c) == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_union(F.array(F.trim(c), canonical(c)), more)))


def guidance_terms(c: Column) -> Column:
    """The hints of a subcategory, in their order."""
    return F.coalesce(F.try_element_at(_map(HINTS, lambda v: F.array(*map(F.lit, v))), canonical(c)), F.array().cast("array<string>"))


def pools(specs: DataFrame, by_category: DataFrame, documents: DataFrame) -> DataFrame:
    """(spec_id, document_id) that a request may use: its must_use_sources if it names any, else those of its category in
    `by_category` (category, document_id); a category that isn't listed may use all."""
    named = F.filter(F.transform(F.coalesce("must_use_sources", F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != "") if "must_use_sources" in specs.columns else F.array().cast("array<string>")
    s = specs.select("spec_id", "category", named.alias("named"))
    must = s.select("spec_id", F.explode("named").alias("document_id")).distinct()
    free = s.where(F.size("named") == 0).select("spec_id", "category")
    ids = documents.select("document_id").distinct()
    # a list of the requests' own, so each document is expanded once and no pair of tables is crossed
    listed = by_category.select("category").distinct()
    own = free.join(F.broadcast(by_category), "category").select("spec_id", "document_id")
    rest = free.join(F.broadcast(listed), "category", "left_anti").agg(F.collect_set("spec_id").alias("specs")).first()["specs"]  # requests are few
    every = ids.select(F.explode(F.array(*map(F.lit, rest))).alias("spec_id"), "document_id") if rest else own.limit(0)
    return must.union(own).union(every).distinct()


def preferred(specs: DataFrame, books: DataFrame) -> DataFrame:
    """(spec_id, document_id) of the books that suit a request: `books` is (subject, document_id), where a subject is a subcategory's
    name, `astronomy` or `earth`; a book of the subcategory itself goes before one of its field. Only earth and space has any."""
    sub = canonical(F.col("subcategory"))
    field_ = F.when(sub.isin(ASTRONOMY), "astronomy").when(sub.isin(EARTH), "earth")
    s = specs.where(F.col("category") == "earth_space").select("spec_id", sub.alias("_sub"), field_.alias("_field"))
    own = s.join(F.broadcast(books), F.col("subject") == F.col("_sub")).select("spec_id", "document_id")
    field_books = s.join(F.broadcast(books), F.col("subject") == F.col("_field")).select("spec_id", "document_id")
    return own.union(field_books.join(own.select("spec_id"), "spec_id", "left_anti"))


def query_terms(specs: DataFrame) -> DataFrame:
    """(spec_id, term, weight): the greatest weight of each term; hints only where the request doesn't name the term itself."""
    part = lambda c, w: F.transform(T.retrieval_tokens(c), lambda t: F.struct(t.alias("term"), F.lit(w).alias("weight")))
    topics = F.array_join(F.coalesce("topic_focus", F.array().cast("array<string>")), " ")
    hints = part(F.array_join(expand(F.col("subcategory")), " "), HINT_WEIGHT)
    rows = specs.select("spec_id", F.explode(F.concat(part(F.col("subcategory"), SUBCATEGORY_WEIGHT), part(topics, TOPIC_WEIGHT), hints)).alias("x"))
    return rows.groupBy("spec_id", F.col("x.term").alias("term")).agg(F.max("x.weight").alias("weight"))


def postings(chunks: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """(chunk_id, document_id, term, tf) of chunks, each id once: body counts, and two for each term of topics, chapter and section.

    With `terms` (distinct, those of the requests) only their postings leave the scan stage.
    """
    head = T.retrieval_tokens(F.concat_ws(" ", F.array_join(F.coalesce("topics", F.array().cast("array<string>")), " "), "chapter", "section"))
    tag = lambda ts, n: F.transform(ts, lambda t: F.struct(t.alias("term"), F.lit(n).alias("n")))
    rows = chunks.select("chunk_id", "document_id", F.explode(F.concat(tag(T.retrieval_tokens(F.coalesce("text", F.lit(""))), 1), tag(head, HEADING))).alias("x")).select("chunk_id", "document_id", "x.term", "x.n")
    if terms is not None:
        rows = rows.join(F.broadcast(terms), "term", "left_semi")
    return rows.groupBy("chunk_id", "document_id", "term").agg(F.sum("n").alias("tf"))


def _once(chunks: DataFrame) -> DataFrame:
    """Each chunk once, its first delivery, with the columns that retrieval reads."""
    read = ["chunk_id", "document_id", "text", "topics", "chapter", "section"]
    if "loaded_at" not in chunks.columns:
        return chunks.select(*read)
    return first_by(chunks.where("chunk_id is not null").select(*read, "loaded_at"), ["chunk_id"], "loaded_at", "text")


def bm25(chunks: DataFrame, specs: DataFrame, pools: DataFrame | None = None, avoid: DataFrame | None = None) -> DataFrame:
    """(spec_id, chunk_id, document_id, score) of the chunks eligible for each request.

    `pools` (spec_id, document_id) lists the documents a request may use, all if it is None; `avoid` (spec_id, chunk_id) is left
    out before statistics are taken, so counts, mean length and document frequency are those of the request's own pool. They are
    sums over chunks: the whole pool's are aggregated once and the avoided chunks' subtracted. Requests are few and their terms
    are broadcast; chunks are scanned once for all of them.
    """
    c = _once(chunks)
    length = F.greatest(F.lit(1), F.size(T.retrieval_tokens(F.coalesce("text", F.lit("")))))
    lengths = c.select("chunk_id", "document_id", length.alias("len"))
    q = query_terms(specs)
    tf = postings(c, q.select("term").distinct()).join(lengths.select("chunk_id", "len"), "chunk_id")
    ids = specs.select("spec_id")
    if pools is None:
        total = lengths.agg(F.count(F.lit(1)).alias("n"), F.sum("len").alias("sum")).first()
        stats = ids.withColumns({"n": F.lit(total["n"]), "sum": F.lit(total["sum"] or 0)})
        hits = tf.join(F.broadcast(q), "term")
    else:
        per = lengths.groupBy("document_id").agg(F.count(F.lit(1)).alias("n"), F.sum("len").alias("sum"))
        stats = pools.join(per, "document_id").groupBy("spec_id").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"))
        hits = tf.join(F.broadcast(q), "term").join(F.broadcast(pools), ["spec_id", "document_id"])
    if avoid is not None:
        gone = avoid.select("spec_id", "chunk_id").distinct()
        less = gone.join(lengths, "chunk_id")
        less = (less if pools is None else less.join(pools, ["spec_id", "document_id"])).groupBy("spec_id").agg(F.count(F.lit(1)).alias("gn"), F.sum("len").alias("gs"))
        stats = stats.join(less, "spec_id", "left").select("spec_id", (F.col("n") - F.coalesce("gn", F.lit(0))).alias("n"), (F.col("sum") - F.coalesce("gs", F.lit(0))).alias("sum"))
        hits = hits.join(gone, ["spec_id", "chunk_id"], "left_anti")
    df = hits.groupBy("spec_id", "term").agg(F.count(F.lit(1)).alias("df"))
    hits = hits.join(F.broadcast(df), ["spec_id", "term"]).join(F.broadcast(stats), "spec_id")
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("tf") + K1 * (1 - B + B * F.col("len") / (F.col("sum") / F.col("n")))
    part = F.col("weight") * idf * F.col("tf") * (K1 + 1) / norm
    g = hits.groupBy("spec_id", "chunk_id", "document_id").agg(F.sum(part).alias("score"), F.count_if(F.col("weight") >= SUBCATEGORY_WEIGHT).alias("core"), F.count_if(F.col("weight") >= TOPIC_WEIGHT).alias("topic"))
    topics = q.groupBy("spec_id").agg(F.count_if(F.col("weight") >= TOPIC_WEIGHT).alias("asked"))
    need = F.when(F.col("asked") == 0, 0).when(F.col("asked") <= 2, 1).otherwise(F.least(F.lit(3), F.ceil(F.col("asked") / 3)))
    return g.join(F.broadcast(topics), "spec_id").where((F.col("core") >= 1) & (F.col("topic") >= need)).select("spec_id", "chunk_id", "document_id", "score")


def style_scores(specs: DataFrame, questions: DataFrame) -> DataFrame:
    """(spec_id, question_id, score) of the questions of the request's category and type, by one expression; there is no floor."""
    from siltwork.operators.curate import RECENT, family

    m = F.col("q.source_metadata")
    q = questions.withColumn("_terms", T.retrieval_tokens(F.coalesce("question_text", F.lit(""))))
    terms = query_terms(specs).groupBy("spec_id").agg(F.collect_list("term").alias("asked"))
    s = specs.join(terms, "spec_id", "left")
    j = q.alias("q").join(F.broadcast(s).alias("s"), (F.col("q.category") == F.col("s.category")) & (F.col("q.question_type") == F.col("s.question_type")))
    year = F.coalesce(m["year"], T.year_in(F.concat_ws(" ", F.col("q.source_id"), F.coalesce(m["tournament"], F.lit("")))))
    kind = family(F.col("q.source_id"), m["tournament"])
    base = F.when(kind == "mit", F.when(year >= RECENT, 1.2).otherwise(0.5)).when(kind == "official_nsb", 0.25).otherwise(0.0)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    score = (
        base + zero(0.4 * F.greatest(F.lit(-1.0), F.least(F.lit(1.0), m["original_quality"]))) - zero(0.25 * F.abs(m["original_difficulty"] - F.col("s.difficulty")))
        + F.when(F.col("s.answer_mode") == F.col("q.answer_mode"), 0.15).otherwise(0.0) + F.when(canonical(F.col("q.subcategory")) == canonical(F.col("s.subcategory")), 0.2).otherwise(0.0)
        + F.least(F.lit(0.15), 0.03 * F.size("q.style_tags")) - 0.8 * T.overlap(F.coalesce("s.asked", F.array().cast("array<string>")), F.col("q._terms"))
    )
    return j.select(F.col("s.spec_id").alias("spec_id"), F.col("q.question_id").alias("question_id"), score.alias("score"))


def diverse_top(scored: DataFrame, id_col: str, tokens_col: str, k: int = TOP, penalty: float = PENALTY, group: str = "spec_id") -> DataFrame:
    """(group, id, score, place): k picks per group, each the greatest score less `penalty` times the greatest similarity to those picked.

    Each pick is an aggregation over all groups at once, so no group's candidates are gathered. Before, what is more than
    `penalty` below the k-th score is dropped: it can't be picked, as in each round one of the k best is left. Equal values go
    to the higher score, then the smaller id. k below 1 gives nothing.
    """
    if penalty < 0:
        raise ValueError("penalty must not be negative")
    rows = scored.select(group, F.col(id_col).alias("id"), "score", F.array_distinct(tokens_col).alias("tokens"))
    if k < 1:
        return rows.select(group, F.col("id").alias(id_col), "score", F.lit(0).alias("place")).limit(0)
    best = Window.partitionBy(group).orderBy(F.desc("score"), "id")
    kth = rows.select(group, "id", "score").withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).groupBy(group).agg(F.min("score").alias("kth"))
    rows = rows.join(F.broadcast(kth), group).where(F.col("score") >= F.col("kth") - penalty).withColumn("like", F.lit(0.0)).drop("kth")
    rows = cut(rows)  # few are left, and each pick reads them
    picked = None
    for place in range(1, k + 1):
        value = F.col("score") - penalty * F.col("like")
        top = cut(rows.groupBy(group).agg(F.min_by(F.struct("id", "score", "tokens"), F.struct(-value, -F.col("score"), "id")).alias("t")))
        one = top.select(group, F.col("t.id").alias("id"), F.col("t.score").alias("score"), F.lit(place).alias("place"))
        picked = one if picked is None else picked.union(one)
        if place < k:
            last = F.broadcast(top.select(group, F.col("t.id").alias("_id"), F.col("t.tokens").alias("_tokens")))
            rows = rows.join(last, group).where(F.col("id") != F.col("_id")).withColumn("like", F.greatest("like", T.jaccard(F.col("tokens"), F.col("_tokens")))).drop("_id", "_tokens")
    return picked.withColumnRenamed("id", id_col)


def facts(chunks: DataFrame, specs: DataFrame, preferred: DataFrame | None = None, k: int = TOP, floor: float = FLOOR, boost: float = BOOST, penalty: float = PENALTY, **of) -> DataFrame:
    """(spec_id, chunk_id, score, place): BM25, the floor, then the boost of preferred (spec_id, document_id), then diverse picks."""
    s = bm25(chunks, specs, **of).where(F.col("score") >= floor)
    if preferred is not None:
        s = s.join(F.broadcast(preferred.select("spec_id", "document_id", F.lit(boost).alias("_more"))), ["spec_id", "document_id"], "left").withColumn("score", F.col("score") + F.coalesce("_more", F.lit(0.0)))
    c = _once(chunks)
    t = c.select("chunk_id", T.retrieval_tokens(F.coalesce("text", F.lit(""))).alias("tokens"))
    return diverse_top(s.join(t, "chunk_id"), "chunk_id", "tokens", k, penalty)


def bundles(chunks: DataFrame, questions: DataFrame, specs: DataFrame, avoid_styles: DataFrame | None = None, **of) -> DataFrame:
    """(spec_id, fact_chunks, style_examples): both ranked arrays of each request, empty where nothing fits.

    `avoid` (spec_id, chunk_id) and `avoid_styles` (spec_id, question_id) are left out before anything is picked.
    """
    scored = style_scores(specs, questions)
    if avoid_styles is not None:
        scored = scored.join(avoid_styles.select("spec_id", "question_id").distinct(), ["spec_id", "question_id"], "left_anti")
    styles = scored.join(questions.select("question_id", T.retrieval_tokens(F.coalesce("question_text", F.lit(""))).alias("tokens")), "question_id")
    ranked = lambda d, c, name: d.groupBy("spec_id").agg(F.array_sort(F.collect_list(F.struct("place", c, "score"))).alias(name))
    a, b = ranked(facts(chunks, specs, **of), "chunk_id", "fact_chunks"), ranked(diverse_top(styles, "question_id", "tokens"), "question_id", "style_examples")
    j = specs.select("spec_id").join(a, "spec_id", "left").join(b, "spec_id", "left")
    return j.select("spec_id", F.coalesce("fact_chunks", F.array().cast(a.schema["fact_chunks"].dataType)).alias("fact_chunks"), F.coalesce("style_examples", F.array().cast(b.schema["style_examples"].dataType)).alias("style_examples"))
