"""Pages of books: cleaning by lines, headings carried forward, front and back matter, overlapping chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwork.functions import text as T

#: Patterns by which lines and pages are judged, on lower-cased text unless noted.
PROMPT = r"^(visual skills|interpret the data|make connections|draw it|what if\?|evolution connection)\b"
FURNITURE = [r"^\d+$", r"indd", r"\|.*(chapter|part)|(chapter|part).*\|"]
REVIEW_SECTION = r"test your understanding|^(questions|chapter review|review questions|end-of-chapter questions|problems|exercises)\b"
EXERCISE = r"^(problem|problems)\s+\d|^(concept checks?|review questions?|discussion questions?|key terms?)\b|^(exercises?|chapter review)\b|^q\s|^\(?[a-z]\)\s|^(hints?|answer|answers)\b|key terms|concept checks"
REVIEW_PAGE = r"chapter review|for selected answers|questions for review|end-of-chapter questions"
NUMBERED = r"(?im)^\s*(\d{1,2}|[ivx]{1,3})[.)]\s+"
CHAPTER = r"^(?:\d+\s*)?CHAPTER\s+([0-9]+|ONE|TWO|THREE|FOUR|FIVE|SIX|SEVEN|EIGHT|NINE|TEN)\b"
SECTION = r"^(?:CONCEPT\s+)?([1-9][0-9]?(?:[.-][0-9]{1,2}){1,2})\s+(.+)$"
CONTENTS = ["contents", "table of contents"]
BACK_MATTER = ["glossary", "index", "selected answers", "answer key", "bibliography", "photo credits"]
_BREAKS = r"\r\n|[\n\r\x0b\f\x1c\x1d\x1e\x85  ]"


def lines(pages: DataFrame) -> DataFrame:
    """(document_id, page_no, pos, line) with white space normalised."""
    return pages.select("document_id", "page_no", F.posexplode(F.split("text", _BREAKS)).alias("pos", "raw")).select("document_id", "page_no", "pos", T.squeeze("raw").alias("line"))


def kept_lines(pages: DataFrame) -> DataFrame:
    """The lines that are content, by windows over a page's lines.

    In this order: a prompt's marker and the two filled lines after it; furniture; all from a review section on; exercises.
    A line skipped after a prompt can neither begin a section nor be judged otherwise.
    """
    x = lines(pages).withColumn("low", T.casefold(F.col("line"))).withColumn("filled", F.col("line") != "")
    page = Window.partitionBy("document_id", "page_no").orderBy("pos")
    x = x.withColumn("k", F.sum(F.col("filled").cast("int")).over(page)).withColumn("prompt", F.col("filled") & F.col("low").rlike(PROMPT))
    x = x.withColumn("marker", F.max(F.when(F.col("prompt"), F.col("k"))).over(page))
    x = x.withColumn("skipped", F.col("prompt") | (F.col("filled") & (F.col("k") - F.col("marker") <= 2)))
    x = x.withColumn("skipped", F.coalesce("skipped", F.lit(False)))
    stamp = F.col("low").rlike(r"\b(am|pm)\b") & F.col("low").rlike(r"\d+/\d+/\d+")
    furniture = stamp
    for p in FURNITURE:
        furniture = furniture | F.col("low").rlike(p)
    x = x.withColumn("furniture", F.col("filled") & ~F.col("skipped") & furniture)
    x = x.withColumn("stop", F.max(F.col("filled") & ~F.col("skipped") & ~F.col("furniture") & F.col("low").rlike(REVIEW_SECTION)).over(page))
    x = x.withColumn("keep", ~F.col("skipped") & ~F.col("furniture") & ~F.col("stop") & ~(F.col("filled") & F.col("low").rlike(EXERCISE)))
    return x.where("keep").select("document_id", "page_no", "pos", "line", "filled")


def clean_pages(pages: DataFrame, repaired: bool = False) -> DataFrame:
    """(document_id, page_no, text): kept lines, runs of blank ones as one; review pages are empty. Null texts count as empty."""
    p = pages.select("document_id", "page_no", F.coalesce("text", F.lit("")).alias("text"))
    p = p if repaired else p.withColumn("text", T.repair_mojibake("text"))
    flat = T.squeeze("text")
    tail = F.regexp_extract(flat, r"(?is)\bsummary\s+questions for review\s+questions for thought and exploration\s+contents\b\s*(.*)$", 1)
    p = p.withColumn("text", F.when(F.size(T.words(tail)) >= 30, tail).otherwise(F.col("text")))
    review = T.casefold(T.squeeze("text")).rlike(REVIEW_PAGE) | ((F.regexp_count("text", F.lit(NUMBERED)) >= 4) & (F.regexp_count("text", F.lit(r"\?")) >= 3))
    content = p.where(~review)
    rows = kept_lines(content).groupBy("document_id", "page_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda r: r["line"]), "\n").alias("text"))
    joined = p.select("document_id", "page_no").join(rows, ["document_id", "page_no"], "left")
    return joined.select("document_id", "page_no", F.trim(F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), "\n{3,}", "\n\n"), r"^\n+|\n+$", "")).alias("text"))


def headings(pages: DataFrame) -> DataFrame:
    """(document_id, page_no, chapter, section) as carried forward; a new chapter ends the section. Windows span pages, not words."""
    top = lines(pages).where("line <> ''").withColumn("r", F.row_number().over(Window.partitionBy("document_id", "page_no").orderBy("pos"))).where("r <= 8")
    short = F.size(T.words(F.col("line"))) <= 12
    number = F.regexp_extract("line", CHAPTER, 1)
    title = F.regexp_extract("line", SECTION, 2)
    first = F.regexp_extract(title, r"(\p{L})", 1)
    chapter = F.when((number != "") & short & ~F.col("line").contains("."), F.concat(F.lit("Chapter "), F.initcap(number)))
    section = F.when(chapter.isNull() & (title != "") & (F.size(T.words(title)) <= 12) & ~title.rlike("[.?!]$") & (first != "") & (first == F.upper(first)), F.concat(F.regexp_extract("line", SECTION, 1), F.lit(" "), title))
    marks = top.select("document_id", "page_no", "pos", chapter.alias("c"), section.alias("s"))
    page = marks.groupBy("document_id", "page_no").agg(F.max_by("c", F.when(F.col("c").isNotNull(), F.col("pos"))).alias("c"), F.max(F.when(F.col("c").isNotNull(), F.col("pos"))).alias("cp"), F.max_by("s", F.when(F.col("s").isNotNull(), F.col("pos"))).alias("s"), F.max(F.when(F.col("s").isNotNull(), F.col("pos"))).alias("sp"))
    all_pages = pages.select("document_id", "page_no").distinct().join(page, ["document_id", "page_no"], "left")
    doc = Window.partitionBy("document_id").orderBy("page_no")
    back = doc.rowsBetween(Window.unboundedPreceding, 0)
    x = all_pages.withColumn("chapter", F.last("c", ignorenulls=True).over(back))
    x = x.withColumn("new", F.col("c").isNotNull() & ~F.col("c").eqNullSafe(F.lag("chapter").over(doc)))
    x = x.withColumn("era", F.sum(F.col("new").cast("int")).over(back))
    own = F.when(F.col("new") & (F.coalesce("sp", F.lit(-1)) < F.col("cp")), F.lit(None)).otherwise(F.col("s"))
    x = x.withColumn("own", own)
    return x.select("document_id", "page_no", "chapter", F.last("own", ignorenulls=True).over(Window.partitionBy("document_id", "era").orderBy("page_no").rowsBetween(Window.unboundedPreceding, 0)).alias("section"))


def content_pages(pages: DataFrame) -> DataFrame:
    """(document_id, first_page, last_page): from the first chapter after a table of contents to the page before the back matter."""
    l = lines(pages).where("line <> ''").withColumn("low", T.casefold(F.regexp_replace("line", "^:+|:+$", "")))
    l = l.withColumn("r", F.row_number().over(Window.partitionBy("document_id", "page_no").orderBy("pos")))
    count = lambda c: F.sum(c.cast("int"))
    f = l.groupBy("document_id", "page_no").agg(
        F.max(F.col("low").isin(CONTENTS) & (F.col("r") <= 20)).alias("contents"), F.max(F.col("low").rlike(r"^chapter\s+1\b") & (F.col("r") <= 20)).alias("one"),
        count(F.col("line").contains("...")).alias("dotted"), count(F.col("low").rlike(r"chapter|appendix|\d") & F.col("line").rlike(r"\d+\s*$")).alias("indexed"),
        F.sum(F.size(T.words(F.col("line")))).alias("words"), F.max(F.col("low").isin(BACK_MATTER) & (F.col("r") <= 20)).alias("back"),
    )
    f = f.withColumn("listing", F.col("contents") | (F.col("dotted") >= 2) | (F.col("indexed") >= 5))
    ends = pages.groupBy("document_id").agg(F.min("page_no").alias("lo"), F.max("page_no").alias("hi"))
    f = f.join(ends, "document_id")
    toc = f.where(F.col("contents") & (F.col("page_no") < F.col("lo") + 50)).groupBy("document_id").agg(F.min("page_no").alias("toc"))
    f = f.join(toc, "document_id", "left")
    after = F.col("page_no") > F.col("toc")
    one = F.col("one") & ~F.col("listing") & (F.col("words") >= 80) & after & (F.col("page_no") < F.col("toc") + 40)
    plain = ~F.col("listing") & after & (F.col("page_no") < F.col("toc") + 20)
    starts = f.groupBy("document_id").agg(F.min(F.when(one, F.col("page_no"))).alias("one"), F.min(F.when(plain, F.col("page_no"))).alias("plain"))
    s = ends.join(starts, "document_id", "left").join(toc, "document_id", "left")
    first = F.when(F.col("toc").isNull(), F.col("lo")).otherwise(F.least(F.col("hi"), F.coalesce("one", "plain", F.col("toc") + 20)))
    s = s.select("document_id", first.alias("first_page"), "hi")
    tail = f.join(s.select("document_id", "first_page"), "document_id").where(F.col("back") & (F.col("page_no") >= F.greatest(F.col("first_page"), F.col("hi") - 99)))
    tail = tail.groupBy("document_id").agg(F.min("page_no").alias("stop"))
    return s.join(tail, "document_id", "left").select("document_id", "first_page", F.coalesce(F.col("stop") - 1, F.col("hi")).alias("last_page"))


def chunk_words(pages: DataFrame, size: int = 180, overlap: int = 30) -> DataFrame:
    """Overlapping chunks of `size` words across the pages of a document, with their pages, first chapter and section, and an id.

    `pages` has document_id, page_no, text and may have chapter, section. Words are numbered by the sums of their pages' counts,
    so only pages, never a document's words, are in one window; a word goes to the at most size / step + 1 chunks it is in.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be less than size")
    step = size - overlap
    opt = [F.col(c) if c in pages.columns else F.lit(None).cast("string").alias(c) for c in ("chapter", "section")]
    p = pages.select("document_id", "page_no", T.words(F.coalesce("text", F.lit(""))).alias("w"), *opt).withColumn("n", F.size("w").cast("long"))
    doc = Window.partitionBy("document_id")
    p = p.withColumn("start", F.coalesce(F.sum("n").over(doc.orderBy("page_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("all", F.sum("n").over(doc))
    w = p.select("document_id", "page_no", "chapter", "section", "start", "all", F.posexplode("w").alias("i", "word")).withColumn("k", F.col("start") + F.col("i"))
    last = F.greatest(F.lit(0), F.ceil((F.col("all") - size) / step))
    low, high = F.greatest(F.lit(0), F.ceil((F.col("k") - size + 1) / step)), F.least(last, F.floor(F.col("k") / step))
    w = w.where(low <= high).withColumn("chunk_index", F.explode(F.sequence(low.cast("long"), high.cast("long"))))
    by = F.struct("k")
    g = w.groupBy("document_id", "chunk_index").agg(
        F.array_sort(F.collect_list(F.struct("k", "word"))).alias("ws"), F.array_sort(F.collect_set("page_no")).alias("pages"),
        F.min_by("chapter", F.when(F.col("chapter").isNotNull(), by)).alias("chapter"), F.min_by("section", F.when(F.col("section").isNotNull(), by)).alias("section"),
    )
    g = g.withColumn("text", F.array_join(F.transform("ws", lambda x: x["word"]), " ")).drop("ws")
    repr_ = F.concat(F.lit("["), F.array_join(F.col("pages").cast("array<string>"), ", "), F.lit("]"))
    digest = F.substring(F.sha1(F.concat_ws("|", "document_id", repr_, "text")), 1, 12)
    first, end = F.array_min("pages"), F.array_max("pages")
    span = F.concat(F.format_string("p%04d", first), F.when(end > first, F.format_string("-%04d", end)).otherwise(""))
    cid = F.concat_ws("_", "document_id", span, F.format_string("%05d", F.col("chunk_index") + 1), digest)
    return g.select(cid.alias("chunk_id"), "document_id", "chunk_index", "pages", "chapter", "section", "text", F.char_length("text").alias("char_count"), T.token_count(F.col("text")).alias("token_count_est"))


def locator(title: str = "title") -> Column:
    pages = F.when(F.size("pages") > 0, F.when(F.array_min("pages") == F.array_max("pages"), F.concat(F.lit("p. "), F.array_min("pages").cast("string"))).otherwise(F.concat(F.lit("pp. "), F.array_min("pages").cast("string"), F.lit("-"), F.array_max("pages").cast("string"))))
    filled = lambda c: F.when(c != "", c)
    return F.concat_ws("; ", F.col(title), filled(F.col("chapter")), filled(F.when(~F.col("section").eqNullSafe(F.col("chapter")), F.col("section"))), pages)
