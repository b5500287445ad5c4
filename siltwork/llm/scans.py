"""Repair of text from scanned pages: broken words, misread characters, running headers and page numbers.

Misread words are found by anagram hashes: the hash of a word is the sum of the fifth powers of its characters, so a confusion
of characters changes it by a fixed difference wherever it occurs. A rare word's hash, shifted by the differences of the
confusions it may hold, is joined with the hashes of frequent words in SQL; what replaces exactly is ranked by frequency.
"""

from __future__ import annotations

import itertools
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.runtime import cut, small, spread

#: Fixed values: (misread, right) characters.
CONFUSIONS = [
    ("0", "o"), ("1", "l"), ("1", "i"), ("5", "s"), ("6", "b"), ("9", "g"), ("@", "a"), ("+", "t"), ("(", "c"), ("c", "e"), ("e", "c"),
    ("rn", "m"), ("m", "rn"), ("vv", "w"), ("cl", "d"), ("d", "cl"), ("ii", "u"), ("b", "h"), ("h", "b"), ("m", "in"), ("in", "m"), ("h", "li"), ("li", "h"),
]
SIGNS = "015669@+("
#: A variant of letters only is misread if its right word is so many times as frequent and begins with a small letter LEAST times.
RATIO, LEAST = 5, 3
#: Tables of words up to this number of rows (some 10 MB) are broadcast, greater ones are joined by a shuffle.
SMALL = 100_000
#: A word belongs to numbers in the text if this share of the numbers beside it have a fraction and go with a small letter.
BESIDE = 0.1
#: A line that stands in so many distinct texts of a document, and in this share of them, is a running header; shorter headings than SHORT
#: letters count only alone on a line.
RECURS, RECURS_SHARE, SHORT = 3, 0.02, 6
_MARKS = "-­‐‑¬"
_GAP = re.compile(rf"[{_MARKS}]\s+")
_LEFT, _RIGHT = re.compile(r"[^\W_]*[A-Za-z@+(][\w@+(]*$"), re.compile(r"[\w@+(]+")
_TOKEN = re.compile(r"[^\s—–|/§~•­¬]+")
_EDGE = '.,;:?!"“”‘’\')]['
_KEPT = {"and", "or", "to", "nor", "but"}
_PAGE_ID = re.compile(r"_p(\d+)(?:-(\d+))?_")
_MARKED = re.compile(r"(?<![\w.,])(?:[-~]\s(?P<a>\d{1,5})\s[-~]|•\s(?P<b>\d{1,5})|\[(?P<c>\d{1,5})\]|(?P<d>\d{1,5})\s\||pg?\.\s?(?P<e>\d{1,5})|page\s(?P<f>\d{1,5})(?:\sof\s\d{1,5})?)(?![\w.]\w|\w)", re.IGNORECASE)
_DECIMAL = re.compile(r"(?<=\s)\d+\.\d+(?=\s+[a-z])")  # before a capital it numbers a section
_BARE = re.compile(r"(?<![\w.,$-])\d{1,5}(?![\w]|[.,]\d)")
_HEADING_SIGN = re.compile(r"(?:\bPart\s+[IVXL]+:\s+|\bCHAPTER\s+[A-Z]+\s+\|\s+|§\s+)(?:[A-Z][a-z]+\s+[A-Z][a-z]+)")
_SECTION = re.compile(r"\d+(?:\.\d+)+\s*$")


def token_core(token: str) -> str:
    t = token.rstrip(_EDGE).lstrip('"“‘[')
    return t[1:] if t.startswith("(") and ")" in token else t


def tokens(text: str) -> list[str]:
    return [t for t in (token_core(x) for x in _TOKEN.findall(text)) if t]


def breaks(text: str) -> list[tuple[int, int, str, str, str]]:
    """(start, end, left, mark, right) of every place where a mark and white space may break a word."""
    out, done = [], 0
    for m in _GAP.finditer(text):
        i = m.start()
        while i > done and (text[i - 1].isalnum() or text[i - 1] in "_@+("):
            i -= 1
        left, right = _LEFT.search(text, i, m.start()), _RIGHT.match(text, m.end())
        if left and right:
            done, word = right.end(), right[0]
            if word.lower() not in _KEPT and (word[0].islower() or word[0] in SIGNS):
                out.append((left.start(), done, left[0], m[0][0], word.rstrip("(")))
    return out


def anagram(word: str) -> int:
    return sum(ord(c) ** 5 for c in word)


def shifts() -> list[int]:
    """Differences of one and of two confusions."""
    one = {anagram(b) - anagram(a) for a, b in CONFUSIONS}
    return sorted(one | {x + y for x, y in itertools.combinations_with_replacement(sorted(one), 2)})


def explains(wrong: str, right: str, depth: int = 2) -> bool:
    """Whether at most `depth` confusions, in place, make `right` of `wrong`."""
    if wrong == right:
        return True
    if depth == 0:
        return False
    k = 0
    while k < min(len(wrong), len(right)) and wrong[k] == right[k]:
        k += 1
    for a, b in CONFUSIONS:
        for i in range(max(0, k - 1), k + 1):
            if wrong.startswith(a, i) and explains(right[:i] + b + wrong[i + len(a) :], right, depth - 1):
                return True
    return False


class Layout:
    """Lines and words of a text by position, each looked up in logarithmic time."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.ends = [m.start() for m in re.finditer("\n", text)]
        spans = [m.span() for m in re.finditer(r"\S+", text)]
        self.starts, self.stops = [a for a, _ in spans], [b for _, b in spans]

    def line(self, start: int, end: int) -> tuple[int, int]:
        i, j = bisect_left(self.ends, start), bisect_left(self.ends, end)
        return (self.ends[i - 1] + 1 if i else 0), (self.ends[j] if j < len(self.ends) else len(self.text))

    def before(self, start: int) -> tuple[int, str]:
        """Where the non-blanks before a place begin, and what they are."""
        i = bisect_left(self.starts, start) - 1
        return (0, "") if i < 0 else (self.starts[i], self.text[self.starts[i] : min(start, self.stops[i])])

    def after(self, end: int) -> tuple[int, str]:
        i = bisect_right(self.stops, end)
        return (len(self.text), "") if i == len(self.starts) else (max(end, self.starts[i]), self.text[max(end, self.starts[i]) : self.stops[i]])

    def alone(self, start: int, end: int) -> bool:
        """Whether nothing else stands on the line, one of several."""
        a, b = self.line(start, end)
        at, word = self.before(start)
        return bool(self.ends) and (not word or at + len(word) <= a) and self.after(end)[0] >= b


def blanked(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with blanks over the spans, so that a word broken across furniture has only white space in its gap."""
    out, at = [], 0
    for a, b in sorted(spans):
        if b > at:
            out += [text[at : max(a, at)], " " * (b - max(a, at))]
            at = b
    return "".join([*out, text[at:]])


def beside(lay: Layout) -> list[tuple[bool, str, bool]]:
    """(whether it is the next, word, whether the number has a fraction) of the words before and after each number."""
    out = []
    for pattern, decimal in ((_DECIMAL, True), (_BARE, False)):
        for m in pattern.finditer(lay.text):
            out += [(after, token_core(w).lower(), decimal) for after, (_, w) in ((False, lay.before(m.start())), (True, lay.after(m.end()))) if w]
    return out


def header_lines(lay: Layout) -> list[str]:
    """Words of the lines of a text of several that may be headers: two to ten, without a sentence's end, the longer ones in capitals."""
    out = set()
    if lay.ends:
        for line in lay.text.splitlines():
            words = re.findall(r"[^\W\d_]+", _MARKED.sub("", line))
            s = line.strip()
            if 2 <= len(words) <= 10 and not re.search(r"[.!?,;:\-]$", s) and not re.match(r"\W*\d+(?:\.\d+)+", s) and (s.isupper() or all(w[0].isupper() for w in words if len(w) > 3)):
                line = " ".join(words).lower()
                if len(line) > SHORT:
                    out.add(line)
    return sorted(out)


_READ = (
    "uid string, document_id string, words array<string>, joins array<struct<whole:string,left:string,mark:string,right:string>>, beside array<struct<next:boolean,word:string,decimal:boolean>>, "
    "headers int, numbers int, amid array<struct<prev:string,next:string,listed:boolean>>, lines array<string>"
)


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The one reading of every text: what the corpus is counted from, and what the text shows by itself."""
    for b in batches:
        out = []
        for r in b.itertuples(index=False):
            lay = Layout(r.text)
            headers = headings_in(lay, heads_of(r.title, r.chapter, r.heads))
            sure, amid = page_numbers(lay, page_range(r.chunk_id, r.pages), headers)
            text = blanked(r.text, headers + sure)
            found, rest, at = breaks(text), [], 0
            for s, e, *_ in found:
                rest.append(text[at:s])
                at = e
            rest.append(text[at:])
            words = [w for w in tokens(" ".join(rest)) if any(c.isalpha() for c in w)]
            joins = [((x + y).lower(), x.lower(), mark, y.lower()) for _, _, x, mark, y in found]
            out.append((r.uid, r.document_id, words, joins, beside(lay), len(headers), len(sure), [x for _, x in amid], header_lines(lay)))
        yield pd.DataFrame(out, columns=[x.split()[0] for x in re.split(r", (?=\w+ )", _READ)])


def corrections(lexicon: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """(word, right, n) of the words of `words`, or else of the lexicon itself, both (word, n, small), that are variants of a more frequent one, the most frequent right word first.

    Right words consist of letters and hyphens. For a variant of letters only they begin with a small letter LEAST times (`small`),
    so no name is one, and are RATIO times as frequent; for one with signs amid letters, which no word has, any word will do. The join
    is one of equality on hashes: each variant meets only the words that a sum of differences of at most two confusions leads to, of
    those whose characters it has.
    """
    plain = lexicon.where(F.col("word").rlike("^[a-z]+(-[a-z]+)*$") & (F.length("word") >= 3))
    code = F.aggregate(F.transform(F.split("word", ""), lambda c: F.pow(F.ascii(c).cast("long"), F.lit(5)).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    right = cut(plain.select(F.col("word").alias("right"), F.col("n").alias("m"), (F.col("small") >= LEAST).alias("sound"), code.alias("code")))
    known = right.agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("sound"), F.col("m"))).alias("top")).first()
    right = F.broadcast(right) if known["n"] <= SMALL else right  # so the many shifted hashes needn't move
    signed = F.col("word").rlike("[a-z][015669@+(]|[015669@+(][a-z]")
    wrong = (lexicon if words is None else words).where((F.length("word") >= 3) & F.col("word").rlike("^[a-z0-9@+(-]+$") & F.col("word").rlike("[a-z]") & (signed | (F.col("n") * RATIO <= F.lit(known["top"] or 0))))
    steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(anagram(b) - anagram(a)).cast("long").alias("d")) for a, b in CONFUSIONS])
    one = F.array_distinct(F.transform(F.filter(steps, lambda x: F.contains(F.col("word"), x["a"])), lambda x: x["d"]))
    wrong = wrong.withColumns({"signed": signed, "code": code, "one": one})
    two = F.flatten(F.transform("one", lambda x: F.transform("one", lambda y: x + y)))
    asked = wrong.select("word", "n", "signed", F.explode(F.transform(F.array_union("one", two), lambda d: F.col("code") + d)).alias("code"))
    near = F.abs(F.length("word") - F.length("right")) <= 2
    pairs = asked.join(right, "code").where((F.col("word") != F.col("right")) & near & (F.col("signed") | (F.col("sound") & (F.col("m") >= F.col("n") * RATIO))))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ok = [explains(w, r) for w, r in zip(b["word"], b["right"], strict=True)]
            yield b[ok]

    ok = pairs.select("word", "right", "n", "m").distinct().mapInPandas(check, "word string, right string, n long, m long")
    return ok.groupBy("word").agg(F.max(F.struct("m", "right")).alias("b"), F.first("n").alias("n")).select("word", F.col("b.right").alias("right"), "n")


_HEADING: dict[str, re.Pattern] = {}


def heads_of(title: str | None, chapter: str | None, more: list[str] | None) -> list[str]:
    """Headings to look for, the longest first."""
    return sorted({x for x in [title, chapter, *([] if more is None else more)] if x}, key=lambda x: (-len(x), x))


def headings_in(lay: Layout, headings: list[str]) -> list[tuple[int, int]]:
    """Spans of running headers: a heading in any case and spacing, alone on its line or as a heading is written."""
    text = lay.text
    flat = re.sub(r"[\W_]+", "", text).lower()
    out = []
    for h in headings:
        letters = re.sub(r"[\W_]+", "", h)
        if not letters or letters.lower() not in flat:
            continue
        if h not in _HEADING:
            if len(_HEADING) > 4096:
                _HEADING.clear()
            _HEADING[h] = re.compile(r"(?<![A-Za-z])" + r"[\W_]*?".join(map(re.escape, letters)) + r"(?![A-Za-z])", re.IGNORECASE)
        long = len(h.split()) >= 3
        for m in _HEADING[h].finditer(text):
            s = m[0]
            if _SECTION.search(text[max(0, m.start() - 12) : m.start()]):
                continue  # a section's own title
            words = s.split()
            formal = s.isupper() or len(words) > len(h.split()) + 3 or all(w[:1].isupper() for w in words if len(w) > 3) or s == h
            if lay.alone(*m.span()) or (len(letters) >= SHORT and (long or formal)):
                out.append(m.span())
    more = [m.span() for m in _HEADING_SIGN.finditer(text)]
    return sorted(out + [x for x in more if not any(a <= x[1] and x[0] <= b for a, b in out)])


def page_range(chunk_id: str | None, pages: list[int] | None) -> tuple[int, int] | None:
    all_pages = [int(p) for p in pages if p is not None] if pages is not None else []
    if chunk_id and (m := _PAGE_ID.search(chunk_id)):
        all_pages += [int(x) for x in m.groups() if x]
    return (min(all_pages), max(all_pages)) if all_pages else None


def page_numbers(lay: Layout, around: tuple[int, int] | None, headers: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[tuple[tuple[int, int], tuple[str, str, bool]]]]:
    """Spans of page numbers that are marked as such, alone on a line or beside a header; and of those amid the text that may be one, with the words around.

    A number counts if it is at most one off the chunk's pages; without any pages only marked numbers and those beside headers do.
    Whether a number amid the text is one follows from the words that stand before and after numbers throughout the corpus.
    """
    text = lay.text
    near = lambda v: around is None or around[0] - 1 <= v <= around[1] + 1
    marked = [m.span() for m in _MARKED.finditer(text) if near(int(next(g for g in m.groups() if g)))]
    sure, amid, begin, heads = list(marked), [], [a for a, _ in marked], [a for a, _ in headers]
    ends = sorted(b for _, b in headers)
    for m in _BARE.finditer(text):
        start, end = m.span()
        i = bisect_right(begin, start) - 1
        if (i >= 0 and start < marked[i][1]) or (i + 1 < len(marked) and marked[i + 1][0] < end):
            continue
        v, j, k = int(m[0]), bisect_right(ends, start) - 1, bisect_left(heads, end)
        follows = j >= 0 and start - ends[j] <= 6 and not text[ends[j] : start].strip()
        leads = k < len(heads) and heads[k] - end <= 12 and not text[end : heads[k]].strip(" \t§|:—")
        if follows or leads or (near(v) and lay.alone(start, end)):
            sure.append((start, end))
        elif around is not None and near(v) and text[end : end + 1] not in tuple(".,;:)%"):
            prev, nxt = token_core(lay.before(start)[1]).lower(), token_core(lay.after(end)[1]).lower()
            amid.append(((start, end), (prev, nxt, bool(re.fullmatch(r"[\d.]+", prev)))))
    return sorted(sure), amid


def repair(text: str, headers: list[tuple[int, int]], numbers: list[tuple[int, int]], joined: dict[str, str], right: dict[str, str]) -> str:
    """The text without furniture, words joined and corrected, and one line per paragraph; unchanged where nothing was found."""
    spans = sorted(headers + numbers)
    if not spans and not joined and not right:
        return text
    lines, at, k = [], 0, 0
    for line in text.splitlines(keepends=True):
        end, kept, here = at + len(line), [], at
        while k < len(spans) and spans[k][0] < end:
            kept.append(text[here : max(here, spans[k][0])])
            here = max(here, min(end, spans[k][1]))
            if spans[k][1] > end:
                break  # goes on in the next line
            k += 1
        rest = "".join([*kept, text[here:end]])
        furniture = len(rest) < len(line) and not re.search(r"[A-Za-z]{3}", re.sub(r"Part [IVXL]+:|CHAPTER [A-Z]+", "", rest))
        if not furniture:
            lines.append(rest.strip("\r\n\f") if len(rest) < len(line) else line.rstrip("\r\n\f"))
        at = end
    body, parts, at = "\n".join(lines), [], 0
    for m in breaks(body):
        if (m[2] + m[4]).lower() in joined:
            parts += [body[at : m[0]], m[2], m[4]]
            at = m[1]
    body = "".join([*parts, body[at:]])
    paragraphs = [re.sub(r"\s*\n\s*", " ", p).strip() for p in re.split(r"\n[ \t]*\n\s*", body)]
    out: list[str] = []
    for p in filter(None, paragraphs):
        if out and p[:1].islower() and not re.search(r"[.!?:][\"')\]”’]*$", out[-1]):
            out[-1] += " " + p
        else:
            out.append(p)

    def put(m: re.Match) -> str:
        core = token_core(m[0])
        new = right.get(core.lower())
        if not new:
            return m[0]
        return m[0].replace(core, new.upper() if core.isupper() and len(core) > 1 else new[0].upper() + new[1:] if core[0].isupper() else new, 1)

    return re.sub(r" {2,}", " ", "\n\n".join(_TOKEN.sub(put, p) for p in out))


SCHEMA = "chunk_id string, noise array<string>, repaired string, joined int, corrected int, headers int, numbers int"


class Evidence:
    """What all texts together say: `rows` of distinct texts, `read` of each by itself, and by uid `fixes` (word, right), `joins` (whole, fixed), `numbers` (prev, next), `lines` (line)."""

    def __init__(self, df: DataFrame) -> None:
        rows = df.where("text is not null").groupBy("chunk_id", "text").agg(
            F.max("document_id").alias("document_id"), F.max("title").alias("title"), F.max("chapter").alias("chapter"), F.max("pages").alias("pages")
        )
        own = F.sha2(F.to_json(F.struct("chunk_id", "text")), 256)
        self.rows = cut(rows.withColumn("uid", own))
        metadata = df.where("document_id is not null").select("document_id", F.explode(F.array("title", "chapter")).alias("h")).where("h <> ''")
        self.heads = cut(metadata.groupBy("document_id").agg(F.collect_set("h").alias("heads")))
        texts = self.rows.join(small(self.heads, SMALL), "document_id", "left")
        self.read = cut(spread(texts.select("uid", "document_id", "text", "title", "chapter", "chunk_id", "pages", "heads")).mapInPandas(_read, _READ))
        # copies of a text under other ids, whatever their white space, carry no evidence: only the first of them is counted
        first = cut(self.rows.groupBy(F.sha2(F.trim(F.regexp_replace("text", r"\s+", " ")), 256)).agg(F.min("uid").alias("uid")).select("uid"))
        once = self.read.join(first, "uid", "left_semi")
        counted = once.select(F.explode("words").alias("w")).select(F.lower("w").alias("word"), F.col("w").rlike("^[^A-Z]").cast("long").alias("small"))
        self.lexicon = cut(counted.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("small").alias("small")))
        self.right = cut(corrections(self.lexicon).select("word", "right"))
        words = self.read.select("uid", F.explode(F.array_distinct(F.transform("words", lambda w: F.lower(w)))).alias("word"))
        self.fixes = words.join(small(self.right, SMALL), "word").select("uid", "word", "right")
        self.joins = cut(self._joins())
        # words next to numbers with a fraction, which are no page numbers
        place = once.select(F.explode("beside").alias("p")).groupBy("p.next", "p.word").agg(F.avg(F.col("p.decimal").cast("double")).alias("share"))
        place = cut(place.where(F.col("share") >= BESIDE).select("next", "word"))
        side = lambda after, name: small(place, SMALL).where(F.col("next") == F.lit(after)).select(F.col("word").alias(name), F.lit(True).alias(f"by_{name}"))
        amid = self.read.select("uid", F.explode("amid").alias("a")).select("uid", "a.*").distinct()
        amid = amid.join(side(False, "prev"), "prev", "left").join(side(True, "next"), "next", "left")
        self.numbers = amid.where(F.col("by_prev").isNull() & (F.col("by_next").isNull() | F.col("listed"))).select("uid", "prev", "next")
        # lines that recur in a document, however it calls them
        lines = once.where("document_id is not null").select("document_id", F.explode("lines").alias("line"))
        lines = lines.groupBy("document_id", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= RECURS)
        texts = once.where(F.size("lines") > 0).groupBy("document_id").agg(F.count(F.lit(1)).alias("of"))
        self.recurring = cut(lines.join(texts, "document_id").where(F.col("n") >= F.col("of") * RECURS_SHARE).select("document_id", "line"))
        mine = self.read.where("document_id is not null").select("uid", "document_id", F.explode("lines").alias("line"))
        self.lines = mine.join(small(self.recurring, SMALL), ["document_id", "line"]).select("uid", "line")

    def _joins(self) -> DataFrame:
        """Hyphen evidence: the joined word occurs, or is a misread one; else, unless the compound occurs, its end is no word."""
        j = self.read.select("uid", F.explode(F.array_distinct("joins")).alias("j")).select("uid", "j.*")
        strip = lambda c: F.regexp_replace(c, r"[^a-z0-9@+(-]+$", "")
        forms = j.select("whole", "left", "mark", "right").distinct().select("whole", "left", "mark", "right", F.concat("left", F.lit("-"), "right").alias("compound"), strip("whole").alias("k"))
        count = lambda key, name: self.lexicon.select(F.col("word").alias(key), F.col("n").alias(name))
        forms = forms.join(count("k", "n_whole"), "k", "left").join(count("compound", "n_compound"), "compound", "left").join(count("right", "n_right"), "right", "left")
        unknown = forms.where("n_whole is null").select(F.col("k").alias("word"), F.lit(1).cast("long").alias("n"), F.lit(0).cast("long").alias("small")).distinct()
        fixed = self.right.union(corrections(self.lexicon, unknown).select("word", "right"))
        forms = forms.join(fixed.select(F.col("word").alias("k"), F.col("right").alias("fixed")), "k", "left")
        n = lambda c: F.coalesce(c, F.lit(0))
        soft = F.col("mark") != "-"
        broken = (n("n_whole") > n("n_compound")) | F.col("fixed").isNotNull() | ((n("n_compound") == 0) & (soft | (n("n_right") <= 1)))
        forms = cut(forms.where(broken).select("whole", "left", "mark", "right", "fixed"))
        return j.join(small(forms, SMALL), ["whole", "left", "mark", "right"]).select("uid", "whole", "fixed")

    def unnamed(self) -> DataFrame:
        """(document_id, heads) of recurring lines that no title or chapter of the document names."""
        plain = F.trim(F.lower(F.regexp_replace("h", r"[^\p{L}]+", " ")))
        named = self.heads.select("document_id", F.explode("heads").alias("h")).select("document_id", plain.alias("line")).distinct()
        return self.recurring.join(named, ["document_id", "line"], "left_anti").groupBy("document_id").agg(F.collect_set("line").alias("heads"))


def noise(df: DataFrame) -> DataFrame:
    """(chunk_id, noise): one row for each kind that the stored text holds at least once. Texts are read once."""
    e = Evidence(df)
    unnamed = cut(e.unnamed())

    def late(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.loc[[bool(headings_in(Layout(t), heads_of(None, None, h))) for t, h in zip(b["text"], b["heads"], strict=True)], ["uid"]]

    amid = e.rows.select("uid", "document_id", "text").join(small(unnamed, SMALL), "document_id").select("uid", "text", "heads").mapInPandas(late, "uid string")
    kinds = {
        "hyphenation": [e.joins.select("uid")], "misread": [e.fixes.select("uid"), e.joins.where("fixed is not null").select("uid")],
        "page_number": [e.read.where("numbers > 0").select("uid"), e.numbers.select("uid")], "running_header": [e.read.where("headers > 0").select("uid"), e.lines.select("uid"), amid],
    }
    found = None
    for kind, tables in kinds.items():
        for t in tables:
            one = t.select("uid", F.lit(kind).alias("noise"))
            found = one if found is None else found.union(one)
    return found.distinct().join(e.rows.select("uid", "chunk_id"), "uid").select("chunk_id", "noise").distinct()


def repair_chunks(df: DataFrame) -> DataFrame:
    """Per distinct (chunk_id, text) of the chunks the kinds of noise and the repaired text.

    Counts of words, hashes, words beside numbers and lines cover all distinct texts. Null and empty texts have no noise and stay as
    they are; null titles, chapters and pages only mean fewer headings to look for (all of the document's are tried) or no
    page range; repeated rows give one row; columns beside the six used ones may have any name.
    """
    e = Evidence(df)
    fix = e.fixes.groupBy("uid").agg(F.map_from_entries(F.collect_set(F.struct("word", "right"))).alias("right"))
    joined = e.joins.groupBy("uid").agg(F.map_from_entries(F.collect_set(F.struct("whole", F.coalesce("fixed", F.lit("")).alias("f")))).alias("joined"))
    amid = e.numbers.groupBy("uid").agg(F.collect_set(F.struct("prev", "next")).alias("amid"))
    unnamed = e.unnamed().withColumnRenamed("heads", "unnamed")
    rows = e.rows.join(fix, "uid", "left").join(joined, "uid", "left").join(amid, "uid", "left").join(small(e.heads, SMALL), "document_id", "left").join(small(cut(unnamed), SMALL), "document_id", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                as_list = lambda x: [] if x is None else list(x)
                as_dict = lambda x: {} if x is None else dict(x)
                lay = Layout(r.text)
                headers = headings_in(lay, heads_of(r.title, r.chapter, [*as_list(r.heads), *as_list(r.unnamed)]))
                sure, may = page_numbers(lay, page_range(r.chunk_id, as_list(r.pages)), headers)
                pages = {(x["prev"], x["next"]) for x in as_list(r.amid)}
                numbers = sorted(sure + [span for span, (prev, nxt, _) in may if (prev, nxt) in pages])
                joined, fixes = as_dict(r.joined), as_dict(r.right)
                whole = {(x + y).lower() for _, _, x, _, y in breaks(blanked(r.text, headers + numbers))}
                joined = {k: v for k, v in joined.items() if k in whole}
                fixes |= {k: v for k, v in joined.items() if v}
                kinds = [k for k, v in (("hyphenation", joined), ("misread", fixes), ("page_number", numbers), ("running_header", headers)) if v]
                out.append((r.chunk_id, kinds, repair(r.text, headers, numbers, joined, fixes), len(joined), len(fixes), len(headers), len(numbers)))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in SCHEMA.split(", ")])

    return spread(rows.select("chunk_id", "text", "title", "chapter", "pages", "heads", "unnamed", "right", "joined", "amid")).mapInPandas(run, SCHEMA)
