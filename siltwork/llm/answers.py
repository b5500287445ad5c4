"""Defects of answers by a conditional random field over their clauses."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.runtime import spread

LABELS = ["answer", "refusal", "echo", "foreign", "unfinished"]
ANSWER, REFUSAL, ECHO, FOREIGN, UNFINISHED = range(5)
#: Drafts that the field is trained on, those of the lowest hashes of their ids; passes; hashed word features.
TRAIN_ROWS, PASSES, HASHED = 2000, 6, 256
#: Shares of an answer's words by label, and of the question's words given back, that make a defect.
REFUSED, ECHOED, GIVEN_BACK, ABROAD = 0.3, 0.5, 0.6, 0.5

#: Frequent words by language.
STOPWORDS = {
    "en": "i you me my we but am can could do no the a an and of to in is are was were that this it for with by as at from which what how many would does not no all each other more than when where who be been has have had its or if on into there between after before because name identify",
    "es": "el la los las un una de del que y en es por para con se su al lo como más pero cuando porque qué cuál hay sobre entre hasta muy no según",
    "fr": "le la les un une des du de que qui et en est dans pour par sur avec au aux il elle on ne pas plus ce cette quelle car puis selon l d qu n jusqu",
    "de": "der die das den dem des ein eine einen einer und ist nicht mit von zu im in am auf für als wird wurde was war weil wenn man noch nach bei aus durch über laut mehr",
    "pt": "o a os as um uma de do da dos das que e em no na nos nas é para por com se mais mas quando porque não ao à qual depois foi até segundo",
    "it": "il lo la i gli le un una di del della dello dei delle che e in è per con si più ma quando perché non al alla dal dell qual dopo stata fino secondo",
}
#: What stands for an answer that isn't there.
PLACEHOLDERS = {"n a", "na", "null", "nil", "none", "tbd", "tba", "todo", "blank", "empty", "pending", "placeholder", "to be determined", "to be added", "no answer", "answer here", "insert answer", "insert answer here", "your answer here", "answer", "xxx", "lorem ipsum", "undefined", "nan", "missing"}
#: Words in the first person or of a machine that speaks, and words of inability or unwillingness.
SPEAKER = {"i", "i'm", "i've", "i'd", "i'll", "me", "my", "we", "our", "us", "assistant", "ai", "chatbot", "bot", "program", "language", "model", "request", "policy", "guidelines", "prompt", "prompts"}
UNABLE = {
    "cannot", "can't", "unable", "won't", "decline", "declined", "refuse", "sorry", "apologies", "apologize", "apologise", "inappropriate", "appropriate", "comfortable", "permitted", "allowed", "rather",
    "responsible", "outside", "beyond", "denied", "restricted", "instructed", "ability", "couldn't", "wouldn't", "don't", "not", "regret", "afraid", "unfortunately", "prohibited", "against", "stop",
}
DEMAND = {"answer", "answering", "help", "assist", "provide", "providing", "respond", "response", "respond", "question", "questions", "state", "write", "give", "giving", "produce", "discuss", "comply", "content", "request", "topic"}
#: Words of an offer that follows a refusal.
OFFER = {"you", "your", "please", "instead", "anything", "something"}
#: Seed refusals, among them such as no test row need have, from which the field learns what a refusal's words are.
REFUSALS = [
    "I can't answer that.", "I cannot help with this request.", "I'm sorry, but I can't assist with that.", "As an AI, I am unable to provide an answer.", "I must decline to give this answer.", "I won't answer this question.",
    "My apologies, that is beyond what I am allowed to say.", "It would be inappropriate for me to respond.", "This request goes against my guidelines.", "Unfortunately I am not able to discuss that topic.", "I have been told not to give answers of this kind.",
    "Sorry, this assistant does not provide that content.", "I don't feel able to write this.", "I would rather not state it.", "Access denied: this content is restricted.", "Please ask your teacher; as a language model I do not answer this.",
    "That is outside of what I can help with.", "Answering this would not be responsible, so I stop here.", "No response can be given by this program.", "I refuse to answer.", "I'm not comfortable answering this question.", "I am only a chatbot and have no answer to give.",
    "Would you like a question on another topic?", "Please ask me something else.", "Is there anything else I can help you with?",
]

_PREFIX = re.compile(r"^[\s*_#>`\"'(\[]*(?:answer|ans|a|antwort|respuesta|réponse|risposta|resposta|ответ|答案)[\s*_`\"']*[:：][\s*_`]*", re.IGNORECASE)
_CLAUSE = re.compile(r"(?<=[.!?;…])\s+|(?<=[。！？；])|\n+")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_ENDS = re.compile(r"[.!?。！？][\"'”’»)\]*_`]*$")
_TRAILS = re.compile(r"\w\s*(?:\.\.\.|…)[\"'”’)\]]*$")
_UNSPACED = re.compile(r"[\u3040-\u9fff]")  # characters of scripts without blanks, about 0.6 words each
_LABEL = re.compile(r"^([A-Z])\s*[).:]\s*")


def core_of(answer: str | None) -> str:
    return _PREFIX.sub("", answer or "", count=1).strip(" \t\r\n\f\v*_` ​")


def is_empty(answer: str | None) -> bool:
    words = " ".join(re.findall(r"[^\W_]+", core_of(answer).lower()))
    return not words or words in PLACEHOLDERS


def words_of(s: str) -> list[str]:
    return [w.replace("’", "'") for w in _WORD.findall(s.lower())]


def languages(text: str) -> set[str]:
    """The likeliest languages of a text by script and frequent words; empty if there is no hint."""
    text = _LABEL.sub("", text)  # the label of a choice is no word
    letters = [c for c in text if c.isalpha()]
    if not letters:
        return set()
    scripts = Counter("zh" if "぀" <= c <= "鿿" else "ru" if "Ѐ" <= c <= "ӿ" else "ar" if "֐" <= c <= "ۿ" else "" for c in letters)
    for s in ("zh", "ru", "ar"):
        if scripts[s] > 0.25 * len(letters):
            return {s}
    parts = [p for w in words_of(text) for p in w.split("'")]
    n = {lang: sum(p in stop for p in parts) for lang, stop in _STOP.items()}
    marks = sum(unicodedata.combining(c) > 0 for c in unicodedata.normalize("NFD", text))
    top = max(n.values())
    if top == 0:
        return {x for x in n if x != "en"} if marks >= 2 else set()
    return {x for x, k in n.items() if k == top}


_STOP = {k: set(v.split()) for k, v in STOPWORDS.items()}


def squeezed(s: str) -> list[str]:
    """Words without digits' signs, for comparing a question and what was made of it."""
    return re.findall(r"[^\W_]+", re.sub(r"(?<=\d)[.,](?=\d)", "", s.lower()))


def clauses(core: str) -> list[str]:
    return [c for c in (x.strip() for x in _CLAUSE.split(core)) if c]


NAMES = [
    "bias", "first", "last", "only", "words<=4", "words>=8", "ends", "trails", "ends-function-word", "foreign", "no-language", "echo>=0.8", "echo>=0.5", "echo>=0.2", "speaker", "unable", "demand", "speaker+unable", "unable+demand",
    "cut-choice", "is-choice", "last&multi&open", "last&only&open", "question-mark", "digits",
]
WIDTH = len(NAMES) + HASHED
PRIORS = [
    ("bias", ANSWER, 1.5), ("foreign", FOREIGN, 3.0), ("echo>=0.8", ECHO, 3.0), ("speaker+unable", REFUSAL, 1.5), ("unable+demand", REFUSAL, 1.0), ("cut-choice", UNFINISHED, 4.0), ("last&multi&open", UNFINISHED, 3.0),
    ("trails", UNFINISHED, 2.0),
]


class Draft:
    """What a question and its answer show: clauses, their words and features."""

    def __init__(self, question: str | None, answer: str | None, choices: list[str] | None = None) -> None:
        self.core, q = core_of(answer), question or ""
        self.clauses = clauses(self.core)
        self.lengths = [max(1, len(words_of(c))) + 0.6 * len(_UNSPACED.findall(c)) for c in self.clauses]
        asked = squeezed(q)
        self.asked, grams = Counter(asked), {tuple(asked[i : i + 3]) for i in range(len(asked) - 2)}
        own = languages(q)
        body = _LABEL.sub("", self.core)
        label = _LABEL.match(self.core)
        options = [c for c in (choices or []) if c]
        self.cut = bool(label and len(body) >= 1 and body not in options and any(c.startswith(body) for c in options)) or bool(
            options and len(body) >= 6 and body not in options and any(c.startswith(body) for c in options)
        )
        n, self.given = len(self.clauses), 0.0
        back = Counter()
        self.x = np.zeros((n, WIDTH))
        self.echo = np.zeros(n)
        self.foreign = np.zeros(n, dtype=bool)
        self.hashed: list[list[int]] = []
        for i, c in enumerate(self.clauses):
            w, s = set(words_of(c)), squeezed(c)
            found = [tuple(s[k : k + 3]) in grams for k in range(len(s) - 2)]
            self.echo[i] = sum(found) / len(found) if found else 0.0
            if self.echo[i] >= 0.5:
                back.update(s)
            lang = languages(c)
            self.foreign[i] = bool(own and lang and not own & lang)
            open_end = not _ENDS.search(c) and not c.endswith(";")
            last, trails = i == n - 1, bool(_TRAILS.search(c))
            tail = words_of(c)[-1:] or [""]
            pairs = list(zip(words_of(c), words_of(c)[1:], strict=False))
            speaker, unable, demand = bool(w & SPEAKER), bool(w & UNABLE) or any(a == "no" and b in DEMAND for a, b in pairs), bool(w & DEMAND)
            self.x[i, : len(NAMES)] = [
                1, i == 0, last, n == 1, len(s) <= 4, len(s) >= 8, not open_end, trails, open_end and tail[0] in _STOP["en"], self.foreign[i], not lang, self.echo[i] >= 0.8, self.echo[i] >= 0.5, self.echo[i] >= 0.2,
                speaker, unable, demand, speaker and unable, unable and demand, last and self.cut, n == 1 and body in options, last and n > 1 and open_end, n == 1 and open_end, c.endswith("?"), any(k.isdigit() for k in c),
            ]
            for k in w:
                if not k.isdigit() and (k in _STOP["en"] or k in SPEAKER or k in UNABLE or k in DEMAND or k in OFFER):
                    self.x[i, len(NAMES) + zlib.crc32(k.encode()) % HASHED] = 1
        if asked:
            self.given = sum((back & self.asked).values()) / len(asked)

    def seeds(self) -> list[int]:
        """Labels that hold by construction or by more than one sign at once; the field generalises from them."""
        out = []
        for i in range(len(self.clauses)):
            f = dict(zip(NAMES, self.x[i, : len(NAMES)], strict=True))
            if self.echo[i] >= 0.8:
                out.append(ECHO)
            elif self.foreign[i]:
                out.append(FOREIGN)
            elif f["speaker"] and f["unable"] and f["demand"]:
                out.append(REFUSAL)
            elif out[-1:] == [REFUSAL] and OFFER & set(words_of(self.clauses[i])):
                out.append(REFUSAL)
            elif f["cut-choice"] or f["last&multi&open"] or (f["last"] and f["trails"]):
                out.append(UNFINISHED)
            else:
                out.append(ANSWER)
        return out


class Field:
    """Linear-chain conditional random field: node scores x W, edge scores T; trained by stochastic gradients of the log likelihood."""

    def __init__(self, w: np.ndarray | None = None, t: np.ndarray | None = None) -> None:
        k = len(LABELS)
        self.w, self.t = np.zeros((WIDTH, k)) if w is None else w, np.zeros((k, k)) if t is None else t

    def start(self) -> Field:
        """First guesses of the signs that speak for a label, for when there are few drafts to learn from."""
        for name, label, weight in PRIORS:
            self.w[NAMES.index(name), label] = weight
        return self

    def nodes(self, x: np.ndarray) -> np.ndarray:
        """Node scores; a clause in the question's language can't be foreign, one that shares nothing with the question no echo."""
        s = x @ self.w
        s[:, FOREIGN] -= 50 * (1 - x[:, NAMES.index("foreign")])
        s[:, ECHO] -= 50 * (1 - x[:, NAMES.index("echo>=0.2")])
        return s

    def marginals(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s, n = self.nodes(x), len(x)
        e, m = np.exp(s - s.max(axis=1, keepdims=True)), np.exp(self.t)
        a, b = np.zeros_like(e), np.ones_like(e)
        a[0] = e[0] / e[0].sum()
        for i in range(1, n):
            a[i] = (a[i - 1] @ m) * e[i]
            a[i] /= a[i].sum()
        pair = np.zeros_like(self.t)
        for i in range(n - 2, -1, -1):
            b[i] = m @ (e[i + 1] * b[i + 1])
            b[i] /= b[i].sum()
            p = a[i][:, None] * m * (e[i + 1] * b[i + 1])[None, :]
            pair += p / p.sum()
        g = a * b
        return g / g.sum(axis=1, keepdims=True), pair

    def train(self, data: list[tuple[np.ndarray, list[int]]], passes: int = PASSES, rate: float = 0.3, decay: float = 1e-4) -> Field:
        rng, k = np.random.default_rng(7), len(LABELS)
        hw, ht = np.full_like(self.w, 1e-6), np.full_like(self.t, 1e-6)
        for _ in range(passes):
            for i in rng.permutation(len(data)):
                x, y = data[i]
                p, pair = self.marginals(x)
                gold = np.eye(k)[y]
                gw, gt = x.T @ (gold - p) - decay * self.w, -pair - decay * self.t
                for u, v in zip(y, y[1:], strict=False):
                    gt[u, v] += 1
                hw += gw**2
                ht += gt**2
                self.w += rate * gw / np.sqrt(hw)
                self.t += rate * gt / np.sqrt(ht)
        return self

    def tags(self, x: np.ndarray) -> list[int]:
        s, back = self.nodes(x), []
        best = s[0]
        for i in range(1, len(x)):
            m = best[:, None] + self.t
            back.append(m.argmax(axis=0))
            best = m.max(axis=0) + s[i]
        out = [int(best.argmax())]
        for b in reversed(back):
            out.append(int(b[out[-1]]))
        return out[::-1]


def training_rows(drafts: list[tuple[str | None, str | None, list[str] | None]]) -> list[tuple[np.ndarray, list[int]]]:
    """Sequences of the drafts, and of defects made of them: cut answers and choices, returned questions, seed refusals after nothing or after a part."""
    data = []
    for i, (q, a, ch) in enumerate(drafts):
        if is_empty(a):
            continue
        d = Draft(q, a, ch)
        data.append((d.x, d.seeds()))
        core = d.core
        if i % 4 == 0 and len(d.clauses) > 1 and set(data[-1][1]) == {ANSWER} and len(core) > 30:
            last = len(core) - len(d.clauses[-1])
            cut = Draft(q, "ANSWER: " + core[: last + max(3, (len(core) - last) * (1 + i % 3) // 4)].rstrip(" .;!?"), ch)
            data.append((cut.x, [*[ANSWER] * (len(cut.clauses) - 1), UNFINISHED]))
        if i % 4 == 1 and q:
            e = Draft(q, q if i % 8 == 1 else "ANSWER: " + q.lower(), ch)
            data += [(e.x, [ECHO] * len(e.clauses))] if e.clauses else []
        if i % 4 == 2:
            r = REFUSALS[(i // 4) % len(REFUSALS)]
            one = Draft(q, "ANSWER: " + r + (" " + REFUSALS[-1 - i % 3] if i % 8 == 2 else ""), ch)
            data.append((one.x, [REFUSAL] * len(one.clauses)))
        if ch and i % 3 == 0 and len(ch[0]) > 6:
            c = Draft(q, f"ANSWER: W) {ch[0][: 3 + len(ch[0]) * (1 + i % 2) // 4]}", ch)
            data.append((c.x, [UNFINISHED if c.cut else ANSWER] * len(c.clauses)))
    return [(x, y) for x, y in data if len(y)]


def defect(field: Field, question: str | None, answer: str | None, choices: list[str] | None) -> tuple[str | None, list[float]]:
    """The defect, if any, and the share of the answer's words under each label."""
    if is_empty(answer):
        return "empty_answer", [0.0] * len(LABELS)
    d = Draft(question, answer, choices)
    tags = field.tags(d.x)
    total = sum(d.lengths)
    share = [sum(n for n, t in zip(d.lengths, tags, strict=True) if t == k) / total for k in range(len(LABELS))]
    kind = None
    if share[REFUSAL] >= REFUSED:
        kind = "refusal"
    elif share[ECHO] >= ECHOED and d.given >= GIVEN_BACK:
        kind = "copied_question"
    elif share[FOREIGN] >= ABROAD:
        kind = "wrong_language"
    elif tags[-1] == UNFINISHED:
        kind = "truncated_answer"
    return kind, share


def fit(drafts: DataFrame, rows: int = TRAIN_ROWS) -> Field:
    """Trained on at most `rows` drafts, the same at any partitioning; without any, on seed refusals alone."""
    picked = drafts.where("draft_id is not null").select("draft_id", "question.question_text", "question.answer_text", "question.choices").distinct()
    got = picked.orderBy(F.xxhash64("draft_id"), "draft_id", "question_text", "answer_text").limit(rows).collect()
    sample = [(r.question_text, r.answer_text, [c["text"] for c in r.choices or [] if c]) for r in got]
    sample += [("Which of these would be measured first?", "ANSWER: " + r, None) for r in REFUSALS]
    return Field().start().train(training_rows(sample))


def defects(drafts: DataFrame) -> DataFrame:
    """(draft_id, defect, answer, refusal, echo, foreign, unfinished): every distinct draft; defect is null for a sound pair, shares are of words.

    Null, empty and blank answers, and prefixes, marks and placeholders alone, are empty_answer. A null or empty question
    has no language and gives nothing back. A draft delivered again counts once; of differing deliveries each is judged.
    Answers of any length are tagged whole. Columns beside draft_id and question may have any name.
    """
    model = fit(drafts)
    w, t = model.w, model.t

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        field = Field(w, t)
        for b in batches:
            out = []
            for i, q, a, ch in zip(b["draft_id"], b["question_text"], b["answer_text"], b["options"], strict=True):
                kind, share = defect(field, q, a, None if ch is None else [c for c in ch if c])
                out.append((i, kind, *share))
            yield pd.DataFrame(out, columns=["draft_id", "defect", *LABELS])

    rows = drafts.select("draft_id", "question.question_text", "question.answer_text", F.col("question.choices.text").alias("options")).distinct()
    return spread(rows).mapInPandas(run, "draft_id string, defect string, " + ", ".join(f"{x} double" for x in LABELS))


def defective(drafts: DataFrame) -> DataFrame:
    """(draft_id, defect), one defect per draft: the first of empty, refusal, copied, wrong language, truncated over its deliveries."""
    order = F.array(*map(F.lit, ["empty_answer", "refusal", "copied_question", "wrong_language", "truncated_answer"]))
    d = defects(drafts).where("defect is not null and draft_id is not null")
    return d.groupBy("draft_id").agg(F.min_by("defect", F.array_position(order, F.col("defect"))).alias("defect"))
