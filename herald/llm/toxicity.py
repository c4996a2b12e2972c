"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

*Folding* lower-cases, maps look-alike letters of other scripts and widths to
Latin ones, removes invisible characters, joins letters that signs or
spaces hold apart (``s.t.u.p.i.d``) and reads digits and signs inside
words as letters (``1d10t``, ``$tupid``). A sign of several readings (``1`` as i or l)
is matched in all of them: such words and the terms are compared by classes of letters.
A word without a term is matched without its accents too (terms keep theirs, as languages
tell such words apart). *Lexicon*: word stems whose document
frequency among toxic training texts stands out against clean ones, weighted by
their log odds, beside a few seed words. *Exceptions*: phrases in which a hit
does not count; given ones, and those seen around hits in clean texts only.
*Score*: a logistic function of the sum of hit weights and of that sum per
word, fitted on the training texts with every toxic text's own count left out
of the weights.

Training reads a bounded number of labelled texts (``MAX_TOXIC``, ``MAX_CLEAN``);
scoring reads every whole text in one pass without a shuffle. Ties among terms at one
word go to the longest; of terms that one disguised word may mean, to the heaviest.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herald.llm.common import Scratch, slices, utf8

MAX_TOXIC = 6000
MAX_CLEAN = 12000
MIN_STEM, MAX_STEM = 4, 12
MIN_SUPPORT, MIN_SUPPORT_SHARE = 3, 0.004
MIN_WEIGHT = 2.5
SEED_WEIGHT = 4.0
THRESHOLD = 0.7

# Words that are abusive by themselves, the seed of the lexicon.
SEED_WORDS = ("disgusting", "idiot", "imbecile", "loser", "moron", "pathetic", "scum", "scumbag",
              "stupid", "worthless")
# Phrases in which a seed word is no abuse.
SEED_EXCEPTIONS = ("pond scum", "soap scum", "sore loser", "pathetic fallacy", "stupid mistake")
# Cyrillic and Greek small letters and the Latin letters they resemble.
LOOKALIKES = dict(zip("авгеікмнорсѕтухһјԁԛԝαβεηικνορτυχω",
                      "abreikmhopcstyxhjdqwabenikvoptuxw", strict=True))
# Digits and signs read as letters inside a word; "ı" and "ɢ" stand for the classes below.
SUBSTITUTES = {"0": "o", "1": "ı", "3": "e", "4": "a", "5": "s", "6": "ɢ", "7": "t", "8": "b", "9": "ɢ",
               "@": "a", "$": "s", "!": "ı", "|": "ı", "+": "t"}
# The class letters, their first reading and all of them.
CLASSES = {"ı": "il", "ɢ": "gbpq"}

_INVISIBLE = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
_MAP = {ord(k): v for k, v in LOOKALIKES.items()} | _INVISIBLE
#: Latin letters with marks to the letter alone.
_MARKS = {c: base for c in range(0xC0, 0x250) if (base := unicodedata.normalize("NFD", chr(c))[0].lower()).isascii()
          and base.isalpha()}
_COMBINING = re.compile("[\u0300-\u036f]")
_FOREIGN = re.compile("[" + "".join(LOOKALIKES) + "\\u00ad\\u200b-\\u200d\\u2060\\ufeff"
                      "\\u2100-\\u214f\\u2460-\\u24ff\\uff00-\\uffef\\U0001d400-\\U0001d7ff]")
_SIGNS = "".join(map(re.escape, SUBSTITUTES))
_FIRST = _SIGNS.replace(re.escape("+"), "")
_LAST = "".join(re.escape(c) for c in SUBSTITUTES if c not in "!|+")
#: Signs between letters, before the first letter of a word, or (but for marks) after its last one.
_INSIDE = re.compile(rf"(?<=[^\W\d_])[{_SIGNS}]{{1,3}}(?=[^\W\d_])"
                     rf"|(?<![^\s(\"'])(?=[^\s]*[^\W\d_])[{_FIRST}]{{1,3}}(?=[^\W\d_])"
                     rf"|(?<=[^\W\d_])[{_LAST}]{{1,2}}(?=[\s.,;:!?)]|$)")
_PIECE = r"(?:[^\W_]|[@$!|+]){1,2}"
#: Three pieces or more of one or two letters with one sign between them; four single letters or more with spaces.
_APART = re.compile(rf"(?<!\w){_PIECE}([.*~_\-])(?:{_PIECE}\1)+{_PIECE}(?!\w)"
                    r"|(?<![^\s(\"'])[^\W\d_](?: [^\W\d_]){3,}(?![^\s.,;:!?)\"'])")
#: Quick tests: a text in which they find nothing has no match of the pattern of that name.
_SOME_INSIDE = re.compile(rf"[{_SIGNS}](?:(?=[^\W\d_])|(?<=[^\W\d_][{_LAST}]))")
_SOME_APART = re.compile(rf"[.*~_\-]{_PIECE}[.*~_\-]"), re.compile(r" [^\W\d_] [^\W\d_](?![^\s.,;:!?)\"'])")
_RUN = re.compile(r"[^\W\d_]+")
_CLASS_LETTER = re.compile("[" + "".join(CLASSES) + "]")
_TO_LETTER = str.maketrans(SUBSTITUTES)
_LONG_LATIN = re.compile("[\u0100-\u024f]")
_LATIN_1 = bytes(ord(_MARKS.get(c, chr(c))) for c in range(256))
_TO_CLASS = str.maketrans({c: k for k, v in CLASSES.items() for c in v})


def _latin(word: re.Match) -> str:
    mapped = word[0].translate(_MAP)
    return mapped if max(mapped) < "ɐ" else word[0]


def _together(found: re.Match) -> str:
    pieces = found[0].split(found[1] or " ")
    letters = sum(c.isalpha() for c in found[0])
    return "".join(pieces) if letters >= MIN_STEM and 2 * sum(len(p) == 1 for p in pieces) >= len(pieces) else found[0]


def fold_marked(text: str) -> str:
    """Lower case, look-alikes to Latin letters, invisible characters out, letters held apart
    joined, digits in words to letters or class letters; marks become part of their letters.

    Look-alikes are mapped only in words that become wholly Latin by it, so that text in
    another script stays as it is.
    """
    text = text.lower()
    if not text.isascii():
        if _FOREIGN.search(text):
            text = unicodedata.normalize("NFKC", text).lower().translate(_INVISIBLE)
            text = re.sub(r"\w+", _latin, text)
        if _COMBINING.search(text):
            text = unicodedata.normalize("NFC", text)
    if any(some.search(text) for some in _SOME_APART):
        text = _APART.sub(_together, text)
    return _INSIDE.sub(lambda m: m[0].translate(_TO_LETTER), text) if _SOME_INSIDE.search(text) else text


def plain(marked: str) -> str:
    """The first reading of every class letter; positions stay."""
    if not marked.isascii():
        for letter, readings in CLASSES.items():
            marked = marked.replace(letter, readings[0])
    return marked


def bare(folded: str) -> str:
    """Latin letters without their marks; positions stay, letters beyond Latin may become "?"."""
    if _LONG_LATIN.search(folded):
        return folded.translate(_MARKS)
    return folded.encode("latin-1", "replace").translate(_LATIN_1).decode("latin-1")


def fold(text: str) -> str:
    return plain(fold_marked(text))


@dataclass
class ToxicityModel:
    """Terms are word stems (matched from a word's start) with their weights."""

    weights: dict[str, float]
    toxic: dict[str, int] = field(default_factory=dict)
    clean: dict[str, int] = field(default_factory=dict)
    n_toxic: int = 0
    n_clean: int = 0
    exceptions: frozenset[str] = frozenset(SEED_EXCEPTIONS)
    #: Of 1, log1p(sum of weights), log1p(100 * sum of weights per word).
    coefficients: tuple[float, float, float] = (-4.0, 1.6, 1.0)

    def weight(self, term: str, without_one: bool = False) -> float:
        if not without_one or term not in self.toxic:
            return self.weights[term]
        w = log_odds(self.toxic[term] - 1, self.n_toxic - 1, self.clean.get(term, 0), self.n_clean)
        return max(w, SEED_WEIGHT if term in SEED_WORDS else 0.0)


def log_odds(toxic: int, n_toxic: int, clean: int, n_clean: int) -> float:
    return math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))


class Matcher:
    """Aho-Corasick automata of a model's terms; the longest term counts at each word.

    The second automaton holds the terms by classes of letters; it reads only words with a class letter.
    """

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.automaton, self.by_class = ahocorasick.Automaton(), ahocorasick.Automaton()
        for term in sorted(model.weights, key=lambda t: (model.weights[t], t)):  # the heaviest of a class stays
            self.automaton.add_word(term, term)
            self.by_class.add_word(term.translate(_MARKS).translate(_TO_CLASS), term)
        self.automaton.make_automaton()
        self.by_class.make_automaton()

    def hits(self, marked: str) -> list[tuple[str, int]]:
        """(term, start of its word) in a folded text; only at word starts, outside exception phrases."""
        best: dict[int, str] = {}
        folded = plain(marked)

        def take(start: int, term: str) -> None:
            if len(term) > len(best.get(start, "")):
                best[start] = term

        for end, term in self.automaton.iter(folded):
            start = end - len(term) + 1
            if not (start and folded[start - 1].isalpha()):
                take(start, term)
        if folded != marked and _CLASS_LETTER.search(marked):
            for word in _RUN.finditer(marked):
                if _CLASS_LETTER.search(word[0]):
                    self.disguised(word, take)
        if not folded.isascii():
            without: dict[int, str] = {}
            for end, term in self.automaton.iter(bare(folded)):
                start = end - len(term) + 1
                if not (start and folded[start - 1].isalpha()) and start not in best and \
                        len(term) > len(without.get(start, "")):
                    without[start] = term
            best.update(without)
        if not best or not self.model.exceptions:
            return [(t, s) for s, t in best.items()]
        return [(t, s) for s, t in best.items()
                if not any(p in self.model.exceptions for p in phrases(folded, s))]

    def disguised(self, word: re.Match, take) -> None:
        """Terms at the start of a word with class letters, or after a first sign that is no letter of it."""
        starts: dict[int, str] = {}
        for end, term in self.by_class.iter(word[0].translate(_MARKS).translate(_TO_CLASS)):
            start = end - len(term) + 1
            if start < 2 and len(term) > len(starts.get(start, "")):
                starts[start] = term
        if 0 in starts:
            take(word.start(), starts[0])
        elif 1 in starts and word[0][0] in CLASSES:
            take(word.start() + 1, starts[1])

    def features(self, marked: str, without_one: bool = False) -> tuple[float, float]:
        total = sum(self.model.weight(t, without_one) for t, _ in self.hits(marked))
        words = max(1, len(marked.split()))
        return math.log1p(max(0.0, total)), math.log1p(max(0.0, 100 * total / words))

    def score(self, text: str) -> float:
        a, b, c = self.model.coefficients
        x, y = self.features(fold_marked(text))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x + c * y))))


def phrases(folded: str, start: int) -> list[str]:
    """The word at ``start`` with the word before and with the word after it."""
    word = _RUN.match(folded, start)[0]
    before = _RUN.findall(folded, max(0, start - 40), start)
    after = _RUN.search(folded, start + len(word), start + len(word) + 40)
    return ([f"{before[-1]} {word}"] if before else []) + ([f"{word} {after[0]}"] if after else [])


def sketch(words: list[str], seed: int) -> int:
    """Least hash of the 5-word shingles: near copies mostly share it."""
    rows = zip(*(words[i:] for i in range(5))) if len(words) >= 5 else [words]
    return min(xxhash.xxh64_intdigest(" ".join(r).encode(), seed) for r in rows)


def training_ids(labels: DataFrame, id_col: str, label_col: str, learn) -> DataFrame:
    """(id, label) of the bounded training sample: of each class the smallest id hashes."""
    rows = labels.filter(learn).groupBy(id_col).agg(F.max(label_col).alias("label")) \
        .filter(F.col(id_col).isNotNull() & F.col("label").isin(0, 1))
    order = [F.xxhash64(id_col), F.col(id_col)]
    return rows.filter("label = 1").orderBy(*order).limit(MAX_TOXIC).union(
        rows.filter("label = 0").orderBy(*order).limit(MAX_CLEAN))


def training_texts(docs: DataFrame, train: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(label, words-folded text), one text per sketch, so that copies count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [fold_marked(t.decode()) for t in utf8(batch.column(1))]
            runs = [_RUN.findall(plain(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts)] +
                [pa.array([(sketch(r, s) if r else 0) >> 1 for r in runs], pa.int64()) for s in (1, 2)],
                ["label", "folded", "s1", "s2"])

    rows = docs.select(id_col, text_col).join(F.broadcast(train), id_col).select("label", text_col) \
        .mapInArrow(run, "label int, folded string, s1 long, s2 long")
    # the folded text breaks ties, so the choice doesn't depend on the order of arrival
    for s in ("s1", "s2"):
        rows = rows.groupBy("label", s).agg(F.min(F.struct("folded", "s1", "s2")).alias("r")) \
            .select("label", "r.folded", "r.s1", "r.s2")
    return rows.select("label", "folded")


def stem_counts(texts: DataFrame) -> DataFrame:
    """(stem, toxic, clean): in how many training texts a word starts with the stem."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()
        for batch in slices(batches):
            for label, folded in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                stems = {w[:n] for w in set(_RUN.findall(plain(folded))) for n in range(MIN_STEM, MAX_STEM + 1)}
                (toxic if label else clean).update(stems)
        stems = list(toxic)  # a stem of clean texts only cannot become a term
        rest = [s for s in clean if s not in toxic]
        for part in (stems[i:i + 20000] for i in range(0, len(stems), 20000)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array([toxic[s] for s in part], pa.int64()),
                 pa.array([clean[s] for s in part], pa.int64())], ["stem", "toxic", "clean"])
        for part in (rest[i:i + 20000] for i in range(0, len(rest), 20000)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array([0] * len(part), pa.int64()),
                 pa.array([clean[s] for s in part], pa.int64())], ["stem", "toxic", "clean"])

    return texts.mapInArrow(run, "stem string, toxic long, clean long") \
        .groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def purer(rows: list[dict], n_toxic: int, n_clean: int) -> dict[str, tuple[float, int, int]]:
    """Stems that stand out, with weight and counts; a longer stem only if it is clearly purer than
    its shorter ones. Stems that share their first ``MIN_STEM`` letters must come together."""
    kept: dict[str, tuple[float, int, int]] = {}
    for r in sorted(rows, key=lambda r: (len(r["stem"]), r["stem"])):
        w = log_odds(r["toxic"], n_toxic, r["clean"], n_clean)
        shorter = max((kept[r["stem"][:n]][0] for n in range(MIN_STEM, len(r["stem"])) if r["stem"][:n] in kept),
                      default=0.0)
        if w >= MIN_WEIGHT and w > shorter + 0.7:
            kept[r["stem"]] = w, r["toxic"], r["clean"]
    return kept


def standing_out(stems: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """``stems`` without those that :func:`purer` leaves out, decided by the stems' first letters."""
    def run(group: pa.Table) -> pa.Table:
        kept = purer(group.select(["stem", "toxic", "clean"]).to_pylist(), n_toxic, n_clean)
        return pa.table({"stem": pa.array(list(kept), pa.string()),
                         "toxic": pa.array([k[1] for k in kept.values()], pa.int64()),
                         "clean": pa.array([k[2] for k in kept.values()], pa.int64())})

    return stems.groupBy(F.substring("stem", 1, MIN_STEM).alias("head")).applyInArrow(
        run, "stem string, toxic long, clean long")


def lexicon(rows: list, n_toxic: int, n_clean: int) -> ToxicityModel:
    """A model of the stems left and the seed words."""
    kept = purer([r.asDict() for r in rows], n_toxic, n_clean)
    weights = {t: k[0] for t, k in kept.items()}
    for word in SEED_WORDS:
        weights[word] = max(weights.get(word, 0.0), SEED_WEIGHT)
    return ToxicityModel(weights, {t: k[1] for t, k in kept.items()}, {t: k[2] for t, k in kept.items()},
                         n_toxic, n_clean)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    penalty = np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty,
                               x.T @ (y - p) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def fit(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> ToxicityModel:
    """Learn lexicon, exceptions and score from the labelled rows for which ``learn`` holds.

    Without labelled toxic and clean texts the seed words and default coefficients remain.
    What reaches the driver (terms, exception phrases, two numbers a text) comes from at most
    ``MAX_TOXIC`` and ``MAX_CLEAN`` texts; nested stems are left out in Spark before.
    """
    train = training_ids(labels, id_col, label_col, learn)
    texts = Scratch(docs.sparkSession, "toxicity").few(
        training_texts(docs, train, id_col, text_col))
    sizes = {r["label"]: r["count"] for r in texts.groupBy("label").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return ToxicityModel(dict.fromkeys(SEED_WORDS, SEED_WEIGHT))
    support = max(MIN_SUPPORT, math.ceil(MIN_SUPPORT_SHARE * n_toxic))
    rows = standing_out(stem_counts(texts).filter(F.col("toxic") >= support), n_toxic, n_clean).collect()
    model = lexicon(rows, n_toxic, n_clean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in slices(batches):
            out = []
            for label, folded in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, y = matcher.features(folded, without_one=label == 1)
                out.append((label, x, y, sorted({p for _, s in matcher.hits(folded)
                                                 for p in phrases(plain(folded), s)})))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(
                    (pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.string())))],
                ["label", "x", "y", "phrases"])

    seen = texts.mapInArrow(run, "label int, x double, y double, phrases array<string>")
    points = seen.select("label", "x", "y").toPandas()
    around = seen.select("label", F.explode("phrases").alias("phrase")).groupBy("phrase").agg(
        F.sum("label").alias("toxic"), F.count("*").alias("n")) \
        .filter("toxic = 0 and n >= 2").select("phrase").collect()
    model.exceptions = model.exceptions | {r["phrase"] for r in around}
    model.coefficients = fit_logistic(points[["x", "y"]].to_numpy(), points["label"].to_numpy())
    return model


def score_documents(docs: DataFrame, model: ToxicityModel, text_col: str = "text",
                    threshold: float = THRESHOLD, score: str = "score",
                    predicted: str = "predicted") -> DataFrame:
    """``docs`` plus columns ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Null and empty texts score like a text without hits; very long ones are read whole. Repeated rows
    score alike, an empty table gives an empty one, and other columns pass through untouched;
    columns of the two names are replaced.
    """
    docs = docs.drop(score, predicted)
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType()),
                           T.StructField(predicted, T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in slices(batches):
            scores = [matcher.score(t or "") for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                batch.columns + [pa.array(scores, pa.float64()),
                                 pa.array([int(s >= threshold) for s in scores], pa.int32())],
                schema.names)

    return docs.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """The rows whose labels are never learned from; a row without an id counts as one."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(True))
