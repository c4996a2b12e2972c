"""Quality classifier by co-training a text view and a page-metadata view.

*Text view*: frequencies of character-class pairs and word statistics of the
whole text. *Metadata view*: language, source, size and line layout, and what the
document's web page tells (address, title, links, paragraphs), where there is one.

Both views start from the labelled rows. In every round each view's classifier
scores all rows without a label, and its most confident ones of either class become
labelled rows of the *other* view. After the last round each view is calibrated on
labelled rows kept back, and both calibrated views are combined into one score.

Scoring and the search for confident rows cover every row, in parallel. Only
bounded samples reach the driver: ``MAX_LABELLED`` labelled rows and ``PSEUDO`` rows
a class, view and round.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herald.llm.common import Scratch, slices, utf8

MAX_LABELLED = 12000
PSEUDO = 1000
ROUNDS = 3
CONFIDENT = 0.95
CALIBRATION_SHARE = 5

#: Character classes by byte: control, lower, upper, digit, blank, line end, stop, comma, bar,
#: signs, marks, other punctuation, beyond ASCII.
_CLASSES = 13
_CLASS = np.zeros(256, dtype=np.int64)
for _number, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
                                  b" \t", b"\n\r", b".", b",", b"|", b"#*$%&<>", b"!?",
                                  b"\"'()+-/:;=@[\\]^_`{}~"), start=1):
    _CLASS[list(_chars)] = _number
_CLASS[128:] = 12
TEXT_DIM = _CLASSES * _CLASSES + 6
LANGS, SOURCES, LAYOUT, PAGE = 8, 16, 4, 10
META_DIM = LANGS + SOURCES + LAYOUT + PAGE
_ADDRESS = re.compile(r"^\w+://([^/?#]*)([^?#]*)(\?[^#]*)?")
_TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.S | re.I)


def text_features(text: bytes) -> np.ndarray:
    """Square roots of class-pair frequencies, then six word and line statistics."""
    out = np.zeros(TEXT_DIM, dtype=np.float32)
    if len(text) > 1:
        c = _CLASS[np.frombuffer(text, dtype=np.uint8)]
        pairs = np.bincount(c[:-1] * _CLASSES + c[1:], minlength=_CLASSES * _CLASSES)
        out[:-6] = np.sqrt(pairs / (len(text) - 1))
    words = text.split()
    if words:
        lines = text.split(b"\n")
        n = len(words)
        out[-6:] = (np.log1p(n) / 10, len(set(words)) / n, len(text) / n / 10,
                    Counter(words).most_common(1)[0][1] / n,
                    sum(map(eq, words, words[1:])) / n, 1 - len(set(lines)) / len(lines))
    return out


def one_hot(value: str | None, size: int) -> np.ndarray:
    out = np.zeros(size, dtype=np.float32)
    if value is not None:
        out[zlib.crc32(value.encode()) % size] = 1
    return out


def layout_features(text: bytes) -> tuple[float, ...]:
    lines = text.split(b"\n")
    return (np.log1p(len(text)) / 10, np.log1p(len(lines)) / 5, np.log1p(len(text) / len(lines)) / 10,
            sum(len(x) < 20 for x in lines) / len(lines))


def page_features(url: str, html: str) -> np.ndarray:
    """What address and markup tell of a page; its article text isn't read."""
    host, path, query = (m.groups() if (m := _ADDRESS.match(url)) else ("", "", None))
    title = m[1] if (m := _TITLE.search(html)) else ""
    size = max(1, len(title))
    low = html.lower()
    return np.array([1, len(re.findall(r"[^\w\s.,]", title)) / size,
                     sum(x.isupper() for x in title) / size, title.count("|") / size,
                     np.log1p(len(html)) / 12, np.log1p(low.count("<a ")) / 5, np.log1p(low.count("<p")) / 5,
                     host.count("-") + host.count(".") / 4, path.count("/") / 4, query is not None],
                    dtype=np.float32)


def page_metadata(pages: DataFrame) -> DataFrame:
    """(doc_id, page): features of the page that shows a document, the smallest page_id if several.

    The number in a page's path is the document's id.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [page_features(u or "", h or "").tolist()
                    for u, h in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float32()))],
                ["doc_id", "page_id", "page"])

    number = F.expr("try_cast(regexp_extract(url, '^\\\\w+://[^/]*/(?:[^?#]*/)?([0-9]+)', 1) as bigint)")
    return pages.select(number.alias("doc_id"), "page_id", "url", "html").filter("doc_id is not null") \
        .mapInArrow(run, "doc_id long, page_id long, page array<float>") \
        .groupBy("doc_id").agg(F.min(F.struct("page_id", "page"))["page"].alias("page"))


def views(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, text_view, meta_view) for every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floats = pa.list_(pa.float32())
        for batch in slices(batches):
            texts = utf8(batch.column(1))
            meta = [np.concatenate([one_hot(lang, LANGS), one_hot(source, SOURCES),
                                    np.array(layout_features(t), dtype=np.float32)]).tolist()
                    for t, lang, source in zip(texts, batch.column(2).to_pylist(),
                                               batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([text_features(t).tolist() for t in texts], floats),
                 pa.array(meta, floats)], ["doc_id", "text_view", "meta"])

    rows = docs.select("doc_id", "text", "lang", "source") \
        .mapInArrow(run, "doc_id long, text_view array<float>, meta array<float>")
    none = F.array_repeat(F.lit(0.0).cast("float"), PAGE)
    return rows.join(page_metadata(pages), "doc_id", "left") \
        .select("doc_id", "text_view", F.concat("meta", F.coalesce("page", none)).alias("meta_view"))


@dataclass
class Logistic:
    """Ridge logistic regression on standardised features; ``prob`` gives P(class 1)."""

    mean: np.ndarray
    scale: np.ndarray
    beta: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Logistic:
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
        beta, penalty = np.zeros(z.shape[1]), np.diag([1e-6] + [ridge] * x.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
            w = np.maximum(p * (1 - p), 1e-6)
            step = np.linalg.solve((z * w[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ beta)
            beta += np.clip(step, -3, 3)
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, scale, beta)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.beta[0] + ((x - self.mean) / self.scale) @ self.beta[1:], -30, 30)

    def prob(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logit(x)))


@dataclass
class CoTrained:
    """Two views' classifiers, their calibrations, and the classifier of both calibrated logits."""

    text: Logistic | None = None
    meta: Logistic | None = None
    text_scale: Logistic | None = None
    meta_scale: Logistic | None = None
    both: Logistic | None = None
    prior: float = 0.5

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.text is None:
            flat = np.full(len(text), self.prior)
            return flat, flat, flat
        a = self.text_scale.logit(self.text.logit(text)[:, None])
        b = self.meta_scale.logit(self.meta.logit(meta)[:, None])
        s = [1 / (1 + np.exp(-v)) for v in (a, b)]
        return s[0], s[1], self.both.prob(np.column_stack([a, b]))


def matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else \
        np.zeros((0, 1))


def confident(unlabelled: DataFrame, text: Logistic, meta: Logistic, pseudo: int) -> list:
    """Rows for the other view: of each view and class the ``pseudo`` most confident ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(text.prob(matrix(batch.column(1)))),
                     pa.array(meta.prob(matrix(batch.column(2))))],
                    ["doc_id", "text_view", "meta_view", "a", "b"])

    scored = unlabelled.mapInArrow(run, "doc_id long, text_view array<float>, meta_view array<float>, "
                                        "a double, b double")
    out = []
    for by, given in (("a", "meta_view"), ("b", "text_view")):
        for label, sure in ((1, F.col(by)), (0, 1 - F.col(by))):
            out.append(scored.filter(sure >= CONFIDENT).orderBy(sure.desc(), "doc_id").limit(pseudo)
                       .select(F.lit(given).alias("view"), F.lit(label).alias("label"),
                               F.col(given).alias("x")))
    rows = out[0]
    for x in out[1:]:
        rows = rows.union(x)
    return rows.collect()


def train(features: DataFrame, labels: DataFrame, learn, label_col: str = "quality", rounds: int = ROUNDS,
          pseudo: int = PSEUDO, max_labelled: int = MAX_LABELLED) -> CoTrained:
    """Co-train on the labelled rows for which ``learn`` holds and on all others without labels.

    Without labelled rows of both classes every document gets the share of the good ones
    (one half if there are none).
    """
    known = labels.filter(learn).groupBy("doc_id").agg(F.max(label_col).alias("label")) \
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    scratch = Scratch(features.sparkSession, "cotraining")
    known = scratch.few(known)
    rows = features.join(F.broadcast(known), "doc_id") \
        .withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(CALIBRATION_SHARE))) \
        .toArrow().sort_by("doc_id").combine_chunks()
    y = rows["label"].to_numpy().astype(float)
    if len(set(y)) < 2:
        return CoTrained(prior=float(y.mean()) if len(y) else 0.5)
    text, meta = (matrix(rows[c].combine_chunks()) for c in ("text_view", "meta_view"))
    back = rows["fold"].to_numpy() == 0
    if len(set(y[back])) < 2 or len(set(y[~back])) < 2:
        back = np.zeros(len(y), dtype=bool)
    train_rows, held = ~back, back if back.any() else ~back
    seen = {"text_view": [(text[train_rows], y[train_rows])], "meta_view": [(meta[train_rows], y[train_rows])]}

    def fitted(view: str) -> Logistic:
        return Logistic.fit(np.concatenate([x for x, _ in seen[view]]),
                            np.concatenate([v for _, v in seen[view]]))

    unlabelled = features.join(F.broadcast(known.select("doc_id")), "doc_id", "left_anti")
    a, b = fitted("text_view"), fitted("meta_view")
    for _ in range(rounds):
        for view in seen:  # a round's pseudo-labels replace those of the round before
            del seen[view][1:]
        for row in confident(unlabelled, a, b, pseudo):
            seen[row["view"]].append((np.array([row["x"]], dtype=float), np.array([float(row["label"])])))
        a, b = fitted("text_view"), fitted("meta_view")
    la, lb = a.logit(text[held])[:, None], b.logit(meta[held])[:, None]
    sa, sb = Logistic.fit(la, y[held]), Logistic.fit(lb, y[held])
    both = Logistic.fit(np.column_stack([sa.logit(la), sb.logit(lb)]), y[held])
    return CoTrained(a, b, sa, sb, both, float(y.mean()))


def classify(docs: DataFrame, pages: DataFrame, labels: DataFrame, learn, label_col: str = "quality",
             threshold: float = 0.5, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, ``text_score``, ``meta_score``, ``score`` (P of good), ``predicted``.

    Null texts count as empty, null languages and sources as none; a document without
    a page has zero page features; a null id never meets a label or a page;
    repeated rows score alike; an empty table gives an empty one. Only ``doc_id``, ``text``,
    ``lang`` and ``source`` are read.
    """
    features = Scratch(docs.sparkSession, "views").write(views(docs, pages))
    model = train(features, labels, learn, label_col, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b, s = model.scores(matrix(batch.column(1)), matrix(batch.column(2)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *map(pa.array, (a, b, s)), pa.array((s >= threshold).astype(np.int32))],
                    ["doc_id", "text_score", "meta_score", "score", "predicted"])

    return features.mapInArrow(run, "doc_id long, text_score double, meta_score double, score double, "
                                    "predicted int")
