"""Toxicity by maximum-scoring segments.

Model. A word's score is its log-odds between toxic and other documents, in documents that
hold it, with a Dirichlet prior: rare words lean on their stem (the first letters), stems on
the whole sample. Words without evidence score ``-DRIFT``, so random text drifts down.

Scan. One pass over a text's words finds all maximal scoring segments (each cannot be made
better at either end). Only words of positive score move the scan, which is linear in them.

Calibration. Scores of chance segments in clean text follow an extreme-value law: the number
of segments of score S or more in n words is about ``K n exp(-lambda S)``. lambda solves
``E[exp(lambda s)] = 1`` over clean words, K comes from the best segments of clean documents.
Segments with an expected number below SIGNIFICANT are toxic passages. A document's score is
a logistic function of the summed and the best log-significance of its passages, fitted on
the labelled documents, each scored as if it had not been counted itself.

Edge cases. Null and empty texts have no words and get the score of a clean text. Without
labels of both kinds every text scores 0. Only the text column is read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workdir import materialized
from .samples import ROWS, labelled_sample

WORD = re.compile(r"[^\W\d_]+")
STEM = 4
DRIFT = 1.0
PRIOR = 5.0  # documents a prior counts for
SEEN = 2  # toxic documents a word or stem must be in
OWN = 20  # toxic documents from which a word no longer counts for its stem
MODEL_WORDS = 30_000
MODEL_STEMS = 2_000
SIGNIFICANT = 0.05
MEMO = 200_000
TYPE = "struct<score:double,passages:array<struct<start:int,end:int,score:double,log_e:double>>>"


@dataclass
class ToxicModel:
    """Numbers of toxic and other documents that hold a word or a stem, and the calibration."""

    base: float = 0.5  # share of toxic documents
    words: dict[str, tuple[int, int]] = field(default_factory=dict)
    stems: dict[str, tuple[int, int]] = field(default_factory=dict)
    lam: float = 1.0
    log_k: float = 0.0
    weights: tuple[float, float, float] | None = None  # intercept, summed, best

    def word_score(self, word: str, without: int | None = None) -> float:
        """Log-odds of a word less DRIFT where that is positive, else 0 (scored as -DRIFT).

        ``without`` is the label of a counted document that holds the word and is left out.
        """
        own, stem = self.words.get(word), self.stems.get(word[:STEM]) if len(word) > STEM else None
        if own is None and stem is None:
            return 0.0
        less = (int(without == 1), int(without == 0))
        share = self.base
        if stem is not None:
            a, b = max(0, stem[0] - less[0]), max(0, stem[1] - less[1])
            share = (a + PRIOR * self.base) / (a + b + PRIOR)
        a, b = (max(0, own[0] - less[0]), max(0, own[1] - less[1])) if own else (0, 0)
        odds = math.log((a + PRIOR * share) / (b + PRIOR * (1 - share))) - math.log(self.base / (1 - self.base))
        return max(0.0, odds - DRIFT)


def segments(hits: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last place, score), given the places of positive
    scores in order; every other place scores ``-drift``."""
    first, last, low, high, link = [], [], [], [], []
    total, at = 0.0, -1
    for place, score in hits:
        total -= drift * (place - at - 1)
        at, start, base = place, place, total
        total += score
        while True:
            j = len(first) - 1
            while j >= 0 and low[j] >= base:
                j = link[j]
            if j < 0 or high[j] >= total:
                break
            start, base = first[j], low[j]
            del first[j:], last[j:], low[j:], high[j:], link[j:]
        first.append(start), last.append(place), low.append(base), high.append(total), link.append(j)
    return [(a, b, r - l) for a, b, l, r in zip(first, last, low, high)]


class Scanner:
    """A model with a memory of word scores, for one worker."""

    def __init__(self, model: ToxicModel, without: int | None = None):
        self.model, self.without = model, without
        self.known: dict[str, float] = {}

    def hits(self, words: list[str]) -> list[tuple[int, float]]:
        known = self.known
        if len(known) > MEMO:
            known.clear()
        missing = set(words).difference(known)
        for word in missing:
            known[word] = self.model.word_score(word, self.without)
        return [(i, s) for i, s in enumerate(map(known.__getitem__, words)) if s]

    def passages(self, words: list[str]) -> list[tuple[int, int, float, float]]:
        """Segments with the logarithm of the number of them expected by chance."""
        hits = self.hits(words)
        if not hits:
            return []
        room = self.model.log_k + math.log(len(words))
        return [(a, b, s, room - self.model.lam * s) for a, b, s in segments(hits)]


def features(passages: list[tuple[int, int, float, float]]) -> tuple[float, float]:
    """Summed and best log-significance of the passages that are significant."""
    strong = [-e for *_, e in passages if e < math.log(SIGNIFICANT)]
    return (math.log1p(sum(strong)), math.log1p(max(strong))) if strong else (0.0, 0.0)


def _words(text: str | None) -> list[str]:
    """Words in lower case. Each is lowered by itself, so that they match their places in the text."""
    return [w.lower() for w in WORD.findall(text or "")]


def _count(sample: DataFrame, stems: bool, own: frozenset[str] = frozenset()) -> DataFrame:
    """(``w``, ``a`` toxic, ``b`` other documents) of words, or of stems without ``own``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1)):
                words = set(_words(text.as_py()))
                if stems:
                    words = {w[:STEM] for w in words - own if len(w) > STEM}
                seen[label.as_py()].update(words)
        names = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, type=pa.string()), pa.array([seen[1][n] for n in names], type=pa.int64()), pa.array([seen[0][n] for n in names], type=pa.int64())],
            names=["w", "a", "b"],
        )

    parts = sample.select("text", "label").mapInArrow(counted, "w string, a long, b long")
    return parts.groupBy("w").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def _calibrate(model: ToxicModel, sample: DataFrame) -> None:
    """lambda, K and the logistic weights, each document left out of the counts it meets."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanners = [Scanner(model, without=label) for label in (0, 1)]
        for batch in batches:
            rows = []
            for text, label in zip(batch.column(0), batch.column(1)):
                words = _words(text.as_py())
                hits = scanners[label.as_py()].hits(words)
                found = segments(hits)
                rows.append((label.as_py(), len(words), [s for _, s in hits], [s for *_, s in found]))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], type=k) for k in kinds], names=["label", "n", "hits", "found"])

    rows = sample.select("text", "label").mapInArrow(measured, "label long, n long, hits array<double>, found array<double>").collect()
    clean = [r for r in rows if r["label"] == 0 and r["n"]]
    scores = np.array([s for r in clean for s in r["hits"]])
    plain = sum(r["n"] for r in clean) - len(scores)
    if plain:
        total = plain + len(scores)
        low, high = 1e-3, 20.0
        for _ in range(60):
            mid = (low + high) / 2
            mean = (plain * math.exp(-mid * DRIFT) + np.exp(np.minimum(mid * scores, 300)).sum()) / total
            low, high = (mid, high) if mean < 1 else (low, mid)
        model.lam = min(low, 2.0)
        best = [(max(r["found"], default=0.0), r["n"]) for r in clean]
        # The mean of an extreme-value law lies Euler's constant above its place.
        model.log_k = float(np.mean([model.lam * s - math.log(n) for s, n in best])) - 0.5772
        model.log_k = min(max(model.log_k, -12.0), 2.0)
    x, y = [], []
    for r in rows:
        room = model.log_k + math.log(max(1, r["n"]))
        x.append((1.0, *features([(0, 0, s, room - model.lam * s) for s in r["found"]])))
        y.append(r["label"])
    if 0 < sum(y) < len(y):
        x, y = np.array(x), np.array(y, dtype=float)
        w = np.zeros(3)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (y - p) - 0.5 * w
            hess = (x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(3)
            w = w + np.linalg.solve(hess, grad)
        model.weights = tuple(float(v) for v in w)


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, folds: int = 5, fold: int = 0, rows: int = ROWS, work_dir: str | None = None) -> ToxicModel:
    """A model from about ``rows`` labelled documents outside ``fold``.

    What reaches the driver is bounded: words and stems seen in SEEN or more toxic documents
    of the sample, MODEL_WORDS and MODEL_STEMS at most, and a few numbers per calibration document.
    """
    sample = labelled_sample(docs, labels, "toxic", folds=folds, fold=fold, rows=rows, work_dir=work_dir)
    toxic, other = (sample.where(F.col("label") == v).count() for v in (1, 0))
    if not toxic or not other:
        return ToxicModel()
    model = ToxicModel(base=toxic / (toxic + other))
    counts = materialized(_count(sample, stems=False), "toxic-words", work_dir)
    telling = F.col("a") / (F.col("b") + 1)
    frequent = counts.where(F.col("a") >= SEEN).orderBy(F.desc(telling), "w").limit(MODEL_WORDS).collect()
    own = frozenset(r["w"] for r in frequent if r["a"] >= OWN)
    stems = _count(sample, stems=True, own=own).where(F.col("a") >= SEEN)
    # Only stems that tell something; the prior of all others is the base share.
    stems = stems.where(F.col("a") / (F.col("a") + F.col("b")) > 2 * model.base).orderBy(F.desc(telling), "w").limit(MODEL_STEMS).collect()
    model.stems = {r["w"]: (r["a"], r["b"]) for r in stems}
    # Words of such stems that clean documents hold too, so that they do not inherit all of it.
    nearby = counts.where(F.substring("w", 1, STEM).isin(list(model.stems)) & (F.length("w") > STEM) & (F.col("b") > 0))
    nearby = nearby.orderBy(F.desc("b"), "w").limit(MODEL_WORDS).collect() if stems else []
    model.words = {r["w"]: (r["a"], r["b"]) for r in [*frequent, *nearby]}
    _calibrate(model, sample)
    return model


def toxicity(text: Column, model: ToxicModel) -> Column:
    """Score (0 to 1) and significant passages (code points) of a text."""

    @F.arrow_udf(TYPE)
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(model)
        kind = pa.struct([("score", pa.float64()), ("passages", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("log_e", pa.float64())])))])
        for batch in texts:
            rows = []
            for value in batch:
                text = value.as_py() or ""
                found = scanner.passages(_words(text))
                strong = [p for p in found if p[3] < math.log(SIGNIFICANT)]
                places = []
                if strong:
                    spans = [m.span() for m in WORD.finditer(text)]
                    places = [{"start": spans[a][0], "end": spans[b][1], "score": s, "log_e": e} for a, b, s, e in strong]
                score = 0.0
                if model.weights:
                    w = model.weights
                    f = features(found)
                    score = 1 / (1 + math.exp(-max(-30.0, min(30.0, w[0] + w[1] * f[0] + w[2] * f[1]))))
                rows.append({"score": score, "passages": places})
            yield pa.array(rows, type=kind)

    return scored(text)
