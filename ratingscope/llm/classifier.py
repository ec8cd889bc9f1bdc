"""Quality classifier: a factorisation machine over a whole text.

Features: hashed words (each with its share of the text), structure statistics (shares of
symbols, capitals, digits, repeats; line and word lengths), and the metadata column n_chars
as buckets. The model adds to the linear part every pairwise interaction as the product of
low-rank factors. By ``sum_{i<j} <v_i, v_j> x_i x_j = (|sum v_i x_i|^2 - sum |v_i x_i|^2) / 2``
a text is scored in time linear in its features.

Edge cases. Null and empty texts have only the structure features. A null n_chars is a bucket
of its own. Without labels of both kinds every text scores the share of label 1, or 0.5.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .samples import labelled_sample

SLOTS = 1 << 15  # hashed words
RANK = 8
ROWS = 6_000  # labelled documents to fit on, about
EPOCHS = 8
BATCH = 128
RATE = 0.02
DECAY = 1e-4
SEED = 7
EDGES = (0.0, 0.01, 0.03, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.95)
STATS = 14
SIZES = 24  # buckets of n_chars: powers of two, and null
WIDTH = SLOTS + STATS * (len(EDGES) + 1) + SIZES
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")

# Classes of bytes: 0 other, 1 small, 2 capital, 3 digit, 4 blank, 5 line end, 6 symbol, 7 punctuation, 8 beyond ASCII.
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[[32, 9, 11, 12, 13]] = 4
_CLASS[10] = 5
_CLASS[list(b"#*$%&|<>")] = 6
_CLASS[list(b".,;:!?'\"()-")] = 7
_CLASS[128:] = 8


@lru_cache(maxsize=200_000)
def _slot(word: str) -> int:
    return crc32(word.encode("utf-8", "surrogatepass")) % SLOTS


def statistics(text: str, words: list[str], counts: Counter) -> list[float]:
    """STATS numbers from 0 to 1."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    kinds = np.bincount(_CLASS[data], minlength=9) / max(1, len(data))
    n = max(1, len(words))
    again = sum(a == b for a, b in zip(words, words[1:])) / n
    loud = text.count("!") / n
    lines = text.count("\n") + 1
    letters = kinds[1] + kinds[2] + kinds[8]
    return [
        kinds[2] / max(1e-9, letters),
        kinds[3],
        kinds[6],
        kinds[7],
        kinds[8],
        1 - len(counts) / n,
        again,
        min(1.0, loud),
        max(counts.values(), default=0) / n,
        min(1.0, lines / n),
        min(1.0, len(text) / n / 20),
        min(1.0, np.log1p(n) / 12),
        1.0 if not words else 0.0,
        sum(1 for w in counts if counts[w] == 1) / max(1, len(counts)),
    ]


def vector(text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's features."""
    text = text or ""
    words = TOKEN.findall(text)
    counts = Counter(words)
    slots = np.fromiter((_slot(w.lower()) for w in counts), dtype=np.int64, count=len(counts))
    share = np.sqrt(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)) / max(1, len(words)))
    stats = statistics(text, words, counts)
    at = SLOTS
    own = []
    for value in stats:
        own.append(at + 1 + int(np.searchsorted(EDGES, value, side="right")) - 1)
        at += len(EDGES) + 1
    size = 0 if n_chars is None else 1 + min(SIZES - 2, max(0, int(n_chars)).bit_length())
    own.append(at + size)
    index = np.concatenate([slots, np.array(own, dtype=np.int64)])
    return index, np.concatenate([share, np.full(len(own), 0.3)])


@dataclass
class FactorModel:
    bias: float = 0.0
    linear: np.ndarray | None = None
    factors: np.ndarray | None = None

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        total = self.bias
        if self.linear is not None:
            scaled = self.factors[index] * value[:, None]
            summed = scaled.sum(axis=0)
            total += float(self.linear[index] @ value) + 0.5 * float(summed @ summed - (scaled * scaled).sum())
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> FactorModel:
    """Adaptive gradient descent on the logistic loss, in batches of documents."""
    ones = sum(y for *_, y in rows)
    if not 0 < ones < len(rows):
        share = (ones + 0.5) / (len(rows) + 1)
        return FactorModel(bias=float(np.log(share / (1 - share))))
    rng = np.random.default_rng(SEED)
    bias, linear, factors = np.log(ones / (len(rows) - ones)), np.zeros(WIDTH), rng.normal(0, 0.05, (WIDTH, RANK))
    sq_bias, sq_linear, sq_factors = 1.0, np.full(WIDTH, 1.0), np.full((WIDTH, RANK), 1.0)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for start in range(0, len(rows), BATCH):
            batch = [rows[i] for i in order[start : start + BATCH]]
            index = np.concatenate([b[0] for b in batch])
            value = np.concatenate([b[1] for b in batch])
            row = np.repeat(np.arange(len(batch)), [len(b[0]) for b in batch])
            y = np.array([b[2] for b in batch], dtype=float)
            scaled = factors[index] * value[:, None]
            cuts = np.concatenate([[0], np.cumsum([len(b[0]) for b in batch])[:-1]])
            summed = np.add.reduceat(scaled, cuts, axis=0)
            logit = bias + np.add.reduceat(linear[index] * value, cuts) + 0.5 * ((summed**2).sum(axis=1) - np.add.reduceat((scaled**2).sum(axis=1), cuts))
            wrong = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y
            touched, inverse = np.unique(index, return_inverse=True)
            pull = wrong[row] * value
            g_linear = np.bincount(inverse, pull, len(touched)) + DECAY * linear[touched]
            each = pull[:, None] * (summed[row] - scaled)
            g_factors = np.stack([np.bincount(inverse, each[:, k], len(touched)) for k in range(RANK)], axis=1) + DECAY * factors[touched]
            sq_bias += wrong.sum() ** 2
            bias -= RATE * wrong.sum() / np.sqrt(sq_bias)
            sq_linear[touched] += g_linear**2
            linear[touched] -= 10 * RATE * g_linear / np.sqrt(sq_linear[touched])
            sq_factors[touched] += g_factors**2
            factors[touched] -= 2 * RATE * g_factors / np.sqrt(sq_factors[touched])
    return FactorModel(float(bias), linear.astype(np.float32), factors.astype(np.float32))


def fit_quality(docs: DataFrame, labels: DataFrame, *, label: str = "quality", folds: int = 3, fold: int = 1, rows: int = ROWS, work_dir: str | None = None) -> FactorModel:
    """A model from about ``rows`` labelled documents outside ``fold``.

    Features are made in Spark; what reaches the driver is bounded by ``rows`` and SLOTS.
    """
    sample = labelled_sample(docs, labels, label, folds=folds, fold=fold, rows=rows, work_dir=work_dir)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [vector(t.as_py(), n.as_py()) for t, n in zip(batch.column(0), batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i.astype(np.int32) for i, _ in made], type=pa.list_(pa.int32())), pa.array([v.astype(np.float32) for _, v in made], type=pa.list_(pa.float32())), batch.column(2)],
                names=["index", "value", "label"],
            )

    made = sample.select("text", "n_chars", "label").mapInArrow(vectors, "index array<int>, value array<float>, label int").toArrow()
    rows_of = zip(made.column("index").combine_chunks() if made.num_rows else [], made.column("value").combine_chunks() if made.num_rows else [], made.column("label").to_pylist())
    return train([(i.values.to_numpy().astype(np.int64), v.values.to_numpy().astype(np.float64), y) for i, v, y in rows_of])


def quality(text: Column, n_chars: Column, model: FactorModel) -> Column:
    """Score of a text, 0 to 1."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, sizes in batches:
            yield pa.array([model.score(*vector(t.as_py(), n.as_py())) for t, n in zip(texts, sizes)], type=pa.float64())

    return scored(text, n_chars.cast("long"))
