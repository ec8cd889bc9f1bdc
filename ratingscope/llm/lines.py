"""Quality rules by line labelling: a linear-chain conditional random field over lines.

Each line with a word becomes a set of features (bucketed shares and lengths, and whether it
repeats an earlier line or the one before). Two labels, content and boilerplate, are decoded
for all lines together by the Viterbi algorithm. A document is kept if at least KEEP of its
words stand in content lines and the plain rules hold.

Fitting. Lines of documents labelled good are content, those of bad ones boilerplate; weights
and transitions maximise the likelihood of whole label sequences (forward-backward).

Edge cases. Null and empty texts have no words, so the plain rules fail. Without labels of both
kinds all lines are content. Texts are read whole, whatever their length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .samples import labelled_sample

# Fixed values of the task.
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent

KEEP = 0.5
ROWS = 4_000
EPOCHS = 30
BATCH = 64
RATE = 0.1
DECAY = 1e-3
SEED = 11
EDGES = (0.001, 0.02, 0.08, 0.2, 0.4, 0.7)
NUMBERS = 9
FLAGS = 4
WIDTH = 1 + NUMBERS * (len(EDGES) + 1) + FLAGS
TYPE = "struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,content_share:double,n_content:long>"


def repeat_words(words: list[str], window: int = WINDOW) -> int:
    """Words that lie in a window of 8 words found twice or more, exactly.

    Windows are numbered by doubling: pairs of words, pairs of pairs, and so on.
    """
    if len(words) <= window:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    if len(number) == len(words):
        return 0
    step = 1
    while step < window:
        _, ids = np.unique(ids[:-step] * (int(ids.max()) + 1) + ids[step:], return_inverse=True)
        step *= 2
    again = np.bincount(ids)[ids] > 1
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    places = np.flatnonzero(again)
    np.add.at(edge, places, 1)
    np.add.at(edge, places + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def line_features(lines: list[str]) -> list[list[int]]:
    """Indices of the features of each line; all lines hold a word."""
    rows, seen, before = [], set(), None
    for line in lines:
        words = TOKEN.findall(line)
        counts = Counter(words)
        n, size = len(words), len(line)
        letters = sum(map(str.isalpha, line))
        numbers = (
            sum(map(line.count, SYMBOLS)) / size,
            sum(map(str.isupper, line)) / max(1, letters),
            1 - letters / max(1, sum(map(len, words))),
            1 - len(counts) / n,
            sum(a == b for a, b in zip(words, words[1:])) / n,
            max(counts.values()) / n,
            line.count("!") / n,
            min(1.0, size / n / 20),
            min(1.0, n / 100),
        )
        row = [0]
        for k, value in enumerate(numbers):
            row.append(1 + k * (len(EDGES) + 1) + sum(value > e for e in EDGES))
        flags = (line in seen, line == before, not line.rstrip().endswith((".", "!", "?", ":", '"')), n < 4)
        row.extend(WIDTH - FLAGS + k for k, flag in enumerate(flags) if flag)
        seen.add(line)
        before = line
        rows.append(row)
    return rows


@dataclass
class LineModel:
    """Weights of (feature, label) and (label, next label); label 1 is content."""

    weights: np.ndarray
    moves: np.ndarray

    def decode(self, rows: list[list[int]]) -> list[int]:
        """The likeliest labels of all lines (Viterbi)."""
        scores = [self.weights[row].sum(axis=0).tolist() for row in rows]
        if not scores:
            return []
        (m00, m01), (m10, m11) = self.moves.tolist()
        back = []
        a, b = scores[0]
        for s0, s1 in scores[1:]:
            from0, from1 = (0 if a + m00 >= b + m10 else 1), (0 if a + m01 > b + m11 else 1)
            back.append((from0, from1))
            a, b = (a + m00 if from0 == 0 else b + m10) + s0, (a + m01 if from1 == 0 else b + m11) + s1
        label = 0 if a > b else 1
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return labels[::-1]


def train(rows: list[tuple[np.ndarray, int]]) -> LineModel:
    """Weights from (lines x WIDTH feature matrix, label of all its lines)."""
    weights, moves = np.zeros((WIDTH, 2)), np.zeros((2, 2))
    if len({y for _, y in rows}) < 2:
        weights[0, 1] = 1.0
        return LineModel(weights, moves)
    rng = np.random.default_rng(SEED)
    sq_w, sq_m = np.full_like(weights, 1e-2), np.full_like(moves, 1e-2)
    # Both labels count the same, so that the larger one does not decide alone.
    share = np.mean([y for _, y in rows])
    order = sorted(range(len(rows)), key=lambda i: len(rows[i][0]))
    batches = [order[a : a + BATCH] for a in range(0, len(order), BATCH)]
    for _ in range(EPOCHS):
        for at in rng.permutation(len(batches)):
            batch = [rows[i] for i in batches[at]]
            most = max(len(x) for x, _ in batch)
            x = np.zeros((len(batch), most, WIDTH))
            mask = np.zeros((len(batch), most))
            for k, (m, _) in enumerate(batch):
                x[k, : len(m)], mask[k, : len(m)] = m, 1
            y = np.array([v for _, v in batch])
            part = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))[:, None] / mask.sum(axis=1, keepdims=True)
            score = x @ weights
            ahead, behind = np.zeros_like(score), np.zeros_like(score)
            ahead[:, 0] = score[:, 0]
            for t in range(1, most):
                step = np.logaddexp(ahead[:, t - 1, 0, None] + moves[0], ahead[:, t - 1, 1, None] + moves[1]) + score[:, t]
                ahead[:, t] = np.where(mask[:, t, None] > 0, step, ahead[:, t - 1])
            for t in range(most - 2, -1, -1):
                there = score[:, t + 1] + behind[:, t + 1]
                step = np.logaddexp(moves[:, 0] + there[:, 0, None], moves[:, 1] + there[:, 1, None])
                behind[:, t] = np.where(mask[:, t + 1, None] > 0, step, 0)
            total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
            odds = np.exp(ahead + behind - total[:, None, None]) * mask[:, :, None]
            true = np.stack([1 - y, y], axis=1)[:, None, :] * mask[:, :, None]
            g_w = np.einsum("bti,btl->il", x, (odds - true) * part[:, :, None]) + DECAY * weights
            pair = ahead[:, :-1, :, None] + moves + (score + behind)[:, 1:, None, :] - total[:, None, None, None]
            pair = np.exp(np.minimum(pair, 0)) * mask[:, 1:, None, None]
            same = true[:, :-1, :, None] * true[:, 1:, None, :]
            g_m = ((pair - same) * part[:, :, None, None]).sum(axis=(0, 1)) + DECAY * moves
            sq_w += g_w**2
            sq_m += g_m**2
            weights -= RATE * g_w / np.sqrt(sq_w)
            moves -= RATE * g_m / np.sqrt(sq_m)
    return LineModel(weights, moves)


def worded(text: str | None) -> list[str]:
    """Lines of a text that hold a word."""
    return [line for line in (text or "").split("\n") if TOKEN.search(line)]


def fit_lines(docs: DataFrame, labels: DataFrame, *, rows: int = ROWS, folds: int = 5, fold: int = 0, work_dir: str | None = None) -> LineModel:
    """A model from about ``rows`` labelled documents outside ``fold``.

    Features are made in Spark; at most ``rows`` documents' worth of them reach the driver,
    each line as one row of small numbers.
    """
    sample = labelled_sample(docs, labels, "quality", folds=folds, fold=fold, rows=rows, work_dir=work_dir)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [line_features(worded(t.as_py())) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(made, type=pa.list_(pa.list_(pa.int32()))), batch.column(1)], names=["lines", "label"])

    made = sample.select("text", "label").mapInArrow(described, "lines array<array<int>>, label int").collect()
    data = []
    for r in made:
        if r["lines"]:
            x = np.zeros((len(r["lines"]), WIDTH))
            for k, row in enumerate(r["lines"]):
                x[k, row] = 1
            data.append((x, r["label"]))
    return train(data)


def line_report(text: Column, model: LineModel) -> Column:
    """Plain counts of a text and the share of its words in content lines."""

    @F.arrow_udf(TYPE)
    def report(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_share", "n_content")
        kind = pa.struct([(n, pa.float64() if n == "content_share" else pa.int64()) for n in names])
        for batch in texts:
            rows = []
            for value in batch:
                text = value.as_py() or ""
                words = TOKEN.findall(text)
                lines = worded(text)
                labels = model.decode(line_features(lines))
                sizes = [len(TOKEN.findall(line)) for line in lines]
                content = sum(n for n, label in zip(sizes, labels) if label)
                rows.append((
                    len(words),
                    sum(map(len, words)),
                    sum(map(text.count, SYMBOLS)),
                    len(lines) - len(set(lines)),
                    repeat_words(words),
                    content / max(1, len(words)),
                    sum(labels),
                ))
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.StructArray.from_arrays([pa.array(c, type=kind.field(i).type) for i, c in enumerate(columns)], fields=list(kind))

    return report(text)


def quality_rules(docs: DataFrame, model: LineModel, *, keep: float = KEEP) -> DataFrame:
    """``doc_id``, the plain counts, ``content_share``, ``base_failed`` and ``kept``."""
    rows = docs.select("doc_id", line_report(F.col("text"), model).alias("r")).select("doc_id", "r.*")
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    rows = rows.withColumn("base_failed", failed)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("content_share") >= keep))
