"""Approximate nearest neighbours by multi-index hashing, nearest by largest inner product.

Codes. Vectors are scaled by the largest norm and get one more component that fills them to
unit length (zero for queries), which turns the inner product into an angle. Rotations learned
on a bounded sample (iterative quantisation, several starts) give BITS sign bits.

Index. A code is cut into substrings of 16 bits, each with a table from value to rows. If two
codes differ in r bits or fewer, some substring differs in few bits (pigeonhole), so probing
every table within that distance retrieves every code within the radius. These are compared
bit by bit, and those within the radius reranked by the original vectors in double precision.

The radius is measured, not guessed: for a few queries all rows are searched exactly, and the
radius is the quantile RECALL of the distances of their true neighbours. A query that finds too
few rows goes through wider radii until it has them.

Work is dealt out in a grid of blocks of rows and blocks of queries, both by a hash of the id;
a cell keeps its best rows per query, and the cells' lists are merged. Blocks are smaller for
longer vectors, so that a cell's memory is bounded.

Edge cases. Vectors that are null, empty, zero, hold null or non-finite components, or differ in length from
most, take no part, nor do rows without an id. Rows that repeat an id count once (the smallest
vector). Ties go to the smaller id. Fewer than k candidates: all of them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..workdir import materialized

K = 20
EVERY = 20  # fixed value of the task: ids divisible by this are queries
BITS = 256
SUB = 16  # bits of a substring
SAMPLE = 4096  # vectors the rotations are learned on
PROBES = 64  # queries the radius is measured on
RECALL = 0.97
STEPS = 15
SEED = 5
LEAST_BLOCK, MOST_BLOCK = 4096, 65536
NUMBERS = 1 << 22  # components of the vectors of a block, and of pairs scored at a time
CHUNK = 32  # queries that probe at a time
FOUND = "query_id long, vec_id long, score double"


@dataclass
class Codes:
    mean: np.ndarray
    rotation: np.ndarray  # (d + 1) x BITS
    scale: float

    def of(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Codes as rows of BITS / 64 unsigned words."""
        norm = np.linalg.norm(vectors, axis=1, keepdims=True)
        if query:
            full = np.hstack([vectors / norm, np.zeros((len(vectors), 1))])
        else:
            x = vectors / self.scale
            full = np.hstack([x, np.sqrt(np.maximum(0, 1 - (norm / self.scale) ** 2))])
        bits = (full - self.mean) @ self.rotation > 0
        return np.packbits(bits, axis=1).view(np.uint64)


def learn_codes(sample: np.ndarray, scale: float) -> Codes:
    """Rotations that bring sign bits close to the vectors (iterative quantisation)."""
    x = sample / scale
    x = np.hstack([x, np.sqrt(np.maximum(0, 1 - (x**2).sum(axis=1, keepdims=True)))])
    mean = x.mean(axis=0)
    x = x - mean
    rng = np.random.default_rng(SEED)
    parts, d = [], x.shape[1]
    while sum(p.shape[1] for p in parts) < BITS:
        turn, _ = np.linalg.qr(rng.normal(size=(d, d)))
        for _ in range(STEPS):
            u, _, v = np.linalg.svd(np.where(x @ turn > 0, 1.0, -1.0).T @ x)
            turn = (u @ v).T
        parts.append(turn)
    return Codes(mean, np.hstack(parts)[:, :BITS], scale)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, component after component, so equal rows give equal bits."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += a[:, k] * b[:, k]
    return total


class SubstringIndex:
    """Tables from substring values to the rows of a block."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        parts = codes.view(np.uint16)
        self.tables = [np.unique(parts[:, j], return_inverse=True) for j in range(parts.shape[1])]

    def within(self, codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) places of all codes within ``radius`` bits."""
        parts = codes.view(np.uint16)
        found = np.zeros((len(codes), len(self.codes)), dtype=bool)
        near, rest = divmod(radius, len(self.tables))
        for j, (values, place) in enumerate(self.tables):
            # The first ``rest + 1`` substrings may differ in ``near`` bits, the others in one less.
            allowed = near if j <= rest else near - 1
            if allowed >= 0:
                hit = np.bitwise_count(parts[:, j, None] ^ values) <= allowed
                found |= hit[:, place]
        q, row = np.nonzero(found)
        close = np.bitwise_count(codes[q] ^ self.codes[row]).sum(axis=1) <= radius
        return q[close], row[close]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _best(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best rows of each query: by score, then smaller id."""
    order = np.lexsort((ids, -scores, q))
    ranked = q[order]
    starts = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, dtype=bool)
    at = np.arange(len(ranked))
    rank = at - np.maximum.accumulate(np.where(starts, at, 0))
    return order[rank < k]


def usable(embeddings: DataFrame, vector: str = "embedding", work_dir: str | None = None) -> DataFrame:
    """(``vec_id``, ``vector``) rows that take part, one per id."""
    good = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))) & F.exists(vector, lambda x: x != 0)
    rows = embeddings.where(F.col("vec_id").isNotNull() & good).select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = materialized(rows.groupBy("vec_id").agg(F.min("vector").alias("vector")), "ann-vectors", work_dir)
    size = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vector") == (size["d"] if size else 0))


def _grid(rows: DataFrame, queries: DataFrame, codes: Codes, radius: int, k: int, blocks: tuple[int, int]) -> DataFrame:
    """The k best rows within ``radius`` of each query, merged over all cells."""
    n, m = blocks
    place = lambda count, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(count))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    left = rows.select("vec_id", "vector", place(n, 1).alias("a")).select("*", every(m).alias("b"))
    right = queries.select("vec_id", "vector", place(m, 2).alias("b")).select("*", every(n).alias("a"))

    def cell(index: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if index.num_rows and asked.num_rows:
            ids, vectors = index.column("vec_id").to_numpy(), _matrix(index.column("vector"))
            q_ids, q_vectors = asked.column("vec_id").to_numpy(), _matrix(asked.column("vector"))
            tables, q_codes = SubstringIndex(codes.of(vectors)), codes.of(q_vectors, query=True)
            part = max(1, NUMBERS // vectors.shape[1])
            for at in range(0, len(q_ids), CHUNK):
                q, row = tables.within(q_codes[at : at + CHUNK], radius)
                q = q + at
                own = ids[row] != q_ids[q]
                q, row = q[own], row[own]
                scores = np.concatenate([inner(q_vectors[q[s : s + part]], vectors[row[s : s + part]]) for s in range(0, len(q), part)]) if len(q) else np.zeros(0)
                best = _best(q, ids[row], scores, k)
                out.append((q_ids[q[best]], ids[row[best]], scores[best]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, dtype=np.int64)] * 2 + [np.zeros(0)]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], names=["query_id", "vec_id", "score"])

    found = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInArrow(cell, FOUND)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def _measured_radius(rows: DataFrame, probes: list, codes: Codes, k: int, recall: float) -> int:
    """Distance that holds the share ``recall`` of the true neighbours of some queries."""
    q_ids = np.array([r["vec_id"] for r in probes])
    q_vectors = np.array([r["vector"] for r in probes])
    q_codes = codes.of(q_vectors, query=True)

    def exact(batches):
        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(), _matrix(pa.chunked_array([batch.column(1)]))
            own = codes.of(vectors)
            scores = q_vectors @ vectors.T
            scores[q_ids[:, None] == ids] = -np.inf
            top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            q = np.repeat(np.arange(len(q_ids)), top.shape[1])
            row = top.ravel()
            bits = np.bitwise_count(q_codes[q] ^ own[row]).sum(axis=1).astype(np.int32)
            real = np.isfinite(scores[q, row])
            yield pa.RecordBatch.from_arrays([pa.array(q_ids[q][real]), pa.array(scores[q, row][real]), pa.array(bits[real])], names=["query_id", "score", "bits"])

    near = rows.select("vec_id", "vector").mapInArrow(exact, "query_id long, score double, bits int")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "bits")
    near = near.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    bits = sorted(r["bits"] for r in near.select("bits").collect())
    return bits[min(len(bits) - 1, math.ceil(recall * len(bits)))] if bits else BITS


def nearest(embeddings: DataFrame, *, vector: str = "embedding", every: int = EVERY, k: int = K, recall: float = RECALL, work_dir: str | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of every ``every``-th id."""
    spark = embeddings.sparkSession
    rows = usable(embeddings, vector, work_dir)
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))).alias("norm"), F.count_if(F.col("vec_id") % every == 0).alias("q"), F.max(F.size("vector")).alias("d")).first()
    if not facts["n"] or not facts["q"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = rows.where(F.col("vec_id") % every == 0)
    # A few thousand vectors and queries, by a hash of the id: bounded, and alike in a rerun.
    by_hash = lambda df, count, most: df.where(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 30)) < int(min(1.0, 1.2 * most / count) * (1 << 30))).orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).collect()
    sample = by_hash(rows.select("vec_id", "vector"), facts["n"], SAMPLE)
    codes = learn_codes(np.array([r["vector"] for r in sample or queries.limit(SAMPLE).collect()]), facts["norm"])
    probes = by_hash(queries.select("vec_id", "vector"), facts["q"], PROBES) or queries.limit(PROBES).collect()
    radius = _measured_radius(rows, probes, codes, k, recall)

    most = max(1, min(MOST_BLOCK, NUMBERS // facts["d"]))
    block = lambda count: math.ceil(count / min(most, max(LEAST_BLOCK, count // 64)))
    wanted = min(k, facts["n"] - 1)
    done: DataFrame | None = None
    left, count = queries, facts["q"]
    while True:
        found = materialized(_grid(rows, left, codes, radius, k, (block(facts["n"]), block(count))), "ann-found", work_dir)
        full = found.groupBy("query_id").count().where(F.col("count") >= wanted).select("query_id")
        ready = found if radius >= BITS else found.join(full, "query_id", "left_semi")
        done = ready if done is None else done.unionByName(ready)
        if radius >= BITS or not wanted:
            break
        left = materialized(left.join(full.withColumnRenamed("query_id", "vec_id"), "vec_id", "left_anti"), "ann-left", work_dir)
        count = left.count()
        if not count:
            break
        radius = min(BITS, radius + 16)
    return done.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
